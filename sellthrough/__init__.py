"""Weekly retail sell-through analytics as Spark DataFrame jobs."""
import sys

from pyspark import cloudpickle

# The few Python functions that run on executors travel with their task, so nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
