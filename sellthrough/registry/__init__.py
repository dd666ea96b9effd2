from sellthrough.registry.oracles import ORACLES
from sellthrough.registry.queries import QUERIES, flagship

__all__ = ["ORACLES", "QUERIES", "flagship"]
