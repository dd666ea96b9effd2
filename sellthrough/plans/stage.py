"""Stage: landing rows to mapped rows."""
from __future__ import annotations

from pyspark.sql import DataFrame

from sellthrough.operators.mapping import map_products, source_rows


def stage(landing: DataFrame, stm: DataFrame) -> DataFrame:
    """All levels of all loads in one relation (schemas.STAGING)."""
    return map_products(source_rows(landing), stm)
