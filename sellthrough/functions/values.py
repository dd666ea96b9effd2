"""Feed text to typed values. Every function returns NULL for text it cannot read, also under ANSI mode."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from sellthrough.functions.text import WHITESPACE
from sellthrough.schemas import MONEY

# Spark's own cast also takes '1d', '1f' and turns '1e400' into infinity, so the shape is checked first.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
# Dates outside the range of nanosecond timestamps count as unreadable.
FIRST_DATE, LAST_DATE = "1677-09-22", "2262-04-11"


def parse_date(text: Column) -> Column:
    """ISO `2026-09-26` or US `9/26/2026`; one pattern is tried per row, chosen by the separator."""
    d = F.when(F.contains(text, F.lit("/")), F.try_to_date(text, "M/d/yyyy")).otherwise(F.try_to_date(text, "yyyy-M-d"))
    return F.when(d.between(F.lit(FIRST_DATE).cast("date"), F.lit(LAST_DATE).cast("date")), d)


def _number(text: Column) -> Column:
    value = F.when(text.rlike(NUMBER), text.try_cast("double"))
    return F.when(F.abs(value) < F.lit(1e16), value)    # what DECIMAL(18,2) and BIGINT can hold


def parse_money(text: Column) -> Column:
    """`$1,234.50` -> 1234.5, `($5.25)` -> -5.25."""
    plain = F.translate(text, "$," + WHITESPACE, "")
    inner = F.substring(plain, F.lit(2), F.length(plain) - 2)
    negative = plain.startswith("(") & plain.endswith(")") & (F.length(plain) >= 2)
    return _number(F.when(negative, F.concat(F.lit("-"), inner)).otherwise(plain))


def parse_count(text: Column) -> Column:
    """`1,200` -> 1200.0; a currency sign is not accepted here."""
    return _number(F.translate(text, ",", ""))


def round_money(value: Column) -> Column:
    """Half-even on the double, as `rint(x * 100) / 100`, then an exact decimal."""
    return (F.rint(value * F.lit(100.0)) / F.lit(100.0)).cast(MONEY)


def round_count(value: Column) -> Column:
    return F.rint(value).cast("long")
