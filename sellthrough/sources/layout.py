"""Shared last step of the readers: named cells to the raw feed contract (`schemas.RAW_FEED`)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sellthrough.functions.text import standard_name
from sellthrough.schemas import FEED_COLUMNS, RAW_FEED


def ambiguous(names: Column) -> Column:
    """Error text when two headers of a file mean the same standard column, else NULL."""
    twice = F.concat_ws(", ", *[F.when(F.size(names) - F.size(F.array_remove(names, c)) > 1, F.lit(c)) for c in FEED_COLUMNS])
    return F.when(twice != "", F.concat(F.lit("two columns mean "), twice))


def column_positions(names: Column) -> Column:
    """Index of each FEED_COLUMNS name among a file's names, NULL where the layout lacks it."""
    at = [F.array_position(names, F.lit(c)).cast("int") for c in FEED_COLUMNS]
    return F.array(*[F.when(p > 0, p - 1) for p in at])


def unique_names(names: Column) -> Column:
    """Repeated or empty names get their position appended, so that they can key a map."""
    return F.transform(names, lambda n, i: F.when(
        (n == "") | (F.array_position(names, n) != i + 1), F.concat(n, F.lit("_"), (i + 1).cast("string"))).otherwise(n))


def from_cells(rows: DataFrame) -> DataFrame:
    """Rows of (source_file, names, positions, cells, layout_error): pick the standard columns by position.

    Names and positions are worked out once per file. A column the layout lacks stays NULL. A row has at least as many
    cells as its file has names, missing ones being ''."""
    def pick(i: int) -> Column:
        at = F.get("positions", F.lit(i))
        return F.when(at.isNotNull(), F.get("cells", at)).alias(FEED_COLUMNS[i])

    return rows.select("source_file", *[pick(i) for i in range(len(FEED_COLUMNS))], F.col("names").alias("raw_names"),
                       F.col("cells").alias("raw_cells"), "layout_error")


def raw_map() -> Column:
    """The raw cells of a row by standard name, for rejects. Cells beyond the header are named by their position."""
    beyond = F.transform(F.sequence(F.size("raw_names"), F.greatest(F.size("raw_cells"), F.size("raw_names"))), lambda i: F.lit(""))
    named = F.transform("raw_names", lambda n: standard_name(n))
    names = unique_names(F.slice(F.concat(named, beyond), F.lit(1), F.size("raw_cells")))
    return F.map_from_arrays(names, F.col("raw_cells"))


def is_ragged() -> Column:
    """Whether a row has more cells than its file's header."""
    return F.coalesce(F.size("raw_cells") > F.size("raw_names"), F.lit(False))


def from_records(rows: DataFrame) -> DataFrame:
    """Rows of (source_file, own, record, layout_error): pick the standard columns by the document's own header for each
    (`own`, in FEED_COLUMNS order, NULL where no record has one)."""
    def pick(i: int) -> Column:
        header = F.get("own", F.lit(i))
        return (F.when(header.isNotNull(), F.coalesce(F.try_element_at("record", header), F.lit("")))
                .alias(FEED_COLUMNS[i]))

    return rows.select("source_file", *[pick(i) for i in range(len(FEED_COLUMNS))], F.map_keys("record").alias("raw_names"),
                       F.map_values("record").alias("raw_cells"), "layout_error")


def empty_feed(spark) -> DataFrame:
    return spark.createDataFrame([], RAW_FEED)
