"""All formats behind one call."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from sellthrough.sources.csv_feed import read_csv_feed
from sellthrough.sources.files import reader_path
from sellthrough.sources.json_feed import read_json_feed
from sellthrough.sources.workbook import read_workbook_feed

READERS = {"csv": read_csv_feed, "json": read_json_feed, "xlsx": read_workbook_feed}


def read_feed_files(spark: SparkSession, paths_by_format: dict[str, list[str]]) -> DataFrame:
    """Raw feed rows of files in several formats, given as they were listed. An unknown format raises before anything is read."""
    unknown = sorted(set(paths_by_format) - set(READERS))
    if unknown:
        raise ValueError(f"unsupported file format {', '.join(map(repr, unknown))}")
    parts = [READERS[fmt](spark, [reader_path(p) for p in paths]) for fmt, paths in sorted(paths_by_format.items()) if paths]
    return reduce(DataFrame.unionByName, parts) if parts else read_csv_feed(spark, [])
