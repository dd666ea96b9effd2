"""JSON feeds (one array of records per file) and landed API pages ({"data": [...], "next_cursor", "total"}).

An array is read by as many tasks as its file has splits. The reader cuts text at every closing brace, which ends most records; whether a brace
ends one depends on what stands before it: an open string, or an outer object. Both are sums over all text before (of quotes and of braces outside
strings), so they are added up within each split and then over the splits of a file, see `array_records`. A file whose chunks all look like records
that follow each other needs no such sums, see `file_shapes`. Pages are small and are read whole."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sellthrough.functions.text import standard_name
from sellthrough.operators.joins import join_bounded
from sellthrough.schemas import FEED_COLUMNS
from sellthrough.session import materialise
from sellthrough.sources.files import reader_path
from sellthrough.sources.layout import ambiguous, empty_feed, from_records
from sellthrough.sources.states import counted_before

NO_RECORDS = "the document is no JSON array of records and no page of them"
# A drop's path without its part: what its pages have in common.
DROP = r"(?i)^(.*_\d{8})(?:_part\d+)?\.json(?:/part-[^/]*)?$"
PAGE_COUNTS = "struct<data:array<string>,next_cursor:bigint,total:bigint>"
PAGE = "struct<data:array<map<string,string>>,next_cursor:bigint,total:bigint>"


def _whole_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    return (spark.read.text(paths, wholetext=True)
            .select(F.col("_metadata.file_path").alias("source_file"), "value"))


def _explode_records(rows: DataFrame) -> DataFrame:
    """(source_file, records array<map>, document_error) to raw feed rows.

    Which header of the document means which standard column is settled once per document; a record then takes one map
    lookup per column."""
    headers = F.array_distinct(F.flatten(F.transform("records", lambda r: F.map_keys(r))))
    named = rows.withColumn("headers", headers).withColumn("names", F.transform("headers", lambda h: standard_name(h)))
    at = [F.array_position("names", F.lit(c)).cast("int") for c in FEED_COLUMNS]
    own = F.array(*[F.when(p > 0, F.get("headers", p - 1)) for p in at])
    error = F.coalesce("document_error", ambiguous(F.col("names")))
    # A faulty document makes one row, which carries the fault.
    listed = F.when(F.col("document_error").isNotNull() & (F.coalesce(F.size("records"), F.lit(0)) == 0),
                    F.array(F.lit(None).cast("map<string,string>"))).otherwise(F.col("records"))
    return from_records(named.withColumns({"own": own, "layout_error": error}).select(
        "source_file", "own", "layout_error", F.explode(listed).alias("record")))


# A string, and one that is open at the end. Possessive, as each has one reading only.
_IN_STRING = r'(?:[^"\\]++|\\.)*+'
_STRINGS = rf'(?s)"{_IN_STRING}(?:"|$)'


def json_chunks(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(source_file, split, chunk_no, value): the text between closing braces, numbered in order within each split of its file."""
    return spark.read.option("lineSep", "}").text(paths).select(
        F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("chunk_no"), "value")


# Outside strings, a chunk that is one record without braces of its own, after the array's bracket or a comma; and what follows the last one.
_FIRST_RECORD = r'^[\s\x{FEFF}]*\[\s*\{[^{"\\]*$'
_NEXT_RECORD = r'^\s*,\s*\{[^{"\\]*$'
_END = r"^\s*\]\s*$"


def file_shapes(chunks: DataFrame) -> DataFrame:
    """(source_file, is_array, is_flat): whether the first character of each file that is no white space opens an array, and whether every chunk of it
    is a record, the array's end coming last. While all chunks before are records, each begins outside of strings and braces, so no order of
    reading is needed to tell."""
    outside = F.regexp_replace("value", rf'(?s)"{_IN_STRING}"', "")
    is_first, is_next, is_end = outside.rlike(_FIRST_RECORD), outside.rlike(_NEXT_RECORD), F.col("value").rlike(_END)
    kind = F.when(is_next, 0).when(is_first, 1).when(is_end, 2).otherwise(3)
    first = F.ascii(F.ltrim(F.regexp_replace("value", r"^[\s\x{FEFF}]+", "")))
    rows = chunks.select("source_file", "split", "chunk_no", kind.alias("kind"), first.alias("first"))
    no = F.col("chunk_no")
    splits = rows.groupBy("source_file", "split").agg(
        F.min(no).alias("low"), F.max(no).alias("high"), F.min_by("first", no).alias("first"), F.count_if(F.col("kind") == 3).alias("others"),
        F.count_if(F.col("kind") == 1).alias("firsts"), F.count_if(F.col("kind") == 2).alias("ends"),
        F.min(F.when(F.col("kind") == 1, no)).alias("first_no"), F.max(F.when(F.col("kind") == 2, no)).alias("end_no"))
    opens, closes = F.min_by(F.col("first_no") == F.col("low"), "split"), F.max_by(F.col("end_no") == F.col("high"), "split")
    flat = (F.sum("others") == 0) & (F.sum("firsts") == 1) & (F.sum("ends") == 1) & opens & closes
    is_array = (F.min("split") == 0) & (F.min_by("first", "split") == ord("["))
    return splits.groupBy("source_file").agg(is_array.alias("is_array"), F.coalesce(flat, F.lit(False)).alias("is_flat"))


def flat_records(chunks: DataFrame) -> DataFrame:
    """`array_records` of flat files."""
    text = F.concat(F.substring("value", F.instr("value", "{"), F.length("value")), F.lit("}"))
    rows = chunks.filter(F.contains("value", F.lit("{"))).select("source_file", F.from_json(text, "map<string,string>").alias("record"))
    return rows.withColumn("problem", F.when(F.col("record").isNull(), F.lit(NO_RECORDS)))


def array_records(chunks: DataFrame) -> DataFrame:
    """(source_file, record map<string,string>, problem) of files that hold an array of records. A file that isn't one makes a row with a problem
    for every place at which it fails."""
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    rows = chunks.withColumn("flips", (F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))) % 2)
    keys = ["source_file", "split"]

    def over_splits(rows: DataFrame, sums: dict[str, str], name: str) -> DataFrame:
        """Sums over everything before in the file: those of the split, and those of the splits before."""
        inner = materialise(counted_before(rows, sums, keys, "chunk_no"), name)
        splits = inner.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
        splits = materialise(counted_before(splits, {c: f"{c}_earlier" for c in sums}, ["source_file"], "split").drop(*sums), f"{name}-splits")
        joined = join_bounded(inner, splits, keys, "inner", splits.count())
        return joined.withColumns({v: F.col(v) + F.col(f"{c}_earlier") for c, v in sums.items()}).drop(*[f"{c}_earlier" for c in sums])

    rows = over_splits(rows, {"flips": "quotes"}, "json-quotes")
    inside = F.col("quotes") % 2 == 1
    text = F.when(inside, F.regexp_replace("value", rf'(?s)^{_IN_STRING}(?:"|$)', "")).otherwise(F.col("value"))
    outside = F.regexp_replace(text, _STRINGS, "")
    # The last chunk of a file is what follows its last brace; it ends with none.
    ends = materialise(rows.groupBy("source_file").agg(F.max(F.struct("split", "chunk_no")).alias("end")), "json-ends")
    rows = join_bounded(rows.withColumn("outside", outside), ends, "source_file", "inner", ends.count())
    rows = rows.withColumn("last", F.struct("split", "chunk_no") == F.col("end")).drop("end")
    closes = F.when(F.col("last") | ((F.col("quotes") + F.col("flips")) % 2 == 1), 0).otherwise(1)
    rows = rows.withColumn("closes", closes).withColumn("step", F.length("outside") - F.length(F.replace("outside", F.lit("{"), F.lit(""))) - F.col("closes"))
    rows = over_splits(rows.drop("flips", "quotes"), {"step": "depth"}, "json-depth")
    rows = rows.withColumn("ends", ((F.col("closes") == 1) & (F.col("depth") + F.col("step") == 0)).cast("int"))
    rows = over_splits(rows, {"ends": "record_no"}, "json-records")
    alone = (F.col("ends") == 1) & (F.col("depth") == 0)
    part = F.struct("split", "chunk_no", "value")
    text_of = F.array_join(F.transform(F.sort_array(F.collect_list(part)), lambda x: x.value), "}")
    several = rows.filter(~alone).groupBy("source_file", "record_no").agg(text_of.alias("value"), F.max("ends").alias("ends"))
    records = rows.filter(alone).select("source_file", "record_no", "value", "ends").unionByName(several)
    # A record follows the array's bracket or a comma; after the last one only the closing bracket is left.
    before = F.when(F.col("record_no") == 0, F.lit(r"(?s)^[\s\x{FEFF}]*\[\s*")).otherwise(F.lit(r"(?s)^\s*,\s*"))
    end = F.when(F.col("record_no") == 0, F.lit(r"(?s)^[\s\x{FEFF}]*\[\s*\]\s*$")).otherwise(F.lit(r"(?s)^\s*\]\s*$"))
    record = F.from_json(F.concat(F.regexp_replace(F.col("value"), before, F.lit("")), F.lit("}")), "map<string,string>")
    rows = records.withColumn("record", F.when(F.col("ends") == 1, F.when(F.regexp_like("value", F.concat(before, F.lit(r"\{.*"))), record)))
    fits = F.when(F.col("ends") == 1, F.col("record").isNotNull()).otherwise(F.regexp_like("value", end))
    rows = rows.withColumn("problem", F.when(~F.coalesce(fits, F.lit(False)), F.lit(NO_RECORDS)))
    return rows.filter("ends = 1 or problem is not null").select("source_file", "record", "problem")


def _split_arrays(spark: SparkSession, records: DataFrame) -> DataFrame:
    """Raw feed rows of array files' records. The headers of a file are settled once, from the distinct ones of its records."""
    rows = materialise(records, "json-array")
    keys = rows.select("source_file", F.map_keys("record").alias("keys")).distinct()
    names = keys.select("source_file", F.explode("keys").alias("header")).distinct()
    headers = names.groupBy("source_file").agg(F.sort_array(F.collect_list("header")).alias("headers"))
    files = materialise(headers.withColumn("names", F.transform("headers", lambda h: standard_name(h))), "json-headers")
    at = [F.array_position("names", F.lit(c)).cast("int") for c in FEED_COLUMNS]
    own = F.array(*[F.when(p > 0, F.get("headers", p - 1)) for p in at])
    files = files.select("source_file", own.alias("own"), ambiguous(F.col("names")).alias("ambiguous"))
    broken = rows.filter("problem is not null").select("source_file", "problem").distinct()
    files = materialise(files.join(broken, "source_file", "full_outer").select("source_file", "own", F.coalesce("problem", "ambiguous").alias("layout_error")), "json-files")
    # A faulty document makes one row without a record, which carries the fault, beside the rows that could be read.
    found = join_bounded(rows.filter("problem is null").select("source_file", "record"), files, "source_file", "inner", files.count())
    faults = files.filter("layout_error is not null").select("source_file", F.lit(None).cast("map<string,string>").alias("record"), "own", "layout_error")
    faults = faults.join(rows.filter("problem is null").select("source_file").distinct(), "source_file", "left_anti")
    return from_records(found.unionByName(faults))


def json_records(rows: DataFrame) -> DataFrame:
    """(source_file, value) with one JSON document per row to raw feed rows. A document is an array of records, or an API
    page landed as it came."""
    is_page = F.ltrim("value").startswith("{")
    records = (F.when(is_page, F.from_json("value", PAGE)["data"])
               .otherwise(F.from_json("value", "array<map<string,string>>")))
    found = rows.select("source_file", records.alias("records"), (F.btrim("value") == "").alias("blank"))
    broken = F.when(F.col("records").isNull() & ~F.coalesce("blank", F.lit(True)), F.lit(NO_RECORDS))
    return _explode_records(found.select("source_file", "records", broken.alias("document_error")))


def read_json_feed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Raw feed rows of all documents. API pages of a drop whose records are not all there are a fault of that drop."""
    if not paths:
        return empty_feed(spark)
    shapes = file_shapes(json_chunks(spark, paths)).filter("is_array").collect()
    flat, nested = (sorted({reader_path(r.source_file) for r in shapes if r.is_flat == x}) for x in (True, False))
    others = [p for p in paths if p not in {*flat, *nested}]
    parts = [_split_arrays(spark, flat_records(json_chunks(spark, flat)))] if flat else []
    parts += [_split_arrays(spark, array_records(json_chunks(spark, nested)))] if nested else []
    parts += [_whole_documents(spark, others)] if others else []
    return reduce(DataFrame.unionByName, parts)


def _whole_documents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Raw feed rows of pages, and of documents that are neither arrays nor pages."""
    documents = _whole_files(spark, paths)
    drop = F.regexp_extract("source_file", DROP, 1)
    pages = documents.filter(F.ltrim("value").startswith("{")).select("source_file", F.from_json("value", PAGE_COUNTS).alias("p"))
    pages = pages.select("source_file", F.col("p.data").alias("records"), "p.next_cursor", "p.total")
    # One row per drop with a fault: as a rule none.
    missing = materialise(incomplete_feeds(pages, drop).select(
        "feed", F.concat(F.lit("pages are missing: "), F.col("records").cast("string"), F.lit(" records of "), F.col("total").cast("string")).alias("missing")), "missing-pages")
    rows = json_records(documents)
    if missing.isEmpty():
        return rows
    named = rows.withColumn("feed", drop).join(missing, "feed", "left")
    return named.withColumn("layout_error", F.coalesce("layout_error", "missing")).select(*rows.columns)


def api_pages(rows: DataFrame) -> DataFrame:
    """(source_file, value) with one page envelope per row to (source_file, records, next_cursor, total)."""
    return rows.select("source_file", F.from_json("value", PAGE).alias("p")).select(
        "source_file", F.col("p.data").alias("records"), "p.next_cursor", "p.total")


def flatten_pages(pages: DataFrame) -> DataFrame:
    """Raw feed rows of all pages."""
    return _explode_records(pages.select("source_file", "records", F.lit(None).cast("string").alias("document_error")))


def page_totals(pages: DataFrame, feed: Column) -> DataFrame:
    """Per feed: records received, the total every page announces, and whether all records arrived exactly once."""
    received, total = F.sum(F.size("records")), F.max("total")
    return pages.groupBy(feed.alias("feed")).agg(
        F.count("*").alias("pages"), received.cast("long").alias("records"), total.alias("total"),
        F.count_if(F.col("next_cursor").isNull()).alias("last_pages"),
        ((received == total) & (F.min("total") == total)).alias("is_complete"))


def incomplete_feeds(pages: DataFrame, feed: Column) -> DataFrame:
    return page_totals(pages, feed).filter(~F.col("is_complete") | (F.col("last_pages") != 1))


def read_api_pages(spark: SparkSession, paths: list[str]) -> DataFrame:
    return api_pages(_whole_files(spark, paths))
