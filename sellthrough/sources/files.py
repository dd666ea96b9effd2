"""Feed files as rows: which files wait, which week they close, which feed they belong to."""
from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sellthrough import schemas as S

# Fixed value: the naming rule <retailer>_<client>_<YYYYMMDD>[_partN].<csv|xlsx|json>. A drop may also be a folder of
# that name holding part files, which is how Spark itself writes one.
FILE_NAME = r"(?i)_(\d{8})(?:_part\d+)?\.(csv|xlsx|json)(?:/part-[^/]*)?$"
FEED_FOLDER = r"(?i)^(.*?)/?[^/]*_\d{8}(?:_part\d+)?\.(?:csv|xlsx|json)(?:/part-[^/]*)?$"


def reader_path(listed: str) -> str:
    """A listed path, which is URL-encoded, as Spark's readers take it: plain, with glob characters escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(listed))


def file_week(path: Column) -> Column:
    """Week in the file name; NULL for other names and for eight digits that are no date."""
    return F.try_to_date(F.regexp_extract(path, FILE_NAME, 1), "yyyyMMdd")


def list_feed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every file below a folder: (source_file, length, modified, file_week, file_format). Lists names only, reads no content."""
    return with_file_week(listed(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)))


def listed(files: DataFrame) -> DataFrame:
    """What identifies the files of Spark's binary file source."""
    return files.select(F.col("_metadata.file_path").alias("source_file"), "length", F.col("modificationTime").alias("modified"))


def with_file_week(files: DataFrame) -> DataFrame:
    return files.select(*files.columns, file_week(F.col("source_file")).alias("file_week"),
                        F.lower(F.regexp_extract("source_file", FILE_NAME, 2)).alias("file_format"))


def pending_files(files: DataFrame) -> DataFrame:
    """Files named like a drop; others are ignored."""
    return files.filter(F.col("file_week").isNotNull())


def unrecognised_files(files: DataFrame) -> DataFrame:
    """Files a drop listing leaves out, for the report."""
    return files.filter(F.col("file_week").isNull())


def below(path: Column, folder: str) -> Column:
    """The part of a listed path below a folder, in plain text; NULL for others."""
    # Listed paths are URL-encoded; a plus sign in them is one.
    trimmed = F.regexp_replace(F.url_decode(F.regexp_replace(path, r"\+", "%2B")), "^file:/+", "/")
    root = "/" + folder.removeprefix("file:").strip("/") if "://" not in folder.removeprefix("file://") else folder.rstrip("/")
    return F.when(trimmed.startswith(root + "/"), F.substring(trimmed, F.lit(len(root) + 2), F.length(trimmed)))


def match_feeds(files: DataFrame, config: DataFrame, folder: str) -> DataFrame:
    """Give each file its feed: the folder part of its path below `folder` equals the feed's source_location."""
    located = files.withColumn("source_location", F.regexp_extract(below(F.col("source_file"), folder), FEED_FOLDER, 1))
    feeds = config.withColumn("source_location", F.btrim("source_location", F.lit("/"))).select(
        "pipeline_id", "source_location")
    return located.join(feeds, "source_location").drop("source_location")


def cap_drops(files: DataFrame, limit: int = S.MAX_DROPS_PER_LOAD) -> DataFrame:
    """Files of the oldest drops of each feed, at most `limit` drops a load; the rest wait for the next load. A drop is all
    that a feed has for one week, however many parts it came in."""
    order = Window.partitionBy("pipeline_id").orderBy("file_week")
    drops = files.select("pipeline_id", "file_week").distinct().withColumn("drop_no", F.row_number().over(order))
    return files.join(drops.filter(F.col("drop_no") <= limit).drop("drop_no"), ["pipeline_id", "file_week"], "left_semi")


def unloaded(files: DataFrame, loaded: DataFrame) -> DataFrame:
    """Files that were not loaded as they are now: new ones, and such as were sent again under their name."""
    same = [F.col(f"f.{c}").eqNullSafe(F.col(f"l.{c}")) for c in S.FILE_IDENTITY.names]
    return files.alias("f").join(loaded.select(S.FILE_IDENTITY.names).alias("l"), same, "left_anti")


def whole_drops(files: DataFrame, loaded: DataFrame) -> DataFrame:
    """Files of drops that still have a file which is not among the loaded ones. A part that comes late brings its drop's
    other parts along: a week is replaced by the load that reports it, so it has to be reported whole."""
    waiting = unloaded(files, loaded).select("pipeline_id", "file_week").distinct()
    return files.join(waiting, ["pipeline_id", "file_week"], "left_semi")


def next_files(spark: SparkSession, folder: str, config: DataFrame, loaded: DataFrame | None = None,
               limit: int = S.MAX_DROPS_PER_LOAD, archive: str | None = None) -> DataFrame:
    """Files of the next load. Parts of its drops that went to the archive come along, unless a file of their name lies below `folder` again (for
    a drop that is a folder of part files: unless that folder does)."""
    files = match_feeds(pending_files(list_feed_files(spark, folder)), config, folder)
    files = cap_drops(files if loaded is None else whole_drops(files, loaded), limit)
    if archive is None:
        return files
    try:
        kept = match_feeds(pending_files(list_feed_files(spark, archive)), config, archive)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return files

    def place(root: str) -> Column:
        return F.regexp_replace(below(F.col("source_file"), root), "/part-[^/]*$", "").alias("place")

    kept = kept.select("*", place(archive)).join(files.select("pipeline_id", "file_week").distinct(), ["pipeline_id", "file_week"], "left_semi")
    return files.unionByName(kept.join(files.select(place(folder)), "place", "left_anti").drop("place"))


def archive_files(spark: SparkSession, paths: list[str], folder: str, archive: str) -> None:
    """Move listed files to the same place below `archive`. A file that has already gone is passed over, so a broken move can be repeated; one of
    the same name is replaced. A move is a rename, and as many as a batch has files."""
    rooted = unquote(folder.removeprefix("file://")).rstrip("/")
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()

    def move(listed_path: str) -> None:
        plain = re.sub("^file:/+", "/", unquote(listed_path))
        if not plain.startswith(rooted + "/"):
            return                                        # in the archive already
        old, new = hadoop.Path(plain), hadoop.Path(archive.rstrip("/") + plain[len(rooted):])
        fs = old.getFileSystem(conf)
        if fs.exists(old):
            fs.mkdirs(new.getParent())
            if fs.exists(new):
                fs.delete(new, False)
            if not fs.rename(old, new):
                raise OSError(f"{listed_path} could not be moved to {new.toString()}")

    with ThreadPoolExecutor(16) as pool:
        list(pool.map(move, paths))
