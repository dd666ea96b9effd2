"""Files arriving over time: a file stream names the new files, each micro-batch is one ordinary load.

The stream's checkpoint remembers which files were taken. A batch that is repeated after a failure has the same id, hence
the same load ids, and leaves the fact alone if its first attempt got that far. Late and early weeks are judged by the load's own window
(older rows are counted and dropped, newer rows fail the load), so no watermark is used: it would drop without counting.
Across batches the last load wins, also where an older file arrives after a newer one, unless the warehouse guards the order. A file brings
along the other parts of its drop that still lie in the folder, so parts that come one after the other end as one drop. The file source
names a path once; a file that was sent again under its name is taken with the next batch, as its length or time has changed.

What arrives is written to the table backlog, with its turn: of every feed the oldest `max_drops` drops come first, then the next ones. Each turn
is a load of its own, and a micro-batch ends when its backlog has been handed out."""
from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from sellthrough.plans.load import plan_batch, run_load
from sellthrough.schemas import MAX_DROPS_PER_LOAD
from sellthrough.sinks.warehouse import Warehouse
from sellthrough.sources.files import list_feed_files, listed, match_feeds, pending_files, unloaded, with_file_week
from sellthrough.sources.metadata import active_feeds
from sellthrough.sources.reader import read_feed_files

BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def ingest(warehouse: Warehouse, folder: str, checkpoint: str, *, stream_name: str = "stream", run_date: date | None = None,
           start_week: date | None = None, end_week: date | None = None, max_files: int | None = None, max_drops: int = MAX_DROPS_PER_LOAD,
           archive_folder: str | None = None, environment: str = "dev", once: bool = True,
           interval: str = "10 minutes") -> StreamingQuery:
    """Start the ingest. With `once` it takes everything that waits and stops; otherwise it looks again every `interval`.
    `max_files` bounds the new files of a batch, `max_drops` the drops that a load takes of a feed; drops stay whole. Files move to `archive_folder` after their batch, if one
    is given. Arrived files that belong to no feed are kept in the table unrecognised_files."""
    spark = warehouse.spark
    options = {"recursiveFileLookup": "true"} | ({"maxFilesPerTrigger": str(max_files)} if max_files else {})
    if archive_folder:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive_folder}
    names = listed(spark.readStream.format("binaryFile").schema(BINARY_FILE).options(**options).load(folder))

    def load(arrived: DataFrame, batch_id: int) -> None:
        config = active_feeds(warehouse.read("pipeline_config"), environment)
        new = with_file_week(arrived)
        files = match_feeds(pending_files(new), config, folder)
        lying = match_feeds(pending_files(list_feed_files(spark, folder)), config, folder)
        loaded = warehouse.read("loaded_files")
        again = unloaded(lying, loaded).join(loaded.select("source_file"), "source_file", "left_semi")
        drops = files.unionByName(again).select("pipeline_id", "file_week").distinct()
        drops = drops.withColumn("turn", F.floor((F.row_number().over(Window.partitionBy("pipeline_id").orderBy("file_week")) - 1) / max_drops))
        files = files.unionByName(lying).dropDuplicates(["pipeline_id", "source_file"]).join(drops, ["pipeline_id", "file_week"])
        stamp = f"{stream_name}{batch_id:08d}"
        strangers = new.join(files.select("source_file"), "source_file", "left_anti").select("source_file", F.current_timestamp().alias("seen_at"))
        warehouse.replace_batch("unrecognised_files", strangers, stamp)
        warehouse.replace_batch("backlog", files, stamp)
        backlog = warehouse.batch("backlog", stamp)
        for turn in range((backlog.agg(F.max("turn")).first()[0] or 0) + 1):
            name = f"{stamp}t{turn}" if turn else stamp
            batch = plan_batch(spark, backlog.filter(F.col("turn") == turn).drop("turn"), config, batch_id=name, stamp=name,
                               run_date=run_date or date.today(), start_week=start_week, end_week=end_week)
            if batch is not None:
                run_load(warehouse, read_feed_files(spark, batch.paths_by_format), batch)

    writer = names.writeStream.queryName(stream_name).option("checkpointLocation", checkpoint).foreachBatch(load)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()
