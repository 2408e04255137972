"""Re-run the daily job for exactly the dates that received new event files.

The job's rule for late data is that an event counts once its date is run again. This module
makes that automatic with Structured Streaming: a file stream over the two event tables'
storage yields, per micro-batch, the new rows, and ``foreachBatch`` reduces them to the distinct
days they belong to (a calendar-sized list), noted in a log table of the target database.
``rerun_pending`` then runs the job once for all noted days, however many batches named them.
With ``available_now`` this happens when the stream has taken in all files there are; a continuous
stream runs them every batch.

The log is partitioned by a generation. When days have been run, a new generation with only the
days that are still open is written, and the older ones are dropped: what a batch reads does
not grow with the batches before it. A run that dies before that leaves its days in the log, and
they are run again to the same result.

Here days are recomputed from the event tables. ``start_merged`` folds the new rows of each batch
into the kept user flags instead (``plans.published``) and never reads old events: flags merge
idempotently, so a batch that is replayed after a failure changes nothing.
"""

from __future__ import annotations

import hashlib
import logging
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import JobOptions, TableNames
from ..operators.user_flags import event_flags, merged
from ..plans import published
from ..plans.daily import run_dates
from ..session import work_dir
from ..sources.schemas import EVENT_DATE

log = logging.getLogger(__name__)


def table_location(spark: SparkSession, table: str) -> str:
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
        if r.col_name == "Location":
            return r.data_type
    raise ValueError(f"{table} has no storage location")


def new_event_days(spark: SparkSession, tables: TableNames, max_files: int | None = None) -> DataFrame:
    """A streaming DataFrame of the event_date of every new row in either event table;
    ``max_files`` bounds the files of a micro-batch (None: all there are)."""
    streams = [_event_stream(spark, t, max_files).select(EVENT_DATE) for t in (tables.tile_events, tables.interstitial_events)]
    return streams[0].unionByName(streams[1])


def _event_stream(spark: SparkSession, name: str, max_files: int | None) -> DataFrame:
    reader = spark.readStream.format("parquet").schema(spark.table(name).schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(table_location(spark, name))


LOG = "batch long, day date"
_FIRST = 0


def log_table(tables: TableNames, checkpoint: str) -> str:
    """The log of a stream, named by its checkpoint."""
    db = tables.daily_summary.rpartition(".")[0]
    name = f"tp_reruns_{hashlib.md5(checkpoint.rstrip('/').encode()).hexdigest()[:12]}"
    return f"{db}.{name}" if db else name


def _create_log(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({LOG}, gen INT) USING parquet PARTITIONED BY (gen)")


def _generation(spark: SparkSession, name: str) -> int:
    """The newest generation (from the catalog)."""
    return max((int(r[0].split("=")[1]) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()), default=_FIRST)


def _note(rows: DataFrame, name: str, gen: int) -> None:
    rows.withColumn("gen", F.lit(gen)).coalesce(1).write.insertInto(name)


def rerun_pending(spark: SparkSession, tables: TableNames, options: JobOptions, checkpoint: str) -> list:
    """Run the job once for every day in the log and start its next generation; returns the days."""
    name = log_table(tables, checkpoint)
    gen = _generation(spark, name)
    noted = spark.table(name).where((F.col("gen") == gen) & F.col("day").isNotNull())
    days, last = noted.agg(F.sort_array(F.collect_set("day")), F.max("batch")).first()  # a calendar-sized list
    if days:
        log.info("re-running %d days", len(days))
        run_dates(spark, days, tables, options)
        still = spark.table(name).where((F.col("gen") == gen) & (F.col("batch") > last)).select("batch", "day")
        mark = spark.createDataFrame([(last, None)], LOG)  # so that the generation exists
        _note(mark.unionByName(still), name, gen + 1)
        old = [int(r[0].split("=")[1]) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
        parts = ", ".join(f"PARTITION (gen = {g})" for g in sorted(old) if g <= gen)
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {parts}")
        spark.catalog.refreshTable(name)
    return days


class Reruns:
    """A started re-run stream. ``awaitTermination`` also runs the days still pending."""

    def __init__(self, query: StreamingQuery, finish):
        self.query, self._finish = query, finish

    def awaitTermination(self, timeout: int | None = None) -> bool:
        ended = self.query.awaitTermination(timeout) if timeout is not None else self.query.awaitTermination()
        if not self.query.isActive:
            self._finish()
        return bool(ended) if timeout is not None else True

    def stop(self) -> None:
        self.query.stop()


def start_reruns(
    spark: SparkSession,
    tables: TableNames = TableNames(),
    options: JobOptions = JobOptions(),
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files: int | None = None,
) -> Reruns:
    """Start the re-run stream. ``available_now`` takes in what is there, runs each touched day
    once and stops; else every micro-batch runs its days."""
    checkpoint = checkpoint or _default_checkpoint(spark, tables)
    name = log_table(tables, checkpoint)
    _create_log(spark, name)

    def note(batch: DataFrame, batch_id: int) -> None:
        days = batch.select(F.lit(batch_id).cast("long").alias("batch"), F.col(EVENT_DATE).alias("day"))
        # the job runs in the caller's session (foreachBatch runs on the driver), so its table
        # caches stay consistent with the tables it rewrites
        _note(days.where("day IS NOT NULL").distinct(), name, _generation(spark, name))
        spark.catalog.refreshTable(name)
        if not available_now:
            rerun_pending(spark, tables, options, checkpoint)

    events = new_event_days(spark, tables, max_files)
    return Reruns(
        _started(events, note, checkpoint, available_now, processing_time),
        lambda: rerun_pending(spark, tables, options, checkpoint),
    )


def _default_checkpoint(spark: SparkSession, tables: TableNames, kind: str = "") -> str:
    return os.path.join(work_dir(spark), "tilepulse-streams", tables.daily_summary.replace(".", "_") + kind)


def _started(events: DataFrame, each, checkpoint: str, available_now: bool, processing_time: str | None) -> StreamingQuery:
    writer = events.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time or "1 minute")
    return writer.start()


def start_merged(
    spark: SparkSession,
    tables: TableNames = TableNames(),
    options: JobOptions = JobOptions(),
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Start the stream that folds the new events of each micro-batch into the user flags and
    publishes the days they touch (``published.create_published(state=True)`` made the targets)."""
    streams = [_event_stream(spark, t, max_files) for t in (tables.tile_events, tables.interstitial_events)]
    flags = event_flags(*streams)

    def fold(batch: DataFrame, batch_id: int) -> None:
        published.apply_flags(spark, merged(batch), tables, options)

    checkpoint = checkpoint or _default_checkpoint(spark, tables, "-merged")
    return _started(flags, fold, checkpoint, available_now, processing_time)
