"""Event loads that are checked, diverted and published in one pass.

The reference partitions events by the day of their timestamp, so a wrong day cannot be stored.
Parquet tables hold the day as a column; here a load enforces it. An event table is the pair

* ``<name>__versions``: partitioned by the stored day, the load and a verdict (``ok`` or a reason);
* the view ``<name>``: rows of published loads whose verdict is ``ok``; and beside it
  ``<name>__quarantine``: the other rows, with their ``reason``.

One write routes every row by its verdict and observes how many there are of each. A load's
tables appear together, by one append to the manifest: a load that fails in any of them shows
nothing, and repeating it duplicates nothing.

The day is that of ``event_ts`` in the table's zone, a property of the table, so it does not move
with the session that loads or reads.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace as changed

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import versions as V
from ..config import TableNames
from ..sources.schemas import EVENT_DATE, SPECS, create_table_ddl, _quote

log = logging.getLogger(__name__)

OK = "ok"
#: Why a row is kept apart.
REASONS = {"no_timestamp": "event_ts is null", "wrong_day": "the stored day is not the day of event_ts"}
_ZONE = "tilepulse.zone"
_REASON = "reason"


def quarantine(table: str) -> str:
    return f"{table}__quarantine"


def create_checked_sources(spark: SparkSession, tables: TableNames = TableNames(), zone: str = "UTC") -> None:
    """Both event tables as published loads with a quarantine each, and the plain metadata table."""
    for name in {t.split(".")[0] for t in vars(tables).values() if "." in t}:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    V.create_manifest(spark, tables.manifest)
    spark.sql(create_table_ddl(tables.tile_metadata, SPECS["tile_metadata"]))
    for table, key in ((tables.tile_events, "tile_events"), (tables.interstitial_events, "interstitial_events")):
        spec = SPECS[key]
        added = [T.StructField(V.RUN, T.StringType()), T.StructField(_REASON, T.StringType())]
        stored = changed(spec, schema=T.StructType([*spec.schema.fields, *added]), partition_cols=(EVENT_DATE, V.RUN, _REASON))
        spark.sql(create_table_ddl(V.physical(table), stored))
        spark.sql(f"ALTER TABLE {V.physical(table)} SET TBLPROPERTIES ('{_ZONE}' = {_quote(zone)})")
        loads = f"(SELECT DISTINCT {V.RUN} FROM {tables.manifest} WHERE table_name = '{V.base_name(table)}')"  # a row a load
        cols = ", ".join(f"v.`{f.name}`" for f in spec.schema.fields)
        read = f"FROM {V.physical(table)} v JOIN {loads} m ON v.{V.RUN} = m.{V.RUN}"
        head = f"CREATE VIEW IF NOT EXISTS {table} ({V.view_columns(spec)}) COMMENT {_quote(spec.comment)}"
        spark.sql(f"{head} AS SELECT /*+ BROADCAST(m) */ {cols} {read} WHERE v.{_REASON} = '{OK}'")
        aside = f"CREATE VIEW IF NOT EXISTS {quarantine(table)} AS SELECT /*+ BROADCAST(m) */ {cols}, v.{_REASON}"
        spark.sql(f"{aside} {read} WHERE v.{_REASON} <> '{OK}'")


def table_zone(spark: SparkSession, table: str) -> str:
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {V.physical(table)}").collect()}
    return found.get(_ZONE, "UTC")


def day_in(spark: SparkSession, events: DataFrame, zone: str, ts: str = "event_ts") -> Column:
    """The day of a timestamp in a zone; one without a zone is taken as that zone's wall clock."""
    if isinstance(events.schema[ts].dataType, T.TimestampNTZType):
        return F.to_date(ts)
    return F.expr(f"to_date(convert_timezone(current_timezone(), {_quote(zone)}, CAST(`{ts}` AS TIMESTAMP_NTZ)))")


def judged(spark: SparkSession, events: DataFrame, zone: str) -> DataFrame:
    """``events`` with their day (filled in where it is not given) and the verdict on it."""
    day = day_in(spark, events, zone)
    if EVENT_DATE in events.columns:
        events = events.withColumn(EVENT_DATE, F.coalesce(EVENT_DATE, day))
    else:
        events = events.withColumn(EVENT_DATE, day)
    wrong = F.when(F.col(EVENT_DATE) != day, F.lit("wrong_day")).otherwise(F.lit(OK))
    return events.withColumn(_REASON, F.when(F.col("event_ts").isNull(), F.lit("no_timestamp")).otherwise(wrong))


def _stage(spark: SparkSession, events: DataFrame, table: str, run_id: str) -> dict[str, int]:
    """Write one table of a load; how many rows got each verdict, observed by the write."""
    target = spark.table(V.physical(table)).columns
    rows = judged(spark, events, table_zone(spark, table)).withColumn(V.RUN, F.lit(run_id)).select(*target)
    seen = Observation()
    rows = rows.observe(seen, *[F.count_if(F.col(_REASON) == r).alias(r) for r in (OK, *REASONS)])
    rows.hint("rebalance", EVENT_DATE, _REASON).write.insertInto(V.physical(table))
    if not any(run == run_id for run in _runs(spark, table)):
        return dict.fromkeys((OK, *REASONS), 0)  # an empty plan is not run, and not observed
    return seen.get


def _runs(spark: SparkSession, table: str) -> set[str]:
    parts = (dict(p.split("=", 1) for p in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {V.physical(table)}").collect())
    return {p[V.RUN] for p in parts}


def load_checked(
    spark: SparkSession, tile_events: DataFrame, inter_events: DataFrame, tables: TableNames = TableNames()
) -> Mapping[str, dict[str, int]]:
    """Add one load to both event tables; returns the number of rows per table and verdict. Both
    are written as concurrent jobs and shown by one commit, or not at all."""
    run_id = V.new_run()
    parts = {tables.tile_events: tile_events, tables.interstitial_events: inter_events}
    with ThreadPoolExecutor(max_workers=len(parts)) as pool:
        jobs = {t: pool.submit(_stage, spark, df, t, run_id) for t, df in parts.items()}
    counts = {t: job.result() for t, job in jobs.items()}
    V.publish(spark, tables.manifest, [(t, run_id, None, "append") for t in parts])
    for t, n in counts.items():
        if aside := {r: n[r] for r in REASONS if n[r]}:
            log.warning("%s: rows kept apart %s", t, aside)
    return counts
