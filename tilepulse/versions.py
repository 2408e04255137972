"""Published versions: rows are staged under a run's own partitions, one commit shows them.

A *versioned* table is a pair: ``<name>__versions``, a Parquet table partitioned by the day and
``run_id``, and the view ``<name>`` that readers use. Writing only ever adds partitions of a new
run, which no reader sees. What they see is in the manifest, a small table of (table, day, run):
a run publishes by appending one file to it, with entries for every table it wrote, so all of
them change at once or not at all. A run that fails before that leaves nothing but unseen
partitions; running again is a new run.

Per table and day, an entry of mode ``replace`` ends what was there (a day without rows is an entry
like any other), one of mode ``append`` adds to it. If two runs publish at the same time the one
with the greater (seq, run_id) holds, for all its tables alike.

The view joins the versions to the members of the manifest, one row a day and run, broadcast;
that prunes the partitions read. ``revert`` points days back to the run before; ``vacuum`` drops
partitions that no entry of the last ``history`` replacements needs.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import replace as changed

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .config import as_date
from .sources.schemas import TableSpec, _quote, create_table_ddl

log = logging.getLogger(__name__)

RUN = "run_id"
MANIFEST = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField(RUN, T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("mode", T.StringType()),
    ]
)


def new_run() -> str:
    """An id that no other run has and that sorts by time."""
    return f"{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def physical(table: str) -> str:
    return f"{table}__versions"


def base_name(table: str) -> str:
    """A table's name in the manifest (without its database)."""
    return table.split(".")[-1].lower()


def members_sql(manifest: str, table: str) -> str:
    """(day, run_id) of the runs that make up each day of a table now."""
    order = f"struct(seq, {RUN})"
    last = f"max(CASE WHEN mode = 'replace' THEN {order} END) OVER (PARTITION BY day)"
    return (
        f"SELECT DISTINCT day, {RUN} FROM (SELECT day, {RUN}, {order} AS at, {last} AS base FROM {manifest} "
        f"WHERE table_name = '{base_name(table)}') WHERE base IS NULL OR at >= base"
    )


def create_manifest(spark: SparkSession, manifest: str) -> None:
    spec = TableSpec(MANIFEST, (), "Which run's rows each day of each versioned table consists of")
    spark.sql(create_table_ddl(manifest, spec))


def view_columns(spec: TableSpec) -> str:
    return ", ".join(
        f"`{f.name}`" + (f" COMMENT {_quote(f.metadata['comment'])}" if f.metadata.get("comment") else "")
        for f in spec.schema.fields
    )


def create_versioned(spark: SparkSession, table: str, spec: TableSpec, manifest: str) -> None:
    """The pair for a table of the registry that is partitioned by one day column."""
    (day,) = spec.partition_cols
    create_manifest(spark, manifest)
    stored = T.StructType([*spec.schema.fields, T.StructField(RUN, T.StringType())])
    spark.sql(create_table_ddl(physical(table), changed(spec, schema=stored, partition_cols=(day, RUN))))
    cols = ", ".join(f"v.`{f.name}`" for f in spec.schema.fields)
    spark.sql(
        f"CREATE VIEW IF NOT EXISTS {table} ({view_columns(spec)}) COMMENT {_quote(spec.comment)} AS "
        f"SELECT /*+ BROADCAST(m) */ {cols} FROM {physical(table)} v JOIN ({members_sql(manifest, table)}) m "
        f"ON v.`{day}` = m.day AND v.{RUN} = m.{RUN}"  # one row a day and run: calendar-sized
    )


def is_versioned(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(physical(table))


def _day_column(spark: SparkSession, table: str) -> str:
    return next(c.name for c in spark.catalog.listColumns(physical(table)) if c.isPartition)


def stage(spark: SparkSession, df: DataFrame, table: str, run_id: str) -> set[dt.date]:
    """Write ``df`` as partitions of the run; nobody sees them yet. Returns the days written, from
    the catalog. Columns go by name; lacking or unknown ones are refused, and rows without a day."""
    target = spark.table(physical(table))
    cols, day = [c for c in target.columns if c != RUN], _day_column(spark, table)
    odd = sorted(set(cols) ^ set(df.columns))
    if odd:
        raise ValueError(f"{table}: result and table differ in columns {odd}")
    dated = F.when(F.col(day).isNull(), F.raise_error(F.lit(f"{table}: a row has no {day}"))).otherwise(F.col(day))
    rows = df.withColumn(day, dated).select(*cols, F.lit(run_id).alias(RUN)).select(*target.columns)
    rows.hint("rebalance", day).write.insertInto(physical(table))
    return days_of(spark, table, run_id)


def days_of(spark: SparkSession, table: str, run_id: str) -> set[dt.date]:
    """The days a run has partitions for (catalog only)."""
    return {d for d, run in _partitions(spark, table) if run == run_id}


def _partitions(spark: SparkSession, table: str) -> list[tuple[dt.date, str]]:
    found = (dict(p.split("=", 1) for p in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {physical(table)}").collect())
    day = _day_column(spark, table)
    return [(as_date(p[day]), p[RUN]) for p in found if p[day] != "__HIVE_DEFAULT_PARTITION__"]


def staged(spark: SparkSession, table: str, run_id: str) -> DataFrame:
    """A run's rows of a table, published or not."""
    return spark.table(physical(table)).where(F.col(RUN) == run_id).drop(RUN)


def publish(spark: SparkSession, manifest: str, entries: Iterable[tuple[str, str, dt.date, str]]) -> int:
    """Show staged rows: (table, run_id, day, mode) for all tables of a run, as one file appended
    in one job commit. Returns the sequence number."""
    rows = [(run, base_name(t), day, mode) for t, run, day, mode in entries]
    if not rows:
        return 0
    seq = (spark.table(manifest).agg(F.max("seq")).first()[0] or 0) + 1
    df = spark.createDataFrame([(seq, *r) for r in rows], MANIFEST)
    df.coalesce(1).write.insertInto(manifest)
    spark.catalog.refreshTable(manifest)
    log.info("published %d entries of %d tables as %d", len(rows), len({r[1] for r in rows}), seq)
    return seq


def _replacements(spark: SparkSession, manifest: str, table: str) -> list[tuple[dt.date, list[str]]]:
    """Each day's runs by replacement, newest first, without repeats in a row."""
    rows = spark.table(manifest).where((F.col("table_name") == base_name(table)) & (F.col("mode") == "replace"))
    runs = F.transform(F.sort_array(F.collect_list(F.struct("seq", RUN)), asc=False), lambda s: s[RUN])
    return [(r["day"], list(dict.fromkeys(r["runs"]))) for r in rows.groupBy("day").agg(runs.alias("runs")).collect()]


def revert(spark: SparkSession, manifest: str, tables: Sequence[str], days: Iterable[str | dt.date] | None = None) -> int:
    """Point the given days (default: all) of all ``tables`` back to the run before the one shown,
    in one commit. A day without an earlier run becomes empty."""
    wanted = None if days is None else {as_date(d) for d in days}
    entries = []
    for table in tables:
        for day, runs in _replacements(spark, manifest, table):
            if wanted is None or day in wanted:
                entries.append((table, runs[1] if len(runs) > 1 else "", day, "replace"))
    return publish(spark, manifest, entries)


def vacuum(spark: SparkSession, manifest: str, table: str, history: int = 1, running: Sequence[str] = ()) -> int:
    """Drop the partitions that neither the shown version nor the ``history`` before it needs, and
    those of failed runs (all runs not in the manifest but ``running``). Returns their number."""
    shown = {(r[0], r[1]) for r in spark.sql(members_sql(manifest, table)).collect()}
    for day, runs in _replacements(spark, manifest, table):
        shown |= {(day, r) for r in runs[: history + 1]}
    gone = sorted(p for p in _partitions(spark, table) if p not in shown and p[1] not in running)
    if gone:
        day = _day_column(spark, table)
        parts = ", ".join(f"PARTITION (`{day}` = DATE '{d.isoformat()}', {RUN} = '{run}')" for d, run in gone)
        spark.sql(f"ALTER TABLE {physical(table)} DROP IF EXISTS {parts}")
        spark.catalog.refreshTable(physical(table))
    return len(gone)
