"""Partition-replacing writes (A7, A10, B6, K9) and the dimension refresh.

Parquet tables have no ``replaceWhere``. Dates are replaced with a dynamic-partition overwrite
(staged files, swapped in at commit; a failed write changes nothing), which also observes the
dates it wrote; dates of the list without rows are then dropped, those that exist, in one
statement. Together: only the given dates change, a re-run gives the same table, an empty
result empties its date, and one date or a whole backfill range is one write job. A failure
between the two statements leaves old rows in dates that should be empty; running the dates
again repairs that. Columns are matched by name (added columns sit before the partition column).
"""

from __future__ import annotations

import datetime as dt
import logging
import threading
import uuid
from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .config import as_date

log = logging.getLogger(__name__)

# Serialises "set overwrite mode + INSERT" so threads sharing a session cannot interleave them.
_MODE_LOCK = threading.Lock()


def _data_columns(spark: SparkSession, table: str, partition_col: str) -> list[str]:
    return [c for c in spark.table(table).columns if c != partition_col]


def _temp_view(df: DataFrame) -> str:
    name = f"_tp_src_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(name)
    return name


def _cols(cols: Iterable[str]) -> str:
    return ", ".join(f"`{c}`" for c in cols)


def _with_overwrite_mode(spark: SparkSession, mode: str, statement: str) -> None:
    """Run one INSERT OVERWRITE with the partition-overwrite mode pinned, then restore it.

    The mode is a session setting for SQL inserts (the writer option is not applied by
    ``insertInto``), so it is set for this statement only, whatever the caller's default is.
    """
    key = "spark.sql.sources.partitionOverwriteMode"
    with _MODE_LOCK:
        previous = spark.conf.get(key, "static")
        spark.conf.set(key, mode)
        try:
            spark.sql(statement)
        finally:
            spark.conf.set(key, previous)


def existing_dates(spark: SparkSession, table: str, partition_col: str = "date") -> set[dt.date]:
    """The dates a table has partitions for, from the catalog (no scan)."""
    prefix = f"{partition_col}="
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    days = [part.removeprefix(prefix) for r in rows for part in r[0].split("/") if part.startswith(prefix)]
    return {as_date(d) for d in days if d != "__HIVE_DEFAULT_PARTITION__"}


def _drop_dates(spark: SparkSession, table: str, dates: Iterable[dt.date], partition_col: str) -> None:
    """Drop those of the dates that exist, in one statement."""
    gone = sorted(set(dates) & existing_dates(spark, table, partition_col))
    if gone:
        parts = ", ".join(f"PARTITION (`{partition_col}` = DATE '{d.isoformat()}')" for d in gone)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")


def _dynamic_replace(spark: SparkSession, df: DataFrame, table: str, cols: list[str], partition_col: str) -> None:
    """Dynamic-partition overwrite: only the dates present in ``df`` are replaced."""
    view = _temp_view(df)
    try:
        _with_overwrite_mode(
            spark,
            "dynamic",
            f"INSERT OVERWRITE TABLE {table} PARTITION (`{partition_col}`) "
            f"BY NAME SELECT {_cols(cols)}, `{partition_col}` FROM {view}",
        )
    finally:
        spark.catalog.dropTempView(view)


def overwrite_partition(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    process_date: str | dt.date,
    partition_col: str = "date",
) -> list[dt.date]:
    """Replace exactly one date of a table partitioned by ``partition_col``.

    Rows of other dates in ``df`` are ignored; a ``df`` without the partition column is
    stamped with the date. Table columns missing from ``df`` are refused (they would silently
    become NULL). Returns ``[date]`` when the result was empty and the date was emptied.
    """
    d = as_date(process_date)
    if partition_col in df.columns:
        df = df.filter(F.col(partition_col) == F.lit(d))
    else:
        df = df.withColumn(partition_col, F.lit(d))
    return overwrite_dates(spark, df, table, [d], partition_col)


def _observed_dates(seen: Observation, staged: DataFrame, partition_col: str) -> set[dt.date]:
    """The dates the write observed. Where the planner proved the result empty it drops the
    observation with the plan, and reading it fails; the (trivial) plan is then asked itself."""
    try:
        return {as_date(d) for d in seen.get["dates"]}
    except Exception as exc:
        log.info("no observed dates (%s); counting them", type(exc).__name__)
        return {r[0] for r in staged.select(partition_col).distinct().collect()}


def overwrite_dates(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    dates: Iterable[str | dt.date] | None,
    partition_col: str = "date",
    present: Iterable[str | dt.date] | None = None,
) -> list[dt.date]:
    """Replace every date in ``dates`` with the rows of ``df`` for that date, in one write job;
    None: every date that ``df`` has (rows without a date are refused).

    ``present``, when the caller knows which of the dates have rows and none has, skips the
    write altogether. The write itself observes the dates it wrote (a calendar-sized set), so
    the result is computed once. Returns the dates of the list that have no rows now.
    """
    wanted = None if dates is None else sorted({as_date(d) for d in dates})
    if wanted == []:
        return []
    cols = _data_columns(spark, table, partition_col)
    absent = [c for c in cols if c not in df.columns]
    if absent:
        raise ValueError(f"{table}: result lacks columns {absent}")
    unknown = [c for c in df.columns if c not in cols and c != partition_col]
    if unknown:
        raise ValueError(
            f"{table}: table lacks result columns {unknown} (schema drift?); add them with "
            "evolve.add_columns before writing"
        )
    if wanted is None:
        day = F.col(partition_col)
        staged = df.withColumn(partition_col, F.when(day.isNull(), F.raise_error(F.lit("a row has no date"))).otherwise(day))
    else:
        staged = df.filter(F.col(partition_col).isin(wanted))
    seen = Observation()
    staged = staged.select(*cols, partition_col).observe(seen, F.collect_set(partition_col).alias("dates"))
    # REBALANCE by date: each date's rows go to as few write tasks as their size needs (AQE
    # splits a large date into advisory-sized pieces), so a range of dates does not become
    # tasks x dates small files.
    staged = staged.hint("rebalance", partition_col)
    if present is None or set(present):
        _dynamic_replace(spark, staged, table, cols, partition_col)
        found = _observed_dates(seen, staged, partition_col)
    else:
        found = set()
    emptied = [d for d in wanted or [] if d not in found]
    _drop_dates(spark, table, emptied, partition_col)
    spark.catalog.refreshTable(table)
    log.info("replaced %d dates of %s (%d emptied)", len(found) + len(emptied), table, len(emptied))
    return emptied


class DuplicateKeyError(ValueError):
    """A new dimension version holds a key more than once."""


def refresh_dimension(
    spark: SparkSession, df: DataFrame, table: str, key: str = "tile_id", allow_empty: bool = False
) -> int:
    """SCD type 1: replace the whole dimension table with a new version. Returns its row count.
    A pointer table (``tilepulse.pointers``) is replaced in one step that readers cannot see half
    done, and can be undone.

    An unpartitioned overwrite clears the table before writing, so the new version is fully
    computed and checked first (persisted, counted, keys unique, not empty unless allowed): a
    version that fails to compute or check leaves the current table untouched.
    """
    from . import pointers

    if pointers.current(spark, table) is not None:
        return pointers.refresh(spark, df, table, key, allow_empty)
    staged = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = staged.count()
        if rows == 0 and not allow_empty:
            raise ValueError(f"new version of {table} is empty; refresh refused (allow_empty=True to force)")
        if not staged.groupBy(key).count().filter(F.col("count") > 1).isEmpty():
            raise DuplicateKeyError(f"new version of {table} repeats {key} values; refresh refused")
        cols = spark.table(table).columns
        view = _temp_view(staged)
        try:
            spark.sql(f"INSERT OVERWRITE TABLE {table} BY NAME SELECT {_cols(cols)} FROM {view}")
        finally:
            spark.catalog.dropTempView(view)
    finally:
        staged.unpersist()
    spark.catalog.refreshTable(table)
    log.info("refreshed dimension %s (%d rows)", table, rows)
    return rows
