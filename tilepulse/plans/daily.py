"""The daily job (L1-L8): read, aggregate, enrich, replace one date in both targets.

Order of work for one date:

1. with enrichment, the metadata is checked, reduced to one row per tile, kept in memory and
   measured once; every later use (broadcast, zero fill, completeness) reads that. A missing,
   unreadable or changed table degrades to an empty dimension: every tile is UNKNOWN, the job
   completes. Without enrichment the metadata is not touched;
2. both event tables are scanned for the day (a partition filter on the stored day);
3. the summary is aggregated and enriched, and its date is replaced in the summary target;
4. the KPIs are computed from the summary partition just written (read back, so the lineage
   is cut, nothing is recomputed, and the KPIs always agree with the committed summary), and
   their date is replaced in the KPI target; the tiles without metadata are counted (and, where
   a table is named, written) by a concurrent job meanwhile. Dates without events have no KPI
   row, whatever zero fill adds to the summary.

The two targets are two commits; a failure between them is repaired by running the date again
(every step is idempotent).

``run_dates`` / ``run_range`` are the same job for a set or span of dates in one pass (grouped
by date and tile), used for backfills and re-runs; each date's rows equal a one-date run.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import pointers
from ..config import JobOptions, TableNames, as_date
from ..functions.columns import date_lit
from ..operators import enrich as E
from ..operators import kpis as K
from ..operators import metrics as M
from ..operators import quality as Q
from ..sinks import overwrite_dates, refresh_dimension
from ..sources import adapt
from ..sources import schemas as S
from ..sources.catalog import scan_events, table_available
from ..sources.schemas import EVENT_DATE

log = logging.getLogger(__name__)


@dataclass
class RunReport:
    dates: list[dt.date]
    metadata_available: bool
    metadata_rows: int
    missing_metadata_tiles: int
    emptied_dates: list[dt.date]


def load_dimension(spark: SparkSession, tables: TableNames, options: JobOptions) -> tuple[E.Dimension, bool]:
    """The measured metadata, kept in memory; or an empty one when the table is missing, cannot
    be read or has lost what the labels need (L3, H6, K2: the job goes on, every tile is
    UNKNOWN). Duplicates stop the job only with ``on_duplicate_metadata='fail'``. A pointer table
    brings a snapshot that is measured already; it is read as it is."""
    labels = options.label_columns
    if not table_available(spark, tables.tile_metadata):
        log.warning("metadata table %s not available: all tiles reported as UNKNOWN", tables.tile_metadata)
        return E.empty_metadata(spark, labels), False
    labels_kept = pointers.kept_labels(spark, tables.tile_metadata, labels)
    if labels_kept is not None:
        return labels_kept, True
    need = ("tile_id", "is_active", *labels)
    kept = None
    try:
        meta = source(spark, tables.tile_metadata, "tile_metadata", options)
        diff = Q.check_source(meta, "tile_metadata", S.TILE_METADATA, tables.tile_metadata, need)
        retyped = [t for t in diff.type_changes if t[0] in need]
        if retyped:
            raise Q.SchemaDriftError(f"{tables.tile_metadata}: types changed {retyped}")
        counted = Observation()
        meta = meta.observe(counted, F.count(F.lit(1)).alias("rows"))
        kept = E.prepare_metadata(meta, columns=labels).df.persist(StorageLevel.MEMORY_AND_DISK)
        dim = E.measure(E.Dimension(kept), options.on_duplicate_metadata)
        if dim.rows:  # K2: all records, counted by the read that measured the active ones
            log.info("metadata table %s contains %d records", tables.tile_metadata, counted.get["rows"])
        return dim, True
    except (Q.SchemaDriftError, PySparkException, Py4JJavaError) as exc:
        log.error("%s; all tiles reported as UNKNOWN", str(exc).splitlines()[0])
        if kept is not None:
            kept.unpersist()
        return E.empty_metadata(spark, labels), False
    except E.DuplicateMetadataError:
        kept.unpersist()
        raise


@contextmanager
def job_dimension(spark: SparkSession, tables: TableNames, options: JobOptions):
    """(dimension, available) for one run; (None, False) without enrichment, where the metadata
    is not touched."""
    if not options.enrich:
        yield None, False
        return
    dim, available = load_dimension(spark, tables, options)
    try:
        yield dim, available
    finally:
        dim.df.unpersist()


def source(spark: SparkSession, table: str, key: str, options: JobOptions) -> DataFrame:
    """A source table; with ``adapt_sources`` mapped to the registry's schema, or refused, before
    anything is written."""
    df = scan_events(spark, table)
    if not options.adapt_sources:
        return df
    names = {f.name for f in adapt.SCHEMAS[key].fields}
    return adapt.conform(df, key, {a: n for a, n in options.column_aliases if n in names})[0]


def event_sources(spark: SparkSession, tables: TableNames, options: JobOptions) -> tuple[DataFrame, DataFrame]:
    """K8: both event tables, which carry the columns the job reads (clear error otherwise)."""
    tile = source(spark, tables.tile_events, "tile_events", options)
    inter = source(spark, tables.interstitial_events, "interstitial_events", options)
    Q.check_source(tile, "tile_events", S.TILE_EVENTS, tables.tile_events)
    Q.check_source(inter, "interstitial_events", S.INTERSTITIAL_EVENTS, tables.interstitial_events)
    return tile, inter


def build_target(
    tile_events: DataFrame,
    inter_events: DataFrame,
    dim: E.Dimension | None,
    process_date: str | dt.date | None,
    options: JobOptions,
    dates: Sequence[str | dt.date] = (),
    with_events: Observation | None = None,
) -> DataFrame:
    """The rows written to the summary target: for one date, or (None) all dates in the input.
    Zero fill covers the date, or ``dates``. ``with_events`` observes the dates that have rows
    before it."""
    if options.drop_null_tiles:
        tile_events, inter_events = tile_events.where("tile_id IS NOT NULL"), inter_events.where("tile_id IS NOT NULL")
    summary = M.daily_summary(tile_events, inter_events, process_date, options.distinct_method)
    if not options.enrich:
        return summary
    if options.zero_fill:
        if with_events is not None:
            summary = summary.observe(with_events, F.collect_set("date").alias("dates"))
        return E.zero_filled(summary, dim, dates if process_date is None else process_date, options.label_columns)
    return E.enrich(summary, dim, options.label_columns)


def _kpis_and_completeness(write_kpis, written: DataFrame, dim: E.Dimension | None, available: bool, options: JobOptions) -> int:
    """Write the KPIs and, as a concurrent job, count (and log, and write out) summary tiles
    without metadata. Both only read the summary just written."""
    if not available:
        write_kpis()
        return 0
    with ThreadPoolExecutor(max_workers=1) as pool:
        check = pool.submit(
            Q.validate_metadata_completeness, written.select("tile_id"), dim.df, options.missing_tiles_table
        )
        write_kpis()
    return check.result()


def run_daily(
    spark: SparkSession,
    process_date: str | dt.date,
    tables: TableNames = TableNames(),
    options: JobOptions = JobOptions(),
) -> RunReport:
    """Run the job for one date and replace that date in both targets."""
    return run_dates(spark, [process_date], tables, options)


def run_dates(
    spark: SparkSession,
    dates: list[str | dt.date],
    tables: TableNames = TableNames(),
    options: JobOptions = JobOptions(),
) -> RunReport:
    """Replace the given dates in both targets in one pass per target (daily run, backfills,
    re-runs).

    The scans keep only those days; for several, rows are grouped by (date, tile_id), so each
    date's rows equal a one-date run. The date list is calendar-sized, never data-sized, and
    dates without events cost no job of their own.
    """
    wanted = sorted({as_date(d) for d in dates})
    if not wanted:
        return RunReport([], False, 0, 0, [])
    sources = event_sources(spark, tables, options)
    one = wanted[0] if len(wanted) == 1 else None
    lits = [date_lit(d) for d in wanted]

    def scan(df: DataFrame) -> DataFrame:
        return df if one is not None else M.on_days(df, wanted)  # the summary filters a single day

    with job_dimension(spark, tables, options) as (dim, available):
        seen = Observation() if options.enrich and options.zero_fill else None
        tile, inter = (scan(df) for df in sources)
        target = build_target(tile, inter, dim, one, options, wanted, seen)
        emptied = overwrite_dates(spark, target, tables.daily_summary, wanted)
        with_rows = [d for d in wanted if d not in set(emptied)]
        if seen is not None:
            with_rows = _with_events(seen, tile, inter, one, options, wanted)
        written = spark.table(tables.daily_summary).filter(F.col("date").isin(lits))
        kpis = K.global_kpis(written.filter(F.col("date").isin([date_lit(d) for d in with_rows])) if with_rows else written.limit(0))
        missing = _kpis_and_completeness(
            lambda: overwrite_dates(spark, kpis, tables.global_kpis, wanted, present=with_rows),
            written, dim, available, options,
        )
        rows = dim.rows if dim is not None else 0
    log.info("job completed for %d dates (%s .. %s)", len(wanted), wanted[0], wanted[-1])
    return RunReport(wanted, available, rows, missing, emptied)


def _with_events(seen: Observation, tile, inter, one, options: JobOptions, wanted: list[dt.date]) -> list[dt.date]:
    """The dates of the list that have events, as observed by the summary write (asked again
    where the planner dropped an empty plan with its observation)."""
    try:
        found = {as_date(d) for d in seen.get["dates"]}
    except Exception:
        plain = build_target(tile, inter, None, one, replace(options, enrich=False))
        found = {r[0] for r in plain.select("date").distinct().collect()}
    return [d for d in wanted if d in found]


def run_range(
    spark: SparkSession,
    start: str | dt.date,
    end: str | dt.date,
    tables: TableNames = TableNames(),
    options: JobOptions = JobOptions(),
) -> RunReport:
    """Backfill: replace every date in [start, end] in both targets."""
    s, e = as_date(start), as_date(end)
    if e < s:
        raise ValueError("end before start")
    return run_dates(spark, [s + dt.timedelta(days=i) for i in range((e - s).days + 1)], tables, options)


def load_sources(
    spark: SparkSession,
    tile_events: DataFrame,
    inter_events: DataFrame,
    metadata: DataFrame | None,
    tables: TableNames,
) -> None:
    """Append event rows (with their event_date) and replace the metadata in catalog tables.

    The writes touch different tables, so they are submitted as concurrent Spark jobs; an
    error in any of them is raised after all have finished.
    """

    def append(df: DataFrame, name: str) -> None:
        cols = spark.table(name).columns
        staged = df.withColumn(EVENT_DATE, F.to_date("event_ts")) if EVENT_DATE not in df.columns else df
        # files per day follow the day's size, not the number of input tasks
        staged.select(*cols).hint("rebalance", EVENT_DATE).write.insertInto(name)

    jobs = [(append, tile_events, tables.tile_events), (append, inter_events, tables.interstitial_events)]
    if metadata is not None:
        jobs.append((lambda df, name: refresh_dimension(spark, df, name), metadata, tables.tile_metadata))
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = [pool.submit(fn, df, name) for fn, df, name in jobs]
    for f in futures:
        f.result()


__all__ = ["run_daily", "run_dates", "run_range", "build_target", "load_dimension", "load_sources", "RunReport"]
