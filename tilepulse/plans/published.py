"""The job with one commit for all it writes (A7, L8), checks inside the write (K3-K6, K10), and
late events folded into a kept state (D1-D6).

The targets are versioned tables (``tilepulse.versions``). A run

1. stages the summary of its dates under its own run id (and the users' flags, where that table
   exists: the summary is then counted from them);
2. reads the staged summary back and stages the KPIs; the same pass counts the checks per date,
   which the write observes. They go to the quality log, and a check over its limit stops the
   run here, with both targets as they were;
3. publishes the dates of all its tables by one append to the manifest.

Whatever fails, readers of both targets see the last published run of each date. Running again is a
new run; nothing is repaired, and what a failed run left is dropped by ``versions.vacuum``.

``run_published`` recomputes its dates from the event tables. ``apply_events`` reads only the new
events and the flags of the days they touch: it appends the load's flags, counts those days anew
from all their flags, and publishes flags, summary and KPIs together. Merging is idempotent, so a
load may be applied again after a failure. ``compact_flags`` merges the loads of a day into one.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import versions as V
from ..config import JobOptions, TableNames, as_date
from ..functions.columns import date_lit
from ..operators import checks as C
from ..operators import enrich as E
from ..operators import metrics as M
from ..operators import quality as Q
from ..operators import user_flags as U
from ..sources.schemas import SPECS, TableSpec, create_table_ddl
from .daily import event_sources, job_dimension

log = logging.getLogger(__name__)

Step = Callable[[str], None]


@dataclass
class PublishReport:
    run_id: str
    seq: int
    dates: list[dt.date]
    metadata_available: bool
    missing_metadata_tiles: int
    checks: list[C.CheckResult]


def create_published(
    spark: SparkSession, tables: TableNames = TableNames(), *, summary: str = "daily_summary", state: bool = False
) -> None:
    """The two targets as versioned tables, the manifest and the quality log; with ``state`` the
    users' flags too."""
    for name in {t.split(".")[0] for t in vars(tables).values() if "." in t}:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    V.create_versioned(spark, tables.daily_summary, SPECS[summary], tables.manifest)
    V.create_versioned(spark, tables.global_kpis, SPECS["global_kpis"], tables.manifest)
    log_spec = TableSpec(C.QUALITY_LOG, (), "Checks of each published or refused run, per date")
    spark.sql(create_table_ddl(tables.quality_log, log_spec))
    if state:
        V.create_versioned(spark, tables.user_flags, U.USER_FLAGS, tables.manifest)


def _nothing(step: str) -> None:
    pass


def _labelled(summary: DataFrame, dim: E.Dimension | None, options: JobOptions, days: Sequence[dt.date]) -> DataFrame:
    if options.drop_null_tiles:
        summary = summary.where("tile_id IS NOT NULL")
    if not options.enrich:
        return summary
    if options.zero_fill:
        return E.zero_filled(summary, dim, days, options.label_columns)
    return E.enrich(summary, dim, options.label_columns)


def _stage_kpis(
    spark: SparkSession, tables: TableNames, run_id: str, days: Iterable[dt.date], with_events: Iterable[dt.date], dim: E.Dimension | None
) -> dict:
    """Stage the KPIs of the run's summary; returns {date: its checks}, observed by that write."""
    if not days:
        return {}
    rows = C.kpis_and_checks(V.staged(spark, tables.daily_summary, run_id), dim)
    seen = Observation()
    rows = rows.observe(seen, F.collect_list(F.struct("date", *C.CHECKS)).alias("checks"))  # one a date
    kpis = rows.drop(*C.CHECKS).where(F.col("date").isin([date_lit(d) for d in with_events]))
    V.stage(spark, kpis, tables.global_kpis, run_id)
    return {r["date"]: r.asDict() for r in seen.get["checks"]}


def _keep_log(spark: SparkSession, tables: TableNames, run_id: str, results: list[C.CheckResult]) -> None:
    rows = [(run_id, r.date, r.check_name, r.violations, r.allowed, r.breached) for r in results]
    spark.createDataFrame(rows, C.QUALITY_LOG).coalesce(1).write.insertInto(tables.quality_log)


def _run(
    spark: SparkSession,
    tables: TableNames,
    options: JobOptions,
    run_id: str,
    days: list[dt.date],
    summary: DataFrame,
    more: list[tuple[str, str, dt.date, str]],
    on_step: Step,
) -> PublishReport:
    """Stage, check and publish ``summary`` (un-enriched) for ``days``, with ``more`` entries of the
    same run."""
    targets = [tables.daily_summary, tables.global_kpis]
    with job_dimension(spark, tables, options) as (dim, available):
        written = V.stage(spark, _labelled(summary, dim, options, days), tables.daily_summary, run_id)
        on_step("summary staged")
        with_events = written
        if options.enrich and options.zero_fill:
            with_events = {r[0] for r in summary.select("date").distinct().collect()}
        known = dim if available else None
        rows = V.staged(spark, tables.daily_summary, run_id)
        with ThreadPoolExecutor(max_workers=1) as pool:
            lacking = pool.submit(
                Q.validate_metadata_completeness, rows.select("tile_id"), dim.df, options.missing_tiles_table
            ) if available else None
            values = _stage_kpis(spark, tables, run_id, written, with_events, known)
        missing = lacking.result() if lacking else 0
        repeated = dim.repeated_tiles if dim is not None else 0
    on_step("kpis staged")
    results = C.judged(values, repeated, dict(options.quality_limits))
    _keep_log(spark, tables, run_id, results)
    breached = [f"{r.date or 'run'} {r.check_name}: {r.violations} > {r.allowed}" for r in results if r.breached]
    if breached:
        raise C.QualityBreachError(f"run {run_id} not published: {'; '.join(breached)}")
    on_step("checked")
    seq = V.publish(spark, tables.manifest, [*((t, run_id, d, "replace") for t in targets for d in days), *more])
    return PublishReport(run_id, seq, days, available, missing, results)


def run_published(
    spark: SparkSession,
    dates: Iterable[str | dt.date],
    tables: TableNames = TableNames(),
    options: JobOptions = JobOptions(),
    on_step: Step = _nothing,
) -> PublishReport:
    """Recompute the dates from the event tables and publish them in both targets at once.
    ``on_step`` is called with the name of each step that is done."""
    days = sorted({as_date(d) for d in dates})
    run_id = V.new_run()
    if not days:
        return PublishReport(run_id, 0, [], False, 0, [])
    tile, inter = (M.on_days(df, days) for df in event_sources(spark, tables, options))
    more = []
    if V.is_versioned(spark, tables.user_flags):
        V.stage(spark, U.merged(U.event_flags(tile, inter)), tables.user_flags, run_id)
        more = [(tables.user_flags, run_id, d, "replace") for d in days]
        summary = U.summary_of(V.staged(spark, tables.user_flags, run_id))
    else:
        summary = M.daily_summary(tile, inter, None, options.distinct_method)
    return _run(spark, tables, options, run_id, days, summary, more, on_step)


def apply_flags(
    spark: SparkSession, flags: DataFrame, tables: TableNames = TableNames(), options: JobOptions = JobOptions(), on_step: Step = _nothing
) -> PublishReport:
    """Fold a load, given as flags of its events, into the state and publish the days it touches."""
    run_id = V.new_run()
    days = sorted(V.stage(spark, U.merged(flags), tables.user_flags, run_id))
    on_step("flags staged")
    if not days:
        return PublishReport(run_id, 0, [], False, 0, [])
    own = V.staged(spark, tables.user_flags, run_id)
    held = spark.table(tables.user_flags).where(F.col("date").isin([date_lit(d) for d in days]))
    more = [(tables.user_flags, run_id, d, "append") for d in days]
    return _run(spark, tables, options, run_id, days, U.summary_of(held.unionByName(own)), more, on_step)


def apply_events(
    spark: SparkSession,
    tile_events: DataFrame,
    inter_events: DataFrame,
    tables: TableNames = TableNames(),
    options: JobOptions = JobOptions(),
    on_step: Step = _nothing,
) -> PublishReport:
    """Fold new events into the state; the event tables are not read."""
    return apply_flags(spark, U.event_flags(tile_events, inter_events), tables, options, on_step)


def compact_flags(spark: SparkSession, tables: TableNames, min_loads: int = 2) -> list[dt.date]:
    """Merge the loads of every day that has at least ``min_loads`` into one. Nothing that readers
    see changes; ``versions.vacuum`` drops the merged loads."""
    members = spark.sql(V.members_sql(tables.manifest, tables.user_flags))
    crowded = members.groupBy("day").count().where(F.col("count") >= min_loads)
    days = sorted(r["day"] for r in crowded.collect())
    if days:
        run_id = V.new_run()
        rows = spark.table(tables.user_flags).where(F.col("date").isin([date_lit(d) for d in days]))
        V.stage(spark, U.merged(rows), tables.user_flags, run_id)
        V.publish(spark, tables.manifest, [(tables.user_flags, run_id, d, "replace") for d in days])
    return days
