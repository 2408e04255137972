"""The registered queries: one per operator group of the inventory, each over the driver's tables.

Every query reads all of ``events`` and ``part`` (shaped by ``sources.driver_tables``). Queries
named ``*_day`` are the reference job for one process date (the day filter and partition
pruning are the operator under test); every other query covers all dates in one pass, whose
rows per date equal a one-date run. Queries that write (sinks, evolution, backfill) create
their tables in a fresh database under the session's checkpoint folder and return the table
read back.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import JobOptions, TableNames
from ..constants import SUMMARY_METRICS
from ..evolve import add_columns, create_tables, rollback_columns, set_table_comment
from ..operators import enrich as E
from ..operators import kpis as K
from ..operators import metrics as M
from ..operators import quality as Q
from ..operators.checks import QualityBreachError
from ..session import fresh_dir
from ..sinks import existing_dates, overwrite_dates, overwrite_partition, refresh_dimension
from ..sources import driver_tables as DT
from ..sources.schemas import DAILY_SUMMARY_COMMENT_V1, EVENT_DATE, SPECS, SUMMARY_ADDED_COLUMNS, create_table_ddl
from .. import pointers
from .. import versions as V
from . import daily, loading, published

PROCESS_DATE = DT.DEFAULT_DATE
Query = Callable[[SparkSession, str], DataFrame]


class Inputs:
    """The three sources for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        events = DT.read(spark, sf_dir, "events")
        self.tile = DT.tile_events(events)
        self.inter = DT.interstitial_events(events)
        self._meta: DataFrame | None = None
        self._dims: dict[tuple, E.Dimension] = {}

    @property
    def meta(self) -> DataFrame:
        """The metadata source, read only by queries that use it."""
        if self._meta is None:
            self._meta = DT.tile_metadata(self.spark, self.sf_dir)
        return self._meta

    def dim(self, **kw) -> E.Dimension:
        """The prepared dimension, one per set of options. ``part`` has unique keys, which each
        query checks as it runs."""
        kw.setdefault("on_duplicates", "fail")
        key = tuple(sorted((k, tuple(v) if isinstance(v, list) else v) for k, v in kw.items()))
        if key not in self._dims:
            self._dims[key] = E.prepare_metadata(self.meta, **kw)
        return self._dims[key]

    def summary(self, process_date=None) -> DataFrame:
        return M.daily_summary(self.tile, self.inter, process_date)

    def enriched(self, process_date=None) -> DataFrame:
        return E.enrich(self.summary(process_date), self.dim())

    def dates(self) -> list[dt.date]:
        """Distinct event days of both sources (bounded by the calendar, not by rows)."""
        day = F.to_date("event_ts").alias("d")
        days = self.tile.select(day).union(self.inter.select(day)).where("d IS NOT NULL").distinct()
        return sorted(r[0] for r in days.collect())

    def without_some_tiles(self) -> tuple[DataFrame, DataFrame]:
        """Both event sources, every seventh event without its tile id."""
        gone = "CASE WHEN CAST(event_id AS BIGINT) % 7 = 0 THEN NULL ELSE tile_id END"
        return self.tile.withColumn("tile_id", F.expr(gone)), self.inter.withColumn("tile_id", F.expr(gone))


def _sandbox(spark: SparkSession, label: str) -> TableNames:
    """Fresh databases under the shared work folder, one per call."""
    root = fresh_dir(spark, label)
    tag = uuid.uuid4().hex[:8]
    src, tgt = f"tp_src_{tag}", f"tp_tgt_{tag}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {src} LOCATION '{root}/{src}'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {tgt} LOCATION '{root}/{tgt}'")
    return TableNames().in_databases(src, tgt)


# ---------------------------------------------------------------- scans


def tile_events(spark, sf):
    """A1 over the whole table: every tile event, shaped to the source schema."""
    return Inputs(spark, sf).tile


def interstitial_events(spark, sf):
    """A2 over the whole table."""
    return Inputs(spark, sf).inter


def tile_events_day(spark, sf):
    return M.for_day(Inputs(spark, sf).tile, PROCESS_DATE)


def interstitial_events_day(spark, sf):
    return M.for_day(Inputs(spark, sf).inter, PROCESS_DATE)


def event_date_partitioned_scan(spark, sf):
    """Tile events written to a table partitioned by event_date, read back whole."""
    inp = Inputs(spark, sf)
    tables = _sandbox(spark, "partitioned-scan")
    create_tables(spark, tables)
    daily.load_sources(spark, inp.tile, inp.inter, None, tables)
    # event_ts is stored as TIMESTAMP; back to TIMESTAMP_NTZ as in the driver's table
    return spark.table(tables.tile_events).withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


def active_metadata(spark, sf):
    return Inputs(spark, sf).dim().joinable()


def metadata_counts(spark, sf):
    return Q.metadata_counts(Inputs(spark, sf).meta)


# ---------------------------------------------------------------- aggregates


def tile_agg(spark, sf):
    return M.tile_agg(M.with_day(Inputs(spark, sf).tile), ["date", "tile_id"])


def interstitial_agg(spark, sf):
    return M.interstitial_agg(M.with_day(Inputs(spark, sf).inter), ["date", "tile_id"])


def daily_summary(spark, sf):
    return Inputs(spark, sf).summary()


def daily_summary_count_distinct(spark, sf):
    inp = Inputs(spark, sf)
    return M.daily_summary(inp.tile, inp.inter, None, method="count_distinct")


def daily_summary_day(spark, sf):
    return Inputs(spark, sf).summary(PROCESS_DATE)


def daily_summary_sorted(spark, sf):
    return Inputs(spark, sf).summary().orderBy("date", "tile_id")


def daily_summary_enriched(spark, sf):
    return Inputs(spark, sf).enriched()


def daily_summary_enriched_day(spark, sf):
    return Inputs(spark, sf).enriched(PROCESS_DATE)


def daily_summary_category(spark, sf):
    inp = Inputs(spark, sf)
    return E.enrich(inp.summary(), inp.dim(columns=["tile_category"]), ["tile_category"])


def daily_summary_all_metadata(spark, sf):
    inp = Inputs(spark, sf)
    dim = inp.dim(columns=["tile_category"], active_only=False)
    return E.enrich(inp.summary(), dim, ["tile_category"])


def daily_summary_event_enriched(spark, sf):
    inp = Inputs(spark, sf)
    return E.event_enriched_summary(inp.tile, inp.inter, inp.dim())


def daily_summary_event_enriched_null_tiles(spark, sf):
    """Events without a tile id in both sources: one null row a date, as null-safe keys give."""
    inp = Inputs(spark, sf)
    return E.event_enriched_summary(*inp.without_some_tiles(), inp.dim())


def daily_summary_zero_filled(spark, sf):
    """Every date of the data, with every active tile."""
    inp = Inputs(spark, sf)
    return E.zero_filled(inp.summary(), inp.dim(), inp.dates())


# ---------------------------------------------------------------- KPIs


def global_kpis(spark, sf):
    return K.global_kpis(Inputs(spark, sf).summary())


def global_kpis_day(spark, sf):
    return K.global_kpis(Inputs(spark, sf).summary(PROCESS_DATE))


def category_kpis(spark, sf):
    return K.category_kpis(Inputs(spark, sf).enriched())


# ---------------------------------------------------------------- quality


def missing_metadata_tiles(spark, sf):
    inp = Inputs(spark, sf)
    return Q.missing_metadata_tiles(inp.summary(), inp.dim().df)


def dq_report(spark, sf):
    inp = Inputs(spark, sf)
    return Q.dq_report(inp.enriched(), inp.meta)


def reconcile_versions(spark, sf):
    """v1.0 summary against v1.1 enriched summary on their shared columns (L6: no change)."""
    inp = Inputs(spark, sf)
    return Q.reconcile(inp.summary(), inp.enriched(), names=("plain", "enriched"))


def dq_report_faulty(spark, sf):
    """The report over data with faults: the two sources' rows not merged (every tile of both is
    there twice), events without a tile id, a count below zero and a null category for some,
    and a metadata table that repeats a third of its tiles."""
    inp = Inputs(spark, sf)
    tile, inter = (M.with_day(e) for e in inp.without_some_tiles())
    zero = {m: F.lit(0).cast("bigint") for m in SUMMARY_METRICS}
    sides = [M.tile_agg(tile, ["date", "tile_id"]), M.interstitial_agg(inter, ["date", "tile_id"])]
    sides = [x.withColumns({m: z for m, z in zero.items() if m not in x.columns}) for x in sides]
    rows = E.enrich(sides[0].unionByName(sides[1]), inp.dim())
    rows = rows.withColumns({
        "unique_tile_views": F.expr("CASE WHEN unique_tile_clicks = 1 THEN -1 ELSE unique_tile_views END"),
        "tile_category": F.expr("CASE WHEN unique_interstitial_views = 1 THEN NULL ELSE tile_category END"),
    })
    meta = inp.meta.union(inp.meta.where("pmod(CAST(substring(tile_id, 6) AS INT), 3) = 0"))
    return Q.dq_report(rows, meta)


def reconcile_active_all(spark, sf):
    """The summary labelled from active metadata against the one from all metadata."""
    inp = Inputs(spark, sf)
    summary = inp.summary()
    active = E.enrich(summary, inp.dim(columns=["tile_category"]), ["tile_category"])
    whole = E.enrich(summary, inp.dim(columns=["tile_category"], active_only=False), ["tile_category"])
    return Q.reconcile(active, whole, names=("active", "all"))


def kpis_disagreeing(spark, sf):
    """Stored KPIs against a summary that has lost its unmapped tiles since."""
    inp = Inputs(spark, sf)
    rows = inp.enriched()
    return Q.kpis_disagreeing(rows.where("tile_category <> 'UNKNOWN'"), K.global_kpis(rows))


# ---------------------------------------------------------------- sinks and evolution


def partition_overwrite(spark, sf):
    """Backfill every date, then re-run one date twice: the table equals one run per date."""
    inp = Inputs(spark, sf)
    tables = _sandbox(spark, "partition-overwrite")
    create_tables(spark, tables)
    overwrite_dates(spark, inp.enriched(), tables.daily_summary, None)
    for _ in range(2):
        overwrite_partition(spark, inp.enriched(PROCESS_DATE), tables.daily_summary, PROCESS_DATE)
    return spark.table(tables.daily_summary).select("date", "tile_id", "tile_name", "tile_category", *SUMMARY_METRICS)


def schema_evolution(spark, sf):
    """Dates before the process date written by v1.0, then ADD COLUMNS, then v1.1 from it on."""
    inp = Inputs(spark, sf)
    tables = _sandbox(spark, "schema-evolution")
    create_tables(spark, tables, enriched=False)
    day = F.col("date")
    overwrite_dates(spark, inp.summary().where(day < F.lit(PROCESS_DATE)), tables.daily_summary, None)
    add_columns(spark, tables.daily_summary, SUMMARY_ADDED_COLUMNS)
    overwrite_dates(spark, inp.enriched().where(day >= F.lit(PROCESS_DATE)), tables.daily_summary, None)
    return spark.table(tables.daily_summary).select("date", "tile_id", "tile_name", "tile_category", *SUMMARY_METRICS)


def schema_rollback(spark, sf):
    """v1.1 table with every date, rolled back to the v1.0 columns by rebuild."""
    inp = Inputs(spark, sf)
    tables = _sandbox(spark, "schema-rollback")
    create_tables(spark, tables, enriched=True)
    overwrite_dates(spark, inp.enriched(), tables.daily_summary, None)
    rollback_columns(spark, tables.daily_summary, ["tile_name", "tile_category"])
    set_table_comment(spark, tables.daily_summary, DAILY_SUMMARY_COMMENT_V1)
    return spark.table(tables.daily_summary).select("date", "tile_id", *SUMMARY_METRICS)


def scd1_refresh(spark, sf):
    """Metadata written once with every tile inactive, then replaced by the current version."""
    inp = Inputs(spark, sf)
    tables = _sandbox(spark, "scd1")
    create_tables(spark, tables)
    refresh_dimension(spark, inp.meta.withColumn("is_active", F.lit(False)), tables.tile_metadata)
    refresh_dimension(spark, inp.meta, tables.tile_metadata)
    return spark.table(tables.tile_metadata).withColumn("updated_ts", F.col("updated_ts").cast("timestamp_ntz"))


# ---------------------------------------------------------------- whole job


def _loaded(spark, sf, label) -> tuple[TableNames, Inputs]:
    inp = Inputs(spark, sf)
    tables = _sandbox(spark, label)
    create_tables(spark, tables)
    daily.load_sources(spark, inp.tile, inp.inter, inp.meta, tables)
    return tables, inp


def _loaded_dates(spark, tables: TableNames) -> list[dt.date]:
    """The days the loaded event tables have partitions for (catalog only, no scan)."""
    return sorted(
        existing_dates(spark, tables.tile_events, EVENT_DATE) | existing_dates(spark, tables.interstitial_events, EVENT_DATE)
    )


def unknown_labels_job(spark, sf):
    """The job over every date where the metadata table is gone: all tiles are UNKNOWN."""
    tables, _ = _loaded(spark, sf, "unknown-labels")
    spark.sql(f"DROP TABLE {tables.tile_metadata}")
    daily.run_dates(spark, _loaded_dates(spark, tables), tables)
    return spark.table(tables.daily_summary).select("date", "tile_id", "tile_name", "tile_category", *SUMMARY_METRICS)


def daily_job(spark, sf):
    """The job for the process date against catalog tables; the KPI target read back."""
    tables, _ = _loaded(spark, sf, "daily-job")
    daily.run_daily(spark, PROCESS_DATE, tables)
    return spark.table(tables.global_kpis)


def backfill_job(spark, sf):
    """The job for every date of the data in one pass; the KPI target read back."""
    tables, _ = _loaded(spark, sf, "backfill-job")
    daily.run_dates(spark, _loaded_dates(spark, tables), tables, JobOptions())
    return spark.table(tables.global_kpis)


def daily_summary_range(spark, sf):
    """The summary target written by the range job (all dates of the data, one pass), read back."""
    tables, _ = _loaded(spark, sf, "range-summary")
    dates = _loaded_dates(spark, tables)
    daily.run_range(spark, dates[0], dates[-1], tables)
    return spark.table(tables.daily_summary).select("date", "tile_id", "tile_name", "tile_category", *SUMMARY_METRICS)


def stream_reruns(spark, sf):
    """Structured Streaming over the loaded event tables re-runs every date it sees."""
    from ..streaming.reruns import start_reruns

    tables, _ = _loaded(spark, sf, "stream-reruns")
    start_reruns(spark, tables, checkpoint=fresh_dir(spark, "stream-ckpt")).awaitTermination()
    return spark.table(tables.daily_summary).select("date", "tile_id", "tile_name", "tile_category", *SUMMARY_METRICS)


# ---------------------------------------------------------------- published versions

LABELLED = ("date", "tile_id", "tile_name", "tile_category", *SUMMARY_METRICS)


class Interrupted(RuntimeError):
    """The failure that the publishing queries plant in a run."""


def _stop_after(step: str):
    def on_step(done: str) -> None:
        if done == step:
            raise Interrupted(step)

    return on_step


def _published(spark, sf, label, **kw) -> tuple[TableNames, Inputs]:
    """Empty source tables, and the targets as versioned tables."""
    inp, tables = Inputs(spark, sf), _sandbox(spark, label)
    published.create_published(spark, tables, **kw)
    for name in ("tile_events", "interstitial_events", "tile_metadata"):
        spark.sql(create_table_ddl(getattr(tables, name), SPECS[name]))
    return tables, inp


def _interrupted(spark, sf, label) -> TableNames:
    """A first run published from tile events only; then interstitial events arrive, and the run
    that takes them in fails when the summary is staged and the KPIs are not."""
    tables, inp = _published(spark, sf, label)
    daily.load_sources(spark, inp.tile, inp.inter.limit(0), inp.meta, tables)
    published.run_published(spark, _loaded_dates(spark, tables), tables)
    daily.load_sources(spark, inp.tile.limit(0), inp.inter, None, tables)
    try:
        published.run_published(spark, _loaded_dates(spark, tables), tables, on_step=_stop_after("summary staged"))
    except Interrupted:
        return tables
    raise AssertionError("the planted failure did not happen")


def publish_interrupted(spark, sf):
    """What both targets show after a run failed between them: the run before, in both."""
    tables = _interrupted(spark, sf, "publish-interrupted")
    sums = [F.sum(m).alias(f"summary_{m}") for m in SUMMARY_METRICS]
    return spark.table(tables.daily_summary).groupBy("date").agg(*sums).join(spark.table(tables.global_kpis), "date", "full_outer")


def publish_retried(spark, sf):
    """The same after the run was repeated: the new summary, and how often each date was published."""
    tables = _interrupted(spark, sf, "publish-retried")
    published.run_published(spark, _loaded_dates(spark, tables), tables)
    shown = spark.table(tables.manifest).where(F.col("table_name") == V.base_name(tables.daily_summary))
    times = shown.groupBy(F.col("day").alias("date")).agg(F.count("*").alias("times_published"))
    return spark.table(tables.daily_summary).select(*LABELLED).join(times, "date", "left")


def publish_reverted(spark, sf):
    """Two published runs, then every date put back to the first: the un-enriched labels of it."""
    tables, inp = _published(spark, sf, "publish-reverted")
    daily.load_sources(spark, inp.tile, inp.inter, inp.meta, tables)
    dates = _loaded_dates(spark, tables)
    published.run_published(spark, dates, tables)
    refresh_dimension(spark, inp.meta.withColumn("is_active", F.lit(False)), tables.tile_metadata)
    published.run_published(spark, dates, tables)
    V.revert(spark, tables.manifest, [tables.daily_summary, tables.global_kpis], [d for d in dates if d >= PROCESS_DATE])
    return spark.table(tables.daily_summary).select(*LABELLED)


def late_events_merged(spark, sf):
    """Every event in two loads, the second of late ones over all dates; the event tables are never
    written, so nothing can read old events. The summary is that of one pass."""
    tables, inp = _published(spark, sf, "late-events", state=True)
    refresh_dimension(spark, inp.meta, tables.tile_metadata)
    late = "pmod(CAST(event_id AS BIGINT), 5) = 3"
    for which in (f"NOT ({late})", late, late):  # the late load twice, as after a failure
        published.apply_events(spark, inp.tile.where(which), inp.inter.where(which), tables)
    published.compact_flags(spark, tables)
    V.vacuum(spark, tables.manifest, tables.user_flags, history=0)
    return spark.table(tables.daily_summary).select(*LABELLED)


def late_events_kpis(spark, sf):
    """The KPIs published with the merged state, of a summary without labels."""
    tables, inp = _published(spark, sf, "late-kpis", summary="daily_summary_v1", state=True)
    late = "pmod(CAST(event_id AS BIGINT), 5) = 3"
    for which in (f"NOT ({late})", late):
        published.apply_events(spark, inp.tile.where(which), inp.inter.where(which), tables, JobOptions(enrich=False))
    return spark.table(tables.global_kpis)


def quality_log(spark, sf):
    """What the published job's write observed, per date and check."""
    tables, inp = _published(spark, sf, "quality-log")
    daily.load_sources(spark, inp.tile, inp.inter, inp.meta, tables)
    published.run_published(spark, _loaded_dates(spark, tables), tables)
    return spark.table(tables.quality_log).select("date", "check_name", "violations")


def quality_breach(spark, sf):
    """A run whose dates have more unlabelled rows than allowed (all of them, its metadata being
    inactive) is refused: the log says so, and the summary shown is that of the run before."""
    tables, inp = _published(spark, sf, "quality-breach")
    daily.load_sources(spark, inp.tile, inp.inter, inp.meta, tables)
    dates, limits = _loaded_dates(spark, tables), JobOptions(quality_limits=(("missing_metadata", 5),))
    published.run_published(spark, dates, tables)
    refresh_dimension(spark, inp.meta.withColumn("is_active", F.lit(False)), tables.tile_metadata)
    try:
        published.run_published(spark, dates, tables, limits)
    except QualityBreachError:
        pass
    refused = spark.table(tables.quality_log).where("breached").select("date", "violations", "allowed")
    rows = spark.table(tables.daily_summary).groupBy("date").agg(F.count_if(F.col("tile_category") != "UNKNOWN").alias("labelled_rows"))
    return rows.join(refused, "date", "left")


def _with_wrong_days(events: DataFrame) -> DataFrame:
    """The events, and copies of some that have the next day, or no timestamp."""
    day = F.to_date("event_ts")
    good = events.withColumn(EVENT_DATE, day)
    copy = events.withColumn("event_id", F.concat(F.lit("bad-"), "event_id"))
    wrong = copy.where("pmod(CAST(substring(event_id, 5) AS BIGINT), 19) = 4").withColumn(EVENT_DATE, F.date_add(day, 1))
    lost = copy.where("pmod(CAST(substring(event_id, 5) AS BIGINT), 23) = 5").withColumn(EVENT_DATE, day)
    lost = lost.withColumn("event_ts", F.lit(None).cast("timestamp_ntz"))
    return good.unionByName(wrong).unionByName(lost)


def _checked_load(spark, sf, label) -> tuple[TableNames, Inputs]:
    inp, tables = Inputs(spark, sf), _sandbox(spark, label)
    loading.create_checked_sources(spark, tables)
    refresh_dimension(spark, inp.meta, tables.tile_metadata)
    loading.load_checked(spark, _with_wrong_days(inp.tile), _with_wrong_days(inp.inter), tables)
    return tables, inp


def enforced_day_summary(spark, sf):
    """The job over a load with wrong days and lost timestamps: the summary of the clean events."""
    tables, inp = _checked_load(spark, sf, "enforced-day")
    published.create_published(spark, tables)
    published.run_published(spark, inp.dates(), tables)
    return spark.table(tables.daily_summary).select(*LABELLED)


def quarantined_events(spark, sf):
    """The rows of that load that were kept apart, with the reason."""
    tables, _ = _checked_load(spark, sf, "quarantine")
    sides = [
        spark.table(loading.quarantine(t)).select(F.lit(name).alias("source"), "event_id", "tile_id", EVENT_DATE, "reason")
        for name, t in (("tile", tables.tile_events), ("interstitial", tables.interstitial_events))
    ]
    return sides[0].unionByName(sides[1])


def reconcile_keys(spark, sf):
    """Which keys and values differ between the summary and one that lost some tiles, gained and
    repeated others, and counts some otherwise (tile numbers by 11, 13, 17 and 5)."""
    inp = Inputs(spark, sf)
    before = inp.enriched()
    n = "CAST(substring(tile_id, 6) AS INT)"
    after = before.where(f"{n} % 11 <> 0")
    after = after.unionByName(before.where(f"{n} % 13 = 0").withColumn("tile_id", F.concat("tile_id", F.lit("-B"))))
    after = after.unionByName(before.where(f"{n} % 17 = 0 AND {n} % 11 <> 0"))
    views = f"CASE WHEN NOT endswith(tile_id, '-B') AND {n} % 5 = 0 THEN unique_tile_views + 1 ELSE unique_tile_views END"
    after = after.withColumn("unique_tile_views", F.expr(views.replace(n, "CAST(substring(tile_id, 6, 3) AS INT)")))
    return Q.reconcile_keys(before, after)


# ---------------------------------------------------------------- one-step replacement


def _pointer_tables(spark, sf, label) -> tuple[TableNames, Inputs]:
    """The metadata as a pointer table, refreshed with every tile inactive and then as it is."""
    inp, tables = Inputs(spark, sf), _sandbox(spark, label)
    pointers.create_pointer(spark, tables.tile_metadata, SPECS["tile_metadata"])
    create_tables(spark, tables)
    refresh_dimension(spark, inp.meta.withColumn("is_active", F.lit(False)), tables.tile_metadata)
    refresh_dimension(spark, inp.meta, tables.tile_metadata)
    return tables, inp


def dimension_undo(spark, sf):
    """Two refreshes, the second undone: the rows of the first."""
    tables, _ = _pointer_tables(spark, sf, "dimension-undo")
    pointers.undo(spark, tables.tile_metadata)
    return spark.table(tables.tile_metadata).withColumn("updated_ts", F.col("updated_ts").cast("timestamp_ntz"))


def snapshot_labels_job(spark, sf):
    """The job over every date, labelled from the snapshot that the refresh keeps."""
    tables, inp = _pointer_tables(spark, sf, "snapshot-labels")
    daily.load_sources(spark, inp.tile, inp.inter, None, tables)
    daily.run_dates(spark, _loaded_dates(spark, tables), tables)
    return spark.table(tables.daily_summary).select(*LABELLED)


def rollback_swapped(spark, sf):
    """The enriched summary as a pointer table, rolled back to the v1.0 columns in one step."""
    inp, tables = Inputs(spark, sf), _sandbox(spark, "rollback-swapped")
    pointers.create_pointer(spark, tables.daily_summary, SPECS["daily_summary"])
    pointers.replace_table(spark, tables.daily_summary, inp.enriched())
    rollback_columns(spark, tables.daily_summary, ["tile_name", "tile_category"], comment=DAILY_SUMMARY_COMMENT_V1)
    return spark.table(tables.daily_summary).select("date", "tile_id", *SUMMARY_METRICS)


def rollback_undone(spark, sf):
    """The same rollback undone: the labels are back."""
    inp, tables = Inputs(spark, sf), _sandbox(spark, "rollback-undone")
    pointers.create_pointer(spark, tables.daily_summary, SPECS["daily_summary"])
    pointers.replace_table(spark, tables.daily_summary, inp.enriched())
    rollback_columns(spark, tables.daily_summary, ["tile_name", "tile_category"])
    pointers.undo(spark, tables.daily_summary)
    return spark.table(tables.daily_summary).select(*LABELLED)


def stream_merged(spark, sf):
    """Structured Streaming folds the loaded events into the user flags, batch by batch."""
    from ..streaming.reruns import start_merged

    tables, inp = _published(spark, sf, "stream-merged", state=True)
    late = "pmod(CAST(event_id AS BIGINT), 5) = 3"
    ckpt = fresh_dir(spark, "merged-ckpt")
    for which, meta in ((f"NOT ({late})", inp.meta), (late, None)):
        daily.load_sources(spark, inp.tile.where(which), inp.inter.where(which), meta, tables)
        start_merged(spark, tables, checkpoint=ckpt).awaitTermination()
    return spark.table(tables.daily_summary).select(*LABELLED)


# ---------------------------------------------------------------- drifted sources

_DRIFT = JobOptions(adapt_sources=True, column_aliases=(("home_tile", "tile_id"), ("occurred_at", "event_ts"), ("category", "tile_category")))


def _drifted(spark, sf, label) -> tuple[TableNames, Inputs]:
    """Source tables of another shape: numbers for user ids, text and 0/1 for flags, text for
    timestamps, other names, other order, no device or version, a column nobody knows."""
    inp, tables = Inputs(spark, sf), _sandbox(spark, label)
    create_tables(spark, tables)
    for t in (tables.tile_events, tables.interstitial_events, tables.tile_metadata):
        spark.sql(f"DROP TABLE {t}")
    tile = inp.tile.selectExpr("event_type", "tile_id AS home_tile", "event_ts AS occurred_at", "CAST(user_id AS BIGINT) AS USER_ID", "event_id", "1.5D AS extra")
    inter = inp.inter.selectExpr(
        "event_id", "CAST(user_id AS INT) AS user_id", "session_id", "CAST(event_ts AS STRING) AS occurred_at", "tile_id AS home_tile",
        "CASE WHEN interstitial_view_flag THEN 'Y' ELSE ' no' END AS interstitial_view_flag",
        "CAST(primary_button_click_flag AS INT) AS primary_button_click_flag",
        "CAST(secondary_button_click_flag AS STRING) AS secondary_button_click_flag",
    )
    meta = inp.meta.selectExpr("tile_category AS category", "tile_name", "CAST(is_active AS STRING) AS is_active", "tile_id")
    for df, t in ((tile, tables.tile_events), (inter, tables.interstitial_events), (meta, tables.tile_metadata)):
        df.write.format("parquet").saveAsTable(t)
    return tables, inp


def drifted_sources_job(spark, sf):
    """The job over drifted sources: the summary of the plain ones."""
    tables, inp = _drifted(spark, sf, "drifted")
    daily.run_dates(spark, inp.dates(), tables, _DRIFT)
    return spark.table(tables.daily_summary).select(*LABELLED)


def drifted_events(spark, sf):
    """The drifted interstitial events as the registry has them; null where the source lacks a column."""
    tables, _ = _drifted(spark, sf, "drifted-events")
    rows = daily.source(spark, tables.interstitial_events, "interstitial_events", _DRIFT)
    return rows.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


QUERIES: dict[str, Query] = {
    "tile_events": tile_events,
    "interstitial_events": interstitial_events,
    "tile_events_day": tile_events_day,
    "interstitial_events_day": interstitial_events_day,
    "event_date_partitioned_scan": event_date_partitioned_scan,
    "active_metadata": active_metadata,
    "metadata_counts": metadata_counts,
    "tile_agg": tile_agg,
    "interstitial_agg": interstitial_agg,
    "daily_summary": daily_summary,
    "daily_summary_count_distinct": daily_summary_count_distinct,
    "daily_summary_day": daily_summary_day,
    "daily_summary_sorted": daily_summary_sorted,
    "daily_summary_enriched": daily_summary_enriched,
    "daily_summary_enriched_day": daily_summary_enriched_day,
    "daily_summary_category": daily_summary_category,
    "daily_summary_all_metadata": daily_summary_all_metadata,
    "daily_summary_event_enriched": daily_summary_event_enriched,
    "daily_summary_event_enriched_null_tiles": daily_summary_event_enriched_null_tiles,
    "daily_summary_zero_filled": daily_summary_zero_filled,
    "global_kpis": global_kpis,
    "global_kpis_day": global_kpis_day,
    "category_kpis": category_kpis,
    "missing_metadata_tiles": missing_metadata_tiles,
    "dq_report": dq_report,
    "reconcile_versions": reconcile_versions,
    "dq_report_faulty": dq_report_faulty,
    "reconcile_active_all": reconcile_active_all,
    "kpis_disagreeing": kpis_disagreeing,
    "partition_overwrite": partition_overwrite,
    "schema_evolution": schema_evolution,
    "schema_rollback": schema_rollback,
    "scd1_refresh": scd1_refresh,
    "unknown_labels_job": unknown_labels_job,
    "daily_job": daily_job,
    "backfill_job": backfill_job,
    "daily_summary_range": daily_summary_range,
    "stream_reruns": stream_reruns,
    "publish_interrupted": publish_interrupted,
    "publish_retried": publish_retried,
    "publish_reverted": publish_reverted,
    "late_events_merged": late_events_merged,
    "late_events_kpis": late_events_kpis,
    "quality_log": quality_log,
    "quality_breach": quality_breach,
    "enforced_day_summary": enforced_day_summary,
    "quarantined_events": quarantined_events,
    "reconcile_keys": reconcile_keys,
    "stream_merged": stream_merged,
    "drifted_sources_job": drifted_sources_job,
    "drifted_events": drifted_events,
    "dimension_undo": dimension_undo,
    "snapshot_labels_job": snapshot_labels_job,
    "rollback_swapped": rollback_swapped,
    "rollback_undone": rollback_undone,
}
