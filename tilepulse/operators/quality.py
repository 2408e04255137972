"""Data-quality operators.

Each check is a DataFrame that returns violations; the caller decides to warn or fail. Only
bounded values reach the driver: counts, and at most ``sample`` example keys for a log line.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import KPI_TOTALS, SUMMARY_METRICS, UNKNOWN_CATEGORY
from . import kpis as K

log = logging.getLogger(__name__)


# ---------------------------------------------------------------- metadata coverage (G1, K1, K5)


def missing_metadata_tiles(summary: DataFrame, metadata: DataFrame) -> DataFrame:
    """Distinct summary tile_ids without a metadata row (set difference, null-safe)."""
    return summary.select("tile_id").subtract(metadata.select("tile_id"))


def validate_metadata_completeness(summary: DataFrame, metadata: DataFrame, table: str | None = None, sample: int = 20) -> int:
    """Count the tiles without metadata; returns the count. The log shows at most ``sample`` of
    them; ``table``, where given, receives them all (replaced at every run)."""
    missing = missing_metadata_tiles(summary, metadata)
    if table:
        missing.write.mode("overwrite").format("parquet").saveAsTable(table)
        missing = missing.sparkSession.table(table)
    seen = Observation()
    shown = missing.observe(seen, F.count(F.lit(1)).alias("n")).orderBy("tile_id").limit(sample).collect()
    if not shown:
        return 0
    log.warning("%d tiles missing metadata, e.g. %s", seen.get["n"], [r.tile_id for r in shown])
    return seen.get["n"]


def kpis_disagreeing(summary: DataFrame, kpis: DataFrame) -> DataFrame:
    """Dates whose stored totals are not the sums of the summary's rows (H13), either way round:
    the date and both sides' totals."""
    sums = K.global_kpis(summary).select("date", *[F.col(t).alias(f"summed_{t}") for t in KPI_TOTALS])
    both = kpis.select("date", *KPI_TOTALS).join(sums, "date", "full_outer")
    differ = [~F.col(t).eqNullSafe(F.col(f"summed_{t}")) for t in KPI_TOTALS]
    cond = differ[0]
    for c in differ[1:]:
        cond = cond | c
    return both.where(cond)


def metadata_counts(metadata: DataFrame) -> DataFrame:
    """Row count and active-row count of the metadata table (D13, K11), one row."""
    return metadata.agg(
        F.count(F.lit(1)).alias("metadata_rows"),
        F.count_if(F.coalesce(F.col("is_active"), F.lit(False))).alias("active_rows"),
    )


# ---------------------------------------------------------------- summary checks


def dq_report(
    summary: DataFrame,
    metadata: DataFrame,
    keys: Sequence[str] = ("date", "tile_id"),
) -> DataFrame:
    """One row per check: (check_name, violations BIGINT).

    * duplicate_keys            - (date, tile_id) values occurring more than once
    * null_date / null_tile_id / null_tile_category - rows with a null key dimension
    * missing_metadata          - summary rows whose tile_id has no active metadata row
    * negative_counts           - rows with any count below zero
    * unknown_category          - rows labelled UNKNOWN (unmapped, or UNKNOWN in the metadata)
    * duplicate_metadata_tile_id - active metadata tile_ids occurring more than once

    ``metadata`` is the raw table; only active rows count for coverage and duplicates.

    The summary is read once: one aggregation by key (rows per key and per-key violation
    counts), one left join of those key rows with the distinct active tile ids (a lookup, so
    it cannot fan out), and one global aggregate. The metadata duplicates are a second, small
    branch over the metadata only.
    """
    keys = list(keys)
    has_cat = "tile_category" in summary.columns
    cat = F.col("tile_category") if has_cat else F.lit(None).cast("string")
    negative = None
    for m in SUMMARY_METRICS:
        c = F.col(m) < 0
        negative = c if negative is None else negative | c
    per_key = summary.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(cat.isNull()).alias("_null_cat"),
        F.count_if(F.coalesce(negative, F.lit(False))).alias("_neg"),
        F.count_if(F.coalesce(cat == F.lit(UNKNOWN_CATEGORY), F.lit(False))).alias("_unknown"),
    )
    active = metadata.filter(F.col("is_active")).select("tile_id")
    known = active.distinct().withColumn("_known", F.lit(True))
    n = F.col("_n")
    checks = per_key.join(known, "tile_id", "left").agg(
        F.count_if(n > 1).alias("duplicate_keys"),
        F.sum(F.when(F.col("date").isNull(), n).otherwise(0)).alias("null_date"),
        F.sum(F.when(F.col("tile_id").isNull(), n).otherwise(0)).alias("null_tile_id"),
        F.sum("_null_cat").alias("null_tile_category"),
        F.sum("_neg").alias("negative_counts"),
        F.sum("_unknown").alias("unknown_category"),
        F.sum(F.when(F.col("_known").isNull(), n).otherwise(0)).alias("missing_metadata"),
    )
    names = checks.columns
    checks = checks.select(*[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in names])
    meta_dups = (
        active.groupBy("tile_id").count().filter(F.col("count") > 1)
        .agg(F.count(F.lit(1)).cast("bigint").alias("duplicate_metadata_tile_id"))
    )
    rows = checks.unpivot([], names, "check_name", "violations").unionByName(
        meta_dups.unpivot([], ["duplicate_metadata_tile_id"], "check_name", "violations")
    )
    return rows.select("check_name", F.col("violations").cast("bigint").alias("violations"))


# ---------------------------------------------------------------- version reconciliation


def reconcile(
    before: DataFrame,
    after: DataFrame,
    columns: Sequence[str] | None = None,
    names: tuple[str, str] = ("before", "after"),
) -> DataFrame:
    """Multiset difference in both directions on the shared columns: (direction, rows).

    Equals ``count(before EXCEPT ALL after)`` and ``count(after EXCEPT ALL before)``, computed in
    one pass: both versions are tagged and unioned, grouped by every shared column (null-safe,
    as set operations are), and each distinct row contributes max(n_before - n_after, 0) to
    one direction and max(n_after - n_before, 0) to the other. Zero rows in both directions
    means the versions agree on every shared column, duplicates included.
    """
    cols = list(columns) if columns else [c for c in before.columns if c in after.columns]
    tagged = before.select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        after.select(*cols, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    per_row = tagged.groupBy(*cols).agg(F.sum("_a").alias("_na"), F.sum("_b").alias("_nb"))
    first, second = f"{names[0]}_not_in_{names[1]}", f"{names[1]}_not_in_{names[0]}"
    totals = per_row.agg(
        F.sum(F.greatest(F.col("_na") - F.col("_nb"), F.lit(0))).alias(first),
        F.sum(F.greatest(F.col("_nb") - F.col("_na"), F.lit(0))).alias(second),
    )
    totals = totals.select(*[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in (first, second)])
    return totals.unpivot([], [first, second], "direction", "rows")


def reconcile_keys(
    before: DataFrame,
    after: DataFrame,
    keys: Sequence[str] = ("date", "tile_id"),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Which values differ between two versions: one row per key, occurrence and column with the
    value ``before`` and ``after`` (as text) and the ``kind``: ``added`` and ``lost`` for rows that
    one version lacks, ``changed`` for values of rows that both have.

    ``columns``: those compared, by default all shared ones but the keys. Keys are null-safe and may
    repeat: rows that are equal in both versions cancel out first, as many times as they occur,
    and what is left of a key is paired by value order, numbered by ``occurrence``. The cancelling
    is one aggregation that combines map-side; only rows that differ go further.
    """
    keys = list(keys)
    cols = list(columns) if columns else [c for c in before.columns if c in after.columns and c not in keys]
    sides = [df.select(*keys, *[F.col(c).cast("string").alias(c) for c in cols], F.lit(n).alias("_n")) for df, n in ((before, 1), (after, -1))]
    surplus = sides[0].unionByName(sides[1]).groupBy(*keys, *cols).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    rows = surplus.select(*keys, *cols, (F.col("_n") > 0).alias("_first"), F.explode(F.expr("sequence(1L, abs(_n))")))
    rows = rows.repartition(*keys)  # one shuffle for the numbering and the pairing
    nth = F.row_number().over(Window.partitionBy(*keys, "_first").orderBy(*cols)).alias("occurrence")
    rows = rows.select(*keys, "_first", nth, F.struct(*cols).alias("_row"))
    of = [F.max(F.when(F.col("_first") == first, F.col("_row"))).alias(n) for first, n in ((True, "_old"), (False, "_new"))]
    pairs = rows.groupBy(*keys, "occurrence").agg(*of)
    kind = "CASE WHEN _old IS NULL THEN 'added' WHEN _new IS NULL THEN 'lost' ELSE 'changed' END AS kind"
    values = ", ".join(f"struct('{c}' AS metric, _old.`{c}` AS before, _new.`{c}` AS after)" for c in cols)
    told = pairs.selectExpr(*keys, "occurrence", kind, f"inline(array({values}))")
    return told.where("kind <> 'changed' OR NOT before <=> after")


# ---------------------------------------------------------------- schema checks


class SchemaDriftError(ValueError):
    """A DataFrame or table does not have the expected columns or types."""


@dataclass
class SchemaDiff:
    missing: list[str] = field(default_factory=list)
    extra: list[str] = field(default_factory=list)
    type_changes: list[tuple[str, str, str]] = field(default_factory=list)
    comment_changes: list[tuple[str, str | None, str | None]] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return not (self.missing or self.type_changes or self.comment_changes)

    def describe(self) -> str:
        parts = []
        if self.missing:
            parts.append(f"missing columns {self.missing}")
        if self.type_changes:
            parts.append("type changes " + ", ".join(f"{c}: {e} -> {a}" for c, e, a in self.type_changes))
        if self.comment_changes:
            parts.append("comment changes " + ", ".join(c for c, _, _ in self.comment_changes))
        if self.extra:
            parts.append(f"extra columns {self.extra}")
        return "; ".join(parts) or "schema matches"


def compare_schema(actual: T.StructType, expected: T.StructType, comments: bool = False) -> SchemaDiff:
    """Compare by column name (order-insensitive, case-insensitive names)."""
    got = {f.name.lower(): f for f in actual.fields}
    want = {f.name.lower(): f for f in expected.fields}
    diff = SchemaDiff()
    for name, f in want.items():
        if name not in got:
            diff.missing.append(f.name)
            continue
        g = got[name]
        if g.dataType.simpleString() != f.dataType.simpleString():
            diff.type_changes.append((f.name, f.dataType.simpleString(), g.dataType.simpleString()))
        if comments and g.metadata.get("comment") != f.metadata.get("comment"):
            diff.comment_changes.append((f.name, f.metadata.get("comment"), g.metadata.get("comment")))
    diff.extra = [g.name for n, g in got.items() if n not in want]
    return diff


def check_schema(df: DataFrame, expected: T.StructType, mode: str = "fail") -> SchemaDiff:
    """K7/K8: required columns and types present. ``fail`` raises, ``warn`` logs and returns."""
    diff = compare_schema(df.schema, expected)
    if not diff.ok:
        if mode == "fail":
            raise SchemaDriftError(diff.describe())
        log.warning("schema drift: %s", diff.describe())
    elif diff.extra:
        log.info("extra columns ignored: %s", diff.extra)
    return diff


# Columns each source must have for the job to run (the rest are carried but not read).
REQUIRED = {
    "tile_events": ("user_id", "event_ts", "tile_id", "event_type"),
    "interstitial_events": (
        "user_id", "event_ts", "tile_id",
        "interstitial_view_flag", "primary_button_click_flag", "secondary_button_click_flag",
    ),
    "tile_metadata": ("tile_id", "tile_name", "tile_category", "is_active"),
}


def check_source(
    df: DataFrame,
    source: str,
    expected: T.StructType,
    name: str = "",
    required: Sequence[str] | None = None,
) -> SchemaDiff:
    """Drift of a job input: a missing *required* column fails with a clear message; any other
    difference from the registry (optional column missing, type change, extra column) is logged."""
    need = tuple(required) if required is not None else REQUIRED[source]
    diff = compare_schema(df.schema, expected)
    lost = [c for c in diff.missing if c in need]
    retyped = [t for t in diff.type_changes if t[0] in need]
    label = name or source
    if lost:
        raise SchemaDriftError(f"{label}: required columns missing {lost}; cannot compute the summary")
    if retyped or diff.missing:
        log.warning("%s: schema drift tolerated: %s", label, diff.describe())
    elif diff.extra:
        log.info("%s: extra columns ignored: %s", label, diff.extra)
    return diff


def table_conformance(spark: SparkSession, table: str, expected: T.StructType) -> SchemaDiff:
    """A catalog table's columns, types and comments against the registry."""
    return compare_schema(spark.table(table).schema, expected, comments=True)
