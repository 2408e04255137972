"""Quality checks that ride along with the KPI write (K3, K4, K6, K10), per date.

``kpis_and_checks`` aggregates the summary's rows once, by (date, tile) and then by date, and gives
the KPI row and the checks of each date; the job writes the former and observes the latter, so
the checks cost no pass of their own. The definitions are those of ``quality.dq_report``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import SUMMARY_METRICS, UNKNOWN_CATEGORY
from . import kpis as K
from .enrich import Dimension

#: Checks by date, in the order of the report.
CHECKS = ("rows", "duplicate_keys", "null_tile_id", "null_tile_category", "negative_counts", "unknown_category", "missing_metadata")
#: Checks of the run (no date).
RUN_CHECKS = ("duplicate_metadata_tile_id",)

QUALITY_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("violations", T.LongType()),
        T.StructField("allowed", T.LongType()),
        T.StructField("breached", T.BooleanType()),
    ]
)


class QualityBreachError(ValueError):
    """A check counts more than its limit allows; nothing was published."""


@dataclass(frozen=True)
class CheckResult:
    date: object
    check_name: str
    violations: int
    allowed: int | None

    @property
    def breached(self) -> bool:
        return self.allowed is not None and self.violations > self.allowed


def kpis_and_checks(summary: DataFrame, dim: Dimension | None) -> DataFrame:
    """The columns of ``global_kpis`` and one column per check, one row per date. ``dim`` is the
    active metadata, one row a tile; without it no row counts as lacking metadata."""
    label = "tile_category" if "tile_category" in summary.columns else None
    negative = " OR ".join(f"`{m}` < 0" for m in SUMMARY_METRICS)
    per_key = summary.groupBy("date", "tile_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.expr(f"count_if({label} IS NULL)" if label else "count(1)").alias("_no_label"),
        F.expr(f"count_if({negative})").alias("_negative"),
        F.expr(f"count_if({label} = '{UNKNOWN_CATEGORY}')" if label else "0L").alias("_unknown"),
        *[F.sum(m).alias(m) for m in SUMMARY_METRICS],
    )
    if dim is not None:
        known = dim.joinable().select("tile_id").withColumn("_known", F.lit(True))
        per_key = per_key.join(known, "tile_id", "left")
    missing = "CASE WHEN _known IS NULL THEN _n ELSE 0L END" if dim is not None else "0L"
    counts = {
        "rows": "_n",
        "duplicate_keys": "CASE WHEN _n > 1 THEN 1L ELSE 0L END",
        "null_tile_id": "CASE WHEN tile_id IS NULL THEN _n ELSE 0L END",
        "null_tile_category": "_no_label",
        "negative_counts": "_negative",
        "unknown_category": "_unknown",
        "missing_metadata": missing,
    }
    return K.global_kpis(per_key, extra=[f"sum({expr}) AS `{name}`" for name, expr in counts.items()])


def judged(values: Mapping, repeated_tiles: int, limits: Mapping[str, int]) -> list[CheckResult]:
    """Check results from {date: {check: count}}, dates in order, and the run's own checks."""
    unknown = sorted(set(limits) - {*CHECKS, *RUN_CHECKS})
    if unknown:
        raise ValueError(f"no such checks: {unknown}")
    rows = [CheckResult(d, c, int(found[c] or 0), limits.get(c)) for d, found in sorted(values.items()) for c in CHECKS]
    return rows + [CheckResult(None, c, repeated_tiles, limits.get(c)) for c in RUN_CHECKS]
