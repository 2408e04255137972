"""Roll-ups of the summary (D8-D12): five sums and three guarded ratios per date (or per date and
category). The input is one row per (date, tile), so the sums run as map-side partial aggregates
and only one partial row per task and group crosses the shuffle.

"Total" counts are sums of per-tile distinct users, not distinct users over all tiles, and a
CTR may exceed 1 (clickers need not be viewers); both are the job's definitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import KPI_RATIOS, KPI_TOTALS, SUMMARY_METRICS

_RATIO_INPUTS = (
    ("total_tile_clicks", "total_tile_views"),
    ("total_primary_clicks", "total_interstitial_views"),
    ("total_secondary_clicks", "total_interstitial_views"),
)


def global_kpis(summary: DataFrame, keys: Sequence[str] = ("date",), extra: Sequence[str] = ()) -> DataFrame:
    """Totals and ratios per group; a date without summary rows has no KPI row. ``extra``: further
    aggregates (SQL with an alias), appended as columns."""
    keys = list(keys)
    sums = summary.groupBy(*keys).agg(
        *[F.expr(f"CAST(sum(`{m}`) AS BIGINT) AS `{t}`") for m, t in zip(SUMMARY_METRICS, KPI_TOTALS)],
        *[F.expr(e) for e in extra],
    )
    ratios = [
        f"CASE WHEN `{d}` > 0 THEN `{n}` / `{d}` ELSE 0.0D END AS `{r}`" for r, (n, d) in zip(KPI_RATIOS, _RATIO_INPUTS)
    ]
    return sums.selectExpr(*[f"`{k}`" for k in keys], *KPI_TOTALS, *ratios, *sums.columns[len(keys) + len(KPI_TOTALS) :])


def category_kpis(enriched: DataFrame) -> DataFrame:
    """The same roll-up per (date, tile_category) of the enriched summary."""
    return global_kpis(enriched, ("date", "tile_category"))
