"""Per-tile distinct-user metrics (D1-D6), the full outer merge of both event sources (C1) and zero
fill (D14), for one date or for every date at once.

Two exact plans for the distinct counts:

* ``count_distinct`` - ``count(DISTINCT CASE WHEN cond THEN user_id END)`` per metric, as written
  in the job. With several distinct aggregates Catalyst adds an ``Expand`` that copies every row
  once per metric before the first shuffle.
* ``two_level`` (default) - group by (keys, user_id) keeping one bit per metric (``bit_or``), then
  count the users whose bit is set. No ``Expand``; both shuffles carry map-side partial aggregates; a hot
  tile spreads over users in the first shuffle and arrives as one partial row per map task in
  the second, so no single task receives a hot group's raw rows.

Neither form pre-filters by event type or user: a tile whose only events are of other types, or
only from null users, still gets a row of zeros, exactly as in the job.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import INTERSTITIAL_METRICS, SUMMARY_METRICS, TILE_CLICK, TILE_VIEW
from ..config import as_date
from ..functions.columns import date_lit, day_of, on_day
from ..sources.schemas import EVENT_DATE

METHODS = ("two_level", "count_distinct")
_MASK_BITS = 63


Condition = str | Column


def tile_conditions() -> list[tuple[str, Condition]]:
    """Metric name -> event predicate (SQL) for tile events; the event type is case-sensitive."""
    return [
        ("unique_tile_views", f"event_type = '{TILE_VIEW}'"),
        ("unique_tile_clicks", f"event_type = '{TILE_CLICK}'"),
    ]


def interstitial_conditions() -> list[tuple[str, Condition]]:
    """Metric name -> event predicate (SQL) for interstitial events; a null flag is not set."""
    flags = ("interstitial_view_flag", "primary_button_click_flag", "secondary_button_click_flag")
    return [(name, f"coalesce({flag}, false)") for name, flag in zip(INTERSTITIAL_METRICS, flags)]


def _sql(cond: Condition) -> Column:
    return F.expr(cond) if isinstance(cond, str) else cond


def distinct_users(
    events: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[tuple[str, Condition]],
    method: str = "two_level",
    user: str = "user_id",
) -> DataFrame:
    """Count distinct non-null users per group and metric. Output: keys + one BIGINT per metric.

    Conditions are SQL predicates (or Columns). In the two-level form the per-user flags travel
    as a BIGINT bitmask (``bit_or`` of bit i for metric i; another for every further 63) rather than one column per metric,
    which makes the first, largest shuffle about 9 % smaller at sf0.1. Aggregates are written as
    SQL expressions, one call each, which keeps plan construction on the driver short.
    """
    keys = list(keys)
    if method == "count_distinct":
        aggs = [
            F.count_distinct(F.when(_sql(c), F.col(user))).alias(name) if not isinstance(c, str)
            else F.expr(f"count(DISTINCT CASE WHEN {c} THEN `{user}` END) AS `{name}`")
            for name, c in metrics
        ]
        return events.groupBy(*keys).agg(*aggs)
    if method != "two_level":
        raise ValueError(f"unknown distinct method {method!r}; expected one of {METHODS}")
    masks, counts = [], []
    for k in range(0, len(metrics), _MASK_BITS):  # one BIGINT of flags for every 63 metrics
        part, name = metrics[k : k + _MASK_BITS], f"_flags{k // _MASK_BITS}"
        mask = None
        for i, (_, c) in enumerate(part):
            bit = F.when(_sql(c), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint")
            mask = bit if mask is None else mask.bitwiseOR(bit)
        if all(isinstance(c, str) for _, c in part):
            bits = " | ".join(f"CASE WHEN {c} THEN {1 << i}L ELSE 0L END" for i, (_, c) in enumerate(part))
            masks.append(F.expr(f"bit_or({bits}) AS {name}"))
        else:
            masks.append(F.bit_or(mask).alias(name))
        seen = f"`{user}` IS NOT NULL AND ({name} & {{}}L) <> 0"
        counts += [F.expr(f"count(CASE WHEN {seen.format(1 << i)} THEN 1 END) AS `{m}`") for i, (m, _) in enumerate(part)]
    return events.groupBy(*keys, user).agg(*masks).groupBy(*keys).agg(*counts)


def with_day(events: DataFrame, ts: str = "event_ts") -> DataFrame:
    """Add the reporting ``date`` column for multi-date grouping: the day stored with the event
    (``event_date``) where the table has one, else the day of its timestamp. A stored day does
    not move with the session's time zone, so no event falls between two runs."""
    return events.withColumn("date", F.col(EVENT_DATE) if EVENT_DATE in events.columns else day_of(ts))


def for_day(events: DataFrame, process_date: str | dt.date) -> DataFrame:
    """Rows of one day, by the same rule as ``with_day``: a partition filter on the stored day,
    or a range on the timestamp that is pushed to the reader."""
    if EVENT_DATE in events.columns:
        return events.filter(F.col(EVENT_DATE) == date_lit(process_date))
    return events.filter(on_day(process_date))


def on_days(events: DataFrame, dates: Sequence[str | dt.date]) -> DataFrame:
    """Rows of the given days, by the same rule."""
    day = F.col(EVENT_DATE) if EVENT_DATE in events.columns else day_of("event_ts")
    return events.filter(day.isin([date_lit(d) for d in dates]))


def tile_agg(events: DataFrame, keys: Sequence[str] = ("tile_id",), method: str = "two_level") -> DataFrame:
    return distinct_users(events, keys, tile_conditions(), method)


def interstitial_agg(
    events: DataFrame, keys: Sequence[str] = ("tile_id",), method: str = "two_level"
) -> DataFrame:
    return distinct_users(events, keys, interstitial_conditions(), method)


def merge_sources(tile: DataFrame, inter: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join of the two per-tile aggregates on the keys, counts zero-filled.

    Equality keys, as in the job: a null tile_id on both sides gives two rows (the quality
    report flags it). Both inputs arrive hash-partitioned on the keys by their final
    aggregation, so the sort-merge join adds no exchange of its own.
    """
    keys = list(keys)
    joined = tile.join(inter, keys, "full_outer")
    return joined.selectExpr(*[f"`{k}`" for k in keys], *[f"coalesce(`{m}`, 0L) AS `{m}`" for m in SUMMARY_METRICS])


def daily_summary(
    tile_events: DataFrame,
    inter_events: DataFrame,
    process_date: str | dt.date | None = None,
    method: str = "two_level",
) -> DataFrame:
    """The un-enriched summary: date, tile_id and the five counts.

    With ``process_date`` this is the reference job for one day (filter, group by tile, stamp
    the date). Without it every date in the input is summarised in one pass, grouped by
    (date, tile_id); each date's rows equal a one-day run for that date.
    """
    if process_date is not None:
        t = tile_agg(for_day(tile_events, process_date), ["tile_id"], method)
        i = interstitial_agg(for_day(inter_events, process_date), ["tile_id"], method)
        merged = merge_sources(t, i, ["tile_id"])
        return merged.selectExpr(f"DATE'{as_date(process_date).isoformat()}' AS date", "tile_id", *SUMMARY_METRICS)
    keys = ["date", "tile_id"]
    t = tile_agg(with_day(tile_events), keys, method)
    i = interstitial_agg(with_day(inter_events), keys, method)
    return merge_sources(t, i, keys).select("date", "tile_id", *SUMMARY_METRICS)
