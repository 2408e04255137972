"""Mergeable distinct state: what each user did on each tile and day, as bits (D1-D6, late events).

One row (date, tile_id, user_id, flags): bit i is set if the user has an event of metric i, two more
bits say which source the events came from (a tile with other events only still has a row of
zeros). Flags of two loads merge by ``bit_or``, in any order and any number of times, so late events
are folded in without reading the old ones, and a load that is applied twice changes nothing.
Distinct counts are counts of rows with a bit set; no sketch, the counts are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import INTERSTITIAL_METRICS, SUMMARY_METRICS, TILE_METRICS
from ..sources.schemas import TableSpec
from .metrics import interstitial_conditions, tile_conditions, with_day

_BIT = {m: 1 << i for i, m in enumerate(SUMMARY_METRICS)}
_FROM_TILE, _FROM_INTER = 1 << len(SUMMARY_METRICS), 2 << len(SUMMARY_METRICS)
_KEYS = ["date", "tile_id", "user_id"]

USER_FLAGS = TableSpec(
    T.StructType(
        [
            T.StructField("date", T.DateType()),
            T.StructField("tile_id", T.StringType()),
            T.StructField("user_id", T.StringType()),
            T.StructField("flags", T.LongType()),
        ]
    ),
    ("date",),
    "What each user did on each tile and day, as bits; rows of several loads merge by bit_or",
)


def _source_flags(events: DataFrame, conditions: Sequence[tuple[str, str]], source: int) -> DataFrame:
    bits = " | ".join(f"CASE WHEN {cond} THEN {_BIT[name]}L ELSE 0L END" for name, cond in conditions)
    return with_day(events).where("date IS NOT NULL").selectExpr(*_KEYS, f"{bits} | {source}L AS flags")


def event_flags(tile_events: DataFrame, inter_events: DataFrame) -> DataFrame:
    """One row per event with a day, not merged (also of streams)."""
    tile = _source_flags(tile_events, tile_conditions(), _FROM_TILE)
    return tile.unionByName(_source_flags(inter_events, interstitial_conditions(), _FROM_INTER))


def merged(flags: DataFrame) -> DataFrame:
    """One row per day, tile and user."""
    return flags.groupBy(*_KEYS).agg(F.bit_or("flags").alias("flags"))


def summary_of(flags: DataFrame) -> DataFrame:
    """The rows of ``metrics.daily_summary`` from flags of any number of loads.

    That summary joins its two sources on equal keys, so a null tile has a row per source; here
    too. Both aggregations combine map-side: a hot tile reaches the second as one row a task.
    """
    seen = [
        f"count_if(user_id IS NOT NULL AND flags & {_BIT[m]}L <> 0) AS `{m}`" for m in SUMMARY_METRICS
    ]
    per_tile = merged(flags).groupBy("date", "tile_id").agg(*[F.expr(s) for s in seen], F.bit_or("flags").alias("_all"))
    both = _FROM_TILE | _FROM_INTER
    parts = f"CASE WHEN tile_id IS NULL THEN filter(array({_FROM_TILE}L, {_FROM_INTER}L), s -> _all & s <> 0) ELSE array({both}L) END"
    per_row = per_tile.withColumn("_part", F.explode(F.expr(parts)))
    of_part = [
        f"CASE WHEN _part & {source}L <> 0 THEN `{m}` ELSE 0L END AS `{m}`"
        for source, names in ((_FROM_TILE, TILE_METRICS), (_FROM_INTER, INTERSTITIAL_METRICS))
        for m in names
    ]
    return per_row.selectExpr("date", "tile_id", *of_part)
