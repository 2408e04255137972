"""Enrichment of the summary with tile metadata.

The metadata dimension is prepared as a plan, not a job: active filter, non-null keys, one row
per tile (the latest). Its join with the summary is left to AQE, which broadcasts the dimension
only after it has been shuffled and its real size is known to be within
``spark.sql.adaptive.autoBroadcastJoinThreshold``, and keeps a sort-merge join with skew splits
otherwise; so no job runs before the query and nothing unmeasured is broadcast. Where a caller
reads the dimension more than once (the daily job) ``measure`` counts it first, and it is broadcast by a hint only if that exact size is within the limit.
"""

from __future__ import annotations

import datetime as dt
import logging
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import LABEL_COLUMNS, SUMMARY_METRICS, UNKNOWN_CATEGORY, UNKNOWN_NAME
from ..functions.columns import date_lit
from . import metrics as M

log = logging.getLogger(__name__)

DEFAULTS = {"tile_name": UNKNOWN_NAME, "tile_category": UNKNOWN_CATEGORY}
DUPLICATE_MODES = ("fail", "latest")
# Fixed per-row overhead used when turning measured bytes into an in-memory size estimate
# (UnsafeRow header + one 8-byte slot per field).
_ROW_OVERHEAD, _FIELD_SLOT = 16, 8
COPIES = "_copies"


class DuplicateMetadataError(ValueError):
    """Active metadata holds a tile_id more than once; a left join would multiply summary rows."""


@dataclass(frozen=True)
class Dimension:
    """A prepared metadata dimension: unique, non-null tile ids. ``rows``, ``est_bytes``,
    ``broadcast`` and the number of tiles that the metadata repeats are known once it is measured."""

    df: DataFrame
    rows: int | None = None
    est_bytes: int | None = None
    broadcast: bool | None = None
    repeated_tiles: int = 0

    def joinable(self) -> DataFrame:
        """The labels with the join strategy pinned if measured: a broadcast, or a sort-merge
        join (so a small compressed file estimate cannot trigger a broadcast of a dimension
        measured too large). Unmeasured, AQE decides on the size at run time."""
        df = self.df.drop(COPIES)
        if self.broadcast is None:
            return df
        return F.broadcast(df) if self.broadcast else df.hint("merge")


_UNITS = {"": 0, "b": 0, "k": 1, "m": 2, "g": 3, "t": 4, "p": 5}


def _bytes(raw: str) -> int | None:
    """A size setting in bytes; None for a form that is not known."""
    m = re.fullmatch(r"\s*(-?[0-9]+(?:\.[0-9]+)?)\s*([bkmgtp]?)(?:i?b)?\s*", str(raw).lower())
    return int(float(m[1]) * 1024 ** _UNITS[m[2]]) if m else None


def broadcast_limit(spark: SparkSession) -> int:
    """Bytes up to which a measured dimension is broadcast (<= 0: never).

    The adaptive threshold (applied by AQE to runtime sizes) is used when set, else the
    planner threshold; the measured size is compared against it.
    """
    for key in ("spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.autoBroadcastJoinThreshold"):
        try:
            raw = spark.conf.get(key, None)
        except Exception:  # optional setting without a value
            raw = None
        if raw not in (None, ""):
            size = _bytes(raw)
            if size is not None:
                return size
            log.warning("%s = %r is not a size; the default limit holds", key, raw)
    return 10 << 20


def latest_per_tile(metadata: DataFrame, columns: Sequence[str] = LABEL_COLUMNS) -> DataFrame:
    """One row per non-null tile_id: greatest updated_ts, ties broken by the label values; with
    the number of rows it stands for.

    An aggregate of a struct, so it runs with map-side partial aggregation.
    """
    order = ["updated_ts", *columns] if "updated_ts" in metadata.columns else list(columns)
    best = F.max(F.struct(*[F.col(c) for c in order])).alias("_best")
    one = metadata.where("tile_id IS NOT NULL").groupBy("tile_id").agg(best, F.count(F.lit(1)).alias(COPIES))
    return one.select("tile_id", *[F.col(f"_best.{c}").alias(c) for c in columns], COPIES)


def prepare_metadata(
    metadata: DataFrame,
    *,
    columns: Sequence[str] = LABEL_COLUMNS,
    active_only: bool = True,
    on_duplicates: str = "latest",
    limit_bytes: int | None = None,
) -> Dimension:
    """Filter and project the metadata to one row per tile; rows without a tile_id go. No job
    runs here, unless ``limit_bytes`` asks for a measurement.

    ``latest`` (default: the pipeline goes on) keeps the newest row of a repeated tile.
    ``fail`` takes the keys to be unique and has the query check it: a scalar subquery, run
    beside the scan of the events, that fails the query if a tile is repeated.
    """
    if on_duplicates not in DUPLICATE_MODES:
        raise ValueError(f"on_duplicates must be one of {DUPLICATE_MODES}")
    base = metadata.filter(F.col("is_active")) if active_only else metadata
    if on_duplicates == "latest":
        dim = Dimension(latest_per_tile(base, columns))
    else:
        keyed = base.where("tile_id IS NOT NULL").select("tile_id", *columns)
        unique = keyed.agg(F.count("tile_id") == F.count_distinct("tile_id")).scalar()
        message = "active metadata repeats a tile_id; fix the dimension or run with on_duplicates='latest'"
        guard = F.when(unique, F.lit(True)).otherwise(F.raise_error(F.lit(message)))
        dim = Dimension(keyed.where(guard).withColumn(COPIES, F.lit(1).cast("long")))
    return dim if limit_bytes is None else measure(dim, on_duplicates, limit_bytes)


def measure(dim: Dimension, on_duplicates: str = "latest", limit_bytes: int | None = None) -> Dimension:
    """The dimension with its exact row count and size (one small action), and its broadcast
    decided; repeated tiles are logged, or refused with ``fail``."""
    if dim.broadcast is not None:
        return dim
    labels = [c for c in dim.df.columns if c != COPIES]
    text_bytes = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in labels), F.lit(0))
    stats = dim.df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.col(COPIES) - 1), F.lit(0)).alias("repeated"),
        F.coalesce(F.sum(text_bytes), F.lit(0)).alias("bytes"),
        F.count_if(F.col(COPIES) > 1).alias("tiles"),
    ).first()
    rows, repeated, text = int(stats["rows"]), int(stats["repeated"]), int(stats["bytes"])
    if repeated and on_duplicates == "fail":
        raise DuplicateMetadataError(
            f"active metadata has {repeated} duplicate tile_id rows; "
            "fix the dimension or run with on_duplicates='latest'"
        )
    if repeated:
        log.warning("metadata: %d duplicate tile_id rows, keeping the latest per tile", repeated)
    est = rows * (_ROW_OVERHEAD + _FIELD_SLOT * len(labels)) + text
    limit = broadcast_limit(dim.df.sparkSession) if limit_bytes is None else limit_bytes
    fits = limit > 0 and est <= limit
    log.info("metadata: %d rows, ~%d bytes, broadcast=%s (limit %d)", rows, est, fits, limit)
    return Dimension(dim.df, rows, est, fits, int(stats["tiles"]))


def empty_metadata(spark: SparkSession, columns: Sequence[str] = LABEL_COLUMNS) -> Dimension:
    """Typed empty dimension, used when the metadata table is missing: every tile is UNKNOWN."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ["tile_id", *columns]])
    schema = schema.add(COPIES, T.LongType())
    return Dimension(spark.createDataFrame([], schema), 0, 0, True)


def label_expr(column: str) -> str:
    """SQL for a label, replaced by its default when null."""
    return f"coalesce(`{column}`, '{DEFAULTS[column]}')"


def label_sql(column: str) -> str:
    return f"{label_expr(column)} AS `{column}`"


def apply_labels(df: DataFrame, columns: Sequence[str] = LABEL_COLUMNS) -> DataFrame:
    """Replace each label in place by its default when null."""
    return df.withColumns({c: F.expr(label_expr(c)) for c in columns})


def enrich(summary: DataFrame, dim: Dimension, columns: Sequence[str] = LABEL_COLUMNS) -> DataFrame:
    """Left join of the aggregated summary with the dimension, defaults for unmapped tiles.

    Row count and metrics are those of the summary, because the dimension's keys are unique.
    """
    joined = summary.join(dim.joinable(), "tile_id", "left")
    return joined.selectExpr("date", "tile_id", *[label_sql(c) for c in columns], *SUMMARY_METRICS)


def zero_filled(
    summary: DataFrame,
    dim: Dimension,
    dates: str | dt.date | Sequence[str | dt.date],
    columns: Sequence[str] = LABEL_COLUMNS,
) -> DataFrame:
    """The summary plus, for each of ``dates``, every active tile without events, all counts 0
    (C7, opt-in).

    The summary becomes one row per tile with the list of its days, which meets the dimension by
    tile; the days that a tile lacks are added to its list, and the rows come from unfolding it.
    So no shuffle, sort or aggregation holds the zero rows (dates x tiles): what a task keeps is
    its share of the dimension and of the summary, and one tile's days (the calendar).
    """
    given = [dates] if isinstance(dates, (str, dt.date)) else list(dates)
    if not given:
        return enrich(summary, dim, columns)
    by_tile = summary.select("date", "tile_id", *SUMMARY_METRICS).repartition("tile_id")
    day = F.struct("date", *SUMMARY_METRICS)
    seen = _summed(by_tile, ["date", "tile_id"]).groupBy("tile_id").agg(F.collect_list(day).alias("_seen"))
    both = seen.join(dim.df.select("tile_id", *columns, COPIES), "tile_id", "full_outer")
    lacking = F.array_except(F.array(*[date_lit(d) for d in given]), F.coalesce(F.col("_seen.date"), F.array()))
    zeros = F.transform(lacking, lambda d: F.struct(d.alias("date"), *[F.lit(0).cast("bigint").alias(m) for m in SUMMARY_METRICS]))
    zeros = F.when(F.col(COPIES).isNotNull(), zeros)  # null for a tile outside the dimension
    days = F.coalesce(F.concat("_seen", zeros), "_seen", zeros)
    rows = both.select("tile_id", *[F.expr(label_sql(c)) for c in columns], F.explode(days).alias("_day"))
    return rows.select("_day.date", "tile_id", *columns, *[f"_day.{m}" for m in SUMMARY_METRICS])


def _summed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Null-safe merge of rows by key: the metrics are added (each has one non-zero source)."""
    return rows.groupBy(*keys).agg(*[F.expr(f"sum(`{m}`) AS `{m}`") for m in SUMMARY_METRICS])


def event_enriched_summary(
    tile_events: DataFrame,
    inter_events: DataFrame,
    dim: Dimension,
    process_date: str | dt.date | None = None,
    method: str = "two_level",
    columns: Sequence[str] = LABEL_COLUMNS,
) -> DataFrame:
    """Enrichment of raw events before aggregation (C3, D7), merged on null-safe keys (C4).

    A label is a function of the tile, so grouping events by (date, tile, labels) gives the groups
    of (date, tile), each with its labels: the events are aggregated first, and the labels meet
    one row a tile and day instead of travelling with every user. The two sources are merged by a
    union and one aggregation, in which a null tile is one group. One plan at every dimension
    size; nothing is run while it is built.
    """
    if process_date is not None:
        tile_events, inter_events = M.for_day(tile_events, process_date), M.for_day(inter_events, process_date)
        date_keys: list[str] = []
    else:
        tile_events, inter_events = M.with_day(tile_events), M.with_day(inter_events)
        date_keys = ["date"]
    keys = [*date_keys, "tile_id"]
    t = M.tile_agg(tile_events, keys, method)
    i = M.interstitial_agg(inter_events, keys, method)
    zeros = {m: F.lit(0).cast("bigint") for m in SUMMARY_METRICS}
    t, i = (x.withColumns({m: z for m, z in zeros.items() if m not in x.columns}) for x in (t, i))
    out = _summed(t.unionByName(i), keys).join(dim.joinable(), "tile_id", "left")
    date_col = F.col("date") if date_keys else date_lit(process_date).alias("date")
    return apply_labels(out, columns).select(date_col, "tile_id", *columns, *SUMMARY_METRICS)
