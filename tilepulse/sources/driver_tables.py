"""Shape the driver's generated tables into the job's three sources.

Only ``events`` and ``part`` are used; every row of both is read (no id ranges, no caps), so the
work grows with the scale factor.

* tile events          = events of type view / click  -> TILE_VIEW / TILE_CLICK
* interstitial events  = events of type purchase / signup / error -> three flags
* tile metadata        = every ``part`` row: tile_id from p_partkey, name p_name, category
                         p_type, active unless p_size is a multiple of 5

The tile id of an event is ``TILE_`` + props.k zero-padded to three digits; the padding width
grows with the number, so it never truncates: part keys above 999 stay distinct (TILE_1234)
and simply match no event. ``props.k`` is read with ``get_json_object`` (code-generated, so the
whole projection stays inside one whole-stage-codegen span) and cast to INT.
Columns stay in the event table's schema order; ``event_ts`` keeps the driver's TIMESTAMP_NTZ,
so the calendar day does not depend on the session time zone.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import TILE_CLICK, TILE_VIEW

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
METADATA_UPDATED_TS = "2024-01-01 00:00:00"
DEFAULT_DATE = dt.date(2024, 1, 15)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{table}.parquet"))


def tile_code_sql(number_sql: str) -> str:
    """SQL for 'TILE_' + the integer zero-padded to at least three digits (never truncated)."""
    digits = f"CAST(CAST({number_sql} AS INT) AS STRING)"
    return f"concat('TILE_', lpad({digits}, greatest(3, length({digits})), '0'))"


# Columns shared by both event sources, as SQL expressions over the driver's `events` row
# (one selectExpr call builds the whole projection).
_COMMON = (
    "CAST(event_id AS STRING) AS event_id",
    "CAST(user_id AS STRING) AS user_id",
    "concat(CAST(user_id AS STRING), '-', CAST(to_date(ts) AS STRING)) AS session_id",
    "ts AS event_ts",
    tile_code_sql("get_json_object(props, '$.k')") + " AS tile_id",
)


def _events(spark_or_events: SparkSession | DataFrame, sf_dir: str | None) -> DataFrame:
    if isinstance(spark_or_events, DataFrame):
        return spark_or_events
    return read(spark_or_events, sf_dir, "events")


def tile_events(spark: SparkSession | DataFrame, sf_dir: str | None = None) -> DataFrame:
    """Tile events (schema of SOURCE_HOME_TILE_EVENTS, event_ts as TIMESTAMP_NTZ).

    Takes a session and folder, or an already-read ``events`` DataFrame.
    """
    ev = _events(spark, sf_dir).where(F.col("event_type").isin("view", "click"))
    return ev.selectExpr(
        *_COMMON,
        f"CASE WHEN event_type = 'view' THEN '{TILE_VIEW}' ELSE '{TILE_CLICK}' END AS event_type",
        "CASE WHEN event_id % 2 = 0 THEN 'Mobile' ELSE 'Web' END AS device_type",
        "'1.0' AS app_version",
    )


def interstitial_events(spark: SparkSession | DataFrame, sf_dir: str | None = None) -> DataFrame:
    """Interstitial events: purchase (T,T,F), signup (T,F,T), error (even event_id, F, F)."""
    ev = _events(spark, sf_dir).where(F.col("event_type").isin("purchase", "signup", "error"))
    return ev.selectExpr(
        *_COMMON,
        "CASE WHEN event_type = 'error' THEN event_id % 2 = 0 ELSE true END AS interstitial_view_flag",
        "event_type = 'purchase' AS primary_button_click_flag",
        "event_type = 'signup' AS secondary_button_click_flag",
    )


def tile_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata dimension derived from every row of ``part``."""
    return read(spark, sf_dir, "part").selectExpr(
        tile_code_sql("p_partkey") + " AS tile_id",
        "p_name AS tile_name",
        "p_type AS tile_category",
        "p_size % 5 <> 0 AS is_active",
        f"CAST('{METADATA_UPDATED_TS}' AS TIMESTAMP_NTZ) AS updated_ts",
    )
