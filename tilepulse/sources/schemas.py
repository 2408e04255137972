"""Table registry: one StructType per table (with column comments), its partitioning and DDL.

Every schema used by the job, the tests and the conformance check comes from here, so the
DDL, the in-memory fixtures and the written tables cannot drift apart.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _field(name: str, dtype: T.DataType, comment: str, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable, metadata={"comment": comment})


S, TS, B, D, L, DBL = (
    T.StringType(),
    T.TimestampType(),
    T.BooleanType(),
    T.DateType(),
    T.LongType(),
    T.DoubleType(),
)

# Column and table comments as the reference's DDL states them.
TILE_EVENTS = T.StructType(
    [
        _field("event_id", S, "Unique event identifier"),
        _field("user_id", S, "User identifier"),
        _field("session_id", S, "Session identifier"),
        _field("event_ts", TS, "Timestamp of event"),
        _field("tile_id", S, "Tile identifier on homepage"),
        _field("event_type", S, "TILE_VIEW or TILE_CLICK"),
        _field("device_type", S, "Mobile, Web etc"),
        _field("app_version", S, "App version"),
    ]
)
TILE_EVENTS_COMMENT = "Raw events for homepage tile impressions and clicks"

INTERSTITIAL_EVENTS = T.StructType(
    [
        _field("event_id", S, "Unique event identifier"),
        _field("user_id", S, "User identifier"),
        _field("session_id", S, "Session identifier"),
        _field("event_ts", TS, "Timestamp"),
        _field("tile_id", S, "Tile that shows interstitial"),
        _field("interstitial_view_flag", B, "Interstitial view flag"),
        _field("primary_button_click_flag", B, "Primary CTA clicked"),
        _field("secondary_button_click_flag", B, "Secondary CTA clicked"),
    ]
)
INTERSTITIAL_EVENTS_COMMENT = "Raw events for interstitial impressions and CTA button clicks"

TILE_METADATA = T.StructType(
    [
        _field("tile_id", S, "Tile identifier"),
        _field("tile_name", S, "User-friendly tile name"),
        _field("tile_category", S, "Business or functional category of tile"),
        _field("is_active", B, "Indicates if tile is currently active"),
        _field("updated_ts", TS, "Last update timestamp"),
    ]
)
TILE_METADATA_COMMENT = (
    "Master metadata for homepage tiles, used for business categorization and reporting enrichment"
)

DAILY_SUMMARY_V1 = T.StructType(
    [
        _field("date", D, "Reporting date"),
        _field("tile_id", S, "Tile identifier"),
        _field("unique_tile_views", L, "Distinct users who viewed the tile"),
        _field("unique_tile_clicks", L, "Distinct users who clicked the tile"),
        _field("unique_interstitial_views", L, "Distinct users who viewed interstitial"),
        _field("unique_interstitial_primary_clicks", L, "Distinct users who clicked primary button"),
        _field("unique_interstitial_secondary_clicks", L, "Distinct users who clicked secondary button"),
    ]
)
DAILY_SUMMARY_COMMENT_V1 = "Daily aggregated tile-level metrics for reporting"

# Columns added by the v1.1 model change, and the table comment it sets.
SUMMARY_ADDED_COLUMNS = T.StructType(
    [
        _field("tile_name", S, "User-friendly tile name from metadata table"),
        _field("tile_category", S, "Business category classification of the tile"),
    ]
)
DAILY_SUMMARY_COMMENT_V11 = (
    "Daily aggregated tile-level metrics with metadata enrichment for enhanced reporting"
)

GLOBAL_KPIS = T.StructType(
    [
        _field("date", D, "Reporting date"),
        _field("total_tile_views", L, "Total unique tile views across tiles"),
        _field("total_tile_clicks", L, "Total unique tile clicks across tiles"),
        _field("total_interstitial_views", L, "Total interstitial views"),
        _field("total_primary_clicks", L, "Total primary button clicks"),
        _field("total_secondary_clicks", L, "Total secondary button clicks"),
        _field("overall_ctr", DBL, "Tile Clicks / Tile Views"),
        _field("overall_primary_ctr", DBL, "Primary Clicks / Interstitial Views"),
        _field("overall_secondary_ctr", DBL, "Secondary Clicks / Interstitial Views"),
    ]
)
GLOBAL_KPIS_COMMENT = "Daily global KPIs rolled up for dashboard"

# Partition column materialised on the event tables: Parquet tables cannot be partitioned by
# the expression date(event_ts), so the day is stored as a column and partitioned by.
EVENT_DATE = "event_date"
_EVENT_DATE_FIELD = _field(EVENT_DATE, D, "Day of event_ts (partition column)")


def _with(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    return T.StructType(list(schema.fields) + list(fields))


def _insert_after(schema: T.StructType, after: str, fields: T.StructType) -> T.StructType:
    out: list[T.StructField] = []
    for f in schema.fields:
        out.append(f)
        if f.name == after:
            out.extend(fields.fields)
    return T.StructType(out)


# v1.1 output order: date, tile_id, tile_name, tile_category, metrics.
DAILY_SUMMARY = _insert_after(DAILY_SUMMARY_V1, "tile_id", SUMMARY_ADDED_COLUMNS)
# Category-only form of the technical specification (one added column).
DAILY_SUMMARY_CATEGORY = _insert_after(
    DAILY_SUMMARY_V1, "tile_id", T.StructType([SUMMARY_ADDED_COLUMNS["tile_category"]])
)


@dataclass(frozen=True)
class TableSpec:
    """A table in the registry: schema, partition columns and comment."""

    schema: T.StructType
    partition_cols: tuple[str, ...]
    comment: str

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


SPECS: dict[str, TableSpec] = {
    "tile_events": TableSpec(_with(TILE_EVENTS, _EVENT_DATE_FIELD), (EVENT_DATE,), TILE_EVENTS_COMMENT),
    "interstitial_events": TableSpec(
        _with(INTERSTITIAL_EVENTS, _EVENT_DATE_FIELD), (EVENT_DATE,), INTERSTITIAL_EVENTS_COMMENT
    ),
    "tile_metadata": TableSpec(TILE_METADATA, (), TILE_METADATA_COMMENT),
    "daily_summary_v1": TableSpec(DAILY_SUMMARY_V1, ("date",), DAILY_SUMMARY_COMMENT_V1),
    "daily_summary": TableSpec(DAILY_SUMMARY, ("date",), DAILY_SUMMARY_COMMENT_V11),
    "daily_summary_category": TableSpec(DAILY_SUMMARY_CATEGORY, ("date",), DAILY_SUMMARY_COMMENT_V11),
    "global_kpis": TableSpec(GLOBAL_KPIS, ("date",), GLOBAL_KPIS_COMMENT),
}


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def column_ddl(field: T.StructField) -> str:
    comment = field.metadata.get("comment")
    text = f"`{field.name}` {field.dataType.simpleString().upper()}"
    return text + (f" COMMENT {_quote(comment)}" if comment else "")


def create_table_ddl(
    name: str, spec: TableSpec, *, location: str | None = None, fmt: str = "parquet"
) -> str:
    """CREATE TABLE IF NOT EXISTS text for a registry entry.

    Partition columns are declared in the column list and named in PARTITIONED BY; Spark
    moves them to the end of the table schema, which is why every write goes BY NAME.
    """
    cols = ",\n  ".join(column_ddl(f) for f in spec.schema.fields)
    parts = f"\nPARTITIONED BY ({', '.join(spec.partition_cols)})" if spec.partition_cols else ""
    loc = f"\nLOCATION {_quote(location)}" if location else ""
    return (
        f"CREATE TABLE IF NOT EXISTS {name} (\n  {cols}\n)\nUSING {fmt}{parts}"
        f"\nCOMMENT {_quote(spec.comment)}{loc}"
    )
