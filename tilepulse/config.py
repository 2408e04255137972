"""Job configuration: table names and run options (config-driven, nothing hard-coded in the job)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class TableNames:
    """Catalog names of the three sources and two targets, and of the tables that the published
    form of the job keeps beside them: the manifest of published runs, the quality log, and the
    users' flags per day."""

    tile_events: str = "analytics_db.SOURCE_HOME_TILE_EVENTS"
    interstitial_events: str = "analytics_db.SOURCE_INTERSTITIAL_EVENTS"
    tile_metadata: str = "analytics_db.SOURCE_TILE_METADATA"
    daily_summary: str = "reporting_db.TARGET_HOME_TILE_DAILY_SUMMARY"
    global_kpis: str = "reporting_db.TARGET_HOME_TILE_GLOBAL_KPIS"
    manifest: str = "reporting_db.TARGET_PUBLISHED_RUNS"
    quality_log: str = "reporting_db.TARGET_QUALITY_LOG"
    user_flags: str = "reporting_db.TARGET_HOME_TILE_USER_FLAGS"

    def in_databases(self, source_db: str, target_db: str) -> "TableNames":
        """Same tables, moved to other databases (tests, sandboxes)."""

        def move(name: str, db: str) -> str:
            return f"{db}.{name.split('.')[-1]}"

        return replace(
            self,
            tile_events=move(self.tile_events, source_db),
            interstitial_events=move(self.interstitial_events, source_db),
            tile_metadata=move(self.tile_metadata, source_db),
            daily_summary=move(self.daily_summary, target_db),
            global_kpis=move(self.global_kpis, target_db),
            manifest=move(self.manifest, target_db),
            quality_log=move(self.quality_log, target_db),
            user_flags=move(self.user_flags, target_db),
        )


@dataclass(frozen=True)
class JobOptions:
    """How the daily job computes and what it does on bad metadata.

    distinct_method: "two_level" (group by key+user, then count users; no Expand) or
        "count_distinct" (the plain multi-distinct aggregate). Both are exact.
    on_duplicate_metadata: "latest" (default: keep the newest row per tile_id, log the rest, as
        the pipeline goes on with bad metadata) or "fail".
    zero_fill: also emit active tiles without events, with zero counts; KPIs do not change.
    drop_null_tiles: leave out events without a tile_id (default: they keep a row of their own).
    enrich: write tile_name / tile_category (v1.1 target) or not (v1.0 target, which never
        reads the metadata).
    missing_tiles_table: a table that receives every tile without metadata, None for none.
    adapt_sources: read the event tables and the metadata through ``sources.adapt``: renamed columns
        (``column_aliases``: (other name, registry name) pairs), safe casts, absent optional columns.
    quality_limits: (check, most allowed) pairs; the published job stops before it publishes a
        date that counts more.
    """

    distinct_method: str = "two_level"
    on_duplicate_metadata: str = "latest"
    zero_fill: bool = False
    drop_null_tiles: bool = False
    enrich: bool = True
    missing_tiles_table: str | None = None
    label_columns: tuple[str, ...] = ("tile_name", "tile_category")
    quality_limits: tuple[tuple[str, int], ...] = ()
    adapt_sources: bool = False
    column_aliases: tuple[tuple[str, str], ...] = ()


def as_date(value: str | dt.date | dt.datetime) -> dt.date:
    """Parse a process date given as ISO text or date."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))
