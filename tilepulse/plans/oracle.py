"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark code, straight from the job's definitions. The driver
pre-registers the generated tables as views (``events``, ``part``, ...). Casts keep the types
equal to Spark's: DuckDB ``sum(BIGINT)`` is HUGEINT, so sums are cast back to BIGINT.
"""

from __future__ import annotations

DAY = "DATE '2024-01-15'"
NO_TILE = "CASE WHEN CAST(event_id AS BIGINT) % 7 = 0 THEN NULL ELSE tile_id END"

_BASE = """
ev AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         CAST(user_id AS VARCHAR) AS user_id,
         CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
         ts AS event_ts,
         printf('TILE_%03d', CAST(json_extract_string(props, '$.k') AS INTEGER)) AS tile_id,
         event_type AS raw_type,
         event_id AS eid
  FROM events),
tile_ev AS (
  SELECT event_id, user_id, session_id, event_ts, tile_id,
         CASE WHEN raw_type = 'view' THEN 'TILE_VIEW' ELSE 'TILE_CLICK' END AS event_type,
         CASE WHEN eid % 2 = 0 THEN 'Mobile' ELSE 'Web' END AS device_type,
         '1.0' AS app_version
  FROM ev WHERE raw_type IN ('view', 'click')),
int_ev AS (
  SELECT event_id, user_id, session_id, event_ts, tile_id,
         CASE WHEN raw_type = 'error' THEN eid % 2 = 0 ELSE TRUE END AS interstitial_view_flag,
         raw_type = 'purchase' AS primary_button_click_flag,
         raw_type = 'signup' AS secondary_button_click_flag
  FROM ev WHERE raw_type IN ('purchase', 'signup', 'error')),
meta AS (
  SELECT printf('TILE_%03d', CAST(p_partkey AS INTEGER)) AS tile_id,
         p_name AS tile_name,
         p_type AS tile_category,
         p_size % 5 <> 0 AS is_active,
         TIMESTAMP '2024-01-01 00:00:00' AS updated_ts
  FROM part),
active AS (SELECT tile_id, tile_name, tile_category FROM meta WHERE is_active)"""


def _summary(prefix: str, where: str, date_expr: str) -> str:
    """tile_agg / int_agg / daily / enriched CTEs for one event filter."""
    return f""",
{prefix}tile_agg AS (
  SELECT {date_expr} AS date, tile_id,
         count(DISTINCT CASE WHEN event_type = 'TILE_VIEW' THEN user_id END) AS unique_tile_views,
         count(DISTINCT CASE WHEN event_type = 'TILE_CLICK' THEN user_id END) AS unique_tile_clicks
  FROM tile_ev {where} GROUP BY 1, 2),
{prefix}int_agg AS (
  SELECT {date_expr} AS date, tile_id,
         count(DISTINCT CASE WHEN interstitial_view_flag THEN user_id END) AS unique_interstitial_views,
         count(DISTINCT CASE WHEN primary_button_click_flag THEN user_id END) AS unique_interstitial_primary_clicks,
         count(DISTINCT CASE WHEN secondary_button_click_flag THEN user_id END) AS unique_interstitial_secondary_clicks
  FROM int_ev {where} GROUP BY 1, 2),
{prefix}daily AS (
  SELECT coalesce(t.date, i.date) AS date,
         coalesce(t.tile_id, i.tile_id) AS tile_id,
         coalesce(t.unique_tile_views, 0) AS unique_tile_views,
         coalesce(t.unique_tile_clicks, 0) AS unique_tile_clicks,
         coalesce(i.unique_interstitial_views, 0) AS unique_interstitial_views,
         coalesce(i.unique_interstitial_primary_clicks, 0) AS unique_interstitial_primary_clicks,
         coalesce(i.unique_interstitial_secondary_clicks, 0) AS unique_interstitial_secondary_clicks
  FROM {prefix}tile_agg t FULL JOIN {prefix}int_agg i ON t.date = i.date AND t.tile_id = i.tile_id),
{prefix}enriched AS (
  SELECT d.date, d.tile_id,
         coalesce(a.tile_name, 'Unknown Tile') AS tile_name,
         coalesce(a.tile_category, 'UNKNOWN') AS tile_category,
         d.unique_tile_views, d.unique_tile_clicks, d.unique_interstitial_views,
         d.unique_interstitial_primary_clicks, d.unique_interstitial_secondary_clicks
  FROM {prefix}daily d LEFT JOIN active a ON d.tile_id = a.tile_id)"""


WITH = (
    "WITH "
    + _BASE
    + _summary("", "", "CAST(event_ts AS DATE)")
    + _summary("null_", "", "CAST(event_ts AS DATE)").replace("AS date, tile_id,", f"AS date, {NO_TILE} AS tile_id,")
    + _summary("day_", f"WHERE CAST(event_ts AS DATE) = {DAY}", DAY)
    + "\n"
)

METRICS = (
    "unique_tile_views, unique_tile_clicks, unique_interstitial_views, "
    "unique_interstitial_primary_clicks, unique_interstitial_secondary_clicks"
)


def _kpis(source: str, keys: str) -> str:
    return f"""
SELECT {keys},
       CAST(sum(unique_tile_views) AS BIGINT) AS total_tile_views,
       CAST(sum(unique_tile_clicks) AS BIGINT) AS total_tile_clicks,
       CAST(sum(unique_interstitial_views) AS BIGINT) AS total_interstitial_views,
       CAST(sum(unique_interstitial_primary_clicks) AS BIGINT) AS total_primary_clicks,
       CAST(sum(unique_interstitial_secondary_clicks) AS BIGINT) AS total_secondary_clicks,
       CASE WHEN sum(unique_tile_views) > 0
            THEN sum(unique_tile_clicks) / sum(unique_tile_views) ELSE 0.0 END AS overall_ctr,
       CASE WHEN sum(unique_interstitial_views) > 0
            THEN sum(unique_interstitial_primary_clicks) / sum(unique_interstitial_views) ELSE 0.0 END
            AS overall_primary_ctr,
       CASE WHEN sum(unique_interstitial_views) > 0
            THEN sum(unique_interstitial_secondary_clicks) / sum(unique_interstitial_views) ELSE 0.0 END
            AS overall_secondary_ctr
FROM {source} GROUP BY {keys}"""


SQL: dict[str, str] = {
    "tile_events": "SELECT * FROM tile_ev",
    "interstitial_events": "SELECT * FROM int_ev",
    "tile_events_day": f"SELECT * FROM tile_ev WHERE CAST(event_ts AS DATE) = {DAY}",
    "interstitial_events_day": f"SELECT * FROM int_ev WHERE CAST(event_ts AS DATE) = {DAY}",
    "event_date_partitioned_scan": "SELECT *, CAST(event_ts AS DATE) AS event_date FROM tile_ev",
    "active_metadata": "SELECT * FROM active",
    "metadata_counts": (
        "SELECT count(*) AS metadata_rows, count(*) FILTER (WHERE is_active) AS active_rows FROM meta"
    ),
    "tile_agg": "SELECT * FROM tile_agg",
    "interstitial_agg": "SELECT * FROM int_agg",
    "daily_summary": "SELECT * FROM daily",
    "daily_summary_count_distinct": "SELECT * FROM daily",
    "daily_summary_day": "SELECT * FROM day_daily",
    "daily_summary_sorted": "SELECT * FROM daily ORDER BY date, tile_id",
    "daily_summary_enriched": "SELECT * FROM enriched",
    "daily_summary_enriched_day": "SELECT * FROM day_enriched",
    "daily_summary_category": f"SELECT date, tile_id, tile_category, {METRICS} FROM enriched",
    "daily_summary_all_metadata": f"""
SELECT d.date, d.tile_id, coalesce(m.tile_category, 'UNKNOWN') AS tile_category, {METRICS}
FROM daily d LEFT JOIN meta m USING (tile_id)""",
    "daily_summary_event_enriched": "SELECT * FROM enriched",
    "daily_summary_event_enriched_null_tiles": f"""
SELECT n.date, n.tile_id, coalesce(a.tile_name, 'Unknown Tile') AS tile_name,
       coalesce(a.tile_category, 'UNKNOWN') AS tile_category, {METRICS}
FROM (SELECT coalesce(t.date, i.date) AS date, coalesce(t.tile_id, i.tile_id) AS tile_id,
             coalesce(unique_tile_views, 0) AS unique_tile_views,
             coalesce(unique_tile_clicks, 0) AS unique_tile_clicks,
             coalesce(unique_interstitial_views, 0) AS unique_interstitial_views,
             coalesce(unique_interstitial_primary_clicks, 0) AS unique_interstitial_primary_clicks,
             coalesce(unique_interstitial_secondary_clicks, 0) AS unique_interstitial_secondary_clicks
      FROM null_tile_agg t FULL JOIN null_int_agg i
        ON t.date = i.date AND t.tile_id IS NOT DISTINCT FROM i.tile_id) n
LEFT JOIN active a ON n.tile_id = a.tile_id""",
    "daily_summary_zero_filled": f"""
SELECT g.date, g.tile_id, coalesce(a.tile_name, 'Unknown Tile') AS tile_name,
       coalesce(a.tile_category, 'UNKNOWN') AS tile_category,
       coalesce(d.unique_tile_views, 0) AS unique_tile_views,
       coalesce(d.unique_tile_clicks, 0) AS unique_tile_clicks,
       coalesce(d.unique_interstitial_views, 0) AS unique_interstitial_views,
       coalesce(d.unique_interstitial_primary_clicks, 0) AS unique_interstitial_primary_clicks,
       coalesce(d.unique_interstitial_secondary_clicks, 0) AS unique_interstitial_secondary_clicks
FROM (SELECT date, tile_id FROM daily UNION SELECT date, tile_id FROM (SELECT DISTINCT date FROM daily), active) g
LEFT JOIN daily d USING (date, tile_id) LEFT JOIN active a USING (tile_id)""",
    "global_kpis": _kpis("daily", "date"),
    "global_kpis_day": _kpis("day_daily", "date"),
    "category_kpis": _kpis("enriched", "date, tile_category"),
    "missing_metadata_tiles": "SELECT tile_id FROM daily EXCEPT SELECT tile_id FROM active",
    "dq_report": f"""
SELECT 'duplicate_keys' AS check_name, CAST(count(*) AS BIGINT) AS violations
  FROM (SELECT date, tile_id FROM enriched GROUP BY date, tile_id HAVING count(*) > 1)
UNION ALL SELECT 'null_date', count(*) FILTER (WHERE date IS NULL) FROM enriched
UNION ALL SELECT 'null_tile_id', count(*) FILTER (WHERE tile_id IS NULL) FROM enriched
UNION ALL SELECT 'null_tile_category', count(*) FILTER (WHERE tile_category IS NULL) FROM enriched
UNION ALL SELECT 'negative_counts', count(*) FILTER (WHERE unique_tile_views < 0 OR unique_tile_clicks < 0
    OR unique_interstitial_views < 0 OR unique_interstitial_primary_clicks < 0
    OR unique_interstitial_secondary_clicks < 0) FROM enriched
UNION ALL SELECT 'unknown_category', count(*) FILTER (WHERE tile_category = 'UNKNOWN') FROM enriched
UNION ALL SELECT 'missing_metadata', count(*) FROM enriched e
    WHERE NOT EXISTS (SELECT 1 FROM active a WHERE a.tile_id = e.tile_id)
UNION ALL SELECT 'duplicate_metadata_tile_id', count(*)
  FROM (SELECT tile_id FROM active GROUP BY tile_id HAVING count(*) > 1)""",
    "dq_report_faulty": f"""
, faulty AS (
  SELECT r.date, r.tile_id,
         CASE WHEN unique_interstitial_views = 1 THEN NULL ELSE coalesce(a.tile_category, 'UNKNOWN') END AS tile_category,
         CASE WHEN unique_tile_clicks = 1 THEN -1 ELSE unique_tile_views END AS unique_tile_views
  FROM (SELECT date, tile_id, unique_tile_views, unique_tile_clicks, 0 AS unique_interstitial_views FROM null_tile_agg
        UNION ALL SELECT date, tile_id, 0, 0, unique_interstitial_views FROM null_int_agg) r
  LEFT JOIN active a ON r.tile_id = a.tile_id)
SELECT 'duplicate_keys' AS check_name, CAST(count(*) AS BIGINT) AS violations
  FROM (SELECT date, tile_id FROM faulty GROUP BY date, tile_id HAVING count(*) > 1)
UNION ALL SELECT 'null_date', count(*) FILTER (WHERE date IS NULL) FROM faulty
UNION ALL SELECT 'null_tile_id', count(*) FILTER (WHERE tile_id IS NULL) FROM faulty
UNION ALL SELECT 'null_tile_category', count(*) FILTER (WHERE tile_category IS NULL) FROM faulty
UNION ALL SELECT 'negative_counts', count(*) FILTER (WHERE unique_tile_views < 0) FROM faulty
UNION ALL SELECT 'unknown_category', count(*) FILTER (WHERE tile_category = 'UNKNOWN') FROM faulty
UNION ALL SELECT 'missing_metadata', count(*) FROM faulty f
    WHERE NOT EXISTS (SELECT 1 FROM active a WHERE a.tile_id = f.tile_id)
UNION ALL SELECT 'duplicate_metadata_tile_id', count(*)
  FROM active WHERE CAST(substr(tile_id, 6) AS INTEGER) % 3 = 0""",
    "reconcile_active_all": f"""
, one AS (SELECT date, tile_id, tile_category, {METRICS} FROM enriched),
  two AS (SELECT d.date, d.tile_id, coalesce(m.tile_category, 'UNKNOWN') AS tile_category, {METRICS}
          FROM daily d LEFT JOIN meta m USING (tile_id))
SELECT 'active_not_in_all' AS direction, count(*) AS "rows" FROM (SELECT * FROM one EXCEPT ALL SELECT * FROM two)
UNION ALL SELECT 'all_not_in_active', count(*) FROM (SELECT * FROM two EXCEPT ALL SELECT * FROM one)""",
    "kpis_disagreeing": """
, stored AS (SELECT date, CAST(sum(unique_tile_views) AS BIGINT) AS total_tile_views,
       CAST(sum(unique_tile_clicks) AS BIGINT) AS total_tile_clicks,
       CAST(sum(unique_interstitial_views) AS BIGINT) AS total_interstitial_views,
       CAST(sum(unique_interstitial_primary_clicks) AS BIGINT) AS total_primary_clicks,
       CAST(sum(unique_interstitial_secondary_clicks) AS BIGINT) AS total_secondary_clicks
  FROM enriched GROUP BY date),
 summed AS (SELECT date, CAST(sum(unique_tile_views) AS BIGINT) AS summed_total_tile_views,
       CAST(sum(unique_tile_clicks) AS BIGINT) AS summed_total_tile_clicks,
       CAST(sum(unique_interstitial_views) AS BIGINT) AS summed_total_interstitial_views,
       CAST(sum(unique_interstitial_primary_clicks) AS BIGINT) AS summed_total_primary_clicks,
       CAST(sum(unique_interstitial_secondary_clicks) AS BIGINT) AS summed_total_secondary_clicks
  FROM enriched WHERE tile_category <> 'UNKNOWN' GROUP BY date)
SELECT * FROM stored FULL JOIN summed USING (date)
WHERE total_tile_views IS DISTINCT FROM summed_total_tile_views
   OR total_tile_clicks IS DISTINCT FROM summed_total_tile_clicks
   OR total_interstitial_views IS DISTINCT FROM summed_total_interstitial_views
   OR total_primary_clicks IS DISTINCT FROM summed_total_primary_clicks
   OR total_secondary_clicks IS DISTINCT FROM summed_total_secondary_clicks""",
    "reconcile_versions": f"""
SELECT 'plain_not_in_enriched' AS direction, count(*) AS "rows"
  FROM (SELECT date, tile_id, {METRICS} FROM daily EXCEPT ALL SELECT date, tile_id, {METRICS} FROM enriched)
UNION ALL
SELECT 'enriched_not_in_plain', count(*)
  FROM (SELECT date, tile_id, {METRICS} FROM enriched EXCEPT ALL SELECT date, tile_id, {METRICS} FROM daily)""",
    "partition_overwrite": "SELECT * FROM enriched",
    "schema_evolution": f"""
SELECT date, tile_id,
       CASE WHEN date < {DAY} THEN NULL ELSE tile_name END AS tile_name,
       CASE WHEN date < {DAY} THEN NULL ELSE tile_category END AS tile_category,
       {METRICS}
FROM enriched""",
    "schema_rollback": "SELECT * FROM daily",
    "scd1_refresh": "SELECT * FROM meta",
    "unknown_labels_job": f"""
SELECT date, tile_id, 'Unknown Tile' AS tile_name, 'UNKNOWN' AS tile_category, {METRICS} FROM daily""",
    "daily_job": _kpis("day_daily", "date"),
    "backfill_job": _kpis("daily", "date"),
    "daily_summary_range": "SELECT * FROM enriched",
    "stream_reruns": "SELECT * FROM enriched",
    "publish_interrupted": f"""
, old AS (SELECT date, tile_id, unique_tile_views, unique_tile_clicks, 0 AS unique_interstitial_views,
       0 AS unique_interstitial_primary_clicks, 0 AS unique_interstitial_secondary_clicks FROM tile_agg),
 kpis AS ({_kpis("old", "date")})
SELECT kpis.*, total_tile_views AS summary_unique_tile_views, total_tile_clicks AS summary_unique_tile_clicks,
       total_interstitial_views AS summary_unique_interstitial_views,
       total_primary_clicks AS summary_unique_interstitial_primary_clicks,
       total_secondary_clicks AS summary_unique_interstitial_secondary_clicks
FROM kpis""",
    "publish_retried": """
SELECT e.*, CASE WHEN t.date IS NULL THEN 1 ELSE 2 END AS times_published
FROM enriched e LEFT JOIN (SELECT DISTINCT date FROM tile_agg) t ON e.date = t.date""",
    "publish_reverted": f"""
SELECT date, tile_id,
       CASE WHEN date < {DAY} THEN 'Unknown Tile' ELSE tile_name END AS tile_name,
       CASE WHEN date < {DAY} THEN 'UNKNOWN' ELSE tile_category END AS tile_category, {METRICS}
FROM enriched""",
    "late_events_merged": "SELECT * FROM enriched",
    "late_events_kpis": _kpis("daily", "date"),
    "quality_log": """
, per_key AS (SELECT date, tile_id, count(*) AS n FROM enriched GROUP BY ALL),
 per_date AS (
  SELECT date, count(*) AS "rows", count(*) FILTER (WHERE tile_id IS NULL) AS null_tile_id,
         count(*) FILTER (WHERE tile_category IS NULL) AS null_tile_category,
         count(*) FILTER (WHERE least(unique_tile_views, unique_tile_clicks, unique_interstitial_views,
             unique_interstitial_primary_clicks, unique_interstitial_secondary_clicks) < 0) AS negative_counts,
         count(*) FILTER (WHERE tile_category = 'UNKNOWN') AS unknown_category,
         count(*) FILTER (WHERE tile_id IS NULL OR tile_id NOT IN (SELECT tile_id FROM active)) AS missing_metadata
  FROM enriched GROUP BY date),
 dups AS (SELECT date, count(*) FILTER (WHERE n > 1) AS duplicate_keys FROM per_key GROUP BY date)
SELECT date, check_name, CAST(violations AS BIGINT) AS violations
FROM (UNPIVOT (SELECT * FROM per_date JOIN dups USING (date))
      ON "rows", null_tile_id, null_tile_category, negative_counts, unknown_category, missing_metadata, duplicate_keys
      INTO NAME check_name VALUE violations)
UNION ALL
SELECT NULL, 'duplicate_metadata_tile_id', count(*)
  FROM (SELECT tile_id FROM active GROUP BY tile_id HAVING count(*) > 1)""",
    "quality_breach": """
, sizes AS (SELECT date, count(*) AS n, count(*) FILTER (WHERE tile_category <> 'UNKNOWN') AS labelled_rows
  FROM enriched GROUP BY date)
SELECT date, labelled_rows, CASE WHEN n > 5 THEN n END AS violations, CASE WHEN n > 5 THEN CAST(5 AS BIGINT) END AS allowed
FROM sizes""",
    "enforced_day_summary": "SELECT * FROM enriched",
    "quarantined_events": """
, all_ev AS (SELECT 'tile' AS source, event_id, event_ts, tile_id FROM tile_ev
  UNION ALL SELECT 'interstitial', event_id, event_ts, tile_id FROM int_ev)
SELECT source, 'bad-' || event_id AS event_id, tile_id, CAST(event_ts AS DATE) + 1 AS event_date, 'wrong_day' AS reason
  FROM all_ev WHERE CAST(event_id AS BIGINT) % 19 = 4
UNION ALL
SELECT source, 'bad-' || event_id, tile_id, CAST(event_ts AS DATE), 'no_timestamp'
  FROM all_ev WHERE CAST(event_id AS BIGINT) % 23 = 5""",
    "stream_merged": "SELECT * FROM enriched",
    "drifted_sources_job": "SELECT * FROM enriched",
    "drifted_events": "SELECT * FROM int_ev",
    "dimension_undo": "SELECT * REPLACE (FALSE AS is_active) FROM meta",
    "snapshot_labels_job": "SELECT * FROM enriched",
    "rollback_swapped": "SELECT * FROM daily",
    "rollback_undone": "SELECT * FROM enriched",
    "reconcile_keys": """
, base AS (SELECT *, CAST(substr(tile_id, 6) AS INTEGER) AS n FROM enriched),
 told AS (
  SELECT date, tile_id, 1 AS occurrence, 'lost' AS kind, b.* EXCLUDE (date, tile_id, n), 0 AS up FROM base b WHERE n % 11 = 0
  UNION ALL
  SELECT date, tile_id || '-B', 1, 'added', b.* EXCLUDE (date, tile_id, n), 0 FROM base b WHERE n % 13 = 0
  UNION ALL
  SELECT date, tile_id, 1, 'added', b.* EXCLUDE (date, tile_id, n), 0 FROM base b WHERE n % 17 = 0 AND n % 11 <> 0 AND n % 5 <> 0
  UNION ALL
  SELECT date, tile_id, 2, 'added', b.* EXCLUDE (date, tile_id, n), 1 FROM base b WHERE n % 17 = 0 AND n % 11 <> 0 AND n % 5 = 0),
 metrics AS (
  UNPIVOT (SELECT date, tile_id, occurrence, kind, tile_name, tile_category,
                  CAST(unique_tile_views + up AS VARCHAR) AS unique_tile_views, CAST(unique_tile_clicks AS VARCHAR) AS unique_tile_clicks,
                  CAST(unique_interstitial_views AS VARCHAR) AS unique_interstitial_views,
                  CAST(unique_interstitial_primary_clicks AS VARCHAR) AS unique_interstitial_primary_clicks,
                  CAST(unique_interstitial_secondary_clicks AS VARCHAR) AS unique_interstitial_secondary_clicks
           FROM told)
  ON COLUMNS(* EXCLUDE (date, tile_id, occurrence, kind)) INTO NAME metric VALUE v)
SELECT date, tile_id, CAST(occurrence AS INTEGER) AS occurrence, kind, metric,
       CASE WHEN kind = 'lost' THEN v END AS before, CASE WHEN kind = 'added' THEN v END AS after
FROM metrics
UNION ALL
SELECT date, tile_id, 1, 'changed', 'unique_tile_views', CAST(unique_tile_views AS VARCHAR), CAST(unique_tile_views + 1 AS VARCHAR)
FROM base WHERE n % 5 = 0 AND n % 11 <> 0""",
}


def oracle_sql() -> dict[str, str]:
    return {k: WITH + v for k, v in SQL.items()}
