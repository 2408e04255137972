"""Values the results depend on."""

# Must equal the reference's for the same results.
TILE_VIEW = "TILE_VIEW"
TILE_CLICK = "TILE_CLICK"
UNKNOWN_CATEGORY = "UNKNOWN"
UNKNOWN_NAME = "Unknown Tile"

# Output column names (fixed values, in target-table order).
TILE_METRICS = ("unique_tile_views", "unique_tile_clicks")
INTERSTITIAL_METRICS = (
    "unique_interstitial_views",
    "unique_interstitial_primary_clicks",
    "unique_interstitial_secondary_clicks",
)
SUMMARY_METRICS = TILE_METRICS + INTERSTITIAL_METRICS
KPI_TOTALS = (
    "total_tile_views",
    "total_tile_clicks",
    "total_interstitial_views",
    "total_primary_clicks",
    "total_secondary_clicks",
)
KPI_RATIOS = ("overall_ctr", "overall_primary_ctr", "overall_secondary_ctr")
LABEL_COLUMNS = ("tile_name", "tile_category")
