"""Every registered query against its DuckDB oracle on the driver's sf0.001 tables."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import compare  # noqa: E402
from tilepulse.plans.oracle import oracle_sql  # noqa: E402
from tilepulse.plans.registry import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["date", "tile_id", "tile_name", "tile_category"]


def test_queries_match_oracle(spark):
    res = compare(spark, SF, list(QUERIES), verbose=False)
    assert [k for k, ok in res.items() if not ok] == []


# categories (incl. UNKNOWN), then the five KPI totals in target order.
GOLDEN = {
    "/root/testdata/sf0.001": (23, 10, 11, 4, 6, (5, 9, 11, 6, 2)),
    "/root/testdata/sf0.01": (99, 26, 10, 22, 7, (66, 52, 162, 65, 66)),
}


@pytest.mark.parametrize("sf", sorted(GOLDEN))
def test_one_day_figures_match_survey(spark, sf):
    if not os.path.isdir(sf):
        pytest.skip("driver test data not present")
    qs = entry.queries()
    tiles, inter_only, tile_only, unmapped, categories, totals = GOLDEN[sf]
    rows = qs["daily_summary_enriched_day"](spark, sf).collect()
    assert len(rows) == tiles
    assert sum(1 for r in rows if r.unique_tile_views == r.unique_tile_clicks == 0) >= inter_only
    assert sum(1 for r in rows if r.tile_category == "UNKNOWN") == unmapped
    assert len({r.tile_category for r in rows}) == categories
    k = qs["global_kpis_day"](spark, sf).first()
    assert (k.total_tile_views, k.total_tile_clicks, k.total_interstitial_views, k.total_primary_clicks,
            k.total_secondary_clicks) == totals
    t = {r.tile_id for r in qs["tile_events_day"](spark, sf).collect()}
    i = {r.tile_id for r in qs["interstitial_events_day"](spark, sf).collect()}
    assert (len(i - t), len(t - i)) == (inter_only, tile_only)
