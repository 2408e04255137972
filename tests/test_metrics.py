"""Golden scenarios and edge rows, every column asserted (FIXTURES.md §2-§4)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import AnalysisException

from conftest import DAY, rows_by_tile, ts
from tilepulse.operators import enrich as E
from tilepulse.operators import kpis as K
from tilepulse.operators import metrics as M

METHODS = ["two_level", "count_distinct"]

# The reference's script-test scenario rows and expectations (FIXTURES.md §2, §3).
META = [
    ("TILE_001", "Credit Score Check", "Personal Finance", True),
    ("TILE_002", "Health Assessment", "Health & Wellness", True),
    ("TILE_003", "Payment Options", "Payments", True),
]
S1_TILE = [
    ("E1", "U1", "S1", ts(8, 0), "TILE_001", "TILE_VIEW", "Mobile", "1.0"),
    ("E2", "U2", "S2", ts(8, 5), "TILE_001", "TILE_CLICK", "Mobile", "1.0"),
    ("E3", "U3", "S3", ts(9, 0), "TILE_002", "TILE_VIEW", "Web", "1.1"),
    ("E4", "U3", "S3", ts(9, 1), "TILE_002", "TILE_CLICK", "Web", "1.1"),
]
S1_INTER = [
    ("IE1", "U1", "S1", ts(8, 10), "TILE_001", True, True, False),
    ("IE2", "U2", "S2", ts(8, 20), "TILE_001", True, False, True),
    ("IE3", "U3", "S3", ts(9, 10), "TILE_002", True, True, False),
]
S2_TILE = S1_TILE + [("E2", "U2", "S2", ts(8, 6), "TILE_001", "TILE_CLICK", "Mobile", "1.0")]
S2_INTER = S1_INTER + [("IE2", "U2", "S2", ts(8, 21), "TILE_001", True, False, True)]
EXPECTED_S = {
    "TILE_001": ("Credit Score Check", "Personal Finance", 1, 1, 2, 1, 1),
    "TILE_002": ("Health Assessment", "Health & Wellness", 1, 1, 1, 1, 0),
}
COLS = (
    "tile_name",
    "tile_category",
    "unique_tile_views",
    "unique_tile_clicks",
    "unique_interstitial_views",
    "unique_interstitial_primary_clicks",
    "unique_interstitial_secondary_clicks",
)


def enriched(make_tile, make_inter, make_meta, tile, inter, meta, method="two_level", day=DAY):
    summary = M.daily_summary(make_tile(tile), make_inter(inter), day, method)
    return summary, E.enrich(summary, E.prepare_metadata(make_meta(meta)))


@pytest.mark.parametrize("method", METHODS)
@pytest.mark.parametrize("scenario", ["insert", "update"])
def test_script_scenarios(make_tile, make_inter, make_meta, method, scenario):
    tile, inter = (S1_TILE, S1_INTER) if scenario == "insert" else (S2_TILE, S2_INTER)
    summary, out = enriched(make_tile, make_inter, make_meta, tile, inter, META, method)
    got = rows_by_tile(out)
    assert set(got) == set(EXPECTED_S)
    for tile_id, exp in EXPECTED_S.items():
        assert tuple(got[tile_id][c] for c in COLS) == exp
        assert got[tile_id]["date"] == DAY
    assert out.columns == ["date", "tile_id", *COLS]
    k = K.global_kpis(summary).collect()
    assert len(k) == 1
    r = k[0]
    assert (r.total_tile_views, r.total_tile_clicks, r.total_interstitial_views) == (2, 2, 3)
    assert (r.total_primary_clicks, r.total_secondary_clicks) == (2, 1)
    assert r.overall_ctr == 1.0
    assert r.overall_primary_ctr == pytest.approx(2 / 3)
    assert r.overall_secondary_ctr == pytest.approx(1 / 3)


def test_zero_fill_adds_active_tiles_without_events(make_tile, make_inter, make_meta):
    summary = M.daily_summary(make_tile(S1_TILE), make_inter(S1_INTER), DAY)
    out = rows_by_tile(E.zero_filled(summary, E.prepare_metadata(make_meta(META)), DAY))
    assert set(out) == {"TILE_001", "TILE_002", "TILE_003"}
    assert tuple(out["TILE_003"][c] for c in COLS) == ("Payment Options", "Payments", 0, 0, 0, 0, 0)


def test_zero_fill_meets_summary_rows_of_any_key(spark, make_meta):
    """Null keys of both sources, a tile outside the metadata, days outside the list, a day given twice."""
    d1, d2, d3 = (DAY + dt.timedelta(days=n) for n in range(3))
    fields = ", ".join(f"{c} long" for c in COLS[2:])
    counts = [(d1, "TILE_001", 1, 2, 3, 4, 5), (d3, "TILE_001", 6, 0, 0, 0, 0), (None, "TILE_001", 7, 0, 0, 0, 0)]
    counts += [(d1, None, 1, 2, 0, 0, 0), (d1, None, 0, 0, 3, 0, 0), (None, None, 1, 0, 0, 0, 0), (d2, "TILE_999", 0, 0, 8, 0, 0)]
    summary = spark.createDataFrame(counts, f"date date, tile_id string, {fields}")
    out = E.zero_filled(summary, E.prepare_metadata(make_meta(META[:2])), [d1, d2, d2.isoformat(), d2])
    assert out.columns == ["date", "tile_id", *COLS]
    labels, unknown = {m[0]: m[1:3] for m in META[:2]}, ("Unknown Tile", "UNKNOWN")
    merged = [r for r in counts if r[:2] != (d1, None)] + [(d1, None, 1, 2, 3, 0, 0)]
    zeros = [(d2, "TILE_001"), (d1, "TILE_002"), (d2, "TILE_002")]
    want = [(*r[:2], *labels.get(r[1], unknown), *r[2:]) for r in merged]
    want += [(d, t, *labels[t], 0, 0, 0, 0, 0) for d, t in zeros]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)


def test_zero_rows_are_unfolded_last(make_tile, make_inter, make_meta):
    """The rows of dates x tiles are made after every join, shuffle, sort and aggregation."""
    summary = M.daily_summary(make_tile(S1_TILE), make_inter(S1_INTER))
    days = [DAY + dt.timedelta(days=n) for n in range(30)]
    out = E.zero_filled(summary, E.prepare_metadata(make_meta(META)), days)
    tree = out._jdf.queryExecution().sparkPlan().toString().splitlines()
    after = tree[: next(n for n, line in enumerate(tree) if "Generate explode" in line)]
    assert all("Project" in line for line in after)
    assert out.count() == 90


# ---------------------------------------------------------------- enrichment and columns

SHOP = [("T_A", "Alpha", "Tools", True), ("T_B", "Beta", "Games", True)]


def category_only(make_tile, make_inter, make_meta, tile, inter, meta):
    summary = M.daily_summary(make_tile(tile), make_inter(inter), DAY)
    dim = E.prepare_metadata(make_meta(meta), columns=["tile_category"], active_only=False)
    return E.enrich(summary, dim, ["tile_category"])


def test_both_sources_meet_per_tile(make_tile, make_inter, make_meta):
    tile = [("1", f"V{n}", "s", ts(7, n), "T_A", "TILE_VIEW") for n in range(4)]
    tile += [("2", "V1", "s", ts(12), "T_B", "TILE_CLICK"), ("3", "V1", "s", ts(13), "T_A", "TILE_CLICK")]
    inter = [("4", f"V{n}", "s", ts(15, n), "T_B", n < 3, n < 2, n == 4) for n in range(5)]
    out = rows_by_tile(category_only(make_tile, make_inter, make_meta, tile, inter, SHOP))
    assert {t: (r["tile_category"], *(r[c] for c in COLS[2:])) for t, r in out.items()} == {
        "T_A": ("Tools", 4, 1, 0, 0, 0),
        "T_B": ("Games", 0, 1, 3, 2, 1),
    }
    k = K.global_kpis(M.daily_summary(make_tile(tile), make_inter(inter), DAY)).first()
    assert (k.total_tile_views, k.total_tile_clicks, k.total_interstitial_views) == (4, 2, 3)
    assert (k.overall_ctr, k.overall_primary_ctr, k.overall_secondary_ctr) == (0.5, 2 / 3, 1 / 3)


def test_unmapped_tile_gets_defaults(make_tile, make_inter, make_meta):
    summary = M.daily_summary(make_tile([("1", "V", "s", ts(3), "T_Z", "TILE_CLICK")]), make_inter([]), DAY)
    (r,) = E.enrich(summary, E.prepare_metadata(make_meta(SHOP))).collect()
    assert tuple(r[c] for c in COLS) == ("Unknown Tile", "UNKNOWN", 0, 1, 0, 0, 0)


def test_a_day_without_events(make_tile, make_inter, make_meta):
    summary = M.daily_summary(make_tile([]), make_inter([]), DAY)
    dim = E.prepare_metadata(make_meta(SHOP))
    assert E.enrich(summary, dim).isEmpty() and K.global_kpis(summary).isEmpty()
    zero = E.zero_filled(summary, dim, [DAY, DAY + dt.timedelta(days=1)]).collect()
    assert sorted((r.date.day, r.tile_id, r.tile_category, r.unique_tile_views) for r in zero) == [
        (d, t, c, 0) for d in (DAY.day, DAY.day + 1) for t, c in (("T_A", "Tools"), ("T_B", "Games"))
    ]


def test_column_order_of_the_category_target(make_tile, make_inter, make_meta):
    out = category_only(make_tile, make_inter, make_meta, [], [], SHOP)
    assert out.columns == ["date", "tile_id", "tile_category", *COLS[2:]]


def test_source_without_the_event_type_is_refused(spark, make_inter):
    bad = spark.createDataFrame([("V", ts(4), "T_A")], "user_id string, event_ts timestamp, tile_id string")
    with pytest.raises(AnalysisException):
        M.daily_summary(bad, make_inter([]), DAY).collect()


def test_repeated_actions_of_a_user_count_once(make_tile, make_inter, make_meta):
    tile = [(str(n), "V", "s", ts(5, n), "T_A", "TILE_VIEW" if n % 2 else "TILE_CLICK") for n in range(20)]
    inter = [(str(n), "V", "s", ts(6, n), "T_A", True, n > 3, False) for n in range(9)]
    (r,) = category_only(make_tile, make_inter, make_meta, tile, inter, SHOP).collect()
    assert tuple(r[c] for c in COLS[2:]) == (1, 1, 1, 1, 0)


def test_many_metrics_need_several_masks(make_tile):
    t = make_tile([("1", f"V{n}", "s", ts(5, n % 60), f"T{n % 2}", f"K{n % 70}") for n in range(140)])
    metrics = [(f"k{i}", f"event_type = 'K{i}'") for i in range(70)]
    a = sorted(map(tuple, M.distinct_users(t, ["tile_id"], metrics).collect()))
    assert a == sorted(map(tuple, M.distinct_users(t, ["tile_id"], metrics, "count_distinct").collect()))
    assert a[0][1:] == tuple(2 if i % 2 == 0 else 0 for i in range(70))


# ---------------------------------------------------------------- edge rows (FIXTURES.md §4)


@pytest.mark.parametrize("method", METHODS)
def test_x1_null_user_not_counted_but_tile_kept(make_tile, make_inter, method):
    tile = [("E1", None, "S1", ts(9), "TILE_001", "TILE_VIEW"), ("E2", "U2", "S2", ts(9), "TILE_002", "TILE_VIEW")]
    inter = [("I1", None, "S1", ts(9), "TILE_003", True, True, True)]
    out = rows_by_tile(M.daily_summary(make_tile(tile), make_inter(inter), DAY, method))
    assert set(out) == {"TILE_001", "TILE_002", "TILE_003"}
    assert out["TILE_001"]["unique_tile_views"] == 0
    assert out["TILE_002"]["unique_tile_views"] == 1
    assert out["TILE_003"]["unique_interstitial_views"] == 0


@pytest.mark.parametrize("method", METHODS)
def test_x2_null_flag_counts_as_unset(make_tile, make_inter, method):
    inter = [("I1", "U1", "S1", ts(9), "TILE_001", None, True, None)]
    r = M.daily_summary(make_tile([]), make_inter(inter), DAY, method).first()
    assert (r.unique_interstitial_views, r.unique_interstitial_primary_clicks, r.unique_interstitial_secondary_clicks) == (0, 1, 0)


def test_x3_null_tile_in_both_sources_gives_two_rows(make_tile, make_inter):
    tile = [("E1", "U1", "S1", ts(9), None, "TILE_VIEW")]
    inter = [("I1", "U1", "S1", ts(9), None, True, False, False)]
    out = M.daily_summary(make_tile(tile), make_inter(inter), DAY).collect()
    assert len(out) == 2 and all(r.tile_id is None for r in out)


def test_x4_day_boundaries(make_tile, make_inter):
    prev, nxt = DAY - dt.timedelta(days=1), DAY + dt.timedelta(days=1)
    tile = [
        ("A", "U1", "S", ts(23, 59, 59, prev, 999999), "T_A", "TILE_VIEW"),
        ("B", "U2", "S", ts(0, 0, 0), "T_B", "TILE_VIEW"),
        ("C", "U3", "S", ts(23, 59, 59, DAY, 999999), "T_C", "TILE_VIEW"),
        ("D", "U4", "S", ts(0, 0, 0, nxt), "T_D", "TILE_VIEW"),
    ]
    out = rows_by_tile(M.daily_summary(make_tile(tile), make_inter([]), DAY))
    assert set(out) == {"T_B", "T_C"}


def test_x5_inactive_or_null_active_is_unknown(make_tile, make_inter, make_meta):
    tile = [("E1", "U1", "S", ts(9), "TILE_001", "TILE_VIEW"), ("E2", "U1", "S", ts(9), "TILE_002", "TILE_VIEW")]
    meta = [("TILE_001", "n1", "c1", False), ("TILE_002", "n2", "c2", None)]
    _, out = enriched(make_tile, make_inter, make_meta, tile, [], meta)
    assert {(r.tile_name, r.tile_category) for r in out.collect()} == {("Unknown Tile", "UNKNOWN")}


def test_x6_duplicate_metadata(make_meta):
    meta = make_meta(
        [
            ("TILE_001", "old", "c-old", True, ts(1)),
            ("TILE_001", "new", "c-new", True, ts(2)),
            ("TILE_002", "n2", "c2", True, ts(1)),
        ]
    )
    with pytest.raises(Exception, match="repeats a tile_id"):
        E.prepare_metadata(meta, on_duplicates="fail").df.collect()
    with pytest.raises(E.DuplicateMetadataError):
        E.measure(E.prepare_metadata(meta), "fail")
    dim = E.measure(E.prepare_metadata(meta))
    got = {r.tile_id: (r.tile_name, r.tile_category) for r in dim.df.collect()}
    assert got == {"TILE_001": ("new", "c-new"), "TILE_002": ("n2", "c2")}
    assert dim.rows == 2 and dim.broadcast


def test_null_keys_of_the_metadata_are_left_out(make_tile, make_inter, make_meta):
    meta = make_meta([(None, "a", "b", True), (None, "c", "d", True), ("T_A", "n", "c", True)])
    for mode in E.DUPLICATE_MODES:
        dim = E.prepare_metadata(meta, on_duplicates=mode)
        assert [r.tile_id for r in dim.df.collect()] == ["T_A"]
        summary = M.daily_summary(make_tile([("1", "V", "s", ts(5), None, "TILE_VIEW")]), make_inter([]), DAY)
        out = E.zero_filled(summary, dim, DAY).collect()
        assert sorted((r.tile_id or "", r.tile_category, r.unique_tile_views) for r in out) == [("", "UNKNOWN", 1), ("T_A", "c", 0)]


@pytest.mark.parametrize("raw, size", [("10MB", 10 << 20), ("1.5g", 3 << 29), ("1t", 1 << 40), ("-1", -1), ("512", 512), ("2kb", 2048), ("7 MiB", 7 << 20), ("odd", None)])
def test_size_settings(raw, size):
    assert E._bytes(raw) == size


def test_x7_tile_only_in_interstitial(make_tile, make_inter):
    inter = [("I1", "U1", "S", ts(9), "TILE_009", True, False, False)]
    r = M.daily_summary(make_tile([]), make_inter(inter), DAY).first()
    assert (r.unique_tile_views, r.unique_tile_clicks, r.unique_interstitial_views) == (0, 0, 1)


@pytest.mark.parametrize("method", METHODS)
def test_x8_other_event_types_keep_a_zero_row(make_tile, make_inter, method):
    tile = [("E1", "U1", "S", ts(9), "TILE_001", "OTHER"), ("E2", "U2", "S", ts(9), "TILE_001", "tile_view")]
    r = M.daily_summary(make_tile(tile), make_inter([]), DAY, method).first()
    assert (r.tile_id, r.unique_tile_views, r.unique_tile_clicks) == ("TILE_001", 0, 0)


def test_x9_null_labels_get_defaults(make_tile, make_inter, make_meta):
    tile = [("E1", "U1", "S", ts(9), "TILE_001", "TILE_VIEW")]
    _, out = enriched(make_tile, make_inter, make_meta, tile, [], [("TILE_001", None, None, True)])
    r = out.first()
    assert (r.tile_name, r.tile_category) == ("Unknown Tile", "UNKNOWN")


def test_x12_clicks_without_views(make_tile, make_inter):
    tile = [("E1", "U1", "S", ts(9), "TILE_001", "TILE_CLICK")]
    k = K.global_kpis(M.daily_summary(make_tile(tile), make_inter([]), DAY)).first()
    assert (k.total_tile_clicks, k.overall_ctr, k.overall_primary_ctr) == (1, 0.0, 0.0)


def test_multi_date_equals_one_run_per_date(make_tile, make_inter):
    days = [DAY, DAY + dt.timedelta(days=1)]
    tile = [
        ("E1", "U1", "S", ts(9, day=days[0]), "TILE_001", "TILE_VIEW"),
        ("E2", "U1", "S", ts(9, day=days[1]), "TILE_001", "TILE_VIEW"),
        ("E3", "U2", "S", ts(9, day=days[1]), "TILE_002", "TILE_CLICK"),
    ]
    inter = [("I1", "U3", "S", ts(10, day=days[1]), "TILE_003", True, False, False)]
    t, i = make_tile(tile), make_inter(inter)
    whole = sorted(tuple(r) for r in M.daily_summary(t, i).collect())
    per_day = sorted(tuple(r) for d in days for r in M.daily_summary(t, i, d).collect())
    assert whole == per_day


def test_event_level_enrichment_matches_summary_enrichment(make_tile, make_inter, make_meta):
    tile = S1_TILE + [("E9", "U9", "S9", ts(9), "TILE_777", "TILE_VIEW", "Web", "1.0")]
    inter = S1_INTER + [("I9", "U9", "S9", ts(9), "TILE_777", True, False, False)]
    dim = E.prepare_metadata(make_meta(META))
    t, i = make_tile(tile), make_inter(inter)
    a = sorted(tuple(r) for r in E.event_enriched_summary(t, i, dim, DAY).collect())
    b = sorted(tuple(r) for r in E.enrich(M.daily_summary(t, i, DAY), dim).collect())
    assert a == b
    unmapped = [r for r in a if r[1] == "TILE_777"]
    assert len(unmapped) == 1  # null-safe keys: one row, not two


@pytest.mark.parametrize("day", [DAY, None])
def test_event_level_rows_do_not_depend_on_the_dimension_size(make_tile, make_inter, make_meta, day):
    """Null tiles in both sources give one row, whether the dimension is broadcast or not."""
    tile = S1_TILE + [("E9", "U9", "S9", ts(9), t, "TILE_VIEW", "Web", "1.0") for t in (None, None, "TILE_777")]
    inter = S1_INTER + [("I9", "U8", "S9", ts(9), t, True, False, False) for t in (None, "TILE_777", "TILE_003")]
    t, i = make_tile(tile), make_inter(inter)
    sizes = [E.prepare_metadata(make_meta(META), limit_bytes=n) for n in (1, 1 << 40)]
    assert [d.broadcast for d in sizes] == [False, True]
    small, large = (sorted(map(str, E.event_enriched_summary(t, i, d, day).collect())) for d in sizes)
    assert small == large
    (null,) = [r for r in E.event_enriched_summary(t, i, sizes[0], day).collect() if r.tile_id is None]
    assert (null.unique_tile_views, null.unique_interstitial_views, null.tile_category) == (1, 1, "UNKNOWN")


@pytest.mark.parametrize("method", METHODS)
def test_skewed_tile_and_user_are_exact(spark, make_tile, make_inter, method):
    """A tile with a third of the rows and a user with many repeats: counts stay exact."""
    hot = [(f"H{n}", f"U{n % 50}", "S", ts(9, n % 60), "TILE_HOT", "TILE_VIEW") for n in range(300)]
    bot = [(f"B{n}", "BOT", "S", ts(10, n % 60), "TILE_HOT", "TILE_CLICK") for n in range(300)]
    rest = [(f"R{n}", f"U{n}", "S", ts(11), f"TILE_{n % 7}", "TILE_VIEW") for n in range(300)]
    out = rows_by_tile(M.daily_summary(make_tile(hot + bot + rest), make_inter([]), DAY, method))
    assert (out["TILE_HOT"]["unique_tile_views"], out["TILE_HOT"]["unique_tile_clicks"]) == (50, 1)
    assert sum(out[f"TILE_{k}"]["unique_tile_views"] for k in range(7)) == 300


def test_first_shuffle_spreads_tiles_over_users(make_tile, make_inter):
    df = M.daily_summary(make_tile([("E", "U", "S", ts(9), "T", "TILE_VIEW")]), make_inter([]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(date" in plan and "tile_id" in plan and "user_id" in plan
    first = [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln]
    assert any("user_id" in ln for ln in first)


@pytest.mark.parametrize("method", METHODS)
def test_column_conditions_equal_sql_conditions(make_tile, make_inter, method):
    from pyspark.sql import functions as F

    tile = [("E1", "U1", "S", ts(9), "T1", "TILE_VIEW"), ("E2", "U2", "S", ts(9), "T1", "TILE_CLICK"),
            ("E3", None, "S", ts(9), "T2", "TILE_VIEW"), ("E4", "U1", "S", ts(9), "T2", "TILE_CLICK")]
    t = make_tile(tile)
    cols = [("v", F.col("event_type") == "TILE_VIEW"), ("c", F.col("event_type") == "TILE_CLICK")]
    sql = [("v", "event_type = 'TILE_VIEW'"), ("c", "event_type = 'TILE_CLICK'")]
    a = sorted(map(tuple, M.distinct_users(t, ["tile_id"], cols, method).collect()))
    b = sorted(map(tuple, M.distinct_users(t, ["tile_id"], sql, method).collect()))
    assert a == b == [("T1", 1, 1), ("T2", 0, 1)]
