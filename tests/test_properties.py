"""Property tests (hypothesis): invariances of the daily summary against a plain-Python model."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import DAY
from tilepulse.operators import enrich as E
from tilepulse.operators import kpis as K
from tilepulse.operators import metrics as M

TILES = ["TILE_001", "TILE_002", "TILE_003", None]
USERS = ["U1", "U2", "U3", "U4", None]
TYPES = ["TILE_VIEW", "TILE_CLICK", "OTHER"]
FLAG = st.sampled_from([True, False, None])
TIMES = st.sampled_from(
    [dt.datetime(2025, 11, 30, 23, 59), dt.datetime(2025, 12, 1, 0, 0), dt.datetime(2025, 12, 1, 12, 0), dt.datetime(2025, 12, 2, 0, 0)]
)

tile_rows = st.lists(
    st.tuples(st.sampled_from(USERS), TIMES, st.sampled_from(TILES), st.sampled_from(TYPES)), max_size=25
)
inter_rows = st.lists(st.tuples(st.sampled_from(USERS), TIMES, st.sampled_from(TILES), FLAG, FLAG, FLAG), max_size=25)


def model(tile, inter, day):
    """Reference semantics in plain Python: per tile, distinct non-null users per predicate."""
    sets = defaultdict(lambda: [set() for _ in range(5)])
    t_keys, i_keys = set(), set()
    for u, t, tile_id, kind in tile:
        if t.date() != day:
            continue
        t_keys.add(tile_id)
        s = sets[("t", tile_id)]
        if u is not None and kind == "TILE_VIEW":
            s[0].add(u)
        if u is not None and kind == "TILE_CLICK":
            s[1].add(u)
    for u, t, tile_id, v, p, sec in inter:
        if t.date() != day:
            continue
        i_keys.add(tile_id)
        s = sets[("i", tile_id)]
        for j, f in enumerate((v, p, sec)):
            if u is not None and f is True:
                s[2 + j].add(u)
    rows = []
    for k in t_keys | i_keys:
        if k is None:
            continue
        a, b = sets[("t", k)], sets[("i", k)]
        rows.append((day, k, len(a[0]), len(a[1]), len(b[2]), len(b[3]), len(b[4])))
    # null tile keys never match across the two sources: one row per side
    if None in t_keys:
        a = sets[("t", None)]
        rows.append((day, None, len(a[0]), len(a[1]), 0, 0, 0))
    if None in i_keys:
        b = sets[("i", None)]
        rows.append((day, None, 0, 0, len(b[2]), len(b[3]), len(b[4])))
    return sorted(rows, key=repr)


def frames(make_tile, make_inter, tile, inter):
    t = make_tile([(f"E{n}", u, "S", ts_, tid, kind) for n, (u, ts_, tid, kind) in enumerate(tile)])
    i = make_inter([(f"I{n}", u, "S", ts_, tid, v, p, s) for n, (u, ts_, tid, v, p, s) in enumerate(inter)])
    return t, i


SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(tile=tile_rows, inter=inter_rows, method=st.sampled_from(M.METHODS))
def test_summary_matches_model(make_tile, make_inter, tile, inter, method):
    t, i = frames(make_tile, make_inter, tile, inter)
    got = sorted((tuple(r) for r in M.daily_summary(t, i, DAY, method).collect()), key=repr)
    assert got == model(tile, inter, DAY)


@SETTINGS
@given(tile=tile_rows, inter=inter_rows)
def test_duplicating_and_reordering_events_changes_nothing(make_tile, make_inter, tile, inter):
    t1, i1 = frames(make_tile, make_inter, tile, inter)
    t2, i2 = frames(make_tile, make_inter, list(reversed(tile)) * 2, inter + inter[::-1])
    a = sorted((tuple(r) for r in M.daily_summary(t1, i1, DAY).collect()), key=repr)
    b = sorted((tuple(r) for r in M.daily_summary(t2, i2, DAY).collect()), key=repr)
    assert a == b


@SETTINGS
@given(tile=tile_rows, inter=inter_rows, active=st.lists(st.booleans(), min_size=3, max_size=3))
def test_enrichment_keeps_rows_and_kpis(make_tile, make_inter, make_meta, tile, inter, active):
    t, i = frames(make_tile, make_inter, tile, inter)
    summary = M.daily_summary(t, i, DAY)
    meta = make_meta([(k, f"n{k}", f"c{k}", a) for k, a in zip(TILES[:3], active)])
    enriched = E.enrich(summary, E.prepare_metadata(meta))
    metric_cols = ["date", "tile_id", *M.SUMMARY_METRICS]
    assert sorted(map(tuple, summary.collect()), key=repr) == sorted(
        map(tuple, enriched.select(*metric_cols).collect()), key=repr
    )
    k1 = sorted(map(tuple, K.global_kpis(summary).collect()))
    k2 = sorted(map(tuple, K.global_kpis(enriched).collect()))
    assert k1 == k2  # metadata never changes KPIs
    rows = summary.collect()
    if rows:  # KPI totals are the sums of the summary's counts
        assert list(k1[0][1:6]) == [sum(r[m] for r in rows) for m in M.SUMMARY_METRICS]
    else:
        assert k1 == []
    users_today = {u for u, ts_, _, _ in tile if u is not None and ts_.date() == DAY}
    for r in summary.collect():
        assert r.unique_tile_views <= len(users_today)


@SETTINGS
@given(tile=tile_rows, inter=inter_rows, method=st.sampled_from(M.METHODS))
def test_all_dates_summary_matches_model_per_day(make_tile, make_inter, tile, inter, method):
    t, i = frames(make_tile, make_inter, tile, inter)
    got = sorted((tuple(r) for r in M.daily_summary(t, i, None, method).collect()), key=repr)
    days = {ts_.date() for _, ts_, *_ in tile} | {ts_.date() for _, ts_, *_ in inter}
    want = sorted((row for d in days for row in model(tile, inter, d)), key=repr)
    assert got == want


# ---------------------------------------------------------------- data-quality report and reconciliation


from tilepulse.operators import quality as Q  # noqa: E402

SUMMARY_SCHEMA = (
    "date date, tile_id string, tile_name string, tile_category string, unique_tile_views bigint, "
    "unique_tile_clicks bigint, unique_interstitial_views bigint, unique_interstitial_primary_clicks bigint, "
    "unique_interstitial_secondary_clicks bigint"
)
summary_rows = st.lists(
    st.tuples(
        st.sampled_from([DAY, DAY + dt.timedelta(days=1), None]),
        st.sampled_from(["A", "B", "C", None]),
        st.sampled_from(["Personal", "UNKNOWN", None]),
        st.integers(-1, 2),
    ),
    max_size=12,
)
meta_rows = st.lists(st.tuples(st.sampled_from(["A", "B", "D"]), st.sampled_from([True, False, None])), max_size=5)


@SETTINGS
@given(rows=summary_rows, meta=meta_rows)
def test_dq_report_matches_brute_force(spark, make_meta, rows, meta):
    df = spark.createDataFrame([(d, t, "n", c, v, 0, 0, 0, 0) for d, t, c, v in rows], SUMMARY_SCHEMA)
    md = make_meta([(t, "n", "c", a) for t, a in meta])
    got = {r.check_name: r.violations for r in Q.dq_report(df, md).collect()}
    active = [t for t, a in meta if a is True]
    keys = [(d, t) for d, t, _, _ in rows]
    want = {
        "duplicate_keys": sum(1 for k in set(keys) if keys.count(k) > 1),
        "null_date": sum(1 for d, *_ in rows if d is None),
        "null_tile_id": sum(1 for _, t, *_ in rows if t is None),
        "null_tile_category": sum(1 for _, _, c, _ in rows if c is None),
        "negative_counts": sum(1 for *_, v in rows if v < 0),
        "unknown_category": sum(1 for _, _, c, _ in rows if c == "UNKNOWN"),
        "missing_metadata": sum(1 for _, t, *_ in rows if t not in active),
        "duplicate_metadata_tile_id": sum(1 for t in set(active) if active.count(t) > 1),
    }
    assert got == want


@SETTINGS
@given(a=summary_rows, b=summary_rows)
def test_reconcile_matches_except_all(spark, a, b):
    mk = lambda rows: spark.createDataFrame([(d, t, "n", c, v, 0, 0, 0, 0) for d, t, c, v in rows], SUMMARY_SCHEMA)
    x, y = mk(a), mk(b)
    got = {r.direction: r.rows for r in Q.reconcile(x, y).collect()}
    assert got == {"before_not_in_after": x.exceptAll(y).count(), "after_not_in_before": y.exceptAll(x).count()}
