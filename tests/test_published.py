"""Versioned targets, checks in the write, merged late events, enforced days, key reconciliation."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import DAY, ts
from tilepulse import versions as V
from tilepulse.config import JobOptions
from tilepulse.evolve import create_tables
from tilepulse.operators import metrics as M
from tilepulse.operators import quality as Q
from tilepulse.operators import user_flags as U
from tilepulse.operators.checks import CHECKS, QualityBreachError
from tilepulse.plans import daily, loading, published
from tilepulse.sinks import refresh_dimension
from tilepulse.sources import schemas as S

D1, D2, D3 = (DAY + dt.timedelta(days=n) for n in range(3))
META = [("T1", "One", "Tools", True), ("T2", "Two", "Games", True), ("T3", "Three", "Games", False)]


class Boom(RuntimeError):
    pass


def boom_at(step):
    def on_step(done):
        if done == step:
            raise Boom(step)

    return on_step


def random_events(rng, n, days=(D1, D2, D3), tiles=("T1", "T2", "T3", None), tag="E"):
    users = [None, *(f"U{i}" for i in range(8))]
    tile, inter = [], []
    for i in range(n):
        when = ts(rng.randrange(24), day=rng.choice(days))
        flags = [rng.choice([True, False, None]) for _ in range(3)]
        row = (f"{tag}{i}", rng.choice(users), "S", when, rng.choice(tiles))
        tile.append((*row, rng.choice(["TILE_VIEW", "TILE_CLICK", "OTHER"])))
        inter.append((f"I{tag}{i}", rng.choice(users), "S", when, rng.choice(tiles), *flags))
    return tile, inter


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def targets(spark, sandbox):
    """Plain sources, versioned targets."""
    published.create_published(spark, sandbox, state=False)
    for name in ("tile_events", "interstitial_events", "tile_metadata"):
        spark.sql(S.create_table_ddl(getattr(sandbox, name), S.SPECS[name]))
    return sandbox


def shown(spark, tables):
    """Both targets, columns in the registry's order (a table has its partition column last)."""
    names = ((tables.daily_summary, S.DAILY_SUMMARY), (tables.global_kpis, S.GLOBAL_KPIS))
    return tuple(rows(spark.table(t).select(*schema.fieldNames())) for t, schema in names)


@pytest.fixture
def load(spark, make_tile, make_inter, make_meta):
    def run(tables, tile, inter, meta=META):
        daily.load_sources(spark, make_tile(tile), make_inter(inter), make_meta(meta) if meta else None, tables)

    return run


# ------------------------------------------------------------------ one commit for both targets


def test_views_have_the_registry_schema(spark, targets):
    for name, key in ((targets.daily_summary, "daily_summary"), (targets.global_kpis, "global_kpis")):
        diff = Q.table_conformance(spark, name, S.SPECS[key].schema)
        assert diff.ok and not diff.extra, diff.describe()
    published.create_published(spark, targets)  # again: nothing happens


@pytest.mark.parametrize("zero_fill", [False, True])
def test_published_equals_the_plain_job(spark, targets, load, make_tile, make_inter, make_meta, zero_fill):
    tile, inter = random_events(random.Random(1), 60, days=(D1, D2))
    load(targets, tile, inter)
    options = JobOptions(zero_fill=zero_fill)
    report = published.run_published(spark, [D1, D2, D3], targets, options)
    plain = targets.in_databases(*(t.split(".")[0] + "_plain" for t in (targets.tile_events, targets.daily_summary)))
    create_tables(spark, plain)
    load(plain, tile, inter)
    want = daily.run_dates(spark, [D1, D2, D3], plain, options)
    assert shown(spark, targets) == shown(spark, plain)
    assert report.missing_metadata_tiles == want.missing_metadata_tiles
    days = [r[0] for r in spark.table(targets.manifest).select("day").distinct().collect()]
    assert sorted(days) == [D1, D2, D3]  # the day without events is an entry too


@pytest.mark.parametrize("step", ["summary staged", "kpis staged", "checked"])
def test_a_failed_run_shows_nothing(spark, targets, load, step):
    load(targets, *random_events(random.Random(2), 30))
    published.run_published(spark, [D1, D2], targets)
    before = shown(spark, targets)
    load(targets, *random_events(random.Random(3), 30, tag="F"), meta=None)
    with pytest.raises(Boom):
        published.run_published(spark, [D1, D2, D3], targets, on_step=boom_at(step))
    assert shown(spark, targets) == before
    published.run_published(spark, [D1, D2, D3], targets)
    after = shown(spark, targets)
    assert after != before and {r[0] for r in after[1]} == {r[0] for r in after[0]}
    assert spark.table(targets.manifest).where("day = DATE'%s'" % D3).count() == 2  # both targets, once


def test_emptied_revert_and_vacuum(spark, targets, load, make_tile):
    load(targets, [("E", "U", "S", ts(1), "T1", "TILE_VIEW")], [])
    published.run_published(spark, [D1], targets)
    first = shown(spark, targets)
    spark.sql(f"TRUNCATE TABLE {targets.tile_events}")
    published.run_published(spark, [D1], targets)
    assert shown(spark, targets) == ([], [])
    both = [targets.daily_summary, targets.global_kpis]
    assert V.revert(spark, targets.manifest, both, [D1]) == 3
    assert shown(spark, targets) == first
    with pytest.raises(Boom):
        load(targets, [("E2", "U", "S", ts(1), "T2", "TILE_VIEW")], [], meta=None)
        published.run_published(spark, [D1], targets, on_step=boom_at("summary staged"))
    assert V.vacuum(spark, targets.manifest, targets.daily_summary) == 1  # the failed run's
    assert shown(spark, targets) == first
    published.run_published(spark, [D1], targets)
    second = shown(spark, targets)
    assert [r[1] for r in second[0]] == ["T2"]
    assert V.vacuum(spark, targets.manifest, targets.daily_summary, history=0) == 1
    assert shown(spark, targets) == second
    V.revert(spark, targets.manifest, [targets.global_kpis], [D2])  # a day that was never published
    assert len(shown(spark, targets)[1]) == 1


def test_concurrent_publishers_leave_one_run_a_day(spark, targets):
    """Two commits with one sequence number: the same run holds in both tables."""
    both = [targets.daily_summary, targets.global_kpis]
    tile = spark.createDataFrame([(D1, "T1", None, None, 1, 0, 0, 0, 0)], S.DAILY_SUMMARY)
    kpis = spark.createDataFrame([(D1, 1, 0, 0, 0, 0, 0.0, 0.0, 0.0)], S.GLOBAL_KPIS)
    for n, run in enumerate(("run-b", "run-a")):
        V.stage(spark, tile.withColumn("unique_tile_views", F.lit(n).cast("long")), both[0], run)
        V.stage(spark, kpis.withColumn("total_tile_views", F.lit(n).cast("long")), both[1], run)
        entries = [(7, run, V.base_name(t), D1, "replace") for t in both]
        spark.createDataFrame(entries, V.MANIFEST).coalesce(1).write.insertInto(targets.manifest)
    assert [r.unique_tile_views for r in spark.table(both[0]).collect()] == [0]
    assert [r.total_tile_views for r in spark.table(both[1]).collect()] == [0]


def test_stage_refuses_other_columns_and_rows_without_a_day(spark, targets):
    df = spark.createDataFrame([(None, 1, 0, 0, 0, 0, 0.0, 0.0, 0.0)], S.GLOBAL_KPIS)
    with pytest.raises(Exception, match="has no date"):
        V.stage(spark, df, targets.global_kpis, "r")
    with pytest.raises(ValueError, match="overall_ctr"):
        V.stage(spark, df.drop("overall_ctr"), targets.global_kpis, "r")
    with pytest.raises(ValueError, match="more"):
        V.stage(spark, df.withColumn("more", F.lit(1)), targets.global_kpis, "r")


# ------------------------------------------------------------------ checks inside the write


def test_checks_equal_the_report_and_stop_a_breach(spark, targets, load, make_meta):
    tile, inter = random_events(random.Random(4), 40, days=(D1,))
    repeated = [*META, ("T1", "Uno", "Tools", True, ts(1))]
    load(targets, tile, inter)
    spark.sql(f"TRUNCATE TABLE {targets.tile_metadata}")
    make_meta(repeated).write.insertInto(targets.tile_metadata)
    report = published.run_published(spark, [D1], targets)
    want = {r.check_name: r.violations for r in Q.dq_report(spark.table(targets.daily_summary), make_meta(repeated)).collect()}
    logged = {r.check_name: r for r in spark.table(targets.quality_log).collect()}
    got = {k: r.violations for k, r in logged.items()}
    assert got.pop("rows") == spark.table(targets.daily_summary).count()
    want.pop("null_date")  # refused by the write
    assert got == want and got["duplicate_metadata_tile_id"] == 1 and got["missing_metadata"] > 0
    assert {r.run_id for r in logged.values()} == {report.run_id} and not any(r.breached for r in logged.values())
    before = shown(spark, targets)
    load(targets, [("N", "U", "S", ts(1), "T9", "TILE_VIEW")], [], meta=None)
    with pytest.raises(QualityBreachError, match="missing_metadata"):
        published.run_published(spark, [D1], targets, JobOptions(quality_limits=(("missing_metadata", got["missing_metadata"]),)))
    assert shown(spark, targets) == before
    breach = spark.table(targets.quality_log).where("breached").collect()
    assert [(r.date, r.check_name, r.violations) for r in breach] == [(D1, "missing_metadata", got["missing_metadata"] + 1)]
    published.run_published(spark, [D1], targets, JobOptions(quality_limits=(("missing_metadata", 99), ("negative_counts", 0))))
    assert shown(spark, targets) != before
    with pytest.raises(ValueError, match="no such checks"):
        published.run_published(spark, [D1], targets, JobOptions(quality_limits=(("nonsense", 1),)))


def test_checks_without_metadata_or_rows(spark, targets, load):
    load(targets, [("E", "U", "S", ts(1), "T1", "TILE_VIEW")], [], meta=None)
    spark.sql(f"DROP TABLE {targets.tile_metadata}")
    report = published.run_published(spark, [D1, D2], targets)
    assert not report.metadata_available
    found = {(r.date, r.check_name): r.violations for r in report.checks}
    assert found[D1, "unknown_category"] == 1 and found[D1, "missing_metadata"] == 0
    assert {d for d, _ in found} == {D1, None} and {c for _, c in found} >= set(CHECKS)


# ------------------------------------------------------------------ late events


def test_flags_give_the_summary(spark, make_tile, make_inter):
    tile, inter = random_events(random.Random(5), 150)
    t, i = make_tile(tile), make_inter(inter)
    want = rows(M.daily_summary(t, i))
    assert rows(U.summary_of(U.event_flags(t, i))) == want
    halves = [U.merged(U.event_flags(t.where(c), i.where(c))) for c in ("event_id < 'E5' or event_id > 'IE5'", "true")]
    assert rows(U.summary_of(halves[0].unionByName(halves[1]).unionByName(halves[1]))) == want
    assert rows(U.summary_of(U.event_flags(t.limit(0), i.limit(0)))) == []


def test_late_events_never_read_the_old_ones(spark, targets, make_tile, make_inter, make_meta):
    published.create_published(spark, targets, state=True)
    refresh_dimension(spark, make_meta(META), targets.tile_metadata)
    for t in (targets.tile_events, targets.interstitial_events):
        spark.sql(f"DROP TABLE {t}")  # nothing can read them
    tile, inter = random_events(random.Random(6), 90)
    parts = [(tile[:60], inter[:60]), (tile[60:], inter[60:]), (tile[60:], inter[60:])]
    for t, i in parts:
        published.apply_events(spark, make_tile(t), make_inter(i), targets)
    from tilepulse.operators import enrich as E
    from tilepulse.operators import kpis as K

    summary = M.daily_summary(make_tile(tile), make_inter(inter))
    want = E.enrich(summary, E.prepare_metadata(make_meta(META)))
    cols = spark.table(targets.daily_summary).columns
    assert shown(spark, targets)[0] == rows(want.select(*cols))
    assert rows(spark.table(targets.global_kpis)) == rows(K.global_kpis(summary).select(*spark.table(targets.global_kpis).columns))
    # a failed load shows nothing, also not in the state
    held = rows(spark.table(targets.user_flags))
    with pytest.raises(Boom):
        late = [("Z", "U9", "S", ts(3), "T1", "TILE_CLICK")]
        published.apply_events(spark, make_tile(late), make_inter([]), targets, on_step=boom_at("kpis staged"))
    assert rows(spark.table(targets.user_flags)) == held
    # one load a day after compaction; the same counts
    assert published.compact_flags(spark, targets) == [D1, D2, D3]
    assert rows(spark.table(targets.user_flags)) == rows(U.merged(spark.createDataFrame(held, U.USER_FLAGS.schema)))
    assert published.compact_flags(spark, targets) == []
    assert V.vacuum(spark, targets.manifest, targets.user_flags, history=0) == 10
    assert shown(spark, targets)[0] == rows(want.select(*cols))
    assert published.apply_events(spark, make_tile([]), make_inter([]), targets).seq == 0


def test_a_full_run_replaces_the_state(spark, targets, load, make_tile, make_inter):
    published.create_published(spark, targets, state=True)
    tile, inter = random_events(random.Random(7), 50)
    load(targets, tile, inter)
    published.run_published(spark, [D1, D2, D3], targets)
    once = rows(spark.table(targets.user_flags))
    published.run_published(spark, [D1, D2, D3], targets)
    assert rows(spark.table(targets.user_flags)) == once
    summary = M.daily_summary(make_tile(tile), make_inter(inter))
    assert rows(spark.table(targets.daily_summary).select(*summary.columns)) == rows(summary)


# ------------------------------------------------------------------ enforced day


def test_wrong_days_are_kept_apart(spark, sandbox, make_tile, make_inter, make_meta):
    loading.create_checked_sources(spark, sandbox)
    diff = Q.table_conformance(spark, sandbox.tile_events, S.SPECS["tile_events"].schema)
    assert diff.ok, diff.describe()
    good = make_tile([("E1", "U1", "S", ts(23, 59), "T1", "TILE_VIEW")])
    odd = make_tile([("E2", "U2", "S", ts(0), "T1", "TILE_VIEW"), ("E3", "U3", "S", None, "T1", "TILE_VIEW"), ("E4", "U4", "S", ts(5), "T1", "TILE_CLICK")])
    day = F.when(F.col("event_id") == "E2", F.lit(D2)).when(F.col("event_id") == "E4", F.lit(None)).otherwise(F.lit(D1))
    rowset = good.withColumn("event_date", F.lit(D1)).unionByName(odd.withColumn("event_date", day))
    counts = loading.load_checked(spark, rowset, make_inter([]), sandbox)
    assert counts[sandbox.tile_events] == {"ok": 2, "no_timestamp": 1, "wrong_day": 1}
    assert counts[sandbox.interstitial_events] == {"ok": 0, "no_timestamp": 0, "wrong_day": 0}
    assert rows(spark.table(sandbox.tile_events).select("event_id", "event_date")) == [("E1", D1), ("E4", D1)]
    aside = spark.table(loading.quarantine(sandbox.tile_events)).select("event_id", "event_date", "reason")
    assert rows(aside) == [("E2", D2, "wrong_day"), ("E3", D1, "no_timestamp")]
    # a load without days gets them, and adds to the table
    loading.load_checked(spark, make_tile([("E5", "U5", "S", ts(7, day=D2), "T2", "TILE_VIEW")]), make_inter([]), sandbox)
    assert spark.table(sandbox.tile_events).count() == 3
    published.create_published(spark, sandbox)
    refresh_dimension(spark, make_meta(META), sandbox.tile_metadata)
    published.run_published(spark, [D1, D2], sandbox)
    got = spark.table(sandbox.daily_summary).select("date", "tile_id", "unique_tile_views", "unique_tile_clicks")
    assert rows(got) == [(D1, "T1", 1, 1), (D2, "T2", 1, 0)]


def test_the_day_is_that_of_the_tables_zone(spark, sandbox, make_tile, make_inter):
    loading.create_checked_sources(spark, sandbox, zone="America/New_York")
    late = make_tile([("E1", "U", "S", ts(3), "T1", "TILE_VIEW"), ("E2", "U", "S", ts(12), "T1", "TILE_VIEW")])
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            loading.load_checked(spark, late.withColumn("app_version", F.lit(zone)), make_inter([]), sandbox)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    got = rows(spark.table(sandbox.tile_events).select("event_id", "event_date").distinct())
    assert got == [("E1", D1 - dt.timedelta(days=1)), ("E2", D1)]  # 22:00 of the day before in New York


def test_a_load_that_fails_shows_neither_table(spark, sandbox, make_tile, make_inter):
    loading.create_checked_sources(spark, sandbox)
    tile = make_tile([("E1", "U", "S", ts(3), "T1", "TILE_VIEW")])
    inter = make_inter([("I1", "U", "S", ts(3), "T1", True, False, False)])
    bad = inter.withColumn("user_id", F.raise_error(F.lit("unreadable")))
    with pytest.raises(Exception, match="unreadable"):
        loading.load_checked(spark, tile, bad, sandbox)
    assert spark.table(sandbox.tile_events).count() == 0
    loading.load_checked(spark, tile, inter, sandbox)
    assert spark.table(sandbox.tile_events).count() == spark.table(sandbox.interstitial_events).count() == 1


# ------------------------------------------------------------------ key-level reconciliation


def test_reconcile_keys(spark):
    schema = "date date, tile_id string, n long, name string"
    old = [(D1, "A", 1, "x"), (D1, "B", 2, None), (D1, None, 3, "z"), (D1, "C", 4, "c"), (D1, "C", 4, "c"), (D1, "C", 5, "c")]
    new = [(D1, "A", 1, "x"), (D1, "B", 2, "y"), (D1, None, 4, "z"), (D1, "C", 4, "c"), (D1, "C", 7, "c"), (D2, "D", 1, None)]
    got = Q.reconcile_keys(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema))
    assert got.columns == ["date", "tile_id", "occurrence", "kind", "metric", "before", "after"]
    assert rows(got) == sorted([
        (D1, "B", 1, "changed", "name", None, "y"),
        (D1, None, 1, "changed", "n", "3", "4"),
        (D1, "C", 1, "changed", "n", "4", "7"),
        (D1, "C", 2, "lost", "n", "5", None),
        (D1, "C", 2, "lost", "name", "c", None),
        (D2, "D", 1, "added", "n", None, "1"),
        (D2, "D", 1, "added", "name", None, None),
    ], key=str)
    same = spark.createDataFrame(old, schema)
    assert Q.reconcile_keys(same, same).collect() == []
    assert Q.reconcile_keys(same, same.limit(0), columns=["n"]).count() == len(old)
