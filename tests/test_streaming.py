"""The re-run stream: new and late events re-run exactly their dates."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

from conftest import DAY, ts
from tilepulse import evolve
from tilepulse.plans import daily
from tilepulse.streaming.reruns import start_reruns

D1, D2 = DAY, DAY + dt.timedelta(days=1)
META = [("TILE_001", "Alpha meter", "Tools", True)]


def summary(spark, tables):
    return sorted((r.date, r.tile_id, r.unique_tile_views, r.unique_tile_clicks) for r in spark.table(tables.daily_summary).collect())


def test_stream_reruns_touched_dates(spark, sandbox, make_tile, make_inter, make_meta):
    evolve.create_tables(spark, sandbox)
    ckpt = os.path.join(tempfile.mkdtemp(prefix="tp-stream-"), "ckpt")
    daily.load_sources(
        spark, make_tile([("E1", "U1", "S", ts(8), "TILE_001", "TILE_VIEW")]), make_inter([]), make_meta(META), sandbox
    )
    start_reruns(spark, sandbox, checkpoint=ckpt).awaitTermination()
    assert summary(spark, sandbox) == [(D1, "TILE_001", 1, 0)]
    # a late event for D1 and a new one for D2 arrive
    late = [("E2", "U2", "S", ts(23, 59), "TILE_001", "TILE_CLICK"), ("E3", "U3", "S", ts(1, day=D2), "TILE_001", "TILE_VIEW")]
    daily.load_sources(spark, make_tile(late), make_inter([]), None, sandbox)
    start_reruns(spark, sandbox, checkpoint=ckpt).awaitTermination()
    assert summary(spark, sandbox) == [(D1, "TILE_001", 1, 1), (D2, "TILE_001", 1, 0)]
    kpis = sorted((r.date, r.total_tile_views, r.total_tile_clicks) for r in spark.table(sandbox.global_kpis).collect())
    assert kpis == [(D1, 1, 1), (D2, 1, 0)]
    # nothing new: the restarted query has nothing to do and changes nothing
    start_reruns(spark, sandbox, checkpoint=ckpt).awaitTermination()
    assert summary(spark, sandbox) == [(D1, "TILE_001", 1, 1), (D2, "TILE_001", 1, 0)]


def test_each_touched_date_runs_once_over_many_batches(spark, sandbox, make_tile, make_inter, make_meta, monkeypatch):
    from tilepulse.streaming import reruns

    evolve.create_tables(spark, sandbox)
    ckpt = os.path.join(tempfile.mkdtemp(prefix="tp-stream-"), "ckpt")
    for n in range(6):  # six files, one a batch
        day = (D1, D2)[n % 2]
        rows = make_tile([(f"E{n}", f"U{n}", "S", ts(8, n, day=day), "TILE_001", "TILE_VIEW")])
        daily.load_sources(spark, rows, make_inter([]), make_meta(META), sandbox)
    ran = []
    job = reruns.run_dates
    monkeypatch.setattr(reruns, "run_dates", lambda s, days, *a: (ran.extend(days), job(s, days, *a)))
    start_reruns(spark, sandbox, checkpoint=ckpt, max_files=1).awaitTermination()
    assert sorted(ran) == [D1, D2]
    assert summary(spark, sandbox) == [(D1, "TILE_001", 3, 0), (D2, "TILE_001", 3, 0)]
    start_reruns(spark, sandbox, checkpoint=ckpt, max_files=1).awaitTermination()
    assert len(ran) == 2
    # a crash between noting a day and running it: the day is still pending
    daily.load_sources(spark, make_tile([("L", "U9", "S", ts(9), "TILE_001", "TILE_VIEW")]), make_inter([]), None, sandbox)
    start_reruns(spark, sandbox, checkpoint=ckpt).query.awaitTermination()
    assert len(ran) == 2
    start_reruns(spark, sandbox, checkpoint=ckpt).awaitTermination()
    assert ran[2:] == [D1] and summary(spark, sandbox)[0] == (D1, "TILE_001", 4, 0)


def test_the_log_keeps_only_open_days(spark, sandbox, make_tile, make_inter, make_meta):
    """However many runs there were, one small generation is left to read."""
    from tilepulse.streaming import reruns

    evolve.create_tables(spark, sandbox)
    ckpt = os.path.join(tempfile.mkdtemp(prefix="tp-stream-"), "ckpt")
    name = reruns.log_table(sandbox, ckpt)
    for n in range(4):
        day = (D1, D2)[n % 2]
        rows = make_tile([(f"E{n}", f"U{n}", "S", ts(8, n, day=day), "TILE_001", "TILE_VIEW")])
        daily.load_sources(spark, rows, make_inter([]), make_meta(META), sandbox)
        start_reruns(spark, sandbox, checkpoint=ckpt).awaitTermination()
        assert spark.sql(f"SHOW PARTITIONS {name}").count() == 1
        assert spark.table(name).count() == 1 and len(spark.table(name).inputFiles()) == 1
    assert summary(spark, sandbox) == [(D1, "TILE_001", 2, 0), (D2, "TILE_001", 2, 0)]
    assert reruns.rerun_pending(spark, sandbox, daily.JobOptions(), ckpt) == []


def test_stream_folds_new_events_into_the_flags(spark, sandbox, make_tile, make_inter, make_meta):
    from tilepulse.plans import published
    from tilepulse.sources import schemas as S
    from tilepulse.streaming.reruns import start_merged

    published.create_published(spark, sandbox, state=True)
    for name in ("tile_events", "interstitial_events", "tile_metadata"):
        spark.sql(S.create_table_ddl(getattr(sandbox, name), S.SPECS[name]))
    ckpt = os.path.join(tempfile.mkdtemp(prefix="tp-stream-"), "ckpt")
    first = make_tile([("E1", "U1", "S", ts(8), "TILE_001", "TILE_VIEW"), ("E2", "U2", "S", ts(9), "TILE_001", "TILE_VIEW")])
    daily.load_sources(spark, first, make_inter([]), make_meta(META), sandbox)
    start_merged(spark, sandbox, checkpoint=ckpt).awaitTermination()
    assert summary(spark, sandbox) == [(D1, "TILE_001", 2, 0)]
    late = [("E3", "U2", "S", ts(23), "TILE_001", "TILE_VIEW"), ("E4", "U2", "S", ts(23), "TILE_001", "TILE_CLICK")]
    inter = make_inter([("I1", "U1", "S", ts(1, day=D2), "TILE_001", True, False, True)])
    daily.load_sources(spark, make_tile(late), inter, None, sandbox)
    start_merged(spark, sandbox, checkpoint=ckpt, max_files=1).awaitTermination()
    assert summary(spark, sandbox) == [(D1, "TILE_001", 2, 1), (D2, "TILE_001", 0, 0)]
    kpis = {r.date: r.total_secondary_clicks for r in spark.table(sandbox.global_kpis).collect()}
    assert kpis == {D1: 0, D2: 1}
    # the whole history replayed by a new checkpoint: every batch is folded in again, to no effect
    start_merged(spark, sandbox, checkpoint=ckpt + "-again").awaitTermination()
    assert summary(spark, sandbox) == [(D1, "TILE_001", 2, 1), (D2, "TILE_001", 0, 0)]
