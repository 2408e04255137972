"""Pointer tables: replaced in one step, undone, never seen half done."""

from __future__ import annotations

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from conftest import DAY, ts
from tilepulse import evolve, pointers
from tilepulse.config import JobOptions
from tilepulse.operators import enrich as E
from tilepulse.operators import quality as Q
from tilepulse.plans import daily
from tilepulse.sinks import DuplicateKeyError, refresh_dimension
from tilepulse.sources import schemas as S

META = [("T1", "One", "Tools", True), ("T2", "Two", "Games", True), ("T3", "Three", "Games", False)]


@pytest.fixture
def dimension(spark, sandbox):
    pointers.create_pointer(spark, sandbox.tile_metadata, S.SPECS["tile_metadata"])
    return sandbox.tile_metadata


def tiles(spark, table):
    return sorted((r.tile_id, r.tile_name) for r in spark.table(table).collect())


def test_refresh_undo_and_history(spark, dimension, make_meta):
    assert Q.table_conformance(spark, dimension, S.SPECS["tile_metadata"].schema).ok
    assert refresh_dimension(spark, make_meta(META), dimension) == 3
    first = tiles(spark, dimension)
    assert refresh_dimension(spark, make_meta(META[:1]), dimension) == 1
    assert tiles(spark, dimension) == first[:1]
    pointers.undo(spark, dimension)
    assert tiles(spark, dimension) == first
    for n in range(4):
        refresh_dimension(spark, make_meta([(f"N{n}", "n", "c", True)]), dimension)
    assert tiles(spark, dimension) == [("N3", "n")]
    assert len(pointers.generations(spark, dimension)) == 2  # the one shown and the one before
    assert pointers.undo(spark, dimension) and tiles(spark, dimension) == [("N2", "n")]
    with pytest.raises(ValueError, match="no earlier"):
        pointers.undo(spark, dimension)
    pointers.create_pointer(spark, dimension, S.SPECS["tile_metadata"])  # there already
    assert tiles(spark, dimension) == [("N2", "n")]


def test_a_refused_version_changes_nothing(spark, dimension, make_meta):
    refresh_dimension(spark, make_meta(META), dimension)
    before, held = tiles(spark, dimension), pointers.generations(spark, dimension)
    for df, error in (
        (make_meta([*META, META[0]]), DuplicateKeyError),
        (make_meta([]), ValueError),
        (make_meta(META).drop("tile_name"), ValueError),
        (make_meta(META).withColumn("tile_name", F.raise_error(F.lit("unreadable"))), Exception),
    ):
        with pytest.raises(error):
            refresh_dimension(spark, df, dimension)
        assert tiles(spark, dimension) == before
    assert refresh_dimension(spark, make_meta([]), dimension, allow_empty=True) == 0
    assert tiles(spark, dimension) == [] and pointers.generations(spark, dimension)[0] == held[-1]
    pointers.undo(spark, dimension)
    assert tiles(spark, dimension) == before


def test_readers_never_see_an_error_or_a_part(spark, sandbox, dimension, make_meta):
    """A reader beside refreshes and a rollback of columns."""
    wide = [(f"T{i}", "x", "c", True) for i in range(500)]
    summary = sandbox.daily_summary
    pointers.create_pointer(spark, summary, S.SPECS["daily_summary"])
    rows = spark.range(300).selectExpr(f"DATE'{DAY}' + CAST(id % 3 AS INT) AS date", "CAST(id AS STRING) AS tile_id", "'n' AS tile_name",
                                       "'c' AS tile_category", *[f"id AS {m}" for m in S.DAILY_SUMMARY_V1.fieldNames()[2:]])
    pointers.replace_table(spark, summary, rows)
    refresh_dimension(spark, make_meta(wide), dimension)
    seen, errors, done = set(), [], threading.Event()

    def read():
        while not done.is_set():
            try:
                seen.add((spark.table(dimension).count(), spark.table(summary).count()))
            except Exception as exc:
                errors.append(exc)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for n in range(3):
            refresh_dimension(spark, make_meta(wide if n % 2 else wide[:250]), dimension)
        evolve.rollback_columns(spark, summary, ["tile_name"])
        evolve.rollback_columns(spark, summary, ["tile_category"])
    finally:
        done.set()
        reader.join()
    assert not errors
    assert seen and {a for a, _ in seen} <= {250, 500} and {b for _, b in seen} == {300}


def test_rollback_and_undo_of_a_partitioned_table(spark, sandbox):
    t = sandbox.daily_summary
    pointers.create_pointer(spark, t, S.SPECS["daily_summary"])
    df = spark.createDataFrame([(DAY + dt.timedelta(days=n), "T1", "n", "c", n, 0, 0, 0, 0) for n in range(2)], S.DAILY_SUMMARY)
    pointers.replace_table(spark, t, df)
    evolve.rollback_columns(spark, t, ["TILE_NAME", "tile_category"], comment=S.DAILY_SUMMARY_COMMENT_V1)
    assert set(spark.table(t).columns) == set(S.DAILY_SUMMARY_V1.fieldNames())
    assert Q.table_conformance(spark, t, S.DAILY_SUMMARY_V1).ok
    assert pointers.spec_of(spark, t).partition_cols == ("date",) and pointers.spec_of(spark, t).comment == S.DAILY_SUMMARY_COMMENT_V1
    assert sorted(spark.table(t).select("unique_tile_views").collect()) == [(0,), (1,)]
    evolve.rollback_columns(spark, t, ["tile_name"])  # gone already
    pointers.undo(spark, t)
    assert sorted(map(tuple, spark.table(t).select(*df.columns).collect())) == sorted(map(tuple, df.collect()))
    with pytest.raises(ValueError, match="no pointer"):
        pointers.replace_table(spark, sandbox.global_kpis, df)


def test_the_job_reads_the_snapshot(spark, sandbox, dimension, make_meta, make_tile, make_inter, monkeypatch):
    evolve.create_tables(spark, sandbox)
    assert pointers.kept_labels(spark, dimension) is None  # nothing refreshed yet
    refresh_dimension(spark, make_meta(META), dimension)
    dim = pointers.kept_labels(spark, dimension)
    own = E.measure(E.prepare_metadata(make_meta(META)))
    assert (dim.rows, dim.est_bytes, dim.broadcast, dim.repeated_tiles) == (own.rows, own.est_bytes, True, 0)
    assert sorted(dim.joinable().collect()) == sorted(own.joinable().collect())
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10")
    try:
        assert pointers.kept_labels(spark, dimension).broadcast is False
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10MB")

    def measured(*a, **k):
        raise AssertionError("the snapshot is measured already")

    monkeypatch.setattr(E, "measure", measured)
    plan = E.enrich(make_summary(spark), dim)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    daily.load_sources(spark, make_tile([("E", "U", "S", ts(1), t, "TILE_VIEW") for t in ("T1", "T3")]), make_inter([]), None, sandbox)
    for options, cols in ((JobOptions(), ("tile_name", "tile_category")),):
        report = daily.run_daily(spark, DAY, sandbox, options)
        got = sorted(tuple(r) for r in spark.table(sandbox.daily_summary).select("tile_id", *cols).collect())
        assert got == [("T1", "One", "Tools"), ("T3", "Unknown Tile", "UNKNOWN")]
        assert report.metadata_rows == 2 and report.missing_metadata_tiles == 1


def make_summary(spark):
    return spark.createDataFrame([(DAY, "T1", 1, 0, 0, 0, 0)], S.DAILY_SUMMARY_V1)
