"""Sinks, DDL, schema evolution and rollback, the whole job (FIXTURES.md X10, X11; SURVEY §5.1)."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import DAY, ts
from tilepulse import evolve
from tilepulse.config import JobOptions
from tilepulse.operators import quality as Q
from tilepulse.plans import daily
from tilepulse.sinks import DuplicateKeyError, overwrite_dates, overwrite_partition, refresh_dimension
from tilepulse.sources import schemas as S

D1, D2 = DAY, DAY + dt.timedelta(days=1)
META = [("TILE_001", "Alpha meter", "Tools", True), ("TILE_002", "Beta board", "Games", True)]


def summary_rows(spark, table):
    return sorted(tuple(r) for r in spark.table(table).select("date", "tile_id", "unique_tile_views").collect())


def small_summary(spark, day, tiles):
    return spark.createDataFrame(
        [(day, t, "n", "c", v, 0, 0, 0, 0) for t, v in tiles],
        "date date, tile_id string, tile_name string, tile_category string, unique_tile_views bigint, "
        "unique_tile_clicks bigint, unique_interstitial_views bigint, unique_interstitial_primary_clicks bigint, "
        "unique_interstitial_secondary_clicks bigint",
    )


def test_ddl_creates_registry_tables_with_comments(spark, sandbox):
    evolve.create_tables(spark, sandbox)
    for name, spec in (
        (sandbox.tile_events, S.SPECS["tile_events"]),
        (sandbox.tile_metadata, S.SPECS["tile_metadata"]),
        (sandbox.daily_summary, S.SPECS["daily_summary"]),
        (sandbox.global_kpis, S.SPECS["global_kpis"]),
    ):
        diff = Q.table_conformance(spark, name, spec.schema)
        assert diff.ok, diff.describe()
    parts = [c.name for c in spark.catalog.listColumns(sandbox.daily_summary) if c.isPartition]
    assert parts == ["date"]
    assert evolve.table_comment(spark, sandbox.global_kpis) == S.GLOBAL_KPIS_COMMENT
    evolve.create_tables(spark, sandbox)  # IF NOT EXISTS: second call is a no-op


def test_partition_replace_semantics(spark, sandbox):
    evolve.create_tables(spark, sandbox)
    t = sandbox.daily_summary
    overwrite_partition(spark, small_summary(spark, D1, [("A", 1), ("B", 2)]), t, D1)
    overwrite_partition(spark, small_summary(spark, D2, [("A", 5)]), t, D2)
    # re-run of D1 with new data replaces only D1
    overwrite_partition(spark, small_summary(spark, D1, [("C", 3)]), t, D1)
    assert summary_rows(spark, t) == [(D1, "C", 3), (D2, "A", 5)]
    # same input twice -> same table (idempotent)
    overwrite_partition(spark, small_summary(spark, D1, [("C", 3)]), t, D1)
    assert summary_rows(spark, t) == [(D1, "C", 3), (D2, "A", 5)]
    # column order of the result does not matter (BY NAME)
    df = small_summary(spark, D1, [("Z", 9)])
    overwrite_partition(spark, df.select(*reversed(df.columns)), t, D1)
    assert summary_rows(spark, t) == [(D1, "Z", 9), (D2, "A", 5)]
    # an empty result empties the date, other dates untouched
    overwrite_partition(spark, df.limit(0), t, D1)
    assert summary_rows(spark, t) == [(D2, "A", 5)]


def test_partition_replace_refuses_missing_columns(spark, sandbox):
    evolve.create_tables(spark, sandbox)
    df = small_summary(spark, D1, [("A", 1)]).drop("tile_name")
    with pytest.raises(ValueError):
        overwrite_partition(spark, df, sandbox.daily_summary, D1)


def test_range_replace_empties_dates_without_rows(spark, sandbox):
    evolve.create_tables(spark, sandbox)
    t = sandbox.daily_summary
    overwrite_partition(spark, small_summary(spark, D1, [("A", 1)]), t, D1)
    overwrite_partition(spark, small_summary(spark, D2, [("B", 2)]), t, D2)
    d3 = D2 + dt.timedelta(days=1)
    overwrite_partition(spark, small_summary(spark, d3, [("K", 7)]), t, d3)
    emptied = overwrite_dates(spark, small_summary(spark, D2, [("B", 4), ("C", 1)]), t, [D1, D2])
    assert emptied == [D1]
    assert summary_rows(spark, t) == [(D2, "B", 4), (D2, "C", 1), (d3, "K", 7)]


def test_scd1_refresh(spark, sandbox, make_meta):
    evolve.create_tables(spark, sandbox)
    refresh_dimension(spark, make_meta(META), sandbox.tile_metadata)
    refresh_dimension(spark, make_meta(META[:1]), sandbox.tile_metadata)
    assert [r.tile_id for r in spark.table(sandbox.tile_metadata).collect()] == ["TILE_001"]
    with pytest.raises(DuplicateKeyError):
        refresh_dimension(spark, make_meta(META[:1] * 2), sandbox.tile_metadata)
    assert spark.table(sandbox.tile_metadata).count() == 1
    with pytest.raises(ValueError, match="empty"):
        refresh_dimension(spark, make_meta([]), sandbox.tile_metadata)
    bad = make_meta(META).withColumn("tile_name", F.when(F.col("tile_id") == "TILE_002", F.raise_error(F.lit("boom"))).otherwise(F.col("tile_name")))
    with pytest.raises(Exception, match="boom"):
        refresh_dimension(spark, bad, sandbox.tile_metadata)
    assert [r.tile_id for r in spark.table(sandbox.tile_metadata).collect()] == ["TILE_001"]
    assert refresh_dimension(spark, make_meta([]), sandbox.tile_metadata, allow_empty=True) == 0


def test_evolution_and_rollback_round_trip(spark, sandbox):
    evolve.create_tables(spark, sandbox, enriched=False)
    t = sandbox.daily_summary
    old = small_summary(spark, D1, [("A", 1)]).drop("tile_name", "tile_category")
    overwrite_partition(spark, old, t, D1)
    assert evolve.add_columns(spark, t, S.SUMMARY_ADDED_COLUMNS) == ["tile_name", "tile_category"]
    assert evolve.add_columns(spark, t, S.SUMMARY_ADDED_COLUMNS) == []  # idempotent
    evolve.set_table_comment(spark, t, S.DAILY_SUMMARY_COMMENT_V11)
    overwrite_partition(spark, small_summary(spark, D2, [("B", 2)]), t, D2)
    rows = {r.date: (r.tile_name, r.tile_category) for r in spark.table(t).collect()}
    assert rows == {D1: (None, None), D2: ("n", "c")}  # no backfill (L7)
    fields = {f.name: f.metadata.get("comment") for f in spark.table(t).schema.fields}
    assert fields["tile_category"] == "Business category classification of the tile"
    assert evolve.table_comment(spark, t) == S.DAILY_SUMMARY_COMMENT_V11
    evolve.rollback_columns(spark, t, ["tile_name", "tile_category"], comment=S.DAILY_SUMMARY_COMMENT_V1)
    assert set(spark.table(t).columns) == set(S.DAILY_SUMMARY_V1.fieldNames())
    assert summary_rows(spark, t) == [(D1, "A", 1), (D2, "B", 2)]
    assert evolve.table_comment(spark, t) == S.DAILY_SUMMARY_COMMENT_V1
    assert [c.name for c in spark.catalog.listColumns(t) if c.isPartition] == ["date"]


def test_drop_needs_confirmation(spark, sandbox):
    evolve.create_tables(spark, sandbox)
    assert not evolve.drop_table(spark, sandbox.tile_metadata)
    assert spark.catalog.tableExists(sandbox.tile_metadata)
    assert evolve.drop_table(spark, sandbox.tile_metadata, confirm=True)
    assert not spark.catalog.tableExists(sandbox.tile_metadata)


def load(spark, sandbox, make_tile, make_inter, make_meta, tile, inter, meta=META):
    evolve.create_tables(spark, sandbox)
    daily.load_sources(spark, make_tile(tile), make_inter(inter), make_meta(meta) if meta is not None else None, sandbox)


TILE = [
    ("E1", "U1", "S1", ts(8), "TILE_001", "TILE_VIEW", "Mobile", "1.0"),
    ("E2", "U2", "S2", ts(8, 5), "TILE_001", "TILE_CLICK", "Mobile", "1.0"),
    ("E3", "U3", "S3", ts(9), "TILE_009", "TILE_VIEW", "Web", "1.1"),
    ("E4", "U3", "S3", ts(9, day=D2), "TILE_002", "TILE_VIEW", "Web", "1.1"),
]
INTER = [("IE1", "U1", "S1", ts(8, 10), "TILE_001", True, True, False)]


def test_run_daily_end_to_end(spark, sandbox, make_tile, make_inter, make_meta):
    load(spark, sandbox, make_tile, make_inter, make_meta, TILE, INTER)
    rep = daily.run_daily(spark, D1, sandbox)
    assert rep.metadata_available and rep.missing_metadata_tiles == 1
    rows = {r.tile_id: r for r in spark.table(sandbox.daily_summary).collect()}
    assert set(rows) == {"TILE_001", "TILE_009"}
    assert (rows["TILE_009"].tile_name, rows["TILE_009"].tile_category) == ("Unknown Tile", "UNKNOWN")
    k = spark.table(sandbox.global_kpis).collect()
    assert [(r.date, r.total_tile_views, r.total_tile_clicks, r.overall_ctr) for r in k] == [(D1, 2, 1, 0.5)]
    # re-run is idempotent
    daily.run_daily(spark, D1, sandbox)
    assert spark.table(sandbox.daily_summary).count() == 2
    assert spark.table(sandbox.global_kpis).count() == 1
    # events of the date disappear -> the date is emptied in both targets, D2 untouched
    daily.run_daily(spark, D2, sandbox)
    spark.sql(f"TRUNCATE TABLE {sandbox.tile_events} PARTITION (event_date = DATE '{D1}')")
    spark.sql(f"TRUNCATE TABLE {sandbox.interstitial_events} PARTITION (event_date = DATE '{D1}')")
    rep = daily.run_daily(spark, D1, sandbox)
    assert rep.emptied_dates == [D1]
    assert [r.date for r in spark.table(sandbox.daily_summary).collect()] == [D2]
    assert [r.date for r in spark.table(sandbox.global_kpis).collect()] == [D2]


def test_run_daily_without_metadata_table(spark, sandbox, make_tile, make_inter, make_meta):
    load(spark, sandbox, make_tile, make_inter, make_meta, TILE, INTER, meta=None)
    spark.sql(f"DROP TABLE {sandbox.tile_metadata}")
    rep = daily.run_daily(spark, D1, sandbox)  # X11: completes, everything UNKNOWN
    assert not rep.metadata_available
    cats = {r.tile_category for r in spark.table(sandbox.daily_summary).collect()}
    assert cats == {"UNKNOWN"}


def test_run_daily_zero_fill_and_duplicate_metadata(spark, sandbox, make_tile, make_inter, make_meta):
    meta = META + [("TILE_002", "Newer", "Health", True, ts(23))]
    load(spark, sandbox, make_tile, make_inter, make_meta, TILE, INTER, meta=None)
    spark.createDataFrame([m if len(m) == 5 else m + (ts(0),) for m in meta], S.TILE_METADATA).write.insertInto(
        sandbox.tile_metadata
    )
    from tilepulse.operators.enrich import DuplicateMetadataError

    with pytest.raises(DuplicateMetadataError):
        daily.run_daily(spark, D1, sandbox, JobOptions(on_duplicate_metadata="fail"))
    assert spark.table(sandbox.daily_summary).count() == 0  # checked before anything is written
    daily.run_daily(spark, D1, sandbox, JobOptions(zero_fill=True))
    rows = {r.tile_id: r for r in spark.table(sandbox.daily_summary).collect()}
    assert set(rows) == {"TILE_001", "TILE_002", "TILE_009"}
    assert rows["TILE_002"].tile_name == "Newer" and rows["TILE_002"].unique_tile_views == 0
    k = spark.table(sandbox.global_kpis).first()
    assert (k.total_tile_views, k.total_tile_clicks) == (2, 1)


def test_run_range_equals_daily_runs(spark, sandbox, make_tile, make_inter, make_meta):
    load(spark, sandbox, make_tile, make_inter, make_meta, TILE, INTER)
    d3 = D2 + dt.timedelta(days=1)
    daily.run_range(spark, D1, d3, sandbox)
    ranged_s = sorted(tuple(r) for r in spark.table(sandbox.daily_summary).collect())
    ranged_k = sorted(tuple(r) for r in spark.table(sandbox.global_kpis).collect())
    for d in (D1, D2, d3):
        daily.run_daily(spark, d, sandbox)
    assert sorted(tuple(r) for r in spark.table(sandbox.daily_summary).collect()) == ranged_s
    assert sorted(tuple(r) for r in spark.table(sandbox.global_kpis).collect()) == ranged_k


def test_v1_target_without_enrichment(spark, sandbox, make_tile, make_inter, make_meta):
    evolve.create_tables(spark, sandbox, enriched=False)
    daily.load_sources(spark, make_tile(TILE), make_inter(INTER), make_meta(META), sandbox)
    daily.run_daily(spark, D1, sandbox, JobOptions(enrich=False))
    assert "tile_category" not in spark.table(sandbox.daily_summary).columns
    assert spark.table(sandbox.daily_summary).count() == 2


def test_partition_pruning_on_event_date(spark, sandbox, make_tile, make_inter, make_meta):
    load(spark, sandbox, make_tile, make_inter, make_meta, TILE, INTER)
    from tilepulse.sources.catalog import scan_events

    df = scan_events(spark, sandbox.tile_events, D1)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "event_date" in plan
    assert df.count() == 3
    assert df.filter(F.col("event_date") != F.lit(D1)).count() == 0


def test_failed_write_keeps_old_date(spark, sandbox):
    evolve.create_tables(spark, sandbox)
    t = sandbox.daily_summary
    overwrite_partition(spark, small_summary(spark, D1, [("A", 1)]), t, D1)
    bad = small_summary(spark, D1, [("B", 2)]).withColumn(
        "unique_tile_views", F.when(F.col("tile_id") == "B", F.raise_error(F.lit("boom"))).cast("bigint")
    )
    with pytest.raises(Exception, match="boom"):
        overwrite_partition(spark, bad, t, D1)
    assert summary_rows(spark, t) == [(D1, "A", 1)]


def test_replace_ignores_callers_overwrite_mode(spark, sandbox):
    evolve.create_tables(spark, sandbox)
    t = sandbox.daily_summary
    overwrite_partition(spark, small_summary(spark, D1, [("A", 1)]), t, D1)
    overwrite_partition(spark, small_summary(spark, D2, [("B", 2)]), t, D2)
    key = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(key, "dynamic")
    try:
        overwrite_partition(spark, small_summary(spark, D1, []), t, D1)  # empty result must empty D1
        assert summary_rows(spark, t) == [(D2, "B", 2)]
        assert spark.conf.get(key) == "dynamic"
    finally:
        spark.conf.set(key, "static")


def test_missing_required_source_column_fails_clearly(spark, sandbox, make_tile, make_inter, make_meta):
    load(spark, sandbox, make_tile, make_inter, make_meta, TILE, INTER)
    spark.sql(f"DROP TABLE {sandbox.tile_events}")
    spark.sql(f"CREATE TABLE {sandbox.tile_events} (event_id STRING, user_id STRING, event_ts TIMESTAMP, tile_id STRING) USING parquet")
    from tilepulse.operators.quality import SchemaDriftError

    with pytest.raises(SchemaDriftError, match="event_type"):
        daily.run_daily(spark, D1, sandbox)


def test_metadata_drift_degrades_to_unknown(spark, sandbox, make_tile, make_inter, make_meta, caplog):
    load(spark, sandbox, make_tile, make_inter, make_meta, TILE, INTER, meta=None)
    spark.sql(f"DROP TABLE {sandbox.tile_metadata}")
    spark.sql(f"CREATE TABLE {sandbox.tile_metadata} (tile_id STRING, tile_name STRING, is_active BOOLEAN) USING parquet")
    import logging

    with caplog.at_level(logging.ERROR, logger="tilepulse.plans.daily"):
        rep = daily.run_daily(spark, D1, sandbox)
    assert not rep.metadata_available
    assert "tile_category" in caplog.text
    assert {r.tile_category for r in spark.table(sandbox.daily_summary).collect()} == {"UNKNOWN"}


def test_target_lacking_result_columns_is_refused(spark, sandbox):
    evolve.create_tables(spark, sandbox, enriched=False)
    with pytest.raises(ValueError, match="tile_name"):
        overwrite_partition(spark, small_summary(spark, D1, [("A", 1)]), sandbox.daily_summary, D1)
    assert spark.table(sandbox.daily_summary).count() == 0


def test_in_memory_sources_are_typed(spark):
    from pyspark.sql import Row

    from tilepulse.sources.memory import from_rows

    empty = from_rows(spark, [], "interstitial_events")
    assert empty.count() == 0 and empty.schema == S.INTERSTITIAL_EVENTS
    rows = [
        ("E1", "U1", "S1", ts(9), "T1", "TILE_VIEW", "Mobile", "1.0"),
        {"event_id": "E2", "user_id": "U2", "event_ts": "2025-12-01 09:05:00", "tile_id": "T1", "event_type": "TILE_CLICK"},
        Row(event_id="E3", user_id="U3", session_id="S3", event_ts="2025-12-01 09:10:00", tile_id="T2",
            event_type="TILE_VIEW", device_type="Web", app_version="1.0"),
    ]
    df = from_rows(spark, rows, "tile_events")
    assert df.schema == S.TILE_EVENTS
    got = sorted((r.event_id, r.event_ts, r.session_id) for r in df.collect())
    assert got == [("E1", ts(9), "S1"), ("E2", ts(9, 5), None), ("E3", ts(9, 10), "S3")]
    with pytest.raises(ValueError):
        from_rows(spark, [{"bogus": 1}], "tile_events")


def test_cli_one_date_and_range(spark, sandbox, make_tile, make_inter, make_meta):
    from tilepulse import cli

    load(spark, sandbox, make_tile, make_inter, make_meta, TILE, INTER)
    src, tgt = sandbox.tile_events.split(".")[0], sandbox.daily_summary.split(".")[0]
    out = cli.main(["--date", D1.isoformat(), "--source-db", src, "--target-db", tgt], spark=spark)
    assert out["dates"] == [D1.isoformat()] and out["missing_metadata_tiles"] == 1
    assert spark.table(sandbox.daily_summary).count() == 2
    out = cli.main(["--start", D1.isoformat(), "--end", D2.isoformat(), "--source-db", src, "--target-db", tgt], spark=spark)
    assert out["dates"] == [D1.isoformat(), D2.isoformat()]
    assert sorted(r.date for r in spark.table(sandbox.global_kpis).collect()) == [D1, D2]
    out = cli.main(["--dates", f"{D2.isoformat()}, {D1.isoformat()}", "--source-db", src, "--target-db", tgt], spark=spark)
    assert out["dates"] == [D1.isoformat(), D2.isoformat()]
    with pytest.raises(SystemExit):
        cli.parse(["--start", D1.isoformat()])


def test_category_only_target(spark, sandbox, make_tile, make_inter, make_meta):
    evolve.create_tables(spark, sandbox, summary="daily_summary_category")
    daily.load_sources(spark, make_tile(TILE), make_inter(INTER), make_meta(META), sandbox)
    daily.run_daily(spark, D1, sandbox, JobOptions(label_columns=("tile_category",)))
    t = spark.table(sandbox.daily_summary)
    assert "tile_name" not in t.columns
    assert {r.tile_id: r.tile_category for r in t.collect()} == {"TILE_001": "Tools", "TILE_009": "UNKNOWN"}
    assert Q.table_conformance(spark, sandbox.daily_summary, S.DAILY_SUMMARY_CATEGORY).ok


def test_range_write_makes_one_file_per_small_date(spark, sandbox):
    import glob

    evolve.create_tables(spark, sandbox)
    t = sandbox.daily_summary
    days = [D1 + dt.timedelta(days=k) for k in range(5)]
    rows = [small_summary(spark, d, [(f"T{i}", i) for i in range(20)]) for d in days]
    df = rows[0]
    for r in rows[1:]:
        df = df.unionByName(r)
    overwrite_dates(spark, df.repartition(8), t, days)
    loc = [r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {t}").collect() if r.col_name == "Location"][0]
    for d in days:
        files = glob.glob(f"{loc.replace('file:', '')}/date={d.isoformat()}/*.parquet")
        assert len(files) == 1, (d, files)
    assert spark.table(t).count() == 100


def test_multi_date_scan_prunes_partitions(spark, sandbox, make_tile, make_inter, make_meta):
    load(spark, sandbox, make_tile, make_inter, make_meta, TILE, INTER)
    from tilepulse.functions.columns import date_lit

    df = spark.table(sandbox.tile_events).filter(F.col("event_date").isin([date_lit(D2), date_lit(D2 + dt.timedelta(days=1))]))
    jvm = spark.sparkContext._jvm
    plan = jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [" in plan
    assert "event_date" in plan.split("PartitionFilters: [", 1)[1].split("]")[0]
    assert [r.event_id for r in df.collect()] == ["E4"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_no_event_is_lost_under_another_session_zone(spark, sandbox, make_tile, make_inter, make_meta, zone):
    """Loaded under UTC, run under any zone: one run a date and one range give the same rows."""
    near = [("N1", "U7", "S", ts(0, 10), "TILE_001", "TILE_VIEW"), ("N2", "U8", "S", ts(23, 50), "TILE_001", "TILE_VIEW")]
    load(spark, sandbox, make_tile, make_inter, make_meta, TILE + near, INTER)
    days = [D1 + dt.timedelta(days=k) for k in range(-1, 3)]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for d in days:
            daily.run_daily(spark, d, sandbox)
        one = summary_rows(spark, sandbox.daily_summary)
        daily.run_range(spark, days[0], days[-1], sandbox)
        assert summary_rows(spark, sandbox.daily_summary) == one
        assert sum(r[2] for r in one) == 5  # every viewer of every tile and day
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def jobs_of(spark, work) -> int:
    sc = spark.sparkContext
    group = f"count-{uuid.uuid4().hex}"  # an id() may be that of an earlier call
    sc.setJobGroup(group, "")
    try:
        work()
        return len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_empty_dates_cost_no_jobs(spark, sandbox, make_tile, make_inter, make_meta):
    load(spark, sandbox, make_tile, make_inter, make_meta, TILE, INTER)
    run = lambda days: jobs_of(spark, lambda: daily.run_range(spark, D1, D1 + dt.timedelta(days=days), sandbox))
    run(3)
    few, many = run(10), run(1000)
    assert many <= few
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {sandbox.daily_summary}").collect()] == [f"date={D1}", f"date={D2}"]


def test_zero_fill_over_a_range_leaves_the_kpis(spark, sandbox, make_tile, make_inter, make_meta):
    load(spark, sandbox, make_tile, make_inter, make_meta, TILE, INTER)
    d3 = D2 + dt.timedelta(days=1)
    daily.run_range(spark, D1, d3, sandbox)
    plain = sorted(map(tuple, spark.table(sandbox.global_kpis).collect()))
    daily.run_range(spark, D1, d3, sandbox, JobOptions(zero_fill=True))
    rows = {(r.date, r.tile_id): r.unique_tile_views for r in spark.table(sandbox.daily_summary).collect()}
    want = {(d, t): 0 for d in (D1, D2, d3) for t in ("TILE_001", "TILE_002")}
    assert rows == {**want, (D1, "TILE_001"): 1, (D1, "TILE_009"): 1, (D2, "TILE_002"): 1}
    assert sorted(map(tuple, spark.table(sandbox.global_kpis).collect())) == plain
    daily.run_daily(spark, d3, sandbox, JobOptions(zero_fill=True))  # a date without events
    assert sorted(map(tuple, spark.table(sandbox.global_kpis).collect())) == plain


def test_v1_job_never_reads_the_metadata(spark, sandbox, make_tile, make_inter, make_meta):
    evolve.create_tables(spark, sandbox, enriched=False)
    daily.load_sources(spark, make_tile(TILE), make_inter(INTER), None, sandbox)
    make_meta(META * 2).write.insertInto(sandbox.tile_metadata)
    rep = daily.run_daily(spark, D1, sandbox, JobOptions(enrich=False, on_duplicate_metadata="fail"))
    assert not rep.metadata_available and spark.table(sandbox.daily_summary).count() == 2


def test_metadata_of_another_type_degrades(spark, sandbox, make_tile, make_inter, make_meta):
    load(spark, sandbox, make_tile, make_inter, make_meta, TILE, INTER, meta=None)
    spark.sql(f"DROP TABLE {sandbox.tile_metadata}")
    make_meta(META).withColumn("is_active", F.lit("yes")).write.saveAsTable(sandbox.tile_metadata)
    rep = daily.run_daily(spark, D1, sandbox)
    assert not rep.metadata_available
    assert {r.tile_category for r in spark.table(sandbox.daily_summary).collect()} == {"UNKNOWN"}


def test_unreadable_metadata_degrades(spark, sandbox, make_tile, make_inter, make_meta):
    import os

    load(spark, sandbox, make_tile, make_inter, make_meta, TILE, INTER)
    loc = [r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {sandbox.tile_metadata}").collect() if r.col_name == "Location"][0]
    with open(os.path.join(loc.removeprefix("file:"), "part-broken.parquet"), "wb") as f:
        f.write(b"not parquet")
    spark.catalog.refreshTable(sandbox.tile_metadata)
    rep = daily.run_daily(spark, D1, sandbox)
    assert not rep.metadata_available
    assert {r.tile_category for r in spark.table(sandbox.daily_summary).collect()} == {"UNKNOWN"}


def test_null_tiles_can_be_dropped(spark, sandbox, make_tile, make_inter, make_meta):
    load(spark, sandbox, make_tile, make_inter, make_meta, TILE + [("E8", "U8", "S", ts(9), None, "TILE_VIEW")], INTER)
    daily.run_daily(spark, D1, sandbox)
    assert spark.table(sandbox.daily_summary).where("tile_id IS NULL").count() == 1
    daily.run_daily(spark, D1, sandbox, JobOptions(drop_null_tiles=True))
    assert spark.table(sandbox.daily_summary).where("tile_id IS NULL").count() == 0


def test_every_date_of_a_result_is_replaced(spark, sandbox):
    evolve.create_tables(spark, sandbox)
    t = sandbox.daily_summary
    overwrite_partition(spark, small_summary(spark, D2, [("OLD", 1)]), t, D2)
    assert overwrite_dates(spark, small_summary(spark, D1, [("A", 1)]), t, None) == []
    assert summary_rows(spark, t) == [(D1, "A", 1), (D2, "OLD", 1)]
    with pytest.raises(Exception, match="no date"):
        overwrite_dates(spark, small_summary(spark, None, [("A", 1)]), t, None)


def test_work_folder_of_a_cluster_must_be_named(spark, monkeypatch):
    from tilepulse import session

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: "yarn" if key == "spark.master" else default)

        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.work_dir(Cluster())


def test_cli_options(spark, sandbox, make_tile, make_inter, make_meta):
    from tilepulse import cli

    load(spark, sandbox, make_tile, make_inter, make_meta, TILE, INTER, meta=None)
    spark.createDataFrame(
        [m + (ts(0),) for m in META] + [("TILE_002", "Newer", "Health", True, ts(23))], S.TILE_METADATA
    ).write.insertInto(sandbox.tile_metadata)
    src, tgt = sandbox.tile_events.split(".")[0], sandbox.daily_summary.split(".")[0]
    base = ["--date", D1.isoformat(), "--source-db", src, "--target-db", tgt]
    from tilepulse.operators.enrich import DuplicateMetadataError

    with pytest.raises(DuplicateMetadataError):
        cli.main(base + ["--on-duplicate-metadata", "fail"], spark=spark)
    cli.main(base + ["--zero-fill", "--distinct-method", "count_distinct"], spark=spark)
    rows = {r.tile_id: r for r in spark.table(sandbox.daily_summary).collect()}
    assert set(rows) == {"TILE_001", "TILE_002", "TILE_009"} and rows["TILE_002"].tile_name == "Newer"
    assert spark.table(sandbox.global_kpis).first().total_tile_views == 2


def test_concurrent_replaces_in_one_session(spark, sandbox):
    from concurrent.futures import ThreadPoolExecutor

    evolve.create_tables(spark, sandbox)
    t = sandbox.daily_summary
    days = [D1 + dt.timedelta(days=k) for k in range(4)]
    for d in days:
        overwrite_partition(spark, small_summary(spark, d, [("OLD", 9)]), t, d)

    def job(k):
        d = days[k]
        df = small_summary(spark, d, [("NEW", k)]) if k % 2 == 0 else small_summary(spark, d, [])
        return overwrite_partition(spark, df, t, d)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(job, range(4)))
    assert summary_rows(spark, t) == [(days[0], "NEW", 0), (days[2], "NEW", 2)]


def test_load_sources_raises_errors_of_concurrent_writes(spark, sandbox, make_tile, make_inter, make_meta):
    evolve.create_tables(spark, sandbox)
    with pytest.raises(DuplicateKeyError):
        daily.load_sources(spark, make_tile(TILE), make_inter(INTER), make_meta(META * 2), sandbox)
    assert spark.table(sandbox.tile_events).count() == len(TILE)  # the other writes completed
    assert spark.table(sandbox.tile_metadata).count() == 0


def test_replace_with_known_present_dates(spark, sandbox):
    evolve.create_tables(spark, sandbox)
    t = sandbox.daily_summary
    for d in (D1, D2):
        overwrite_partition(spark, small_summary(spark, d, [("OLD", 1)]), t, d)
    emptied = overwrite_dates(spark, small_summary(spark, D2, [("NEW", 2)]), t, [D1, D2], present=[D2])
    assert emptied == [D1]
    assert summary_rows(spark, t) == [(D2, "NEW", 2)]
