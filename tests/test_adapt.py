"""Drifted sources read as the registry's tables."""

from __future__ import annotations

import datetime as dt

import pytest

from conftest import DAY, ts
from tilepulse import evolve
from tilepulse.config import JobOptions
from tilepulse.operators.quality import SchemaDriftError
from tilepulse.plans import daily
from tilepulse.sources import adapt
from tilepulse.sources import schemas as S


def inter_row(spark, **types):
    """One interstitial event with some columns of other types (value SQL by column)."""
    base = {
        "event_id": "'E'", "user_id": "'U'", "session_id": "'S'", "event_ts": f"TIMESTAMP'{DAY} 10:00:00'", "tile_id": "'T'",
        "interstitial_view_flag": "true", "primary_button_click_flag": "false", "secondary_button_click_flag": "CAST(NULL AS BOOLEAN)",
    }
    cols = {**base, **types}
    return spark.range(1).selectExpr(*[f"{v} AS `{k}`" for k, v in cols.items() if v is not None])


def test_registry_columns_pass_unchanged(spark):
    df, report = adapt.conform(inter_row(spark), "interstitial_events")
    assert df.schema.simpleString() == S.INTERSTITIAL_EVENTS.simpleString()
    assert {m.action for m in report} == {"same"}


@pytest.mark.parametrize(
    ("value", "want"),
    [("'Yes '", True), ("'N'", False), ("'TRUE'", True), ("'0'", False), ("1", True), ("0Y", False), ("CAST(NULL AS STRING)", None), ("CAST(NULL AS INT)", None)],
)
def test_flags_of_other_types(spark, value, want):
    df, report = adapt.conform(inter_row(spark, interstitial_view_flag=value), "interstitial_events")
    assert df.first()["interstitial_view_flag"] is want
    assert {m.action for m in report if m.column == "interstitial_view_flag"} == {"cast"}


@pytest.mark.parametrize(("column", "value"), [("interstitial_view_flag", "'maybe'"), ("interstitial_view_flag", "2"), ("event_ts", "'yesterday'")])
def test_a_value_without_a_reading_fails_the_query(spark, column, value):
    df, _ = adapt.conform(inter_row(spark, **{column: value}), "interstitial_events")
    with pytest.raises(Exception, match="no reading of"):
        df.collect()


@pytest.mark.parametrize(
    ("column", "value", "message"),
    [
        ("interstitial_view_flag", "1.0D", "double does not become boolean"),
        ("event_ts", "1764583200L", "bigint does not become timestamp"),
        ("user_id", "true", "boolean does not become string"),
        ("tile_id", "array('T')", "does not become string"),
        ("user_id", None, "required column missing: user_id"),
    ],
)
def test_unsafe_changes_fail_at_once(spark, column, value, message):
    with pytest.raises(SchemaDriftError, match=message):
        adapt.conform(inter_row(spark, **{column: value}), "interstitial_events")


def test_names_casts_and_report(spark):
    odd = {"USER_ID": "7", "user_id": None, "event_ts": None, "when": f"DATE'{DAY}'", "session_id": None, "event_date": f"DATE'{DAY}'", "junk": "1"}
    df, report = adapt.conform(inter_row(spark, **odd), "interstitial_events", {"When": "event_ts", "other": "tile_id"})
    row = df.first()
    assert (row.user_id, row.event_ts, row.session_id, row.event_date) == ("7", ts(0), None, DAY)
    assert df.columns == [*S.INTERSTITIAL_EVENTS.fieldNames(), "event_date"]
    actions = {m.column: m.action for m in report if m.action != "same"}
    assert actions == {"user_id": "cast", "event_ts": "renamed and cast", "session_id": "absent", "junk": "dropped"}
    with pytest.raises(SchemaDriftError, match="several aliases"):
        adapt.conform(inter_row(spark, tile_id=None, a="'x'", b="'y'"), "interstitial_events", {"a": "tile_id", "b": "tile_id"})
    own, _ = adapt.conform(inter_row(spark, a="'x'"), "interstitial_events", {"a": "tile_id"})
    assert own.first().tile_id == "T"  # its own name goes first
    with pytest.raises(ValueError, match="no column nowhere"):
        adapt.conform(inter_row(spark), "interstitial_events", {"a": "nowhere"})


def test_times_of_both_kinds(spark):
    for value in (f"TIMESTAMP_NTZ'{DAY} 10:00:00'", f"'{DAY} 10:00:00'", f"TIMESTAMP'{DAY} 10:00:00'"):
        df, _ = adapt.conform(inter_row(spark, event_ts=value), "interstitial_events")
        assert df.first().event_ts == ts(10)


def test_the_job_refuses_or_fails_before_it_writes(spark, sandbox, make_tile, make_inter, make_meta):
    evolve.create_tables(spark, sandbox)
    daily.load_sources(spark, make_tile([("E", "U", "S", ts(1), "T", "TILE_VIEW")]), make_inter([]), make_meta([("T", "n", "c", True)]), sandbox)
    daily.run_daily(spark, DAY, sandbox)
    before = spark.table(sandbox.daily_summary).collect()
    options = JobOptions(adapt_sources=True)
    for value, error in (("'maybe'", "no reading of"), ("1.5D", "does not become boolean")):
        spark.sql(f"DROP TABLE {sandbox.interstitial_events}")
        inter_row(spark, interstitial_view_flag=value).write.format("parquet").saveAsTable(sandbox.interstitial_events)
        with pytest.raises(Exception, match=error):
            daily.run_daily(spark, DAY, sandbox, options)
        assert spark.table(sandbox.daily_summary).collect() == before
    spark.sql(f"DROP TABLE {sandbox.interstitial_events}")
    inter_row(spark, interstitial_view_flag="'y'", user_id="12").write.format("parquet").saveAsTable(sandbox.interstitial_events)
    spark.sql(f"DROP TABLE {sandbox.tile_metadata}")
    spark.sql(f"CREATE TABLE {sandbox.tile_metadata} USING parquet AS SELECT 'T' AS tile_id, 'N' AS tile_name, 'C' AS tile_category, 'y' AS is_active")
    report = daily.run_daily(spark, DAY, sandbox, options)
    assert report.metadata_available
    row = spark.table(sandbox.daily_summary).first()
    assert (row.tile_name, row.unique_tile_views, row.unique_interstitial_views) == ("N", 1, 1)
    assert row.date == DAY and isinstance(row.date, dt.date)
