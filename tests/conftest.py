from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tilepulse.config import TableNames  # noqa: E402
from tilepulse.session import local_session  # noqa: E402
from tilepulse.sources import schemas as S  # noqa: E402

DAY = dt.date(2025, 12, 1)


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="tilepulse-test-")
    s = local_session(
        4,
        shuffle_partitions=4,
        app="tilepulse-tests",
        **{"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")},
    )
    yield s


def ts(h: int, m: int = 0, s: int = 0, day: dt.date = DAY, us: int = 0) -> dt.datetime:
    return dt.datetime(day.year, day.month, day.day, h, m, s, us)


@pytest.fixture
def make_tile(spark):
    """Tile events from tuples (event_id, user, session, ts, tile, type[, device, version])."""

    def build(rows):
        full = [tuple(r) + ("Mobile", "1.0")[len(r) - 6 :] if len(r) < 8 else tuple(r) for r in rows]
        return spark.createDataFrame(full, S.TILE_EVENTS)

    return build


@pytest.fixture
def make_inter(spark):
    """Interstitial events from tuples (event_id, user, session, ts, tile, view, primary, secondary)."""

    def build(rows):
        return spark.createDataFrame([tuple(r) for r in rows], S.INTERSTITIAL_EVENTS)

    return build


@pytest.fixture
def make_meta(spark):
    """Metadata from tuples (tile_id, name, category, is_active[, updated_ts])."""

    def build(rows):
        full = [tuple(r) if len(r) == 5 else tuple(r) + (ts(0),) for r in rows]
        return spark.createDataFrame(full, S.TILE_METADATA)

    return build


@pytest.fixture
def sandbox(spark):
    """Fresh source and target databases, one per test."""
    tag = uuid.uuid4().hex[:8]
    src, tgt = f"t_src_{tag}", f"t_tgt_{tag}"
    spark.sql(f"CREATE DATABASE {src}")
    spark.sql(f"CREATE DATABASE {tgt}")
    return TableNames().in_databases(src, tgt)


def rows_by_tile(df):
    return {r["tile_id"]: r.asDict() for r in df.collect()}
