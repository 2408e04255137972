"""Column expressions shared by the operators. All are built-in Catalyst expressions (codegen'd).

Hot column lists elsewhere are written as SQL expression strings (``selectExpr`` / ``F.expr``):
one Python-to-JVM call per expression instead of one per Column node keeps plan construction on
the driver short.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import as_date


def date_lit(value: str | dt.date) -> Column:
    """A typed DATE literal (the target column is DATE, never a string)."""
    return F.lit(as_date(value))


def day_of(ts: str = "event_ts") -> Column:
    """Calendar day of a timestamp (session time zone for TIMESTAMP, none for TIMESTAMP_NTZ)."""
    return F.to_date(F.col(ts))


def on_day(process_date: str | dt.date, ts: str = "event_ts") -> Column:
    """Keep rows whose day is process_date.

    Catalyst turns to_date(ts) = d into a half-open range on ts that reaches the Parquet
    reader as a pushed filter.
    """
    return day_of(ts) == date_lit(process_date)
