"""Scans of the catalog tables (A1-A3, B1, B2, K2, L3)."""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession

from ..operators.metrics import for_day

log = logging.getLogger(__name__)


def scan_events(spark: SparkSession, table: str, process_date: str | dt.date | None = None) -> DataFrame:
    """A source table as the job reads it, optionally restricted to one day (partitions are pruned where the table
    stores the day, else the predicate is pushed to the reader as a range on event_ts)."""
    df = spark.table(table)
    return df if process_date is None else for_day(df, process_date)


def table_available(spark: SparkSession, table: str) -> bool:
    """True when the table exists and can be read (checked before the job starts, not after)."""
    try:
        if not spark.catalog.tableExists(table):
            return False
        spark.table(table).schema  # resolves the relation; raises if it cannot be read
        return True
    except Exception as exc:  # any catalog or analysis error means "not available"
        log.warning("table %s not available: %s", table, exc)
        return False


def validate_metadata_table(spark: SparkSession, table: str) -> bool:
    """K2: the metadata table is readable; logs its row count; False on any error."""
    if not table_available(spark, table):
        return False
    try:
        n = spark.table(table).count()
    except Exception as exc:
        log.warning("metadata table %s not readable: %s", table, exc)
        return False
    log.info("metadata table %s contains %d records", table, n)
    return True
