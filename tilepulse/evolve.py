"""Table creation and schema evolution.

* ``create_tables``      CREATE TABLE IF NOT EXISTS for the five tables, from the registry
* ``add_columns``        ALTER TABLE ... ADD COLUMNS (additive; old partitions read NULL,
                         nothing is backfilled)
* ``set_table_comment``  ALTER TABLE ... SET TBLPROPERTIES ('comment' = ...)
* ``rollback_columns``   Parquet refuses DROP COLUMN, so the table is rebuilt: create a stage,
                         INSERT ... BY NAME the kept columns, check the row count, rename the
                         target aside, rename the stage into place, drop the old table
* ``drop_table``         DROP TABLE IF EXISTS, only with an explicit confirmation
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from .config import TableNames
from .sources.schemas import SPECS, TableSpec, column_ddl, create_table_ddl, _quote

log = logging.getLogger(__name__)


def create_tables(
    spark: SparkSession,
    tables: TableNames = TableNames(),
    *,
    enriched: bool = True,
    fmt: str = "parquet",
    summary: str | None = None,
) -> None:
    """Create databases and the five tables if absent.

    The summary target is v1.1 (name + category) when ``enriched``, else v1.0 (no labels);
    ``summary`` names a registry entry explicitly ("daily_summary", "daily_summary_v1",
    "daily_summary_category").
    """
    for name in {t.split(".")[0] for t in vars(tables).values() if "." in t}:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    plan = {
        tables.tile_events: SPECS["tile_events"],
        tables.interstitial_events: SPECS["interstitial_events"],
        tables.tile_metadata: SPECS["tile_metadata"],
        tables.daily_summary: SPECS[summary or ("daily_summary" if enriched else "daily_summary_v1")],
        tables.global_kpis: SPECS["global_kpis"],
    }
    for name, spec in plan.items():
        spark.sql(create_table_ddl(name, spec, fmt=fmt))


def add_columns(spark: SparkSession, table: str, fields: T.StructType) -> list[str]:
    """Add the columns that are not there yet (idempotent). Returns the names added."""
    have = {c.lower() for c in spark.table(table).columns}
    new = [f for f in fields.fields if f.name.lower() not in have]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(column_ddl(f) for f in new)})")
        log.info("added %s to %s", [f.name for f in new], table)
    return [f.name for f in new]


def set_table_comment(spark: SparkSession, table: str, comment: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('comment' = {_quote(comment)})")


def table_comment(spark: SparkSession, table: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    for r in rows:
        if r.col_name == "Comment":
            return r.data_type
    return None


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def rollback_columns(
    spark: SparkSession,
    table: str,
    drop: Sequence[str],
    *,
    comment: str | None = None,
    fmt: str = "parquet",
) -> None:
    """Remove columns by rebuilding the table; all rows are kept, and checked by count. A pointer
    table (``tilepulse.pointers``) is swapped in one step, and can be undone."""
    from . import pointers

    if pointers.current(spark, table) is not None:
        pointers.drop_columns(spark, table, drop, comment)
        return
    current = spark.table(table).schema
    lower = {d.lower() for d in drop}
    kept = T.StructType([f for f in current.fields if f.name.lower() not in lower])
    if len(kept.fields) == len(current.fields):
        return
    parts = tuple(_partition_columns(spark, table))
    if comment is None:
        comment = table_comment(spark, table) or ""
    db, _, base = table.rpartition(".")
    stage = f"{db + '.' if db else ''}{base}__rollback_{uuid.uuid4().hex[:8]}"
    spark.sql(create_table_ddl(stage, TableSpec(kept, parts, comment), fmt=fmt))
    cols = ", ".join(f"`{c}`" for c in kept.fieldNames())
    # rebalance by the partition columns: files per partition follow its size, not the task count
    hint = f"/*+ REBALANCE({', '.join(f'`{p}`' for p in parts)}) */ " if parts else ""
    spark.sql(f"INSERT INTO {stage} BY NAME SELECT {hint}{cols} FROM {table}")
    before = spark.table(table).count()
    after = spark.table(stage).count()
    if before != after:
        spark.sql(f"DROP TABLE IF EXISTS {stage}")
        raise RuntimeError(f"rollback of {table} aborted: {before} rows before, {after} in stage")
    # swap: target -> backup, stage -> target (backup restored if that fails), drop backup
    backup = f"{db + '.' if db else ''}{base}__pre_rollback_{uuid.uuid4().hex[:8]}"
    spark.sql(f"ALTER TABLE {table} RENAME TO {backup}")
    try:
        spark.sql(f"ALTER TABLE {stage} RENAME TO {table}")
    except Exception:
        spark.sql(f"ALTER TABLE {backup} RENAME TO {table}")
        raise
    spark.sql(f"DROP TABLE {backup}")
    log.info("rolled back %s: dropped %s, %d rows kept", table, list(drop), after)


def drop_table(spark: SparkSession, table: str, *, confirm: bool = False) -> bool:
    """Drop a table (the rollback's optional last step); refuses unless ``confirm``."""
    if not confirm:
        log.warning("drop of %s skipped: pass confirm=True", table)
        return False
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    return True
