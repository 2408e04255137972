"""Tables that are replaced whole, in one step: a view points at the generation readers see (A13,
A15).

A *pointer* table is the view ``<name>`` over one of its generations ``<name>__g<tag>``, ordinary
tables. A replacement writes a new generation, checks what was written, and then alters the view,
which is a single catalog update: a reader resolves the old generation or the new one, never an
empty, partial or missing table, and a replacement that fails changes nothing. The last ``history``
generations stay, so a running reader of the one before ends well and ``undo`` has something to go
back to; older ones are dropped.

Replacing may change the columns: ``drop_columns`` is the rollback of added columns.

A refreshed dimension also gets a *snapshot* of its labels in the same generation: active rows,
one a tile, written once, with its exact size in its properties; jobs broadcast (or not) by those
figures without measuring, shuffling or checking the metadata themselves.
"""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import replace as changed

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .constants import LABEL_COLUMNS
from .operators import enrich as E
from .sources.schemas import TableSpec, create_table_ddl

log = logging.getLogger(__name__)

_CHECKED = "tilepulse.checked"
_SNAPSHOT = ("tilepulse.rows", "tilepulse.bytes", "tilepulse.repeated_tiles")


def _split(table: str) -> tuple[str, str]:
    db, _, base = table.rpartition(".")
    return (f"{db}." if db else ""), base.lower()


def _generation(table: str, tag: str) -> str:
    db, base = _split(table)
    return f"{db}{base}__g{tag}"


def current(spark: SparkSession, table: str) -> str | None:
    """The tag of the generation that a pointer table shows; None for any other table."""
    if not spark.catalog.tableExists(table) or spark.catalog.getTable(table).tableType != "VIEW":
        return None
    text = next((r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r.col_name == "View Text"), "")
    found = re.search(rf"{re.escape(_split(table)[1])}__g(\w+)`?$", text.strip(), re.IGNORECASE)
    return found[1] if found else None


def generations(spark: SparkSession, table: str) -> list[str]:
    """The tags of all generations there are, oldest first."""
    db, base = _split(table)
    names = [r["tableName"] for r in spark.sql(f"SHOW TABLES {'IN ' + db[:-1] if db else ''} LIKE '{base}__g*'").collect()]
    found = (re.fullmatch(rf"{re.escape(base)}__g(\w+)", n) for n in names)
    return sorted(m[1] for m in found if m)


def _tag(spark: SparkSession, table: str) -> str:
    """A tag that sorts behind all there are and that no other writer takes."""
    last = max((int(g.split("_")[0]) for g in generations(spark, table)), default=0)
    return f"{last + 1:08d}_{uuid.uuid4().hex[:8]}"


def _new_generation(spark: SparkSession, table: str, tag: str, spec: TableSpec, df: DataFrame | None) -> None:
    name = _generation(table, tag)
    spark.sql(create_table_ddl(name, spec))
    if df is not None:
        rows = df.select(*spark.table(name).columns)
        if spec.partition_cols:
            rows = rows.hint("rebalance", *spec.partition_cols)
        rows.write.insertInto(name)


def _mark_checked(spark: SparkSession, table: str, tag: str) -> None:
    spark.sql(f"ALTER TABLE {_generation(table, tag)} SET TBLPROPERTIES ('{_CHECKED}' = 'true')")


def _is_checked(spark: SparkSession, table: str, tag: str) -> bool:
    return any(r["key"] == _CHECKED for r in spark.sql(f"SHOW TBLPROPERTIES {_generation(table, tag)}").collect())


def create_pointer(spark: SparkSession, table: str, spec: TableSpec) -> None:
    """An empty pointer table, if there is none."""
    if not spark.catalog.tableExists(table):
        tag = _tag(spark, table)
        _new_generation(spark, table, tag, spec, None)
        _mark_checked(spark, table, tag)
        spark.sql(f"CREATE VIEW IF NOT EXISTS {table} AS SELECT * FROM {_generation(table, tag)}")


def spec_of(spark: SparkSession, table: str) -> TableSpec:
    """Columns (with comments), partitioning and comment of the generation shown."""
    name = _generation(table, current(spark, table))
    parts = tuple(c.name for c in spark.catalog.listColumns(name) if c.isPartition)
    return TableSpec(spark.table(name).schema, parts, spark.catalog.getTable(name).description or "")


def _point(spark: SparkSession, table: str, tag: str) -> None:
    spark.sql(f"ALTER VIEW {table} AS SELECT * FROM {_generation(table, tag)}")  # one catalog update


def replace_table(
    spark: SparkSession,
    table: str,
    df: DataFrame,
    spec: TableSpec | None = None,
    check: Callable[[DataFrame], None] | None = None,
    prepare: Callable[[str], None] | None = None,
    history: int = 1,
) -> str:
    """Show the rows of ``df`` instead of what the pointer table shows. ``check`` gets the written
    generation and raises to refuse it; ``prepare`` gets its tag, for what goes with it. Returns
    the tag."""
    before = current(spark, table)
    if before is None:
        raise ValueError(f"{table} is no pointer table")
    spec = spec or spec_of(spark, table)
    if absent := [c for c in spec.columns if c not in df.columns]:
        raise ValueError(f"{table}: new version lacks columns {absent}")
    tag = _tag(spark, table)
    try:
        _new_generation(spark, table, tag, spec, df)
        if check is not None:
            check(spark.table(_generation(table, tag)))
        if prepare is not None:
            prepare(tag)
    except BaseException:
        _drop(spark, table, tag)
        raise
    _mark_checked(spark, table, tag)
    _point(spark, table, tag)
    kept = [g for g in generations(spark, table) if g < tag]
    for old in kept[: max(0, len(kept) - history)]:
        _drop(spark, table, old)
    log.info("%s: generation %s replaces %s", table, tag, before)
    return tag


def _drop(spark: SparkSession, table: str, tag: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_generation(table, tag)}")
    spark.sql(f"DROP TABLE IF EXISTS {labels_table(table, tag)}")


def undo(spark: SparkSession, table: str) -> str:
    """Show the generation before the one shown; returns its tag. What a replacement left that died
    before its check is passed over."""
    shown = current(spark, table)
    older = [g for g in generations(spark, table) if shown and g < shown and _is_checked(spark, table, g)]
    if not older:
        raise ValueError(f"{table}: no earlier generation is kept")
    _point(spark, table, older[-1])
    return older[-1]


def drop_columns(spark: SparkSession, table: str, drop: Sequence[str], comment: str | None = None) -> None:
    """Replace a pointer table by itself without some columns; all rows are kept, and counted."""
    spec = spec_of(spark, table)
    gone = {c.lower() for c in drop}
    kept = T.StructType([f for f in spec.schema.fields if f.name.lower() not in gone])
    if len(kept) == len(spec.schema):
        return
    rows = spark.table(table)

    def all_rows(written: DataFrame) -> None:
        before, after = rows.count(), written.count()
        if before != after:
            raise RuntimeError(f"rollback of {table} refused: {before} rows before, {after} written")

    spec = changed(spec, schema=kept, comment=spec.comment if comment is None else comment)
    replace_table(spark, table, rows.select(*kept.fieldNames()), spec, check=all_rows)


# ------------------------------------------------------------------ the dimension and its labels


def labels_table(table: str, tag: str) -> str:
    """The snapshot that belongs to a generation of the metadata."""
    db, base = _split(table)
    return f"{db}{base}__labels_{tag}"


def refresh(spark: SparkSession, df: DataFrame, table: str, key: str = "tile_id", allow_empty: bool = False) -> int:
    """SCD type 1 refresh of a pointer table, checked as it was written (keys unique, not empty
    unless allowed); with a snapshot of the labels where it has them. Returns the row count."""
    from .sinks import DuplicateKeyError

    counted: dict[str, int] = {}

    def check(written: DataFrame) -> None:
        n, keys = written.agg(F.count(F.lit(1)), F.count_distinct(key) + F.max(F.when(F.col(key).isNull(), 1).otherwise(0))).first()
        if n == 0 and not allow_empty:
            raise ValueError(f"new version of {table} is empty; refresh refused (allow_empty=True to force)")
        if n and keys < n:
            raise DuplicateKeyError(f"new version of {table} repeats {key} values; refresh refused")
        counted["rows"] = n

    def prepare(tag: str) -> None:
        if {"tile_id", "is_active", *LABEL_COLUMNS} <= set(df.columns):
            _write_labels(spark, table, tag)

    replace_table(spark, table, df, check=check, prepare=prepare)
    return counted["rows"]


def _write_labels(spark: SparkSession, table: str, tag: str) -> None:
    name = labels_table(table, tag)
    dim = E.prepare_metadata(spark.table(_generation(table, tag)))
    dim.df.coalesce(1).write.format("parquet").saveAsTable(name)  # one row a tile
    dim = E.measure(E.Dimension(spark.table(name)))
    values = zip(_SNAPSHOT, (dim.rows, dim.est_bytes, dim.repeated_tiles), strict=True)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({', '.join(f"'{k}' = '{v}'" for k, v in values)})")


def kept_labels(spark: SparkSession, table: str, columns: Sequence[str] = LABEL_COLUMNS) -> E.Dimension | None:
    """The active metadata from the snapshot of the generation shown, its broadcast decided by the
    recorded size: no action, no aggregation, no exchange. None without a snapshot."""
    tag = current(spark, table)
    if tag is None or not spark.catalog.tableExists(labels_table(table, tag)):
        return None
    name = labels_table(table, tag)
    held = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if not set(_SNAPSHOT) <= set(held):
        return None
    rows, size, repeated = (int(held[k]) for k in _SNAPSHOT)
    df = spark.table(name).select("tile_id", *columns, E.COPIES)
    return E.Dimension(df, rows, size, 0 < E.broadcast_limit(spark) >= size, repeated)
