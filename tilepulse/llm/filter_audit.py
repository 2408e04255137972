"""Interaction of filters, by relations of failing ids (operator 13).

Every filter has one stored table of the ids that fail it, bucketed by id like the table of all
ids (with part and labels). All else is joins of those narrow tables, never of texts. The ids
run through the filters' tables once: left-semi the table of a filter, they gain its letter
(``hits``); left-anti it, they stay as they are; so after k filters the rows without a letter are
the survivors of that prefix, and after all of them every id lies in the relation of exactly the
filters that it fails. For a filter f behind a prefix P in any order,

* removals are the ids whose hits hold f and avoid P, survivors those that avoid P and f;
* redundancies are the ids whose hits hold f and meet P;
* label losses are the removals that carry the label (its ids are joined to the table of ids);
* failures of f alone are the ids whose hits are f.

Those 32 relations are counted by part; the counts serve all 120 orders.

Scale: texts are read once; the tables are bucketed alike, so the joins shuffle nothing; a bucket
holds about ``BUCKET_ROWS`` rows and a key is a document, so none is hot. Each round of joins is a
stored table, so a lost executor repeats one round's tasks. Only counts leave the joins.

Defined cases: a null text is empty (and fails "under 200 words"); a null id never makes another
row fail as a copy, never fails as one, and carries no label; repeated rows each count; a null
part is the empty string; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir
from .common import written

#: Rows of one bucket of a failing-id table.
BUCKET_ROWS = 2_000_000

#: The text filters of the audit: name -> condition (SQL over ``t``, a non-null text, and ``words``)
#: under which a document fails.
TEXT_FILTERS = {
    "A": "size(words) < 200",
    "B": "100L * size(array_distinct(words)) < 50L * size(words)",
    "C": "100L * length(regexp_replace(t, '[^A-Z]+', '')) > 3L * length(t)",
    "D": "t rlike '[#$%&*|]'",
}
#: The filter that fails every copy of a text but the one with the smallest id.
COPIES = "E"
LABELS = ("good", "toxic")


def measure(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, part_col: str, filters: dict[str, str]) -> DataFrame:
    """One narrow row per document: its id, the digest of its text, its part, its labels, and a
    flag per text filter. The only pass over the texts."""
    words = r"array_remove(split(t, '[\\x20\\x09-\\x0D]+'), '')"
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(part_col, F.lit("")).alias("part"), F.coalesce(text_col, F.lit("")).alias("t"))
    rows = rows.withColumn("words", F.expr(words))
    flags = [F.expr(cond).alias(f"fails_{name}") for name, cond in filters.items()]
    rows = rows.select("id", "part", F.unhex(F.sha2("t", 256)).alias("text_id"), *flags)
    either = [F.expr(f"coalesce(bool_or({c} = 1), false)").alias(n) for c, n in zip(("quality", "toxic"), LABELS)]
    marks = labels.select(F.col(id_col).alias("id"), "quality", "toxic").where("id IS NOT NULL").groupBy("id").agg(*either)
    rows = rows.join(marks, "id", "left")
    known = [F.coalesce(n, F.lit(False)).alias(n) for n in LABELS]
    named = F.coalesce(F.concat(F.lit("="), F.col("id").cast("string")), F.lit(""))
    key = F.unhex(F.md5(F.concat_ws("|", F.hex("text_id"), named))).alias("key")  # 128 bits: a document
    return rows.select(key, "id", "text_id", "part", *known, *[f"fails_{name}" for name in filters])


def copies(rows: DataFrame) -> DataFrame:
    """The rows whose text a smaller id holds: those with an id that are not the first of their
    text. One partial minimum a text and task, then an anti join on (text, id): no key is hot."""
    named = rows.where("id IS NOT NULL")
    first = named.groupBy("text_id").agg(F.min("id").alias("id"))
    return named.join(first, ["text_id", "id"], "left_anti")


@contextmanager
def _database(spark: SparkSession):
    """A database in the shared folder for the stored tables; it goes at the end, files included."""
    base = f"tilepulse_failing_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {base} LOCATION '{os.path.join(work_dir(spark), 'tilepulse-llm', base)}'")
    try:
        yield base
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {base} CASCADE")


def _stored(df: DataFrame, table: str, buckets: int) -> DataFrame:
    df.write.format("parquet").bucketBy(buckets, "key").sortBy("key").saveAsTable(table)
    return df.sparkSession.table(table)


def failing_tables(rows: DataFrame, filters: dict[str, str], base: str, buckets: int) -> dict[str, DataFrame]:
    """Filter -> its stored table of failing ids. ``rows`` is the bucketed table of all ids."""
    tables = {name: _stored(rows.where(f"fails_{name}").select("key"), f"{base}.fails_{name}", buckets) for name in filters}
    late = copies(rows).select("key").repartition(buckets, "key").coalesce(buckets)
    return {**tables, COPIES: _stored(late, f"{base}.fails_{COPIES}", buckets)}


def hits_of(rows: DataFrame, failing: dict[str, DataFrame], base: str, buckets: int) -> DataFrame:
    """``rows`` with ``hits``, the letters of the filters that each id fails: one round of a
    left-semi and a left-anti join per filter."""
    rows = rows.select("key", "part", *LABELS, F.lit("").alias("hits"))
    for name, table in sorted(failing.items()):
        met = rows.join(table, "key", "left_semi").withColumn("hits", F.concat("hits", F.lit(name)))
        rows = _stored(met.union(rows.join(table, "key", "left_anti")), f"{base}.behind_{name}", buckets)
    return rows


def _steps(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """Every counted relation with every step of every order: its filter, whether the relation's
    ids fail it (``holds``), and whether a filter before it took them (``gone``)."""
    orders = F.split(F.lit(",".join("".join(p) for p in permutations(names))), ",")
    grid = counts.withColumn("filter_order", F.explode(orders))
    grid = grid.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(names)))))
    grid = grid.withColumn("filter", F.expr("substring(filter_order, step, 1)"))
    before = "translate(hits, substring(filter_order, 1, step - 1), '') <> hits"
    return grid.withColumns({"holds": F.expr("contains(hits, filter)"), "gone": F.expr(before)})


def audit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    filters: dict[str, str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """One row per part, order of the filters and step: kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, and the filter's removals over all orders (shapley). ``filters`` are
    named by single letters other than ``COPIES``."""
    spark = docs.sparkSession
    filters = TEXT_FILTERS if filters is None else filters
    names = [*filters, COPIES]
    measured = written(measure(docs, labels, id_col, text_col, part_col, filters), "measured")
    buckets = buckets or max(spark.sparkContext.defaultParallelism, -(-measured.count() // BUCKET_ROWS))
    with _database(spark) as base:
        rows = _stored(measured.repartition(buckets, "key").coalesce(buckets), f"{base}.ids", buckets)
        hits = hits_of(rows, failing_tables(rows, filters, base, buckets), base, buckets)
        sums = [F.count("*").alias("n"), *[F.count_if(F.col(n)).alias(n) for n in LABELS]]
        counts = written(hits.groupBy("part", "hits").agg(*sums), "relations")

    def total(value: str, cond: str) -> Column:
        return F.expr(f"sum(CASE WHEN {cond} THEN {value} ELSE 0L END)")

    steps = _steps(counts, names).groupBy("part", "filter_order", "step", "filter").agg(
        total("n", "NOT gone AND NOT holds").alias("kept"),
        total("n", "NOT gone AND holds").alias("removed"),
        total("n", "gone AND holds").alias("redundant"),
        total("n", "hits = filter").alias("unique_fails"),
        *[total(n, "NOT gone AND holds").alias(f"{n}_lost") for n in LABELS],
    )
    shapley = F.expr("sum(removed) OVER (PARTITION BY part, filter)").alias("shapley")
    return steps.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", shapley)
