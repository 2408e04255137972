"""What the operators share: batches of bounded size, texts as bytes, written intermediates."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir

#: Rows and bytes of one Arrow batch handed to a Python worker.
BATCH_ROWS = 256
BATCH_BYTES = "8m"

#: The folder that holds the package.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

_DDL = {
    pa.int64(): "bigint",
    pa.int32(): "int",
    pa.string(): "string",
    pa.binary(): "binary",
    pa.bool_(): "boolean",
    pa.float64(): "double",
}


def ddl(schema: pa.Schema) -> str:
    """The Spark DDL of a flat Arrow schema."""
    return ", ".join(f"`{f.name}` {_DDL[f.type]}" for f in schema)


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session, so that a batch of very long texts fits, and
    let the Python workers find this package where its folder is not on their path (a cluster
    that does not share the folder gets it by --py-files)."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, env.get("PYTHONPATH", "")]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def map_texts(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    per_batch: Callable[[list, list], list[list]],
    schema: pa.Schema,
) -> DataFrame:
    """One output row per input row: ``per_batch(ids, texts)`` returns the columns of ``schema``
    (the id, an integer, first). A null text reaches it as the empty string. No shuffle; a lost task only
    repeats its own split."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_pylist()
            texts = [t or "" for t in b.column(1).to_pylist()]
            cols = per_batch(ids, texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema
            )

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, ddl(schema))


def keep_rows(docs: DataFrame, text_col: str, keep: Callable[[list], list[bool]]) -> DataFrame:
    """The rows of ``docs`` whose text passes, every column untouched (names never clash)."""
    small_batches(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            mask = keep([t or "" for t in b.column(at).to_pylist()])
            yield b.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: cuts lineage, survives lost
    executors, and fixes the rows when a step is read more than once."""
    spark = df.sparkSession
    path = os.path.join(work_dir(spark), "tilepulse-llm", f"{label}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
