"""From raw ``documents`` to token ids in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; its
result is written as Parquet and read again as the next one's ``docs``. All but the last return
the columns of ``documents``, whatever they are.

1. Quality rules: rejected documents go.
2. SimHash near-dedup: of each group the document with the smallest id stays.
3. Benchmark decontamination: documents that leak a benchmark item go.
4. PII: every span becomes its kind in angle brackets; ``n_chars`` follows the text.
5. BPE: each document's token ids, with digests of the ids and of the text decoded from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilepulse.llm import bpe, decontaminate, pii, quality_rules, simhash
from tilepulse.llm.common import written
from tilepulse.llm.queries import read, tokenizer_file


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaking(docs, read(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact_pii(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ids = bpe.encode(docs, tokenizer_file())
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("ids", "decoded")]
    return ids.select("doc_id", "n_tokens", "ids", *digests)


STAGES = [
    ("quality rules", keep_good),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("pii", redact),
    ("bpe", tokenize),
]

#: Suffix arrays, SimHash components and BPE are beyond SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; every stage but the last is a table in the shared folder."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
