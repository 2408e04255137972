"""Quality classifier by importance resampling (operator 7).

Two generative models of hashed n-grams: of the target texts (labelled good) and of the raw
texts (all documents). A document's log weight is the log likelihood ratio of its n-grams; with
Gumbel noise added, the ``k`` largest are a sample without replacement in proportion to the
weights. The noise depends on the id and the seed only.

n-grams are words and punctuation runs in lower case, and pairs of neighbours, hashed to
``BUCKETS``; a pair of equal tokens counts as one kind, whatever the token, as in endless
repetition. The raw counts are of all documents; a task adds up its own and sends one row a
bucket. The target's rows are at most ``TARGET_ROWS`` labelled ids (those with the smallest
hash), broadcast as two numbers each. ``k`` is the share of good ones among all
labelled ids, of all documents, unless given. The k-th largest key is found by counting: each round cuts the
range that holds it into 4,096 parts, so no task or driver holds the sample.

Defined cases: null or empty texts have log weight 0; a null id has a noise of its own, the
same for all; rows with equal keys stand or fall together, so copies of a row may exceed ``k``;
without target rows every log weight is 0; other columns are not read; an empty table gives no
rows.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ddl, map_texts, small_batches, written

BUCKETS = 10_007
TARGET_ROWS = 20_000
SEED = 7
PARTS = 4096
TOKEN = re.compile(r"\w+|[^\w\s]+")
#: Distinct tokens whose hash a worker remembers.
REMEMBERED = 300_000
_hashes: dict[str, int] = {}


def ngrams(text: str) -> np.ndarray:
    """The bucket of each token, then of each pair of neighbours."""
    words = TOKEN.findall(text.lower())
    if len(_hashes) > REMEMBERED:
        _hashes.clear()
    for w in set(words).difference(_hashes):
        _hashes[w] = crc32(w.encode("utf-8", "replace"))
    h = np.fromiter(map(_hashes.__getitem__, words), np.int64, len(words))
    pairs = np.where(h[:-1] == h[1:], 1, h[:-1] * 31 + h[1:] * 17 + 7)
    return np.concatenate([h, pairs]) % BUCKETS


def ngram_counts(docs: DataFrame, text_col: str, target: DataFrame, id_col: str) -> DataFrame:
    """(bucket, raw, target): n-grams of all documents, and of those in ``target`` (id)."""
    small_batches(docs.sparkSession)
    flagged = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    flagged = flagged.join(F.broadcast(target.withColumn("good", F.lit(True))), "id", "left").select("text", "good")
    schema = pa.schema([("bucket", pa.int64()), ("raw", pa.int64()), ("target", pa.int64())])

    def run(batches):
        counts = np.zeros((2, BUCKETS), np.int64)
        for b in batches:
            for text, good in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                x = np.bincount(ngrams(text or ""), minlength=BUCKETS)
                counts[0] += x
                if good:
                    counts[1] += x
        at = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (at, counts[0][at], counts[1][at])], schema=schema)

    return flagged.mapInArrow(run, ddl(schema)).groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: list) -> np.ndarray:
    """Of each bucket, smoothed by one count; zero without a target."""
    c = np.zeros((2, BUCKETS))
    for r in counts:
        c[:, r["bucket"]] = r["raw"], r["target"]
    if not c[1].sum():
        return np.zeros(BUCKETS)
    p = (c + 1) / (c.sum(1, keepdims=True) + BUCKETS)
    return np.log(p[1]) - np.log(p[0])


def kth_largest(rows: DataFrame, col: str, k: int) -> float | None:
    """The k-th largest value of a column without nulls (None if there are fewer rows)."""
    low, high, n = rows.agg(F.min(col), F.max(col), F.count("*")).first()
    if k < 1 or n < k:
        return None
    inside, above = rows, 0
    while low < high:
        width = (high - low) / PARTS
        if width == 0 or low + width == low:
            break
        part = F.least(F.floor((F.col(col) - low) / width), F.lit(PARTS - 1)).cast("int")
        found = inside.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min(col).alias("low"), F.max(col).alias("high"))
        for r in found.orderBy(F.desc("part")).collect():
            if above + r["n"] >= k:
                break
            above += r["n"]
        low, high = r["low"], r["high"]
        inside = inside.where(F.col(col).between(low, high))
    return low


def importance_sample(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    share: float | None = None,
    seed: int = SEED,
) -> DataFrame:
    """The sampled documents: the id, ``log_weight``, ``sample_key`` and ``kept`` (true).
    ``share`` of all rows is sampled; None: the share of good ones among all labelled ids."""
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    usable = usable.groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("good"))
    usable = written(usable, "labels")
    if share is None:
        share = usable.agg(F.avg("good")).first()[0] or 0.0
    sample = written(usable.orderBy(F.xxhash64("id"), "id").limit(TARGET_ROWS), "target")
    target = sample.where("good = 1").select("id")
    ratios = log_ratios(ngram_counts(docs, text_col, target, id_col).collect())  # one row a bucket

    schema = pa.schema([("id", pa.int64()), ("log_weight", pa.float64())])
    weights = map_texts(docs, id_col, text_col, lambda ids, texts: [ids, [float(ratios[ngrams(t)].sum()) for t in texts]], schema)
    u = (F.expr(f"shiftrightunsigned(xxhash64({int(seed)}, id), 11)") + 0.5) / F.lit(2.0**53)
    keyed = written(weights.withColumn("sample_key", F.col("log_weight") - F.log(-F.log(u))), "weights")
    least = kth_largest(keyed, "sample_key", round(share * keyed.count()))
    out = keyed.where(F.lit(False) if least is None else F.col("sample_key") >= least)
    return out.select(F.col("id").alias(id_col), "log_weight", "sample_key", F.lit(True).alias("kept"))
