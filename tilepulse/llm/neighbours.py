"""Approximate nearest neighbours by learned partitions (operator 11).

Fit, on a bounded sample (``sample`` distinct vectors, those with the smallest digests; a fit
parameter): the cosine neighbour graph of the sample is cut into balanced parts (bisection along
principal directions, then moves that put neighbours together while no part grows past
``SLACK``), and a network of one hidden layer learns to name the parts of a vector and its
neighbours. The number of parts a query is routed to is the smallest that finds ``target`` of
the sample's own neighbours.

Index: every row is in the part that the network finds likeliest. Search: every query meets all
rows of its likeliest parts and is reranked by exact cosine in double precision.

Scale: equal vectors are one entry that carries its ``k`` + 1 smallest ids (more can never be
asked for), and equal queries are searched once, so copies cost nothing. A part is cut into
cells of at most ``CELL`` entries by as many queries, so that a crowded part is many tasks, each
of bounded memory. The driver holds the sample, the network and one row a part.

Defined cases: a vector that is null, empty, zero, or holds a null or non-finite component takes
no part; so do vectors of another length than the most frequent one (the shorter, if two are)
and rows without an id. Rows that repeat an id and a vector count once; rows that share an id
but not the vector are each searched and found, but never for that id. Other columns are not
read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ddl, small_batches, written

#: Distinct vectors that the partition and the network are fitted on.
SAMPLE = 4096
#: Sampled vectors a part needs at least; with SAMPLE it bounds the number of parts.
PER_PART = 64
#: Neighbours of a vector in the sample's graph.
GRAPH = 10
#: A part may be this much larger than the mean.
SLACK = 1.05
#: Share of the sample's neighbours that routing has to reach.
TARGET = 0.97
#: Entries, and queries, of one cell.
CELL = 4096
HIDDEN = 128


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of the ``k`` nearest other rows by cosine, for unit rows."""
    k = min(k, len(x) - 1)
    out = np.zeros((len(x), k), np.int64)
    for at in range(0, len(x), 1024):
        near = x[at : at + 1024] @ x.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        top = np.argpartition(-near, k - 1, axis=1)[:, :k] if k else out[:0]
        out[at : at + 1024] = np.take_along_axis(top, np.argsort(-np.take_along_axis(near, top, 1), axis=1), 1)
    return out


def _bisect(x: np.ndarray, rows: np.ndarray, parts: int, first: int, out: np.ndarray) -> None:
    """Parts ``first`` ... of ``rows``, cut along the direction in which they spread most."""
    if parts == 1:
        out[rows] = first
        return
    own = x[rows] - x[rows].mean(axis=0)
    _, axes = np.linalg.eigh(own.T @ own)
    rows = rows[np.argsort(own @ axes[:, -1], kind="stable")]
    left = parts // 2
    cut = len(rows) * left // parts
    _bisect(x, rows[:cut], left, first, out)
    _bisect(x, rows[cut:], parts - left, first + left, out)


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int, rounds: int = 12) -> np.ndarray:
    """A part of each row: few edges of the graph between parts, sizes within ``SLACK``."""
    part = np.zeros(len(x), np.int64)
    _bisect(x, np.arange(len(x)), parts, 0, part)
    ends = np.concatenate([near.ravel(), np.repeat(np.arange(len(x)), near.shape[1])])
    starts = np.concatenate([np.repeat(np.arange(len(x)), near.shape[1]), near.ravel()])
    size = np.bincount(part, minlength=parts)
    most = int(np.ceil(SLACK * len(x) / parts))
    least = int(np.floor((2 - SLACK) * len(x) / parts))
    for _ in range(rounds):
        links = np.zeros((len(x), parts))
        np.add.at(links, (starts, part[ends]), 1)
        gain = links.max(axis=1) - links[np.arange(len(x)), part]
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            to = int(links[i].argmax())
            if size[to] < most and size[part[i]] > least:
                size[part[i]] -= 1
                size[to] += 1
                part[i] = to
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """The fitted network, and how many parts a query is sent to."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int = 1

    @property
    def parts(self) -> int:
        return len(self.b2)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Unnormalised log-probabilities of the parts, for rows of any length but zero."""
        return np.maximum(_unit(x) @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def home(self, x: np.ndarray) -> np.ndarray:
        return self.scores(x).argmax(axis=1)

    def routes(self, x: np.ndarray) -> np.ndarray:
        """The likeliest parts of each row, likeliest first."""
        return np.argsort(-self.scores(x), axis=1, kind="stable")[:, : self.probes]


def _train(x: np.ndarray, goal: np.ndarray, epochs: int = 40, batch: int = 128, rate: float = 5e-3) -> Router:
    """Softmax cross-entropy against ``goal`` (a distribution a row) by Adam."""
    rng = np.random.default_rng(11)
    d, parts = x.shape[1], goal.shape[1]
    p = [
        rng.normal(0, np.sqrt(2 / d), (d, HIDDEN)) * np.sqrt(d),  # unit rows have components of 1/sqrt(d)
        np.zeros(HIDDEN),
        rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)),
        np.zeros(parts),
    ]
    m, v, step = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p], 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        pace = rate * (1 - epoch / epochs)
        for at in range(0, len(x), batch):
            xb, gb = x[order[at : at + batch]], goal[order[at : at + batch]]
            h = xb @ p[0] + p[1]
            r = np.maximum(h, 0)
            z = r @ p[2] + p[3]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            dz = (z / z.sum(axis=1, keepdims=True) - gb) / len(xb)
            dh = (dz @ p[2].T) * (h > 0)
            step += 1
            for i, g in enumerate((xb.T @ dh, dh.sum(axis=0), r.T @ dz, dz.sum(axis=0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p[i] -= pace * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return Router(*p)


def fit_router(x: np.ndarray, parts: int, target: float = TARGET) -> Router:
    """Partition the sample's neighbour graph, learn the parts, and set the number of probes."""
    x = _unit(np.asarray(x, np.float64))
    if parts <= 1 or len(x) <= 2:
        return Router(np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    near = neighbour_graph(x, GRAPH)
    part = balanced_parts(x, near, parts)
    goal = np.zeros((len(x), parts))
    np.add.at(goal, (np.repeat(np.arange(len(x)), near.shape[1]), part[near].ravel()), 1 / near.shape[1])
    goal = 0.5 * goal + 0.5 * np.eye(parts)[part]
    router = _train(x, goal)
    order = np.argsort(-router.scores(x), axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :], 1)
    wanted = np.take_along_axis(place, router.home(x)[near[:, :5]], 1)  # the probe at which each neighbour is met
    met = np.cumsum(np.bincount(wanted.ravel(), minlength=parts)) / wanted.size
    router.probes = int(np.searchsorted(met, target) + 1)
    return router


def _usable(vecs: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, key, v): the rows that take part; the digest of the vector, and its bytes."""
    small_batches(vecs.sparkSession)
    single = vecs.schema[vec_col].dataType.elementType == T.FloatType()
    kind = np.dtype("<f4" if single else "<f8")
    schema = pa.schema([("id", pa.int64()), ("key", pa.binary()), ("v", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, keys, out = [], [], []
            for i, v in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                v = v.values
                if i is None or v is None or not len(v) or v.null_count:
                    continue
                x = v.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(x).all() or not x.any():
                    continue
                raw = (x + 0.0).astype(kind).tobytes()  # one zero
                ids.append(i)
                keys.append(hashlib.blake2b(raw, digest_size=16).digest())
                out.append(raw)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(out, pa.binary())], schema=schema)

    cols = [F.col(id_col).cast("long"), F.col(vec_col)]
    rows = vecs.select(*cols).mapInArrow(run, ddl(schema))
    return rows.withColumn("bits", F.lit(kind.itemsize * 8))


def _matrix(column: pa.Array, bits: int) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, f"<f{bits // 8}").reshape(len(column), -1).astype(np.float64)


def _routed(rows: DataFrame, router: Router, bits: int) -> DataFrame:
    """``rows`` (with v) and ``parts``: the home of each, and behind it the parts it is sent to."""
    spark = rows.sparkSession
    small_batches(spark)
    model = spark.sparkContext.broadcast(router)
    names = rows.columns
    schema = T.StructType([*rows.schema.fields, T.StructField("parts", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(names.index("v")), bits)
            parts = np.c_[model.value.home(x), model.value.routes(x)].tolist()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(parts, pa.list_(pa.int32()))], names=[*names, "parts"])

    return rows.mapInArrow(run, schema)


_FOUND = pa.schema([("qkey", pa.binary()), ("id", pa.int64()), ("score", pa.float64())])


def _search_cell(queries: pa.Table, entries: pa.Table, bits: int, most: int) -> pa.Table:
    """The ``most`` nearest ids of one cell for each of its queries."""
    if not queries.num_rows or not entries.num_rows:
        return _FOUND.empty_table()
    q, e = (_matrix(t.column("v").combine_chunks(), bits) for t in (queries, entries))
    q_len, e_len = np.sqrt(np.einsum("ij,ij->i", q, q)), np.sqrt(np.einsum("ij,ij->i", e, e))
    ids = entries.column("ids").to_pylist()
    count = np.array([len(x) for x in ids])
    flat, first = np.concatenate([np.array(x, np.int64) for x in ids]), np.r_[0, np.cumsum(count)[:-1]]
    keys = np.array(queries.column("key").to_pylist(), object)
    out: list[tuple] = []
    for at in range(0, len(q), 256):
        near = (q[at : at + 256] @ e.T) / q_len[at : at + 256, None] / e_len[None, :]
        edge = np.partition(near, max(near.shape[1] - most, 0), axis=1)[:, max(near.shape[1] - most, 0)]
        qi, ei = np.nonzero(near >= edge[:, None] - 1e-12)  # those that rounding may put in another order
        exact = np.einsum("ij,ij->i", q[at + qi], e[ei]) / (q_len[at + qi] * e_len[ei])
        rows = np.repeat(np.arange(len(qi)), count[ei])
        nth = np.arange(len(rows)) - np.repeat(np.r_[0, np.cumsum(count[ei])[:-1]], count[ei])
        who, what, score = qi[rows], flat[first[ei[rows]] + nth], exact[rows]
        order = np.lexsort((what, -score, who))
        who, what, score = who[order], what[order], score[order]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        keep = place < most
        out.append((keys[at + who[keep]], what[keep], score[keep]))
    cols = [np.concatenate(c) for c in zip(*out, strict=True)]
    return pa.table([pa.array(list(cols[0]), pa.binary()), pa.array(cols[1]), pa.array(cols[2])], schema=_FOUND)


def _cells(index: DataFrame, queries: DataFrame, cell: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with their cell (part, eb, qb): each entry once for every block of its part's
    queries, each query once for every block of entries of its parts."""
    spark = index.sparkSession
    sent = queries.select("key", "v", F.explode(F.expr("slice(parts, 2, size(parts))")).alias("part"))
    held = index.select("key", "v", "ids", F.col("parts")[0].alias("part"))
    entries = {r["part"]: r["count"] for r in held.groupBy("part").count().collect()}
    asked = {r["part"]: r["count"] for r in sent.groupBy("part").count().collect()}
    rows = [(p, -(-n // cell), -(-asked[p] // cell)) for p, n in entries.items() if p in asked]
    blocks = F.broadcast(spark.createDataFrame(rows, "part int, ebs long, qbs long"))  # one row a part
    h = F.xxhash64("key")
    held = held.join(blocks, "part").withColumn("eb", F.pmod(h, "ebs")).withColumn("qb", F.explode(F.expr("sequence(0L, qbs - 1)")))
    sent = sent.join(blocks, "part").withColumn("qb", F.pmod(h, "qbs")).withColumn("eb", F.explode(F.expr("sequence(0L, ebs - 1)")))
    return held.select("part", "eb", "qb", "v", "ids"), sent.select("part", "eb", "qb", "key", "v")


def nearest(
    vecs: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    every: int = 50,
    k: int = 5,
    parts: int | None = None,
    sample: int = SAMPLE,
    target: float = TARGET,
    cell: int | None = None,
) -> DataFrame:
    """The ``k`` nearest found of each row whose id is divisible by ``every``: (query_id, rank,
    ``id_col``, score), ties to the smaller id. ``parts``: by default a quarter of the square root
    of the number of distinct vectors, and no more than the sample can describe."""
    spark = vecs.sparkSession
    none = spark.createDataFrame([], f"query_id long, rank int, `{id_col}` long, score double")
    rows = written(_usable(vecs, id_col, vec_col), "vectors")
    shape = rows.groupBy(F.octet_length("v").alias("n"), "bits").count().orderBy(F.desc("count"), "n").first()
    if shape is None:
        return none
    bits = shape["bits"]
    rows = rows.where(F.octet_length("v") == shape["n"]).drop("bits")

    # equal vectors: one entry with its k + 1 smallest ids (a row limit a key, before the shuffle too)
    small = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    firsts = rows.groupBy("key", "id").agg(F.first("v").alias("v")).withColumn("n", small).where(F.col("n") <= k + 1)
    entries = written(firsts.groupBy("key").agg(F.first("v").alias("v"), F.sort_array(F.collect_list("id")).alias("ids")), "entries")
    asking = rows.where(F.col("id") % every == 0).select("id", "key", "v")
    queries = asking.groupBy("key").agg(F.first("v").alias("v"))

    total = entries.count()
    drawn = [r["v"] for r in entries.orderBy("key").limit(sample).select("v").collect()]  # digests: a uniform order
    x = _matrix(pa.array(drawn, pa.binary()), bits)
    parts = parts or round(np.sqrt(total) / 4)
    router = fit_router(x, max(1, min(parts, len(x) // PER_PART)), target)
    index = written(_routed(entries, router, bits), "index")
    queries = written(_routed(queries, router, bits), "queries")
    if queries.isEmpty():
        return none
    cell = cell or min(CELL, max(256, 2 * total // router.parts))
    held, sent = _cells(index, queries, cell)

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        return _search_cell(a, b, bits, k + 1)

    grouped = [d.groupBy("part", "eb", "qb") for d in (sent, held)]
    found = grouped[0].cogroup(grouped[1]).applyInArrow(search, ddl(_FOUND))
    best = F.row_number().over(Window.partitionBy("qkey").orderBy(F.desc("score"), "id"))
    found = found.withColumn("n", best).where(F.col("n") <= k + 1)
    hits = found.groupBy(F.col("qkey").alias("key")).agg(F.sort_array(F.collect_list(F.struct("n", "id", "score"))).alias("hits"))
    out = asking.select(F.col("id").alias("query_id"), "key").distinct().join(hits, "key")
    others = F.expr(f"slice(filter(hits, h -> h.id <> query_id), 1, {k})")
    out = out.select("query_id", F.posexplode(others).alias("at", "hit"))
    return out.select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("hit.id").alias(id_col), F.col("hit.score").alias("score")
    )
