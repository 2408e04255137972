"""Ranked lexical search of many queries at once, by common subexpressions (operator 12).

Terms are the maximal runs of ASCII letters, digits and all characters beyond ASCII, with A-Z
lowered. A document's score for an item sums, over the item's distinct terms, the term's weight
times a saturating function of its count in the document (``weight``, ``gain``), in integers.

The items share terms, and their scores share sums. Per block of items a sharing graph is mined
(``mine``): the terms that occur in the same set of items are one leaf; then, again and again,
the two nodes that most items have in common become one node, whose accumulator is the sum of
theirs, until no two nodes meet in more than one item. A document's gains are added into the
leaves once, the inner nodes are filled along the graph, and an item's score is the sum of the
few nodes that are left to it.

Spark's part: one pass over the texts writes the documents' counts of query terms (a narrow
table); the corpus statistics and document frequencies are aggregated from it, one row a term
and task; a second pass over that table scores it, each task keeping the ``k`` best of every item;
the last step ranks those. Items are taken in rounds of at most ``ROUND_BYTES`` of text, which
bounds what is broadcast and what the driver holds; every round reads the texts once.

Defined cases: a null or empty text has no terms, and a document without terms is not counted;
an item without terms, or whose terms no document holds, has no rows; repeated rows are
documents (items) of their own, equal ones side by side; a null document id ranks behind equal
scores and is returned; other columns are not read; empty tables give no rows.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ddl, small_batches, written

#: Items whose sharing graph is mined together.
BLOCK_ITEMS = 256
#: Bytes of item text scored in one pass over the documents.
ROUND_BYTES = 8 << 20
#: Nodes of an item whose pairs are mined; the rest of a very long item is added up unshared.
MINED_NODES = 256

_TERM = set(range(0x80, 0x100)) | set(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c) if c in _TERM else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass
class Graph:
    """A block's sharing graph. Nodes 0 .. leaves - 1 are leaves; node ``leaves`` + i is the sum of
    the pair ``inner[i]``; ``roots[j]`` are the nodes that sum to item j's score."""

    leaf_of: dict[int, int]
    leaves: int
    inner: list[tuple[int, int]] = field(default_factory=list)
    roots: list[list[int]] = field(default_factory=list)

    @property
    def additions(self) -> int:
        return len(self.inner) + sum(len(r) for r in self.roots)


def mine(items: list[set[int]]) -> Graph:
    """The sharing graph of items given as sets of terms."""
    holders = defaultdict(list)
    for j, own in enumerate(items):
        for t in own:
            holders[t].append(j)
    same: dict[tuple, int] = {}
    leaf_of = {t: same.setdefault(tuple(holders[t]), len(same)) for t in sorted(holders)}
    graph = Graph(leaf_of, len(same))
    has: list[set[int]] = [{leaf_of[t] for t in own} for own in items]
    by_node: dict[int, set[int]] = {leaf: set(js) for js, leaf in same.items()}
    shared = [sorted((n for n in own if len(by_node[n]) > 1), key=lambda n: (-len(by_node[n]), n))[:MINED_NODES] for own in has]
    live = [set(s) for s in shared]
    pairs: Counter = Counter()
    for own in live:
        ordered = sorted(own)
        pairs.update((a, b) for i, a in enumerate(ordered) for b in ordered[i + 1 :])
    heap = [(-n, p) for p, n in pairs.items() if n > 1]
    heapq.heapify(heap)
    while heap:
        n, (a, b) = heapq.heappop(heap)
        if pairs[a, b] != -n:
            if pairs[a, b] > 1:
                heapq.heappush(heap, (-pairs[a, b], (a, b)))
            continue
        new = graph.leaves + len(graph.inner)
        graph.inner.append((a, b))
        by_node[new] = {j for j in by_node[a] & by_node[b] if a in live[j] and b in live[j]}
        fresh: Counter = Counter()
        for j in by_node[new]:
            for x in live[j]:
                if x != a and x != b:
                    fresh[x] += 1
                    pairs[min(a, x), max(a, x)] -= 1
                    pairs[min(b, x), max(b, x)] -= 1
            live[j] -= {a, b}
            live[j].add(new)
            has[j] -= {a, b}
            has[j].add(new)
        pairs[a, b] = 0
        for x, m in fresh.items():
            if m > 1:
                pairs[x, new] = m
                heapq.heappush(heap, (-m, (x, new)))
    graph.roots = [sorted(own) for own in has]
    return graph


class Round:
    """The items of one pass: vocabulary, graphs, and (once counted) the terms' weights."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]]):
        self.ids = [i for i, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        sets = [{self.vocabulary.setdefault(t, len(self.vocabulary)) for t in dict.fromkeys(own)} for _, own in items]
        self.graphs = [mine(sets[at : at + BLOCK_ITEMS]) for at in range(0, len(sets), BLOCK_ITEMS)]
        self.leaf = []  # of each block: the leaf of every term, or a spare one
        for g in self.graphs:
            leaf = np.full(len(self.vocabulary), -1, np.int64)
            leaf[list(g.leaf_of)] = list(g.leaf_of.values())
            self.leaf.append(leaf)

    def scores(self, block: int, doc: np.ndarray, term: np.ndarray, gain: np.ndarray, n_docs: int) -> np.ndarray:
        """Scores [item of the block, document] from gains (document, term, value): each gain is
        added once, into its leaf; the rest are sums of whole accumulators."""
        g = self.graphs[block]
        leaf = self.leaf[block][term]
        known = leaf >= 0
        acc = np.zeros((g.leaves + len(g.inner), n_docs), np.int64)
        np.add.at(acc.ravel(), leaf[known] * n_docs + doc[known], gain[known])
        for i, (a, b) in enumerate(g.inner):
            np.add(acc[a], acc[b], out=acc[g.leaves + i])
        return np.stack([acc[r].sum(axis=0) for r in g.roots])


class Best:
    """The ``k`` best documents of each item so far: score, then the smaller id."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.edge = np.ones(items, np.int64)  # the least score that may still enter
        self.kept: list[tuple] = []
        self.size = 0

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.edge[first : first + len(scores), None])
        if len(item):
            self.kept.append((first + item, scores[item, doc], ids[doc]))
            self.size += len(item)
            if self.size > 8 * self.k * len(self.edge):
                self.prune()

    def prune(self) -> tuple:
        cols = [np.concatenate(c) for c in zip(*self.kept, strict=True)] or [np.zeros(0, np.int64)] * 3
        order = np.lexsort((cols[2], -cols[1], cols[0]))
        item, score, ids = (c[order] for c in cols)
        place = np.arange(len(item)) - np.searchsorted(item, item)
        last = place == self.k - 1
        self.edge[item[last]] = np.maximum(self.edge[item[last]], score[last])
        keep = place < self.k
        self.kept = [(item[keep], score[keep], ids[keep])]
        self.size = int(keep.sum())
        return self.kept[0]


_NO_ID = np.iinfo(np.int64).max
_COUNTS = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("term", pa.list_(pa.int32())), ("tf", pa.list_(pa.int32()))])
_FREQ = pa.schema([("term", pa.int32()), ("df", pa.int64())])
_HITS = pa.schema([("item", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])


def _count_terms(docs: DataFrame, id_col: str, text_col: str, vocabulary) -> DataFrame:
    """(id, n, term, tf): every document with a term, its length, and its counts of query terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = vocabulary.value
        for b in batches:
            rows = []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if own := terms(text):
                    tf = [(code[t], c) for t, c in Counter(own).items() if t in code]
                    rows.append((i, len(own), [t for t, _ in tf], [c for _, c in tf]))
            cols = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _COUNTS, strict=True)], schema=_COUNTS)

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, "id bigint, n bigint, term array<int>, tf array<int>")


def _frequencies(counts: DataFrame, size: int) -> DataFrame:
    """(term, df): each task counts its documents, then one row a term and task is added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for b in batches:
            df += np.bincount(b.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(df[seen])], schema=_FREQ)

    return counts.select("term").mapInArrow(run, ddl(_FREQ)).groupBy("term").agg(F.sum("df").alias("df"))


def _score(counts: DataFrame, held, k: int) -> DataFrame:
    """(item, id, score): the ``k`` best documents of each item in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rnd, weights, n_docs, length = held.value
        best = Best(len(rnd.ids), k)
        for b in batches:
            term = b.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            if not len(term):
                continue
            tf = b.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            n = b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            ids = np.array([_NO_ID if i is None else i for i in b.column(0).to_pylist()], np.int64)
            doc = np.repeat(np.arange(len(n)), pa.compute.list_value_length(b.column(2)).to_numpy(zero_copy_only=False))
            m = 50 + (50 * n * n_docs) // length
            gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
            for block in range(len(rnd.graphs)):
                best.add(block * BLOCK_ITEMS, rnd.scores(block, doc, term, gain, len(n)), ids)
        item, score, ids = best.prune()
        nulls = ids == _NO_ID
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(ids, mask=nulls), pa.array(score)], schema=_HITS)

    return counts.mapInArrow(run, ddl(_HITS))


def _rounds(items: DataFrame, id_col: str, text_col: str) -> Iterator[list]:
    """The items in id order, in lists of bounded bytes; one round is collected at a time."""
    own = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("length(text) > 0")
    size = own.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    rounds = max(1, -(-size // ROUND_BYTES))
    if rounds > 1:
        own = written(own.withColumn("round", F.pmod(F.xxhash64("id", "text"), F.lit(rounds))), "items")
    for r in range(rounds):
        part = own.where(F.col("round") == r) if rounds > 1 else own
        yield [(x["id"], own_terms) for x in part.orderBy("id", "text").collect() if (own_terms := terms(x["text"]))]


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    k: int = 50,
) -> DataFrame:
    """The ``k`` best documents of every item: (``item_col``, rank, ``id_col``, score)."""
    spark = docs.sparkSession
    small_batches(spark)
    out = []
    for own in _rounds(items, item_col, item_text_col):
        if not own:
            continue
        rnd = Round(own)
        counts = written(_count_terms(docs, id_col, text_col, spark.sparkContext.broadcast(rnd.vocabulary)), "counts")
        n_docs, length = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            break
        weights = np.full(len(rnd.vocabulary), weight(n_docs, 0), np.int64)
        for term, df in _frequencies(counts, len(weights)).collect():  # the items' vocabulary at most
            weights[term] = weight(n_docs, df)
        held = spark.sparkContext.broadcast((rnd, weights, n_docs, length))
        hits = written(_score(counts, held, k), "hits")
        names = F.broadcast(spark.createDataFrame(list(enumerate(rnd.ids)), f"item int, `{item_col}` long"))  # one round's items
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
        top = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        out.append(top.join(names, "item").select(item_col, "rank", F.col("id").alias(id_col), "score"))
    if not out:
        return spark.createDataFrame([], f"`{item_col}` long, rank int, `{id_col}` long, score long")
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result
