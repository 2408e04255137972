"""Exact substring dedup with fixed-block anchors (operator 6).

A word is removed if some window of ``window`` words that covers it also starts earlier: in a
document with a smaller id, or earlier in the same document. Words are ``[^\\x20\\x09-\\x0D]+``.

Anchors: every document is cut into non-overlapping reference blocks of half a window, so any
window holds a whole block. Every rolling half window of every document probes them; a probe
whose content is a block and occurs elsewhere is a hit. Hits are extended to the full windows
around them; the smallest (id, start) of each such window's content is its first occurrence,
all others are repeats, and runs of repeated windows are the maximal exact repeats.

Documents are dealt to chunks by a hash of id and text, so the rows of one id, or all without an
id, are spread (only rows equal in both share a chunk). A chunk's probes go out as sorted hashes,
one entry for each distinct content, packed by hash bucket, so content that a third of all
documents share is one entry a chunk (hashes of 38 bits beside the bucket: a false hit only
costs a needless extension). Buckets answer with the hits of each chunk; the extended windows
travel the same way, with 96-bit hashes and the chunk's first occurrence, and buckets answer
with the windows that started in an earlier chunk or document. The number of chunks follows the
bytes of text. All stages run from Spark shuffles of the texts by chunk, so lost executors
repeat their chunks alone.

Defined cases: null text has no words (its digest is that of the empty string); a null id comes
after all others; rows with equal ids are one document for the order, in which the earlier start
is first, so an identical row does not remove the other; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Bytes of text in a chunk, on average; and the least number of chunks.
CHUNK_BYTES, MIN_CHUNKS = 4 << 20, 64
#: Bytes hashed at once; longer texts are hashed in parts (a longer word whole).
HASH_BYTES = 1 << 20
LAST = (1 << 63) - 1

_U = np.uint64
_RANDOM = np.random.Generator(np.random.PCG64(20))
_BYTE = _RANDOM.integers(0, 1 << 64, 256, _U)
_BASE, _WORD, _CHECK = (int(x) | 1 for x in _RANDOM.integers(0, 1 << 64, 3, _U))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BREAK = re.compile(rb"[\x20\x09-\x0D]")


@lru_cache(8)
def _powers_of(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, _U)
    out[0] = 1
    return np.cumprod(out)


def _powers(base: int, n: int) -> np.ndarray:
    return _powers_of(base, 1 << max(10, (n - 1).bit_length()))[:n] if n else np.zeros(0, _U)


def _spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash modulo 2**64 of values[start:end], from prefix sums; ``base`` is odd."""
    sums = np.zeros(len(values) + 1, _U)
    np.cumsum(values * _powers(base, len(values)), out=sums[1:])
    return (sums[ends] - sums[starts]) * _powers(pow(base, -1, 1 << 64), len(values) + 1)[starts]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _slices(text: bytes) -> Iterator[bytes]:
    """A text in parts of about ``HASH_BYTES``, cut before white space."""
    at = 0
    while len(text) - at > HASH_BYTES and (m := _BREAK.search(text, at + HASH_BYTES)):
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


class Words:
    """The words of a chunk's texts: ``hashes``, and for each word its text's index ``doc``, its
    place ``at`` in the text and how many words ``left`` from there, itself included."""

    def __init__(self, texts: list[bytes]):
        hashes, counts, part, size = [], [], [], 0
        owner = [i for i, t in enumerate(texts) for _ in _slices(t)]
        for t in (x for t in texts for x in _slices(t)):
            if part and size + len(t) > HASH_BYTES:
                hashes.append(self._hash(part, counts))
                part, size = [], 0
            part.append(t)
            size += len(t)
        hashes.append(self._hash(part, counts))
        self.hashes = np.concatenate(hashes)
        self.counts = np.zeros(len(texts), np.int64)
        np.add.at(self.counts, np.array(owner, np.int64), np.concatenate(counts))
        self.doc = np.repeat(np.arange(len(texts)), self.counts)
        first = np.cumsum(self.counts) - self.counts
        self.at = np.arange(len(self.doc)) - first[self.doc]
        self.left = self.counts[self.doc] - self.at

    @staticmethod
    def _hash(texts: list[bytes], counts: list[np.ndarray]) -> np.ndarray:
        """The words' hashes; ``counts`` gets the words of each text."""
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        space = _SPACE[raw]
        edge = np.flatnonzero(np.diff(space, prepend=True))
        starts, ends = edge[::2], edge[1::2]
        bounds = np.cumsum([len(t) + 1 for t in texts])
        counts.append(np.diff(np.searchsorted(starts, bounds), prepend=0))
        return _mixed(_spans_hash(_BYTE[raw], starts, ends, _BASE))

    def windows(self, size: int, base: int = _WORD) -> tuple[np.ndarray, np.ndarray]:
        """The places where a window of ``size`` words fits, and its hash."""
        at = np.flatnonzero(self.left >= size)
        return at, _mixed(_spans_hash(self.hashes, at, at + size, base))


def _planes(values: np.ndarray, size: int) -> bytes:
    """The ``size`` low bytes of non-negative numbers, first all the highest bytes, then all the
    next: sorted or small numbers have long runs there, which the shuffle's codec shortens."""
    planes = values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - size :]
    return planes.T.tobytes()


def _numbers(blob: bytes, size: int, at: int = 0, n: int | None = None) -> np.ndarray:
    """The ``n`` (all) numbers that ``_planes`` wrote, from byte ``at``."""
    n = len(blob) // size if n is None else n
    out = np.zeros((n, 8), np.uint8)
    out[:, 8 - size :] = np.frombuffer(blob, np.uint8, n * size, at).reshape(size, n).T
    return out.view(">u8").ravel().astype(_U)


def _packed(keys: np.ndarray) -> bytes:
    return _planes(keys, 5)


def _unpacked(blob: bytes) -> np.ndarray:
    return _numbers(blob, 5)


def _cuts(groups: np.ndarray) -> list[tuple[int, int, int]]:
    """(group, start, end) of each run of a sorted array."""
    if not len(groups):
        return []
    lead = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    return [(int(groups[s]), int(s), int(e)) for s, e in zip(lead, np.r_[lead[1:], len(groups)], strict=True)]


def _table(names: str, *cols: list) -> pa.Table:
    kinds = {"bucket": pa.int64(), "part": pa.int64(), "blob": pa.binary()}
    return pa.table([pa.array(c, kinds[n]) for n, c in zip(names.split(), cols, strict=True)], names=names.split())


class _Chunk:
    """A chunk's documents in the order of their ids."""

    def __init__(self, t: pa.Table):
        t = t.sort_by([("rank", "ascending")])
        self.ids, self.ranks = t["id"].to_pylist(), t["rank"].to_numpy()
        self.texts = [x or b"" for x in t["raw"].to_pylist()]
        self.words = Words(self.texts)
        self.part = t["part"][0].as_py()


def _firsts(chunk: _Chunk, at: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct contents of windows at the places ``at``, the index of each one's first (by
    rank, then start), and each window's content."""
    if len(np.unique(chunk.ranks)) == len(chunk.ranks):  # the first place: documents are in order
        return np.unique(h, return_index=True, return_inverse=True)
    w = chunk.words
    order = np.lexsort((w.at[at], chunk.ranks[w.doc[at]], h))
    new = np.r_[True, h[order][1:] != h[order][:-1]] if len(h) else np.zeros(0, bool)
    own = np.empty(len(h), np.int64)
    own[order] = np.cumsum(new) - 1
    return h[order][new], order[new], own


def _probes(chunk: _Chunk, window: int, buckets: int) -> pa.Table:
    """One row a bucket: 38 bits of each distinct half window's hash, a bit for a block among
    its occurrences, a bit for several occurrences. Texts too short for a window have none."""
    half, w = window // 2, chunk.words
    at, h = w.windows(half)
    fits = w.counts[w.doc[at]] >= window
    at, h = at[fits], h[fits]
    if not len(h):
        return _table("bucket part blob", [], [], [])
    order = np.argsort(h)
    h, block = h[order], w.at[at[order]] % half == 0
    lead = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    several = np.diff(np.r_[lead, len(h)]) > 1
    h, block = h[lead], np.logical_or.reduceat(block, lead)
    keys = (h >> _U(26) << _U(2)) | (block.astype(_U) << _U(1)) | several.astype(_U)
    bucket = (h % _U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket, keys = bucket[order], keys[order]
    rows = [(b, chunk.part, _packed(keys[s:e])) for b, s, e in _cuts(bucket)]
    return _table("bucket part blob", *zip(*rows, strict=True))


def _hits(t: pa.Table) -> pa.Table:
    """One bucket: for each chunk, its contents that are a block and occur more than once."""
    bucket, blobs = t["bucket"][0].as_py(), [_unpacked(x) for x in t["blob"].to_pylist()]
    part = np.repeat(t["part"].to_numpy(), [len(x) for x in blobs])
    keys = np.concatenate(blobs)
    order = np.argsort(keys >> _U(2), kind="stable")
    keys, part = keys[order], part[order]
    content = keys >> _U(2)
    lead = np.flatnonzero(np.r_[True, content[1:] != content[:-1]])
    size = np.diff(np.r_[lead, len(keys)])
    any_flag = np.bitwise_or.reduceat(keys, lead)
    hit = np.repeat((any_flag & _U(2) > 0) & ((size > 1) | (any_flag & _U(1) > 0)), size)
    content, part = content[hit], part[hit]
    order = np.argsort(part, kind="stable")
    content, part = content[order], part[order]
    cuts = _cuts(part)
    return _table("bucket part blob", [bucket] * len(cuts), [p for p, _, _ in cuts], [_packed(content[s:e]) for _, s, e in cuts])


def _extended(chunk: _Chunk, hits: pa.Table, window: int, buckets: int) -> pa.Table:
    """The full windows around the chunk's hits, one entry for each distinct content: its hash,
    a second hash, and the (rank, start) of its first occurrence in the chunk."""
    half, w = window // 2, chunk.words
    known = [_unpacked(x) << _U(26) | _U(b) for b, x in zip(hits["bucket"].to_pylist(), hits["blob"].to_pylist(), strict=True)]
    if not known:
        return _table("bucket part blob", [], [], [])
    known = np.sort(np.concatenate(known))
    at, h = w.windows(half)
    probe = (h >> _U(26) << _U(26)) | (h % _U(buckets))
    found = np.searchsorted(known, probe)
    found[found == len(known)] = 0
    hit = np.zeros(len(w.doc) + 1, np.int64)
    hit[at + 1] = known[found] == probe
    sums = np.cumsum(hit)
    at, h = w.windows(window)
    near = sums[at + window - half + 1] > sums[at]
    at, h, check = at[near], h[near], w.windows(window, _CHECK)[1][near]
    h, lead, _ = _firsts(chunk, at, h)
    if not len(h):
        return _table("bucket part blob", [], [], [])
    at, check = at[lead], check[lead]
    bucket = (h % _U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket, h, check, at = bucket[order], h[order], check[order], at[order]
    rank = chunk.ranks[w.doc[at]].astype(_U) ^ _U(1 << 63)  # signed order as unsigned order
    cols = (h, 8), (rank, 8), (check & _U(0xFFFFFFFF), 4), (w.at[at], 4)
    rows = [(b, chunk.part, b"".join(_planes(c[s:e], size) for c, size in cols)) for b, s, e in _cuts(bucket)]
    return _table("bucket part blob", *zip(*rows, strict=True))


def _later(t: pa.Table) -> pa.Table:
    """One bucket: for each chunk, the windows that another chunk holds earlier."""
    blobs = t["blob"].to_pylist()
    sizes = [len(x) // 24 for x in blobs]

    def column(size: int, before: int) -> np.ndarray:
        return np.concatenate([_numbers(x, size, before * n, n) for x, n in zip(blobs, sizes, strict=True)])

    h, rank, check, start = column(8, 0), column(8, 8), column(4, 16), column(4, 20)
    part = np.repeat(t["part"].to_numpy(), sizes)
    order = np.lexsort((start, rank, check, h))
    h, check, part, rank, start = h[order], check[order], part[order], rank[order], start[order]
    lead = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (check[1:] != check[:-1])])
    size = np.diff(np.r_[lead, len(h)])
    later = (rank != np.repeat(rank[lead], size)) | (start != np.repeat(start[lead], size))
    h, part = h[later], part[later]
    order = np.argsort(part, kind="stable")
    h, part = h[order], part[order]
    cuts = _cuts(part)
    return _table("part blob", [p for p, _, _ in cuts], [h[s:e].tobytes() for _, s, e in cuts])


_OUT = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("text", pa.string())])


def _result(chunk: _Chunk, later: pa.Table, window: int, with_text: bool) -> pa.Table:
    """The chunk's documents without the words of repeated windows."""
    w = chunk.words
    at, h = w.windows(window)
    gone = np.zeros(len(w.doc) + 1, np.int64)
    if len(h):
        _, lead, own = _firsts(chunk, at, h)
        first = at[lead][own]
        rank = chunk.ranks
        a, b = rank[w.doc[at]], rank[w.doc[first]]
        repeated = (a > b) | ((a == b) & (w.at[at] > w.at[first]))
        known = [np.frombuffer(x, _U) for x in later["blob"].to_pylist()]
        if known:
            known = np.sort(np.concatenate(known))
            found = np.searchsorted(known, h)
            found[found == len(known)] = 0
            repeated |= known[found] == h
        at = at[repeated]
        np.add.at(gone, at, 1)
        np.subtract.at(gone, at + window, 1)
    removed = np.cumsum(gone)[:-1] > 0
    ends = np.cumsum(w.counts)
    counts = np.diff(np.r_[0, np.cumsum(removed)][np.r_[0, ends]])
    digests, texts = [], []
    for t, n, end, lost in zip(chunk.texts, w.counts.tolist(), ends.tolist(), counts.tolist(), strict=True):
        words = t.split()
        if lost:
            words = [x for x, r in zip(words, removed[end - n : end].tolist(), strict=True) if not r]
        kept = b" ".join(words)
        digests.append(hashlib.sha256(kept).hexdigest())
        texts.append(kept.decode("utf-8", "replace") if with_text else None)
    cols = [chunk.ids, w.counts.tolist(), counts.tolist(), digests, texts]
    return pa.table([pa.array(c, f.type) for c, f in zip(cols, _OUT, strict=True)], schema=_OUT)


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, with_text: bool = True
) -> DataFrame:
    """One row per input row: the id, ``n_words``, ``n_removed``, ``kept_sha256`` and ``text``,
    the kept words joined by one space (null without ``with_text``). ``window`` is even."""
    if window < 2 or window % 2:
        raise ValueError("the window is an even number of words: two blocks")
    small_batches(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    chunks = min(1 << 25, max(MIN_CHUNKS, math.ceil(size / CHUNK_BYTES)))
    rank = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))
    dealt = docs.select(
        F.col(id_col).cast("long").alias("id"),
        rank.alias("rank"),
        F.pmod(F.xxhash64(rank, F.col(text_col)), F.lit(chunks)).alias("part"),
        F.col(text_col).cast("binary").alias("raw"),
    ).groupBy("part")

    rows = "bucket bigint, part bigint, blob binary"
    probes = dealt.applyInArrow(lambda t: _probes(_Chunk(t), window, chunks), rows)
    hits = probes.groupBy("bucket").applyInArrow(_hits, rows)
    wide = dealt.cogroup(hits.groupBy("part")).applyInArrow(
        lambda d, x: _extended(_Chunk(d), x, window, chunks) if len(d) else _table("bucket part blob", [], [], []), rows
    )
    later = wide.groupBy("bucket").applyInArrow(_later, "part bigint, blob binary")
    out = dealt.cogroup(later.groupBy("part")).applyInArrow(
        lambda d, x: _result(_Chunk(d), x, window, with_text) if len(d) else _OUT.empty_table(),
        "id bigint, n_words bigint, n_removed bigint, kept_sha256 string, text string",
    )
    return out.withColumnRenamed("id", id_col)
