"""Quality rules with suffix-array repetition (operator 2).

Words are ``[^\\x20\\x09-\\x0D]+``. The texts of a batch share one suffix array over word ids,
built by prefix doubling in numpy: the first rank of a word carries its document, so suffixes
of different documents never tie, and every round sorts only the suffixes still tied. Adjacent
suffixes' longest common prefixes (LCP) come from the ranks of the rounds, or, in an array beyond
``ARRAY_WORDS`` (one very long text), from a scan of the text in which the prefix of a position
is at most one word shorter than that of the position before it: memory is linear in the text,
whatever repeats in it. A position's longest
repeat is the larger LCP to its two neighbours; the union of those spans is the union of all
LCP intervals' substrings, i.e. of all maximal repeated substrings.

Verdict: a text is rejected if the words covered by repeats of ``min_repeat`` words or more are
over ``max_covered`` of its words, or if its longest repeat has over ``max_longest`` words; and
by the base rules (under 50 words, or over half its words in repeated 3-word windows).

Defined cases: null text counts as empty (0 words, so base_failed); a null id stays null;
repeated rows give repeated results; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import keep_rows, map_texts

MIN_REPEAT = 8
MAX_COVERED = 0.4
MAX_LONGEST = 300
#: Words of one suffix array; a longer single text gets an array of its own.
ARRAY_WORDS = 200_000
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64())]
    + [("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_())]
    + [("n_covered_words", pa.int64()), ("longest_repeat", pa.int64())]
)


def longest_repeats(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For every position, the words of the longest substring that starts there and occurs
    again in its document. ``ids``: word ids, ``doc``: the (ascending) document of each."""
    n = len(ids)
    best = np.zeros(n, np.int64)
    if n < 2:
        return best
    keep = n <= ARRAY_WORDS  # the ranks of all rounds
    small = np.int64 if keep else np.int32
    end = np.searchsorted(doc, doc, side="right").astype(small)
    key = doc * (int(ids.max()) + 1) + ids
    sa = np.argsort(key, kind="stable").astype(small)
    key = key[sa]
    first = np.r_[True, key[1:] != key[:-1]]
    del key
    rank = np.empty(n, small)
    rank[sa] = np.maximum.accumulate(np.where(first, np.arange(n, dtype=small), 0))
    levels, h = [rank.copy()] if keep else [], 1
    while True:
        lead = np.flatnonzero(first)
        size = np.diff(np.r_[lead, n])
        tied = np.repeat(size > 1, size)
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        act = sa[slots]
        nxt = act + h
        inside = nxt < end[act]
        key = rank[act].astype(np.int64) * (n + 1)
        key[inside] += rank[nxt[inside]] + 1
        del nxt, inside
        order = np.argsort(key, kind="stable")
        act, key = act[order], key[order]
        del order
        sa[slots] = act
        new = np.r_[True, key[1:] != key[:-1]]
        del key
        first[slots] = new
        rank[act] = slots[np.maximum.accumulate(np.where(new, np.arange(len(act)), 0))]
        if keep:
            levels.append(rank.copy())
        h *= 2
    if not keep:
        return _scanned(ids, end, sa, rank)
    pair = np.flatnonzero(levels[0][sa[1:]] == levels[0][sa[:-1]])
    a0, b0 = sa[pair], sa[pair + 1]
    a, b, lcp = a0.copy(), b0.copy(), np.zeros(len(pair), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        ok = (a < end[a0]) & (b < end[b0])
        same = np.zeros(len(pair), bool)
        same[ok] = levels[k][a[ok]] == levels[k][b[ok]]
        step = same * (1 << k)
        lcp, a, b = lcp + step, a + step, b + step
    np.maximum.at(best, a0, lcp)
    np.maximum.at(best, b0, lcp)
    return best


def _scanned(ids: np.ndarray, end: np.ndarray, sa: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """``longest_repeats`` from a suffix array, by a scan in text order."""
    n = len(ids)
    before = np.full(n, -1, sa.dtype)  # the suffix that sorts before each
    before[sa[1:]] = sa[:-1]
    codes, ends, prior, lcp = (memoryview(x) for x in (ids.astype(np.int32), end, before, np.zeros(n, np.int32)))
    h = 0
    for i in range(n):
        j = prior[i]
        if j < 0 or ends[i] != ends[j]:
            h = 0
            continue
        most = ends[i] - max(i, j)
        while h < most and codes[i + h] == codes[j + h]:
            h += 1
        lcp[i] = h
        if h:
            h -= 1
    best = np.asarray(lcp).astype(np.int64)
    np.maximum.at(best, before[before >= 0], best[before >= 0].copy())
    return best


def covered(best: np.ndarray, least: int, width: int | None = None) -> np.ndarray:
    """0/1 for each position: inside a span [p, p + best[p]) of ``least`` words or more
    (of exactly ``width`` words if given)."""
    at = np.flatnonzero(best >= least)
    edge = np.zeros(len(best) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.subtract.at(edge, at + (best[at] if width is None else width), 1)
    return (np.cumsum(edge[:-1]) > 0).astype(np.int64)


def _array(words: list[list[bytes]], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: words in repeated 3-word windows, words covered by repeats, longest repeat."""
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for ws in words for w in ws), np.int64)
    doc = np.repeat(np.arange(len(words)), [len(ws) for ws in words])
    best = longest_repeats(ids, doc)
    longest = np.zeros(len(words), np.int64)
    np.maximum.at(longest, doc, best)
    total = lambda x: np.bincount(doc, x, len(words)).astype(np.int64)
    return total(covered(best, 3, 3)), total(covered(best, least)), longest


def measure(texts: list[str], min_repeat: int = MIN_REPEAT) -> list[list]:
    """Columns n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered, longest."""
    n_words, chars, symbols, dup_lines, rows = [], [], [], [], ([], [], [])
    part: list[list[bytes]] = []
    size = 0

    def flush() -> None:
        for to, x in zip(rows, _array(part, min_repeat), strict=True):
            to.extend(x.tolist())
        part.clear()

    for t in texts:
        raw = t.encode("utf-8", "surrogatepass")
        words = raw.split()  # bytes.split cuts at exactly \x20 and \x09-\x0D
        n_words.append(len(words))
        chars.append(len(t) - sum(map(t.count, SPACES)))
        symbols.append(sum(map(t.count, SYMBOLS)))
        lines = [x for x in raw.split(b"\n") if x.strip()]
        dup_lines.append(len(lines) - len(set(lines)))
        if part and size + len(words) > ARRAY_WORDS:
            flush()
            size = 0
        part.append(words)
        size += len(words)
    if part:
        flush()
    return [n_words, chars, symbols, dup_lines, *rows]


def verdicts(m: list[list], max_covered: float, max_longest: int) -> tuple[list[bool], list[bool]]:
    failed = [n < 50 or 100 * r > 50 * n for n, r in zip(m[0], m[4], strict=True)]
    kept = [
        not f and c <= max_covered * n and x <= max_longest
        for f, n, c, x in zip(failed, m[0], m[5], m[6], strict=True)
    ]
    return failed, kept


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_repeat: int = MIN_REPEAT,
    max_covered: float = MAX_COVERED,
    max_longest: int = MAX_LONGEST,
) -> DataFrame:
    """The measures and verdict of every row (see the module's text)."""

    def per_batch(ids, texts):
        m = measure(texts, min_repeat)
        failed, kept = verdicts(m, max_covered, max_longest)
        return [ids, m[0], m[1], m[2], m[3], m[4], failed, kept, m[5], m[6]]

    return map_texts(docs, id_col, text_col, per_batch, SCHEMA)


def keep_good(docs: DataFrame, text_col: str = "text", **limits) -> DataFrame:
    """The rows of ``docs`` whose verdict is to keep; all columns as they were."""
    least = limits.get("min_repeat", MIN_REPEAT)
    most = limits.get("max_covered", MAX_COVERED), limits.get("max_longest", MAX_LONGEST)
    return keep_rows(docs, text_col, lambda texts: verdicts(measure(texts, least), *most)[1])
