"""Toxicity by a bidirectional gated recurrent network with attention pooling (operator 8).

Inputs of a word: what the word and its character grams (prefixes, suffixes, inner grams) say of
toxicity in the labelled sample (log odds of the texts that have them), and small learned
vectors of the word and of its grams, all hashed. A run of letters and digits of more than
``LONG`` bytes (unspaced scripts, glued words) is cut into pieces of ``PIECE`` characters, each
overlapping the next by half, which are words of their own. A window of ``WIDTH`` words goes through two
gated recurrent networks, one a direction; attention over their states gives one vector and one
logit. All windows of a text, each overlapping the next by half, are scored; the text's score
is its highest window's, calibrated on the sample.

Training (numpy, on the driver) uses at most ``SAMPLE`` labelled texts, toxic ones for up to a
third: those with the smallest hash of their id, so the same rows at every size. Log odds are
taken from other folds of the sample than a text's own, so the network learns how far to trust
them; a toxic text trains on its highest window, which changes with the network. The number of
steps is fixed. The model (about 5 MB, whatever the data) is broadcast; scoring is one pass
over the texts, without a shuffle.

Defined cases: null text counts as empty and gets the score of a window without words; rows
without a usable label or id are not learned from; without labels of both kinds every score is
0; a null id stays null and is not held out; repeated rows give repeated results; other columns
are never inputs; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import pickle
import re
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ddl, small_batches

SAMPLE = 3000
#: Characters of a text that the fit reads at most, in pieces.
FIT_CHARS, FIT_PIECES = 200_000, 20
WIDTH, STRIDE = 32, 16
STATES, VECTOR = 8, 4
GRAM_BUCKETS, WORD_ROWS, GRAM_ROWS = 1 << 20, 1 << 13, 1 << 12
FOLDS, STEPS, BATCH, RATE = 5, 320, 48, 0.02
#: Distinct words whose inputs a worker remembers.
REMEMBERED = 150_000
RUN = re.compile(r"[^\W_]+")
LONG, PIECE = 64, 16


def words(text: str) -> list[str]:
    """The words of a text in lower case, long runs in overlapping pieces."""
    out = []
    for w in RUN.findall(text.lower()):
        if len(w) > PIECE and len(w.encode("utf-8", "replace")) > LONG:
            out += [w[i : i + PIECE] for i in range(0, len(w) - PIECE // 2, PIECE // 2)]
        else:
            out.append(w)
    return out


def grams(word: str) -> list[int]:
    """Hashes of the word, then of its grams in UTF-8 bytes: prefixes, suffixes, inner ones."""
    b = word.encode("utf-8", "replace")
    n = len(b)
    out = [crc32(b, 1)]
    out += [crc32(b[:k], 2) for k in range(3, min(9, n) + 1)]
    out += [crc32(b[-k:], 3) for k in range(3, min(5, n) + 1)]
    out += [crc32(b[i : i + 4], 4) for i in range(1, n - 4)]
    return out


@dataclass
class WordTable:
    """The distinct words met so far: number of each, and the grams of each, end to end."""

    number: dict[str, int] = field(default_factory=dict)
    hashes: list[int] = field(default_factory=list)
    starts: list[int] = field(default_factory=list)

    def numbers(self, words: list[str]) -> list[int]:
        for w in set(words).difference(self.number):
            self.number[w] = len(self.number) + 1  # 0 is the padding
            self.starts.append(len(self.hashes))
            self.hashes += grams(w)
        return list(map(self.number.__getitem__, words))


def word_inputs(odds: np.ndarray, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The four log-odds inputs of each word: its own, the largest and the mean of its grams,
    and the largest of its first grams."""
    if not len(starts):
        return np.zeros((0, 4), np.float32)
    v = odds[hashes % GRAM_BUCKETS]
    size = np.diff(np.r_[starts, len(v)])
    own = v[starts]
    top, mean = np.maximum.reduceat(v, starts), np.add.reduceat(v, starts) / size
    place = np.arange(len(v)) - np.repeat(starts, size)
    first = np.maximum.reduceat(np.where((place >= 1) & (place <= 4), v, -9), starts)
    return np.stack([own, top, mean, np.maximum(first, -4)], 1).astype(np.float32)


def log_odds(docs: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Of each gram bucket, from the distinct buckets of each text; shrunk towards zero."""
    seen = [np.zeros(GRAM_BUCKETS, np.float32), np.zeros(GRAM_BUCKETS, np.float32)]
    for x, y in zip(docs, toxic, strict=True):
        seen[int(y)][x] += 1
    rates = [(s + 0.5) / (n + 1) for s, n in zip(seen, (len(toxic) - toxic.sum(), toxic.sum()), strict=True)]
    odds = np.log(rates[1]) - np.log(rates[0])
    total = seen[0] + seen[1]
    return (odds * total / (total + 2)).astype(np.float32)


def init(rng: np.random.Generator) -> dict[str, np.ndarray]:
    """The network's parameters. x: inputs to gates, u: states to gates, for both directions."""
    d, h = 4 + 2 * VECTOR, STATES
    p = {"word": rng.normal(0, 0.05, (WORD_ROWS, VECTOR)), "gram": rng.normal(0, 0.05, (GRAM_ROWS, VECTOR))}
    for way in "fb":
        p[f"x{way}"], p[f"u{way}"] = rng.normal(0, 0.3, (d, 3 * h)), rng.normal(0, 0.3, (h, 3 * h))
        p[f"c{way}"] = np.zeros(3 * h)
    p |= {"att": rng.normal(0, 0.3, (2 * h, h)), "pick": rng.normal(0, 0.3, h), "out": rng.normal(0, 0.3, 2 * h), "bias": np.full(1, -2.0)}
    return {k: v.astype(np.float32) for k, v in p.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _gru(x: np.ndarray, u: np.ndarray, back: bool, keep: bool) -> tuple[np.ndarray, list]:
    """States (T, B, H) from gate inputs x (T, B, 3H): update, reset, candidate."""
    t, b, h = x.shape[0], x.shape[1], u.shape[0]
    out, now, memory = np.empty((t, b, h), x.dtype), np.zeros((b, h), x.dtype), []
    for i in range(t - 1, -1, -1) if back else range(t):
        s = now @ u
        gates = _sigmoid(x[i, :, : 2 * h] + s[:, : 2 * h])
        z, r = gates[:, :h], gates[:, h:]
        c = np.tanh(x[i, :, 2 * h :] + r * s[:, 2 * h :])
        if keep:
            memory.append((i, now, z, r, c, s[:, 2 * h :]))
        now = c + z * (now - c)
        out[i] = now
    return out, memory


def _gru_gradient(u: np.ndarray, memory: list, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = u.shape[0]
    dx, du = np.zeros((*d_out.shape[:2], 3 * h), np.float32), np.zeros_like(u)
    carry = np.zeros(d_out.shape[1:], np.float32)
    for i, before, z, r, c, s in reversed(memory):
        g = d_out[i] + carry
        dc = g * (1 - z) * (1 - c * c)
        dz = g * (before - c) * z * (1 - z)
        dr = dc * s * r * (1 - r)
        ds = np.concatenate([dz, dr, dc * r], 1)
        dx[i] = np.concatenate([dz, dr, dc], 1)
        du += before.T @ ds
        carry = g * z + ds @ u.T
    return dx, du


def forward(p: dict, xf: np.ndarray, xb: np.ndarray, real: np.ndarray, keep: bool = False):
    """Logits of windows. xf, xb: gate inputs (T, B, 3H); real: (T, B), false at padding."""
    f, mf = _gru(xf, p["uf"], False, keep)
    b, mb = _gru(xb, p["ub"], True, keep)
    s = np.concatenate([f, b], 2)
    a = np.tanh(s @ p["att"])
    e = np.where(real, a @ p["pick"], -30.0)
    e = np.exp(e - e.max(0))
    w = e / e.sum(0)
    pooled = (w[:, :, None] * s).sum(0)
    return pooled @ p["out"] + p["bias"], (mf, mb, s, a, w, pooled, real)


def gradient(p: dict, memory: tuple, d_logit: np.ndarray) -> tuple[dict, np.ndarray, np.ndarray]:
    """Gradients of the parameters past the inputs, and of the gate inputs of both ways."""
    mf, mb, s, a, w, pooled, real = memory
    g = {"out": pooled.T @ d_logit, "bias": d_logit.sum(keepdims=True)}
    d_pooled = d_logit[:, None] * p["out"]
    ds = w[:, :, None] * d_pooled
    dw = (s * d_pooled).sum(2)
    de = w * (dw - (w * dw).sum(0)) * real
    g["pick"] = np.einsum("tb,tbh->h", de, a)
    da = de[:, :, None] * p["pick"] * (1 - a * a)
    g["att"] = np.einsum("tbi,tbj->ij", s, da)
    ds = ds + da @ p["att"].T
    h = p["uf"].shape[0]
    dxf, g["uf"] = _gru_gradient(p["uf"], mf, ds[:, :, :h])
    dxb, g["ub"] = _gru_gradient(p["ub"], mb, ds[:, :, h:])
    return g, dxf, dxb


def inputs(p: dict, stats: np.ndarray, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A row of inputs a word, after one for the padding."""
    out = np.zeros((len(starts) + 1, 4 + 2 * VECTOR), np.float32)
    if len(starts):
        out[1:, :4] = stats
        out[1:, 4 : 4 + VECTOR] = p["word"][hashes[starts] % WORD_ROWS]
        size = np.diff(np.r_[starts, len(hashes)])[:, None]
        out[1:, 4 + VECTOR :] = np.add.reduceat(p["gram"][hashes % GRAM_ROWS], starts, axis=0) / size
    return out


def windows(numbers: list[int]) -> np.ndarray:
    """The overlapping windows of a text's word numbers, the last one padded; at least one."""
    n = len(numbers)
    count = 1 if n <= WIDTH else -(-(n - WIDTH) // STRIDE) + 1
    flat = np.zeros((count - 1) * STRIDE + WIDTH, np.int32)
    flat[:n] = numbers
    return np.lib.stride_tricks.sliding_window_view(flat, WIDTH)[::STRIDE]


def logits(p: dict, rows: np.ndarray, wins: np.ndarray, part: int = 2048) -> np.ndarray:
    """Of windows (B, T) of word numbers, from the words' input rows."""
    gf, gb = rows @ p["xf"] + p["cf"], rows @ p["xb"] + p["cb"]
    out = []
    for at in range(0, len(wins), part):
        w = wins[at : at + part].T
        out.append(forward(p, gf[w], gb[w], w > 0)[0])
    return np.concatenate(out)


def train(texts: list[str], toxic: list[int], steps: int = STEPS, seed: int = 8) -> dict:
    """The model: parameters, log odds and calibration (see the module's text)."""
    rng = np.random.default_rng(seed)
    y = np.array(toxic, np.int64)
    if not len(y) or y.min() == y.max():
        return {}
    table = WordTable()
    numbers = [table.numbers(words(t)) for t in texts]
    hashes, starts = np.array(table.hashes, np.int64), np.array(table.starts, np.int64)
    ends = np.r_[starts[1:], len(hashes)]
    doc_grams = []
    for x in numbers:
        own = np.unique(np.array(x, np.int64)) - 1
        parts = [hashes[starts[w] : ends[w]] for w in own]
        doc_grams.append(np.unique(np.concatenate(parts) % GRAM_BUCKETS) if parts else np.zeros(0, np.int64))
    fold = np.empty(len(y), np.int64)
    for c in (0, 1):
        at = np.flatnonzero(y == c)
        fold[at] = np.arange(len(at)) % FOLDS
    stats = []
    for k in range(FOLDS):
        others = np.flatnonzero(fold != k)
        odds = log_odds([doc_grams[i] for i in others], y[others])
        stats.append(word_inputs(odds, hashes, starts))
    wins = [windows(x) for x in numbers]

    # Each window starts with what its words' log odds say; the network replaces that.
    hint = [np.r_[[0.0], np.maximum(0, x[:, :2].max(1))] for x in stats]
    best = [w[np.argmax(hint[k][w].max(1))] for w, k in zip(wins, fold, strict=True)]
    p = init(rng)
    momentum = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in p.items()}
    kinds = [np.flatnonzero(y == c) for c in (0, 1)]
    for step in range(1, steps + 1):
        if step % (steps // 4) == 0:  # the windows that the network now thinks most toxic
            best = [w[i] for w, i in zip(wins, _tops(p, stats, hashes, starts, wins, fold)[1], strict=True)]
        picked = np.concatenate([rng.choice(c, BATCH // 2) for c in kinds])
        for k in [step % FOLDS]:  # one fold's log odds a step
            own = picked[fold[picked] == k]
            if len(own) < 4:
                own = np.flatnonzero(fold == k)[:BATCH]
            extra = [wins[i][rng.integers(len(wins[i]))] for i in own if y[i] == 0]
            w = np.stack([*(best[i] for i in own), *extra])
            target = np.r_[y[own], np.zeros(len(extra))].astype(np.float32)
            _step(p, momentum, stats[k], hashes, starts, w, target, step)
    top, _ = _tops(p, stats, hashes, starts, wins, fold)
    return {"p": p, "odds": log_odds(doc_grams, y).astype(np.float16), "scale": _calibrated(top, y)}


def _tops(p, stats, hashes, starts, wins, fold) -> tuple[np.ndarray, list[int]]:
    """Each text's highest logit and its window, with the log odds of the other folds."""
    top, at = np.zeros(len(wins)), [0] * len(wins)
    for k in range(FOLDS):
        own = np.flatnonzero(fold == k)
        if len(own):
            flat = logits(p, inputs(p, stats[k], hashes, starts), np.concatenate([wins[i] for i in own]))
            for i, x in zip(own, np.split(flat, np.cumsum([len(wins[i]) for i in own])[:-1]), strict=True):
                at[i] = int(np.argmax(x))
                top[i] = x[at[i]]
    return top, at


def _step(p, momentum, stats, hashes, starts, w, target, step) -> None:
    """One Adam step on the windows ``w``; only their words are looked up."""
    words, local = np.unique(w, return_inverse=True)
    words = words[words > 0]
    local = local.reshape(w.shape) + (0 if (w == 0).any() else 1)
    ends = np.r_[starts[1:], len(hashes)]
    parts = [hashes[starts[x - 1] : ends[x - 1]] for x in words]
    h = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    s = np.cumsum([0, *map(len, parts)])[:-1].astype(np.int64) if parts else np.zeros(0, np.int64)
    rows = inputs(p, stats[words - 1], h, s)
    x = rows[local.T]
    logit, memory = forward(p, x @ p["xf"] + p["cf"], x @ p["xb"] + p["cb"], w.T > 0, keep=True)
    g, dxf, dxb = gradient(p, memory, ((_sigmoid(logit) - target) / len(target)).astype(np.float32))
    flat = x.reshape(-1, x.shape[2])
    d_rows = np.zeros_like(rows)
    for way, dx in (("f", dxf), ("b", dxb)):
        dx = dx.reshape(len(flat), -1)
        g[f"x{way}"], g[f"c{way}"] = flat.T @ dx, dx.sum(0)
        np.add.at(d_rows, local.T.ravel(), dx @ p[f"x{way}"].T)
    if len(s):
        size = np.diff(np.r_[s, len(h)])
        g["word"], g["gram"] = np.zeros_like(p["word"]), np.zeros_like(p["gram"])
        np.add.at(g["word"], h[s] % WORD_ROWS, d_rows[1:, 4 : 4 + VECTOR])
        np.add.at(g["gram"], h % GRAM_ROWS, np.repeat(d_rows[1:, 4 + VECTOR :] / size[:, None], size, axis=0))
    for k, d in g.items():
        m, v = momentum[k]
        m += 0.1 * (d - m)
        v += 0.01 * (d * d - v)
        unbiased = np.sqrt(v / (1 - 0.99**step)) + 1e-6
        p[k] -= RATE * (m / (1 - 0.9**step) / unbiased + 0.01 * p[k]).astype(np.float32)


def _calibrated(top: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit of the labels on the highest logits (Newton steps,
    with a small ridge so that separable classes stay finite)."""
    x = np.stack([top, np.ones(len(top))], 1)
    v = np.array([1.0, 0.0])
    for _ in range(25):
        q = _sigmoid(x @ v)
        hess = (x * (q * (1 - q))[:, None]).T @ x + 0.05 * np.eye(2)
        v = v - np.clip(np.linalg.solve(hess, x.T @ (q - y) + 0.05 * (v - [1.0, 0.0])), -2, 2)
    return (float(v[0]), float(v[1])) if v[0] > 0 else (1.0, 0.0)


class Scorer:
    """A model with the input rows of the words met so far."""

    def __init__(self, model: dict):
        self.model, self.odds = model, model["odds"].astype(np.float32)
        self._forget()

    def _forget(self) -> None:
        self.table = WordTable()
        p = self.model["p"]
        first = inputs(p, np.zeros((0, 4), np.float32), np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.gates = [[first @ p[f"x{w}"] + p[f"c{w}"]] for w in "fb"]

    def _gates(self) -> list[np.ndarray]:
        """The words' gate inputs; those of new words are added."""
        t, p = self.table, self.model["p"]
        if t.starts:
            h, s = np.array(t.hashes, np.int64), np.array(t.starts, np.int64)
            rows = inputs(p, word_inputs(self.odds, h, s), h, s)[1:]
            for w, g in zip("fb", self.gates, strict=True):
                g[:] = [np.concatenate([*g, rows @ p[f"x{w}"] + p[f"c{w}"]])]
            t.hashes, t.starts = [], []
        return [g[0] for g in self.gates]

    def scores(self, texts: list[str]) -> np.ndarray:
        if len(self.table.number) > REMEMBERED:
            self._forget()
        wins = [windows(self.table.numbers(words(t))) for t in texts]
        gf, gb = self._gates()
        p, flat, out = self.model["p"], np.concatenate(wins), []
        for at in range(0, len(flat), 2048):
            w = flat[at : at + 2048].T
            out.append(forward(p, gf[w], gb[w], w > 0)[0])
        counts = [len(w) for w in wins]
        top = np.maximum.reduceat(np.concatenate(out), np.cumsum([0, *counts])[:-1])
        slope, offset = self.model["scale"]
        return _sigmoid(slope * top.astype(np.float64) + offset)


@functools.lru_cache(1)
def _scorer(blob: bytes) -> Scorer:
    return Scorer(pickle.loads(blob))


def held_out(id_col: str, folds: int = 5):
    """Whether a row's label may not be learned from: crc32 of its id as text is divisible."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int = SAMPLE) -> dict:
    """The model of the sampled labelled rows that are not held out: at most ``sample`` ids, those of
    the smallest hashes, and of each id the row whose text has the smallest hash. Of a text beyond
    ``FIT_CHARS`` characters, ``FIT_PIECES`` pieces at equal distances are learned from (a bound of
    the fit; scoring reads whole texts)."""
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    usable = usable.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    order = F.xxhash64("id")
    toxic = usable.where("y = 1").orderBy(order, "id").limit(sample // 3)
    others = usable.where("y = 0").orderBy(order, "id").limit(sample - sample // 3)
    chosen = F.broadcast(toxic.union(others))  # at most ``sample`` rows of two numbers
    length, piece = "length(text)", FIT_CHARS // FIT_PIECES
    starts = f"transform(sequence(0, {FIT_PIECES - 1}), i -> 1 + CAST(i * CAST({length} - {piece} AS BIGINT) DIV {FIT_PIECES - 1} AS INT))"
    pieces = f"array_join(transform({starts}, s -> substring(text, s, {piece})), ' ')"
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).join(chosen, "id")
    own = own.selectExpr("id", "y", "xxhash64(text) AS hash", f"CASE WHEN {length} > {FIT_CHARS} THEN {pieces} ELSE text END AS text")
    one = own.groupBy("id", "y").agg(F.min(F.struct("hash", "text")).alias("row")).select("id", "y", "row.text")
    rows = sorted(one.collect(), key=lambda r: r["id"])
    return train([r["text"] for r in rows], [r["y"] for r in rows])


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, ``score`` and ``predicted``."""
    spark = docs.sparkSession
    small_batches(spark)
    blob = spark.sparkContext.broadcast(pickle.dumps(model)) if model else None
    schema = pa.schema([("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches):
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            if not texts:
                continue
            s = _scorer(blob.value).scores(texts) if blob else np.zeros(len(texts))
            cols = [b.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, names=[id_col, *schema.names])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, {ddl(schema)}")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Learn from ``labels`` and score every document: the id, ``held_out``, ``score`` and
    ``predicted``."""
    scored = score(docs, learn(docs, labels, id_col, text_col, label_col), id_col, text_col)
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score", "predicted")
