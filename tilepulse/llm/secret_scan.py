"""Secret scans with password guess costs (operator 10).

Base kinds (assign, access, hex) follow their patterns over the whole text, leftmost and
non-overlapping per kind, and drop what is too short. The method adds ``password`` spans: the
value after a credential word is kept if guessing it is dear. Its guess cost is the cheapest
segmentation into dictionary words, dates, repeats, keyboard or alphabet walks and brute-force
characters, found by dynamic programming; costs are decimal logarithms and add up. A word costs
its rank: among common passwords, or among the words of the documents themselves, ranked by the
number of documents that hold them (``corpus_words``; counted outside of credential values, so
that a password in many copies does not become a word). At most the ``DICTIONARY`` most frequent
words are broadcast, 2 MB; words of the count at which that bound is passed are left out. A value ends
at a blank, at the quote that it was opened with, or before the next field (``&``, ``,`` or ``;``
with a name and ``=`` or ``:``). A context that another one introduces has the value; contexts
inside a kept value are part of it, those inside a dropped one are read. After ``Authorization``
a scheme such as ``Bearer`` or ``Basic`` is skipped; ``Bearer`` and blanks is a context by itself.
After such blanks, and after "is" or "was" in four languages, one plain word is prose.

Texts are scanned as Latin-1 bytes, one per code point ("?" for others), so byte offsets are
code-point offsets. Scans are linear; the cost is linear in the value, as segments other than
repeats and walks have bounded length, and those are taken at their full length.

Defined cases: null or empty text has no spans; a null id stays null; repeated rows give
repeated results; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written
from .pii import _ARROW_SPANS, SPAN

BASE_KINDS = ("assign", "access", "hex")
KINDS = BASE_KINDS + ("password",)
#: A value in credential context counts from this many decimal digits of guesses.
MIN_COST = 8.0
MIN_VALUE, MAX_DATE = 6, 10
#: Words of the documents that are known to the guesser, of at most MAX_WORD letters.
DICTIONARY, MAX_WORD = 50_000, 20
#: Words that a task counts before it passes its counts on.
COUNT_WORDS = 400_000

ASSIGN = re.compile(
    rb"((?i:password|passwd|secret|token|api_?key))[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_WORDS = (b"passw", b"secret", b"token", b"api")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
#: Credential words beyond the base ones, and "is"/"was" beside ":" and "=".
CONTEXT = re.compile(
    rb"(?i)(?<![A-Za-z])(?:passwords?|passwd|passphrase|passcode|pwd|pass|secret(?:[ _-]?key)?|token|api[ _-]?key|"
    rb"private[ _-]?key|credentials?|auth(?:orization)?|bearer|pin|kennwort|passwort|mot de passe|contrase.a)"
    rb"[\"']?(?:\s*+[:=]\s*+|(?P<verb>\s++(?:is|was|ist|est|es)\s++)|(?<=bearer)(?P<blanks>\s++))[\"']?"
)
#: The scheme between "Authorization:" and its value.
SCHEME = re.compile(rb"(?i)(?:bearer|basic|token|digest|apikey|negotiate)\s++[\"']?(?=[!-~])")
PROSE = re.compile(rb"[A-Za-z]?[a-z'-]{0,19}")
CONTEXT_WORDS = (b"pass", b"pwd", b"secret", b"token", b"api", b"key", b"credential", b"auth", b"bearer", b"pin", b"kennwort", b"contrase")
#: The next field, or the end of an attribute.
_FIELD = rb"(?=[\"']?[}\])]?(?:&amp;|[&,;])[{\[(]?[\"']?[A-Za-z_][A-Za-z0-9_.-]{0,40}[\"']?[:=]|[\"'](?:[>}\])]|[,;](?![!-~]))|[^!-~]|\Z)"
VALUE = re.compile(rb"[!-~]+?" + _FIELD)
#: After an opening quote: up to the next one, unless escaped (without one, as ``VALUE``).
QUOTED = {q: re.compile(rb"(?:\\[!-~]|[!-\[\]-~])+?(?=%b)" % q) for q in (b'"', b"'")}
_HEX = bytes(120 if chr(c) in "0123456789abcdef" else 32 for c in range(256))
_HEX_RUN = re.compile(rb"x{32,}")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

# Common words of passwords, most common first.
COMMON = (
    "password pass admin welcome login letmein qwerty dragon monkey master shadow sunshine princess football "
    "baseball superman batman iloveyou trustno secret hello freedom whatever michael jordan charlie summer winter "
    "spring autumn flower cheese computer internet server root user guest test demo default changeme example "
    "sample token key api service system private public access account hunter ranger killer pepper ginger cookie "
    "chocolate orange banana apple silver golden purple black white green yellow blue love angel star money happy "
    "lucky tiger lion eagle bear wolf horse house home family friend mother father sister brother january february "
    "march april june july august september october november december monday tuesday wednesday thursday friday"
).split()
_WORD = re.compile(r"[^\W\d_]+")
LEET = str.maketrans("@4301!$57", "aaeoiisst")
WALKS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz", "1qaz2wsx3edc4rfv5tgb")
_STEPS = {(w[i], w[i + 1]) for w in WALKS for i in range(len(w) - 1)}
_STEPS |= {(b, a) for a, b in _STEPS}
DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0?[1-9]|1[0-2])(?:[-/.]?(?:0?[1-9]|[12]\d|3[01]))?)?|(?:0?[1-9]|[12]\d|3[01])[-/.](?:0?[1-9]|1[0-2])[-/.](?:19|20)?\d\d")


def _char_cost(c: str) -> float:
    return math.log10(10 if c.isdigit() else 26 if c.islower() else 52 if c.isupper() else 33)


class Dictionary:
    """Ranked words as a trie over prefixes: a prefix that starts no word ends the search."""

    def __init__(self, words: list[str] = ()):
        self.node: dict[str, int] = {}  # a prefix's rank as a word, 0 if it is only a prefix
        for ranked in (COMMON, words):
            for rank, w in enumerate(ranked, 1):
                if len(w) <= MAX_WORD:
                    if not 0 < self.node.get(w, 0) <= rank:
                        self.node[w] = rank
                    for k in range(1, len(w)):
                        self.node.setdefault(w[:k], 0)

    def words_at(self, text: str, at: int) -> list[tuple[int, int]]:
        """(end, rank) of the words of three letters and more that start at a place."""
        out = []
        for end in range(at + 1, min(len(text), at + MAX_WORD) + 1):
            rank = self.node.get(text[at:end])
            if rank is None:
                break
            if rank and end - at >= 3:
                out.append((end, rank))
        return out


_PASSWORDS_ONLY = Dictionary()


def guess_cost(value: str, dictionary: Dictionary = _PASSWORDS_ONLY) -> float:
    """Decimal logarithm of the guesses the cheapest segmentation needs."""
    n = len(value)
    low = value.lower()
    plain = low.translate(LEET)
    best = [0.0] + [math.inf] * n
    run_end, walk_end = list(range(1, n + 1)), list(range(1, n + 1))
    for i in range(n - 2, -1, -1):
        if value[i] == value[i + 1]:
            run_end[i] = run_end[i + 1]
        if (low[i], low[i + 1]) in _STEPS:
            walk_end[i] = walk_end[i + 1]
    forms = [(low, 0.0)] if plain == low else [(low, 0.0), (plain, 0.5)]
    for i in range(n):
        here = best[i]
        best[i + 1] = min(best[i + 1], here + _char_cost(value[i]))
        for form, extra in forms:
            for j, rank in dictionary.words_at(form, i):
                cased = 0.0 if value[i:j] == low[i:j] else 0.5
                best[j] = min(best[j], here + math.log10(rank + 1) + extra + cased)
        if value[i].isdigit() and (m := DATE.match(value, i, min(n, i + MAX_DATE))):
            for j in {m.end(), i + 4} if value[i : i + 2] in ("19", "20") and i + 4 <= n else {m.end()}:
                if value[i:j].strip("0123456789-/.") == "":
                    best[j] = min(best[j], here + (2.1 if j - i <= 4 else 4.6))
        if (j := run_end[i]) - i >= 3:
            best[j] = min(best[j], here + _char_cost(value[i]) + math.log10(j - i))
        if (j := walk_end[i]) - i >= 3:
            best[j] = min(best[j], here + 1.7 + math.log10(j - i))
    return best[n]


def find_spans(text: str, dictionary: Dictionary = _PASSWORDS_ONLY) -> list[tuple[str, int, int, float]]:
    """All spans (kind, start, end, score) of a text, by start, then kind as in ``KINDS``. The
    score of a ``password`` span is its guess cost, of a base span its value's."""
    raw = text.encode("latin-1", "replace")
    low = raw.translate(_LOWER)
    found = []
    if any(w in low for w in ASSIGN_WORDS):
        found += [("assign", *m.span(), m.span(2)) for m in ASSIGN.finditer(raw) if len(m[2]) >= 8]
    if b"AKIA" in raw:
        found += [("access", *m.span(), m.span()) for m in ACCESS.finditer(raw) if len(m[0]) >= 16]
    found += [("hex", *m.span(), m.span()) for m in _HEX_RUN.finditer(raw.translate(_HEX))]
    out = [(k, s, e, round(guess_cost(raw[a:b].decode("latin-1"), dictionary), 3)) for k, s, e, (a, b) in found]
    if any(w in low for w in CONTEXT_WORDS):
        at = end = 0  # end: of the last kept value
        while m := CONTEXT.search(raw, at):
            at = start = m.end()
            blanks = m["blanks"] is not None or m["verb"] is not None
            if m[0][:4].lower() == b"auth" and (scheme := SCHEME.match(raw, at)):
                at = start = scheme.end()
                blanks = True
            if start < end or CONTEXT.match(raw, start):  # part of a value, or the next context has it
                continue
            v = (q := QUOTED.get(raw[start - 1 : start])) and q.match(raw, start) or VALUE.match(raw, start)
            value = v[0].rstrip(b"\"',;.)]}>") if v else b""
            if len(value) < MIN_VALUE or blanks and PROSE.fullmatch(value):
                continue
            if (cost := guess_cost(value.decode("latin-1"), dictionary)) >= MIN_COST:
                end = start + len(value)
                out.append(("password", start, end, round(cost, 3)))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


_VALUES = re.compile(CONTEXT.pattern + rb"\S*")


def plain_words(text: str) -> set[str]:
    """The distinct words of a text, lower-case, without its credential values."""
    raw = text.encode("latin-1", "replace")
    if any(w in raw.translate(_LOWER) for w in CONTEXT_WORDS):
        raw = _VALUES.sub(b" ", raw)
    return {w for w in _WORD.findall(raw.decode("latin-1").lower()) if 3 <= len(w) <= MAX_WORD}


def corpus_words(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY) -> list[str]:
    """At most ``size`` words that most documents hold (two at least), most frequent first: those of
    the least count at which they are not more than ``size``. Each task adds up its documents and
    passes on a row a word; the driver gets a row a count, and the words."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(counts: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

        counts: Counter = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                counts.update(plain_words(t or ""))
            if len(counts) > COUNT_WORDS:
                yield rows(counts)
                counts = Counter()
        yield rows(counts)

    counted = docs.select(F.col(text_col)).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counted = written(counted.where("n > 1"), "words")
    least, held = None, 0
    for r in sorted(counted.groupBy("n").count().collect(), reverse=True):
        held += r["count"]
        if held > size:
            break
        least = r["n"]
    if least is None:
        return []
    kept = counted.where(F.col("n") >= least).collect()
    return [r["word"] for r in sorted(kept, key=lambda r: (-r["n"], r["word"]))]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dictionary_size: int = DICTIONARY) -> DataFrame:
    """One row per input row: the id and ``spans``, an array of (kind, start, end, score). Reads the
    texts twice: for the words of the dictionary, and for the spans."""
    spark = docs.sparkSession
    small_batches(spark)
    schema = docs.select(F.col(id_col)).schema
    words = spark.sparkContext.broadcast(corpus_words(docs, text_col, dictionary_size))

    def run(batches):
        dictionary = Dictionary(words.value)
        for b in batches:
            spans = [
                [dict(zip(("kind", "start", "end", "score"), x, strict=True)) for x in find_spans(t or "", dictionary)]
                for t in b.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, _ARROW_SPANS)], names=[id_col, "spans"])

    out = f"`{id_col}` {schema[0].dataType.simpleString()}, spans array<{SPAN}>"
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, out)
