"""Benchmark decontamination by template windows (operator 4), DataFrame functions only.

Text becomes template tokens in a few regular-expression passes: numbers with the unit behind them
(and number words) and names (words with a capital and small letters inside a sentence) become
typed slots that carry their filler; the rest is lower-cased words without punctuation. Every
rolling window of ``window`` tokens of every document is hashed without the fillers and joined
with the windows of the benchmark, so a question asked again with other numbers, names or units
still meets itself. A word with a capital that opens a sentence may be a name or not: its windows
are hashed under both readings, as a slot of its own type and as a plain word.

Matches of one document and item on one diagonal (the distance of their places) are one
alignment. A filler of the benchmark is torn if it has several fillers in the document, per
type; two fillers of the benchmark may become one. Without torn fillers all windows count. Else
those count whose slots are not torn or hold the benchmark's own filler, if one of them has a
filler at all: plain words alone do not make up for a torn filler. Words that open sentences may
change without being taken for torn fillers, but a window with such a word counts only if its
other readings agree with it. Windows with fewer than
``min_literals`` plain words prove nothing by their template, so they count only if their
fillers are the benchmark's own. An alignment is a leak if at least ``min_windows`` of its
windows count (or all that the item has).

Nothing is paired by way of a template alone. A document's windows first meet the distinct
templates of the benchmark; the stretches of a document in which enough of them lie are told apart
by a digest of their windows, and each distinct one meets the items once, so a phrase that many
items and many documents share costs one row an item and one a document.

The benchmark's windows are broadcast only if they are measured to be few; else both sides are
shuffled by window hash.

An item shorter than a window is one window of its own length, which tells only by its own
fillers: a document leaks it if it has the item's tokens in a row.

Defined cases: null or empty texts have no windows; rows of equal id and text are one document, a null id is an id of its own; other columns are
not read; an empty benchmark or table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

WINDOW, MIN_LITERALS, MIN_WINDOWS = 8, 5, 3
#: The benchmark's windows are broadcast up to this many.
BROADCAST_WINDOWS = 200_000
# Number words and units of measure.
NUMBER_WORDS = (
    "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
UNITS = (
    "kg g mg lb lbs oz ton tons km m cm mm mi mile miles ft feet foot inch inches yard yards l ml litre litres liter "
    "liters gallon gallons hour hours minute minutes second seconds day days week weeks month months year years "
    "percent dollar dollars euro euros pound pounds cent cents degree degrees mph kmh"
).split()
#: A slot is SLOT, its type, FILLER, its filler. A number takes along the unit after it.
SLOT, FILLER = "\x01", "\x02"
BLANKS = r"[\x09-\x0D\x20]+"
NAME = r"(?<=[\p{Ll}\p{Nd},;]\x20)\p{Lu}\p{Ll}[\p{L}\p{Nd}]*"
#: Any other word with a capital: it opens a sentence, or follows a quote or bracket.
OPENER = r"(?<![\p{L}\p{Nd}\x02])\p{Lu}\p{Ll}[\p{L}\p{Nd}]*"
NUMBER = (
    r"(?<![\p{L}\p{Nd}])([0-9]+)(?:[.,:/-]([0-9]+))?(?:[.,:/-]([0-9]+))?"
    rf"(?:[ -]?((?i:{'|'.join(sorted(UNITS, key=len, reverse=True))}))(?![\p{{L}}\p{{Nd}}]))?"
)
PUNCTUATION = r"[^\p{L}\p{Nd}\x01\x02]+"


def _slot(kind: str, filler: str) -> str:
    return f"{SLOT}{kind}{FILLER}{filler}"


OPEN = f"{SLOT}open{FILLER}"


def _is_open(token: Column) -> Column:
    return F.startswith(token, F.lit(OPEN))


def _plain(token: Column) -> Column:
    """A token in the reading where a word that opens a sentence is a plain word."""
    return F.when(_is_open(token), F.substring_index(token, FILLER, -1)).otherwise(token)


def _tokens(text: Column) -> Column:
    """The template tokens of a text; slots carry their fillers, all in lower case."""
    text = F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")
    text = F.regexp_replace(text, NAME, _slot("name", "$0"))
    text = F.regexp_replace(text, OPENER, _slot("open", "$0"))
    text = F.regexp_replace(text, NUMBER, _slot("num", "$1p$2p$3u$4"))
    words = F.split(F.btrim(F.regexp_replace(F.lower(text), PUNCTUATION, " ")), " ")
    numbers = [*NUMBER_WORDS, *(OPEN + w for w in NUMBER_WORDS)]
    number = lambda t: F.concat(F.lit(_slot("num", "")), _plain(t))
    return F.transform(words, lambda t: F.when(t.isin(numbers), number(t)).otherwise(t))


def _is_slot(token: Column) -> Column:
    return F.startswith(token, F.lit(SLOT))


def _doubled(h: str, n: int) -> Column:
    """From the hashes of ``n`` tokens at each place those of 2n (meaningless at the end)."""
    return F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + n)))


def _places(h: str, length: int) -> Column:
    """Of the hashes ``h``, one a token, those at which ``length`` tokens start."""
    return F.slice(h, F.lit(1), F.greatest(F.size("tokens") - (length - 1), F.lit(0)))


def _short(length: int) -> Column:
    """The hashes of the windows of ``length`` tokens, fewer than a whole window: hashes of powers
    of two, joined."""
    powers = [n for n in (1 << k for k in range(length.bit_length())) if length & n]
    starts = [sum(powers[:k]) for k in range(len(powers))]
    more = lambda i: [F.get(f"h{n}", i + at) for n, at in zip(powers[1:], starts[1:], strict=True)]
    return F.transform(_places(f"h{powers[0]}", length), lambda x, i: F.xxhash64(F.lit(length), x, *more(i)))


def _windows(texts: DataFrame, keys: list[str], window: int, short: list[int]) -> DataFrame:
    """One row a window of ``window`` tokens, or as many as in ``short``, and reading: keys, the
    hash ``h`` of its template, and what ``_placed`` needs to cut it: its number ``nth`` among the
    text's and the whole text's ``tokens``, in both readings (``plain``). Together with the join this
    stays in one generated loop over longs, where a text's arrays are held once and not copied to
    its windows, as long as nothing behind the join needs a lambda."""
    cut = texts.select(*keys, _tokens(F.col("text")).alias("tokens"))
    cut = cut.withColumn("plain", F.transform("tokens", _plain))
    kind = lambda t: F.when(_is_slot(t), F.substring_index(t, FILLER, 1)).otherwise(t)
    cut = cut.withColumn("h", F.transform("plain", lambda t: F.xxhash64(kind(t))))
    slot = F.xxhash64(F.lit(OPEN))
    cut = cut.withColumn("g", F.transform("tokens", lambda t, i: F.when(_is_open(t), slot).otherwise(F.get("h", i))))
    n = 1
    while n < window:
        if short:
            cut = cut.withColumn(f"h{n}", F.col("h"))
        cut = cut.withColumns({"h": _doubled("h", n), "g": _doubled("g", n)})
        n *= 2
    # A window without such words comes twice, which the sets behind the join undo: to find out here
    # would take a lambda, and with one the generator leaves the generated loop.
    hashes = F.concat(_places("h", window), _places("g", window), *map(_short, short))
    return cut.select(*keys, "tokens", "plain", F.posexplode(hashes).alias("nth", "h"))


def _placed(found: DataFrame, window: int, short: list[int]) -> DataFrame:
    """``found`` with each window's place ``pos``, ``length`` and reading ``opened`` (whether words that
    open sentences are slots in it), from its number. Without short windows that is two small
    expressions: what follows the join must not outgrow the method that the JVM compiles."""
    size = lambda length: F.greatest(F.size("tokens") - (length - 1), F.lit(0))
    if not short:
        opened = F.col("nth") >= size(window)
        pos = F.col("nth") - F.when(opened, size(window)).otherwise(0)
        return found.withColumns({"pos": pos, "opened": opened, "length": F.lit(window)})
    kinds = [(window, False), (window, True), *((length, False) for length in short)]
    starts, at = [], F.lit(0)
    for length, _ in kinds:
        starts.append(at)
        at = at + size(length)
    out: dict[str, Column] = {}
    for k, ((length, opened), start) in reversed(list(enumerate(zip(kinds, starts, strict=True)))):
        here = {"pos": F.col("nth") - start, "length": F.lit(length), "opened": F.lit(opened)}
        out = {c: v if c not in out else F.when(F.col("nth") < starts[k + 1], v).otherwise(out[c]) for c, v in here.items()}
    return found.withColumns(out)


def _cut() -> Column:
    """A window's tokens, in its reading."""
    own = [F.slice(c, F.col("pos") + 1, F.col("length")) for c in ("tokens", "plain")]
    return F.when(F.col("opened"), own[0]).otherwise(own[1])


def _key(tokens: str) -> Column:
    """What a window must have in common with an item's to count: its template ``h`` if that tells, else
    its tokens too."""
    return F.when(F.col("telling"), F.col("h")).otherwise(F.xxhash64("h", tokens))


def benchmark_windows(benchmark: DataFrame, item_col: str, text_col: str, window: int, min_literals: int) -> DataFrame:
    """The index: hash, item, place, length and tokens of each window of the items, and whether
    it has enough plain words to tell by its template (never if it is a short item)."""
    texts = benchmark.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("text"))
    short = list(range(1, window))
    w = _placed(_windows(texts, ["item_id"], window, short), window, short)
    w = w.where((F.col("length") == window) | ((F.col("length") == F.size("tokens")) & (F.get("tokens", F.lit(0)) != "")))
    w = w.select("item_id", F.col("pos").alias("at"), "h", _cut().alias("theirs"), F.col("length").alias("item_length"), "opened")
    w = w.where(~F.col("opened") | F.exists("theirs", _is_open)).drop("opened")
    telling = (F.col("item_length") == window) & (F.size(F.filter("theirs", _is_slot)) <= window - min_literals)
    return w.withColumn("telling", telling).withColumn("key", _key("theirs"))


def _torn() -> Column:
    """The fillers of the benchmark that have several in the document."""
    theirs = F.array_distinct(F.transform("slots", lambda s: s["theirs"]))
    several = F.filter(theirs, lambda t: F.size(F.filter("slots", lambda s: s["theirs"] == t)) > 1)
    return F.when(F.size("slots") > F.size(theirs), several).otherwise(F.slice(theirs, 1, 0))


def _typed(slot: Column) -> Column:
    return ~_is_open(slot["theirs"])


def _untorn(window: Column) -> Column:
    return F.forall(window["slots"], lambda s: (s["theirs"] == s["ours"]) | ~F.array_contains("torn", s["theirs"]))


def _stretches(docs: DataFrame, index: DataFrame, window: int, min_windows: int, small: bool, lengths: list[int]) -> DataFrame:
    """The parts of the documents that may hold a leak: ``doc_id``, ``text_hash``, ``windows`` (place
    from the start of the part, ``key``, tokens) and their digest ``shape``.

    A document's windows meet one row a template, not one an item, however many items share it. Where
    a window lies beyond the longest item of all windows before it, a new part begins: no alignment
    spans two. A part with fewer windows than any of its items needs goes."""
    near = F.broadcast if small else lambda df: df
    sizes = index.groupBy("item_id").agg(
        F.least(F.lit(min_windows), F.countDistinct("at")).alias("need"), (F.max("at") - F.min("at")).alias("reach")
    )
    templates = index.groupBy("h").agg(F.max("telling").alias("telling"))
    keys = index.join(near(sizes), index["item_id"].eqNullSafe(sizes["item_id"]))
    keys = keys.groupBy("key").agg(F.min("need").alias("need"), F.max("reach").alias("reach"))

    found = _windows(docs, ["doc_id", "text_hash"], window, lengths)
    if small:
        met = _placed(found.join(F.broadcast(templates), "h"), window, lengths).withColumn("ours", _cut())
    else:
        met = _placed(found, window, lengths).withColumn("ours", _cut()).drop("tokens", "plain").join(templates, "h")
    met = met.select("doc_id", "text_hash", "pos", "ours", _key("ours").alias("key")).join(near(keys), "key")

    earlier = Window.partitionBy("doc_id", "text_hash").orderBy("pos").rangeBetween(Window.unboundedPreceding, -1)
    upto = earlier.rangeBetween(Window.unboundedPreceding, 0)
    opens = F.col("pos") > F.coalesce("before", F.lit(-1))
    met = met.withColumn("before", F.max(F.col("pos") + F.col("reach")).over(earlier))
    met = met.withColumn("start", F.max(F.when(opens, F.col("pos"))).over(upto))
    place = F.struct((F.col("pos") - F.col("start")).alias("pos"), "key", "ours")
    parts = met.groupBy("doc_id", "text_hash", "start").agg(F.collect_set(place).alias("windows"), F.min("need").alias("need"))
    parts = parts.where(F.size(F.array_distinct(F.transform("windows", lambda w: w["pos"]))) >= F.col("need"))
    parts = parts.select("doc_id", "text_hash", F.sort_array("windows").alias("windows"))
    return parts.withColumn("shape", F.sha2(F.to_json("windows"), 256))


def _leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    min_literals: int = MIN_LITERALS,
    min_windows: int = MIN_WINDOWS,
) -> tuple[DataFrame, DataFrame]:
    """The stretches, and one row a leaking shape and item. What many documents have in common, such as
    a phrase that many items share, meets those items once."""
    if window < 2 or window & (window - 1):
        raise ValueError("the window is a power of two")
    index = written(benchmark_windows(benchmark, item_col, item_text_col, window, min_literals), "benchmark")
    lengths = {r["item_length"]: r["count"] for r in index.groupBy("item_length").count().collect()}  # at most ``window``
    small = sum(lengths.values()) <= BROADCAST_WINDOWS
    sizes = index.groupBy("item_id").agg(F.countDistinct("at").alias("item_windows"))

    keyed = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    stretches = written(_stretches(keyed, index, window, min_windows, small, sorted(lengths.keys() - {window})), "stretches")
    shapes = stretches.select("shape", "windows").dropDuplicates(["shape"])
    met = shapes.select("shape", F.inline("windows")).join(F.broadcast(index) if small else index, "key")
    met = met.where(F.col("telling") | (F.col("ours") == F.col("theirs")))
    pairs = F.zip_with("theirs", "ours", lambda t, o: F.struct(t.alias("theirs"), o.alias("ours")))
    slots = F.filter(pairs, lambda s: _is_slot(s["theirs"]))
    met = met.select("shape", "item_id", "at", (F.col("pos") - F.col("at")).alias("diagonal"), slots.alias("slots"))
    lined = met.groupBy("shape", "item_id", "diagonal").agg(F.collect_set(F.struct("at", "slots")).alias("windows"))
    lined = lined.withColumn("slots", F.array_distinct(F.flatten(F.transform("windows", lambda w: w["slots"]))))
    lined = lined.withColumn("torn", _torn()).withColumn("counted", F.filter("windows", _untorn))
    filled = F.exists("counted", lambda w: F.exists(w["slots"], _typed))
    whole = F.forall("torn", _is_open)  # no typed filler is torn
    n = F.when(whole | filled, F.size(F.array_distinct(F.transform("counted", lambda w: w["at"]))))
    same = F.forall("slots", lambda s: s["theirs"] == s["ours"])
    lined = lined.select("shape", "item_id", n.alias("n"), same.alias("same")).join(F.broadcast(sizes) if small else sizes, "item_id")
    leaks = (
        lined.where(F.col("n") >= F.least(F.lit(min_windows), "item_windows"))
        .groupBy("shape", "item_id", "item_windows")
        .agg(F.max("n").alias("n_windows"), F.count("*").alias("n_alignments"), F.max("same").alias("exact"))
    )
    return stretches.drop("windows"), leaks


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per leaking document and item: the id, ``text_hash`` (with the id, the document),
    ``item_id``, ``n_windows`` (most distinct windows of the item in one alignment),
    ``item_windows``, ``n_alignments`` and ``exact`` (some leak has the benchmark's own fillers
    throughout). Other options are those of ``_leaks``."""
    stretches, leaks = _leaks(docs, benchmark, id_col, text_col, **options)
    return (
        stretches.join(leaks, "shape")
        .groupBy("doc_id", "text_hash", "item_id", "item_windows")
        .agg(F.max("n_windows").alias("n_windows"), F.sum("n_alignments").alias("n_alignments"), F.max("exact").alias("exact"))
        .withColumnRenamed("doc_id", id_col)
    )


def drop_leaking(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that leak an item; all columns as they were."""
    stretches, leaks = _leaks(docs, benchmark, id_col, text_col, **options)
    stretches = stretches.join(leaks, "shape", "left_semi")
    leaks = stretches.select(F.col("doc_id").alias("leak_id"), F.col("text_hash").alias("leak_hash")).distinct()
    same = docs[id_col].eqNullSafe(leaks["leak_id"]) & (F.xxhash64(docs[text_col]) == leaks["leak_hash"])
    return docs.join(leaks, same, "left_anti")
