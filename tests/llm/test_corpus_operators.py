"""SimHash, substrings, decontamination, sampling, toxicity, BPE and the pipeline."""

from __future__ import annotations

import collections
import hashlib
import random
from zlib import crc32

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tilepulse.llm import bpe, components, decontaminate, importance, queries, simhash, substrings, toxicity


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def _classes(values):
    """Smallest member of each value's component of links at two bits or fewer."""
    values = sorted(set(values))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def _brute_fingerprint(t):
    words = (t or "").encode().lower().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hs = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


@pytest.mark.parametrize("hot", [simhash.HOT_BUCKET, 2])
def test_links_match_all_pairs(spark, hot):
    """Also where every crowded bucket is cut further instead of paired."""
    rng = random.Random(4)
    values = {0, 1, 3, 7, 15, 2**64 - 1}
    for base in (rng.getrandbits(64) for _ in range(5)):
        bits = rng.sample(range(64), 8)
        values |= {base ^ sum(1 << b for b in bits if rng.random() < 0.4) for _ in range(60)}
    values = [_signed(v) for v in values]
    links = simhash.near_links(spark.createDataFrame([(v,) for v in values], "fp long"), 2, hot)
    assert not links.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > 2).count()
    got = {r["node"]: r["root"] for r in components.components(links).collect()}
    want = _classes(values)
    assert {v: got.get(v, v) for v in values} == want


def test_components_of_a_long_chain(spark):
    chain = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    more = spark.createDataFrame([(900, 1000), (1000, 900), (950, 950), (None, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(chain.union(more)).collect()}
    assert got == {**dict.fromkeys(range(301), 0), 900: 900, 1000: 900}


def test_simhash_rows(make_docs, odd_rows):
    text = " ".join(f"w{i}" for i in range(900))
    rows = [*odd_rows, (10, text), (11, text.upper()), (12, text + " end"), (None, text)]
    got = simhash.simhash_groups(make_docs(rows, extra=True)).collect()
    want = collections.Counter((i, f"{_brute_fingerprint(t):016x}") for i, t in rows)
    assert collections.Counter((r["doc_id"], r["fingerprint"]) for r in got) == want
    classes = _classes([_brute_fingerprint(t) for _, t in rows])
    least = {}
    for i, t in rows:
        if i is not None:
            c = classes[_brute_fingerprint(t)]
            least[c] = min(least.get(c, i), i)
    for r in got:
        assert r["component_id"] == least.get(classes[int(r["fingerprint"], 16)])


def test_keep_one(make_docs):
    rows = [(3, "a b c d"), (2, "A b c d"), (2, "A b c d"), (5, None), (4, ""), (None, "a b c d"), (None, "x y z"), (None, "X y z"), (9, "p q r s t")]
    docs = make_docs(rows, extra=True)
    out = simhash.keep_one(docs)
    assert out.schema == docs.schema
    kept = sorted((str(r["doc_id"]), (r["text"] or "").lower()) for r in out.collect())
    assert kept == [("2", "a b c d"), ("4", ""), ("9", "p q r s t"), ("None", "x y z")]


def test_the_row_that_stays_does_not_depend_on_partitions(spark, make_docs):
    """Rows that share the smallest id of their group but not the text."""
    rows = [(1, f"some words that differ by number {i}") for i in range(40)] + [(None, "x y z"), (None, "x y z"), (2, "else")]
    kept = [sorted(map(str, simhash.keep_one(make_docs(r).repartition(n)).collect())) for n in (1, 5) for r in (rows, rows[::-1])]
    assert all(k == kept[0] for k in kept)
    assert len([k for k in kept[0] if "doc_id=1," in k]) == 1


def test_toxicity_sample_is_defined_where_ids_repeat(spark, make_docs, monkeypatch):
    """One row an id, whatever the partitions; long texts in pieces."""
    docs = [(i % 40, f"text {i} " * (1 + i % 3)) for i in range(400)] + [(41, "x" * 500_000 + " end")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(42)], "doc_id long, toxic int")
    taken = []
    monkeypatch.setattr(toxicity, "train", lambda texts, y: taken.append((texts, y)) or None)
    for n in (1, 7):
        for frame in (make_docs(docs), make_docs(docs[::-1])):
            toxicity.learn(frame.repartition(n), labels, "doc_id", "text", "toxic")
    assert all(t == taken[0] for t in taken)
    used = [i for i in range(42) if crc32(str(i).encode()) % 5 and i != 40]
    assert len(taken[0][0]) == len(used)
    if 41 in used:
        text = taken[0][0][used.index(41)]
        assert len(text) <= toxicity.FIT_CHARS + toxicity.FIT_PIECES and text.endswith(" end")


def _brute_removal(rows, window):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - window + 1):
            at = (1 << 63 if i is None else i, k)
            first[tuple(w[k : k + window])] = min(first.get(tuple(w[k : k + window]), at), at)
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < (1 << 63 if i is None else i, k):
                gone |= set(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return sorted(out, key=str)


@pytest.mark.parametrize("window", [20, 6])
def test_removal_matches_brute_force(make_docs, odd_rows, window):
    rng = random.Random(window)
    rows = [
        (None if rng.random() < 0.03 else rng.randrange(150), " ".join(rng.choice(["a", "b", "é\n"][: rng.randrange(1, 4)]) for _ in range(rng.randrange(80))))
        for _ in range(150)
    ]
    passage = " ".join(f"w{i}" for i in range(60))
    rows += [(200, f"start {passage} end"), (201, f"other {passage} tail"), (202, passage)]
    rows += [r for r in odd_rows if r[0] not in (6, 7)] + [(900, "a " * 300)]
    got = substrings.remove_repeats(make_docs(rows, extra=True), window=window).collect()
    assert sorted((tuple(r) for r in got), key=str) == _brute_removal(rows, window)


@pytest.mark.parametrize("one_id", [None, 77])
def test_removal_where_one_id_holds_most_rows(spark, make_docs, one_id):
    """The rows of one id, or without any, over many chunks: the order by start holds across them."""
    rng = random.Random(3)
    passages = [" ".join(f"p{k}w{i}" for i in range(25)) for k in range(6)]
    texts = [" ".join([*rng.choices("xyz", k=rng.randrange(6)), rng.choice(passages), *rng.choices("uv", k=rng.randrange(4))]) for _ in range(400)]
    rows = [(one_id if i % 3 else i, t) for i, t in enumerate(texts)]
    got = substrings.remove_repeats(make_docs(rows), window=20).collect()
    assert sorted((tuple(r) for r in got), key=str) == _brute_removal(rows, 20)


def test_rows_of_one_id_are_spread(spark, make_docs):
    rows = [(5, f"text number {i} of one id") for i in range(10_000)]
    out = substrings.remove_repeats(make_docs(rows), window=20, with_text=False)
    assert out.count() == 10_000
    dealt = make_docs(rows).select(F.pmod(F.xxhash64(F.col("doc_id"), F.col("text")), F.lit(substrings.MIN_CHUNKS)).alias("part"))
    assert dealt.groupBy("part").count().agg(F.max("count")).first()[0] < 400


def test_words_of_sliced_texts(monkeypatch):
    """The parts that texts are hashed in do not show."""
    rng = random.Random(8)
    texts = ["".join(rng.choice(["a", "bc", " ", "\n", "é"]) for _ in range(rng.randrange(200))).encode() for _ in range(40)]
    whole = substrings.Words(texts)
    for size in (1, 7, 64):
        monkeypatch.setattr(substrings, "HASH_BYTES", size)
        part = substrings.Words(texts)
        assert (part.hashes == whole.hashes).all() and (part.counts == whole.counts).all() and (part.at == whole.at).all()
    assert whole.counts.tolist() == [len(t.split()) for t in texts]


def test_removal_of_nothing(make_docs):
    assert substrings.remove_repeats(make_docs([])).count() == 0


ITEM = "Maria sold 12 boxes of ripe apples to the market for 30 euros before the rain came down on the old town"


def test_leaks(spark, make_docs):
    bench = spark.createDataFrame(
        [(1, ITEM), (2, "too short"), (3, None), (4, "the quick brown fox jumps over the lazy dog near the river bank today")],
        "item_id long, text string",
    )
    words = ITEM.split()
    rows = [
        (10, f"Intro words here. {ITEM} and more."),
        (11, "Intro. " + ITEM.replace("Maria", "Peter").replace("12", "45").replace("30", "99")),
        (12, "x " * 30 + " ".join(words[3:16]) + " y" * 30),
        (13, ITEM.upper()),
        (14, " ".join(reversed(words))),
        (15, "Sold boxes of apples to the town market for rain before it came."),
        (16, None),
        (None, ITEM),
        (10, f"Intro words here. {ITEM} and more."),
    ]
    docs = make_docs(rows, extra=True)
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.find_leaks(docs, bench).collect()}
    assert set(got) == {(10, 1), (11, 1), (12, 1), (13, 1), (None, 1)}
    assert got[10, 1]["exact"] and not got[11, 1]["exact"]
    out = decontaminate.drop_leaking(docs, bench)
    assert out.schema == docs.schema
    assert sorted(r["doc_id"] for r in out.collect()) == [14, 15, 16]
    wide = decontaminate.BROADCAST_WINDOWS
    try:
        decontaminate.BROADCAST_WINDOWS = 0  # the way for a large benchmark
        again = decontaminate.find_leaks(docs, bench).collect()
    finally:
        decontaminate.BROADCAST_WINDOWS = wide
    assert sorted(map(str, again)) == sorted(map(str, got.values()))
    assert not decontaminate.find_leaks(docs, bench.limit(0)).count()


def test_inconsistent_slots_are_no_leak(spark, make_docs):
    item = "the farmer has 5 cows and then the farmer buys 5 more cows so the farmer now owns many cows in the field"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, item.replace("5", "8")), (2, item.replace("5", "8", 1).replace("5", "9"))]
    got = {r["doc_id"]: r["n_windows"] for r in decontaminate.find_leaks(make_docs(rows), bench).collect()}
    assert 1 in got and 2 not in got


def test_a_torn_filler_costs_only_its_windows(spark, make_docs):
    item = "the train to Paris left late and then the old train from Paris came back so many people were glad to see it"
    sums = "the farmer has 5 cows and also owns 3 big horses so the man must feed all of them on each day"
    bench = spark.createDataFrame([(1, item), (2, sums)], "item_id long, text string")
    rows = [
        (1, item.replace("from Paris", "from London")),
        (2, sums.replace("5", "4").replace("3", "4")),
        (3, item.replace("to Paris", "to Rome").replace("from Paris", "from London")),
    ]
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.find_leaks(make_docs(rows), bench).collect()}
    assert set(got) == {(1, 1), (2, 2)}
    assert not got[1, 1]["exact"] and 3 <= got[1, 1]["n_windows"] < got[1, 1]["item_windows"]


def test_short_items_are_found_as_they_are(spark, make_docs, monkeypatch):
    items = ["What is the capital of France?", "Name 3 primes", "", " ?! ", None, "one two three four five six seven"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = [
        (1, "A quiz. What is the capital of France? Paris, of course."),
        (2, "what is the capital of Spain and of France"),
        (3, "name 3 primes"),
        (4, "name 4 primes"),
        (5, "x one two three four five six seven"),
        (6, "one two three four five six eight"),
        (7, ""),
        (8, "?"),
    ]
    for wide in (decontaminate.BROADCAST_WINDOWS, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", wide)
        got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.find_leaks(make_docs(rows), bench).collect()}
        assert set(got) == {(1, 0), (3, 1), (5, 5)}
        assert all(r["exact"] and r["item_windows"] == 1 for r in got.values())


def test_leaks_of_the_driver_data(spark, sf):
    """Every document that holds eight words of an item in a row, and no other."""
    got = {(r["doc_id"], r["item_id"]) for r in queries.op4_benchmark_decontamination(spark, sf).collect()}
    index = collections.defaultdict(set)
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        w = r["text"].lower().split()
        for k in range(len(w) - 7):
            index[tuple(w[k : k + 8])].add(r["item_id"])
    want = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        w = (r["text"] or "").lower().split()
        want |= {(r["doc_id"], i) for k in range(len(w) - 7) for i in index.get(tuple(w[k : k + 8]), ())}
    assert got == want


def test_kth_largest(spark):
    x = spark.range(3000).select((F.hash("id") % 777).cast("double").alias("v"))
    v = sorted((r["v"] for r in x.collect()), reverse=True)
    assert [importance.kth_largest(x, "v", k) for k in (1, 2, 17, 999, 3000)] == [v[k - 1] for k in (1, 2, 17, 999, 3000)]
    assert importance.kth_largest(x, "v", 0) is None and importance.kth_largest(x, "v", 3001) is None


def test_sampling_matches_brute_force(spark, make_docs, odd_rows):
    rng = random.Random(6)
    good = ["the cat sat on a mat", "a dog of the house", "it was the day of all", "we like the sea"]
    junk = ["### $$$ |||", "zz zz zz zz zz", "!! !! BUY !!"]
    rows = [(100 + i, " ".join(rng.choice(good if i % 3 else junk) for _ in range(8))) for i in range(120)] + odd_rows
    labels = spark.createDataFrame([(100 + i, 1 if i % 3 else 0) for i in range(60)] + [(None, 1)], "doc_id long, quality int")
    got = importance.importance_sample(make_docs(rows, extra=True), labels, share=0.6).collect()
    counts = np.zeros((2, importance.BUCKETS))
    for i, t in rows:
        x = np.bincount(importance.ngrams(t or ""), minlength=importance.BUCKETS)
        counts += [x, x * (i is not None and 100 <= i < 160 and (i - 100) % 3 > 0)]
    p = (counts + 1) / (counts.sum(1, keepdims=True) + importance.BUCKETS)
    ratio = np.log(p[1] / p[0])
    weight = {i: ratio[importance.ngrams(t or "")].sum() for i, t in rows if i is not None}
    u = {r["id"]: (((r["h"] % 2**64) >> 11) + 0.5) / 2**53 for r in spark.createDataFrame([(i,) for i in weight], "id long").select("id", F.xxhash64(F.lit(importance.SEED), "id").alias("h")).collect()}
    key = {i: weight[i] - np.log(-np.log(u[i])) for i in weight}
    for r in got:
        if r["doc_id"] is not None:
            assert r["log_weight"] == pytest.approx(weight[r["doc_id"]]) and r["sample_key"] == pytest.approx(key[r["doc_id"]])
    least = min(r["sample_key"] for r in got)
    assert {r["doc_id"] for r in got if r["doc_id"] is not None} == {i for i in key if key[i] >= least - 1e-9}
    assert round(0.6 * len(rows)) <= len(got) <= round(0.6 * len(rows)) + 1
    assert not any(r["doc_id"] in weight and 100 <= r["doc_id"] < 220 and (r["doc_id"] - 100) % 3 == 0 for r in got)


def test_the_share_is_of_all_labels(spark, make_docs, monkeypatch):
    """Also of those that the target model leaves out."""
    monkeypatch.setattr(importance, "TARGET_ROWS", 7)
    docs = make_docs([(i, f"word{i} and some more") for i in range(200)])
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(200)], "doc_id long, quality int")
    assert importance.importance_sample(docs, labels).count() == 20


def test_sampling_without_labels_or_rows(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert importance.importance_sample(make_docs([(1, "a")]), none).count() == 0
    assert importance.importance_sample(make_docs([(1, "a"), (2, "b")]), none, share=0.5).count() == 1
    assert importance.importance_sample(make_docs([]), none, share=0.5).count() == 0


def test_network_gradient():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in toxicity.init(rng).items()}
    xf, xb = rng.normal(size=(2, 5, 3, 3 * toxicity.STATES))
    real = np.ones((5, 3), bool)
    real[3:, 1] = False
    y = np.array([1.0, 0, 1])

    def loss():
        logit, memory = toxicity.forward(p, xf, xb, real, keep=True)
        return (np.log1p(np.exp(logit)) - y * logit).sum(), logit, memory

    _, logit, memory = loss()
    g, dxf, dxb = toxicity.gradient(p, memory, toxicity._sigmoid(logit) - y)
    checks = [(p[k], g[k]) for k in g] + [(xf, dxf), (xb, dxb)]
    for value, slope in checks:
        at = tuple(rng.integers(n) for n in value.shape)
        value[at] += 1e-5
        up = loss()[0]
        value[at] -= 2e-5
        down = loss()[0]
        value[at] += 1e-5
        assert (up - down) / 2e-5 == pytest.approx(slope[at], abs=1e-3)


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 48, 49, 500):
        w = toxicity.windows(list(range(1, n + 1)))
        assert w.shape[1] == toxicity.WIDTH and set(w.ravel()) - {0} == set(range(1, n + 1))
        assert len(w) == 1 or (w[1:, : toxicity.STRIDE] == w[:-1, toxicity.STRIDE :]).all()


def test_every_part_of_an_unspaced_text_is_scored():
    rng = random.Random(10)

    def text(toxic):
        runs = ["".join(chr(0x4E00 + rng.randrange(400)) for _ in range(rng.randrange(60, 120))) for _ in range(2)]
        return ("\u9a71\u9a72\u9a73\u9a74\u9a75" if toxic else "\u4e00").join(runs)

    model = toxicity.train([text(i % 3 == 0) for i in range(240)], [int(i % 3 == 0) for i in range(240)])
    scores = toxicity.Scorer(model).scores([text(i % 2) for i in range(40)])
    assert np.mean((scores >= 0.5) == (np.arange(40) % 2)) >= 0.95


def test_toxicity_of_held_out_rows(spark, make_docs, odd_rows):
    rng = random.Random(9)
    words = ["".join(rng.choice(["an", "er", "th", "on", "ti", "re"]) for _ in range(rng.randrange(1, 5))) for _ in range(300)]
    bad = ["idiot", "scumbag", "scumlord", "scummy"]
    rows = []
    for i in range(500):
        w = [rng.choice(words) for _ in range(rng.randrange(20, 200))]
        for _ in range(rng.randrange(2, 5) if i % 4 == 0 else 0):
            w[rng.randrange(len(w))] = rng.choice(bad)
        rows.append((100 + i, " ".join(w)))
    labels = spark.createDataFrame([(100 + i, int(i % 4 == 0)) for i in range(500)] + [(None, 1)], "doc_id long, toxic int")
    docs = make_docs(rows + odd_rows, extra=True)
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows) + len(odd_rows)
    right = []
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
        assert r["held_out"] == (r["doc_id"] is not None and crc32(str(r["doc_id"]).encode()) % 5 == 0)
        if r["held_out"] and r["doc_id"] >= 100:
            right.append(r["predicted"] == int((r["doc_id"] - 100) % 4 == 0))
    assert np.mean(right) >= 0.95
    one = toxicity.toxicity(docs, labels.where("toxic = 0")).collect()
    assert {r["score"] for r in one} == {0.0}


@pytest.fixture(scope="module")
def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    lib = pytest.importorskip("tokenizers").Tokenizer.from_file(str(public.path("word_bpe_49k.json")))
    lib.no_truncation()
    lib.no_padding()
    return public.path("word_bpe_49k.json"), lib


PARTS = ["a", "the", " ", "  ", "\n", "É", "é", "Σ", "İ", "ß", "’", "'s", "'LL", "1", "23", "!!", "\U0001f642", "中", "é", "<|endoftext|>", "<|ENDOFTEXT|>"]
PARTS += ["\x1c", "\x85", "\xa0", "ing", "tion", "AAAA", "zz", "ﬁ", "​", "٣", "Ⅷ", "\x00", " ", "<|startoftext|>", "<|"]


def test_encoding_matches_the_library(make_docs, odd_rows, tokenizer):
    file, lib = tokenizer
    rng = random.Random(7)
    rows = [(100 + i, "".join(rng.choice(PARTS) for _ in range(rng.randrange(40)))) for i in range(1200)]
    rows += [(9000 + i, "".join(rng.choice("abcdeéstn") for _ in range(rng.randrange(60)))) for i in range(600)] + odd_rows
    docs = make_docs(rows, extra=True)
    want = collections.Counter()
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want[i, len(ids), " ".join(map(str, ids)), lib.decode(ids, skip_special_tokens=False)] += 1
    assert collections.Counter(tuple(r) for r in bpe.encode(docs, file).collect()) == want
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    got = collections.Counter(tuple(r) for r in bpe.encode_digests(docs, file).collect())
    assert got == collections.Counter({(i, n, digest(a), digest(b)): c for (i, n, a, b), c in want.items()})


def test_forgetting_changes_nothing(tokenizer, monkeypatch):
    file, lib = tokenizer
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    monkeypatch.setattr(bpe, "REMEMBERED_PAIRS", 5)
    with open(file, encoding="utf-8") as f:
        enc = bpe.Encoder(bpe.Vocabulary(f.read()))
    texts = ["one two three", "four five <|endoftext|> six", "two seven", "eight nine ten"] * 3
    got = [x for i in range(0, len(texts), 2) for x, _ in enc.run(texts[i : i + 2])]
    assert got == [" ".join(map(str, lib.encode(t, add_special_tokens=False).ids)) for t in texts]


def test_pipeline_stages(spark, sf):
    """Each stage against what its operator says of its own input."""
    import corpus_pipeline as P

    docs = queries.read(spark, sf, "documents")
    sizes = [docs.count()]
    tables = [docs]
    for name, stage in P.STAGES[:-1]:
        out = P.written(stage(spark, tables[-1], sf), "test")
        assert out.schema == docs.schema, name
        tables.append(out)
        sizes.append(out.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] == sizes[-2]
    ids = [{r["doc_id"] for r in t.select("doc_id").collect()} for t in tables]
    verdict = queries.quality_rules.quality_rules(docs).where("kept").collect()
    assert ids[1] == {r["doc_id"] for r in verdict}
    groups = simhash.simhash_groups(tables[1]).collect()
    assert ids[2] == {r["component_id"] for r in groups}
    leaks = decontaminate.find_leaks(tables[2], queries.read(spark, sf, "benchmark")).collect()
    assert ids[3] == ids[2] - {r["doc_id"] for r in leaks} and leaks
    spans = queries.pii.find_pii(tables[4]).where(F.size("spans") > 0)
    assert not spans.where(F.exists("spans", lambda s: s["kind"].isin("email", "card"))).count()
    final = P.run(spark, sf).collect()
    assert {r["doc_id"] for r in final} == ids[4] and all(r["n_tokens"] == len(r["ids"].split()) for r in final)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_on_empty_tables(spark, tmp_path, name):
    schemas = {
        "documents": "doc_id long, text string, lang string, source string, n_chars long",
        "labels": "doc_id long, quality long, toxic long",
        "pages": "page_id long, url string, html string",
        "benchmark": "item_id long, text string",
        "embeddings": "vec_id long, embedding array<float>, label int",
    }
    for table, schema in schemas.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{table}.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).collect() == []
