"""The decontamination rule against its SQL on tables that hold its cases, and the recall of questions
that were asked again with other numbers, names and units."""

from __future__ import annotations

import random
import re

import duckdb
import pytest

from tilepulse.llm import decontaminate
from tilepulse.llm.oracle import ORACLE

NAMES = "Maria Peter Natalia Bob Ines Karl Yuki Omar Lea Tom".split()
PLACES = "Paris London Rome Oslo Madrid Bern".split()


def _sql(docs, bench):
    import pyarrow as pa

    con = duckdb.connect()
    tables = {
        "documents": pa.table({"doc_id": pa.array([i for i, _ in docs], pa.int64()), "text": pa.array([t for _, t in docs], pa.string())}),
        "benchmark": pa.table({"item_id": pa.array([i for i, _ in bench], pa.int64()), "text": pa.array([t for _, t in bench], pa.string())}),
    }
    for name, t in tables.items():
        con.register(name, t)
    con.execute(ORACLE["op4_benchmark_decontamination"])
    names = [d[0] for d in con.description]
    return sorted(str(sorted(zip(names, r, strict=True))) for r in con.fetchall())


def _spark(spark, make_docs, docs, bench):
    frame = spark.createDataFrame(bench, "item_id long, text string")
    rows = decontaminate.find_leaks(make_docs(docs), frame).drop("text_hash").collect()
    return sorted(str(sorted(r.asDict().items())) for r in rows), {(r["doc_id"], r["item_id"]) for r in rows}


PLANTED = [
    ("A train travels 60 km in 2 hours, then 90 km in 3 hours. How far?", "A train travels 70 km in 4 hours, then 95 km in 6 hours. How far?", True),
    ("Natalia sold clips to 48 of her friends in April, and then she sold half as many in May.",
     "Maria sold clips to 36 of her friends in June, and then she sold half as many in July.", True),
    ("the train to Paris left late and then the old train from Paris came back so many people were glad to see it",
     "the train to Paris left late and then the old train from London came back so many people were glad to see it", True),
    ("the train to Paris left late and then the old train from Paris came back so many people were glad to see it",
     "the train to Rome left late and then the old train from London came back so many people were glad to see it", False),
    ("What is the capital of France?", "so what is the capital of France? I know", True),
    ("What is the capital of France?", "What is the capital of Spain?", False),
    ("the farmer has 5 cows and also owns 3 big horses so the man must feed all of them on each day",
     "the farmer has 4 cows and also owns 4 big horses so the man must feed all of them on each day", True),
    ("the  farmer\thas 5 kg of hay and  Bob buys  two more bales of it in the town", "the farmer has 7 lb of hay and  Tom buys nine more bales of it in the town", True),
    ("One man went to mow a meadow and then two men came to mow it too", "Two men went to mow a lawn and sing", False),
    ("The dog was old. The dog was not well. The cat was young and it was not ill at all",
     "The dog was old. A dog was not well. The cat was young and it was not ill at all", True),
    ("", "", False),
    ("?!", "text", False),
]


def test_planted_cases(spark, make_docs):
    for wide in (decontaminate.BROADCAST_WINDOWS, 0):
        docs = [(i, f"{'lead in words here. ' if i % 2 else ''}{d}") for i, (_, d, _) in enumerate(PLANTED)]
        bench = [(i, b) for i, (b, _, _) in enumerate(PLANTED)]
        rows, found = _spark(spark, make_docs, docs, bench)
        assert {(i, i) for i, p in enumerate(PLANTED) if p[2]} <= found
        assert not {(i, i) for i, p in enumerate(PLANTED) if not p[2]} & found - {(3, 3)} and (3, 3) not in found
        assert rows == _sql(docs, bench)


@pytest.mark.parametrize("seed", range(4))
def test_rule_matches_its_sql(spark, make_docs, seed):
    """Random texts of few words, so that windows, torn fillers, short items and openers are many."""
    rng = random.Random(seed)
    words = ["the", "a", "man", "has", "of", "Bob", "Ann", "Rome", "5", "7 kg", "12", "3 hours", "two", "One", "sold", "and", ".", "?", "\n", ","]

    def text(n):
        return " ".join(rng.choices(words, k=n))

    bench = [(i, text(rng.choice([2, 4, 7, 9, 14, 25]))) for i in range(14)] + [(50, None), (51, ""), (None, text(12))]
    docs = [(i, text(rng.randrange(40))) for i in range(30)]
    for i in range(40):
        own = rng.choice([t for _, t in bench if t])
        for _ in range(rng.randrange(4)):
            a, b = rng.sample(["Bob", "Ann", "Rome", "5", "7 kg", "12", "the"], 2)
            own = re.sub(rf"(?<!\S){a}(?!\S)", b, own, count=rng.choice([0, 1]))
        docs.append((100 + i % 35, f"{text(rng.randrange(5))} {own} {text(rng.randrange(5))}"))
    docs += [docs[40], (None, docs[41][1]), (7, None)]
    rows, found = _spark(spark, make_docs, docs, bench)
    assert rows == _sql(docs, bench) and found


def test_phrase_that_many_items_and_documents_share(spark, make_docs):
    """Documents with only the phrase are few shapes, and no leak; those with more of an item are found,
    twice where they hold it twice, far apart."""
    phrase = "read the text below with care and then"  # one window of eight plain words
    tails = [" ".join(f"w{i}x{k}" for k in range(9)) for i in range(60)]
    bench = [(i, f"{phrase} {t}") for i, t in enumerate(tails)] + [(100, "Is it so?"), (101, phrase)]
    far = "nothing here is of any use " * 20
    docs = [(i, f"{'some lead ' * (i % 7)}words {phrase} go on number {i}") for i in range(300)]
    docs += [(1000 + i, f"{far}{b} {far if i % 2 else ''}{b} {phrase} {far}") for i, (_, b) in enumerate(bench[:20])]
    rows, found = _spark(spark, make_docs, docs, bench)
    assert rows == _sql(docs, bench)
    assert {(1000 + i, i) for i in range(20)} <= found
    assert {p for p in found if p[0] < 1000} == {(i, 101) for i in range(300)}
    stretches, leaks = decontaminate._leaks(make_docs(docs[:300]), spark.createDataFrame(bench, "item_id long, text string"))
    assert stretches.count() == 300 and stretches.select("shape").distinct().count() == leaks.count() == 1


QUESTIONS = [
    "{n} bought {a} kg of apples and {b} kg of pears at the market in {p}. How much fruit did {n} carry home from {p} in all?",
    "{n} reads {a} pages of a long book on each day of the week. After how many days has {n} read all {b} pages of the book?",
    "A train leaves {p} at {a} km an hour, and a second train follows it {b} minutes later. When do the two trains meet?",
    "There are {a} red balls and {b} blue balls in a large box. {n} takes one ball without looking. Which colour is more likely?",
    "{n} earns {a} dollars an hour and works {b} hours a week in {p}. How much does {n} earn in four weeks of work?",
    "In {p}, a garden that is {a} m long and {b} m wide gets a new fence. How many meters of fence does {n} need for it?",
    "If {a} workers build a wall in {b} days, how long do twice as many workers need for the same wall in {p}?",
    "{n} mixes {a} ml of juice with {b} ml of water. What part of the drink that {n} made is juice, and what part is water?",
]


def test_recall_of_questions_asked_again(spark, make_docs):
    rng = random.Random(21)
    units = {"kg": ["lb", "g", "kg"], "km": ["miles", "km"], "ml": ["l", "ml"], "m": ["ft", "yards", "m"], "dollars": ["euros", "pounds"]}

    def asked(q):
        used = {"n": rng.choice(NAMES), "p": rng.choice(PLACES), "a": rng.randrange(2, 90), "b": rng.randrange(100, 900)}
        return q.format(**used)

    bench = [(i, asked(q)) for i, q in enumerate(QUESTIONS)]
    filler = "some other words of a page that has nothing to do with it and goes on for a while".split()
    docs, wanted = [], set()
    for k in range(160):
        i = k % len(QUESTIONS)
        text = asked(QUESTIONS[i])
        for unit, others in units.items():
            text = re.sub(rf"(?<=\d ){unit}\b", rng.choice(others), text)
        docs.append((k, f"{' '.join(rng.sample(filler, 9))}. {text} {' '.join(rng.sample(filler, 9))}"))
        wanted.add((k, i))
    for k in range(160, 400):  # other questions about the same things
        n, p, a, b = rng.choice(NAMES), rng.choice(PLACES), rng.randrange(99), rng.randrange(99)
        parts = [f"{n} went to {p} by train", f"there were {a} apples and {b} pears", f"the book has {a} pages", "How long is the fence?",
                 f"{n} had {a} dollars", f"it took {b} hours", "the balls in the box are red", f"{n} works in {p}", "How much does it cost?"]
        docs.append((k, ". ".join(rng.sample(parts, 6))))
    _, found = _spark(spark, make_docs, docs, bench)
    assert len(wanted & found) >= 0.9 * len(wanted)
    assert not found - wanted
