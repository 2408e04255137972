from __future__ import annotations

import os

import pytest

SF = "/root/testdata/sf0.001"
EXTRA = "kept boolean, n_words int, spans string, id long, text_hash long, part long, rank long"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("driver data is absent")
    return SF


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names operators use inside."""

    def build(rows, extra: bool = False):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        if extra:
            full = [(*r, True, 1, "x", 5, 6, 7, 8) for r in full]
            schema += f", {EXTRA}"
        return spark.createDataFrame(full, schema)

    return build


#: Nulls, empty and blank texts, repeated rows, one very long word and one long text.
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "a"),
    (4, "a"),
    (None, "some text without an id"),
    (None, None),
    (5, "x" * 20_000),
    (6, "long text of the day " * 4_000),
    (7, "é́ \U0001f642 中文 \x00\x01\x1c\x85"),
]


@pytest.fixture
def odd_rows():
    return list(ODD)
