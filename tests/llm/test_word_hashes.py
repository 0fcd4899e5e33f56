"""Long words that a polynomial of their bytes would take for one another."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest

from editpulse.llm import text as tx
from editpulse.llm.decontaminate import contamination
from editpulse.llm.jaccard import jaccard_join
from editpulse.llm.substrings import substring_dedup


def twins(doublings=12):
    """The two Thue-Morse words of that many doublings."""
    one, other = "a", "b"
    for _ in range(doublings):
        one, other = one + other, other + one
    return one, other


@pytest.fixture(scope="module")
def docs(spark):
    pad = " ".join(f"p{i}" for i in range(12))
    one, other = twins()
    rows = [(1, f"{pad} {one}"), (2, f"{pad} {other}"), (3, f"{pad} {other}"), (4, None)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_substrings_keep_words_apart(docs):
    found = {r.doc_id: r for r in substring_dedup(docs, digest=True).collect()}
    assert {i: (r.n_words, r.n_removed) for i, r in found.items()} == {1: (13, 0), 2: (13, 0), 3: (13, 13), 4: (0, 0)}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for i in (1, 2, 4):
        assert found[i].kept == hashlib.sha256(texts[i].encode()).hexdigest()


def test_windows_of_the_benchmark_keep_words_apart(spark, docs):
    benchmark = spark.createDataFrame([(1, twins()[0])], "item_id long, text string")
    hits = {r.doc_id: r.n_hit for r in contamination(docs, benchmark).collect()}
    assert hits == {1: 1, 2: 0, 3: 0, 4: 0}


def test_sets_of_shingles_keep_words_apart(spark):
    one, other = twins()
    rows = [(1, f"x y {one}"), (2, f"x y {other}"), (3, f"X y {other}")]
    found = jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in found.collect()} == {1: 1, 2: 2, 3: 2}


def test_equal_words_have_equal_hashes_wherever_they_stand():
    long = "é" * 50_000
    column = pa.array([long, None, "A\x00 a A", f"x {long}", "a\x00 a", "aaaaaaaab aaaaaaaa b" + " w" * 70_000 + f" {long}"])
    data, starts = tx.texts(column)
    found = tx.words(data, starts, fold=tx.LOWER)
    spelled = [bytes(data[a:b]).lower() for a, b in zip(found.start, found.end)]
    assert spelled == [w for text in column.to_pylist() for w in (text or "").encode().lower().split(b" ") if w]
    kinds, which = np.unique(found.hash, return_inverse=True)
    of = {}
    for word, kind in zip(spelled, which):
        assert of.setdefault(word, kind) == kind
    assert len(of) == len(kinds)
