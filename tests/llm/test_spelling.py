"""Spelling variants against a brute-force version, and the check sums against zlib's."""

import re
import zlib
from collections import Counter

import numpy as np

from editpulse.llm import spelling
from editpulse.llm.queries import table
from editpulse.llm.spelling import spelling_variants

A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(A_TO_Z)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 6
    words = {w: n for w, n in counts.items() if n >= 5}
    letters = sorted(set("".join(words)))

    def near(w):
        places = range(len(w))
        found = {w[:i] + w[i + 1 :] for i in places}
        found |= {w[:i] + c + w[i + 1 :] for i in places for c in letters}
        found |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        return [x for x in found - {w} if x in words]

    nears = {w: near(w) for w in words}
    best = {w: min(near_, key=lambda x: (-words[x], x), default=None) for w, near_ in nears.items()}
    form = {w: b if b and words[b] >= 5 * words[w] else None for w, b in best.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(nears[w]), words[form[w]] if form[w] else None) for w, n in words.items()}


def result(docs):
    rows = spelling_variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len({r.word for r in rows}) == len(rows)
    return {tuple(r) for r in rows}


def test_whole_table(spark, small_sf):
    docs = table(spark, small_sf, "documents").select("doc_id", "text")
    assert result(docs) == brute([tuple(r) for r in docs.collect()])


def test_edge_rows(spark):
    chain = ["Straße " * 5, "strasse " * 30, "STRASSES " * 800, "straßes " * 6]
    doubled = ["aaabbb " * 9, "aaaabbb " * 5, "aaabbbb " * 50, "xaaabbb " * 5]
    odd = [None, "", " \n", "short " * 99, "ÀÉÎõü×÷ÿ " * 7, "àÉÎõü×÷ÿ " * 7, "naïveté’naïveté " * 5, "日本naïvetés日本 " * 6]
    long_ = ["y" * 3000 + " " + "z" * 70000, ("y" * 3000 + " ") * 6, "Ã" * 65 + " " + "ã" * 64 + " " + "b" * 64]
    texts = chain + doubled + odd + long_ + long_
    rows = [(i, t, "x", i) for i, t in enumerate(texts)] + [(None, chain[2], "x", 1), (-7, chain[1], None, 2), (-7, chain[1], None, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, n int").repartition(3)
    assert result(docs) == brute([r[:2] for r in rows])
    assert spelling_variants(docs.limit(0)).collect() == []


def test_pieces_of_a_batch_do_not_matter(spark, small_sf, monkeypatch):
    docs = table(spark, small_sf, "documents")
    whole = {tuple(r) for r in spelling.count_words(docs).collect()}
    monkeypatch.setattr(spelling, "RUN_BYTES", 1000)
    assert {tuple(r) for r in spelling.count_words(docs).collect()} == whole


def test_check_sums():
    draw = np.random.default_rng(3)
    data = draw.integers(0, 256, 5000, np.uint8)
    length = np.array([1, 2, 63, 64, 65, 200, 7, 1])
    start = np.array([0, 9, 100, 200, 300, 400, 700, 4999])
    before = np.array([zlib.crc32(b"%d:" % i) for i in range(8)], np.uint32)
    want = [zlib.crc32(data[s : s + n].tobytes(), int(b)) for s, n, b in zip(start, length, before)]
    assert spelling.check_sums(data, start, length, before).tolist() == want


def test_a_group_holds_a_word_a_letter_at_most(spark):
    """Rotations of many near words: no group grows beyond the alphabet."""
    words = [f"word{a}{b}{c}" for a in "abcdefghij" for b in "abcdefghij" for c in "abcdefghij"]
    frame = spark.createDataFrame([(w, 5 + i) for i, w in enumerate(words)], "word string, n long")
    sizes = spelling.rotations(frame).groupBy("prefix").count().agg({"count": "max"}).first()[0]
    assert sizes == 10
    assert {r.n_near for r in spelling.neighbours(frame).collect()} == {27}
