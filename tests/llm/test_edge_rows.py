"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from editpulse.llm import exchange
from editpulse.llm.decontaminate import contamination, decontaminate
from editpulse.llm.jaccard import drop_near_copies, jaccard_join
from editpulse.llm.lines import drop_repeated_lines, line_dedup
from editpulse.llm.mixing import mix
from editpulse.llm.quality import quality
from editpulse.llm.substrings import substring_dedup
from editpulse.llm.suffixes import suffix_dedup
from editpulse.llm.topk import exact_top_k
from editpulse.llm.toxicity import drop_toxic, toxicity
from editpulse.llm.urls import Rule, judge_urls

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, id long, block int, size string, kept int"


def words(text):
    return re.findall(r"[^\x20\x09-\x0d]+", text or "")


def _texts():
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)] + ["ñandú", "Über", "日本"]
    make = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    base, passage = make(120), make(40)
    near = base.replace(base.split()[60], "changed", 1)
    lines = "\n".join(make(9) for _ in range(6))
    return [
        None, "", " \t\n ", "one", "one two", "ONE two", base, base, near, base + " " + make(30),
        make(50) + " " + passage + " " + make(50), passage, make(20) + "\n" + passage + "\r\n" + make(12),
        lines, lines + "\n" + make(10), "\n".join(reversed(lines.split("\n"))), "a " * 300, "a " * 300, "ñ" * 80, "ñ" * 80,
        "x" * 2000 + " " + "y" * 300, make(6000), "tab\tand\x0bvertical\x0cform\rreturn",
    ]


@pytest.fixture(scope="module")
def docs(spark):
    rows = []
    for i, text in enumerate(_texts()):
        name = f"s{i % 3}" if i % 5 else None
        rows.append((i * 3, text, "en" if i % 4 else None, name, None if text is None else len(text), 1, 2, "s", 3))
    rows.append(rows[6])  # a repeated row
    rows.append((None, rows[6][1], None, None, None, 1, 2, "s", 3))
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def plain(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i * 3, i % 2, (i // 2) % 2) for i in range(15)] + [(None, 1, 1), (3, None, None), (6, 1, 1), (6, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    texts = _texts()
    rows = [(1, texts[11]), (2, "w1"), (3, None), (4, ""), (None, texts[6]), (5, texts[11]), (5, "w2 w3")]
    return spark.createDataFrame(rows, "item_id long, text string")


def order(doc_id):
    return exchange.LAST_ID if doc_id is None else doc_id


def collected(frame, key="doc_id"):
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: (order(r[0]), str(r)))


def covered(rows, units, width, joined):
    """Brute force: per row the units covered by a window of a smaller id."""
    first = {}
    cut = {i: units(text) for i, (_, text) in enumerate(rows)}
    for i, (doc_id, _) in enumerate(rows):
        for j in range(len(cut[i]) - width + 1):
            key = joined(cut[i][j : j + width])
            first[key] = min(first.get(key, math.inf), order(doc_id))
    for i, (doc_id, _) in enumerate(rows):
        gone = [False] * len(cut[i])
        for j in range(len(cut[i]) - width + 1):
            if first[joined(cut[i][j : j + width])] < order(doc_id):
                gone[j : j + width] = [True] * width
        yield doc_id, cut[i], gone


@pytest.mark.parametrize("parts", [1, 4])
def test_substrings(docs, plain, monkeypatch, parts):
    monkeypatch.setattr(exchange, "parts", lambda *_: parts)
    got = collected(substring_dedup(docs).drop("level_words"))
    want = [
        (i, len(unit), sum(gone), " ".join(u for u, g in zip(unit, gone) if not g))
        for i, unit, gone in covered(plain, words, 13, tuple)
    ]
    assert got == sorted(want, key=lambda r: (order(r[0]), str(r)))


def test_substring_levels_double_while_windows_repeat(docs):
    levels = {r.doc_id: r.level_words for r in substring_dedup(docs).collect()}
    assert levels[18] == levels[21] == 104  # copies of 120 words
    assert levels[24] == 52  # a word in the middle changed
    assert levels[33] == 26  # a passage of 40 words
    assert levels[63] == 0


@pytest.mark.parametrize("parts", [1, 3])
def test_suffixes(docs, plain, monkeypatch, parts):
    monkeypatch.setattr(exchange, "parts", lambda *_: parts)
    got = collected(suffix_dedup(docs))
    want = []
    for i, unit, gone in covered(plain, lambda t: (t or "").encode(), 50, bytes):
        runs = sum(g and not (j and gone[j - 1]) for j, g in enumerate(gone))
        want.append((i, len(unit), sum(gone), runs, bytearray(c for c, g in zip(unit, gone) if not g)))
    assert got == sorted(want, key=lambda r: (order(r[0]), str(r)))


def test_digest_is_that_of_the_kept_text(docs):
    kept = {(r.doc_id, hashlib.sha256(r.kept.encode()).hexdigest()) for r in substring_dedup(docs).collect()}
    assert kept == {(r.doc_id, r.kept) for r in substring_dedup(docs, digest=True).collect()}


def shingles(text, n):
    low = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(low[i : i + n]) for i in range(len(low) - n + 1)) or frozenset([tuple(low)] if low else [])


@pytest.mark.parametrize("few, tile", [(32, 512), (1, 2)])
def test_jaccard(docs, plain, monkeypatch, few, tile):
    from editpulse.llm import jaccard

    monkeypatch.setattr(jaccard, "FEW", few)
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(exchange, "parts", lambda *_: 2)
    rows = [(i, text) for i, text in plain]
    sets = [shingles(text, 3) for _, text in rows]
    parent, links = {}, [0] * len(rows)

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, (i, _) in enumerate(rows):
        for b, (j, _) in enumerate(rows):
            if a != b and i is not None and j is not None and sets[a] and sets[b]:
                if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                    links[a] += 1
                    parent[max(root(i), root(j))] = min(root(i), root(j))
    want = [(i, len(s), None if i is None else root(i), n) for (i, _), s, n in zip(rows, sets, links)]
    assert collected(jaccard_join(docs)) == sorted(want, key=lambda r: (order(r[0]), str(r)))


def test_near_copies_leave_one_and_keep_what_has_no_words(docs):
    left = collected(drop_near_copies(docs).select("doc_id"))
    ids = [r[0] for r in left]
    assert ids.count(18) == 1 and 21 not in ids and 24 not in ids
    assert {0, 3, 6, None} <= set(ids)  # without words, without id
    assert drop_near_copies(docs).columns == docs.columns


@pytest.mark.parametrize("group_words", [1 << 17, 30])
def test_contamination(docs, plain, benchmark, group_words):
    fold = lambda t: re.findall(
        r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)})
    )
    owners = {}
    for item in benchmark.collect():
        unit = fold(item.text)
        if unit and item.item_id is not None:
            n = min(10, len(unit))
            for j in range(len(unit) - n + 1):
                owners.setdefault(tuple(unit[j : j + n]), set()).add(str(item.item_id))
    want = []
    for i, text in plain:
        unit, found = fold(text), set()
        hit = [False] * len(unit)
        for n in {len(k) for k in owners}:
            for j in range(len(unit) - n + 1):
                if tuple(unit[j : j + n]) in owners:
                    hit[j : j + n] = [True] * n
                    found |= owners[tuple(unit[j : j + n])]
        want.append((i, len(unit), sum(hit), sorted(found)))
    got = contamination(docs, benchmark, group_words=group_words).drop("spans")
    assert collected(got) == sorted(want, key=lambda r: (order(r[0]), str(r)))


def test_decontaminated_texts_lose_their_spans(spark, docs):
    passage = _texts()[11]
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    left = {r.doc_id: r.text for r in decontaminate(docs, items).collect()}
    assert 33 not in left  # nothing but the passage
    assert passage not in left[30] and left[30].startswith(_texts()[10][:40])
    assert left[0] is None and left[18] == _texts()[6]
    assert decontaminate(docs, items).columns == docs.columns


def line_sets(text):
    for line in [] if text is None else text.split("\n"):
        unit = words(line)
        runs = [tuple(unit[i : i + 5]) for i in range(len(unit) - 4)]
        yield frozenset(runs if len(unit) >= 5 else [tuple(unit)] if unit else [])


def test_lines(docs, plain):
    flat = [(order(i), n, s) for i, text in plain for n, s in enumerate(line_sets(text))]
    gone = {
        (i, n)
        for i, n, s in flat
        if s and any((j, m) < (i, n) and t and 100 * len(s & t) >= 80 * len(s | t) for j, m, t in flat)
    }
    want = []
    for i, text in plain:
        n = 0 if text is None else text.count("\n") + 1
        own = sorted(m for j, m in gone if j == order(i) and m < n)
        want.append((i, n, len(own), own))
    assert collected(line_dedup(docs)) == sorted(want, key=lambda r: (order(r[0]), str(r)))


def test_dropped_lines_leave_the_others_as_they_were(docs, plain):
    left = {r.doc_id: r.text for r in drop_repeated_lines(docs).collect()}
    texts = dict(plain)
    assert left[39] == texts[39] and 45 not in left  # all lines of an earlier text
    assert left[42] == texts[42].split("\n")[-1]
    assert left[0] is None and left[3] == ""
    assert drop_repeated_lines(docs).columns == docs.columns


def test_mix_reaches_its_targets(docs, plain):
    rows = mix(docs)
    assert rows.columns == [c for c in docs.columns if c != "size"] + ["size", "source_size", "target", "copies"]
    got = rows.collect()
    assert all(0 <= r.copies <= 3 for r in got) and len(got) == len(plain)
    assert {(r.doc_id, r.size) for r in got} == {(i, len(words(t))) for i, t in plain}
    total = sum(r.size for r in got)
    targets = {r.source: r.target for r in got}
    assert sum(targets.values()) == pytest.approx(total)
    assert collected(mix(docs).select("doc_id", "copies")) == collected(mix(docs.repartition(7)).select("doc_id", "copies"))


def test_scores_of_every_row(docs, labels, plain):
    for rows in (toxicity(docs, labels), quality(docs, labels)):
        got = rows.collect()
        assert sorted(order(r.doc_id) for r in got) == sorted(order(i) for i, _ in plain)
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
        assert all(r.held_out for r in got if r.doc_id is None)
    assert drop_toxic(docs, labels).columns == docs.columns
    none = labels.limit(0)
    assert toxicity(docs, none).count() == quality(docs, none).count() == len(plain)


def test_top_k(spark):
    draw = random.Random(3)
    rows = [(i, [draw.choice((-0.5, 0.0, 0.25, 1.0)) for _ in range(6)]) for i in range(120)]
    rows += [(200, None), (201, [1.0, None]), (202, [float("nan")] * 6), (203, [float("inf")] * 6), (None, [1.0] * 6)]
    rows += [(210, []), (211, [0.5]), (rows[50][0], rows[50][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    usable = {
        i: [math.floor(256 * x) for x in v]
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    want = []
    for q in usable:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(usable[q], v)), i) for i, v in usable.items() if i != q)
            want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:5], 1)]
    got = exact_top_k(frame, F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    few = exact_top_k(frame.filter("vec_id in (0, 7, 9)"), F.col("vec_id") % 50 == 0).collect()
    assert len(few) == 2
    assert exact_top_k(frame.limit(0), F.col("vec_id") % 50 == 0).collect() == []


def test_top_k_of_large_components(spark):
    rows = [(0, [3e38, 1.0]), (1, [1.0, 1.0]), (2, [-1.0, 2.0]), (50, [1e5, 1e5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert exact_top_k(frame, F.col("vec_id") % 50 == 0).count() == 6


RULES = (
    Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"),
)
URLS = [
    (1, "http://A.Example.ORG/es/1?x=1", "a.example.org", "/es/1", "example.org/es/", "block"),
    (2, "https://example.org/en/17", "example.org", "/en/17", "example.org/en/1", "block"),
    (3, "x://example.org/en/2#f", "example.org", "/en/2", "org/", "allow"),
    (4, "http://example.org", "example.org", "", None, None),
    (5, "http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    (6, "http://com/de/", "com", "/de/", "com/de/", "block"),
    (7, "http://a.com/fr/x?y#z", "a.com", "/fr/x", "com/fr/", "allow"),
    (8, "no scheme", "", "", None, None),
    (9, None, "", "", None, None),
    (10, "http://a?b://c", "a", "", None, None),
    (11, "", "", "", None, None),
    (11, "http://a.net/" + "x" * 5000, "a.net", "/" + "x" * 5000, None, None),
]


def test_urls(spark):
    frame = spark.createDataFrame([(p, u, "host") for p, u, *_ in URLS], "page_id long, url string, host string")
    got = judge_urls(frame, RULES).collect()
    assert sorted((r.page_id, r.host, r.path, r.rule) for r in got) == sorted(
        ((p, h, q, r) for p, _, h, q, r, _ in URLS), key=lambda r: r[:3]
    ) or {(r.page_id, r.host, r.path, r.rule) for r in got} == {(p, h, q, r) for p, _, h, q, r, _ in URLS}
    told = {(p, h): v for p, _, h, _, _, v in URLS if v}
    assert all(r.verdict == told.get((r.page_id, r.host), r.verdict) for r in got)
    assert {r.verdict for r in got} <= {"allow", "block"}
    assert judge_urls(frame.limit(0), RULES).count() == 0
    assert {r.verdict for r in judge_urls(frame.filter("page_id in (4, 8)"), RULES).collect()} == {"allow"}


def test_empty_tables(spark, empty, labels, benchmark):
    frames = [
        substring_dedup(empty), suffix_dedup(empty), jaccard_join(empty), drop_near_copies(empty),
        contamination(empty, benchmark), decontaminate(empty, benchmark), line_dedup(empty), drop_repeated_lines(empty),
        mix(empty), toxicity(empty, labels), quality(empty, labels), drop_toxic(empty, labels),
    ]
    assert [f.count() for f in frames] == [0] * len(frames)


def test_no_items(docs, benchmark, plain):
    none = contamination(docs, benchmark.limit(0))
    assert none.filter("n_hit = 0").count() == len(plain)
