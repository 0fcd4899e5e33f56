"""License scans against a brute-force version, and their plan."""

import re

from editpulse.llm.licenses import TEMPLATES, license_scan

BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(A_TO_Z))
    places, base, labels, score = [], set(), set(), 0.0
    for start in range(len(words)):
        for phrase, label in BASE.items():
            if words[start : start + len(phrase.split())] == phrase.split():
                places.append(start)
                base.add(label)
    for template in TEMPLATES:
        own = template.words.split()
        key = range(template.key, len(own) if template.key_end is None else template.key_end)
        for start in range(-len(own), len(words)):
            at = {q: words[start + q] for q in range(len(own)) if 0 <= start + q < len(words)}
            if all(at.get(q) == own[q] for q in key):
                labels.add(template.label)
                score = max(score, sum(at.get(q) == w for q, w in enumerate(own)) / len(own))
    ends = (min(places), max(places)) if places else (None, None)
    return (len(words), len(places), *ends, ",".join(sorted(base)), ",".join(sorted(labels)), score)


def check(spark, texts):
    rows = [(i if i % 7 else None, text, i, "x", "y") for i, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int, word string, label string").repartition(4)
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    got = sorted((tuple(r) for r in license_scan(docs).select(*columns).collect()), key=str)
    assert got == sorted(((r[0], *brute(r[1])) for r in rows), key=str)
    return got


def test_edge_rows(spark):
    passage = TEMPLATES[3].words
    texts = [
        None, "", " .;\n", "MIT License", "mit-license", "mit  LICENSE, Mit License; license mit", "mit licenses",
        "the GNU General Public License and the Apache License", "general public", "apache general public license license",
        "MİT license", "mıt license", "mit licenseé", "mit license", "mit license7", "x" * 5000 + " mit license",
        passage, "before " + passage.upper() + " after", passage.replace("granted", "given"), passage.replace("software", "thing"),
        TEMPLATES[8].words, "any purpose " + TEMPLATES[11].words, "License of the public software " * 50,
        ("word " * 50 + "mit license\n") * 400, "mit " * 3000 + "license " * 3000, "MIT License", "MIT License",
    ] + [t.words for t in TEMPLATES]
    got = check(spark, texts)
    assert max(r[2] for r in got) == 400


def test_words_that_no_text_has(spark):
    check(spark, ["license", "public general license", "nothing at all"])


def test_empty_table(spark):
    assert license_scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []
