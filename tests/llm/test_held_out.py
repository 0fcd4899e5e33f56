"""Scores of rows that were never learned from, with floors."""

import pytest

from editpulse.llm.quality import quality
from editpulse.llm.queries import table
from editpulse.llm.toxicity import toxicity

SF = "/root/testdata/sf0.1"


def area(rows):
    """Share of pairs of a labelled 1 and 0 that the scores put in the right order."""
    ones = sorted(s for s, y in rows if y)
    zeros = sorted(s for s, y in rows if not y)
    right, below = 0.0, 0
    for s in ones:
        while below < len(zeros) and zeros[below] < s:
            below += 1
        ties = sum(1 for z in zeros[below:] if z == s)
        right += below + ties / 2
    return right / (len(ones) * len(zeros))


@pytest.fixture(scope="module")
def tables(spark):
    return table(spark, SF, "documents"), table(spark, SF, "labels")


def test_toxicity(tables):
    docs, labels = tables
    rows = toxicity(docs, labels).filter("held_out").join(labels.select("doc_id", "toxic").dropna(), "doc_id")
    rows = [(r.score, r.toxic) for r in rows.collect()]
    assert len(rows) > 500
    assert area(rows) > 0.95
    assert sum((s >= 0.5) == (y == 1) for s, y in rows) / len(rows) > 0.95


def test_quality(tables):
    docs, labels = tables
    known = labels.select("doc_id", "quality").dropna()
    rows = quality(docs, labels).filter("held_out").join(known, "doc_id").collect()
    assert len(rows) > 500
    assert area([(r.score, r.quality) for r in rows]) > 0.95
    most = sum(r.quality for r in rows) / len(rows)
    right = sum(r.predicted == r.quality for r in rows) / len(rows)
    assert right > max(most, 1 - most) + 0.02
