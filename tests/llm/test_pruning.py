"""Operator 3: how many products the annuli save, and that they lose nothing."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from editpulse.llm import topk


def _clustered(n, seed=3, spread=4.0):
    """Vectors of about one length around a few directions."""
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(24, 24))
    centres *= 400 / np.linalg.norm(centres, axis=1)[:, None]
    return np.rint(centres[draw.integers(0, 24, n)] + draw.normal(scale=spread, size=(n, 24))).astype(np.int64)


def _brute(v, ids, q, own, k):
    scores = v @ q
    order = [i for i in np.lexsort((ids, -scores)) if ids[i] != own][:k]
    return [(int(ids[i]), int(scores[i])) for i in order]


def _annulus(v, pivot):
    pivots = topk.Pivots(v.shape[1], float((v**2).sum(axis=1).max()), v[:1] * 0.0 + pivot, np.zeros(1), np.zeros((1, 3)))
    distance = pivots.of_rows(v.astype(float))[:, 0]
    order = np.argsort(distance, kind="stable")
    return pivots, order, topk.Annulus(order.astype(np.int64), v[order], distance[order])


@pytest.mark.parametrize("bounded", [False, True])
def test_ranges_stop_before_the_end(bounded):
    v = _clustered(12_000)
    pivots, _, annulus = _annulus(v, v[0])
    ids = np.arange(0, 12_000, 4)
    away = pivots.of_queries(v[ids].astype(float))[:, 0]
    near = np.argsort(away, kind="stable")[:64]
    ids, away = ids[near], away[near]
    want = [_brute(v, np.arange(len(v)), v[i], i, 5) for i in ids]
    bound = np.array([float(w[-1][1]) if bounded else -np.inf for w in want])
    counts, found, scores = annulus.best(pivots, away, ids, v[ids], bound, 5)
    got = list(zip(found.tolist(), scores.tolist()))
    assert counts == [5] * 64
    assert [got[5 * i : 5 * i + 5] for i in range(64)] == want
    assert annulus.products < 0.6 * 64 * len(v)


def test_vectors_without_clusters_lose_nothing(spark):
    v = np.random.default_rng(5).integers(-3, 4, size=(900, 6))  # many ties
    frame = spark.createDataFrame([(i, [float(x) / 256 for x in row]) for i, row in enumerate(v)], "vec_id long, embedding array<double>")
    got = {}
    for r in topk.exact_top_k(frame, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == {i: _brute(v, np.arange(900), v[i], i, 5) for i in range(0, 900, 50)}
