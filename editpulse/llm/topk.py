"""Exact top-k by inner product, on a pivot-distance index.

Inner products become distances by one more component: with ``m`` the greatest
norm, x gets sqrt(m^2 - |x|^2) and a query gets 0, so that the nearest row is
the one of the greatest product. Every row is keyed by its nearest pivot and its
distance from it, and rows of a pivot are cut into annuli by that distance. A
query first searches the annulus nearest to it, which bounds the distance of its
k-th best row. By the triangle inequality a row within that radius lies, from
any pivot, within the radius of the query's own distance: only annuli that reach
into this range are searched, and in them the range of the sorted rows that grows
from the query's own distance until no row beyond it can come among the best.

Pivots and the edges of annuli come from a bounded sample; every row is indexed
and the bounds hold for any pivots, so results are exact.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editpulse.llm import exchange

SAMPLE_ROWS = 4096
PIVOTS = 16
RINGS = 4
BUCKET_ROWS = 4096  # of an annulus that one task searches
QUERY_ROWS = 8192  # that meet a bucket in one task
STEP_ROWS = 512  # of an annulus that a range grows by
STEP_QUERIES = 64  # whose ranges grow together

_FOUND = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v): whole components floor(scale * x), one row for an id, the least if it has several."""
    usable = F.col(vector_col).isNotNull() & F.col(id_col).isNotNull()
    bad = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale))
    rows = vectors.filter(usable & ~bad).select(F.col(id_col).cast("long").alias("id"), whole.alias("v"))
    return rows.groupBy("id").agg(F.min("v").alias("v"))


@dataclass
class Pivots:
    """Pivots with their extra component, ring edges, and what each annulus holds."""

    width: int
    most: float  # greatest squared norm
    at: np.ndarray
    extra: np.ndarray
    edges: np.ndarray
    rows: np.ndarray | None = None
    near: np.ndarray | None = None
    far: np.ndarray | None = None

    def distances(self, v: np.ndarray, extra: np.ndarray) -> np.ndarray:
        squares = (v**2).sum(axis=1)[:, None] + (self.at**2).sum(axis=1)[None, :] - 2 * v @ self.at.T
        return np.sqrt(np.maximum(squares + (extra[:, None] - self.extra[None, :]) ** 2, 0))

    def of_rows(self, v: np.ndarray) -> np.ndarray:
        return self.distances(v, np.sqrt(np.maximum(self.most - (v**2).sum(axis=1), 0)))

    def of_queries(self, v: np.ndarray) -> np.ndarray:
        return self.distances(v, np.zeros(len(v)))

    @property
    def salts(self) -> np.ndarray:
        return np.maximum(1, np.ceil(self.rows / BUCKET_ROWS)).astype(int)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of whole numbers, short ones filled up with zeros."""
    out = np.zeros((len(column), width), np.int64)
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(column)), lengths)
    place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, place] = values
    return out


def _joined(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whole inner products: by floats where they are exact, else by whole numbers."""
    bound = math.sqrt((queries.astype(float) ** 2).sum(axis=1).max() * (rows.astype(float) ** 2).sum(axis=1).max())
    if bound < 1 << 52:
        return np.rint(queries.astype(float) @ rows.astype(float).T).astype(np.int64)
    return queries @ rows.T


def _fit(rows: DataFrame) -> Pivots | None:
    """Pivots by a few rounds of k-means on at most ``SAMPLE_ROWS`` rows, in order of a hash."""
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    most, width = rows.agg(F.max(square), F.max(F.size("v"))).first()
    if most is None:
        return None
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("v").collect()
    width = max(int(width), 1)
    v = _matrix(pa.array([r.v for r in sample], pa.list_(pa.int64())), width).astype(float)
    extra = np.sqrt(np.maximum(most - (v**2).sum(axis=1), 0))
    full = np.concatenate([v, extra[:, None]], axis=1)
    centres = np.unique(full[:: max(1, len(full) // PIVOTS)][:PIVOTS], axis=0)
    for _ in range(5):
        nearest = ((full[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.stack([full[nearest == c].mean(axis=0) if (nearest == c).any() else centres[c] for c in range(len(centres))])
    pivots = Pivots(width, float(most), centres[:, :-1], centres[:, -1], np.zeros((len(centres), RINGS - 1)))
    away = pivots.of_rows(v)
    nearest = away.argmin(axis=1)
    for c in range(len(centres)):
        own = away[nearest == c, c]
        if len(own):
            pivots.edges[c] = np.quantile(own, np.arange(1, RINGS) / RINGS)
    return pivots


def _keyed(pivots: Pivots):
    def key(batches):
        for batch in batches:
            away = pivots.of_rows(_matrix(batch.column("v"), pivots.width).astype(float))
            cell = away.argmin(axis=1) if len(away) else np.zeros(0, int)
            distance = away[np.arange(len(cell)), cell]
            ring = (distance[:, None] > pivots.edges[cell]).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("v"), pa.array((cell * RINGS + ring).astype(np.int32)), pa.array(distance)],
                ["id", "v", "bucket", "distance"],
            )

    return key


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def _seeds(pivots: Pivots, k: int):
    """The bucket each query starts in: the nearest of those with rows enough."""
    enough = np.flatnonzero(pivots.rows // pivots.salts > k)
    enough = enough if len(enough) else np.flatnonzero(pivots.rows > 0)

    def seed(batches):
        for batch in batches:
            away = pivots.of_queries(_matrix(batch.column("v"), pivots.width).astype(float))
            away = away[:, enough // RINGS]
            gap = np.maximum(np.maximum(pivots.near[enough] - away, away - pivots.far[enough]), 0)
            bucket = enough[np.lexsort((away, gap), axis=1)[:, 0]] if len(away) else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(bucket.astype(np.int32))], [*batch.schema.names, "bucket"]
            )

    return seed


def _reach(pivots: Pivots, v: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """How far from a query a row may be whose score is ``bound`` or more."""
    squares = (v**2).sum(axis=1) + pivots.most - 2 * bound
    return np.where(np.isfinite(bound), np.sqrt(np.maximum(squares, 0)) * (1 + 1e-9) + 1e-6, np.inf)


def _spread(pivots: Pivots):
    """Every query to all buckets that may hold a row within its reach."""

    def spread(batches):
        used = np.flatnonzero(pivots.rows > 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column("v"), pivots.width).astype(float)
            bound = batch.column("bound").to_numpy(zero_copy_only=False).astype(float)
            reach, away = _reach(pivots, v, bound), pivots.of_queries(v)[:, used // RINGS]
            gap = np.maximum(pivots.near[used] - away, away - pivots.far[used])
            query, at = np.nonzero(gap <= reach[:, None])
            bucket = used[at]
            times = pivots.salts[bucket]
            salt = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            query, bucket = np.repeat(query, times), np.repeat(bucket, times)
            for a in range(0, len(query), 4096):
                rows = batch.take(pa.array(query[a : a + 4096]))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[rows.column(name) for name in ("id", "v", "bound", "share")],
                        pa.array(bucket[a : a + 4096].astype(np.int32)),
                        pa.array(salt[a : a + 4096].astype(np.int32)),
                    ],
                    ["id", "v", "bound", "share", "bucket", "salt"],
                )

    return spread


@dataclass
class Annulus:
    """Rows of one pivot sorted by their distance from it."""

    ids: np.ndarray
    v: np.ndarray
    distance: np.ndarray
    products: int = 0  # computed so far

    def best(self, pivots: Pivots, away: np.ndarray, ids: np.ndarray, q: np.ndarray, bound: np.ndarray, k: int):
        """Up to ``k`` rows for each of some queries: their number, ids and scores.

        ``away`` is how far the queries are from the pivot. From there the range of
        rows grows to both sides, a stretch at a time; the k-th score so far draws
        the reach in, and rows beyond the reach of all queries are never multiplied.
        """
        real, bound = q.astype(float), bound.copy()
        none = np.zeros(0, np.int64)
        found = [(none, none)] * len(q)
        left = right = int(np.searchsorted(self.distance, np.median(away)))
        while True:
            reach = _reach(pivots, real, bound)
            low = int(np.searchsorted(self.distance, (away - reach).min(), "left"))
            high = int(np.searchsorted(self.distance, (away + reach).max(), "right"))
            spans = [(max(low, left - STEP_ROWS), left), (right, min(high, right + STEP_ROWS))]
            spans = [(a, b) for a, b in spans if a < b]
            if not spans:
                break
            for a, b in spans:
                scores, own = _products(q, self.v[a:b]), self.ids[a:b]
                self.products += scores.size
                for i in np.flatnonzero((scores >= bound[:, None]).any(axis=1)):
                    keep = np.flatnonzero((own != ids[i]) & (scores[i] >= bound[i]))
                    if len(keep) > 8 * k:  # ties of the k-th stay in
                        top = scores[i, keep]
                        keep = keep[top >= np.partition(top, -k)[-k]]
                    both = np.concatenate([found[i][0], own[keep]]), np.concatenate([found[i][1], scores[i, keep]])
                    least = _best(*both, k)
                    found[i] = both[0][least], both[1][least]
                    if len(least) == k:
                        bound[i] = max(bound[i], found[i][1][-1])
            left, right = min(left, spans[0][0]), max(right, spans[-1][1])
        return [len(x) for x, _ in found], np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def _search(pivots: Pivots, k: int):
    """The best rows of one bucket for every query that reaches it."""

    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if queries.num_rows and rows.num_rows:
            cell = queries["bucket"][0].as_py() // RINGS
            q, x = (_matrix(_joined(t["v"]), pivots.width) for t in (queries, rows))
            q_ids, bound = queries["id"].to_numpy(), queries["bound"].to_numpy().astype(float)
            distance = rows["distance"].to_numpy()
            order = np.argsort(distance, kind="stable")
            annulus = Annulus(rows["id"].to_numpy()[order], x[order], distance[order])
            away = pivots.of_queries(q.astype(float))[:, cell]
            # Queries of about one distance go together, as their ranges overlap.
            order = np.argsort(away, kind="stable")
            for a in range(0, len(q), STEP_QUERIES):
                some = order[a : a + STEP_QUERIES]
                counts, ids, scores = annulus.best(pivots, away[some], q_ids[some], q[some], bound[some], k)
                out.append((np.repeat(q_ids[some], counts), ids, scores))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, columns))))

    return search


def exact_top_k(
    vectors: DataFrame,
    queries: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
) -> DataFrame:
    """The ``k`` rows of the greatest inner product for each row where ``queries`` holds.

    Components count as floor(``scale`` * x); a score is the whole inner product,
    without overflow for norms below 2^31. A query's own id is no candidate. Returns
    ``query_id``, ``rank`` from 1, ``vec_id`` and ``score``; ties go to the smaller
    id, and a query with fewer candidates has fewer rows.

    Vectors that are null or hold null or non-finite components take no part, nor
    rows without id. Of several rows of one id the least vector counts. Shorter
    vectors count as filled up with zeros. Other columns are ignored but may be
    used in ``queries``, which is a condition on the id. Without rows there is no
    result.
    """
    spark = vectors.sparkSession
    rows = exchange.stored(quantised(vectors, id_col, vector_col, scale), "vectors")
    pivots = _fit(rows)
    if pivots is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    index = rows.mapInArrow(_keyed(pivots), "id long, v array<bigint>, bucket int, distance double")
    index = exchange.stored(index, "vector-index")
    buckets = len(pivots.at) * RINGS
    held = index.groupBy("bucket").agg(F.count("*"), F.min("distance"), F.max("distance")).collect()
    pivots.rows, pivots.near, pivots.far = np.zeros(buckets, int), np.full(buckets, np.inf), np.full(buckets, -np.inf)
    for bucket, n, near, far in held:
        pivots.rows[bucket], pivots.near[bucket], pivots.far[bucket] = n, near, far

    asked = rows.withColumnRenamed("id", id_col).filter(queries).withColumnRenamed(id_col, "id")
    asked = asked.select("id", "v")
    shares = max(1, math.ceil(asked.count() / QUERY_ROWS))
    salts = F.get(F.array(*[F.lit(int(s)) for s in pivots.salts]), F.col("bucket"))
    index = index.withColumn("salt", F.pmod(F.xxhash64("id"), salts).cast("int"))

    def searched(sent: DataFrame, held: DataFrame) -> DataFrame:
        held = held.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
        keys = ["bucket", "salt", "share"]
        return sent.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(_search(pivots, k), _FOUND)

    share = F.pmod(F.xxhash64("id"), F.lit(shares)).cast("int").alias("share")
    start = asked.select("id", "v", F.lit(float("-inf")).alias("bound"), share)
    start = start.mapInArrow(_seeds(pivots, k), "id long, v array<bigint>, bound double, share int, bucket int")
    first = searched(start.withColumn("salt", F.lit(0)), index.filter("salt = 0"))
    # The k-th score found so far; a query with fewer has no bound yet.
    bounds = first.groupBy("query_id").agg(F.min("score").alias("bound"), F.count("*").alias("n"))
    bounds = bounds.filter(F.col("n") >= k).select(F.col("query_id").alias("id"), F.col("bound").cast("double"))
    bounded = asked.join(bounds, "id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    sent = exchange.stored(bounded.select("id", "v", "bound", share), "vector-queries").mapInArrow(
        _spread(pivots), "id long, v array<bigint>, bound double, share int, bucket int, salt int"
    )
    found = searched(sent, index)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")).alias("rank")
    return found.select("query_id", rank, "vec_id", "score").filter(F.col("rank") <= k)
