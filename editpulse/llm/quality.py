"""Quality by co-training: a model of the text and a model of the metadata.

Both are logistic regressions, over separate features. In every round each view
is trained on the labelled rows and on what the other view was sure of in the
round before, among all documents; after the rounds a curve, fitted on labelled
rows that neither view saw, combines both views' calibrated opinions.

All training is by sums over the documents: a Newton step is one pass in which
tasks add up gradients and curvatures of both views at once, and only these
sums, of a fixed size, come to the driver. Pseudo-labels are not stored but
follow from the models of the round before.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.llm import exchange, text as tx
from editpulse.llm.toxicity import fold

ROUNDS = 3
STEPS = 3  # Newton steps of a round
SURE = 0.95
PSEUDO_WEIGHT = 0.2
RIDGE = 1.0
LANGS, SOURCES = 16, 64  # buckets that names are hashed to
CURVE_ROWS = 20_000

# Kinds of bytes that a text's shares are counted of.
_KINDS = np.full(256, 9)
for _kind, _bytes in enumerate(
    (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".,;:!?'\"-()", b"|", b"<>/=", b"#$%&*@~^_+")
):
    _KINDS[list(_bytes)] = _kind
_KINDS[128:] = 10
CONTENT = 11 + 7
META = 2 + LANGS + SOURCES


def _content(column: pa.Array) -> np.ndarray:
    """Features of texts: shares of byte kinds, lengths, and how much repeats."""
    data, starts = tx.texts(column)
    out = np.zeros((len(column), CONTENT))
    for a, b in tx.runs_of(starts):
        part, edges = data[starts[a] : starts[b]], starts[a : b + 1] - starts[a]
        size, n = np.diff(edges), b - a
        of = np.repeat(np.arange(n), size)
        kinds = np.bincount(of * 11 + _KINDS[part], minlength=11 * n).reshape(n, 11)
        found = tx.words(part, edges)
        counts = np.maximum(found.counts(n), 1)
        distinct = np.unique(found.doc * np.int64(1 << 40) + (found.hash >> tx.U64(24)).astype(np.int64))
        kinds_of_words = np.bincount(distinct >> 40, minlength=n)
        lengths = found.end - found.start
        lines = tx.words(part, edges, np.arange(256) != 10)
        line_kinds = np.unique(lines.doc * np.int64(1 << 40) + (lines.hash >> tx.U64(24)).astype(np.int64))
        n_lines = np.maximum(lines.counts(n), 1)
        last = _KINDS[part[np.maximum(found.end - 1, 0)]] if len(part) else np.zeros(0, int)
        more = [
            np.log1p(counts),
            np.bincount(found.doc, weights=lengths, minlength=n) / counts,
            np.bincount(found.doc, weights=lengths > 20, minlength=n) / counts,
            kinds_of_words / counts,
            np.bincount(line_kinds >> 40, minlength=n) / n_lines,
            np.log1p(counts / n_lines),
            np.bincount(found.doc, weights=last == 8, minlength=n) / counts,
        ]
        out[a:b] = np.concatenate([kinds / np.maximum(size, 1)[:, None], np.stack(more, axis=1)], axis=1)
    return out


def _features(batches):
    for batch in batches:
        content = _content(batch.column("text"))
        meta = np.zeros((batch.num_rows, META))
        chars = batch.column("n_chars").to_numpy(zero_copy_only=False).astype(float)
        meta[:, 0], meta[:, 1] = np.log1p(np.maximum(np.nan_to_num(chars), 0)), np.isnan(chars)
        rows = np.arange(batch.num_rows)
        meta[rows, 2 + batch.column("lang").to_numpy()] = 1
        meta[rows, 2 + LANGS + batch.column("source").to_numpy()] = 1
        pack = lambda x: pa.array([r.tobytes() for r in x.astype(np.float32)], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pack(content), pack(meta)], ["id", "content", "meta"]
        )


def _unpacked(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    joined = b"".join(batch.column(name).to_pylist())
    return np.frombuffer(joined, np.float32).reshape(-1, width).astype(float)


@dataclass
class View:
    """One view: its features' scale, and its weights once it is trained."""

    name: str
    width: int
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray | None = None

    def inputs(self, batch: pa.RecordBatch) -> np.ndarray:
        x = (_unpacked(batch, self.name, self.width) - self.mean) / self.spread
        return np.concatenate([np.ones((len(x), 1)), np.clip(x, -8, 8)], axis=1)


def _chance(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _sums(rows: DataFrame, per_batch) -> np.ndarray:
    """The sum over all rows of what ``per_batch`` makes of a batch, an array of a fixed size."""

    def add(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = per_batch(batch)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    total = None
    for row in rows.mapInArrow(add, "sums binary").toLocalIterator():
        part = np.frombuffer(row.sums)
        total = part.copy() if total is None else total + part
    return total


def _scaled(rows: DataFrame) -> list[View]:
    def moments(batch):
        x = np.concatenate([_unpacked(batch, "content", CONTENT), _unpacked(batch, "meta", META)], axis=1)
        return np.concatenate([[len(x)], x.sum(axis=0), (x**2).sum(axis=0)])

    sums = _sums(rows, moments)
    width = CONTENT + META
    n, mean = (sums[0], sums[1 : 1 + width] / sums[0]) if sums is not None else (0, np.zeros(width))
    spread = np.sqrt(np.maximum(sums[1 + width :] / n - mean**2, 0)) if n else np.zeros(width)
    spread[spread < 1e-6] = 1
    cut = CONTENT
    return [View("content", CONTENT, mean[:cut], spread[:cut]), View("meta", META, mean[cut:], spread[cut:])]


def _step(views: list[View], teachers: list[View] | None, current: list[np.ndarray]):
    """Gradient and curvature of both views over a batch."""

    def add(batch):
        label = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
        use = np.isin(batch.column("fold").to_numpy(), (1, 2, 3)) & ~np.isnan(label)
        inputs = [view.inputs(batch) for view in views]
        told = [_chance(x @ t.weights) for x, t in zip(inputs, teachers)] if teachers else [None, None]
        out = []
        for own, x in enumerate(inputs):
            target, weight = np.where(use, np.nan_to_num(label), 0.0), use.astype(float)
            other = told[1 - own]
            if other is not None:
                sure = ~use & ((other >= SURE) | (other <= 1 - SURE))
                target = np.where(sure, other >= SURE, target)
                weight = np.where(sure, PSEUDO_WEIGHT, weight)
            p = _chance(x @ current[own])
            gradient = x.T @ (weight * (p - target))
            curvature = (x * (weight * p * (1 - p))[:, None]).T @ x
            out += [gradient, curvature.ravel()]
        return np.concatenate(out)

    return add


def _trained(rows: DataFrame, views: list[View]) -> list[View]:
    teachers = None
    current = [np.zeros(view.width + 1) for view in views]
    for _ in range(ROUNDS):
        for _ in range(STEPS):
            sums = _sums(rows, _step(views, teachers, current))
            at = 0
            for own, view in enumerate(views):
                d = view.width + 1
                gradient = (sums[at : at + d] if sums is not None else np.zeros(d)) + RIDGE * current[own]
                curvature = sums[at + d : at + d + d * d].reshape(d, d) if sums is not None else np.zeros((d, d))
                current[own] = current[own] - np.linalg.solve(curvature + RIDGE * np.eye(d), gradient)
                at += d + d * d
        teachers = [View(v.name, v.width, v.mean, v.spread, w.copy()) for v, w in zip(views, current)]
    return teachers


def _opinions(views: list[View]):
    def tell(batches):
        for batch in batches:
            z = [np.clip(view.inputs(batch) @ view.weights, -30, 30) for view in views]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(z[0]), pa.array(z[1])], ["id", "content", "meta"])

    return tell


def _combined(sample: list) -> np.ndarray:
    """Curve over both views' opinions, from labelled rows kept out of their training."""
    if not sample:
        return np.array([0.0, 0.5, 0.5])
    rows = np.array([[1.0, r.content, r.meta] for r in sample])
    label, w = np.array([float(r.label) for r in sample]), np.array([0.0, 0.5, 0.5])
    for _ in range(20):
        p = _chance(rows @ w)
        step = (rows * (p * (1 - p))[:, None]).T @ rows + 0.01 * np.eye(3)
        w = w - np.linalg.solve(step, rows.T @ (p - label) + 0.01 * w)
    return w


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """``id_col``, ``held_out``, ``content`` and ``meta`` (opinions), ``score``, ``predicted`` of every row.

    The metadata are ``n_chars``, ``lang`` and ``source``. Labels are learned from
    rows whose fold is not 0: folds 1 to 3 train both views, at most
    ``CURVE_ROWS`` rows of fold 4, in order of a hash, fit the curve over them. All
    rows take part as unlabelled. Of several labels of an id the least counts.

    A null or empty text has a content of zeros, a null name a bucket of its own,
    a null length a mark. Rows of one id get the same label and a row each.
    Without labels every score is one half. An empty table gives an empty one;
    other columns are ignored.
    """
    known = labels.select(F.col(id_col).cast("long").alias("of"), F.col(label_col).alias("label"))
    known = known.dropna().groupBy("of").agg((F.min("label") > 0).cast("int").alias("label"))
    name = lambda column, n: F.pmod(F.xxhash64(F.coalesce(column, F.lit("\0null"))), F.lit(n)).cast("int")
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(text_col).alias("text"),
        F.col("n_chars").cast("double").alias("n_chars"),
        name(F.col("lang"), LANGS).alias("lang"),
        name(F.col("source"), SOURCES).alias("source"),
    )
    rows = rows.mapInArrow(_features, "id long, content binary, meta binary")
    rows = rows.join(known.hint("merge"), rows["id"] == known["of"], "left").drop("of")
    rows = exchange.stored(rows.withColumn("fold", fold(F.col("id")).cast("int")), "quality-features")
    views = _trained(rows, _scaled(rows))
    told = exchange.stored(rows.select("id", "content", "meta").mapInArrow(_opinions(views), "id long, content double, meta double"), "quality-opinions")

    held = told.join(known.filter(fold(F.col("of")) == 4).hint("merge"), F.col("id") == F.col("of"))
    sample = held.orderBy(F.xxhash64("id"), "id").limit(CURVE_ROWS).select("content", "meta", "label").collect()
    base, content, meta = (F.lit(float(x)) for x in _combined(sample))
    score = 1 / (1 + F.exp(-(base + content * F.col("content") + meta * F.col("meta"))))
    scored = told.select(F.col("id").alias(id_col), (fold(F.col("id")) == 0).alias("held_out"), "content", "meta", score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
