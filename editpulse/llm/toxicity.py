"""Toxicity by Kneser-Ney language models, one pair for each of two scales.

One pair runs over the bytes of each word, so that endings and new words made of
known parts count; the other takes words whole. At the highest order each class
has its own discounted counts. What the discount leaves goes to counts that both
classes share: continuation counts of bytes, and all counts of a word. What
was never counted falls back to the bytes before it, or says nothing.

A word's evidence is log p(toxic) - log p(ordinary), over its bytes and as a
whole. A text's evidence is the sum over its words, by their number and by its
root; a logistic curve over these, fitted on labelled rows kept out of the
counts, makes it a score.

Evidence is weighed by how sure it is: by the likelihood ratio of both counts
against equal shares, over itself plus ``DOUBT``. Few counts weigh little and
none are left out.

Counts cover every labelled row, are summed by Spark and all stay, however rare.
Evidence is worked out for the distinct words of the texts, joined to the counts
by the bytes before each n-gram's last; a block of texts sends each shard its
distinct words and gets back theirs. No table of words or n-grams is broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editpulse.llm import exchange, text as tx
from editpulse.llm.text import U64

ORDER = 7
DISCOUNT = 0.75
DOUBT = 100.0  # chosen by the log loss of fold 4 on sf0.1, among 1, 3, 10, 30 and 100
VALUES = ("bytes", "words")
CALIBRATION_ROWS = 20_000
BLOCK_BYTES = 16 << 20  # of texts that meet their words' evidence in one task
VOCABULARY_BYTES = 4 << 20
RIDGE = 1e-3
_WORD = U64(1 << 63)  # marks the number of a whole word, which is its hash
_BEFORE, _AFTER = 1, 2  # stand for the edges of a word


@dataclass
class Model:
    """``VALUES`` of each word, its evidence over its bytes and as a whole; and the curve."""

    values: DataFrame
    curve: tuple[float, ...] = (0.0, 0.0, 0.5, 0.0, 0.5)


def _distinct_words(data: np.ndarray, starts: np.ndarray):
    """Words of the texts, the distinct ones by their first place, and which each is."""
    found = tx.words(data, starts, tx.ALNUM, tx.LOWER)
    _, first, which = np.unique(found.hash, return_index=True, return_inverse=True)
    return found, first, which


def _grams(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte and after the last, as a number; and its word."""
    length = last - first
    ends = np.cumsum(length + 1)
    total = int(ends[-1]) if len(ends) else 0
    word = np.repeat(np.arange(len(first)), length + 1)
    place = np.arange(total) - (ends - length - 1)[word]
    end, base = length[word], first[word]
    grams = np.zeros(total, U64)
    for back in range(ORDER - 1, -1, -1):
        at = place - back
        byte = tx.LOWER[data[np.clip(base + at, 0, max(len(data) - 1, 0))]].astype(U64)
        byte[at == end] = _AFTER
        byte[at == -1] = _BEFORE
        byte[at < -1] = 0
        grams = (grams << U64(8)) | byte
    return grams, word


def _shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each number: n-grams of the same bytes before the last share one."""
    mixed = tx.mix(np.where(keys & _WORD, keys, keys >> U64(8)))
    return (((mixed >> U64(32)) * U64(shards)) >> U64(32)).astype(np.int32)


def _count(shards: int):
    """Counts of n-grams by class, summed up piece by piece; Spark sums the pieces."""

    def count(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            data, starts = tx.texts(batch.column("text"))
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
            for a, b in tx.runs_of(starts):
                part = data[starts[a] : starts[b]]
                found, first, which = _distinct_words(part, starts[a : b + 1] - starts[a])
                if not len(first):
                    continue
                # A text counts each of its words once: one that repeats itself says no more.
                doc, word = np.divmod(np.unique(found.doc * np.int64(len(first)) + which), len(first))
                bad = toxic[a:b][doc]
                times = np.stack([np.bincount(word[kind], minlength=len(first)) for kind in (bad, ~bad)])
                grams, word = _grams(part, found.start[first], found.end[first])
                keys = np.concatenate([grams, found.hash[first] | _WORD])
                held.append(_summed(keys, np.concatenate([times[:, word], times], axis=1)))
                size += len(held[-1][0])
                if size > 1 << 21:
                    yield from _counted(held, shards)
                    held, size = [], 0
        if held:
            yield from _counted(held, shards)

    return count


def _counted(held: list, shards: int):
    grams, counts = _summed(np.concatenate([g for g, _ in held]), np.concatenate([c for _, c in held], axis=1))
    columns = [_shard_of(grams, shards), grams.astype(np.int64), *counts]
    for a in range(0, len(grams), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(x[a : a + (1 << 16)]) for x in columns], ["shard", "gram", "toxic", "plain"])


def _summed(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, which = np.unique(grams, return_inverse=True)
    return keys, np.stack([np.bincount(which, weights=c, minlength=len(keys)).astype(np.int64) for c in counts])


def _vocabulary(blocks: int):
    """Words of the texts in small letters, once for each run of texts, by blocks of their hash."""

    def collect(batches):
        for batch in batches:
            data, starts = tx.texts(batch.column("text"))
            for a, b in tx.runs_of(starts, VOCABULARY_BYTES):
                part = data[starts[a] : starts[b]]
                found, first, _ = _distinct_words(part, starts[a : b + 1] - starts[a])
                lowered = tx.LOWER[part].tobytes()
                kinds = [lowered[x:y] for x, y in zip(found.start[first].tolist(), found.end[first].tolist())]
                # The distinct words stand in order of their hash: a block's are a slice.
                edges = exchange.shard_edges(found.hash[first], blocks)
                used = np.flatnonzero(np.diff(edges))
                packed = [b"\n".join(kinds[edges[x] : edges[x + 1]]) for x in used]
                yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(packed, pa.binary())], ["block", "words"])

    return collect


class _Block:
    """Distinct words of a block and all numbers of which they need the evidence."""

    def __init__(self, table: pa.Table, shards: int):
        data = np.frombuffer(b"\n".join(table["words"].to_pylist()), np.uint8)
        found = tx.words(data, np.array([0, len(data)]), tx.ALNUM, tx.LOWER)
        self.hash, first = np.unique(found.hash, return_index=True)
        grams, self.word = _grams(data, found.start[first], found.end[first])
        self.keys, which = np.unique(np.concatenate([grams, self.hash | _WORD]), return_inverse=True)
        self.of_gram, self.of_word = which[: len(grams)], which[len(grams) :]
        shard = _shard_of(self.keys, shards)
        self.order = np.argsort(shard, kind="stable")
        self.edges = np.searchsorted(shard[self.order], np.arange(shards + 1))


def _ask(shards: int):
    """A block's numbers, once each, one row for each shard."""

    def ask(table: pa.Table) -> pa.Table:
        block = _Block(table, shards)
        keys, used = block.keys[block.order], np.flatnonzero(np.diff(block.edges))
        rows = [keys[block.edges[s] : block.edges[s + 1]].tobytes() for s in used]
        number = pa.array([table["block"][0].as_py()] * len(used), pa.int32())
        return pa.table({"shard": pa.array(used.astype(np.int32)), "block": number, "keys": pa.array(rows, pa.binary())})

    return ask


def _valued(shards: int):
    """Evidence of a block's words from what the shards say of their numbers."""

    def value(table: pa.Table, answers: pa.Table) -> pa.Table:
        block = _Block(table, shards)
        by_key = np.zeros(len(block.keys))
        told = [np.frombuffer(x, np.float32) for x in answers.sort_by("shard")["found"].to_pylist()]
        by_key[block.order] = np.concatenate([np.zeros(0, np.float32), *told])
        in_bytes = np.bincount(block.word, weights=by_key[block.of_gram], minlength=len(block.hash))
        columns = (block.hash.astype(np.int64), in_bytes, by_key[block.of_word])
        return pa.table(dict(zip(("word", *VALUES), map(pa.array, columns))))

    return value


def _all_words(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and edges of a block's texts, and its distinct words' hashes in order."""
    data, starts = tx.texts(table["text"])
    held = [
        np.unique(tx.words(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a], tx.ALNUM, tx.LOWER).hash)
        for a, b in tx.runs_of(starts)
    ]
    return data, starts, np.unique(np.concatenate(held)) if held else np.zeros(0, U64)


def _pack(batches):
    """Rows of a batch by their block, compressed together: texts are most of what is shuffled."""
    for batch in batches:
        block = batch.column("block").to_numpy(zero_copy_only=False)
        order = np.argsort(block, kind="stable")
        used, edges = np.unique(block[order], return_index=True)
        rows = pa.Table.from_batches([batch]).select(["carry", "text"]).take(pa.array(order))
        packed = []
        for a, b in zip(edges, [*edges[1:], len(order)]):
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(rows.slice(a, b - a).combine_chunks())
            packed.append(out.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(packed, pa.binary())], ["block", "rows"])


def _unpacked(table: pa.Table) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(x.as_buffer()).read_all() for x in table["rows"]])


def _send_words(shards: int):
    def send(table: pa.Table) -> pa.Table:
        _, _, keys = _all_words(_unpacked(table))
        edges = exchange.shard_edges(keys, shards)
        used = np.flatnonzero(np.diff(edges))
        return pa.table(
            {
                "shard": pa.array(used.astype(np.int32)),
                "block": pa.array([table["block"][0].as_py()] * len(used), pa.int32()),
                "keys": pa.array([keys[edges[s] : edges[s + 1]].tobytes() for s in used], pa.binary()),
            }
        )

    return send


def _answer(sent: pa.Table, values: pa.Table) -> pa.Table:
    """All ``VALUES`` of the words of each row of ``sent``, in their order."""
    word = values["word"].to_numpy().view(np.uint64)
    order = np.argsort(word)
    all_ = np.stack([values[name].to_numpy()[order] for name in VALUES])
    wanted = [np.frombuffer(x, np.uint64) for x in sent["keys"].to_pylist()]
    found = [all_[:, np.searchsorted(word[order], keys)].astype(np.float32).tobytes() for keys in wanted]
    return pa.table(
        {"block": sent["block"].cast(pa.int32()), "shard": sent["shard"].cast(pa.int32()), "found": pa.array(found, pa.binary())}
    )


def _evidence(table: pa.Table, answers: pa.Table) -> pa.Table:
    """Sums of all ``VALUES`` over every text, and its number of words, beside its row."""
    table = _unpacked(table)
    data, starts, keys = _all_words(table)
    packed = answers.sort_by("shard")["found"].to_pylist()  # shards are ranges of the hashes
    none = np.zeros((len(VALUES), 0))
    by_word = np.concatenate([none, *[np.frombuffer(x, np.float32).reshape(len(VALUES), -1) for x in packed]], axis=1)
    sums, counts = [], []
    for a, b in tx.runs_of(starts):
        found = tx.words(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a], tx.ALNUM, tx.LOWER)
        values = by_word[:, np.searchsorted(keys, found.hash)]
        sums.append(np.stack([np.bincount(found.doc, weights=x, minlength=b - a) for x in values]))
        counts.append(found.counts(b - a))
    sums = dict(zip(VALUES, map(pa.array, np.concatenate([none, *sums], axis=1))))
    n_words = pa.array(np.concatenate([np.zeros(0, np.int64), *counts]))
    return pa.table({"carry": table["carry"], "text": table["text"], **sums, "n_words": n_words})


def with_evidence(docs: DataFrame, carry: list[Column], text_col: str, model: Model) -> DataFrame:
    """``carry``, ``text``, evidence and number of words of every row; ``model`` covers all words."""
    n = exchange.parts(docs, text_col, BLOCK_BYTES)
    rows = docs.select(F.struct(*carry).alias("carry"), F.col(text_col).alias("text"))
    # Rows spread by all they hold: no id, nor a text under several ids, is one block.
    rows = rows.withColumn("block", F.pmod(F.xxhash64("carry", "text"), F.lit(n)).cast("int"))
    kind = rows.schema["carry"].dataType.simpleString()
    rows = rows.select("block", "carry", "text").mapInArrow(_pack, "block int, rows binary")
    sent = rows.groupBy("block").applyInArrow(_send_words(n), "shard int, block int, keys binary")
    shard = F.shiftright(F.shiftrightunsigned("word", 32) * n, 32).cast("int").alias("shard")
    values = model.values.select(shard, "word", *VALUES)
    answers = sent.groupBy("shard").cogroup(values.groupBy("shard")).applyInArrow(_answer, "block int, shard int, found binary")
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _evidence, f"carry {kind}, text string, {', '.join(f'{name} double' for name in VALUES)}, n_words long"
    )


def fold(id_col: Column) -> Column:
    """Remainder by 5 of a document's checksum; 0 for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5, F.lit(0))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", doubt: float = DOUBT) -> Model:
    """Both models and the curve, from labelled rows whose ``fold`` is not 0.

    Folds 1 to 3 are counted whole; the curve is fitted on at most
    ``CALIBRATION_ROWS`` rows of fold 4, in order of a hash. An id with several
    labels is toxic if one says so; null labels and ids do not count.
    """
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("toxic"))
    known = known.dropna().groupBy("id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # Merged at every size: labels grow with the texts, so they are never broadcast.
    counted = texts.join(known.filter(fold(F.col("id")).isin(1, 2, 3)).hint("merge"), "id")
    shards = exchange.parts(texts, "text")
    grams = counted.select("text", "toxic").mapInArrow(_count(shards), "shard int, gram long, toxic long, plain long")
    summed = grams.groupBy("shard", "gram").agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain"))
    grams = exchange.stored(summed, "grams")
    exchange.tidy(docs.sparkSession)
    model = Model(_values(texts, grams, shards, doubt))
    exchange.discard(grams)

    held = known.filter(fold(F.col("id")) == 4).orderBy(F.xxhash64("id"), "id").limit(CALIBRATION_ROWS)
    # At most CALIBRATION_ROWS ids and labels: the texts stay where they are.
    sample = texts.join(F.broadcast(held), "id").dropDuplicates(["id"])
    rows = with_evidence(sample, [F.col("toxic")], "text", model).select("carry.toxic", *VALUES, "n_words").collect()
    if rows:
        model.curve = _curve(*(np.array(x, float) for x in zip(*rows)))
    exchange.tidy(docs.sparkSession)
    return model


def _values(texts: DataFrame, grams: DataFrame, shards: int, doubt: float = DOUBT) -> DataFrame:
    """Evidence of every distinct word of ``texts``, over its bytes and as a whole.

    Words are distinct within blocks of their hash. A block asks each shard of the
    counts for its distinct numbers, packed; no n-gram of a word is a row.
    """
    words = texts.select("text").mapInArrow(_vocabulary(shards), "block int, words binary")
    asked = words.groupBy("block").applyInArrow(_ask(shards), "shard int, block int, keys binary")
    told = asked.groupBy("shard").cogroup(grams.groupBy("shard")).applyInArrow(
        _tell(*_totals(grams), doubt), "block int, shard int, found binary"
    )
    values = words.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        _valued(shards), f"word long, {', '.join(f'{name} double' for name in VALUES)}"
    )
    return exchange.stored(values, "word-evidence")


def _totals(grams: DataFrame) -> tuple:
    """What all shards need: the shared model of byte pairs, and sums over all counts of each kind."""
    # Continuation counts of the last two bytes: 65,536 rows at most.
    pair = F.col("gram").bitwiseAND(0xFFFF).alias("pair")
    in_bytes, whole = grams.filter("gram >= 0"), grams.filter("gram < 0")
    shared = _shared(in_bytes.groupBy(pair).agg(F.count("*").alias("kinds")).toPandas())
    kinds = ("toxic", "plain")
    left = lambda kind: F.greatest(F.col(kind) - DISCOUNT, F.lit(0.0))
    totals = [x or 0 for x in in_bytes.agg(*[F.sum(kind) for kind in kinds]).first()]
    words = [float(x or 0) for x in whole.agg(*[F.sum(kind) for kind in kinds], *[F.sum(left(kind)) for kind in kinds]).first()]
    return shared, totals, words[:2], words[2:]


def _tell(shared: np.ndarray, totals: list, word_totals: list, word_spent: list, doubt: float):
    """Evidence of the numbers that blocks ask a shard for, from its counts."""

    def tell(asked: pa.Table, counts: pa.Table) -> pa.Table:
        gram = counts["gram"].to_numpy().view(np.uint64)
        order = np.argsort(gram)
        gram, both = gram[order], [counts[kind].to_numpy()[order].astype(float) for kind in ("toxic", "plain")]
        words = int(np.searchsorted(gram, _WORD))  # they come after all n-grams
        context, rest, value = _of_contexts(gram[:words], [x[:words] for x in both], shared, totals, doubt)
        value = np.concatenate([value, _of_words([x[words:] for x in both], word_totals, word_spent, doubt)])
        found = []
        for packed in asked["keys"].to_pylist():
            keys = np.frombuffer(packed, np.uint64)
            known, at = _place(gram, keys)
            told = np.where(known, value[at] if len(value) else 0.0, 0.0)
            seen, at = _place(context, keys >> U64(8))
            unseen = ~known & seen & (keys < _WORD)
            told[unseen] = rest[at[unseen]]
            found.append(told.astype(np.float32).tobytes())
        columns = (asked["block"].cast(pa.int32()), asked["shard"].cast(pa.int32()), pa.array(found, pa.binary()))
        return pa.table(dict(zip(("block", "shard", "found"), columns)))

    return tell


def _place(of: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are in the sorted ``of``, and where (or any place)."""
    at = np.minimum(np.searchsorted(of, keys), max(len(of) - 1, 0))
    return (of[at] == keys if len(of) else np.zeros(len(keys), bool)), at


def _of_contexts(gram: np.ndarray, counts: list, shared: np.ndarray, totals: list, doubt: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted n-grams: the bytes before the last, evidence of any other last one, and of each."""
    context, of = np.unique(gram >> U64(8), return_inverse=True)
    sums = lambda x: np.bincount(of, weights=x, minlength=len(context))
    all_ = [sums(x) for x in counts]
    lower = shared[(gram & U64(0xFFFF)).astype(np.int64)]
    rest = [_rest(n, sums(np.maximum(x - DISCOUNT, 0))) for n, x in zip(all_, counts)]
    value = _log_ratio(*[_smoothed(x, n[of], r[of], lower) for x, n, r in zip(counts, all_, rest)])
    return context, _log_ratio(*rest) * _sureness(*all_, *totals, doubt), value * _sureness(*counts, *totals, doubt)


def _of_words(counts: list, totals: list, spent: list, doubt: float) -> np.ndarray:
    """Evidence of counted words as a whole."""
    both = sum(counts) / max(sum(totals), 1)
    n = [np.full(len(both), x) for x in totals]
    value = _log_ratio(*[_smoothed(x, m, _rest(m, np.full(len(both), s)), both) for x, m, s in zip(counts, n, spent)])
    return value * _sureness(*counts, *totals, doubt)


def _sureness(toxic: np.ndarray, plain: np.ndarray, all_toxic: float, all_plain: float, doubt: float) -> np.ndarray:
    """From 0 to 1 as the counts tell of other shares than those of all counts."""
    both, part = toxic + plain, all_toxic / max(all_toxic + all_plain, 1)
    told = np.zeros(len(both))
    for counts, share in ((toxic, part), (plain, 1 - part)):
        told += 2 * counts * np.log(np.maximum(counts, 1e-12) / np.maximum(both * share, 1e-12))
    told = np.maximum(told, 0)
    return told / (told + doubt)


def _rest(all_: np.ndarray, spent: np.ndarray) -> np.ndarray:
    """Share of a context that its counts leave to the shared ones."""
    return np.where(all_ > 0, 1 - spent / np.maximum(all_, 1), 1.0)


def _smoothed(counts: np.ndarray, all_: np.ndarray, rest: np.ndarray, shared: np.ndarray) -> np.ndarray:
    own = np.where(all_ > 0, np.maximum(counts - DISCOUNT, 0) / np.maximum(all_, 1), 0.0)
    return own + rest * shared


def _log_ratio(toxic: np.ndarray, plain: np.ndarray) -> np.ndarray:
    return np.log(np.maximum(toxic, 1e-12)) - np.log(np.maximum(plain, 1e-12))


def _shared(pairs) -> np.ndarray:
    """p(byte | byte before) by continuation counts, smoothed the same way once more."""
    kinds = np.zeros(65536)
    kinds[pairs.pair.to_numpy(np.int64)] = pairs.kinds
    kinds = kinds.reshape(256, 256)
    single = (kinds > 0).sum(axis=0) + 0.1
    single /= single.sum()
    total = np.maximum(kinds.sum(axis=1, keepdims=True), 1)
    left = DISCOUNT * (kinds > 0).sum(axis=1, keepdims=True) / total
    left[kinds.sum(axis=1) == 0] = 1
    return (np.maximum(kinds - DISCOUNT, 0) / total + left * single).ravel()


def _curve(toxic: np.ndarray, *values: np.ndarray) -> tuple[float, ...]:
    """Logistic regression on both norms of all ``VALUES``, by Newton steps with a small ridge."""
    *values, n_words = values
    n = np.maximum(n_words, 1)
    x = np.stack([np.ones(len(toxic)), *[value / norm for value in values for norm in (n, np.sqrt(n))]], axis=1)
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - toxic) + RIDGE * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w))
        w -= np.linalg.solve(hessian, gradient)
    return tuple(float(v) for v in w)


def score(model: Model) -> Column:
    """Score between 0 and 1 from the evidence and the number of words."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    base, *weights = model.curve
    total = F.lit(base)
    for name, mean, root in zip(VALUES, weights[::2], weights[1::2]):
        total = total + F.col(name) * (mean / n + root / F.sqrt(n))
    return 1 / (1 + F.exp(-total))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``id_col``, ``held_out``, ``score`` and ``predicted`` of every row.

    The score comes from the whole text alone. Held out are rows whose fold is
    0, from which nothing is learned; a null id is held out. A text without
    words, or a null one, gets the score of no evidence. Without labels of both
    classes every score is of no evidence. Rows of one id each get their row;
    an empty table gives an empty one; other columns are ignored.
    """
    model = fit(docs, labels, id_col, text_col, label_col)
    rows = with_evidence(docs, [F.col(id_col).alias("id")], text_col, model)
    rows = rows.select(F.col("carry.id").alias(id_col), (fold(F.col("carry.id")) == 0).alias("held_out"), score(model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below 0.5, with all their columns."""
    model = fit(docs, labels, id_col, text_col)
    # Beside the text, or a constant: a struct has one column at least.
    carry = [F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(docs.columns) if name != text_col]
    rows = with_evidence(docs, carry or [F.lit(0)], text_col, model).filter(score(model) < 0.5)
    return rows.select(
        *[F.col("text" if name == text_col else f"carry.c{i}").alias(name) for i, name in enumerate(docs.columns)]
    )
