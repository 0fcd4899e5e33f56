"""Substring dedup by level-wise doubling.

Windows of words that repeat in another document at one length are the only
ones extended to twice that length. The first level takes windows of about half
the least length, and of these only the local minima of their hashes: every
window of the least length holds one, at the same place in each of its copies.
Windows without a repeated minimum cannot repeat and are dropped there, which
is most of an ordinary corpus. The second level is the least length itself,
exact by a 64-bit hash and a smallest document for each window. Longer levels
go on from stored survivors until none is left.

A level is two shuffles: blocks of documents send their distinct window hashes
to shards of the key space, and get back which of them other blocks sent too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.llm import exchange, text as tx
from editpulse.llm.text import FULL, U64

_ANSWER = "block int, shard int, kind int, keys binary, flags binary"
_RESULT = (
    "block int, uid int, id long, n_words long, n_removed long, kept string, level_words int, "
    "positions binary, hashes binary"
)


def substring_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = 13,
    digest: bool = False,
    block_bytes: int = exchange.BLOCK_BYTES,
) -> DataFrame:
    """Remove every word that a repeated window of ``min_words`` words covers.

    A window is repeated where its words also start in a document of a smaller
    id; windows are judged on the input. Words are runs of other than space and
    the control bytes 9 to 13. Returns ``id_col``, ``n_words``, ``n_removed``,
    ``kept`` (words joined by one space, or with ``digest`` its SHA-256 in hex)
    and ``level_words``: the greatest of ``min_words``, twice that and so on at
    which a window of the document occurs in another document, 0 for none.

    A null text has no words. A null id counts as the largest. Rows of one id
    are one document for what is "another", and each gets its row. Texts
    shorter than a window are kept. Other columns are ignored, an empty table
    gives an empty one. Equal hashes of 64 bits count as equal windows.
    """
    spark = docs.sparkSession
    n = exchange.parts(docs, text_col, block_bytes)
    half = (min_words + 1) // 2
    rows = exchange.blocks(docs, id_col, text_col, n)
    seeds = rows.groupBy("block").applyInArrow(_send_halves(min_words, half, n), "shard int, block int, keys binary")
    halves = exchange.repeated_keys(seeds).select(
        "block", "shard", F.lit(0).alias("kind"), "keys", F.lit(None).cast("binary").alias("flags")
    )
    sent = rows.groupBy("block").cogroup(halves.groupBy("block")).applyInArrow(
        _send_windows(min_words, half, n), "shard int, block int, keys binary, ids binary"
    )
    flags = sent.groupBy("shard").applyInArrow(_first_owners, _ANSWER)
    answers = halves.unionByName(flags)
    base = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _remove(min_words, half, n, digest), _RESULT
    )
    base = exchange.stored(base, "substring-base")
    levels = _longer_levels(spark, base, min_words, n)
    result = base.drop("positions", "hashes")
    if levels is not None:
        best = levels.groupBy("block", "uid").agg(F.max("level").alias("longer"))
        result = result.join(best, ["block", "uid"], "left").withColumn(
            "level_words", F.greatest("level_words", F.coalesce("longer", F.lit(0)))
        )
    return result.select(F.col("id").alias(id_col), "n_words", "n_removed", "kept", "level_words")


def _longer_levels(spark, base: DataFrame, length: int, shards: int) -> DataFrame | None:
    """(block, uid, level) of every window that still repeats at a longer level."""
    level = base.filter(F.octet_length("positions") > 0).select("block", "uid", "id", "positions", "hashes")
    found = None
    while True:
        sent = level.groupBy("block").applyInArrow(_send_doubled(length, shards), "shard int, block int, keys binary")
        masks = sent.groupBy("shard").applyInArrow(_in_two_blocks, "block int, shard int, flags binary")
        level = level.groupBy("block").cogroup(masks.groupBy("block")).applyInArrow(
            _survivors(length, shards), "block int, uid int, id long, positions binary, hashes binary"
        )
        level = exchange.stored(level, "substring-level")
        length *= 2
        if level.isEmpty():
            return found
        reached = level.select("block", "uid", F.lit(length).alias("level"))
        found = reached if found is None else found.unionByName(reached)


def twice(keys: np.ndarray) -> np.ndarray:
    """Which keys this block holds more than once; shards only tell of other blocks."""
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return counts[inverse] > 1


class _Block:
    """Words of the documents of one block."""

    def __init__(self, table: pa.Table):
        self.ids = exchange.ids_of(table)
        self.data, self.starts = tx.texts(table["text"])
        self.words = tx.words(self.data, self.starts)

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the window from each word on, and whether it ends in its document."""
        hashes, doc = tx.windows(self.words.hash, length), self.words.doc
        return hashes, doc[: len(hashes)] == doc[length - 1 :][: len(hashes)]

    def seeds(self, min_words: int, half: int) -> tuple[np.ndarray, np.ndarray]:
        """Local minima of the half windows: first word and hash."""
        hashes, whole = self.windows(half)
        hashes = np.where(whole, np.minimum(tx.mix(hashes), FULL - U64(1)), FULL)
        at = tx.minima(hashes, min_words - half + 1)
        return at, tx.mix(hashes[at])  # least values lie close together, shards need even ones

    def candidates(self, min_words: int, half: int, answers: pa.Table, shards: int):
        """Windows of the least length around a repeated seed: first word and hash."""
        at, keys = self.seeds(min_words, half)
        at = at[exchange.known(keys, answers, shards) | twice(keys)]
        hashes, whole = self.windows(min_words)
        if not len(at) or not len(hashes):
            return np.zeros(0, np.int64), np.zeros(0, U64)
        first = np.maximum(at - (min_words - half), 0)
        near = tx.cover(first, at + 1, len(self.words.hash))[: len(hashes)]
        at = np.flatnonzero(near & whole)
        return at, tx.mix(hashes[at])

    def fingerprints(self) -> np.ndarray:
        """A hash of each document's whole word sequence."""
        n = len(self.ids)
        counts = self.words.counts(n)
        ends = np.cumsum(counts)
        place = np.arange(len(self.words.hash), dtype=np.int64) - np.repeat(ends - counts, counts)
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(tx.mix(self.words.hash ^ tx.mix(place.astype(U64))))])
        return tx.mix((sums[ends] - sums[ends - counts]) ^ (counts.astype(U64) << U64(40)) ^ U64(0x5851F42D4C957F2D))


def _send_halves(min_words: int, half: int, shards: int):
    def send(table: pa.Table) -> pa.Table:
        keys = _Block(table).seeds(min_words, half)[1]
        return exchange.ship_keys(table["block"][0].as_py(), keys, shards)

    return send


def _keys_and_ids(block: _Block, at: np.ndarray, hashes: np.ndarray):
    """Distinct keys of the block with the least id of each, in key order.

    The keys are the windows and, for documents that hold any, the fingerprint.
    """
    docs = np.unique(block.words.doc[at])
    keys = np.concatenate([hashes, block.fingerprints()[docs]])
    ids = np.concatenate([block.ids[block.words.doc[at]], block.ids[docs]])
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    last = np.flatnonzero(np.append(first[1:], True)) if len(keys) else np.zeros(0, np.int64)
    return keys[first], ids[first], ids[first] != ids[last]


def _send_windows(min_words: int, half: int, shards: int):
    def send(table: pa.Table, answers: pa.Table) -> pa.Table:
        number = _number(table, answers)
        out = {"shard": [], "block": [], "keys": [], "ids": []}
        if table.num_rows:
            block = _Block(table)
            keys, ids, _ = _keys_and_ids(block, *block.candidates(min_words, half, answers, shards))
            edges = exchange.shard_edges(keys, shards)
            for shard in np.flatnonzero(np.diff(edges)):
                share = slice(edges[shard], edges[shard + 1])
                out["shard"].append(int(shard))
                out["block"].append(number)
                out["keys"].append(keys[share].tobytes())
                out["ids"].append(exchange.narrow(ids[share]))
        return pa.table(
            [pa.array(out["shard"], pa.int32()), pa.array(out["block"], pa.int32()), pa.array(out["keys"], pa.binary()), pa.array(out["ids"], pa.binary())],
            names=list(out),
        )

    return send


def _number(*tables: pa.Table) -> int:
    return next(t["block"][0].as_py() for t in tables if t.num_rows)


def _gathered(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All keys of a shard and where each block's begin."""
    rows = [np.frombuffer(x, U64) for x in table["keys"].to_pylist()]
    return np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])


def _groups(keys: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the group of equal keys of each place in ``order``, and group sizes."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    group = np.cumsum(new) - 1
    return group, np.bincount(group)


def _first_owners(table: pa.Table) -> pa.Table:
    """For every key sent: is it in two documents or more, and in a smaller one."""
    keys, starts = _gathered(table)
    ids = np.concatenate([exchange.widen(x) for x in table["ids"].to_pylist()])
    order = np.lexsort((ids, keys))
    group, sizes = _groups(keys, order)
    least = ids[order][np.cumsum(sizes) - sizes]
    shared, smaller = np.empty(len(keys), bool), np.empty(len(keys), bool)
    shared[order] = sizes[group] > 1
    smaller[order] = ids[order] > least[group]
    parts = [(starts[i], starts[i + 1]) for i in range(len(starts) - 1)]
    return pa.table(
        {
            "block": table["block"].cast(pa.int32()),
            "shard": table["shard"].cast(pa.int32()),
            "kind": pa.array([1] * len(parts), pa.int32()),
            "keys": pa.array([np.packbits(shared[a:b]).tobytes() for a, b in parts], pa.binary()),
            "flags": pa.array([np.packbits(smaller[a:b]).tobytes() for a, b in parts], pa.binary()),
        }
    )


def _bits(answers: pa.Table, column: str, edges: np.ndarray) -> np.ndarray:
    """One flag for each key sent, put together from the shards' answers."""
    flags = np.zeros(edges[-1], bool)
    for shard, packed in zip(answers["shard"].to_pylist(), answers[column].to_pylist()):
        a, b = edges[shard], edges[shard + 1]
        flags[a:b] = np.unpackbits(np.frombuffer(packed, np.uint8), count=b - a).astype(bool)
    return flags


def _remove(min_words: int, half: int, shards: int, digest: bool):
    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        block = _Block(table)
        kinds = answers["kind"].combine_chunks().to_numpy(zero_copy_only=False)
        seeds, flags = answers.filter(pa.array(kinds == 0)), answers.filter(pa.array(kinds == 1))
        at, hashes = block.candidates(min_words, half, seeds, shards)
        n, doc = len(block.ids), block.words.doc
        keys, least, local = _keys_and_ids(block, at, hashes)
        edges = exchange.shard_edges(keys, shards)
        shared = _bits(flags, "keys", edges) | local
        smaller = _bits(flags, "flags", edges)
        place = np.searchsorted(keys, hashes)
        later = smaller[place] | (block.ids[doc[at]] > least[place])
        gone = tx.cover(at[later], at[later] + min_words, len(doc))
        counts = block.words.counts(n)

        copied, first = np.zeros(n, bool), np.ones(n, bool)
        holders = np.unique(doc[at])
        if len(holders):
            print_at = np.searchsorted(keys, block.fingerprints()[holders])
            copied[holders] = shared[print_at]
            first[holders] = ~(smaller[print_at] | (block.ids[holders] > least[print_at]))
        repeats = shared[place]
        level = np.zeros(n, np.int64)
        level[np.unique(doc[at[repeats]])] = min_words
        whole = copied & (counts >= min_words)
        level[whole] = min_words << np.floor(np.log2(counts[whole] / min_words)).astype(np.int64)

        # Copies of a document go no further: the first of them stands for all.
        stay = repeats & first[doc[at]]
        doc_first = np.cumsum(counts) - counts
        positions, hashes, of = (at - doc_first[doc[at]])[stay], hashes[stay], doc[at[stay]]
        cut = np.searchsorted(of, np.arange(n + 1))
        pieces = range(n)
        return pa.table(
            {
                "block": table["block"].cast(pa.int32()),
                "uid": pa.array(np.arange(n, dtype=np.int32)),
                "id": table["id"],
                "n_words": pa.array(counts.astype(np.int64)),
                "n_removed": pa.array(np.bincount(doc[gone], minlength=n).astype(np.int64)),
                "kept": pa.array(_kept(block, gone, digest), pa.string()),
                "level_words": pa.array(level.astype(np.int32)),
                "positions": pa.array([positions[cut[i] : cut[i + 1]].astype(np.uint32).tobytes() for i in pieces], pa.binary()),
                "hashes": pa.array([hashes[cut[i] : cut[i + 1]].tobytes() for i in pieces], pa.binary()),
            }
        )

    return remove


def _kept(block: _Block, gone: np.ndarray, digest: bool) -> list[str]:
    """What is left of every document, its words joined by one space."""
    kept = np.flatnonzero(~gone)
    first, last, doc = block.words.start[kept], block.words.end[kept].copy(), block.words.doc[kept]
    more = np.zeros(len(kept), bool)
    more[:-1] = doc[1:] == doc[:-1]
    data = block.data.copy()
    data[last[more]] = 32
    last[more] += 1
    left = data[tx.cover(first, last, len(data))].tobytes()
    ends = np.cumsum(np.bincount(doc, weights=last - first, minlength=len(block.ids))).astype(np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    read = tx.sha256 if digest else (lambda piece: piece.decode("utf-8", "replace"))
    return [read(left[a:b]) for a, b in zip(starts, ends)]


def _doubled(table: pa.Table, length: int):
    """Windows of twice the length whose two halves survive: place, hash, row, id."""
    found = []
    for row, (packed, hashes) in enumerate(zip(table["positions"].to_pylist(), table["hashes"].to_pylist())):
        at, half = np.frombuffer(packed, np.uint32).astype(np.int64), np.frombuffer(hashes, U64)
        second = np.searchsorted(at, at + length)
        fits = second < len(at)
        fits[fits] = at[second[fits]] == at[fits] + length
        both = tx.mix(half[fits] * U64(0x9E3779B97F4A7C15) + half[second[fits]])
        found.append((at[fits], both, np.full(len(both), row)))
    at, keys, rows = (np.concatenate(x) for x in zip(*found))
    return at, keys, rows, exchange.ids_of(table)


def _send_doubled(length: int, shards: int):
    def send(table: pa.Table) -> pa.Table:
        keys = np.unique(_doubled(table, length)[1])
        edges = exchange.shard_edges(keys, shards)
        used = np.flatnonzero(np.diff(edges))
        return pa.table(
            {
                "shard": pa.array(used.astype(np.int32)),
                "block": pa.array(np.full(len(used), table["block"][0].as_py(), np.int32)),
                "keys": pa.array([keys[edges[s] : edges[s + 1]].tobytes() for s in used], pa.binary()),
            }
        )

    return send


def _in_two_blocks(table: pa.Table) -> pa.Table:
    keys, starts = _gathered(table)
    order = np.argsort(keys, kind="stable")
    group, sizes = _groups(keys, order)
    shared = np.empty(len(keys), bool)
    shared[order] = sizes[group] > 1
    flags = [np.packbits(shared[starts[i] : starts[i + 1]]).tobytes() for i in range(len(starts) - 1)]
    return pa.table(
        {
            "block": table["block"].cast(pa.int32()),
            "shard": table["shard"].cast(pa.int32()),
            "flags": pa.array(flags, pa.binary()),
        }
    )


def _survivors(length: int, shards: int):
    def keep(table: pa.Table, masks: pa.Table) -> pa.Table:
        at, hashes, rows, ids = _doubled(table, length)
        keys, inverse = np.unique(hashes, return_inverse=True)
        shared = _bits(masks, "flags", exchange.shard_edges(keys, shards))
        # Two documents of this block may share what no other block has.
        least, most = np.full(len(keys), exchange.LAST_ID), np.full(len(keys), -exchange.LAST_ID - 1)
        np.minimum.at(least, inverse, ids[rows])
        np.maximum.at(most, inverse, ids[rows])
        stay = (shared | (least != most))[inverse]
        at, hashes, rows = at[stay], hashes[stay], rows[stay]
        used = np.unique(rows)
        cut = np.searchsorted(rows, np.append(used, table.num_rows))
        left = table.take(pa.array(used)).select(["block", "uid", "id"])
        for name, values in (("positions", at.astype(np.uint32)), ("hashes", hashes)):
            pieces = [values[cut[i] : cut[i + 1]].tobytes() for i in range(len(used))]
            left = left.append_column(name, pa.array(pieces, pa.binary()))
        return left

    return keep
