"""Dedup of long byte strings by suffix arrays in a logarithmic index family.

Only suffixes that can repeat are sorted. Of every ``min_bytes`` bytes the least
(by hash) inner piece of about half that length marks the place; pieces that
occur once are dropped by a first exchange, with all suffixes they mark. What is
left goes to shards by the piece, so that equal strings meet. A shard takes its
suffixes in batches of growing document ids: each batch is sorted into a suffix
array (by the first ``min_bytes`` bytes, as they are, not by a hash), merged
against the arrays of the levels held so far, and matches there are later
copies. Its new suffixes become a level, and levels of equal rank merge into
one of the next, so a suffix is merged as often as the logarithm of the batches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.llm import exchange, text as tx
from editpulse.llm.substrings import twice
from editpulse.llm.text import FULL, U64

BATCHES = 8
PIECE_BYTES = 1 << 16
BLOCK_BYTES = 4 << 20
SHARDS_PER_BLOCK = 2

# A block reports a piece of more surroundings than the first; reports that add up
# to more than the second make it hot. A shard so gets at most the second, and the
# first from each block, of a piece that is not.
BLOCK_RUNS = 8
HOT_RUNS = 16384


def suffix_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_bytes: int = 50,
    batches: int = BATCHES,
    digest: bool = False,
    block_bytes: int = BLOCK_BYTES,
    hot_runs: int = HOT_RUNS,
) -> DataFrame:
    """Remove every byte of a ``min_bytes`` string that a smaller id has too.

    Texts count as UTF-8 bytes and strings never cross documents; overlaps
    count, and strings are judged on the input. Returns ``id_col``, ``n_bytes``,
    ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept``, the remaining
    bytes, or with ``digest`` their SHA-256 (32 bytes).

    A null text is empty. A null id counts as the largest. Rows of one id do
    not remove from each other. Texts shorter than a string are kept. Other
    columns are ignored, an empty table gives an empty one. ``hot_runs`` changes
    where strings meet, never the result.
    """
    n = exchange.parts(docs, text_col, block_bytes)
    cut = _Cut(min_bytes)
    rows = exchange.blocks(docs, id_col, text_col, n)
    n *= SHARDS_PER_BLOCK
    answers = _answers(rows, cut, n, hot_runs)
    sent = _sent(rows, answers, cut, n)
    flags = sent.groupBy("shard").applyInArrow(_later_copies(cut, batches), "block int, shard int, kind int, keys binary")
    answers = answers.unionByName(flags)
    result = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _remove(cut, n, digest), "id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
    return result.withColumnRenamed("id", id_col)


def _answers(rows: DataFrame, cut: _Cut, shards: int, hot_runs: int) -> DataFrame:
    """Which pieces of each block occur again, and which of them are hot."""
    pieces = rows.groupBy("block").applyInArrow(_send_pieces(cut, shards), "shard int, block int, kind int, keys binary")
    return pieces.groupBy("shard").applyInArrow(_judge_pieces(hot_runs), "shard int, block int, kind int, keys binary")


def _sent(rows: DataFrame, answers: DataFrame, cut: _Cut, shards: int) -> DataFrame:
    """The strings that each block sends each shard."""
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _send_strings(cut, shards), "shard int, block int, ids binary, extra binary, bytes binary"
    )


# What a row of keys says.
_REPEATED, _LATER, _HOT = 0, 1, 2


@dataclass(frozen=True)
class _Cut:
    """Lengths: the whole string, the piece that marks it, and pieces in a string."""

    string: int

    @property
    def piece(self) -> int:
        return max(1, (self.string + 1) // 2 - 1)

    @property
    def places(self) -> int:
        return self.string - self.piece + 1


class _Block:
    """Marked places of the documents of one block."""

    def __init__(self, table: pa.Table, cut: _Cut):
        self.ids = exchange.ids_of(table)
        self.data, self.starts = tx.texts(table["text"])
        self.cut = cut

    def marks(self) -> tuple[np.ndarray, np.ndarray]:
        """Places whose piece is the least of some string, and the hashes of these pieces."""
        data, cut, total = self.data, self.cut, len(self.data)
        ends = self.starts[1:]
        margin = cut.places - 1
        found = []
        for begin in range(0, total, PIECE_BYTES):
            stop = min(begin + PIECE_BYTES, total)
            a, b = max(begin - margin, 0), min(stop + margin + cut.piece - 1, total)
            hashes = tx.mix(tx.windows(tx.BYTE_VALUES[data[a:b]], cut.piece))
            np.minimum(hashes, FULL - U64(1), out=hashes)
            lo, hi = np.searchsorted(ends, [a, b + cut.piece])
            broken = (ends[lo:hi, None] - np.arange(1, cut.piece)).ravel() - a
            hashes[broken[(broken >= 0) & (broken < len(hashes))]] = FULL
            at = tx.minima(hashes, cut.places) if len(hashes) >= cut.places else np.flatnonzero(hashes != FULL)
            at = at[(at + a >= begin) & (at + a < stop)]
            found.append((at + a, hashes[at]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, U64)
        return tuple(np.concatenate(x) for x in zip(*found))

    def crowded(self, at: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of more than ``BLOCK_RUNS`` different surroundings here, and how many they have."""
        kinds, of, marks = np.unique(keys, return_inverse=True, return_counts=True)
        some = np.flatnonzero(marks[of] > BLOCK_RUNS)
        at, of = at[some], of[some]
        doc = np.searchsorted(self.starts, at, "right") - 1
        low = np.maximum(at - self.cut.places + 1, self.starts[doc])
        high = np.minimum(at + self.cut.string, self.starts[doc + 1])
        around = self.prints(low, high - low, self.cut.string + self.cut.places - 1) ^ (at - low).astype(U64)
        pairs = np.unique(np.stack([of.astype(U64), around]), axis=1)
        runs = np.bincount(pairs[0].astype(np.int64), minlength=len(kinds))
        many = np.flatnonzero(runs > BLOCK_RUNS)
        return kinds[many], runs[many]

    def prints(self, low: np.ndarray, length: np.ndarray, longest: int) -> np.ndarray:
        """A hash of the bytes of each run."""
        up = tx.mix(np.arange(1, longest + 1, dtype=U64)) | U64(1)
        out = np.empty(len(low), U64)
        for a in range(0, len(out), 16384):
            some = length[a : a + 16384]
            place = np.minimum(low[a : a + 16384, None] + np.arange(longest), len(self.data) - 1)
            values = tx.BYTE_VALUES[self.data[place]] * up
            values[np.arange(longest) >= some[:, None]] = 0
            out[a : a + 16384] = tx.mix(values.sum(axis=1, dtype=U64) ^ some.astype(U64))
        return out

    def strings(self, answers: pa.Table, shards: int) -> "_Strings":
        """Strings whose mark is repeated, as runs of neighbouring first bytes."""
        at, keys = self.marks()
        doc = np.searchsorted(self.starts, at, "right") - 1
        # A string belongs to the first of its least pieces: ``low`` to ``high``
        # are the first bytes of the strings that belong to each mark.
        low = np.maximum(at - self.cut.places + 1, self.starts[doc])
        high = np.minimum(at, self.starts[doc + 1] - self.cut.string)
        for step in range(1, len(at)):
            gap = at[step:] - at[:-step]
            near = gap < self.cut.places
            if not near.any():
                break
            before = np.flatnonzero(near & (keys[:-step] <= keys[step:]))
            low[before + step] = np.maximum(low[before + step], at[before] + 1)
            after = np.flatnonzero(near & (keys[step:] < keys[:-step]))
            high[after] = np.minimum(high[after], at[after + step] - self.cut.places)
        keys = tx.mix(keys)  # least values lie close together, shards need even ones
        use = (low <= high) & (exchange.known(keys, _of_kind(answers, _REPEATED), shards) | twice(keys))
        hot = exchange.known(keys[use], _of_kind(answers, _HOT), shards)
        return _Strings(self, low[use], high[use], doc[use], keys[use], hot, shards)


class _Strings:
    """Runs of strings of a block, and its distinct runs with their least id.

    Around hot pieces each string is a run of its own.
    """

    def __init__(self, block: _Block, low, high, doc, keys, hot, shards):
        counts = high[hot] - low[hot] + 1
        single = _spread_out(low[hot], counts)
        self.low = np.concatenate([low[~hot], single])
        self.high = np.concatenate([high[~hot], single])
        self.doc = np.concatenate([doc[~hot], np.repeat(doc[hot], counts)])
        width = block.cut.string
        print_ = block.prints(self.low, self.high - self.low + width, width + block.cut.places - 1)
        keys = np.concatenate([keys[~hot], print_[len(print_) - len(single) :]])
        shard = (((keys >> U64(32)) * U64(shards)) >> U64(32)).astype(np.int64)
        ids = block.ids[self.doc]
        order = np.lexsort((ids, print_, shard))
        new = np.ones(len(order), bool)
        new[1:] = (print_[order][1:] != print_[order][:-1]) | (shard[order][1:] != shard[order][:-1])
        self.of = np.empty(len(order), np.int64)  # the distinct run of each run
        self.of[order] = np.cumsum(new) - 1
        self.first = order[new]  # one run for each distinct one, of the least id
        self.least = ids[self.first]
        self.edges = np.searchsorted(shard[self.first], np.arange(shards + 1))
        self.counts = (self.high - self.low + 1)[self.first]


def _of_kind(answers: pa.Table, kind: int) -> pa.Table:
    return answers.filter(pa.array(answers["kind"].combine_chunks().to_numpy(zero_copy_only=False) == kind))


def _spread_out(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...`` for ``counts[i]`` places each."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def _send_pieces(cut: _Cut, shards: int):
    def send(table: pa.Table) -> pa.Table:
        number, block = table["block"][0].as_py(), _Block(table, cut)
        at, keys = block.marks()
        sent = exchange.ship_keys(number, tx.mix(keys), shards)
        kinds, runs = block.crowded(at, keys)
        kinds = tx.mix(kinds)
        order = np.argsort(kinds)
        kinds, runs = kinds[order], runs[order]
        edges = exchange.shard_edges(kinds, shards)
        used = np.flatnonzero(np.diff(edges))
        low = (kinds & U64(0xFFFFFFFF)).astype(np.uint32)
        pairs = np.stack([low, np.minimum(runs, 1 << 30).astype(np.uint32)], axis=1)
        shard = sent["shard"].to_pylist() + used.tolist()
        rows = sent["keys"].to_pylist() + [pairs[edges[s] : edges[s + 1]].tobytes() for s in used]
        kind = [_REPEATED] * sent.num_rows + [_HOT] * len(used)
        return pa.table(
            {
                "shard": pa.array(shard, pa.int32()),
                "block": pa.array([number] * len(shard), pa.int32()),
                "kind": pa.array(kind, pa.int32()),
                "keys": pa.array(rows, pa.binary()),
            }
        )

    return send


def _judge_pieces(hot_runs: int):
    def judge(table: pa.Table) -> pa.Table:
        shard, sent = table["shard"][0].as_py(), _of_kind(table, _REPEATED)
        blocks, rows = sent["block"].to_pylist(), [np.frombuffer(x, np.uint32) for x in sent["keys"].to_pylist()]
        keys = np.concatenate(rows)
        keys.sort()
        repeated = np.unique(keys[1:][keys[1:] == keys[:-1]])
        reports = b"".join(_of_kind(table, _HOT)["keys"].to_pylist())
        crowded, runs = np.frombuffer(reports, np.uint32).reshape(-1, 2).T
        kinds, of = np.unique(crowded, return_inverse=True)
        hot = kinds[np.bincount(of, weights=runs, minlength=len(kinds)) > hot_runs]
        out = []
        for kind, some in ((_REPEATED, repeated), (_HOT, hot)):
            kept = [row[np.isin(row, some, assume_unique=True)] for row in rows]
            out += [(block, kind, row) for block, row in zip(blocks, kept) if len(row)]
        return pa.table(
            {
                "shard": pa.array([shard] * len(out), pa.int32()),
                "block": pa.array([block for block, _, _ in out], pa.int32()),
                "kind": pa.array([kind for _, kind, _ in out], pa.int32()),
                "keys": pa.array([row.tobytes() for _, _, row in out], pa.binary()),
            }
        )

    return judge


def _send_strings(cut: _Cut, shards: int):
    def send(table: pa.Table, answers: pa.Table) -> pa.Table:
        out = {"shard": [], "ids": [], "extra": [], "bytes": []}
        number = next(t["block"][0].as_py() for t in (table, answers) if t.num_rows)
        if table.num_rows:
            block = _Block(table, cut)
            strings = block.strings(answers, shards)
            for shard in np.flatnonzero(np.diff(strings.edges)):
                share = slice(strings.edges[shard], strings.edges[shard + 1])
                counts = strings.counts[share]
                low = strings.low[strings.first[share]]
                out["shard"].append(int(shard))
                out["ids"].append(exchange.narrow(strings.least[share]))
                out["extra"].append((counts - 1).astype(np.uint16).tobytes())
                out["bytes"].append(block.data[_spread_out(low, counts - 1 + cut.string)].tobytes())
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        columns = {name: pa.array(values, kind) for (name, values), kind in zip(out.items(), kinds)}
        columns["block"] = pa.array([number] * len(out["shard"]), pa.int32())
        return pa.table(columns).select(["shard", "block", "ids", "extra", "bytes"])

    return send


class SuffixFamily:
    """Suffix arrays whose ranks differ; a new one merges with those of equal rank."""

    def __init__(self):
        self.levels: list[tuple[int, np.ndarray]] = []

    def holds(self, suffixes: np.ndarray) -> np.ndarray:
        """Which of these sorted suffixes any level has."""
        found = np.zeros(len(suffixes), bool)
        for _, level in self.levels:
            place = np.minimum(np.searchsorted(level, suffixes), len(level) - 1)
            found |= level[place] == suffixes
        return found

    def add(self, suffixes: np.ndarray) -> None:
        """Take sorted suffixes that no level has."""
        if not len(suffixes):
            return
        rank = 0
        while self.levels and self.levels[-1][0] == rank:
            suffixes = np.sort(np.concatenate([self.levels.pop()[1], suffixes]), kind="stable")
            rank += 1
        self.levels.append((rank, suffixes))


def _batch_edges(ids: np.ndarray, counts: np.ndarray, batches: int) -> np.ndarray:
    """Cuts of rows sorted by id into batches of about equal work; an id stays whole."""
    total = np.cumsum(counts)
    wanted = np.searchsorted(total, total[-1] * np.arange(1, batches) / batches)
    return np.unique(np.concatenate([[0], np.searchsorted(ids, ids[wanted], "left"), [len(ids)]]))


def _later_copies(cut: _Cut, batches: int):
    def match(table: pa.Table) -> pa.Table:
        ids = np.concatenate([exchange.widen(x) for x in table["ids"].to_pylist()])
        extra = [np.frombuffer(x, np.uint16) for x in table["extra"].to_pylist()]
        sizes = [len(x) for x in extra]
        counts = np.concatenate(extra).astype(np.int64) + 1
        data = np.frombuffer(b"".join(table["bytes"].to_pylist()), np.uint8)
        starts = np.cumsum(counts + cut.string - 1) - (counts + cut.string - 1)
        view = np.lib.stride_tricks.sliding_window_view(data, cut.string)
        offsets = np.cumsum(counts) - counts
        later = np.zeros(counts.sum(), bool)
        family = SuffixFamily()
        order = np.argsort(ids, kind="stable")
        edges = _batch_edges(ids[order], counts[order], batches)
        for a, b in zip(edges[:-1], edges[1:]):
            rows = order[a:b]
            suffixes = view[_spread_out(starts[rows], counts[rows])].view(f"S{cut.string}").ravel()
            owner = np.repeat(ids[rows], counts[rows])
            array = np.argsort(suffixes, kind="stable")  # rows are by id: the least comes first
            suffixes, owner = suffixes[array], owner[array]
            new = np.ones(len(array), bool)
            new[1:] = suffixes[1:] != suffixes[:-1]
            group = np.cumsum(new) - 1
            distinct = suffixes[new]
            old = family.holds(distinct)
            family.add(distinct[~old])
            copies = np.empty(len(array), bool)
            copies[array] = old[group] | (owner > owner[new][group])
            later[_spread_out(offsets[rows], counts[rows])] = copies
        ends = np.cumsum(sizes)
        bounds = np.append(offsets, len(later))
        flags = [np.packbits(later[bounds[e - s] : bounds[e]]).tobytes() for s, e in zip(sizes, ends)]
        return pa.table(
            {
                "block": table["block"].cast(pa.int32()),
                "shard": table["shard"].cast(pa.int32()),
                "kind": pa.array([_LATER] * len(flags), pa.int32()),
                "keys": pa.array(flags, pa.binary()),
            }
        )

    return match


def _removed(block: _Block, answers: pa.Table, shards: int) -> np.ndarray:
    """Which bytes of the block go."""
    strings = block.strings(answers, shards)
    bounds = np.concatenate([[0], np.cumsum(strings.counts)])
    later = np.zeros(bounds[-1], bool)
    flags = _of_kind(answers, _LATER)
    for shard, packed in zip(flags["shard"].to_pylist(), flags["keys"].to_pylist()):
        a, b = bounds[strings.edges[shard]], bounds[strings.edges[shard + 1]]
        later[a:b] = np.unpackbits(np.frombuffer(packed, np.uint8), count=b - a).astype(bool)
    counts = strings.high - strings.low + 1
    whole = block.ids[strings.doc] > strings.least[strings.of]
    part = np.flatnonzero(~whole)
    first = _spread_out(strings.low[part], counts[part])
    first = first[later[_spread_out(bounds[strings.of[part]], counts[part])]]
    starts = np.concatenate([strings.low[whole], first])
    ends = np.concatenate([strings.high[whole] + block.cut.string, first + block.cut.string])
    return tx.cover(starts, ends, len(block.data))


def _remove(cut: _Cut, shards: int, digest: bool):
    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        block = _Block(table, cut)
        gone = _removed(block, answers, shards)
        opens = gone.copy()
        opens[1:] &= ~gone[:-1]
        inner = block.starts[:-1][block.starts[:-1] < len(gone)]
        opens[inner] = gone[inner]
        size = np.diff(block.starts)
        removed, spans = (
            np.diff(np.concatenate([[0], np.cumsum(x)])[block.starts]) for x in (gone, opens)
        )
        left = block.data[~gone].tobytes()
        ends = np.cumsum(size - removed)
        kept = [left[e - n : e] for e, n in zip(ends, size - removed)]
        if digest:
            kept = [bytes.fromhex(tx.sha256(x)) for x in kept]
        return pa.table(
            {
                "id": table["id"],
                "n_bytes": pa.array(size.astype(np.int64)),
                "n_removed": pa.array(removed.astype(np.int64)),
                "n_spans": pa.array(spans.astype(np.int64)),
                "kept": pa.array(kept, pa.binary()),
            }
        )

    return remove
