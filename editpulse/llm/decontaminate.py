"""Benchmark decontamination by a suffix automaton of the test items.

The words of all items make one generalised suffix automaton: its states are
the distinct word sequences of the items, grouped by where they end. Training
text streams through it word by word and the automaton keeps the length of the
longest match that ends at each word. A word outside the items' vocabulary sets
the match to nothing, so only runs of known words need a step in Python.

Items are cut into groups of at most ``group_words`` words. A group's automaton
is small enough to be sent to all tasks; a test set of many groups takes one
pass over the text per group, and each pass goes through every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.llm import exchange, text as tx

GROUP_WORDS = 1 << 17


class Automaton:
    """Generalised suffix automaton over word numbers, with the items of each window."""

    def __init__(self, items: list[tuple[int, list[int]]], window: int):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[tuple[int, int, int]] = []  # state, item, words of the item up to there
        for item, words in items:
            last = 0
            for i, word in enumerate(words, 1):
                last = self._extend(last, word)
                if i >= window or i == len(words):
                    ends.append((last, item, min(i, window)))
        self._mark(ends)

    def _extend(self, last: int, word: int) -> int:
        following = self.next[last].get(word)
        if following is not None:
            if self.length[following] == self.length[last] + 1:
                return following
            return self._clone(last, word, following)
        state = self._state(self.length[last] + 1, {})
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at < 0:
            self.link[state] = 0
        else:
            following = self.next[at][word]
            if self.length[following] == self.length[at] + 1:
                self.link[state] = following
            else:
                self.link[state] = self._clone(at, word, following)
        return state

    def _state(self, length: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, at: int, word: int, following: int) -> int:
        """A state for the shorter sequences of ``following`` that end here too."""
        copy = self._state(self.length[at] + 1, dict(self.next[following]))
        self.link[copy] = self.link[following]
        self.link[following] = copy
        while at >= 0 and self.next[at].get(word) == following:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _mark(self, ends) -> None:
        """Hang every window on the state that its word sequence belongs to."""
        own: dict[int, dict[int, set[int]]] = {}
        for state, item, words in ends:
            while self.length[self.link[state]] >= words:
                state = self.link[state]
            own.setdefault(state, {}).setdefault(words, set()).add(item)
        self.windows: list[tuple[tuple[int, tuple[int, ...]], ...]] = [()] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            mine = tuple((n, tuple(sorted(x))) for n, x in sorted(own.get(state, {}).items()))
            self.windows[state] = self.windows[self.link[state]] + mine

    def matches(self, words: list[int]) -> Iterator[tuple[int, int, int]]:
        """After each word: its place, the state and the length of the longest match."""
        nexts, link, length = self.next, self.link, self.length
        state = matched = 0
        for place, word in enumerate(words):
            following = nexts[state].get(word)
            while following is None and state:
                state = link[state]
                matched = length[state]
                following = nexts[state].get(word)
            if following is not None:
                state = following
                matched += 1
            yield place, state, matched


@dataclass
class Group:
    """Automaton of some items, their vocabulary by word hash, and the shortest window.

    A word takes under a kilobyte, so ``GROUP_WORDS`` keep a group near 100 MB.
    """

    vocabulary: np.ndarray
    automaton: Automaton
    shortest: int


def item_words(texts: pa.Array) -> list[np.ndarray]:
    data, starts = tx.texts(texts)
    found = tx.words(data, starts, tx.ALNUM, tx.LOWER)
    cut = np.searchsorted(found.doc, np.arange(len(starts)))
    return [found.hash[a:b] for a, b in zip(cut[:-1], cut[1:])]


def _group(items, window: int) -> Group:
    vocabulary = np.unique(np.concatenate([words for _, words in items]))
    numbered = [(item, np.searchsorted(vocabulary, words).tolist()) for item, words in items]
    shortest = min(window, min(len(words) for _, words in items))
    return Group(vocabulary, Automaton(numbered, window), shortest)


def _hits(group: Group, hashes: np.ndarray, doc: np.ndarray, hit: np.ndarray, items: list[set]) -> None:
    """Mark the words that lie in a window, and collect the items, text by text."""
    place = np.minimum(np.searchsorted(group.vocabulary, hashes), len(group.vocabulary) - 1)
    known = group.vocabulary[place] == hashes
    opens, closes = known.copy(), known.copy()
    edge = doc[1:] != doc[:-1]
    opens[1:] &= ~known[:-1] | edge
    closes[:-1] &= ~known[1:] | edge
    first, last = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    long = last - first >= group.shortest
    windows, shortest = group.automaton.windows, group.shortest
    for a, b in zip(first[long].tolist(), last[long].tolist()):
        for at, state, matched in group.automaton.matches(place[a:b].tolist()):
            if matched >= shortest and windows[state]:
                for words, owners in windows[state]:
                    if words > matched:
                        break
                    hit[a + at + 1 - words : a + at + 1] = True
                    items[doc[a]].update(owners)


def _groups(benchmark: DataFrame, item_col: str, text_col: str, window: int, group_words: int) -> Iterator[Group]:
    """Groups of items, read one after the other; the test set is never held whole."""
    pending, size = [], 0
    rows = benchmark.select(F.col(item_col).cast("string"), text_col).toLocalIterator()
    for item, text in rows:
        if item is None or not text:
            continue
        words = item_words(pa.array([text], pa.string()))[0]
        if not len(words):
            continue
        if pending and size + len(words) > group_words:
            yield _group(pending, window)
            pending, size = [], 0
        pending.append((item, words))
        size += len(words)
    if pending:
        yield _group(pending, window)


def _scan(handle, text: str):
    """Words and hits of every text against one group, over those found before.

    ``text`` says what becomes of the text: "drop", "keep", or "cut" its spans out.
    """

    def scan(batches):
        group = handle.value
        for batch in batches:
            data, starts = tx.texts(batch.column("text"))
            for a, b in tx.runs_of(starts):
                part, edges = batch.slice(a, b - a), starts[a : b + 1] - starts[a]
                found = tx.words(data[starts[a] : starts[b]], edges, tx.ALNUM, tx.LOWER)
                hit = np.zeros(len(found.hash), bool)
                items = [set(x) for x in part.column("items").to_pylist()]
                for doc, spans in enumerate(part.column("spans").to_pylist()):
                    for first, words in zip(spans[::3], spans[2::3]):
                        at = np.searchsorted(found.start, edges[doc] + first)
                        hit[at : at + words] = True
                if group is not None:
                    _hits(group, found.hash, found.doc, hit, items)
                spans = _spans(hit, found, edges)
                out = {
                    "carry": part.column("carry"),
                    "n_words": pa.array(np.bincount(found.doc, minlength=b - a), pa.int64()),
                    "n_hit": pa.array(np.bincount(found.doc[hit], minlength=b - a), pa.int64()),
                    "items": pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    "spans": pa.array(spans, pa.list_(pa.int64())),
                }
                if text == "keep":
                    out["text"] = part.column("text")
                elif text == "cut":
                    out["text"] = _without(part.column("text"), spans)
                yield pa.RecordBatch.from_pydict(out)

    return scan


def _without(column: pa.Array, spans: list[list[int]]) -> pa.Array:
    """The texts without their spans; those that have none as they are."""
    if not any(spans):
        return column
    left = column.to_pylist()
    for row, found in enumerate(spans):
        if found:
            data, at, pieces = left[row].encode(), 0, []
            for first, end in zip(found[::3], found[1::3]):
                pieces.append(data[at:first])
                at = end
            left[row] = b"".join([*pieces, data[at:]]).decode("utf-8", "replace")
    return pa.array(left, column.type)


def _spans(hit: np.ndarray, found: tx.Words, starts: np.ndarray) -> list[list[int]]:
    """First and last byte of every run of hit words, and its words, flat, by text."""
    out: list[list[int]] = [[] for _ in range(len(starts) - 1)]
    at = np.flatnonzero(hit)
    if len(at):
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (found.doc[at[1:]] != found.doc[at[:-1]])
        first = at[new]
        last = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)]
        for f, l, d in zip(first, last, found.doc[first]):
            out[d] += [int(found.start[f] - starts[d]), int(found.end[l] - starts[d]), int(l - f + 1)]
    return out


def _checked(docs, carry, text_col, benchmark, item_col, window, group_words, text="drop") -> DataFrame:
    """Counts, items and spans of every row of ``docs``, with ``carry`` beside them.

    One pass for each group of items, without a shuffle; rows are stored between
    passes, so that a task holds one automaton at a time.
    """
    rows = docs.select(
        F.struct(*carry).alias("carry"),
        F.col(text_col).alias("text"),
        F.array().cast("array<string>").alias("items"),
        F.array().cast("array<bigint>").alias("spans"),
    )
    kind = rows.schema["carry"].dataType.simpleString()
    found = f"carry {kind}, n_words long, n_hit long, items array<string>, spans array<bigint>"
    tables = _groups(benchmark, item_col, "text", window, group_words)
    group = next(tables, None)
    while True:
        following = next(tables, None)
        use = text if following is None else "keep"
        handle = docs.sparkSession.sparkContext.broadcast(group)
        rows = rows.mapInArrow(_scan(handle, use), found + ", text string" * (use != "drop"))
        if following is None:
            return rows
        rows, group = exchange.stored(rows, "decontaminate"), following


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    window: int = 10,
    group_words: int = GROUP_WORDS,
) -> DataFrame:
    """Words of every text that lie in a window of any item, and the items found.

    Words are runs of ASCII letters (lower-cased), digits and non-ASCII
    characters. A window is ``window`` consecutive words of an item; an item of
    fewer words, but not none, is one window. The items' text is in ``text``.
    Returns ``id_col``, ``n_words``, ``n_hit``, ``items`` (sorted ids, as
    strings) and ``spans``, flat triples of first byte, end byte and words of
    each run of hit words.

    A null text has no words; items without id or words match nothing; an item
    id may repeat. Every row gets its row, rows of one id too; an empty table
    gives an empty one, an empty test set no hits.
    """
    carry = [F.col(id_col).alias("id")]
    rows = _checked(docs, carry, text_col, benchmark, item_col, window, group_words)
    return rows.select(F.col("carry.id").alias(id_col), "n_words", "n_hit", "items", "spans")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    window: int = 10,
    most_covered: float = 0.8,
    group_words: int = GROUP_WORDS,
) -> DataFrame:
    """Cut the contaminated spans out of ``docs``, and drop what is mostly such.

    A text loses the words found by ``contamination``, from the first byte of a
    run to its last; where more than ``most_covered`` of its words are such, its
    row goes. Returns the columns of ``docs``, whatever their names. Texts
    without a hit stay as they are, null texts too, and each row of one id is
    judged by itself.
    """
    carry = [F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(docs.columns) if name != text_col]
    carry = carry or [F.lit(None).cast("string").alias("none")]
    rows = _checked(docs, carry, text_col, benchmark, item_col, window, group_words, "cut")
    kept = rows.filter((F.col("n_hit") == 0) | (F.col("n_hit") <= most_covered * F.col("n_words")))
    return kept.select(
        *[
            (F.col("text") if name == text_col else F.col(f"carry.c{i}")).alias(name)
            for i, name in enumerate(docs.columns)
        ]
    )
