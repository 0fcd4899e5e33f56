"""Spelling variants by permuterm rotations.

The words of the texts are counted, with numpy in tasks and then by Spark. Each
word gets a terminator and is rotated to every place. A rotation of ``w$`` that
ends in a letter stands for the edit of that letter: what comes before it is a
prefix, and the rotations with this prefix and one letter more are of the words
that have another letter there, while a rotation that equals the prefix is of the
word without the letter. So the sorted rotations are scanned in groups of equal
prefix. A group holds one word for each letter of the alphabet at most and one
without, whatever the texts hold. A group gives each of its words the
number of its neighbours there and the most frequent one; pairs are not made.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.llm import exchange
from editpulse.llm.text import LOWER, runs_of, texts

LEAST_LETTERS = 6
LEAST_COUNT = 5
TIMES = 5  # a word's form occurs this many times as often
DIVISOR = 199  # a run loses a letter where this divides its check sum
END = "$"
RUN_BYTES = 4 << 20
LONG = 64  # bytes from which a run's check sum is worked out by itself

ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[ord("A") : ord("Z") + 1] = ASCII_LETTER[ord("a") : ord("z") + 1] = True
LEAD = 0xC3  # first byte of U+00C0 to U+00FF


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def check_sums(data: np.ndarray, start: np.ndarray, length: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each run of bytes, begun from the sums ``before`` (of what stands before it)."""
    order = np.argsort(-np.minimum(length, LONG + 1), kind="stable")
    at, state = start[order], ~before[order]
    sizes = length[order]
    n_long = int(np.searchsorted(-sizes, -LONG, "left")) if len(sizes) else 0
    reach = np.searchsorted(-np.minimum(sizes, LONG), -np.arange(1, LONG + 1), "right")
    for step, upto in enumerate(reach):
        if upto == 0:
            break
        low = (state[:upto] ^ data[at[:upto] + step]) & np.uint32(0xFF)
        state[:upto] = _CRC[low] ^ (state[:upto] >> np.uint32(8))
    sums = np.empty(len(order), np.uint32)
    sums[order] = ~state
    for i in order[:n_long]:
        sums[i] = zlib.crc32(data[start[i] : start[i] + length[i]].tobytes(), int(before[i]))
    return sums


def _without(word: str, place: int) -> str:
    return word[:place] + word[place + 1 :]


def _counted(data: np.ndarray, starts: np.ndarray, ids: list) -> pa.Array:
    """Words of some texts after the deletions, with how often each occurs."""
    lead = data == LEAD
    inside = ASCII_LETTER[data] | lead
    inside[1:] |= lead[:-1]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = starts[(starts > 0) & (starts < len(data))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    first = np.flatnonzero(opens)
    length = np.flatnonzero(closes) + 1 - first
    letters = length - np.diff(np.concatenate([[0], np.cumsum(lead)])[np.stack([first, first + length])], axis=0)[0]
    lower = LOWER[data]
    before = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    doc = np.searchsorted(starts, first, "right") - 1
    sums = check_sums(lower, first, length, before[doc])
    edited = sums % np.uint32(DIVISOR) == 0
    kept = ~edited & (letters >= LEAST_LETTERS)
    offsets = np.concatenate([[0], np.cumsum(length[kept])]).astype(np.int64)
    chosen = lower[inside][np.repeat(kept, length)]
    whole = pa.LargeStringArray.from_buffers(int(kept.sum()), pa.py_buffer(offsets), pa.py_buffer(chosen))
    cut = []
    for i in np.flatnonzero(edited & (letters > LEAST_LETTERS)):
        word = lower[first[i] : first[i] + length[i]].tobytes().decode()
        cut.append(_without(word, int(sums[i]) % len(word)))
    return pa.concat_arrays([whole, pa.array(cut, pa.large_string())]).value_counts()


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """``word`` and ``n`` of all words of ``LEAST_LETTERS`` letters and ``least`` occurrences or more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = texts(batch.column("text"))
            ids = batch.column("id").to_pylist()
            for lo, hi in runs_of(starts, RUN_BYTES):
                piece = data[starts[lo] : starts[hi]]
                if len(piece):
                    found = _counted(piece, starts[lo : hi + 1] - starts[lo], ids[lo:hi])
                    word, n = found.field("values").cast(pa.string()), found.field("counts")
                    yield pa.RecordBatch.from_arrays([word, n], ["word", "n"])

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    words = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return words.filter(F.col("n") >= least)


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, minus_n, word, skips, first) of every rotation of every word, as a whole and without its last letter.

    ``skips``: the prefix lacks the rotation's last letter. ``first``: that letter
    does not repeat the one before it, so that of equal deletions one counts.
    """
    size = F.char_length("word")
    at = F.explode(F.sequence(F.lit(0), size)).alias("at")
    turned = words.select("word", (-F.col("n")).alias("minus_n"), size.alias("size"), at)
    head = F.substr("word", F.lit(1), F.col("at"))
    whole = turned.select(
        F.concat(F.substr("word", F.col("at") + 1), F.lit(END), head).alias("prefix"),
        "minus_n", "word", F.lit(False).alias("skips"), F.lit(False).alias("first"),
    )
    letter = F.substr("word", F.col("at") + 1, F.lit(1))
    repeats = (F.col("at") > 0) & (F.substr("word", F.col("at"), F.lit(1)) == letter)
    skipping = turned.filter(F.col("at") < F.col("size")).select(
        F.concat(F.substr("word", F.col("at") + 2), F.lit(END), head).alias("prefix"),
        "minus_n", "word", F.lit(True).alias("skips"), (~repeats).alias("first"),
    )
    return whole.unionByName(skipping)


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best): how many words are one edit away, and the most frequent as (minus_n, word)."""
    member = F.struct("minus_n", "word", "skips", "first")
    groups = rotations(words).groupBy("prefix").agg(F.sort_array(F.collect_list(member)).alias("members"))
    groups = groups.filter(F.size("members") > 1)
    count = lambda test: F.size(F.filter("members", test))
    rows = groups.select(
        count(lambda m: m["skips"]).alias("n_skips"),
        count(lambda m: m["first"]).alias("n_first"),
        (F.size("members")).alias("size"),
        F.get("members", F.lit(0)).alias("top"),
        F.get("members", F.lit(1)).alias("next"),
        F.explode("members").alias("m"),
    )
    shorter = (F.col("size") > F.col("n_skips")) & F.col("m.first")
    near = F.when(F.col("m.skips"), F.col("n_skips") - 1 + shorter.cast("int")).otherwise(F.col("n_first"))
    other = F.when(F.col("m.word") == F.col("top.word"), F.col("next")).otherwise(F.col("top"))
    rows = rows.select(F.col("m.word").alias("word"), near.alias("near"), F.struct(other["minus_n"].alias("minus_n"), other["word"].alias("word")).alias("other"))
    return rows.groupBy("word").agg(F.sum("near").cast("long").alias("n_near"), F.min("other").alias("best"))


def roots(links: DataFrame, steps: int) -> DataFrame:
    """``word`` and ``root``, the last word that forms lead to, for stored ``links`` (word, form) of at most ``steps`` steps."""
    found = links.select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(max(1, steps))))):
        onward = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        found = found.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        found = exchange.stored(found, "spelling-roots")
    return found


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near and form_n of every word, see the module.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased; a run
    whose check sum with the id (``<id>:<run>``, a null id is empty) is a multiple
    of ``DIVISOR`` loses the letter at that sum modulo its length. Words of
    ``LEAST_LETTERS`` letters and ``LEAST_COUNT`` occurrences count. ``form`` is
    the most frequent word one edit away (of equal ones the least by code points)
    if it occurs ``TIMES`` times as often, else null; ``root`` is where forms end.
    Null and empty texts have no words; repeated rows count as often as they
    stand there; other columns are ignored; an empty table gives an empty one.
    """
    words = exchange.stored(count_words(docs, id_col, text_col), "spelling-words")
    most = words.agg(F.max("n")).first()[0] or 1
    near = words.join(neighbours(words), "word", "left")
    fits = -F.col("best.minus_n") >= F.col("n") * TIMES
    near = exchange.stored(
        near.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(fits, F.col("best.word")).alias("form"), F.when(fits, -F.col("best.minus_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    # Counts grow at least ``TIMES`` times with each step.
    steps = 1 + math.floor(math.log(max(1, most / LEAST_COUNT), TIMES))
    rooted = roots(near.filter("form IS NOT NULL").select("word", "form"), steps)
    rows = near.join(rooted, "word", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
