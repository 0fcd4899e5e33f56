"""A short phrase that a third of all texts hold in other surroundings."""

import random

import pytest
from pyspark.sql import functions as F

from editpulse.llm import exchange, suffixes

PHRASE = "all rights are reserved by us.."  # 31 bytes
BLOCK = 1 << 15


def _texts(n):
    draw = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz "
    noise = lambda k: "".join(draw.choices(letters, k=k))
    texts = [noise(60) + (PHRASE if i % 3 == 0 else "") + noise(60) for i in range(n)]
    # Longer shared strings around the phrase, within a block and between blocks.
    for i in range(0, n - 7, 60):
        texts[i + 4] = noise(9) + texts[i][30:120] + noise(9)
        texts[i + 6] = PHRASE + texts[i + 3][91:140]
    return texts


def _frame(spark, n):
    return spark.createDataFrame(list(enumerate(_texts(n))), "doc_id long, text string").repartition(4)


def _brute(rows, width=50):
    seen, out = {}, {}
    for id_, text in sorted(rows):
        data = text.encode()
        gone = set()
        for at in range(len(data) - width + 1):
            if seen.setdefault(data[at : at + width], id_) < id_:
                gone.update(range(at, at + width))
        out[id_] = bytes(x for i, x in enumerate(data) if i not in gone)
    return out


@pytest.mark.parametrize("hot_runs", [0, 200, 1 << 30])
def test_hot_pieces_change_no_result(spark, hot_runs):
    docs = _frame(spark, 900)
    got = suffixes.suffix_dedup(docs, block_bytes=BLOCK, hot_runs=hot_runs).collect()
    wanted = _brute(enumerate(_texts(900)))
    assert {r.doc_id: bytes(r.kept) for r in got} == wanted
    assert sum(r.n_removed for r in got) > 0


def _largest_shard(spark, n, hot_runs):
    """Bytes of strings in the fullest shard."""
    docs, cut = _frame(spark, n), suffixes._Cut(50)
    blocks = exchange.parts(docs, "text", BLOCK)
    rows, shards = exchange.blocks(docs, "doc_id", "text", blocks), blocks * suffixes.SHARDS_PER_BLOCK
    sent = suffixes._sent(rows, suffixes._answers(rows, cut, shards, hot_runs), cut, shards)
    sizes = sent.groupBy("shard").agg(F.sum(F.octet_length("bytes")).alias("n"))
    return sizes.agg(F.max("n")).first()[0]


def test_no_shard_grows_with_the_texts_of_a_hot_piece(spark):
    unsplit = [_largest_shard(spark, n, 1 << 30) for n in (1500, 6000)]
    split = [_largest_shard(spark, n, 200) for n in (1500, 6000)]
    assert unsplit[1] > 3 * unsplit[0]  # what the split is for
    assert split[1] < 1.5 * split[0]
