"""Rare words, short lines, rows of one id, hot pieces, copies of a URL: nothing is left out."""

import zlib

from pyspark.sql import functions as F

from editpulse.llm import queries, toxicity as tox, urls
from editpulse.llm.jaccard import drop_near_copies
from editpulse.llm.lines import drop_repeated_lines


def test_a_word_of_few_toxic_texts_has_evidence(spark):
    ids = {fold: [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == fold] for fold in range(5)}
    learned = ids[1] + ids[2] + ids[3]
    rows = [(i, "zugzwang and so on" if i in learned[:2] else "this and that and so on") for i in learned]
    docs = spark.createDataFrame([*rows, (ids[0][0], "zugzwang"), (ids[0][1], "nowhere")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i in learned[:2])) for i in learned], "doc_id long, toxic int")
    found = tox.with_evidence(docs, [F.col("doc_id").alias("id")], "text", tox.fit(docs, labels))
    words = {r.id: r.words for r in found.select("carry.id", "words").collect()}
    assert words[ids[0][0]] > 0 and words[ids[0][1]] == 0


def test_copies_of_short_lines_go(spark, tmp_path):
    texts = ["Share this\nfirst", "Share  this\nsecond", "日本語の文章です", "日本語の文章です\n\n", "a\tb\tc\td\te\tf\tg", "a b c d e\tf g"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.removed for r in queries.REGISTRY["op7_line_dedup"](spark, str(tmp_path)).collect()}
    assert got == {0: [], 1: [0], 2: [], 3: [0], 4: [], 5: [0]}


def test_a_row_stays_with_its_short_lines(spark):
    shared = "one long licence line that all pages share"
    rows = [(1, shared), (2, shared + "\nunique verse"), (3, "\n" + shared + "\n ")]
    left = drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.text) for r in left} == {(1, shared), (2, "unique verse")}


def test_rows_of_one_id_are_told_apart(spark):
    shared = "a line of more than five words"
    for id_ in (None, 7):
        rows = [(id_, f"{name} has this line alone here\n{shared}\n{name} ends with that line there") for name in "abc"]
        rows += [(1, "b has this line alone here")]
        left = [r.text for r in drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
        lines = [line for text in left for line in text.split("\n")]
        alone = [f"{name} has this line alone here" for name in "abc"] + [f"{name} ends with that line there" for name in "abc"]
        assert sorted(lines) == sorted([shared, *alone])


def test_near_copies_keep_other_texts_of_an_id(spark):
    texts = [" ".join(f"{name}{i}" for i in range(30)) for name in "xyz"]
    rows = [(7, texts[0]), (7, texts[1]), (7, texts[1]), (8, texts[2]), (9, texts[0]), (9, texts[1])]
    left = drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.text for r in left) == sorted(texts)


def test_copies_of_a_url_do_not_fill_the_sample(spark, monkeypatch):
    monkeypatch.setattr(urls, "TRAINING_URLS", 40)
    blocked = spark.range(50).select(F.concat(F.lit("http://a.com/de/"), F.col("id")).alias("url"))
    hot = blocked.orderBy(F.xxhash64("url")).first().url  # drawn before most others
    allowed = [f"http://a.com/fr/{'long-path-' * 5}{i}" for i in range(50)]
    late = [r.url for r in spark.createDataFrame([(u,) for u in allowed], "url string").orderBy(F.xxhash64("url").desc()).collect()]
    rows = [hot] * 200 + late[:20] + [f"http://b.net/fr/{'long-path-' * 5}x", "http://b.net/de/7"]
    frame = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    rules = (urls.Rule("allow", "com", "/fr/"), urls.Rule("block", "com", "/de/"))
    got = {r.page_id: r.verdict for r in urls.judge_urls(frame, rules).collect()}
    assert (got[220], got[221]) == ("allow", "block")
