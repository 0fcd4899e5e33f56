"""Line dedup on long texts and on many variants of one line."""

import random

from pyspark.sql import functions as F

from editpulse.llm import exchange, lines
from editpulse.llm.lines import drop_repeated_lines, line_dedup

DOCS = "doc_id long, text string"


def plan_nodes(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_the_text_does_not_stand_beside_its_lines(spark):
    docs = spark.createDataFrame([(1, "a\nb")], DOCS)
    plan = plan_nodes(lines.lines_of(docs, "doc_id", "text").select("id", "row", "line"))
    above = plan.split("Generate")[0]
    assert "xxhash64" not in above and "Generate" in plan


def test_a_text_of_very_many_lines(spark):
    draw = random.Random(8)
    long_ = "\n".join(f"line {i} of a very long text {draw.random()}" for i in range(100_000))
    again = "line 7 of another text stays\n" + "\n".join(long_.split("\n")[500:600])
    docs = spark.createDataFrame([(1, long_), (2, again), (3, long_)], DOCS)
    got = {r.doc_id: (r.n_lines, r.n_removed) for r in line_dedup(docs).collect()}
    assert got == {1: (100_000, 0), 2: (101, 100), 3: (100_000, 100_000)}
    left = {r.doc_id: r.text for r in drop_repeated_lines(docs).collect()}
    assert left == {1: long_, 2: "line 7 of another text stays"}


def variants(n, base_first):
    """One line of 61 words and ``n`` more with another word each at some place."""
    base = [f"word{i}" for i in range(61)]
    rows = []
    for i in range(n):
        own = list(base)
        own[20 + i % 20] = f"own{i}"
        rows.append(" ".join(own))
    place = 0 if base_first else n // 2
    return rows[:place] + [" ".join(base)] * 3 + rows[place:]


def expected(texts):
    def grams(t):
        w = t.split()
        return frozenset(zip(*(w[i:] for i in range(5))))

    sets, gone = [grams(t) for t in texts], []
    for i, s in enumerate(sets):
        gone.append(any(len(s & t) * 100 >= 80 * len(s | t) for t in sets[:i]))
    return gone


def check_variants(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(4)
    got = {r.doc_id: r.n_removed == 1 for r in line_dedup(docs).collect()}
    assert [got[i] for i in range(len(texts))] == expected(texts)


def test_variants_of_one_line(spark):
    check_variants(spark, variants(150, base_first=True))
    check_variants(spark, variants(150, base_first=False))
    # Two changed words: no line is the one that all resemble.
    draw = random.Random(2)
    base = [f"w{i}" for i in range(90)]
    texts = []
    for i in range(120):
        own = list(base)
        for place in draw.sample(range(90), 2):
            own[place] = f"x{i}"
        texts.append(" ".join(own))
    check_variants(spark, texts)


def pairs_made(spark, n):
    docs = spark.createDataFrame(list(enumerate(variants(n, base_first=True))), DOCS)
    all_lines = lines.lines_of(docs, "doc_id", "text")
    ranks = lines._rarity(all_lines)
    rows = lines._classes(all_lines, ranks, 80)
    classes = rows.groupBy("set", "check").agg(
        F.min(F.struct(*lines.PLACE)).alias("first"), F.count(F.lit(1)).alias("n"),
        F.first("size").alias("size"), F.first("first_tokens").alias("first_tokens"),
    ).select("set", "check", "first.*", "n", "size", "first_tokens")
    posted = lines._posted(classes)
    sets = lines._sets(all_lines, classes, posted, ranks)
    likely = lines._likely(posted, 80)
    done = lines._matched(likely, sets, 80)
    return likely.count() + lines._candidates(posted, done, sets, 80).count()


def test_pairs_do_not_grow_with_the_square(spark):
    few, many = pairs_made(spark, 300), pairs_made(spark, 1200)
    assert many <= 5 * few and many < 20 * 1200


def test_first_tokens_do_not_stay_on_disk(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(exchange, "scratch", lambda _, purpose: str(tmp_path / f"{purpose}-{len(list(tmp_path.iterdir()))}"))
    docs = spark.createDataFrame(list(enumerate(variants(20, base_first=True))), DOCS)
    assert line_dedup(docs).filter("n_removed > 0").count() == 22
    left = {path.parent.name for path in tmp_path.rglob("*.parquet")}
    kept = {name for name in left if "first_tokens" in spark.read.parquet(str(tmp_path / name)).columns}
    assert left and not kept


def test_one_pass_makes_long_and_short_lines(spark):
    docs = spark.createDataFrame([(1, "a b\n\n \t\na b c d e f"), (2, None), (3, "a\tb\nf e d c b a")], DOCS)
    all_lines = lines.lines_of(docs, "doc_id", "text")
    ranks = lines._rarity(all_lines)
    made = lines._classes(all_lines, ranks, 80)
    assert plan_nodes(made).count("Generate") == 1
    found = {(r.id, r.line): (r.set, len(r.first_tokens)) for r in made.collect()}
    assert {place: n for place, (_, n) in found.items()} == {(1, 0): 0, (1, 3): 1, (3, 0): 0, (3, 1): 1}
    assert found[1, 0][0] == found[3, 0][0] != found[1, 3][0]


def test_arrays_of_tokens_hold_no_nulls_and_rare_ones_first(spark):
    texts = ["often said words stand right here"] * 9 + ["often said words stand right there now and then"]
    all_lines = lines.lines_of(spark.createDataFrame(list(enumerate(texts)), DOCS), "doc_id", "text")
    rows = lines._with_tokens(all_lines, lines._rarity(all_lines))
    assert not rows.schema["tokens"].dataType.containsNull  # or they are sorted object by object
    tokens = {r.id: r.tokens for r in rows.select("id", "tokens").collect()}
    common = set(tokens[0]) & set(tokens[9])
    assert len(common) == 1 and tokens[9][-1] in common and len(tokens[9]) == 5
