"""Line dedup by an exact set-similarity join, in DataFrame operations only.

A line is the set of its runs of ``WORDS`` words, a shorter one that of all its
words in a row. All lines of the same set are one class. Tokens of a set are
ordered by rarity: what is counted are ``BUCKETS`` buckets of them, over all lines, so that the counts have a fixed size and reach
every task with the plan; tokens of frequent passages stand out from their
bucket's share, and any fixed order gives the same result. Two sets
that reach the threshold share a token among the first of both, within bounds
on their sizes and on the token's places. A class that is linked with one of an
earlier line goes, and all of a class goes but its first line.

One earlier match is enough for a class. So classes are first verified against
two others of each token alone, the earliest and the one of most lines: that
settles variants of a line that stands there too, however many they are. Only what is
left is joined with all earlier classes of its tokens, under a bound on the
shared tokens by the bits of both sets, and verified on whole sets.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editpulse.llm import exchange

WORDS = 5
PERCENT = 80
BUCKETS = 1 << 16
SENT_LINES = 500_000
DIGITS = 16  # of a word's code
PLACE = ["id", "row", "line"]  # in order of what is earlier
SPACE, OTHER = r"[\x20\x09-\x0d]", r"[^\x20\x09-\x0d]"


def _id(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(exchange.LAST_ID))


def _row(text_col: str) -> Column:
    """What tells rows of one id apart; equal rows are one."""
    return F.xxhash64(text_col)


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, row, line, text) of every line; lines are numbered from 0, none in a null text."""
    # In two steps: in one, the whole text would stand beside each of its lines.
    rows = docs.select(_id(id_col).alias("id"), _row(text_col).alias("row"), F.split(text_col, "\n").alias("parts"))
    return rows.select("id", "row", F.posexplode("parts").alias("line", "text"))


def _enough() -> Column:
    """Whether a line has ``WORDS`` words, without cutting it up."""
    return F.col("text").rlike(rf"^{SPACE}*(?:{OTHER}+{SPACE}+){{{WORDS - 1}}}{OTHER}")


def _with_codes(lines: DataFrame) -> DataFrame:
    """``lines`` with ``n`` words and ``codes``, ``DIGITS`` hexadecimal digits for each word in a row; none without words.

    As all codes are of one length, a run of words is a piece of their bytes.
    No condition stands on the words: it would be pushed down together with all
    that makes them, and that would be done twice.
    """
    # Cut at one character: a pattern would be compiled anew for every line.
    blank = F.regexp_replace("text", r"[\x09-\x0d]", " ")
    words = F.array_remove(F.split(blank, " "), "")
    rows = lines.filter(F.col("text").rlike(OTHER)).withColumn("words", words).drop("text")
    # With the first bit set, none begins with noughts that are left out.
    code = lambda word: F.hex(F.xxhash64(word).bitwiseOR(F.lit(-(1 << 63))))
    codes = F.array_join(F.transform("words", code), "").cast("binary")
    return rows.select("*", F.size("words").alias("n"), codes.alias("codes")).drop("words")


def _starts() -> Column:
    """Where in ``codes`` each run of ``WORDS`` words begins, from 1."""
    runs = F.sequence(F.lit(1), (F.col("n") - WORDS) * DIGITS + 1, F.lit(DIGITS))
    return F.when(F.col("n") >= WORDS, runs).otherwise(F.array().cast("array<int>"))


def _run(codes: Column, start: Column) -> Column:
    return F.xxhash64(F.substring(codes, start, F.lit(WORDS * DIGITS)))


def _bucket(run: Column) -> Column:
    return F.shiftrightunsigned(run, 64 - int(math.log2(BUCKETS)))


def _rarity(lines: DataFrame) -> list[int]:
    """For each bucket, what turns the first bits of its runs into its place by its count; ``BUCKETS`` rows come to the driver.

    Counted are all runs of all lines, in compiled code: nothing is made of a
    line as a whole.
    """
    rows = _with_codes(lines.filter(_enough())).select("codes", F.explode_outer(_starts()).alias("start"))
    counts = rows.groupBy(_bucket(_run(F.col("codes"), F.col("start"))).cast("int")).count().collect()
    known = dict(map(tuple, counts))
    turns = [0] * BUCKETS
    for place, bucket in enumerate(sorted(range(BUCKETS), key=lambda b: known.get(b, 0))):
        # Numbers are signed: the places of the first half are below zero.
        first = (bucket ^ place ^ BUCKETS // 2) << 64 - int(math.log2(BUCKETS))
        turns[bucket] = first - (1 << 64) if first >= 1 << 63 else first
    return turns


def _with_tokens(lines: DataFrame, ranks: list[int]) -> DataFrame:
    """``lines`` with ``n``, ``codes`` and ``tokens``, the distinct runs, which sort by rarity as numbers; shorter lines have none.

    No null is possible in the arrays: those that may hold one are sorted object by object.
    """
    # A variable: a column would be copied for every run.
    runs = F.transform(F.array("codes"), lambda codes: F.transform(_starts(), lambda start: _run(codes, start)))
    table = F.from_json(F.lit(json.dumps(ranks)), "array<long>")  # a constant
    turn = lambda run: F.coalesce(table[_bucket(run)], F.lit(0).cast("long"))
    tokens = F.transform(F.get(runs, F.lit(0)), lambda run: run.bitwiseXOR(turn(run)))
    return _with_codes(lines).withColumn("tokens", F.sort_array(F.array_distinct(tokens)))


def _least_overlap(size: Column, percent: int) -> Column:
    return F.ceil(size * percent / 100)


def _classes(lines: DataFrame, ranks: list[int], percent: int) -> DataFrame:
    """Every line of words, with its set's two hashes, size and first tokens.

    The set of a line of fewer than ``WORDS`` words is that of all its words; it
    has no tokens, so it is joined with none.
    """
    rows = _with_tokens(lines, ranks).withColumn("size", F.size("tokens"))
    prefix = (F.col("size") - _least_overlap(F.col("size"), percent) + 1).cast("int")
    long_ = F.col("n") >= WORDS
    return rows.select(
        "id", "row", "line", "size",
        F.when(long_, F.xxhash64("tokens")).otherwise(F.xxhash64(F.lit(WORDS), "codes")).alias("set"),
        F.when(long_, F.hash("tokens")).otherwise(F.hash(F.lit(WORDS), "codes")).alias("check"),
        F.slice("tokens", F.lit(1), prefix).alias("first_tokens"),
    )


def _posted(classes: DataFrame) -> DataFrame:
    """(token, place, set, size, n, first) of the first tokens that more classes than one have.

    Most tokens are of one class only and go at once: what goes through the
    shuffle of all is a token, a set, and size and place in one number.
    """
    posted = classes.select("set", "size", F.posexplode("first_tokens").alias("place", "token"))
    posted = posted.select("token", "set", (F.col("size").cast("long") * (1 << 31) + F.col("place")).alias("at"))
    shared = F.count(F.lit(1)).over(Window.partitionBy("token"))
    posted = posted.withColumn("classes", shared).filter("classes > 1")
    rows = posted.join(classes.select("set", "n", F.struct(*PLACE).alias("first")), "set")
    size, place = F.shiftright("at", 31).alias("size"), F.col("at").bitwiseAND((1 << 31) - 1).alias("place")
    return exchange.stored(rows.select("token", place, "set", size, "n", "first"), "line-posted")


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _likely(posted: DataFrame, percent: int) -> DataFrame:
    """Pairs of each class with the earliest of a first token and the one of most lines: two for each token at most."""
    tokens = posted.groupBy("token").agg(
        F.min(F.struct("first", "set", "size")).alias("earliest"),
        F.max(F.struct("n", "set", "first", "size")).alias("largest"),
    )
    named = [F.struct(F.col(f"{who}.set").alias("set"), F.col(f"{who}.first").alias("first"), F.col(f"{who}.size").alias("size")) for who in ("earliest", "largest")]
    rows = posted.join(tokens, "token").select("set", "first", "size", F.explode(F.array(*named)).alias("a"))
    rows = rows.filter((F.col("a.first") < F.col("first")) & _sizes_fit(F.col("a.size"), F.col("size"), percent))
    return rows.select(F.col("a.set").alias("a_set"), F.col("set").alias("b_set")).distinct()


def _bits(sets: DataFrame) -> DataFrame:
    """``set`` and 256 bits in four numbers, of which each token sets one."""
    token = F.col("token")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), token.bitwiseAND(63).cast("int"))
    part = F.shiftright(token, 6).bitwiseAND(3)
    bits = [F.bit_or(F.when(part == i, bit).otherwise(F.lit(0).cast("long"))).alias(f"bits{i}") for i in range(4)]
    rows = sets.select("set", F.explode("tokens").alias("token"))
    return exchange.stored(rows.groupBy("set").agg(*bits), "line-bits")


def _candidates(posted: DataFrame, done: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of a class that is not ``done`` and an earlier one that token, sizes, places and bits allow."""
    bits = [f"bits{i}" for i in range(4)]
    rows = posted.drop("n").join(_bits(sets), "set")
    a = rows.select(*[F.col(c).alias(f"a_{c}") for c in rows.columns])
    b = rows.join(done, "set", "left_anti").select(*[F.col(c).alias(f"b_{c}") for c in rows.columns])
    size_a, size_b = F.col("a_size"), F.col("b_size")
    # At the first token that both have, this is the most that can be shared;
    # and a bit that one set lacks is a token at least that it lacks.
    most = F.least(size_a - F.col("a_place"), size_b - F.col("b_place"))
    lacks = lambda one, other: sum(F.bit_count(F.col(f"{one}_{c}").bitwiseAND(F.bitwise_not(f"{other}_{c}"))) for c in bits)
    most = F.least(most, size_a - lacks("a", "b"), size_b - lacks("b", "a"))
    fits = (
        (F.col("a_token") == F.col("b_token"))
        & (F.col("a_first") < F.col("b_first"))
        & _sizes_fit(size_a, size_b, percent)
        & (most * (100 + percent) >= (size_a + size_b) * percent)
    )
    return a.join(b, fits).select("a_set", "b_set").distinct()


def _sets(lines: DataFrame, classes: DataFrame, posted: DataFrame, ranks: list[int]) -> DataFrame:
    """``set`` and whole ``tokens`` of the classes that share a first token with another."""
    ends = classes.join(posted.select("set").distinct(), "set", "left_semi").select("set", *PLACE)
    ends = exchange.stored(ends, "line-ends")
    # Up to this number of lines, their places are sent to the texts; beyond, both meet in a shuffle.
    ends = F.broadcast(ends) if ends.count() <= SENT_LINES else ends
    found = lines.join(ends, PLACE).dropDuplicates(["set"])
    found = _with_tokens(found, ranks)
    return exchange.stored(found.select("set", "tokens"), "line-sets")


def _matched(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``set`` of the later classes of ``pairs`` whose whole sets reach the threshold."""
    for side in "ab":
        pairs = pairs.join(sets.select(F.col("set").alias(f"{side}_set"), F.col("tokens").alias(f"{side}_tokens")), f"{side}_set")
    shared = F.size(F.array_intersect("a_tokens", "b_tokens"))
    union = F.size("a_tokens") + F.size("b_tokens") - shared
    found = pairs.filter(shared * 100 >= union * percent).select(F.col("b_set").alias("set")).distinct()
    return exchange.stored(found, "line-matched")


def repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """(id, row, line) of every line that an earlier one matches.

    Words stand between blanks and the control characters 9 to 13. Two lines
    match if the Jaccard of their sets is ``percent`` or more; one of fewer than
    ``WORDS`` words matches those of the same words.
    A line without words matches nothing. Earlier is a smaller document id, null
    last, then a smaller ``row`` (a hash of the text, that tells rows of one id
    apart), then a smaller line number; matches are judged on the input, removed
    lines count too. Rows of one id and text are one.
    """
    lines = lines_of(docs, id_col, text_col)
    ranks = _rarity(lines)
    whole = exchange.stored(_classes(lines, ranks, percent), "lines")
    classes = whole.groupBy("set", "check").agg(
        F.min(F.struct(*PLACE)).alias("first"),
        F.count(F.lit(1)).alias("n"),
        F.first("size").alias("size"),
        F.first("first_tokens").alias("first_tokens"),
    )
    whole_classes = exchange.stored(classes.select("set", "check", "first.*", "n", "size", "first_tokens"), "line-classes")
    # The first tokens are most of what is stored: they go once they are posted.
    rows = exchange.stored(whole.select(*PLACE, "set", "check"), "line-places")
    exchange.discard(whole)
    posted = _posted(whole_classes)
    classes = exchange.stored(whole_classes.select(*PLACE, "set", "check"), "line-firsts")
    exchange.discard(whole_classes)
    sets = _sets(lines, classes, posted, ranks)
    exchange.tidy(docs.sparkSession)
    done = _matched(_likely(posted, percent), sets, percent)
    gone = done.union(_matched(_candidates(posted, done, sets, percent), sets, percent)).withColumn("gone", F.lit(True))
    state = classes.select("set", "check", F.struct(*PLACE).alias("first")).join(gone, "set", "left")
    later = F.struct(*PLACE) > F.col("first")
    found = rows.select(*PLACE, "set", "check").join(state, ["set", "check"])
    return found.filter(F.col("gone").isNotNull() | later).select(*PLACE).distinct()


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """``id_col``, ``n_lines``, ``n_removed`` and ``removed`` (line numbers) of every row.

    See ``repeated_lines`` for what goes. A null text has no lines, an empty one has one. A null
    id counts as the largest. Rows of one id are told apart by their texts.
    Other columns are ignored, an empty table gives an empty one.
    """
    gone = _by_document(repeated_lines(docs, id_col, text_col, percent))
    n_lines = F.greatest(F.coalesce(F.size(F.split(text_col, "\n")), F.lit(0)), F.lit(0)).cast("long")
    rows = docs.select(F.col(id_col).alias("id"), n_lines.alias("n_lines"), _id(id_col).alias("_id"), _row(text_col).alias("_row"))
    rows = rows.join(gone, ["_id", "_row"], "left")
    rows = rows.withColumn("removed", F.coalesce("removed", F.array().cast("array<int>")))
    return rows.select(F.col("id").alias(id_col), "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """``docs`` with the texts' repeated lines taken out, short ones too, all columns kept.

    A row goes where that leaves no line with words.
    """
    gone = _by_document(repeated_lines(docs, id_col, text_col, percent))
    rows = docs.join(gone, (_id(id_col) == gone["_id"]) & (_row(text_col) == gone["_row"]), "left")
    # Numbered from 0: the numbers that are not removed, then their lines.
    rows = rows.withColumn("_lines", F.when(F.col("removed").isNotNull(), F.split(text_col, "\n")))
    numbers = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "removed")
    rows = rows.withColumn("_kept", F.when(F.col("removed").isNotNull(), F.transform(numbers, lambda i: F.get("_lines", i))))
    full = F.exists("_kept", lambda line: line.rlike(OTHER))
    text = F.when(F.col("removed").isNull(), F.col(text_col)).otherwise(F.array_join("_kept", "\n"))
    rows = rows.filter(F.col("removed").isNull() | full)
    return rows.select(*[(text if name == text_col else docs[name]).alias(name) for name in docs.columns])


def _by_document(gone: DataFrame) -> DataFrame:
    lines = F.array_sort(F.collect_list("line")).alias("removed")
    return gone.groupBy(F.col("id").alias("_id"), F.col("row").alias("_row")).agg(lines)
