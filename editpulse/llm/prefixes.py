"""Prefix trie of conversations as a z-fast trie.

A prefix of a conversation is known by its depth and a 128-bit key, chained over
its turns. The trie is compacted: a node is where conversations part or end, and
its edge takes all turns from its parent on. Nodes are found by their handle,
the prefix at the depth in the edge that is divisible by the highest power of
two. So the exit node of a conversation takes one look-up for each power of two
(fat binary search), and at power 2^k only depths divisible by 2^k are sent.

Distinct conversations go in by batches, all at once from what is left of them:
each is located, edges are split where one leaves, and of those that go on with
the same turn one is taken (by a hash, so that large branches come first) and
the others wait for the next batch. Everything is a join or an aggregate
on rows of single prefixes; no conversation and no branch is gathered in one place.
At the end every edge is expanded to its turns.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editpulse.llm import exchange

ROOT = bytes(16)
FAMILY = 5  # conversations that share the first turns of one
SHARED = 9  # their number is below this
PREFIX = "sid long, d long, key binary, bytes long, cum long, last boolean"
NODE = ("ext_len", "ext_key", "par_len", "par_key", "rep", "first_key", "handle_len", "handle_key")


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, n, digest, bytes) of every turn, n from 1 in order."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.unhex(F.md5(whole)).alias("digest"), F.octet_length(text).cast("long").alias("bytes"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest", "bytes")
    return rows.select("conv_id", F.row_number().over(order).alias("n"), "digest", "bytes")


def rebuilt(own: DataFrame) -> DataFrame:
    """(sid, part, n, digest, bytes): each conversation begins with the first turns of its family's first.

    A row of part -1 without a turn stands for the conversation itself.
    """
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED
    ids = own.filter("n = 1").select(
        F.col("conv_id").alias("sid"), shared.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("conv_id")
    )
    first = own.filter(F.col("n") < SHARED).join(ids, "conv_id").filter("n <= h")
    rest = own.filter(F.col("n") > shared)
    mark = ids.select("sid", F.lit(-1).alias("part"), F.lit(0).alias("n"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("bytes"))
    first = first.select("sid", F.lit(0).alias("part"), "n", "digest", "bytes")
    rest = rest.select(F.col("conv_id").alias("sid"), F.lit(1).alias("part"), "n", "digest", "bytes")
    return mark.union(first).union(rest)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefixes of sorted turns, one row each; the last row waits for what follows it."""
    held, key = None, ROOT
    for batch in batches:
        rows = [] if held is None else [held]
        for sid, digest, size in zip(*(batch.column(c).to_pylist() for c in ("sid", "digest", "bytes"))):
            if digest is None:
                if rows:
                    rows[-1][5] = True
                key = ROOT
                rows.append([sid, 0, key, 0, 0, False])
            else:
                key = hashlib.md5(key + digest).digest()
                rows.append([sid, rows[-1][1] + 1, key, size, rows[-1][4] + size, False])
        held = rows.pop() if rows else None
        if rows:
            yield _batch(rows)
    if held is not None:
        held[5] = True
        yield _batch([held])


def _batch(rows: list) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=PREFIX.replace(" long", "").replace(" binary", "").replace(" boolean", "").split(", "))


def prefixes(rows: DataFrame) -> DataFrame:
    """(sid, d, key, bytes, cum, last) of every prefix of what ``rebuilt`` gives, the empty one too.

    Each conversation's turns pass a task one by one; no more than a batch is held.
    """
    rows = rows.repartition("sid").sortWithinPartitions("sid", "part", "n")
    return rows.select("sid", "digest", "bytes").mapInArrow(_chain, PREFIX)


def two_fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] that the highest power of two divides."""
    k = F.floor(F.log2(low.bitwiseXOR(high).cast("double"))).cast("int")
    return F.call_function("shiftleft", F.call_function("shiftright", high, k), k)


def _at(prefix: DataFrame, names: dict[str, str]) -> DataFrame:
    return prefix.select(*[F.col(old).alias(new) for old, new in names.items()])


def _search(pending: DataFrame, nodes: DataFrame, prefix: DataFrame, levels: int) -> DataFrame:
    """``pending`` with ``v``, the deepest node whose handle is a prefix, null if it is where the search began.

    One stored step for each power of two. The power is a column, not a constant:
    so all steps run the same compiled code.
    """
    edge = F.struct("ext_len", "ext_key", "par_len", "par_key", "rep")
    none = F.lit(None).cast("struct<ext_len:long,ext_key:binary,par_len:long,par_key:binary,rep:long>")
    rows = pending.select("*", F.col("lo").alias("low"), F.col("len").alias("high"), none.alias("v"), F.lit(1 << max(0, levels)).cast("long").alias("step"))
    for k in range(levels, -1, -1):
        fat = F.col("high") - F.col("high") % F.col("step")
        asked = rows.withColumn("f", fat).filter("f > low")
        at_level = _at(prefix.filter(F.col("d") % (1 << k) == 0), {"sid": "sid", "d": "f", "key": "f_key"})
        handles = nodes.select(F.col("handle_len").alias("f"), F.col("handle_key").alias("f_key"), edge.alias("hit"))
        asked = asked.join(at_level, ["sid", "f"]).join(handles, ["f", "f_key"], "left")
        found = F.col("hit").isNotNull()
        asked = asked.select(
            "sid", "len", "key", "lo", "lo_key",
            F.when(found, F.col("hit.ext_len")).otherwise(F.col("low")).alias("low"),
            F.when(found, F.col("high")).otherwise(F.col("f") - 1).alias("high"),
            F.coalesce("hit", "v").alias("v"), "step",
        )
        rows = asked.unionByName(rows.filter(fat <= F.col("low")))
        rows = exchange.stored(rows.withColumn("step", F.col("step").cast("long") / 2), "trie-search")
        rows = rows.withColumn("step", F.col("step").cast("long"))
    return rows.drop("low", "high", "step")


def locate(pending: DataFrame, nodes: DataFrame, prefix: DataFrame, levels: int) -> DataFrame:
    """``pending`` with ``edge``, in which a conversation leaves the trie (null: at a node), and ``m``, ``m_key``, where."""
    rows = _search(pending, nodes, prefix, levels)
    rows = rows.withColumn("at_len", F.coalesce("v.ext_len", "lo"))
    rows = rows.join(_at(prefix, {"sid": "sid", "d": "at_len", "key": "at_key"}), ["sid", "at_len"], "left")
    passed = F.col("v").isNull() | F.coalesce(F.col("at_key") == F.col("v.ext_key"), F.lit(False))
    rows = rows.withColumn("passed", passed).withColumn("at", F.when(passed, F.coalesce("v.ext_len", "lo")))
    rows = rows.withColumn("at_key", F.when(F.col("v").isNull(), F.col("lo_key")).otherwise(F.col("v.ext_key")))
    # At a node: the child that goes on with the same turn, if there is one.
    rows = rows.withColumn("next", F.when(F.col("at") < F.col("len"), F.col("at") + 1))
    rows = rows.join(_at(prefix, {"sid": "sid", "d": "next", "key": "next_key"}), ["sid", "next"], "left")
    children = nodes.select(
        (F.col("par_len") + 1).alias("next"), F.col("first_key").alias("next_key"),
        F.struct("ext_len", "ext_key", "par_len", "par_key", "rep").alias("child"),
    )
    rows = rows.join(children, ["next", "next_key"], "left")
    rows = rows.withColumn("edge", F.when(F.col("passed"), F.col("child")).otherwise(F.col("v")))
    rows = exchange.stored(rows.select("sid", "len", "key", "edge", "at", "at_key"), "trie-edges")
    # In an edge: how far the turns of the edge's conversation are the same.
    inside = rows.filter(F.col("edge").isNotNull()).join(prefix.select("sid", "d", F.col("key").alias("d_key")), "sid")
    inside = inside.filter((F.col("d") > F.col("edge.par_len")) & (F.col("d") <= F.col("edge.ext_len")))
    inside = inside.select("sid", F.col("edge.rep").alias("rep"), "d", "d_key")
    same = inside.join(_at(prefix, {"sid": "rep", "d": "d", "key": "d_key"}), ["rep", "d", "d_key"])
    reach = same.groupBy("sid").agg(F.max(F.struct("d", "d_key")).alias("reach"))
    rows = rows.join(reach, "sid", "left")
    return rows.select(
        "sid", "len", "key", "edge",
        F.coalesce("reach.d", "at").alias("m"),
        F.when(F.col("reach").isNull(), F.col("at_key")).otherwise(F.col("reach.d_key")).alias("m_key"),
    )


def _complete(nodes: DataFrame, prefix: DataFrame) -> DataFrame:
    """``nodes`` (ext, par and rep) with the key of their first turn and their handle."""
    rows = nodes.withColumn("first_len", F.col("par_len") + 1).withColumn("handle_len", two_fattest(F.col("par_len"), F.col("ext_len")))
    rows = rows.join(_at(prefix, {"sid": "rep", "d": "first_len", "key": "first_key"}), ["rep", "first_len"])
    rows = rows.join(_at(prefix, {"sid": "rep", "d": "handle_len", "key": "handle_key"}), ["rep", "handle_len"])
    return rows.select(*NODE)


def insert(exits: DataFrame, nodes: DataFrame, prefix: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes after a batch of located conversations (stored), and those that wait for the next."""
    splits = exits.filter(F.col("edge").isNotNull() & (F.col("m") < F.col("edge.ext_len")))
    splits = splits.groupBy("edge", "m", "m_key").agg(F.lit(1).alias("one")).drop("one")
    split_edges = splits.select("edge").distinct()
    ends = split_edges.select("edge", F.col("edge.ext_len").alias("m"), F.col("edge.ext_key").alias("m_key"))
    # The pieces of one edge, as many as depths at which conversations leave it.
    upward = Window.partitionBy("edge.ext_len", "edge.ext_key").orderBy("m")
    above = F.lag(F.struct("m", "m_key")).over(upward)
    pieces = splits.unionByName(ends).withColumn("above", above).select(
        F.col("m").alias("ext_len"), F.col("m_key").alias("ext_key"),
        F.coalesce("above.m", "edge.par_len").alias("par_len"), F.coalesce("above.m_key", "edge.par_key").alias("par_key"),
        F.col("edge.rep").alias("rep"),
    )
    going = exits.filter(F.col("m") < F.col("len")).withColumn("next", F.col("m") + 1)
    going = going.join(_at(prefix, {"sid": "sid", "d": "next", "key": "next_key"}), ["sid", "next"])
    pick = F.min(F.struct(F.xxhash64("sid").alias("hash"), "sid", "len", "key")).alias("pick")
    picked = going.groupBy("m", "m_key", "next_key").agg(pick)
    leaves = picked.select(
        F.col("pick.len").alias("ext_len"), F.col("pick.key").alias("ext_key"), F.col("m").alias("par_len"),
        F.col("m_key").alias("par_key"), F.col("pick.sid").alias("rep"),
    )
    kept = nodes.join(split_edges.select("edge.ext_len", "edge.ext_key"), ["ext_len", "ext_key"], "left_anti")
    grown = kept.select(*NODE).unionByName(_complete(pieces.unionByName(leaves), prefix))
    waiting = going.join(picked.select(F.col("pick.sid").alias("sid")), "sid", "left_anti")
    return grown, waiting.select("sid", "len", "key", F.col("m").alias("lo"), F.col("m_key").alias("lo_key"))


def build(strings: DataFrame, prefix: DataFrame) -> DataFrame:
    """The compacted nodes of ``strings`` (sid, len, key), distinct conversations with stored prefixes."""
    spark = strings.sparkSession
    rep, longest = strings.agg(F.min("sid"), F.max("len")).first()
    if rep is None:
        return spark.createDataFrame([], "ext_len long, ext_key binary, par_len long, par_key binary, rep long, first_key binary, handle_len long, handle_key binary")
    top = [(0, ROOT, -1, b"", rep, b"", 0, b"")]
    nodes = spark.createDataFrame(top, "ext_len long, ext_key binary, par_len long, par_key binary, rep long, first_key binary, handle_len long, handle_key binary")
    nodes = exchange.stored(nodes, "trie-nodes")
    pending = strings.filter("len > 0").select("sid", "len", "key", F.lit(0).cast("long").alias("lo"), F.lit(ROOT).alias("lo_key"))
    levels = -1  # the root alone has no handle to look for
    while not pending.isEmpty():
        exits = exchange.stored(locate(pending, nodes, prefix, levels), "trie-exits")
        levels = int(math.log2(max(1, longest)))
        grown, waiting = insert(exits, nodes, prefix)
        nodes, pending = exchange.stored(grown, "trie-nodes"), exchange.stored(waiting, "trie-pending")
    return nodes


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the sorted ids of each distinct conversation, ids one by one."""
    now, state, done = None, None, []
    for batch in batches:
        for sid, member in zip(batch.column("sid").to_pylist(), batch.column("member").to_pylist()):
            if sid != now:
                if state is not None:
                    done.append((now, state.hexdigest()))
                now, state = sid, hashlib.sha256(str(member).encode())
            else:
                state.update(b",%d" % member)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["sid", "digest"])
            done = []
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([state.hexdigest()])], ["sid", "digest"])


def members_digest(members: DataFrame) -> DataFrame:
    """(sid, digest) for (sid, member): of a conversation's own id where it is alone, else of all in order."""
    rows = members.repartition("sid").sortWithinPartitions("sid", "member")
    return rows.select("sid", "member").mapInArrow(_digests, "sid long, digest string")


def _measured(nodes: DataFrame, path: DataFrame, strings: DataFrame, prefix: DataFrame) -> DataFrame:
    """``nodes`` with members, children, leaves, their edge's weight and their subtree's."""
    on_path = path.join(nodes.select(F.col("ext_len").alias("d"), F.col("ext_key").alias("key"), "rep"), ["d", "key"])
    on_path = exchange.stored(on_path.select("sid", "d", "key", "rep"), "trie-paths")
    counted = on_path.join(strings.select("sid", "members"), "sid").groupBy("d", "key").agg(
        F.sum("members").alias("n_convs"), F.min("sid").alias("conv_id")
    )
    counted = counted.withColumnsRenamed({"d": "ext_len", "key": "ext_key"})
    children = nodes.groupBy(F.col("par_len").alias("ext_len"), F.col("par_key").alias("ext_key")).agg(F.count(F.lit(1)).alias("n_children"))
    rows = nodes.join(counted, ["ext_len", "ext_key"]).join(children, ["ext_len", "ext_key"], "left")
    rows = rows.join(_at(prefix, {"sid": "rep", "d": "ext_len", "cum": "ext_cum"}), ["rep", "ext_len"])
    rows = rows.join(_at(prefix, {"sid": "rep", "d": "par_len", "cum": "par_cum"}), ["rep", "par_len"], "left")
    weight = (F.col("n_convs") - 1) * (F.col("ext_cum") - F.coalesce("par_cum", F.lit(0)))
    rows = rows.withColumn("n_children", F.coalesce("n_children", F.lit(0))).withColumn("weight", weight)
    rows = exchange.stored(rows.select("ext_len", "ext_key", "par_len", "par_key", "rep", "n_convs", "conv_id", "n_children", "ext_cum", "weight"), "trie-counted")
    # Each edge is counted once, on the path of its own conversation, for all nodes above it.
    own = on_path.join(rows.select(F.col("ext_len").alias("d"), F.col("ext_key").alias("key"), "weight", "n_children"), ["d", "key"])
    below = Window.partitionBy("sid").orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, 0)
    mine = F.when(F.col("rep") == F.col("sid"), F.col("weight")).otherwise(0)
    sums = own.select("d", "key", F.sum(mine).over(below).alias("saved"), F.sum((F.col("n_children") == 0).cast("long")).over(below).alias("leaves"))
    sums = sums.groupBy(F.col("d").alias("ext_len"), F.col("key").alias("ext_key")).agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("n_leaves"))
    parents = rows.select(F.col("ext_len").alias("par_len"), F.col("ext_key").alias("par_key"), F.col("conv_id").alias("above"))
    return rows.join(sums, ["ext_len", "ext_key"]).join(parents, ["par_len", "par_key"], "left")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row for each distinct sequence of first turns of the rebuilt conversations, the empty one too.

    Columns: conv_id (least member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256. Turns go by ``turn``, null first, equal
    ones by a digest of role and text; null roles and texts are empty; a repeated
    row is a turn of its own; rows of a null ``conv_id`` belong to no conversation
    and are left out; other columns are ignored; an empty table gives an empty one.
    """
    own = exchange.stored(turns(conversations), "trie-turns")
    prefix = exchange.stored(prefixes(rebuilt(own)), "trie-prefixes")
    ends = prefix.filter("last").select("sid", F.col("d").alias("len"), "key")
    strings = ends.groupBy("len", "key").agg(F.min("sid").alias("sid"), F.count(F.lit(1)).alias("members"))
    strings = exchange.stored(strings, "trie-strings")
    members = ends.withColumnRenamed("sid", "member").join(strings.select("sid", "len", "key"), ["len", "key"])
    digests = members_digest(members.select("sid", "member"))
    path = exchange.stored(prefix.join(strings.select("sid"), "sid", "left_semi").drop("last"), "trie-distinct")
    nodes = build(strings, path)
    measured = _measured(nodes, path, strings, path)
    end_digest = digests.join(strings.select("sid", F.col("len").alias("ext_len"), F.col("key").alias("ext_key")), "sid").drop("sid")
    measured = exchange.stored(measured.join(end_digest, ["ext_len", "ext_key"], "left"), "trie-measured")
    # Every turn of an edge becomes a node: those of a path go with the next node at or below them.
    info = F.struct(*[c for c in measured.columns])
    at = measured.select(F.col("ext_len").alias("d"), F.col("ext_key").alias("key"), info.alias("at_node"))
    below = Window.partitionBy("sid").orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, 0)
    rows = path.join(at, ["d", "key"], "left").withColumn("v", F.last("at_node", ignorenulls=True).over(below))
    rows = rows.filter(F.col("v.rep") == F.col("sid"))
    top, bottom = F.col("d") - 1 == F.col("v.par_len"), F.col("d") == F.col("v.ext_len")
    rest = (F.col("v.n_convs") - 1) * (F.col("v.ext_cum") - F.col("cum") + F.col("bytes"))
    return rows.select(
        F.col("v.conv_id").alias("conv_id"),
        F.col("d").alias("depth"),
        F.when(top, F.col("v.above")).otherwise(F.col("v.conv_id")).alias("parent_conv_id"),
        F.col("v.n_convs").alias("n_convs"),
        F.when(bottom, F.col("v.n_children")).otherwise(F.lit(1)).cast("long").alias("n_children"),
        F.col("v.n_leaves").alias("n_leaves"),
        (F.col("v.saved") - F.col("v.weight") + rest).cast("long").alias("saved_tokens"),
        F.coalesce(F.when(bottom, F.col("v.digest")), F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
