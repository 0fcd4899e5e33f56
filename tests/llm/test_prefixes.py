"""The prefix trie of conversations against one built from all prefixes in Python."""

import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from editpulse.llm import prefixes
from editpulse.llm.prefixes import conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string, d long, key string, n int, members int"


def digest(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, digest(role, text), (role, text)))
    own = {c: [t[-1] for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        first = conv - (conv % 5 if conv >= 0 else -(-conv % 5))
        rebuilt[conv] = tuple(own.get(first, [])[:h] + turns[h:])
    members, children = defaultdict(list), defaultdict(set)
    for conv, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(conv)
            if d:
                children[turns[: d - 1]].add(turns[:d])
    saved, leaves = defaultdict(int), defaultdict(int)
    for node, convs in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1].encode()) if node else 0
            leaves[node[:d]] += not children[node]
    result = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        result.append((min(convs), len(node), parent, len(convs), len(children[node]), leaves[node], saved[node], sha))
    return sorted(result, key=str)


def result(frame):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in conversation_trie(frame).select(*columns).collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", 2, 3) for r in rows], SCHEMA).repartition(3)


def test_random_conversations(spark):
    draw = random.Random(4)
    rows = []
    for conv in range(-6, 120):
        for turn in range(draw.choice([1, 2, 3, 9, 17, 33])):
            rows.append((conv, turn, draw.choice(["user", "bot"]), draw.choice("aé") * draw.choice([1, 3])))
    assert result(frame(spark, rows)) == brute(rows)


def test_edge_rows(spark):
    copies = [(c, t, "user", f"turn {t}") for c in range(100, 160) for t in range(12)]
    stairs = [(c, t, "u", "same" if t < c - 200 else f"own {c}") for c in range(200, 230) for t in range(31)]
    odd = [
        (None, 1, "user", "left out"), (5, None, None, None), (5, None, "a", "b"), (5, 0, "", ""), (5, 0, "", ""),
        (7, 3, "user", "ties"), (7, 3, "bot", "ties"), (7, 3, "bot", "ties"), (301, 1, "only", "turn"),
        (11, 0, "ab", "c"), (12, 0, "a", "bc"), (13, 0, "", None),
    ]
    rows = copies + stairs + odd + [(400, t, "u", "x" * (t % 3)) for t in range(700)]
    assert result(frame(spark, rows)) == brute(rows)


def test_empty_table(spark):
    assert conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert conversation_trie(spark.createDataFrame([(None, 1, "a", "b")], "conv_id long, turn long, role string, text string")).collect() == []


def test_nodes_are_found_by_their_handles(spark):
    """Every node's handle is at the fattest depth of its edge, and batches are few."""
    rows = [(10 * c, t, "u", str(t if t < c else (c, t))) for c in range(40) for t in range(40)]
    own = prefixes.turns(frame(spark, rows))
    found = prefixes.prefixes(prefixes.rebuilt(own)).cache()
    strings = found.filter("last").groupBy(F.col("d").alias("len"), "key").agg(F.min("sid").alias("sid"))
    batches = []
    inserted = prefixes.insert
    prefixes.insert = lambda *a: batches.append(1) or inserted(*a)
    try:
        nodes = prefixes.build(strings, found).collect()
    finally:
        prefixes.insert = inserted
    for node in nodes:
        if node.ext_len:
            depths = range(node.par_len + 1, node.ext_len + 1)
            assert node.handle_len == max(depths, key=lambda d: d & -d)
    assert len(batches) <= 6
