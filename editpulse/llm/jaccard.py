"""Jaccard join of documents on word n-grams, by grouped prefixes.

Shingles are ordered by how many documents hold them, rarest first. Documents
whose similarity reaches the threshold share a shingle among the first of this
order, so only prefixes are joined. Documents of the same set of shingles are
one class before that, and classes of the same prefix and size are one group:
groups are paired over their prefix shingles and filtered by size and position,
then their members are taken out and verified on whole sets.

The order needs the count of every shingle, and a document needs it back. Blocks
of documents send each shard their distinct shingles, and get a byte for each.

A shingle in the prefixes of few documents has its pairs written out. One of
many has them verified in place: its documents fall into tiles, every two tiles
meet in one task, and only links come out (of these a spanning forest, and how
many links each document has), never all pairs of a group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editpulse.llm import exchange, text as tx
from editpulse.llm.exchange import LAST_ID
from editpulse.llm.graph import components
from editpulse.llm.text import U64

BLOCK_BYTES = 4 << 20
FEW = 32  # documents under a shingle whose pairs are written out
TILE = 512

_SENT = "shard int, block int, kind int, keys binary, extra binary"
_ANSWER = "block int, shard int, kind int, extra binary"
_DOCS = (
    "id long, n_shingles long, class_id long, leads boolean, group_key long, "
    "tokens binary, places binary, shingles binary"
)


def jaccard_join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 3,
    percent: int = 90,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Components of documents whose shingle sets have a Jaccard of ``percent`` or more.

    Texts are lower-cased in ASCII and cut into words at space and the control
    bytes 9 to 13; a set holds each distinct run of ``words`` words, or of a
    shorter text the whole of it. Returns ``id_col``, ``n_shingles``,
    ``component_id`` (the least id reachable by links, its own included) and
    ``n_links`` (documents linked directly).

    A text without words, or null, has an empty set and no link. A row without
    id has no link and a null component. Rows of one id are one document for
    components, each gets its row, and two that are linked count as a link.
    Other columns are ignored, an empty table gives an empty one. Equal hashes
    of 64 bits count as equal shingles.
    """
    n = exchange.parts(docs, text_col, block_bytes)
    rows = exchange.blocks(docs, id_col, text_col, n)
    sent = rows.groupBy("block").applyInArrow(_send(words, n), _SENT)
    answers = sent.groupBy("shard").applyInArrow(_ranks, _ANSWER)
    found = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_prefixes(words, percent, n), _DOCS)
    found = exchange.stored(found, "jaccard-sets")

    sizes = found.filter("n_shingles > 0 and id is not null").groupBy("class_id").agg(F.count("*").alias("copies"))
    members = found.filter("leads").select("id", "n_shingles", "group_key", "tokens", "places", "shingles")
    members = members.join(sizes.withColumnRenamed("class_id", "id"), "id")
    members = exchange.stored(members, "jaccard-members")
    edges, counts = _links(members, percent)
    parts = components(edges).withColumnRenamed("component", "least")
    counts = counts.groupBy("id").agg(F.sum("links").alias("links"))
    result = (
        found.join(sizes, "class_id", "left")
        .join(parts, F.col("class_id") == F.col("node"), "left")
        .join(counts.withColumnRenamed("id", "counted"), F.col("class_id") == F.col("counted"), "left")
    )
    return result.select(
        F.col("id").alias(id_col),
        "n_shingles",
        F.coalesce("least", "class_id").alias("component_id"),
        (F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))).alias("n_links"),
    )


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """``docs`` without those that have a smaller id in their component.

    Rows of one id and text count as one document, of which one row stays; those
    of one id with other texts are documents after all others. Rows without words
    or without id all stay.
    """
    id_, row = F.col(id_col).cast("long"), F.xxhash64(text_col)
    several = docs.filter(id_.isNotNull()).groupBy(id_.alias("_id")).agg(F.min(row).alias("_row"), F.max(row).alias("_other"))
    several = exchange.stored(several.filter("_row <> _other").select("_id", "_row"), "jaccard-several")
    # The first text of an id keeps it; others get a number from 1 << 62 on.
    number = F.shiftrightunsigned(F.xxhash64(id_, text_col), 2).bitwiseOR(F.lit(1 << 62))
    keyed = docs.join(several, id_ == F.col("_id"), "left")
    keyed = keyed.withColumn("_key", F.when(row != F.col("_row"), number).otherwise(id_)).select(*docs.columns, "_key")
    found = jaccard_join(keyed, "_key", text_col, words, percent)
    gone = found.filter("n_shingles > 0").groupBy("_key").agg(F.min("component_id").alias("component"))
    keep = gone.filter("_key = component").select("_key")
    bare = keyed.join(gone.select("_key"), "_key", "left_anti")
    whole = keyed.join(keep, "_key", "left_semi").dropDuplicates(["_key"])
    return whole.unionByName(bare).select(*docs.columns)


class _Sets:
    """Shingle sets of the documents of one block: rows by document and hash."""

    def __init__(self, table: pa.Table, words: int, shards: int):
        data, starts = tx.texts(table["text"])
        found = tx.words(data, starts, tx.NON_SPACE, tx.LOWER)
        self.n = table.num_rows
        counts = found.counts(self.n)
        first = np.cumsum(counts) - counts
        hashes = tx.windows(found.hash, words)
        whole = found.doc[: len(hashes)] == found.doc[words - 1 :][: len(hashes)]
        doc, keys = [found.doc[: len(hashes)][whole]], [tx.mix(hashes[whole])]
        for length in range(1, words):  # texts too short for one shingle
            short = np.flatnonzero(counts == length)
            if len(short):
                doc.append(short)
                keys.append(tx.mix(tx.windows(found.hash, length)[first[short]] ^ U64(length)))
        doc, keys = np.concatenate(doc), np.concatenate(keys)
        order = np.lexsort((keys, doc))
        doc, keys = doc[order], keys[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (keys[1:] != keys[:-1])
        self.doc, self.keys = doc[new], keys[new]
        self.sizes = np.bincount(self.doc, minlength=self.n)
        self.ids = exchange.ids_of(table)
        self.shards = shards
        # What a shard sees of a shingle: its low 32 bits, enough for an order.
        self.short = (((self.keys >> U64(32)) * U64(shards) >> U64(32)) << U64(32)) | (self.keys & U64(0xFFFFFFFF))
        self.kinds, self.times = np.unique(self.short, return_counts=True)
        self.edges = np.searchsorted(self.kinds >> U64(32), np.arange(shards + 1, dtype=U64))

    def classes(self):
        """Distinct sets of the block with their least id: hash, id; and which each row has."""
        ends = np.cumsum(self.sizes)
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(tx.mix(self.keys ^ U64(0x2545F4914F6CDD1D)))])
        prints = tx.mix((sums[ends] - sums[ends - self.sizes]) ^ (self.sizes.astype(U64) << U64(32)))
        use = np.flatnonzero((self.sizes > 0) & (self.ids != LAST_ID))
        order = use[np.lexsort((self.ids[use], prints[use]))]
        new = np.ones(len(order), bool)
        new[1:] = prints[order][1:] != prints[order][:-1]
        of = np.full(self.n, -1)
        of[order] = np.cumsum(new) - 1
        first = order[new]
        return prints[first], self.ids[first], first, of


def _send(words: int, shards: int):
    def send(table: pa.Table) -> pa.Table:
        block = _Sets(table, words, shards)
        out = {"shard": [], "kind": [], "keys": [], "extra": []}
        low = (block.kinds & U64(0xFFFFFFFF)).astype(np.uint32)
        times = np.minimum(block.times, 255).astype(np.uint8)
        prints, ids, _, _ = block.classes()
        edges = exchange.shard_edges(prints, shards)
        for kind, cuts, keys, extra in ((0, block.edges, low, times), (1, edges, prints, ids)):
            for shard in np.flatnonzero(np.diff(cuts)):
                share = slice(cuts[shard], cuts[shard + 1])
                out["shard"].append(int(shard))
                out["kind"].append(kind)
                out["keys"].append(keys[share].tobytes())
                out["extra"].append(extra[share].tobytes() if kind == 0 else exchange.narrow(extra[share]))
        number = table["block"][0].as_py()
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
        columns = {name: pa.array(values, kind) for (name, values), kind in zip(out.items(), kinds)}
        columns["block"] = pa.array([number] * len(out["shard"]), pa.int32())
        return pa.table(columns).select(["shard", "block", "kind", "keys", "extra"])

    return send


def _ranks(table: pa.Table) -> pa.Table:
    """A byte that grows with the count of each shingle, 0 for one; least ids of sets."""
    kinds = table["kind"].combine_chunks().to_numpy(zero_copy_only=False)
    answers: list[bytes] = [b""] * table.num_rows
    for kind, dtype in ((0, np.uint32), (1, U64)):
        rows = np.flatnonzero(kinds == kind)
        if not len(rows):
            continue
        part = table.take(pa.array(rows))
        keys = [np.frombuffer(x, dtype) for x in part["keys"].to_pylist()]
        cuts = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
        keys = np.concatenate(keys)
        distinct, of = np.unique(keys, return_inverse=True)
        if kind == 0:
            times = np.concatenate([np.frombuffer(x, np.uint8) for x in part["extra"].to_pylist()])
            total = np.bincount(of, weights=times)
            values = np.minimum(np.where(total > 1, 1 + 8 * np.log2(np.maximum(total, 1)), 0), 255).astype(np.uint8)[of]
        else:
            ids = np.concatenate([exchange.widen(x) for x in part["extra"].to_pylist()])
            least = np.full(len(distinct), LAST_ID)
            np.minimum.at(least, of, ids)
            values = least[of]
        for i, row in enumerate(rows):
            share = values[cuts[i] : cuts[i + 1]]
            answers[row] = share.tobytes() if kind == 0 else exchange.narrow(share)
    return pa.table(
        {
            "block": table["block"].cast(pa.int32()),
            "shard": table["shard"].cast(pa.int32()),
            "kind": table["kind"].cast(pa.int32()),
            "extra": pa.array(answers, pa.binary()),
        }
    )


def least_overlap(size, percent: int):
    """Shingles that a set of this size shares at least with any linked one."""
    return -(-size * percent // 100)


def _prefixes(words: int, percent: int, shards: int):
    def prefixes(table: pa.Table, answers: pa.Table) -> pa.Table:
        block = _Sets(table, words, shards)
        prints, least, first, of = block.classes()
        rank = np.zeros(len(block.kinds), np.uint8)
        cuts = exchange.shard_edges(prints, shards)
        for shard, kind, packed in zip(*(answers[name].to_pylist() for name in ("shard", "kind", "extra"))):
            if kind == 0:
                rank[block.edges[shard] : block.edges[shard + 1]] = np.frombuffer(packed, np.uint8)
            else:
                least[cuts[shard] : cuts[shard + 1]] = exchange.widen(packed)
        class_id = np.where(of >= 0, least[of] if len(least) else LAST_ID, block.ids)
        leads = np.zeros(block.n, bool)
        leads[first[block.ids[first] == least]] = True

        ranks = rank[np.searchsorted(block.kinds, block.short)]
        order = np.lexsort((block.keys, ranks, block.doc))
        keys, ranks = block.keys[order], ranks[order]
        starts = np.cumsum(block.sizes) - block.sizes
        place = np.arange(len(keys)) - starts[block.doc]
        length = np.where(block.sizes > 0, block.sizes - least_overlap(block.sizes, percent) + 1, 0)
        inside = place < length[block.doc]
        # A shingle that no other document has joins nothing.
        posted = inside & (ranks > 0)
        some = np.bincount(block.doc[posted], minlength=block.n) > 0
        leads &= some
        group = np.zeros(block.n, U64)
        np.add.at(group, block.doc[inside], tx.mix(keys[inside] ^ tx.mix(place[inside].astype(U64))))
        group = tx.mix(group ^ block.sizes.astype(U64))
        at = np.searchsorted(block.doc[posted], np.arange(block.n + 1))
        tokens, places = keys[posted], place[posted].astype(np.uint32)
        whole = np.append(starts, len(keys))

        def packed(values, cut):
            return pa.array(
                [values[cut[i] : cut[i + 1]].tobytes() if leads[i] else None for i in range(block.n)], pa.binary()
            )

        no_id = block.ids == LAST_ID
        return pa.table(
            {
                "id": table["id"],
                "n_shingles": pa.array(block.sizes.astype(np.int64)),
                "class_id": pa.array(class_id, pa.int64(), mask=no_id),
                "leads": pa.array(leads),
                "group_key": pa.array(group.view(np.int64)),
                "tokens": packed(tokens, at),
                "places": packed(places, at),
                "shingles": packed(keys, whole),
            }
        )

    return prefixes


def _links(members: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Edges that connect all linked classes, and the links of each class by copies."""
    spark = members.sparkSession
    groups = members.groupBy("group_key").agg(
        F.count("*").alias("members"),
        F.first("n_shingles").alias("size"),
        F.first("tokens").alias("tokens"),
        F.first("places").alias("places"),
    )
    postings = groups.mapInArrow(_postings, "token long, group_key long, members long, size long, place int")
    postings = exchange.stored(postings, "jaccard-postings")
    weight = postings.groupBy("token").agg(F.sum("members").alias("all"), F.count("*").alias("groups"))
    weight = weight.filter("all > 1")
    postings = exchange.stored(postings.join(weight, "token"), "jaccard-postings")

    few = postings.filter(F.col("all") <= FEW)
    shards = F.pmod(F.col("token"), F.lit(max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) * 4)))
    pairs = few.groupBy(shards.alias("shard")).applyInArrow(_pairs(percent), "x long, y long").distinct()
    sides = members.select("group_key", "id", "copies", "shingles")
    left = sides.toDF("x", "a", "copies_a", "shingles_a")
    right = sides.toDF("y", "b", "copies_b", "shingles_b")
    both = pairs.join(left, "x").join(right, "y").filter((F.col("x") != F.col("y")) | (F.col("a") < F.col("b")))
    both = both.select("a", "copies_a", "shingles_a", "b", "copies_b", "shingles_b")
    written = both.mapInArrow(_verified(percent), "a long, b long, copies_a long, copies_b long")
    written = exchange.stored(written, "jaccard-links")

    # The first shingle that two groups share, few before many, decides who verifies them.
    many = postings.filter(F.col("all") > FEW)
    others = postings.join(many.select("group_key").distinct(), "group_key", "left_semi").groupBy("group_key").agg(
        F.collect_list(F.struct((F.col("all") > FEW).alias("many"), "token")).alias("posted")
    )
    tiles = F.ceil(F.col("all") / TILE).cast("int")
    met = many.join(others, "group_key").join(members.select("group_key", "id", "copies", "shingles"), "group_key")
    met = met.withColumn("tiles", tiles).withColumn("own", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    earlier = F.filter("posted", lambda p: ~p["many"] | (p["token"] < F.col("token")))
    met = met.select(
        "token", "own", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"),
        "id", "copies", "shingles", F.transform(earlier, lambda p: p["token"]).alias("earlier"),
    )
    met = met.withColumn("first", F.least("own", "other")).withColumn("second", F.greatest("own", "other"))
    tiled = met.groupBy("token", "first", "second").applyInArrow(_tile(percent), "a long, b long, links long")
    tiled = exchange.stored(tiled, "jaccard-tiles")

    edges = written.select("a", "b").union(tiled.filter("b is not null").select("a", "b"))
    counts = written.select(F.col("a").alias("id"), F.col("copies_b").alias("links"))
    counts = counts.union(written.select("b", "copies_a")).union(tiled.filter("b is null").select("a", "links"))
    return edges, counts


def _postings(batches):
    for batch in batches:
        tokens = [np.frombuffer(x, np.int64) for x in batch.column("tokens").to_pylist()]
        places = [np.frombuffer(x, np.uint32) for x in batch.column("places").to_pylist()]
        if not tokens:
            continue
        row = pa.array(np.repeat(np.arange(len(tokens)), [len(t) for t in tokens]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(tokens)),
                *[batch.column(name).take(row) for name in ("group_key", "members", "size")],
                pa.array(np.concatenate(places).astype(np.int32)),
            ],
            ["token", "group_key", "members", "size", "place"],
        )


def _pairs(percent: int):
    """Pairs of groups under one shingle that sizes and places allow; a group with itself too."""

    def pairs(table: pa.Table) -> pa.Table:
        token, group, members, size, place = (
            table[name].to_numpy() for name in ("token", "group_key", "members", "size", "place")
        )
        order = np.argsort(token, kind="stable")
        token, group, members, size, place = (x[order] for x in (token, group, members, size, place))
        last = np.searchsorted(token, token, "right")
        found = [np.stack([group[members > 1], group[members > 1]])]
        index = np.arange(len(token))
        for step in range(1, FEW):
            a = index[index + step < last]
            if not len(a):
                break
            b = a + step
            small, large = np.minimum(size[a], size[b]), np.maximum(size[a], size[b])
            most = np.minimum(place[a], place[b]) + 1 + np.minimum(size[a] - place[a], size[b] - place[b]) - 1
            # Overlap at least percent of the union, that is of sizes less overlap.
            fits = (small * 100 >= large * percent) & (most * (100 + percent) >= percent * (small + large))
            a, b = a[fits], b[fits]
            found.append(np.stack([np.minimum(group[a], group[b]), np.maximum(group[a], group[b])]))
        both = np.unique(np.concatenate(found, axis=1), axis=1)
        return pa.table({"x": both[0], "y": both[1]})

    return pairs


def _verified(percent: int):
    def verify(batches):
        for batch in batches:
            left, right = (batch.column(f"shingles_{side}").to_pylist() for side in "ab")
            keep = []
            for i, (x, y) in enumerate(zip(left, right)):
                x, y = np.frombuffer(x, U64), np.frombuffer(y, U64)
                same = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * same >= percent * (len(x) + len(y) - same):
                    keep.append(i)
            part = batch.take(pa.array(keep, pa.int64()))
            yield part.select(["a", "b", "copies_a", "copies_b"])

    return verify


def _shared(rows: list[np.ndarray], cols: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many values each of ``rows`` shares with each of ``cols``, some columns at a time."""
    sizes = [len(x) for x in (*rows, *cols)]
    values = np.concatenate([*rows, *cols])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    column = np.cumsum(new) - 1
    often = np.bincount(column, minlength=1) > 1
    renumbered = np.cumsum(often) - 1
    use = often[column] if len(column) else np.zeros(0, bool)
    owner, column = owner[use], renumbered[column[use]]
    total = np.zeros((len(rows), len(cols)), np.float32)
    for a in range(0, int(often.sum()), width):
        lo, hi = np.searchsorted(column, [a, a + width])
        matrix = np.zeros((len(sizes), width), np.float32)
        matrix[owner[lo:hi], column[lo:hi] - a] = 1
        total += matrix[: len(rows)] @ matrix[len(rows) :].T
    return total


def _tile(percent: int):
    """Links between two tiles of the documents under one shingle."""

    def links(table: pa.Table) -> pa.Table:
        own, other = table["own"].to_numpy(), table["other"].to_numpy()
        ids, copies = table["id"].to_numpy(), table["copies"].to_numpy()
        sets = [np.frombuffer(x, U64) for x in table["shingles"].to_pylist()]
        earlier = [np.array(x, np.int64).view(U64) for x in table["earlier"].to_pylist()]
        within = bool((own == other).all())
        low = np.minimum(own, other).min()
        left = np.arange(len(ids)) if within else np.flatnonzero(own == low)
        right = left if within else np.flatnonzero(own != low)
        pick = lambda values, rows: [values[i] for i in rows]
        size = np.array([len(s) for s in sets], np.float64)
        same = _shared(pick(sets, left), pick(sets, right)).astype(np.float64)
        union = size[left][:, None] + size[right][None, :] - same
        linked = (100 * same >= percent * union) & (_shared(pick(earlier, left), pick(earlier, right)) == 0)
        linked &= ids[left][:, None] < ids[right][None, :] if within else ids[left][:, None] != ids[right][None, :]
        x, y = np.nonzero(linked)
        x, y = left[x], right[y]
        links = np.bincount(x, weights=copies[y], minlength=len(ids)) + np.bincount(y, weights=copies[x], minlength=len(ids))
        counted = np.flatnonzero(links)
        a, b = _forest(x, y, len(ids))
        none = pa.nulls(len(counted), pa.int64())
        return pa.table(
            {
                "a": pa.array(np.concatenate([ids[a], ids[counted]])),
                "b": pa.concat_arrays([pa.array(ids[b]), none]),
                "links": pa.array(np.concatenate([np.zeros(len(a), np.int64), links[counted].astype(np.int64)])),
            }
        )

    return links


def _forest(x: np.ndarray, y: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Enough of the edges to connect what all of them connect."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    kept = []
    for i, (a, b) in enumerate(zip(x.tolist(), y.tolist())):
        a, b = find(a), find(b)
        if a != b:
            root[a] = b
            kept.append(i)
    return x[kept], y[kept]
