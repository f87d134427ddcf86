"""SimHash fingerprints and the groups they form, found through Gray-ordered hierarchical indexes."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millrace.llm.common import mapped, stored
from millrace.llm.components import components

SEED = 42
# Three rotations of the 64 bits put another third of them first.  Of at most RADIUS differing bits, one third holds
# at most RADIUS // 3 = 1, so a pair meets where the leading bits of one rotation differ in at most one place.
ROTATIONS = (0, 22, 43)
RADIUS = 4
MAX_PREFIX = 21
LEAVES = 1024      # aimed-at fingerprints under one shared prefix
SPLIT = 4096       # a prefix with more of them is divided by the bits behind it
FAN_OUT = 8        # children of a node
FRONTIER = 1 << 17  # (query, node) pairs looked at together; their children are eight times as many

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def simhash(text: str | None, width: int = 4) -> int:
    """The 64-bit fingerprint of a text's word shingles, repeats included (unsigned)."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    total, n = np.zeros(64, np.int64), len(words) - width + 1
    for at in range(0, n, 8192):
        until = min(at + 8192, n)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in
                           zip(starts[at:until].tolist(), ends[at + width - 1:until + width - 1].tolist())], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def with_simhash(docs: DataFrame, keys: list[str], text: str = "text", width: int = 4) -> DataFrame:
    """The ``keys`` columns and ``fingerprint`` (long: the 64 bits) of every whole text.

    Null and blank texts have fingerprint zero; a text of fewer than ``width``
    words has one shingle, all its words.
    """
    names = [f"k{i}" for i in range(len(keys))]
    source = docs.select(*(F.col(k).alias(n) for k, n in zip(keys, names)), F.col(text).alias("text"))
    kinds = dict(source.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([simhash(t.as_py(), width) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [pa.array(prints.view(np.int64))], [*names, "fingerprint"])

    schema = ", ".join([*(f"{n} {kinds[n]}" for n in names), "fingerprint bigint"])
    return mapped(source, run, schema).toDF(*keys, "fingerprint")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each 64-bit word in Gray-code order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """A static hierarchical index of fingerprints.

    Leaves stand in Gray order, so neighbours share most bits.  A node covers
    FAN_OUT children and keeps the bits all of them agree on; what a parent
    holds is not looked at again below it.  A search adds up the differences on
    the way down and leaves a whole subtree once they exceed the radius.
    """

    def __init__(self, codes: np.ndarray):
        self.leaves = codes[np.argsort(gray_rank(codes), kind="stable")]
        ones, zeros = [self.leaves], [~self.leaves]
        while len(ones[-1]) > FAN_OUT:
            starts = np.arange(0, len(ones[-1]), FAN_OUT)
            ones.append(np.bitwise_and.reduceat(ones[-1], starts))
            zeros.append(np.bitwise_and.reduceat(zeros[-1], starts))
        shared = [a | b for a, b in zip(ones, zeros)]
        # Own bits of a node: those it agrees on and its parent does not.
        self.own = [s & ~np.repeat(up, FAN_OUT)[:len(s)] for s, up in zip(shared, shared[1:])] + [shared[-1]]
        self.pattern = ones

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query number, leaf number) of every pair within ``radius``, in blocks."""
        top = len(self.own) - 1
        step = max(1, FRONTIER // max(1, len(self.own[top])) // FAN_OUT)
        for at in range(0, len(queries), step):
            block = queries[at:at + step]
            stack = [(top, np.repeat(np.arange(len(block)), len(self.own[top])),
                      np.tile(np.arange(len(self.own[top])), len(block)),
                      np.zeros(len(block) * len(self.own[top]), np.uint8))]
            while stack:
                level, query, node, known = stack.pop()
                if len(query) > FRONTIER:  # depth first in halves, so that memory stays bounded
                    half = len(query) // 2
                    stack += [(level, query[:half], node[:half], known[:half]),
                              (level, query[half:], node[half:], known[half:])]
                    continue
                differ = (block[query] ^ self.pattern[level][node]) & self.own[level][node]
                known = known + np.bitwise_count(differ)
                kept = np.flatnonzero(known <= radius)
                query, node, known = query[kept], node[kept], known[kept]
                if level == 0:
                    if len(query):
                        yield query + at, node
                    continue
                child = (node[:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
                inside = np.flatnonzero(child < len(self.own[level - 1]))
                stack.append((level - 1, np.repeat(query, FAN_OUT)[inside], child[inside],
                              np.repeat(known, FAN_OUT)[inside]))


def _lowest_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``labels`` after joining the classes of every pair (a, b)."""
    while True:
        low = np.minimum(labels[a], labels[b])
        new = labels.copy()
        np.minimum.at(new, labels[a], low)
        np.minimum.at(new, labels[b], low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        new = new[labels]
        if np.array_equal(new, labels):
            return labels
        labels = new


def spanning_links(leaves: np.ndarray, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same fingerprints as all pairs (query, leaf) within ``radius`` do; fewer than fingerprints."""
    index = GrayIndex(leaves)
    nodes, place = np.unique(np.concatenate([index.leaves, queries]), return_inverse=True)
    labels = np.arange(len(nodes))
    for query, leaf in index.search(queries, radius):
        a, b = place[len(leaves):][query], place[:len(leaves)][leaf]
        apart = labels[a] != labels[b]
        if apart.any():
            labels = _lowest_labels(labels, a[apart], b[apart])
    joined = np.flatnonzero(labels != np.arange(len(nodes)))
    return nodes[joined], nodes[labels[joined]]


def _rotated(code: Column, by: int) -> Column:
    return code if by == 0 else F.shiftleft(code, by).bitwiseOR(F.shiftrightunsigned(code, 64 - by))


def _asked(node: Column, bits: int) -> Column:
    """The nodes that a fingerprint under ``node`` asks: its own and those with one more bit set."""
    up = [F.when(F.shiftrightunsigned(node, i).bitwiseAND(F.lit(1)) == 0, node.bitwiseOR(F.lit(1 << i)))
          for i in range(bits)]
    return F.array_compact(F.array(node, *up))


def _pieces(code: Column, bits: int, radius: int) -> Column:
    """What follows the ``bits`` leading bits, in ``radius`` + 1 pieces (piece, bits): near fingerprints share one."""
    cuts = [round((64 - bits) * i / (radius + 1)) for i in range(radius + 2)]
    return F.array(*(F.struct(F.lit(i).alias("piece"),
                              F.shiftrightunsigned(code, lo).bitwiseAND(F.lit((1 << hi - lo) - 1)).alias("held"))
                     for i, (lo, hi) in enumerate(zip(cuts, cuts[1:]))))


def routed(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(turn, node, piece, held, p, q, code, leaf, asks): fingerprints dealt into indexes of bounded size.

    Shuffle keys are the top nodes of three Gray-ordered indexes (the leading
    bits of each rotation); a fingerprint asks its own node and those one set
    bit away.  A node of over SPLIT leaves is divided by what follows the
    leading bits: of radius + 1 pieces, two near fingerprints share one.  What
    still has over SPLIT leaves is dealt in tiles, every part of its leaves with
    every part of its askers; so are the many askers that a node gets from hot
    neighbours.
    """
    bits = min(MAX_PREFIX, max(1, math.ceil(math.log2(max(2, prints.count()) / LEAVES))))
    most = SPLIT * (MAX_PREFIX + 1)  # askers of a tile: nodes that are not hot send no more than this in all
    entries = prints.select(F.posexplode(F.array(*(_rotated(F.col("fingerprint"), r) for r in ROTATIONS)))
                            .alias("turn", "code"))
    entries = entries.withColumn("node", F.shiftrightunsigned("code", 64 - bits))
    hot = stored(entries.groupBy("turn", "node").agg(F.count("*").alias("n")).filter(F.col("n") > SPLIT))
    divided = (entries.join(hot.select("turn", "node"), ["turn", "node"], "left_semi")
               .select("turn", "node", F.inline(_pieces(F.col("code"), bits, radius)))
               .groupBy("turn", "node", "piece", "held").agg(F.count("*").alias("n")).filter(F.col("n") > SPLIT))
    whole = F.array(F.struct(F.lit(-1).alias("piece"), F.lit(0).cast("bigint").alias("held")))
    counted = stored(hot.select("turn", "node", F.inline(whole), "n").unionByName(divided))
    place = ["turn", "node", "piece", "held"]
    tiles = stored(counted.select(*place, "n", F.lit(0).cast("bigint").alias("m"))
                   .unionByName(counted.withColumn("node", F.explode(_asked(F.col("node"), bits)))
                                .select(*place, F.lit(0).cast("bigint").alias("n"), F.col("n").alias("m")))
                   .groupBy(*place).agg(F.ceil(F.sum("n") / SPLIT).alias("ps"), F.ceil(F.sum("m") / most).alias("qs")))
    asked = (entries.withColumn("to", F.explode(_asked(F.col("node"), bits)))
             .select("turn", F.col("to").alias("node"), "code", (F.col("to") == F.col("node")).alias("own"))
             .join(hot.select("turn", "node", F.lit(True).alias("hot")), ["turn", "node"], "left")
             .select("turn", "node", "code", "own",
                     F.inline(F.when(F.col("hot"), _pieces(F.col("code"), bits, radius)).otherwise(whole))))
    ps, qs = (F.greatest(F.coalesce(c, F.lit(1)), F.lit(1)) for c in ("ps", "qs"))
    p, q = F.pmod(F.xxhash64("code"), ps), F.pmod(F.xxhash64("code"), qs)

    def cell(p: Column, q: Column, leaf: Column, asks: Column) -> Column:
        return F.struct(p.alias("p"), q.alias("q"), leaf.alias("leaf"), asks.alias("asks"))

    zero, yes, no = F.lit(0).cast("bigint"), F.lit(True), F.lit(False)
    elsewhere = F.filter(F.sequence(zero, ps - 1), lambda i: ~F.col("own") | (i != p))
    asking = F.transform(elsewhere, lambda i: cell(i, q, no, yes))
    standing = F.transform(F.sequence(zero, qs - 1), lambda i: cell(p, i, yes, i == q))
    return (asked.join(tiles, place, "left")
            .select(*place, "code", F.inline(F.when(F.col("own"), F.concat(asking, standing)).otherwise(asking))))


def near_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints which chains of pairs within ``radius`` bits connect.

    ``prints`` has one long column ``fingerprint`` of distinct values.  ``routed``
    deals them into indexes; every index returns a spanning forest, never all pairs.
    """
    if radius // len(ROTATIONS) > 1:
        raise ValueError("the routing is for a radius of at most 5 bits")

    def search(group: pa.Table) -> pa.Table:
        codes = group.column("code").to_numpy().view(np.uint64)
        leaf, asks = (group.column(c).to_numpy(zero_copy_only=False) for c in ("leaf", "asks"))
        turn = np.uint64(ROTATIONS[group.column("turn")[0].as_py()])
        if not leaf.any():
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        a, b = spanning_links(codes[leaf], codes[asks], radius)
        if turn:
            a, b = (x >> turn | x << (np.uint64(64) - turn) for x in (a, b))
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return (routed(prints, radius).groupBy("turn", "node", "piece", "held", "p", "q")
            .applyInArrow(search, "a bigint, b bigint").distinct())


def near_groups(prints: DataFrame, key: str, radius: int = RADIUS) -> DataFrame:
    """(fingerprint, first, group): every distinct fingerprint with the smallest ``key`` in its group, and the group.

    Groups are the connected components of fingerprints at ``radius`` or fewer
    differing bits.  Null keys are passed over.  An empty table gives no rows.
    """
    known = stored(prints.groupBy("fingerprint").agg(F.min(key).alias("first")))
    roots = components(near_links(known.select("fingerprint"), radius), "a", "b")
    member = known.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left") \
        .withColumn("root", F.coalesce("root", "fingerprint"))
    first = member.groupBy("root").agg(F.min("first").alias("first"))
    return stored(member.select("fingerprint", "root").join(first, "root")
                  .select("fingerprint", "first", F.col("root").alias("group")))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per document: ``key``, ``fingerprint`` (long) and ``component_id``, the smallest key it can reach.

    Every row of ``docs`` gives a row: repeated rows share everything, a null
    key keeps its row, null and blank texts have fingerprint zero and link like
    any other.  Other columns play no part.
    """
    return grouped(docs, key, text, radius).drop("group")


def grouped(docs: DataFrame, key: str, text: str, radius: int) -> DataFrame:
    """``near_duplicates`` with a column ``group``: two groups may share their smallest key."""
    prints = stored(with_simhash(docs, [key], text))
    groups = near_groups(prints, key, radius).withColumnRenamed("first", "component_id")
    return prints.join(groups, "fingerprint").select(key, "fingerprint", "component_id", "group")


def _with_fingerprint(docs: DataFrame, text: str, fingerprint: Callable[[str | None], int], name: str) -> DataFrame:
    """``docs`` with a last column ``name``: the fingerprint (signed) of each row's text."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array([fingerprint(t.as_py()) for t in batch.column(at)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, prints], [*batch.schema.names, name])

    return mapped(docs, run, StructType([*docs.schema.fields, StructField(name, LongType())]))


def keep_one(docs: DataFrame, found: DataFrame, key: str, text: str,
             fingerprint: Callable[[str | None], int]) -> DataFrame:
    """``docs`` with one row of each group of ``found`` (key, fingerprint, component_id, group), and rows without a key.

    A group's row has the smallest key.  A key may have several texts, each in a
    group of its own: the row is the one with the group's fingerprint.
    """
    named = docs.filter(F.col(key).isNotNull())
    texts = found.groupBy(key).agg(F.count("*").alias("n"), F.count_distinct("fingerprint").alias("texts"))
    heads = (found.filter(F.col(key) == F.col("component_id")).groupBy(key, "group")
             .agg(F.min("fingerprint").alias("fingerprint")))
    kept = stored(heads.join(texts, key))
    # The keys are the narrow side: hashing them spares sorting the texts.  Only repeated keys need their rows compared.
    once, more = (kept.filter(f"texts = 1 and {c}").select(key).hint("shuffle_hash") for c in ("n = 1", "n > 1"))
    several = kept.filter("texts > 1").select(key, F.col("fingerprint").alias("_print"))
    printed = _with_fingerprint(named.join(several.select(key).distinct(), key, "left_semi"), text, fingerprint, "_print")
    return (named.join(once, key, "left_semi")
            .unionByName(named.join(more, key, "left_semi").dropDuplicates([key]))
            .unionByName(printed.join(several, [key, "_print"], "left_semi").dropDuplicates([key, "_print"]).drop("_print"))
            .unionByName(docs.filter(F.col(key).isNull())))


def one_per_group(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the smallest key, and one row of it.

    A row without a key cannot be named as a group's document; such rows stay as they are.
    """
    named = docs.filter(F.col(key).isNotNull())
    found = grouped(named, key, text, radius)
    return keep_one(docs, found, key, text, lambda t: int(np.uint64(simhash(t)).view(np.int64)))
