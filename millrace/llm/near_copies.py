"""Groups of texts whose sets of word shingles are alike: SimHash fingerprints, Gray-ordered indexes, exact Jaccard.

Two sets with a Jaccard likeness of 0.8 differ in about ten bits of 64, far too
many for leading bits to bring them together (``simhash.near_links`` is for
five).  So MinHash bands decide which sets meet, a Gray-ordered index of their
SimHash fingerprints which of those are near, and their shingles which link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import mapped, scratch, stored
from millrace.llm.components import components
from millrace.llm.simhash import _LOWER, SEED, GrayIndex, gray_rank, keep_one

WIDTH = 5
LEAST = 0.8
# A pair at LEAST shares none of the bands with probability (1 - 0.8 ** 5) ** 30 = 7e-6.
BANDS, ROWS = 30, 5
# Differing bits of a pair at LEAST: 9.7 on average, with a standard deviation of 2.9.
RADIUS = 22
GROUP = 512        # sets of a cluster that are compared in one task, if their shingles are at most
SHINGLES = 1 << 21
TOGETHER = 1024    # sets of small clusters that share a task
BLOCK = 2048

_rng = np.random.default_rng(SEED)
_TIMES = _rng.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _rng.integers(0, 1 << 63, BANDS * ROWS, np.uint64)


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's word shingles; all words are one if they are fewer than ``width``."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in
                                  zip(starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist())), np.uint64))


def set_id(found: np.ndarray) -> int:
    """A 64-bit name (signed) of a set of shingles; zero for none."""
    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), SEED)).view(np.int64)) if len(found) else 0


def minima(found: np.ndarray) -> np.ndarray:
    """The least value of every hash function over a set of shingles."""
    low = np.full(BANDS * ROWS, (1 << 64) - 1, np.uint64)
    for at in range(0, len(found), BLOCK):
        np.minimum(low, (found[at:at + BLOCK, None] * _TIMES + _PLUS).min(axis=0), out=low)
    return low >> np.uint64(24)


def fingerprint_of(found: np.ndarray) -> int:
    """The 64-bit SimHash (signed) of a set of shingles: the bits that more than half of their hashes have."""
    total, n = np.zeros(64, np.int64), len(found)
    for at in range(0, n, BLOCK):
        bits = np.unpackbits(found[at:at + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<i8")[0]) if n else 0


def _printed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, fingerprint, bands) of every row: the name of its set of shingles and the hashes of its bands."""
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, bands = [], []
            for t in batch.column("text"):
                found = shingles(t.as_py())
                names.append(set_id(found))
                bands.append(np.array([xxhash.xxh64_intdigest(row.tobytes(), i) for i, row in
                                       enumerate(minima(found).reshape(BANDS, ROWS))], np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(names, pa.int64()),
                                              pa.array(bands, pa.list_(pa.int64()))], ["key", "fingerprint", "bands"])

    kind = dict(source.dtypes)["key"]
    return mapped(source, run, f"key {kind}, fingerprint bigint, bands array<bigint>")


def _sets(docs: DataFrame, text: str) -> DataFrame:
    """(fingerprint, code, n, grams): SimHash, size and shingles (32 bits of each) of every distinct set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_id(f) for f in found], pa.int64()), pa.array([fingerprint_of(f) for f in found], pa.int64()),
                 pa.array([len(f) for f in found], pa.int64()),
                 pa.array([f.astype(np.uint32).tobytes() for f in found], pa.binary())], ["fingerprint", "code", "n", "grams"])

    return mapped(docs.select(text), run, "fingerprint bigint, code bigint, n bigint, grams binary").dropDuplicates(["fingerprint"])


class _Classes:
    """Classes of the numbers 0..n-1 that are joined one pair at a time."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def roots(self) -> np.ndarray:
        return np.array([self.root(i) for i in range(len(self.up))], np.int64)

    def join(self, i: int, j: int) -> None:
        self.up[self.root(j)] = self.root(i)


def near_pairs(codes: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (i, j), i < j, of fingerprints (unsigned) within ``radius`` bits, the nearest first."""
    order = np.argsort(gray_rank(codes), kind="stable")
    index, a, b = GrayIndex(codes), [], []
    for query, leaf in index.search(index.leaves, radius):
        once = query < leaf
        a.append(query[once])
        b.append(leaf[once])
    a, b = order[np.concatenate(a)], order[np.concatenate(b)]
    first = np.lexsort((b, a, np.bitwise_count(codes[a] ^ codes[b])))
    return np.minimum(a, b)[first], np.maximum(a, b)[first]


def forest(codes: np.ndarray, sizes: np.ndarray, grams: list[bytes], labels: np.ndarray,
           least: float = LEAST) -> list[tuple[int, int]]:
    """Pairs of ``labels`` that join whatever the sets of a group whose likeness reaches ``least`` join.

    Pairs within RADIUS bits are taken nearest first; those under one label
    already are passed over, the others are counted by their shingles.
    """
    names, at = np.unique(labels, return_inverse=True)
    classes, found = _Classes(len(names)), []
    every = np.concatenate([np.frombuffer(g, np.uint32) for g in grams])
    values, place = np.unique(every, return_inverse=True)
    parts = np.split(place, np.cumsum([len(g) // 4 for g in grams])[:-1])
    seen, of = np.zeros(len(values), bool), None
    a, b = near_pairs(codes)
    small, large = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
    possible = (small >= least * large - 1e-9) & (at[a] != at[b])
    a, b = a[possible], b[possible]
    for start in range(0, len(a), 4 * GROUP):  # pairs joined meanwhile are left out together
        roots = classes.roots()[at]
        x, y = a[start:start + 4 * GROUP], b[start:start + 4 * GROUP]
        apart = roots[x] != roots[y]
        for i, j in zip(x[apart].tolist(), y[apart].tolist()):
            if classes.root(at[i]) == classes.root(at[j]):
                continue
            if i != of:
                if of is not None:
                    seen[parts[of]] = False
                seen[parts[i]] = True
                of = i
            both = np.count_nonzero(seen[parts[j]])
            if both >= least * (sizes[i] + sizes[j] - both) - 1e-9:
                classes.join(at[i], at[j])
                found.append((int(labels[i]), int(labels[j])))
    return found


def _compared(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between the roots of ``members`` (cluster, deal, fingerprint, root): a forest for each cluster.

    A task gets the clusters of one ``deal``.
    """
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        cluster = table.column("cluster").to_numpy()
        order = np.argsort(cluster, kind="stable")
        codes, sizes, labels = (table.column(c).to_numpy() for c in ("code", "n", "root"))
        grams, found = table.column("grams").to_pylist(), []
        for part in np.split(order, np.flatnonzero(np.diff(cluster[order])) + 1):
            if len(part) > 1:
                found += forest(codes[part].view(np.uint64), sizes[part], [grams[i] for i in part], labels[part])
        a, b = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    whole = members.join(sets, "fingerprint").select("deal", "cluster", "root", "code", "n", "grams")
    return whole.groupBy("deal").applyInArrow(search, "a bigint, b bigint").distinct()


def _under(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return members.withColumn("root", F.col("fingerprint"))
    return members.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left") \
        .withColumn("root", F.coalesce("root", "fingerprint"))


def _merged(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, root) after joining the roots that ``links`` (a, b) name."""
    new = components(links, "a", "b")
    if roots is None:
        return new
    kept = roots.join(new.select(F.col("node").alias("root"), F.col("root").alias("_to")), "root", "left").select(
        "node", F.coalesce("_to", "root").alias("root"))
    return kept.unionByName(new.join(roots.select("node"), "node", "left_anti"))


def links(known: DataFrame, docs: DataFrame, key: str, text: str, store) -> DataFrame | None:
    """(node, root) of every set linked with another: components of the pairs in a common band that reach LEAST.

    Sets that share a band's hash meet at the smallest of them, the head of
    their cluster, so a set travels once for each head.  A cluster of up to
    GROUP sets is compared as a whole.  A larger one is dealt by hash into parts,
    each with the head, anew in every round; sets of one root are never
    compared again.  Once those outside a cluster's commonest root are few, they
    meet all of it, so that no link of two roots is left out.
    """
    entries = known.select("fingerprint", F.posexplode("bands").alias("band", "code")).select(
        "fingerprint", F.xxhash64("band", "code").alias("bucket"))
    heads = entries.groupBy("bucket").agg(F.count("*").alias("m"), F.min("fingerprint").alias("cluster")).filter("m > 1")
    members = store(entries.join(heads.select("bucket", "cluster"), "bucket").select("cluster", "fingerprint").distinct())
    near = store(members.select("fingerprint").distinct())
    named = known.join(near, "fingerprint", "left_semi").select(F.col("first").alias(key)).distinct()
    sets = store(_sets(docs.join(named.hint("shuffle_hash"), key, "left_semi"), text).join(near, "fingerprint", "left_semi"))
    sized = members.join(sets.select("fingerprint", "n"), "fingerprint").groupBy("cluster").agg(
        F.count("*").alias("m"), F.sum("n").alias("total"))
    parts = F.ceil(F.greatest(F.col("m") / GROUP, F.col("total") / SHINGLES)).cast("bigint")
    sized = store(sized.select("cluster", "m", parts.alias("parts")))
    dealt = store(members.join(sized, "cluster"))
    small, large = dealt.filter("parts = 1"), dealt.filter("parts > 1")
    shared = max(1, (small.count() // TOGETHER))
    first = small.select("cluster", "fingerprint", F.pmod(F.xxhash64("cluster"), F.lit(shared)).alias("deal"))
    roots = None

    def in_parts(rows: DataFrame, salt: int) -> DataFrame:
        part = F.pmod(F.xxhash64("fingerprint", F.lit(salt)), F.col("parts"))
        every = F.when(F.col("fingerprint") == F.col("cluster"), F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))
        return rows.withColumn("part", F.explode(F.coalesce(every, F.array(part))))

    def deal(*columns: str):
        return F.xxhash64(*columns, F.lit("part"))

    clusters = first.unionByName(in_parts(large, 0).select("cluster", "fingerprint", deal("cluster", "part").alias("deal")))
    found = store(_compared(_under(clusters, None), sets))
    if not found.isEmpty():
        roots = store(_merged(roots, found))
    for turn in range(1, 100):
        under = _under(large, roots)
        common = under.groupBy("cluster", "root").agg(F.count("*").alias("held")).groupBy("cluster").agg(
            F.max_by("root", F.struct("held", "root")).alias("main"), F.sum("held").alias("m"),
            (F.sum("held") - F.max("held")).alias("others")).filter("others > 0")
        under = store(under.drop("m").join(common, "cluster"))
        blocks = F.ceil(F.col("others") / GROUP).cast("bigint")
        m, meetings = under.select("cluster", "m", blocks.alias("q")).distinct().agg(
            F.sum("m"), F.sum(F.col("m") * F.col("q"))).first()
        if not m:
            break
        last = meetings <= 2 * m or turn > 4
        if last:
            under = under.withColumn("q", blocks).withColumn("p", F.pmod(F.xxhash64("fingerprint"), F.col("parts")))
            zero = F.lit(0).cast("bigint")
            own = F.when(F.col("root") != F.col("main"), F.pmod(F.xxhash64("fingerprint", F.lit("q")), F.col("q")))
            at_home = under.withColumn("other", F.explode(F.sequence(zero, F.col("q") - 1))).withColumn("part", F.col("p"))
            asking = under.withColumn("other", own).filter("other IS NOT NULL").withColumn(
                "part", F.explode(F.sequence(zero, F.col("parts") - 1)))
            met = at_home.unionByName(asking).select("cluster", "fingerprint", "root", "part", "other").distinct() \
                .withColumn("deal", deal("cluster", "part", "other"))
        else:
            met = in_parts(under, turn).withColumn("deal", deal("cluster", "part"))
        found = store(_compared(met.select("cluster", "deal", "fingerprint", "root"), sets))
        if not found.isEmpty():
            roots = store(_merged(roots, found))
        if last:
            break
    return roots


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, ``fingerprint`` (its set of shingles), ``component_id`` and ``group``.

    Documents are linked if the Jaccard likeness of their sets of five-word
    shingles is at least 0.8; ``component_id`` is the smallest key a document can
    reach, and ``group`` tells groups apart that share it.  Null and blank texts
    are alike.  Sets are named by 64 bits and compared by 32 of each shingle: two
    sets of n sets in all share a name by chance with odds of n * n / 4e19, and a
    pair of sets of m shingles counts a common one too many with odds of m * m / 4e9.
    """
    with scratch(docs.sparkSession) as store:
        banded = store(_printed(docs, key, text))
        prints = stored(banded.select("key", "fingerprint"))
        known = store(banded.groupBy("fingerprint").agg(F.min("key").alias("first"), F.any_value("bands").alias("bands")))
        roots = links(known, docs, key, text, store)
        member = _under(known.select("fingerprint", "first"), roots)
        first = member.groupBy("root").agg(F.min("first").alias("component_id"))
        groups = stored(member.select("fingerprint", "root").join(first, "root")
                        .select("fingerprint", "component_id", F.col("root").alias("group")))
    return prints.select(F.col("key").alias(key), "fingerprint").join(groups, "fingerprint") \
        .select(key, "fingerprint", "component_id", "group")


def jaccard_reaches(x: bytes, y: bytes, least: float = LEAST) -> bool:
    """Whether two sorted arrays of distinct shingles have a Jaccard likeness of at least ``least``."""
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= least * (len(x) + len(y) - both) - 1e-9


def one_per_group(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near copies: the smallest key, and one row of it.

    Rows without a key stay as they are.
    """
    named = docs.filter(F.col(key).isNotNull())
    return keep_one(docs, near_copies(named, key, text), key, text, lambda t: set_id(shingles(t)))
