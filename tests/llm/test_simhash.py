"""SimHash groups against brute force over all pairs."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import simhash
from millrace.llm.components import components


def plain_simhash(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\n", " ").replace(
        "\t", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(codes, radius=4):
    root = {int(c): int(c) for c in codes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    codes = np.unique(codes)
    for i, c in enumerate(codes):
        for d in codes[i + 1:][np.bitwise_count(codes[i + 1:] ^ c) <= radius]:
            a, b = find(int(c)), find(int(d))
            root[max(a, b)] = min(a, b)
    return {c: find(c) for c in root}


def planted(seed, n):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**64, n, dtype=np.uint64)
    near = base[rng.integers(0, n // 10 + 1, n)].copy()
    for _ in range(4):
        near ^= np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
    return np.unique(np.concatenate([base, near, [np.uint64(0), np.uint64(2**64 - 1)]]))


@pytest.mark.parametrize("text", ["", None, "One", "a b c d", "The THE the ÉÀ the\tthe\nthe", "x y z " * 500, " \n"])
def test_fingerprint(text):
    assert simhash.simhash(text) == plain_simhash(text)


def test_unicode_space_ends_no_word():
    text = "a\u00a0b c d"  # three words: one shingle
    assert simhash.simhash(text) == xxhash.xxh64_intdigest(text.encode(), 42)


def test_gray_rank_is_the_inverse_of_the_code():
    n = np.arange(1000, dtype=np.uint64)
    assert (simhash.gray_rank(n ^ n >> np.uint64(1)) == n).all()


@pytest.mark.parametrize("seed", range(4))
def test_index_finds_all_pairs(seed):
    codes = planted(seed, 300)
    index = simhash.GrayIndex(codes)
    got = {(int(codes[q]), int(index.leaves[x])) for qs, xs in index.search(codes, 4) for q, x in zip(qs, xs)}
    want = {(int(c), int(d)) for c in codes for d in codes[np.bitwise_count(codes ^ c) <= 4]}
    assert got == want


@pytest.mark.parametrize("split", [4096, 16])
def test_links_connect_what_pairs_connect(spark, monkeypatch, split):
    monkeypatch.setattr(simhash, "LEAVES", 32)
    monkeypatch.setattr(simhash, "SPLIT", split)
    codes = planted(9, 900)
    prints = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "fingerprint bigint")
    links = [(r["a"] % 2**64, r["b"] % 2**64) for r in simhash.near_links(prints).collect()]
    root = {int(c): int(c) for c in codes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert {c: find(c) for c in root} == groups(codes)


def ball(seed, n, prefix_bits=21):
    """Fingerprints under one prefix: half of them within a few bits of one, half anywhere."""
    rng = np.random.default_rng(seed)
    tail = np.uint64((1 << 64 - prefix_bits) - 1)
    near = np.full(n // 2, rng.integers(0, 2**64, dtype=np.uint64) & tail)
    for _ in range(6):
        near ^= np.uint64(1) << rng.integers(0, 64 - prefix_bits, len(near)).astype(np.uint64)
    far = rng.integers(0, 2**64, n // 2, dtype=np.uint64) & tail
    far[:n // 20] = near[:n // 20] ^ np.uint64(1 << 63)  # the next prefix, in which few stand, is asked by all of them
    return np.unique(np.concatenate([near, far]))


def test_a_hot_prefix_is_divided_and_loses_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LEAVES", 16)
    monkeypatch.setattr(simhash, "SPLIT", 32)
    monkeypatch.setattr(simhash, "MAX_PREFIX", 6)
    codes = ball(3, 3000)
    prints = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "fingerprint bigint")
    tiles = simhash.routed(prints).groupBy("turn", "node", "piece", "held", "p", "q").agg(
        F.count_if("leaf").alias("leaves"), F.count_if("asks").alias("askers"))
    most = tiles.agg(F.max("leaves"), F.max("askers")).first()
    assert most[0] <= 3 * 32 and most[1] <= 3 * 32 * 7
    links = [(r["a"] % 2**64, r["b"] % 2**64) for r in simhash.near_links(prints).collect()]
    root = {int(c): int(c) for c in codes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert {c: find(c) for c in root} == groups(codes)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200, 200), (None, 5), (300, 299)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b").collect()}
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)} | {299: 299, 300: 299}
    assert got == want
    none = spark.createDataFrame([], "a bigint, b bigint")
    assert components(none, "a", "b").count() == 0


def test_documents(spark, documents):
    base = " ".join(f"word{i}" for i in range(400))
    texts = [(5, base), (3, base.upper()), (9, base + " more"), (1, "quite another text " * 9), (20, None), (21, " "),
             (None, base), (22, "tiny"), (22, "tiny")]
    got = simhash.near_duplicates(documents(texts))
    rows = sorted(((r["doc_id"], r["component_id"], r["fingerprint"]) for r in got.collect()), key=repr)
    codes = np.array([plain_simhash(t) for _, t in texts], np.uint64)
    root = groups(codes)
    least = {}
    for (i, _), c in zip(texts, codes):
        if i is not None:
            least[root[int(c)]] = min(i, least.get(root[int(c)], i))
    want = sorted(((i, least[root[int(c)]], int(c.view(np.int64))) for (i, _), c in zip(texts, codes)), key=repr)
    assert rows == want
    kept = simhash.one_per_group(documents(texts))
    assert kept.columns == documents(texts).columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(set(least.values()))
    assert sum(r["doc_id"] is None for r in kept.collect()) == 1


def test_empty_table(spark, documents):
    assert simhash.near_duplicates(documents([])).count() == 0
    assert simhash.one_per_group(documents([])).count() == 0


def test_one_id_with_two_texts(spark, documents):
    one, two, three = (" ".join(f"{c}{i}" for i in range(80)) for c in "abc")
    texts = [(7, one), (7, two), (7, two), (8, one), (9, two), (3, three), (5, three), (5, "quite other words here now")]
    kept = sorted((r["doc_id"], r["text"]) for r in simhash.one_per_group(documents(texts)).collect())
    assert kept == [(3, three), (5, "quite other words here now"), (7, one), (7, two)]
