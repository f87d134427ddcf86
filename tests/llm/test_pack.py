"""Packing: ids equal the tokenizer's, pieces and sequences fit together, padding is small."""

import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import pack

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", None, "a b'll DON'T <|endoftext|> x<|startoftext|>y", "ΑΣ ΑΣ Σ é é ½²x İstanbul ﬁ 12ab ','",
       "日本語 テキスト \x1c a\x85b ̈ a", "tab\tand\nline\r\x0b\x0c end", "Reed*** ndsh*** && a-b_c"]


def expected(text):
    ids = Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [pack.END_ID]
    return struct.pack(f"<{len(ids)}I", *ids)


def test_word_ids_are_the_tokenizers():
    tokens = pack.WordTokens(PATH)
    got = tokens.ids([t or "" for t in ODD])
    assert [g + struct.pack("<I", 1) for g in got] == [expected(t) for t in ODD]


@pytest.mark.parametrize("seed", range(5))
def test_patterns_hold_the_histogram(seed):
    rng = np.random.default_rng(seed)
    size = int(rng.integers(1, 200))
    histogram = {int(n): int(rng.integers(1, 1000)) for n in rng.integers(1, size + 1, 30)}
    patterns = pack.pack_histogram(histogram, size)
    held = Counter()
    for count, lengths in patterns:
        assert count > 0 and sum(lengths) <= size
        for length in lengths:
            held[length] += count
    assert held == Counter(histogram)
    assert len(patterns) <= 4 * len(histogram)


def check(rows, texts, size):
    """Every document is whole, every sequence gapless."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault((r["doc_id"], r["doc_row"]), []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    found = Counter()
    for (doc_id, _), pieces in by_doc.items():
        ids = b"".join(struct.pack(f"<{len(p['ids'])}I", *p["ids"]) for p in sorted(pieces, key=lambda p: p["start"]))
        found[(doc_id, ids)] += 1
        for p in pieces:
            assert p["length"] == len(p["ids"]) and p["doc_tokens"] == len(ids) // 4
            assert p["ids_crc32"] == zlib.crc32(ids[4 * p["start"]:4 * (p["start"] + p["length"])])
    assert found == Counter((i, expected(t)) for i, t in texts)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= size
    assert sorted(by_sequence) == list(range(len(by_sequence)))


def test_pack(spark, documents):
    texts = [(i, t) for i, t in enumerate(ODD)] + [(50, "long word " * 3000), (50, "long word " * 3000), (None, "no key"),
                                                   *((100 + i, "same text") for i in range(40))]
    placed = pack.pack(documents(texts), PATH, 64, with_ids=True)
    check(placed.collect(), texts, 64)
    whole = pack.sequences(placed).collect()
    assert all(len(s["ids"]) <= 64 and s["starts"][0] == 0 for s in whole)


def test_hot_length_is_ranked_in_parts(spark):
    from millrace.llm.common import rank_within
    df = spark.range(5000).selectExpr("id", "if(id % 3 = 0, 1, 2) AS g")
    sizes = df.groupBy("g").count().withColumnRenamed("count", "n")
    ranked = rank_within(df, "g", "id", sizes, rows_per_part=100).collect()
    for g in (1, 2):
        ranks = sorted(r["rank"] for r in ranked if r["g"] == g)
        assert ranks == list(range(len(ranks)))


def test_little_padding(spark, sf):
    from millrace.llm.common import table
    rows = pack.pack(table(spark, sf, "documents"), PATH, 2048).groupBy("sequence_id").sum("length").collect()
    used = [r[1] for r in rows]
    assert sum(pack.padding(u, 2048) for u in used) <= 2048 + 0.01 * sum(used)


def test_empty_table(spark, documents):
    assert pack.pack(documents([]), PATH, 2048).count() == 0


def test_power_of_two_needs_no_padding():
    assert [pack.padding(n, 2048) for n in (2048, 1024, 1023, 1)] == [0, 0, 1025, 0]


def test_samples_are_those_of_the_smallest_hash(spark):
    from pyspark.sql import functions as F

    from millrace.llm.common import sampled
    rows = spark.range(5000).selectExpr("id AS key", "CASE WHEN id % 50 = 0 THEN 'few' WHEN id % 7 = 0 THEN NULL ELSE 'many' END AS g")
    got = sampled(rows, "g", "key", 120).collect()
    hashed = rows.withColumn("h", F.xxhash64("key")).collect()
    for g, n in (("few", 100), ("many", 120)):
        want = [r["key"] for r in sorted((r for r in hashed if r["g"] == g), key=lambda r: r["h"])[:120]]
        assert [r["key"] for r in sorted(got, key=lambda r: r["place"]) if r["g"] == g] == want and len(want) == n
    assert len(got) == 220 and sampled(rows.limit(0), "g", "key", 5).count() == 0
