"""Fingerprints: edited texts, closeness to the true likeness, and odd inputs."""

import hashlib
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from millrace.llm import minhash
from millrace.llm.common import table


def shingles(text):
    words = text.split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(texts):
    return [x[:len(x) - len(x) // 2] + y[:len(x) // 2] for x, y in zip(texts, texts[1:] + texts[:1])]


def test_likeness_is_close_to_the_true_one(spark, sf):
    docs = table(spark, sf, "documents")
    rows = minhash.edited_fingerprints(docs).orderBy("doc_id").collect()
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()]
    other = edited(texts)
    assert [r["edited_sha256"] for r in rows] == [hashlib.sha256(t.encode()).hexdigest() for t in other]
    assert [r["n_chars"] for r in rows] == [len(t) for t in texts]
    error = np.array([r["near_edited"] - jaccard(a, b) for r, a, b in zip(rows, texts, other)])
    assert abs(error.mean()) < 0.02 and error.std() < 0.06
    following = np.array([r["near_next"] - jaccard(a, b) for r, a, b in zip(rows, texts, texts[1:] + texts[:1])])
    assert abs(following.mean()) < 0.02 and following.std() < 0.06


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def folded(values, width):
    """The 64-bit hash of whole numbers of ``width`` bytes, one after the other."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest((v % (1 << 8 * width)).to_bytes(width, "little"), seed)
    return seed


def plain_fingerprint(text):
    words = [xxhash.xxh64_intdigest(w.encode(), 42) for w in re.split("[\x20\x09-\x0D]+", text or "") if w]
    if len(words) >= 5:
        hashes = [folded(words[i:i + 5], 8) for i in range(len(words) - 4)]
    else:
        hashes = [42] if words else []
        for w in words:
            hashes = [folded([hashes[0], w], 8)]
    least = {}
    for h in hashes:
        least[h >> 56] = min(h, least.get(h >> 56, h))
    full = {b: h % 16 for b, h in least.items()}

    def value(b):
        tries = [b, *(folded([b, t], 4) % 256 for t in range(8))]
        hit = next((full[t] for t in tries if t in full), None)
        return min((signed(folded([b, o, 8], 4)), low) for o, low in full.items())[1] if hit is None else hit

    return "".join(f"{value(b):x}" for b in range(256)) if full else ""


def test_fingerprints_by_a_plain_computation(spark, sf, documents):
    given = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    odd = [(-1, None), (-2, " \n"), (-3, "one"), (-4, "a b c d"), (-5, "a b c d e"), (-6, "é\u00a0ü 名 b\x0bc d e f g"),
           (-7, "again " * 3000)]
    want = {i: plain_fingerprint(t) for i, t in given + odd}
    got = {r["doc_id"]: r["fingerprint"] for r in minhash.fingerprints(documents(given + odd)).collect()}
    assert got == want


def test_fingerprints_of_equal_texts_are_equal(spark, documents):
    rows = {r["doc_id"]: r["fingerprint"] for r in minhash.fingerprints(documents(
        [(1, "a b c d e f"), (2, "a  b\nc d e f"), (3, "a"), (4, None), (5, " \n"), (6, "a b c d e g")])).collect()}
    assert rows[1] == rows[2] != rows[6]
    assert rows[4] == rows[5] == "" and len(rows[3]) == minhash.BINS


def test_odd_rows(spark, documents):
    texts = [(None, "null key"), (1, "é ü 漢字 abc"), (2, None), (2, "z"), (3, "word " * 50_000), (9, "")]
    rows = minhash.edited_fingerprints(documents(texts)).collect()
    assert len(rows) == len(texts)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["edited_sha256"] == hashlib.sha256("é ü 漢".encode()).hexdigest()  # the next text is empty
    assert by_id[3]["n_chars"] == 250_000 and by_id[9]["near_edited"] == 1.0
    last = hashlib.sha256("".encode()).hexdigest()
    assert by_id[9]["edited_sha256"] == last


def test_one_row_follows_itself_and_no_rows_give_none(spark, documents):
    row = minhash.edited_fingerprints(documents([(5, "ab cd")])).first()
    assert row["edited_sha256"] == hashlib.sha256(b"ab ab").hexdigest() and row["near_next"] == 1.0
    assert minhash.edited_fingerprints(documents([])).count() == 0


def test_every_row_meets_the_next(spark):
    rows = spark.range(3000).select((F.col("id") * 7 % 3001).alias("doc_id"), F.col("id").cast("string").alias("t"))
    dealt, following = minhash.with_next(rows, "doc_id", ["t"])
    got = sorted((r["doc_id"], r["n"]) for r in dealt.withColumn("n", following("t")).filter("own").collect())
    texts = [r["t"] for r in rows.orderBy("doc_id").collect()]
    assert [n for _, n in got] == texts[1:] + texts[:1]
