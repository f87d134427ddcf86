"""Runs against a plain search of every period."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from millrace.llm import periodic_runs as pr
from millrace.llm.common import table


def plain_runs(words):
    """Every maximal stretch of every period, kept if no smaller period covers the same words."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        begin = None
        for i in range(len(words) - q + 1):
            same = i < len(words) - q and words[i] == words[i + q]
            if same and begin is None:
                begin = i
            elif not same and begin is not None:
                if i + q - begin >= max(24, 3 * q):
                    found.setdefault((begin, i + q), q)
                begin = None
    return sorted((b, e - b, q) for (b, e), q in found.items())


def sample(rng, n, letters):
    """A text of few different words with repeats of all sizes, nested ones and broken ones."""
    words = rng.integers(0, letters, n).tolist()
    for _ in range(int(rng.integers(0, 6))):
        a, q, times = int(rng.integers(0, n)), int(rng.integers(1, max(2, n // 3))), float(rng.uniform(2, 6))
        unit = words[a:a + q]
        if rng.random() < 0.5 and q > 6:
            p = int(rng.integers(1, 4))
            unit = ([*unit[:p]] * q)[:q - 1] + [int(rng.integers(0, letters))]
        words[a:a + int(q * times)] = (unit * 7)[:int(q * times)]
        if rng.random() < 0.3:
            words[int(rng.integers(0, len(words)))] = -5
    return words


@pytest.mark.parametrize("seed", range(40))
def test_equal_to_a_plain_search(seed):
    rng = np.random.default_rng(seed)
    texts = [[str(w).encode() for w in sample(rng, int(rng.integers(1, 400)), int(rng.choice([1, 2, 3, 50])))] for _ in range(8)]
    assert pr.runs_of(texts) == [plain_runs(t) for t in texts]


@pytest.mark.parametrize("q", range(1, 140))
def test_every_period_of_exactly_three(q):
    rng = np.random.default_rng(q)
    for length in (max(24, 3 * q), max(24, 3 * q) - 1):
        unit = [b"a"] * (q - 1) + [b"b"] if q % 2 else [str(x).encode() for x in rng.integers(0, 2, q)]
        words = [b"x", *(unit * 25)[:length], b"y"]
        assert pr.runs_of([words, words[1:-1]]) == [plain_runs(words), plain_runs(words[1:-1])]


def test_words_of_a_recursive_kind():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 1500:
        a, b = b, b + a
    thue = [b"a"]
    while len(thue) < 1000:
        thue += [b"b" if w == b"a" else b"a" for w in thue]
    nested = (([b"a"] * 9 + [b"b"]) * 5 + [b"c"]) * 4
    for words in (b[:1500], thue, nested, [b"z"] * 700, b[:900] * 3):
        assert pr.runs_of([words]) == [plain_runs(words)]


def test_long_text_takes_time_in_proportion():
    import time
    rng = np.random.default_rng(0)
    took = []
    for n in (200_000, 800_000):
        words = [b"w%d" % x for x in rng.integers(0, 3000, n)]
        words[100:n // 2] = (words[100:100 + n // 9] * 9)[:n // 2 - 100]
        began = time.time()
        found = pr.runs_of([words])[0]
        took.append(time.time() - began)
        assert (100, n // 9) in [(f[0], f[2]) for f in found]
    assert took[1] < 8 * took[0] + 1


def digests(key, text):
    """The contract's row by a plain search."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(key).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = plain_runs(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    dropped = {i for s, m, q in found for i in range(s + q, s + m)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (key, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_query_equals_a_plain_search(spark, sf, monkeypatch, documents):
    from millrace.llm import queries
    rows = [(i, " ".join("abcdefgh"[x] for x in np.random.default_rng(i).integers(0, 8, i % 97))) for i in range(300)]
    rows += [(900, None), (901, ""), (902, " \t\n"), (903, "same " * 100), (903, "same " * 100), (904, "\x0ba\x0cb c\x85d e\xa0f " * 30),
             (905, "x y " * 12 + "z"), (906, "x y " * 11 + "x y")]
    docs = documents(rows)
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    got = queries.QUERIES["op12_periodic_runs"](spark, sf).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((digests(i, t) for i, t in rows), key=repr)
    docs = documents([])
    assert queries.QUERIES["op12_periodic_runs"](spark, sf).count() == 0
    docs = table(spark, sf, "documents").filter("n_chars < 3000")
    got = queries.QUERIES["op12_periodic_runs"](spark, sf).collect()
    assert sorted(map(tuple, got)) == sorted(digests(r["doc_id"], r["text"]) for r in docs.collect())


def test_null_keys_and_clashing_columns(spark):
    df = spark.createDataFrame([(None, "a b " * 20, 1), (None, None, 2)], "name string, body string, runs int")
    got = sorted(pr.periodic_runs(df, "name", "body").collect(), key=lambda r: r["n_words"])
    assert [(r["name"], r["n_words"], r["collapsed"]) for r in got] == [(None, 0, ""), (None, 40, "a b")]
    assert [tuple(r) for r in got[1]["runs"]] == [(0, 40, 2)]
