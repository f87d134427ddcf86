"""Groups of near copies against the Jaccard likeness of all pairs."""

import random

import numpy as np
import pytest

import corpus_pipeline
from millrace.llm import near_copies
from millrace.llm.near_copies import jaccard_reaches, shingles


def plain_set(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def plain_groups(texts):
    """{doc_id: smallest id it can reach} by all pairs."""
    sets = {i: plain_set(t) for i, t in texts}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in sets:
        for j in sets:
            if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def planted(seed):
    """Texts, and copies of some of them with words changed so that they share 0.6 to 1 of the shingles."""
    rng = random.Random(seed)
    texts = []
    for i in range(60):
        words = [f"w{rng.randint(0, 3000)}" for _ in range(rng.choice([3, 8, 60, 300, 900]))]
        texts.append((i, " ".join(words)))
        for k in range(3):
            copy = list(words)
            for _ in range(round(len(words) * rng.choice([0.0, 0.005, 0.01, 0.02, 0.021, 0.022, 0.03, 0.05]))):
                copy[rng.randrange(len(copy))] = f"v{rng.randint(0, 10**6)}"
            texts.append((1000 + 10 * i + k, " ".join(copy).title() if k else " ".join(copy)))
    common = [f"c{j}" for j in range(100)]  # one large group of copies of one text, many of them under 0.8 to each other
    for k in range(150):
        copy = list(common)
        for at in rng.sample(range(100), 2):
            copy[at] = f"x{rng.randint(0, 10**6)}"
        texts.append((5000 + k, " ".join(copy)))
    return texts + [(9000, None), (9001, " "), (9002, "one"), (9003, "One")]


@pytest.mark.parametrize("group", [512, 20])
def test_groups_are_those_of_all_pairs(spark, documents, monkeypatch, group):
    monkeypatch.setattr(near_copies, "GROUP", group)
    texts = planted(3)
    got = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(documents(texts)).collect()}
    want = plain_groups(texts)
    assert got == want
    assert len(set(want.values())) < len(want) - 100  # many of the planted copies link


def test_the_stage_drops_planted_copies_and_nothing_else(spark, documents):
    texts = planted(5)
    out = corpus_pipeline.drop_near_duplicates(spark, documents(texts), None)
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(set(plain_groups(texts).values()))


def test_jaccard_at_the_limit():
    a = [f"a{i}" for i in range(13)]
    x, y = shingles(" ".join(a)), shingles(" ".join(a[:12]))  # 9 and 8 shingles
    assert jaccard_reaches(x.tobytes(), y.tobytes(), 8 / 9) and not jaccard_reaches(x.tobytes(), y.tobytes(), 0.9)
    assert jaccard_reaches(x.tobytes(), shingles(" ".join(a)[:-1] + "2").tobytes()) and jaccard_reaches(b"", b"")


def test_near_pairs_of_a_group():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 1 << 63, 40, np.uint64) << np.uint64(1)
    codes = np.concatenate([codes, codes[:30] ^ np.uint64(0xFFF) ^ np.uint64(1 << 40), codes[:5]])
    a, b = near_copies.near_pairs(codes, 14)
    apart = np.bitwise_count(codes[:, None] ^ codes[None, :])
    assert {*zip(a.tolist(), b.tolist())} == {(i, j) for i in range(75) for j in range(i + 1, 75) if apart[i, j] <= 14}
    assert (np.diff(apart[a, b].astype(int)) >= 0).all()


def test_no_documents(spark, documents):
    assert near_copies.near_copies(documents([])).count() == near_copies.one_per_group(documents([])).count() == 0


def test_one_id_with_two_texts(spark, documents):
    one, two, three = (" ".join(f"{c}{i}" for i in range(80)) for c in "abc")
    texts = [(7, one), (7, two), (7, two), (8, one), (9, two), (3, three), (5, three), (5, "quite other words here now")]
    kept = sorted((r["doc_id"], r["text"]) for r in near_copies.one_per_group(documents(texts)).collect())
    assert kept == [(3, three), (5, "quite other words here now"), (7, one), (7, two)]
