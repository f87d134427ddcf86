"""Exact top-k against brute force, with ties, copies, repeated keys and unfit vectors."""

import numpy as np
import pytest

from millrace.llm import topk


def brute(ids, vectors, query_id, query, k):
    scores = [(-int(v @ query), int(i)) for i, v in zip(ids, vectors) if i != query_id]
    return [(i, -s) for s, i in sorted(scores)[:k]]


@pytest.mark.parametrize("seed", range(6))
def test_lists_give_the_best(seed):
    rng = np.random.default_rng(seed)
    n, d = int(rng.integers(1, 300)), int(rng.integers(1, 12))
    vectors = rng.integers(-3, 4, (n, d))  # small numbers: many ties
    vectors[: n // 3] = vectors[0]
    ids = rng.permutation(n * 2)[:n]
    lists = topk.SortedLists(ids, vectors)
    for i in range(min(n, 20)):
        got = list(zip(*(x.tolist() for x in lists.top(int(ids[i]), vectors[i], 5))))
        assert got == brute(ids, vectors, ids[i], vectors[i], 5)


def test_stops_before_the_end():
    rng = np.random.default_rng(0)
    vectors = rng.integers(-5, 6, (4000, 3))
    vectors[7] = (400, 400, 400)
    lists = topk.SortedLists(np.arange(4000), vectors)

    class Counted(np.ndarray):
        reads = 0

        def __getitem__(self, at):
            Counted.reads += 1
            return np.asarray(self).__getitem__(at)

    lists.falling = lists.falling.view(Counted)
    ids, scores = lists.top(-1, np.array([1, 1, 1]), 1)
    assert ids.tolist() == [7] and scores.tolist() == [1200] and Counted.reads < 4


def test_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in rng.normal(size=4)], "x") for i in range(150)]
    rows += [(150, [1.0, None, 0.0, 0.0], "x"), (151, None, "x"), (152, [1.0, float("nan"), 0.0, 0.0], "x"),
             (153, [float("inf")] * 4, "x"), (None, [9.0] * 4, "x"), (100, rows[100][1], "copy")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score string")
    got = {}
    for r in topk.top_inner_products(df, 5, "vec_id % 50 = 0").collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    ids = np.arange(150)
    vectors = np.array([[int(np.floor(256 * float(np.float32(x)))) for x in v] for _, v, _ in rows[:150]])
    assert set(got) == {0, 50, 100}
    for q in got:
        assert [got[q][k + 1] for k in range(5)] == brute(ids, vectors, q, vectors[q], 5)


def test_few_rows(spark):
    kind = "vec_id bigint, embedding array<float>"
    two = spark.createDataFrame([(0, [1.0]), (1, [2.0])], kind)
    assert [tuple(r) for r in topk.top_inner_products(two, 5, "vec_id % 50 = 0").collect()] == [(0, 1, 1, 256 * 512)]
    assert topk.top_inner_products(two.limit(0), 5, "vec_id % 50 = 0").count() == 0
