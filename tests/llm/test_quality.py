"""The quality classifier: the linear-time score equals all pairs, and held-out labels are found."""

import numpy as np

from millrace.llm import quality
from millrace.llm.common import table


def test_scores_equal_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    width = quality.BUCKETS + len(quality.STATISTICS)
    model = quality.FactorisationMachine(0.1, rng.normal(0, .1, width), rng.normal(0, .1, (width, quality.FACTORS)),
                                         np.zeros(len(quality.STATISTICS)), np.ones(len(quality.STATISTICS)))
    text = "One two, two three.\nFOUR!! five ***"
    at, x = model.row(*quality.features(text))
    raw = model.bias + sum(model.linear[a] * v for a, v in zip(at, x))
    raw += sum(model.factors[at[i]] @ model.factors[at[j]] * x[i] * x[j] for i in range(len(at)) for j in range(i))
    assert abs(model.score(text) - 1 / (1 + np.exp(-raw))) < 1e-6


def test_held_out_labels(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = quality.fit(docs, labels)
    rows = quality.score(docs, model).withColumn("held", quality.held_out()).join(labels, "doc_id").filter("held").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == v] for v in (1, 0))
    auc = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert auc > 0.97
    assert np.mean([s >= quality.THRESHOLD for s in good]) > 0.97


def test_words_are_hashed_alike_wherever_they_stand():
    a, b = quality.features("same same"), quality.features("x same")
    assert len(a[0]) == 1 and a[0][0] in b[0]


def test_odd_rows(spark, documents):
    rows = [(1, None), (2, ""), (3, "ok " * 100_000), (None, "no key"), (4, "fine text."), (4, "fine text.")]
    docs = documents(rows)
    labels = spark.createDataFrame([(4, 1, None), (3, 0, 1), (9, None, 0), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    scored = quality.score(docs, quality.fit(docs, labels)).collect()
    assert len(scored) == 6 and all(0 <= r["score"] <= 1 for r in scored)
    scores = {r["doc_id"]: r["score"] for r in scored}
    assert scores[1] == scores[2]
    none = quality.score(docs, quality.fit(docs, labels.limit(0)))
    assert {r["score"] for r in none.collect()} == {0.5}
    assert quality.score(documents([]), None).count() == 0
