"""Language ID: held-out accuracy, rejection, and odd inputs."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import langid
from millrace.llm.common import table


def test_held_out_accuracy(spark, sf):
    docs = table(spark, sf, "documents")
    model = langid.fit(docs.filter(~langid.held_out()))
    found = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").withColumn("held", langid.held_out())
    right = found.filter("held").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.97
    assert found.filter("rejected").count() <= 1
    assert found.filter("score < 0 OR score > 1").count() == 0


def test_rejects_what_is_far_from_all(spark, sf):
    docs = table(spark, sf, "documents")
    model = langid.fit(docs)
    assert model.predict("Это совсем другой язык и довольно длинный текст " * 5)[3]
    assert model.predict(None) == ("und", 0.0, 0.0, True)
    assert model.predict("12 34 %% !")[0] == "und"
    assert not model.predict("The.")[3]


def test_odd_rows_and_extra_columns(spark, documents):
    rows = [(i, "the thing that was", "en", "s") for i in range(12)] + [(i, "der die das und nicht", "de", "s") for i in range(20, 32)]
    rows += [(40, None, "en", "s"), (41, "", None, "s"), (None, "the thing", None, None), (42, "x" * 300_000, None, "s"),
             (0, "the thing that was", "en", "s")]
    docs = documents(rows)
    model = langid.fit(docs)
    found = langid.predict(docs, model).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r["lang_pred"] for r in found}
    assert by_id[1] == "en" and by_id[21] == "de" and by_id[40] == by_id[41] == "und" and by_id[None] == "en"
    kept = langid.accepted(docs, model)
    assert kept.schema == docs.schema
    assert {r["doc_id"] for r in kept.collect()} >= {None, *range(12), *range(20, 32)}
    assert not {40, 41} & {r["doc_id"] for r in kept.collect()}


def test_without_rows_or_labels(spark, documents):
    empty = documents([])
    model = langid.fit(empty)
    assert langid.predict(empty, model).count() == 0
    assert model.predict("some text")[::3] == ("und", False)


def plain_grams(text):
    """Buckets of letter bigrams and trigrams, counted one by one."""
    shown = "".join(c if c.isalpha() else "\0" for c in text.lower()).lstrip("\0")
    while "\0\0" in shown:
        shown = shown.replace("\0\0", "\0")
    codes, whole = [32, *(ord(c) or 32 for c in shown), 32], 0xFFFFFFFF
    two = [a * 0x9E3779B1 & whole ^ b * 0x85EBCA77 & whole for a, b in zip(codes, codes[1:])]
    three = [a * 0xC2B2AE3D & whole ^ b * 0x27D4EB2F & whole for a, b in zip(two, codes[2:])]
    return Counter((g * 0x165667B1 & whole) >> 32 - 13 for g in two + three)


def test_equals_a_plain_computation(spark, sf):
    """Document frequencies, TF-IDF weights and the nearest centroid's cosine, with dictionaries."""
    rows = [r for r in table(spark, sf, "documents").select("doc_id", "text", "lang").collect() if r["text"]]
    docs = table(spark, sf, "documents").where("text IS NOT NULL AND text <> ''")
    model = langid.fit(docs)
    grams = {r["doc_id"]: plain_grams(r["text"]) for r in rows}
    seen = Counter(b for r in rows if r["lang"] is not None for b in grams[r["doc_id"]])
    n = sum(r["lang"] is not None for r in rows)
    idf = {b: math.log((1 + n) / (1 + seen[b])) + 1 for b in range(langid.BUCKETS)}
    assert max(abs(idf[b] - model.idf[b]) for b in idf) < 1e-5
    for r in langid.predict(docs, model).collect():
        weights = {b: math.log1p(c) * idf[b] for b, c in grams[r["doc_id"]].items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        cosines = [sum(w * float(centroid[b]) for b, w in weights.items()) / norm for centroid in model.centroids.T]
        nearest = max(range(len(cosines)), key=cosines.__getitem__)
        assert abs(r["cosine"] - cosines[nearest]) < 1e-4
        assert r["lang_pred"] == model.languages[model.owner[nearest]]


FOREIGN = ["suomalaiset asuvat pohjoisessa jossa talvi on pitkä mutta kesällä aurinko paistaa koko yön eikä kukaan halua nukkua ",
           "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i są obdarzeni rozumem i sumieniem ",
           "Это совсем другой язык и довольно длинный текст "]


@pytest.mark.parametrize("grams", [100, 300, 1000, 4000])
def test_rejects_foreign_and_garbled_texts_of_any_length(spark, sf, grams):
    """Nearly all: a document's letters turned by 13 keep their frequencies, and a few lie within the limit."""
    docs = table(spark, sf, "documents")
    model = langid.fit(docs)
    rng = random.Random(grams)
    garbled = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(grams)) for _ in range(20)]
    turned = ["".join(chr((ord(c) - 84) % 26 + 97) if "a" <= c <= "z" else c for c in r["text"] * 9)
              for r in docs.where("length(text) > 500").select("text").limit(20).collect()]
    rejected = [model.predict(text[:grams // 2])[3] for text in [*[f * 60 for f in FOREIGN], *garbled, *turned]]
    assert all(rejected[:len(FOREIGN)]) and sum(rejected) >= 0.9 * len(rejected), (sum(rejected), len(rejected))


def test_one_outlier_does_not_set_a_limit():
    grams, cosine = np.full(300, 500), np.full(300, 0.8)
    cosine[7] = 0.01
    assert langid._limits(cosine, grams)[2] > 0.3
