"""Mixing against its SQL and against budgets worked out by hand."""

import duckdb
import pytest

from millrace.llm import mixing
from millrace.llm.queries import MIX

TREE = (mixing.Level("domain", "substr(source, 1, 1)", {"a": 3, "b": 1, "z": 0}),
        mixing.Level("language", "lang", {"en": 2}), mixing.Level("origin", "source"))


def by_sql(documents, mix):
    db = duckdb.connect()
    db.register("given", documents.select("doc_id", "text", "lang", "source").toPandas())
    db.execute("CREATE VIEW documents AS SELECT CAST(doc_id AS BIGINT) AS doc_id, text, lang, source FROM given")
    return sorted(db.execute(mixing.mix_sql(mix)).fetchall(), key=repr)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("percent, epochs", [(100, 1), (50, 1), (100, 4), (300, 2), (1, 3)])
def test_equals_sql(spark, documents, percent, epochs):
    sources = ["a1", "a2", "b1", "c1", "z1", None]
    docs = documents([(i, "word " * (i % 37), ["en", "de", None][i % 3], sources[i * i % 6]) for i in range(300)])
    mix = mixing.Mix(TREE, percent, epochs)
    assert rows(mixing.selected(docs, mix)) == by_sql(docs, mix)


def test_siblings_make_up_before_ancestors(spark):
    leaves = spark.createDataFrame([("a", "en", "a1", 10), ("a", "en", "a2", 1000), ("b", "en", "b1", 1000)],
                                   "domain string, language string, origin string, size bigint")
    mix = mixing.Mix((mixing.Level("domain", "x"), mixing.Level("language", "x"), mixing.Level("origin", "x")), 50, 1)
    got = {r["origin"]: r["budget"] for r in mixing.budgets(leaves, mix).collect()}
    # 1,005 tokens: 502 a domain; a1 has only 10, and a2, not b1, takes over its share.
    assert got == {"a1": 10, "a2": 492, "b1": 502}
    full = mixing.Mix(mix.levels, 100, 1)
    short = spark.createDataFrame([("a", "en", "a1", 10), ("b", "en", "b1", 1000)], leaves.schema)
    assert {r["origin"]: r["budget"] for r in mixing.budgets(short, full).collect()} == {"a1": 10, "b1": 1000}


def test_hot_source_and_repeated_rows(spark, documents):
    docs = documents([(i % 400, "x" * 40, "en", "a1") for i in range(1200)] + [(None, "null key", "en", "a1")] * 3)
    mix = mixing.Mix(TREE, 70, 2)
    assert rows(mixing.selected(docs, mix)) == by_sql(docs, mix)


def test_mixed_keeps_the_columns(spark, documents):
    docs = documents([(i, "text " * (i % 9), "en", f"a{i % 3}") for i in range(90)])
    mix = mixing.Mix(TREE, 150, 4)
    out = mixing.mixed(docs, mix)
    assert out.schema == docs.schema
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(r["doc_id"] for r in mixing.selected(docs, mix).collect())


def test_empty_and_textless(spark, documents):
    assert mixing.selected(documents([]), MIX).count() == 0
    docs = documents([(1, None), (2, "")])
    assert rows(mixing.selected(docs, MIX)) == by_sql(docs, MIX)
