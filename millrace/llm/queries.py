"""The operators of this package applied to the given tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm import chat, html_text, langid, minhash, mixing, pack, periodic_runs, quality, secret_scan, simhash, token_codes, topk, whitening
from millrace.llm.common import table
from millrace.llm.minhash import let
from millrace.session import shared_folder

QUERIES: dict = {}
SQL: dict[str, str] = {}

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


# Targets of the mix: three domains of sources, languages within them, sources alike within a language.
MIX = mixing.Mix((
    mixing.Level("domain", """CASE WHEN source = 'src0' THEN 'crawl'
        WHEN source IN ('src1', 'src2', 'src3', 'src4', 'src5', 'src6', 'src7', 'src8', 'src9') THEN 'web'
        WHEN source LIKE 'src1_' THEN 'books' ELSE 'other' END""", {"crawl": 30, "web": 40, "books": 30}),
    mixing.Level("language", "lang", {"en": 50, "de": 20, "fr": 20, "es": 10}),
    mixing.Level("origin", "source"),
))


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = pack.pack(table(spark, sf_dir, "documents"), WORD_TOKENIZER, 2048)
    return placed.drop("doc_row")


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(~langid.held_out()))
    return langid.predict(docs, model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score",
                                              "cosine", "rejected")


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


@query
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.edited_fingerprints(table(spark, sf_dir, "documents"))


@query
def op5_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_inner_products(table(spark, sf_dir, "embeddings"), 5, "vec_id % 50 = 0")


@query
def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.selected(table(spark, sf_dir, "documents"), MIX)


SQL["op5_top_products"] = topk.top_sql(5, "vec_id % 50 = 0")
SQL["op6_mix"] = mixing.mix_sql(MIX)


@query
def op7_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = [r.kind for r in secret_scan.BASE]

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    own = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select("doc_id", *map(count, base), F.sha2(joined(own), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


@query
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.fit(pages), also=["url"])


@query
def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], given.schema)
    return chat.digests(chat.formatted_turns(chat.canonical(given.unionByName(more), "conv_id"), "conv_id"), "conv_id")


@query
def op11_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "tokens")
    token_codes.write(table(spark, sf_dir, "documents"), folder, BYTE_TOKENIZER)
    return token_codes.documents(spark, folder)


def with_planted_period(words: Column, key: Column) -> Column:
    """In one text of ten, by crc32 of its key, every word from a place on becomes one of the period that begins there."""
    h = F.crc32(key.cast("string").cast("binary"))
    g, n = F.floor(h / 10), F.size(words).cast("bigint")
    at = F.pmod(g, n)
    period = 1 + F.floor((n - at) / (3 + F.pmod(g, F.lit(8))))

    def changed(place: Column) -> Column:
        return F.transform(words, lambda w, i: F.when(i < place["at"], w).otherwise(
            F.get(words, (place["at"] + F.pmod(i - place["at"], place["period"])).cast("int"))))

    place = F.struct(at.alias("at"), period.alias("period"))
    return F.when((h % 10 == 0) & (n > 0), let(place, changed)).otherwise(words)


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    planted = let(words, lambda w: F.array_join(with_planted_period(w, F.col("doc_id")), " "))
    # Only texts that get a period are cut into words here.
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, planted).otherwise(F.col("text")).alias("text"))
    found = periodic_runs.periodic_runs(docs).withColumn("best", periodic_runs.strongest(F.col("runs")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), 4)
