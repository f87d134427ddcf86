"""Directly addressable codes: ids are the tokenizer's, every id can be read alone, files give back what was written."""

import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import token_codes as tc
from millrace.llm.common import table
from millrace.session import shared_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", None, "a b'll DON'T I'm  x <|endoftext|> y", "  two\n\n three \t four  ", "été İstanbul ﬁ 12ab ','", "日本語 \x1c a\x85b ̈ a",
       "tab\tand\nline\r\x0b\x0c end ", "x'sy 'S ''re 100,000.5 $%& a'", "\xa0nbsp ½ ² × ÷ ÿ", "'" * 50 + " " * 50]


TOKENIZER = Tokenizer.from_file(PATH)


def expected(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, tc.END_ID]


def test_ids_are_the_tokenizers():
    tokens = tc.PieceTokens(PATH)
    rng = np.random.default_rng(1)
    mixed = ["".join(rng.choice(list("aZé'st  \n\t09.,-ll"), 60)) for _ in range(300)]
    for t in [t or "" for t in ODD] + mixed:
        assert [*np.frombuffer(tokens.ids(t), "<u4"), tc.END_ID] == expected(t)


@pytest.mark.parametrize("seed", range(6))
def test_every_id_is_read_alone(seed):
    rng = np.random.default_rng(seed)
    ids = (rng.integers(0, 1 << 32, int(rng.integers(0, 3000))) >> rng.integers(0, 33, 1)).astype(np.uint32)
    if seed == 0:
        ids = np.zeros(700, np.uint32)
    for widths in (None, [4, 4, 8, 16], [32], [1] * 32):
        codes = tc.Codes(tc.encoded(ids, widths))
        assert len(codes) == len(ids) and np.array_equal(codes.all(), ids)
        assert [codes[i] for i in range(len(ids))] == ids.tolist()
    with pytest.raises(IndexError):
        codes[len(ids)]


def test_widths_are_the_cheapest():
    def cost(widths, longer):
        at = total = 0
        for w in widths:
            total += longer[at] * (w + (0 if at + w == len(longer) else 1 + 32 / tc.RANKED))
            at += w
        return total

    def splits(bits):
        yield from ([w, *rest] for w in range(1, bits + 1) for rest in (splits(bits - w) if w < bits else [[]]))

    longer = [1000, 990, 900, 700, 650, 120, 100, 90, 3]
    assert cost(tc.best_widths(longer), longer) == min(cost(w, longer) for w in splits(len(longer)))


def written(spark, docs, **more):
    folder = shared_folder(spark, "tokens")
    tc.write(docs, folder, PATH, **more)
    return folder


def test_files_give_back_the_documents(spark, documents):
    texts = [(i, t) for i, t in enumerate(ODD)] + [(50, "a long word " * 4000), (50, "another text"), (50, "another text"), (None, "no key"),
                                                   *((99, f"row {i}") for i in range(200)), (-7, "before all")]
    folder = written(spark, documents(texts).repartition(5), block=100)
    got = sorted(tc.documents(spark, folder, with_ids=True).collect(), key=lambda r: r["start"])
    at, keys = 0, []
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(r['ids'])}I", *r["ids"]))
        at += r["n_tokens"]
        keys.append(r["doc_id"])
    assert keys == sorted((k for k, _ in texts), key=lambda k: (k is not None, k or 0))
    assert sorted((repr(r["doc_id"]), r["ids"]) for r in got) == sorted((repr(k), expected(t)) for k, t in texts)
    everything = [i for r in got for i in r["ids"]]
    asked = spark.createDataFrame([(p,) for p in [*range(0, at, 7), at - 1, 0, 0, at, -1, None]], "position bigint")
    found = {r["position"]: r["id"] for r in tc.tokens_at(spark, folder, asked, cell=64).collect()}
    assert found == {p: everything[p] for p in {*range(0, at, 7), at - 1}}


def test_other_keys_and_no_rows(spark, documents):
    folder = written(spark, spark.createDataFrame([("b", "x y"), ("a", None)], "name string, body string"), key="name", text="body")
    assert [r["name"] for r in tc.documents(spark, folder, "name").orderBy("start").collect()] == ["a", "b"]
    folder = written(spark, documents([]))
    assert tc.documents(spark, folder).count() == 0
    assert tc.tokens_at(spark, folder, spark.range(3).withColumnRenamed("id", "position")).count() == 0


def test_query_on_the_given_documents(spark, sf):
    from millrace.llm.queries import QUERIES
    got = {r["doc_id"]: r for r in QUERIES["op11_token_codes"](spark, sf).collect()}
    at = 0
    for r in table(spark, sf, "documents").orderBy("doc_id").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect():
        ids = expected(r["text"])
        row = got[r["doc_id"]]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        at += len(ids)
