"""Every stage of the pipeline, and its end, against a plain version over the same rows."""

import re
from collections import Counter

import numpy as np

import corpus_pipeline
from millrace.llm import langid, mixing, secret_scan
from millrace.llm.common import stored
from test_mixing import by_sql
from test_pack import check
from test_near_copies import plain_groups
from millrace.llm import pack


def test_stages_in_turn(spark, documents):
    rng = np.random.default_rng(4)
    en, de = "the of and that with this from have".split(), "der die und nicht mit das ist ein".split()
    texts = []
    for i in range(120):
        words = [*rng.choice(en if i % 2 else de, 60), str(i), f"w{i * 7919}"]
        texts.append((i, " ".join(words) + ("\ntoken = 'abcdef0123456789abcd'" if i % 10 == 0 else ""),
                      "en" if i % 2 else "de", f"src{i % 4}"))
    texts += [(200 + i, texts[i][1], *texts[i][2:]) for i in range(15)]            # exact copies
    texts += [(300 + i, texts[i][1].upper(), *texts[i][2:]) for i in range(5)]     # same words in capitals
    for i in range(20):  # near copies: one to three neighbouring words of about sixty changed, a likeness of 0.84, 0.81 and 0.78
        words = texts[i][1].split("\ntoken")[0].split()
        words[25:26 + i % 3] = [f"v{i}{k}" for k in range(1 + i % 3)]
        texts.append((500 + i, " ".join(words), *texts[i][2:]))
    texts += [(400, None, "en", "src0"), (401, "12 34", "en", "src0"), (402, "", None, None), (None, "the of and no id", "en", "s")]
    docs = documents(texts)
    done = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, None))
        assert out.columns == docs.columns
        before, after = docs.collect(), out.collect()
        if name == "language_id":
            model = langid.fit(docs.filter(~langid.held_out()))
            assert Counter(after) == Counter(r for r in before if not model.predict(r["text"])[3])
            assert not {400, 401, 402} & {r["doc_id"] for r in after}
            assert {r["doc_id"] for r in after} >= set(range(120))
        elif name == "simhash_near_dedup":
            first = plain_groups([(r["doc_id"], r["text"]) for r in before if r["doc_id"] is not None])
            assert {r["doc_id"] for r in after} == {None, *first.values()}
            assert not {500 + i for i in range(0, 20, 3) if i % 10} & {r["doc_id"] for r in after}
            assert {500 + i for i in range(2, 20, 3)} <= {r["doc_id"] for r in after}
        elif name == "secret_scan":
            mark = lambda t: re.sub(r"token = '[0-9a-f]+|\b[0-9a-f]{16,}", "[SECRET]", t)
            assert {r["doc_id"]: r["text"] for r in after} == {r["doc_id"]: mark(r["text"]) for r in before}
            assert all(r["n_chars"] == len(r["text"]) for r in after)
            assert not any(secret_scan.scan_texts([r["text"] for r in after]))
        else:
            want = Counter(r[0] for r in by_sql(docs, corpus_pipeline.MIX))
            assert Counter(r["doc_id"] for r in after) == want
        done[name] = out
        docs = out
    placed = pack.pack(docs, corpus_pipeline.WORD_TOKENIZER, 2048, with_ids=True)
    check(placed.collect(), [(r["doc_id"], r["text"]) for r in docs.collect()], 2048)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, None)
    assert last.columns == [c for c in placed.columns if c not in ("ids", "doc_row")]


def test_run_is_the_stages_in_a_row(spark, sf):
    from millrace.llm.common import table
    docs = table(spark, sf, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf))
    want = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    key = lambda df: sorted(tuple(r)[:5] for r in df.collect())
    assert key(corpus_pipeline.run(spark, sf)) == key(want)


def test_names_and_oracle():
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    assert isinstance(corpus_pipeline.MIX, mixing.Mix)
