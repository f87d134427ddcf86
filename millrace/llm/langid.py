"""Language identification: several n-gram centroids per language, nearest by cosine, with a distance limit."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import crc, mapped, sampled

UNKNOWN = "und"
BUCKETS = 1 << 13
CENTROIDS = 4            # per language
SAMPLE_ROWS = 300        # labelled documents per language that the centroids are fitted on
LENGTH_CLASSES = (64, 256, 1024)  # n-grams; a distance limit is learned for each class above the first
CLASS_ROWS = 20          # sampled documents that a class needs for a limit of its own
LOWEST = 0.01           # quantile of the sampled cosines of a class that its limit is taken from: outliers do not set it
SLACK = 0.4             # a text may lie farther than that, by this factor of the cosine
SHORT_LEAST = 0.02       # texts shorter than the first class need little more than shared n-grams
CLUSTER_ROWS = 5         # smaller clusters are outliers and give no centroid
SHARPNESS = 20.0         # of the score

_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of a text's hashed letter bigrams and trigrams, word ends included; None if it has no letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le"), "<u4")
    letter = letters()[codes]
    if not letter.any():
        return None
    # One blank stands for everything between two words.
    codes = np.where(letter, codes, 32)
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    codes = np.concatenate(([32], codes[kept], [32])).astype(np.uint32)
    two = codes[:-1] * np.uint32(0x9E3779B1) ^ codes[1:] * np.uint32(0x85EBCA77)
    three = two[:-1] * np.uint32(0xC2B2AE3D) ^ codes[2:] * np.uint32(0x27D4EB2F)
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    mixed = np.concatenate((two * np.uint32(0x165667B1) >> shift, three * np.uint32(0x165667B1) >> shift))
    return np.bincount(mixed, minlength=BUCKETS)


@dataclass(frozen=True)
class Centroids:
    """The fitted model: unit centroids, the language of each, idf weights and least cosines."""

    languages: list[str]
    owner: np.ndarray      # language number of each centroid
    centroids: np.ndarray  # (BUCKETS, centroids)
    idf: np.ndarray
    least: np.ndarray      # (languages, length classes): smaller cosines are rejected

    def vector(self, counts: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The unit TF-IDF vector of counts in the buckets ``at``."""
        weighted = np.log1p(counts.astype(np.float32)) * self.idf[at]
        return weighted / max(float(weighted @ weighted) ** 0.5, 1e-9)

    def predict(self, text: str | None) -> tuple[str, float, float, bool]:
        """(language, score, cosine, rejected) of one whole text."""
        counts = gram_counts(text)
        if counts is None or not self.languages:
            return UNKNOWN, 0.0, 0.0, counts is None
        at = np.flatnonzero(counts)
        cosines = self.vector(counts[at], at) @ self.centroids[at]
        best = np.full(len(self.languages), -1.0)
        np.maximum.at(best, self.owner, cosines)
        first = int(best.argmax())
        odds = np.exp(SHARPNESS * (best - best[first]))
        limit = self.least[first, np.searchsorted(LENGTH_CLASSES, counts.sum(), side="right")]
        return self.languages[first], float(1 / odds.sum()), float(best[first]), bool(best[first] < limit)


def _clusters(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids of spherical k-means, started at vectors far from each other."""
    chosen = [vectors[0]]
    nearest = vectors @ vectors[0]
    while len(chosen) < min(k, len(vectors)):
        chosen.append(vectors[int(nearest.argmin())])
        nearest = np.maximum(nearest, vectors @ chosen[-1])
    centroids = np.array(chosen)
    for _ in range(rounds):
        member = (vectors @ centroids.T).argmax(axis=1)
        for c in range(len(centroids)):
            if (member == c).any():
                mean = vectors[member == c].mean(axis=0)
                centroids[c] = mean / max(np.linalg.norm(mean), 1e-9)
    members = np.bincount((vectors @ centroids.T).argmax(axis=1), minlength=len(centroids))
    return centroids[members >= min(CLUSTER_ROWS, members.max())]


def _limits(cosine: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Least cosine per length class, from a quantile of the sample's own distances."""
    lengths = np.searchsorted(LENGTH_CLASSES, grams, side="right")
    everyone = SLACK * np.quantile(cosine[lengths > 0], LOWEST) if (lengths > 0).any() else SHORT_LEAST
    own = [SLACK * np.quantile(cosine[lengths == c], LOWEST) if (lengths == c).sum() >= CLASS_ROWS else everyone
           for c in range(1, len(LENGTH_CLASSES) + 1)]
    return np.array([SHORT_LEAST, *own])


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        sample_rows: int = SAMPLE_ROWS) -> Centroids:
    """Centroids learned from ``labelled`` rows (a null language is not a label).

    Document frequencies are counted over all of them.  The centroids are
    fitted on at most ``sample_rows`` documents per language, those with the
    smallest hash of their key; languages are few by their meaning.  Without a
    labelled row the model knows no language and rejects only texts without a letter.
    """
    spark = labelled.sparkSession
    rows = labelled.filter(F.col(lang).isNotNull()).select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for t in batch.column("text"):
                if (grams := gram_counts(t.as_py())) is not None:
                    found += grams > 0
                    n += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(np.arange(BUCKETS), -1)), pa.array(np.append(found, n))], ["bucket", "docs"])

    counted = mapped(rows.select("text"), count, "bucket bigint, docs bigint").groupBy("bucket").agg(F.sum("docs"))
    frequency = np.zeros(BUCKETS + 1)
    for bucket, docs in counted.collect():
        frequency[bucket] = docs
    idf = (np.log((1 + frequency[-1]) / (1 + frequency[:-1])) + 1).astype(np.float32)

    places = sampled(rows.select("key", "lang"), "lang", "key", sample_rows)
    # At most sample_rows keys per language; the texts join them without being shuffled.
    sample = rows.select("key", "text").join(F.broadcast(places), "key")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, at, counts = [], [], []
            for i, t in enumerate(batch.column("text")):
                if (found := gram_counts(t.as_py())) is not None:
                    kept.append(i)
                    at.append(np.flatnonzero(found).astype(np.int32))
                    counts.append(found[at[-1]].astype(np.int32))
            taken = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").take(taken), batch.column("place").take(taken),
                 pa.array(at, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
                ["lang", "place", "at", "counts"])

    kind = "lang string, place int, at array<int>, counts array<int>"
    features = mapped(sample.select("lang", "place", "text"), grams, kind).toPandas()
    features = features.sort_values(["lang", "place"])
    languages = sorted(set(features["lang"]))
    model = Centroids(languages, np.zeros(0, int), np.zeros((BUCKETS, 0), np.float32), idf, np.zeros((0, 0)))
    owner, centroids, least = [], [], []
    for number, language in enumerate(languages):
        mine = features[features["lang"] == language]
        dense = np.zeros((len(mine), BUCKETS), np.float32)
        for row, at, counts in zip(dense, mine["at"], mine["counts"]):
            row[at] = model.vector(np.asarray(counts), at)
        found = _clusters(dense, CENTROIDS)
        least.append(_limits((dense @ found.T).max(axis=1), np.array([sum(c) for c in mine["counts"]])))
        centroids.append(found)
        owner += [number] * len(found)
    if languages:
        model = Centroids(languages, np.array(owner), np.ascontiguousarray(np.concatenate(centroids).T), idf,
                          np.array(least))
    return model


def predict(docs: DataFrame, model: Centroids, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score, cosine, rejected) of every row, from its whole text alone.

    A null text or one without a letter is UNKNOWN with score 0, and rejected.
    ``rejected`` also marks texts farther from their language's centroids than
    all but LOWEST of its sampled documents of that length are (by SLACK); they keep the nearest
    language as their prediction.
    """
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = dict(source.dtypes)["key"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            found = [known.predict(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *(pa.array([f[i] for f in found], t) for i, t in
                                        enumerate((pa.string(), pa.float64(), pa.float64(), pa.bool_())))],
                ["key", "lang_pred", "score", "cosine", "rejected"])

    schema = f"key {kind}, lang_pred string, score double, cosine double, rejected boolean"
    return mapped(source, run, schema).withColumnRenamed("key", key)


def held_out(key: str = "doc_id"):
    """Rows that are never learned from: a quarter, by the crc32 of the key."""
    return F.coalesce(F.pmod(crc(key), F.lit(4)) == 2, F.lit(False))


def accepted(docs: DataFrame, model: Centroids, text: str = "text") -> DataFrame:
    """``docs`` without the rows that the model rejects; every column as it was."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            good = [not known.predict(t.as_py())[3] for t in batch.column(text)]
            yield batch.filter(pa.array(good, pa.bool_()))

    shared = docs.sparkSession.sparkContext.broadcast(model)
    return mapped(docs, run, docs.schema)
