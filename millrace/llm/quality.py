"""A quality classifier: a factorisation machine over hashed words and structure statistics.

The contract leaves no metadata to score by but a text's length, which is among its statistics.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import crc, mapped, sampled

BUCKETS = 1 << 12        # for hashed words
FACTORS = 8
SAMPLE_ROWS = 3000       # labelled documents per label value that the model is fitted on
EPOCHS = 40
BATCH = 256
RATE = 0.05
DECAY = 1e-4
THRESHOLD = 0.3          # scores from here on predict label 1

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS = {name: np.isin(np.arange(256), np.frombuffer(chars, np.uint8)) for name, chars in {
    "space": b" \t\n\x0b\x0c\r", "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)),
    "digit": b"0123456789", "stop": b".!?", "comma": b",;:", "quote": b"\"'()[]", "sign": b"#$%&*+/<=>@\\^_`{|}~-",
    "break": b"\n"}.items()}
_IS["wide"] = np.arange(256) >= 128
STATISTICS = ("length", "words", "word_length", "distinct_words", "distinct_lines", "line_length", "longest_word",
              "one_letter_words", "capital_words", "signed_words", *sorted(_IS))


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch of bytes, from running sums: no loop over stretches."""
    powers = np.cumprod(np.full(len(data), _ODD))
    sums = np.concatenate(([np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers)))
    back = np.cumprod(np.full(len(data) + 1, _ODD_INVERSE))
    mixed = (sums[ends] - sums[starts]) * back[starts]
    return (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word buckets, their weights, STATISTICS) of one whole text; a null text is an empty one."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(len(STATISTICS), np.float32)
    inside = np.concatenate(([False], ~_IS["space"][data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    lines = np.concatenate(([-1], np.flatnonzero(data == 10), [len(data)]))
    n, sizes = max(1, len(starts)), ends - starts
    words = _hashes(_LOWER[data], starts, ends)
    at, counts = np.unique((words >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32), return_counts=True)
    weights = np.log1p(counts).astype(np.float32)
    weights /= max(float(weights @ weights) ** 0.5, 1e-9)
    kinds = np.bincount(data, minlength=256)
    share = [kinds[_IS[name]].sum() / len(data) for name in sorted(_IS)]
    capital = _IS["upper"][data[starts]] & (sizes > 1) & _IS["upper"][data[np.minimum(starts + 1, len(data) - 1)]]
    signed = _IS["sign"][data[ends - 1]] if len(starts) else np.zeros(1, bool)
    line_starts, line_ends = lines[:-1] + 1, lines[1:]
    line_hashes = _hashes(data, line_starts, line_ends)
    statistics = np.array([
        np.log1p(len(data)) / 10, np.log1p(len(starts)) / 10, sizes.sum() / n / 10, len(np.unique(words)) / n,
        len(np.unique(line_hashes)) / len(line_hashes), np.log1p(len(data) / len(line_hashes)) / 10,
        np.log1p(sizes.max(initial=0)) / 5, (sizes == 1).sum() / n, capital.sum() / n, signed.sum() / n, *share],
        np.float32)
    return at, weights, statistics


@dataclass(frozen=True)
class FactorisationMachine:
    """score = sigmoid(bias + w.x + sum of pairwise <v_i, v_j> x_i x_j), read in time linear in the features."""

    bias: float
    linear: np.ndarray   # (features,)
    factors: np.ndarray  # (features, FACTORS)
    mean: np.ndarray     # of the statistics, and their spread
    spread: np.ndarray

    def row(self, at: np.ndarray, weights: np.ndarray, statistics: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        scaled = np.clip((statistics - self.mean) / self.spread, -4, 4) / 2
        return (np.concatenate([at, BUCKETS + np.arange(len(scaled))]),
                np.concatenate([weights, scaled]).astype(np.float32))

    def score(self, text: str | None) -> float:
        at, x = self.row(*features(text))
        own = self.factors[at] * x[:, None]
        # Sum of squares identity: all pairs at once, from the sum and the sum of squares.
        pairs = 0.5 * ((own.sum(axis=0) ** 2).sum() - (own ** 2).sum())
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.linear[at] @ x + pairs, -30, 30))))


def _train(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, linear weights and factors by weighted log loss, with per-parameter step sizes."""
    rng = np.random.default_rng(1)
    width = x.shape[1]
    linear, factors = np.zeros(width, np.float32), rng.normal(0, 0.02, (width, FACTORS)).astype(np.float32)
    bias, seen = 0.0, [1e-6, np.full(width, 1e-6, np.float32), np.full((width, FACTORS), 1e-6, np.float32)]
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            chosen = order[at:at + BATCH]
            b, square = x[chosen], x[chosen] ** 2
            inner = b @ factors
            raw = bias + b @ linear + 0.5 * ((inner ** 2).sum(axis=1) - square @ (factors ** 2).sum(axis=1))
            error = weight[chosen] * (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y[chosen]) / len(chosen)
            step_bias = error.sum()
            step_linear = b.T @ error + DECAY * linear
            step_factors = b.T @ (error[:, None] * inner) - (square.T @ error)[:, None] * factors + DECAY * factors
            for i, step in enumerate((step_bias, step_linear, step_factors)):
                seen[i] = seen[i] + step ** 2
            bias -= RATE * step_bias / seen[0] ** 0.5
            linear -= RATE * step_linear / np.sqrt(seen[1])
            factors -= RATE * step_factors / np.sqrt(seen[2])
    return bias, linear, factors


def held_out(key: str = "doc_id"):
    """Rows whose labels are never learned from: a fifth, by the crc32 of the key."""
    return F.coalesce(F.pmod(crc(key), F.lit(5)) == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        sample_rows: int = SAMPLE_ROWS) -> FactorisationMachine | None:
    """A model learned from ``labels`` (key, label 0 or 1) joined to their texts; held-out keys are passed over.

    At most ``sample_rows`` labelled documents per value are read, those with
    the smallest hash of their key; they weigh as their value does among all
    labels.  None if no labelled document is there.
    """
    usable = (labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out(key))
              .groupBy(F.col(key).alias("key")).agg(F.max(label).cast("int").alias("label")))
    counts = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    sample = sampled(usable, "label", "key", sample_rows).drop("place")
    # At most 2 * sample_rows rows: the bound is a parameter.
    chosen = (docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
              .join(F.broadcast(sample), "key").select("key", "label", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, weights, statistics = zip(*(features(t.as_py()) for t in batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("label"), pa.array(at, pa.list_(pa.int32())),
                 pa.array(weights, pa.list_(pa.float32())), pa.array(statistics, pa.list_(pa.float32()))],
                ["key", "label", "at", "weights", "statistics"])

    kind = dict(chosen.dtypes)["key"]
    schema = f"key {kind}, label int, at array<int>, weights array<float>, statistics array<float>"
    rows = sorted(mapped(chosen, run, schema).collect(), key=lambda r: (r["key"], len(r["at"])))
    if not rows:
        return None
    statistics = np.array([r["statistics"] for r in rows], np.float32)
    scale = FactorisationMachine(0.0, np.zeros(0), np.zeros((0, FACTORS)), statistics.mean(axis=0),
                                 np.maximum(statistics.std(axis=0), 1e-3))
    x = np.zeros((len(rows), BUCKETS + len(STATISTICS)), np.float32)
    for to, r in zip(x, rows):
        at, values = scale.row(np.array(r["at"], np.int32), np.array(r["weights"], np.float32),
                               np.array(r["statistics"], np.float32))
        to[at] = values
    y = np.array([r["label"] for r in rows], np.float32)
    share = np.array([counts.get(v, 0) / max(1, (y == v).sum()) for v in (0, 1)])
    weight = share[y.astype(int)]
    bias, linear, factors = _train(x, y, (weight / weight.mean()).astype(np.float32))
    return FactorisationMachine(float(bias), linear, factors, scale.mean, scale.spread)


def score(docs: DataFrame, model: FactorisationMachine | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, predicted) of every row, from its whole text alone.

    Empty and null texts get the score of an empty text.  Without a model every score is 0.5.
    """
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = dict(source.dtypes)["key"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            scores = [known.score(t.as_py()) if known else 0.5 for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(scores, pa.float64())], ["key", "score"])

    scored = mapped(source, run, f"key {kind}, score double").withColumnRenamed("key", key)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
