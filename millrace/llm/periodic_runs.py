"""Runs of repeated words (stretches with a period), found through string synchronising sets at dyadic scales."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import mapped

LEAST_LENGTH = 24
REPEATS = 3           # a run is at least so many periods long
SMALL = LEAST_LENGTH // REPEATS   # periods looked for one by one; those above have runs of REPEATS periods or more

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _joined(x: np.ndarray, y: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit name of two stretches in a row, from theirs."""
    return _mixed(x * _A + y * _B + np.uint64(salt))


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every stretch of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], same.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


def _synchronising(names: np.ndarray, tau: int, periodic: np.ndarray) -> np.ndarray:
    """A string synchronising set: whether a position belongs depends on the 2 tau words from it alone.

    ``names`` names the tau words from each position (tau is a power of two), ``periodic``
    marks those with a period of at most tau / 3, which take no part.  Any tau
    positions in a row hold one of the set unless all words from them have such a period.
    """
    worst = np.uint64((1 << 64) - 1)
    own = np.where(periodic, worst, np.minimum(names, worst - np.uint64(1)))
    low, width = own, 1
    while width < tau:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[:len(own) - tau], own[tau:])  # over tau + 1 positions
    return np.flatnonzero((low < worst) & ((low == own[:len(low)]) | (low == own[tau:])))


def _pairs(names: np.ndarray, at: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of neighbours with one name that lie ``least`` < distance <= ``most`` apart."""
    order = np.argsort(names, kind="stable")
    names, at = names[order], at[order]
    apart = at[1:] - at[:-1]
    near = (names[1:] == names[:-1]) & (apart > least) & (apart <= most)
    return at[:-1][near], apart[near]


class _Names:
    """Names of all stretches of 1, 2, 4, ... words of a sequence."""

    def __init__(self, words: np.ndarray, longest: int):
        self.n = len(words)
        self.of = [_mixed(words.astype(np.uint64) + np.uint64(1))]
        while 2 << len(self.of) - 1 <= longest:
            x, half = self.of[-1], 1 << len(self.of) - 1
            self.of.append(_joined(x[:-half], x[half:], len(self.of)))

    def extended(self, at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest stretch around each ``at`` in which words ``period`` apart are the same."""
        right, left = at.copy(), at.copy()
        for k in range(len(self.of) - 1, -1, -1):
            name, step = self.of[k], 1 << k
            # A step may be taken twice: the longest stretch need not fit into one step of each size.
            for _ in range(2):
                inside = right + period + step <= self.n
                to = np.where(inside, right, 0)
                ok = inside & (name[to] == name[np.where(inside, right + period, 0)])
                right = right + ok * step
                inside = left - step >= 0
                to = np.where(inside, left - step, 0)
                ok = inside & (name[to] == name[np.where(inside, left - step + period, 0)])
                left = left - ok * step
        return left, right + period


def runs(words: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """(start, end, smallest period) of every run of a sequence of word numbers, by start and period.

    A run is a stretch of at least LEAST_LENGTH words and REPEATS periods that
    no neighbouring word extends.  ``longest`` bounds the length of a run (of
    the longest of the texts that stand in ``words`` one after the other).

    Periods up to SMALL are found by comparing the words that far apart.  A
    longer period q lies in (2 tau, 4 tau] for one power of two tau.  There the
    run's first 3 q words hold a position of the synchronising set of tau whose
    following words, 3 tau or 4 tau of them and no fewer than q, come again q
    words later and not before, since their period is q.  So neighbours of one
    name propose every period, and extending them gives the runs.  What the set
    leaves out has a period of at most tau / 3 and is known from before.
    """
    words = np.asarray(words, np.int64)
    found: dict[tuple[int, int], int] = {}
    low: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # highly periodic regions: begin, end, period

    def add(begin: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        kept = np.flatnonzero(end - begin >= REPEATS * period)
        if not len(kept):
            return
        begin, end, period = np.unique(np.stack([begin[kept], end[kept], period[kept]]), axis=1)
        low.append((begin, end, period))
        for b, e, q in zip(begin.tolist(), end.tolist(), period.tolist()):
            # A run with period q has its multiples as periods too, over the same words.
            if e - b >= LEAST_LENGTH and q < found.get((b, e), 1 << 62):
                found[b, e] = q

    longest = min(longest, len(words))
    for q in range(1, min(SMALL, longest // REPEATS) + 1):
        begin, end = _stretches(words[:-q] == words[q:])
        add(begin, end + q, np.full(len(begin), q))
    if longest >= REPEATS * (SMALL + 1):
        names = _Names(words, longest)
        tau, k = SMALL // 2, (SMALL // 2).bit_length() - 1
        while REPEATS * (2 * tau + 1) <= longest:
            periodic = np.zeros(len(words) + 1, np.int64)
            for begin, end, period in low:
                inside = np.flatnonzero((3 * period <= tau) & (end - begin >= tau))
                np.add.at(periodic, begin[inside], 1)
                np.add.at(periodic, end[inside] - tau + 1, -1)
            one, two = names.of[k], names.of[k + 1]
            at = _synchronising(one, tau, np.cumsum(periodic)[:len(one)] > 0)
            for least, most, head, tail in ((2 * tau, 3 * tau, two, one), (3 * tau, 4 * tau, two, two)):
                here = at[at + most <= len(words)]
                start, period = _pairs(_joined(head[here], tail[here + 2 * tau], 99), here, least, most)
                if len(start):
                    begin, end = names.extended(start, period)
                    add(begin, end, period)
            tau, k = 2 * tau, k + 1
    return sorted((b, e, q) for (b, e), q in found.items())


def _numbered(texts: list[list[bytes]]) -> np.ndarray:
    """Equal numbers for equal words; texts stand in a row, with a number of its own behind each."""
    known: dict[bytes, int] = defaultdict()
    known.default_factory = known.__len__
    total = sum(map(len, texts)) + len(texts)
    out, at = np.empty(total, np.int64), 0
    for i, words in enumerate(texts):
        out[at:at + len(words)] = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        out[at + len(words)] = -1 - i
        at += len(words) + 1
    return out


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of every text, given as its words."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if texts:
        ends = np.cumsum([len(t) + 1 for t in texts])
        for b, e, q in runs(_numbered(texts), max(map(len, texts))):
            i = int(np.searchsorted(ends, b, "right"))
            found[i].append((b - int(ends[i]) + len(texts[i]) + 1, e - b, q))
    return found


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by a space, without those that lie in a run behind its first period."""
    if not found:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in found:
        kept[start + period:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept)])


SCHEMA = "n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
_RUN = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, n_words, its runs by start and period, and the text with every run cut to one period.

    Words are cut at ASCII white space of the whole text.  Every row gives a
    row, repeated ones and those with a null key too; null and blank texts have
    no words, no runs and an empty ``collapsed``.  Other columns play no part.
    Names of stretches have 64 bits, so that a wrong run is as likely as their
    collision.  The texts of an Arrow batch are searched together: memory is
    bounded by a few hundred bytes a word of a batch or of its longest text.
    """
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = dict(source.dtypes)["key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t.as_py() or "").encode().split() for t in batch.column("text")]
            found = runs_of(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([[dict(zip(("start", "length", "period"), r)) for r in f] for f in found], pa.list_(_RUN)),
                 pa.array([collapsed(t, f).decode() for t, f in zip(texts, found)], pa.string())],
                ["key", "n_words", "runs", "collapsed"])

    return mapped(source, run, f"key {kind}, {SCHEMA}").withColumnRenamed("key", key)


def strongest(found: Column) -> Column:
    """Of an array of runs by start and period, the one with the greatest exact length / period, the first of equals."""
    def better(a: Column, b: Column) -> Column:
        return F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a)

    return F.when(F.size(found) > 0, F.aggregate(found, found[0], better))
