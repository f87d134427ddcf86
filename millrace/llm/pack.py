"""Packing of tokenised documents into fixed-length sequences: shortest pack first, over the length histogram."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm.common import mapped, rank_within, stored

END_ID = 1
# What a Python worker remembers, about 200 bytes each: up to twice these numbers, as the ones used since the table
# was last full and those before them.
CACHE_WORDS = 50_000
CACHE_RUNS = 300_000

# Texts of these characters only are unchanged by Unicode composition and have one-to-one lower case, so the
# tokenizer treats each run of letters, each digit and each run of signs on its own.  ("'" makes contractions.)
_PLAIN = re.compile(r"[!-&(-~À-ÖØ-öø-ÿ]+")
_PLAIN_TEXT = re.compile(r"[\t-\r -&(-~À-ÖØ-öø-ÿ]*")
_RUN = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\t-\r ]+")


def _split(text: str) -> list[str]:
    """Words of a text, cut at ASCII white space; empty ones between two spaces."""
    for space in "\t\n\r\x0b\x0c":
        text = text.replace(space, " ")
    return text.split(" ")


class WordTokens:
    """Ids of a white-space dropping tokenizer, one run of characters at a time, remembered across texts.

    Ids come from the tokenizer alone.  Because it splits texts at white space
    and between letters, digits and signs, a text's ids are its runs' ids in a
    row; a run met before is looked up.  Texts with characters for which this
    is not plain to see are cut into words, which the tokenizer encodes whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.bytes_of = [i.to_bytes(4, "little") for i in range(max(self.tokenizer.get_vocab().values()) + 1)]
        # How the tokenizer writes the bytes of the characters beyond ASCII.
        wide = [chr(i) for i in range(0xC0, 0x100) if _PLAIN.fullmatch(chr(i))]
        self.written = str.maketrans({c: self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in wide})
        self.words, self.old_words = {"": b""}, {"": b""}
        self.runs, self.old_runs = {}, {}

    def _age(self) -> None:
        if len(self.words) > CACHE_WORDS:
            self.words, self.old_words = {"": b""}, self.words
        if len(self.runs) > CACHE_RUNS:
            self.runs, self.old_runs = {}, self.runs

    def _encode(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def _encode_run(self, run: str) -> bytes:
        """The ids of one run of plain characters, which needs no splitting or normalising any more."""
        tokens = self.model.tokenize(run if run.isascii() else run.translate(self.written))
        return b"".join([self.bytes_of[t.id] for t in tokens])

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        self._age()
        plain = [_RUN.findall(t.lower()) if _PLAIN_TEXT.fullmatch(t) and "<|" not in t else None for t in texts]
        odd = {i: _split(t) for i, (t, runs) in enumerate(zip(texts, plain)) if runs is None}
        self._learn_runs(set().union(*(runs for runs in plain if runs is not None)))
        self._learn_words(set().union(*odd.values()))
        return [b"".join(map(self.words.__getitem__, odd[i])) if runs is None else
                b"".join(map(self.runs.__getitem__, runs)) for i, runs in enumerate(plain)]

    def _learn_runs(self, runs: set[str]) -> None:
        known, old = self.runs, self.old_runs
        new = runs.difference(known)
        known.update((r, old[r]) for r in new.intersection(old))
        known.update((r, self._encode_run(r)) for r in new.difference(old))

    def _learn_words(self, words: set[str]) -> None:
        """Words of texts with other characters: whole, unless they are plain themselves."""
        known, old = self.words, self.old_words
        new = words.difference(known)
        known.update((w, old[w]) for w in new.intersection(old))
        new.difference_update(old)
        plain = {w: _RUN.findall(w.lower()) for w in new if _PLAIN.fullmatch(w) and "<|" not in w}
        self._learn_runs(set().union(*plain.values()))
        known.update((w, b"".join(map(self.runs.__getitem__, runs))) for w, runs in plain.items())
        known.update((w, self._encode(w)) for w in new.difference(plain))


_LOADED: dict[str, WordTokens] = {}


def _tokens(path: str) -> WordTokens:
    if path not in _LOADED:
        _LOADED[path] = WordTokens(path)
    return _LOADED[path]


def token_pieces(docs: DataFrame, tokenizer: str, length: int, key: str = "doc_id", text: str = "text",
                 with_ids: bool = False) -> DataFrame:
    """Every document's ids, ended by END_ID, cut into pieces of at most ``length``.

    Returns ``key``, start, length, ids_crc32 (of the little-endian unsigned
    32-bit ids), doc_tokens, doc_row (tells apart rows with the same key) and,
    with ``with_ids``, the ids.  A null text is an empty one: one piece, END_ID.
    ``tokenizer`` is the file of a tokenizer that drops white space.
    """
    end, most = np.array([END_ID], "<u4").tobytes(), 4 * length
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"),
                         F.monotonically_increasing_id().alias("doc_row"))
    kind = dict(source.dtypes)["key"]
    fields = [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
    if with_ids:
        fields.append(("ids", pa.list_(pa.int64())))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(tokenizer)
        for batch in batches:
            place, rows = [], []
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for i, ids in enumerate(tokens.ids(texts)):
                ids += end
                for at in range(0, len(ids), most):
                    piece = ids[at:at + most]
                    place.append(i)
                    row = (at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4)
                    rows.append(row + (np.frombuffer(piece, "<u4"),) if with_ids else row)
            at = pa.array(place, pa.int64())
            columns = zip(*rows) if rows else [[] for _ in fields]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(at), batch.column("doc_row").take(at),
                 *(pa.array(list(c), f[1]) for c, f in zip(columns, fields))],
                ["key", "doc_row", *(f[0] for f in fields)])

    schema = (f"key {kind}, doc_row bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
              + ", ids array<bigint>" * with_ids)
    return mapped(source, cut, schema).withColumnRenamed("key", key)


def pack_histogram(histogram: dict[int, int], size: int) -> list[tuple[int, tuple[int, ...]]]:
    """Packing patterns (count, lengths) that hold every length of the histogram as often as it occurs.

    Lengths are placed longest first.  Each goes onto the open patterns with
    most room left (the shortest packs), on as many packs as the counts allow: a
    pattern of n packs of which m < n get it splits in two.  What fits nowhere
    opens packs of its own.  A length makes at most three patterns more, so
    their number has a bound whatever the number of documents.
    """
    open_: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)  # by the room that is left
    for length in sorted(histogram, reverse=True):
        left, made = histogram[length], []
        for room in sorted((r for r in open_ if r >= length), reverse=True):
            while left and open_[room]:
                count, pattern = open_[room].pop()
                if left < count:
                    open_[room].append((count - left, pattern))
                    count = left
                each = min(room // length, left // count)
                left -= each * count
                made.append((room - each * length, (count, pattern + (length,) * each)))
        if left:
            packs, rest = divmod(left, size // length)
            made += [(size - n * length, (k, (length,) * n)) for k, n in ((packs, size // length), (1, rest)) if k and n]
        for room, pattern in made:
            open_[room].append(pattern)
    return [p for same in open_.values() for p in same]


def slots(patterns: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int, int]]:
    """Where the k-th piece of a length goes: (length, first, until, per pack, first sequence, offset).

    Ranks first..until-1 of the length fill a pattern's packs, ``per pack`` in
    each.  A pattern has at most sqrt(2 size) different lengths, so this table
    is bounded by the sequence length alone.
    """
    rows, used, sequence = [], defaultdict(int), 0
    for count, pattern in patterns:
        offset = 0
        for length in dict.fromkeys(pattern):
            each = pattern.count(length)
            rows.append((length, used[length], used[length] + count * each, each, sequence, offset))
            used[length] += count * each
            offset += each * length
        sequence += count
    return rows


SLOT = "length bigint, first bigint, until bigint, each bigint, base bigint, at bigint"


def place(spark: SparkSession, pieces: DataFrame, size: int, order: list[str]) -> DataFrame:
    """Adds sequence_id and offset to every piece (column ``length``, 1 to ``size``).

    ``order`` names columns that tell the pieces of a length apart.  Only the
    histogram of lengths (at most ``size`` rows) reaches the driver.  ``pieces``
    is read three times, so give it stored.
    """
    counts = pieces.groupBy("length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.collect()}
    if any(not 1 <= n <= size for n in histogram):
        raise ValueError(f"piece lengths must be 1 to {size}")
    sizes = spark.createDataFrame([*histogram.items()], "length bigint, n bigint")
    ranked = rank_within(pieces.withColumn("_order", F.struct(*order)), "length", "_order", sizes)
    plan = spark.createDataFrame(slots(pack_histogram(histogram, size)), SLOT)
    here = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("until"))
    nth = F.col("rank") - F.col("first")
    return (ranked.join(F.broadcast(plan), "length").filter(here)
            .withColumns({"sequence_id": F.col("base") + F.floor(nth / F.col("each")).cast("bigint"),
                          "offset": F.col("at") + F.pmod(nth, F.col("each")) * F.col("length")})
            .drop("rank", "_order", "first", "until", "each", "base", "at"))


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, key: str = "doc_id", text: str = "text",
         with_ids: bool = False) -> DataFrame:
    """Pieces of all documents (see token_pieces) with their sequence_id and offset.

    Documents longer than ``size`` fill whole sequences and leave a rest; rests
    and short documents stay in one piece.  Repeated rows are packed once each;
    an empty table gives no pieces.
    """
    pieces = stored(token_pieces(docs, tokenizer, size, key, text, with_ids))
    placed = place(docs.sparkSession, pieces, size, [key, "start", "doc_row"])
    return placed.select(key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "doc_row",
                         *(["ids"] if with_ids else []))


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids, starts): the ids of every sequence in order, and where its pieces begin.

    ``placed`` comes from ``pack(..., with_ids=True)``.  A sequence is bounded, so gathering one is safe.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.offset").alias("starts"))


def padding(used: int, size: int) -> int:
    """Ids of padding in a sequence of ``used`` ids: none at a power of two, else up to ``size``."""
    return 0 if used and not used & (used - 1) else size - used
