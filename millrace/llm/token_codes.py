"""Token ids in directly addressable codes: chunk levels with continuation bitmaps and rank directories."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from millrace.llm.common import mapped

END_ID = 2
BLOCK = 1 << 16     # a block ends with the document that brings it to so many ids
RANKED = 256        # entries of a level between two numbers of its rank directory
MAGIC = b"DAC1"
CACHE_PIECES = 300_000

# Over these characters the tokenizer's pieces are the ones below; "\s" is their white space.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN_TEXT = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]*")
_PIECE = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[0-9]+| ?[^\t-\r {_LETTERS}0-9]+|"
                    r"[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")


class PieceTokens:
    """Ids of a byte-level tokenizer, one piece (a word with the space before it, a number, signs) at a time.

    Ids come from the tokenizer alone; a piece met before is looked up.  Texts
    with characters for which its pieces are not plain to see, or with the text
    of a special token, are encoded by it as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.bytes_of = [i.to_bytes(4, "little") for i in range(max(self.tokenizer.get_vocab().values()) + 1)]
        plain = [chr(i) for i in range(0x100) if _PLAIN_TEXT.fullmatch(chr(i))]
        self.written = str.maketrans({c: self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in plain})
        self.pieces, self.old_pieces = {}, {}

    def ids(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit numbers."""
        if not _PLAIN_TEXT.fullmatch(text) or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self.pieces) > CACHE_PIECES:
            self.pieces, self.old_pieces = {}, self.pieces
        known, old, found = self.pieces, self.old_pieces, _PIECE.findall(text)
        for piece in set(found).difference(known):
            known[piece] = old[piece] if piece in old else b"".join(
                [self.bytes_of[t.id] for t in self.model.tokenize(piece.translate(self.written))])
        return b"".join(map(known.__getitem__, found))


_LOADED: dict[str, PieceTokens] = {}


def _tokens(path: str) -> PieceTokens:
    if path not in _LOADED:
        _LOADED[path] = PieceTokens(path)
    return _LOADED[path]


def best_widths(longer: list[int]) -> list[int]:
    """Chunk widths of the levels that take the fewest bits.

    ``longer[s]`` is the number of ids with more than ``s`` bits (all of them
    for 0): those with an entry in a level that begins at bit ``s``.
    """
    bits = len(longer)
    rank = 32 / RANKED
    best: list[tuple[float, list[int]]] = [(0.0, [])] * (bits + 1)
    for s in range(bits - 1, -1, -1):
        best[s] = min(((longer[s] * (w + (0 if s + w == bits else 1 + rank)) + best[s + w][0], [w, *best[s + w][1]])
                       for w in range(1, bits - s + 1)), key=lambda x: x[0])
    return best[0][1]


def _places(width: int) -> Iterator[tuple[int, int, int]]:
    """Where eight chunks of ``width`` bits lie in 64-bit words: (chunk, word, bit)."""
    return ((k, *divmod(k * width, 64)) for k in range(8))


def _pack(values: np.ndarray, width: int) -> bytes:
    """Chunks in a row without gaps, the lowest bit first: eight of them take ``width`` bytes."""
    eights = -(-len(values) // 8)
    padded = np.zeros(8 * eights, np.uint64)
    padded[:len(values)] = values
    chunks = padded.reshape(-1, 8).T
    words = np.zeros((eights, -(-width // 8) + 1), np.uint64)
    for k, word, bit in _places(width):
        words[:, word] |= chunks[k] << np.uint64(bit)
        if bit + width > 64:
            words[:, word + 1] |= chunks[k] >> np.uint64(64 - bit)
    return words.astype("<u8", copy=False).view(np.uint8)[:, :width].tobytes()[:(len(values) * width + 7) // 8]


def _unpack(data: memoryview, entries: int, width: int) -> np.ndarray:
    eights = -(-entries // 8)
    flat = np.zeros(eights * width, np.uint8)
    flat[:len(data)] = np.frombuffer(data, np.uint8)
    raw = np.zeros((eights, 8 * (-(-width // 8) + 1)), np.uint8)
    raw[:, :width] = flat.reshape(eights, width)
    words, chunks = raw.view("<u8"), np.empty((eights, 8), np.uint32)
    for k, word, bit in _places(width):
        chunk = words[:, word] >> np.uint64(bit)
        if bit + width > 64:
            chunk |= words[:, word + 1] << np.uint64(64 - bit)
        chunks[:, k] = chunk & np.uint64((1 << width) - 1)
    return chunks.ravel()[:entries]


def encoded(ids: np.ndarray, widths: list[int] | None = None) -> bytes:
    """The ids (unsigned, up to 32 bits) as directly addressable codes.

    Layout, all little-endian unsigned 32-bit: MAGIC, number of ids, number of
    levels, and per level its chunk width and its entries; then per level its
    packed chunks and, but for the last, a bitmap of the entries that go on in
    the next level and its rank directory: the ones before every RANKED-th entry.
    """
    values = np.ascontiguousarray(ids, "<u4")
    if widths is None:
        lengths = np.bincount(np.frexp(values.astype(np.float64))[1], minlength=2) if len(values) else np.array([0, 0])
        above = lengths[::-1].cumsum()[::-1]
        widths = best_widths([len(values), *above[2:].tolist()])
    heads, bodies = [], []
    for k, width in enumerate(widths):
        last = k == len(widths) - 1
        heads += [width, len(values)]
        bodies.append(_pack(values & np.uint32((1 << width) - 1), width))
        if not last:
            rest = values >> np.uint32(width)
            more = rest > 0
            ones = np.concatenate(([0], np.cumsum(more)))
            bodies += [np.packbits(more, bitorder="little").tobytes(), ones[:-1:RANKED].astype("<u4").tobytes()]
            values = rest[more]
    return MAGIC + np.array([len(ids), len(widths), *heads], "<u4").tobytes() + b"".join(bodies)


class Codes:
    """Ids held as ``encoded`` writes them: any one of them, or all."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not directly addressable codes")
        view = memoryview(data)
        self.n, levels = np.frombuffer(view[4:12], "<u4").tolist()
        heads = np.frombuffer(view[12:12 + 8 * levels], "<u4").reshape(levels, 2).tolist()
        self.levels, at = [], 12 + 8 * levels
        for k, (width, entries) in enumerate(heads):
            sizes = [(entries * width + 7) // 8]
            if k < levels - 1:
                sizes += [(entries + 7) // 8, 4 * -(-entries // RANKED)]
            parts = []
            for size in sizes:
                parts.append(view[at:at + size])
                at += size
            self.levels.append((width, entries, *parts))

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        """The i-th id: one chunk a level, found by the ones before it; nothing else is decoded."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = shift = 0
        for k, (width, _, chunks, *more) in enumerate(self.levels):
            bit = i * width
            value |= (int.from_bytes(chunks[bit >> 3:(bit >> 3) + 5], "little") >> (bit & 7) & (1 << width) - 1) << shift
            shift += width
            if k == len(self.levels) - 1 or not more[0][i >> 3] >> (i & 7) & 1:
                break
            group = i // RANKED
            before = int.from_bytes(more[0][group * RANKED // 8:(i >> 3) + 1], "little") & (1 << i - group * RANKED) - 1
            i = int.from_bytes(more[1][4 * group:4 * group + 4], "little") + before.bit_count()
        return value

    def all(self) -> np.ndarray:
        """All ids in a row."""
        values, at, shift = np.zeros(self.n, np.uint32), None, 0
        for width, entries, chunks, *more in self.levels:
            part = _unpack(chunks, entries, width) << np.uint32(shift)
            if at is None:
                values, at = part, np.arange(self.n)
            else:
                values[at] |= part
            shift += width
            if more:
                at = at[np.unpackbits(np.frombuffer(more[0], np.uint8), count=entries, bitorder="little").view(bool)]
        return values


def _blocks_schema(kind: str) -> str:
    return f"part int, first bigint, n bigint, docs array<struct<key: {kind}, n: bigint>>, codes binary"


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, key: str = "doc_id", text: str = "text",
          block: int = BLOCK) -> None:
    """Writes every whole text's ids, ended by ``end_id``, to Parquet files of blocks, by ascending ``key``.

    A block holds whole documents: their keys and numbers of ids, and all ids as
    ``encoded``.  ``part`` counts the sorted stretches, ``first`` the ids before
    a block within its part.  A null text is an empty one (``end_id`` alone);
    null keys come first; rows of one key, repeated ones too, stand one after
    the other in the order they are read; other columns play no part.  A key of
    very many rows lies over several parts.  An empty table gives no block.
    """
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row"))
    kind = dict(source.dtypes)["key"]
    rows = source.repartitionByRange("key", "row").sortWithinPartitions("key", "row").select("key", "text")
    end = np.array([end_id], "<u4").tobytes()
    arrow_key = pa.struct([("key", rows.limit(0).toArrow().schema.field("key").type), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, first = _tokens(tokenizer), TaskContext.get().partitionId(), 0
        held, names, sizes = [], [], []

        def block_of() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            listed = [{"key": k, "n": n} for k, n in zip(names, sizes)]
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([first], pa.int64()), pa.array([len(ids)], pa.int64()),
                 pa.array([listed], pa.list_(arrow_key)), pa.array([encoded(ids)], pa.binary())],
                ["part", "first", "n", "docs", "codes"])

        for batch in batches:
            for name, t in zip(batch.column("key").to_pylist(), batch.column("text")):
                held.append(tokens.ids(t.as_py() or "") + end)
                names.append(name)
                sizes.append(len(held[-1]) // 4)
                if sum(sizes) >= block:
                    yield block_of()
                    first += sum(sizes)
                    held, names, sizes = [], [], []
        if held:
            yield block_of()

    mapped(rows, run, _blocks_schema(kind)).write.parquet(folder)


def blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The blocks of ``write`` with ``start``: the ids of all documents before them.

    The parts' totals are one row for each task that wrote, summed up in a row
    and broadcast, so that the codes stay where they are.
    """
    found = spark.read.parquet(folder)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = found.groupBy("part").agg(F.sum("n").alias("total")).select(
        "part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return found.join(F.broadcast(starts), "part").withColumn("start", F.col("base") + F.col("first")).drop("base", "first")


def documents(spark: SparkSession, folder: str, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """What the files hold of every document: ``key``, start, n_tokens, ids_crc32 and, with ``with_ids``, its ids."""
    found = blocks(spark, folder).select("start", "docs", "codes")
    listed = dict(found.dtypes)["docs"]
    kind = listed[listed.index(":") + 1:listed.rindex(",")]
    fields = [("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    if with_ids:
        fields.append(("ids", pa.list_(pa.int64())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                held = batch.column("docs").slice(i, 1).flatten()
                sizes = held.field("n").to_numpy(zero_copy_only=False)
                ends, ids = np.cumsum(sizes), Codes(batch.column("codes")[i].as_py()).all().astype("<u4")
                raw = memoryview(ids).cast("B")
                columns = [batch.column("start")[i].as_py() + ends - sizes, sizes,
                           [zlib.crc32(raw[4 * (b - n):4 * b]) for b, n in zip(ends.tolist(), sizes.tolist())]]
                if with_ids:
                    columns.append([ids[b - n:b] for b, n in zip(ends, sizes)])
                yield pa.RecordBatch.from_arrays(
                    [held.field("key"), *(pa.array(c, f[1]) for c, f in zip(columns, fields))], ["key", *(f[0] for f in fields)])

    schema = f"key {kind}, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids
    return mapped(found, run, schema).withColumnRenamed("key", key)


def tokens_at(spark: SparkSession, folder: str, positions: DataFrame, position: str = "position",
              cell: int = BLOCK) -> DataFrame:
    """(``position``, id) of every distinct given position: the place of an id among the ids of all documents.

    Positions and blocks meet in cells of ``cell`` positions, and a block with
    the ones asked of it in one group; the ids are looked up without decoding
    the block.  Null positions and those beyond the end give no row.
    """
    asked = positions.select(F.col(position).cast("bigint").alias("position")).filter("position >= 0").distinct()
    spans = blocks(spark, folder).filter("n > 0").select("start", "n").withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("start") / cell), F.floor((F.col("start") + F.col("n") - 1) / cell))))
    met = (asked.withColumn("cell", F.floor(F.col("position") / cell)).join(spans, "cell")
           .filter("position >= start and position < start + n").select("start", "position"))
    codes = blocks(spark, folder).filter("n > 0").select("start", "codes").join(
        met.select("start").distinct(), "start", "left_semi")

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        place, start = left.column("position").to_pylist(), right.column("start")[0].as_py()
        held = Codes(right.column("codes")[0].as_py())
        return pa.table({"position": pa.array(place, pa.int64()), "id": pa.array([held[p - start] for p in place], pa.int64())})

    found = met.groupBy("start").cogroup(codes.groupBy("start")).applyInArrow(look_up, "position bigint, id bigint")
    return found.withColumnRenamed("position", position)
