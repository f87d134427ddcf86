"""Chat formatting: records of many layouts become canonical turns, turns become marked text, and back."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from millrace.llm.common import mapped

# ---------------------------------------------------------------- layouts


@dataclass(frozen=True)
class Listed:
    """One turn per element of the array at ``path``; ``role`` and ``text`` are fields of an element."""

    path: str
    role: str
    text: str


@dataclass(frozen=True)
class Fields:
    """Turns read from fields of the record, in order: (role, fields); fields of a turn are joined by a blank line."""

    turns: tuple[tuple[str, tuple[str, ...]], ...]


@dataclass(frozen=True)
class Rows:
    """The record is one turn of a conversation."""

    turn: str
    role: str
    text: str


# A layout is known by its field paths, without the key; "[]" marks an array.
LAYOUTS: dict[frozenset[str], Listed | Fields | Rows] = {
    frozenset({"turn", "role", "text"}): Rows("turn", "role", "text"),
    frozenset({"messages[].role", "messages[].content"}): Listed("messages", "role", "content"),
    frozenset({"conversations[].from", "conversations[].value"}): Listed("conversations", "from", "value"),
    frozenset({"prompt", "completion"}): Fields((("user", ("prompt",)), ("assistant", ("completion",)))),
    frozenset({"prompt", "response"}): Fields((("user", ("prompt",)), ("assistant", ("response",)))),
    frozenset({"system", "prompt", "response"}):
        Fields((("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    frozenset({"instruction", "output"}): Fields((("user", ("instruction",)), ("assistant", ("output",)))),
    frozenset({"instruction", "input", "output"}):
        Fields((("user", ("instruction", "input")), ("assistant", ("output",)))),
    frozenset({"question", "answer"}): Fields((("user", ("question",)), ("assistant", ("answer",)))),
}
# Role names of other layouts and what they are called here; other names stay as they are.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def fingerprint(paths: Iterable[str]) -> str:
    """The hash of a set of field paths, whatever their order."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


BY_FINGERPRINT = {fingerprint(paths): (paths, mapping) for paths, mapping in LAYOUTS.items()}


def schema_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Field paths of a Spark type."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, f"{at}[]")
    return [at]


def value_paths(value, at: str = "") -> set[str]:
    """Field paths of a parsed JSON value; an empty array shows as its own path."""
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in value_paths(v, f"{at}.{k}" if at else k)}
    if isinstance(value, list) and value:
        return {p for v in value for p in value_paths(v, f"{at}[]")}
    return {f"{at}[]" if isinstance(value, list) else at}


def mapping_for(paths: Iterable[str]) -> tuple[str | None, Listed | Fields | Rows | None]:
    """(fingerprint, mapping) of the layout with exactly these paths, else of the largest layout among them.

    Of several largest the one that LAYOUTS states first counts.
    """
    here = set(paths)
    exact = fingerprint(here)
    if exact in BY_FINGERPRINT:
        return exact, BY_FINGERPRINT[exact][1]
    inside = [f for f, (p, _) in BY_FINGERPRINT.items() if p <= here]
    found = max(inside, key=lambda f: len(BY_FINGERPRINT[f][0]), default=None)
    return found, BY_FINGERPRINT[found][1] if found else None


def canonical(records: DataFrame, key: str) -> DataFrame:
    """(key, turn, role, text) of records whose layout is in the DataFrame's own schema.

    Null texts are empty ones; null roles stay null.  Columns that the mapping
    does not name play no part.  A schema that no layout fits is an error.
    """
    paths = [p for p in schema_paths(records.schema) if p != key]
    _, mapping = mapping_for(paths)
    if mapping is None:
        raise ValueError(f"no layout has the fields {sorted(paths)}")
    if isinstance(mapping, Rows):  # turns already: their roles stay as they are
        role, text, turn = F.col(mapping.role), F.col(mapping.text), F.col(mapping.turn)
        return records.select(F.col(key), turn.cast("bigint").alias("turn"), role.alias("role"),
                              F.coalesce(text, F.lit("")).alias("text"))
    if isinstance(mapping, Listed):
        rows = records.select(F.col(key), F.posexplode(mapping.path).alias("turn", "m")).select(
            key, F.col("turn").cast("bigint").alias("turn"), F.col(f"m.{mapping.role}").alias("role"),
            F.col(f"m.{mapping.text}").alias("text"))
    else:
        turns = F.array(*(F.struct(F.lit(role).alias("role"), F.concat_ws("\n\n", *(
            F.when(F.col(f) != "", F.col(f)) for f in fields)).alias("text")) for role, fields in mapping.turns))
        rows = records.select(F.col(key), F.posexplode(turns).alias("turn", "m")).select(
            key, F.col("turn").cast("bigint").alias("turn"), "m.role", "m.text")
    names = F.create_map(*(F.lit(x) for pair in ROLES.items() for x in pair))
    return rows.withColumns({"role": F.coalesce(F.try_element_at(names, F.coalesce("role", F.lit(""))), "role"),
                             "text": F.coalesce("text", F.lit(""))})


def _turns_of(record, mapping) -> list[tuple[int, str | None, str]]:
    def words(value) -> str:
        return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)

    if isinstance(mapping, Rows):
        found = [(record[mapping.turn], record[mapping.role], record[mapping.text])]
    elif isinstance(mapping, Listed):
        found = [(i, m.get(mapping.role), m.get(mapping.text)) for i, m in enumerate(record[mapping.path])]
    else:
        found = [(i, role, "\n\n".join(w for f in fields if (w := words(record[f]))))
                 for i, (role, fields) in enumerate(mapping.turns)]
    return [(int(i), ROLES.get(role, role), words(text)) for i, role, text in found]


def canonical_json(records: DataFrame, key: str, column: str) -> DataFrame:
    """(key, layout, turn, role, text) of JSON records of mixed layouts, each mapped by its own fingerprint.

    A record that is no JSON object, or of a layout that nobody declared, keeps
    one row with a null layout, turn, role and its JSON as text.
    """
    source = records.select(F.col(key).alias("key"), F.col(column).alias("json"))
    kind = dict(source.dtypes)["key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for i, line in enumerate(batch.column("json").to_pylist()):
                try:
                    record = json.loads(line or "")
                    layout, mapping = mapping_for(value_paths(record)) if isinstance(record, dict) else (None, None)
                    found = [(layout, *t) for t in _turns_of(record, mapping)] if mapping else []
                except (ValueError, TypeError, AttributeError):
                    found = []
                found = found or [(None, None, None, line)]
                at += [i] * len(found)
                rows += found
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(at, pa.int64())),
                 *(pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.string())))],
                ["key", "layout", "turn", "role", "text"])

    return mapped(source, run, f"key {kind}, layout string, turn bigint, role string, text string") \
        .withColumnRenamed("key", key)


# ---------------------------------------------------------------- template

# Marks that open and close a turn, and what divides the role from the text of any other role.
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("[ROLE]", "[:]", "[/ROLE]")
_CONTROL = sorted({m for pair in MARKS.values() for m in pair} | set(OTHER), key=len, reverse=True)
_ANY = re.compile("|".join(map(re.escape, _CONTROL)))
_ESCAPED = re.compile(r"\\(\\?)")


def escape(text: str) -> str:
    """``text`` without any mark: backslashes are doubled, and one is put behind the first character of a mark."""
    return _ANY.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str | None, text: str) -> tuple[str, int, int]:
    """(marked turn, start, end): start to end is the text of an assistant turn, which the loss covers; else 0, 0.

    A null role is an empty one.
    """
    inner = escape(text)
    if role in MARKS:
        first, last = MARKS[role]
        start = len(first)
        return f"{first}{inner}{last}", *((start, start + len(inner)) if role == "assistant" else (0, 0))
    return f"{OTHER[0]}{escape(role or '')}{OTHER[1]}{inner}{OTHER[2]}", 0, 0


def read_turns(formatted: str) -> list[tuple[str, str, bool]]:
    """(role, text, under the loss) of every turn of a formatted text."""
    opening = {pair[0]: role for role, pair in MARKS.items()}
    found, at = [], 0
    while at < len(formatted):
        first = _ANY.match(formatted, at)
        last = _ANY.search(formatted, first.end())
        if first[0] == OTHER[0]:
            role, start = unescape(formatted[first.end():last.start()]), last.end()
            last = _ANY.search(formatted, start)
        else:
            role, start = opening[first[0]], first.end()
        found.append((role, unescape(formatted[start:last.start()]), first[0] == MARKS["assistant"][0]))
        at = last.end()
    return found


def formatted_turns(turns: DataFrame, key: str) -> DataFrame:
    """(key, formatted, loss_start, loss_end): a marked text per turn, those of a conversation together and in order.

    Conversations are dealt by their key and sorted within partitions, so one
    is read as a stream and never gathered, however many turns it has.  Turns
    with the same number stand by role and text; rows without a key are one
    conversation.
    """
    ordered = (turns.select(F.col(key).alias("key"), "turn", "role", "text").repartition("key")
               .sortWithinPartitions("key", "turn", "role", "text"))
    kind = dict(ordered.dtypes)["key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [format_turn(r, t) for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())]
            texts, starts, ends = zip(*made) if made else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(texts, pa.string()), pa.array(starts, pa.int64()),
                 pa.array(ends, pa.int64())], ["key", "formatted", "loss_start", "loss_end"])

    return mapped(ordered, run, f"key {kind}, formatted string, loss_start bigint, loss_end bigint") \
        .withColumnRenamed("key", key)


def conversations(formatted: DataFrame, key: str) -> DataFrame:
    """(key, text, loss): whole conversations, with the loss spans in code points of ``text``.

    For conversations that fit into a record; ``formatted`` comes from formatted_turns.
    """
    source = formatted.withColumnRenamed(key, "key")
    kind = dict(source.dtypes)["key"]

    def close(conversation):
        name, parts, loss, _ = conversation
        return name, "".join(parts), loss

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _grouped(batches, lambda name: [name, [], [], 0], _add_text, close, (
            ("text", pa.string()), ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))))

    return mapped(source, run, f"key {kind}, text string, loss array<struct<start: bigint, end: bigint>>") \
        .withColumnRenamed("key", key)


def _add_text(conversation, text: str, start: int, end: int) -> None:
    if (start, end) != (0, 0):
        conversation[2].append({"start": conversation[3] + start, "end": conversation[3] + end})
    conversation[1].append(text)
    conversation[3] += len(text)


def _grouped(batches, begin, add, close, columns) -> Iterator[pa.RecordBatch]:
    """Rows of neighbouring equal keys folded into one row each; keeps one conversation's fold at a time."""
    current, done, kind = None, [], None
    for batch in batches:
        kind = batch.schema.field("key").type
        rows = zip(*(batch.column(c).to_pylist() for c in ("key", "formatted", "loss_start", "loss_end")))
        for name, text, start, end in rows:
            if current is None or current[0] != name:
                if current is not None:
                    done.append(close(current))
                current = begin(name)
            add(current, text, start, end)
        if len(done) >= 512:
            yield _batch(done, kind, columns)
            done = []
    if current is not None:
        yield _batch([*done, close(current)], kind, columns)


def _batch(rows, kind, columns) -> pa.RecordBatch:
    arrays = [pa.array(c, t) for c, t in zip(zip(*rows), (kind, *(t for _, t in columns)))]
    return pa.RecordBatch.from_arrays(arrays, ["key", *(n for n, _ in columns)])


DIGEST = (("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
          ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()))


def digests(formatted: DataFrame, key: str) -> DataFrame:
    """What the formatted turns say when they are read back, one row per conversation.

    n_turns; turns_sha256 of role, newline, text, newline of every turn;
    loss_chars and loss_sha256 of all text under the loss mask, unescaped; and
    formatted_chars.  ``formatted`` comes from formatted_turns.
    """
    source = formatted.withColumnRenamed(key, "key")
    kind = dict(source.dtypes)["key"]

    def add(state, text: str, start: int, end: int) -> None:
        for role, words, _ in read_turns(text):
            state[1] += 1
            state[2].update(f"{role}\n{words}\n".encode())
        if (start, end) != (0, 0):
            covered = unescape(text[start:end])
            state[3] += len(covered)
            state[4].update(covered.encode())
        state[5] += len(text)

    def close(state):
        name, turns, told, chars, covered, size = state
        return name, turns, told.hexdigest(), chars, covered.hexdigest(), size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _grouped(batches, lambda name: [name, 0, hashlib.sha256(), 0, hashlib.sha256(), 0], add, close, DIGEST)

    return mapped(source, run, f"key {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                                  "loss_sha256 string, formatted_chars bigint").withColumnRenamed("key", key)
