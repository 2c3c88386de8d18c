"""Conversations as marked text with a loss mask, assembled column by column.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings inside a text get a backslash after their first
character, and one more where backslashes stand there already, so that a reader takes one away and has the text as it was.
A batch is formatted without a loop over its turns: lengths of all segments, their cumulative offsets, and from these the
places in one preallocated buffer to which headers, texts and ends are copied; the buffer becomes the Arrow column.

Turns are dealt out by ranges of (conversation, turn), so a conversation of any length is formatted by many tasks, in
pieces; ``read_formatted`` puts pieces together again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricepanel.llm.common import drained, stored

#: Strings that a trainer could take for marks, of this template and of other common ones (fixed values). ``<<SYS>>`` holds ``<SYS>``.
CONTROLS = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "<SYS>", "</SYS>", "[INST]", "[/INST]")
_PIECE = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("piece", pa.int32()), ("open", pa.bool_()), ("n_turns", pa.int64()), ("formatted", pa.string()), ("loss_start", pa.list_(pa.int32())), ("loss_end", pa.list_(pa.int32()))])
_READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.int32(): "int", pa.bool_(): "boolean", pa.string(): "string"}
    return ", ".join(f"{f.name} array<int>" if pa.types.is_list(f.type) else f"{f.name} {kinds[f.type]}" for f in schema)


@dataclass(frozen=True)
class Template:
    """How turns are marked, and which strings are escaped. Start and end begin with control strings; a control string has its first character once."""

    start: str = "<|im_start|>"
    end: str = "<|im_end|>\n"
    controls: tuple[str, ...] = CONTROLS
    learnt: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        if any(not c or c.count(c[0]) > 1 or "\\" in c or "\n" in c for c in self.controls):
            raise ValueError("a control string has its first character once, no backslash and no newline")
        if not all(any(x.startswith(c) for c in self.controls) for x in (self.start, self.end)):
            raise ValueError("start and end of a turn begin with control strings")

    def patterns(self, least: str) -> list[str]:
        """For each first character: it, then backslashes and the rest of a control string."""
        firsts = sorted({c[0] for c in self.controls})
        rests = {a: "|".join(re.escape(c[1:]) for c in self.controls if c[0] == a) for a in firsts}
        return [rf"({re.escape(a)}){least}(\\*(?:{rests[a]}))" for a in firsts]

    def escaped(self, texts: pa.Array) -> pa.Array:
        for p in self.patterns(""):
            texts = pc.replace_substring_regex(texts, p, r"\1\\\2")
        return texts

    def headers(self, roles: pa.Array) -> pa.Array:
        """Start, role and newline of each turn; backslashes and newlines of a role are escaped before its control strings."""
        coded = roles.dictionary_encode()
        one_line = pc.replace_substring(pc.replace_substring(coded.dictionary, "\\", "\\\\"), "\n", "\\n")
        heads = pc.binary_join_element_wise(self.start, self.escaped(one_line), "\n", "")
        return heads.take(coded.indices)


class Reader:
    """Turns of a formatted text, as they were."""

    def __init__(self, template: Template):
        self.start, self.end = template.start.encode(), template.end.encode()
        self.marks = [re.compile(p.encode()) for p in template.patterns(r"\\")]

    def plain(self, data: bytes) -> bytes:
        if b"\\" in data:
            for p in self.marks:
                data = p.sub(rb"\1\2", data)
        return data

    def role(self, data: bytes) -> bytes:
        return re.sub(rb"\\(.)", lambda m: b"\n" if m[1] == b"n" else m[1], self.plain(data))

    def turns(self, data: bytes) -> Iterator[tuple[bytes, bytes]]:
        *turns, rest = data.split(self.end)
        if rest:
            raise ValueError("a formatted text ends with the end of a turn")
        for turn in turns:
            if not turn.startswith(self.start):
                raise ValueError("a turn begins with its start")
            head, _, body = turn[len(self.start) :].partition(b"\n")
            yield self.role(head), self.plain(body)


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a string column without nulls."""
    _, offsets, data = column.cast(pa.large_string()).buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return at - at[0], np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)


def _scatter(out: np.ndarray, to: np.ndarray, offsets: np.ndarray, data: np.ndarray, long: int = 1 << 16) -> None:
    """Copy segments of ``data`` to the places ``to``: long ones each, all others by one array of indices."""
    lengths = np.diff(offsets)
    for i in np.flatnonzero(lengths > long).tolist():
        out[to[i] : to[i] + lengths[i]] = data[offsets[i] : offsets[i + 1]]
    few = lengths <= long
    n, first = lengths[few], offsets[:-1][few]
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    out[np.repeat(to[few], n) + within] = data[np.repeat(first, n) + within]


def assembled(headers: pa.Array, texts: pa.Array, end: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all turns in one buffer, the offsets of the turns (one more), and of their texts: start and end, by turn."""
    (h_at, h_data), (t_at, t_data) = _buffers(headers), _buffers(texts)
    lengths = np.column_stack([np.diff(h_at), np.diff(t_at), np.full(len(texts), len(end))])
    ends = np.cumsum(lengths.ravel()).reshape(-1, 3)
    starts = ends - lengths
    out = np.empty(int(ends[-1, -1]) if len(ends) else 0, np.uint8)
    _scatter(out, starts[:, 0], h_at, h_data)
    _scatter(out, starts[:, 1], t_at, t_data)
    out[starts[:, 2][:, None] + np.arange(len(end))] = np.frombuffer(end, np.uint8)
    return out, np.r_[0, ends[:, -1]], np.column_stack([starts[:, 1], ends[:, 1]])


def _sized(batch: pa.RecordBatch, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of some ``most`` bytes of text, one row at least."""
    at, _ = _buffers(batch.column(2))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, side="right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def _formatted(template: Template):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, piece, before = TaskContext.get().partitionId(), 0, ()
        end = template.end.encode()
        for rows in (x for batch in it for x in _sized(batch)):
            ids, roles, texts = rows.columns
            keys, gone = ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)
            data, turn_at, text_at = assembled(template.headers(roles), template.escaped(texts), end)
            learnt = pc.is_in(roles, pa.array(template.learnt)).to_numpy(zero_copy_only=False)
            cuts = np.r_[0, np.flatnonzero((keys[1:] != keys[:-1]) | (gone[1:] != gone[:-1])) + 1, len(keys)]
            places = turn_at[cuts]
            columns = {name: [] for name in _PIECE.names}
            for k, (a, b) in enumerate(pairwise(cuts.tolist())):
                key = None if gone[a] else int(keys[a])
                spans = (text_at[a:b][learnt[a:b]] - places[k]).astype(np.int32)
                # What may go on before or after these rows is open: the task's first, and the last of each batch.
                is_open = b == len(keys) or (k == 0 and before in ((), (key,)))
                for name, value in zip(_PIECE.names, (key, part, piece, is_open, b - a, None, spans[:, 0], spans[:, 1]), strict=True):
                    columns[name].append(value)
                piece += 1
            before = (key,)
            made = pa.StringArray.from_buffers(len(places) - 1, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(data))
            yield pa.RecordBatch.from_arrays([made if f.name == "formatted" else pa.array(columns[f.name], f.type) for f in _PIECE], schema=_PIECE)

    return run


def format_chats(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", template: Template | None = None) -> DataFrame:
    """Format all conversations; returns the written table: conv_id, part, piece, open, n_turns, formatted, loss_start, loss_end.

    A conversation is one row, or (``open`` is true) some, in the order of part and piece. loss_start and loss_end are the
    UTF-8 places in ``formatted`` of the texts to learn from, in order. Turns come by number, those without one first, of
    equal numbers by role, then text. Null texts and roles are empty; rows without a conversation are one of their own;
    repeated rows are turns each. Other columns are not read. Without rows the table is empty.
    """
    template = template or Template()
    rows = turns.select(F.col(conv_col).cast("long").alias("_c"), F.col(turn_col).alias("_t"), F.coalesce(role_col, F.lit("")).alias("_r"), F.coalesce(text_col, F.lit("")).alias("_x"))
    dealt = rows.repartitionByRange("_c", "_t", "_r").sortWithinPartitions("_c", "_t", "_r", "_x").select("_c", "_r", "_x")
    return stored(dealt.mapInArrow(_formatted(template), _ddl(_PIECE)), "chats")


def _digests(template: Template):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, rows = Reader(template), {name: [] for name in _READ.names}
        now, whole, loss, n, learnt, chars = (), hashlib.sha256(), hashlib.sha256(), 0, 0, 0

        def close() -> None:
            for name, value in zip(_READ.names, (*now, n, whole.hexdigest(), learnt, loss.hexdigest(), chars), strict=True):
                rows[name].append(value)

        for batch in it:
            for i in range(batch.num_rows):
                key, text, starts, ends = (batch.column(c)[i].as_py() for c in ("conv_id", "formatted", "loss_start", "loss_end"))
                if now != (key,):
                    if now:
                        close()
                    now, whole, loss, n, learnt, chars = (key,), hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                data = text.encode()
                for role, body in reader.turns(data):
                    whole.update(role + b"\n" + body + b"\n")
                    n += 1
                for a, b in zip(starts, ends, strict=True):
                    said = reader.plain(data[a:b])
                    loss.update(said)
                    learnt += len(said.decode())
                chars += len(text)
            if rows["n_turns"]:
                yield drained(rows, _READ)
        if now:
            close()
            yield drained(rows, _READ)

    return run


def read_formatted(chats: DataFrame, template: Template | None = None) -> DataFrame:
    """Per conversation, from the written table: n_turns, digests of its turns and of what is learnt, and lengths in code points.

    Whole conversations are read where they lie; pieces of the others are sorted together. A digest takes a conversation's
    bytes in their order, so a very long one is read by one task, piece by piece.
    """
    template, need = template or Template(), ("conv_id", "formatted", "loss_start", "loss_end")
    read = lambda rows: rows.select(*need).mapInArrow(_digests(template), _ddl(_READ))
    pieces = chats.where("open").repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")
    return read(chats.where("not open")).unionByName(read(pieces))
