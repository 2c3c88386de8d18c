"""Token ids in directly addressable codes: any token can be read without decoding a block.

An id is split into 8-bit chunks, lowest first. Level l holds the l-th chunk of every id that has one,
a bitmap saying which of them go on, and a rank directory with the number of set bits before every
512th bit. The place of an id's next chunk is the rank of its bit, so a random read costs one step a level.

File format of a shard (little-endian): magic ``DAC1``; uint32 levels; uint64 ids; for each level uint64
chunks, the chunks, ceil(chunks / 8) bytes of bitmap (bit i of byte j: chunk 8 j + i), and
ceil(chunks / 512) uint64 ranks. Shards are the ``codes`` column of a Parquet table, so that any store
Spark writes to can hold them; beside each are its document ids and their starts.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricepanel.llm.common import drained, stored, text_batches

_RANK = 512
_SHARD = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())), ("codes", pa.binary())])
_DOC = pa.schema([("_doc", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
#: How the byte-level pre-tokenizer cuts a text before bytes are merged (fixed values).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts with a space or newline between other white space, or between that and the end: there it does not begin a part (RE2).
_RUN = "[W][ \\n](?:[W]|\\z)".replace("W", r"\s\x0b\x1c-\x1f\x{85}\pZ")
#: What may follow a word of letters as a part of its own.
_TAIL = ".,;:!?"


class Encoder:
    """Ids of texts, the end id appended.

    A byte-level tokenizer that neither normalizes nor adds a space to the first word cuts a text before every single
    space or newline, then by PATTERN, and merges bytes inside the parts alone. So the library encodes each distinct part
    once: words of letters and what follows them are told apart by Arrow, other pieces are cut by PATTERN. Whole
    texts go to the library where that does not hold: texts with the content of an added token or a space or newline
    inside other white space, and any other kind of tokenizer.
    """

    def __init__(self, path: str, end_id: int = 0, most: int = 900_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.end, self.most = Tokenizer.from_file(path), end_id, most
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        kind = made.get("pre_tokenizer") or {}
        self.cuts = made.get("normalizer") is None and made["model"]["type"] == "BPE" and kind.get("type") == "ByteLevel" and kind.get("use_regex", True) and not kind.get("add_prefix_space")
        self.cut = regex.compile(PATTERN).findall
        self._clear()

    def _clear(self) -> None:
        """Forget all pieces: ids of number i are ids[starts[i] : starts[i + 1]]; number 0 has none."""
        self.words: dict[str, dict[str, int]] = {" ": {}, "\n": {}}  # letters after a space, or without one
        self.pieces: dict[str, int] = {"": 0}  # any other, as it is
        self.ids, self.starts, self.n = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), 1

    def library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _add(self, known: dict[str, int], pieces: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, first = self.n, self.starts[self.n]
        while first + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(pieces) >= len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.ids[first : first + len(ids)] = ids
        self.starts[n + 1 : n + 1 + len(pieces)] = first + np.cumsum(sizes)
        known.update(zip(pieces, range(n, n + len(pieces)), strict=True))
        self.n += len(pieces)

    def of(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these pieces one after another, and how many each has."""
        size = self.starts[number + 1] - self.starts[number]
        total = np.cumsum(size)
        return self.ids[np.repeat(self.starts[number] - total + size, size) + np.arange(total[-1] if len(total) else 0)], size

    def _words(self, words: list[str], before: str, block: int = 200) -> np.ndarray:
        """Numbers of words of letters, with the space ``before`` them or without the newline; new ones are encoded in rows, as parts of one text."""
        known, lead = self.words[before], before.strip("\n")
        found = list(map(known.get, words))
        if None in found:
            new = [w for w, i in zip(words, found, strict=True) if i is None]
            rows = [new[at : at + block] for at in range(0, len(new), block)]
            ids, sizes = [], []
            for row, e in zip(rows, self.tokenizer.encode_batch([lead + before.join(row) for row in rows], add_special_tokens=False), strict=True):
                some, part = np.array(e.ids, np.uint32), np.array(e.word_ids, np.int64)
                if before == "\n":  # each second part is the newline
                    some, part = some[part % 2 == 0], part[part % 2 == 0] // 2
                size = np.bincount(part, minlength=len(row))
                if len(size) != len(row) or (size == 0).any() or (before == "\n" and e.word_ids[-1] != 2 * len(row) - 2):  # the library cuts one of them
                    each = self.library([lead + w for w in row])
                    some, size = np.array([i for x in each for i in x], np.uint32), np.array([len(x) for x in each])
                ids.append(some)
                sizes.append(size)
            self._add(known, new, np.concatenate(ids), np.concatenate(sizes))
            found = list(map(known.__getitem__, words))
        return np.array(found, np.int64)

    def _others(self, words: list[str]) -> np.ndarray:
        """Numbers of any pieces of text, cut into parts."""
        new = [*dict.fromkeys(w for w in words if w not in self.pieces)]
        if new:
            cut = [self.cut(w) for w in new]
            parts = [*dict.fromkeys(p for c in cut for p in c if p not in self.pieces)]
            if parts:
                ids = self.library(parts)
                sizes = np.fromiter(map(len, ids), np.int64, len(ids))
                self._add(self.pieces, parts, np.fromiter(chain.from_iterable(ids), np.uint32), sizes)
            cut, new = [c for c in cut if len(c) > 1], [w for w, c in zip(new, cut, strict=True) if len(c) > 1]
            ids, sizes = self.of(np.array([self.pieces[p] for c in cut for p in c], np.int64))
            ends = np.r_[0, np.cumsum(sizes)][np.cumsum([len(c) for c in cut])] if cut else np.zeros(0, np.int64)
            self._add(self.pieces, new, ids, np.diff(ends, prepend=0))
        return np.array(list(map(self.pieces.__getitem__, words)), np.int64)

    def _whole(self, column: pa.Array) -> np.ndarray:
        """Texts that the library must see whole."""
        if not self.cuts:
            return np.ones(len(column), bool)
        out = pc.match_substring_regex(column, _RUN).to_numpy(zero_copy_only=False)
        for content in self.added:
            out = out | pc.match_substring(column, content).to_numpy(zero_copy_only=False)
        return out

    def flat(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a string column (null: empty) one after another, and each text's start among them (one number more)."""
        column = column.cast(pa.string()).fill_null("")
        if not len(column):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        if self.n > self.most or self.starts[self.n] > 16 * self.most:
            self._clear()
        whole = self._whole(column)
        # A newline begins a piece, as a space does, but stays in it.
        cut = pc.split_pattern(pc.replace_substring(pc.if_else(pa.array(whole), "", column) if whole.any() else column, "\n", " \n"), " ")
        at, flat = cut.offsets.to_numpy() - cut.offsets[0].as_py(), cut.flatten()
        line = pc.starts_with(flat, "\n").to_numpy(zero_copy_only=False)
        bare = line.copy()
        bare[at[:-1]] = True  # no space before the first of a text
        body = pc.utf8_ltrim(flat, characters="\n")
        cores = pc.utf8_rtrim(body, characters=_TAIL)
        tail = (pc.binary_length(body).to_numpy() - pc.binary_length(cores).to_numpy()).astype(np.int64)
        letters = pc.utf8_is_alpha(cores).to_numpy(zero_copy_only=False) & (tail <= 4)
        number = np.zeros((len(flat), 3), np.int64)  # the newline, the word, its tail

        number[letters & line, 0] = self._others(["\n"])[0]
        for before, here in ((" ", letters & ~bare), ("\n", letters & bare)):
            coded = pc.dictionary_encode(cores.filter(pa.array(here)))
            number[here, 1] = self._words(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), before)[coded.indices.to_numpy()]
        for n in range(1, 5):
            here = np.flatnonzero(letters & (tail == n))
            if len(here):
                coded = pc.dictionary_encode(pc.utf8_slice_codeunits(flat.take(pa.array(here)), -n))
                number[here, 2] = self._others(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        rest = np.flatnonzero(~letters)
        number[rest, 1] = self._others((np.where(bare[rest], "", " ").astype(object) + flat.take(pa.array(rest)).to_numpy(zero_copy_only=False)).tolist())

        ids, sizes = self.of(number.ravel())
        length = np.diff(np.r_[0, np.cumsum(sizes)][3 * at])
        of_text = length.copy()
        texts = np.flatnonzero(whole).tolist()
        own = dict(zip(texts, self.library([column[i].as_py() for i in texts]), strict=True)) if texts else {}
        for i, x in own.items():
            length[i] = len(x)
        starts = np.r_[0, np.cumsum(length + 1)]
        out = np.full(starts[-1], self.end, np.uint32)
        for i, x in own.items():
            out[starts[i] : starts[i] + len(x)] = x
            of_text[i] = 0
        out[np.repeat(starts[:-1] - np.cumsum(of_text) + of_text, of_text) + np.arange(len(ids))] = ids
        return out, starts

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Of each text the ids as little-endian uint32 bytes."""
        ids, starts = self.flat(pa.array(texts, pa.string()))
        return [ids[a:b].astype("<u4").tobytes() for a, b in pairwise(starts.tolist())]


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, end_id: int = 0) -> Encoder:
    """One encoder for each worker process; it runs on the task's core alone."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = Encoder(path, end_id)
    return _ENCODERS[path, end_id]


def pack_codes(ids: np.ndarray) -> bytes:
    """The bytes of a shard."""
    levels, rest = [], ids.astype(np.uint64)
    while True:
        more = rest >> np.uint64(8) > 0
        bits = np.packbits(more, bitorder="little").tobytes()
        ranks = np.add.reduceat(more, np.arange(0, len(more), _RANK), dtype=np.uint64) if len(more) else np.zeros(0, np.uint64)
        ranks = np.cumsum(ranks, dtype=np.uint64) - ranks
        levels.append(struct.pack("<Q", len(rest)) + (rest & np.uint64(255)).astype(np.uint8).tobytes() + bits + ranks.astype("<u8").tobytes())
        if not more.any():
            return b"DAC1" + struct.pack("<IQ", len(levels), len(ids)) + b"".join(levels)
        rest = rest[more] >> np.uint64(8)


class Codes:
    """Read access to a shard's bytes."""

    def __init__(self, data: bytes):
        if data[:4] != b"DAC1":
            raise ValueError("not a shard of token codes")
        n_levels, self.n = struct.unpack_from("<IQ", data, 4)
        self.levels, at = [], 16
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<Q", data, at)
            chunks = np.frombuffer(data, np.uint8, n, at + 8)
            bits = np.frombuffer(data, np.uint8, -(-n // 8), at + 8 + n)
            ranks = np.frombuffer(data, "<u8", -(-n // _RANK), at + 8 + n + len(bits))
            self.levels.append((chunks, bits, ranks))
            at += 8 + n + len(bits) + 8 * len(ranks)

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        """One id: a chunk of each level, its place found by rank."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level, (chunks, bits, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << 8 * level
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // _RANK
            before = np.unpackbits(bits[block * _RANK // 8 : (i >> 3) + 1], bitorder="little")[: i - block * _RANK]
            i = int(ranks[block]) + int(before.sum())
        return value

    def all(self) -> np.ndarray:
        out, at = np.zeros(self.n, np.uint32), np.arange(self.n)
        for level, (chunks, bits, _) in enumerate(self.levels):
            out[at] |= chunks.astype(np.uint32) << np.uint32(8 * level)
            at = at[np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)]
        return out


def _encoded(path: str, end_id: int, shard_tokens: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, shard = encoder(path, end_id), TaskContext.get().partitionId(), 0
        docs, starts, ids, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal shard, held
            codes = pack_codes(np.concatenate(ids))
            out = drained({"part": [part], "shard": [shard], "n_tokens": [held], "doc_ids": [list(docs)], "starts": [list(starts)], "codes": [codes]}, _SHARD)
            for x in (docs, starts, ids):
                x.clear()
            shard, held = shard + 1, 0
            return out

        for batch in text_batches(it):
            coded, places = encode.flat(batch.column(1))
            for doc, (a, b) in zip(batch.column(0).to_pylist(), pairwise(places.tolist()), strict=True):
                docs.append(doc)
                starts.append(held)
                ids.append(coded[a:b])
                held += b - a
                if held >= shard_tokens:
                    yield flush()
        if docs:
            yield flush()

    return run


def write_codes(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, shard_tokens: int = 1 << 20) -> DataFrame:
    """Encode every text, in ascending id order, into shards; returns the table of shards as read back.

    Null and empty texts are the end id alone. Rows that repeat an id follow each other in any order, null
    ids come first. A shard ends with the document that takes it over ``shard_tokens``.
    """
    source = docs.select(F.col(id_col).cast("long").alias("_doc"), F.col(text_col).alias("_text"))
    ordered = source.repartitionByRange("_doc").sortWithinPartitions("_doc")
    return stored(ordered.mapInArrow(_encoded(tokenizer, end_id, shard_tokens), "part int, shard int, n_tokens long, doc_ids array<long>, starts array<long>, codes binary"), "token-codes")


def located(shards: DataFrame) -> DataFrame:
    """Each shard's first place among all tokens: sums over parts, then inside each part."""
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    parts = parts.select("part", (F.sum("_n").over(Window.orderBy("part")) - F.col("_n")).alias("_of_part"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_tokens")
    found = shards.select("part", "shard", inside.alias("_inside"), "n_tokens").join(parts, "part").select("part", "shard", (F.col("_inside") + F.col("_of_part")).alias("first"))
    return stored(found, "token-starts")  # its size is then known, so the shards themselves need no shuffle where it is small


def _decoded(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        for row in range(batch.num_rows):
            first, docs, starts, codes = (batch.column(c)[row].as_py() for c in ("first", "doc_ids", "starts", "codes"))
            ids = Codes(codes).all()
            ends = [*starts[1:], len(ids)]
            crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts, ends, strict=True)]
            yield drained({"_doc": docs, "start": [first + a for a in starts], "n_tokens": [b - a for a, b in zip(starts, ends, strict=True)], "ids_crc32": crc}, _DOC)


def read_codes(shards: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document, from the shards: id, start, n_tokens, ids_crc32."""
    placed = shards.select("part", "shard", "doc_ids", "starts", "codes").join(located(shards), ["part", "shard"])
    return placed.mapInArrow(_decoded, "_doc long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("_doc", id_col)
