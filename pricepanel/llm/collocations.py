"""Collocations: phrases of two and three words that stand together more often than their parts let expect, per language.

Words are ranked by frequency, and a pair of ranks is an address: (rank, rank) lies in a tile of SIDE x SIDE cells. Tasks
count a tile that fills by a dense ``bincount`` over its cells, others as sorted coordinates with counts, and hand over one
row of bytes for each strip of eight tiles; a strip is then summed by one task, in at most 8 x SIDE x SIDE numbers. Frequent pairs are ranked
anew by frequency, and a triple is again an address: (rank of its first pair, rank of its third word).

Ranks are a broadcast of fixed size (``ranked_words``, ``ranked_pairs``). What is frequent but has no rank is told from what is
rare by bitmaps of fixed size: frequent words by their counts, pairs with such a word by the counts of their hashes. What
the bitmaps let through is counted under its own words: slower, and as exact.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricepanel.llm.common import discard, mixed, stored, text_batches

#: A tile has 2^10 ranks on each side; second ranks have 18 bits, so a tile's number is (first >> 10) * 2^8 + (second >> 10).
_BITS, _SECOND = 10, 18
SIDE, MOST_WORDS = 1 << _BITS, 1 << _SECOND
_CELL = 2 * _BITS
_STRIP = _CELL + 3
_WORD_BITS, _PAIR_BITS = 26, 27
#: Bytes that end a piece become '.', which no word then holds; A-Z become a-z and tabs blanks.
_PIECES = bytes(46 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_CUT = re.compile(rb"[ .]")
_COUNTS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])
_PARTS = pa.schema([("lang", pa.string()), ("tile", pa.int32()), ("salt", pa.int32()), ("cells", pa.binary()), ("counts", pa.binary()), ("phrase", pa.string()), ("n", pa.int64())])
_PARTS_DDL = "lang string, tile int, salt int, cells binary, counts binary, phrase string, n long"
_FILLED = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("a", pa.int64()), ("parts", pa.list_(pa.int64())), ("x", pa.int64()), ("y", pa.int64()), ("code", pa.int64())])


def token_lists(texts: list[str], k: int, step: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words of the texts, and b'.' between pieces, in lists of some ``step`` bytes; each run of k words is whole in just one list."""
    return (words for words, _ in token_parts(texts, k, step))


def token_parts(texts: list[str], k: int, step: int = 1 << 20) -> Iterator[tuple[list[bytes], int]]:
    """The same with how many words a list repeats from the one before it, up to k - 1."""
    split = lambda data: data.replace(b".", b" . ").split()
    held, size = [], 0
    for text in texts:
        data = text.encode().translate(_PIECES)
        if len(data) > step:
            at, before = 0, []
            while at < len(data):
                cut = _CUT.search(data, at + step)
                end = cut.start() if cut else len(data)
                words = before + split(data[at:end])
                yield words, len(before)
                at, before = end, words[max(0, len(words) - k + 1) :]
            continue
        held.append(data)
        size += len(data)
        if size > step:
            yield split(b".".join(held)), 0
            held, size = [], 0
    if held:
        yield split(b".".join(held)), 0


def _by_lang(batch: pa.RecordBatch) -> dict[str, list[str]]:
    out: dict[str, list[str]] = defaultdict(list)
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        out[lang].append(text)
    return out


def _word_counts(most: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)

        def out() -> Iterator[pa.RecordBatch]:
            for lang, n in counts.items():
                n.pop(b".", None)
                n[b""] = n.total()  # all words of the language, under no word
                words, each = list(n), list(n.values())
                for at in range(0, len(words), 1 << 16):
                    part = pa.array(words[at : at + (1 << 16)], pa.binary()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), part, pa.array(each[at : at + (1 << 16)], pa.int64())], schema=_COUNTS)
            counts.clear()

        for batch in text_batches(it, 1024):
            for lang, texts in _by_lang(batch).items():
                for words in token_lists(texts, 1):
                    counts[lang].update(words)
                    if sum(map(len, counts.values())) > most:
                        yield from out()
        yield from out()

    return run


class Ranks:
    """Words and pairs of each language by rank, and bitmaps of the frequent ones without a rank."""

    def __init__(self, words: dict[str, tuple[pa.Array, np.ndarray]], word_bits: np.ndarray | None):
        self.words, self.word_bits = words, word_bits
        #: Of each language: addresses of the ranked pairs in order of address, their ranks, and counts by rank.
        self.pairs: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.pair_bits: np.ndarray | None = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("_ids", "_by_rank")}

    @cached_property
    def _ids(self) -> dict[str, dict[bytes, int]]:
        return {}

    @cached_property
    def _by_rank(self) -> dict[str, np.ndarray]:
        return {}

    def addresses(self, lang: str) -> np.ndarray:
        """Addresses of the language's ranked pairs, by rank."""
        if lang not in self._by_rank:
            keys, ranks, _ = self.pairs[lang]
            self._by_rank[lang] = np.empty_like(keys)
            self._by_rank[lang][ranks] = keys
        return self._by_rank[lang]

    def ids(self, lang: str) -> dict[bytes, int]:
        if lang not in self._ids:
            self._ids[lang] = {w: i for i, w in enumerate(self.words[lang][0].cast(pa.binary()).to_pylist() if lang in self.words else ())} | {b".": -2}
        return self._ids[lang]

    def names(self, lang: str, ids: np.ndarray) -> pa.Array:
        return self.words[lang][0].take(pa.array(ids))

    def codes(self, lang: str, words: list[bytes]) -> np.ndarray:
        """Ranks; for frequent words without one MOST_WORDS + their crc32; below 0 for rare words and breaks."""
        out = np.fromiter(map(self.ids(lang).get, words, repeat(-1)), np.int64, len(words))
        if self.word_bits is not None:
            first, mask = zlib.crc32(lang.encode() + b"\0"), (1 << _WORD_BITS) - 1
            for i in np.flatnonzero(out == -1).tolist():
                h = zlib.crc32(words[i], first)
                if self.word_bits[(h & mask) >> 3] >> (h & 7) & 1:
                    out[i] = MOST_WORDS + h
        return out

    def pair_ranks(self, lang: str, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of codes, -1 for pairs without one."""
        keys, ranks, _ = self.pairs.get(lang, (np.zeros(0, np.int64), None, None))
        out = np.full(len(a), -1, np.int64)
        if len(keys):
            ok = np.flatnonzero((a >= 0) & (b >= 0) & (a < MOST_WORDS) & (b < MOST_WORDS))
            key = a[ok] << _SECOND | b[ok]
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            out[ok] = np.where(keys[at] == key, ranks[at], -1)
        return out

    def unranked(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Can these pairs be frequent ones without a rank?"""
        if self.pair_bits is None:
            return np.zeros(len(a), bool)
        place = pair_hashes(a, b) & ((1 << _PAIR_BITS) - 1)
        return (a >= 0) & (b >= 0) & (self.pair_bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


def pair_hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """63 bits of pairs of codes; the lowest _PAIR_BITS are their places in the bitmap."""
    x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)
    return (mixed(mixed(x)) >> np.uint64(1)).astype(np.int64)


def addressed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Address of two ranks: the number of their tile, then the cell in it."""
    low = SIDE - 1
    tile = (first >> _BITS) << (_SECOND - _BITS) | second >> _BITS
    return tile << _CELL | (first & low) << _BITS | second & low


def ranks_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    tile, low = keys >> _CELL, SIDE - 1
    return (tile >> (_SECOND - _BITS)) << _BITS | (keys >> _BITS) & low, (tile & ((1 << (_SECOND - _BITS)) - 1)) << _BITS | keys & low


class Tiles:
    """Counts of addresses: dense tiles by cell, the others as sorted coordinates."""

    def __init__(self, pending: int = 1 << 20, most: int = 1 << 20, dense: int = 6, full: int = 1 << 15):
        self.pending, self.most, self.dense, self.full = pending, most, dense, full
        self.new: dict[str | None, list[np.ndarray]] = defaultdict(list)
        self.cells: dict[tuple[str, int], np.ndarray] = {}
        #: By language; hashes, whatever their language, under None.
        self.sparse: dict[str | None, tuple[np.ndarray, np.ndarray]] = {}
        self.size = 0

    def add(self, lang: str, first: np.ndarray, second: np.ndarray) -> bool:
        """True if there is so much that it should be taken away."""
        return self.put(lang, addressed(first, second))

    def put(self, lang: str | None, keys: np.ndarray) -> bool:
        self.new[lang].append(keys)
        self.size += len(keys)
        if self.size > self.pending:
            self.settle()
        return sum(len(k) for k, _ in self.sparse.values()) > self.most

    def settle(self) -> None:
        for lang, new in self.new.items():
            keys = np.concatenate(new)
            if not len(keys):
                continue
            for tile in np.flatnonzero(np.bincount(keys >> _CELL) >= self.full).tolist() if lang is not None else ():
                if (lang, tile) not in self.cells and len(self.cells) >= self.dense:
                    continue
                own = keys >> _CELL == tile
                found = np.bincount(keys[own] & ((1 << _CELL) - 1), minlength=1 << _CELL)
                if (lang, tile) in self.cells:
                    self.cells[lang, tile] += found
                else:
                    self.cells[lang, tile] = found
                keys = keys[~own]
            keys, n = np.unique(keys, return_counts=True)
            if lang in self.sparse:
                keys, n = summed(np.concatenate([self.sparse[lang][0], keys]), np.concatenate([self.sparse[lang][1], n]))
            self.sparse[lang] = keys, n
        self.new.clear()
        self.size = 0

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and counts; takes them away."""
        self.settle()
        return self.sparse.pop(None, (np.zeros(0, np.int64), np.zeros(0, np.int64)))

    def taken(self) -> Iterator[tuple[str, int, np.ndarray, np.ndarray]]:
        """Language, strip, cells in it and counts, of all but hashes; empties this of them."""
        self.settle()
        low = (1 << _STRIP) - 1
        for (lang, tile), cells in self.cells.items():
            at = np.flatnonzero(cells)
            yield lang, tile >> (_STRIP - _CELL), (tile << _CELL | at) & low, cells[at]
        for lang in [la for la in self.sparse if la is not None]:
            keys, n = self.sparse.pop(lang)
            strips = keys >> _STRIP
            cuts = np.r_[0, np.flatnonzero(strips[1:] != strips[:-1]) + 1, len(keys)]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if b > a:
                    yield lang, int(strips[a]), keys[a:b] & low, n[a:b]
        self.cells.clear()


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, ascending, with the sum of its numbers."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(n, first)


class Rows:
    """Rows of _PARTS, gathered into batches of some ``most`` bytes."""

    def __init__(self, most: int = 1 << 22):
        self.most, self.held, self.size = most, [], 0

    def add(self, lang: str, salt: int, tile: int | None = None, cells: np.ndarray | None = None, n: np.ndarray | int | None = None, phrase: bytes | None = None, kind: str = "<u4") -> Iterator[pa.RecordBatch]:
        if phrase is None:
            self.held.append((lang, tile, salt, cells.astype(kind).tobytes(), n.astype("<i8").tobytes(), None, None))
            self.size += 16 * len(n)
        else:
            self.held.append((lang, None, salt, None, None, phrase.decode(), n))
        self.size += 100
        if self.size > self.most:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for f, c in zip(_PARTS, zip(*self.held, strict=True), strict=True)], schema=_PARTS)
        self.held, self.size = [], 0


def _counted(ranks, k: int, fan_in: int, shards: int, most: int):
    """Counts runs of k = 2 or 3 words: rows of a strip of tiles, of hashes (tile below 0), or of one phrase.

    Pairs with a word without rank are counted by hash when k is 2, and by their words when k is 3, where frequent hashes are known.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, tiles, rows, salt = ranks.value, Tiles(), Rows(), TaskContext.get().partitionId() // fan_in
        phrases: dict[str, Counter] = defaultdict(Counter)

        def out() -> Iterator[pa.RecordBatch]:
            for lang, tile, cells, n in tiles.taken():
                yield from rows.add(lang, salt, tile, cells, n)
            hashes, n = tiles.hashes()
            shard = hashes % shards
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            for i in np.flatnonzero(np.diff(cuts)).tolist():
                own = order[cuts[i] : cuts[i + 1]]
                yield from rows.add("", salt, -1 - i, hashes[own], n[own], kind="<i8")
            for lang, counts in phrases.items():
                for phrase, m in counts.items():
                    yield from rows.add(lang, salt, n=m, phrase=phrase)
            phrases.clear()
            yield from rows.rest()

        for batch in text_batches(it, 1024):
            for lang, texts in _by_lang(batch).items():
                for words, repeated in token_parts(texts, k):
                    codes = model.codes(lang, words)
                    a, b = codes[:-1], codes[1:]
                    ranked = (a < MOST_WORDS) & (b < MOST_WORDS)
                    if k == 2:
                        alive = (a >= 0) & (b >= 0)
                        full = tiles.add(lang, a[alive & ranked], b[alive & ranked])
                        named = alive & ~ranked
                        full = tiles.put(None, pair_hashes(a[named], b[named])) or full
                    else:
                        pair, named = model.pair_ranks(lang, a, b), model.unranked(a, b)
                        frequent = (pair >= 0) | named
                        alive, first, last = frequent[:-1] & frequent[1:], pair[:-1], codes[2:]
                        tiled = alive & (first >= 0) & (last < MOST_WORDS)
                        full = tiles.add(lang, first[tiled], last[tiled])
                        new = named & ~ranked
                        new[: max(0, repeated - 1)] = False
                        phrases[lang].update(b" ".join(words[i : i + 2]) for i in np.flatnonzero(new).tolist())
                        phrases[lang].update(b" ".join(words[i : i + 3]) for i in np.flatnonzero(alive & ~tiled).tolist())
                    if full or sum(map(len, phrases.values())) > most:
                        yield from out()
        yield from out()

    return run


def _merged(ranks, k: int, least: int):
    """Sums the rows of each strip (column tile), which come one after the other; with ``least`` 0 as tiles again, else as phrases with their parts."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, size, dense, rows = None, [], 0, None, Rows()
        made: list[tuple[str, np.ndarray, np.ndarray, np.ndarray]] = []

        def close() -> Iterator[pa.RecordBatch]:
            if dense is None:
                cells, n = summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
            else:
                cells = np.flatnonzero(dense)
                n = dense[cells]
            lang, tile, salt = now
            if not least:
                yield from rows.add(lang, salt, tile, cells, n)
                return
            cells, n = cells[n >= least].astype(np.int64), n[n >= least]
            if len(n):
                made.append((lang, *ranks_of(tile << _STRIP | cells), n))
            if sum(len(x[3]) for x in made) > 1 << 15:
                yield from named()

        def named() -> Iterator[pa.RecordBatch]:
            model = ranks.value
            for lang in dict.fromkeys(x[0] for x in made):
                first, last, n = (np.concatenate([x[i] for x in made if x[0] == lang]) for i in (1, 2, 3))
                names = [model.names(lang, last)]
                if k == 3:
                    key = model.addresses(lang)[first]
                    names = [model.names(lang, key >> _SECOND), model.names(lang, key & (MOST_WORDS - 1)), *names]
                else:
                    names = [model.names(lang, first), *names]
                found = pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pc.binary_join_element_wise(*names, " "), pa.array(n, pa.int64())], schema=_COUNTS)
                for at in range(0, len(n), 1 << 14):
                    yield filled(model, found.slice(at, 1 << 14))
            made.clear()

        for batch in it:
            for i in range(batch.num_rows):
                lang, tile, salt, cells, n = (batch.column(c)[i].as_py() for c in range(5))
                key = (lang, tile, salt if not least else 0)
                if key != now:
                    if now:
                        yield from close()
                    now, held, size, dense = key, [], 0, None
                cells, n = np.frombuffer(cells, "<u4"), np.frombuffer(n, "<i8")
                size += len(n)
                if dense is not None:
                    dense[cells] += n
                    continue
                held.append((cells, n))
                if size > 1 << 20:
                    dense = np.zeros(1 << _STRIP, np.int64)
                    for c, m in held:
                        dense[c] += m
                    held = []
        if now:
            yield from close()
        yield from named() if least else rows.rest()

    return run


def _frequent_hashes(least: int):
    """Bits of the hashes of a shard, whose rows come one after the other, that are counted ``least`` times."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, size = None, [], 0

        def together() -> tuple[np.ndarray, np.ndarray]:
            return summed(*(np.concatenate(x) for x in zip(*held, strict=True)))

        def close() -> pa.RecordBatch:
            keys, n = together()
            return pa.RecordBatch.from_arrays([pa.array(np.unique(keys[n >= least] & ((1 << _PAIR_BITS) - 1)))], names=["place"])

        for batch in it:
            for i in range(batch.num_rows):
                tile, keys, n = (batch.column(c)[i].as_py() for c in range(3))
                if tile != now:
                    if now is not None:
                        yield close()
                    now, held, size = tile, [], 0
                held.append((np.frombuffer(keys, "<i8"), np.frombuffer(n, "<i8")))
                size += len(held[-1][0])
                if size > 1 << 22:
                    held = [together()]
                    size = 0
        if now is not None:
            yield close()

    return run


def filled(model: Ranks, rows: pa.RecordBatch) -> pa.RecordBatch:
    """To phrases with their counts: counts of the parts of their cuts, as far as ranks know them; of pairs also ranks and bit."""
    langs, phrases, counts = (c.to_pylist() for c in rows.columns)
    of: dict[tuple[str, int], list[int]] = defaultdict(list)
    words = [p.encode().split(b" ") for p in phrases]
    for i, (lang, w) in enumerate(zip(langs, words, strict=True)):
        of[lang, len(w)].append(i)
    made: list[tuple] = [()] * len(langs)
    known = lambda c, n: [int(n[v]) if 0 <= v < len(n) else None for v in c.tolist()]
    for (lang, k), own in of.items():
        each = model.words[lang][1] if lang in model.words else np.zeros(0, np.int64)
        codes = [model.codes(lang, [words[i][j] for i in own]) for j in range(k)]
        if k == 2:
            ids = [[v if v < MOST_WORDS else None for v in c.tolist()] for c in codes]
            bits = (pair_hashes(*codes) & ((1 << _PAIR_BITS) - 1)).tolist()
            for i, *parts, x, y, bit in zip(own, known(codes[0], each), known(codes[1], each), *ids, bits, strict=True):
                made[i] = (parts, x, y, bit)
        else:
            of_pair = model.pairs.get(lang, (None, None, np.zeros(0, np.int64)))[2]
            left, right = (model.pair_ranks(lang, codes[j], codes[j + 1]) for j in (0, 1))
            for i, *parts in zip(own, known(codes[0], each), known(right, of_pair), known(left, of_pair), known(codes[2], each), strict=True):
                made[i] = (parts, None, None, None)
    columns = (langs, phrases, counts, *(zip(*made, strict=True) if made else [[]] * 4))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for f, c in zip(_FILLED, columns, strict=True)], schema=_FILLED)


def _filled(ranks):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(it, 1 << 14):
            yield filled(ranks.value, batch)

    return run


def _bitmap(places: DataFrame, bits: int) -> np.ndarray | None:
    """The bits at the places of a table's one column: 2^bits of them, whatever the table's size; None without rows."""
    at = F.col(places.columns[0]) + 1
    found = places.groupBy(F.bitmap_bucket_number(at).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("m")).collect()
    if not found:
        return None
    out = np.zeros((1 << bits) >> 3, np.uint8)
    for r in found:
        first = (r["b"] - 1) * 4096
        out[first : first + 4096] = np.frombuffer(r["m"], np.uint8)
    return out


def _after(rows: DataFrame, n: str, last: tuple[int, str, str]) -> DataFrame:
    """Rows that come after the row ``last`` in descending order of n, then by lang and phrase."""
    name = F.struct("lang", "phrase") > F.struct(F.lit(last[1]), F.lit(last[2]))
    return rows.where((F.col(n) < last[0]) | ((F.col(n) == last[0]) & name))


def _by_rank(best: pa.Table, column: str, n: str) -> dict[str, tuple[pa.Array, np.ndarray]]:
    """A column and counts of each language, in the order of the table."""
    langs = best.column("lang").combine_chunks().dictionary_encode()
    codes = langs.indices.to_numpy()
    order = np.argsort(codes, kind="stable")
    values, counts = best.column(column).combine_chunks().take(pa.array(order)), best.column(n).to_numpy()[order]
    cuts = np.searchsorted(codes[order], np.arange(len(langs.dictionary) + 1)).tolist()
    return {lang: (pa.concat_arrays([values.slice(a, b - a)]), counts[a:b]) for lang, a, b in zip(langs.dictionary.to_pylist(), cuts[:-1], cuts[1:], strict=True)}


def _phrases(counted: DataFrame, ranks, k: int, many: bool, least: int) -> DataFrame:
    """Written table of the runs of words found ``least`` times, with what is known of their parts."""
    tiles = counted.where("tile >= 0").drop("phrase", "n")
    if many:  # a tile's rows from very many tasks are summed for some of these at a time first
        tiles = tiles.repartition("lang", "tile", "salt").sortWithinPartitions("lang", "tile", "salt").mapInArrow(_merged(ranks, k, 0), _PARTS_DDL).drop("phrase", "n")
    filled_ddl = "lang string, phrase string, a long, parts array<long>, x long, y long, code long"
    tiled = tiles.repartition("lang", "tile").sortWithinPartitions("lang", "tile").mapInArrow(_merged(ranks, k, least), filled_ddl)
    named = counted.where("tile is null").groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return stored(tiled.unionByName(named.mapInArrow(_filled(ranks), filled_ddl)), f"frequent-{k}")


def _completed(found: DataFrame, rest: DataFrame) -> DataFrame:
    """lang, phrase, a, parts of all: the counts that no rank gave come from ``rest`` (lang, phrase, n), joined by the part's words."""
    lacks = F.exists("parts", lambda p: p.isNull())
    w = F.split("phrase", " ")
    word = lambda i: F.get(w, F.lit(i))
    names = F.when(F.size("parts") == 2, F.array(word(0), word(1))).otherwise(F.array(word(0), F.concat_ws(" ", word(1), word(2)), F.concat_ws(" ", word(0), word(1)), word(2)))
    each = found.where(lacks).select("lang", "phrase", "a", F.posexplode(F.arrays_zip(F.col("parts").alias("n"), names.alias("name"))).alias("i", "p")).select("lang", "phrase", "a", "i", F.col("p.n").alias("n"), F.col("p.name").alias("name"))
    looked_up = each.where("n is null").drop("n").join(rest.select("lang", F.col("phrase").alias("name"), "n"), ["lang", "name"])
    parts = F.transform(F.array_sort(F.collect_list(F.struct("i", "n"))), lambda s: s["n"])
    whole = each.where("n is not null").unionByName(looked_up).groupBy("lang", "phrase").agg(F.first("a").alias("a"), parts.alias("parts"))
    return found.where(~lacks).select("lang", "phrase", "a", "parts").unionByName(whole)


def collocations(docs: DataFrame, *, lang_col: str = "lang", text_col: str = "text", least: int = 10, top: int = 2000, ranked_words: int = MOST_WORDS, ranked_pairs: int = 1 << 20, fan_in: int = 512, most: int = 300_000) -> DataFrame:
    """Each language's best ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    A phrase of two or three words found a >= ``least`` times is cut where it is least surprising: l and r are the counts of
    the parts, score is floor(1e6 a^2 / (l r)). A pair goes if a candidate of three words holds it and is found half as often.
    Order: score and a descending, then the phrase's bytes. Null texts are empty, a null language is 'und'; repeated rows
    count each; other columns are not read. Without rows, or without frequent phrases, the result is empty.

    ``ranked_words`` (2^18 at most, some 20 MB) and ``ranked_pairs`` (2^20 at most, 24 MB) bound what is broadcast, beside
    bitmaps of 8 and 16 MB; they say which way a phrase is counted, not whether. A task holds ``most`` phrases without ranks.
    """
    if not (0 < ranked_words <= MOST_WORDS and 0 < ranked_pairs <= 1 << 20):
        raise ValueError("at most 2^18 ranked words and 2^20 ranked pairs")
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(lang_col, F.lit("und")).alias("lang"), F.coalesce(text_col, F.lit("")).alias("text"))
    tasks = rows.rdd.getNumPartitions()
    many, shards = tasks > fan_in, max(64, tasks)

    counts = rows.mapInArrow(_word_counts(most), "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    counts = stored(counts.where((F.col("n") >= least) | (F.col("phrase") == "")), "words")
    words, totals = counts.where("phrase <> ''"), counts.where("phrase = ''").select("lang", F.col("n").alias("_all"))
    best = words.orderBy(F.desc("n"), "lang", "phrase").limit(ranked_words).toArrow()
    tail, bits = words.limit(0), None
    if best.num_rows == ranked_words:
        last = best.slice(best.num_rows - 1).to_pylist()[0]
        tail = _after(words, "n", (last["n"], last["lang"], last["phrase"]))
        crc = F.crc32(F.concat(F.col("lang").cast("binary"), F.lit(b"\0"), F.col("phrase").cast("binary")))
        bits = _bitmap(tail.select(crc.bitwiseAND(F.lit((1 << _WORD_BITS) - 1)).alias("place")), _WORD_BITS)
    model = Ranks(_by_rank(best, "phrase", "n") if best.num_rows else {}, bits)
    sent = [spark.sparkContext.broadcast(model)]
    counted = [stored(rows.mapInArrow(_counted(sent[0], 2, fan_in, shards, most), _PARTS_DDL), "pairs")]
    pairs = _phrases(counted[0], sent[0], 2, many, least)

    best = pairs.select("lang", "phrase", "a", "x", "y").orderBy(F.desc("a"), "lang", "phrase").limit(ranked_pairs)
    best = best.select("lang", "a", F.shiftleft("x", _SECOND).bitwiseOR(F.col("y")).alias("key")).toArrow()
    below = pairs.limit(0)
    if best.num_rows == ranked_pairs:
        last = best.slice(best.num_rows - 1).to_pylist()[0]
        ends = model.names(last["lang"], np.array([last["key"] >> _SECOND, last["key"] & (MOST_WORDS - 1)])).to_pylist()
        below = _after(pairs, "a", (last["a"], last["lang"], " ".join(ends)))
    for lang, (keys, n) in (_by_rank(best, "key", "a") if best.num_rows else {}).items():
        order = np.argsort(keys.to_numpy())
        model.pairs[lang] = keys.to_numpy()[order], order.astype(np.int32), n
    del best
    pa.default_memory_pool().release_unused()
    hashed = counted[0].where("tile < 0").select("tile", "cells", "counts").repartition("tile").sortWithinPartitions("tile").mapInArrow(_frequent_hashes(least), "place long")
    model.pair_bits = _bitmap(hashed.unionByName(below.select(F.col("code").alias("place"))), _PAIR_BITS)
    sent.pop().destroy()  # workers hold one of the two at a time
    sent.append(spark.sparkContext.broadcast(model))
    counted.append(stored(rows.mapInArrow(_counted(sent[0], 3, fan_in, shards, most), _PARTS_DDL), "triples"))
    found = _phrases(counted[1], sent[0], 3, many, least)
    triples, named = found.where("size(parts) = 4"), found.where("size(parts) = 2")

    rest = tail.unionByName(below.unionByName(named).select("lang", "phrase", F.col("a").alias("n")))
    threes = _completed(triples, rest)
    w = F.split("phrase", " ")
    inner = threes.select("lang", "a", F.explode(F.array(F.struct(F.get("parts", F.lit(2)).alias("n"), F.concat_ws(" ", F.get(w, F.lit(0)), F.get(w, F.lit(1))).alias("phrase")), F.struct(F.get("parts", F.lit(1)).alias("n"), F.concat_ws(" ", F.get(w, F.lit(1)), F.get(w, F.lit(2))).alias("phrase")))).alias("i"))
    held = inner.where("100 * a >= 50 * i.n").select("lang", "i.phrase").distinct()
    twos = _completed(pairs.unionByName(named), rest).join(held, ["lang", "phrase"], "left_anti")

    wide = lambda c: F.get("parts", F.lit(c)).cast("decimal(19,0)")
    scored = twos.unionByName(threes).withColumns({"_l": wide(0), "_r": wide(1), "_l2": wide(2), "_r2": wide(3), "_a": F.col("a").cast("decimal(13,0)")})
    scored = scored.withColumns({"_s": F.expr("(_a * _a * cast(1000000 as decimal(7,0))) div (_l * _r)"), "_s2": F.expr("(_a * _a * cast(1000000 as decimal(7,0))) div (_l2 * _r2)")})
    second = F.coalesce(F.col("_s2") < F.col("_s"), F.lit(False))
    cut = scored.select("lang", "phrase", "a", F.when(second, F.col("_l2")).otherwise(F.col("_l")).cast("long").alias("l"), F.when(second, F.col("_r2")).otherwise(F.col("_r")).cast("long").alias("r"), F.when(second, F.col("_s2")).otherwise(F.col("_s")).alias("score"))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    some = cut.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    some = some.withColumn("_k", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("_k") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    out = stored(ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("_all").alias("n"), "score"), "collocations")
    discard(counts, pairs, found, *counted)
    sent[0].destroy()
    return out
