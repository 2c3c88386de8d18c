"""Best-fit packing by linear grouping, planned on a histogram of lengths.

The driver sees only how many pieces have each length (at most ``capacity`` numbers). On them it

1. sorts the large lengths and cuts them into groups of equal cardinality, each rounded up to its longest;
2. solves the configuration program of these few sizes by column generation and rounds it down;
3. substitutes actual lengths for the rounded ones, which leaves room in each sequence;
4. puts what is left, longest first, wherever it fits best, a whole run of equal sequences at a time.

The plan is a list of intervals: pieces of one length with ranks r0 .. r0 + n - 1 go to sequences s0 .. at one
offset. Spark ranks the pieces of each length and looks their interval up, so no piece passes the driver.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricepanel.llm.common import drained, stored, text_batches
from pricepanel.llm.token_codes import encoder

_PIECE = pa.schema([("_doc", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("_part", pa.int32()), ("_at", pa.int64())])


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, int]]:
    """(How many of each size, how often): the configuration program by column generation, rounded down."""
    k = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    d = np.array(demand, float)
    for _ in range(60 * k):
        inverse = np.linalg.inv(basis)
        x, price = inverse @ d, inverse.T @ np.ones(k)
        value, pattern = _best_pattern(sizes, price, capacity)
        if value <= 1 + 1e-7:
            break
        column = inverse @ pattern
        ratio = np.where(column > 1e-9, np.maximum(x, 0) / np.maximum(column, 1e-9), np.inf)
        basis[:, int(ratio.argmin())] = pattern
    x = np.linalg.solve(basis, d)
    return [(basis[:, j].round().astype(int), int(x[j] + 1e-6)) for j in range(k) if x[j] >= 1 - 1e-6]


def _best_pattern(sizes: list[int], price: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The configuration of the greatest price: one item more in each round, for all capacities at once."""
    best, taken = np.zeros(capacity + 1), []
    for _ in range(capacity // min(sizes)):
        tries = np.full((len(sizes), capacity + 1), -1.0)
        for i, s in enumerate(sizes):
            tries[i, s:] = best[: capacity + 1 - s] + price[i]
        pick = tries.argmax(0)
        better = tries[pick, np.arange(capacity + 1)]
        taken.append(np.where(better > best + 1e-12, pick, -1))
        best = np.maximum(best, better)
    pattern, room = np.zeros(len(sizes)), capacity
    for pick in reversed(taken):
        if pick[room] >= 0:
            pattern[pick[room]] += 1
            room -= sizes[pick[room]]
    return float(price @ pattern), pattern


class Plan:
    """Places pieces by length; ``intervals`` are (length, first rank, how many, first sequence, offset)."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.capacity, self.left, self.rank = capacity, dict(histogram), defaultdict(int)
        self.intervals: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> (first sequence, how many)
        self.rooms: list[int] = []

    def put(self, length: int, first: int, n: int, offset: int) -> None:
        self.intervals.append((length, self.rank[length], n, first, offset))
        self.rank[length] += n
        self.left[length] -= n

    def keep(self, room: int, first: int, n: int) -> None:
        if n and room:
            if not self.open[room]:
                insort(self.rooms, room)
            self.open[room].append((first, n))

    def take(self, length: int) -> tuple[int, int, int]:
        """The run of sequences with the least room that holds ``length``; a new one where there is none."""
        i = bisect_left(self.rooms, length)
        if i == len(self.rooms):
            n = -(-self.left[length] // (self.capacity // length))
            self.sequences += n
            return self.capacity, self.sequences - n, n
        room = self.rooms[i]
        first, n = self.open[room].pop()
        if not self.open[room]:
            del self.rooms[i]
        return room, first, n

    def configured(self, groups: list[list[int]], pattern: np.ndarray, times: int) -> None:
        """Fill ``times`` new sequences with actual lengths of the groups (their lengths, longest first)."""
        slots = [g for g, k in enumerate(pattern) for _ in range(k)]
        have = [sum(self.left[x] for x in group) for group in groups]
        times = min([times, *[have[g] // k for g, k in enumerate(pattern) if k]])
        if times <= 0:
            return
        first, cuts, runs = self.sequences, {0, times}, []
        self.sequences += times
        taken: dict[int, int] = defaultdict(int)
        for g in slots:
            at, run = 0, []
            for x in groups[g]:
                n = min(self.left[x] - taken[x], times - at)
                if n > 0:
                    run.append((at, at + n, x))
                    taken[x] += n
                    at += n
                    cuts.add(at)
            runs.append(run)
        points = sorted(cuts)
        for a, b in zip(points, points[1:], strict=False):
            offset = 0
            for run in runs:
                length = next(x for lo, hi, x in run if lo <= a < hi)
                self.put(length, first + a, b - a, offset)
                offset += length
            self.keep(self.capacity - offset, first + a, b - a)

    def best_fit(self, lengths: list[int]) -> None:
        for length in lengths:
            while self.left[length] > 0:
                room, first, n = self.take(length)
                each = room // length
                full = min(n, self.left[length] // each)
                for j in range(each if full else 0):
                    self.put(length, first, full, self.capacity - room + j * length)
                self.keep(room - each * length, first, full)
                if full < n:
                    some = self.left[length]  # fewer than one sequence takes
                    for j in range(some):
                        self.put(length, first + full, 1, self.capacity - room + j * length)
                    self.keep(room - some * length, first + full, 1 if some else 0)
                    rest = n - full - (1 if some else 0)
                    self.keep(room, first + full + (1 if some else 0), rest)


def grouped_plan(histogram: dict[int, int], capacity: int, n_groups: int, small: int) -> Plan:
    """One plan: lengths over capacity / ``small`` are large; groups end where a length does."""
    p = Plan({x: n for x, n in histogram.items() if n > 0}, capacity)
    large = sorted((x for x in p.left if x * small > capacity), reverse=True)
    total, groups, held = sum(p.left[x] for x in large), [[]], 0
    for x in large:
        if held >= total / n_groups and groups[-1]:
            groups.append([])
            held = 0
        groups[-1].append(x)
        held += p.left[x]
    groups = [g for g in groups if g]
    if groups:
        sizes = [g[0] for g in groups]
        for pattern, times in configurations(sizes, [sum(p.left[x] for x in g) for g in groups], capacity):
            p.configured(groups, pattern, times)
    p.best_fit(sorted(p.left, reverse=True))
    return p


def plan(histogram: dict[int, int], capacity: int, n_groups: int = 64, smalls: tuple[int, ...] = (2, 3, 4)) -> Plan:
    """The plan with the fewest sequences among some bounds between large and small lengths.

    Few large lengths to a sequence make rounding cheap, many leave less to best fit; planning on the
    histogram takes well under a second, so each bound is tried.
    """
    return min((grouped_plan(histogram, capacity, n_groups, s) for s in smalls), key=lambda p: p.sequences)


def _pieces(path: str, end_id: int, capacity: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, ranks = encoder(path, end_id), TaskContext.get().partitionId(), defaultdict(int)
        out: dict[str, list] = {n: [] for n in _PIECE.names}
        for batch in text_batches(it):
            coded, places = encode.flat(batch.column(1))
            coded = coded.astype("<u4", copy=False)
            for doc, (first, last) in zip(batch.column(0).to_pylist(), pairwise(places.tolist()), strict=True):
                n, ids = last - first, coded[first:last]
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    for name, value in zip(_PIECE.names, (doc, i, a, b - a, zlib.crc32(ids[a:b]), part, ranks[b - a]), strict=True):
                        out[name].append(value)
                    ranks[b - a] += 1
            yield drained(out, _PIECE)

    return run


def _placed(plan):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = plan.value  # sorted by (length, first rank)
        key = table[:, 0] << 40 | table[:, 1]
        for batch in it:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            at = np.searchsorted(key, length << 40 | rank, side="right") - 1
            names = [n for n in batch.schema.names if n != "_rank"]
            columns = [batch.column(n) for n in names] + [pa.array(table[at, 3] + rank - table[at, 1]), pa.array(table[at, 4])]
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 0, n_groups: int = 64) -> DataFrame:
    """Pack every text's ids (end id appended) into few sequences of ``capacity`` tokens at most.

    Only longer texts are cut; their first piece is the short one. Returns for each piece: id, piece, start,
    length, ids_crc32, sequence_id, offset. Null and empty texts are the end id alone; rows that repeat an id
    and null ids are packed like any other; no rows give no rows.
    """
    spark = docs.sparkSession
    if capacity >= 1 << 23:
        raise ValueError("capacity must be below 2^23")
    source = docs.select(F.col(id_col).cast("long").alias("_doc"), F.col(text_col).alias("_text"))
    pieces = stored(source.mapInArrow(_pieces(tokenizer, end_id, capacity), "_doc long, piece int, start long, length long, ids_crc32 long, _part int, _at long"), "pieces")
    counts = pieces.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    before = counts.select("length", "_part", (F.sum("_n").over(Window.partitionBy("length").orderBy("_part")) - F.col("_n")).alias("_before"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).toLocalIterator()}  # capacity rows at most
    table = np.array(sorted(plan(histogram, capacity, n_groups).intervals), np.int64).reshape(-1, 5)
    ranked = pieces.join(before, ["length", "_part"]).select("_doc", "piece", "start", "length", "ids_crc32", (F.col("_before") + F.col("_at")).alias("_rank"))
    out = ranked.mapInArrow(_placed(spark.sparkContext.broadcast(table)), "_doc long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.withColumnRenamed("_doc", id_col)

