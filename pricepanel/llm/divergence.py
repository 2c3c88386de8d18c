"""How far sources of a language diverge in their words, from run-length columns of counts.

Terms are counted per source once. The vocabulary of a language is put in an order that brings equal counts together: by
total count into blocks, inside a block by the counts of all sources. Each source's column of a block is then a few runs of
equal counts. For a pair of sources the boundaries of their runs are intersected, the divergence of two counts is worked
out once for each run, and multiplied by its length.

A term's smoothed share is p = 1 + floor(SCALE * (count + 2) / (N + 2 V)), N the counts of the source over the V terms that
its language keeps; the divergence of two shares is floor((p - q)^2 / (p + q)). All of it is exact.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricepanel.llm.common import stored

SCALE = 1_000_000_000
#: Other ASCII than letters is a break, A-Z are taken for a-z.
_TERMS = bytes(32 if c < 0x41 or 0x5A < c < 0x61 or 0x7A < c < 0x80 else c + 32 if c < 0x5B else c for c in range(256))
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("d", pa.int64())])
_RUNS = pa.schema([("lang", pa.string()), ("block", pa.int64()), ("terms", pa.int32()), ("source", pa.string()), ("ends", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])
_PAIRS = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64())])


def terms_of(text: str, step: int = 1 << 22) -> Iterator[list[bytes]]:
    """The terms of a text, of a very long one in parts."""
    data, at = text.encode().translate(_TERMS), 0
    while at < len(data):
        end = at + step
        if end < len(data):
            end = data.find(b" ", end)
            end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def _counted(most: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        added = 0

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, d) in counts.items():
                # The row without a term says that the group is there.
                terms = [b"", *n]
                for at in range(0, len(terms), 1 << 16):
                    part = terms[at : at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), pa.array([source] * len(part)), pa.array(part, pa.binary()).cast(pa.string()), pa.array([n[t] for t in part], pa.int64()), pa.array([d[t] for t in part], pa.int64())], schema=_COUNTS)
            counts.clear()

        for batch in it:
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                n, d = counts.setdefault((lang, source), (Counter(), Counter()))
                seen: set[bytes] = set()
                for terms in terms_of(text):
                    n.update(terms)
                    seen.update(terms)
                d.update(seen)
                added += len(seen)
                if added > most:
                    added = sum(len(n) for n, _ in counts.values())
                    if added > most // 2:
                        yield from out()
                        added = 0
        yield from out()

    return run


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least_docs: int = 10, most: int = 1_000_000) -> DataFrame:
    """Written table: lang, source, term, n of the kept terms, with total (n in the language) and lead (one row of each term); and a row with term '' of each source.

    Tasks count by dictionaries of ``most`` entries at most before the only shuffle, by term.
    """
    rows = docs.select(*[F.coalesce(c, F.lit("")).alias(c_) for c, c_ in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    counted = rows.mapInArrow(_counted(most), "lang string, source string, term string, n long, d long")
    whole = counted.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    of_term = Window.partitionBy("lang", "term")
    kept = whole.withColumns({"total": F.sum("n").over(of_term), "_docs": F.sum("d").over(of_term), "lead": F.min("source").over(of_term) == F.col("source")})
    return stored(kept.where((F.col("_docs") >= least_docs) | (F.col("term") == "")).select("lang", "source", "term", "n", "total", "lead"), "term-counts")


def groups_of(counts: DataFrame) -> DataFrame:
    """Each source of each language: n and v as in the module's formula, n_lang the language's n, idx its place among the k sources."""
    own = F.col("term") != ""
    sources = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.count_if(own & F.col("lead")).alias("_v"))
    langs = sources.groupBy("lang").agg(F.sum("n").alias("n_lang"), F.sum("_v").alias("v"), F.count("*").alias("k"))
    placed = sources.withColumn("idx", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    return placed.drop("_v").join(langs, "lang")


def _runs(most_terms: int, most_entries: int = 1 << 20):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block = TaskContext.get().partitionId() << 32, 0
        lang, last, starts = None, None, []
        sources: list[str] = []
        counts: list[int] = []

        def out() -> pa.RecordBatch:
            """The block's columns: its terms sorted by their counts in all sources, each source's entries cut into runs."""
            nonlocal block
            names = sorted(set(sources))
            place = {s: i for i, s in enumerate(names)}
            entries = np.column_stack([np.fromiter(map(place.get, sources), ">u8", len(sources)), np.array(counts, ">u8")])
            keys = [entries[a:b].tobytes() for a, b in pairwise([*starts, len(sources)])]
            rank = np.empty(len(keys), np.int64)
            rank[np.array(sorted(range(len(keys)), key=keys.__getitem__))] = np.arange(len(keys))
            of_term = np.repeat(rank, np.diff([*starts, len(sources)]))
            entries = entries.astype(np.int64)
            order = np.lexsort((of_term, entries[:, 0]))
            who, at, n = entries[order, 0], of_term[order], entries[order, 1]
            bounds = np.searchsorted(who, np.arange(len(names) + 1))
            columns: dict[str, list] = {"ends": [], "counts": []}
            for a, b in pairwise(bounds.tolist()):
                ends, values = run_lengths(at[a:b], n[a:b], len(keys))
                columns["ends"].append(ends.astype(np.int32))
                columns["counts"].append(values)
            made = {"lang": [lang] * len(names), "block": [part + block] * len(names), "terms": [len(keys)] * len(names), "source": names} | columns
            block += 1
            for x in (sources, counts, starts):
                x.clear()
            return pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in _RUNS], schema=_RUNS)

        for batch in it:
            for la, term, source, n in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                if (la, term) != (lang, last):
                    if starts and (la != lang or len(starts) == most_terms or len(sources) >= most_entries):
                        yield out()
                    lang, last = la, term
                    starts.append(len(sources))
                sources.append(source)
                counts.append(n)
        if starts:
            yield out()

    return run


def run_lengths(at: np.ndarray, n: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of a column that is n at the ascending places ``at`` and 0 elsewhere: where each ends, and its count."""
    ends = np.column_stack([at, at + 1]).ravel()  # before each entry what is between is 0
    values = np.column_stack([np.zeros(len(n), np.int64), n]).ravel()
    ends, values = np.r_[ends, terms], np.r_[values, 0]
    some = np.diff(ends, prepend=0) > 0
    ends, values = ends[some], values[some]
    last = np.r_[values[1:] != values[:-1], True] if len(values) else np.zeros(0, bool)
    return ends[last], values[last]


def shares(counts: np.ndarray, n: int, v: int) -> np.ndarray:
    """1 + floor(SCALE (count + 2) / (n + 2 v)), by long division in steps that stay in 64 bits."""
    below = n + 2 * v
    if below > (1 << 63) // 1000:
        raise OverflowError("a source of over 9e15 terms")
    p, rest = np.zeros(len(counts), np.int64), counts.astype(np.int64) + 2
    p, rest = rest // below, rest % below
    for _ in range(3):
        p, rest = p * 1000 + rest * 1000 // below, rest * 1000 % below
    return p + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _paired(rows: pa.Table) -> pa.Table:
    """Sums of one block over all pairs of a tile's sources; a source without entries has one run of zeros."""
    tile_a, tile_b = rows.column("_a")[0].as_py(), rows.column("_b")[0].as_py()
    made: dict[str, list] = {name: [] for name in _PAIRS.names}
    lists = {c: rows.column(c).combine_chunks() for c in ("ends", "counts")}
    columns = []
    for i, r in enumerate(rows.select(["tile", "idx", "source", "n", "v", "terms"]).to_pylist()):
        if not r["terms"]:
            ends, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        elif lists["ends"][i].is_valid:
            ends, counts = (lists[c][i].values.to_numpy() for c in ("ends", "counts"))
        else:
            ends, counts = np.array([r["terms"]]), np.zeros(1, np.int64)
        columns.append((r["tile"], r["idx"], r["source"], ends, shares(counts, r["n"], r["v"]) if len(counts) else counts))
    columns.sort(key=lambda c: c[1])
    for i, (tile, _, a, ends_a, p) in enumerate(columns):
        if tile != tile_a:
            continue
        for other, _, b, ends_b, q in columns[i + 1 :]:
            if other != tile_b:
                continue
            ends = np.union1d(ends_a, ends_b)
            f = divergence(p[np.searchsorted(ends_a, ends)], q[np.searchsorted(ends_b, ends)])
            for name, value in zip(_PAIRS.names, (rows.column("lang")[0].as_py(), a, b, int((f * np.diff(ends, prepend=0)).sum())), strict=True):
                made[name].append(value)
    return pa.table(made, schema=_PAIRS)


def _value(n: str, below: str) -> str:
    return f"1 + ((cast({n} + 2 as decimal(19,0)) * cast({SCALE} as decimal(10,0))) div cast({below} as decimal(19,0)))"


def audit(docs: DataFrame, *, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least_docs: int = 10, top: int = 10, most_terms: int = 1 << 15, tile: int = 64) -> DataFrame:
    """Divergence of each source from every other source of its language, and the terms by which it stands out.

    Rows: lang, source, part, item, value, rank. Part ``pair`` has every other source, the most divergent first; part
    ``term`` the ``top`` terms that are more frequent in the source than in its language. Ties go by the item's bytes.
    Null texts, sources and languages are ''; a source without kept terms takes part with counts of 0, and a language
    without any gives pairs of value 0. Repeated rows count each; other columns are not read. Without rows the result is empty.

    A block is ``most_terms`` terms wide, a tile ``tile`` sources, so no task holds a whole column or all sources of a language.
    """
    counts = term_counts(docs, lang_col, source_col, text_col, least_docs)
    groups = stored(groups_of(counts), "term-groups")
    own = counts.where("term <> ''")

    dealt = own.repartitionByRange("lang", "total", "term").sortWithinPartitions("lang", "total", "term", "source").select("lang", "term", "source", "n")
    runs = stored(dealt.mapInArrow(_runs(most_terms), "lang string, block long, terms int, source string, ends array<int>, counts array<long>"), "term-runs")
    blocks = runs.select("lang", "block", "terms").distinct().unionByName(groups.where("v = 0").select("lang", F.lit(-1).cast("long").alias("block"), F.lit(0).alias("terms")).distinct())
    sources = groups.select("lang", "source", "n", "v", "idx", (F.col("idx") / tile).cast("int").alias("tile"), F.ceil(F.col("k") / tile).cast("int").alias("_tiles"))
    grid = blocks.join(sources, "lang").join(runs.drop("terms"), ["lang", "block", "source"], "left")
    other = F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)).alias("_other")
    tiled = grid.select("*", other).withColumns({"_a": F.least("tile", "_other"), "_b": F.greatest("tile", "_other")}).drop("_tiles", "_other")
    sums = tiled.groupBy("lang", "block", "_a", "_b").applyInArrow(_paired, "lang string, a string, b string, value long")
    pairs = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = pairs.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value")
    both = both.unionByName(pairs.select("lang", F.col("b").alias("source"), F.lit("pair").alias("part"), F.col("a").alias("item"), "value"))

    named = own.select("lang", "source", F.col("term").alias("item"), F.col("n").alias("_n"), "total").where("_n > 0").join(groups, ["lang", "source"])
    p, q = F.expr(_value("_n", "n + 2 * v")), F.expr(_value("total", "n_lang + 2 * v"))
    named = named.select("lang", "source", F.lit("term").alias("part"), "item", p.alias("_p"), q.alias("_q")).where("_p > _q").withColumn("value", F.expr("(_p - _q) * (_p - _q) div (_p + _q)")).drop("_p", "_q")

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return both.withColumn("rank", F.row_number().over(order)).unionByName(ranked)
