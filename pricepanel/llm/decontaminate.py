"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

Built-in expressions only.

1. A window of an item's length m that is similar enough to it (bag Jaccard t) has ceil(2 t m / (1 + t)) places at least whose
   shingle the item has too. So the documents' shingles are joined with the items', and of every document and item the windows
   with that many such places are named, wherever and in whatever order the shingles stand; no other window can be similar.
2. Each named window gets a 64-bit SimHash of its shingles, as does each item. The bits are 8 blocks; two
   fingerprints within 23 bits agree in some block but for 2 bits, so an index of every block value within
   2 bits of the items' blocks finds all of them.
3. A pair within the radius is verified: bag Jaccard of the shingles, each weighted by how often it occurs.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricepanel.llm.common import among, stored
from pricepanel.llm.quality_rules import shingle_hashes, words_of

_BLOCKS, _BITS, _WITHIN = 8, 8, 2
RADIUS = _BLOCKS * (_WITHIN + 1) - 1
#: A table of the benchmark is broadcast up to so many bytes; a larger one is shuffled.
BROADCAST_BYTES = 32 << 20
#: Four counters of 16 bits in a number, which go so far.
_LANES, _MOST = 0x0001000100010001, 0x7FFF


def small(table: DataFrame, row_bytes: int) -> DataFrame:
    """``table`` (stored, of fixed-size rows), to be broadcast if its rows have no more than BROADCAST_BYTES."""
    return F.broadcast(table) if table.count() * row_bytes <= BROADCAST_BYTES else table


def with_simhash(rows: DataFrame, shingles: str, name: str) -> DataFrame:
    """Adds ``name``: bit b is set if more of the shingles have it than not.

    Bits b, b + 16, b + 32 and b + 48 of all shingles are counted at once; of over 32,767 shingles bits b and b + 32.
    """

    def lanes(j: int, ones: int) -> Column:
        return F.aggregate(shingles, F.lit(0).cast("long"), lambda s, h: s + F.shiftrightunsigned(h, j).bitwiseAND(F.lit(ones)))

    many = F.size(shingles) > _MOST
    rows = rows.withColumn("_votes", F.when(many, F.array(*[lanes(j, 0x0000000100000001) for j in range(32)])).otherwise(F.array(*[lanes(j, _LANES) for j in range(16)])))
    out = F.lit(0).cast("long")
    for b in range(64):
        count = F.shiftrightunsigned(F.get("_votes", F.lit(b % 16)), 16 * (b // 16)).bitwiseAND(F.lit(0xFFFF))
        count = F.when(many, F.shiftrightunsigned(F.get("_votes", F.lit(b % 32)), 32 * (b // 32)).bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(count)
        out = out.bitwiseOR(F.when(2 * count > F.size(shingles), F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")))
    return rows.withColumn(name, out).drop("_votes")


def blocks(fingerprint: Column) -> Column:
    """The 8-bit blocks of a fingerprint."""
    return F.array(*[F.shiftrightunsigned(fingerprint, _BITS * i).bitwiseAND(255).cast("int") for i in range(_BLOCKS)])


def bag_similarity(x: Column, y: Column) -> Column:
    """Sum of the least over the sum of the greatest counts of each shingle."""
    times = lambda a, h: F.size(F.filter(a, lambda z: z == h))
    common = F.aggregate(F.array_distinct(x), F.lit(0), lambda s, h: s + F.least(times(x, h), times(y, h)))
    return common / (F.size(x) + F.size(y) - common)


def lowered_words(text: Column) -> Column:
    """Words with A-Z lower-cased."""
    return words_of(F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def shingles_of(words: Column, k: Column | None, sizes: list[int]) -> Column:
    """Hashes of ``k`` words in a row, k one of ``sizes``."""
    out = F.array().cast("array<bigint>")
    for size in sizes:
        out = F.when(k == size, shingle_hashes(words, size)).otherwise(out)
    return out


def leaking_rows(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", k: int = 5, threshold: float = 0.75) -> DataFrame:
    """Of each text that has a window of an item: _doc, _hash (of the text), _item, window_start, hamming and similarity, those of the best window.

    Texts and items without words match nothing. An item of fewer than k words is one shingle of all its words, so it matches every
    text that has them in a row; else shingles are k words. A text of fewer shingles than the item is a window as a whole.
    Rows are told apart by id and text, so an id may be null or repeat; so may item ids. No documents or no items give no rows.
    """
    rows = benchmark.select(F.col(item_col).alias("_item"), F.col(item_text_col).alias("_t")).distinct().withColumn("_w", lowered_words(F.col("_t"))).where("size(_w) > 0")
    rows = rows.withColumn("_k", F.least(F.size("_w"), F.lit(k)))
    every = [*range(1, k + 1)]
    items = rows.select(F.xxhash64("_item", "_t").alias("_key"), "_item", "_k", shingles_of(F.col("_w"), F.col("_k"), every).alias("_is")).withColumn("_m", F.size("_is"))
    items = stored(with_simhash(items, "_is", "_if"), "items")
    sizes = sorted(r["_k"] for r in items.select("_k").distinct().toLocalIterator())  # k at most
    if not sizes:
        sizes = [k]
    of_items = stored(items.select("_key", "_k", "_m", F.explode(F.array_distinct("_is")).alias("_h")), "item-shingles")
    of_items = small(of_items, 64)

    source = docs.select(F.col(id_col).alias("_doc"), F.xxhash64(F.col(text_col)).alias("_hash"), F.col(text_col).alias("_t"))
    words = source.withColumn("_w", lowered_words(F.col("_t"))).drop("_t")
    parts = []
    for size in sizes:
        # The outer form: else Spark infers a filter on the array and makes the words anew for each element.
        hashes = words.select("_doc", "_hash", F.lit(size).alias("_k"), F.posexplode_outer(shingle_hashes(F.col("_w"), size)).alias("_p", "_h")).where("_h is not null")
        parts.append(hashes.join(of_items, ["_k", "_h"]).select("_doc", "_hash", "_key", "_k", "_m", "_p"))
    hits = reduce(DataFrame.union, parts).groupBy("_doc", "_hash", "_key", "_k", "_m").agg(F.array_sort(F.collect_set("_p")).alias("_at"))
    # At least so many places in a window of m, and in any window at all.
    need = F.ceil(2 * threshold * F.col("_m") / (1 + threshold) - 1e-9).cast("int")
    least = F.ceil(threshold * F.col("_m") - 1e-9).cast("int")
    hits = hits.where(F.size("_at") >= least).withColumn("_need", need)
    at = F.col("_at")
    last = F.transform(F.slice(at, F.col("_need"), F.size(at)), lambda p, i: F.struct(F.greatest(p - F.col("_m") + 1, F.lit(0)).alias("a"), at[i].alias("b")))
    starts = F.array_distinct(F.flatten(F.transform(F.filter(last, lambda x: x["a"] <= x["b"]), lambda x: F.sequence(x["a"], x["b"]))))
    # Place 0 stands for the whole of a shorter text; in others it is named anyway or not similar.
    named = hits.select("_doc", "_hash", "_k", F.struct("_m", F.array_union(F.when(F.size(at) >= F.col("_need"), starts).otherwise(F.array().cast("array<int>")), F.array(F.lit(0))).alias("starts")).alias("_x"))
    named = stored(named.groupBy("_doc", "_hash", "_k").agg(F.collect_set("_x").alias("_named")), "named-windows")

    wanted = among(source, named.select("_hash"), "_hash")
    theirs = named.withColumnsRenamed({"_doc": "_id", "_hash": "_of"})
    found = wanted.join(theirs, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_of"))).select("_doc", "_hash", "_k", "_named", "_t").dropDuplicates(["_doc", "_hash", "_k"])
    found = found.withColumn("_w", lowered_words(F.col("_t"))).withColumn("_s", shingles_of(F.col("_w"), F.col("_k"), sizes)).drop("_t", "_w")
    windows = found.select("_doc", "_hash", "_k", "_s", F.explode("_named").alias("_x")).select("_doc", "_hash", "_k", F.col("_x._m").alias("_m"), "_s", F.explode("_x.starts").alias("_from"))
    windows = windows.withColumn("_from", F.least("_from", F.greatest(F.size("_s") - F.col("_m"), F.lit(0)))).dropDuplicates(["_doc", "_hash", "_k", "_m", "_from"])
    windows = windows.withColumn("_win", F.slice("_s", F.col("_from") + 1, F.col("_m"))).drop("_s").where("size(_win) > 0")
    windows = stored(with_simhash(windows, "_win", "_f"), "windows")  # each fingerprint is made once

    near = [sum(1 << b for b in c) for n in range(_WITHIN + 1) for c in combinations(range(_BITS), n)]
    index = items.select("_key", "_k", "_m", "_if", F.posexplode(blocks(F.col("_if"))).alias("_b", "_v"))
    index = stored(index.select("_key", "_k", "_m", "_if", "_b", F.explode(F.transform(F.lit(near), lambda x: x.bitwiseXOR(F.col("_v")))).alias("_v")), "hamming-index")
    probes = windows.select("_doc", "_hash", "_from", "_k", "_m", "_win", "_f", F.posexplode(blocks(F.col("_f"))).alias("_b", "_v"))
    # A pair may meet in several blocks: it goes on from the first in which it does.
    apart = F.bit_count(F.col("_f").bitwiseXOR(F.col("_if")))
    first = F.array_position(F.transform(blocks(F.col("_f").bitwiseXOR(F.col("_if"))), lambda x: F.bit_count(x) <= _WITHIN), F.lit(True)) - 1
    pairs = probes.join(small(index, 64), ["_k", "_m", "_b", "_v"]).where((apart <= RADIUS) & (first == F.col("_b"))).withColumn("_far", apart)
    scored = pairs.join(items.select("_key", "_item", "_is"), "_key").withColumn("_sim", bag_similarity(F.col("_win"), F.col("_is"))).where(F.col("_sim") >= threshold - 1e-12)
    best = F.max(F.struct("_sim", (-F.col("_from")).alias("_from"), (-F.col("_far")).alias("_far"))).alias("_best")
    out = scored.groupBy("_doc", "_hash", "_item").agg(best)
    return out.select("_doc", "_hash", "_item", (-F.col("_best._from")).cast("long").alias("window_start"), (-F.col("_best._far")).alias("hamming"), F.col("_best._sim").alias("similarity"))


def leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", item_col: str = "item_id", **settings) -> DataFrame:
    """Pairs of a document and an item of which it has a window: ``id_col``, ``item_col``, window_start (in shingles), hamming and similarity.

    See ``leaking_rows``. Rows that repeat an id are one document, of which the best window counts; so are items that repeat theirs.
    Rows without an id are not reported; ``clean`` drops them too.
    """
    found = leaking_rows(docs, benchmark, id_col=id_col, item_col=item_col, **settings).where("_doc is not null")
    best = F.max(F.struct("similarity", (-F.col("window_start")).alias("start"), (-F.col("hamming")).alias("far"))).alias("b")
    out = found.groupBy("_doc", "_item").agg(best)
    return out.select(F.col("_doc").alias(id_col), F.col("_item").alias(item_col), (-F.col("b.start")).alias("window_start"), (-F.col("b.far")).alias("hamming"), F.col("b.similarity").alias("similarity"))


def clean(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows without a leak, all columns; a row is judged by its own text, whether or not it has an id."""
    dirty = leaking_rows(docs, benchmark, id_col=id_col, text_col=text_col, **settings).select(F.col("_doc").alias("_dirty"), F.col("_hash").alias("_dirty_hash")).distinct()
    same = docs[id_col].eqNullSafe(F.col("_dirty")) & (F.xxhash64(docs[text_col]) == F.col("_dirty_hash"))
    return docs.join(dirty, same, "left_anti")
