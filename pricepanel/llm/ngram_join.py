"""N-gram Jaccard self-join: rare-first prefix filtering, verified once per pair, then components.

1. Counts. One pass names every document's set by its hash (documents with one and the same set are one *node*)
   and counts all shingles in a table of fixed size (``buckets``). A shingle's place in the global order is
   (count of its bucket, hash), rarest first. Any global order gives exact prefixes; the counts only keep
   frequent shingles out of them.
2. Prefixes. A node of n shingles is indexed under its first n - ceil(t n) + 1. Two nodes that link share a prefix
   shingle at places that pass the length filter and the positional filter. Shingles of buckets with very high counts
   are dealt out by (shingle, part of the nodes), so that no task gets all of a hot one.
3. Stars. In each prefix group every node is paired with one centre (the node whose shingles are the most
   frequent), not with all others, so a group of g near copies makes g - 1 pairs; the centres of a hot
   shingle's parts are paired with one of them. Pairs from many groups are merged and verified: the suffix
   filter on fixed parts of the hash space (a *sketch* counts a node's shingles in each) goes before the texts
   are read, then on the sets themselves, then the exact count.
4. Rest. Groups with nodes of different components after step 3 get a round of stars more, each group with a
   centre of its own by hash; what is then left is joined pairwise between components, but
   for the pairs that were judged before, so no link is lost; pairs inside a component can change nothing.
   A large group is dealt out by (part of one side, part of the other), so that no task gets all of its pairs.
5. Components of all links, by alternating large and small stars.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricepanel.llm.common import among, batches, discard, distinct, drained, grams, stored, text_batches, view_of, word_hashes

_NODE = pa.schema([("_doc", pa.int64()), ("_n", pa.int64()), ("_node", pa.int64()), ("_sketch", pa.binary()), ("_few", pa.list_(pa.int8())), ("_part", pa.int32()), ("_counts", pa.binary())])
_ENTRY = pa.schema([("_token", pa.int64()), ("_salt", pa.int32()), ("_node", pa.int64()), ("_place", pa.int64()), ("_weight", pa.int64())])
_COUNT = pa.schema([("_part", pa.int32()), ("_counts", pa.binary())])
_LINK = pa.schema([("_a", pa.int64()), ("_b", pa.int64())])
_PART = 4096
_SALTS = 64
#: Rows of a group that meet in one task in the pairwise rest.
_MEET = 4096


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text: A-Z lower-cased; fewer words than k are one shingle, no words none."""
    h, places = word_hashes(column, lower=True)
    g = grams(h, k)
    for a, b in zip(places.tolist(), places[1:].tolist(), strict=False):
        yield distinct(g[a : b - k + 1]) if b - a >= k else grams(h[a:b], b - a) if b > a else g[:0]


def node_of(s: np.ndarray) -> int:
    """The name of a shingle set: its hash."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).view(np.int64))


def sketch(s: np.ndarray) -> bytes:
    """How many shingles of a set are in each of equal parts of the hash space; about as many parts as half the set."""
    bits = min(max(4, (len(s) // 2).bit_length()), 12)
    counts = np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8 if counts.max() < 1 << 8 else np.uint32).tobytes()


def few(s: np.ndarray) -> np.ndarray:
    """Counts of 128 parts; more than 127 count as so many, which makes differences smaller, never larger."""
    return np.minimum(np.bincount((s >> np.uint64(57)).astype(np.int64), minlength=128), 127).astype(np.int8)


def parts_of(sketched: bytes, n: int) -> np.ndarray:
    """The counts of a sketch of n shingles."""
    size = 1 << min(max(4, (n // 2).bit_length()), 12)
    return np.frombuffer(sketched, np.uint8 if len(sketched) == size else np.uint32).astype(np.int64)


def least_difference(x: np.ndarray, y: np.ndarray) -> int:
    """A lower bound of the symmetric difference of two sets, from the counts of their parts."""
    while len(x) > len(y):
        x = x.reshape(-1, 2).sum(1)
    while len(y) > len(x):
        y = y.reshape(-1, 2).sum(1)
    return int(np.abs(x - y).sum())


def _packed(counts: np.ndarray) -> bytes:
    """Counts of a part as the narrowest numbers that hold them; beyond 2^31 only the order among such buckets is lost."""
    most = int(counts.max())
    return np.minimum(counts, (1 << 31) - 1).astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32).tobytes()


def _unpacked(counts: bytes) -> np.ndarray:
    return np.frombuffer(counts, {1: np.uint8, 2: np.uint16, 4: np.uint32}[len(counts) // _PART])


def _nodes(k: int, buckets: int):
    """A row for each document; after the last one, rows with the counts of the task's shingles."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.uint32)
        for batch in text_batches(it):
            sets = [*shingle_sets(batch.column(1), k)]
            at = (np.concatenate(sets) & np.uint64(buckets - 1)).astype(np.int64)
            np.add.at(total, at, np.uint32(1))
            nothing = [None] * len(sets)
            yield batches({"_doc": batch.column(0).to_pylist(), "_n": [len(s) for s in sets], "_node": [node_of(s) if len(s) else None for s in sets], "_sketch": [sketch(s) if len(s) else None for s in sets], "_few": [few(s) if len(s) else None for s in sets], "_part": nothing, "_counts": nothing}, _NODE)
        parts = np.flatnonzero(total.reshape(-1, _PART).any(1))
        nothing = [None] * len(parts)
        yield batches({"_doc": nothing, "_n": nothing, "_node": nothing, "_sketch": nothing, "_few": nothing, "_part": parts, "_counts": [_packed(total[p * _PART : (p + 1) * _PART]) for p in parts.tolist()]}, _NODE)

    return run


def _summed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of the count vectors of a part; parts arrive sorted."""
    part, total, out = None, np.zeros(_PART, np.int64), {"_part": [], "_counts": []}
    for batch in it:
        for p, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if p != part and part is not None:
                out["_part"].append(part)
                out["_counts"].append(_packed(total))
                total[:] = 0
            part = p
            total += _unpacked(c)
    if part is not None:
        out["_part"].append(part)
        out["_counts"].append(_packed(total))
    yield batches(out, _COUNT)


def shingle_counts(counted: DataFrame, buckets: int) -> np.ndarray:
    """In how many documents the shingles of each bucket occur, over all rows; of fixed size, whatever the corpus."""
    parts = counted.where("_part is not null").select("_part", "_counts").repartition("_part").sortWithinPartitions("_part").mapInArrow(_summed, "_part int, _counts binary")
    total = np.zeros((buckets // _PART, _PART), np.uint32)
    for r in parts.toLocalIterator():  # buckets * 4 bytes in all
        total[r["_part"]] = _unpacked(r["_counts"])
    return total.ravel()


def _entries(k: int, t: Fraction, counts, hot_from: int):
    """Prefix entries; a set that a task has met before is not indexed again."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, df = set(), counts.value
        mask, hot = np.uint64(len(df) - 1), 4 * df.mean() + hot_from
        for batch in text_batches(it):
            parts = []
            for s in shingle_sets(batch.column(0), k):
                if not len(s) or (node := node_of(s)) in met:
                    continue
                if len(met) > 500_000:
                    met.clear()
                met.add(node)
                n = len(s)
                often = df[(s & mask).astype(np.int64)]
                prefix = n - -(-t.numerator * n // t.denominator) + 1
                # The rarest, ties by hash: s is sorted, so the order of equal counts stays.
                order = np.argsort(often, kind="stable")[:prefix]
                weight = int(often.sum(dtype=np.int64) * 16 // n)
                salt = np.where(often[order] > hot, 1 + node % _SALTS, 0)
                parts.append((s[order].view(np.int64), salt, np.full(prefix, node), n << 32 | np.arange(prefix), np.full(prefix, weight)))
            if parts:
                yield batches(dict(zip(_ENTRY.names, map(np.concatenate, zip(*parts, strict=True)), strict=True)), _ENTRY)

    return run


def least_overlap(t: Fraction, m: int, n: int) -> int:
    """Common shingles that sets of m and n need for a Jaccard similarity of t."""
    return -(-t.numerator * (m + n) // (t.numerator + t.denominator))


def suffix_filter(x: np.ndarray, y: np.ndarray, most: int, depth: int = 3) -> int:
    """A lower bound of the symmetric difference of two sorted sets; stops beyond ``most``."""
    gap = abs(len(x) - len(y))
    if depth == 0 or gap > most or not len(x) or not len(y):
        return gap
    pivot = y[len(y) // 2]
    a, b = int(np.searchsorted(x, pivot)), len(y) // 2
    same = int(a < len(x) and x[a] == pivot)
    left, right = abs(a - b), abs(len(x) - a - same - (len(y) - b - 1))
    if left + right + 1 - same > most:
        return left + right + 1 - same
    left = suffix_filter(x[:a], y[:b], most - right - 1 + same, depth - 1)
    return left + suffix_filter(x[a + same :], y[b + 1 :], most - left - 1 + same, depth - 1) + 1 - same


def links(x: np.ndarray, y: np.ndarray, t: Fraction) -> bool:
    """Is the Jaccard similarity t at least? Suffix filter first, then the exact count."""
    need = least_overlap(t, len(x), len(y))
    most = len(x) + len(y) - 2 * need
    return most >= 0 and suffix_filter(x, y, most) <= most and len(np.intersect1d(x, y, assume_unique=True)) >= need


def _alike(t: Fraction):
    """Pairs that the counts of their parts allow to link."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(it, 4096):
            keep = []
            for m, x, n, y in zip(*[batch.column(i).to_pylist() for i in (2, 3, 4, 5)], strict=True):
                most = m + n - 2 * least_overlap(t, m, n)
                keep.append(most >= 0 and least_difference(parts_of(x, m), parts_of(y, n)) <= most)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], schema=_LINK)

    return run


def _verified(k: int, t: Fraction):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = {"_a": [], "_b": []}
        for batch in text_batches(it):
            for a, b, mine, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), shingle_sets(batch.column(2), k), shingle_sets(batch.column(3), k), strict=True):
                if len(mine) and len(held) and node_of(mine) == a and node_of(held) == b and links(mine, held, t):
                    out["_a"].append(a)
                    out["_b"].append(b)
            yield drained(out, _LINK)

    return run


def components(links: DataFrame) -> DataFrame:
    """(_node, _least): the least node reachable from each node of ``links`` (columns _a, _b).

    Large-star and small-star in turn (Kiverdis and others, 2014) until nothing changes: the number of rounds is
    logarithmic, each is two aggregations of the links, and a node's neighbours are only ever summed, never collected.
    """
    edges = stored(links.select(F.greatest("_a", "_b").alias("_hi"), F.least("_a", "_b").alias("_lo")).where("_hi <> _lo").distinct(), "links")
    before, state = None, ()
    while state != before:
        both = edges.select("_hi", "_lo").union(edges.select(F.col("_lo"), F.col("_hi")))
        least = both.groupBy(F.col("_hi").alias("_u")).agg(F.least(F.min("_lo"), F.col("_u")).alias("_m"))
        large = both.join(least, F.col("_hi") == F.col("_u")).where("_lo > _u").select(F.col("_lo").alias("_hi"), F.col("_m").alias("_lo"))
        large = large.where("_hi <> _lo").distinct()
        lower = large.groupBy(F.col("_hi").alias("_u")).agg(F.min("_lo").alias("_m"))
        small = large.join(lower, F.col("_hi") == F.col("_u")).select(F.explode(F.array(F.struct(F.col("_lo").alias("_hi"), F.col("_m").alias("_lo")), F.struct(F.col("_u").alias("_hi"), F.col("_m").alias("_lo")))).alias("e")).select("e.*")
        after = stored(small.where("_hi <> _lo").distinct(), "links")
        discard(edges)
        before, edges = state, after
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("_hi", "_lo").cast("decimal(38,0)"))).first()
    return view_of(edges, edges.select(F.col("_hi").alias("_node"), F.col("_lo").alias("_least")))


def jaccard_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 5, threshold: str = "3/4", buckets: int = 1 << 22, rounds: int = 1, hot_from: int = 2_000) -> DataFrame:
    """One row per document: ``id_col``, n_shingles (size of its set) and component_id.

    Documents link when the Jaccard similarity of their sets of k-word shingles (A-Z lower-cased) is
    ``threshold`` at least; component_id is the least id reachable by links, its own included.
    Null or wordless texts have an empty set and link with nothing. Rows that repeat an id stay rows,
    each judged by its own text (of different texts under one id, the pairs that need the id's text are
    checked against each). A row with a null id links only through a row that has an id and the same set.
    Sets are named by 64-bit hashes of 64-bit shingle hashes; a false link needs such hashes to collide.
    ``rounds`` of stars go before the pairwise rest; a shingle is hot if its bucket counts ``hot_from`` more than four times the mean.
    """
    t = Fraction(threshold)
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("_doc"), F.col(text_col).alias("_text"))
    counted = stored(source.mapInArrow(_nodes(k, buckets), "_doc long, _n long, _node long, _sketch binary, _few array<tinyint>, _part int, _counts binary"), "nodes")
    df = spark.sparkContext.broadcast(shingle_counts(counted, buckets))

    nodes = counted.where("_part is null").select("_doc", "_n", "_node")
    classes = stored(nodes.where("_node is not null").groupBy("_node").agg(F.min("_doc").alias("_doc")), "classes")
    entries = source.select("_text").mapInArrow(_entries(k, t, df, hot_from), "_token long, _salt int, _node long, _place long, _weight long").repartition("_token", "_salt")
    entries = entries.groupBy("_token", "_salt", "_node").agg(F.max("_place").alias("_place"), F.max("_weight").alias("_weight"))
    size = lambda c: F.shiftright(c, 32)
    place = lambda c: F.col(c).bitwiseAND(0xFFFFFFFF)

    def overlap(p: str, q: str):
        """Common shingles that a link needs."""
        return F.ceil((size(F.col(p)) + size(F.col(q))) * t.numerator / float(t.numerator + t.denominator) - 1e-9)

    def passes(p: str, q: str):
        """Length filter, and what is left behind both places must still make up the overlap needed."""
        m, n = size(F.col(p)), size(F.col(q))
        return (F.least(m, n) * t.denominator >= F.greatest(m, n) * t.numerator) & (F.least(m - place(p), n - place(q)) >= overlap(p, q))

    # Centre of a group: the greatest weight, then the greatest node. A window over the shingle reads the one shuffle once.
    group = Window.partitionBy("_token", "_salt")
    centre = F.max(F.struct("_weight", "_node", "_place")).over(group)
    grouped = entries.withColumns({"_g": F.count("*").over(group), "_centre": centre}).where("_g > 1 or _salt > 0")
    grouped = grouped.select("_token", "_salt", "_g", "_node", "_place", "_weight", F.col("_centre._node").alias("_c"), F.col("_centre._place").alias("_cp"))
    grouped = stored(grouped, "prefix-groups")
    # A hot shingle's parts have a centre each, of which the greatest is the centre of all.
    parts = grouped.where("_salt > 0 and _node = _c").select("_token", F.struct("_weight", "_node", "_place").alias("_at"))
    top = parts.groupBy("_token").agg(F.max("_at").alias("_top"))
    tops = parts.join(top, "_token").select("_at._node", "_at._place", F.col("_top._node").alias("_c"), F.col("_top._place").alias("_cp"))

    def of_pairs(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.explode(F.array("_a", "_b")).alias("_id")).distinct()

    def both(pairs: DataFrame, rows: DataFrame, *columns: str) -> DataFrame:
        """``rows`` (by _id) at both ends of each pair."""
        for end in ("_a", "_b"):
            pairs = pairs.join(rows.select(F.col("_id").alias(end), *[F.col(c).alias(end + c) for c in columns]), end)
        return pairs.select("_a", "_b", *[end + c for end in ("_a", "_b") for c in columns])

    def verify(pairs: DataFrame) -> DataFrame:
        sketches = counted.join(of_pairs(pairs), F.col("_node") == F.col("_id"), "left_semi").groupBy(F.col("_node").alias("_id")).agg(F.first("_n").alias("_n"), F.first("_sketch").alias("_s"))
        alike = stored(both(pairs, sketches, "_n", "_s").mapInArrow(_alike(t), "_a long, _b long"), "alike")
        reps = stored(classes.join(of_pairs(alike), F.col("_node") == F.col("_id"), "left_semi"), "representatives")
        held = stored(among(source, reps.select("_doc"), "_doc").join(reps, "_doc").select(F.col("_node").alias("_id"), F.col("_text").alias("_t")), "texts")
        out = stored(both(alike, held, "_t").mapInArrow(_verified(k, t), "_a long, _b long"), "verified")
        discard(alike, reps, held)
        return out

    judged, found = [], []

    def judge(pairs: DataFrame, name: str) -> DataFrame | None:
        """Verifies the pairs that were not judged before; the components of all links so far, or nothing where no pair was new."""
        new = pairs.select(F.least("_node", "_c").alias("_a"), F.greatest("_node", "_c").alias("_b")).distinct()
        if judged:
            new = new.join(reduce(DataFrame.union, judged), ["_a", "_b"], "left_anti")
        new = stored(new, name)
        judged.append(new)
        if new.isEmpty():
            return None
        found.append(verify(new))
        return components(reduce(DataFrame.union, found))

    def mixed(label: DataFrame) -> DataFrame:
        """Groups with nodes of several components, each node with its component and that of most of the group."""
        named = left.join(label, "_node", "left").select("_token", "_node", "_place", F.coalesce("_least", "_node").alias("_comp"))
        per = named.groupBy("_token", "_comp").agg(F.count("*").alias("_k"))
        main = per.groupBy(F.col("_token").alias("_t")).agg(F.max_by("_comp", F.struct("_k", "_comp")).alias("_main"), F.count("*").alias("_comps"), F.sum("_k").alias("_size")).where("_comps > 1")
        return stored(named.join(main, F.col("_token") == F.col("_t")).select("_token", "_node", "_place", "_comp", "_main", "_size"), "mixed-groups")

    stars = grouped.select("_node", "_place", "_c", "_cp").union(tops).where((F.col("_node") != F.col("_c")) & passes("_place", "_cp"))
    none = spark.createDataFrame([], "_node long, _least long")
    label = judge(stars, "stars")
    label = none if label is None else label

    # What is left: pairs of one group in different components, but for those with a centre that saw all of the group.
    left = grouped.where("(_g > 2 and _node <> _c) or _salt > 0").select("_token", "_node", "_place")
    groups = mixed(label)
    discard(grouped)
    df.destroy()
    for r in range(rounds):
        left = groups.select("_token", "_node", "_place")
        # Any one node of each group, another one in each group and round.
        drawn = groups.withColumn("_h", F.xxhash64("_node", "_token", F.lit(r)))
        least = drawn.groupBy("_token").agg(F.min("_h").alias("_h"))
        centres = drawn.join(least, ["_token", "_h"]).select("_token", F.col("_node").alias("_c"), F.col("_place").alias("_cp"), F.col("_comp").alias("_cc"))
        pairs = groups.join(centres, "_token").where((F.col("_comp") != F.col("_cc")) & passes("_place", "_cp"))
        after = judge(pairs.select("_node", "_c"), "stars")
        if after is None:
            break
        before, label = [groups, *([] if label is none else [label])], after
        groups = mixed(label)
        discard(*before)
    # One side is outside the component of most of the group.
    counts = counted.join(groups.select(F.col("_node").alias("_id")).distinct(), F.col("_node") == F.col("_id"), "left_semi").groupBy("_node").agg(F.first("_few").alias("_few"))
    groups_with = groups.join(counts, "_node")
    # Parts of a large group, by node on either side; each side goes to all parts of the other.
    dealt = F.ceil(F.col("_size") / _MEET)
    mine, others = F.pmod(F.xxhash64("_node"), dealt), F.explode(F.sequence(F.lit(0).cast("long"), dealt - 1))
    few = groups_with.where("_comp <> _main").select("_token", mine.alias("_i"), others.alias("_j"), "_node", F.col("_place").alias("_p"), F.col("_comp").alias("_ca"), F.col("_few").alias("_x"))
    every = groups_with.select("_token", others.alias("_i"), mine.alias("_j"), F.col("_node").alias("_c"), F.col("_place").alias("_q"), F.col("_comp").alias("_cb"), "_main", F.col("_few").alias("_y"))
    # The suffix filter on 128 parts of the hash space, while the pairs are made.
    apart = F.aggregate(F.zip_with("_x", "_y", lambda x, y: F.abs(x - y)), F.lit(0), lambda total, d: total + d)
    may = passes("_p", "_q") & (apart <= size(F.col("_p")) + size(F.col("_q")) - 2 * overlap("_p", "_q"))
    rest = few.join(every, ["_token", "_i", "_j"]).where((F.col("_ca") != F.col("_cb")) & ((F.col("_cb") == F.col("_main")) | (F.col("_node") < F.col("_c"))) & may)
    after = judge(rest.select("_node", "_c"), "rest")
    used = [x for x in (label, after) if x is not None and x is not none]
    label = label if after is None else after
    discard(groups, *judged, *found)

    # The least id of each component; one that holds much of the corpus is dealt out by its nodes.
    linked = classes.join(label, "_node").select("_node", "_doc", "_least", F.pmod("_node", F.lit(_SALTS)).alias("_salt"))
    roots = classes.join(label.select(F.col("_least").alias("_node")).distinct(), "_node").select(F.col("_node").alias("_least"), F.col("_doc"))
    least = linked.select("_least", "_doc").union(roots).groupBy("_least").agg(F.min("_doc").alias("_id"))
    salted = least.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    ids = linked.join(salted, ["_least", "_salt"]).select("_node", "_id").union(least.select(F.col("_least").alias("_node"), "_id"))
    every = classes.join(ids, "_node", "left").select("_node", F.coalesce("_id", "_doc").alias("_id"))
    out = nodes.join(every, "_node", "left").select(F.col("_doc").alias(id_col), F.col("_n").alias("n_shingles"), F.coalesce("_id", "_doc").alias("component_id"))
    out = stored(out, "components")
    discard(counted, classes, *used)
    return out
