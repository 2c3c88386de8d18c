"""Exact substring dedup: suffix automata of reference shards give matching statistics.

Broadcasting one automaton of the whole corpus to every document has no size bound, so the reference
is cut into shards and only the passages that can match a shard are streamed through it:

1. Winnowing. Every window of ``min_words`` words is named by its least 8-word hash (its *anchor*).
   Equal windows have equal anchors, so windows with an anchor that occurs once are unique.
2. Runs of windows whose anchor occurs again become *passages*, routed by anchor. Equal passages are
   merged where they are made, keeping the earliest; an anchor with very many occurrences is routed
   by whole windows instead, so no group of different passages grows with the corpus.
3. A shard is some consecutive anchors. Its automaton grows over its passages from the earliest on;
   at each word it knows the longest suffix that ended earlier (the matching statistic). A window
   repeats an earlier one exactly when that length reaches ``min_words``.
4. Every window of a shared run is removed but for those that step 3 saw first.

Passages are compared as texts: hashes only route, so results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from pricepanel.llm.common import as_binary, batches, drained, grams, stored, text_batches, word_hashes

_ANCHOR = 8
_RUNS = pa.schema([("_anchor", pa.int64()), ("_doc", pa.int64()), ("_mark", pa.int64()), ("_span", pa.int64())])
_PASSAGES = pa.schema([("_key", pa.int64()), ("_words", pa.string()), ("_doc", pa.int64()), ("_mark", pa.int64()), ("_start", pa.int32())])
_FIRST = pa.schema([("_doc", pa.int64()), ("_mark", pa.int64()), ("_start", pa.int32()), ("_first", pa.binary())])


def anchored(h: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of windows with one anchor: anchor, first window, last window + 1, seen twice within."""
    g, wide = grams(h, _ANCHOR), min_words - _ANCHOR + 1
    if len(g) < wide:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    least, have = g, 1
    while have < wide:  # sliding minimum by doubling
        step = min(have, wide - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    cut = np.flatnonzero(least[1:] != least[:-1]) + 1
    start, stop = np.r_[0, cut], np.r_[cut, len(least)]
    anchor, places = least[start], np.arange(wide)
    here = lambda w: w + (g[w[:, None] + places] == anchor[:, None]).argmax(1)  # noqa: E731  its first place in window w
    return anchor.view(np.int64), start, stop, here(start) != here(stop - 1)


def _runs(min_words: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(it):
            hashes, places = word_hashes(batch.column(2))
            docs, marks, parts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            for doc, mark, a, b in zip(docs, marks, places.tolist(), places[1:].tolist(), strict=False):
                if doc is None or b - a < min_words:
                    continue
                anchor, start, stop, twice = anchored(hashes[a:b], min_words)
                parts.append((anchor, np.full(len(anchor), doc), np.full(len(anchor), mark), start << 32 | stop << 1 | twice))
            if parts:
                yield batches(dict(zip(_RUNS.names, map(np.concatenate, zip(*parts, strict=True)), strict=True)), _RUNS)

    return run


def _passages(min_words: int, most: int = 60_000):
    """Texts of the shared runs; equal ones of a task are merged before they are dealt out."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, size = {}, 0

        def flush() -> pa.RecordBatch:
            keys, at = list(seen), list(seen.values())
            out = batches({"_key": [k for k, _ in keys], "_words": pa.array([w for _, w in keys], pa.binary()).cast(pa.string()), "_doc": [x[0] for x in at], "_mark": [x[1] for x in at], "_start": [x[2] for x in at]}, _PASSAGES)
            seen.clear()
            return out

        for batch in text_batches(it):
            for doc, mark, text, anchors, spans, hot in zip(*[batch.column(i).to_pylist() for i in (0, 1)], as_binary(batch.column(2)), *[batch.column(i).to_pylist() for i in (3, 4, 5)], strict=True):
                if not anchors or text is None:
                    continue
                words, windows = text.split(), None
                for anchor, span, many in zip(anchors, spans, hot, strict=True):
                    start, stop = span >> 32, (span & 0xFFFFFFFF) >> 1
                    if many:
                        if windows is None:
                            windows = grams(word_hashes(pa.array([text], pa.binary()))[0], min_words).view(np.int64).tolist()
                        pieces = [(windows[w], w, w + min_words) for w in range(start, min(stop, len(windows)))]
                    else:
                        pieces = [(anchor, start, stop + min_words - 1)]
                    for key, a, b in pieces:
                        k, at = (key, b" ".join(words[a:b])), (doc, mark, a)
                        old = seen.get(k)
                        if old is None:
                            seen[k] = at
                            size += b - a
                        elif at < old:
                            seen[k] = at
                if len(seen) >= most or size > 40 * most:
                    yield flush()
                    size = 0
        if seen:
            yield flush()

    return run


class Automaton:
    """A suffix automaton over several word sequences, grown word by word."""

    def __init__(self):
        self.length, self.link, self.next = [0], [-1], [{}]

    def stream(self, words: list, threshold: int) -> list[bool]:
        """For each word: do at least ``threshold`` words up to it end earlier in what was streamed? Adds the words."""
        length, link, edges, last, out = self.length, self.link, self.next, 0, []
        for c in words:
            q = edges[last].get(c)
            if q is None:
                cur = len(length)
                length.append(length[last] + 1)
                edges.append({})
                link.append(0)
                p = last
                while p >= 0 and c not in edges[p]:
                    edges[p][c] = cur
                    p = link[p]
                if p >= 0:
                    q = edges[p][c]
                    link[cur] = q if length[p] + 1 == length[q] else self._split(p, c, q)
                last = cur
                out.append(length[link[cur]] >= threshold)
            else:
                last = q if length[last] + 1 == length[q] else self._split(last, c, q)
                out.append(length[last] >= threshold)
        return out

    def _split(self, p: int, c, q: int) -> int:
        length, link, edges = self.length, self.link, self.next
        new = len(length)
        length.append(length[p] + 1)
        edges.append(edges[q].copy())
        link.append(link[q])
        link[q] = new
        while p >= 0 and edges[p].get(c) == q:
            edges[p][c] = new
            p = link[p]
        return new


def _shards(min_words: int, shard_words: int):
    """Sorted passages -> for those with windows seen first, which; a shard ends at a change of key."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, held, key = Automaton(), 0, None
        out: dict[str, list] = {n: [] for n in _FIRST.names}
        for batch in it:
            for k, text, doc, mark, start in zip(batch.column(0).to_pylist(), as_binary(batch.column(1)), *[batch.column(i).to_pylist() for i in (2, 3, 4)], strict=True):
                if k != key and held > shard_words:
                    automaton, held = Automaton(), 0
                key, words = k, text.split(b" ")
                held += len(words)
                again = automaton.stream(words, min_words)[min_words - 1 :]
                if not all(again):
                    out["_doc"].append(doc)
                    out["_mark"].append(mark)
                    out["_start"].append(start)
                    out["_first"].append(bytes(not x for x in again))
            if len(out["_doc"]) > 20_000:
                yield drained(out, _FIRST)
        yield drained(out, _FIRST)

    return run


def removed_words(n: int, spans: list[int], starts: list[int], firsts: list[bytes], min_words: int) -> np.ndarray:
    """Mask of the words that some removed window covers: those of the shared runs but for the windows seen first."""
    windows = np.zeros(n + 1, bool)
    for span in spans:
        windows[span >> 32 : (span & 0xFFFFFFFF) >> 1] = True
    for start, first in zip(starts, firsts, strict=True):
        flags = np.frombuffer(first, bool)
        windows[start : start + len(flags)] &= ~flags[: max(0, n + 1 - start)]
    edges = np.zeros(n + min_words + 1, np.int64)
    at = np.flatnonzero(windows)
    edges[at] += 1
    edges[at + min_words] -= 1
    return np.cumsum(edges)[:n] > 0


def _kept(min_words: int, schema: pa.Schema):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(it):
            n_words, n_removed, kept = [], [], []
            shared = [batch.column(c).to_pylist() for c in ("_spans", "_starts", "_firsts")]
            for text, spans, starts, firsts in zip(as_binary(batch.column("_text")), *shared, strict=True):
                words = (text or b"").split()
                n_words.append(len(words))
                if spans:
                    gone = removed_words(len(words), spans, starts or [], firsts or [], min_words)
                    words = [*compress(words, (~gone).tolist())]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-4], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], schema=schema)

    return run


def substring_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = 20, shard_words: int = 20_000, many: int = 2_000, keep: tuple[str, ...] = ()) -> DataFrame:
    """Remove each word of a ``min_words``-word window that also starts earlier in the corpus.

    Earlier means a smaller id, or the same document and an earlier start. Returns ``id_col``, the columns
    named in ``keep``, n_words, n_removed and kept_text (kept words joined by one space).

    Null text counts as no words. A row with a null id is neither earlier than others nor cut. Of rows that share
    an id, those with the same text are one position, so neither makes the other go; different texts are documents
    in the order of their hashes. Texts shorter than a window are never cut. ``shard_words`` bounds a shard's
    automaton; ``many`` occurrences of an anchor make it a hot one.
    """
    if min_words < _ANCHOR:
        raise ValueError(f"min_words must be {_ANCHOR} at least")
    ids = docs.groupBy(F.col(id_col).cast("long").alias("_doc")).agg(F.count("*").alias("_n"))
    unique = ids.where("_n > 1 and _doc is not null").isEmpty()
    mark = F.when(F.lit(not unique) | F.col(id_col).isNull(), F.xxhash64(F.col(text_col))).otherwise(F.lit(0).cast("long"))  # tells rows of one id apart
    own = [F.col(id_col).cast("long").alias("_doc"), mark.alias("_mark"), F.col(text_col).alias("_text")]
    runs = docs.select(*own).mapInArrow(_runs(min_words), "_anchor long, _doc long, _mark long, _span long")
    shared = runs.groupBy(F.col("_anchor").alias("_a")).agg(F.sum(1 + (F.col("_span") % 2)).alias("_n")).where("_n > 1")
    one = F.collect_list(F.struct(F.col("_anchor").alias("anchor"), F.col("_span").alias("span"), (F.col("_n") > many).alias("many"))).alias("_runs")
    listed = runs.join(shared, F.col("_anchor") == F.col("_a")).groupBy("_doc", "_mark").agg(one)
    listed = stored(listed, "substring-runs")

    dealt = docs.select(*own, *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)]).repartition("_doc", "_mark")
    found = dealt.join(listed, ["_doc", "_mark"], "left").select("_doc", "_mark", "_text", "_runs.anchor", "_runs.span", "_runs.many")
    passages = found.mapInArrow(_passages(min_words), "_key long, _words string, _doc long, _mark long, _start int").repartition("_key")
    if unique:  # a text gives each of its passages once, so there are no ties; hashed, where a least struct would be sorted
        earliest = passages.groupBy("_key", "_words").agg(F.min("_doc").alias("_doc"), F.min_by("_mark", "_doc").alias("_mark"), F.min_by("_start", "_doc").alias("_start"))
    else:
        earliest = passages.groupBy("_key", "_words").agg(F.min(F.struct("_doc", "_mark", "_start")).alias("_at")).select("_key", "_words", "_at.*")
    first = earliest.sortWithinPartitions("_key", "_doc", "_mark", "_start").mapInArrow(_shards(min_words, shard_words), "_doc long, _mark long, _start int, _first binary")
    firsts = first.groupBy("_doc", "_mark").agg(F.collect_list(F.struct(F.col("_start").alias("start"), F.col("_first").alias("first"))).alias("_seen"))

    kept_names = [f"_k{i}" for i in range(len(keep))]
    whole = dealt.join(listed.join(firsts, ["_doc", "_mark"], "left"), ["_doc", "_mark"], "left").select("_doc", *kept_names, "_text", F.col("_runs.span").alias("_spans"), F.col("_seen.start").alias("_starts"), F.col("_seen.first").alias("_firsts"))
    fields = [whole.schema[n] for n in ("_doc", *kept_names)]
    spark_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", n_words long, n_removed long, kept_text string"
    arrow = to_arrow_schema(whole.select("_doc", *kept_names).schema)
    for name, kind in (("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())):
        arrow = arrow.append(pa.field(name, kind))
    out = whole.mapInArrow(_kept(min_words, arrow), spark_schema)
    return out.select(F.col("_doc").alias(id_col), *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "n_words", "n_removed", "kept_text")
