"""Toxicity: subword bags averaged into a linear softmax, trained jointly in numpy.

A word is its character n-grams (and itself) hashed into a table of embeddings, so a misspelling that was
never seen shares most of a word's vectors. A passage of words is the average of its vectors; a linear
softmax over it gives two classes. A document scores as its most toxic passage, so a long text does not
drown a few words. Because all is linear up to the softmax, a word adds a fixed number to the logit of a
passage: scoring needs one table look-up per word and a running sum.

Training fits passages, but labels are of documents: each toxic document gives the passage that scores
highest so far (at first by counts of words), clean ones give their highest and some others, and both tables
are trained on them by Adam, a few times over.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from pricepanel.llm.common import as_binary, grams, held_out, text_batches


def subwords(words: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of each word and its 3- to 5-character n-grams, ends marked: all in a row, and how many each word has."""
    marked = [f"<{w.decode().lower()}>" for w in words]
    long = np.array([len(w) for w in marked], np.int64)
    codes = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), long)
    left = np.cumsum(long)[owner] - np.arange(len(codes))
    whole = np.fromiter(map(xxhash.xxh3_64_intdigest, marked), np.uint64, len(words))
    owners, found = [np.arange(len(words))], [whole]
    for n in range(3, 6):
        at = np.flatnonzero((left >= n) & (long > n)[owner])
        owners.append(owner[at])
        found.append(grams(codes, n)[at])
    keys = np.sort(np.concatenate(owners) * buckets + (np.concatenate(found) % np.uint64(buckets)).astype(np.int64))
    once = keys[np.diff(keys, prepend=-1) > 0]
    return once % buckets, np.bincount(once // buckets, minlength=len(words))


def in_blocks(words: list[bytes], most: int = 300_000) -> Iterator[list[bytes]]:
    """The words in blocks of ``most`` bytes or one word, so that what is made of a block stays small."""
    block, size = [], 0
    for w in words:
        if block and size + len(w) > most:
            yield block
            block, size = [], 0
        block.append(w)
        size += len(w)
    if block:
        yield block


def spoken(text: bytes | None) -> list[bytes]:
    """Words of a text; a word said again and again at once counts once."""
    return [w for w, _ in groupby((text or b"").split())]


@dataclass
class Model:
    """``logits[b]``: what bucket b adds to the logit of toxic, the softmax weights applied to its embedding."""

    logits: np.ndarray
    bias: float
    window: int

    def values(self, words: list[bytes]) -> list[float]:
        """What each word adds to the logit: the average of its buckets."""
        index, many = subwords(words, len(self.logits))
        return (np.add.reduceat(self.logits[index].astype(np.float64), np.cumsum(many) - many) / many).tolist()


class WordValues(dict):
    """Word -> its value; words not met before are worked out together. Forgets all beyond ``most`` words."""

    def __init__(self, model: Model, most: int = 400_000):
        super().__init__()
        self.model, self.most = model, most

    def of(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        if len(self) > self.most:
            self.clear()
        for words in in_blocks(list(set(chain.from_iterable(texts)).difference(self))):
            self.update(zip(words, self.model.values(words), strict=True))
        return [np.fromiter(map(self.__getitem__, words), float, len(words)) for words in texts]


def passages(n: int, window: int) -> np.ndarray:
    """Starts and ends of half-overlapping passages of ``window`` words that cover n words; fewer words are one passage."""
    step = window // 2
    starts = np.minimum(np.arange(0, max(n - step, 1), step), max(n - window, 0))
    return np.stack([starts, np.minimum(starts + window, n)], 1)


def passage_scores(values: np.ndarray, window: int, bias: float) -> np.ndarray:
    """Logit of each passage: average of its words' values."""
    sums = np.r_[0.0, np.cumsum(values)]
    at = passages(len(values), window)
    return bias + (sums[at[:, 1]] - sums[at[:, 0]]) / np.maximum(at[:, 1] - at[:, 0], 1)


def _score(values: np.ndarray, window: int, bias: float) -> float:
    logit = passage_scores(values, window, bias).max() if len(values) else bias
    return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


def fit(texts: list[bytes], labels: list[int], *, buckets: int = 1 << 17, dim: int = 8, window: int = 16, rounds: int = 3, epochs: int = 8, negatives: int = 4, rate: float = 0.3, least: int = 5, seed: int = 4) -> Model:
    """Train on whole texts of documents; the order of the rows sets nothing but ties."""
    rng, y = np.random.default_rng(seed), np.array(labels)
    table = rng.normal(0, 0.01, (buckets, dim)).astype(np.float32)
    weights, bias = rng.normal(0, 0.3, (dim, 2)).astype(np.float32), np.zeros(2, np.float32)
    number: dict[bytes, int] = {}
    docs = [np.array([number.setdefault(w, len(number)) for w in spoken(t)], np.int64) for t in texts]
    words_of = list(in_blocks(list(number)))

    having = np.zeros((2, buckets))  # documents of a class with a word of the bucket, counted by word
    for c in (0, 1):
        met = np.concatenate([np.zeros(0, np.int64), *[np.unique(words) for words, label in zip(docs, labels, strict=True) if label == c]])
        often, at = np.bincount(met, minlength=len(number)), 0
        for block in words_of:
            index, many = subwords(block, buckets)
            having[c] += np.bincount(index, np.repeat(often[at : at + len(block)], many), buckets)
            at += len(block)
    odds = np.log((having[1] + 0.5) / (having[0] + 0.5)) - np.log(((y == 1).sum() + 1) / ((y == 0).sum() + 1)) - 1.0
    common = having.sum(0) >= least
    table[~common] = 0  # too rare to learn from: such n-grams stay without a vector
    # Of each word the buckets that have a vector, and how many it has with the others.
    compact, kept, per_word = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for block in words_of:
        index, many = subwords(block, buckets)
        usable = common[index]
        compact.append(index[usable].astype(np.int32))
        kept.append(np.add.reduceat(usable, np.cumsum(many) - many, dtype=np.int64))
        per_word.append(many)
    compact, kept, per_word = map(np.concatenate, (compact, kept, per_word))
    first = np.cumsum(kept) - kept

    def bag(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Buckets with a vector of a passage's words, and the share of its word that each makes up."""
        n = kept[words]
        at = np.repeat(first[words] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return compact[at], np.repeat((window / len(words) / per_word[words]).astype(np.float32), n)

    logits, floor = np.where(common, np.maximum(odds, 0), 0).astype(np.float32), 0.0
    for _ in range(rounds):
        values = np.zeros(len(number))
        for at in range(0, len(number), 10_000):  # sums of the buckets of each word, in blocks
            ends = first[at : at + 10_000] + kept[at : at + 10_000]
            sums = np.r_[0, np.cumsum(logits[compact[first[at] : ends[-1]]], dtype=np.float64)]
            values[at : at + 10_000] = (sums[ends - first[at]] - sums[first[at : at + 10_000] - first[at]]) / per_word[at : at + 10_000]
        bags, ys = [], []
        for words, c in zip(docs, labels, strict=True):
            if len(words):
                at, scores = passages(len(words), window), passage_scores(values[words], window, floor)
                for i in {int(scores.argmax())} if c else {int(scores.argmax()), *rng.integers(0, len(at), negatives).tolist()}:
                    bags.append(words[slice(*at[i])])
                    ys.append(c)
        _train(table, weights, bias, list(map(bag, bags)), np.array(ys), epochs, rng, rate)
        logits = (window * (table @ (weights[:, 1] - weights[:, 0]))).astype(np.float32)
        floor = float(bias[1] - bias[0])
    return Model(logits, floor, window)


def _train(table, weights, bias, bags, y, epochs, rng, rate, batch: int = 256) -> None:
    """Softmax cross-entropy; embeddings (plain gradient steps) and softmax (Adam) move together. Toxic passages weigh 0.3 in all.

    A passage is the average of its words' vectors times a fixed scale, which the model keeps.
    """
    bags, y = [b for b in bags if len(b[0])], y[[i for i, b in enumerate(bags) if len(b[0])]]
    share = np.array([w / max(1, (y == c).sum()) for c, w in ((0, 0.7), (1, 0.3))], np.float32) * len(y)
    flat, scale = [b[0] for b in bags], [b[1] for b in bags]
    state = {name: [np.zeros_like(p), np.zeros_like(p)] for name, p in (("w", weights), ("b", bias))}
    for epoch in range(epochs):
        order, step = rng.permutation(len(bags)), rate * (1 - epoch / epochs)
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            index, factor = np.concatenate([flat[r] for r in rows]), np.concatenate([scale[r] for r in rows])
            ends = np.cumsum([0, *[len(flat[r]) for r in rows]])[:-1]
            bag = np.add.reduceat(table[index] * factor[:, None], ends, axis=0)
            logit = bag @ weights + bias
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p *= share[y[rows]][:, None] / len(rows)
            back = (p @ weights.T)[np.repeat(np.arange(len(rows)), np.diff([*ends, len(index)]))] * factor[:, None]
            gradient = np.stack([np.bincount(index, back[:, d], len(table)) for d in range(back.shape[1])], 1).astype(np.float32)
            for name, parameter, g in (("w", weights, bag.T @ p), ("b", bias, p.sum(0))):
                m, v = state[name]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                parameter -= 0.02 * step / rate * m / (np.sqrt(v) + 1e-7)
            table -= step * len(rows) * gradient


def _scores(model, schema: pa.Schema):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        values = WordValues(m)
        for batch in text_batches(it):
            texts = list(map(spoken, as_binary(batch.column(batch.num_columns - 1))))
            out = [_score(v, m.window, m.bias) for v in values.of(texts)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.float64())], schema=schema)

    return run


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, id_col: str = "doc_id", text_col: str = "text", max_chars: int = 12_000_000) -> DataFrame:
    """_id, _y and _text (whole) of labelled rows, those of the least hashed ids; never held-out rows.

    Of each class ``per_class`` rows at most, with no more than ``max_chars`` characters together, so both rows and bytes of the
    sample are bounded. A row that does not fit is passed over, and those after it may; one with over a twentieth of
    ``max_chars`` never fits, so that no few long rows stand for a class. Labels that disagree about a row give none.
    """
    rows = labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_y")).where(F.col("_y").isin(0, 1) & ~held_out("_id"))
    rows = rows.groupBy("_id").agg(F.min("_y").alias("_y"), F.max("_y").alias("_top")).where("_y = _top").drop("_top")
    picked = [rows.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(per_class) for y in (0, 1)]
    chosen = F.broadcast(picked[0].union(picked[1]))  # 2 * per_class ids at most
    found = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).join(chosen, "_id")
    found = found.groupBy("_id", "_y").agg(F.min("_text").alias("_text"))  # an id that repeats counts once
    # No more rows than were chosen, so one task a class can sum their lengths; texts stay where they are.
    lengths = found.select("_id", "_y", F.length("_text").alias("_n"))
    in_order = F.array_sort(F.collect_list(F.struct(F.xxhash64("_id").alias("h"), F.col("_id").alias("id"), F.col("_n").cast("long").alias("n"))))
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.filter(F.transform(in_order, lambda x: x["id"]), lambda x: F.lit(False)).alias("ids"))
    fits = lambda a, x: F.when(a["sum"] + x["n"] <= max_chars, F.struct((a["sum"] + x["n"]).alias("sum"), F.concat(a["ids"], F.array(x["id"])).alias("ids"))).otherwise(a)
    lengths = lengths.where(20 * F.col("_n") <= max_chars).groupBy("_y").agg(F.aggregate(in_order, start, fits)["ids"].alias("_ids"))
    within = F.broadcast(lengths.select(F.explode("_ids").alias("_id")))
    return found.join(within, "_id").select("_id", "_y", "_text")


def fitted(sample: DataFrame, fit: Callable[[list[bytes], list[int]], object]):
    """What ``fit`` makes of a bounded sample's texts and labels, in one task; the driver gets no text, only the model."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, ys = [], []
        for batch in it:
            texts += as_binary(batch.column("_text"))
            ys += batch.column("_y").to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(texts, ys))], pa.binary())], names=["model"])

    row = sample.repartition(1).sortWithinPartitions("_id").mapInArrow(run, "model binary").first()
    return fit([], []) if row is None else pickle.loads(row["model"])


def train(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", per_class: int = 2_000, max_chars: int = 12_000_000, id_col: str = "doc_id", text_col: str = "text", **settings) -> Model:
    """Fit on a bounded sample of labelled rows (of each class ``per_class`` rows and ``max_chars`` characters); texts are read whole.

    With labels of one class or none there is nothing to learn: the score is that class's share, or 0.5.
    """

    def fit_sample(texts: list[bytes], ys: list[int]) -> Model:
        if len(set(ys)) < 2:
            share = (sum(ys) + 1) / (len(ys) + 2)
            return Model(np.zeros(1, np.float32), float(np.log(share / (1 - share))) if ys else 0.0, 16)
        return fit(texts, ys, **settings)

    return fitted(labelled_sample(docs, labels, label, per_class, id_col, text_col, max_chars), fit_sample)


def toxicity(docs: DataFrame, model: Model, *, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and score (0 to 1). Null, empty and wordless texts score as a passage without words."""
    source = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(text_col).alias("_text"))
    kept = source.drop("_text")
    arrow = to_arrow_schema(kept.schema).append(pa.field("score", pa.float64()))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    out = source.mapInArrow(_scores(docs.sparkSession.sparkContext.broadcast(model), arrow), f"{kinds}, score double")
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "score")
