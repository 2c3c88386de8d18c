"""Quality by nearest neighbours: labelled latent-semantic vectors vote with their similarity.

A text becomes counts of hashed features: its words, their shapes, and how words and lines repeat.
Damped counts times inverse document frequency are projected on the leading singular directions of a
bounded labelled sample. The sample's vectors are broadcast; every document is compared with all of
them, in blocks, by exact cosine products, and its nearest neighbours vote, weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from pricepanel.llm.common import as_binary, text_batches
from pricepanel.llm.toxicity import fitted, labelled_sample


def shape(word: bytes) -> str:
    """Letters by case, digits and other signs; runs count once."""
    out = []
    for c in word.decode():
        kind = "X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


class Features(dict):
    """Word -> its two features (word, shape)."""

    def __init__(self, size: int, most: int = 400_000):
        super().__init__()
        self.size, self.most = size, most

    def number(self, name: str) -> int:
        return xxhash.xxh3_64_intdigest(name) % self.size

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) >= self.most:
            self.clear()
        self[word] = value = self.number("w " + word.decode().lower()), self.number("s " + shape(word))
        return value

    def counts(self, text: bytes | None) -> np.ndarray:
        """Damped counts of a text's features, shares of repeats among them."""
        text = text or b""
        words = text.split()
        pairs = np.array(list(map(self.__getitem__, words)), np.int64).reshape(-1, 2)
        out = np.log1p(np.bincount(pairs[:, 0], minlength=self.size))
        shapes = np.bincount(pairs[:, 1], minlength=self.size)
        n = max(1, len(words))
        out += 12 * np.sqrt(shapes / n)  # shares: a shape matters by how much of the text has it
        lines = [x for x in text.split(b"\n") if x.strip()]
        for name, share in (
            ("same word again", sum(a == b for a, b in pairwise(words)) / n),
            ("few words", 1 - len(set(words)) / n),
            ("line again", 1 - len(set(lines)) / max(1, len(lines))),
            ("signs", sum(not w.decode().isalnum() for w in words) / n),
            ("long words", sum(len(w) > 24 for w in words) / n),
            ("short text", 1 / (1 + n / 20)),
        ):
            out[self.number("r " + name)] += 12 * np.sqrt(share)
        return out


@dataclass
class Neighbours:
    """idf, projection, unit vectors of the sample and their labels."""

    size: int
    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    k: int

    def project(self, counts: np.ndarray) -> np.ndarray:
        x = (counts * self.idf).astype(np.float32) @ self.projection
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def vote(self, x: np.ndarray) -> np.ndarray:
        """Share of label 1 among each row's k nearest, weighted by similarity."""
        if not len(self.labels):
            return np.full(len(x), 0.5)
        k = min(self.k, len(self.labels))
        similar = x @ self.vectors.T
        near = np.argpartition(-similar, k - 1, axis=1)[:, :k]
        weight = np.clip(np.take_along_axis(similar, near, 1), 1e-6, None) ** 8
        return np.clip((weight * self.labels[near]).sum(1) / weight.sum(1), 0.0, 1.0)


def fit(texts: list[bytes], labels: list[int], *, size: int = 4096, rank: int = 48, k: int = 15, seed: int = 7) -> Neighbours:
    """Latent-semantic space of the sample by subspace iteration."""
    if not texts:
        return Neighbours(size, np.ones(size, np.float32), np.zeros((size, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), k)
    features = Features(size)
    counts = np.stack([features.counts(t).astype(np.float32) for t in texts])
    idf = (np.log((1 + len(texts)) / (1 + (counts > 0).sum(0))) + 0.3).astype(np.float32)
    x = counts * idf
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    q = np.random.default_rng(seed).normal(size=(size, min(rank, len(texts), size))).astype(np.float32)
    for _ in range(6):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    model = Neighbours(size, idf, q.astype(np.float32), np.zeros((0, 1)), np.array(labels, np.float64), k)
    model.vectors = model.project(counts)
    return model


def _votes(model, schema: pa.Schema):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        features = Features(m.size)
        for batch in text_batches(it):
            counts = np.stack([features.counts(t) for t in as_binary(batch.column(batch.num_columns - 1))]) if batch.num_rows else np.zeros((0, m.size))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(m.vote(m.project(counts)), pa.float64())], schema=schema)

    return run


def train(docs: DataFrame, labels: DataFrame, *, label: str = "quality", per_class: int = 1_500, max_chars: int = 12_000_000, id_col: str = "doc_id", text_col: str = "text", **settings) -> Neighbours:
    """Vectors of a bounded sample of labelled rows (of each class ``per_class`` rows and ``max_chars`` characters), whole texts."""
    return fitted(labelled_sample(docs, labels, label, per_class, id_col, text_col, max_chars), lambda texts, ys: fit(texts, ys, **settings))


def quality(docs: DataFrame, model: Neighbours, *, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and score (0 to 1). Null and empty texts are scored as texts without features; with no labels the score is 0.5."""
    source = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(text_col).alias("_text"))
    kept = source.drop("_text")
    arrow = to_arrow_schema(kept.schema).append(pa.field("score", pa.float64()))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    out = source.mapInArrow(_votes(docs.sparkSession.sparkContext.broadcast(model), arrow), f"{kinds}, score double")
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "score")
