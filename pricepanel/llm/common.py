"""Helpers shared by the corpus operators: words, hashes, Arrow batches, shared tables."""

from __future__ import annotations

import re
import uuid
import weakref
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but these six bytes; ``bytes.split()`` splits on the same six.
WHITE = " \t\n\x0b\x0c\r"


#: The six white bytes; the value of each byte in a hash, those of A-Z as given or as a-z.
_WHITE = np.zeros(256, bool)
_WHITE[list(WHITE.encode())] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (in place)."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


def _odd(n: int, seed: int) -> np.ndarray:
    """The first n of a sequence of odd multipliers."""
    x = np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    return mixed(mixed(x)) | np.uint64(1)


_VALUE = _odd(256, 11)
_LOWER = _VALUE.copy()
_LOWER[65:91] = _VALUE[97:123]
_VALUE[_WHITE] = _LOWER[_WHITE] = 0
_PLACE = [_odd(1 << 12, 23)]


def _place(n: int) -> np.ndarray:
    """Multipliers of the first n bytes of a word at least."""
    if len(_PLACE[0]) < n:
        _PLACE[0] = _odd(2 * n, 23)
    return _PLACE[0]


def word_hashes(column: pa.Array, lower: bool = False, chunk: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a string column, and where each text's words start among them (one number more than texts).

    A word's hash is the sum of its bytes' values times the multipliers of their places, modulo 2^64; ``lower`` takes
    A-Z for a-z. Works on the column's buffer in chunks that end between words. A null has no words.
    """
    if not len(column):
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    column = column.fill_null("") if column.null_count else column
    _, offsets, data = column.cast(pa.binary()).buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets -= offsets[0]
    value, hashes, starts, at = _LOWER if lower else _VALUE, [], [], 0
    while at < len(data):
        end, step = min(at + chunk, len(data)), chunk
        while end < len(data):  # to the last white byte or text's end of the chunk; on, where one word fills it
            text = offsets[np.searchsorted(offsets, end, side="right") - 1]
            white = np.flatnonzero(_WHITE[data[max(at, text) : end]])
            if len(white) or text > at:
                end = max(at, text) + (int(white[-1]) + 1 if len(white) else 0)
                break
            step *= 2
            end = min(at + step, len(data))
        part = data[at:end]
        white = _WHITE[part]
        cut = np.empty(len(part), bool)
        cut[0], cut[1:] = True, white[:-1]
        first, last = np.searchsorted(offsets, [at, end])
        cut[offsets[first:last] - at] = True
        start = np.flatnonzero(cut & ~white)
        if len(start):
            long = np.diff(start, append=len(part))
            place = np.arange(len(part), dtype=np.int64)
            place -= np.repeat(np.r_[0, start], np.r_[start[0], long])
            x = value[part]
            x *= _place(int(max(long.max(), start[0])) + 1)[place]
            hashes.append(np.add.reduceat(x, start))
            starts.append(start + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(column) + 1, np.int64)
    return mixed(np.concatenate(hashes)), np.searchsorted(np.concatenate(starts), offsets)


#: Odd multipliers, one for each place in a shingle.
_PLACES = (np.random.default_rng(20).integers(1 << 62, 1 << 63, 32, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def grams(hashes: np.ndarray, k: int, chunk: int = 1 << 14) -> np.ndarray:
    """Hashes of all runs of k words; empty when there are fewer."""
    n = len(hashes) - k + 1
    out = np.empty(max(n, 0), np.uint64)
    for at in range(0, n, chunk):  # small enough to stay in the cache
        end = min(at + chunk, n)
        x = hashes[at:end] * _PLACES[0]
        for j in range(1, k):
            x += hashes[at + j : end + j] * _PLACES[j]
        out[at:end] = mixed(x)
    return out


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted, each once."""
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def as_binary(column: pa.ChunkedArray | pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


def batches(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def drained(rows: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    """A batch of what the lists hold; empties them."""
    out = batches(rows, schema)
    for x in rows.values():
        x.clear()
    return out


#: Where the tables of ``stored`` lie.
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
#: Paths written since each ``scratch`` that is open.
_OPEN: list[list[str]] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under spark.checkpoint.dir and read it back.

    This cuts the lineage at a table that survives the loss of executors. Where a session on one machine sets no
    checkpoint folder (tests) the warehouse folder is used.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    for made in _OPEN:
        made.append(path)
    return out


def view_of(table: DataFrame, view: DataFrame) -> DataFrame:
    """``view``, a selection from a table of ``stored``, stands for the table in ``discard``."""
    _PATHS[view] = _PATHS.pop(table)
    return view


@contextmanager
def scratch(spark: SparkSession) -> Iterator[set[str]]:
    """Tables that ``stored`` writes inside are deleted at the end, but for those that are put into the set (by ``place_of``)."""
    keep, made = set(), []
    _OPEN.append(made)
    try:
        yield keep
    finally:
        _OPEN.remove(made)
        for path in made:
            if path not in keep:
                _delete(spark, path)


def place_of(table: DataFrame) -> str:
    return _PATHS[table]


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``stored`` that nothing will read again."""
    for df in tables:
        _delete(df.sparkSession, _PATHS.pop(df))


def among(rows: DataFrame, ids: DataFrame, column: str, bits: int = 1 << 23) -> DataFrame:
    """``rows`` without most of those whose ``column`` is not among ``ids`` (one column), by a bitmap of their hashes.

    The bitmap has ``bits`` bits whatever the size of ``ids``, so it may be broadcast; what it lets through goes on to a join.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    one = ids.select(place(F.col(ids.columns[0])).alias("_bit"))
    bitmap = one.groupBy(F.bitmap_bucket_number("_bit").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("_bitmap"))
    at = F.bitmap_bit_position(place(F.col(column)))
    byte = F.conv(F.hex(F.substring("_bitmap", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = rows.join(F.broadcast(bitmap), F.bitmap_bucket_number(place(F.col(column))) == F.col("_bucket"))
    return found.where(F.getbit(byte, (at % 8).cast("int")) == 1).drop("_bucket", "_bitmap")


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse")
    return folder.rstrip("/") + "/pricepanel-llm"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id"):
    """Rows that no label is learnt from: crc32 of the id as text divides by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the public tokenizer file lies; a parameter of every operator that encodes."""
    import public_tokenizers

    return str(Path(public_tokenizers.path(name)))


def text_batches(it: Iterator[pa.RecordBatch], size: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that what is made of long texts never piles up in a Python worker.

    Spark itself ends a batch by rows and, with spark.sql.execution.arrow.maxBytesPerBatch, by bytes.
    """
    for batch in it:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def unused(*taken: str) -> Callable[[str], str]:
    """Names for helper columns that none of the ``taken`` ones has."""

    def name(wish: str) -> str:
        while wish in taken:
            wish = "_" + wish
        return wish

    return name


def set_aside(rows: DataFrame, results: tuple[str, ...], *columns: str) -> tuple[DataFrame, tuple[str, ...]]:
    """``rows`` with those of its columns that have a result's name renamed with ``_in`` after it, and the new names of some ``columns``."""
    new: dict[str, str] = {}
    for c in rows.columns:
        if c in results:
            new[c] = c + "_in"
            while new[c] in (*rows.columns, *results, *[v for k, v in new.items() if k != c]):
                new[c] += "_in"
    return rows.withColumnsRenamed(new), tuple(new.get(c, c) for c in columns)
