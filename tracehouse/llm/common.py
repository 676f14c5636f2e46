"""Shared helpers: staging on shared storage, batches bounded by bytes, hashes of words."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracehouse.session import shared_folder

# A word is a run of characters other than the ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"

# Texts handled together by one vectorised step; a longer text is a batch of its own.
BATCH_BYTES = 1 << 20

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_GOLD = np.uint64(0xD6E8FEB86659FD93)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- staging ----------------------------------------------------------------------------------------


class Stage:
    """Tables written once to shared storage and read back: lineage ends there, and a lost executor
    costs no recomputation. ``drop`` deletes what no later step reads."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.paths: dict[int, tuple[DataFrame, str]] = {}
        self.written = 0

    def __call__(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{self.written}"
        self.written += 1
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(back)] = (back, path)
        return back

    def passed_on(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """``new`` reads the table of ``old`` and is dropped in its place."""
        self.paths[id(new)] = (new, self.paths.pop(id(old))[1])
        return new

    def drop(self, *frames: DataFrame | None) -> None:
        for frame in frames:
            held = self.paths.pop(id(frame), None)
            if held is not None:
                path = held[1]
                target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                conf = self.spark.sparkContext._jsc.hadoopConfiguration()
                target.getFileSystem(conf).delete(target, True)


# --- columns ----------------------------------------------------------------------------------------


def words(text: Column) -> Column:
    """Words of a text as an array (null: none)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of the id written as text (null id: as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


# --- batches ----------------------------------------------------------------------------------------


def pieces_by_bytes(batch: pa.RecordBatch, column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch whose texts hold about ``limit`` bytes (one row at least)."""
    text = batch.column(column)
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(text), 0), np.int64)
    ends = np.cumsum(sizes)
    start, rows = 0, len(sizes)
    while start < rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


# --- hashes of words --------------------------------------------------------------------------------

_random = np.random.Generator(np.random.PCG64(20240229))
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[_BLANK] = 0
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: np.uint64 = _MULTIPLIER) -> np.ndarray:
    """base**0 … base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)[:n]


def word_hashes(text: str | bytes | None, lower: bool = False) -> np.ndarray:
    """64-bit hash of every word of one text, computed over blocks of its bytes."""
    if not text:
        return np.empty(0, np.uint64)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text, np.uint8)
    blank = _BLANK[data]
    first = ~blank
    first[1:] &= blank[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64)
    table = _BYTE_LOWER if lower else _BYTE
    out, at, size = [], 0, len(starts)
    while at < size:
        stop = max(at + 1, int(np.searchsorted(starts, starts[at] + BATCH_BYTES)))
        low = starts[at]
        high = starts[stop] if stop < size else len(data)
        own = starts[at:stop] - low
        lengths = np.diff(np.append(own, high - low))
        within = np.arange(high - low) - np.repeat(own, lengths)
        terms = table[data[low:high]] * powers(int(lengths.max()))[within]
        out.append(np.add.reduceat(terms, own))
        at = stop
    return mix(np.concatenate(out))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; of the whole sequence if there are fewer words."""
    n = len(hashes)
    if n == 0:
        return hashes
    if n < size:
        return mix(np.sum(hashes * powers(n, _GOLD), dtype=np.uint64, keepdims=True) + np.uint64(n))
    factor = powers(size, _GOLD)
    total = hashes[: n - size + 1] * factor[0]
    for k in range(1, size):
        total = total + hashes[k : n - size + 1 + k] * factor[k]
    return mix(total + np.uint64(size))
