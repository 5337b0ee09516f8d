"""Helpers shared by the training-data operators.

Text is handled as UTF-8 bytes.  ``bytes.split()`` splits on exactly the six
ASCII white-space characters of the word pattern ``[^\\x20\\x09-\\x0D]+``.
Tasks work through their rows in blocks of a few MB, so the memory of a Python
worker does not depend on the size of its partition.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_scratch

BLOCK_BYTES = 4 << 20
LAST_ID = (1 << 63) - 1          # stands for a null doc_id: it sorts after all others

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the rows no label may be learned from (crc32(doc_id) mod 3 = 1)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet in the shared folder and read it back: later
    reads neither recompute it nor depend on the executors that made it."""
    path = new_scratch(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_stored(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """Intermediate tables of one run, deleted together once their result is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def store(self, df: DataFrame, label: str) -> DataFrame:
        df, path = stored(df, label)
        self.paths.append(path)
        return df

    def drop(self, keep: int = 0) -> None:
        """Delete all tables but the ``keep`` last ones."""
        while len(self.paths) > keep:
            drop_stored(self.spark, self.paths.pop(0))


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads the bits of a hash (array in, array out)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def binary_rows(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def text_blocks(batches: Iterable[pa.RecordBatch], id_col: str, text_col: str,
                limit: int = BLOCK_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """Blocks of (ids, texts) of about ``limit`` bytes; a null text is empty."""
    ids: list = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        for i, t in zip(batch.column(id_col).to_pylist(), binary_rows(batch, text_col)):
            t = t or b""
            ids.append(i)
            texts.append(t)
            size += len(t)
            if size >= limit:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


class Words:
    """The words of a block of texts, in one normalised buffer (single spaces)."""

    def __init__(self, texts: list[bytes]):
        split = [t.split() for t in texts]
        self.counts = np.array([len(w) for w in split], dtype=np.int64)
        self.data = b" ".join(b" ".join(w) for w in split if w)
        self.buf = np.frombuffer(self.data, dtype=np.uint8)
        gaps = np.flatnonzero(self.buf == 32)
        total = int(self.counts.sum())
        self.starts = np.zeros(total, dtype=np.int64)
        self.ends = np.full(total, len(self.data), dtype=np.int64)
        if total:
            self.starts[1:] = gaps + 1
            self.ends[:-1] = gaps
        self.doc_first = np.concatenate(([0], np.cumsum(self.counts)))  # first word of each text

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        lens = self.ends - self.starts
        spans = lens + 1
        spans[-1] = lens[-1]
        at = np.arange(len(self.buf), dtype=np.int64) - np.repeat(self.starts, spans)
        with np.errstate(over="ignore"):
            power = np.cumprod(np.full(int(spans.max()) + 1, BASE, dtype=np.uint64))
            value = (self.buf.astype(np.uint64) + np.uint64(7)) * power[at]
            value[self.ends[:-1]] = 0
            return mix(np.add.reduceat(value, self.starts) + lens.astype(np.uint64))


def window_hash(values: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hash of each run of ``length`` consecutive values (by doubling)."""
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        out, done, size, level, mult = None, 0, 1, values, BASE
        left = length
        while left:
            if left & 1:
                part = level[done:done + n]
                out = part.copy() if out is None else out * mult + part
                done += size
            left >>= 1
            if left:
                level = level[:-size] * mult + level[size:]
                mult, size = mult * mult, size * 2
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` consecutive values."""
    level, size = values, 1
    while size * 2 <= width:
        level = np.minimum(level[:-size], level[size:])
        size *= 2
    rest = width - size
    return np.minimum(level[:len(level) - rest], level[rest:]) if rest else level
