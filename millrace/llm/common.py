"""What the text operators share: session settings, stored steps, word hashes, row identity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import prepare, scratch

#: Rows and bytes of one Arrow batch, so that long texts do not fill a worker.
BATCH_ROWS, BATCH_BYTES = 512, 16 << 20

MIX_1, MIX_2, STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def ready(spark: SparkSession) -> SparkSession:
    """The library's settings, and Arrow batches small enough for long texts."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written once to the shared folder and read back: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalised 64-bit hashes; a bijection."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash of a word, remembered; forgets all words once ``limit`` are held."""

    limit = 250_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive word hashes; the size is part of the hash."""
    n = hashes.size - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, np.uint64(size), np.uint64)
    for j in range(size):
        out = out * STEP + hashes[j:j + n]
    return mixed(out)


def space_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased; other characters stay as they are."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples of Python values."""
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def text_key(text: str | Column = "text") -> Column:
    """64-bit hash of a text; null and empty differ."""
    column = F.col(text) if isinstance(text, str) else text
    return F.xxhash64(column, column.isNull())


#: Bits of a filter over 64-bit keys: 8 MB, whatever the input.
FILTER_BITS_LOG2, FILTER_SLICES, FILTER_PARTS = 26, 64, 256


def filter_slots(keys: np.ndarray) -> np.ndarray:
    return mixed(keys) >> np.uint64(64 - FILTER_BITS_LOG2)


def in_filter(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be in the filter; true for every key that was put in."""
    slot = filter_slots(keys)
    return (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def key_filter(keys: DataFrame) -> np.ndarray:
    """A bit filter over one long column, of fixed size: tasks send bit arrays, never keys.

    It only spares later steps rows that a join would drop; with very many keys it lets all through.
    """
    width = (1 << FILTER_BITS_LOG2) // 8 // FILTER_SLICES
    schema = "slice int, part int, bits binary"

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, part = np.zeros(1 << FILTER_BITS_LOG2, bool), TaskContext.get().partitionId() % FILTER_PARTS
        for batch in batches:
            bits[filter_slots(longs(batch.column(0)))] = True
        packed = np.packbits(bits, bitorder="little").reshape(FILTER_SLICES, width)
        used = [i for i in range(FILTER_SLICES) if packed[i].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([part] * len(used), pa.int32()), pa.array([packed[i].tobytes() for i in used], pa.binary())],
            ["slice", "part", "bits"])

    def join(group: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(width, np.uint8)
        for raw in group["bits"]:
            bits |= np.frombuffer(raw, np.uint8)
        return pd.DataFrame({"slice": group["slice"][:1], "part": [0], "bits": [bits.tobytes()]})

    out = np.zeros((FILTER_SLICES, width), np.uint8)
    slices = keys.mapInArrow(mark, schema).groupBy("slice", "part").applyInPandas(join, schema) \
        .groupBy("slice").applyInPandas(join, schema)
    for row in slices.collect():
        out[row["slice"]] = np.frombuffer(row["bits"], np.uint8)
    return out.reshape(-1)


def longs(column: pa.Array) -> np.ndarray:
    """A long column without nulls as unsigned 64-bit numbers."""
    return column.to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64)
