"""How often shingles occur over the corpus, in a fixed number of counters.

Each task counts its own shingles by hash and sends only counters, so hot shingles cost nothing more; the counters
are summed by slice.  A counter bounds the frequency of its shingles from above.  Orders by rarity need a total
order that is the same everywhere, not exact counts, so results do not depend on collisions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from millrace.llm.common import WordHashes, rows_of, windows

COUNTERS, SLICES, PARTS = 1 << 20, 64, 256


def sizes_in_one(hashes: np.ndarray, counters: int = COUNTERS) -> np.ndarray:
    """The counter of each hash."""
    return (hashes & np.uint64(counters - 1)).astype(np.int64)


def shingle_counts(docs: DataFrame, words_of: Callable[[str | None], list[bytes]], shingle: int,
                   counters: int = COUNTERS, text: str = "text") -> np.ndarray:
    """Counters over the distinct shingles of each text (int64, ``counters`` of them: 8 MB, whatever the input)."""
    width = counters // SLICES
    schema = "slice int, part int, counts binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, total = WordHashes(), np.zeros(counters, np.int64)
        part = TaskContext.get().partitionId() % PARTS
        for (value,) in rows_of(batches):
            words = words_of(value)
            if words:
                grams = np.unique(windows(hashed.of(words), min(shingle, len(words))))
                np.add.at(total, sizes_in_one(grams, counters), 1)
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(SLICES), pa.int32()), pa.array([part] * SLICES, pa.int32()),
                 pa.array([s.astype("<i4" if s.max() < 1 << 31 else "<i8").tobytes() for s in total.reshape(SLICES, width)], pa.binary())],
                ["slice", "part", "counts"])

    def add(part: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width, np.int64)
        for raw in part["counts"]:
            total += np.frombuffer(raw, "<i4" if len(raw) == 4 * width else "<i8")
        return pd.DataFrame({"slice": part["slice"][:1], "part": [0], "counts": [total.tobytes()]})

    # In two steps, so that no task gets a slice from every task.
    sums = docs.select(text).mapInArrow(count, schema).groupBy("slice", "part").applyInPandas(add, schema) \
        .groupBy("slice").applyInPandas(add, schema).collect()
    out = np.zeros((SLICES, width), np.int64)
    for row in sums:
        out[row["slice"]] = np.frombuffer(row["counts"], np.int64)
    return out.reshape(-1)
