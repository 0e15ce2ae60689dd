"""Harmonic packing of token sequences into rows of a fixed capacity.

A piece of length L belongs to class k = capacity // L, and a row of class k takes exactly k pieces, so rows are
filled without looking at lengths again.  Documents are cut into full rows; the rest is cut at most ``CUTS`` times
at a reciprocal of the capacity (capacity // k), which leaves a short tail.  Workers fill the rows of their own
class queues; what does not fill a row goes on: first to one queue per class, then (fewer than k pieces
of each class, a constant whatever the input) into the fullest row with room.

A piece's worker is a hash of its document, place and stored row number, and this orders a worker's queue, so a repeated task gives
the same rows, and rows that are repeated in the input are spread like others.  Row r of worker w is number r * workers + w of its class;
classes follow one another by the longest queue of each.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import rows_of, stored

CAPACITY, END_ID, CUTS = 2048, 1, 2
#: Pieces in a worker's queue of class k: many times k, so that little is left over.
QUEUE, TIMES_K = 4096, 256
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def encoder(ranks_path: str | None = None, vocabulary_path: str | None = None) -> Callable[[str], list[int]]:
    """Text to token ids, as `tokenizers` gives them with ``byte_bpe_50k.json`` in its default setting.

    The rank file of the same vocabulary gives them five times as fast; a text is cut at the tokens that the vocabulary file adds
    (``<|endoftext|>``), which have ids of their own (the tests compare both).
    """
    import public_tokenizers
    import tiktoken

    path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encode = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    with open(vocabulary_path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        added = {token["content"]: token["id"] for token in json.load(file)["added_tokens"]}
    at_added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None

    def ids(text: str) -> list[int]:
        if at_added is None or not any(token in text for token in added):
            return encode(text)
        return [i for part in at_added.split(text) for i in ([added[part]] if part in added else encode(part))]

    return ids


def cut(n: int, capacity: int = CAPACITY, cuts: int = CUTS) -> list[int]:
    """Lengths of a document's pieces, in order."""
    lengths, rest = [capacity] * (n // capacity), n % capacity
    for _ in range(cuts):
        if not rest:
            break
        k = -(-capacity // rest)
        while capacity // k > rest:
            k += 1
        lengths.append(capacity // k)
        rest -= capacity // k
    return lengths + [rest] if rest else lengths


def pieces(docs: DataFrame, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Tokenise each text, end it with ``END_ID`` and cut it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in rows_of([batch]):
                ids = np.asarray([*encode(text or ""), END_ID], "<u4")
                start = 0
                for length in cut(ids.size, capacity):
                    own = ids[start:start + length]
                    row = (doc_id, start, length, zlib.crc32(own.tobytes()), ids.size)
                    out.append((*row, own.astype(np.int32)) if with_ids else row)
                    start += length
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            columns = [pa.array([r[i] for r in out], pa.int64()) for i in range(5)]
            if with_ids:
                names.append("ids")
                columns.append(pa.array([r[5] for r in out], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, PIECE + (", ids array<int>" if with_ids else ""))


ORDER = ["doc_id", "start", "ids_crc32", "row"]


def _queue(df: DataFrame, keys: list[str], number: Column) -> DataFrame:
    """Place pieces in the queues named by ``keys``: ``number`` of the queue's row, and the offset there.

    ``sequence_id`` stays null where a row would not be full.
    """
    placed = df.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*ORDER)).cast("long") - 1) \
        .withColumn("size", F.count(F.lit(1)).over(W.partitionBy(*keys)))
    full = F.col("rank") < F.col("size") - F.col("size") % F.col("class")
    placed = placed.withColumn("line", F.floor(F.col("rank") / F.col("class")).cast("long"))
    before = W.partitionBy(*keys, "line").orderBy("rank").rowsBetween(W.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0).cast("long"))) \
        .withColumn("sequence_id", F.when(full, number)).drop("rank", "size", "line")


def _last(capacity: int, columns: list[str], first_number: int):
    """Fewer than k pieces of each class: longest first into the fullest row with room."""

    def fill(left: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values(["length", *ORDER], ascending=[False, True, True, True, True])
        used: list[int] = []
        number, offset = [], []
        for length in left["length"]:
            fits = [i for i, u in enumerate(used) if u + length <= capacity]
            at = max(fits, key=lambda i: used[i]) if fits else len(used)
            if not fits:
                used.append(0)
            number.append(first_number + at)
            offset.append(used[at])
            used[at] += int(length)
        left["sequence_id"], left["offset"] = number, offset
        return left[columns]

    return fill


def pack(docs: DataFrame, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: its document, place there, checksum of its ids, and its row and offset.

    Needs ``doc_id`` and ``text``; other columns are ignored.  A null or empty text is the end id alone; a null
    ``doc_id`` is packed like any other; repeated rows are packed each.  An empty table gives no rows.
    ``with_ids`` adds the ids themselves.
    """
    cut_up = pieces(docs, capacity, with_ids)
    return _packed(stored(cut_up.withColumn("row", F.monotonically_increasing_id()), "pieces"), capacity)


def _packed(cut_up: DataFrame, capacity: int) -> DataFrame:
    """Stored pieces, each with a ``row`` of its own, in rows."""
    of_class = lambda numbers: F.element_at(F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair]), F.col("class"))
    cut_up = cut_up.withColumn("class", F.floor(F.lit(capacity) / F.col("length")).cast("long"))
    names = [*(c for c in cut_up.columns if c not in ("class", "row")), "sequence_id", "offset"]
    # One number per class, of which there are at most 2 * sqrt(capacity).
    counts = {r["class"]: r["n"] for r in cut_up.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return cut_up.select(*names[:-2], F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    workers = {k: -(-n // max(QUEUE, TIMES_K * k)) for k, n in counts.items()}
    dealt = cut_up.withColumn("worker", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "row"), of_class(workers)).cast("long"))
    longest = {r["class"]: r["n"] // r["class"] for r in dealt.groupBy("class", "worker").agg(F.count(F.lit(1)).alias("n"))
               .groupBy("class").agg(F.max("n").alias("n")).collect()}
    begin, second_begin, number = {}, {}, 0
    for k in sorted(counts):
        begin[k], number = number, number + longest[k] * workers[k]
    for k in sorted(counts):  # fewer than k pieces of each worker are left, so fewer rows than workers
        second_begin[k], number = number, number + workers[k]
    first = stored(_queue(dealt, ["worker", "class"], of_class(begin) + F.col("line") * of_class(workers) + F.col("worker")), "packed")
    second = _queue(first.where(F.col("sequence_id").isNull()).drop("sequence_id", "offset"), ["class"], of_class(second_begin) + F.col("line"))
    last = second.where(F.col("sequence_id").isNull())
    third = last.groupBy(F.pmod("length", F.lit(1)).alias("all")).applyInPandas(_last(capacity, names, number), last.select(*names).schema)
    done = [d.where(F.col("sequence_id").isNotNull()).select(*names) for d in (first, second)]
    return done[0].unionByName(done[1]).unionByName(third)
