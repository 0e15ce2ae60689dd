"""A uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Rows are dealt to parts by a hash.  How many rows each part sends to each shard is drawn from the multivariate
hypergeometric distribution, part by part, so that every shard gets exactly its size and every assignment of rows
is equally likely.  Within its part a row gets a random rank, which the matrix turns into a shard; within its shard rows
are ordered by a second random number, which gives the slot.

The law is ``rows``: shard sizes are at most one apart.  Only built-in functions touch rows; the driver sees
one count per part (``PARTS``) and per piece of a shard, numbers that do not grow with the input, and draws the matrix.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import stored

SHARDS, SEED = 24, 20240229
#: Parts that rows are dealt from, and pieces of a shard that are ordered on their own.
PARTS, PIECES = 1024, 64


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` from ``good + bad`` are good; for any size, by inversion around the mode."""
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    total = good + bad
    mode = min(max((draws + 1) * (good + 1) // (total + 2), low), high)
    spread = math.sqrt(draws * (good / total) * (bad / total) * max(total - draws, 1) / max(total - 1, 1))
    low, high = max(low, mode - int(14 * spread) - 40), min(high, mode + int(14 * spread) + 40)
    k = np.arange(low, high, dtype=np.float64)  # the tails beyond have less than 1e-40
    step = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    weight = np.concatenate([[0.0], np.cumsum(step)])
    mass = np.cumsum(np.exp(weight - weight.max()))
    return low + int(np.searchsorted(mass, rng.random() * mass[-1], side="right"))


def communication_matrix(rows: list[int], columns: list[int], seed: int = SEED) -> list[list[int]]:
    """Counts with these row and column sums, as a uniform shuffle would give them."""
    rng, left, matrix = np.random.default_rng(seed), list(columns), []
    for n in rows:
        rest, line = sum(left), []
        for j, room in enumerate(left):
            got = hypergeometric(rng, room, rest - room, n) if j < len(left) - 1 else n
            line.append(got)
            n, rest = n - got, rest - room
        left = [a - b for a, b in zip(left, line)]
        matrix.append(line)
    return matrix


def sizes(total: int, shards: int) -> list[int]:
    """Shard sizes, at most one apart."""
    return [total // shards + (i < total % shards) for i in range(shards)]


def _literal(values: list, kind: str):
    return F.from_json(F.lit(json.dumps(values)), kind)


def shuffle(rows: DataFrame, keys: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``rows`` plus ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard), replacing columns of those names.

    ``keys`` should tell rows apart; rows alike in all of them may swap places, which no one can see if they
    are alike in all columns.  Nulls are values like others.  An empty table gives no rows; with fewer rows than
    shards some shards stay empty.  Rows and a seed fix the result, not how the rows are partitioned.
    """
    rows = rows.drop("shard", "slot")
    draw = lambda salt: F.xxhash64(F.lit(seed), F.lit(salt), *keys)
    dealt = stored(rows.withColumns({"__part": F.pmod(draw(1), F.lit(PARTS)).cast("int"), "__first": draw(2), "__second": draw(3)}), "dealt")
    by_part = {r["__part"]: r["n"] for r in dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = [by_part.get(i, 0) for i in range(PARTS)]
    matrix = communication_matrix(counts, sizes(sum(counts), shards), seed)
    ends = np.cumsum(np.array(matrix, dtype=np.int64).reshape(PARTS, shards), axis=1).tolist()

    rank = F.row_number().over(W.partitionBy("__part").orderBy("__first", *keys)) - 1
    ends_of_part = F.get(_literal(ends, "array<array<bigint>>"), F.col("__part"))
    sent = dealt.withColumn("__rank", rank).withColumn(
        "shard", F.aggregate(ends_of_part, F.lit(0), lambda n, end: n + F.when(end <= F.col("__rank"), 1).otherwise(0)).cast("int"))
    # A piece holds one range of the second random number, so pieces in order are the shard in order.
    sent = stored(sent.withColumn("__piece", F.expr(f"cast(shiftrightunsigned(__second, {64 - (PIECES.bit_length() - 1)}) AS int)"))
                  .drop("__part", "__first", "__rank"), "sent")
    held = {(r["shard"], r["__piece"]): r["n"] for r in sent.groupBy("shard", "__piece").agg(F.count(F.lit(1)).alias("n")).collect()}
    before = [[sum(held.get((s, q), 0) for q in range(p)) for p in range(PIECES)] for s in range(shards)]
    base = F.get(F.get(_literal(before, "array<array<bigint>>"), F.col("shard")), F.col("__piece"))
    # The random number is ordered without its sign, as the pieces are.
    place = F.row_number().over(W.partitionBy("shard", "__piece").orderBy("__second", *keys)) - 1
    return sent.withColumn("slot", (base + place).cast("long")).drop("__second", "__piece")


def report(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row.

    ``size`` is the text's bytes plus 8; a null text has no bytes and the checksum of no bytes, 0.
    """
    raw = F.coalesce(F.col("text").cast("string"), F.lit(""))
    light = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(raw) + 8).cast("long").alias("size"),
                        F.crc32(raw.cast("binary")).alias("text_crc32"), F.xxhash64(raw).alias("__text"))
    return shuffle(light, ["doc_id", "size", "text_crc32", "__text"], shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
