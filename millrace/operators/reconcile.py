"""Do two copies of a table hold the same values, and if not, where?

A row's hash covers its key and values.  Count, sum and exclusive-or of the hashes do not depend on order, so they can be
taken where rows are written and again where they are read.  They are compared per slice first, then in the slices that
differ per range of the key's hash, then row by row in the ranges that differ; nothing else is read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.keyed import content_hash

#: Ranges of the key's hash in a slice.
RANGES_LOG2 = 12
CHECKSUM = ("rows", "hash_sum", "hash_xor")


def _key_range(keys: Sequence[str]) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - RANGES_LOG2)


def checksums(df: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, sum and exclusive-or of the row hashes per group of ``by``; equal for equal bags of rows.

    One partial aggregate per task: a hot slice sends one row per task.
    """
    hashed = df.withColumn("_hash", content_hash(columns or df.columns))
    return hashed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("_hash").cast("decimal(20,0)")).alias("hash_sum"), F.bit_xor("_hash").alias("hash_xor"))


def differing(sent: DataFrame, received: DataFrame, by: Sequence[str]) -> DataFrame:
    """Groups whose checksums differ, or that one side lacks."""
    sides = [c.select(*by, F.struct(*CHECKSUM).alias(name)) for c, name in ((sent, "sent"), (received, "received"))]
    # Groups meet by union, so that a null group meets its other side.
    both = sides[0].withColumn("received", F.lit(None).cast(sides[1].schema["received"].dataType)).unionByName(
        sides[1].withColumn("sent", F.lit(None).cast(sides[0].schema["sent"].dataType)))
    met = both.groupBy(*by).agg(F.first("sent", ignorenulls=True).alias("sent"), F.first("received", ignorenulls=True).alias("received"))
    return met.where(~F.col("sent").eqNullSafe(F.col("received"))).select(*by)


def differences(sent: DataFrame, received: DataFrame, keys: Sequence[str], slice_by: str,
                sent_sums: DataFrame | None = None) -> DataFrame:
    """``keys, columns``: rows that differ, with the columns at fault; ``columns`` is null for a key that only one side has.

    ``sent_sums`` are the sender's checksums by slice where they were kept; otherwise they are taken here.  Keys are unique on each
    side (``keyed.require_unique``).  A row whose slice changed differs in that column.
    """
    columns = sent.columns
    received = received.select(*columns)
    slices = differing(sent_sums if sent_sums is not None else checksums(sent, [slice_by]), checksums(received, [slice_by], columns), [slice_by])
    # Slices are a bounded set: one value per slice, as a table's folders are.
    values = [r[0] for r in slices.collect()]
    inside = F.col(slice_by).isin([v for v in values if v is not None])
    inside = F.coalesce(inside, F.lit(False)) | (F.col(slice_by).isNull() if None in values else F.lit(False))
    sides = [df.where(inside).withColumn("_range", _key_range(keys)) for df in (sent, received)]
    ranges = differing(*[checksums(df, ["_range"], columns) for df in sides], ["_range"])
    values_of = [c for c in columns if c not in keys]
    left, right = (df.join(ranges, "_range", "left_semi").select(*keys, F.struct(*values_of).alias(name)) for df, name in zip(sides, ("_sent", "_received")))
    both = left.join(right, list(keys), "full")
    wrong = F.array_compact(F.array(*[
        F.when(~F.col(f"_sent.{c}").eqNullSafe(F.col(f"_received.{c}")), F.lit(c)) for c in values_of]))
    one_sided = F.col("_sent").isNull() | F.col("_received").isNull()
    return both.select(*keys, F.when(~one_sided, F.array_join(wrong, ",")).alias("columns")).where("columns IS NULL OR columns <> ''")
