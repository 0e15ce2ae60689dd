"""Operators on tables with a business key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """A merge source holds the same key more than once."""


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """Keep one row per key, the first in ``newest_first`` order.

    Filtering ``row_number() = 1`` lets Spark drop all but one row per key inside each map
    task before the shuffle, so a key holding a third of the table still sends at most one
    row per task.  Give a total order if reruns must pick the same row.
    """
    ranked = Window.partitionBy(*keys).orderBy(*newest_first)
    return (
        df.withColumn("_position", F.row_number().over(ranked))
        .where(F.col("_position") == 1)
        .drop("_position")
    )


def top_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column], n: int,
                  rank_name: str = "rank") -> DataFrame:
    """The first ``n`` rows of every group with their position."""
    ranked = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank_name, F.row_number().over(ranked)).where(F.col(rank_name) <= n)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys present more than once.  A key with a NULL part matches nothing and is not counted."""
    return (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    clash = duplicate_keys(df, keys).first()
    if clash is not None:
        raise DuplicateKeyError(f"more than one source row for {clash.asDict()}")


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a whole key, rows with a NULL part).

    The latter match nothing, yet an outer join would send them all to one task, and a full join
    cannot be split by adaptive execution; so they go around it.
    """
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return df.where(~null), df.where(null)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           newer_by: str | None = None, check: bool = True) -> DataFrame:
    """Whole-row upsert: a matched key takes every source column, an unmatched one is added.

    The default replaces unconditionally, so replaying an old feed brings old values back;
    ``newer_by`` keeps the target row where it is later in that column.
    """
    if check:
        require_unique(source, keys)
    source = source.select(*target.columns)
    target, loose_old = split_null_keys(target, keys)
    source, loose_new = split_null_keys(source, keys)
    loose = loose_old.unionByName(loose_new)
    if newer_by is not None:
        stale = source.select(*keys, F.col(newer_by).alias("_offered"))
        kept = (
            target.join(stale, list(keys), "left")
            .where(F.col("_offered").isNull() | (F.col(newer_by) > F.col("_offered")))
            .select(*target.columns)
        )
        added = source.join(kept.select(*keys), list(keys), "left_anti")
    else:
        kept, added = target.join(source.select(*keys), list(keys), "left_anti"), source
    return kept.unionByName(added).unionByName(loose)


def upsert_columns(target: DataFrame, source: DataFrame, keys: Sequence[str],
                   update: Sequence[str], check: bool = True) -> DataFrame:
    """Partial upsert: a matched row changes only in ``update`` (NULL overwrites too)."""
    if check:
        require_unique(source, keys)
    whole_old, loose_old = split_null_keys(target, keys)
    whole_new, loose_new = split_null_keys(source.select(*target.columns), keys)
    old = whole_old.select(*[F.col(c).alias(f"_t_{c}") for c in target.columns], F.lit(True).alias("_in_target"))
    new = whole_new.withColumn("_in_source", F.lit(True))
    on = [F.col(f"_t_{k}") == F.col(k) for k in keys]
    both = old.join(new, on, "full")

    def pick(name: str) -> Column:
        take_source = F.col("_in_target").isNull()
        if name in update:
            take_source = take_source | F.col("_in_source").isNotNull()
        return F.when(take_source, F.col(name)).otherwise(F.col(f"_t_{name}")).alias(name)

    return both.select(*[pick(c) for c in target.columns]).unionByName(loose_old).unionByName(loose_new)


def content_hash(columns: Sequence[str]) -> Column:
    """``xxhash64`` over values and NULL flags.

    The plain hash skips NULLs, so ('a', NULL) and (NULL, 'a') would look unchanged.
    """
    parts: list[Column] = []
    for name in columns:
        parts += [F.col(name), F.col(name).isNull()]
    return F.xxhash64(*parts)


def definition_changes(known: DataFrame, published: DataFrame, keys: Sequence[str],
                       content: Sequence[str]) -> DataFrame:
    """Rows of ``published`` that are new or differ from ``known``; identical ones are a no-op."""
    before = known.select(*keys, content_hash(content).alias("_before"))
    after = published.withColumn("_after", content_hash(content))
    return (
        after.join(before, list(keys), "left")
        .withColumn("change", F.when(F.col("_before").isNull(), "NEW")
                    .when(F.col("_before") != F.col("_after"), "CHANGED"))
        .where(F.col("change").isNotNull())
        .drop("_before", "_after")
    )
