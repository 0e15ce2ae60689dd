"""Slowly changing dimensions of type 2, kept as half-open intervals [valid_from, valid_to)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.keyed import content_hash, latest_per_key, require_unique, split_null_keys

BEGINNING = date(1900, 1, 1)
OPEN_END = date(9999, 12, 31)


@dataclass(frozen=True)
class Dimension:
    """``tracked`` attributes open a new version when they change; the others do not."""

    key: str
    surrogate: str
    attributes: tuple[str, ...]
    tracked: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return [self.surrogate, self.key, *self.attributes,
                "row_hash", "valid_from", "valid_to", "is_current"]


def surrogate_key(key: str, valid_from: str = "valid_from") -> Column:
    """Hash of key and start date, types fixed because the hash depends on them."""
    return F.xxhash64(F.col(key).cast("bigint"), F.col(valid_from).cast("date"))


def _as_versions(df: DataFrame, dim: Dimension) -> DataFrame:
    return df.withColumn(dim.surrogate, surrogate_key(dim.key)).select(*dim.columns)


def onboard(current: DataFrame, dim: Dimension, valid_from: date = BEGINNING) -> DataFrame:
    """First load: every key becomes one open version that covers all earlier facts."""
    return _as_versions(
        current.withColumn("row_hash", content_hash(dim.tracked))
        .withColumn("valid_from", F.lit(valid_from))
        .withColumn("valid_to", F.lit(OPEN_END))
        .withColumn("is_current", F.lit(True)),
        dim,
    )


def merge_day(history: DataFrame, incoming: DataFrame, dim: Dimension, run_date: date) -> DataFrame:
    """The whole dimension after one day's feed, which must not repeat a key."""
    require_unique(incoming, [dim.key])
    closed_before = history.where(~F.col("is_current")).select(*dim.columns)
    return closed_before.unionByName(advance(history.where("is_current"), incoming, dim, run_date))


def advance(current: DataFrame, incoming: DataFrame, dim: Dimension, run_date: date) -> DataFrame:
    """Open rows and the rows closed today, from the open rows and one day's feed, in one join.

    A changed key closes at ``run_date`` and reopens from it; an open version that starts on ``run_date`` is replaced in
    place, so a second change of one day leaves no empty interval or repeated surrogate key.  A changed key whose open
    version starts later stops the run: the feed is older than what is known, and ``replay`` is the way to place it.
    A change of untracked attributes alone moves nothing.  Keys missing from the feed stay open.  The feed must not
    repeat a key (``merge_day`` checks it).
    """
    body = [dim.key, *dim.attributes, "row_hash"]
    dated = [*body, "valid_from", "valid_to", "is_current"]
    # Rows without a key match nothing: open ones stay, fed ones open, for the key check to report.
    current, loose_open = split_null_keys(current, [dim.key])
    incoming, loose_fed = split_null_keys(incoming, [dim.key])
    now = current.select(F.struct(*dated).alias("was"), F.col(dim.key).alias("_was_key"))
    fed = incoming.withColumn("row_hash", content_hash(dim.tracked)).select(
        F.struct(*body).alias("fed"), F.col(dim.key).alias("_fed_key"))
    both = now.join(fed, F.col("_was_key") == F.col("_fed_key"), "full")

    def opened(start: Column) -> Column:
        return F.struct(
            *[F.col(f"fed.{c}").alias(c) for c in body], start.alias("valid_from"),
            F.lit(OPEN_END).alias("valid_to"), F.lit(True).alias("is_current"))

    today = F.lit(run_date)
    closed = F.struct(
        *[F.col(f"was.{c}").alias(c) for c in body], F.col("was.valid_from").alias("valid_from"),
        today.alias("valid_to"), F.lit(False).alias("is_current"))
    untouched = F.col("_fed_key").isNull() | (F.col("was.row_hash") == F.col("fed.row_hash"))
    after = (
        F.when(F.col("_was_key").isNull(), F.array(opened(today)))
        .when(untouched, F.array(F.col("was")))
        .when(F.col("was.valid_from") > today, F.raise_error(F.concat(
            F.lit(f"{dim.key} "), F.col("_was_key").cast("string"), F.lit(f" changed after {run_date}, the feed's day"))))
        .when(F.col("was.valid_from") == today, F.array(opened(F.col("was.valid_from"))))
        .otherwise(F.array(closed, opened(today)))
    )
    moved = _as_versions(both.select(F.explode(after).alias("v")).select("v.*"), dim)
    return moved.unionByName(loose_open.select(*dim.columns)).unionByName(onboard(loose_fed, dim, run_date))


def replay(log: DataFrame, dim: Dimension, effective: str, newest_first: Sequence[Column],
           first_slice: date | None = None, deleted: str | None = None) -> DataFrame:
    """Rebuild the dimension from a dated log.

    The log is first cut to one row per key and day, map-side; after that a key has no more
    rows than the log has days, however many log rows it holds, and the ordered windows stay
    small.  Keys present on the first day of the log start at ``BEGINNING``, as after onboarding.

    ``deleted`` names a flag of log rows that say their key is gone: it closes the version before it and opens none, so a key
    that comes back has a gap.  A key that never existed before such a row has no version from it.
    """
    if not isinstance(log.schema[effective].dataType, T.DateType):
        raise TypeError(f"{effective} must be a date")
    if first_slice is None:
        first_slice = log.agg(F.min(effective)).first()[0]
    daily = latest_per_key(log, [dim.key, effective], newest_first).withColumn(
        "row_hash", content_hash(dim.tracked))
    gone = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
    daily = daily.withColumn("_state", F.when(~gone, F.col("row_hash")))
    by_day = Window.partitionBy(dim.key).orderBy(effective)
    # A key begins without state, as a deleted one has none.
    starts = (
        daily.withColumn("_previous", F.lag("_state").over(by_day))
        .where(~F.col("_previous").eqNullSafe(F.col("_state")))
        .withColumn("_next", F.lead(effective).over(by_day))
        .where(F.col("_state").isNotNull())
    )
    return _as_versions(
        starts.withColumn("valid_from", F.when(F.col(effective) <= F.lit(first_slice), F.lit(BEGINNING))
                          .otherwise(F.col(effective)))
        .withColumn("valid_to", F.coalesce("_next", F.lit(OPEN_END)))
        .withColumn("is_current", F.col("_next").isNull()),
        dim,
    )


def splice(history: DataFrame, log: DataFrame, late: DataFrame, dim: Dimension, effective: str,
           newest_first: Sequence[Column], first_slice: date) -> DataFrame:
    """The dimension after rows that arrived late, ``late``, equal to a replay of ``log`` and ``late`` together.

    A late row may split or shorten a version, or show that one began again after it, which only the log tells: so the
    late rows' keys are replayed from the log, and no other key is read beyond its versions.  ``first_slice`` is the
    day of onboarding, which a late row must not precede.
    """
    before = late.where(F.col(effective) < F.lit(first_slice)).first()
    if before is not None:
        raise ValueError(f"{dim.key} {before[dim.key]} is dated before {first_slice}, the first day of the history")
    keys = late.select(dim.key).distinct()
    of_keys = log.select(*late.columns).join(keys, dim.key, "left_semi").unionByName(late)
    again = replay(of_keys, dim, effective, newest_first, first_slice)
    return history.select(*dim.columns).join(keys, dim.key, "left_anti").select(*dim.columns).unionByName(again)


def changed_spans(before: DataFrame, after: DataFrame, dim: Dimension, values: Sequence[str] = ()) -> DataFrame:
    """``key, from, to``: for each key whose versions differ, the days that hold all differences.

    Versions differ by surrogate and interval, and by ``values``: a row of a day that already began a version may replace
    what it says and leave its interval.
    """
    body = list(dict.fromkeys([dim.key, dim.surrogate, "valid_from", "valid_to", *values]))
    sides = before.select(*body, F.lit(1).alias("_side")).unionByName(after.select(*body, F.lit(-1).alias("_side")))
    differ = sides.groupBy(*body).agg(F.sum("_side").alias("_only")).where("_only != 0")
    return differ.groupBy(dim.key).agg(F.min("valid_from").alias("_from"), F.max("valid_to").alias("_to"))


def rekey(facts: DataFrame, before: DataFrame, after: DataFrame, dim: Dimension, fact_key: str, fact_date: str,
          take: Sequence[str]) -> DataFrame:
    """``facts``, which carry ``take`` from the versions ``before``, with those of ``after``.

    Only facts of changed keys, dated in their changed days, are looked up; all others go through as they are.
    """
    spans = changed_spans(before, after, dim, take).select(F.col(dim.key).alias(fact_key), "_from", "_to")
    inside = (F.col(fact_date) >= F.col("_from")) & (F.col(fact_date) < F.col("_to"))
    marked = facts.join(spans, fact_key, "left").withColumn("_hit", F.coalesce(inside, F.lit(False))).drop("_from", "_to")
    hit = marked.where("_hit").drop("_hit", *take)
    return marked.where("NOT _hit").select(*facts.columns).unionByName(
        as_of_join(hit, after, fact_key, fact_date, dim.key, take).select(*facts.columns))


def as_of_join(facts: DataFrame, history: DataFrame, fact_key: str, fact_date: str, key: str,
               take: Sequence[str]) -> DataFrame:
    """Left join every fact to the version of its key valid on its date; a miss gives NULLs.

    The distinct (key, date) pairs are resolved by one ordered pass and joined back on both columns, whatever the
    number of versions: comparing each fact of a busy key with its whole history would multiply, and the pairs also
    spread a busy key over its dates.  ``facts`` is read twice; hand in a stored frame, or resolve at the coarsest
    table that has key and date.  Intervals of one key must not overlap (``quality.dimension_checks`` tells).
    """
    return facts.join(
        resolve_pairs(facts, history, fact_key, fact_date, key, take), [fact_key, fact_date], "left"
    ).select(*facts.columns, *take)


def one_version_each(history: DataFrame, key: str) -> bool:
    """Whether no key has several versions; reads the keys of the dimension only."""
    return history.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def only_version_join(facts: DataFrame, history: DataFrame, fact_key: str, fact_date: str, key: str,
                      take: Sequence[str]) -> DataFrame:
    """``as_of_join`` for a history with ``one_version_each``: a fact meets at most one version by its key, so facts are read
    once and no pairs are made."""
    only = history.select(F.col(key).alias("_key"), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"),
                          F.struct(*take).alias("_taken"))
    valid = (F.col(fact_key) == F.col("_key")) & (F.col(fact_date) >= F.col("_from")) & (F.col(fact_date) < F.col("_to"))
    return facts.join(only, valid, "left").select(*facts.columns, *[F.col(f"_taken.{c}").alias(c) for c in take])


def resolve_pairs(facts: DataFrame, history: DataFrame, fact_key: str, fact_date: str, key: str,
                  take: Sequence[str]) -> DataFrame:
    """One row per (key, date) found in ``facts`` that a version covers.

    Both inputs hold at most one row per key and day, so each key's ordered run is bounded by
    the calendar and not by the facts; a date column that is no date is refused.
    """
    if not isinstance(facts.schema[fact_date].dataType, T.DateType):
        raise TypeError(f"{fact_date} must be a date")
    asked = facts.select(fact_key, fact_date).dropna().distinct().select(
        fact_key, fact_date, F.lit(None).cast(history.select(F.struct("valid_to", *take)).schema[0].dataType)
        .alias("_version"), F.lit(1).alias("_ask"))
    offered = history.select(F.col(key).alias(fact_key), F.col("valid_from").alias(fact_date),
                             F.struct("valid_to", *take).alias("_version"), F.lit(0).alias("_ask"))
    seen = Window.partitionBy(fact_key).orderBy(fact_date, "_ask")
    return (
        offered.unionByName(asked)
        .withColumn("_found", F.last("_version", ignorenulls=True).over(seen))
        .where((F.col("_ask") == 1) & (F.col(fact_date) < F.col("_found.valid_to")))
        .select(fact_key, fact_date, *[F.col(f"_found.{c}").alias(c) for c in take])
    )


def current_join(facts: DataFrame, history: DataFrame, fact_key: str, key: str,
                 take: Sequence[str]) -> DataFrame:
    """Left join to the version that is current now, whatever the fact's date."""
    now = history.where("is_current").select(F.col(key).alias(fact_key), *take)
    return facts.join(now, fact_key, "left").select(*facts.columns, *take)
