"""Line deduplication by overlapping windows of three lines.

Lines are what ``\\n`` separates.  Every three consecutive lines of a text make a window, identified by a 128-bit hash;
windows of blank lines only do not count.  The first occurrence of a window, by (doc_id, text, position), stays;
the lines of later occurrences are removed, where overlapping occurrences merge into one set of positions.
Texts of fewer than three lines have no window and stay as they are.

Only built-in functions.  A hot window is cut to one row per task before the shuffle; joining its occurrences to that
one row does not multiply, and adaptive execution splits the hot join partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import text_key

SIZE = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _windows(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, key, at, high, low): hash and 0-based first line of every window."""
    lines = docs.select("doc_id", "key", _lines(F.col("text")).alias("lines")).where(F.size("lines") >= size)
    line = [F.element_at("lines", (F.col("at") + 1 + j).cast("int")) for j in range(size)]
    blank = F.trim(F.concat(*line), F.lit(" \t\r\x0b\x0c")) == ""
    return lines.withColumn("at", F.explode(F.sequence(F.lit(0), F.size("lines") - size))) \
        .where(~blank) \
        .select("doc_id", "key", "at", F.xxhash64(*line).alias("high"), F.xxhash64(F.lit(size), *line[::-1]).alias("low"))


def covered(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``doc_id, key, removed``: the sorted positions of lines to remove, for texts that have any.

    ``docs`` has ``doc_id``, ``key`` (hash of the text) and ``text``.
    """
    found = _windows(docs, size)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key", "at")
    repeated = found.groupBy("high", "low").agg(F.min(place).alias("first"), F.max(place).alias("final")) \
        .where(F.col("first") != F.col("final")).select("high", "low", "first")
    later = found.join(repeated, ["high", "low"]).where(place != F.col("first"))
    return later.groupBy("doc_id", "key").agg(F.collect_set("at").alias("starts")).select(
        "doc_id", "key",
        F.array_sort(F.array_distinct(F.flatten(F.transform(
            "starts", lambda s: F.sequence(s, s + F.lit(size - 1)))))).alias("removed"))


def _without(lines: Column, removed: Column) -> Column:
    """The lines but for those at the sorted positions, as the slices between them: each line is read once."""
    def slices(x: Column) -> Column:
        before = lambda j: F.coalesce(F.get(x["removed"], j - 1), F.lit(-1))
        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(x["removed"])), lambda j: F.slice(
            x["lines"], before(j) + 2, F.coalesce(F.get(x["removed"], j), F.size(x["lines"])) - before(j) - 1)))

    # One struct in an array: the text is split once and not for each slice.
    return F.transform(F.array(F.struct(lines.alias("lines"), removed.alias("removed"))), slices)[0]


def dedup(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``docs`` with later occurrences of repeated windows taken out of ``text``, plus ``n_lines`` and ``removed``.

    All columns are kept; ``n_lines`` (long) and ``removed`` (array<int>, 0-based) replace columns of those names.
    Null texts have no lines (0) and stay null; an empty text is one empty line.  Rows that are alike in doc_id and
    text are one place: they lose the same lines, and keep their first occurrences alike.  A null doc_id sorts last.
    """
    keyed = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__key": text_key(F.col("text").cast("string"))})
    cover = covered(keyed.select(F.col("__id").alias("doc_id"), F.col("__key").alias("key"), F.col("text").cast("string").alias("text")), size) \
        .select(F.col("doc_id").alias("__d"), F.col("key").alias("__k"), F.col("removed").alias("__removed"))
    joined = keyed.join(cover, F.col("__id").eqNullSafe(F.col("__d")) & (F.col("__key") == F.col("__k")), "left")
    kept = F.array_join(_without(_lines(F.col("text")), F.col("__removed")), "\n")
    n_lines = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(_lines(F.col("text")))).cast("long")
    return joined.withColumns({
        "n_lines": n_lines, "removed": F.coalesce("__removed", F.array().cast("array<int>")),
        "text": F.when(F.col("__removed").isNull(), F.col("text")).otherwise(kept)}) \
        .drop("__id", "__key", "__d", "__k", "__removed")
