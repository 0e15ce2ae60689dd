"""Benchmark decontamination: which words of a document lie inside a window of a benchmark item.

A window is ``window`` consecutive item words, or the whole item if it is shorter.  A document holds it whole or not
at all (containment 1), so by the prefix filter one of its shingles is enough to find it: the rarest over the corpus.
Documents are searched for these tokens only; a match fixes where the window would have to lie, which
is checked for length and position, and then word by word.

Rarity comes from counters over the shingles of all documents; they only choose the token, any choice is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WordHashes, rows_of, stored, text_key, windows
from millrace.llm.rarity import shingle_counts, sizes_in_one

WINDOW, SHINGLE = 13, 5
#: Bits of the filter that documents pass before the join: a fixed 1 MB, whatever the benchmark's size.
FILTER_BITS = 1 << 23
_DROP = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Runs of a-z, 0-9 and non-ASCII characters, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().translate(_DROP).split() if text else []


def item_tokens(items: DataFrame, counts: np.ndarray, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """One row per item window: its words, its rarest shingle and where the shingle lies in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHashes()
        for batch in batches:
            out = []
            for item_id, text in rows_of([batch]):
                words = words_of(text)
                size = min(window, len(words))
                if not size:
                    continue
                k = min(shingle, size)
                grams = windows(hashed.of(words), k)
                often = counts[sizes_in_one(grams, counts.size)]
                for at in range(len(words) - size + 1):
                    own = slice(at, at + size - k + 1)
                    best = int(np.lexsort((grams[own], often[own]))[0])
                    out.append((item_id, [w.decode("utf-8", "surrogatepass") for w in words[at:at + size]],
                                int(grams[own][best].view(np.int64)), best, k))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(
                    (pa.int64(), pa.list_(pa.string()), pa.int64(), pa.int32(), pa.int32()))],
                ["item_id", "words", "token", "at", "k"])

    return items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "item_id long, words array<string>, token long, at int, k int")


def _filter(tokens: DataFrame) -> tuple[np.ndarray, list[int]]:
    """A bit for each token's hash, and the shingle lengths in use (at most ``SHINGLE``).  Both are bounded."""
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    slot = tokens.select(F.expr(f"cast(shiftrightunsigned(token, {64 - (FILTER_BITS.bit_length() - 1)}) AS int)").alias("slot"))
    sums = slot.groupBy(F.expr("slot div 8").alias("byte")).agg(F.expr("bit_or(shiftleft(1, slot % 8))").alias("bits"))
    for row in sums.toLocalIterator():
        bits[row["byte"]] = row["bits"]
    return bits, sorted(r["k"] for r in tokens.select("k").distinct().collect())


def found(docs: DataFrame, bits: np.ndarray, sizes: list[int], window: int = WINDOW) -> DataFrame:
    """Places in documents where a token may be, with the words around; and one row with the number of words.

    Rows with ``token`` null carry ``n_words``; there is one per document.
    """
    shift = np.uint64(64 - (FILTER_BITS.bit_length() - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHashes()
        for batch in batches:
            out = []
            for doc_id, key, text in rows_of([batch]):
                words = words_of(text)
                out.append((doc_id, key, len(words), None, None, None))
                if not words:
                    continue
                own = hashed.of(words)
                for k in sizes:
                    grams = windows(own, k)
                    slot = grams >> shift
                    hit = np.flatnonzero(bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1)
                    for p in hit.tolist():
                        low = max(0, p - window + k)
                        around = words[low:p + window]
                        out.append((doc_id, key, len(words), int(grams[p].view(np.int64)), p - low,
                                    [low, b" ".join(around).decode("utf-8", "surrogatepass")]))
                if len(out) > 20_000:
                    yield pack(out)
                    out = []
            yield pack(out)

    def pack(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
            pa.array([r[2] for r in out], pa.int64()), pa.array([r[3] for r in out], pa.int64()),
            pa.array([r[4] for r in out], pa.int32()),
            pa.array([r[5] and r[5][0] for r in out], pa.int64()),
            pa.array([r[5] and r[5][1] for r in out], pa.string())],
            ["doc_id", "key", "n_words", "token", "place", "low", "around"])

    return docs.select("doc_id", "key", "text").mapInArrow(
        run, "doc_id long, key long, n_words long, token long, place int, low long, around string")


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document row: ``doc_id, key, n_words, n_hit, item_ids`` (items whose windows occur), ``spans``.

    ``spans`` are the merged word ranges [start, end) that windows cover.  ``key`` is the hash of the text.
    Null or empty texts have no words, hits or items; repeated rows get the same result each; null ``item_id`` rows
    are ignored; with no items nothing is hit.  Needs ``doc_id``, ``text`` and ``item_id``, ``text`` only.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .withColumn("key", text_key())
    counts = shingle_counts(docs, words_of, SHINGLE)
    tokens = stored(item_tokens(items.where(F.col("item_id").isNotNull()), counts, window), "item-tokens")
    bits, sizes = _filter(tokens)
    seen = stored(found(docs, bits, sizes, window), "places")
    base = seen.where(F.col("token").isNull()).select("doc_id", "key", "n_words")
    first = F.col("place") - F.col("at")  # of the window, among the words around
    size = F.size("words")
    matched = seen.where(F.col("token").isNotNull()).join(tokens, "token") \
        .where((first >= 0) & (F.col("low") + first + size <= F.col("n_words"))) \
        .where(F.slice(F.split("around", " "), first + 1, size) == F.col("words")) \
        .groupBy("doc_id", "key").agg(
            F.collect_set(F.struct((F.col("low") + first).alias("a"), (F.col("low") + first + size).alias("b"))).alias("cover"),
            F.collect_set("item_id").alias("item_ids"))
    spans = F.aggregate(
        F.array_sort("cover"), F.array().cast("array<struct<a:bigint,b:bigint>>"),
        lambda merged, s: F.when(
            (F.size(merged) > 0) & (F.element_at(merged, -1)["b"] >= s["a"]),
            F.concat(F.slice(merged, 1, F.size(merged) - 1), F.array(F.struct(
                F.element_at(merged, -1)["a"].alias("a"),
                F.greatest(F.element_at(merged, -1)["b"], s["b"]).alias("b")))))
        .otherwise(F.concat(merged, F.array(s))))
    matched = matched.withColumn("spans", spans)
    joined = base.alias("d").join(
        matched.alias("m"), F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("d.key") == F.col("m.key")), "left")
    return joined.select(
        "d.doc_id", "d.key", "n_words",
        F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"]), F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
        F.coalesce("spans", F.array().cast("array<struct<a:bigint,b:bigint>>")).alias("spans"))


def contaminated(n_hit, n_words):
    """The rule: some hit, and at least one word in twenty."""
    return (n_hit > 0) & (F.lit(20) * n_hit >= n_words)


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The digest of ``hits``: numbers, the checksum of the items' ids, the verdict."""
    ids = F.array_join(F.array_sort(F.transform("item_ids", lambda i: i.cast("string"))), ",")
    return hits(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"), contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
        "spans")


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not contaminated."""
    bad = hits(docs, items).where(contaminated(F.col("n_hit"), F.col("n_words"))).select("key").distinct()
    # The verdict depends on the text alone, so the text's hash is enough to find the rows; nulls have no hits.
    keyed = docs.withColumn("__text_key", text_key(F.col("text").cast("string")))
    return keyed.join(bad, keyed["__text_key"] == bad["key"], "left_anti").select(*docs.columns)
