"""Order MinHash fingerprints: signatures whose likeness follows the edit distance of texts.

The k-mers of a text are ``K`` consecutive code points, numbered by occurrence.  For each of ``SKETCHES`` hash
functions the ``TUPLE`` smallest numbered k-mers are chosen, put back in text order and hashed as a tuple.  Two
signatures are alike in as many places as these tuples agree, in content and order.

Each text is compared with an edited version of itself and with the next document, by descending doc_id and around the
end.  Documents are dealt once, by ranges of doc_id, and stream through in order; the first document of a range
is also sent to the range before it, so no text is shuffled twice and none is collected.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import STEP, mixed, rows_of

K, TUPLE, SKETCHES, SEED = 6, 2, 32, 11
#: k-mers whose sketch values are held together, so that a long text needs bounded memory beyond its own k-mers.
BLOCK = 1 << 10
#: Ranges for each task, so that tasks get about the same number of rows although ranges are dealt by hash.
RANGES = 8

_RNG = np.random.default_rng(SEED)
_FACTORS = _RNG.integers(1 << 62, 1 << 63, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def points(text: str | None) -> np.ndarray:
    """Code points."""
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)


def numbered_kmers(codes: np.ndarray, k: int = K) -> np.ndarray:
    """A hash of each k-mer and how often it occurred before; a shorter text is one k-mer, an empty one has none."""
    k = min(k, codes.size)
    if not k:
        return np.empty(0, np.uint64)
    n = codes.size - k + 1
    h = np.full(n, k, np.uint64)
    for j in range(k):
        h *= STEP
        h += codes[j:j + n]
    h = mixed(h)
    order = np.argsort(h)
    in_order = h[order]
    fresh = np.concatenate([[True], in_order[1:] != in_order[:-1]])
    if not fresh.all():
        run = np.cumsum(fresh) - 1
        many = np.bincount(run)[run] > 1
        run, place, value = run[many], order[many], in_order[many]
        by_place = np.lexsort((place, run))
        run, place, value = run[by_place], place[by_place], value[by_place]
        starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
        number = np.arange(run.size) - np.repeat(starts, np.diff(np.append(starts, run.size)))
        h[place] = mixed(value + number.astype(np.uint64) * STEP)
    return h


def _minimal(kmers: np.ndarray, take: int, bound: np.uint64) -> np.ndarray | None:
    """Places of the ``take`` smallest k-mers of each sketch, in text order; None if too few lie under the bound."""
    place, sketch, value = [], [], []
    for at in range(0, kmers.size, BLOCK):
        values = kmers[at:at + BLOCK, None] * _FACTORS
        flat = values.reshape(-1)
        near = np.flatnonzero(flat <= bound)
        place.append(near // SKETCHES + at)
        sketch.append(near % SKETCHES)
        value.append(flat[near])
    place, sketch, value = np.concatenate(place), np.concatenate(sketch), np.concatenate(value)
    if np.bincount(sketch, minlength=SKETCHES).min() < take:
        return None
    order = np.lexsort((place, value, sketch))
    starts = np.searchsorted(sketch[order], np.arange(SKETCHES))
    return np.sort(place[order][starts[:, None] + np.arange(take)], axis=1)


def signature(codes: np.ndarray, k: int = K, size: int = TUPLE) -> np.ndarray:
    """One 32-bit number for each sketch; equal texts have equal ones, and texts without k-mers have zeros."""
    kmers = numbered_kmers(codes, k)
    n = kmers.size
    if not n:
        return np.zeros(SKETCHES, np.uint32)
    take, top = min(size, n), np.uint64((1 << 64) - 1)
    # Most k-mers are far from minimal: look below a bound that some six times as many as needed are expected under.
    bound = top if n <= 6 * size else np.uint64((1 << 64) * 6 * size // n)
    low = _minimal(kmers, take, bound)
    if low is None:
        low = _minimal(kmers, take, top)
    h = np.arange(1, SKETCHES + 1, dtype=np.uint64)
    for j in range(take):
        h = h * STEP + kmers[low[:, j]]
    return (mixed(h) >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The part of sketches that agree."""
    return float((a == b).mean())


def text_of(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


def edited(codes: np.ndarray, following: np.ndarray) -> np.ndarray:
    """The last half of the code points replaced by the first as many (or all) of the following text."""
    half = codes.size // 2
    return np.concatenate([codes[:codes.size - half], following[:half]])


def _cuts(ids: DataFrame, ranges: int) -> list[int]:
    """At most ``ranges - 1`` doc_ids that split the table into ranges of about the same number of rows."""
    known = ids.select(F.col("doc_id").cast("double").alias("x")).where(F.col("x").isNotNull())
    return sorted({int(c) for c in known.approxQuantile("x", [i / ranges for i in range(1, ranges)], 1 / (4 * ranges))}) if ranges > 1 else []


def _literal(values: list):
    return F.from_json(F.lit(json.dumps(values)), "array<bigint>")


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """``range, copy, doc_id, text``: documents by range, each range followed by the next one's first row.

    Sorted by doc_id descending, nulls last, then by text.  Rows with ``copy`` only serve as a next document.  The
    driver sees one doc_id per range.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranges or RANGES * partitions
    cuts = _cuts(docs, ranges)
    # Range 0 has the largest ids; rows without id form the last one.
    number = F.aggregate(_literal(cuts), F.lit(0), lambda n, c: n + F.when(F.col("doc_id") < c, 1).otherwise(0))
    ranged = docs.withColumn("range", F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(number))
    heads = {r["range"]: r["head"] for r in ranged.groupBy("range").agg(F.max("doc_id").alias("head")).collect()}
    filled = sorted(heads)
    before = {r: filled[i - 1] for i, r in enumerate(filled)}  # around the end: the last range takes the first one's head
    every = range(len(cuts) + 2)
    is_head = F.col("doc_id").eqNullSafe(F.get(_literal([heads.get(r) for r in every]), F.col("range")))
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("copy"))
    copy = F.struct(F.get(_literal([before.get(r) for r in every]), F.col("range")).cast("int").alias("range"), F.lit(True).alias("copy"))
    to = F.explode(F.when(is_head, F.array(own, copy)).otherwise(F.array(own)))
    return ranged.withColumn("to", to).select("to.range", "to.copy", "doc_id", "text") \
        .repartition(partitions, "range").sortWithinPartitions("range", "copy", F.col("doc_id").desc_nulls_last(), "text")


OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")


def fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """The fingerprints of each text and of its edited version, and how alike they and the next document's are.

    Needs ``doc_id`` and ``text``; other columns are ignored.  A null text is empty; texts without k-mers have the
    fingerprint of zeros and are alike.  Rows with the same doc_id follow each other by text, rows without doc_id come
    last; the only row of a table is its own next document.  An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # range, copy, doc_id, code points, signature of the row before
        for batch in batches:
            out = []
            for number, copy, doc_id, text in rows_of([batch]):
                same = held is not None and held[0] == number
                if same and held[1]:
                    continue  # a further row with the doc_id of the next range's first
                codes = points(text)
                sig = signature(codes)
                if same:
                    out.append(compared(*held[2:], codes, sig))
                held = (number, copy, doc_id, codes, sig)
            yield pa.RecordBatch.from_pylist(out, SCHEMA)

    def compared(doc_id, codes, sig, following, sig_following) -> dict:
        new = edited(codes, following)
        sig_new = signature(new)
        raw = new.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
        return {"doc_id": doc_id, "n_chars": codes.size, "edited_sha256": hashlib.sha256(raw).hexdigest(),
                "fingerprint": text_of(sig), "edited_fingerprint": text_of(sig_new),
                "near_edited": likeness(sig, sig_new), "near_next": likeness(sig, sig_following)}

    light = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return with_next(light, ranges).mapInArrow(run, OUT)


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
