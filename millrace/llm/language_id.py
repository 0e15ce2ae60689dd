"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is lower-cased; everything but letters becomes one blank.  Its subwords are the runs of 2, 3 and 4 characters,
hashed into ``BUCKETS`` rows of an embedding table; a text is the average of its subwords' embeddings, and a
softmax over that average gives the languages.  Both tables are trained by stochastic gradient descent in numpy on a
bounded sample; the temperature of the softmax and the limit below which a prediction is rejected are fitted
on a part of the sample that training does not see.

The sample is the only bounded part: at most ``PER_LANGUAGE`` documents of each language, those with the smallest
hash of doc_id.  Prediction reads every text whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import rows_of, stored, text_key

BUCKETS, DIMENSIONS, ORDERS = 1 << 13, 16, (2, 3, 4)
PER_LANGUAGE = 400
STEPS, RATE, BATCH, SEED = 1500, 0.5, 32, 7
#: One in so many sampled documents calibrates; so many of the rightly predicted ones may be rejected.
CALIBRATION, LOST = 5, 0.002
#: Characters that are looked at together, so that a long text needs bounded memory.
BLOCK = 1 << 18
UNKNOWN = "und"

_LETTER: np.ndarray | None = None


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTER


def subwords(text: str | None, buckets: int = BUCKETS) -> np.ndarray | None:
    """How often each bucket occurs in the whole text; None if it has no letter."""
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    counts, any_letter, carry = np.zeros(buckets, np.float32), False, np.zeros(1, np.uint32)
    for at in range(0, points.size, BLOCK):
        block = points[at:at + BLOCK]
        is_letter = letters()[block]
        any_letter |= bool(is_letter.any())
        block = np.where(is_letter, block, np.uint32(0))
        block = np.concatenate([carry, block, np.zeros(1, np.uint32)] if at + BLOCK >= points.size else [carry, block])
        # Runs of blanks become one; a block starts with the last characters of the one before.
        block = block[np.concatenate([[True], (block[1:] != 0) | (block[:-1] != 0)])]
        fresh = carry.size
        for n in ORDERS:
            first = max(0, fresh - n + 1) if at else 0
            part = block[first:]
            if part.size < n:
                continue
            h = np.full(part.size - n + 1, n, np.uint32)
            for j in range(n):
                h = h * np.uint32(0x01000193) ^ part[j:j + h.size]
            h = h * np.uint32(0x9E3779B1)
            counts += np.bincount(h >> np.uint32(32 - (buckets.bit_length() - 1)), minlength=buckets)
        carry = block[-max(ORDERS) + 1:]
    return counts if any_letter else None


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # bucket x language: the embeddings times the output layer
    bias: np.ndarray
    temperature: float
    limit: float  # below it a prediction is rejected

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Calibrated probabilities of the languages for rows of bucket counts."""
        mean = counts / np.maximum(counts.sum(1, keepdims=True), 1)
        return softmax((mean @ self.table + self.bias) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(counts: np.ndarray, langs: list[str], calibrates: np.ndarray) -> Model:
    """Fit both layers by stochastic gradient descent, then the temperature and the limit on the ``calibrates`` rows."""
    languages = sorted(set(langs))
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 0.0)
    y = np.array([languages.index(x) for x in langs])
    x = counts / np.maximum(counts.sum(1, keepdims=True), 1)
    rng = np.random.default_rng(SEED)
    inner = rng.normal(0, 1.0, (counts.shape[1], DIMENSIONS)).astype(np.float32)
    outer = rng.normal(0, 0.1, (DIMENSIONS, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    own = np.flatnonzero(~calibrates) if (~calibrates).any() else np.arange(y.size)
    of_language = [own[y[own] == k] for k in range(len(languages)) if (y[own] == k).any()]
    for step in range(STEPS):
        rate = RATE * (1 - step / STEPS)
        # Languages take turns, so a rare one is learned as well as a frequent one.
        rows = np.array([rng.choice(of_language[i]) for i in rng.integers(len(of_language), size=BATCH)])
        hidden = x[rows] @ inner
        wrong = softmax(hidden @ outer + bias)
        wrong[np.arange(rows.size), y[rows]] -= 1
        wrong /= rows.size
        back = wrong @ outer.T
        outer -= rate * (hidden.T @ wrong)
        bias -= rate * wrong.sum(0)
        inner -= rate * 50 * (x[rows].T @ back)  # an average moves each of its many rows only a little
    table = (inner @ outer).astype(np.float32)
    held = np.flatnonzero(calibrates) if calibrates.any() else own
    logits = x[held] @ table + bias
    # Smoothed targets, else perfectly told rows would ask for a temperature of zero.
    target = (held.size + 1) / (held.size + 2)

    def loss(t: float) -> float:
        p = np.clip(softmax(logits / t)[np.arange(held.size), y[held]], 1e-12, 1 - 1e-12)
        return float(-(target * np.log(p) + (1 - target) * np.log(1 - p)).mean())

    likely = [(loss(t), t) for t in np.geomspace(0.05, 20, 60)]
    temperature = float(min(likely)[1])
    model = Model(languages, table, bias, temperature, 0.0)
    p = softmax(logits / temperature)
    right = p.max(1)[p.argmax(1) == y[held]]
    if right.size:
        model.limit = float(min(0.5, np.quantile(right, LOST)))
    return model


def _features(docs: DataFrame) -> DataFrame:
    """Bucket counts of whole texts, as the buckets that occur and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, split, found, often = [], [], [], []
            for one, part, text in rows_of([batch]):
                counts = subwords(text)
                if counts is not None:
                    at = np.flatnonzero(counts)
                    lang.append(one)
                    split.append(part)
                    found.append(at.astype("<u2").tobytes())
                    often.append(counts[at].astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(split, pa.int64()), pa.array(found, pa.binary()), pa.array(often, pa.binary())],
                ["lang", "split", "found", "often"])

    return docs.select("lang", "split", "text").mapInArrow(run, "lang string, split long, found binary, often binary")


def held_out(doc_id="doc_id"):
    """Documents that no training may see."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Train on at most ``per_language`` texts of each non-null ``lang`` that are not held out.

    Rows alike in doc_id, lang and text are one.  Rows with a null doc_id are not used.  The model depends on the rows only, not on how they are partitioned.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()) \
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    split = F.xxhash64("doc_id")
    chosen = usable.distinct().withColumn("split", split) \
        .withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy("split", "doc_id"))) \
        .where(F.col("rank") <= per_language).select("doc_id", "lang", "split")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    # Stored, the sample's ids have a known size: few enough are broadcast, and the texts stay where they are.
    found = texts.join(stored(chosen, "sample"), ["doc_id", "lang"]).where(F.col("text").isNotNull()).withColumn("hash", text_key())
    # A doc_id may stand in many rows: one of each text, and again the first of them.
    first = found.dropDuplicates(["doc_id", "lang", "hash"]) \
        .withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy("split", "doc_id", "hash"))) \
        .where(F.col("rank") <= per_language).drop("rank")
    rows = _features(first).collect()
    rows.sort(key=lambda r: (r["lang"], r["split"], r["found"], r["often"]))
    counts = np.zeros((len(rows), BUCKETS), np.float32)
    for i, r in enumerate(rows):
        counts[i, np.frombuffer(r["found"], "<u2")] = np.frombuffer(r["often"], "<f4")
    place = np.arange(len(rows))
    return train(counts, [r["lang"] for r in rows], place % CALIBRATION == CALIBRATION - 1)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` plus ``lang_pred``, ``score`` and ``rejected``; they replace columns of those names.

    A null text or one without a letter is ``und`` with score 0 and rejected; so is any text if nothing was learned.
    A text whose calibrated score is under the model's limit keeps its language and is rejected.
    """
    out_names = ("lang_pred", "score", "rejected")
    kept = docs.drop(*out_names)
    names = list(kept.columns)
    at = names.index("text")
    schema = T.StructType(list(kept.schema.fields)).add("lang_pred", "string").add("score", "double").add("rejected", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score = [], []
            for text in batch.column(at):
                counts = subwords(text.as_py())
                if counts is None or not model.languages:
                    lang.append(UNKNOWN)
                    score.append(0.0)
                    continue
                p = model.scores(counts[None])[0]
                lang.append(model.languages[int(p.argmax())])
                score.append(float(p.max()))
            rejected = [x == UNKNOWN or s < model.limit for x, s in zip(lang, score)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                [*names, *out_names])

    return kept.mapInArrow(run, schema)


def report(docs: DataFrame) -> DataFrame:
    """Fit on the documents, predict every one: ``doc_id, held_out, lang_pred, score, rejected``."""
    model = fit(docs)
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def accepted(docs: DataFrame) -> DataFrame:
    """The documents whose language is told with enough certainty; all columns."""
    return predict(docs, fit(docs)).where(~F.col("rejected")).select(*docs.columns)
