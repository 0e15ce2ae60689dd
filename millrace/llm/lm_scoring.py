"""Stupid-backoff scores of documents under the n-gram counts of the whole corpus.

The score of a word after the words before it is c(n-gram) / c(n-gram without its last word) if the n-gram is in the
count table, and ``BACKOFF`` times the score with one word less of context otherwise; a single word scores c / N.
Count tables keep all n-grams; ``least`` leaves out those that occur less often (single words never).

Count tables are partitioned by hash.  Documents are dealt to blocks; a block sends each table partition its distinct
n-grams with their counts, so a hot n-gram costs one entry per block.  The partition adds up the counts and answers each
block, in the block's own order, with what other blocks add to its counts.  Joined to the block's n-grams they give the
scores, which are summed per document.  No n-gram occurs more often than a part of it, so one of three or more words
occurs once if either n-gram with one word less does: words and pairs are counted first, and of longer n-grams only
those are sent whose count that leaves open.  Blocks of texts are shuffled once and used for all of this.

N-grams are hashes of as many bits as keep the odds that any two of the corpus meet below 10**-6, and 64 bits at
most, which some 10**7 n-grams take: two n-grams that meet share a count, of 10**10 about three pairs are expected to.
A block sends rows only to partitions that it has n-grams for, so rows never outnumber n-grams.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import STEP, WordHashes, mixed, rows_of, space_words, text_key

ORDER, LEAST, BACKOFF = 3, 1, 0.4
#: Words in a block, and n-grams that are sent to one table partition, on average.
BLOCK_WORDS, TABLE_GRAMS = 1_200_000, 2_000_000


def corpus_words(docs: DataFrame) -> int:
    """How many words all texts have."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(len(space_words(text)) for (text,) in rows_of(batches))
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64())], ["n"])

    return docs.select("text").mapInArrow(count, "n long").agg(F.sum("n")).first()[0] or 0


class Layout:
    """How n-grams are cut into a table partition and a key of ``width`` bits."""

    def __init__(self, words: int):
        grams = max(2, words * ORDER)
        self.bits = max(4, math.ceil(math.log2(grams / TABLE_GRAMS + 1)))
        self.width = min(64, math.ceil(2 * math.log2(grams)) + 20) - self.bits
        self.blocks = max(1, -(-words // BLOCK_WORDS))

    def reduced(self, hashes: np.ndarray) -> np.ndarray:
        return hashes >> np.uint64(64 - self.bits - self.width)

    def part(self, keys: np.ndarray) -> np.ndarray:
        return keys >> np.uint64(self.width)

    def _cut(self, size: int) -> tuple[int, int, int]:
        """Low bits of each of ``size`` keys, as all bits, whole bytes and the bits that are left."""
        low = max(0, self.width - size.bit_length() + 1)
        return low, low // 8, low % 8

    def packed(self, keys: np.ndarray) -> bytes:
        """Ascending keys of one partition: the low bits of each, and its high bits as the place of a mark, two bits a key."""
        low, whole, rest = self._cut(keys.size)
        own = (keys & np.uint64((1 << self.width) - 1)).astype("<u8")
        octets = own.view(np.uint8).reshape(-1, 8)
        left = np.unpackbits(octets[:, whole, None], axis=1)[:, 8 - rest:] if rest else np.empty(0, np.uint8)
        place = (own >> np.uint64(low)).astype(np.int64) + np.arange(keys.size)
        marks = np.zeros(int(place[-1]) + 1, bool)
        marks[place] = True
        return octets[:, :whole].tobytes() + np.packbits(left).tobytes() + np.packbits(marks).tobytes()

    def unpacked(self, raw: bytes, size: int) -> np.ndarray:
        low, whole, rest = self._cut(size)
        at, end = whole * size, whole * size + -(-rest * size // 8)
        octets = np.zeros((size, 8), np.uint8)
        octets[:, :whole] = np.frombuffer(raw, np.uint8, count=at).reshape(size, whole)
        if rest:
            left = np.unpackbits(np.frombuffer(raw, np.uint8, count=end - at, offset=at), count=rest * size).reshape(size, rest)
            octets[:, whole] = np.packbits(left, axis=1)[:, 0] >> np.uint8(8 - rest)
        marks = np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8, offset=end)))
        return octets.view("<u8").reshape(-1) | (marks - np.arange(size)).astype(np.uint64) << np.uint64(low)


def _packed_counts(counts: np.ndarray) -> bytes:
    """Numbers many of which are 0: a bit each, a byte for those above 0, eight more for those of 255 and above."""
    some = counts[counts > 0]
    return np.packbits(counts > 0).tobytes() + np.minimum(some, 255).astype(np.uint8).tobytes() \
        + some[some >= 255].astype("<i8").tobytes()


def _counts(raw: bytes, size: int) -> np.ndarray:
    head = -(-size // 8)
    above = np.unpackbits(np.frombuffer(raw, np.uint8, count=head), count=size).astype(bool)
    some = np.frombuffer(raw, np.uint8, count=int(above.sum()), offset=head).astype(np.int64)
    some[some == 255] = np.frombuffer(raw, "<i8", offset=head + some.size)
    out = np.zeros(size, np.int64)
    out[above] = some
    return out


class Grams:
    """The distinct n-grams among ``keys``, how often they occur there, and the partitions that count them."""

    def __init__(self, keys: np.ndarray, layout: Layout):
        self.keys, self.at, self.counts = np.unique(keys, return_inverse=True, return_counts=True)
        part = layout.part(self.keys)
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if part.size else np.empty(0, np.int64)
        #: (partition, first, end)
        self.slices = [(int(part[a]), int(a), int(b)) for a, b in zip(starts, np.append(starts[1:], part.size))]

    def rows(self, n: int, number: int, layout: Layout) -> list[tuple]:
        return [(n, p, number, b - a, layout.packed(self.keys[a:b]), _packed_counts(self.counts[a:b] - 1)) for p, a, b in self.slices]

    def totals(self, others: dict[int, bytes]) -> np.ndarray:
        """The corpus's count of each of the keys that were given."""
        out = self.counts.astype(np.int64)
        for p, a, b in self.slices:
            out[a:b] += _counts(others[p], b - a)
        return out[self.at]


class Block:
    """The n-grams of some documents, in the order of their last words."""

    def __init__(self, texts: list[str | None], layout: Layout):
        lists = [space_words(t) for t in texts]
        self.layout, self.sizes = layout, np.array([len(w) for w in lists], np.int64)
        own = WordHashes().of([w for words in lists for w in words])
        self.within = np.arange(own.size) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.places, self.keys = [], []  # by order
        h = np.zeros(own.size, np.uint64)
        for n in range(1, ORDER + 1):
            # the n words that end at each place: the n-1 words that end one place earlier, and the last word
            shifted = np.concatenate([np.zeros(1, np.uint64), h[:-1]]) if own.size else h
            h = shifted * STEP + own + np.uint64(n)
            self.places.append(np.flatnonzero(self.within >= n - 1))
            self.keys.append(layout.reduced(mixed(h[self.places[-1]])))

    def first(self) -> Grams:
        """Words and pairs."""
        return Grams(np.concatenate(self.keys[:2]), self.layout)

    def later(self, n: int, below: np.ndarray) -> tuple[np.ndarray, Grams]:
        """Which n-grams may occur more than once; ``below`` counts by place those with one word less."""
        places = self.places[n - 1]
        chosen = np.flatnonzero((below[places] > 1) & (below[places - 1] > 1))
        return places[chosen], Grams(self.keys[n - 1][chosen], self.layout)

    def counted(self, found: pd.DataFrame, orders: int) -> np.ndarray:
        """For each order up to ``orders`` the corpus's count of the n-gram that ends at each place, 0 near a text's start."""
        others: dict[int, dict[int, bytes]] = {n: {} for n in range(1, orders + 1)}
        for n, p, raw in zip(found["n"], found["part"], found["others"]):
            others[n][p] = raw
        count = np.zeros((orders + 1, self.within.size), np.int64)
        known = self.first().totals(others[1])
        count[1], count[2, self.places[1]] = known[:self.within.size], known[self.within.size:]
        for n in range(3, orders + 1):
            places, grams = self.later(n, count[n - 1])
            count[n, self.places[n - 1]] = 1
            count[n, places] = grams.totals(others[n])
        return count


ASKED = {"n": "int", "part": "long", "block": "long", "size": "long", "keys": "binary", "more": "binary"}


def first_requests(blocks: DataFrame, layout: Layout) -> DataFrame:
    """The distinct words and pairs of words of each block with its counts of them, a row for each table partition."""

    def run(texts: pd.DataFrame) -> pd.DataFrame:
        rows = Block(texts["text"].tolist(), layout).first().rows(1, int(texts["block"].iat[0]), layout)
        return pd.DataFrame(rows, columns=list(ASKED))

    return blocks.groupBy("block").applyInPandas(run, ", ".join(f"{c} {t}" for c, t in ASKED.items()))


def next_requests(blocks: DataFrame, answered: DataFrame, n: int, layout: Layout) -> DataFrame:
    """The distinct n-grams of each block whose count is open."""

    def run(texts: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple] = []
        if len(texts):
            block = Block(texts["text"].tolist(), layout)
            rows = block.later(n, block.counted(found, n - 1)[n - 1])[1].rows(n, int(texts["block"].iat[0]), layout)
        return pd.DataFrame(rows, columns=list(ASKED))

    return blocks.groupBy("block").cogroup(answered.groupBy("block")).applyInPandas(run, ", ".join(f"{c} {t}" for c, t in ASKED.items()))


def answers(asked: DataFrame, layout: Layout) -> DataFrame:
    """``block, n, part, others``: what other blocks add to a block's counts, in the order of its n-grams."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([layout.unpacked(raw, size) for raw, size in zip(part["keys"], part["size"])])
        own = np.concatenate([_counts(raw, size) + 1 for raw, size in zip(part["more"], part["size"])])
        _, inverse = np.unique(keys, return_inverse=True)
        others = np.bincount(inverse, weights=own).astype(np.int64)[inverse] - own
        ends = np.cumsum(part["size"].to_numpy())
        return pd.DataFrame({"block": part["block"], "n": part["n"], "part": part["part"],
                             "others": [_packed_counts(others[end - size:end]) for end, size in zip(ends, part["size"])]})

    return asked.groupBy("n", "part").applyInPandas(run, "block long, n int, part long, others binary")


def scores(docs: DataFrame, least: int = LEAST, backoff: float = BACKOFF) -> DataFrame:
    """``doc_id, n_words, n_trigram, n_bigram, n_unigram, log_score, mean_log_score`` for every row.

    ``log_score`` is the sum of the natural logarithms of its words' scores; the mean is over words, null without any.
    The three numbers tell at which order the words were scored.  Words are separated by ASCII white space, A-Z
    lower-cased; n-grams do not cross texts.  A null or empty text has no words and score 0; rows without doc_id are
    scored too; repeated rows count and are scored each.  Needs ``doc_id`` and ``text``; an empty table gives no rows.
    """
    light = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = corpus_words(light)
    layout = Layout(total)
    # The input's partition spreads repeated rows; a lost task is dealt again as before.
    blocks = light.withColumn("block", F.pmod(F.xxhash64("doc_id", text_key(), F.spark_partition_id()), F.lit(layout.blocks)).cast("long")) \
        .repartition("block")

    def run(texts: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        block = Block(texts["text"].tolist(), layout)
        count, doc = block.counted(found, ORDER), np.repeat(np.arange(block.sizes.size), block.sizes)
        count[2:][count[2:] < least] = 0
        value = np.log(np.maximum(count[1], 1)) - math.log(max(total, 1)) + (ORDER - 1) * math.log(backoff)
        # Places near a text's start have less context to back off from.
        value -= np.maximum(ORDER - 1 - block.within, 0) * math.log(backoff)
        used = np.ones(doc.size, np.int64)
        for n in range(2, ORDER + 1):
            at = np.flatnonzero(count[n])
            steps = np.minimum(ORDER - 1, block.within[at]) - (n - 1)
            value[at] = np.log(count[n, at]) - np.log(count[n - 1, at - 1]) + steps * math.log(backoff)
            used[at] = n
        log_score = np.bincount(doc, weights=value, minlength=block.sizes.size)
        out = pd.DataFrame({"doc_id": texts["doc_id"].astype("Int64"), "n_words": block.sizes})
        for n, name in ((3, "n_trigram"), (2, "n_bigram"), (1, "n_unigram")):
            out[name] = np.bincount(doc[used == n], minlength=block.sizes.size)
        out["log_score"] = np.round(log_score, 6)
        mean = np.round(log_score / np.maximum(block.sizes, 1), 6)
        out["mean_log_score"] = pd.Series(mean).where(pd.Series(block.sizes) > 0, None).to_numpy()
        return out

    replies = answers(first_requests(blocks, layout), layout)
    for n in range(3, ORDER + 1):
        replies = replies.unionByName(answers(next_requests(blocks, replies, n, layout), layout))
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(
        run, "doc_id long, n_words long, n_trigram long, n_bigram long, n_unigram long, log_score double, mean_log_score double")
