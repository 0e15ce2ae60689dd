"""Passages that repeat, found by sorting sparse suffixes.

Texts are words between ASCII white space, A-Z lower-cased.  A passage of ``least`` words is a window; what a document
repeats is what its windows cover that occur at another place too, and every such window is found.  Each window has an
anchor, a minimiser: where the hash of ``K`` words is the smallest of the first ``SPAN`` of it, so equal windows have equal
anchors with the same ``HEAD`` words behind, whatever stands around them.  Only suffixes at anchors are kept, and of these only
the ones whose head occurs again.  Where all places of a head agree in all words that the anchor's windows cover, one suffix
stands for these windows (a unit of ``n`` windows); elsewhere the anchor is extended to the left, one suffix for each window.

The suffixes are sorted by their first words, then by place, in ranges over all tasks, and neighbours are compared: those that
begin alike are a run, whose first place the others repeat.  The words are compared as two independent 64-bit hashes of the
whole window.  A run may go over many ranges, so a passage that very many texts hold is split; each range hands on two places
of the runs at its ends.  Ranges of words that touch are one match, as far to the left and right as words agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import STEP, WordHashes, in_filter, key_filter, longs, mixed, rows_of, space_words, stored, windows

LEAST, K, SPAN, HEAD = 50, 5, 20, 26
#: Words around the ends of a match that are compared in one round; a match whose words all agree goes into the next.
AROUND = 2 * (SPAN + K) + HEAD
#: Units in one Arrow batch, about.
UNITS = 200_000
#: Makes other word hashes of the word hashes.
SECOND = np.uint64(0xD6E8FEB86659FD93)
SETTLED, OPEN, EDGE = 0, 1, 2
IN_ORDER = ["unit", "proof", "doc_id", "spot", "n", "first_doc", "first_spot", "next_doc", "kind"]
BACK = np.uint64(pow(int(STEP), -1, 1 << 64))


class Passages:
    """Hashes of any ranges of a text's words."""

    def __init__(self, own: np.ndarray):
        ones = np.ones(own.size + 1, np.uint64)
        ones[1:] = BACK
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own * np.cumprod(ones)[:-1], dtype=np.uint64)])
        ones[1:] = STEP
        self.powers = np.cumprod(ones)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of words is part of the hash."""
        return mixed(mixed((self.sums[end] - self.sums[start]) * self.powers[start]) + (end - start).astype(np.uint64))


def anchors(own: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a text, and the first window and the number of windows of each."""
    count = own.size - least + 1
    at = np.lib.stride_tricks.sliding_window_view(windows(own, K), SPAN)[:count].argmin(axis=1) + np.arange(count)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[first], first, np.diff(np.append(first, count))


def heads(docs: DataFrame, least: int) -> DataFrame:
    """``head, whole``: for each anchor the hashes of its head and of all words that its windows cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHashes()
        for batch in batches:
            found = [np.empty((2, 0), np.uint64)]
            for (text,) in rows_of([batch]):
                words = space_words(text)
                if len(words) >= least:
                    own = hashed.of(words)
                    passage, (at, first, n) = Passages(own), anchors(own, least)
                    found.append(np.stack([passage(at, at + HEAD), passage(first, first + n - 1 + least)]))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in np.concatenate(found, axis=1).view(np.int64)], ["head", "whole"])

    return docs.select("text").mapInArrow(run, "head long, whole long")


def units(docs: DataFrame, least: int, alike: Broadcast, unlike: Broadcast) -> DataFrame:
    """``unit, proof, doc_id, spot, n``: ``n`` windows in a row from ``spot``, which is the text's key and the word's number.

    ``unit`` and ``proof`` are independent hashes of the words.

    A filter may let a head through that it does not hold.  That adds rows, and none that are wrong.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHashes()
        for batch in batches:
            found: list[tuple] = []
            size = 0
            for doc_id, key, text in rows_of([batch]):
                words = space_words(text)
                if len(words) < least:
                    continue
                own = hashed.of(words)
                passage, (at, first, n) = Passages(own), anchors(own, least)
                head = passage(at, at + HEAD)
                single = in_filter(unlike.value, head)
                block = in_filter(alike.value, head) & ~single
                places = np.flatnonzero(np.repeat(single, n))
                start = np.concatenate([places, first[block]])
                count = np.concatenate([np.ones(places.size, np.int64), n[block]])
                if not start.size:
                    continue
                end = start + count - 1 + least
                found.append((passage(start, end).view(np.int64), Passages(mixed(own ^ SECOND))(start, end).view(np.int64),
                              np.full(start.size, doc_id),
                              (np.int64(key) << np.int64(32)) + start, count.astype(np.int32)))
                size += start.size
                if size > UNITS:
                    yield as_batch(found)
                    found, size = [], 0
            yield as_batch(found)

    def as_batch(found: list[tuple]) -> pa.RecordBatch:
        kinds = (np.int64, np.int64, np.int64, np.int64, np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([np.empty(0, k), *(f[i] for f in found)])) for i, k in enumerate(kinds)],
            ["unit", "proof", "doc_id", "spot", "n"])

    return docs.select("doc_id", "key", "text").mapInArrow(run, "unit long, proof long, doc_id long, spot long, n int")


def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare the sorted suffixes of one range with their neighbours; see ``in_order``.

    Rows of a run that begins here carry its first place and the next one's document (``SETTLED``).  Rows of the first run, which may
    begin in an earlier range, and a last run of one row, which may go on in the next, are ``OPEN``; the two smallest places
    of both runs are ``EDGE`` rows.  Of a run two rows are held, whatever its length.
    """
    held = np.empty((5, 0), np.int64)  # the smallest two places of the last run
    given, opening = 0, True  # how many of them are out; whether the last run is the first of the range
    before = np.empty((5, 0), np.int64)

    def rows(some: np.ndarray, first: np.ndarray, following: np.ndarray, kind: int) -> pa.RecordBatch:
        columns = [*some, first[2], first[3], following[2]]
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c) for c in columns[:4]), pa.array(columns[4].astype(np.int32)), *(pa.array(c) for c in columns[5:]),
             pa.array(np.full(some.shape[1], kind, np.int32))], IN_ORDER)

    for chunk in gathered(batches):
        joined = np.concatenate([before, chunk], axis=1)
        new = np.ones(joined.shape[1], bool)
        new[1:] = (joined[:4, 1:] != joined[:4, :-1]).any(axis=0)  # rows alike in text and doc_id are one place
        before, chunk = joined[:, -1:], chunk[:, new[before.shape[1]:]]
        all_rows = np.concatenate([held, chunk], axis=1)
        size = all_rows.shape[1]
        starts = np.concatenate([[0], 1 + np.flatnonzero((all_rows[:2, 1:] != all_rows[:2, :-1]).any(axis=0))])
        lengths = np.diff(np.append(starts, size))
        out = np.arange(size) >= given
        if opening:
            some = all_rows[:, :lengths[0]][:, out[:lengths[0]]]
            yield rows(some, some, some, OPEN)
            out[:lengths[0]] = False
            if starts.size > 1:
                some = all_rows[:, :min(2, lengths[0])]
                yield rows(some, some, some, EDGE)
        out &= np.repeat(lengths > 1, lengths)
        first = np.repeat(starts, lengths)[out]
        yield rows(all_rows[:, out], all_rows[:, first], all_rows[:, first + 1], SETTLED)
        opening = opening and starts.size == 1
        held = all_rows[:, starts[-1]:starts[-1] + 2]
        given = held.shape[1] if opening or lengths[-1] > 1 else 0
    if held.shape[1]:
        yield rows(held, held, held, EDGE)
        if not given:
            yield rows(held, held, held, OPEN)


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Columns of some batches at a time."""
    some: list[np.ndarray] = []
    for batch in batches:
        if batch.num_rows:
            some.append(np.stack([longs(c).view(np.int64) for c in batch.columns]))
        if sum(x.shape[1] for x in some) >= UNITS:
            yield np.concatenate(some, axis=1)
            some = []
    if some:
        yield np.concatenate(some, axis=1)


def in_order(found: DataFrame) -> DataFrame:
    """``unit, doc_id, spot, n, first_doc, first_spot, next_doc``: suffixes that begin like a neighbour in the sorted order.

    ``next_doc`` is the document of the run's second place.
    """
    order = ("unit", "proof", "doc_id", "spot")
    kinds = "unit long, proof long, doc_id long, spot long, n int, first_doc long, first_spot long, next_doc long, kind int"
    compared = stored(found.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(neighbours, kinds), "neighbours")
    held: dict[tuple[int, int], set] = {}
    for r in compared.where(F.col("kind") == EDGE).select("unit", "proof", "doc_id", "spot").collect():  # at most four for a range
        held.setdefault((r["unit"], r["proof"]), set()).add((r["doc_id"], r["spot"]))
    runs = compared.sparkSession.sparkContext.broadcast(
        {u: (*sorted(x)[0], sorted(x)[1][0]) for u, x in held.items() if len(x) > 1})

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            unsettled = np.flatnonzero(rows[-1] == OPEN)
            keep = rows[-1] == SETTLED
            if unsettled.size:
                unit, proof = rows[0][unsettled], rows[1][unsettled]
                starts = np.concatenate([[0], 1 + np.flatnonzero((unit[1:] != unit[:-1]) | (proof[1:] != proof[:-1]))])
                found = [runs.value.get((int(unit[i]), int(proof[i]))) for i in starts]
                lengths = np.diff(np.append(starts, unsettled.size))
                rows[5:8] = (c.copy() for c in rows[5:8])
                for c, values in zip(rows[5:8], zip(*(f or (0, 0, 0) for f in found))):
                    c[unsettled] = np.repeat(values, lengths)
                keep[unsettled] = np.repeat([f is not None for f in found], lengths)
            yield pa.RecordBatch.from_arrays([pa.array(rows[i][keep]) for i in (0, 2, 3, 4, 5, 6, 7)], [IN_ORDER[i] for i in (0, 2, 3, 4, 5, 6, 7)])

    return compared.where(F.col("kind") != EDGE).mapInArrow(
        settle, "unit long, doc_id long, spot long, n int, first_doc long, first_spot long, next_doc long")


def prepared(docs: DataFrame) -> DataFrame:
    key = F.hash(F.col("text").cast("string"))  # tells texts of one doc_id apart
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"),
                       F.col("text").cast("string").alias("text")).where(F.col("doc_id").isNotNull())


def places(docs: DataFrame, least: int) -> DataFrame:
    """``unit, doc_id, spot, n, first_doc, first_spot, next_doc, later``: the places of units that have several, with the first of them.

    ``later`` is true for all but the first; ``next_doc`` is the document of the second.
    """
    if least < LEAST:
        raise ValueError(f"places are chosen for passages of {LEAST} words and more")
    send = docs.sparkSession.sparkContext.broadcast
    shared = stored(heads(docs, least).groupBy("head").agg(
        F.count(F.lit(1)).alias("n"), (F.min("whole") != F.max("whole")).alias("unlike")).where("n > 1").select("head", "unlike"), "heads")
    alike, unlike = (send(key_filter(shared.where(F.col("unlike") == x).select("head"))) for x in (False, True))
    found = stored(units(docs, least, alike, unlike), "units")  # read twice: the ranges of the sort come from a sample
    later = (F.col("doc_id") != F.col("first_doc")) | (F.col("spot") != F.col("first_spot"))
    return in_order(found).withColumn("later", later)


def _key(spot: str):
    return F.shiftright(spot, 32).cast("int")


def _at(spot: str):
    return F.col(spot).bitwiseAND(F.lit((1 << 32) - 1)).cast("int")


def segments(pairs: DataFrame) -> DataFrame:
    """``a_doc, a_key, b_doc, b_key, shift, start, end``: word ranges of a that agree with b, ``shift`` words further."""
    diagonal = pairs.groupBy("a_doc", "a_key", "b_doc", "b_key", (F.col("b_at") - F.col("a_at")).alias("shift")) \
        .agg(F.array_sort(F.collect_set(F.struct(F.col("a_at").alias("start"), (F.col("a_at") + F.col("size")).alias("end")))).alias("starts"))
    ranges = F.aggregate(
        "starts", F.array().cast("array<struct<start:int,end:int>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= s["start"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end")))))
        .otherwise(F.concat(done, F.array(s))))
    return diagonal.select("a_doc", "a_key", "b_doc", "b_key", "shift", F.explode(ranges).alias("r")) \
        .select("a_doc", "a_key", "b_doc", "b_key", "shift", "r.start", "r.end")


def _contexts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``doc_id, key, at, before, after``: hashes of the ``AROUND`` words before and after each wanted place of a text.

    Each place is asked once, however many matches end there.
    """
    keep = docs.sparkSession.sparkContext.broadcast(key_filter(wanted.select("doc_id")))

    def only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_filter(keep.value, longs(batch.column(0)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHashes()
        for batch in batches:
            for doc_id, key, text, ats in rows_of([batch]):
                own = hashed.of(space_words(text))
                for some in (ats[i:i + 4096] for i in range(0, len(ats), 4096)):
                    out = [(doc_id, key, at, own[max(0, at - AROUND):at].tobytes(), own[at:at + AROUND].tobytes()) for at in some]
                    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], ["doc_id", "key", "at", "before", "after"])

    texts = docs.mapInArrow(only, docs.schema).dropDuplicates(["doc_id", "key"])
    of_text = wanted.groupBy("doc_id", "key").agg(F.collect_set("at").alias("ats"))
    return texts.join(of_text, ["doc_id", "key"]).select("doc_id", "key", "text", "ats") \
        .mapInArrow(run, "doc_id long, key int, at int, before binary, after binary")


def _agreeing(a: bytes, b: bytes, backwards: bool) -> int:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    n = min(x.size, y.size)
    same = (x[x.size - n:] == y[y.size - n:])[::-1] if backwards else x[:n] == y[:n]
    return n if same.all() else int(same.argmin())


def _extended(docs: DataFrame, ends: DataFrame) -> DataFrame:
    """``id, at, back`` of ends of matches, with ``at`` as far out as the words of both sides agree.

    ``at`` is a's; b's is ``shift`` further.  Rounds of ``AROUND`` words go on until no end is open.
    """
    done = None

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(i, back, _agreeing(a, b, back)) for i, back, a, b in rows_of([batch])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], k) for i, k in enumerate((pa.int64(), pa.bool_(), pa.int32()))], ["id", "back", "more"])

    while True:
        b_at = (F.col("at") + F.col("shift")).cast("int")
        wanted = ends.select(F.col("a_doc").alias("doc_id"), F.col("a_key").alias("key"), "at").unionByName(
            ends.select(F.col("b_doc").alias("doc_id"), F.col("b_key").alias("key"), b_at.alias("at"))).distinct()
        around = stored(_contexts(docs, wanted), "contexts")
        side = lambda x: around.select(
            F.col("doc_id").alias(f"{x}_doc"), F.col("key").alias(f"{x}_key"), F.col("at").alias(f"{x}_at"),
            F.col("before").alias(f"{x}_before"), F.col("after").alias(f"{x}_after"))
        words = lambda x: F.when(F.col("back"), F.col(f"{x}_before")).otherwise(F.col(f"{x}_after"))
        both = ends.withColumn("a_at", F.col("at")).withColumn("b_at", b_at) \
            .join(side("a"), ["a_doc", "a_key", "a_at"]).join(side("b"), ["b_doc", "b_key", "b_at"])
        more = both.select("id", "back", words("a").alias("a"), words("b").alias("b")).mapInArrow(extend, "id long, back boolean, more int")
        moved = stored(ends.join(more, ["id", "back"]).withColumn(
            "at", F.when(F.col("back"), F.col("at") - F.col("more")).otherwise(F.col("at") + F.col("more")).cast("int")), "ends")
        closed = moved.where(F.col("more") < AROUND).select("id", "back", "at")
        done = closed if done is None else done.unionByName(closed)
        ends = moved.where(F.col("more") == AROUND).drop("more")
        if ends.isEmpty():
            return done


def matches(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``a_doc, a_start, b_doc, b_start, n_words``: maximal equal passages of at least ``least`` words, a before b.

    Every place of a repeated passage of ``least`` words is matched with the first one; not all pairs of a group are listed.
    A passage may repeat within one document.  Null, empty and shorter texts have none; rows without doc_id are left
    out; rows alike in doc_id and text are one.
    """
    docs = prepared(docs)
    pairs = places(docs, least).where("later").select(
        F.col("first_doc").alias("a_doc"), _key("first_spot").alias("a_key"), _at("first_spot").alias("a_at"),
        F.col("doc_id").alias("b_doc"), _key("spot").alias("b_key"), _at("spot").alias("b_at"), (F.col("n") + (least - 1)).alias("size"))
    met = stored(segments(pairs).withColumn("id", F.xxhash64("a_doc", "a_key", "b_doc", "b_key", "shift", "start")), "segments")
    common = ["id", "a_doc", "a_key", "b_doc", "b_key", "shift"]
    ends = met.select(*common, F.col("start").alias("at"), F.lit(True).alias("back")).unionByName(
        met.select(*common, F.col("end").alias("at"), F.lit(False).alias("back")))
    far = _extended(docs, ends)
    return met.select("id", "a_doc", "b_doc", "a_key", "b_key", "shift") \
        .join(far.where("back").select("id", F.col("at").alias("s")), "id") \
        .join(far.where("not back").select("id", F.col("at").alias("e")), "id") \
        .select("a_doc", "a_key", F.col("s").alias("a_start"), "b_doc", "b_key", (F.col("s") + F.col("shift")).alias("b_start"),
                (F.col("e") - F.col("s")).alias("n_words")).distinct().drop("a_key", "b_key")


def _merged(start: np.ndarray, end: np.ndarray, later: np.ndarray, partner: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, end, copy and partner of the ranges of one text: words of some first place are no copy."""
    low = int(start.min())
    size = int(end.max()) - low
    cover = np.zeros((2, size + 1), np.int64)
    for kind in (0, 1):
        of = later == bool(kind)
        cover[kind] = np.cumsum(np.bincount(start[of] - low, minlength=size + 1) - np.bincount(end[of] - low, minlength=size + 1))
    state = np.where(cover[0] > 0, 1, np.where(cover[1] > 0, 2, 0))
    edges = np.flatnonzero(np.diff(np.concatenate([[0], state])))
    a, b = edges[:-1], edges[1:]
    used = state[a] > 0
    a, b = a[used], b[used]
    smallest = np.full(a.size, np.iinfo(np.int64).max)
    low_run, high_run = np.searchsorted(b, start - low, "right"), np.searchsorted(a, end - low, "left")
    many = high_run - low_run
    run = np.repeat(low_run - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(int(many.sum()))
    np.minimum.at(smallest, run, np.repeat(partner, many))
    return a + low, b + low, state[a] == 2, smallest


def repeated_spans(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``doc_id, start_word, n_words, copy, partner_doc_id``: each document's merged ranges of repeated words.

    A range ends where ``copy`` changes: it is true where all repeated passages have an earlier (doc_id, place), so removing
    the ranges with it keeps the first place of each whole.  ``partner_doc_id`` is the smallest doc_id that holds some repeated
    passage of the range at another place; the ranges of unlike texts with one doc_id are not merged with each other.
    """
    found = places(prepared(docs), least) \
        .withColumn("partner", F.when(F.col("later"), F.col("first_doc")).otherwise(F.col("next_doc")))
    spans = found.select("doc_id", _key("spot").alias("key"), F.struct(
        _at("spot").alias("s"), (_at("spot") + F.col("n") + (least - 1)).alias("e"), F.col("later").alias("c"), F.col("partner").alias("p")).alias("span")) \
        .groupBy("doc_id", "key").agg(F.collect_set("span").alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = [x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten()]
            bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            out: list[list[np.ndarray]] = [[np.empty(0, k)] for k in (np.int64, np.int64, np.int64, bool, np.int64)]
            for doc_id, x, y in zip(batch.column(0).to_pylist(), bounds[:-1], bounds[1:]):
                a, b, copy, partner = _merged(*(f[x:y] for f in flat))
                for column, values in zip(out, (np.full(a.size, doc_id), a, b - a, copy, partner)):
                    column.append(values)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out],
                                             ["doc_id", "start_word", "n_words", "copy", "partner_doc_id"])

    return spans.select("doc_id", "spans").mapInArrow(
        run, "doc_id long, start_word long, n_words long, copy boolean, partner_doc_id long")
