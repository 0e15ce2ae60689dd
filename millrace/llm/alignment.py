"""Two tokenizers' tokens of one text, aligned by their bytes.

Both tokenise the text after a space; a token covers the bytes that it stands for, so each side cuts the same bytes into
ranges.  In a batch every document has byte positions of its own, and an as-of merge finds for each token start the
token of the other side that covers it; both directions together are all pairs of tokens whose ranges overlap.  Bytes
where tokens of both sides end cut a document into groups.

How often a pair of ids is linked is counted over all documents.  Documents are gathered in blocks of a bounded number
of pairs; a block offers each of its pairs once, with the number of its documents, so a pair that every document
has costs a row per block.  Counts come back to the blocks by a join on the pair and one on the block.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from millrace.llm.common import rows_of, stored

#: Bytes of text that one merge looks at (a longer text is one merge), and pairs of documents in a block.
MERGE_BYTES, BLOCK_PAIRS = 1 << 20, 1 << 21
LEFT_FILE, RIGHT_FILE = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"


@dataclass(frozen=True)
class Side:
    """A tokenizer: texts to lists of ids, and the bytes of each id."""

    encode: object
    token_bytes: tuple[bytes, ...]

    @property
    def sizes(self) -> np.ndarray:
        return np.array([len(b) for b in self.token_bytes], np.int64)


def _tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def byte_side(path: str | None = None) -> Side:
    """Byte-level BPE from a rank file; the text gets a space before it, special tokens' strings are plain text.

    The ids are those of ``byte_bpe_50k.json``, whose vocabulary the rank file holds (the tests compare them).
    """
    import public_tokenizers
    import tiktoken
    with open(path or _tokenizer_file(LEFT_FILE), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("left", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return Side(lambda texts: [encoding.encode_ordinary(" " + t) for t in texts], tuple(table))


@lru_cache(maxsize=2)
def piece_side(path: str | None = None) -> Side:
    """Sentence pieces, which put the space before the text themselves."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path or _tokenizer_file(RIGHT_FILE))

    def piece(i: int) -> bytes:
        name = model.IdToPiece(i)
        return bytes([int(name[3:5], 16)]) if model.IsByte(i) else name.replace("▁", " ").encode()

    return Side(lambda texts: model.encode(list(texts), num_threads=1), tuple(map(piece, range(model.GetPieceSize()))))


def overlaps(left_start: np.ndarray, right_start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of overlapping tokens of two cuts of the same bytes, each pair once.

    Starts ascend and are positions in the batch, so a document's tokens meet only its own.
    """
    left = pd.DataFrame({"at": left_start, "i": np.arange(left_start.size)})
    right = pd.DataFrame({"at": right_start, "j": np.arange(right_start.size)})
    under_left = pd.merge_asof(left, right, on="at")
    under_right = pd.merge_asof(right, left, on="at")
    # Where both start at one byte, both directions find the pair.
    i, j = under_right["i"].to_numpy(), under_right["j"].to_numpy()
    new = left_start[i] != right_start[j]
    return np.concatenate([under_left["i"].to_numpy(), i[new]]), np.concatenate([under_left["j"].to_numpy(), j[new]])


@dataclass
class Aligned:
    """The tokens of a batch of texts: ids, starts, documents, the common ends' flags, and the linked index pairs."""

    ids: list[np.ndarray]
    doc: list[np.ndarray]
    start: list[np.ndarray]
    ends_group: list[np.ndarray]
    group: list[np.ndarray]
    links: tuple[np.ndarray, np.ndarray]


def _tokens(texts: list[str | None], sides: tuple[Side, Side]) -> list[list[list[int]]]:
    """Ids of each text by both sides; none where a text is missing or a side does not give the text back."""
    whole = [t for t in texts if t]
    both = [iter(side.encode(whole)) if whole else iter(()) for side in sides]
    out: list[list[list[int]]] = [[], []]
    for text in texts:
        ids = [next(b) for b in both] if text else [[], []]
        if text:
            want = (" " + text).encode()
            if any(b"".join(map(side.token_bytes.__getitem__, own)) != want for side, own in zip(sides, ids)):
                ids = [[], []]
        for k in (0, 1):
            out[k].append(ids[k])
    return out


def align(texts: list[str | None], sides: tuple[Side, Side], sizes: tuple[np.ndarray, np.ndarray]) -> Aligned:
    ids, doc, start, end = [], [], [], []
    for side_ids, size in zip(_tokens(texts, sides), sizes):
        own = np.concatenate([np.empty(0, np.int64), *(np.asarray(x, np.int64) for x in side_ids)])
        ids.append(own)
        doc.append(np.repeat(np.arange(len(texts)), [len(x) for x in side_ids]))
        end.append(size[own].cumsum())
        start.append(end[-1] - size[own])
    flags = [np.isin(end[0], end[1], assume_unique=True), np.isin(end[1], end[0], assume_unique=True)]
    return Aligned(ids, doc, start, flags, [f.cumsum() - f for f in flags], overlaps(*start))


class GroupText:
    """Writes a document's groups as ``a1,a2|b1;a3|b2,b3``."""

    ENDS = (b",", b"|", b";", b"")

    def __init__(self, sides: tuple[Side, Side]):
        self.shift = [0, 4 * len(sides[0].token_bytes)]
        self.parts = [b"%d%s" % (i, end) for side in sides for i in range(len(side.token_bytes)) for end in self.ENDS]

    def of(self, found: Aligned, n: int) -> list[str]:
        """One text per document, empty without tokens."""
        code = []
        for k in (0, 1):
            ends = np.where(found.ends_group[k], k + 1, 0)
            if k and ends.size:
                last = np.flatnonzero(np.append(found.doc[1][1:] != found.doc[1][:-1], True))
                ends[last] = 3
            code.append(self.shift[k] + 4 * found.ids[k] + ends)
        # A token comes after all tokens of earlier groups, the left side's before the right side's.
        groups = int(found.ends_group[0].sum())
        before = [np.concatenate([[0], np.bincount(g, minlength=groups).cumsum()]) for g in found.group]
        items = np.empty(code[0].size + code[1].size, np.int64)
        items[np.arange(code[0].size) + before[1][found.group[0]]] = code[0]
        items[np.arange(code[1].size) + before[0][found.group[1] + 1]] = code[1]
        sizes = np.bincount(found.doc[0], minlength=n) + np.bincount(found.doc[1], minlength=n)
        at, out = 0, []
        for size in sizes.tolist():
            out.append(b"".join(map(self.parts.__getitem__, items[at:at + size].tolist())).decode())
            at += size
        return out


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows (doc_id, text) in lists of about ``MERGE_BYTES`` of text."""
    rows, size = [], 0
    for row in rows_of(batches):
        rows.append(row)
        size += len(row[1] or "") + 64
        if size >= MERGE_BYTES:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


GROUPS = ("doc_id long, groups array<struct<start: long, end: long, a: array<int>, b: array<int>>>, "
          "links array<struct<a: int, b: int>>")


def groups(docs: DataFrame, left_path: str | None = None, right_path: str | None = None) -> DataFrame:
    """Each document's groups (bytes of space and text, ids of both sides) and links (token numbers of both sides)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = (byte_side(left_path), piece_side(right_path))
        sizes = (sides[0].sizes, sides[1].sizes)
        for rows in _portions(batches):
            out_groups, out_links = [], []
            for _, text in rows:
                found = align([text], sides, sizes)
                ends = np.flatnonzero(found.ends_group[0])
                at = found.start[0][ends] + sizes[0][found.ids[0][ends]]
                cut = [np.split(found.ids[k], np.flatnonzero(found.ends_group[k])[:-1] + 1) for k in (0, 1)]
                begin = np.concatenate([[0], at[:-1]])
                out_groups.append([{"start": int(s), "end": int(e), "a": a.tolist(), "b": b.tolist()}
                                   for s, e, a, b in zip(begin, at, *cut)])
                pairs = sorted(zip(found.links[0].tolist(), found.links[1].tolist()))
                out_links.append([{"a": a, "b": b} for a, b in pairs])
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()),
                 pa.array(out_groups, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))),
                 pa.array(out_links, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))], ["doc_id", "groups", "links"])

    return _plain(docs).mapInArrow(run, GROUPS)


FOUND = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, block long, at binary, times binary, "
         "pairs array<long>, in_docs array<int>")


def _found(docs: DataFrame, left_path: str | None, right_path: str | None, block_pairs: int) -> DataFrame:
    """Two kinds of rows: a document with its distinct pairs (numbers in the block's list, and how often each is linked);
    a block's distinct pairs, with the number of its documents that hold each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = (byte_side(left_path), piece_side(right_path))
        sizes = (sides[0].sizes, sides[1].sizes)
        bits = int(sizes[1].size - 1).bit_length()
        writer = GroupText(sides)
        block, held, codes, times = TaskContext.get().partitionId() << 33, [], [], []

        def flush() -> pa.RecordBatch:
            pairs, at, in_docs = np.unique(np.concatenate([np.empty(0, np.int64), *codes]), return_inverse=True, return_counts=True)
            at = at.astype("<u2" if pairs.size <= 1 << 16 else "<u4")
            cut = np.cumsum([c.size for c in codes])[:-1]
            rows = [(*row, block, a.tobytes(), t.astype("<u2" if t.size and t.max() < 1 << 16 else "<u4").tobytes(), None, None)
                    for row, a, t in zip(held, np.split(at, cut), times)]
            rows.append((None,) * 6 + (block, None, None, pairs, in_docs))
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(
                    [pa.int64()] * 5 + [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())])],
                [part.split()[0] for part in FOUND.split(", ")])

        for rows in _portions(batches):
            n = len(rows)
            found = align([text for _, text in rows], sides, sizes)
            texts = writer.of(found, n)
            i, j = found.links
            of = found.doc[0][i]
            key, often = np.unique((of << 44) | (found.ids[0][i] << bits) | found.ids[1][j], return_counts=True)
            cut = np.searchsorted(key >> 44, np.arange(1, n))
            own = np.split(key & ((1 << 44) - 1), cut)
            numbers = [np.bincount(d, minlength=n) for d in (found.doc[0], found.doc[1], found.doc[0][found.ends_group[0]], of)]
            for d, (doc_id, _) in enumerate(rows):
                held.append((doc_id, *(int(x[d]) for x in numbers), hashlib.sha256(texts[d].encode()).hexdigest() if texts[d] else ""))
            codes += own
            times += np.split(often, cut)
            if sum(c.size for c in codes) + len(held) >= block_pairs:
                yield flush()
                block += 1
                held, codes, times = [], [], []
        if held:
            yield flush()

    return _plain(docs).mapInArrow(run, FOUND)


REPORT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def report(docs: DataFrame, left_path: str | None = None, right_path: str | None = None, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """One row per row of ``docs``: tokens of both sides, groups, links, links by the left id's commonest pair, and the sum of
    the links' counts.  A pair's count is the number of rows of ``docs`` that hold it.

    Needs ``doc_id`` and ``text``; other columns are ignored.  A null or empty text, and one that a tokenizer does not give back
    byte by byte (the right one writes U+2581 for a space), has no tokens: zeros and an empty string.  Repeated rows count
    and are reported each; a null ``doc_id`` is kept.  Ties for the commonest pair are all best.  An empty table gives no rows.
    A text is aligned whole, so a task's memory follows its longest text.
    """
    found = stored(_found(docs, left_path, right_path, block_pairs), "aligned")
    bits = int(piece_side(right_path).sizes.size - 1).bit_length()
    blocks = found.where(F.col("pairs").isNotNull())
    counted = blocks.select(F.explode(F.arrays_zip("pairs", "in_docs")).alias("p")) \
        .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.in_docs").alias("n"))
    # At most as many rows per left id as the right side has ids.
    best = counted.withColumn("is_best", F.col("n") == F.max("n").over(W.partitionBy(F.shiftright("pair", bits))))
    offered = blocks.select(F.col("block").alias("of_block"), F.explode("pairs").alias("pair")).join(best, "pair")

    def look_up(rows: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        counts = counts.sort_values("pair")
        n, is_best = counts["n"].to_numpy(np.int64), counts["is_best"].to_numpy(bool)
        n_best, total = [], []
        for at, times, links in zip(rows["at"], rows["times"], rows["n_links"]):
            at = np.frombuffer(at, "<u2" if len(n) <= 1 << 16 else "<u4")
            times = np.frombuffer(times, "<u2" if len(times) == 2 * at.size else "<u4").astype(np.int64)
            n_best.append(int(times[is_best[at]].sum()))
            total.append(int((times * n[at]).sum()))
        return rows.drop(columns=["at", "times", "block"]).assign(n_best=n_best, count_sum=total)

    names = [part.split()[0] for part in REPORT.split(", ")]
    plain = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    rows = found.where(F.col("pairs").isNull())
    looked = rows.where("n_links > 0").select(*plain, "block", "at", "times").groupBy("block").cogroup(offered.groupBy("of_block")) \
        .applyInPandas(look_up, ", ".join(f"{c} {'string' if c.endswith('256') else 'long'}" for c in [*plain, "n_best", "count_sum"]))
    none = rows.where("n_links = 0").select(*plain, F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum"))
    return looked.unionByName(none).select(*names)
