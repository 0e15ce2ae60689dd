"""Documents whose word shingles have a Jaccard similarity of at least 0.8, as connected components.

A text is lower-cased (A-Z) and split at ASCII white space; its set holds the hashes of its 5-word shingles, or of
the whole sequence if it has fewer words.  Texts with the same set are one node.  Sets are ordered rare first and
joined on their prefixes: two sets of sizes n and m with similarity t share a token among the first n - ceil(t n) + 1
(m - ceil(t m) + 1) ones.  Candidates pass the length filter, the positional filter and the suffix filter (an
upper bound on the overlap from how many tokens fall in each of ``BINS`` hash ranges) before their sets are compared, once.

Large groups of near copies would give all pairs of a group, so pairs never become rows.  First every node meets one leader
(the smallest node of its rarest shared token), and the links found are joined to components.  Then only nodes of different
components are compared, token by token in blocks (``dealt``): a block tells which nodes have a candidate and keeps as many
candidates as hold them together, less than its nodes.  Nodes held together are a family; each family's sets are brought
together once, in blocks too, and a block verifies its pairs by their sets and keeps as many links as join something new.
A family of more than one block is first verified inside its blocks, then between them, where nodes that are in one large
component by then are not compared again.  No link between components is lost.

Nodes are 64-bit hashes of sets; among 10 billion different sets about three pairs would share one.
Rarity comes from counters (``rarity``): any order is exact, rare tokens first are fewer candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import WordHashes, in_filter, key_filter, longs, rows_of, space_words, stored, windows
from millrace.llm.components import components
from millrace.llm.rarity import shingle_counts, sizes_in_one

SHINGLE = 5
#: Similarity of at least NUMERATOR / DENOMINATOR.
NUMERATOR, DENOMINATOR = 4, 5
BINS = 128
#: Nodes of one token that one task compares with each other; more are split into blocks.
BLOCK = 2048
#: Bytes of a shingle's hash where sets are compared: two sets of 1,000 agree by chance on one in 10**8 times.
KEPT_BYTES = 6


def shingle_set(text: str | None, hashed: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles; empty without words."""
    words = space_words(text)
    return np.unique(windows(hashed.of(words), min(SHINGLE, len(words)))) if words else np.empty(0, np.uint64)


def node_of(grams: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(grams.tobytes())).view(np.int64))


def prefix_size(n: int) -> int:
    return n - -(-NUMERATOR * n // DENOMINATOR) + 1


def _long_batch(arrays: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64) if a.dtype == np.uint64 else a) for a in arrays], names)


def _histogram(grams: np.ndarray) -> bytes:
    """How many hashes fall in each of ``BINS`` ranges, in 1 or 2 bytes each; from bits that shortened hashes keep too."""
    inside = np.bincount((grams >> np.uint64(48)).astype(np.int64) & (BINS - 1), minlength=BINS)
    width = np.uint8 if inside.max() <= 255 else "<u2" if inside.max() < 1 << 16 else "<u4"
    return inside.astype(width).tobytes()


def _histograms(raw: list[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(x, {1: np.uint8, 2: "<u2", 4: "<u4"}[len(x) // BINS]).astype(np.uint32) for x in raw])


def shared_tokens(tokens: DataFrame) -> DataFrame:
    """The rows of tokens that more than one node holds, each once."""
    own = F.shiftright("node", 32).cast("int")
    shared = tokens.groupBy("token").agg(F.min(own).alias("low"), F.max(own).alias("high")).where("low != high").select("token")
    return tokens.join(shared, "token", "left_semi").distinct()


POSTS = "doc_id long, node long, n int, token long, at int, bins binary"


def posts(docs: DataFrame, counts) -> DataFrame:
    """Two kinds of rows: each document with its set's size, node and bins; each prefix token, rare first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed, seen = WordHashes(), set()
        for batch in batches:
            doc_ids, nodes, sizes, bins = [], [], [], []
            of, tokens, at, n = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.empty(0, np.int32)], [np.empty(0, np.int32)]
            for doc_id, text in rows_of([batch]):
                grams = shingle_set(text, hashed)
                node = node_of(grams) if grams.size else None
                doc_ids.append(doc_id)
                nodes.append(node)
                sizes.append(grams.size)
                bins.append(None)
                if node is None or node in seen or doc_id is None:
                    continue
                seen.add(node)
                prefix = grams[np.lexsort((grams, counts.value[sizes_in_one(grams)]))[:prefix_size(grams.size)]]
                bins[-1] = _histogram(grams)
                of.append(np.full(prefix.size, node, np.int64))
                tokens.append(prefix)
                at.append(np.arange(prefix.size, dtype=np.int32))
                n.append(np.full(prefix.size, grams.size, np.int32))
            if len(seen) > 500_000:
                seen.clear()
            more = sum(map(len, of))
            none = lambda kind, k: pa.nulls(k, kind)
            rows = len(doc_ids)
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([pa.array(doc_ids, pa.int64()), none(pa.int64(), more)]),
                pa.concat_arrays([pa.array(nodes, pa.int64()), pa.array(np.concatenate(of))]),
                pa.concat_arrays([pa.array(sizes, pa.int32()), pa.array(np.concatenate(n))]),
                pa.concat_arrays([none(pa.int64(), rows), pa.array(np.concatenate(tokens).view(np.int64))]),
                pa.concat_arrays([none(pa.int32(), rows), pa.array(np.concatenate(at))]),
                pa.concat_arrays([pa.array(bins, pa.binary()), none(pa.binary(), more)])],
                ["doc_id", "node", "n", "token", "at", "bins"])

    return docs.select("doc_id", "text").mapInArrow(run, POSTS)


def _may_link(n_a, at_a, n_b, at_b):
    """Length filter, and positional filter for a token at these places (true for the first token that both share)."""
    low, high = F.least(n_a, n_b), F.greatest(n_a, n_b)
    most = F.least(n_a - at_a, n_b - at_b)
    need = (n_a + n_b).cast("long") * NUMERATOR
    return (high.cast("long") * NUMERATOR <= low.cast("long") * DENOMINATOR) & (most.cast("long") * (NUMERATOR + DENOMINATOR) >= need)


def leader_pairs(tokens: DataFrame) -> DataFrame:
    """``a, b``: each node b with the leader a of the rarest token where both may link."""
    leader = tokens.groupBy("token").agg(
        F.min(F.struct("node", "n", "at")).alias("leader"), F.max("node").alias("last")) \
        .where(F.col("leader.node") != F.col("last")).select("token", "leader")
    met = tokens.join(leader, "token").where(F.col("node") != F.col("leader.node")) \
        .where(_may_link(F.col("n"), F.col("at"), F.col("leader.n"), F.col("leader.at")))
    return met.groupBy(F.col("node").alias("b")).agg(F.min_by("leader.node", F.struct("at", "token")).alias("a")).select("a", "b")


def sets_of(docs: DataFrame, owners: DataFrame) -> DataFrame:
    """``node, grams``: the set of every node in ``owners`` (doc_id, node), as sorted hashes of 6 bytes."""
    wanted = docs.sparkSession.sparkContext.broadcast(key_filter(owners.select("doc_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHashes()
        for batch in batches:
            batch = batch.filter(pa.array(in_filter(wanted.value, longs(batch.column(0)))))
            nodes, sets = [], []
            for _, text in rows_of([batch]):
                grams = shingle_set(text, hashed)
                if grams.size:
                    nodes.append(node_of(grams))
                    sets.append(grams.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 8 - KEPT_BYTES:].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], ["node", "grams"])

    # The filter may let a few more documents through; joins with pairs drop their sets.  One exchange by node, which both
    # sides of the comparison use.
    made = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text").mapInArrow(run, "node long, grams binary")
    return made.groupBy("node").agg(F.first("grams").alias("grams"))


def _unpacked(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // KEPT_BYTES, 8), np.uint8)
    wide[:, 8 - KEPT_BYTES:] = np.frombuffer(raw, np.uint8).reshape(-1, KEPT_BYTES)
    return wide.view("<u8").reshape(-1)


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (``a, b``) whose sets are similar enough, each compared once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None
        for batch in batches:
            a, b = [], []
            for one, other, raw_a, raw_b in rows_of([batch]):
                if raw_a != last:
                    last, left = raw_a, _unpacked(raw_a)
                right = _unpacked(raw_b)
                both = np.concatenate([left, right])
                both.sort()
                overlap = int((both[1:] == both[:-1]).sum())
                if DENOMINATOR * overlap >= NUMERATOR * (left.size + right.size - overlap):
                    a.append(one)
                    b.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    # Sets are of one size with their texts: each pair carries one of them to the other.
    of_b = pairs.join(sets.select(F.col("node").alias("b"), F.col("grams").alias("grams_b")), "b")
    of_a = sets.select(F.col("node").alias("a"), F.col("grams").alias("grams_a"))
    return of_b.join(of_a, "a").select("a", "b", "grams_a", "grams_b").mapInArrow(run, "a long, b long")


def has_large(rows: DataFrame, group: str) -> bool:
    """Whether a group has more than ``BLOCK`` rows."""
    return not rows.groupBy(group).agg(F.count(F.lit(1)).alias("total")).where(F.col("total") > BLOCK).isEmpty()


def dealt(rows: DataFrame, group: str, within: bool | None = None, large: bool = True) -> DataFrame:
    """Rows (``group``, ``node``, ``component``, ...) in blocks (``group, p, q``); ``own`` is the row's part, p or q.

    A group of at most ``BLOCK`` rows is one part.  In a larger one a component of more than ``BLOCK`` rows has parts of its own, other components
    are put whole into common parts.  Every two parts meet in a block, but for two parts of one component; a common part also
    meets itself.  Groups of one component have no block.  ``within`` keeps the blocks of one part, or all others.  ``large`` is
    what ``has_large`` says; without a large group the steps that split one are left out.
    """
    sizes = rows.groupBy(group, "component").agg(F.count(F.lit(1)).alias("m"))
    totals = sizes.groupBy(group).agg(F.sum("m").alias("total"), F.count(F.lit(1)).alias("n_components")).where("n_components > 1")
    big = totals.where(F.col("total") > BLOCK).select(group)
    small = rows.join(totals.where(F.col("total") <= BLOCK).select(group), group, "left_semi")
    zero = F.lit(0).cast("long")
    single = small.select("*", zero.alias("p"), zero.alias("q"), zero.alias("own"))
    if within is False:
        single = single.limit(0)
    if not large:
        return single
    kin = F.when(F.col("m") > BLOCK, F.col("component")).alias("kin")
    families = sizes.join(big, group, "left_semi").select(group, "component", "m", kin)
    parts = families.groupBy(group, "kin").agg(F.ceil(F.sum("m") / BLOCK).cast("int").alias("parts"))
    listed = parts.select(group, "kin", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("k")) \
        .select(group, "kin", F.xxhash64("kin", "k").alias("part"))
    left, right = (listed.select(group, F.col("kin").alias(f"kin_{x}"), F.col("part").alias(x)) for x in "pq")
    apart = F.col("kin_p").isNull() | F.col("kin_q").isNull() | (F.col("kin_p") != F.col("kin_q"))
    kind = F.lit(True) if within is None else (F.col("p") == F.col("q")) if within else (F.col("p") != F.col("q"))
    blocks = left.join(right, group).where((F.col("p") <= F.col("q")) & apart & kind).select(group, "p", "q")
    sides = blocks.select(group, "p", "q", F.explode(F.array_distinct(F.array("p", "q"))).alias("own"))
    in_family = rows.join(families.select(group, "component", "kin"), [group, "component"]).join(
        parts.withColumnRenamed("kin", "of"), group).where(F.col("of").eqNullSafe(F.col("kin")))
    spread = F.when(F.col("kin").isNull(), F.xxhash64("component")).otherwise(F.xxhash64("node"))
    placed = in_family.withColumn("own", F.xxhash64("kin", F.pmod(spread, F.col("parts")).cast("int"))).drop("kin", "of", "parts")
    split = placed.join(sides, [group, "own"])
    return single.unionByName(split.select(*single.columns))


class Joined:
    """Which rows of a block are held together so far; keeps the pairs that joined something new."""

    def __init__(self, labels: np.ndarray):
        _, self.label = np.unique(labels, return_inverse=True)
        self.pairs: list[tuple[int, int]] = []

    def join(self, i: int, js: np.ndarray) -> None:
        other, first = np.unique(self.label[js], return_index=True)
        new = other != self.label[i]
        self.pairs += [(i, int(js[at])) for at in first[new]]
        self.label[np.isin(self.label, other[new])] = self.label[i]


def _may_link_rows(i: int, n: np.ndarray, own: np.ndarray, label: np.ndarray, across: bool) -> np.ndarray:
    """Later rows of another component that pass the length filter, of the other part if the block has two."""
    js = np.arange(i + 1, n.size)
    good = (label[js] != label[i]) & (NUMERATOR * np.maximum(n[i], n[js]) <= DENOMINATOR * np.minimum(n[i], n[js]))
    return js[good & (own[js] != own[i])] if across else js[good]


def _similar_rows(i: int, js: np.ndarray, n: np.ndarray, hist: np.ndarray) -> np.ndarray:
    """Those of ``js`` that pass the suffix filter."""
    most = np.minimum(hist[i], hist[js]).sum(1, dtype=np.int64)
    return js[(NUMERATOR + DENOMINATOR) * most >= NUMERATOR * (n[i] + n[js])]


def _by_block(compare) -> object:
    """Sorted rows that begin with (group, p, q), block by block, to pairs of nodes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[tuple] = []
        for batch in batches:
            out: list[tuple[int, int]] = []
            for row in rows_of([batch]):
                if block and block[0][:3] != row[:3]:
                    out += compare(block)
                    block = []
                block.append(row)
            yield as_batch(out)
        yield as_batch(compare(block) if block else [])

    def as_batch(out: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], ["a", "b"])

    return run


def _blocked(rows: DataFrame, group: str, columns: list[str], compare) -> DataFrame:
    grouped = rows.repartition(group, "p", "q").sortWithinPartitions(group, "p", "q", "node")
    return grouped.select(group, "p", "q", "own", "node", "component", *columns).mapInArrow(_by_block(compare), "a long, b long")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """With each node's component; a node without links is its own."""
    return rows.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))


def held_together(tokens: DataFrame, bins: DataFrame, labels: DataFrame) -> DataFrame:
    """``a, b``: nodes of different components that pass all three filters at some token, as many as hold all such nodes together."""

    def compare(rows: list[tuple]) -> list[tuple[int, int]]:
        own, node, component = (np.array([r[k] for r in rows]) for k in (3, 4, 5))
        n, at = (np.array([r[k] for r in rows], np.int64) for k in (6, 7))
        if (component == component[0]).all():
            return []
        hist, across = _histograms([r[8] for r in rows]), rows[0][1] != rows[0][2]
        # Components tell what to compare, and families grow beside them.
        family = Joined(node)
        for i in range(n.size - 1):
            js = _may_link_rows(i, n, own, component, across)
            js = js[(NUMERATOR + DENOMINATOR) * np.minimum(n[i] - at[i], n[js] - at[js]) >= NUMERATOR * (n[i] + n[js])]
            js = js[family.label[js] != family.label[i]]
            if js.size and (js := _similar_rows(i, js, n, hist)).size:
                family.join(i, js)
        return [(int(node[i]), int(node[j])) for i, j in family.pairs]

    return _blocked(dealt(_labelled(tokens, labels), "token", None, has_large(tokens, "token")).join(bins, "node"), "token", ["n", "at", "bins"], compare)


def verified_links(families: DataFrame, sets: DataFrame, labels: DataFrame, within: bool, large: bool) -> DataFrame:
    """``a, b``: links between nodes of one family (``family, node``), as many as join its components."""

    def compare(rows: list[tuple]) -> list[tuple[int, int]]:
        own, node, component = (np.array([r[k] for r in rows]) for k in (3, 4, 5))
        sets = [_unpacked(r[6]) for r in rows]
        n, across = np.array([x.size for x in sets], np.int64), rows[0][1] != rows[0][2]
        hist = _histograms([_histogram(x) for x in sets])
        distinct, ids = np.unique(np.concatenate(sets), return_inverse=True)
        ends = np.cumsum(n)
        begins, mark, joined = ends - n, np.zeros(distinct.size, bool), Joined(component)
        for i in range(n.size - 1):
            js = _may_link_rows(i, n, own, joined.label, across)
            if not js.size or not (js := _similar_rows(i, js, n, hist)).size:
                continue
            mark[ids[begins[i]:ends[i]]] = True
            overlap = np.array([np.count_nonzero(mark[ids[begins[j]:ends[j]]]) for j in js])
            mark[ids[begins[i]:ends[i]]] = False
            js = js[DENOMINATOR * overlap >= NUMERATOR * (n[i] + n[js] - overlap)]
            if js.size:
                joined.join(i, js)
        return [(int(node[i]), int(node[j])) for i, j in joined.pairs]

    return _blocked(dealt(_labelled(families, labels), "family", within, large).join(sets, "node"), "family", ["grams"], compare)


def classes(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, node, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest doc_id that links reach, itself included.  Rows without words have no node and are
    alone; rows without doc_id have no component and link nothing; repeated rows get equal results.
    Needs ``doc_id`` and ``text``; other columns are ignored.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    send = spark.sparkContext.broadcast
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = send(shingle_counts(docs, space_words, SHINGLE).clip(max=(1 << 32) - 1).astype(np.uint32))
    found = stored(posts(docs, counts), "posts")
    rows = found.where(F.col("token").isNull())
    tokens = stored(shared_tokens(found.where(F.col("token").isNotNull()).select("token", "node", "n", "at")), "tokens")
    owners = stored(rows.where(F.col("node").isNotNull() & F.col("doc_id").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("doc_id")), "owners")

    def sets_for(nodes: DataFrame) -> DataFrame:
        return sets_of(docs, owners.join(nodes.distinct(), "node", "left_semi"))

    first = stored(leader_pairs(tokens), "pairs")
    nodes = first.select(F.col("a").alias("node")).unionByName(first.select(F.col("b").alias("node")))
    labels = components(stored(linked(first, sets_for(nodes)), "links"))
    bins = rows.where(F.col("bins").isNotNull()).select("node", "bins").dropDuplicates(["node"])
    families = stored(components(held_together(tokens, bins, labels)).withColumnRenamed("component", "family"), "families")
    sets = stored(sets_for(families.select("node")), "sets")
    # Only a family of more than one block has links between blocks.
    large = has_large(families, "family")
    for within in (True, False) if large else (True,):
        more = verified_links(families, sets, labels, within, large)
        labels = components(labels.select(F.col("component").alias("a"), F.col("node").alias("b")).unionByName(more))

    smallest = owners.join(labels, "node").groupBy("component").agg(F.min("doc_id").alias("least"))
    of_node = owners.join(labels, "node", "left").join(smallest, "component", "left") \
        .select("node", F.coalesce("least", "doc_id").alias("component_id"))
    alone, with_node = rows.where(F.col("node").isNull()), rows.where(F.col("node").isNotNull())
    out = with_node.join(of_node, "node", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), "node", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
    return out.unionByName(alone.select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), "node", F.col("doc_id").alias("component_id")))


def _with_nodes(docs: DataFrame) -> DataFrame:
    """``docs`` and, as ``__node``, the hash of each row's set; null without words."""
    names = docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = WordHashes()
        for batch in batches:
            sets = [shingle_set(text, hashed) for text in batch.column(at).to_pylist()]
            nodes = pa.array([node_of(grams) if grams.size else None for grams in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, nodes], [*names, "__node"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("__node", T.LongType())]))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that link to one with a smaller doc_id; all columns.

    Of rows with the same doc_id and component one stays; rows without doc_id all stay.
    """
    found = stored(classes(docs), "classes")
    first = found.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("__keep"), F.col("node").alias("__own"))
    # Only where unlike rows share a doc_id does its row have to be told by its set.
    unlike = found.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("__keep")) \
        .agg((F.min("component_id") != F.max("component_id")).alias("unlike")).where("unlike").select("__keep")
    same_id = F.col("doc_id").cast("long") == F.col("__keep")
    plain = docs.join(first.select("__keep").distinct().join(unlike, "__keep", "left_anti"), same_id)
    told = _with_nodes(docs.join(unlike, same_id, "left_semi")).join(
        first.distinct(), same_id & F.col("__node").eqNullSafe(F.col("__own")))
    kept = plain.select(*docs.columns).unionByName(told.select(*docs.columns)).dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))
