"""A Merkle manifest of a table: a hash per row, a tree per group, a tree over the groups, and a proof for every row.

Rows get dense ranks in their group, and a rank's base-3 digits are columns.  Inside a block of ``3 ** DIGITS`` ranks the
digits are grouped away one after the other, lowest first: what remains is one row per block that holds its subtree as nested
structs.  All these steps need one exchange, by group and block.  The blocks' hashes are the leaves of the next tier, until
each group is one block; the groups' hashes make a tree in the same way.  Proofs go down the tiers: a tier's rows are brought
together with the paths above them by one aggregation, and transforms unfold the nested structs into a row per child.

No row ever holds more than one block, whatever a group's share of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from millrace.llm.common import stored

ARITY, DIGITS = 3, 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "struct<left: string, right: string>"


def hashed(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts put together."""
    return F.sha2(F.concat(*parts), 256)


def leaf(fields: Sequence[Column]) -> Column:
    """Hash of a row: each field as its length in bytes, a colon and itself; ``-`` for a null."""
    text = [f.cast("string") for f in fields]
    return hashed(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text])


def levels_of(n: str) -> Column:
    """Levels of a tree over n leaves: rounds until one node remains."""
    return F.expr("+".join(f"int({n} > {ARITY ** k})" for k in range(40) if ARITY ** k < 1 << 62))


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``idx``, the dense rank from 0 in the text column ``group``, and ``levels``, the height of the group's tree.

    One exchange by ranges of (group, order) cuts a hot group and repeated values alike, as ``order`` ends in a number that is
    different in each row; then the ranges' counts, a row per range and group, say where each range begins.
    """
    by = ["group", *order]
    placed = stored(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("place", 33)
    sizes = placed.groupBy("group", part.alias("part")).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
    earlier = W.partitionBy("group").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("group", "part", (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
                          F.sum("rows").over(W.partitionBy("group")).alias("n"))
    return placed.withColumn("part", part).join(starts, ["group", "part"]) \
        .withColumn("idx", F.col("place") + F.col("shift")).withColumn("levels", levels_of("n")).drop("place", "shift", "part", "n")


def _blocks(nodes: DataFrame, tier: int, n_digits: int) -> DataFrame:
    """``group, levels, block, hash, kids``: nodes (group, levels, idx, hash, load) rolled up to one nested row per block."""
    digits = [f"d{k}" for k in range(n_digits)]
    out = nodes.select("group", "levels", F.expr(f"idx div {ARITY ** n_digits}").alias("block"), "hash", "load",
                       *[F.expr(f"cast(idx div {ARITY ** k} % {ARITY} AS tinyint)").alias(d) for k, d in enumerate(digits)]) \
        .repartition("group", "block")
    own = ["hash", "load"]
    for k, digit in enumerate(digits):
        out = out.groupBy("group", "levels", "block", *digits[k + 1:]).agg(F.sort_array(F.collect_list(F.struct(digit, *own))).alias("kids"))
        # Above the group's root there is one node, which stays as it is.
        real = F.col("levels") > tier * n_digits + k
        out = out.withColumn("hash", F.when(real, F.sha2(F.concat_ws("", F.transform("kids", lambda x: x["hash"])), 256))
                             .otherwise(F.col("kids")[0]["hash"]))
        own = ["hash", "kids"]
    return out


def _unfolded(kids: Column, path: Column, levels: Column, below: int, k: int) -> Column:
    """Array of (load, hash, path) of all lowest nodes; a path is the hashes left and right of the node, level by level upwards."""
    hashes = F.transform(kids, lambda x: x["hash"])

    def child(x: Column, i: Column) -> Column:
        step = F.struct(F.concat_ws("", F.slice(hashes, F.lit(1), i)).alias("left"),
                        F.concat_ws("", F.slice(hashes, i + 2, F.lit(ARITY))).alias("right"))
        # The path stands in the expression once, so that its size follows the number of levels.
        own = F.concat(F.filter(F.array(step), lambda _: levels > below + k), path)
        if k == 0:
            return F.array(F.struct(x["load"].alias("load"), x["hash"].alias("hash"), own.alias("path")))
        return _unfolded(x["kids"], own, levels, below, k - 1)

    return F.flatten(F.transform(kids, child))


def _up(leaves: DataFrame, label: str, digits: int) -> list[DataFrame]:
    """The tiers over nodes (group, levels, idx, hash, load); the last one has a row per group, and an empty table none."""
    most = leaves.agg(F.max("levels")).first()[0]
    tiers, nodes = [], leaves
    while most is not None and (not tiers or digits * len(tiers) < most):
        tiers.append(stored(_blocks(nodes, len(tiers), digits), f"{label}-{len(tiers)}"))
        nodes = tiers[-1].select("group", "levels", F.col("block").alias("idx"), "hash", F.col("block").alias("load"))
    return tiers


def _down(tiers: list[DataFrame], tops: DataFrame, carried: Sequence[str], digits: int) -> DataFrame:
    """``group, load, hash, path`` and ``carried`` of every leaf; ``tops`` (group, path, carried) are the paths above the groups."""
    paths = tops.withColumn("block", F.lit(0).cast("long"))
    for tier in reversed(range(len(tiers))):
        rows = tiers[tier].select("group", "block", "levels", "kids")
        both = rows.unionByName(paths.select("group", "block", "path", *carried), allowMissingColumns=True)
        met = both.groupBy("group", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("levels", "kids", "path", *carried)])
        found = F.explode(_unfolded(F.col("kids"), F.col("path"), F.col("levels"), tier * digits, digits - 1)).alias("x")
        out = met.select("group", *carried, found).select("group", *carried, "x.load", "x.hash", "x.path")
        if tier:
            paths = out.select("group", F.col("load").alias("block"), "path", *carried)
    return out


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and the hashes beside its path give."""
    return F.aggregate(path, start, lambda own, step: hashed(step["left"], own, step["right"]))


RESULT = f"doc_id long, leaf string, other_leaf string, subroot string, root string, path array<{STEP}>"


def proofs(docs: DataFrame, group_by: str = "source", fields: Sequence[str] = FIELDS, other: dict[str, Column] | None = None,
           digits: int = DIGITS) -> DataFrame:
    """Leaf, roots and proof of every row: the table's manifest.

    ``other`` gives changed versions of some fields; ``other_leaf`` is the row's hash with these, null where equal to ``leaf``.
    Rows of a group (the text of ``group_by``; null is a group, the first) ascend by ``doc_id`` (null first), equal ones by leaf; rows that are
    equal in all fields have equal leaves and each a place.  ``path`` holds the hashes left and right of the row, from its leaf up to
    the root; levels above a lone node have no entry.  Needs ``doc_id`` and the fields; other columns are ignored.  An empty
    table gives no rows.
    """
    def of(changes: dict[str, Column]) -> Column:
        return leaf([changes.get(c, F.col(c)) for c in fields])

    key = F.col(group_by).cast("string")
    leaves = docs.select(
        F.when(key.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), key)).alias("group"),
        F.col("doc_id").cast("long").alias("doc_id"), of({}).alias("leaf"), of(other or {}).alias("changed"), F.monotonically_increasing_id().alias("row"))
    # The row number is stored: ranges are the same when a task is repeated.
    leaves = stored(leaves.withColumn("other_leaf", F.when(F.col("changed") != F.col("leaf"), F.col("changed"))).drop("changed"), "leaves")
    placed = stored(ranked(leaves, ["doc_id", "leaf", "row"]), "placed")
    spark = docs.sparkSession
    tiers = _up(placed.select("group", "levels", "idx", F.col("leaf").alias("hash"), F.struct("doc_id", "other_leaf").alias("load")), "tier", digits)
    if not tiers:
        return spark.createDataFrame([], RESULT)
    # The groups are the leaves of one more tree.
    groups = tiers[-1].select(F.lit("").alias("group"), F.col("group").alias("load"), "hash")
    top = stored(ranked(groups, ["load"]), "groups")
    top_tiers = _up(top, "top", digits)
    root = top_tiers[-1].select("group", F.col("hash").alias("root"), F.expr(f"cast(array() AS array<{STEP}>)").alias("path"))
    of_groups = _down(top_tiers, root, ["root"], digits)
    tops = stored(of_groups.select(F.col("load").alias("group"), "root", F.col("hash").alias("subroot"), "path"), "tops")
    return _down(tiers, tops, ["root", "subroot"], digits).select(
        "load.doc_id", F.col("hash").alias("leaf"), "load.other_leaf", "subroot", "root", "path")


def report(docs: DataFrame, digits: int = DIGITS) -> DataFrame:
    """The manifest of ``documents`` checked against a table where every second doc_id's text has lost its line breaks.

    ``folded_root`` is what the row, changed where its doc_id says so, and the original hashes beside it give; ``verified`` tells whether
    that is the root.  A null doc_id is not changed; a text without line breaks stays equal, so it is verified.
    """
    lost = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 2 == 0
    text = F.when(lost, F.regexp_replace("text", "\n", "")).otherwise(F.col("text"))
    found = proofs(docs, other={"text": text}, digits=digits)
    siblings = F.concat_ws("", F.transform("path", lambda s: F.concat(s["left"], s["right"])))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
                        folded(F.coalesce("other_leaf", "leaf"), F.col("path")).alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))
