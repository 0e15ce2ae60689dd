"""Credentials in texts, and how widely each is copied over repositories and owners.

Each kind is a pattern.  Splitting a text at a pattern gives the gaps between the matches, so the lengths of gaps and matches add up to places.
Texts are read once; what follows are rows of hashes.  A candidate's hash is counted by distinct repositories and owners over the
whole corpus: one that several owners hold is an example that was copied, one that a single owner holds looks live.
Base kinds are always reported; an ``opaque`` run outside them, which is no credential by its form alone, only where it looks live.

Built-in functions only.  A hash that a third of all rows hold is counted from distinct (hash, owner, repository) rows, and the
counts come back over a salted join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from millrace.llm.common import stored


def either_case(word: str) -> str:
    """A pattern for the word with ASCII letters in either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# Fixed values.
NAMES = "|".join(map(either_case, ("password", "passwd", "secret", "token"))) + "|" + either_case("api") + "_?" + either_case("key")
ASSIGN = rf"({NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
#: A run of 16 characters that starts so; a shorter one holds no longer one.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: Not base: a long run of letters and digits, as keys in base 64 are.
OPAQUE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
KINDS = (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("opaque", OPAQUE))
LEAST_VALUE, LEAST_DISTINCT, BASE = 8, 10, 3
#: Copies of the counts and parts of the candidates in the join.
SALT = 16

MATCH = "array<struct<kind: int, i: int, gap: int, size: int, good: boolean, key: string>>"


def live_looking(value: Column) -> Column:
    """An opaque run with a digit, both cases and at least ``LEAST_DISTINCT`` different characters."""
    return value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]") \
        & (F.size(F.array_distinct(F.split(value, ""))) >= LEAST_DISTINCT)


def _matches(text: Column, kind: int) -> Column:
    """All matches of a kind in order: the gap before each, its size, whether it passes, its value's hash."""
    name, pattern = KINDS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def one(gap: Column, match: Column) -> Column:
        value = F.regexp_extract(match, pattern, 2) if name == "assign" else match
        good = F.length(value) >= LEAST_VALUE if name == "assign" else live_looking(value) if name == "opaque" else F.lit(True)
        return F.struct(F.length(gap).alias("gap"), F.length(match).alias("size"), good.alias("good"), F.sha2(value, 256).alias("key"))

    paired = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found, one)
    numbered = F.transform(paired, lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), x["gap"].alias("gap"), x["size"].alias("size"), x["good"].alias("good"), x["key"].alias("key")))
    return F.when(text.rlike(pattern), numbered).otherwise(F.lit(None).cast(MATCH))


def _spans(docs: DataFrame, repository: str, owner: str) -> tuple[DataFrame, DataFrame]:
    """All rows, numbered (``row, doc_id, any``), and the spans of all candidates in them."""
    text = F.col("__text")
    seen = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col(repository).cast("string").alias("repository"), F.col(owner).cast("string").alias("owner"), F.col("text").cast("string").alias("__text"))
    found = F.flatten(F.array_compact(F.array(*[_matches(text, k) for k in range(len(KINDS))])))
    seen = stored(seen.select("row", "doc_id", "repository", "owner", found.alias("found")), "matches")
    rows = seen.select("row", "doc_id", (F.size("found") > 0).alias("any"))
    so_far = W.partitionBy("row", "kind").orderBy("i")
    placed = seen.where(F.size("found") > 0).select("row", "repository", "owner", F.explode("found").alias("m")) \
        .select("row", "repository", "owner", "m.*").withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far)) \
        .withColumn("start", F.col("end") - F.col("size")).where("good")
    # An opaque run counts outside the base spans: none begins before it and ends in it, none begins in it.
    base = F.col("kind") < BASE
    order = W.partitionBy("row").orderBy("start", "kind")
    behind = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(W.unboundedPreceding, 0))
    ahead = F.min(F.when(base, F.col("start"))).over(order.rowsBetween(0, W.unboundedFollowing))
    free = (F.coalesce(behind, F.lit(0)) <= F.col("start")) & (F.coalesce(ahead, F.col("end")) >= F.col("end"))
    spans = placed.withColumn("free", free).where(base | F.col("free")).select("row", "repository", "owner", "kind", "start", "end", "key")
    return rows, stored(spans, "spans")


def ownership(spans: DataFrame) -> DataFrame:
    """``key, n_owners, n_repositories``: how widely each value is held.  Rows without owner are one owner's."""
    held = spans.select("key", "owner", "repository").distinct()
    of_owner = held.groupBy("key", "owner").agg(F.count(F.lit(1)).alias("n"))
    return of_owner.groupBy("key").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_repositories"))


def candidates(docs: DataFrame, repository: str = "doc_id", owner: str = "source", most_owners: int = 1) -> tuple[DataFrame, DataFrame]:
    """All rows (``row, doc_id, any``) and, by ``row``, each candidate's ``kind, start, end, key, n_owners, n_repositories, live``."""
    rows, spans = _spans(docs, repository, owner)
    counts = ownership(spans).withColumn("live", F.col("n_owners") <= most_owners) \
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)).cast("array<int>")))
    met = spans.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALT)).cast("int")).join(counts, ["key", "salt"]).drop("salt")
    return rows, met


REPORT = "doc_id long, n_assign long, n_access long, n_hex long, n_live long, n_copied long, base_sha256 string, spans string"


def report(docs: DataFrame, repository: str = "doc_id", owner: str = "source", most_owners: int = 1) -> DataFrame:
    """One row per row of ``docs``: base spans by kind, their digest, and all spans that are reported.

    ``n_live`` counts reported spans whose value at most ``most_owners`` owners hold, ``n_copied`` the other candidates, opaque ones included.
    Spans are in code points, by start and then kind.  A null text is empty; a null ``doc_id`` or owner is kept as a value;
    repeated rows are reported each and count once for their repository.  Needs ``doc_id``, ``text`` and the two columns named;
    other columns are ignored.  An empty table gives no rows.
    """
    rows, met = candidates(docs, repository, owner, most_owners)
    of_row = met.groupBy("row").agg(
        F.sort_array(F.collect_list(F.when((F.col("kind") < BASE) | F.col("live"), F.struct("start", "kind", "end")))).alias("all"),
        *[F.sum((F.col("kind") == k).cast("long")).alias(f"n_{KINDS[k][0]}") for k in range(BASE)],
        F.sum(F.col("live").cast("long")).alias("n_live"), F.sum((~F.col("live")).cast("long")).alias("n_copied"))
    names = F.array(*[F.lit(name) for name, _ in KINDS])

    def joined(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))

    numbers = ["n_assign", "n_access", "n_hex", "n_live", "n_copied"]
    with_any = rows.where("any").join(of_row, "row", "left").select(
        "doc_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers],
        F.sha2(F.coalesce(joined(F.filter("all", lambda s: s["kind"] < BASE)), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(joined(F.col("all")), F.lit("")).alias("spans"))
    none = rows.where("NOT any").select(
        "doc_id", *[F.lit(0).cast("long").alias(c) for c in numbers], F.sha2(F.lit(""), 256).alias("base_sha256"), F.lit("").alias("spans"))
    return with_any.unionByName(none)
