"""URL rules held in a cascade of Bloom filters, exact for every key of the corpus.

A rule is a host and a path prefix.  It fits its host and all subdomains if the url's path starts with its path;
of the fitting rules the longest wins.  So a url has few candidate keys: each suffix of its host at a dot, with the first
characters of its path for each path length that rules have.

Listed keys (level 1) and, alternately, the other level's false positives go into Bloom filters until a level has
none.  The universe is every distinct candidate key of the corpus, so the answer is exact for each of them: a key that
first misses at an odd level is not listed, at an even one it is.  Looking up is an expression over a few literal
arrays; the pages are read once, never joined or shuffled.

Only built-in functions.  A level's filter has ``BITS_PER_KEY`` bits per key it holds, up to ``MOST_BITS``; beyond that,
filters let more keys through and the cascade gets more levels (at most ``MOST_LEVELS``), until the keys that are
left are few enough to be listed themselves; otherwise it refuses and asks for the rules in parts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import stored

BITS_PER_KEY, HASHES, MOST_BITS, MOST_LEVELS = 10, 4, 1 << 22, 32


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def key(self) -> str:
        return self.host + self.path


RULES = (Rule("com", "/", "allow"), Rule("example.com", "/en/", "block"), Rule("www.example.com", "/en/", "allow"),
         Rule("net", "/es/", "block"), Rule("net", "/fr/", "block"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def candidates(host: Column, path: Column, lengths: list[int]) -> Column:
    """The keys of all rules that could fit, longest first; at one length the longer host comes first.

    A host has at most 253 characters; longer ones are no valid hosts, yet all their suffixes are looked at too.
    """
    parts = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)),
                           lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))

    def with_head(n: int) -> Column:
        head = F.substring(path, 1, n)
        return F.transform(suffixes, lambda s: F.struct(
            F.length(F.concat(s, head)).alias("size"), F.length(s).alias("host_size"), F.concat(s, head).alias("key")))

    longest_first = F.reverse(F.array_sort(F.flatten(F.array(*map(with_head, lengths)))))
    return F.array_distinct(F.transform(longest_first, lambda k: k["key"]))


def _slot(key: Column, bits: int, level: int, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(level * HASHES + seed), key), F.lit(bits))


def _filter(keys: DataFrame, level: int) -> tuple[int, list[int]]:
    """Number of bits and the words of a Bloom filter over the column ``key``."""
    n = keys.count()
    bits = min(MOST_BITS, max(64, 1 << (n * BITS_PER_KEY - 1).bit_length()))
    slots = keys.select(F.explode(F.array(*(_slot(F.col("key"), bits, level, s) for s in range(HASHES)))).alias("slot"))
    words = [0] * (bits // 64)
    for row in slots.groupBy(F.expr("slot div 64").alias("word")) \
            .agg(F.expr("bit_or(shiftleft(1L, cast(slot % 64 AS int)))").alias("bits")).toLocalIterator():
        words[row["word"]] = row["bits"]
    return bits, words


def _passes(key: Column, level: int, bits: int, words: list[int]) -> Column:
    held = F.from_json(F.lit(str(words)), "array<bigint>")
    found = F.lit(True)
    for seed in range(HASHES):
        slot = _slot(key, bits, level, seed)
        word = F.get(held, F.floor(slot / 64).cast("int"))
        found = found & (F.call_function("getbit", word, F.pmod(slot, F.lit(64)).cast("int")) == 1)
    return found


@dataclass
class Cascade:
    levels: list[tuple[int, list[int]]]

    def holds(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in range(len(self.levels) - 1, -1, -1):
            answer = F.when(_passes(key, level, *self.levels[level]), answer).otherwise(F.lit(level % 2 == 1))
        return answer


def cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """Filters for the listed keys, exact over the universe; both have one column ``key`` without repeats."""
    levels: list[tuple[int, list[int]]] = []
    holds, others = listed, universe.join(listed, "key", "left_anti")
    while holds.limit(1).count():
        if len(levels) == MOST_LEVELS:
            raise ValueError("the listed keys are too many for one cascade; give the rules in parts")
        level = len(levels)
        levels.append(_filter(holds, level))
        holds, others = stored(others.where(_passes(F.col("key"), level, *levels[level])), "false-positives"), holds
    return Cascade(levels)


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, default: str = "allow") -> DataFrame:
    """``pages`` plus ``host, path, rule, verdict``, which replace columns of those names; one row for each row.

    Without a fitting rule ``rule`` is null and ``verdict`` is ``default``: a url that is not listed is not blocked.
    A null url, or one without ``://``, has an empty host and path; only a rule for an empty host would fit it.
    An empty table gives no rows; repeated rows are judged each.
    """
    spark: SparkSession = pages.sparkSession
    if len({r.key for r in rules}) < len(rules):
        raise ValueError("two rules have the same host and path")
    lengths = sorted({len(r.path) for r in rules})
    url = F.col("url").cast("string")
    keys = candidates(host_of(url), path_of(url), lengths)
    universe = stored(pages.select(F.explode(keys).alias("key")).distinct(), "keys")
    as_keys = lambda chosen: spark.sql("SELECT explode(from_json('" + _json(chosen) + "', 'array<string>')) AS key")
    listed = cascade(as_keys([r.key for r in rules]), universe)
    blocked = cascade(as_keys([r.key for r in rules if r.verdict == "block"]), universe)
    fitting = F.filter(keys, lambda k: listed.holds(k))
    rule = F.get(fitting, F.lit(0))
    return pages.withColumns({"host": host_of(url), "path": path_of(url), "rule": rule}).withColumn(
        "verdict", F.when(F.col("rule").isNull(), F.lit(default))
        .when(blocked.holds(F.col("rule")), F.lit("block")).otherwise(F.lit("allow")))


def _json(values: list[str]) -> str:
    import json

    return json.dumps(values).replace("\\", "\\\\").replace("'", "\\'")
