"""The operators as queries over the given tables, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    alignment, decontamination, fingerprints, language_id, line_dedup, lm_scoring, manifest, ngram_jaccard, packing, repeats, secrets,
    sharding, url_filter)
from millrace.llm.common import ready, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(ready(spark), sf_dir)

    prepared.__name__, prepared.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = prepared
    return prepared


@query
def op9_decontamination(spark, sf_dir):
    """Words of each document that lie in a 13-word window of a benchmark item."""
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


A_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLES["op9_decontamination"] = rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {A_Z}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {A_Z}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
sized AS (SELECT item_id, words, least(13, len(words)) AS size FROM i WHERE len(words) > 0),
item_windows AS (
  SELECT DISTINCT item_id, size, array_to_string(words[p:p + size - 1], ' ') AS w
  FROM (SELECT *, unnest(generate_series(1, len(words) - size + 1)) AS p FROM sized)),
doc_windows AS (
  SELECT doc_id, p, size, array_to_string(words[p:p + size - 1], ' ') AS w
  FROM (SELECT doc_id, words, size, unnest(generate_series(1, len(words) - size + 1)) AS p
        FROM w, (SELECT DISTINCT size FROM sized) WHERE len(words) >= size)),
met AS (SELECT doc_id, p, d.size, item_id FROM doc_windows d JOIN item_windows USING (size, w)),
covered AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
            FROM (SELECT doc_id, unnest(generate_series(p, p + size - 1)) AS pos FROM met) GROUP BY doc_id),
of_items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                    string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
             FROM met GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN of_items USING (doc_id)
"""


@query
def op10_packing(spark, sf_dir):
    """Every document's token ids in sequences of 2048."""
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op4_line_dedup(spark, sf_dir):
    """Every document without the later occurrences of repeated three-line windows."""
    out = line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"),
                      F.sha2("text", 256).alias("text_sha256"))


ORACLES["op4_line_dedup"] = r"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
windows AS (
  SELECT doc_id, p, array_to_string(lines[p:p + 2], chr(10)) AS w
  FROM (SELECT doc_id, lines, unnest(generate_series(1, len(lines) - 2)) AS p FROM l WHERE len(lines) >= 3)
  WHERE trim(lines[p] || lines[p + 1] || lines[p + 2], ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''),
ranked AS (SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id, p) AS rn FROM windows),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(p, p + 2)) AS p FROM ranked WHERE rn > 1),
removed AS (SELECT doc_id, list(p) AS gone FROM gone GROUP BY doc_id)
SELECT l.doc_id, CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN gone IS NULL THEN text ELSE coalesce(array_to_string(
         list_transform(list_filter(generate_series(1, len(lines)), lambda i: NOT list_contains(gone, i)), lambda i: lines[i]), chr(10)), '') END) AS text_sha256
FROM l LEFT JOIN removed USING (doc_id)
"""


@query
def op6_language_id(spark, sf_dir):
    """The language of every document."""
    return language_id.report(table(spark, sf_dir, "documents"))


@query
def op7_ngram_jaccard(spark, sf_dir):
    """The near-duplicate class of every document."""
    return ngram_jaccard.classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


ORACLES["op7_ngram_jaccard"] = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {A_Z}), '[^\x20\x09-\x0D]+') AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[p:p + 4], ' ') AS s
  FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(1, len(words) - 4))) AS p FROM w WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
met AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM shingles x JOIN shingles y USING (s)
        WHERE x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id),
links AS (SELECT a, b FROM met JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
          WHERE 100 * common >= 80 * (x.n + y.n - common)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM documents
          UNION SELECT reach.doc_id, ways.b FROM reach JOIN ways ON reach.other = ways.a)
SELECT reach.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN sizes ON reach.doc_id = sizes.doc_id GROUP BY reach.doc_id
"""


@query
def op3_url_filters(spark, sf_dir):
    """The rule that each page's url falls under."""
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


ORACLES["op3_url_filters"] = rf"""
WITH rules(rule, rhost, rpath, verdict) AS (VALUES
  ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
u AS (
  SELECT page_id, row_number() OVER () AS i,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), {A_Z}), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
fits AS (
  SELECT i, rule, verdict, row_number() OVER (PARTITION BY i ORDER BY length(rule) DESC) AS rn
  FROM u JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM u LEFT JOIN fits ON u.i = fits.i AND rn = 1
"""


@query
def op5_sharding(spark, sf_dir):
    """Every document's place in 24 shards of equal numbers of rows."""
    return sharding.report(table(spark, sf_dir, "documents"))


@query
def op8_fingerprints(spark, sf_dir):
    """Order MinHash fingerprints of every document, its edited text and its successor."""
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


@query
def op1_lm_scoring(spark, sf_dir):
    """The stupid-backoff score of every document under the trigram counts of all documents."""
    return lm_scoring.scores(table(spark, sf_dir, "documents"))


ORACLES["op1_lm_scoring"] = rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {A_Z}), '[^\x20\x09-\x0D]+') AS words FROM documents),
places AS (
  SELECT doc_id, p, words[p] AS c, CASE WHEN p > 1 THEN words[p - 1] END AS b, CASE WHEN p > 2 THEN words[p - 2] END AS a
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words))) AS p FROM w)),
one AS (SELECT c, count(*) AS n FROM places GROUP BY c),
two AS (SELECT b, c, count(*) AS n FROM places WHERE b IS NOT NULL GROUP BY b, c),
three AS (SELECT a, b, c, count(*) AS n FROM places WHERE a IS NOT NULL GROUP BY a, b, c),
scored AS (
  SELECT doc_id, CASE WHEN three.n IS NOT NULL THEN 3 WHEN two.n IS NOT NULL THEN 2 ELSE 1 END AS used,
    CASE WHEN three.n IS NOT NULL THEN ln(three.n) - ln(before.n)
         WHEN two.n IS NOT NULL THEN ln(two.n) - ln(previous.n) + least(p - 2, 1) * ln(0.4)
         ELSE ln(one.n) - ln((SELECT count(*) FROM places)) + least(p - 1, 2) * ln(0.4) END AS value
  FROM places JOIN one ON places.c = one.c
  LEFT JOIN two ON places.b = two.b AND places.c = two.c
  LEFT JOIN one AS previous ON places.b = previous.c
  LEFT JOIN three ON places.a = three.a AND places.b = three.b AND places.c = three.c
  LEFT JOIN two AS before ON places.a = before.b AND places.b = before.c)
SELECT w.doc_id, CAST(count(used) AS BIGINT) AS n_words, count(*) FILTER (used = 3) AS n_trigram,
       count(*) FILTER (used = 2) AS n_bigram, count(*) FILTER (used = 1) AS n_unigram,
       round(coalesce(sum(value), 0), 6) AS log_score, round(avg(value), 6) AS mean_log_score
FROM w LEFT JOIN scored ON w.doc_id = scored.doc_id GROUP BY w.doc_id
"""


@query
def op1_lm_scoring_all(spark, sf_dir):
    """The name that ``op1_lm_scoring`` had while it left out n-grams that occur once; both keep all now."""
    return lm_scoring.scores(table(spark, sf_dir, "documents"), least=1)


ORACLES["op1_lm_scoring_all"] = ORACLES["op1_lm_scoring"]


@query
def op2_suffix_array_dedup(spark, sf_dir):
    """The passages of at least 50 words in each document that occur elsewhere too."""
    return repeats.repeated_spans(table(spark, sf_dir, "documents"))


# Every window of 50 words; a word is a copy where all repeated windows over it have an earlier place.
ORACLES["op2_suffix_array_dedup"] = rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(text, {A_Z}), '[^\x20\x09-\x0D]+') AS words FROM documents WHERE doc_id IS NOT NULL),
win AS (
  SELECT doc_id, p, md5(array_to_string(words[p + 1:p + {repeats.LEAST}], ' ')) AS unit
  FROM (SELECT doc_id, words, unnest(range(len(words) - {repeats.LEAST - 1})) AS p FROM w WHERE len(words) >= {repeats.LEAST})),
ranked AS (
  SELECT doc_id, p, row_number() OVER places AS i, first_value(doc_id) OVER places AS first_doc, lead(doc_id) OVER places AS next_doc
  FROM win WINDOW places AS (PARTITION BY unit ORDER BY doc_id, p)),
shared AS (
  SELECT doc_id, p, i > 1 AS later, CASE WHEN i > 1 THEN first_doc ELSE next_doc END AS partner
  FROM ranked WHERE i > 1 OR next_doc IS NOT NULL),
covered AS (
  SELECT doc_id, word, bool_and(later) AS copy, min(partner) AS partner
  FROM (SELECT doc_id, later, partner, unnest(range(p, p + {repeats.LEAST})) AS word FROM shared) GROUP BY doc_id, word),
runs AS (SELECT *, word - row_number() OVER (PARTITION BY doc_id, copy ORDER BY word) AS run FROM covered)
SELECT doc_id, min(word) AS start_word, count(*) AS n_words, copy, min(partner) AS partner_doc_id FROM runs GROUP BY doc_id, copy, run
"""


@query
def op11_merkle_manifest(spark, sf_dir):
    """Leaf, roots and proof of every document, and what a table without some line breaks gives."""
    return manifest.report(table(spark, sf_dir, "documents"))


def _sized(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE CAST(strlen(CAST({column} AS VARCHAR)) AS VARCHAR) || ':' || {column} END"


ORACLES["op11_merkle_manifest"] = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, sha256(concat({", ".join(map(_sized, manifest.FIELDS))})) AS leaf,
    CASE WHEN 1 & xor(4294967295, list_reduce(
        list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
        lambda crc, c: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, c)), 4294967295)) = 0
      THEN replace(text, chr(10), '') ELSE text END AS lost,
    lang, n_chars, text FROM documents),
leaves AS (
  SELECT doc_id, source, leaf, sha256(concat({", ".join(_sized("lost" if c == "text" else c) for c in manifest.FIELDS)})) AS changed,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM d),
up AS (
  SELECT 0 AS level, source, idx, n, leaf AS h FROM leaves
  UNION ALL
  SELECT level + 1, source, idx // 3, CAST(ceil(max(n) / 3) AS BIGINT), sha256(string_agg(h, '' ORDER BY idx)) FROM up WHERE n > 1 GROUP BY level, source, idx // 3),
subroots AS (
  SELECT source, h, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (
  SELECT 0 AS level, idx, n, h FROM subroots
  UNION ALL
  SELECT level + 1, idx // 3, CAST(ceil(max(n) / 3) AS BIGINT), sha256(string_agg(h, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY level, idx // 3),
runs AS (SELECT level, source, idx // 3 AS run, list(h ORDER BY idx) AS hs FROM up WHERE n > 1 GROUP BY level, source, idx // 3),
top_runs AS (SELECT level, idx // 3 AS run, list(h ORDER BY idx) AS hs FROM top WHERE n > 1 GROUP BY level, idx // 3),
fold AS (
  SELECT 0 AS level, leaves.source, leaves.idx AS place, leaves.idx, changed AS h, '' AS siblings FROM leaves
  UNION ALL
  SELECT fold.level + 1, fold.source, place, run,
    sha256(array_to_string(hs[:idx % 3], '') || h || array_to_string(hs[idx % 3 + 2:], '')),
    siblings || array_to_string(hs[:idx % 3], '') || array_to_string(hs[idx % 3 + 2:], '')
  FROM fold JOIN runs ON runs.level = fold.level AND runs.source IS NOT DISTINCT FROM fold.source AND run = idx // 3),
folded AS (SELECT source, place, max_by(h, level) AS h, max_by(siblings, level) AS siblings FROM fold GROUP BY source, place),
top_fold AS (
  SELECT 0 AS level, folded.source, place, subroots.idx, folded.h, siblings FROM folded JOIN subroots ON subroots.source IS NOT DISTINCT FROM folded.source
  UNION ALL
  SELECT top_fold.level + 1, source, place, run,
    sha256(array_to_string(hs[:idx % 3], '') || h || array_to_string(hs[idx % 3 + 2:], '')),
    siblings || array_to_string(hs[:idx % 3], '') || array_to_string(hs[idx % 3 + 2:], '')
  FROM top_fold JOIN top_runs ON top_runs.level = top_fold.level AND run = idx // 3),
done AS (SELECT source, place, max_by(h, level) AS h, max_by(siblings, level) AS siblings FROM top_fold GROUP BY source, place)
SELECT doc_id, leaf, subroots.h AS subroot, root, sha256(siblings) AS proof_sha256, done.h AS folded_root, done.h = root AS verified
FROM leaves JOIN done ON done.source IS NOT DISTINCT FROM leaves.source AND done.place = leaves.idx
  JOIN subroots ON subroots.source IS NOT DISTINCT FROM leaves.source, (SELECT h AS root FROM top WHERE n = 1)
"""


@query
def op12_alignment(spark, sf_dir):
    """Every document's tokens by two tokenizers, aligned, and how common its pairs of ids are."""
    return alignment.report(table(spark, sf_dir, "documents"))


@query
def op13_secret_scan(spark, sf_dir):
    """Every document's credentials, and those that only its source holds."""
    return secrets.report(table(spark, sf_dir, "documents"))


def _found(kind: int) -> str:
    name, pattern = secrets.KINDS[kind]
    quoted = pattern.replace("'", "''")
    value = f"regexp_extract(m, '{quoted}', 2)" if name == "assign" else "m"
    good = {"assign": f"length(v) >= {secrets.LEAST_VALUE}", "opaque": "regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND "
            f"regexp_matches(v, '[A-Z]') AND len(list_distinct(string_split(v, ''))) >= {secrets.LEAST_DISTINCT}"}.get(name, "true")
    return f"""
  SELECT r, source, doc_id, {kind} AS kind, '{name}' AS name, e - length(m) AS s, e, v FROM (
    SELECT r, source, doc_id, m, {value} AS v, sum(length(gap) + length(m)) OVER (PARTITION BY r ORDER BY i) AS e FROM (
      SELECT r, source, doc_id, unnest(ms) AS m, unnest(gaps[:len(ms)]) AS gap, unnest(range(len(ms))) AS i FROM (
        SELECT r, source, doc_id, regexp_extract_all(text, '{quoted}', 0) AS ms, string_split_regex(text, '{quoted}') AS gaps FROM d)))
  WHERE {good}"""


ORACLES["op13_secret_scan"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
base AS ({" UNION ALL ".join(map(_found, range(secrets.BASE)))}),
runs AS ({_found(secrets.BASE)}),
placed AS (SELECT * FROM base UNION ALL
           SELECT * FROM runs WHERE NOT EXISTS (SELECT 1 FROM base WHERE base.r = runs.r AND base.s < runs.e AND runs.s < base.e)),
held AS (SELECT v, count(DISTINCT coalesce('=' || source, '')) AS n FROM placed GROUP BY v),
spans AS (SELECT r, kind, s, n = 1 AS live, concat_ws(':', name, CAST(s AS BIGINT), CAST(e AS BIGINT)) AS span FROM placed JOIN held USING (v))
SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
       count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied,
       sha256(coalesce(string_agg(span, ',' ORDER BY s, kind) FILTER (kind < {secrets.BASE}), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY s, kind) FILTER (kind < {secrets.BASE} OR live), '') AS spans
FROM d LEFT JOIN spans USING (r) GROUP BY r, doc_id
"""
