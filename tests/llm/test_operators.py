"""Each operator against a brute-force version, and on nulls, empty tables, long texts, ties and repeated rows."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import (
    components, decontamination, fingerprints, language_id, line_dedup, lm_scoring, ngram_jaccard, packing, repeats, sharding, url_filter)
from millrace.llm.common import stored
from millrace.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import ODD

SF = "/root/testdata/sf0.001"


def words(text):
    return (text or "").encode().lower().split()


def sentence(rng, n):
    return " ".join(rng.choice("abcdefghij") + rng.choice("klmnop") + str(rng.randrange(40)) for _ in range(n))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(llm, name):
    import duckdb
    duck = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df, want = QUERIES[name](llm, SF), duck.sql(ORACLES[name])
    order = sorted(df.columns)
    assert order == sorted(want.columns)
    plain = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    bag = lambda names, data: Counter(tuple(plain(r[names.index(c)]) for c in order) for r in data)
    assert bag(df.columns, [tuple(r) for r in df.collect()]) == bag(want.columns, want.fetchall())


# ---- LM scoring

@pytest.mark.parametrize("least", [1, 2])
def test_lm_scores_follow_the_counts(make, least):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randrange(0, 30))) for _ in range(40)]
    counts = [Counter() for _ in range(4)]
    for t in texts:
        w = words(t)
        for n in (1, 2, 3):
            counts[n].update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    total = sum(counts[1].values())

    def score(gram):
        n = len(gram)
        if n == 1:
            return math.log(counts[1][gram] / total)
        if counts[n][gram] >= least:
            return math.log(counts[n][gram] / counts[n - 1][gram[:-1]])
        return math.log(0.4) + score(gram[1:])

    got = {r.doc_id: r for r in lm_scoring.scores(make(list(enumerate(texts))), least).collect()}
    for i, t in enumerate(texts):
        w = words(t)
        want = sum(score(tuple(w[max(0, p - 2):p + 1])) for p in range(len(w)))
        assert got[i].n_words == len(w) and abs(got[i].log_score - want) < 1e-5
        assert got[i].n_trigram + got[i].n_bigram + got[i].n_unigram == len(w)


def test_all_counts_are_kept(llm):
    assert all("HAVING" not in ORACLES[name] for name in ORACLES if name.startswith("op1_"))
    used = QUERIES["op1_lm_scoring_all"](llm, SF).agg(*(F.sum(c) for c in ("n_words", "n_trigram", "n_bigram", "n_unigram"))).first()
    docs = [words(r.text) for r in llm.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    want = [sum(map(len, docs)), *(sum(f(len(w)) for w in docs) for f in (lambda n: max(n - 2, 0), lambda n: n >= 2, lambda n: n >= 1))]
    assert list(used) == want


@pytest.mark.parametrize("words_in_corpus", [0, 1, 1000, 10**6, 10**9, 10**14])
def test_lm_keys_and_counts_are_packed_without_loss(words_in_corpus):
    layout, rng = lm_scoring.Layout(words_in_corpus), np.random.default_rng(1)
    for size in (1, 2, 7, 8, 255, 256, 5000):
        keys = np.unique(rng.integers(0, 1 << min(layout.width, 62), size).astype(np.uint64))
        in_part = keys | np.uint64(3 << layout.width)
        assert (layout.unpacked(layout.packed(in_part), keys.size) == keys).all() and (layout.part(in_part) == 3).all()
        counts = rng.integers(0, 2, size) * rng.integers(0, 10**rng.integers(1, 12), size)
        assert (lm_scoring._counts(lm_scoring._packed_counts(counts), size) == counts).all()


def test_lm_repeated_rows_in_many_blocks(make, monkeypatch):
    monkeypatch.setattr(lm_scoring, "BLOCK_WORDS", 50)
    rows = [(1, "a b c a b d")] * 60 + [(i, f"a b c w{i} w{i + 1}") for i in range(2, 40)]
    counts = Counter(tuple(w[i:i + n]) for _, t in rows for w in [t.split()] for n in (1, 2, 3) for i in range(len(w) - n + 1))
    total = sum(c for gram, c in counts.items() if len(gram) == 1)
    got = lm_scoring.scores(make(rows).repartition(4)).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        w = texts[r.doc_id].split()
        want = sum(math.log(counts[g] / (counts[g[:-1]] if g[1:] else total)) for p in range(len(w)) for g in [tuple(w[max(0, p - 2):p + 1])])
        assert abs(r.log_score - want) < 1e-5


def test_lm_odd_rows(make):
    got = lm_scoring.scores(make(ODD)).collect()
    assert len(got) == len(ODD)
    assert all((r.n_words == 0) == (r.mean_log_score is None) and (r.n_words > 0 or r.log_score == 0) for r in got)
    assert lm_scoring.scores(make([])).count() == 0


# ---- repeated passages

def spans_by_force(texts, least=50):
    held = {i: words(t) for i, t in texts}
    seen = Counter(tuple(w[p:p + least]) for w in held.values() for p in range(len(w) - least + 1))
    out = set()
    for i, w in held.items():
        cover = np.zeros(len(w) + 1, bool)
        for p in range(len(w) - least + 1):
            if seen[tuple(w[p:p + least])] > 1:
                cover[p:p + least] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], cover]).astype(int)))
        out |= {(i, int(a), int(b - a)) for a, b in zip(edges[::2], edges[1::2])}
    return out


def test_repeated_passages(make):
    rng = random.Random(2)
    passages = [sentence(rng, n) for n in (49, 50, 51, 80, 200)]
    texts = [(i, " ".join([sentence(rng, rng.randrange(90)), rng.choice(passages), sentence(rng, rng.randrange(90))])) for i in range(60)]
    texts += [(100, texts[0][1]), (101, texts[0][1]), (102, " ".join([passages[3]] * 2)), (103, sentence(rng, 300))]
    got = repeats.repeated_spans(make(texts)).collect()
    assert {(r.doc_id, r.start_word, r.n_words) for r in got} == spans_by_force(texts)
    first = min(r.doc_id for r in got if not r.copy)
    assert first == min(r.doc_id for r in got)
    assert all(r.copy for r in got if r.doc_id in (100, 101))


def test_nested_passages_in_a_hot_group(make):
    rng = random.Random(12)
    hot = sentence(rng, 46)
    texts = [(i, " ".join([sentence(rng, 30), hot, sentence(rng, 30)])) for i in range(400)]
    sides = [(sentence(rng, a), sentence(rng, b)) for a, b in ((4, 0), (0, 4), (2, 2), (3, 1), (1, 3)) for _ in range(8)]
    for j, (left, right) in enumerate(sides):
        texts += [(1000 + 10 * j + c, " ".join([sentence(rng, 30), left, hot, right, sentence(rng, 30)])) for c in (0, 1)]
    left, right = sentence(rng, 2), sentence(rng, 2)
    texts += [(3000 + i, " ".join([sentence(rng, 30), left, hot, sentence(rng, 30)])) for i in range(40)]
    texts += [(4000 + i, " ".join([sentence(rng, 30), hot, right, sentence(rng, 30)])) for i in range(40)]
    texts += [(5000 + i, " ".join([sentence(rng, 30), left, hot, right, sentence(rng, 30)])) for i in (0, 1)]
    got = repeats.repeated_spans(make(texts)).collect()
    assert {(r.doc_id, r.start_word, r.n_words) for r in got} == spans_by_force(texts)


def test_each_place_is_one_row(make):
    rng = random.Random(15)
    passage = sentence(rng, 90)
    texts = [(i, " ".join([sentence(rng, 20), passage, sentence(rng, 20)])) for i in range(300)]
    docs = repeats.prepared(make(texts))
    found = repeats.places(docs, 50)
    assert found.count() == found.select("unit", "doc_id", "spot").distinct().count()
    met = found.where("later").select(F.col("first_doc").alias("doc_id"), repeats._key("first_spot").alias("key"),
                                            repeats._at("first_spot").alias("at"))
    assert met.count() > 299 and repeats._contexts(docs, met).count() == met.distinct().count()


def test_matches_are_maximal(make):
    rng = random.Random(13)
    hot, left, right = sentence(rng, 300), sentence(rng, 15), sentence(rng, 15)
    texts = [(i, " ".join([sentence(rng, 30), hot, sentence(rng, 30)])) for i in range(3)]
    texts += [(i, " ".join([sentence(rng, 30), left, hot, right, sentence(rng, 30)])) for i in (10, 11)]
    held = {i: words(t) for i, t in texts}
    got = repeats.matches(make(texts)).collect()
    for r in got:
        a, b = held[r.a_doc], held[r.b_doc]
        assert a[r.a_start:r.a_start + r.n_words] == b[r.b_start:r.b_start + r.n_words]
        assert a[r.a_start - 1] != b[r.b_start - 1] and a[r.a_start + r.n_words] != b[r.b_start + r.n_words]
    assert (10, 30, 11, 30, 330) in {tuple(r) for r in got}


def test_removing_copies_keeps_one_of_each(make):
    rng = random.Random(14)
    x, y, z, p1, p2 = (sentence(rng, n) for n in (30, 40, 30, 60, 60))
    texts = [(1, p2), (5, f"{p2} {p1}"), (9, p1), (11, f"{x} {y}"), (15, f"{x} {y} {z}"), (19, f"{y} {z}"), (20, f"{x} {y} {z} {p1}")]
    got = repeats.repeated_spans(make(texts)).collect()
    assert {(r.start_word, r.n_words, r.copy, r.partner_doc_id) for r in got if r.doc_id == 5} == {(0, 60, True, 1), (60, 60, False, 9)}
    left = []
    for i, t in texts:
        w = words(t)
        for r in got:
            if r.doc_id == i and r.copy:
                w[r.start_word:r.start_word + r.n_words] = [None] * r.n_words
        left.append(w)
    windows = lambda w: [tuple(w[p:p + 50]) for p in range(len(w) - 49)]
    held = Counter(v for _, t in texts for v in windows(words(t)))
    kept = Counter(v for w in left for v in windows(w))
    assert all(kept[v] == 1 for v, n in held.items() if n > 1)


@pytest.mark.parametrize("chunk", [1, 2, 7, 1000])
def test_neighbours_across_ranges(monkeypatch, chunk):
    """Runs over many ranges, runs that end a range with one row, repeated rows."""
    monkeypatch.setattr(repeats, "UNITS", chunk)
    rng = random.Random(chunk)
    for _ in range(150):
        rows = sorted((rng.randrange(4), rng.randrange(2), rng.randrange(5), rng.randrange(6), 1) for _ in range(rng.randrange(1, 40)))
        cuts = sorted(rng.randrange(len(rows) + 1) for _ in range(rng.randrange(5)))
        out = []
        for a, b in zip([0, *cuts], [*cuts, len(rows)]):
            batches = [pa.RecordBatch.from_pylist([dict(zip(repeats.IN_ORDER, r)) for r in rows[i:min(b, i + 3)]]) for i in range(a, b, 3)]
            out += [tuple(r.values()) for batch in repeats.neighbours(iter(batches)) for r in batch.to_pylist()]
        edges = defaultdict(set)
        for r in out:
            if r[8] == repeats.EDGE:
                edges[r[:2]].add(r[2:4])
        got = {r[:8] for r in out if r[8] == repeats.SETTLED}
        for r in (r for r in out if r[8] == repeats.OPEN):
            two = sorted(edges[r[:2]])[:2]
            if len(two) > 1:
                got.add((*r[:5], *two[0], two[1][0]))
        runs = defaultdict(set)
        for r in rows:
            runs[r[:2]].add(r[2:4])
        want = {(*u, *place, 1, *sorted(held)[0], sorted(held)[1][0]) for u, held in runs.items() if len(held) > 1 for place in held}
        assert got == want


def test_hot_runs_over_many_tasks(llm, make):
    rng = random.Random(16)
    hot = sentence(rng, 70)
    own = lambda i: " ".join(f"own{i}x{j}" for j in range(25))
    texts = [(i, " ".join([own(i), hot, own(-i - 1)])) for i in range(900)]
    llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = repeats.repeated_spans(make(texts)).collect()
    finally:
        llm.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {tuple(r) for r in got} == {(i, 25, 70, i > 0, int(i == 0)) for i in range(900)}


def test_repeats_odd_rows(make):
    assert {r.doc_id for r in repeats.repeated_spans(make(ODD)).collect()} <= {6}
    assert repeats.repeated_spans(make([])).count() == 0


# ---- URL rules

def test_url_rules(llm):
    urls = [None, "", "no scheme", "http://com", "http://COM/", "https://Example.com/en", "https://example.com/en/x?y", "x://www.example.com/en/1",
            "x://a.www.example.com/en/1", "x://badexample.com/en/", "x://example.com.net/es/1", "x://net/fr/", "x://net#/fr/", "x://com?/",
            "http://a://b.net/es/", "x://m.net/ES/", "x:///en/", "http://net/es/\nx"] * 2
    rules = {r.key: r for r in url_filter.RULES}

    def judge(url):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
            host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
            path = rest[end:]
            path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
        fit = [r for r in rules.values() if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fit, key=lambda r: len(r.key)) if fit else None
        return host, path, best and best.key, best.verdict if best else "allow"

    pages = llm.createDataFrame([(i, u, "mine", "mine") for i, u in enumerate(urls)], "page_id long, url string, key string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages).collect()}
    assert got == {i: judge(u) for i, u in enumerate(urls)}
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_cascade_is_exact_over_its_universe(llm, monkeypatch):
    monkeypatch.setattr(url_filter, "BITS_PER_KEY", 1)  # many false positives, so several levels
    keys = llm.range(4000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    listed = keys.where(F.crc32(F.col("key").cast("binary")) % 7 == 0)
    built = url_filter.cascade(listed, keys)
    assert len(built.levels) > 2
    wrong = keys.where(built.holds(F.col("key")) != (F.crc32(F.col("key").cast("binary")) % 7 == 0))
    assert wrong.count() == 0


# ---- line dedup

def lines_by_force(texts):
    seen, out = set(), {}
    for i, t in sorted(texts):
        lines = t.split("\n")
        gone, own = set(), []
        for p in range(len(lines) - 2):
            w = tuple(lines[p:p + 3])
            if not "".join(w).strip(" \t\r\x0b\x0c"):
                continue
            if w in seen:
                gone |= {p, p + 1, p + 2}
            seen.add(w)
        out[i] = "\n".join(x for p, x in enumerate(lines) if p not in gone) if gone else t
        del own
    return out


def test_line_dedup(make):
    rng = random.Random(3)
    texts = [(i, "\n".join(rng.choice("abc ") for _ in range(rng.randrange(0, 14)))) for i in range(60)]
    got = {r.doc_id: r.text for r in line_dedup.dedup(make(texts)).collect()}
    assert got == lines_by_force(texts)


def test_line_dedup_of_a_long_text(make):
    """Time in proportion to the lines, where half of them go."""
    block = [f"line {i}" for i in range(60_000)]
    texts = [(1, "\n".join(block)), (2, "\n".join([*block, "own", "lines"])), (3, "\n".join(["first", *block]))]
    got = {r.doc_id: r.text for r in line_dedup.dedup(make(texts)).collect()}
    assert got == {1: texts[0][1], 2: "own\nlines", 3: "first"}


def test_line_dedup_odd_rows(make):
    got = line_dedup.dedup(make(ODD + [(20, "a\nb\nc\nd"), (20, "a\nb\nc\nd"), (21, "x\na\nb\nc"), (None, "a\nb\nc")])).collect()
    assert len(got) == len(ODD) + 4
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert [r.text for r in by[20]] == ["a\nb\nc\nd"] * 2 and by[21][0].text == "x" and by[1][0].text is None
    assert "" in [r.text for r in by[None]] and by[21][0].removed == [1, 2, 3] and by[21][0].key == "mine"
    assert line_dedup.dedup(make([])).count() == 0


# ---- sharding

def test_hypergeometric_has_the_right_moments():
    rng = np.random.default_rng(5)
    for good, bad, draws in ((30, 70, 20), (5, 5, 10), (10**12, 3 * 10**12, 10**9)):
        x = np.array([sharding.hypergeometric(rng, good, bad, draws) for _ in range(2000)], float)
        total, p = good + bad, good / (good + bad)
        sd = math.sqrt(draws * p * (1 - p) * (total - draws) / (total - 1))
        assert abs(x.mean() - draws * p) <= 4 * sd / math.sqrt(2000) + 1e-9 and abs(x.std() - sd) <= 0.1 * sd + 1e-9


def test_matrix_has_its_margins():
    matrix = np.array(sharding.communication_matrix([5, 0, 100, 7], [28, 28, 28, 28]))
    assert matrix.sum(1).tolist() == [5, 0, 100, 7] and matrix.sum(0).tolist() == [28] * 4


@pytest.mark.parametrize("n", [0, 5, 1000])
def test_shards_are_even_and_slots_gapless(make, n):
    docs = make([(i, f"text {i % 300}") for i in range(n)] + ODD * (n > 0))
    got = sharding.report(docs).collect()
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert len(got) == docs.count() and all(sorted(s) == list(range(len(s))) for s in by.values())
    sizes = [len(by.get(s, [])) for s in range(24)]
    assert max(sizes) - min(sizes) <= 1
    assert {(r.doc_id, r.size, r.text_crc32) for r in got} == {
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in [(r.doc_id, r.text) for r in docs.collect()]}
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, sharding.report(docs.repartition(7)).collect()), key=str)


# ---- language ID

def test_languages_of_held_out_documents(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    got = language_id.report(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.lang == r.lang_pred for r in out) >= 0.95 * len(out) and sum(r.rejected for r in got) <= 0.02 * len(got)
    assert all(0 <= r.score <= 1 for r in got)
    # Neither labels of held-out rows nor the partitioning matter.
    changed = docs.withColumn("lang", F.when(language_id.held_out(), "xx").otherwise(F.col("lang"))).repartition(5)
    assert {tuple(r) for r in language_id.report(changed).collect()} == {tuple(r)[:5] for r in got}


def test_language_odd_rows(llm, make):
    model = language_id.fit(llm.read.parquet(f"{SF}/documents.parquet"))
    got = language_id.predict(make(ODD + [(30, "123 !!! 456")]), model).collect()
    assert len(got) == len(ODD) + 1
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and r.rejected >= (not letters) and r.key == "mine"
    assert {r.lang_pred for r in language_id.predict(make(ODD), language_id.fit(make([]))).collect()} == {"und"}
    assert language_id.predict(make([]), model).count() == 0


def test_sample_is_bounded_where_a_doc_id_repeats(make, monkeypatch):
    seen = []
    train = language_id.train
    monkeypatch.setattr(language_id, "train", lambda counts, lang, *rest: seen.append(len(lang)) or train(counts, lang, *rest))
    one = next(i for i in range(9) if zlib.crc32(str(i).encode()) % 4 != 2)
    language_id.fit(make([(one, f"some text {'abcdefghij'[i % 10] * (1 + i)}") for i in range(40)]), per_language=10)
    language_id.fit(make([(one, "the same text")] * 40), per_language=10)
    assert seen == [10, 1]


def test_long_texts_count_like_short_ones(monkeypatch):
    text = "Der schnelle  braune Fuchs, 12 springt! " * 50
    whole = language_id.subwords(text)
    monkeypatch.setattr(language_id, "BLOCK", 37)
    assert (language_id.subwords(text) == whole).all()


# ---- n-gram Jaccard join

def components_by_force(texts):
    sets = {}
    for i, t in texts:
        w = words(t)
        sets[i] = {tuple(w[p:p + 5]) for p in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("block", [2048, 7])
def test_components_match_all_pairs(make, monkeypatch, block):
    monkeypatch.setattr(ngram_jaccard, "BLOCK", block)
    rng = random.Random(4)
    texts = []
    for base in range(3):
        original = sentence(rng, 120).split()
        for _ in range(40):  # near copies around the threshold, with a shared passage in all groups
            w = list(original)
            for _ in range(rng.randrange(8)):
                w[rng.randrange(len(w))] = "x" + str(rng.randrange(10**6))
            texts.append((len(texts), " ".join(w)))
    passage = sentence(rng, 60)
    texts += [(200 + i, passage + " " + sentence(rng, rng.randrange(100))) for i in range(25)]
    texts += [(300 + i, "short " * i) for i in range(8)] + [(400, texts[0][1]), (401, texts[0][1].upper()), (402, "a b c"), (403, "A  b\nc")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard.classes(make(texts)).collect()}
    assert got == components_by_force(texts)


def test_jaccard_odd_rows(make):
    got = ngram_jaccard.classes(make(ODD)).collect()
    assert len(got) == len(ODD)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} >= {(1, 0, 1), (2, 0, 2), (3, 0, 3), (7, 1, 7), (10, 1, 7), (None, 0, None)}
    kept = ngram_jaccard.one_of_each(make(ODD)).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(map(str, [1, 2, 3, 4, 5, 6, 7, 9, None, None]))
    assert ngram_jaccard.classes(make([])).count() == 0 and ngram_jaccard.one_of_each(make([])).count() == 0


def test_the_row_that_is_no_copy_stays(make):
    rng = random.Random(16)
    texts = [(i, sentence(rng, 60)) for i in range(20)]
    clean = [(i, sentence(rng, 60)) for i in range(100, 120)]
    rows = texts + [(100 + i, t) for i, t in texts] + clean
    for order in (rows, rows[::-1]):
        kept = ngram_jaccard.one_of_each(make(order).coalesce(1)).collect()
        assert sorted((r.doc_id, r.text) for r in kept) == sorted(texts + clean)


def test_components_of_stars_take_no_round(llm, monkeypatch):
    steps = []
    monkeypatch.setattr(components, "stored", lambda df, label: steps.append(label) or stored(df, label))
    stars, chain = [(1, 5), (5, 1), (6, 1), (2, 9), (3, 3), (2, 9)], [(i, i + 1) for i in range(20, 40)]
    for links, rounds in ((stars, 0), ([], 0), (chain + stars, None)):
        steps.clear()
        got = components.components(llm.createDataFrame(links, "a long, b long")).collect()
        want = {1: 1, 5: 1, 6: 1, 2: 2, 9: 2} if links else {}
        assert {r.node: r.component for r in got} == want | ({i: 20 for i in range(20, 41)} if rounds is None else {})
        assert len(got) == len({r.node for r in got}) and (rounds is None or len(steps) == 1 + rounds)


@pytest.mark.parametrize("block", [2, 2048])
def test_blocks_are_made_only_for_large_groups(make, monkeypatch, block):
    monkeypatch.setattr(ngram_jaccard, "BLOCK", block)
    passes, verified = [], ngram_jaccard.verified_links
    monkeypatch.setattr(ngram_jaccard, "verified_links", lambda *args: passes.append(args[3]) or verified(*args))
    rng = random.Random(17)
    original, texts = sentence(rng, 120).split(), []
    for i in range(30):  # near copies around the threshold: leaders do not link them all
        w = list(original)
        for _ in range(rng.randrange(8)):
            w[rng.randrange(len(w))] = "x" + str(rng.randrange(10**6))
        texts.append((i, " ".join(w)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard.classes(make(texts)).collect()}
    assert got == components_by_force(texts)
    assert passes == ([True, False] if block == 2 else [True])


# ---- fingerprints

def test_fingerprints(make):
    rng = random.Random(5)
    texts = {i: sentence(rng, rng.randrange(1, 200)) for i in range(80)} | {90: "", 91: "ab", 92: "\U0001F600é" * 9}
    ids = sorted(texts, reverse=True)
    for ranges in (1, 7):
        got = {r.doc_id: r for r in fingerprints.fingerprints(make(list(texts.items())), ranges).collect()}
        assert set(got) == set(texts)
        for n, i in enumerate(ids):
            text, following = texts[i], texts[ids[(n + 1) % len(ids)]]
            half = len(text) // 2
            new = text[:len(text) - half] + following[:half]
            r, own = got[i], fingerprints.signature(fingerprints.points(text))
            assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
            assert r.fingerprint == fingerprints.text_of(own)
            assert r.near_edited == fingerprints.likeness(own, fingerprints.signature(fingerprints.points(new)))
            assert r.near_next == fingerprints.likeness(own, fingerprints.signature(fingerprints.points(following)))


def test_signature_takes_the_smallest_numbered_kmers_in_text_order(monkeypatch):
    codes = fingerprints.points("abracadabra " * 30)
    kmers = fingerprints.numbered_kmers(codes)
    assert len(set(kmers.tolist())) == kmers.size  # numbers tell equal k-mers apart
    whole = fingerprints.signature(codes)
    for s in range(3):
        value = kmers * fingerprints._FACTORS[s]
        low = np.sort(np.argsort(value)[:fingerprints.TUPLE])
        h = np.uint64(s + 1)
        with np.errstate(over="ignore"):
            for x in kmers[low]:
                h = h * fingerprints.STEP + x
        assert whole[s] == fingerprints.mixed(np.array([h]))[0] >> np.uint64(32)
    monkeypatch.setattr(fingerprints, "BLOCK", 13)
    assert (fingerprints.signature(codes) == whole).all()
    swapped = fingerprints.signature(np.concatenate([codes[180:], codes[:180]]))
    assert 0 < fingerprints.likeness(whole, swapped) <= 1


def test_fingerprint_odd_rows(make):
    got = fingerprints.fingerprints(make(ODD), 3).collect()
    assert len(got) == len(ODD)
    assert len({r.fingerprint for r in got if r.doc_id == 7}) == 2
    assert fingerprints.fingerprints(make([]), 3).count() == 0
    (one,) = fingerprints.fingerprints(make([(1, "only text")]), 3).collect()
    assert one.near_next == 1


# ---- decontamination

def hits_by_force(texts, items):
    out = {}
    for i, t in texts:
        w = decontamination.words_of(t)
        cover, met = set(), set()
        for item, body in items:
            b = decontamination.words_of(body)
            size = min(13, len(b))
            own = {tuple(b[p:p + size]) for p in range(len(b) - size + 1)} if size else set()
            for p in range(len(w) - size + 1):
                if tuple(w[p:p + size]) in own:
                    cover |= set(range(p, p + size))
                    met.add(str(item))
        out[i] = (len(w), len(cover), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(),
                  len(cover) > 0 and 20 * len(cover) >= len(w))
    return out


def test_decontamination(llm, make):
    rng = random.Random(6)
    items = [(i, sentence(rng, n)) for i, n in enumerate((1, 2, 4, 5, 12, 13, 14, 40))] + [(20, None), (21, "!!"), (10, sentence(rng, 30))]
    texts = []
    for i in range(60):
        parts = [sentence(rng, rng.randrange(60))]
        for _ in range(rng.randrange(3)):
            b = (items[rng.randrange(8)][1]).split()
            a = rng.randrange(len(b))
            parts += [rng.choice([", ", " ", "? "]).join(b[a:a + rng.randrange(1, 30)]).upper(), sentence(rng, rng.randrange(20))]
        texts.append((i, " ".join(parts)))
    bench = llm.createDataFrame([(i, t, "mine") for i, t in items], "item_id long, text string, words string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontamination.report(make(texts), bench).collect()}
    assert got == hits_by_force(texts, items)
    kept = {r.doc_id for r in decontamination.without_contaminated(make(texts), bench).collect()}
    assert kept == {i for i, r in got.items() if not r[4]}


def test_decontamination_odd_rows(llm, make):
    bench = llm.createDataFrame([(1, "same text here"), (1, "same text here"), (None, "one")], "item_id long, text string")
    got = decontamination.report(make(ODD), bench).collect()
    assert len(got) == len(ODD)
    assert sorted(str(r.doc_id) for r in got if r.contaminated) == ["10", "7", "7"]
    assert decontamination.report(make(ODD), bench.limit(0)).where("contaminated").count() == 0
    assert decontamination.report(make([]), bench).count() == 0


# ---- packing

def test_packing_is_a_round_trip(make):
    import public_tokenizers
    from tokenizers import Tokenizer
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(7)
    texts = [(i, sentence(rng, int(rng.expovariate(1 / 300)))) for i in range(150)] + [
        (200, "<|endoftext|> it's  spaced\n\n out \u00e9\U0001F600"), (201, None), (202, ""),
        (203, "a <|endoftext|><|endoftext|> b<|endoftext"), (204, "<|endoftext|>")]
    got = packing.pack(make(texts), with_ids=True).collect()
    by_doc, by_row = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_row[r.sequence_id].append(r)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length
    for i, t in texts:
        own = sorted(by_doc[i], key=lambda r: r.start)
        assert [x for r in own for x in r.ids] == reference.encode(t or "", add_special_tokens=False).ids + [1]
        assert {r.doc_tokens for r in own} == {sum(r.length for r in own)}
    for row in by_row.values():
        row.sort(key=lambda r: r.offset)
        ends = np.cumsum([r.length for r in row])
        assert [r.offset for r in row] == [0, *ends[:-1]] and ends[-1] <= 2048
    used = sum(r.length for r in got)
    assert used / (2048 * len(by_row)) > 0.97


def test_cuts():
    for n in range(1, 9000):
        lengths = packing.cut(n)
        assert sum(lengths) == n and all(0 < x <= 2048 for x in lengths) and len(lengths) <= n // 2048 + packing.CUTS + 1


def test_many_equal_pieces_share_no_row(llm):
    """100,000 equal full pieces and others: no row over its capacity, offsets gapless, each piece in one row."""
    piece = lambda n, doc_id, length: llm.range(n).select(
        F.lit(doc_id).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("start"), F.lit(length).cast("long").alias("length"),
        F.lit(9).cast("long").alias("ids_crc32"), F.lit(length).cast("long").alias("doc_tokens"))
    rows = piece(100_000, 1, 2048).unionByName(piece(30_000, 2, 1000)).unionByName(piece(20_000, 3, 3)).unionByName(piece(7, 4, 700))
    stored = rows.withColumn("row", F.monotonically_increasing_id()).repartition(4, "row").persist()
    got = packing._packed(stored, 2048).persist()
    per_row = got.groupBy("sequence_id").agg(F.sum("length").alias("used"), F.sum("offset").alias("offsets"),
                                             F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("all")).persist()
    assert got.count() == 150_007 and per_row.agg(F.max("used")).first()[0] <= 2048
    gaps = F.aggregate("all", F.lit(0).cast("long"), lambda end, x: F.when(x["offset"] == end, end + x["length"]))
    assert per_row.where(gaps.isNull() | (gaps != F.col("used"))).count() == 0
    assert per_row.count() <= 100_000 + 15_000 + 31 + 4
    spread = stored.withColumn("worker", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "row"), F.lit(25))).where("doc_id = 1")
    assert spread.groupBy("worker").count().agg(F.max("count")).first()[0] < 6_000


def test_packing_odd_rows(make):
    got = packing.pack(make(ODD)).collect()
    assert sum(r.start == 0 for r in got) == len(ODD)
    seen = Counter((r.sequence_id, r.offset) for r in got)
    assert max(seen.values()) == 1
    assert packing.pack(make([])).count() == 0
