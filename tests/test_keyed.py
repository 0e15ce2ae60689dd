import pytest
from pyspark.sql import functions as F

from millrace.operators import keyed

T = "k int, v string, u int"


def test_latest_keeps_first_in_order_and_groups_null_keys(spark, rows):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "c", 1), (None, "d", 3), (2, "e", 1)], T)
    assert rows(keyed.latest_per_key(df, ["k"], [F.col("u").desc()])) == [(None, "d", 3), (1, "b", 2), (2, "e", 1)]


def test_latest_drops_rows_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("u"))
    plan = keyed.latest_per_key(df, ["k"], [F.col("u").desc()])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_upsert_replaces_inserts_and_never_matches_null(spark, rows):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (None, "n", 1)], T)
    source = spark.createDataFrame([(2, None, 0), (3, "c", 5), (None, "m", 2)], T)
    assert rows(keyed.upsert(target, source, ["k"])) == [
        (None, "m", 2), (None, "n", 1), (1, "a", 1), (2, None, 0), (3, "c", 5)]


def test_upsert_twice_is_upsert_once(spark, rows):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], T)
    source = spark.createDataFrame([(2, "x", 2), (3, "c", 2)], T)
    once = keyed.upsert(target, source, ["k"])
    assert rows(keyed.upsert(once, source, ["k"])) == rows(once)


def test_upsert_refuses_repeated_source_key(spark):
    target = spark.createDataFrame([(1, "a", 1)], T)
    source = spark.createDataFrame([(1, "x", 2), (1, "y", 2)], T)
    with pytest.raises(keyed.DuplicateKeyError):
        keyed.upsert(target, source, ["k"])
    nulls = spark.createDataFrame([(None, "x", 2), (None, "y", 2)], T)
    assert keyed.upsert(target, nulls, ["k"]).count() == 3


def test_upsert_newer_only(spark, rows):
    target = spark.createDataFrame([(1, "a", 5), (2, "b", 1)], T)
    source = spark.createDataFrame([(1, "old", 4), (2, "new", 2), (3, "c", 1)], T)
    assert rows(keyed.upsert(target, source, ["k"], newer_by="u")) == [(1, "a", 5), (2, "new", 2), (3, "c", 1)]


def test_partial_upsert_changes_only_named_columns(spark, rows):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (None, "n", 1)], T)
    source = spark.createDataFrame([(1, None, 9), (3, "c", 9), (None, "m", 9)], T)
    assert rows(keyed.upsert_columns(target, source, ["k"], ["v"])) == [
        (None, "m", 9), (None, "n", 1), (1, None, 1), (2, "b", 1), (3, "c", 9)]


def test_content_hash_tells_shifted_nulls_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", None)], "x string, y string")
    assert df.select(keyed.content_hash(["x", "y"])).distinct().count() == 2
    assert df.select(F.xxhash64("x", "y")).distinct().count() == 1


def test_publishing_the_same_definition_is_a_no_op(spark, rows):
    known = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], T)
    assert keyed.definition_changes(known, known, ["k"], ["v", "u"]).count() == 0
    changed = spark.createDataFrame([(1, "a", 1), (2, "B", 1), (3, "c", 1)], T)
    assert rows(keyed.definition_changes(known, changed, ["k"], ["v", "u"]).select("k", "change")) == [
        (2, "CHANGED"), (3, "NEW")]


def test_top_per_group(spark, rows):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("a", 3, 9), ("b", 4, 1)], "g string, id int, v int")
    top = keyed.top_per_group(df, ["g"], [F.col("v").desc(), F.col("id")], 2)
    assert rows(top.select("g", "id", "rank")) == [("a", 1, 2), ("a", 3, 1), ("b", 4, 1)]
