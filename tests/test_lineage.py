import random

import pytest

from millrace.operators import lineage


def test_equal_names_explicit_maps_and_unmatched(spark, rows):
    columns = spark.createDataFrame(
        [("src.a", c) for c in ("id", "x", "y")] + [("src.b", c) for c in ("id", "z")]
        + [("mid.m", c) for c in ("id", "x", "new")] + [("out.o", c) for c in ("id", "total")], "dataset string, column string")
    edges = spark.createDataFrame([("mid.m", "src.a"), ("mid.m", "src.b"), ("out.o", "mid.m")], "downstream string, upstream string")
    explicit = spark.createDataFrame([("out.o", "total", "mid.m", "x"), ("out.o", "total", "mid.m", "gone")],
                                     "downstream string, down_column string, upstream string, up_column string")
    got = lineage.column_edges(columns, edges, explicit)
    assert rows(got) == [
        ("mid.m", "id", "src.a", "id", False), ("mid.m", "id", "src.b", "id", False), ("mid.m", "x", "src.a", "x", False),
        ("out.o", "total", "mid.m", "gone", True), ("out.o", "total", "mid.m", "x", True)]
    assert rows(lineage.broken_edges(got, columns)) == [("out.o", "total", "mid.m", "gone", "upstream")]


def test_broken_edges_reads_the_edges_once(spark, rows):
    known = spark.createDataFrame([("a", "x"), ("b", "x")], "dataset string, column string")
    layout = "downstream string, down_column string, upstream string, up_column string"
    spark.createDataFrame([("a", "x", "b", "x"), ("a", "no", "b", "no"), ("a", "no", "b", "x"), ("a", "x", None, "x")], layout) \
        .createOrReplaceTempView("edges_once")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    edges = spark.table("edges_once").mapInArrow(count, layout)
    got = rows(lineage.broken_edges(edges, known))
    assert sorted(got, key=str) == [
        ("a", "no", "b", "no", "downstream"), ("a", "no", "b", "no", "upstream"), ("a", "no", "b", "x", "downstream"),
        ("a", "x", None, "x", "upstream")]
    assert seen.value == 4


def test_column_edges_against_brute_force_with_a_hot_dataset(spark, rows):
    rng = random.Random(5)
    columns = {(f"d{rng.choice([0, 0, 0, 1, 2, 3, 4])}", f"c{rng.randrange(40)}") for _ in range(150)}
    edges = {(f"d{a}", f"d{b}") for a in range(5) for b in range(5) if a != b and (a == 0 or rng.random() < 0.4)}
    empty = spark.createDataFrame([], "downstream string, down_column string, upstream string, up_column string")
    got = lineage.column_edges(spark.createDataFrame(list(columns), "dataset string, column string"),
                               spark.createDataFrame(list(edges), "downstream string, upstream string"), empty)
    want = sorted((d, c, u, c, False) for d, u in edges for (ds, c) in columns if ds == d and (u, c) in columns)
    assert rows(got) == want


@pytest.mark.parametrize("upstream", [False, True])
def test_reachable_with_cycle_against_brute_force(spark, rows, upstream):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e"), ("x", "d"), ("a", "d")]
    got = lineage.reachable(spark, spark.createDataFrame(edges, "upstream string, downstream string"),
                            spark.createDataFrame([("a",), ("x",), ("e",)], "node string"), 3, upstream)
    step = {}
    for u, d in edges:
        near, far = (d, u) if upstream else (u, d)
        step.setdefault(near, set()).add(far)
    want = []
    for root in ("a", "x", "e"):
        seen, level = {root}, {root}
        for hop in range(1, 4):
            level = {n for x in level for n in step.get(x, ())} - seen
            seen |= level
            want += [(root, n, hop) for n in level]
    assert rows(got.select("root", "node", "hop")) == sorted(want)


def test_process_and_dataset_edges(spark, rows):
    jobs = spark.createDataFrame([("j1", ["a", "b"], ["c"]), ("j2", ["c"], []), ("j3", [], ["d"])],
                                 "job string, inputs array<string>, outputs array<string>")
    assert rows(lineage.process_edges(jobs)) == [
        ("j1", "input", "a"), ("j1", "input", "b"), ("j1", "output", "c"), ("j2", "input", "c"), ("j3", "output", "d")]
    assert rows(lineage.dataset_edges(jobs)) == [("a", "c"), ("b", "c")]


def test_catalog_from_real_frames(spark, rows):
    frames = {"s.t": spark.createDataFrame([], "order_id bigint, is_open boolean, created_at timestamp, v string")}
    assert rows(lineage.column_catalog(spark, frames).select("position", "column", "type_class", "name_class")) == [
        (1, "order_id", "number", "number"), (2, "is_open", "boolean", "boolean"), (3, "created_at", "time", "timestamp"),
        (4, "v", "string", "string")]
