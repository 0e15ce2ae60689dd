import json
from datetime import date

import pytest
from pyspark.sql import types as T

from millrace.operators import history
from millrace.sources.slices import SliceTable
from millrace.streaming import changes

ROW = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("note", T.StringType()),
                    T.StructField("created_at", T.StringType())])


def event(op, i, note, seq, day="2024-01-01"):
    image = {"id": i, "note": note, "created_at": day}
    return json.dumps({"op": op, "before": image if op == "d" else None, "after": None if op == "d" else image,
                       "source": {"seq": seq, "extra": 1}})


@pytest.fixture
def feed(spark, tmp_path):
    folder = f"{tmp_path}/in"

    def add(values):
        spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.mode("append").parquet(folder)
    return folder, add


FIRST = [event("c", 1, "a", 1), event("r", 2, "b", 2), event("u", 1, "a2", 3), event("d", 2, "b", 4), None,
         "{broken", event("c", 3, "c", 5)]


def test_only_inserts_land_and_a_restart_adds_only_what_is_new(spark, tmp_path, rows, feed):
    folder, add = feed
    add(FIRST)
    out, mark = f"{tmp_path}/out", f"{tmp_path}/mark"

    def land():
        changes.land_inserts(changes.open_stream(spark, "parquet", folder), ROW, out, mark)
        return rows(spark.read.schema(ROW).parquet(out).select("id", "note"))

    assert land() == [(1, "a"), (2, "b"), (3, "c")]
    assert land() == [(1, "a"), (2, "b"), (3, "c")]
    add([event("c", 4, "d", 6)])
    assert land() == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


def test_continuous_mode_polls(spark, tmp_path, feed):
    folder, add = feed
    add(FIRST)
    query = changes.land_inserts(changes.open_stream(spark, "parquet", folder), ROW, f"{tmp_path}/out",
                                 f"{tmp_path}/mark", continuous=True)
    try:
        query.processAllAvailable()
        assert spark.read.schema(ROW).parquet(f"{tmp_path}/out").count() == 3
    finally:
        query.stop()


def test_changes_apply_in_order_and_once(spark, tmp_path, rows, feed):
    folder, add = feed
    state = SliceTable(spark, f"{tmp_path}/state", changes.state_schema(ROW), "bucket")

    def apply(mark):
        stream = changes.open_stream(spark, "parquet", folder)
        changes.apply_changes(stream, ROW, "id", state, f"{tmp_path}/{mark}", buckets=2)
        return rows(changes.live_rows(state, ROW).select("id", "note"))

    add(FIRST)
    assert apply("m") == [(1, "a2"), (3, "c")]
    files = sorted(state.read().inputFiles())
    assert apply("m") == [(1, "a2"), (3, "c")]
    assert sorted(state.read().inputFiles()) == files
    # A late older change loses, a deleted key may come back.
    add([event("u", 1, "late", 2), event("c", 2, "again", 9), event("d", 3, "c", 8), event("d", 77, "x", 8)])
    assert apply("m") == [(1, "a2"), (2, "again")]
    # Everything replayed under a lost checkpoint gives the same table.
    assert apply("other") == [(1, "a2"), (2, "again")]


DAYS = [event("c", 1, "a", 1, "2024-01-01"), event("u", 1, "b", 2, "2024-01-01"), event("c", 2, "x", 3, "2024-01-01"),
        event("u", 1, "c", 4, "2024-01-02"), event("d", 2, "x", 5, "2024-01-02"), event("c", 3, "n", 6, "2024-01-02"),
        event("u", 1, "c", 7, "2024-01-03"), event("u", 1, "a", 8, "2024-01-04"), event("u", 3, "late", 9, "2024-01-01"), None,
        event("c", 2, "back", 12, "2024-01-05"), event("d", 4, "never", 10, "2024-01-02"), event("u", 2, "back", 13, "2024-01-06")]


@pytest.mark.parametrize("cuts", [[13], [3, 7, 10, 13], list(range(1, 14))])
def test_streamed_history_is_the_same_for_any_cut(spark, tmp_path, rows, feed, cuts):
    folder, add = feed
    dim = history.Dimension("id", "id_key", ("note", "created_at"), ("note",))
    table = SliceTable(spark, f"{tmp_path}/daily", changes.daily_schema(ROW), "bucket")
    start = 0
    for end in cuts:
        add(DAYS[start:end])
        start = end
        for _ in range(2):
            changes.daily_rows(changes.open_stream(spark, "parquet", folder), ROW, "id", "created_at", table, f"{tmp_path}/m", buckets=2)
    day = lambda n: date(2024, 1, n)
    assert rows(changes.history_of(table, dim).select("id", "note", "valid_from", "valid_to")) == [
        (1, "a", day(4), history.OPEN_END), (1, "b", history.BEGINNING, day(2)), (1, "c", day(2), day(4)),
        (2, "back", day(5), history.OPEN_END), (2, "x", history.BEGINNING, day(2)),
        (3, "late", history.BEGINNING, day(2)), (3, "n", day(2), history.OPEN_END)]
