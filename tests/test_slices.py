import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import keyed
from millrace.operators.keyed import DuplicateKeyError
from millrace.sources.feeds import ControlTotalError
from millrace.sources import files
from millrace.sources.slices import SliceTable, field_bytes

SCHEMA = "id int, v string, d date"


@pytest.fixture
def table(spark, tmp_path):
    def make(data):
        df = spark.createDataFrame(data, "id int, v string, day string").withColumn("d", F.col("day").cast("date")).drop("day")
        return df
    t = SliceTable(spark, f"{tmp_path}/t", make([]).schema, "d")
    return t, make


DAYS = [(1, "a", "2024-01-01"), (2, "b", "2024-01-01"), (3, "c", "2024-01-02")]


def test_replacing_a_slice_twice_is_replacing_it_once(table, rows):
    t, make = table
    t.overwrite(make(DAYS))
    again = make([(1, "x", "2024-01-01")])
    t.replace_slices(again, ["2024-01-01"])
    once = rows(t.read())
    t.replace_slices(again, ["2024-01-01"])
    assert rows(t.read()) == once
    assert [r[0] for r in once] == [1, 3]


def test_an_empty_reload_clears_the_slice(table, rows):
    t, make = table
    t.overwrite(make(DAYS))
    t.replace_slices(make([]), ["2024-01-01"])
    assert [r[0] for r in rows(t.read())] == [3]


def test_failed_guards_leave_the_old_rows(table, rows):
    t, make = table
    t.overwrite(make(DAYS))
    before = rows(t.read())
    with pytest.raises(ValueError, match="outside"):
        t.replace_slices(make([(9, "z", "2024-01-09")]), ["2024-01-01"])
    with pytest.raises(ControlTotalError):
        t.replace_slices(make([(1, "z", "2024-01-01")]), ["2024-01-01"], expected_rows=2)
    assert rows(t.read()) == before


def test_a_load_that_dies_before_its_renames_is_invisible(table, rows, monkeypatch):
    t, make = table
    t.overwrite(make(DAYS))
    before = rows(t.read())

    def die(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(files, "move", die)
    with pytest.raises(RuntimeError):
        t.replace_slices(make([(1, "z", "2024-01-01")]), ["2024-01-01"])
    monkeypatch.undo()
    assert rows(t.read()) == before


class Killed(Exception):
    pass


def killer(at):
    """A hook that dies at its ``at``-th call."""
    seen = []

    def step(name):
        seen.append(name)
        if len(seen) == at:
            raise Killed(name)
    return step


@pytest.mark.parametrize("what", ["merge", "batch", "reload"])
def test_a_load_killed_at_any_step_and_repeated_is_a_load(table, rows, spark, what):
    t, make = table
    day = lambda n: f"2024-01-{n:02}"
    first = make([(i, "a", day(1 + i % 4)) for i in range(10)])
    second = make([(1, "x", day(2)), (2, "moved", day(4)), (50, "new", day(9))])
    smaller = make([(60, "y", day(2))])

    def load(table):
        if what == "merge":
            table.merge(second, ["id"], lambda kept, new: keyed.upsert(kept, new, ["id"], check=False))
        elif what == "batch":
            table.append(smaller, batch="b")
        else:
            table.replace_slices(smaller, [day(2), day(3)])

    def fresh(name):
        table = SliceTable(spark, f"{t.path}-{name}", t.schema, "d")
        table.overwrite(first)
        if what == "batch":
            table.append(second, batch="b")
        return table

    undisturbed = fresh("whole")
    before = rows(undisturbed.read())
    load(undisturbed)
    after = rows(undisturbed.read())
    assert before != after
    at, completed = 0, False
    while not completed:
        at += 1
        path = fresh(f"killed-{at}").path
        try:
            load(SliceTable(spark, path, t.schema, "d", on_step=killer(at)))
            completed = True
        except Killed:
            reader = SliceTable(spark, path, t.schema, "d", reading=True)
            assert rows(reader.read()) in (before, after)
            assert rows(reader.read([day(n) for n in range(1, 10)])) in (before, after)
        again = SliceTable(spark, path, t.schema, "d")
        assert rows(again.read()) in (before, after)
        load(again)
        assert rows(again.read()) == after
        assert not {"intent.json", "placed.json"} & set(files.child_names(spark, path))
    assert at > 6


def test_merge_rewrites_only_touched_slices_and_moves_rows(table, rows):
    t, make = table
    t.overwrite(make(DAYS + [(4, "d", "2024-01-03")]))
    untouched = t.read(["2024-01-03"]).inputFiles()
    source = make([(1, "moved", "2024-01-02"), (5, "new", "2024-01-05")])
    t.merge(source, ["id"], lambda kept, new: keyed.upsert(kept, new, ["id"], check=False))
    assert [(r[0], r[1], str(r[2])) for r in rows(t.read())] == [
        (1, "moved", "2024-01-02"), (2, "b", "2024-01-01"), (3, "c", "2024-01-02"), (4, "d", "2024-01-03"),
        (5, "new", "2024-01-05")]
    assert t.read(["2024-01-03"]).inputFiles() == untouched
    with pytest.raises(DuplicateKeyError):
        t.merge(make([(1, "x", "2024-01-01"), (1, "y", "2024-01-01")]), ["id"], keyed.upsert)


def test_a_named_batch_is_applied_once(table):
    t, make = table
    for _ in range(2):
        t.append(make(DAYS), batch="b1")
    assert t.read().count() == 3
    t.append(make(DAYS), batch="b2")
    assert t.read().count() == 6


def test_null_slice_is_kept(table, rows):
    t, make = table
    t.overwrite(make([(1, "a", None), (2, "b", "2024-01-01")]))
    t.merge(make([(1, "x", None)]), ["id"], lambda kept, new: keyed.upsert(kept, new, ["id"], check=False))
    assert [(r[0], r[1], r[2]) for r in rows(t.read())][0] == (1, "x", None)


def test_a_replayed_batch_is_applied_once_however_many_came_after(table):
    t, make = table
    for n in range(12):
        t.append(make(DAYS[:1]), batch=f"b/{n}")
    t.append(make(DAYS[:1]), batch="b/0")
    assert t.read().count() == 12


def test_files_per_slice_stay_few(table):
    t, make = table
    df = make([(i, "v", f"2024-01-{1 + i % 20:02}") for i in range(400)])
    per_slice = lambda: t.file_profile().withColumn("d", F.regexp_extract("file_path", "/d=([^/]*)", 1)).groupBy("d").count() \
        .agg(F.max("count")).first()[0]
    t.commit(df.repartition(8))
    assert per_slice() == 1
    t.merge(make([(i, "w", f"2024-01-{1 + i % 20:02}") for i in range(100)]), ["id"],
            lambda kept, new: keyed.upsert(kept, new, ["id"], check=False), slice_of_key=True)
    t.replace_slices(df.where("d = DATE '2024-01-02'").repartition(4), ["2024-01-02"])
    assert per_slice() == 1 and t.read().count() == 400
    t.append(df, batch="more")
    assert per_slice() == 2


def test_a_merge_whose_key_keeps_its_slice_reads_only_the_source(table, monkeypatch):
    t, make = table
    t.overwrite(make(DAYS))
    monkeypatch.setattr(t, "read", lambda *_: pytest.fail("the table was read"))
    assert t.touched_slices(make([(1, "x", "2024-01-01")]), ["id"], slice_of_key=True) == {"2024-01-01"}


def test_pruned_read_opens_only_named_slices(table):
    t, make = table
    t.overwrite(make(DAYS), ["id"])
    assert len(t.read(["2024-01-02"]).inputFiles()) == 1
    plan = t.read().where("d = DATE '2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan


def test_field_bytes(spark, rows):
    df = spark.createDataFrame([("ab", 10), ("ü", None)], "s string, n int")
    assert rows(field_bytes(df)) == [("n", 2), ("s", 4)]


def test_a_table_without_rows_needs_no_python_workers(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("a `b`", T.ArrayType(T.StringType())), T.StructField("day", T.DateType())])
    empty = SliceTable(spark, f"{tmp_path}/none", schema, "day").read()
    assert (empty.dtypes, empty.collect()) == ([(f.name, f.dataType.simpleString()) for f in schema.fields], [])
    assert "ExistingRDD" not in empty._jdf.queryExecution().executedPlan().toString()


def test_a_merge_asks_for_slices_and_repeated_keys_at_once(spark, tmp_path, monkeypatch):
    table = SliceTable(spark, f"{tmp_path}/t", spark.createDataFrame([], "k int, s int").schema, "s")
    table.append(spark.createDataFrame([(1, 1), (2, 2)], "k int, s int"))
    frame, asked = type(spark.range(1)), []
    for name in ("first", "collect"):
        monkeypatch.setattr(frame, name, lambda self, name=name, real=getattr(frame, name): asked.append(name) or real(self))
    table.merge(spark.createDataFrame([(1, 3), (None, 2), (None, None)], "k int, s int"), ["k"],
                lambda kept, new: keyed.upsert(kept, new, ["k"], check=False))
    assert asked == ["collect"]
    monkeypatch.undo()
    assert sorted(map(str, table.read().collect())) == sorted(map(str, [
        Row(k=1, s=3), Row(k=2, s=2), Row(k=None, s=2), Row(k=None, s=None)]))
    with pytest.raises(keyed.DuplicateKeyError, match="'k': 7"):
        table.merge(spark.createDataFrame([(7, 1), (7, 2)], "k int, s int"), ["k"], lambda kept, new: new)
