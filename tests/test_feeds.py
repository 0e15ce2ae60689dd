import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.sources import feeds

DAY = date(2024, 3, 1)


def write(path, content):
    path.write_text(content, encoding="utf-8")
    return str(path)


def test_stage_read_keeps_text_and_declared_columns(spark, tmp_path, rows):
    p = write(tmp_path / "f.csv", "b,a,extra\n 007 ,x,1\n,y,2\n\"q,1\",ü,3\n")
    df = feeds.read_stage(spark, p, ["a", "b"], DAY)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["string", "string", "date", "timestamp"]
    assert rows(df.select("a", "b", "load_business_date")) == [
        ("x", " 007 ", DAY), ("y", None, DAY), ("ü", "q,1", DAY)]


def test_stage_read_needs_declared_columns(spark, tmp_path):
    p = write(tmp_path / "f.csv", "a\n1\n")
    with pytest.raises(ValueError, match="no column b"):
        feeds.read_stage(spark, p, ["a", "b"], DAY)


def test_line_breaks_inside_quotes(spark, tmp_path, rows):
    p = write(tmp_path / "f.csv", 'a,b\n"one\ntwo",2\n')
    assert rows(feeds.read_text_feed(spark, p, ["a", "b"], line_breaks=True)) == [("one\ntwo", "2")]


def test_both_feeds_must_exist(spark, tmp_path):
    inbound = str(tmp_path)
    present = feeds.daily_feed_path(inbound, "card_auth", DAY)
    assert present.endswith("card_auth_20240301.csv")
    write(tmp_path / "card_auth_20240301.csv", "a\n")
    feeds.require_feeds(spark, [present])
    with pytest.raises(FileNotFoundError, match="card_post_20240301"):
        feeds.require_feeds(spark, [present, feeds.daily_feed_path(inbound, "card_post", DAY)])


CASTS = {"n": "int", "m": "decimal(18,2)", "t": "timestamp_ntz", "d": "date"}
RAW = [("1", "2.345", "2024-01-01 00:00:00", "2024-01-01", "a"), ("x", "1e3", "", "nope", "b"),
       (None, "1,000", None, None, "c"), ("2", "-.5", "2024-13-01", "2024-02-30", "d")]
SCHEMA = "n string, m string, t string, d string, z string"


def test_typing_turns_bad_text_into_null(spark):
    got = feeds.typed(spark.createDataFrame(RAW, SCHEMA), CASTS).orderBy("z").collect()
    assert [str(r.m) if r.m is not None else None for r in got] == ["2.35", None, None, "-0.50"]
    assert [r.n for r in got] == [1, None, None, 2]
    assert got[0].t == datetime(2024, 1, 1) and got[1].t is None and got[3].t is None
    assert [r.d for r in got] == [date(2024, 1, 1), None, None, None]


def test_quarantine_splits_without_losing_rows(spark, rows):
    good, bad = feeds.split_bad_casts(spark.createDataFrame(RAW, SCHEMA), CASTS)
    assert rows(bad.select("z", F.array_join("reasons", ","))) == [("b", "n,m,t,d"), ("c", "m"), ("d", "t,d")]
    assert [r.z for r in good.collect()] == ["a"]


def test_window_includes_both_ends(spark, rows):
    df = spark.createDataFrame([(i, datetime(2024, 1, 1, 0, 0, i)) for i in range(5)], "id int, updated_at timestamp_ntz")
    got = feeds.extract_window(df, datetime(2024, 1, 1, 0, 0, 1), datetime(2024, 1, 1, 0, 0, 3))
    assert rows(got.select("id")) == [(1,), (2,), (3,)]


def test_extract_manifest_and_watermark(spark, tmp_path, rows):
    data = [(1, "a", datetime(2024, 1, 1)), (2, None, datetime(2024, 1, 2)), (3, 'q"x,', datetime(2024, 1, 5))]
    df = spark.createDataFrame(data, "id int, v string, updated_at timestamp_ntz")
    state = f"{tmp_path}/state"
    feeds.extract_feed(spark, {"t": df}, f"{tmp_path}/f1", state, "src", DAY, datetime(2024, 1, 2))
    assert rows(feeds.read_manifest(spark, f"{tmp_path}/f1").select("table", "rows", "low_watermark")) == [
        ("t", 2, "1970-01-01 00:00:00")]
    assert feeds.read_state(spark, state) == {"t": datetime(2024, 1, 2)}
    feeds.extract_feed(spark, {"t": df}, f"{tmp_path}/f2", state, "src", DAY + timedelta(1), datetime(2024, 1, 9))
    # The boundary row comes again.
    file, _ = feeds.manifest_entries(spark, f"{tmp_path}/f2", ["t"])["t"]
    raw = feeds.read_text_feed(spark, f"{tmp_path}/f2/{file}", ["id", "v"])
    assert rows(raw) == [("2", None), ("3", 'q"x,')]
    feeds.extract_feed(spark, {"t": df}, f"{tmp_path}/f3", state, "src", DAY, datetime(2024, 1, 9), full=True)
    assert feeds.read_manifest(spark, f"{tmp_path}/f3").first()["rows"] == 3


def test_a_run_date_keeps_its_window(spark, tmp_path):
    df = spark.createDataFrame([(i, datetime(2024, 1, i)) for i in range(1, 11)], "id int, updated_at timestamp_ntz")
    state = f"{tmp_path}/state"

    def ids(day, high, name="f", **more):
        feeds.extract_feed(spark, {"t": df}, f"{tmp_path}/{name}{day}", state, "src", date(2024, 1, day), datetime(2024, 1, high), **more)
        file, n = feeds.manifest_entries(spark, f"{tmp_path}/{name}{day}", ["t"])["t"]
        got = sorted(int(r["id"]) for r in feeds.read_text_feed(spark, f"{tmp_path}/{name}{day}/{file}", ["id"]).collect())
        assert len(got) == n
        return got

    assert ids(3, 3) == ids(3, 9) == [1, 2, 3]
    assert ids(7, 7) == ids(7, 9, "again") == [3, 4, 5, 6, 7]
    # A late date takes what follows the dates before it, and moves nothing back.
    assert ids(5, 5) == ids(5, 5) == [3, 4, 5]
    assert feeds.read_state(spark, state) == {"t": datetime(2024, 1, 7)}
    assert ids(9, 9) == [7, 8, 9]


def test_an_extract_that_dies_leaves_its_rows_to_the_next_date(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(i, datetime(2024, 1, i)) for i in range(1, 11)], "id int, updated_at timestamp_ntz")
    state = f"{tmp_path}/state"
    extract = lambda day: feeds.extract_feed(spark, {"t": df}, f"{tmp_path}/{day}", state, "src", date(2024, 1, day), datetime(2024, 1, day))
    extract(2)

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(feeds, "publish_manifest", die)
        with pytest.raises(RuntimeError):
            extract(4)
    extract(6)
    assert feeds.read_manifest(spark, f"{tmp_path}/6").first()["rows"] == 5
    extract(4)
    assert feeds.read_manifest(spark, f"{tmp_path}/4").first()["rows"] == 3
    assert feeds.read_state(spark, state) == {"t": datetime(2024, 1, 6)}


def test_line_breaks_count_as_written_and_a_retry_replaces_the_feed(spark, tmp_path, rows):
    data = [(1, 'two\n"lines",\r\n', datetime(2024, 1, 1)), (2, "b", datetime(2024, 1, 2))]
    df = spark.createDataFrame(data, "id int, v string, updated_at timestamp_ntz")
    folder = f"{tmp_path}/f"
    for _ in range(2):
        feeds.extract_feed(spark, {"t": df, "none": df.limit(0)}, folder, f"{tmp_path}/s", "src", DAY, datetime(2024, 1, 9), full=True)
    assert rows(feeds.read_manifest(spark, folder).select("table", "rows")) == [("none", 0), ("t", 2)]
    file, expected = feeds.manifest_entries(spark, folder, ["t"])["t"]
    whole = feeds.read_text_feed(spark, f"{folder}/{file}", ["id", "v"], line_breaks=True)
    assert rows(whole) == [("1", 'two\n"lines",\r\n'), ("2", "b")]
    # A reader that splits lines disagrees with the total.
    split = feeds.read_text_feed(spark, f"{folder}/{file}", ["id", "v"]).count()
    counted = spark.createDataFrame([("t", split), ("none", 0)], "table string, rows_read bigint")
    with pytest.raises(feeds.ControlTotalError):
        feeds.require_totals(feeds.control_totals(feeds.read_manifest(spark, folder), counted))


def manifest(tmp_path, tables):
    body = {"source": "s", "run_date": "2024-03-01", "extracted_at": "x", "run_hwm": "x", "tables": tables}
    write(tmp_path / "manifest.json", json.dumps(body, indent=2))
    return str(tmp_path)


def test_control_totals(spark, tmp_path, rows):
    folder = manifest(tmp_path, [{"table": t, "file": t, "low_watermark": "x", "rows": n} for t, n in (("a", 2), ("b", 3))])
    counted = spark.createDataFrame([("a", 2), ("b", 4), ("c", 1)], "table string, rows_read bigint")
    totals = feeds.control_totals(feeds.read_manifest(spark, folder), counted)
    assert rows(totals) == [("a", 2, 2, True), ("b", 3, 4, False), ("c", None, 1, False)]
    with pytest.raises(feeds.ControlTotalError):
        feeds.require_totals(totals)
    feeds.require_totals(totals.where("agrees"))
    with pytest.raises(feeds.ControlTotalError, match="does not name z"):
        feeds.manifest_entries(spark, folder, ["a", "z"])


def test_empty_or_absent_manifest_fails(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        feeds.read_manifest(spark, str(tmp_path))
    with pytest.raises(feeds.ControlTotalError):
        feeds.read_manifest(spark, manifest(tmp_path, []))
