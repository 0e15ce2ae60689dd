import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators.keyed import DuplicateKeyError
from millrace.operators import history
from millrace.operators.history import BEGINNING, OPEN_END

DIM = history.Dimension("id", "id_key", ("tier", "note"), ("tier",))
D = [date(2024, 1, d) for d in range(1, 11)]
SEEN = ["id", "tier", "valid_from", "valid_to", "is_current"]


def frame(spark, data):
    return spark.createDataFrame(data, "id bigint, tier string, note string")


@pytest.mark.parametrize("seed", range(4))
def test_feeds_in_any_order_give_the_replay(spark, rows, seed):
    """Daily feeds spliced in one by one, in random order after the first day."""
    rng = random.Random(seed)
    log = [(k, rng.choice("AB"), "x", day) for k in range(1, 8) for day in D if day == D[0] or rng.random() < 0.5]
    as_frame = lambda data: spark.createDataFrame(data, "id bigint, tier string, note string, day date")
    newest = [F.col("tier").desc()]
    known = [r for r in log if r[3] == D[0]]
    versions = history.replay(as_frame(known), DIM, "day", newest, D[0])
    for day in rng.sample(D[1:], 4):
        late = [r for r in log if r[3] == day]
        versions = history.splice(versions, as_frame(known), as_frame(late), DIM, "day", newest, D[0])
        known += late
    assert rows(versions.select(*SEEN)) == rows(history.replay(as_frame(known), DIM, "day", newest).select(*SEEN))
    with pytest.raises(ValueError, match="dated before"):
        history.splice(versions, as_frame(known), as_frame([(1, "A", "x", date(2023, 1, 1))]), DIM, "day", newest, D[0])


def test_rekey_looks_up_changed_spans_only(spark, rows):
    log = [(1, "A", "x", D[0]), (1, "B", "x", D[6]), (2, "A", "x", D[0])]
    as_frame = lambda data: spark.createDataFrame(data, "id bigint, tier string, note string, day date")
    before = history.replay(as_frame(log), DIM, "day", [F.col("tier")])
    after = history.splice(before, as_frame(log), as_frame([(1, "C", "x", D[3])]), DIM, "day", [F.col("tier")], D[0])
    facts = history.as_of_join(spark.createDataFrame([(n, k, D[n]) for n in range(9) for k in (1, 2)], "n int, id bigint, at date"),
                               before, "id", "at", "id", ["id_key", "tier"])
    got = history.rekey(facts, before, after, DIM, "id", "at", ["id_key", "tier"])
    assert rows(got) == rows(history.as_of_join(facts.drop("id_key", "tier"), after, "id", "at", "id", ["id_key", "tier"]).select(*facts.columns))
    assert rows(history.changed_spans(before, after, DIM)) == [(1, BEGINNING, D[6])]


def test_rekey_sees_a_version_that_says_something_else(spark, rows):
    log = [(1, "A", "x", D[0], 1), (1, "B", "x", D[3], 2), (2, "A", "x", D[0], 3)]
    as_frame = lambda data: spark.createDataFrame(data, "id bigint, tier string, note string, day date, n int")
    newest = [F.col("n").desc()]
    before = history.replay(as_frame(log), DIM, "day", newest)
    after = history.splice(before, as_frame(log), as_frame([(1, "C", "x", D[3], 9)]), DIM, "day", newest, D[0])
    facts = history.as_of_join(spark.createDataFrame([(n, k, D[n]) for n in range(6) for k in (1, 2)], "n int, id bigint, at date"),
                               before, "id", "at", "id", ["tier", "valid_from"])
    got = history.rekey(facts, before, after, DIM, "id", "at", ["tier", "valid_from"])
    assert rows(got) == rows(history.as_of_join(facts.drop("tier", "valid_from"), after, "id", "at", "id", ["tier", "valid_from"]).select(*facts.columns))


def test_deletes_leave_gaps(spark, rows):
    log = [(1, "A", D[0], False), (1, "A", D[2], True), (1, "A", D[4], False), (1, "A", D[5], False), (1, "B", D[6], True), (2, "A", D[1], True), (2, "A", D[3], None)]
    df = spark.createDataFrame(log, "id bigint, tier string, day date, gone boolean").withColumn("note", F.lit("x"))
    assert rows(history.replay(df, DIM, "day", [F.col("tier")], deleted="gone").select(*SEEN)) == [
        (1, "A", BEGINNING, D[2], False), (1, "A", D[4], D[6], False), (2, "A", D[3], OPEN_END, True)]


def test_onboard(spark, rows):
    got = rows(history.onboard(frame(spark, [(1, "A", "x")]), DIM).select(*SEEN))
    assert got == [(1, "A", BEGINNING, OPEN_END, True)]


def test_merge_day_cases(spark, rows):
    start = history.onboard(frame(spark, [(1, "A", "x"), (2, "A", "x"), (3, "A", "x"), (4, None, "x")]), DIM)
    fed = frame(spark, [(1, "A", "changed note"), (2, "B", "x"), (4, "A", "x"), (5, "N", "x")])
    got = history.merge_day(start, fed, DIM, D[1])
    assert rows(got.select(*SEEN)) == [
        (1, "A", BEGINNING, OPEN_END, True),
        (2, "A", BEGINNING, D[1], False), (2, "B", D[1], OPEN_END, True),
        (3, "A", BEGINNING, OPEN_END, True),
        (4, None, BEGINNING, D[1], False), (4, "A", D[1], OPEN_END, True),
        (5, "N", D[1], OPEN_END, True)]
    # An untracked change alone moves nothing.
    assert got.where("id = 1").first()["note"] == "x"


def test_same_day_second_change_replaces_in_place(spark, rows):
    start = history.onboard(frame(spark, [(1, "A", "x")]), DIM)
    once = history.merge_day(start, frame(spark, [(1, "B", "x")]), DIM, D[1])
    twice = history.merge_day(once, frame(spark, [(1, "C", "x")]), DIM, D[1])
    assert rows(twice.select(*SEEN)) == [(1, "A", BEGINNING, D[1], False), (1, "C", D[1], OPEN_END, True)]
    assert twice.select("id_key").distinct().count() == 2


def test_rows_without_key_are_kept_and_not_matched(spark, rows):
    start = history.onboard(frame(spark, [(1, "A", "x"), (None, "A", "x")]), DIM)
    got = history.merge_day(start, frame(spark, [(1, "A", "x"), (None, "B", "x")]), DIM, D[1])
    assert rows(got.select("id", "tier", "valid_from", "is_current")) == [
        (None, "A", BEGINNING, True), (None, "B", D[1], True), (1, "A", BEGINNING, True)]


def test_a_feed_older_than_a_changed_version_is_refused(spark, rows):
    start = history.merge_day(history.onboard(frame(spark, [(1, "A", "x")]), DIM), frame(spark, [(1, "B", "x")]), DIM, D[5])
    with pytest.raises(Exception, match="changed after"):
        history.merge_day(start, frame(spark, [(1, "C", "x")]), DIM, D[2]).collect()
    assert rows(history.merge_day(start, frame(spark, [(1, "B", "x")]), DIM, D[2])) == rows(start)


def test_a_feed_that_repeats_a_key_is_refused(spark):
    start = history.onboard(frame(spark, [(1, "A", "x")]), DIM)
    with pytest.raises(DuplicateKeyError):
        history.merge_day(start, frame(spark, [(1, "B", "x"), (1, "C", "x")]), DIM, D[1])


def test_dates_must_be_dates(spark):
    log = spark.createDataFrame([(1, "A", "x", "2024-01-01")], "id bigint, tier string, note string, day string")
    with pytest.raises(TypeError):
        history.replay(log.withColumn("day", F.to_timestamp("day")), DIM, "day", [F.col("tier")])


def test_rerun_of_a_day_changes_nothing(spark, rows):
    start = history.onboard(frame(spark, [(1, "A", "x"), (2, "A", "x")]), DIM)
    fed = frame(spark, [(1, "B", "x"), (3, "A", "x")])
    once = history.merge_day(start, fed, DIM, D[1])
    assert rows(history.merge_day(once, fed, DIM, D[1])) == rows(once)


def test_daily_merges_give_the_same_intervals_as_replay(spark, rows):
    rng = random.Random(7)
    log = [(k, rng.choice("AB"), "x", day) for k in range(1, 9) for day in D if rng.random() < 0.5]
    log += [(9, t, "x", d) for t, d in zip("ABA", D[2:5])]
    seen = spark.createDataFrame(log, "id bigint, tier string, note string, day date")
    first = min(r[3] for r in log)
    folded = None
    for day in D:
        fed = seen.where(F.col("day") == F.lit(day)).drop("day")
        if folded is None:
            folded = history.onboard(fed, DIM)
        else:
            folded = history.merge_day(spark.createDataFrame(folded.collect(), folded.schema), fed, DIM, day)
    assert first == D[0]
    replayed = history.replay(seen, DIM, "day", [F.col("tier")])
    assert rows(replayed.select("id_key", *SEEN)) == rows(folded.select("id_key", *SEEN))


def test_replay_keeps_only_the_last_change_of_a_day(spark, rows):
    log = spark.createDataFrame(
        [(1, "A", "x", D[0], 1), (1, "B", "x", D[1], 2), (1, "C", "x", D[1], 3), (1, "C", "x", D[3], 4)],
        "id bigint, tier string, note string, day date, seq int")
    got = history.replay(log, DIM, "day", [F.col("seq").desc()]).select(*SEEN)
    assert rows(got) == [(1, "A", BEGINNING, D[1], False), (1, "C", D[1], OPEN_END, True)]


def test_as_of_join_matches_brute_force_with_a_hot_key(spark, rows):
    rng = random.Random(3)
    log = [(k, rng.choice("ABC"), "x", D[i]) for k in (1, 2, 3) for i in range(10) if rng.random() < 0.6]
    versions = history.replay(spark.createDataFrame(log, "id bigint, tier string, note string, day date"),
                              DIM, "day", [F.col("tier")]).drop("note")
    facts = [(n, rng.choice([1, 1, 1, 2, 3, 4, None]), rng.choice(D + [None, date(1950, 1, 1)])) for n in range(200)]
    asked = spark.createDataFrame(facts, "n int, cust bigint, at date")
    got = history.as_of_join(asked, versions, "cust", "at", "id", ["tier", "valid_from"])
    held = versions.collect()
    want = []
    for n, cust, at in facts:
        hit = [v for v in held if v.id == cust and at is not None and v.valid_from <= at < v.valid_to]
        assert len(hit) <= 1
        want.append((n, cust, at, hit[0].tier if hit else None, hit[0].valid_from if hit else None))
    assert rows(got.select("n", "cust", "at", "tier", "valid_from")) == rows(
        spark.createDataFrame(want, "n int, cust bigint, at date, tier string, valid_from date"))


def test_interval_ends(spark, rows):
    versions = history.merge_day(history.onboard(frame(spark, [(1, "A", "x")]), DIM),
                                 frame(spark, [(1, "B", "x")]), DIM, D[1])
    at = spark.createDataFrame([(1, D[1] - timedelta(1)), (1, D[1])], "cust bigint, at date")
    got = history.as_of_join(at, versions, "cust", "at", "id", ["tier"])
    assert rows(got.select("at", "tier")) == [(D[0], "A"), (D[1], "B")]


def test_current_join(spark, rows):
    versions = history.merge_day(history.onboard(frame(spark, [(1, "A", "x")]), DIM),
                                 frame(spark, [(1, "B", "x")]), DIM, D[1])
    at = spark.createDataFrame([(1, D[0]), (7, D[0])], "cust bigint, at date")
    assert rows(history.current_join(at, versions, "cust", "id", ["tier"])) == [(1, D[0], "B"), (7, D[0], None)]


def test_one_version_each_is_joined_by_key(spark, rows):
    versions = spark.createDataFrame([(1, "A", D[1], D[4]), (2, "B", BEGINNING, OPEN_END), (None, "C", BEGINNING, OPEN_END)],
                                     "id bigint, tier string, valid_from date, valid_to date")
    facts = spark.createDataFrame([(n, k, D[n] if n < 6 else None) for n in range(7) for k in (1, 2, 3, None)], "n int, cust bigint, at date")
    assert history.one_version_each(versions, "id")
    assert not history.one_version_each(versions.unionByName(versions), "id")
    got = history.only_version_join(facts, versions, "cust", "at", "id", ["tier"])
    assert rows(got) == rows(history.as_of_join(facts, versions, "cust", "at", "id", ["tier"]))


def test_lines_meet_a_dimension_of_one_version_without_pairs(spark, rows, capsys):
    from millrace.operators import star
    lines = spark.createDataFrame([(1, 1, 7, 1, 2, 3, 4), (1, 2, 8, 1, 2, 3, 4)],
                                  "order_id bigint, line_no int, product_id bigint, quantity int, unit_price int, discount_pct int, line_amount int")
    orders = spark.createDataFrame([(1, D[2], "PLACED")], "order_id bigint, order_date date, status string")
    one = spark.createDataFrame([(7, 70, D[0], OPEN_END)], "product_id bigint, product_key bigint, valid_from date, valid_to date")
    two = spark.createDataFrame([(7, 70, D[0], D[1]), (7, 71, D[1], OPEN_END)], one.schema)
    for dim, key, windows in ((one, 70, False), (two, 71, True)):
        fact = star.build_fact(lines, orders, {"product_key": dim})
        assert rows(fact.select("line_no", "product_key")) == [(1, key), (2, None)]
        fact.explain()
        assert ("Window" in capsys.readouterr().out) == windows


def test_totals_are_dealt_by_order_once(spark, rows, capsys):
    from millrace.operators import metrics
    report = spark.createDataFrame(
        [(1, D[0], 2, "S", "c1", "r", "x"), (1, D[0], 3, "S", "c2", "r", "x"), (2, D[0], 1, "T", "c1", None, "x"), (None, D[0], 1, "T", "c1", "r", "y")],
        "order_id bigint, order_date date, quantity int, segment string, category_name string, region string, channel string") \
        .withColumn("extended_amount", F.col("quantity").cast("decimal(18,2)"))
    totals = metrics.daily_totals(report)
    assert rows(totals.select("grouped_by", "segment", "category_name", "region", "channel", "units", "orders", "lines")) == rows(spark.createDataFrame([
        ("all", None, None, None, None, 7, 2, 4), ("segment", "S", None, None, None, 5, 1, 2), ("segment", "T", None, None, None, 2, 1, 2),
        ("category", None, "c1", None, None, 4, 2, 3), ("category", None, "c2", None, None, 3, 1, 1),
        ("region_channel", None, None, "r", "x", 5, 1, 2), ("region_channel", None, None, None, "x", 1, 1, 1),
        ("region_channel", None, None, "r", "y", 1, 0, 1)],
        "g string, s string, c string, r string, h string, u bigint, o bigint, l bigint"))
    totals.explain()
    assert "Expand" not in capsys.readouterr().out
    assert dict(totals.dtypes)["revenue"] == "decimal(28,2)"
