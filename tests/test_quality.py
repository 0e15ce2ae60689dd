from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators import quality
from millrace.operators.quality import Check, CheckSet

D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


@pytest.fixture
def df(spark):
    data = [(D1, "a", 1), (D1, "a", None), (D2, "b", 5)]
    return spark.createDataFrame(data, "d date, k string, v int").withColumn(
        "loaded_at", F.lit(datetime(2024, 1, 2)).cast("timestamp_ntz"))


def one(df, check):
    return quality.run([CheckSet("t", df, (check,))]).first()


def test_status_order(df):
    nulls = quality.count_where(F.col("v").isNull())
    assert one(df, Check("C", "nulls", nulls, lambda n: n == 1)).status == "PASSED"
    assert one(df, Check("C", "nulls", nulls)).status == "FAILED"
    warned = one(df, Check("C", "nulls", nulls, lambda n: n == 1, warns=lambda n: n > 0))
    assert warned.status == "WARNING" and warned.actual == 1.0
    bad = one(df, Check("C", "nulls", F.sum("no_such_column"), lambda n: n.isNull(), warns=lambda n: n.isNull()))
    assert bad.status == "ERROR" and bad.actual is None and "no_such_column" in bad.message


def test_error_leaves_the_other_checks_of_the_set(df):
    got = quality.run([CheckSet("t", df, (Check("BAD", "x", F.sum("nope")), Check("N", "x", F.count(F.lit(1)))), "d")])
    assert sorted((str(r.business_date), r.check_code, r.status) for r in got.collect()) == [
        ("2024-01-01", "BAD", "ERROR"), ("2024-01-01", "N", "FAILED"),
        ("2024-01-02", "BAD", "ERROR"), ("2024-01-02", "N", "FAILED")]


def test_a_failure_while_running_leaves_the_other_checks(spark, df):
    broken = Check("BAD", "x", F.sum(F.raise_error(F.lit("boom")).cast("int")))
    fine = Check("N", "x", F.count(F.lit(1)))
    got = quality.run_apart([CheckSet("t", df, (broken, fine)), CheckSet("u", df, (fine,))])
    status = {(r.table_name, r.check_code): r.status for r in got.collect()}
    assert status[("t", "BAD")] == quality.ERROR and status[("t", "N")] == status[("u", "N")] != quality.ERROR


def test_text_and_null_values(df):
    text = one(df, Check("C", "x", F.max("k"), lambda v: v == "b"))
    assert (text.status, text.actual, text.actual_text) == ("PASSED", None, "b")
    null = one(df.limit(0), Check("C", "x", F.max("v"), lambda v: v <= 3))
    assert (null.status, null.actual) == ("FAILED", None)
    assert one(df.limit(0), Check("C", "x", F.max("v"), lambda v: v.isNull())).status == "PASSED"


def test_levels(df):
    assert one(df, Check("C", "x", F.max("v"))).level == "L1"
    assert one(df, Check("C", "x", F.max("v"), field="v")).level == "L2"


def test_mandatory_checks(df):
    got = {(r.check_code, str(r.business_date)): r for r in quality.run(quality.mandatory(
        "t", df, ["k"], 2, 10, now=datetime(2024, 1, 3, 0, 0, 1), today=date(2024, 1, 2), by="d")).collect()}
    assert len(got) == 4 * 2 + 1
    assert got[("SLA_VALIDATION", "2024-01-01")].status == "FAILED"
    assert got[("RECORD_COUNT", "2024-01-01")].actual == 2
    assert got[("RECORD_COUNT_THRESHOLD", "2024-01-02")].status == "FAILED"
    assert got[("DUPLICATE_FEED", "2024-01-01")].actual == 2
    assert got[("DUPLICATE_FEED", "2024-01-02")].status == "PASSED"
    assert got[("BUSINESS_DATE", "None")].status == "PASSED"
    older = quality.run(quality.mandatory("t", df, ["k"], 2, 10, datetime(2024, 1, 2), date(2024, 1, 3), by="d"))
    assert older.where("check_code = 'BUSINESS_DATE'").first()["actual"] == 2


def test_a_day_without_rows_is_reported(df):
    sets = quality.mandatory("t", df, ["k"], 1, 10, datetime(2024, 1, 4), date(2024, 1, 4), by="d", day=date(2024, 1, 3))
    got = {r.check_code: (r.actual, r.status, str(r.business_date)) for r in quality.run(sets).collect()}
    assert got == {
        "SLA_VALIDATION": (None, "FAILED", "2024-01-03"), "RECORD_COUNT": (0, "PASSED", "2024-01-03"),
        "RECORD_COUNT_THRESHOLD": (0, "FAILED", "2024-01-03"), "DUPLICATE_FEED": (0, "PASSED", "2024-01-03"),
        "BUSINESS_DATE": (3, "FAILED", "None")}
    custom = quality.for_day([CheckSet("t", df, (Check("N", "x", F.count(F.lit(1))),), "d")], date(2024, 1, 3))
    assert [(r.actual, r.status) for r in quality.run(custom).collect()] == [(0, "PASSED")]


def test_mandatory_checks_share_one_scan(spark, tmp_path):
    spark.range(100).select(F.lit(D1).alias("d"), F.col("id").alias("k"),
                            F.current_timestamp().alias("loaded_at")).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    results = quality.run(quality.mandatory("t", df, ["k"], 1, 10, datetime(2024, 1, 2), D2, by="d"))
    results.collect()
    final = results._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1


def test_thirty_mandatory_and_fifteen_custom_checks(spark):
    cols = {c: "string" for c in ("txn_id", "auth_amount", "auth_ts", "mcc", "txn_type", "settled_amount", "posting_ts",
                                  "posting_ref", "decline_reason", "merchant_name", "mcc_category")}
    cols |= {c: "int" for c in ("card_id", "is_approved", "is_posted", "approved_count", "decline_count", "txn_count", "rank")}
    cols |= {"load_business_date": "date", "txn_date": "date", "loaded_at": "timestamp_ntz"}
    wide = spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in cols.items()))
    frames = {t: wide for t in quality.BANDS}
    sets = quality.card_mandatory(frames, datetime(2024, 1, 2), D2)
    assert sum(len(s.checks + s.whole) for s in sets) == 30
    sets += quality.stage_checks(wide, wide) + quality.integration_checks(wide, wide) + quality.report_checks(wide, wide)
    assert sum(len(s.checks + s.whole) for s in sets) == 45
    ids = quality.definitions(sets, "o", "s")
    assert len({i for i, *_ in ids}) == 45


def test_postings_without_authorisation(spark):
    auth = spark.createDataFrame([("T1", D1), ("T2", D2)], "txn_id string, load_business_date date")
    post = spark.createDataFrame([("T1", D1), ("T1", D1), ("T1", D2), ("X", D2), ("X", D2)], auth.schema)
    counts = quality.match_counts(post, auth, ["txn_id", "load_business_date"])
    got = counts.where("found IS NULL").agg(F.sum("n")).first()[0]
    assert got == 3


def test_star_checks(spark):
    fact = spark.createDataFrame(
        [(1, 1, 10.0, 5), (1, 1, 1.0, 5), (2, 1, 7.0, None)],
        "order_id int, line_no int, amount double, customer_key int").withColumn(
        "extended_amount", F.col("amount").cast("decimal(12,2)"))
    orders = spark.createDataFrame([(1, 11.0), (2, 7.01), (3, 1.0)], "order_id int, t double").withColumn(
        "order_total", F.col("t").cast("decimal(12,2)"))
    dim = spark.createDataFrame([(1, 100, True), (1, 101, True), (2, 102, False), (None, 102, True)],
                                "customer_id int, customer_key int, is_current boolean")
    apart = [quality.grain_check(fact, ["order_id", "line_no"]), quality.reference_check(fact, ["customer_key"]),
             quality.reconciliation_check(fact, orders)]
    one_pass = [quality.fact_checks(fact, orders, ["customer_key"])]
    assert sorted(map(tuple, quality.run(apart).collect()), key=str) == sorted(map(tuple, quality.run(one_pass).collect()), key=str)
    got = {r.check_code: (r.actual, r.status) for r in quality.run([
        *one_pass, *quality.dimension_checks("dim", dim, "customer_id", "customer_key")]).collect()}
    assert got == {
        "FACT_GRAIN_UNIQUE": (1, "FAILED"), "FACT_KEYS_RESOLVED": (1, "FAILED"),
        "ORDER_TOTAL_RECONCILED": (1, "FAILED"), "ORDER_HAS_LINES": (1, "WARNING"),
        "ONE_CURRENT_ROW": (1, "FAILED"), "HAS_CURRENT_ROW": (1, "WARNING"), "KEY_PRESENT": (1, "FAILED"),
        "SURROGATE_UNIQUE": (1, "FAILED")}


def test_gate(df):
    bad = quality.run([CheckSet("t", df, (Check("N", "rows", F.count(F.lit(1))),))])
    with pytest.raises(quality.QualityGateError, match="t.N FAILED"):
        quality.require_passed(bad)
    quality.require_passed(quality.run([CheckSet("t", df, (
        Check("N", "rows", F.count(F.lit(1)), warns=quality.is_positive),))]))


def test_run_events(df):
    sets = [CheckSet("T1", df, (Check("N", "rows", F.count(F.lit(1)), warns=quality.is_positive),))]
    e = quality.run_events(quality.run(sets), "Owner", "Stage", datetime(2024, 1, 1)).first()
    assert (e.check_id, e.result_type, e.status) == ("urn:li:assertion:owner_stage_t1_n", "FAILURE", "WARNING")
    assert quality.definitions(sets, "Owner", "Stage") == [("urn:li:assertion:owner_stage_t1_n", "T1", "N", "", "rows")]
