from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators import cards

DAY = date(2024, 3, 1)
AUTH = ", ".join(f"{c} string" for c in cards.AUTH_COLUMNS) + ", load_business_date date"
POST = ", ".join(f"{c} string" for c in cards.POST_COLUMNS) + ", load_business_date date"


@pytest.fixture(scope="module")
def refs(spark):
    return (cards.card_reference(cards.numbers(spark, 200)), cards.merchant_reference(cards.numbers(spark, 100)),
            cards.mcc_reference(cards.numbers(spark, 100)))


def auth_row(refs, **change):
    base = dict(txn_id="T1", card_number_hash=refs[0].where("card_id = 7").first()["card_number_hash"],
                auth_ts="2024-03-01 10:00:00.1236", auth_amount="10.005", txn_currency="USD", merchant_id="M0003",
                mcc="5003", txn_type="PURCHASE", response_code="00", file_seq="1")
    base.update(change)
    return tuple(base[c] for c in cards.AUTH_COLUMNS) + (DAY,)


def post_row(**change):
    base = dict(txn_id="T1", posting_ref="P1", posting_ts="2024-03-02 01:00:00", settled_amount="10.20",
                settlement_currency="USD", acquirer_id="A", file_seq="1")
    base.update(change)
    return tuple(base[c] for c in cards.POST_COLUMNS) + (DAY,)


def run(spark, refs, auth, post):
    return cards.integrate(spark.createDataFrame(auth, AUTH), spark.createDataFrame(post, POST), *refs)


def test_reference_tables(spark, refs, rows):
    assert rows(cards.reference_profile(refs[2], refs[1], refs[0])) == [
        ("card", 200, 192), ("mcc_category", 100, 12), ("merchant", 100, 100)]
    assert refs[2].where("mcc = '5001'").first()["mcc_category"] == "Groceries"
    assert refs[2].where("mcc = '5100'").first()["mcc_category"] == "Fuel"
    m = refs[1].where("merchant_id = 'M0100'").first()
    assert (m.merchant_name, m.mcc, m.country) == ("Merchant 0100", "5100", "FR")
    c = refs[0].where("card_id = 1").first()
    assert c.card_number_hash == "6B86B273FF34FCE19D6B804EFF5A3F5747ADA4EAA22F1D49C01E52DDB7875B4B"
    assert (c.customer_id, c.issue_date, c.is_active) == (100001, date(2024, 12, 21), True)


def test_valid_row_is_typed_and_enriched(spark, refs):
    r = run(spark, refs, [auth_row(refs)], [post_row()]).first()
    assert (r.card_id, r.txn_date, str(r.auth_amount), str(r.settled_amount)) == (7, DAY, "10.01", "10.20")
    assert r.auth_ts == datetime(2024, 3, 1, 10, 0, 0, 124000)
    assert (r.merchant_name, r.mcc_category, r.is_approved, r.is_posted, r.decline_reason) == (
        "Merchant 0003", "Travel", 1, 1, None)


@pytest.mark.parametrize("change", [
    {"auth_amount": "-1"}, {"auth_amount": "0"}, {"auth_amount": "abc"}, {"auth_amount": "1e3"}, {"auth_amount": None},
    {"auth_ts": "soon"}, {"auth_ts": ""}, {"auth_ts": "2024-03-02 00:00:00"}, {"mcc": "AB12"}, {"txn_type": "BOGUS"},
    {"txn_type": "purchase"}, {"card_number_hash": "unknown"}, {"merchant_id": "M9999"}, {"txn_type": None}])
def test_invalid_rows_drop_out(spark, refs, change):
    assert run(spark, refs, [auth_row(refs, **change)], [post_row()]).count() == 0


def test_first_valid_row_by_text_order_of_file_seq(spark, refs):
    auth = [auth_row(refs, file_seq="1", auth_amount="bad"), auth_row(refs, file_seq="9", auth_amount="9"),
            auth_row(refs, file_seq="10", auth_amount="10")]
    got = run(spark, refs, auth, []).collect()
    assert [(str(r.auth_amount), r.is_posted) for r in got] == [("10.00", 0)]


def test_repeats_on_both_sides_do_not_multiply(spark, refs):
    auth = [auth_row(refs, file_seq=str(i)) for i in range(50)]
    post = [post_row(posting_ref=f"P{i}", settled_amount=str(i)) for i in range(9, 0, -1)]
    got = run(spark, refs, auth, post).collect()
    assert len(got) == 1 and str(got[0].settled_amount) == "1.00"


def test_posting_of_another_day_does_not_match(spark, refs):
    other = post_row()[:-1] + (date(2024, 3, 2),)
    assert run(spark, refs, [auth_row(refs)], [other]).first()["is_posted"] == 0


@pytest.mark.parametrize("code,reason", [
    ("05", "Do not honor"), ("51", "Insufficient funds"), ("14", "Invalid card number"), ("54", "Expired card"),
    ("61", "Exceeds withdrawal limit"), ("65", "Activity limit exceeded"), ("91", "Issuer unavailable"),
    ("77", "Declined"), (None, "Declined")])
def test_decline_reasons(spark, refs, code, reason):
    r = run(spark, refs, [auth_row(refs, response_code=code)], []).first()
    assert (r.is_approved, r.decline_reason) == (0, reason)


def test_declines_and_reports(spark, refs, rows):
    auth = [auth_row(refs, txn_id="A", response_code="05", auth_amount="1000"),
            auth_row(refs, txn_id="B", response_code="05", auth_amount="1000.01"),
            auth_row(refs, txn_id="C"), auth_row(refs, txn_id="D", auth_amount="5")]
    txn = run(spark, refs, auth, [post_row(txn_id="D", settled_amount="6")])
    assert rows(cards.declines(txn).select("txn_id", "flagged_for_review")) == [("A", 0), ("B", 1)]
    s = cards.daily_summary(txn).first()
    assert (s.txn_count, s.approved_count, s.decline_count) == (4, 2, 2)
    assert (str(s.auth_amount_total), str(s.settled_amount_total)) == ("15.01", "6.00")


def test_top_merchants_ties_and_limit(spark, rows):
    data = [(DAY, f"M{i:02}", f"m{i}", 1, None if i == 0 else 5) for i in range(15)]
    txn = spark.createDataFrame(data, "txn_date date, merchant_id string, merchant_name string, is_approved int, s int")
    top = cards.top_merchants(txn.withColumn("settled_amount", F.col("s").cast("decimal(18,2)")))
    got = rows(top.select("rank", "merchant_id"))
    assert sorted(got) == [(i, f"M{i:02}") for i in range(1, 11)]
