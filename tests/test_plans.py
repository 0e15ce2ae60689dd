"""Daily runs end to end: repeatable, traceable, and stopping where they must."""

from datetime import date, datetime

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from millrace.operators import cards, lineage, quality, star
from millrace.operators.quality import QualityGateError
from millrace.plans.card_day import CardWarehouse, RepeatedIdError
from millrace.plans.sales_day import DIMENSIONS, SOURCES, SalesWarehouse
from millrace.session import together
from millrace.sources import adapters, feeds, files
from millrace.sources.feeds import ControlTotalError
from millrace.sources.slices import SliceTable

SF = "/root/testdata/sf0.001"
DAY = date(2024, 1, 5)
RUN_AT = datetime(2024, 1, 6, 5, 0, 0)


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


# ---- cards -----------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def card_run(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("cards")
    for name, build, columns in (("card_auth", adapters.card_auth, cards.AUTH_COLUMNS),
                                 ("card_post", adapters.card_post, cards.POST_COLUMNS)):
        df = build(spark, SF)
        for day in (DAY, date(2024, 1, 6)):
            feeds.write_text_feed(df.where(F.col("load_business_date") == F.lit(day)).select(*columns).coalesce(1),
                                  feeds.daily_feed_path(f"{root}/in", name, day))
    warehouse = CardWarehouse(
        spark, f"{root}/wh", cards.card_reference(adapters.table(spark, SF, "customer").select(F.col("c_custkey").alias("n"))),
        cards.merchant_reference(cards.numbers(spark, 100)), cards.mcc_reference(cards.numbers(spark, 100)))
    events = warehouse.load_day(f"{root}/in", DAY, RUN_AT)
    return warehouse, f"{root}/in", events


def stored(warehouse, name, spark):
    return SliceTable(spark, f"{warehouse.root}/{name}", None, "txn_date").read().drop("loaded_at")


def test_card_day_row_counts_agree_between_layers(spark, card_run):
    warehouse, _, events = card_run
    txn = stored(warehouse, "card_txn", spark)
    assert txn.count() > 0
    assert stored(warehouse, "daily_card_summary", spark).agg(F.sum("txn_count")).first()[0] == txn.count()
    assert stored(warehouse, "card_txn_decline", spark).count() == txn.where("is_approved = 0").count()
    assert stored(warehouse, "card_top_merchants", spark).count() == min(
        10, txn.where("is_approved = 1").select("merchant_id").distinct().count())
    assert events.count() == 45


def test_planted_flaws_fire_their_checks(card_run):
    _, _, events = card_run
    failed = {r.check_code for r in events.where("status = 'FAILED'").collect()}
    assert {"AUTH_AMOUNT_NUMERIC", "RECORD_COUNT_THRESHOLD"} <= failed
    assert events.where("status = 'ERROR'").count() == 0


def test_loading_the_day_again_leaves_the_same_state(spark, card_run, rows):
    warehouse, inbound, _ = card_run
    names = ("card_txn", "card_txn_decline", "daily_card_summary", "card_top_merchants")
    before = {n: rows(stored(warehouse, n, spark)) for n in names}
    warehouse.load_day(inbound, DAY, RUN_AT)
    assert {n: rows(stored(warehouse, n, spark)) for n in names} == before


def test_an_id_of_another_date_fails_the_load(spark, card_run, rows):
    warehouse, inbound, _ = card_run
    before = rows(stored(warehouse, "card_txn", spark))
    other = date(2024, 1, 7)
    day_feed = feeds.read_text_feed(spark, feeds.daily_feed_path(inbound, "card_auth", DAY), cards.AUTH_COLUMNS)
    feeds.write_text_feed(day_feed, feeds.daily_feed_path(inbound, "card_auth", other))
    with pytest.raises(FileNotFoundError):
        warehouse.load_day(inbound, other, RUN_AT)
    feeds.write_text_feed(feeds.read_text_feed(
        spark, feeds.daily_feed_path(inbound, "card_post", DAY), cards.POST_COLUMNS),
        feeds.daily_feed_path(inbound, "card_post", other))
    with pytest.raises(RepeatedIdError):
        warehouse.load_day(inbound, other, RUN_AT)
    assert rows(stored(warehouse, "card_txn", spark)) == before


def test_daily_feeds_are_written_in_one_pass(spark, tmp_path, rows, monkeypatch):
    data = [("a", date(2024, 1, 10)), ('q"\n,', date(2024, 1, 20)), ("b", date(2024, 1, 10))]
    df, written, write = spark.createDataFrame(data, "id string, d date"), [], feeds.write_text_feed
    monkeypatch.setattr(feeds, "write_text_feed", lambda *args: written.append(args[1]) or write(*args))
    days = [date(2024, 1, 10), date(2024, 1, 20), date(2024, 1, 31)]
    assert feeds.write_daily_feeds(df, f"{tmp_path}/in", "f", "d") == days[:2] and len(written) == 1
    assert feeds.write_daily_feeds(df, f"{tmp_path}/in", "g", "d", days[1:]) == days
    for name, of in (("f", days[:2]), ("g", days)):
        for day in of:
            got = feeds.read_text_feed(spark, feeds.daily_feed_path(f"{tmp_path}/in", name, day), ["id"], line_breaks=True)
            assert rows(got) == sorted((i,) for i, d in data if d == day)
    with pytest.raises(ValueError):
        feeds.write_daily_feeds(spark.createDataFrame([("a", None)], "id string, d date"), f"{tmp_path}/in", "h", "d")


def test_new_ids_are_looked_up_from_written_rows(spark, card_run, rows, monkeypatch):
    """The day's transactions are integrated once, spread over the tasks that made them, and ids are read from them."""
    warehouse, inbound, _ = card_run
    seen, check = [], CardWarehouse._require_new_ids
    monkeypatch.setattr(CardWarehouse, "_require_new_ids", lambda self, txn, day: seen.append(txn.inputFiles()) or check(self, txn, day))
    warehouse.load_day(inbound, DAY, RUN_AT)
    assert len(seen) == 1 and seen[0] and all("/card_txn/aside/" in f for f in seen[0])
    table = SliceTable(spark, f"{warehouse.root}/spread", spark.range(1).withColumn("d", F.lit("x")).schema, "d")
    table.replace_slices(spark.range(0, 40, 1, 4).withColumn("d", F.lit("x")), ["x"], cluster=False)
    assert table.read().agg(F.count("id"), F.sum("id")).first() == (40, 780) and table.file_profile().count() == 4


# ---- sales -----------------------------------------------------------------------------------

def fed(spark, name, data):
    columns = list(SOURCES[name].columns)
    text = ", ".join(f"{c} string" for c in columns)
    stamp = lambda at: ("2024-01-01 00:00:00", f"{at} 00:00:00")
    df = spark.createDataFrame([tuple(r[:-1]) + stamp(r[-1]) for r in data], text)
    return df.withColumn("updated_at", F.col("updated_at").cast("timestamp"))


def first_feed(spark, at="2024-02-01"):
    return {
        "product_categories": fed(spark, "product_categories", [("1", " Tools ", at)]),
        "customers": fed(spark, "customers", [
            ("1", " ann ", "LEE", "A@X.com", "consumer", "new york", "ny", "usa", "2023-01-01", at),
            ("2", "bob", "ray", "b@x.com", "SMB", None, None, "usa", "2023-01-01", at)]),
        "products": fed(spark, "products", [("10", " sku-1", "Saw ", "1", "9.99", "1", at), ("11", "sku-2", "Axe", "9", "5", "1", at)]),
        "stores": fed(spark, "stores", [("5", "Main", "retail", "East", "boston", "ma", "usa", at),
                                        ("6", "Web", "online", "Online", None, None, "usa", at)]),
        "orders": fed(spark, "orders", [("100", "1", "5", "2024-01-20 10:00:00", "2024-01-20", " placed ", "19.98", at),
                                        ("101", "2", "6", "2024-01-21 10:00:00", "2024-01-21", "PAID", "4.50", at)]),
        "order_items": fed(spark, "order_items", [("100", "1", "10", "2", "9.99", "0", "19.98", at),
                                                  ("101", "1", "11", "1", "5.00", "0.1", "4.50", at)]),
    }


def second_feed(spark, at="2024-02-02"):
    none = {n: [] for n in SOURCES}
    none["product_categories"] = []
    none["customers"] = [("1", "Ann", "Lee", "a@x.com", "ENTERPRISE", "New York", "NY", "USA", "2023-01-01", at),
                         ("2", "Bob", "Ray", "new@x.com", "SMB", None, None, "USA", "2023-01-01", at)]
    none["orders"] = [("100", "1", "5", "2024-01-20 10:00:00", "2024-01-20", "shipped", "19.98", at),
                      ("102", "1", "6", "2024-02-02 10:00:00", "2024-02-02", "placed", "9.99", at)]
    none["order_items"] = [("102", "1", "10", "1", "9.99", "0", "9.99", at)]
    return {n: fed(spark, n, rows) for n, rows in none.items()}


def extract(spark, tables, folder, state, day):
    feeds.extract_feed(spark, tables, folder, state, "shop", day, datetime(2024, 3, 1), full=True)
    return folder


D1, D2 = date(2024, 2, 1), date(2024, 2, 2)


@pytest.fixture(scope="module")
def sales(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("sales")
    warehouse = SalesWarehouse(spark, f"{root}/wh", date(2024, 1, 1), date(2024, 12, 31), buckets=2)
    first = extract(spark, first_feed(spark), f"{root}/f1", f"{root}/s", D1)
    second = extract(spark, second_feed(spark), f"{root}/f2", f"{root}/s", D2)
    warehouse.run(first, D1)
    report = warehouse.run(second, D2)
    return warehouse, second, report


def test_conformed_and_point_in_time(spark, sales):
    _, _, report = sales
    got = {r.order_id: r for r in report.collect()}
    assert set(got) == {100, 101, 102}
    # The order before the change keeps the old segment, the later one has the new.
    assert (got[100].segment, got[102].segment) == ("CONSUMER", "ENTERPRISE")
    # A re-fed order passes its status on to lines that were not fed again.
    assert (got[100].status, got[102].status) == ("SHIPPED", "PLACED")
    assert (got[100].first_name, got[100].last_name, got[100].customer_city) == ("Ann", "Lee", "New York")
    assert (got[100].sku, got[100].product_name, got[100].category_name) == ("SKU-1", "Saw", "Tools")
    assert (got[101].category_name, got[101].store_city, got[101].channel) == (None, None, "ONLINE")
    assert got[102].is_weekend is False and got[100].is_weekend is True
    assert report.columns == star.REPORT_COLUMNS


def test_views(spark, sales, rows):
    _, _, report = sales
    assert spark.sql("SELECT sum(quantity) FROM fact_sales").first()[0] == 4
    assert rows(spark.table("sales_report")) == rows(report)
    assert spark.sql("SELECT count(*) FROM dim_date").first()[0] == 366


def test_versions_and_untracked_change(sales, rows):
    warehouse, _, _ = sales
    got = warehouse.dimensions()["customer_key"]
    assert rows(got.select("customer_id", "segment", "email", "valid_from", "valid_to", "is_current")) == [
        (1, "CONSUMER", "a@x.com", date(1900, 1, 1), D2, False),
        (1, "ENTERPRISE", "a@x.com", D2, date(9999, 12, 31), True),
        (2, "SMB", "b@x.com", date(1900, 1, 1), date(9999, 12, 31), True)]


def test_sales_rerun_leaves_the_same_state(sales, rows):
    warehouse, second, report = sales
    before = rows(report), rows(warehouse.dimensions()["customer_key"]), rows(warehouse.fact().read())
    again = warehouse.run(second, D2)
    assert (rows(again), rows(warehouse.dimensions()["customer_key"]), rows(warehouse.fact().read())) == before


def test_report_with_fewer_columns_has_the_same_rows(sales, rows):
    warehouse, _, _ = sales
    some = ["order_id", "region", "extended_amount"]
    assert rows(warehouse.report(some)) == rows(warehouse.report().select(*some))


def test_bad_rows_are_set_aside_and_do_not_grow(spark, tmp_path, rows):
    warehouse = SalesWarehouse(spark, f"{tmp_path}/wh", date(2024, 1, 1), date(2024, 12, 31), buckets=2)
    tables = first_feed(spark)
    tables["customers"] = tables["customers"].unionByName(fed(spark, "customers", [
        ("x7", "bad", "key", "c@x.com", "SMB", None, None, "usa", "2023-01-01", "2024-02-01"),
        (None, "no", "key", "d@x.com", "SMB", None, None, "usa", "2023-01-01", "2024-02-01")]))
    folder = extract(spark, tables, f"{tmp_path}/f", f"{tmp_path}/s", D1)
    for _ in range(2):
        warehouse.run(folder, D1)
        assert rows(warehouse.current("customers").read().select("customer_id")) == [(1,), (2,)]
        assert sorted(r.reasons for r in warehouse.table("quarantine", "customers", "_run_date").read().collect()) == [
            ["customer_id"], ["customer_id"]]


def test_wrong_control_total_lands_nothing(spark, sales, tmp_path, monkeypatch):
    warehouse, second, _ = sales
    real = feeds.manifest_entries

    def one_more(*args):
        return {t: (file, rows + (t == "orders")) for t, (file, rows) in real(*args).items()}

    monkeypatch.setattr(feeds, "manifest_entries", one_more)
    with pytest.raises(ControlTotalError, match="orders"):
        warehouse.land(second, date(2024, 2, 9))
    assert "2024-02-09" not in warehouse.log("orders").slices()


def test_a_wrong_total_of_one_table_lands_none(sales, monkeypatch):
    warehouse, second, _ = sales
    real = feeds.manifest_entries
    monkeypatch.setattr(feeds, "manifest_entries", lambda *args: {
        t: (file, rows + (t == "order_items")) for t, (file, rows) in real(*args).items()})
    with pytest.raises(ControlTotalError, match="log/order_items: wrote 1 rows, expected 2"):
        warehouse.land(second, date(2024, 2, 10))
    assert not [n for n in SOURCES if "2024-02-10" in warehouse.log(n).slices()]


def test_a_feed_is_counted_in_one_query(spark, sales, monkeypatch):
    warehouse, second, _ = sales
    frame, asked = type(spark.range(1)), []
    for name in ("count", "collect"):
        monkeypatch.setattr(frame, name, lambda self, name=name, real=getattr(frame, name): asked.append(name) or real(self))
    warehouse.land(second, D2)
    assert asked == ["collect", "collect"]  # the manifest, and what was written of all tables


def test_steps_together_give_results_in_order_or_the_first_error(spark):
    assert together(spark, *[lambda n=n: (n, SparkSession.getActiveSession(), spark.range(n).count()) for n in range(5)]) == [
        (n, None, n) for n in range(5)]
    ended = []
    with pytest.raises(ZeroDivisionError):
        together(spark, lambda: ended.append(1), lambda: 1 // 0, lambda: [][0], lambda: ended.append(4))
    assert sorted(ended) == [1, 4]


def test_orphans_and_gate_stop_the_run(spark, tmp_path):
    warehouse = SalesWarehouse(spark, f"{tmp_path}/wh", date(2024, 1, 1), date(2024, 12, 31), buckets=2)
    tables = first_feed(spark)
    lost = {**tables, "customers": tables["customers"].where("customer_id = '1'")}
    folder = extract(spark, lost, f"{tmp_path}/f1", f"{tmp_path}/s1", D1)
    with pytest.raises(star.UnresolvedKeyError):
        warehouse.run(folder, D1)
    assert not warehouse.table("current", "orders", "bucket", spark.range(0)).exists()  # a refused day changes nothing
    warehouse.run(folder, D1, set_aside=True)
    assert [r.order_id for r in warehouse.fact().read().collect()] == [100]
    # The set-aside order was one of two; the other's total is now wrong.
    totals = warehouse.current("orders")
    totals.overwrite(totals.read().withColumn("order_total", F.lit("1.00").cast("decimal(12,2)")))
    with pytest.raises(QualityGateError, match="ORDER_TOTAL_RECONCILED"):
        quality.require_passed(warehouse.checks())


def test_catalog_and_lineage_of_the_real_tables(spark, sales, rows):
    """Dataset and column edges of the run's own tables refer to columns that exist."""
    warehouse, _, _ = sales
    frames = {f"log.{n}": warehouse.log(n).read().select(*SOURCES[n].columns) for n in SOURCES}
    frames |= {f"current.{n}": warehouse.current(n).read().drop("bucket") for n in SOURCES if n != "product_categories"}
    frames |= {f"star.{n}": warehouse.dimension(n).read() for n in DIMENSIONS}
    frames |= {"star.fact": warehouse.fact().read(), "serve.report": warehouse.report()}
    catalog = lineage.column_catalog(spark, frames)
    edges = [(f"current.{n}", f"log.{n}") for n in SOURCES if n != "product_categories"]
    edges += [("current.products", "log.product_categories")] + [(f"star.{n}", f"current.{n}") for n in DIMENSIONS]
    edges += [("star.fact", "current.orders"), ("star.fact", "current.order_items")]
    explicit = [("star.fact", "extended_amount", "current.order_items", "line_amount"),
                ("star.fact", "date_key", "current.orders", "order_date")]
    columns = catalog.select("dataset", "column")
    got = lineage.column_edges(columns, spark.createDataFrame(edges, "downstream string, upstream string"),
                               spark.createDataFrame(explicit, "downstream string, down_column string, upstream string, up_column string"))
    assert lineage.broken_edges(got, columns).count() == 0
    assert got.where("downstream = 'current.products' AND down_column = 'category_name'").first()["upstream"] == "log.product_categories"
    assert got.where("downstream = 'star.fact'").count() == 2
    assert got.where("downstream = 'star.customers' AND down_column = 'valid_from'").count() == 0


def test_small_files_are_read_without_a_job(spark, tmp_path):
    files.publish_json(spark, f"{tmp_path}/one.json", {"a": ["\u00e9", 1]})
    spark.sparkContext.setJobGroup("small-file", "small-file")
    try:
        assert files.read_json(spark, f"{tmp_path}/one.json") == {"a": ["\u00e9", 1]}
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("small-file")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
