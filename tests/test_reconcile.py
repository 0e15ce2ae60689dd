from datetime import date

from pyspark.sql import functions as F

from millrace.operators import metrics, reconcile


def test_checksums_find_changed_moved_swapped_and_lost_rows(spark, rows):
    sent = spark.range(3000).select("id", (F.col("id") % 7).alias("month"), (F.col("id") * 3).alias("amount"), F.when(F.col("id") % 2 == 0, "x").alias("note"))
    got = lambda other: rows(reconcile.differences(sent, other, ["id"], "month"))
    assert got(sent.repartition(5)) == []
    amount = F.when(F.col("id") == 10, 1).when(F.col("id") == 20, 63).when(F.col("id") == 21, 60).otherwise(F.col("amount"))
    month = F.when(F.col("id") == 30, 6).when(F.col("id") == 37, F.lit(None)).otherwise(F.col("month"))
    note = F.when(F.col("id") == 41, "new").otherwise(F.col("note"))
    changed = sent.select("id", month.alias("month"), amount.alias("amount"), note.alias("note")).where("id <> 50")
    extra = spark.createDataFrame([(9000, None, None, None)], "id long, month long, amount long, note string")
    assert got(changed.unionByName(extra)) == [
        (10, "amount"), (20, "amount"), (21, "amount"), (30, "month"), (37, "month"), (41, "note"), (50, None), (9000, None)]
    kept = reconcile.checksums(sent, ["month"])
    assert rows(reconcile.differences(sent, changed.where("month = 3 OR month IS NULL"), ["id"], "month", kept))[0][0] is not None


def report_of(spark, data):
    return spark.createDataFrame(data, "order_id long, order_date date, quantity int, extended_amount decimal(18,2), segment string, "
                                       "category_name string, region string, channel string")


def test_totals_follow_late_and_changed_orders(spark, tmp_path, rows):
    from decimal import Decimal
    line = lambda o, day, amount, segment="A", cat="c", region="R", channel="X": (o, day, 1, Decimal(amount), segment, cat, region, channel)
    jan, feb = date(2024, 1, 5), date(2024, 2, 5)
    before = [line(1, jan, "2.00"), line(1, jan, "3.00", cat="d", region="S"), line(2, jan, "1.00", segment=None), line(3, feb, "7.00", channel=None)]
    after = [*before[:3], line(3, feb, "8.50", channel=None), line(4, date(2024, 2, 6), "1.00", cat=None)]
    totals = metrics.MaintainedTotals.build(f"{tmp_path}/t", report_of(spark, before))
    january = set(totals.table.read(["2024-01-01"]).inputFiles())
    totals.refresh(report_of(spark, after), ["2024-02-01"])
    assert set(totals.table.read(["2024-01-01"]).inputFiles()) == january
    whole = report_of(spark, after)
    wanted = ["revenue", "units", "orders", "avg_line", "row_count"]
    for name, columns in metrics.GROUPED_BY.items():
        assert rows(totals.chart(wanted, name)) == rows(metrics.chart_query(whole, wanted, columns))
    for grain in metrics.GRAIN:
        assert rows(totals.chart(["revenue", "orders"], grain=grain)) == rows(metrics.chart_query(whole, ["revenue", "orders"], (), "order_date", grain))
    totals.refresh(report_of(spark, before[:3]), ["2024-02-01"])
    assert rows(totals.chart(["orders", "row_count"])) == [(2, 3)]
    empty = metrics.MaintainedTotals.build(f"{tmp_path}/none", report_of(spark, []))
    assert rows(empty.chart(wanted)) == rows(metrics.chart_query(report_of(spark, []), wanted))
