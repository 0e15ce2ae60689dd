"""Every operator as a query over the given tables: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import text
from millrace.operators import cards, history, keyed, lineage, metrics, plan_lineage, quality, reconcile, star
from millrace.plans import card_day, sales_day
from millrace.session import prepare, scratch
from millrace.sources import adapters as src
from millrace.sources import feeds, slices
from millrace.streaming import changes

MONEY = "decimal(18,2)"

# Dates the oracles repeat.
CUTOVER = date(1998, 6, 30)
RUN_DATE = date(2001, 12, 31)
NOW = datetime(2024, 1, 31, 6, 0, 0)
TODAY = date(2024, 1, 30)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    prepared.__name__, prepared.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = prepared
    return prepared


def _held(spark, df: DataFrame, name: str) -> DataFrame:
    """The frame as a written table, for work that reads it several times."""
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# ---- feeds -----------------------------------------------------------------------------------

@query
def stage_all_string_land(spark, sf_dir):
    """Write the authorisation feed as CSV by day, read it back as text with its business date."""
    path = scratch(spark, "inbound")
    feeds.write_text_feed(src.card_auth(spark, sf_dir), path, ["load_business_date"])
    raw = feeds.read_text_feed(spark, path, [*cards.AUTH_COLUMNS, "load_business_date"])
    return raw.withColumn("load_business_date", F.col("load_business_date").cast("date"))


AUTH_CASTS = {"auth_ts": "timestamp_ntz", "auth_amount": MONEY, "mcc": "int", "file_seq": "bigint"}


@query
def typed_landing_try_cast(spark, sf_dir):
    """Text columns cast by a per-table map; bad text becomes NULL."""
    return feeds.typed(src.card_auth(spark, sf_dir).drop("load_business_date", "card_number_hash"), AUTH_CASTS)


@query
def quarantine_bad_casts(spark, sf_dir):
    """Rows with a value that did not cast, with the columns at fault."""
    _, bad = feeds.split_bad_casts(src.card_auth(spark, sf_dir), AUTH_CASTS)
    return bad.select("txn_id", "file_seq", "auth_ts", "auth_amount", "mcc",
                      F.array_join("reasons", ",").alias("reasons"))


def _sources(spark, sf_dir):
    """Orders with notes that hold quotes, separators and line breaks, and their lines."""
    note = F.when(F.col("order_id") % 5 == 0, F.concat("status", F.lit(',\n"quoted"\r\n,'), F.col("order_id").cast("string")))
    return {
        "orders": src.orders(spark, sf_dir).withColumn("note", note)
        .withColumn("updated_at", F.col("order_date").cast("timestamp_ntz")),
        "order_items": src.raw_order_items(spark, sf_dir)
        .withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz")),
    }


LOW, HIGH = datetime(1998, 6, 30), datetime(2001, 6, 30)
EVER = datetime(2100, 1, 1)


@query
def watermark_extract(spark, sf_dir):
    """Order lines changed between two watermarks, both included."""
    return feeds.extract_window(_sources(spark, sf_dir)["order_items"], LOW, HIGH)


def _extracted(spark, sf_dir) -> str:
    """One run date extracted twice in full, as after a retry; the second attempt counts."""
    folder = scratch(spark, "feed")
    for _ in range(2):
        feeds.extract_feed(spark, _sources(spark, sf_dir), folder, f"{folder}-state", "shop", RUN_DATE, EVER, full=True)
    return folder


@query
def feed_manifest(spark, sf_dir):
    """Extract both tables as CSV and return the manifest; files are named by their attempt."""
    return feeds.read_manifest(spark, _extracted(spark, sf_dir)).withColumn(
        "file", F.regexp_replace("file", "_[0-9a-f]{32}", ""))


@query
def control_total_check(spark, sf_dir):
    """Manifest rows beside the rows read back from the feed's files."""
    folder = _extracted(spark, sf_dir)
    sources = _sources(spark, sf_dir)
    counted = None
    for name, (file, _) in feeds.manifest_entries(spark, folder, list(sources)).items():
        one = feeds.read_text_feed(spark, f"{folder}/{file}", sources[name].columns, line_breaks=True).agg(
            F.count(F.lit(1)).alias("rows_read")).select(F.lit(name).alias("table"), "rows_read")
        counted = one if counted is None else counted.unionByName(one)
    return feeds.control_totals(feeds.read_manifest(spark, folder), counted).select(
        F.col("table").alias("table_name"), "rows_expected", "rows_read", "agrees")


#: Run dates in the order they are extracted; the last one is late.
EXTRACTED = (date(1998, 6, 30), date(2000, 6, 30), date(1999, 6, 30))


@query
def incremental_extract(spark, sf_dir):
    """Three run dates, one late, each extracted twice: their windows, listed rows and what the files hold.

    The second attempt asks for a later end; the window stored first is what counts.
    """
    sources, root, out = _sources(spark, sf_dir), scratch(spark, "feed"), None
    for day in EXTRACTED:
        folder = f"{root}/{day.isoformat()}"
        for high in (datetime(day.year, day.month, day.day), EVER):
            feeds.extract_feed(spark, sources, folder, f"{root}/state", "shop", day, high)
        for name, (file, _) in feeds.manifest_entries(spark, folder, list(sources)).items():
            read = feeds.read_text_feed(spark, f"{folder}/{file}", sources[name].columns, line_breaks=True)
            held = read.agg(F.count(F.lit(1)).alias("rows_read"), F.sum(F.col("order_id").cast("bigint")).alias("id_sum"))
            one = feeds.read_manifest(spark, folder).where(F.col("table") == name).select(
                "run_date", F.col("table").alias("table_name"), "low_watermark", F.col("rows").alias("rows_listed")).join(held, how="left")
            out = one if out is None else out.unionByName(one)
    return out


@query
def csv_round_trip(spark, sf_dir):
    """A table with NULLs through the CSV sink and typed landing."""
    stores = src.stores(spark, sf_dir)
    path = scratch(spark, "csv")
    feeds.write_text_feed(stores, path)
    raw = feeds.read_text_feed(spark, path, stores.columns)
    return feeds.typed(raw, {"store_id": "bigint"})


# ---- tables ------------------------------------------------------------------------------------

@query
def idempotent_slice_reload(spark, sf_dir):
    """Load every business date, reload one with the same rows, empty another."""
    auth = src.card_auth(spark, sf_dir).select("txn_id", "auth_amount", "file_seq", "load_business_date")
    table = slices.SliceTable(spark, scratch(spark, "stage"), auth.schema, "load_business_date")
    table.overwrite(auth, ["txn_id"])
    again, emptied = "2024-01-10", "2024-01-20"
    table.replace_slices(auth.where(F.col("load_business_date") == F.lit(again).cast("date")), [again])
    table.replace_slices(auth.limit(0), [emptied])
    return table.read()


def _shipped(spark, sf_dir) -> tuple[slices.SliceTable, DataFrame]:
    lines = src.raw_order_items(spark, sf_dir).withColumn("ship_year", F.year("updated_at"))
    return slices.SliceTable(spark, scratch(spark, "lines"), lines.schema, "ship_year"), lines


@query
def compact_partition(spark, sf_dir):
    """Lines added by two loads, then each year rewritten as one; same rows."""
    table, lines = _shipped(spark, sf_dir)
    for half in (0, 1):
        table.append(lines.where(F.col("line_no") % 2 == half), batch=f"half {half}")
    table.replace_slices(table.read(), table.slices(), ["order_id"])
    return table.read()


@query
def file_profile(spark, sf_dir):
    """Rows per slice as counted from the files behind the table."""
    table, lines = _shipped(spark, sf_dir)
    table.commit(lines, order_by=["order_id"])
    return (
        table.file_profile()
        .withColumn("ship_year", F.regexp_extract("file_path", r"ship_year=(\d+)", 1).cast("int"))
        .groupBy("ship_year")
        .agg(F.sum("record_count").alias("record_count"), F.min(F.col("file_size") > 0).alias("has_bytes"))
    )


@query
def field_bytes(spark, sf_dir):
    """Bytes of text per column of the events table."""
    return slices.field_bytes(src.table(spark, sf_dir, "events"))


@query
def wide_column_sum(spark, sf_dir):
    """Sums over several columns; only these are read."""
    return src.table(spark, sf_dir, "lineitem").agg(
        F.sum(F.col("l_extendedprice").cast(MONEY)).cast(MONEY).alias("sum_price"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("sum_quantity"),
        F.sum("l_orderkey").alias("sum_orderkey"), F.count(F.lit(1)).alias("row_count"))


@query
def pushed_range_filter(spark, sf_dir):
    """A range and set predicate that reaches the Parquet reader."""
    return src.table(spark, sf_dir, "lineitem").where(
        (F.col("l_shipdate") >= F.lit(datetime(1998, 1, 1)).cast("timestamp_ntz"))
        & (F.col("l_shipdate") < F.lit(datetime(1999, 1, 1)).cast("timestamp_ntz"))
        & F.col("l_returnflag").isin("A", "R")
    ).select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("ship_date"))


# ---- keyed tables --------------------------------------------------------------------------------

@query
def latest_per_key_lineitem(spark, sf_dir):
    """The latest copy of each order line."""
    return src.order_items(spark, sf_dir)


@query
def conform_customer(spark, sf_dir):
    return src.raw_customers(spark, sf_dir).select(
        "customer_id", text.title("first_name").alias("first_name"), text.title("last_name").alias("last_name"),
        text.lower("email").alias("email"), text.upper("segment").alias("segment"), text.title("city").alias("city"),
        text.upper("state").alias("state"), text.upper("country").alias("country"), "balance")


@query
def conform_product(spark, sf_dir):
    """Products with the current name of their category, looked up over the whole category history."""
    names = keyed.latest_per_key(src.category_log(spark, sf_dir), ["category_id"], [F.col("version").desc()]).select(
        "category_id", text.plain("category_name").alias("category_name"))
    return src.raw_products(spark, sf_dir).join(names, "category_id", "left").select(
        "product_id", text.upper("sku").alias("sku"), text.plain("product_name").alias("product_name"),
        "category_id", "category_name", "unit_price", "active_flag")


@query
def conform_store(spark, sf_dir):
    return src.stores(spark, sf_dir).select(
        "store_id", text.plain("store_name").alias("store_name"), text.upper("channel").alias("channel"),
        text.plain("region").alias("region"), text.title("city").alias("city"),
        text.upper("state").alias("state"), text.upper("country").alias("country"))


@query
def conform_orders(spark, sf_dir):
    """The latest state of every order over all feed slices."""
    feed = src.order_feed(spark, sf_dir)
    return keyed.latest_per_key(feed, ["order_id"], [F.col("updated_at").desc()]).select(
        "order_id", "customer_id", "order_date", text.upper("status").alias("status"), "order_total", "updated_at")


def _before_and_after(spark, sf_dir):
    """Orders up to the cutover as placed, and a feed of the later ones plus final states of earlier."""
    orders = src.orders(spark, sf_dir).drop("order_ts")
    early = orders.where(F.col("order_date") <= F.lit(CUTOVER)).withColumn("status", F.lit("PLACED"))
    fed = orders.where((F.col("order_date") > F.lit(CUTOVER)) | (F.col("status") == "DELIVERED")).withColumn(
        "order_total", F.col("order_total") + F.lit(1).cast(MONEY)).withColumn("order_total", F.col("order_total").cast(MONEY))
    return early, fed


@query
def keyed_upsert(spark, sf_dir):
    """Whole-row upsert of a feed into a stored table, sliced by order year."""
    early, fed = _before_and_after(spark, sf_dir)
    year = F.year("order_date").alias("order_year")
    early, fed = early.select("*", year), fed.select("*", year)
    table = slices.SliceTable(spark, scratch(spark, "orders"), early.schema, "order_year")
    table.commit(early)
    table.merge(fed, ["order_id"], lambda kept, new: keyed.upsert(kept, new, ["order_id"], check=False),
                slice_of_key=True)  # an order keeps its date
    return table.read()


class _Killed(Exception):
    pass


@query
def keyed_upsert_after_crash(spark, sf_dir):
    """The same upsert, killed once after each kind of step and repeated; a reader beside it sees one state or the other.

    ``states`` is how many different row counts readers saw after the kills: the one before and the one after.
    """
    early, fed = _before_and_after(spark, sf_dir)
    year = F.year("order_date").alias("order_year")
    early, fed = early.select("*", year), fed.select("*", year)
    path = scratch(spark, "orders")
    seen, done = set(), set()

    def die_once(step: str) -> None:
        if step not in done:
            done.add(step)
            raise _Killed(step)

    slices.SliceTable(spark, path, early.schema, "order_year").overwrite(early)
    while True:
        try:
            slices.SliceTable(spark, path, early.schema, "order_year", on_step=die_once).merge(
                fed, ["order_id"], lambda kept, new: keyed.upsert(kept, new, ["order_id"], check=False), slice_of_key=True)
            break
        except _Killed:
            seen.add(slices.SliceTable(spark, path, early.schema, "order_year", reading=True).read().count())
    return slices.SliceTable(spark, path, early.schema, "order_year").read().withColumn("states", F.lit(len(seen)))


@query
def partial_upsert_status(spark, sf_dir):
    """Only the status of matched orders changes; new orders are inserted whole."""
    early, fed = _before_and_after(spark, sf_dir)
    return keyed.upsert_columns(early, fed, ["order_id"], ["status"])


@query
def definition_changelog(spark, sf_dir):
    """Customers whose published attribute is new or differs from what was published at the cutover."""
    log = src.priority_log(spark, sf_dir)
    newest = [F.col("effective").desc(), F.col("order_id").desc()]
    known = keyed.latest_per_key(log.where(F.col("effective") <= F.lit(CUTOVER)), ["customer_id"], newest)
    published = keyed.latest_per_key(log, ["customer_id"], newest)
    return keyed.definition_changes(known, published, ["customer_id"], ["priority"]).select(
        "customer_id", "priority", "change")


# ---- history -------------------------------------------------------------------------------------

PRIORITY = history.Dimension("customer_id", "customer_key", ("priority",), ("priority",))


def _state_at(log: DataFrame, day: date | None) -> DataFrame:
    seen = log if day is None else log.where(F.col("effective") <= F.lit(day))
    return keyed.latest_per_key(seen, ["customer_id"], [F.col("effective").desc(), F.col("order_id").desc()])


INTERVAL = ["customer_id", "priority", "valid_from", "valid_to", "is_current"]


@query
def scd2_onboard(spark, sf_dir):
    """Every customer's state at the cutover as one open version."""
    return history.onboard(_state_at(src.priority_log(spark, sf_dir), CUTOVER), PRIORITY).select(*INTERVAL)


@query
def scd2_daily_merge(spark, sf_dir):
    """The onboarded dimension after a feed of every customer's final state."""
    log = src.priority_log(spark, sf_dir)
    dimension = history.onboard(_state_at(log, CUTOVER), PRIORITY)
    return history.merge_day(dimension, _state_at(log, None), PRIORITY, RUN_DATE).select(*INTERVAL)


def _replayed(spark, sf_dir) -> DataFrame:
    return history.replay(src.priority_log(spark, sf_dir), PRIORITY, "effective", [F.col("order_id").desc()])


@query
def scd2_replay(spark, sf_dir):
    """All versions rebuilt from the dated log."""
    return _replayed(spark, sf_dir).select(*INTERVAL)


@query
def surrogate_key_properties(spark, sf_dir):
    """Distinct keys against distinct hashes, for versions and for fact lines."""
    versions = _replayed(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("customer_key").alias("distinct_keys"))
    lines = src.raw_order_items(spark, sf_dir).select("order_id", "line_no").distinct().agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(F.xxhash64("order_id", "line_no")).alias("distinct_keys"))
    return versions.select(F.lit("versions").alias("what"), "*").unionByName(
        lines.select(F.lit("lines").alias("what"), "*"))


def _line_heads(spark, sf_dir, heads: DataFrame) -> DataFrame:
    return src.order_items(spark, sf_dir).select("order_id", "line_no").join(heads, "order_id")


@query
def point_in_time_join(spark, sf_dir):
    """Each line with the customer priority valid on its order date, looked up once per order."""
    heads = history.as_of_join(
        src.orders(spark, sf_dir).select("order_id", "customer_id", "order_date"), _replayed(spark, sf_dir),
        "customer_id", "order_date", "customer_id", ["priority", "valid_from"])
    return _line_heads(spark, sf_dir, heads).select(
        "order_id", "line_no", "customer_id", "order_date", "priority", "valid_from")


@query
def current_state_join(spark, sf_dir):
    """Each line with the customer priority of today."""
    heads = history.current_join(
        src.orders(spark, sf_dir).select("order_id", "customer_id", "order_date"), _replayed(spark, sf_dir),
        "customer_id", "customer_id", ["priority"])
    return _line_heads(spark, sf_dir, heads).select(
        "order_id", "line_no", "customer_id", "order_date", "priority")


# ---- star ----------------------------------------------------------------------------------------

# The customers here have a priority instead of a signup date, and versions by it.
CUSTOMER = replace(sales_day.DIMENSIONS["customers"], attributes=(
    *sales_day.DIMENSIONS["customers"].attributes[:-1], "priority"), tracked=("priority",))
PRODUCT, STORE = sales_day.DIMENSIONS["products"], sales_day.DIMENSIONS["stores"]


def _calendar(spark, sf_dir) -> DataFrame:
    return star.calendar_over(src.orders(spark, sf_dir).agg(
        F.trunc(F.min("order_date"), "YEAR").alias("first"), F.last_day(F.max("order_date")).alias("last")))


def _customer_history(spark, sf_dir) -> DataFrame:
    return _replayed(spark, sf_dir).join(src.customers(spark, sf_dir), "customer_id").select(*CUSTOMER.columns)


# Surrogate name -> builder; the customer dimension has real versions.
DIMENSIONS = {
    "customer_key": _customer_history,
    "product_key": lambda spark, sf_dir: history.onboard(src.products(spark, sf_dir), PRODUCT),
    "store_key": lambda spark, sf_dir: history.onboard(src.stores(spark, sf_dir), STORE),
    "date_key": _calendar,
}


def sales_report(spark, sf_dir, columns: list[str]) -> DataFrame:
    """The wide report, cut to some columns; the rows do not depend on which."""
    dims = {surrogate: build(spark, sf_dir) for surrogate, build in DIMENSIONS.items()}
    return star.report_of(src.order_items(spark, sf_dir), src.orders(spark, sf_dir), dims, columns)


@query
def dim_date(spark, sf_dir):
    """Calendar over the years the orders span."""
    return _calendar(spark, sf_dir)


@query
def sales_report_wide(spark, sf_dir):
    """The full report at order-line grain."""
    return sales_report(spark, sf_dir, star.REPORT_COLUMNS)


#: Where an application keeps the totals of a folder of tables; the tables do not change while it runs.
_TOTALS: dict[tuple[str, str], str] = {}


def _totals(spark, sf_dir) -> metrics.MaintainedTotals:
    """The totals of the sales report, built once per application and folder and read by all metric queries."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at in _TOTALS:
        kept = metrics.MaintainedTotals(spark, _TOTALS[at], T.StructType())
        if kept.table.exists():
            return metrics.MaintainedTotals(spark, _TOTALS[at])
    path = scratch(spark, "totals")
    out = metrics.MaintainedTotals.build(path, sales_report(spark, sf_dir, metrics.REPORT_NEEDED))
    _TOTALS[at] = path
    return out


@query
def maintained_totals(spark, sf_dir):
    """Totals built without every seventh order, then refreshed for the months of these late orders: orders and revenue by
    month, region and channel."""
    report = _held(spark, sales_report(spark, sf_dir, metrics.REPORT_NEEDED), "report")
    late = F.col("order_id") % 7 == 0
    totals = metrics.MaintainedTotals.build(scratch(spark, "totals"), report.where(~late))
    months = [str(r[0]) for r in report.where(late).select(F.trunc("order_date", "MONTH")).distinct().collect()]
    totals.refresh(report, months)
    return totals.table.read().where("grouped_by = 'region_channel'").groupBy("month", "region", "channel").agg(
        F.sum("revenue").cast(MONEY).alias("revenue"), F.sum("orders").alias("orders"))


@query
def revenue_total(spark, sf_dir):
    return _totals(spark, sf_dir).chart(["revenue", "units", "orders", "avg_line", "row_count"])


@query
def revenue_by_month(spark, sf_dir):
    return _totals(spark, sf_dir).chart(["revenue"], grain="P1M")


@query
def revenue_by_segment(spark, sf_dir):
    return _totals(spark, sf_dir).chart(["revenue"], "segment", descending_by="revenue", limit=100)


@query
def top_categories(spark, sf_dir):
    return _totals(spark, sf_dir).chart(["revenue", "units", "orders"], "category", descending_by="revenue", limit=10)


@query
def revenue_region_channel(spark, sf_dir):
    return _totals(spark, sf_dir).chart(["revenue", "orders"], "region_channel", descending_by="revenue", limit=50)


# ---- cards -----------------------------------------------------------------------------------------

def _reference(spark, sf_dir):
    """Cards from the customers, merchants from the suppliers, one category code for each of these."""
    number = lambda name, column: src.table(spark, sf_dir, name).select(F.col(column).alias("n"))
    return (cards.card_reference(number("customer", "c_custkey")),
            cards.merchant_reference(number("supplier", "s_suppkey")), cards.mcc_reference(number("supplier", "s_suppkey")))


def card_transactions(spark, sf_dir) -> DataFrame:
    card, merchant, mcc = _reference(spark, sf_dir)
    return cards.integrate(src.card_auth(spark, sf_dir), src.card_post(spark, sf_dir), card, merchant, mcc)


@query
def reference_seed(spark, sf_dir):
    """Card reference rows, one per customer."""
    return _reference(spark, sf_dir)[0]


@query
def reference_merchants(spark, sf_dir):
    """Merchant reference rows, one per supplier, with their category."""
    _, merchant, codes = _reference(spark, sf_dir)
    return merchant.join(codes, "mcc").select("merchant_id", "merchant_name", "mcc", "mcc_category", "country")


@query
def reference_verify(spark, sf_dir):
    """Stacked counts of the three reference tables."""
    card, merchant, mcc = _reference(spark, sf_dir)
    return cards.reference_profile(mcc, merchant, card)


@query
def card_txn_integration(spark, sf_dir):
    return card_transactions(spark, sf_dir)


@query
def card_txn_decline(spark, sf_dir):
    return cards.declines(card_transactions(spark, sf_dir))


@query
def daily_card_summary(spark, sf_dir):
    return cards.daily_summary(card_transactions(spark, sf_dir))


@query
def card_top_merchants(spark, sf_dir):
    return cards.top_merchants(card_transactions(spark, sf_dir))


# ---- quality ---------------------------------------------------------------------------------------

RESULT = ["table_name", "business_date", "check_code", "field", "level", "actual", "status", "expected_1", "expected_2"]


def _staged(df: DataFrame) -> DataFrame:
    """Stage rows with a load time six hours after their business date ends."""
    day = "load_business_date" if "load_business_date" in df.columns else "txn_date"
    return df.withColumn("loaded_at", F.col(day).cast("timestamp_ntz") + F.expr("INTERVAL 30 HOURS"))


@query
def dq_mandatory(spark, sf_dir):
    """The five mandatory checks of the two stage tables, for every business date."""
    frames = {"card_auth": _staged(src.card_auth(spark, sf_dir)), "card_post": _staged(src.card_post(spark, sf_dir))}
    return quality.run(quality.card_mandatory(frames, NOW, TODAY)).select(*RESULT)


@query
def dq_stage_custom(spark, sf_dir):
    """The seven field checks of the stage tables, for every business date."""
    return quality.run(quality.stage_checks(src.card_auth(spark, sf_dir), src.card_post(spark, sf_dir))).select(*RESULT)


@query
def dq_card_reports(spark, sf_dir):
    """Mandatory and custom checks of the integration and report tables, for every date."""
    txn = card_transactions(spark, sf_dir)
    held = {"card_txn": _held(spark, _staged(txn), "card_txn")}
    for name, build in (("card_txn_decline", cards.declines), ("daily_card_summary", cards.daily_summary),
                        ("card_top_merchants", cards.top_merchants)):
        held[name] = _staged(build(held["card_txn"]))
    sets = (quality.card_mandatory(held, NOW, TODAY)
            + quality.integration_checks(held["card_txn"], held["card_txn_decline"])
            + quality.report_checks(held["daily_card_summary"], held["card_top_merchants"]))
    return quality.run(sets).select(*RESULT)


@query
def dq_star(spark, sf_dir):
    """Grain, references, reconciliation and version checks of the star."""
    dims = {k: DIMENSIONS[k](spark, sf_dir) for k in ("customer_key", "product_key", "store_key")}
    dims["customer_key"] = _held(spark, dims["customer_key"], "customers")  # replayed once for all its uses
    orders = src.orders(spark, sf_dir)
    fact = star.build_fact(src.order_items(spark, sf_dir), orders, dims)
    sets = [quality.fact_checks(fact, orders, ["customer_key", "product_key", "store_key"]),
            *quality.dimension_checks("dim_customer", dims["customer_key"], "customer_id", "customer_key"),
            *quality.dimension_checks("dim_product", dims["product_key"], "product_id", "product_key"),
            *quality.dimension_checks("dim_store", dims["store_key"], "store_id", "store_key")]
    return quality.run(sets).select("table_name", "check_code", "field", "level", "actual", "status")


@query
def dq_result_history(spark, sf_dir):
    """Results of two runs appended to one table."""
    sets = quality.stage_checks(src.card_auth(spark, sf_dir), src.card_post(spark, sf_dir))
    results = quality.run(sets)
    table = None
    for run_at in (NOW, datetime(2024, 2, 1, 6, 0, 0)):
        events = quality.run_events(results, "shop", "stage", run_at).withColumn("run_date", F.to_date("run_at"))
        table = table or slices.SliceTable(spark, scratch(spark, "results"), events.schema, "run_date")
        table.append(events, batch=run_at.isoformat())
        table.append(events, batch=run_at.isoformat())
    return table.read().select("check_id", "run_at", "business_date", "result_type", "status",
                               F.col("actual_text").cast("bigint").alias("actual"))


# ---- metadata --------------------------------------------------------------------------------------

CATALOGED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
             "pages", "benchmark", "labels", "conversations"]


@query
def column_catalog(spark, sf_dir):
    """Every column of the given tables with its type classes and the row count of its table."""
    frames = {t: src.table(spark, sf_dir, t) for t in CATALOGED}
    counts = None
    for name, df in frames.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("dataset"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    return lineage.column_catalog(spark, frames).join(counts, "dataset").select(
        "dataset", "position", F.col("column").alias("column_name"), "type_class", "name_class", "row_count")


def _label(kind: str, column: str):
    return F.concat(F.lit(kind + ":"), F.col(column).cast("string"))


def _jobs(spark, sf_dir) -> DataFrame:
    """Each order line as a job that reads a part and a supplier and feeds an order."""
    return src.table(spark, sf_dir, "lineitem").select(
        F.concat(_label("line", "l_orderkey"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("job"),
        F.array(_label("part", "l_partkey"), _label("supplier", "l_suppkey")).alias("inputs"),
        F.array(_label("order", "l_orderkey")).alias("outputs"))


@query
def process_lineage(spark, sf_dir):
    return lineage.process_edges(_jobs(spark, sf_dir))


def _catalog_of_orders(spark, sf_dir):
    """Orders as datasets whose columns are their suppliers, derived from the customer's first order.

    A catalog is a stored table, so columns and links are written once.
    """
    lines = src.table(spark, sf_dir, "lineitem")
    columns = lines.select(_label("order", "l_orderkey").alias("dataset"),
                           _label("supplier", "l_suppkey").alias("column")).distinct()
    columns = _held(spark, columns, "columns")
    orders = src.table(spark, sf_dir, "orders")
    first = orders.groupBy("o_custkey").agg(F.min(F.struct("o_orderdate", "o_orderkey")).alias("f")).select(
        "o_custkey", F.col("f.o_orderkey").alias("first_order"))
    linked = orders.join(first, "o_custkey").where("o_orderkey <> first_order").select(
        _label("order", "o_orderkey").alias("downstream"), _label("order", "first_order").alias("upstream"),
        "o_orderstatus")
    linked = _held(spark, linked, "links")
    explicit = linked.where("o_orderstatus = 'P'").select(
        "downstream", F.lit("total").alias("down_column"), "upstream", F.lit("total").alias("up_column"))
    return columns, linked.select("downstream", "upstream"), explicit


@query
def column_lineage(spark, sf_dir):
    """Column edges by explicit map or equal name."""
    columns, edges, explicit = _catalog_of_orders(spark, sf_dir)
    return lineage.column_edges(columns, edges, explicit)


@query
def lineage_sanity(spark, sf_dir):
    """Column edges that name a column nobody has."""
    columns, edges, explicit = _catalog_of_orders(spark, sf_dir)
    return lineage.broken_edges(lineage.column_edges(columns, edges, explicit), columns)


#: What the outputs below are made of.
LINEAGE_SOURCES = ("customer", "nation", "region", "orders", "lineitem", "part", "supplier", "events")


def _output_edges(spark, sf_dir) -> DataFrame:
    """Column edges of two outputs of this library, from their plans, with the row count of the table that each comes from."""
    sources = {t: src.table(spark, sf_dir, t) for t in LINEAGE_SOURCES}
    outputs = {"sales_report_wide": sales_report_wide(spark, sf_dir), "card_txn": card_txn_integration(spark, sf_dir)}
    counts = reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("upstream"), "row_count") for t, df in sources.items()])
    return plan_lineage.plan_edges(spark, outputs, sources).join(counts, "upstream").select(
        "downstream", "down_column", "upstream", "up_column", "row_count")


@query
def output_lineage(spark, sf_dir):
    """Which columns of the given tables every column of the sales report and of the card transactions comes from."""
    return _output_edges(spark, sf_dir)


@query
def output_lineage_after_rename(spark, sf_dir):
    """Edges that break when a customer's name and a supplier's nation are called otherwise, with the rows behind each."""
    edges = _output_edges(spark, sf_dir)
    renamed = {"customer": {"c_name": "c_full_name"}, "supplier": {"s_nationkey": "s_nation_id"}}
    frames = {t: src.table(spark, sf_dir, t).withColumnsRenamed(renamed.get(t, {})) for t in LINEAGE_SOURCES}
    frames |= {"sales_report_wide": sales_report_wide(spark, sf_dir), "card_txn": card_txn_integration(spark, sf_dir)}
    broken = lineage.broken_edges(edges, lineage.column_catalog(spark, frames))
    return broken.join(edges, ["downstream", "down_column", "upstream", "up_column"])


@query
def lineage_closure(spark, sf_dir):
    """What each region reaches through nation, customer and order within five steps."""
    def edge(table, up_kind, up, down_kind, down):
        return src.table(spark, sf_dir, table).select(
            _label(up_kind, up).alias("upstream"), _label(down_kind, down).alias("downstream"))

    edges = (edge("nation", "region", "n_regionkey", "nation", "n_nationkey")
             .unionByName(edge("customer", "nation", "c_nationkey", "customer", "c_custkey"))
             .unionByName(edge("orders", "customer", "o_custkey", "order", "o_orderkey"))
             .unionByName(edge("lineitem", "order", "l_orderkey", "supplier", "l_suppkey"))
             .unionByName(edge("supplier", "supplier", "s_suppkey", "nation", "s_nationkey")))
    roots = src.table(spark, sf_dir, "region").select(_label("region", "r_regionkey").alias("node"))
    return lineage.reachable(spark, edges, roots, hops=5)


@query
def ids_from_urls(spark, sf_dir):
    """Identifiers in page URLs: path parts that start with a letter code, and query values."""
    pages = src.table(spark, sf_dir, "pages")
    found = text.ids_in_url(F.col("url"), in_path=r"/([a-z]{2}/[0-9]+)", value_prefix="f")
    return pages.select("page_id", F.array_join(found, " ").alias("ids"), F.size(found).alias("id_count"))


# ---- change streams --------------------------------------------------------------------------------

CHANGE_ROW = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("note", T.StringType()),
                           T.StructField("created_at", T.StringType())])


def _change_folder(spark, sf_dir) -> str:
    folder = scratch(spark, "changes")
    src.change_events(spark, sf_dir).repartition(4, "event_id").select("value").write.parquet(folder)
    return folder


@query
def cdc_land_inserts(spark, sf_dir):
    """Inserted rows landed by a drained stream; a second run adds nothing."""
    folder, out, mark = _change_folder(spark, sf_dir), scratch(spark, "landed"), scratch(spark, "mark")
    for _ in range(2):
        changes.land_inserts(changes.open_stream(spark, "parquet", folder), CHANGE_ROW, out, mark)
    return spark.read.schema(CHANGE_ROW).parquet(out)


@query
def cdc_apply(spark, sf_dir):
    """The table of live rows after all inserts, updates and deletes, applied in two batches."""
    folder, mark = _change_folder(spark, sf_dir), scratch(spark, "mark")
    state = slices.SliceTable(spark, scratch(spark, "state"), changes.state_schema(CHANGE_ROW), "bucket")
    stream = changes.open_stream(spark, "parquet", folder, maxFilesPerTrigger="2")
    changes.apply_changes(stream, CHANGE_ROW, "id", state, mark)
    return changes.live_rows(state, CHANGE_ROW)


@query
def stream_history(spark, sf_dir):
    """Customer priorities as change events, streamed in batches of two files; every version is kept."""
    log = src.priority_log(spark, sf_dir)
    image = F.struct("customer_id", "priority", F.col("effective").cast("string").alias("effective"))
    event = F.to_json(F.struct(F.lit("u").alias("op"), image.alias("after"), F.struct(F.col("order_id").alias("seq")).alias("source")))
    folder, mark = scratch(spark, "priorities"), scratch(spark, "mark")
    log.select(event.alias("value"), "order_id").repartition(4, "order_id").select("value").write.parquet(folder)
    row = T.StructType([T.StructField("customer_id", T.LongType()), T.StructField("priority", T.StringType()),
                        T.StructField("effective", T.StringType())])
    daily = slices.SliceTable(spark, scratch(spark, "daily"), changes.daily_schema(row), "bucket")
    changes.daily_rows(changes.open_stream(spark, "parquet", folder, maxFilesPerTrigger="2"), row, "customer_id", "effective", daily, mark)
    return changes.history_of(daily, PRIORITY).select(*INTERVAL)


@query
def stream_history_deletes(spark, sf_dir):
    """As ``stream_history``, but every seventh order deletes its customer; versions have gaps."""
    log = src.priority_log(spark, sf_dir)
    image = F.struct("customer_id", "priority", F.col("effective").cast("string").alias("effective"))
    old = F.struct("customer_id", "priority", F.lit("1900-01-01").alias("effective"))
    deletes = F.col("order_id") % 7 == 0
    event = F.to_json(F.struct(
        F.when(deletes, "d").otherwise("u").alias("op"), F.when(deletes, old).alias("before"), F.when(~deletes, image).alias("after"),
        F.struct(F.col("order_id").alias("seq")).alias("source"),
        F.when(deletes, F.unix_millis(F.col("effective").cast("timestamp"))).alias("ts_ms")))
    folder, mark = scratch(spark, "priorities"), scratch(spark, "mark")
    log.select(event.alias("value"), "order_id").repartition(4, "order_id").select("value").write.parquet(folder)
    row = T.StructType([T.StructField("customer_id", T.LongType()), T.StructField("priority", T.StringType()),
                        T.StructField("effective", T.StringType())])
    daily = slices.SliceTable(spark, scratch(spark, "daily"), changes.daily_schema(row), "bucket")
    changes.daily_rows(changes.open_stream(spark, "parquet", folder, maxFilesPerTrigger="2"), row, "customer_id", "effective", daily, mark)
    return changes.history_of(daily, PRIORITY).select(*INTERVAL)


def _late(spark, sf_dir) -> tuple[DataFrame, DataFrame, date]:
    """The dated log without every tenth order, these orders, and the log's first day."""
    log = _held(spark, src.priority_log(spark, sf_dir), "log")
    late = F.col("order_id") % 10 == 3
    return log.where(~late), log.where(late), log.agg(F.min("effective")).first()[0]


@query
def late_feed_splice(spark, sf_dir):
    """A history without every tenth order, then these arrive: the versions of a replay of all."""
    log, late, first = _late(spark, sf_dir)
    known = history.replay(log, PRIORITY, "effective", [F.col("order_id").desc()], first)
    return history.splice(known, log, late, PRIORITY, "effective", [F.col("order_id").desc()], first).select(*INTERVAL)


@query
def late_feed_rekey(spark, sf_dir):
    """Orders keyed by the history without the late ones, then keyed again where versions changed."""
    log, late, first = _late(spark, sf_dir)
    known = _held(spark, history.replay(log, PRIORITY, "effective", [F.col("order_id").desc()], first), "versions")
    after = _held(spark, history.splice(known, log, late, PRIORITY, "effective", [F.col("order_id").desc()], first), "versions")
    orders = src.orders(spark, sf_dir).select("order_id", "customer_id", "order_date")
    taken = ["priority", "valid_from"]
    facts = _held(spark, history.as_of_join(orders, known, "customer_id", "order_date", "customer_id", taken), "facts")
    return history.rekey(facts, known, after, PRIORITY, "customer_id", "order_date", taken)


#: The days of ``sales_days``; the late one is fed last.
FIRST_DAY, SECOND_DAY, LATE_DAY = date(1999, 6, 30), date(2000, 6, 30), date(1999, 12, 31)


def _day_feed(spark, sf_dir, root: str, day: date, customers: DataFrame, orders: DataFrame, lines: DataFrame, totals: DataFrame,
              with_static: bool = False, spoil: bool = False) -> str:
    """One day's feed: its customers, its orders with all their lines, on the first day also products and stores.

    Order totals are the sums of the lines; ``spoil`` makes one wrong.
    """
    stamps = [F.lit(f"{day} 00:00:00").alias("created_at"), F.lit(f"{day} 00:00:00").alias("updated_at")]
    heads = orders.drop("order_total").join(totals, "order_id")
    if spoil:
        wrong = orders.agg(F.min("order_id").alias("_wrong"))
        heads = heads.join(wrong, F.col("order_id") == F.col("_wrong"), "left") \
            .withColumn("order_total", F.col("order_total") + F.when(F.col("_wrong").isNotNull(), 1).otherwise(0)).drop("_wrong")
    static = lambda df: df if with_static else df.limit(0)
    tables = {
        "product_categories": static(src.category_log(spark, sf_dir).dropDuplicates(["category_id"]).select("category_id", "category_name", *stamps)),
        "customers": customers.select("*", F.lit("1998-01-01").alias("signup_date"), *stamps),
        "products": static(src.products(spark, sf_dir).drop("category_name").select("*", *stamps)),
        "stores": static(src.stores(spark, sf_dir).select("*", *stamps)),
        "orders": heads.select("*", *stamps),
        "order_items": lines.join(orders.select("order_id"), "order_id").drop("store_id").select("*", *stamps),
    }
    folder = f"{root}/feed-{day}-{'spoilt' if spoil else 'right'}"
    feeds.extract_feed(spark, tables, folder, f"{root}/state", "shop", day, EVER, full=True)
    return folder


@query
def sales_days(spark, sf_dir):
    """Three days through the sales warehouse: the report after them, and how many days the gate refused.

    Every tenth customer is missing on the first day, so their lines wait.  The second day's feed has a wrong total and is refused, then fed
    again.  Last comes a late feed of a day between: it brings the missing customers, whose lines leave the queue where they are
    dated after it, and changes a segment that a later day changed again.
    """
    root = scratch(spark, "sales")
    warehouse = sales_day.SalesWarehouse(spark, f"{root}/wh", date(1990, 1, 1), date(2010, 12, 31), buckets=4, monthly_fact=True)
    people, orders = src.customers(spark, sf_dir), src.orders(spark, sf_dir)
    # All lines and their sums are the same for every feed.
    lines = _held(spark, src.order_items(spark, sf_dir).drop("updated_at"), "lines")
    totals = _held(spark, lines.groupBy("order_id").agg(
        F.sum("line_amount").cast("decimal(12,2)").alias("order_total"), F.min("store_id").alias("store_id")), "totals")
    feed = lambda *day, **more: _day_feed(spark, sf_dir, root, *day, lines, totals, **more)
    missing = F.col("customer_id") % 10 == 3
    early = orders.where(F.col("order_date") <= F.lit(FIRST_DAY))
    fed_again = early.where(F.col("order_id") % 5 == 0).unionByName(
        orders.where(F.col("order_date").between(F.lit(FIRST_DAY) + F.expr("INTERVAL 1 DAY"), F.lit(SECOND_DAY))))
    segment = lambda every, name: people.where(F.col("customer_id") % every == 0).withColumn("segment", F.lit(name))
    first = feed(FIRST_DAY, people.where(~missing), early.withColumn("status", F.lit(" placed ")), with_static=True)
    warehouse.run(first, FIRST_DAY, set_aside=True)
    served, refused = warehouse.report().count(), 0
    try:
        warehouse.run(feed(SECOND_DAY, segment(4, "vip"), fed_again, spoil=True), SECOND_DAY, set_aside=True)
    except quality.QualityGateError:
        refused += warehouse.report().count() == served
    warehouse.run(feed(SECOND_DAY, segment(4, "vip"), fed_again), SECOND_DAY, set_aside=True)
    late = people.where(missing).unionByName(segment(8, "mid"))
    report = warehouse.run(feed(LATE_DAY, late, orders.limit(0)), LATE_DAY, set_aside=True)
    return report.select("order_id", "line_no", "status", "customer_id", "segment", "order_date", "extended_amount").withColumn(
        "refused_days", F.lit(refused)).withColumn("still_waiting", F.lit(warehouse.queue().read().count()).cast("bigint"))


@query
def value_control_totals(spark, sf_dir):
    """Orders and their received copy, in which some totals changed or changed places and some orders moved to another month."""
    orders = src.orders(spark, sf_dir).select("order_id", "customer_id", "order_date", "order_total")
    month = F.trunc("order_date", "MONTH").alias("month")
    slot = F.col("order_id") % 1000
    partner = orders.where(slot.isin(3, 4)).select(
        F.when(slot == 3, F.col("order_id") + 1).otherwise(F.col("order_id") - 1).alias("order_id"), F.col("order_total").alias("_other"))
    received = orders.join(partner, "order_id", "left").select(
        "order_id", "customer_id",
        F.when(slot == 2, F.add_months("order_date", 1)).otherwise(F.col("order_date")).alias("order_date"),
        F.when(slot == 1, F.col("order_total") + 1).otherwise(F.coalesce("_other", "order_total")).cast(MONEY).alias("order_total"))
    return reconcile.differences(orders.select("*", month), received.select("*", month), ["order_id"], "month")


@query
def ingest_stamp(spark, sf_dir):
    """Landed orders with the run date and the file they came from."""
    folder = _extracted(spark, sf_dir)
    columns = ["order_id", "status", "note"]
    file, _ = feeds.manifest_entries(spark, folder, ["orders"])["orders"]
    raw = feeds.read_text_feed(spark, f"{folder}/{file}", columns, line_breaks=True)
    return feeds.stamp_ingest(raw, RUN_DATE, file).select(
        F.col("order_id").cast("bigint").alias("order_id"), "status", "note", F.col("_run_date").alias("run_date"),
        F.regexp_replace("_source_file", "_[0-9a-f]{32}", "").alias("source_file"),
        F.col("_ingested_at").isNotNull().alias("is_stamped"))


@query
def table_edges(spark, sf_dir):
    """Which given table feeds which of the library's own, with the rows that are read."""
    jobs = [("customers", ["customer", "nation", "region"], ["dim_customer"]), ("priorities", ["orders"], ["dim_customer"]),
            ("products", ["part"], ["dim_product"]), ("stores", ["supplier", "nation", "region"], ["dim_store"]),
            ("sales", ["orders", "lineitem"], ["fact_sales"]), ("cards", ["events", "customer", "supplier"], ["card_txn"])]
    edges = lineage.dataset_edges(spark.createDataFrame(jobs, "job string, inputs array<string>, outputs array<string>"))
    counts = None
    for name in ("customer", "nation", "region", "orders", "part", "supplier", "lineitem", "events"):
        one = src.table(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("upstream"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    return edges.join(counts, "upstream").select(
        text.dataset_id(F.lit("parquet"), F.lit("given"), F.col("upstream"), F.lit("PROD")).alias("upstream"),
        text.dataset_id(F.lit("parquet"), F.lit("star"), F.col("downstream"), F.lit("PROD")).alias("downstream"), "row_count")


def _period_end(day):
    """The 10th, the 20th or the last of the month."""
    return F.when(F.dayofmonth(day) <= 10, F.date_add(F.trunc(day, "MONTH"), 9)).when(
        F.dayofmonth(day) <= 20, F.date_add(F.trunc(day, "MONTH"), 19)).otherwise(F.last_day(day))


@query
def card_days(spark, sf_dir):
    """All card feeds as one load per third of a month, run in order and the first one twice; the transactions stored."""
    root, by = scratch(spark, "card-days"), "load_business_date"
    read = {"card_auth": (src.card_auth(spark, sf_dir), cards.AUTH_COLUMNS), "card_post": (src.card_post(spark, sf_dir), cards.POST_COLUMNS)}
    days = []
    for name, (df, columns) in read.items():
        found = feeds.write_daily_feeds(df.select(*columns, _period_end(F.col(by)).alias(by)), f"{root}/in", name, by, days)
        days = days or found
    warehouse = card_day.CardWarehouse(spark, f"{root}/tables", *_reference(spark, sf_dir))
    for day in [*days, days[0]]:
        warehouse.load_day(f"{root}/in", day, NOW)
    return slices.SliceTable(spark, f"{root}/tables/card_txn", None, "txn_date").read().drop("loaded_at")
