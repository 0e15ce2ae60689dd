"""Domain views over the given tables.

Each view is a projection or a lookup join; none samples or cuts rows.  Flaws that real feeds
carry (bad text, repeats, orphans) are planted by arithmetic on the row id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.casts import line_amount
from millrace.functions.text import id_hash, zero_padded
from millrace.operators.keyed import latest_per_key

MONEY = "decimal(18,2)"


# Declared, not inferred: a read then needs no job of its own to look into the files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", F.col("n_name").alias("state"), F.col("r_name").alias("region"))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as an application would feed them: padded, mixed case, some cities missing."""
    c = table(spark, sf_dir, "customer")
    place = _places(spark, sf_dir)
    return c.join(place, c.c_nationkey == place.n_nationkey, "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" ")).alias("first_name"),
        F.concat(F.upper("c_mktsegment"), F.lit("  ")).alias("last_name"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit("@Example.COM")).alias("email"),
        F.concat(F.lower("c_mktsegment"), F.lit(" ")).alias("segment"),
        F.when(F.col("c_custkey") % 10 != 0, F.concat(F.lit("port "), F.lower("c_mktsegment"))).alias("city"),
        F.lower("state").alias("state"), F.lower("region").alias("country"),
        F.col("c_acctbal").cast(MONEY).alias("balance"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    place = _places(spark, sf_dir)
    return c.join(place, c.c_nationkey == place.n_nationkey, "left").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("first_name"),
        F.col("c_name").alias("last_name"), F.lower("c_name").alias("email"),
        F.col("c_mktsegment").alias("segment"), F.col("state").alias("city"), "state",
        F.col("region").alias("country"))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit(" "), F.lower("p_brand"), F.lit("-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.concat(F.col("p_name"), F.lit("  ")).alias("product_name"),
        F.when(F.col("p_partkey") % 50 == 0, 99).otherwise(F.col("p_size")).alias("category_id"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
        F.lit(1).alias("active_flag"))


def category_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category names over time: the size group is renamed by each later part."""
    return table(spark, sf_dir, "part").select(
        F.col("p_size").alias("category_id"), F.concat(F.lit(" "), F.col("p_type")).alias("category_name"),
        F.col("p_partkey").alias("version"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("sku"),
        F.col("p_name").alias("product_name"), F.col("p_size").alias("category_id"),
        F.col("p_type").alias("category_name"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"), F.lit(1).alias("active_flag"))


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    place = _places(spark, sf_dir)
    channel = (F.when(F.col("s_nationkey") % 3 == 0, "RETAIL")
               .when(F.col("s_nationkey") % 3 == 1, "ONLINE").otherwise("PARTNER"))
    online = F.col("s_nationkey") % 3 == 1
    return s.join(place, s.s_nationkey == place.n_nationkey, "left").select(
        F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name"), channel.alias("channel"),
        "region", F.when(~online, F.col("state")).alias("city"), F.when(~online, F.col("state")).alias("state"),
        F.col("region").alias("country"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = (F.when(F.col("o_orderstatus") == "F", "DELIVERED")
              .when(F.col("o_orderstatus") == "O", "PLACED").otherwise("SHIPPED"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_ts"), F.col("o_orderdate").cast("date").alias("order_date"),
        status.alias("status"), F.col("o_totalprice").cast(MONEY).alias("order_total"))


def order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order twice: placed on its date, then with its final status 30 days on."""
    final = orders(spark, sf_dir)
    step = F.explode(F.array(F.lit(0), F.lit(30))).alias("days")
    return final.select("*", step).select(
        "order_id", "customer_id", "order_ts", "order_date",
        F.when(F.col("days") == 0, " placed ").otherwise(F.lower("status")).alias("status"), "order_total",
        F.date_add("order_date", F.col("days")).alias("updated_at"),
        F.date_add("order_date", F.col("days")).alias("_run_date"))


def _as_items(lineitem: DataFrame) -> DataFrame:
    quantity = F.col("l_quantity").cast("int")
    price = F.col("l_extendedprice").cast(MONEY)
    discount = F.col("l_discount").cast("decimal(5,4)")
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("store_id"),
        quantity.alias("quantity"), price.alias("unit_price"), discount.alias("discount_pct"),
        line_amount(quantity, price, discount).cast(MONEY).alias("line_amount"),
        F.col("l_shipdate").cast("date").alias("updated_at"))


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as fed; a (order, line) pair may come several times."""
    return _as_items(table(spark, sf_dir, "lineitem"))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest copy of every line; amounts are worked out only for rows that stay."""
    lineitem = table(spark, sf_dir, "lineitem").drop("l_tax", "l_returnflag", "l_linestatus")
    return _as_items(latest_per_key(
        lineitem, ["l_orderkey", "l_linenumber"],
        [F.col("l_shipdate").desc(), F.col("l_partkey"), F.col("l_suppkey")]))


def priority_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dated attribute of customers: the priority of each of their orders."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").cast("date").alias("effective"), F.col("o_orderkey").alias("order_id"))


def _amount_text():
    value = F.col("value").cast(MONEY).cast("string")
    i = F.col("event_id")
    return (F.when(i % 61 == 0, "abc").when(i % 67 == 0, F.concat(F.lit("-"), value))
            .when(i % 71 == 0, "1e3").otherwise(value))


def _time_text(ts):
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")


def _response_code():
    slot = F.col("event_id") % 40
    return (F.when(slot == 0, "05").when(slot == 1, "51").when(slot == 2, "14").when(slot == 3, "54")
            .when(slot == 4, "61").when(slot == 5, "65").when(slot == 6, "91").when(slot == 7, "99")
            .otherwise("00"))


def card_auth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authorisation feed, all text as it arrives, with the business date of each row."""
    i = F.col("event_id")
    mcc = F.get_json_object("props", "$.k").cast("int")
    kind = (F.when(i % 79 == 0, "BOGUS").when(i % 83 == 0, "purchase")
            .when(F.col("event_type") == "signup", "REFUND").when(F.col("event_type") == "error", "AUTH_ONLY")
            .otherwise("PURCHASE"))
    when = (F.when(i % 53 == 0, "not-a-time")
            .when(i % 59 == 0, _time_text(F.col("ts") + F.expr("INTERVAL 2 DAYS"))).otherwise(_time_text(F.col("ts"))))
    copies = F.explode(F.when(i % 43 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return table(spark, sf_dir, "events").select("*", copies.alias("copy")).select(
        F.concat(F.lit("T"), zero_padded(i, 10)).alias("txn_id"),
        F.when(i % 101 == 0, "unknown").otherwise(id_hash(F.col("user_id"))).alias("card_number_hash"),
        when.alias("auth_ts"), _amount_text().alias("auth_amount"), F.lit("USD").alias("txn_currency"),
        F.concat(F.lit("M"), zero_padded(mcc)).alias("merchant_id"),
        F.when(i % 73 == 0, "AB12").otherwise((F.lit(5000) + mcc).cast("string")).alias("mcc"),
        kind.alias("txn_type"), _response_code().alias("response_code"),
        (i * 10 + F.col("copy")).cast("string").alias("file_seq"),
        F.col("ts").cast("date").alias("load_business_date"))


def card_post(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posting feed: one posting per approved authorisation that settles, with flaws.

    Some are posted twice and some name an unknown transaction; ``error`` events are
    authorisations without settlement.
    """
    i = F.col("event_id")
    copies = F.explode(F.when(i % 89 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    posted = _time_text(F.col("ts") + F.make_dt_interval(hours=(i % 35 + 2).cast("int")))
    settled = F.col("value").cast(MONEY) + (i % 6).cast("int").cast("decimal(18,0)")
    return (
        table(spark, sf_dir, "events").where((_response_code() == "00") & (F.col("event_type") != "error"))
        .select("*", copies.alias("copy")).select(
            F.concat(F.when(i % 91 == 0, "X").otherwise("T"), zero_padded(i, 10)).alias("txn_id"),
            F.concat(F.lit("P"), zero_padded(i * 10 + F.col("copy"), 12)).alias("posting_ref"),
            F.when(i % 97 == 0, "").otherwise(posted).alias("posting_ts"),
            F.when(i % 103 == 0, "bad").otherwise((settled + F.col("copy")).cast(MONEY).cast("string")).alias("settled_amount"),
            F.lit("USD").alias("settlement_currency"), F.concat(F.lit("A"), (i % 7).cast("string")).alias("acquirer_id"),
            (i * 10 + F.col("copy")).cast("string").alias("file_seq"),
            F.col("ts").cast("date").alias("load_business_date")))


def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change envelopes as text, one per event, with every kind of change and some junk.

    The changed row is the user; ``seq`` gives the order of changes.
    """
    i = F.col("event_id")
    op = (F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "view", "r")
          .when(F.col("event_type") == "error", "d").otherwise("u"))
    row = F.struct(F.col("user_id").cast("int").alias("id"), F.col("event_type").alias("note"),
                   F.col("ts").cast("date").cast("string").alias("created_at"))
    image = F.when(op != "d", row)
    before = F.when(op == "d", row)
    envelope = F.to_json(F.struct(op.alias("op"), before.alias("before"), image.alias("after"),
                                  F.struct(i.alias("seq")).alias("source")))
    return table(spark, sf_dir, "events").select(
        i.alias("event_id"),
        F.when(i % 31 == 0, F.lit(None).cast("string")).when(i % 37 == 0, "{broken").otherwise(envelope).alias("value"))
