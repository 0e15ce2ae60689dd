"""Card transactions: reference tables, integration and daily reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.casts import to_decimal, to_timestamp_ms
from millrace.functions.text import id_hash, zero_padded
from millrace.operators.keyed import latest_per_key, top_per_group

AUTH_COLUMNS = [
    "txn_id", "card_number_hash", "auth_ts", "auth_amount", "txn_currency",
    "merchant_id", "mcc", "txn_type", "response_code", "file_seq"]
POST_COLUMNS = [
    "txn_id", "posting_ref", "posting_ts", "settled_amount",
    "settlement_currency", "acquirer_id", "file_seq"]

# Transaction types, response codes and their reasons, category and country labels.
TXN_TYPES = ["PURCHASE", "REFUND", "AUTH_ONLY"]
APPROVED_CODE = "00"
DECLINE_REASONS = {
    "05": "Do not honor",
    "51": "Insufficient funds",
    "14": "Invalid card number",
    "54": "Expired card",
    "61": "Exceeds withdrawal limit",
    "65": "Activity limit exceeded",
    "91": "Issuer unavailable",
}
OTHER_DECLINE = "Declined"
MCC_CATEGORIES = [
    "Groceries", "Restaurants", "Travel", "Fuel", "Retail", "Entertainment",
    "Utilities", "Healthcare", "Electronics", "Apparel", "Services", "Other"]
COUNTRIES = ["US", "GB", "CA", "DE", "FR", "AU"]
FIRST_MCC = 5000
FIRST_CUSTOMER = 100000
ISSUE_DAY = date(2025, 1, 1)
REVIEW_ABOVE = 1000


# ---- reference tables, from any frame of whole numbers --------------------------------------

def numbers(spark: SparkSession, count: int) -> DataFrame:
    return spark.range(1, count + 1).select(F.col("id").alias("n"))


def _pick(labels: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), (index + 1).cast("int"))


def mcc_reference(ids: DataFrame) -> DataFrame:
    n = F.col("n")
    return ids.select(zero_padded(n + FIRST_MCC).alias("mcc"),
                      _pick(MCC_CATEGORIES, F.pmod(n - 1, F.lit(len(MCC_CATEGORIES)))).alias("mcc_category"))


def merchant_reference(ids: DataFrame) -> DataFrame:
    n = F.col("n")
    return ids.select(
        F.concat(F.lit("M"), zero_padded(n)).alias("merchant_id"),
        F.concat(F.lit("Merchant "), zero_padded(n)).alias("merchant_name"),
        zero_padded(n + FIRST_MCC).alias("mcc"), _pick(COUNTRIES, n % len(COUNTRIES)).alias("country"))


def card_reference(ids: DataFrame) -> DataFrame:
    n = F.col("n")
    return ids.select(
        n.alias("card_id"), id_hash(n).alias("card_number_hash"), (n + FIRST_CUSTOMER).alias("customer_id"),
        F.date_sub(F.lit(ISSUE_DAY), ((n * 11) % 1500).cast("int")).alias("issue_date"),
        (n % 25 != 0).alias("is_active"))


def reference_profile(mcc: DataFrame, merchant: DataFrame, card: DataFrame) -> DataFrame:
    """Rows and a distinct or flag count of each reference table, stacked."""
    def line(name: str, df: DataFrame, measure: Column) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("row_count"), measure.cast("bigint").alias("measure")).select(
            F.lit(name).alias("tbl"), "row_count", "measure")

    return (
        line("mcc_category", mcc, F.count_distinct("mcc_category"))
        .unionByName(line("merchant", merchant, F.count_distinct("mcc")))
        .unionByName(line("card", card, F.sum(F.col("is_active").cast("int"))))
    )


# ---- integration ----------------------------------------------------------------------------

def _decline_reason(code: Column) -> Column:
    chosen = F.when(code == APPROVED_CODE, F.lit(None).cast("string"))
    for value, reason in DECLINE_REASONS.items():
        chosen = chosen.when(code == value, reason)
    return chosen.otherwise(OTHER_DECLINE)


def valid_authorisations(auth: DataFrame) -> DataFrame:
    """Rows with a positive amount, a readable time not after the business date and a known type."""
    return (
        auth.withColumn("amount", to_decimal("auth_amount")).withColumn("at", to_timestamp_ms("auth_ts"))
        .where((F.col("amount") > 0) & (F.col("at").cast("date") <= F.col("load_business_date"))
               & F.col("txn_type").isin(*TXN_TYPES))
    )


def integrate(auth: DataFrame, post: DataFrame, card: DataFrame, merchant: DataFrame,
              mcc: DataFrame) -> DataFrame:
    """One typed, enriched row per transaction and business date.

    Rows of unknown card, merchant or category drop out first, then the first remaining row by
    ``file_seq`` (text order) is kept.  Postings are cut to one per transaction, the lowest
    ``posting_ref``, before the join: repeats on both sides would otherwise multiply.
    """
    known = (
        valid_authorisations(auth)
        .join(card.select("card_id", "card_number_hash"), "card_number_hash")
        .join(merchant.select("merchant_id", "merchant_name"), "merchant_id")
        .join(mcc.select("mcc", "mcc_category"), "mcc")
        .select("txn_id", "load_business_date", "card_id", "at", "amount", "txn_currency", "merchant_id",
                "merchant_name", "mcc", "mcc_category", "txn_type", "response_code", "file_seq")
    )
    first_auth = latest_per_key(
        known, ["txn_id", "load_business_date"],
        [F.col("file_seq"), F.col("at"), F.col("amount"), F.col("card_id"), F.col("merchant_id"), F.col("mcc"),
         F.col("txn_type"), F.col("response_code"), F.col("txn_currency")])
    first_post = latest_per_key(
        post.select("txn_id", "load_business_date", "posting_ref", "posting_ts", "settled_amount"),
        ["txn_id", "load_business_date"],
        [F.col("posting_ref"), F.col("posting_ts"), F.col("settled_amount")],
    ).withColumn("posted", F.lit(1))
    code = F.col("response_code")
    return first_auth.join(first_post, ["txn_id", "load_business_date"], "left").select(
        "txn_id", "card_id", F.col("at").alias("auth_ts"), to_timestamp_ms("posting_ts").alias("posting_ts"),
        F.col("load_business_date").alias("txn_date"), F.col("amount").alias("auth_amount"),
        to_decimal("settled_amount").alias("settled_amount"), "txn_currency", "merchant_id", "merchant_name",
        "mcc", "mcc_category", "txn_type",
        F.when(code == APPROVED_CODE, 1).otherwise(0).alias("is_approved"),
        F.coalesce("posted", F.lit(0)).alias("is_posted"),
        _decline_reason(code).alias("decline_reason"))


def declines(txn: DataFrame) -> DataFrame:
    return txn.where("is_approved = 0").select(
        "txn_id", "card_id", "txn_date", "auth_amount", "decline_reason",
        F.when(F.col("auth_amount") > REVIEW_ABOVE, 1).otherwise(0).alias("flagged_for_review"))


# ---- reports --------------------------------------------------------------------------------

def daily_summary(txn: DataFrame) -> DataFrame:
    """Counts of all transactions and approved-only totals per date, category and type."""
    approved = F.col("is_approved") == 1
    none = F.lit(0).cast("decimal(18,2)")
    return txn.groupBy("txn_date", "mcc_category", "txn_type").agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.count_if(approved).alias("approved_count"),
        F.count_if(F.col("is_approved") == 0).alias("decline_count"),
        F.sum(F.when(approved, F.col("auth_amount")).otherwise(none)).cast("decimal(18,2)").alias("auth_amount_total"),
        F.sum(F.when(approved, F.coalesce("settled_amount", none)).otherwise(none)).cast("decimal(18,2)")
        .alias("settled_amount_total"))


def top_merchants(txn: DataFrame, n: int = 10) -> DataFrame:
    """The merchants with most approved settled volume per day; merchant_id breaks ties."""
    per_merchant = txn.where("is_approved = 1").groupBy("txn_date", "merchant_id", "merchant_name").agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.sum(F.coalesce("settled_amount", F.lit(0).cast("decimal(18,2)"))).cast("decimal(18,2)")
        .alias("settled_amount_total"))
    return top_per_group(
        per_merchant, ["txn_date"], [F.col("settled_amount_total").desc(), F.col("merchant_id")], n
    ).select("txn_date", F.col("rank").cast("int").alias("rank"), "merchant_id", "merchant_name",
             "txn_count", "settled_amount_total")
