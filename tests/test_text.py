import pytest
from pyspark.sql import functions as F

from millrace.functions import casts, text, typeclass


@pytest.mark.parametrize("url,ids", [
    ("https://h/dataset/urn:li:dataset:(urn:li:dataPlatform:x,db.t,PROD)/Columns?is_lineage=false",
     ["urn:li:dataset:(urn:li:dataPlatform:x,db.t,PROD)"]),
    ("https://h/search?filter_a=urn%3Ali%3AdataPlatform%3Ax&filter_b=%E2%90%9Fdemo&query=", ["urn:li:dataPlatform:x"]),
    ("https://h/dataset/urn%3Ali%3Ax%3A1/urn:li:x:1?a=urn:li:x:1&b=urn:li:y:2#urn:li:z:3", ["urn:li:x:1", "urn:li:y:2"]),
    ("https://h/a?q=xurn:li:no&r=a+b", []),
    ("https://h/a?q=urn:li:a+b%2Bc=d", ["urn:li:a b+c=d"]),
    ("  /plain/urn:li:x:9 ", ["urn:li:x:9"]),
    ("https://h/%zz/urn:li:x:1?ok=urn:li:y:2", ["urn:li:y:2"]),
    ("", [])])
def test_ids_in_url(spark, url, ids):
    assert spark.createDataFrame([(url,)], "u string").select(text.ids_in_url(F.col("u"))).first()[0] == ids


def test_ids_in_null_url(spark):
    assert spark.createDataFrame([(None,)], "u string").select(text.ids_in_url(F.col("u"))).first()[0] in (None, [])


def test_conform_rules(spark):
    df = spark.createDataFrame([("  new YORK ", None)], "a string, b string")
    got = df.select(text.title("a"), text.upper("a"), text.lower("a"), text.plain("a"), text.title("b")).first()
    assert tuple(got) == ("New York", "NEW YORK", "new york", "new YORK", None)


def test_padding_never_cuts(spark):
    df = spark.createDataFrame([(7,), (12345,)], "n int")
    assert [r[0] for r in df.select(text.zero_padded(F.col("n"))).collect()] == ["0007", "12345"]


def test_identifiers(spark):
    got = spark.range(1).select(
        text.dataset_id(F.lit("p"), F.lit("app1"), F.lit("db.s.t"), F.lit("PROD")).alias("d")).select(
        "d", text.column_id(F.col("d"), F.lit("c"))).first()
    assert got[0] == "urn:li:dataset:(urn:li:dataPlatform:p,app1.db.s.t,PROD)"
    assert got[1] == f"urn:li:schemaField:({got[0]},c)"


def test_half_up_money(spark):
    df = spark.sql("SELECT 3 AS q, CAST(0.335 AS DECIMAL(10,3)) AS p, CAST(0 AS DECIMAL(5,4)) AS d")
    assert str(df.select(casts.line_amount(F.col("q"), F.col("p"), F.col("d"))).first()[0]) == "1.01"


@pytest.mark.parametrize("value,want", [
    ("1.005", "1.01"), (" 12 ", "12.00"), ("+.5", "0.50"), ("5.", "5.00"), ("1e3", None), ("1,000", None), ("", None),
    ("12345678901234567", None), (None, None)])
def test_decimal_text(spark, value, want):
    got = spark.createDataFrame([(value,)], "v string").select(casts.to_decimal("v")).first()[0]
    assert (str(got) if got is not None else None) == want


@pytest.mark.parametrize("native,want", [
    ("nvarchar(40)", "string"), ("char(3)", "string"), ("decimal(18,2)", "number"), ("bigint", "number"),
    ("int", "number"), ("bit", "boolean"), ("datetime2(3)", "time"), ("date", "date"), ("xml", "string"),
    ("timestamp_ntz", "time"), ("boolean", "boolean")])
def test_native_types(spark, native, want):
    assert spark.createDataFrame([(native,)], "n string").select(typeclass.by_native_type(F.col("n"))).first()[0] == want


@pytest.mark.parametrize("name,want", [
    ("is_current", "boolean"), ("active_flag", "boolean"), ("created_at", "timestamp"), ("order_ts", "timestamp"),
    ("signup_date", "date"), ("date", "date"), ("valid_to", "date"), ("order_id", "number"), ("line_no", "number"),
    ("date_key", "number"), ("unit_price", "number"), ("discount_pct", "number"), ("quantity", "number"),
    ("day_of_week", "number"), ("month_name", "string"), ("row_hash", "string"), ("is_total", "boolean")])
def test_name_types(spark, name, want):
    assert spark.createDataFrame([(name,)], "n string").select(typeclass.by_column_name(F.col("n"))).first()[0] == want
