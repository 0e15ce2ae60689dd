"""Data-quality checks compiled to aggregates; the results are a table.

A check is one aggregate expression and a rule on its value.  All checks on the same frame go
into one ``agg``, so the frame is scanned once; grouped by the business date that same scan
answers every day at once.  Checks that need another shape (per-key counts, matches with another
table) bring a frame of that shape, already reduced to one row per key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime
from functools import reduce

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.casts import hours_between, to_decimal, to_timestamp_ms
from millrace.functions.text import check_id
from millrace.operators.cards import TXN_TYPES

PASSED, FAILED, WARNING, ERROR = "PASSED", "FAILED", "WARNING", "ERROR"
EVENT_TYPE = {PASSED: "SUCCESS", FAILED: "FAILURE", WARNING: "FAILURE", ERROR: "ERROR"}


class QualityGateError(RuntimeError):
    """At least one check did not pass."""


def is_zero(value: Column) -> Column:
    return value == 0


def is_positive(value: Column) -> Column:
    return value > 0


@dataclass(frozen=True)
class Check:
    code: str
    description: str
    measure: Column
    passes: Callable[[Column], Column] = is_zero
    warns: Callable[[Column], Column] | None = None
    field: str | None = None
    expected_1: str | None = None
    expected_2: str | None = None

    @property
    def level(self) -> str:
        return "L2" if self.field else "L1"


@dataclass(frozen=True)
class CheckSet:
    """Checks that share one frame.

    With ``by`` every check is answered per business date and the ``whole`` checks once over all
    dates, from the same scan.  Without it the frame is one group, labelled ``day`` if given, and
    an empty frame still answers.
    """

    table: str
    frame: DataFrame
    checks: tuple[Check, ...]
    by: str | None = None
    whole: tuple[Check, ...] = ()
    day: date | None = None


def for_day(sets: Sequence[CheckSet], day: date) -> list[CheckSet]:
    """The same checks for one day's rows, so that a day without rows is reported too."""
    return [replace(s, frame=s.frame.where(F.col(s.by) == F.lit(day)), by=None, day=day) if s.by else s for s in sets]


def count_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def _analysis_error(frame: DataFrame, *measures: Column) -> str | None:
    try:
        frame.agg(F.count(F.lit(1)), *[m.alias(f"value_{i}") for i, m in enumerate(measures)])
    except AnalysisException as problem:
        return str(problem).splitlines()[0]
    return None


def _outcome(check: Check, value: Column, error: str | None) -> Column:
    text = value.cast("string")
    shown = F.concat(F.lit(f"{check.description} (actual="), F.coalesce(text, F.lit("null")), F.lit(")"))
    if error is not None:
        status, message = F.lit(ERROR), F.lit(f"query error: {error}")
    else:
        good = F.coalesce(check.passes(value), F.lit(False))
        status = F.when(good, PASSED).otherwise(FAILED)
        message = F.when(good, f"ok: {check.description}").otherwise(F.concat(F.lit("failed: "), shown))
        if check.warns is not None:
            warned = F.coalesce(check.warns(value), F.lit(False))
            status = F.when(warned, WARNING).otherwise(status)
            message = F.when(warned, F.concat(F.lit("warning: "), shown)).otherwise(message)
    return F.struct(
        F.lit(check.code).alias("check_code"), F.lit(check.field).cast("string").alias("field"),
        F.lit(check.level).alias("level"), text.try_cast("double").alias("actual"), text.alias("actual_text"),
        status.alias("status"), F.lit(check.expected_1).cast("string").alias("expected_1"),
        F.lit(check.expected_2).cast("string").alias("expected_2"), message.alias("message"))


def run(sets: Sequence[CheckSet]) -> DataFrame:
    """One result row per check, and per business date where the set is grouped.

    An expression that cannot be analysed gives ERROR rows and leaves the other checks alone.
    Order of status: ERROR, WARNING, PASSED, FAILED; a NULL value passes only if the rule says so.
    """
    results = []
    for s in sets:
        every = (*s.checks, *s.whole)
        # All measures are analysed at once, and one by one only if that fails.
        sound = _analysis_error(s.frame, *[c.measure for c in every]) is None
        errors = [None if sound else _analysis_error(s.frame, c.measure) for c in every]
        # The count keeps the aggregate when every measure of the set is an error.
        values = [F.count(F.lit(1)).alias("_rows"), *[
            (F.lit(None).cast("double") if errors[i] else c.measure).alias(f"_v{i}") for i, c in enumerate(every)]]
        outcomes = [_outcome(c, F.col(f"_v{i}"), errors[i]) for i, c in enumerate(every)]
        per_group, overall = outcomes[:len(s.checks)], outcomes[len(s.checks):]
        if s.by is None:
            answered, day, shown = s.frame.agg(*values), F.lit(s.day).cast("date"), F.array(*per_group)
        elif not s.whole:
            answered, day, shown = s.frame.groupBy(s.by).agg(*values), F.col(s.by).cast("date"), F.array(*per_group)
        else:
            answered = s.frame.rollup(s.by).agg(F.grouping(s.by).alias("_total"), *values)
            day = F.col(s.by).cast("date")
            shown = F.when(F.col("_total") == 1, F.array(*overall)).otherwise(F.array(*per_group))
        results.append(answered.select(
            F.lit(s.table).alias("table_name"), day.alias("business_date"), F.explode(shown).alias("o"),
        ).select("table_name", "business_date", "o.*"))
    return reduce(DataFrame.unionByName, results)


def run_apart(sets: Sequence[CheckSet]) -> DataFrame:
    """``run``, one set at a time and at once, so that a set that fails while it runs does not end the others.

    The checks of such a set are tried one by one; those that fail give ERROR rows.  Results are one row per check and
    business date, which is what the driver holds.
    """
    spark = sets[0].frame.sparkSession
    rows, schema = [], None
    for s in sets:
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in run([s]).schema])
        try:
            rows += run([s]).collect()
        except PySparkException:
            for c in (*s.checks, *s.whole):
                one = replace(s, checks=(c,), whole=()) if c in s.checks else replace(s, checks=(c,), whole=(), by=None)
                try:
                    rows += run([one]).collect()
                except PySparkException as problem:
                    rows.append((s.table, s.day, c.code, c.field, c.level, None, None, ERROR, c.expected_1, c.expected_2,
                                 f"query error: {str(problem).splitlines()[0]}"))
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def require_passed(results: DataFrame) -> None:
    """Raise if any check failed or could not run, so nothing downstream publishes.

    A warning is recorded and lets the run go on.
    """
    bad = results.where(F.col("status").isin(FAILED, ERROR)).select("table_name", "check_code", "status").distinct().collect()
    if bad:
        raise QualityGateError("; ".join(f"{r.table_name}.{r.check_code} {r.status}" for r in bad))


# ---- the five checks every table gets --------------------------------------------------------

def per_key_counts(df: DataFrame, keys: Sequence[str], by: str, loaded_at: str) -> DataFrame:
    """One row per business date and key: copies and the last load time."""
    return df.groupBy(by, *keys).agg(
        F.count(F.lit(1)).alias("copies"), F.max(F.col(loaded_at).cast("timestamp_ntz")).alias("last_loaded"))


def mandatory(table: str, df: DataFrame, keys: Sequence[str], low: int, high: int, now: datetime,
              today: date, by: str = "load_business_date", loaded_at: str = "loaded_at",
              day: date | None = None) -> list[CheckSet]:
    """Freshness, count, count band and repeated key per day, business date over the whole table.

    All come from one per-key count of the table.  With ``day`` the daily checks read just that
    day's rows, and only the business-date check looks at the rest.
    """
    count = F.coalesce(F.sum("copies"), F.lit(0))
    daily = (
        Check("SLA_VALIDATION", f"hours since {table} was last loaded",
              hours_between(F.max("last_loaded"), F.lit(now).cast("timestamp_ntz")),
              lambda h: h <= 24.0, expected_2="24"),
        Check("RECORD_COUNT", f"rows of {table}", count, lambda n: n >= 0),
        Check("RECORD_COUNT_THRESHOLD", f"rows of {table} in [{low}, {high}]", count,
              lambda n: n.between(low, high), expected_1=str(low), expected_2=str(high)),
        Check("DUPLICATE_FEED", f"largest group of one key in {table}",
              F.coalesce(F.max(F.when(F.col("copies") > 1, F.col("copies"))), F.lit(0))),
    )
    outside = ~F.col(by).between(F.date_sub(F.lit(today), 1), F.lit(today))
    text = f"rows of {table} dated outside yesterday and today"
    if day is not None:
        per_key = per_key_counts(df.where(F.col(by) == F.lit(day)), keys, by, loaded_at)
        return [CheckSet(table, per_key, daily, day=day),
                CheckSet(table, df, (Check("BUSINESS_DATE", text, count_where(outside)),))]
    window = Check("BUSINESS_DATE", text, F.coalesce(F.sum(F.when(outside, F.col("copies"))), F.lit(0)))
    return [CheckSet(table, per_key_counts(df, keys, by, loaded_at), daily, by, (window,))]


# ---- card checks -------------------------------------------------------------------------------

def _bad_amount(name: str) -> Column:
    amount = to_decimal(name)
    return amount.isNull() | (amount <= 0)


def match_counts(rows: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key and whether the key exists in ``other``.

    Both sides are cut to one row per key before they meet.
    """
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    present = other.select(*keys).distinct().withColumn("found", F.lit(True))
    return counted.join(present, list(keys), "left")


def stage_checks(auth: DataFrame, post: DataFrame, by: str = "load_business_date") -> list[CheckSet]:
    return [
        CheckSet("card_auth", auth, (
            Check("AUTH_AMOUNT_NUMERIC", "amounts that are no positive decimal",
                  count_where(_bad_amount("auth_amount")), field="auth_amount"),
            Check("AUTH_TS_PARSEABLE", "times that do not parse",
                  count_where(to_timestamp_ms("auth_ts").isNull()), field="auth_ts"),
            Check("MCC_FOUR_DIGITS", "category codes that are not four digits",
                  count_where(~F.col("mcc").rlike("^[0-9]{4}$")), field="mcc"),
            Check("TXN_TYPE_ENUM", "unknown transaction types",
                  count_where(~F.col("txn_type").isin(*TXN_TYPES)), field="txn_type"),
        ), by),
        CheckSet("card_post", post, (
            Check("SETTLED_AMOUNT_NUMERIC", "settled amounts that are no positive decimal",
                  count_where(_bad_amount("settled_amount")), field="settled_amount"),
            Check("POSTING_TS_PARSEABLE", "posting times that do not parse",
                  count_where(to_timestamp_ms("posting_ts").isNull()), field="posting_ts"),
        ), by),
        CheckSet("card_post", match_counts(post, auth, ["txn_id", by]), (
            Check("POST_TXN_ID_IN_AUTH", "postings without an authorisation of the day",
                  F.coalesce(F.sum(F.when(F.col("found").isNull(), F.col("n"))), F.lit(0)), field="txn_id"),
        ), by),
    ]


def integration_checks(txn: DataFrame, decline: DataFrame, by: str = "txn_date") -> list[CheckSet]:
    amount, approved, reason = F.col("auth_amount"), F.col("is_approved"), F.col("decline_reason")
    return [
        CheckSet("card_txn", txn, (
            Check("CARD_ID_RESOLVED", "rows without a card", count_where(F.col("card_id").isNull()), field="card_id"),
            Check("MERCHANT_NAME_PRESENT", "rows without a merchant name",
                  count_where(F.col("merchant_name").isNull()), field="merchant_name"),
            Check("AUTH_AMOUNT_RANGE", "amounts outside (0, 100000]",
                  count_where(~((amount > 0) & (amount <= 100000))), field="auth_amount"),
            Check("APPROVED_FLAG_CONSISTENT", "approval that disagrees with the decline reason",
                  count_where(((approved == 1) & reason.isNotNull()) | ((approved == 0) & reason.isNull()))),
            Check("POSTED_IMPLIES_APPROVED", "posted but not approved",
                  count_where((F.col("is_posted") == 1) & (approved == 0))),
        ), by),
        CheckSet("card_txn_decline", decline, (
            Check("DECLINE_REASON_PRESENT", "declines without a reason", count_where(reason.isNull()),
                  field="decline_reason"),
        ), by),
    ]


def report_checks(summary: DataFrame, top: DataFrame, by: str = "txn_date") -> list[CheckSet]:
    return [
        CheckSet("daily_card_summary", summary, (
            Check("APPROVED_PLUS_DECLINE_EQUALS_TXN_COUNT", "rows whose counts do not add up",
                  count_where(F.col("approved_count") + F.col("decline_count") != F.col("txn_count"))),
        ), by),
        CheckSet("card_top_merchants", top, (
            Check("RANK_IS_1_TO_10", "ranks outside 1 to 10",
                  count_where((F.col("rank") < 1) | (F.col("rank") > 10)), field="rank"),
        ), by),
    ]


# Daily row bands per card table.
BANDS = {
    "card_auth": (100, 1000), "card_post": (100, 1000), "card_txn": (100, 1000),
    "card_txn_decline": (1, 100), "daily_card_summary": (1, 200), "card_top_merchants": (1, 10)}
KEYS = {
    "card_auth": ["txn_id"], "card_post": ["posting_ref"], "card_txn": ["txn_id"],
    "card_txn_decline": ["txn_id"], "daily_card_summary": ["mcc_category", "txn_type"],
    "card_top_merchants": ["rank"]}


def card_mandatory(frames: dict[str, DataFrame], now: datetime, today: date, day: date | None = None,
                   bands: dict[str, tuple[int, int]] = BANDS) -> list[CheckSet]:
    """The mandatory checks of the given card tables; stage tables carry the load date.

    ``bands`` are the rows expected a day; give your own where a day is larger.
    """
    sets: list[CheckSet] = []
    for table, df in frames.items():
        by = "load_business_date" if table in ("card_auth", "card_post") else "txn_date"
        sets += mandatory(table, df, KEYS[table], *bands[table], now=now, today=today, by=by, day=day)
    return sets


# ---- star checks -------------------------------------------------------------------------------

def grain_check(fact: DataFrame, grain: Sequence[str]) -> CheckSet:
    """Rows beyond the first of each grain; NULL parts count as values."""
    counted = fact.groupBy(*grain).agg(F.count(F.lit(1)).alias("copies"))
    return CheckSet("fact_sales", counted, (
        Check("FACT_GRAIN_UNIQUE", "rows beyond the first of a grain",
              F.coalesce(F.sum(F.col("copies") - 1), F.lit(0))),))


def reference_check(fact: DataFrame, keys: Sequence[str]) -> CheckSet:
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return CheckSet("fact_sales", fact, (
        Check("FACT_KEYS_RESOLVED", "rows with a missing dimension key", count_where(missing)),))


def reconciliation_check(fact: DataFrame, orders: DataFrame, tolerance: float = 0.005) -> CheckSet:
    """Line sums against order totals; orders on one side only are counted apart, not compared."""
    summed = fact.groupBy("order_id").agg(F.sum("extended_amount").alias("line_sum"))
    off = F.abs(F.col("line_sum") - F.col("order_total")) > F.lit(tolerance).cast("decimal(9,4)")
    both = summed.join(orders.select("order_id", "order_total"), "order_id", "full")
    return CheckSet("fact_sales", both, (
        Check("ORDER_TOTAL_RECONCILED", "orders whose lines do not add up", count_where(off)),
        Check("ORDER_HAS_LINES", "orders without a fact row",
              count_where(F.col("line_sum").isNull() & F.col("order_total").isNotNull()), warns=is_positive)))


def fact_checks(fact: DataFrame, orders: DataFrame, keys: Sequence[str], order: str = "order_id", line: str = "line_no",
                tolerance: float = 0.005) -> CheckSet:
    """Grain, references and reconciliation of a fact at (order, line) from one pass over it, dealt by order.

    The same checks as ``grain_check``, ``reference_check`` and ``reconciliation_check``.
    """
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    per_order = fact.repartition(order).groupBy(order, line).agg(
        F.count(F.lit(1)).alias("copies"), F.sum("extended_amount").alias("amount"), count_where(missing).alias("missing")) \
        .groupBy(order).agg(F.sum(F.col("copies") - 1).alias("beyond"), F.sum("amount").alias("line_sum"),
                            F.sum("missing").alias("missing"), F.lit(True).alias("in_fact"))
    both = per_order.join(orders.select(order, "order_total"), order, "full")
    off = F.abs(F.col("line_sum") - F.col("order_total")) > F.lit(tolerance).cast("decimal(9,4)")
    none = F.lit(0)
    return CheckSet("fact_sales", both, (
        Check("FACT_GRAIN_UNIQUE", "rows beyond the first of a grain", F.coalesce(F.sum("beyond"), none)),
        Check("FACT_KEYS_RESOLVED", "rows with a missing dimension key", F.coalesce(F.sum("missing"), none)),
        Check("ORDER_TOTAL_RECONCILED", "orders whose lines do not add up", count_where(off)),
        Check("ORDER_HAS_LINES", "orders without a fact row",
              count_where(F.col("in_fact").isNull() & F.col("order_total").isNotNull()), warns=is_positive)))


def dimension_checks(table: str, history: DataFrame, key: str, surrogate: str) -> list[CheckSet]:
    """At most one and at least one current row per key, key present, surrogate not repeated."""
    per_key = history.groupBy(key).agg(F.count_if("is_current").alias("current_rows"))
    per_surrogate = history.groupBy(surrogate).agg(F.count(F.lit(1)).alias("copies"))
    return [
        CheckSet(table, per_key, (
            Check("ONE_CURRENT_ROW", "keys with several current rows", count_where(F.col("current_rows") > 1), field=key),
            Check("HAS_CURRENT_ROW", "keys without a current row", count_where(F.col("current_rows") == 0),
                  warns=is_positive, field=key),
            Check("KEY_PRESENT", "rows without business key", count_where(F.col(key).isNull()), field=key))),
        CheckSet(table, per_surrogate, (
            Check("SURROGATE_UNIQUE", "repeated surrogate keys", count_where(F.col("copies") > 1), field=surrogate),)),
    ]


# ---- results over time -------------------------------------------------------------------------

def definitions(sets: Sequence[CheckSet], owner: str, schema: str) -> list[tuple[str, str, str, str, str]]:
    """(check id, table, code, field, description): what is stable from run to run."""
    raw = [(s.table, c.code, c.field or "", c.description) for s in sets for c in (*s.checks, *s.whole)]
    return [("urn:li:assertion:" + f"{owner}_{schema}_{t}_{code}".lower(), t, code, f, d) for t, code, f, d in raw]


def run_events(results: DataFrame, owner: str, schema: str, run_at: datetime) -> DataFrame:
    """Results as appendable events: coarse type for consumers, exact status kept beside it."""
    kinds = F.create_map(*[F.lit(x) for pair in EVENT_TYPE.items() for x in pair])
    return results.select(
        check_id(F.lit(owner), F.lit(schema), F.col("table_name"), F.col("check_code")).alias("check_id"),
        F.lit(run_at).cast("timestamp_ntz").alias("run_at"), "table_name", "business_date", "check_code",
        kinds[F.col("status")].alias("result_type"), "status", "actual_text", "expected_1", "expected_2", "message")
