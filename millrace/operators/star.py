"""Calendar, fact and wide report of a sales star."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.history import as_of_join, one_version_each, only_version_join


class UnresolvedKeyError(ValueError):
    """A fact row points at no dimension version."""


def date_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd").cast("int")


def calendar(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day, both ends included."""
    span = spark.range(1).select(F.lit(first).alias("first"), F.lit(last).alias("last"))
    return calendar_over(span)


def calendar_over(span: DataFrame) -> DataFrame:
    """Calendar for a one-row frame with ``first`` and ``last``."""
    day = F.col("date")
    return span.select(
        F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("date")
    ).select(
        date_key(day).alias("date_key"), day,
        F.year(day).alias("year"), F.quarter(day).alias("quarter"), F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"), F.dayofmonth(day).alias("day"),
        F.dayofweek(day).alias("day_of_week"), F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).alias("week_of_year"), F.dayofweek(day).isin(1, 7).alias("is_weekend"))


@dataclass(frozen=True)
class Role:
    """How a dimension hangs on the fact and which of its columns the report shows."""

    key: str
    surrogate: str
    report: dict[str, str] = field(default_factory=dict)


CUSTOMER = Role("customer_id", "customer_key", {
    "customer_id": "customer_id", "first_name": "first_name", "last_name": "last_name",
    "segment": "segment", "customer_city": "city", "customer_state": "state"})
PRODUCT = Role("product_id", "product_key", {
    "product_id": "product_id", "sku": "sku", "product_name": "product_name",
    "category_name": "category_name", "product_list_price": "unit_price"})
STORE = Role("store_id", "store_key", {
    "store_id": "store_id", "store_name": "store_name", "channel": "channel", "region": "region",
    "store_city": "city", "store_state": "state"})
CALENDAR = Role("date", "date_key", {
    c: c for c in ("year", "quarter", "month", "month_name", "day_name", "is_weekend")})
ROLES = (CUSTOMER, PRODUCT, STORE)

FACT_REPORT = {
    "order_id": "order_id", "line_no": "line_no", "status": "status", "order_date": "order_date",
    "quantity": "quantity", "sale_unit_price": "unit_price", "discount_pct": "discount_pct",
    "extended_amount": "extended_amount"}

# The report's columns in their order.
REPORT_COLUMNS = [
    "order_id", "line_no", "status", "order_date",
    "year", "quarter", "month", "month_name", "day_name", "is_weekend",
    "customer_id", "first_name", "last_name", "segment", "customer_city", "customer_state",
    "product_id", "sku", "product_name", "category_name", "product_list_price",
    "store_id", "store_name", "channel", "region", "store_city", "store_state",
    "quantity", "sale_unit_price", "discount_pct", "extended_amount"]


def build_fact(lines: DataFrame, orders: DataFrame, dimensions: dict[str, DataFrame],
               take: dict[str, list[str]] | None = None) -> DataFrame:
    """Order lines with the surrogate keys valid on their order date.

    ``dimensions`` maps a surrogate name to its history; a surrogate left out is not resolved.
    A key that sits on the order is resolved there, on fewer rows than the lines; one that sits
    on the line after the join.  A dimension on the lines whose keys have one version each is joined by its key alone: pairs of key and
    date would be almost as many as the lines.  ``take`` names further columns of a dimension to bring along, so that a report
    need not look the surrogate up again.
    """
    take = take or {}

    def resolve(rows: DataFrame, role: Role) -> DataFrame:
        more = take.get(role.surrogate, [])
        history = dimensions[role.surrogate].select(
            role.key, "valid_from", "valid_to", role.surrogate, *[F.col(c).alias(_taken(role, c)) for c in more])
        join = only_version_join if role in on_line and one_version_each(history, role.key) else as_of_join
        return join(rows, history, role.key, "order_date", role.key, [role.surrogate, *[_taken(role, c) for c in more]])

    wanted = [r for r in ROLES if r.surrogate in dimensions]
    on_line = [r for r in wanted if r.key in lines.columns]
    on_order = [r for r in wanted if r.key not in lines.columns]
    heads = orders.select("order_id", "order_date", "status", *[r.key for r in on_order])
    for role in on_order:
        heads = resolve(heads, role)
    fact = lines.join(heads, "order_id")
    for role in on_line:
        fact = resolve(fact, role)
    return fact.select(
        F.xxhash64(F.col("order_id").cast("bigint"), F.col("line_no").cast("int")).alias("sales_key"),
        date_key(F.col("order_date")).alias("date_key"), *[r.surrogate for r in wanted],
        *[_taken(r, c) for r in wanted for c in take.get(r.surrogate, [])],
        "order_id", "line_no", "status", "quantity", "unit_price", "discount_pct",
        F.col("line_amount").alias("extended_amount"), "order_date")


def _taken(role: Role, column: str) -> str:
    return f"_{role.surrogate}_{column}"


def report_of(lines: DataFrame, orders: DataFrame, dimensions: dict[str, DataFrame], columns: list[str] | None = None) -> DataFrame:
    """The wide report straight from lines, orders and histories, each key looked up once.

    The rows are those of ``report_view``, whatever ``columns`` are asked for: lines whose keys all resolve and whose
    date the calendar has.
    """
    wanted = columns or REPORT_COLUMNS
    shown = {r.surrogate: {name: source for name, source in r.report.items() if name in wanted} for r in (CALENDAR, *ROLES)}
    fact = resolved(build_fact(lines, orders, {r.surrogate: dimensions[r.surrogate] for r in ROLES},
                               {r.surrogate: list(dict.fromkeys(shown[r.surrogate].values())) for r in ROLES}))
    days = dimensions["date_key"].select("date_key", *[F.col(s).alias(_taken(CALENDAR, s)) for s in shown["date_key"].values()])
    wide = fact.join(days, "date_key")
    sources = {name: source for name, source in FACT_REPORT.items() if name in wanted}
    for role in (CALENDAR, *ROLES):
        sources.update({name: _taken(role, source) for name, source in shown[role.surrogate].items()})
    return wide.select(*[F.col(sources[c]).alias(c) for c in wanted])


def _missing_key(fact: DataFrame) -> Column:
    return reduce(lambda a, b: a | b, [F.col(r.surrogate).isNull() for r in ROLES if r.surrogate in fact.columns])


def unresolved(fact: DataFrame) -> DataFrame:
    """Fact rows with a NULL dimension key."""
    return fact.where(_missing_key(fact))


def resolved(fact: DataFrame) -> DataFrame:
    return fact.where(~_missing_key(fact))


def require_resolved(fact: DataFrame) -> None:
    missing = unresolved(fact).count()
    if missing:
        raise UnresolvedKeyError(f"{missing} fact rows have no dimension version on their order date")


def report_view(fact: DataFrame, dimensions: dict[str, DataFrame],
                columns: list[str] | None = None) -> DataFrame:
    """The wide report of a stored fact: inner joins on all surrogate keys, so a row outside any dimension is dropped.

    All dimensions are joined whatever ``columns`` are asked for, so every metric counts the same rows.
    """
    wanted = columns or REPORT_COLUMNS
    wide = fact.select(*[F.col(c).alias(f"_f_{c}") for c in fact.columns])
    sources = {name: f"_f_{source}" for name, source in FACT_REPORT.items() if name in wanted}
    for role in (CALENDAR, *ROLES):
        shown = {name: source for name, source in role.report.items() if name in wanted}
        side = dimensions[role.surrogate].select(
            F.col(role.surrogate).alias(f"_d_{role.surrogate}"),
            *[F.col(source).alias(name) for name, source in shown.items()])
        wide = wide.join(side, F.col(f"_f_{role.surrogate}") == F.col(f"_d_{role.surrogate}"))
        sources.update({name: name for name in shown})
    return wide.select(*[F.col(sources[c]).alias(c) for c in wanted])
