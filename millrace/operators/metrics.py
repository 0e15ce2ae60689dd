"""Metrics and chart queries on the wide report, and daily totals that are kept up to date."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources.slices import SliceTable

MONEY = "decimal(18,2)"


def metrics() -> dict[str, Column]:
    return {
        "revenue": F.sum("extended_amount").cast(MONEY),
        "units": F.sum("quantity").cast("bigint"),
        "orders": F.count_distinct("order_id"),
        "avg_line": F.avg("extended_amount").cast("decimal(18,4)"),
        "row_count": F.count(F.lit(1)),
    }


GRAIN = {"P1D": "DAY", "P1M": "MONTH", "P3M": "QUARTER", "P1Y": "YEAR"}


def chart_query(report: DataFrame, wanted: Sequence[str], by: Sequence[str] = (),
                time_column: str | None = None, grain: str | None = None,
                descending_by: str | None = None, limit: int | None = None) -> DataFrame:
    """Aggregate ``wanted`` metrics by columns, or by a time column cut to a grain.

    Ordering with a limit adds the group columns as tie-break, so the same rows come back.
    """
    known = metrics()
    groups: list[Column] = [F.col(c) for c in by]
    names = list(by)
    if time_column is not None:
        groups.append(F.trunc(time_column, GRAIN[grain]).alias(time_column)
                      if grain != "P1D" else F.col(time_column))
        names.append(time_column)
    out = report.groupBy(*groups).agg(*[known[m].alias(m) for m in wanted])
    if descending_by is not None:
        out = out.orderBy(F.col(descending_by).desc(), *names)
    elif time_column is not None:
        out = out.orderBy(*names)
    return out.limit(limit) if limit is not None else out


# ---- maintained totals -----------------------------------------------------------------------

#: Column sets that totals are kept for, each by order date.
GROUPED_BY: dict[str, tuple[str, ...]] = {
    "all": (), "segment": ("segment",), "category": ("category_name",), "region_channel": ("region", "channel")}
KEYS = list(dict.fromkeys(c for columns in GROUPED_BY.values() for c in columns))
REPORT_NEEDED = ["order_id", "order_date", "quantity", "extended_amount", *KEYS]


def daily_totals(report: DataFrame) -> DataFrame:
    """Revenue, units, orders and lines by order date and each column set, from one pass over the report.

    An order has one date, so its distinct count by date and columns adds up over dates.
    """
    def one_set(name: str, columns: Sequence[str]) -> Column:
        return F.struct(F.lit(name).alias("grouped_by"), *[
            (F.col(c) if c in columns else F.lit(None).cast(report.schema[c].dataType)).alias(c) for c in KEYS])

    # Dealt by order once: its lines are brought together for every set without a further exchange.
    spread = report.repartition("order_id").select(
        "order_id", "order_date", "quantity", "extended_amount",
        F.explode(F.array(*[one_set(n, columns) for n, columns in GROUPED_BY.items()])).alias("_set")) \
        .select("order_id", "order_date", "quantity", "extended_amount", "_set.*")
    groups = ["grouped_by", "order_date", *KEYS]
    per_order = spread.groupBy("order_id", *groups).agg(
        F.sum("extended_amount").alias("revenue"), F.sum("quantity").cast("bigint").alias("units"), F.count(F.lit(1)).alias("lines"))
    return per_order.groupBy(*groups).agg(
        F.sum("revenue").cast(per_order.schema["revenue"].dataType).alias("revenue"), F.sum("units").alias("units"), F.count("order_id").alias("orders"),
        F.sum("lines").alias("lines")).select("order_date", *KEYS, "grouped_by", "revenue", "units", "orders", "lines") \
        .withColumn("month", F.trunc("order_date", "MONTH"))


class MaintainedTotals:
    """Daily totals as a table sliced by month; a refresh counts the months that changed anew and leaves the others."""

    def __init__(self, spark, path: str, schema=None):
        self.table = SliceTable(spark, path, schema, "month")

    @classmethod
    def build(cls, path: str, report: DataFrame) -> MaintainedTotals:
        totals = daily_totals(report)
        out = cls(report.sparkSession, path, totals.schema)
        out.table.overwrite(totals, ["grouped_by"])
        return out

    def refresh(self, report: DataFrame, months: Iterable[str]) -> None:
        """The named months (their first days) as ``report`` has them now."""
        months = list(months)
        chosen = F.trunc("order_date", "MONTH").cast("string").isin(months)
        self.table.replace_slices(daily_totals(report.where(chosen)), months, ["grouped_by"])

    def chart(self, wanted: Sequence[str], grouped_by: str = "all", grain: str | None = None,
              descending_by: str | None = None, limit: int | None = None) -> DataFrame:
        """``chart_query`` by one of ``GROUPED_BY`` or a grain of the order date, from the totals."""
        lines = F.sum("lines")
        known = {"revenue": F.sum("revenue").cast(MONEY), "units": F.sum("units"), "orders": F.sum("orders"),
                 "avg_line": (F.sum("revenue") / lines).cast("decimal(18,4)"), "row_count": lines}
        names = list(GROUPED_BY[grouped_by])
        groups = [F.col(c) for c in names]
        if grain is not None:
            groups.append(F.trunc("order_date", GRAIN[grain]).alias("order_date") if grain != "P1D" else F.col("order_date"))
            names.append("order_date")
        out = self.table.read().where(F.col("grouped_by") == grouped_by).groupBy(*groups).agg(*[known[m].alias(m) for m in wanted])
        if not groups:  # no rows at all: counts are zero, as over an empty report
            out = out.select(*[F.coalesce(m, F.lit(0).cast("bigint")).alias(m) if m in ("orders", "row_count") else F.col(m) for m in wanted])
        if descending_by is not None:
            out = out.orderBy(F.col(descending_by).desc(), *names)
        elif grain is not None:
            out = out.orderBy(*names)
        return out.limit(limit) if limit is not None else out
