"""Logical type of a column, by its native type or by its name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Native type prefixes in the order they are tried.
NATIVE_PREFIXES = [
    ("string", ["nvarchar", "varchar", "char", "string"]),
    ("number", ["decimal", "numeric", "bigint", "int", "float", "real", "smallint", "double"]),
    ("boolean", ["bit", "boolean"]),
    ("time", ["datetime", "timestamp"]),
    ("date", ["date"]),
]

# Names that are numbers without a telling suffix.
NUMBER_NAMES = ["quantity", "year", "quarter", "month", "day", "day_of_week", "week_of_year"]


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def by_native_type(native: Column) -> Column:
    kind = F.lower(native)
    chosen = F
    for label, prefixes in NATIVE_PREFIXES:
        chosen = chosen.when(_any([kind.startswith(p) for p in prefixes]), label)
    return chosen.otherwise("string")


def by_column_name(name: Column) -> Column:
    """First rule that fits wins: flags, times, dates, numbers, else text."""
    n = F.lower(name)
    return (
        F.when(n.startswith("is_") | n.endswith("_flag"), "boolean")
        .when(n.endswith("_ts") | n.endswith("_at"), "timestamp")
        .when((n == "date") | n.endswith("_date") | n.isin("valid_from", "valid_to"), "date")
        .when(n.rlike("_(id|key|no)$") | n.isin(*NUMBER_NAMES) | n.rlike("price|amount|total|pct"), "number")
        .otherwise("string")
    )
