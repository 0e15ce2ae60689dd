"""Casts that turn bad text into NULL, and money arithmetic on decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal text.  Exponents and thousands separators are not numbers in a feed.
DECIMAL_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)\s*$"


def _column(source: Column | str) -> Column:
    return F.col(source) if isinstance(source, str) else source


def to_decimal(source: Column | str, precision: int = 18, scale: int = 2) -> Column:
    text = _column(source)
    return F.when(text.rlike(DECIMAL_TEXT), text.try_cast(f"decimal({precision},{scale})"))


def to_timestamp_ms(source: Column | str) -> Column:
    """Timestamp without zone, rounded to milliseconds; '' and garbage give NULL.

    Truncation goes through a zoned timestamp, so it relies on the session zone being UTC.
    """
    nudged = _column(source).try_cast("timestamp_ntz") + F.expr("INTERVAL '0.0005' SECOND")
    return F.date_trunc("MILLISECOND", nudged).cast("timestamp_ntz")


def to_type(source: Column | str, type_name: str) -> Column:
    """``try_cast`` by type name, with the decimal text guard."""
    text = _column(source)
    if type_name.startswith("decimal"):
        return F.when(text.rlike(DECIMAL_TEXT), text.try_cast(type_name))
    return text.try_cast(type_name)


def line_amount(quantity: Column, unit_price: Column, discount: Column) -> Column:
    """quantity x price x (1 - discount), half-up to cents, never through a float."""
    return F.round(quantity * unit_price * (F.lit(1).cast("decimal(1,0)") - discount), 2)


def hours_between(earlier: Column, later: Column) -> Column:
    """Whole seconds over 3600."""
    return F.timestamp_diff("SECOND", earlier, later) / F.lit(3600.0)
