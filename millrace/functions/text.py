"""Conforming rules and identifiers found in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def plain(name: str) -> Column:
    return F.trim(F.col(name))


def upper(name: str) -> Column:
    return F.upper(F.trim(F.col(name)))


def lower(name: str) -> Column:
    return F.lower(F.trim(F.col(name)))


def title(name: str) -> Column:
    return F.initcap(F.trim(F.col(name)))


def zero_padded(number: Column, width: int = 4) -> Column:
    """At least ``width`` digits; longer numbers are kept whole."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def id_hash(number: Column) -> Column:
    """Upper-case hex SHA-256 of the number's digits."""
    return F.upper(F.sha2(number.cast("string"), 256))


# The pattern and prefix of identifiers.
ID_IN_PATH = r"(urn:li:[^\s/?#&]+)"
ID_PREFIX = "urn:li:"


def ids_in_url(url: Column, in_path: str = ID_IN_PATH, value_prefix: str = ID_PREFIX) -> Column:
    """Identifiers of one URL in order, without repeats.

    Taken from the decoded path by pattern, then from decoded query values by prefix.
    A part that cannot be decoded yields nothing.
    """
    link = F.trim(url)
    no_fragment = F.regexp_replace(link, r"#.*$", "")
    path = F.regexp_replace(F.regexp_replace(no_fragment, r"\?.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    # '+' is a blank in a query but itself in a path.
    decoded_path = F.try_url_decode(F.regexp_replace(path, r"\+", "%2B"))
    from_path = F.regexp_extract_all(F.coalesce(decoded_path, F.lit("")), F.lit(in_path), F.lit(1))
    query = F.when(F.instr(no_fragment, "?") > 0, F.regexp_replace(no_fragment, r"^[^?]*\?", ""))
    values = F.transform(
        F.split(F.coalesce(query, F.lit("")), "&"),
        lambda pair: F.try_url_decode(F.regexp_replace(pair, r"^[^=]*=?", "")))
    from_query = F.filter(values, lambda v: v.isNotNull() & v.startswith(value_prefix))
    return F.array_distinct(F.concat(from_path, from_query))


def dataset_id(platform: Column, instance: Column, name: Column, env: Column) -> Column:
    """Dataset identifier with its platform instance in front of the name."""
    return F.format_string("urn:li:dataset:(urn:li:dataPlatform:%s,%s.%s,%s)", platform, instance, name, env)


def column_id(dataset: Column, column: Column) -> Column:
    return F.format_string("urn:li:schemaField:(%s,%s)", dataset, column)


def check_id(owner: Column, schema: Column, table: Column, code: Column) -> Column:
    return F.concat(F.lit("urn:li:assertion:"), F.lower(F.concat_ws("_", owner, schema, table, code)))
