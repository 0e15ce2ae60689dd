"""Feeds of text files: writing, manifest, reading as text, typing, control totals."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from datetime import date, datetime, timezone
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.casts import to_type
from millrace.session import together
from millrace.sources import files

# A leading underscore would hide the file from Spark readers.
MANIFEST = "manifest.json"
EPOCH = datetime(1970, 1, 1)

# Field names and the epoch are fixed values.
MANIFEST_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("run_date", T.StringType()),
    T.StructField("extracted_at", T.StringType()),
    T.StructField("run_hwm", T.StringType()),
    T.StructField("tables", T.ArrayType(T.StructType([
        T.StructField("table", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("low_watermark", T.StringType()),
        T.StructField("rows", T.LongType()),
    ]))),
])


class ControlTotalError(ValueError):
    """Rows read differ from the manifest, or the manifest does not name a table."""


# ---- reading -------------------------------------------------------------------------------

def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def require_feeds(spark: SparkSession, paths: Sequence[str]) -> None:
    """Fail before anything is read or written if one input is missing."""
    missing = [p for p in paths if not files.exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"missing feed input: {', '.join(missing)}")


def daily_feed_path(inbound: str, feed: str, day: date) -> str:
    return f"{inbound}/{feed}_{day:%Y%m%d}.csv"


def read_text_feed(spark: SparkSession, path: str, columns: Sequence[str],
                   line_breaks: bool = False) -> DataFrame:
    """CSV with a header, every declared column as text; other columns of the file are left out.

    The header decides which column is which, so the declared order need not be the file's; a
    folder whose files disagree on the header is refused.  ``line_breaks`` allows them inside
    quotes, at the price of reading each file in one task; a feed that a writer splits into files stays parallel.
    """
    require_feeds(spark, [path])
    options = {"header": True, "encoding": "UTF-8", "multiLine": line_breaks, "quote": '"', "escape": '"'}
    header = spark.read.options(**options).csv(path).columns
    absent = [c for c in columns if c not in header]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    return (
        spark.read.schema(text_schema(header)).options(**options, enforceSchema=False).csv(path).select(*columns)
    )


def read_stage(spark: SparkSession, path: str, columns: Sequence[str], business_date: date) -> DataFrame:
    """One day's raw landing: text columns, the business date and the load time (UTC)."""
    return read_text_feed(spark, path, columns).select(
        *columns, F.lit(business_date).alias("load_business_date"), F.current_timestamp().alias("loaded_at"))


def stamp_ingest(df: DataFrame, run_date: date, source_file: Column | str | None = None) -> DataFrame:
    """Add ``_run_date``, ``_source_file`` and ``_ingested_at``.

    Without a name the file each row was read from is used.
    """
    origin = F.col("_metadata.file_name") if source_file is None else (
        F.lit(source_file) if isinstance(source_file, str) else source_file)
    return df.select("*", F.lit(run_date).alias("_run_date"), origin.alias("_source_file"),
                     F.current_timestamp().alias("_ingested_at"))


# ---- typing --------------------------------------------------------------------------------

def typed(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Cast the mapped columns, leave the rest text; text that does not cast becomes NULL."""
    return df.select(*[to_type(c, casts[c]).alias(c) if c in casts else F.col(c) for c in df.columns])


def _failed(casts: Mapping[str, str], columns: Sequence[str]) -> list[tuple[str, Column]]:
    return [(c, F.col(c).isNotNull() & to_type(c, t).isNull()) for c, t in casts.items() if c in columns]


def split_bad_casts(df: DataFrame, casts: Mapping[str, str], key: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(typed rows, quarantined raw rows with the list of columns that did not cast or miss a part of ``key``)."""
    failed = _failed(casts, df.columns) + [(c, F.col(c).isNull()) for c in key]
    any_failed = reduce(lambda a, b: a | b, [test for _, test in failed], F.lit(False))
    reasons = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in failed]))
    good = typed(df.where(~any_failed), casts)
    bad = df.where(any_failed).withColumn("reasons", reasons)
    return good, bad


# ---- extracting ----------------------------------------------------------------------------

def extract_window(df: DataFrame, low: datetime, high: datetime, updated: str = "updated_at") -> DataFrame:
    """Rows changed in [low, high], both ends included.

    A row stamped in the boundary second comes again next time; the keyed load absorbs it.
    """
    return df.where(F.col(updated).between(F.lit(low).cast(df.schema[updated].dataType),
                                           F.lit(high).cast(df.schema[updated].dataType)))


def write_text_feed(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """CSV with header, NULL as an empty field, quotes only where needed; text may hold quotes and line breaks."""
    writer = (df.write.mode("error").option("header", True).option("nullValue", "").option("emptyValue", "")
              .option("lineSep", "\n").option("escape", '"')
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def write_daily_feeds(df: DataFrame, inbound: str, feed: str, by: str, days: Iterable[date] = ()) -> list[date]:
    """The feed of every day from one pass over the rows, each where ``daily_feed_path`` says; the days, in order.

    ``days`` without rows get a feed of no rows.  Rows whose ``by`` is null belong to no day and are refused.
    """
    spark, aside = df.sparkSession, f"{inbound}/{feed}-{uuid.uuid4().hex}"
    write_text_feed(df.hint("rebalance", by), aside, [by])
    made = {name.split("=", 1)[1]: name for name in files.child_names(spark, aside) if "=" in name}
    if any(not value[:1].isdigit() for value in made):
        raise ValueError(f"{feed}: rows without {by}")
    for value, name in made.items():
        files.move(spark, f"{aside}/{name}", daily_feed_path(inbound, feed, date.fromisoformat(value)))
    files.remove(spark, aside)
    found = {date.fromisoformat(value) for value in made}
    for day in set(days) - found:
        write_text_feed(df.drop(by).limit(0), daily_feed_path(inbound, feed, day))
    return sorted(found | set(days))


def publish_manifest(spark: SparkSession, folder: str, source: str, run_date: date, high: datetime,
                     tables: Sequence[tuple[str, str, datetime, int]]) -> None:
    """The completion marker of a feed; written after all its files.  A feed extracted again replaces its marker.

    The field names are fixed values.
    """
    files.publish_json(spark, f"{folder}/{MANIFEST}", {
        "source": source, "run_date": run_date.isoformat(),
        "extracted_at": datetime.now(timezone.utc).isoformat(timespec="seconds"),
        "run_hwm": str(high),
        "tables": [{"table": t, "file": f, "low_watermark": str(low), "rows": n} for t, f, low, n in tables]}, replace=True)


def _dated(spark: SparkSession, state_dir: str, kind: str, before: date | None = None) -> list[str]:
    """Run dates in the ledger, in order: ``window`` where an extract has begun, ``done`` where its feed stands."""
    dates = [n[len(kind) + 1:-len(".json")] for n in files.child_names(spark, state_dir) if n.startswith(f"{kind}-") and n.endswith(".json")]
    return [d for d in dates if before is None or d < before.isoformat()]


def read_state(spark: SparkSession, state_dir: str, before: date | None = None) -> dict[str, datetime]:
    """High watermark per table over the feeds that stand (of run dates ``before`` one); none before the first run.

    It is the highest of all, so a late or repeated run date never moves it back.
    """
    out: dict[str, datetime] = {}
    for day in _dated(spark, state_dir, "done", before):
        for name, (_, high) in _windows(spark, state_dir, day, "done").items():
            out[name] = max(out.get(name, EPOCH), high)
    return out


def _windows(spark: SparkSession, state_dir: str, day: str, kind: str = "window") -> dict[str, tuple[datetime, datetime]]:
    path = f"{state_dir}/{kind}-{day}.json"
    body = files.read_json(spark, path) if files.exists(spark, path) else {}
    return {name: (datetime.fromisoformat(low), datetime.fromisoformat(high)) for name, (low, high) in body.items()}


def reserve_windows(spark: SparkSession, state_dir: str, tables: Iterable[str], run_date: date, high: datetime,
                    full: bool = False) -> dict[str, tuple[datetime, datetime]]:
    """The window of each table for a run date, stored before anything is extracted.

    A run date keeps the window that it got first, whatever ``high`` says on a repeat; a table that it did not extract before
    gets one now.  Low is the highest watermark of earlier run dates whose feeds stand, so a date that died leaves its rows to the next one.
    ``full`` starts at the epoch and replaces the window.
    """
    known = {} if full else _windows(spark, state_dir, run_date.isoformat())
    state = {} if full else read_state(spark, state_dir, run_date)
    out = {name: known.get(name, (state.get(name, EPOCH), high)) for name in tables}
    _store(spark, f"{state_dir}/window-{run_date.isoformat()}.json", {**known, **out})
    return out


def _store(spark: SparkSession, path: str, windows: Mapping[str, tuple[datetime, datetime]]) -> None:
    files.publish_json(spark, path, {name: [str(low), str(high)] for name, (low, high) in windows.items()}, replace=True)


def extract_feed(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str, state_dir: str,
                 source: str, run_date: date, high: datetime, full: bool = False,
                 updated: str = "updated_at") -> None:
    """Store the windows, write every table's changes (several tables at once), then the manifest, then note that the feed stands.

    A run date extracted again reads its own windows again (``reserve_windows``).  Each attempt writes folders of its own and the manifest names them, so a run date can be extracted again, after a
    crash or not: until the manifest is replaced the earlier feed stands.  Rows are counted on their way into the files,
    without the reader whose result they will be compared with.
    """
    windows = reserve_windows(spark, state_dir, tables, run_date, high, full)
    attempt = uuid.uuid4().hex

    def write(name: str, df: DataFrame) -> tuple[str, str, datetime, int]:
        low, upto = windows[name]
        path = f"{folder}/{name}_{run_date.isoformat()}_{attempt}.csv"
        counted = Observation(f"{name}-{attempt}")
        window = extract_window(df, low, upto, updated).sortWithinPartitions(updated)
        write_text_feed(window.observe(counted, F.count(F.lit(1)).alias("rows")), path)
        return name, path.rsplit("/", 1)[1], low, counted.get.get("rows", 0)

    listed = together(spark, *[partial(write, name, df) for name, df in tables.items()])
    publish_manifest(spark, folder, source, run_date, max((upto for _, upto in windows.values()), default=high), listed)
    day = run_date.isoformat()
    _store(spark, f"{state_dir}/done-{day}.json", {**_windows(spark, state_dir, day, "done"), **windows})


# ---- control totals ------------------------------------------------------------------------

def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per table of the feed; an absent or empty manifest is a failure."""
    path = f"{folder}/{MANIFEST}"
    require_feeds(spark, [path])
    listed = (
        spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).json(path)
        .select("source", "run_date", F.explode("tables").alias("t"))
        .select("source", "run_date", "t.*")
    )
    if listed.isEmpty():
        raise ControlTotalError(f"{path} names no table")
    return listed


def control_totals(manifest: DataFrame, counted: DataFrame) -> DataFrame:
    """Manifest rows beside counted rows; a table on one side only does not agree.

    ``counted`` has ``table`` and ``rows_read``.
    """
    return manifest.select("table", F.col("rows").alias("rows_expected")).join(counted, "table", "full").select(
        "table", "rows_expected", "rows_read",
        F.coalesce(F.col("rows_expected") == F.col("rows_read"), F.lit(False)).alias("agrees"))


def require_totals(totals: DataFrame) -> None:
    wrong = [row.asDict() for row in totals.where(~F.col("agrees")).collect()]
    if wrong:
        raise ControlTotalError(f"control totals differ: {wrong}")


def manifest_entries(spark: SparkSession, folder: str, tables: Sequence[str]) -> dict[str, tuple[str, int]]:
    """File and expected rows of each table; the manifest must name all of them."""
    named = {r["table"]: (r["file"], r["rows"]) for r in read_manifest(spark, folder).collect()}
    absent = [t for t in tables if t not in named]
    if absent:
        raise ControlTotalError(f"manifest does not name {', '.join(absent)}")
    return {t: named[t] for t in tables}
