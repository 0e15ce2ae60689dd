"""Change-event streams: landing inserts, applying every kind of change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import history
from millrace.operators.keyed import latest_per_key
from millrace.sources.slices import SliceTable

INSERT_OPS = ("c", "r")


def envelope_schema(row: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("op", T.StringType()), T.StructField("before", row), T.StructField("after", row),
        T.StructField("source", T.StructType([T.StructField("seq", T.LongType())])),
        T.StructField("ts_ms", T.LongType()),
    ])


def open_stream(spark: SparkSession, fmt: str, path: str | None = None, **options: str) -> DataFrame:
    """A stream with a text column ``value``: a folder of files, or a broker where its jar is present."""
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "parquet":
        reader = reader.schema("value string")
    stream = reader.load(path) if path else reader.load()
    return stream.select(F.col("value").cast("string").alias("value"))


def parse(stream: DataFrame, row: T.StructType) -> DataFrame:
    """Envelope fields; a NULL value or broken text has no ``op`` and is dropped by any later filter."""
    return stream.select(F.from_json("value", envelope_schema(row)).alias("e")).select("e.*")


def inserts(changes: DataFrame) -> DataFrame:
    """Images of inserted and snapshot rows; updates, deletes and tombstones fall out."""
    return changes.where(F.col("op").isin(*INSERT_OPS)).select("after.*")


def _start(writer, continuous: bool) -> StreamingQuery:
    if continuous:
        return writer.trigger(processingTime="5 seconds").start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def land_inserts(stream: DataFrame, row: T.StructType, out: str, checkpoint: str,
                 continuous: bool = False) -> StreamingQuery:
    """Append inserted rows as Parquet, each exactly once across restarts.

    By default takes what is there and stops; ``continuous`` keeps polling.
    """
    rows = inserts(parse(stream, row))
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", out).option(
        "checkpointLocation", checkpoint)
    return _start(writer, continuous)


# ---- applying changes ----------------------------------------------------------------------

def state_schema(row: T.StructType) -> T.StructType:
    return T.StructType(list(row.fields) + [
        T.StructField("seq", T.LongType()), T.StructField("is_deleted", T.BooleanType()),
        T.StructField("bucket", T.IntegerType())])


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def latest_changes(changes: DataFrame, key: str, buckets: int) -> DataFrame:
    """The last change of each key as a state row; a delete keeps the row it removed, marked."""
    image = F.coalesce("after", "before")
    rows = changes.where(F.col("op").isNotNull()).select(
        image.alias("image"), F.col("source.seq").alias("seq"), (F.col("op") == "d").alias("is_deleted"),
    ).select("image.*", "seq", "is_deleted")
    return latest_per_key(rows, [key], [F.col("seq").desc(), F.col("is_deleted").desc()]).withColumn(
        "bucket", bucket_of(key, buckets))


def keep_newest(key: str):
    """Merge rule: the later ``seq`` wins, so late or repeated batches change nothing."""
    def combine(state: DataFrame, batch: DataFrame) -> DataFrame:
        return latest_per_key(state.unionByName(batch), [key], [F.col("seq").desc(), F.col("is_deleted").desc()])
    return combine


def apply_changes(stream: DataFrame, row: T.StructType, key: str, state: SliceTable, checkpoint: str,
                  buckets: int = 8, continuous: bool = False) -> StreamingQuery:
    """Keep ``state`` equal to the source: inserts, updates and deletes, one merge per batch.

    A batch replayed after a crash changes nothing, as the later ``seq`` wins.  ``buckets`` is how many slices the
    state has; size it so that one fits a few tasks (state bytes / 1 GB, say).  A merge rewrites the buckets of its keys only.
    """
    changes = parse(stream, row)

    def apply(batch: DataFrame, batch_id: int) -> None:
        state.merge(latest_changes(batch, key, buckets), [key], keep_newest(key), slice_of_key=True)

    writer = changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return _start(writer, continuous)


def live_rows(state: SliceTable, row: T.StructType) -> DataFrame:
    return state.read().where(~F.col("is_deleted")).select(*row.names)


# ---- versions from changes -------------------------------------------------------------------

def daily_schema(row: T.StructType) -> T.StructType:
    return T.StructType(list(row.fields) + [
        T.StructField("_day", T.DateType()), T.StructField("_seq", T.LongType()), T.StructField("_deleted", T.BooleanType()),
        T.StructField("bucket", T.IntegerType())])


def daily_rows(stream: DataFrame, row: T.StructType, key: str, dated_by: str, table: SliceTable, checkpoint: str,
               buckets: int = 8, continuous: bool = False) -> StreamingQuery:
    """Keep the last change of each key and day, by ``seq``; one merge per batch.

    The versions follow from this table alone (``history_of``), so however the stream is cut into batches, and in
    whatever order days arrive, they are the same.  The day is ``dated_by`` of the row; that of a delete, whose row is the old one, is the
    event's ``ts_ms`` (UTC) where it has one.  A delete wins over another change of the same ``seq``.  Changes without key or day
    are left out.
    """
    changes = parse(stream, row)
    newest = [F.col("_seq").desc(), F.col("_deleted").desc()]
    deleted = F.col("op") == "d"
    happened = F.when(deleted, F.to_date(F.timestamp_millis("ts_ms")))

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = batch.where(F.col("op").isin("c", "r", "u", "d")) \
            .select(F.when(deleted, F.col("before")).otherwise(F.col("after")).alias("image"), F.col("source.seq").alias("_seq"),
                    deleted.alias("_deleted"), happened.alias("_happened")) \
            .select("image.*", "_seq", "_deleted", F.coalesce("_happened", F.col(f"image.{dated_by}").cast("date")).alias("_day")) \
            .dropna(subset=[key, "_day"])
        fed = latest_per_key(rows, [key, "_day"], newest).withColumn("bucket", bucket_of(key, buckets)).select(*table.schema.names)
        table.merge(fed, [key, "_day"], lambda kept, new: latest_per_key(kept.unionByName(new), [key, "_day"], newest),
                    slice_of_key=True)

    writer = changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return _start(writer, continuous)


def history_of(table: SliceTable, dim: history.Dimension) -> DataFrame:
    """All versions of the keys in a table of daily rows; a delete ends a version, a later row begins another."""
    return history.replay(table.read(), dim, "_day", [F.col("_seq").desc()], deleted="_deleted")
