"""Catalog, column lineage and impact analysis as tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.typeclass import by_column_name, by_native_type
from millrace.session import scratch

CATALOG_SCHEMA = "dataset string, position int, column string, native_type string"


def column_catalog(spark: SparkSession, frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per dataset and column of real frames, with its logical type by type and by name."""
    rows = [(dataset, i, f.name, f.dataType.simpleString())
            for dataset, df in frames.items() for i, f in enumerate(df.schema.fields, 1)]
    return spark.createDataFrame(rows, CATALOG_SCHEMA).select(
        "*", by_native_type(F.col("native_type")).alias("type_class"),
        by_column_name(F.col("column")).alias("name_class"))


def column_edges(columns: DataFrame, edges: DataFrame, explicit: DataFrame) -> DataFrame:
    """Column edges: the explicit map where a downstream has one, else columns of equal name.

    ``columns(dataset, column)``, ``edges(downstream, upstream)`` and
    ``explicit(downstream, down_column, upstream, up_column)``.  Each edge is expanded from its
    narrower end and looked up at the other, so the candidates never exceed the smaller of the
    two column lists, even where one dataset holds much of the catalog and many edges.
    """
    named = columns.select("dataset", "column").distinct()
    width = named.groupBy("dataset").agg(F.count(F.lit(1)).alias("width"))
    mapped = explicit.select("downstream").distinct()
    measured = (
        edges.select("downstream", "upstream").distinct().join(mapped, "downstream", "left_anti")
        .join(width.select(F.col("dataset").alias("downstream"), F.col("width").alias("_down")), "downstream")
        .join(width.select(F.col("dataset").alias("upstream"), F.col("width").alias("_up")), "upstream")
    )

    from_up = F.col("_up") <= F.col("_down")
    ends = measured.select(
        F.when(from_up, F.col("upstream")).otherwise(F.col("downstream")).alias("near"),
        F.when(from_up, F.col("downstream")).otherwise(F.col("upstream")).alias("far"), from_up.alias("from_up"))
    shared = (
        ends.join(named.withColumnRenamed("dataset", "near"), "near")
        .join(named.withColumnRenamed("dataset", "far"), ["far", "column"], "left_semi")
    )
    same_name = shared.select(
        F.when(F.col("from_up"), F.col("far")).otherwise(F.col("near")).alias("downstream"),
        F.col("column").alias("down_column"),
        F.when(F.col("from_up"), F.col("near")).otherwise(F.col("far")).alias("upstream"),
        F.col("column").alias("up_column"), F.lit(False).alias("is_explicit"))
    return same_name.unionByName(explicit.select(
        "downstream", "down_column", "upstream", "up_column", F.lit(True).alias("is_explicit")))


def broken_edges(edges: DataFrame, columns: DataFrame) -> DataFrame:
    """Column edges naming a column the catalog does not have, with the side at fault."""
    known = columns.select("dataset", "column").distinct()
    checked, sides = edges.select("downstream", "down_column", "upstream", "up_column"), []
    for side, dataset, column in (("downstream", "downstream", "down_column"), ("upstream", "upstream", "up_column")):
        at = known.select(F.col("dataset").alias(dataset), F.col("column").alias(column), F.lit(True).alias(f"_{side}"))
        checked = checked.join(at, [dataset, column], "left")
        sides.append(F.when(F.col(f"_{side}").isNull(), F.lit(side)))
    # Both sides from one pass over the edges.
    return checked.select("downstream", "down_column", "upstream", "up_column", F.explode(F.array_compact(F.array(*sides))).alias("side"))


def process_edges(jobs: DataFrame) -> DataFrame:
    """``jobs(job, inputs, outputs)`` spread into one row per job, direction and dataset."""
    def tagged(name: str, direction: str):
        return F.transform(name, lambda d: F.struct(F.lit(direction).alias("direction"), d.alias("dataset")))

    ends = F.concat(tagged("inputs", "input"), tagged("outputs", "output"))
    return jobs.select("job", F.explode(ends).alias("end")).select("job", "end.*").distinct()


def dataset_edges(jobs: DataFrame) -> DataFrame:
    """Dataset edges (upstream, downstream) implied by jobs."""
    return jobs.select(F.explode("inputs").alias("upstream"), "outputs").select(
        "upstream", F.explode("outputs").alias("downstream")).distinct()


def reachable(spark: SparkSession, edges: DataFrame, roots: DataFrame, hops: int,
              upstream: bool = False) -> DataFrame:
    """``(root, node, hop)``: everything within ``hops`` steps of each root, at its shortest distance.

    Breadth first: each step joins only the newest level and drops what was reached before, so
    cycles end by themselves.  The edges and every level are written tables, which keeps the plan
    from growing and survives lost executors.
    """
    near, far = ("downstream", "upstream") if upstream else ("upstream", "downstream")
    folder = scratch(spark, "reach")
    layout = "root string, node string, hop int"

    def level(number: int, df: DataFrame) -> DataFrame:
        path = f"{folder}/levels/hop={number}"
        df.write.parquet(path)
        return spark.read.schema("root string, node string").parquet(path)

    edges.select(F.col(near).alias("node"), F.col(far).alias("next")).distinct().write.parquet(f"{folder}/edges")
    step = spark.read.schema("node string, next string").parquet(f"{folder}/edges")
    newest = level(0, roots.select(F.col("node").alias("root"), "node").distinct())
    done = 0
    while done < hops and not newest.isEmpty():
        seen = spark.read.schema(layout).parquet(f"{folder}/levels").select("root", "node")
        found = newest.join(step, "node").select("root", F.col("next").alias("node")).distinct()
        done += 1
        newest = level(done, found.join(seen, ["root", "node"], "left_anti"))
    return spark.read.schema(layout).parquet(f"{folder}/levels").where("hop > 0")
