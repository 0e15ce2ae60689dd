"""One run of the sales warehouse: feed to log, current state, dimensions, fact, checks."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import text
from millrace.operators import history, keyed, quality, star
from millrace.session import together
from millrace.sources import feeds, files
from millrace.sources.slices import SliceTable, Staged

Rule = Callable[[str], Column]


@dataclass(frozen=True)
class Source:
    """A fed table: its columns with types (text where none is given), key and conform rules."""

    columns: Mapping[str, str]
    key: tuple[str, ...]
    rules: Mapping[str, Rule] = field(default_factory=dict)

    @property
    def casts(self) -> dict[str, str]:
        return {c: t for c, t in self.columns.items() if t != "string"}


STAMPS = {"created_at": "timestamp", "updated_at": "timestamp"}
SOURCES: dict[str, Source] = {
    "product_categories": Source(
        {"category_id": "int", "category_name": "string", **STAMPS}, ("category_id",), {"category_name": text.plain}),
    "customers": Source(
        {"customer_id": "bigint", "first_name": "string", "last_name": "string", "email": "string",
         "segment": "string", "city": "string", "state": "string", "country": "string", "signup_date": "date", **STAMPS},
        ("customer_id",),
        {"first_name": text.title, "last_name": text.title, "email": text.lower, "segment": text.upper,
         "city": text.title, "state": text.upper, "country": text.upper}),
    "products": Source(
        {"product_id": "bigint", "sku": "string", "product_name": "string", "category_id": "int",
         "unit_price": "decimal(10,2)", "active_flag": "int", **STAMPS},
        ("product_id",), {"sku": text.upper, "product_name": text.plain}),
    "stores": Source(
        {"store_id": "int", "store_name": "string", "channel": "string", "region": "string", "city": "string",
         "state": "string", "country": "string", **STAMPS},
        ("store_id",),
        {"store_name": text.plain, "channel": text.upper, "region": text.plain, "city": text.title,
         "state": text.upper, "country": text.upper}),
    "orders": Source(
        {"order_id": "bigint", "customer_id": "bigint", "store_id": "int", "order_ts": "timestamp",
         "order_date": "date", "status": "string", "order_total": "decimal(12,2)", **STAMPS},
        ("order_id",), {"status": text.upper}),
    "order_items": Source(
        {"order_id": "bigint", "line_no": "int", "product_id": "bigint", "quantity": "int",
         "unit_price": "decimal(10,2)", "discount_pct": "decimal(5,4)", "line_amount": "decimal(12,2)", **STAMPS},
        ("order_id", "line_no")),
}

DIMENSIONS = {
    "customers": history.Dimension(
        "customer_id", "customer_key",
        ("first_name", "last_name", "email", "segment", "city", "state", "country", "signup_date"),
        ("segment", "city", "state")),
    "products": history.Dimension(
        "product_id", "product_key",
        ("sku", "product_name", "category_id", "category_name", "unit_price", "active_flag"),
        ("unit_price", "product_name", "category_name")),
    "stores": history.Dimension(
        "store_id", "store_key", ("store_name", "channel", "region", "city", "state", "country"),
        ("region", "channel", "store_name")),
}
GRAIN = ["order_id", "line_no"]


def conform(df: DataFrame, rules: Mapping[str, Rule]) -> DataFrame:
    return df.select(*[rules[c](c).alias(c) if c in rules else F.col(c) for c in df.columns])


class SalesWarehouse:
    """Log, current-state, dimension and fact tables under one folder.

    ``buckets`` is how many slices a current-state table has; size it so that one slice fits a few tasks, as a run
    rewrites the slices of its keys.  A run can be repeated and leaves the same state.  Rows with a value that does not
    cast, or without a whole key, go to a quarantine table by run date and no further.  The fact is sliced by order date, or with
    ``monthly_fact`` by month, where a day is far smaller than a file should be.

    ``run`` stages all tables, checks them as they would be, and publishes them only if the gate passes: a refused day leaves
    what is served as it was (its rows stay in the log, which the corrected feed of the day replaces).  A feed older
    than one that was landed is spliced in: versions and facts of its keys are those of a run in order.

    The tables of one step do not need each other, and some are made at the same time.
    """

    def __init__(self, spark: SparkSession, root: str, first_day: date, last_day: date, buckets: int = 16, monthly_fact: bool = False):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.fact_slice = "order_month" if monthly_fact else "order_date"
        self.first_day, self.last_day = first_day, last_day
        self._staged: dict[tuple[str, str], Staged] | None = None
        self._work: list[str] = []
        self._schemas: dict[str, T.StructType] = {}
        self._late: tuple[date, bool] | None = None  # of the day that runs

    # ---- staging

    def _held(self, df: DataFrame) -> DataFrame:
        """The frame as a written table, for a step that reads it several times; ``_clear`` removes it."""
        path = f"{self.root}/work/{uuid.uuid4().hex}"
        self._work.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _clear(self) -> None:
        while self._work:
            files.remove(self.spark, self._work.pop())

    def _put(self, layer: str, name: str, staged: Staged) -> None:
        if self._staged is None:
            staged.publish()
        else:
            self._staged[layer, name] = staged

    def _rows(self, layer: str, name: str, slice_by: str, slices: list[str] | None = None) -> DataFrame:
        """A table's rows, as they will be where the run has staged it."""
        staged = (self._staged or {}).get((layer, name))
        return staged.read(slices) if staged else self.table(layer, name, slice_by).read(slices)

    def _settle(self, publish: bool) -> None:
        """Current state before dimensions before queue and fact."""
        staged, self._staged = self._staged or {}, None
        ranks = [[key for key in staged if key[0] == "current"], [key for key in staged if key[0] == "star" and key[1] in DIMENSIONS]]
        ranks += [[("star", name)] for name in ("unresolved", "fact") if ("star", name) in staged]
        for rank in ranks:
            together(self.spark, *[staged[key].publish if publish else staged[key].discard for key in rank])

    # ---- tables

    def table(self, layer: str, name: str, slice_by: str, like: DataFrame | None = None) -> SliceTable:
        """A table that exists, or one to be created like the given frame."""
        return SliceTable(self.spark, f"{self.root}/{layer}/{name}", like.schema if like else None, slice_by)

    def _bucketed(self, df: DataFrame, key: tuple[str, ...]) -> DataFrame:
        return df.withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(self.buckets)).cast("int"))

    def log(self, name: str) -> SliceTable:
        if name not in self._schemas:
            columns = [F.lit(None).cast(t).alias(c) for c, t in SOURCES[name].columns.items()]
            self._schemas[name] = feeds.stamp_ingest(self.spark.range(0).select(*columns), self.first_day, "none").schema
        return SliceTable(self.spark, f"{self.root}/log/{name}", self._schemas[name], "_run_date")

    # ---- steps

    def land(self, folder: str, run_date: date) -> None:
        """Typed log slices and quarantine of one feed; together they must hold as many rows as the manifest says.

        All tables are written before one is placed, so a wrong total of one lands none.
        """
        listed = feeds.manifest_entries(self.spark, folder, list(SOURCES))
        staged = together(self.spark, *[partial(self._landed, name, folder, listed[name][0], run_date) for name in SOURCES])
        # What was written is counted in one query (footer counts); one row per table and layer.
        counted = {(r["layer"], r["table"]): r["rows"] for r in reduce(DataFrame.unionByName, [
            load.written().agg(F.count(F.lit(1)).alias("rows")).select(F.lit(layer).alias("layer"), F.lit(name).alias("table"), "rows")
            for name, pair in zip(SOURCES, staged) for layer, load in zip(("quarantine", "log"), pair)]).collect()}
        for name, (_, rows) in listed.items():
            expected = rows - counted["quarantine", name]
            if counted["log", name] != expected:
                raise feeds.ControlTotalError(f"{self.root}/log/{name}: wrote {counted['log', name]} rows, expected {expected}")
        together(self.spark, *[load.publish for pair in staged for load in pair])

    def _landed(self, name: str, folder: str, file: str, run_date: date) -> tuple[Staged, Staged]:
        """Quarantine and log slice of one table, written but not placed."""
        source, day = SOURCES[name], [run_date.isoformat()]
        raw = feeds.read_text_feed(self.spark, f"{folder}/{file}", list(source.columns), line_breaks=True)
        held = feeds.stamp_ingest(raw, run_date, file)
        good, bad = feeds.split_bad_casts(held, source.casts, source.key)
        return self.table("quarantine", name, "_run_date", bad).stage_slices(bad, day), self.log(name).stage_slices(good, day)

    def _newest_first(self, name: str) -> list[Column]:
        return [F.col("updated_at").desc(), F.col("_ingested_at").desc(), F.xxhash64(*SOURCES[name].columns)]

    def _newest(self, df: DataFrame, name: str) -> DataFrame:
        return keyed.latest_per_key(df, SOURCES[name].key, self._newest_first(name))

    def fed(self, name: str, run_date: date) -> DataFrame:
        """The run's latest row per key, conformed."""
        return self._conformed(self._newest(self.log(name).read([run_date.isoformat()]), name), name)

    def _conformed(self, rows: DataFrame, name: str, more: Sequence[str] = ()) -> DataFrame:
        """Rows of the log by the source's rules; products with the name of their category."""
        source = SOURCES[name]
        out = conform(rows.select(*source.columns, *more), source.rules)
        if name != "products":
            return out
        # A product may name a category fed on an earlier day, so look over the whole log.
        names = conform(self._newest(self.log("product_categories").read(), "product_categories"),
                        SOURCES["product_categories"].rules).select("category_id", "category_name")
        return out.join(names, "category_id", "left").select(
            *[c for c in source.columns if c not in STAMPS], "category_name", *STAMPS, *more)

    def current(self, name: str) -> SliceTable:
        return self.table("current", name, "bucket")

    def late(self, run_date: date) -> bool:
        """Whether a later day was landed already."""
        if self._late is not None and self._late[0] == run_date:
            return self._late[1]
        return any(day > run_date.isoformat() for name in SOURCES for day in self.log(name).slices())

    def refresh_current(self, run_date: date) -> None:
        """The run's rows over the stored ones; those of a late feed only where they are newer."""
        newer = "updated_at" if self.late(run_date) else None

        def refresh(name: str, source: Source) -> None:
            key = list(source.key)
            fed = self._bucketed(self.fed(name, run_date), source.key)
            self._put("current", name, self.table("current", name, "bucket", fed).stage_merge(
                fed, key, lambda kept, new: keyed.upsert(kept, new, key, newer, check=False), slice_of_key=True))

        together(self.spark, *[partial(refresh, name, source) for name, source in SOURCES.items() if name != "product_categories"])

    def dimension(self, name: str) -> SliceTable:
        return self.table("star", name, "is_current")

    def refresh_dimensions(self, run_date: date) -> None:
        """Onboard on the first run, advance after; closed rows are only ever added.  A late feed is spliced in."""
        late = self.late(run_date)

        def refresh(name: str, dim: history.Dimension) -> None:
            state = self._rows("current", name, "bucket")
            first = history.onboard(state, dim)
            table = self.table("star", name, "is_current", first)
            if not table.exists():
                staged = table.stage(first)
            elif late:
                staged = table.stage(self._spliced(table, name, dim, run_date), ["true", "false"])
            else:
                # Closed rows stay: a repeated run finds the versions that it opened and closes nothing again.
                staged = table.stage(history.advance(table.read(["true"]), state, dim, run_date), ["true"])
            self._put("star", name, staged)

        together(self.spark, *[partial(refresh, name, dim) for name, dim in DIMENSIONS.items()])

    def _spliced(self, table: SliceTable, name: str, dim: history.Dimension, run_date: date) -> DataFrame:
        """The dimension with a late feed's rows; the log is read for the keys of the feed only."""
        keys = self.log(name).read([run_date.isoformat()]).select(dim.key).distinct()
        of_keys = self.log(name).read().join(keys, dim.key, "left_semi")
        daily = self._conformed(keyed.latest_per_key(of_keys, [dim.key, "_run_date"], self._newest_first(name)), name, ["_run_date"])
        rows = daily.select(dim.key, *dim.attributes, "_run_date")
        today = F.col("_run_date") == F.lit(run_date)
        first = date.fromisoformat(min(day for n in DIMENSIONS for day in self.log(n).slices()))
        return history.splice(table.read(), rows.where(~today), rows.where(today), dim, "_run_date", [F.lit(0)], first)

    def dimensions(self) -> dict[str, DataFrame]:
        out = {dim.surrogate: self._rows("star", name, "is_current") for name, dim in DIMENSIONS.items()}
        out["date_key"] = star.calendar(self.spark, self.first_day, self.last_day)
        return out

    def fact(self) -> SliceTable:
        return self.table("star", "fact", self.fact_slice)

    def queue(self) -> SliceTable:
        """Lines that were set aside because a key had no version on their order date, with these keys."""
        if "unresolved" not in self._schemas:
            columns = ("order_id bigint, line_no int, order_date date, customer_id bigint, product_id bigint, store_id int, "
                       "run_date date, bucket int")
            self._schemas["unresolved"] = self.spark.createDataFrame([], columns).schema
        return SliceTable(self.spark, f"{self.root}/star/unresolved", self._schemas["unresolved"], "bucket")

    def _changed_spans(self) -> dict[str, DataFrame]:
        """Per dimension that this run has staged: the keys whose versions change, and the days that hold the changes."""
        out = {}
        for name, dim in DIMENSIONS.items():
            staged, before = (self._staged or {}).get(("star", name)), self.table("star", name, "is_current", self.spark.range(0))
            if staged is not None and before.exists():
                out[name] = history.changed_spans(self.dimension(name).read(), staged.read(), dim)
        return out

    def _touched_orders(self, run_date: date) -> DataFrame:
        """Orders with a head or line in the run's feed, with a waiting line whose key has changed versions, and, after a late
        feed, with a line dated in the changed days of one of its keys."""
        day = [run_date.isoformat()]
        touched = [self.log("orders").read(day).select("order_id"), self.log("order_items").read(day).select("order_id")]
        spans, queue = self._changed_spans(), self.queue().read()
        late, orders, lines = self.late(run_date), self._rows("current", "orders", "bucket"), self._rows("current", "order_items", "bucket")
        for name, span in spans.items():
            key = DIMENSIONS[name].key
            touched.append(queue.join(span.select(key), key, "left_semi").select("order_id"))
            if late:
                dated = orders if key in orders.columns else lines.join(orders.select("order_id", "order_date"), "order_id")
                inside = (F.col("order_date") >= F.col("_from")) & (F.col("order_date") < F.col("_to"))
                touched.append(dated.join(span, key).where(inside).select("order_id"))
        return reduce(DataFrame.unionByName, touched).distinct()

    def _desired(self, run_date: date) -> tuple[DataFrame, DataFrame]:
        """Fact rows of all touched orders, and the natural keys of their lines; each step is written, as several read it."""
        touched = self._held(self._touched_orders(run_date))
        lines, orders = together(self.spark, *[
            lambda name=name: self._held(self._rows("current", name, "bucket").join(touched, "order_id", "left_semi"))
            for name in ("order_items", "orders")])
        dims = {k: d for k, d in self.dimensions().items() if k != "date_key"}
        natural = lines.select(*GRAIN, "product_id").join(orders.select("order_id", "customer_id", "store_id"), "order_id")
        return self._held(star.build_fact(lines, orders, dims)), natural

    def refresh_fact(self, run_date: date, set_aside: bool = False) -> None:
        """New lines are added with the keys of their order date; known lines only take the status, and after a late feed
        also their keys.

        A line dated before its key's first version stops the run, or with ``set_aside`` waits in ``queue`` and the rest is loaded.
        A waiting line is looked up again when the versions of one of its keys change, and leaves the queue once all resolve.
        """
        try:
            self._refresh_fact(run_date, set_aside)
        finally:
            self._clear()

    def _refresh_fact(self, run_date: date, set_aside: bool) -> None:
        desired, natural = self._desired(run_date)
        waiting = self.queue()
        missing = star.unresolved(desired)
        if not set_aside:
            star.require_resolved(desired.join(waiting.read().select(*GRAIN), GRAIN, "left_anti"))
        tried = desired.select(*GRAIN, "order_date").join(natural, GRAIN) \
            .join(missing.select(*GRAIN, F.lit(True).alias("_missing")), GRAIN, "left").withColumn("run_date", F.lit(run_date))
        tried = self._bucketed(tried, ("order_id",)).select(*waiting.schema.names, "_missing")
        update = [c for c in desired.columns if c not in GRAIN] if self.late(run_date) else ["status"]
        loaded = star.resolved(desired)
        if self.fact_slice != "order_date":
            loaded = loaded.withColumn(self.fact_slice, F.trunc("order_date", "MONTH"))
        together(
            self.spark,
            lambda: self._put("star", "unresolved", waiting.stage_merge(
                tried, GRAIN, lambda kept, new: kept.join(new.select(*GRAIN), GRAIN, "left_anti").unionByName(
                    new.where("_missing").drop("_missing")), slice_of_key=True)),
            lambda: self._put("star", "fact", self.table("star", "fact", self.fact_slice, loaded).stage_merge(
                loaded, GRAIN, lambda kept, new: keyed.upsert_columns(kept, new, GRAIN, update, check=False),
                order_by=["customer_key"])))

    def checks(self) -> DataFrame:
        """Star checks on the tables as they are, or as the run has staged them; the order totals must reconcile."""
        fact, dims = self._rows("star", "fact", self.fact_slice), self.dimensions()
        sets = [quality.fact_checks(fact, self._rows("current", "orders", "bucket"), [dim.surrogate for dim in DIMENSIONS.values()])]
        for name, dim in DIMENSIONS.items():
            sets += quality.dimension_checks(f"dim_{name}", dims[dim.surrogate], dim.key, dim.surrogate)
        return quality.run(sets)

    def report(self, columns: list[str] | None = None) -> DataFrame:
        return star.report_view(self.fact().read(), self.dimensions(), columns)

    def register_views(self) -> DataFrame:
        """Temporary views of the star tables and of the report, for ``spark.sql``; the report."""
        dims, fact = self.dimensions(), self.fact().read()
        report = star.report_view(fact, dims)
        views = {f"dim_{name.removesuffix('_key')}": df for name, df in dims.items()}
        views |= {"fact_sales": fact, "sales_report": report}
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        return report

    def run(self, folder: str, run_date: date, set_aside: bool = False) -> DataFrame:
        """Feed to report for one run date; what the run would make of the tables is checked before any of them changes."""
        try:
            return together(self.spark, lambda: self._run(folder, run_date, set_aside))[0]
        finally:
            gc.collect()  # frames hang in cycles with the JVM's objects; without this the driver keeps the plans of earlier days

    def _run(self, folder: str, run_date: date, set_aside: bool) -> DataFrame:
        self.land(folder, run_date)
        self._staged = {}
        passed = False
        try:
            self._late = run_date, self.late(run_date)
            self.refresh_current(run_date)
            self.refresh_dimensions(run_date)
            self.refresh_fact(run_date, set_aside)
            quality.require_passed(self.checks())
            passed = True
        finally:
            self._late = None
            self._settle(passed)
        return self.register_views()
