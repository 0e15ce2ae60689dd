"""One business day of the card warehouse: stage, integrate, report, with checks after each step."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import cards, quality
from millrace.sources import feeds
from millrace.sources.slices import SliceTable


class RepeatedIdError(ValueError):
    """A transaction id of the day already exists on another date."""


class CardWarehouse:
    """Six tables under one folder, each sliced by business date, and the history of checks.

    A failed check is a row in that history and does not stop the load.  A day can be loaded
    again at any time and leaves the same state.
    """

    def __init__(self, spark: SparkSession, root: str, card: DataFrame, merchant: DataFrame, mcc: DataFrame,
                 owner: str = "cards"):
        self.spark, self.root, self.owner = spark, root.rstrip("/"), owner
        self.card, self.merchant, self.mcc = card, merchant, mcc

    def _table(self, name: str, schema, slice_by: str) -> SliceTable:
        return SliceTable(self.spark, f"{self.root}/{name}", schema, slice_by)

    def _load(self, name: str, df: DataFrame, day: date, slice_by: str = "txn_date",
              require: Callable[[DataFrame], None] | None = None) -> tuple[DataFrame, DataFrame]:
        """Replace the day's slice, if ``require`` lets its rows pass; returns (that slice, the whole table) as stored."""
        if "loaded_at" not in df.columns:
            df = df.withColumn("loaded_at", F.current_timestamp())
        table = self._table(name, df.schema, slice_by)
        table.replace_slices(df, [day.isoformat()], cluster=False, require=require)
        return table.read([day.isoformat()]), table.read()

    def _record(self, sets: list[quality.CheckSet], layer: str, run_at: datetime) -> DataFrame:
        events = quality.run_events(quality.run_apart(sets), self.owner, layer, run_at).withColumn(
            "run_date", F.to_date("run_at"))
        table = self._table("check_history", events.schema, "run_date")
        table.append(events, batch=f"{layer}@{run_at.isoformat()}")
        return events

    def load_day(self, inbound: str, day: date, run_at: datetime, ids_unique_across_dates: bool = True) -> DataFrame:
        """Load one day's two feeds through to the reports; returns the day's check events."""
        paths = {name: feeds.daily_feed_path(inbound, name, day) for name in ("card_auth", "card_post")}
        feeds.require_feeds(self.spark, list(paths.values()))
        by = "load_business_date"

        def check(layer: str, whole: dict[str, DataFrame], custom: list[quality.CheckSet]) -> DataFrame:
            sets = quality.card_mandatory(whole, run_at, run_at.date(), day) + quality.for_day(custom, day)
            return self._record(sets, layer, run_at)

        auth, all_auth = self._load(
            "card_auth", feeds.read_stage(self.spark, paths["card_auth"], cards.AUTH_COLUMNS, day), day, by)
        post, all_post = self._load(
            "card_post", feeds.read_stage(self.spark, paths["card_post"], cards.POST_COLUMNS, day), day, by)
        recorded = [check("stage", {"card_auth": all_auth, "card_post": all_post}, quality.stage_checks(auth, post))]

        txn = cards.integrate(auth, post, self.card, self.merchant, self.mcc)
        new_ids = (lambda rows: self._require_new_ids(rows, day)) if ids_unique_across_dates else None
        txn, all_txn = self._load("card_txn", txn, day, require=new_ids)
        decline, all_decline = self._load("card_txn_decline", cards.declines(txn), day)
        recorded.append(check("integration", {"card_txn": all_txn, "card_txn_decline": all_decline},
                              quality.integration_checks(txn, decline)))

        summary, all_summary = self._load("daily_card_summary", cards.daily_summary(txn), day)
        top, all_top = self._load("card_top_merchants", cards.top_merchants(txn), day)
        recorded.append(check("report", {"daily_card_summary": all_summary, "card_top_merchants": all_top},
                              quality.report_checks(summary, top)))
        return reduce(DataFrame.unionByName, recorded)

    def _require_new_ids(self, txn: DataFrame, day: date) -> None:
        table = self._table("card_txn", txn.schema, "txn_date")
        others = table.slices() - {day.isoformat()}
        if not others:
            return
        clash = table.read(others).select("txn_id", "txn_date").join(txn.select("txn_id"), "txn_id", "left_semi").first()
        if clash is not None:
            raise RepeatedIdError(f"{clash['txn_id']} of {day} already exists on {clash['txn_date']}")
