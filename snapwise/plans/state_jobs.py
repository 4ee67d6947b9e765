"""Stored jobs of the refresh queue, discovery and the market history.

The queue (one row per guild) and the worlds are small states: a run writes the
next state as a partition of its own, which appears as a whole or not at all, and
drops the ones before the last two. The market history is partitioned by day: a
load rewrites the days it brings, and loading the same data again gives the same
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from snapwise.operators import market as MK
from snapwise.operators import refresh_queue as RQ
from snapwise.plans.tables import BATCH, Tables


class QueueJobs:
    """K10, K11, K13 over stored tables; every step is one state transition."""

    def __init__(self, spark: SparkSession, root: str):
        self.store = Tables(spark, root)

    def state(self, name: str = "queue") -> DataFrame | None:
        """The newest state of a table, None before the first."""
        batches = self.store.batches(name)
        if not batches:
            return None
        folder = f"{self.store.folder(name)}/{BATCH}={max(batches)}"
        return self.store.spark.read.parquet(folder)

    def _next(self, df: DataFrame, name: str = "queue") -> DataFrame:
        batches = sorted(self.store.batches(name))
        self.store.put(name, df, (batches[-1] if batches else 0) + 1)
        for old in batches[:-1]:
            self.store.drop(name, old)
        return self.state(name)

    def load(self, queue: DataFrame) -> DataFrame:
        return self._next(queue.select(*RQ.QUEUE_COLUMNS))

    def discover(self, names: DataFrame, as_of: Column) -> DataFrame:
        """Found guilds join the queue."""
        return self._next(RQ.guild_upsert(self.state(), names, as_of).select(*RQ.QUEUE_COLUMNS))

    def discover_worlds(self, stored: DataFrame, names: DataFrame, as_of: Column) -> DataFrame:
        """K10, from the stored worlds once there are any."""
        known = self.state("worlds")
        return self._next(RQ.world_upsert(stored if known is None else known, names, as_of), "worlds")

    def claim(self, as_of: Column, batch_size: int, world: str | None = None) -> DataFrame:
        """The claimed guilds, marked as running."""
        before = self.state()
        claimed = self.store.work(RQ.due_entities(before, as_of, batch_size, world))
        self._next(RQ.claim(before, claimed, as_of))
        return claimed

    def outcomes(self, outcomes: DataFrame, as_of: Column) -> DataFrame:
        return self._next(RQ.apply_outcomes(self.state(), outcomes, as_of))

    def release_stale(self, as_of: Column) -> DataFrame:
        return self._next(RQ.release_stale(self.state(), as_of))


class MarketJobs:
    """K08 over a stored table (K19 reads it through ``operators.market``)."""

    def __init__(self, spark: SparkSession, root: str):
        self.store = Tables(spark, root)

    def history(self, like: DataFrame) -> DataFrame:
        if not self.store.exists("history"):
            return like.limit(0)
        return self.store.spark.read.schema(like.schema).parquet(self.store.folder("history")).select(*like.columns)

    def load_items(self, items: DataFrame) -> None:
        """The next state of the catalogue, as a whole partition."""
        batches = sorted(self.store.batches("items"))
        self.store.put("items", items, (batches[-1] if batches else 0) + 1)
        for old in batches[:-1]:
            self.store.drop("items", old)

    def load(self, valid: DataFrame) -> DataFrame:
        """One load of valid observations: merged by day, upserted keeping valid
        sides. Only the loaded days are read and written; returns their rows."""
        incoming = self.store.work(MK.daily_merge(valid))
        days = incoming.select("observed_date").distinct()
        stored = self.history(incoming).join(days, "observed_date", "left_semi")
        rows = self.store.work(MK.upsert_keep_valid(stored.select(*incoming.columns), incoming))
        if not rows.isEmpty():
            self.store.replace("history", rows, ("observed_date",))
        return rows
