"""Activity estimates: online intervals, daily and all-time minutes.

All rules come out of the member timeline (``changes.timeline``), i.e. the
same single window pass that produces the change events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapwise.functions.exprs import (DEFAULT_CAP_MINUTES, capped_minutes, idiv,
                                      interval_minutes, is_online, micros_between)
from snapwise.operators.changes import MEMBER_KEY, timeline
from snapwise.operators.pairs import T

INTERVAL_COLUMNS = ["guild_name", "world", "character_name", "previous_snapshot_time",
                    "latest_snapshot_time", "previous_status", "latest_status",
                    "interval_minutes", "estimated_online_minutes"]


def intervals_from(tl: DataFrame, cap: int = DEFAULT_CAP_MINUTES) -> DataFrame:
    """C13 sparse rule: one row per member online at the start of a pair.

    The end status is the member's status in the pair's latest snapshot, null
    when it is absent there.
    """
    minutes = interval_minutes(T, "next_snapshot_time")
    return (tl.filter(F.col("next_snapshot_time").isNotNull() & is_online("status"))
              .select("guild_name", "world", "character_name",
                      F.col(T).alias("previous_snapshot_time"),
                      F.col("next_snapshot_time").alias("latest_snapshot_time"),
                      F.col("status").alias("previous_status"),
                      F.when(F.col("in_next"), F.col("next_status")).alias("latest_status"),
                      minutes.alias("interval_minutes"),
                      capped_minutes(minutes, cap).alias("estimated_online_minutes")))


def online_intervals(roster: DataFrame, cap: int = DEFAULT_CAP_MINUTES) -> DataFrame:
    return intervals_from(timeline(roster), cap)


def dense_intervals_from(tl: DataFrame, cap: int = DEFAULT_CAP_MINUTES) -> DataFrame:
    """C12 dense rule: every member of either snapshot of a pair (full outer
    of previous and latest roster), 0 minutes unless online at the start."""
    start_side = tl.filter(F.col("next_snapshot_time").isNotNull()).select(
        "guild_name", "world", "character_name",
        F.col(T).alias("previous_snapshot_time"),
        F.col("next_snapshot_time").alias("latest_snapshot_time"),
        F.col("status").alias("previous_status"),
        F.when(F.col("in_next"), F.col("next_status")).alias("latest_status"))
    joined_side = tl.filter(F.col("previous_snapshot_time").isNotNull() & ~F.col("in_previous")).select(
        "guild_name", "world", "character_name",
        "previous_snapshot_time",
        F.col(T).alias("latest_snapshot_time"),
        F.lit(None).cast("string").alias("previous_status"),
        F.col("status").alias("latest_status"))
    rows = start_side.unionByName(joined_side)
    minutes = interval_minutes("previous_snapshot_time", "latest_snapshot_time")
    return rows.select(
        "guild_name", "world", "character_name", "previous_snapshot_time",
        "latest_snapshot_time", "previous_status", "latest_status",
        minutes.alias("interval_minutes"),
        F.when(is_online("previous_status"), capped_minutes(minutes, cap))
         .otherwise(F.lit(0)).cast("int").alias("estimated_online_minutes"))


def online_intervals_dense(roster: DataFrame, cap: int = DEFAULT_CAP_MINUTES) -> DataFrame:
    return dense_intervals_from(timeline(roster), cap)


def minutes_by_day(intervals: DataFrame, keep_zero: bool = False) -> DataFrame:
    """Minutes and interval rows per member and calendar date of the
    interval end (nothing is split at midnight). Only days with minutes > 0
    are stored unless ``keep_zero``."""
    out = (intervals.groupBy("guild_name", "world", "character_name",
                             F.to_date("latest_snapshot_time").alias("activity_date"))
                    .agg(F.coalesce(F.sum("estimated_online_minutes"), F.lit(0)).cast("int")
                          .alias("estimated_online_minutes"),
                         F.count(F.lit(1)).cast("int").alias("online_interval_rows")))
    return out if keep_zero else out.filter(F.col("estimated_online_minutes") > 0)


def minutes_total(intervals: DataFrame, keep_zero: bool = False) -> DataFrame:
    """All-time minutes per member from interval rows."""
    out = (intervals.groupBy("guild_name", "world", "character_name")
                    .agg(F.coalesce(F.sum("estimated_online_minutes"), F.lit(0)).cast("int")
                          .alias("estimated_online_minutes")))
    return out if keep_zero else out.filter(F.col("estimated_online_minutes") > 0)


def online_minutes_fractional(roster: DataFrame, cap: int = DEFAULT_CAP_MINUTES) -> DataFrame:
    """D05 older rule: LEAD over the member's own appearances, each online
    row credited min(next - t, cap) exactly, summed, rounded once."""
    w = Window.partitionBy(*MEMBER_KEY).orderBy(T)
    r = roster.filter(F.col("world").isNotNull()).withColumn("next_t", F.lead(T).over(w))
    cap_micros = int(cap) * 60_000_000
    credit = F.least(micros_between(T, "next_t"), F.lit(cap_micros))
    online = r.filter(is_online("status") & F.col("next_t").isNotNull() & (F.col("next_t") > F.col(T)))
    agg = online.groupBy("guild_name", "world", "character_name").agg(F.sum(credit).alias("_us"))
    return agg.select("guild_name", "world", "character_name",
                      idiv(F.col("_us") + F.lit(30_000_000), 60_000_000).cast("int")
                      .alias("estimated_online_minutes"))


def last_online_snapshot(roster: DataFrame) -> DataFrame:
    """D08 older: latest snapshot time at which the member was online."""
    return (roster.filter(is_online("status"))
                  .groupBy("guild_name", "world", "character_name")
                  .agg(F.max(T).alias("last_online_at")))


def last_online_interval(intervals: DataFrame) -> DataFrame:
    """D08 current: latest interval *start* with an online start status."""
    return (intervals.filter(is_online("previous_status"))
                     .groupBy("guild_name", "world", "character_name")
                     .agg(F.max("previous_snapshot_time").alias("last_online_at")))


def last_level_change(level_changes: DataFrame) -> DataFrame:
    """Latest level-change time per member."""
    return (level_changes.groupBy("guild_name", "world", "character_name")
                         .agg(F.max("latest_snapshot_time").alias("last_level_change_at")))
