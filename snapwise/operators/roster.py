"""Latest-state and overview tables over the member snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapwise.functions.exprs import (BASE_VOCATIONS, base_vocation, exact_avg,
                                      js_round_percent, level_band)
from snapwise.operators.activity import last_level_change, last_online_interval
from snapwise.operators.pairs import T

LATEST_MEMBER_COLUMNS = ["guild_name", "world", "character_name", "vocation", "guild_rank",
                         "current_level", "latest_snapshot_time"]


def latest_snapshot_times(roster: DataFrame) -> DataFrame:
    """Newest snapshot time per guild (one row per guild)."""
    return (roster.filter(F.col("world").isNotNull())
                  .groupBy("guild_name", "world").agg(F.max(T).alias("latest_snapshot_time")))


def latest_roster_by_guild(roster: DataFrame) -> DataFrame:
    """C17 v2: members of each guild's newest snapshot."""
    ls = latest_snapshot_times(roster)
    r = roster.join(ls, (roster.guild_name == ls.guild_name) & (roster.world == ls.world)
                    & (roster[T] == ls.latest_snapshot_time), "left_semi")
    return r.select("guild_name", "world", "character_name", "vocation", "guild_rank",
                    F.col("level").alias("current_level"), F.col(T).alias("latest_snapshot_time"))


def latest_roster_global(roster: DataFrame) -> DataFrame:
    """C17 v1: members of the newest snapshot over all guilds (scalar max)."""
    r = roster.filter(F.col(T) == roster.agg(F.max(T)).scalar())
    return r.select("guild_name", "world", "character_name", "guild_rank", "vocation",
                    "level", "status", F.col("joined").alias("joined_date"), T)


def latest_members(roster: DataFrame, intervals: DataFrame, level_changes: DataFrame) -> DataFrame:
    """Latest roster per guild with the last-connected estimate:
    greatest(last online interval start, last level change), null if neither."""
    base = latest_roster_by_guild(roster)
    key = ["guild_name", "world", "character_name"]
    lo = last_online_interval(intervals)
    lc = last_level_change(level_changes)
    out = base.join(lo, key, "left").join(lc, key, "left")
    return out.select(*LATEST_MEMBER_COLUMNS,
                      F.greatest("last_online_at", "last_level_change_at").alias("last_connected_at"))


def overview_by_snapshot(roster: DataFrame, scale: int = 1) -> DataFrame:
    """Per guild and snapshot: members, max, min and average level."""
    agg = roster.groupBy("guild_name", "world", F.col(T).alias("snapshot_time")).agg(
        F.count(F.lit(1)).alias("number_of_members"),
        F.max("level").alias("max_level"),
        F.min("level").alias("min_level"),
        F.sum("level").alias("_s"),
        F.count("level").alias("_c"))
    return agg.select("guild_name", "world", "snapshot_time", "number_of_members",
                      "max_level", "min_level",
                      exact_avg("_s", "_c", scale).alias("average_level"))


def overview_latest(roster: DataFrame) -> DataFrame:
    """Newest overview row of each guild."""
    ov = overview_by_snapshot(roster)
    cols = [c for c in ov.columns if c not in ("guild_name", "world")]
    latest = ov.groupBy("guild_name", "world").agg(
        F.max_by(F.struct(*cols), F.col("snapshot_time")).alias("r"))
    return latest.select("guild_name", "world", "r.*")


def date_bounds(roster: DataFrame) -> DataFrame:
    """D02 per guild."""
    return roster.groupBy("guild_name", "world").agg(
        F.min(T).alias("min_snapshot_time"), F.max(T).alias("max_snapshot_time"))


def date_bounds_global(roster: DataFrame) -> DataFrame:
    """D02 older, global."""
    return roster.agg(F.min(T).alias("min_snapshot_time"), F.max(T).alias("max_snapshot_time"))


def vocation_summary(current: DataFrame) -> DataFrame:
    """Per vocation of the current roster: count, avg (2 dp), min, max."""
    agg = current.groupBy("guild_name", "world", "vocation").agg(
        F.count(F.lit(1)).alias("character_count"),
        F.sum("level").alias("_s"), F.count("level").alias("_c"),
        F.min("level").alias("min_level"), F.max("level").alias("max_level"))
    return agg.select("guild_name", "world", "vocation", "character_count",
                      exact_avg("_s", "_c", 2).alias("avg_level"), "min_level", "max_level")


def level_bands(current: DataFrame) -> DataFrame:
    """Level histogram in fixed bands (null level lands in the last band)."""
    return (current.groupBy("guild_name", "world", level_band("level").alias("level_band"))
                   .agg(F.count(F.lit(1)).alias("character_count")))


def vocation_rows(members: DataFrame, min_level: int | None = None,
                  max_level: int | None = None) -> DataFrame:
    """B07 + B18: base-vocation rows of the latest members, optional level bounds
    (0 or None = unbounded); Unknown is dropped."""
    rows = members.select("guild_name", "world", "character_name", "vocation",
                          base_vocation("vocation").alias("base_vocation"),
                          F.coalesce(F.col("current_level"), F.lit(0)).cast("int").alias("current_level"))
    rows = rows.filter(F.col("base_vocation").isin(BASE_VOCATIONS))
    if min_level:
        rows = rows.filter(F.col("current_level") >= F.lit(int(min_level)))
    if max_level:
        rows = rows.filter(F.col("current_level") <= F.lit(int(max_level)))
    return rows


def vocation_pie(rows: DataFrame) -> DataFrame:
    """Count per base vocation with zero fill and rounded percent."""
    guilds = rows.select("guild_name", "world").distinct()
    dim = guilds.select("guild_name", "world",
                        F.explode(F.array(*[F.lit(v) for v in BASE_VOCATIONS])).alias("base_vocation"))
    counts = rows.groupBy("guild_name", "world", "base_vocation").agg(
        F.count(F.lit(1)).alias("n"))
    j = dim.join(counts, ["guild_name", "world", "base_vocation"], "left")
    n = F.coalesce(F.col("n"), F.lit(0)).cast("bigint")
    total = F.sum(n).over(Window.partitionBy("guild_name", "world"))
    return j.select("guild_name", "world", "base_vocation",
                    n.alias("character_count"),
                    js_round_percent(n, total).alias("percent"))
