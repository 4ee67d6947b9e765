"""Validation and reconciliation queries (expected-zero checks, counts).

Each check is a whole-table DataFrame over every guild at once; the
reference's versions are per-guild SQL scripts read by a person.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapwise.functions.exprs import null_safe_differs
from snapwise.operators.pairs import T
from snapwise.operators.panels import one_row_join

GUILD = ["world", "guild_name"]


def freshness_check(roster: DataFrame, latest_cache: DataFrame) -> DataFrame:
    """Newest source snapshot vs newest cached roster time per guild
    (full outer), with a null-safe equality flag."""
    m = roster.groupBy(*GUILD).agg(F.max(T).alias("latest_member_snapshot_time"))
    c = latest_cache.groupBy(*GUILD).agg(F.max("latest_snapshot_time").alias("latest_cache_snapshot_time"))
    j = m.join(c, GUILD, "full_outer")
    return j.select(*GUILD, "latest_member_snapshot_time", "latest_cache_snapshot_time",
                    F.col("latest_member_snapshot_time").eqNullSafe(F.col("latest_cache_snapshot_time"))
                    .alias("is_cache_current"))


def roster_diff(base_latest: DataFrame, cache: DataFrame) -> DataFrame:
    """Members whose level, rank or time differ (null-safely) between
    the latest source roster and the cached roster; full outer by member."""
    key = ["world", "guild_name", "character_name"]
    b = base_latest.select(*key, F.col("current_level").alias("base_current_level"),
                           F.col("guild_rank").alias("base_guild_rank"),
                           F.col("latest_snapshot_time").alias("base_latest_snapshot_time"))
    c = cache.select(*key, F.col("current_level").alias("cache_current_level"),
                     F.col("guild_rank").alias("cache_guild_rank"),
                     F.col("latest_snapshot_time").alias("cache_latest_snapshot_time"))
    j = b.join(c, key, "full_outer")
    differs = (null_safe_differs("base_current_level", "cache_current_level")
               | null_safe_differs("base_guild_rank", "cache_guild_rank")
               | null_safe_differs("base_latest_snapshot_time", "cache_latest_snapshot_time"))
    return j.filter(differs)


def snapshot_freshness(roster: DataFrame, n: int = 50) -> DataFrame:
    """Per guild: distinct snapshots, member rows, newest time; newest n."""
    agg = roster.groupBy(*GUILD).agg(
        F.countDistinct(T).alias("snapshot_count"),
        F.count(F.lit(1)).alias("member_snapshot_rows"),
        F.max(T).alias("latest_member_snapshot_time"))
    order = [F.col("latest_member_snapshot_time").desc(), F.col("world"), F.col("guild_name")]
    top = agg.orderBy(*order).limit(n)
    return top.withColumn("freshness_rank", F.row_number().over(Window.orderBy(*order)))


def dup_check(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys present more than once (expected: no rows)."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("duplicate_count"))
              .filter(F.col("duplicate_count") > 1))


def snapshot_inventory(roster: DataFrame) -> DataFrame:
    """Member rows per snapshot time."""
    return roster.groupBy(F.col(T).alias("extracted_at_utc")).agg(
        F.count(F.lit(1)).alias("member_rows"))


def snapshot_count(roster: DataFrame) -> DataFrame:
    """Number of distinct snapshot times."""
    return roster.agg(F.countDistinct(T).alias("snapshot_count"))


def latest_snapshot_rows(roster: DataFrame) -> DataFrame:
    """Rows in the newest snapshot (scalar max, then a filtered count)."""
    mx = roster.agg(F.max(T)).scalar()
    rows = roster.filter(F.col(T) == mx).agg(F.count(F.lit(1)).alias("member_rows"))
    return one_row_join([roster.agg(F.max(T).alias("latest_snapshot_time")), rows])


def table_ranges(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Min / max of a time column and row count of each table."""
    out = None
    for name, (df, col) in tables.items():
        part = df.agg(F.min(col).alias("min_time"), F.max(col).alias("max_time"),
                      F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "min_time", "max_time", "row_count")
        out = part if out is None else out.unionByName(part)
    return out
