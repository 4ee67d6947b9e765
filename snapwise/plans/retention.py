"""Retention (K14, K15) and maintenance migrations.

The cutoff is a scalar subquery (one aggregate, computed once), so the
whole job stays distributed: nothing is collected to the driver and no
table is joined to it. On stored, date-partitioned tables the keep-filter prunes
whole partitions; the job layer writes the kept rows as a new version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapwise.functions.exprs import RETENTION_DAYS, RETENTION_LEGACY_MONTHS

# Fixed step order of the 7-day retention report: (step name, table key,
# time column, compare by calendar date).
RETENTION_STEPS = [
    ("character_online_minutes_by_day_cache", "days", "activity_date", True),
    ("character_online_intervals_cache", "intervals", "latest_snapshot_time", False),
    ("character_level_changes_with_online_cache", "level_changes", "latest_snapshot_time", False),
    ("guild_joins_api_cache", "joins", "latest_snapshot_time", False),
    ("guild_leaves_api_cache", "leaves", "latest_snapshot_time", False),
    ("rank_changes_api_cache", "rank_changes", "latest_snapshot_time", False),
    ("snapshot_pairs_api_cache", "pairs", "latest_snapshot_time", False),
    ("guild_member_snapshot", "members", "extracted_at_utc", False),
    ("raw_guild_snapshot", "raw", "extracted_at_utc", False),
]
NO_SOURCE_STEP = "no_raw_snapshots_found"
FINAL_STEP = "analyze_completed"


def retention_cutoff(raw: DataFrame, days: int = RETENTION_DAYS) -> Column:
    """Newest raw time - ``days`` as a scalar subquery (null when empty)."""
    return F.timestamp_add("DAY", F.lit(-int(days)), raw.agg(F.max("extracted_at_utc")).scalar())


def _old(col: str, by_date: bool, cutoff: Column) -> Column:
    if by_date:
        return F.col(col) < F.to_date(cutoff)
    return F.col(col) < cutoff


def apply_retention(tables: dict[str, DataFrame], days: int = RETENTION_DAYS, cutoff: Column | None = None
                    ) -> tuple[dict[str, DataFrame], DataFrame]:
    """Drop rows older than the cutoff from every result table, then
    members, then raw (child before parent); report rows deleted per step.

    The day table compares its date with the cutoff's date, so the cutoff
    day stays whole while some of its intervals go (N22). An empty raw table
    yields the single no-op report row. A caller that knows the ``cutoff`` may
    pass tables that were cut to the older days."""
    cutoff = retention_cutoff(tables["raw"], days) if cutoff is None else cutoff
    spark = tables["raw"].sparkSession
    kept: dict[str, DataFrame] = {}
    parts = []
    for order, (step, key, col, by_date) in enumerate(RETENTION_STEPS, start=1):
        t = tables[key]
        kept[key] = t.filter(~F.coalesce(_old(col, by_date, cutoff), F.lit(False)))
        parts.append(t.filter(_old(col, by_date, cutoff)).agg(F.count(F.lit(1)).alias("deleted_rows"))
                      .select(F.lit(step).alias("step_name"), "deleted_rows", F.lit(order).alias("step_order")))
    parts.append(spark.range(1).select(F.lit(FINAL_STEP).alias("step_name"),
                                       F.lit(0).cast("bigint").alias("deleted_rows"),
                                       F.lit(len(RETENTION_STEPS) + 1).alias("step_order")))
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    report = report.filter(cutoff.isNotNull())
    noop = spark.range(1).select(
        F.lit(NO_SOURCE_STEP).alias("step_name"), F.lit(0).cast("bigint").alias("deleted_rows"),
        F.lit(0).alias("step_order")).filter(cutoff.isNull())
    return kept, report.unionByName(noop)


def cascade_retention(raw: DataFrame, members: DataFrame, as_of: Column,
                      months: int = RETENTION_LEGACY_MONTHS) -> tuple[DataFrame, DataFrame]:
    """Raw documents older than ``as_of - months`` go; members follow
    their document (foreign key with cascade) by snapshot id."""
    cut = F.timestamp_add("MONTH", F.lit(-int(months)), as_of)
    kept_raw = raw.filter(F.col("extracted_at_utc") >= cut)
    kept_members = members.join(kept_raw.select("snapshot_id"), "snapshot_id", "left_semi")
    return kept_raw, kept_members


def prune_zero(intervals: DataFrame, column: str = "estimated_online_minutes") -> DataFrame:
    """Drop zero-minute rows (sparse storage)."""
    return intervals.filter(F.coalesce(F.col(column), F.lit(0)) != 0)


def backfill_observed_date(history: DataFrame) -> DataFrame:
    """Fill a missing observation date from the observation time."""
    return history.withColumn("observed_date",
                              F.coalesce(F.col("observed_date"), F.to_date("observed_at_utc")))
