"""Dashboard reads re-expressed as whole-table queries.

The reference's browser does part of the relational work (group by member,
sum minutes, merge, filter, sort). Here each panel is one DataFrame query,
computed for *all* guilds at once; orderings are exposed as a rank column
(row_number per guild) so they can be checked order-insensitively.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapwise.functions.exprs import RETENTION_DAYS
from snapwise.operators.ordering import row_number_by

GUILD = ["guild_name", "world"]
MEMBER = ["guild_name", "world", "character_name"]


# ---------------------------------------------------------------------------
# Filters (B03-B09)
# ---------------------------------------------------------------------------

def range_bounds(start_date: str, end_date: str) -> tuple[Column, Column]:
    """Inclusive bounds 00:00:00.000 .. 23:59:59.999 (the last 999 us of the
    end day fall outside, as in the reference)."""
    start = F.lit(f"{start_date} 00:00:00").cast("timestamp_ntz")
    end = F.lit(f"{end_date} 23:59:59.999").cast("timestamp_ntz")
    return start, end


def filter_ts_range(df: DataFrame, start_date: str | None, end_date: str | None,
                    column: str = "latest_snapshot_time") -> DataFrame:
    """No range (either side missing) means no filter."""
    if not start_date or not end_date:
        return df
    start, end = range_bounds(start_date, end_date)
    return df.filter(F.col(column).between(start, end))


def filter_date_range(df: DataFrame, start_date: str | None, end_date: str | None,
                      column: str = "activity_date") -> DataFrame:
    """Inclusive date range on a date column."""
    if not start_date or not end_date:
        return df
    return df.filter(F.col(column).between(F.lit(start_date).cast("date"),
                                           F.lit(end_date).cast("date")))


def scope_filter(df: DataFrame, world: str, guild_name: str) -> DataFrame:
    """Equality scope on world and guild."""
    return df.filter((F.col("world") == F.lit(world)) & (F.col("guild_name") == F.lit(guild_name)))


def name_contains(df: DataFrame, search: str | None, column: str = "character_name") -> DataFrame:
    """Trimmed, case-insensitive literal substring; blank means all."""
    s = (search or "").strip().lower()
    if not s:
        return df
    return df.filter(F.instr(F.lower(F.coalesce(F.col(column), F.lit(""))), F.lit(s)) > 0)


def vocation_in(rows: DataFrame, selected: list[str]) -> DataFrame:
    """Multi-select on base vocation; an empty selection keeps nothing."""
    if not selected:
        return rows.limit(0)
    return rows.filter(F.col("base_vocation").isin(selected))


def default_range(bounds: DataFrame, as_of: Column | None = None,
                  days: int = RETENTION_DAYS) -> DataFrame:
    """Default window of ``days`` ending at ``as_of`` (default: the
    newest snapshot time of the data), clamped to each guild's first date."""
    if as_of is None:
        # the data's newest time as a scalar subquery (computed once)
        as_of = bounds.agg(F.max("max_snapshot_time")).scalar()
    b = bounds
    end = F.to_date(as_of)
    start = F.greatest(F.date_sub(end, days), F.to_date("min_snapshot_time"))
    return b.select(*GUILD, start.alias("start_date"), end.alias("end_date"))


# ---------------------------------------------------------------------------
# Level panel (C24 + D10 + D11)
# ---------------------------------------------------------------------------

def level_panel(level_changes: DataFrame, daily_minutes: DataFrame,
                start_date: str | None, end_date: str | None) -> DataFrame:
    """Per member over a date range: summed gain, first previous level,
    last level/rank/vocation, first and last time, plus the member's daily
    minutes in the same date range (0 if none)."""
    lc = filter_ts_range(level_changes, start_date, end_date)
    agg = lc.groupBy(*MEMBER).agg(
        F.sum(F.coalesce(F.col("level_gain"), F.lit(0))).cast("bigint").alias("level_gain"),
        F.min_by("previous_level", "previous_snapshot_time").alias("previous_level"),
        F.max_by(F.struct("current_level", "guild_rank", "vocation"), "latest_snapshot_time").alias("_last"),
        F.min("previous_snapshot_time").alias("first_snapshot_time"),
        F.max("latest_snapshot_time").alias("latest_snapshot_time"),
    )
    dm = filter_date_range(daily_minutes, start_date, end_date)
    minutes = dm.groupBy(*MEMBER).agg(
        F.sum(F.coalesce(F.col("estimated_online_minutes"), F.lit(0))).cast("bigint").alias("_m"))
    out = agg.join(minutes, MEMBER, "left")
    return out.select(*MEMBER, F.col("_last.vocation").alias("vocation"),
                      F.col("_last.guild_rank").alias("guild_rank"),
                      "previous_level", F.col("_last.current_level").alias("current_level"),
                      "level_gain",
                      F.coalesce(F.col("_m"), F.lit(0)).cast("bigint").alias("estimated_online_minutes"),
                      "first_snapshot_time", "latest_snapshot_time")


# ---------------------------------------------------------------------------
# Orders (S03, S04, S06)
# ---------------------------------------------------------------------------

def ranked(df: DataFrame, order: list[Column], rank_col: str = "panel_rank",
           by: list[str] | None = None) -> DataFrame:
    """Attach the display position per guild (row_number over the panel
    order), skew-safe: a guild with most of the rows is still split over
    many tasks (``ordering.row_number_by``)."""
    return row_number_by(df, list(by if by is not None else GUILD), order, rank_col)


def top_n(df: DataFrame, order: list[Column], n: int, rank_col: str = "top_rank") -> DataFrame:
    """Top-n over the whole table: a bounded TakeOrderedAndProject (each task
    keeps n rows), then the position over those n rows only."""
    top = df.orderBy(*order).limit(n)
    return top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))


def sort_any(df: DataFrame, key: str, ascending: bool, tie: list[Column]) -> list[Column]:
    """User sort on one typed column, nulls last in both directions, ties
    kept in the fetch order ``tie`` (the sort is stable)."""
    c = F.col(key)
    if dict(df.dtypes)[key] == "string":
        c = F.lower(c)
    first = c.asc_nulls_last() if ascending else c.desc_nulls_last()
    return [first, *tie]


# ---------------------------------------------------------------------------
# Summaries
# ---------------------------------------------------------------------------

def api_summary(ranks: DataFrame, counts: DataFrame) -> DataFrame:
    """C23 + D14: newest / second newest snapshot time beside one-row counts.

    Both sides are single-row aggregates; the pairing is a join on a constant
    key of two 1-row frames (no row multiplication)."""
    times = ranks.agg(
        F.max(F.when(F.col("snapshot_rank") == 1, F.col("snapshot_time"))).alias("latest_snapshot_time"),
        F.max(F.when(F.col("snapshot_rank") == 2, F.col("snapshot_time"))).alias("previous_snapshot_time"),
    )
    return one_row_join([times, counts])


def tagged_counts(frames: dict[str, DataFrame], name_col: str = "metric",
                  value_col: str = "value") -> DataFrame:
    """UNION ALL of (name, count) rows."""
    # Counting many inputs in one job: each branch is a partial count per task.
    out = None
    for name, df in frames.items():
        part = df.agg(F.count(F.lit(1)).alias(value_col)).select(
            F.lit(name).alias(name_col), value_col)
        out = part if out is None else out.unionByName(part)
    return out



def one_row_join(frames: list[DataFrame]) -> DataFrame:
    """Place single-row aggregates side by side: every column becomes a
    scalar subquery of one output row (no join; Spark merges subqueries over
    the same input)."""
    spark = frames[0].sparkSession
    cols = [df.select(c).scalar().alias(c) for df in frames for c in df.columns]
    return spark.range(1).select(*cols)
