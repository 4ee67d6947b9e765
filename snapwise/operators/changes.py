"""Change events from consecutive snapshots: one window pass.

The reference joins pair x latest roster x previous roster for every event
kind. Here each member row is tagged with its guild's previous/next snapshot
time (a join against the small snapshot index), then one window keyed by
(world, guild, member) and ordered by time yields, per row, the member's own
previous/next appearance and attributes. An event is a comparison between the
two: no self-join, one shuffle keyed by member (so a huge guild does not land
in one task), and every event kind comes out of the same pass.

Older rules (global pairing, strict ``<>`` comparison, newest-vs-second-newest)
are kept as separate functions with their own plans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapwise.functions.exprs import (DEFAULT_CAP_MINUTES, capped_minutes,
                                      interval_minutes, is_online, null_safe_differs)
from snapwise.operators.pairs import T, newest_two_times, snapshot_index, snapshot_pairs_global

MEMBER_KEY = ["world", "guild_name", "character_name"]


def timeline(roster: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """Member rows with the guild's and the member's neighbouring snapshots.

    Added columns: previous_snapshot_time / next_snapshot_time (guild level),
    m_prev_t / m_next_t (member level), prev_level, prev_rank, prev_status,
    next_status, in_previous (member present in the guild's previous
    snapshot), in_next (present in the next one).
    """
    idx = (index if index is not None else snapshot_index(roster)).select(
        "world", "guild_name", T, "previous_snapshot_time", "next_snapshot_time")
    m = roster.join(idx, ["world", "guild_name", T])
    w = Window.partitionBy(*MEMBER_KEY).orderBy(T)
    m = m.withColumns({
        "m_prev_t": F.lag(T).over(w),
        "m_next_t": F.lead(T).over(w),
        "prev_level": F.lag("level").over(w),
        "prev_rank": F.lag("guild_rank").over(w),
        "prev_status": F.lag("status").over(w),
        "next_status": F.lead("status").over(w),
    })
    return m.withColumns({
        "in_previous": F.col("previous_snapshot_time").isNotNull()
        & F.col("m_prev_t").eqNullSafe(F.col("previous_snapshot_time")),
        "in_next": F.col("next_snapshot_time").isNotNull()
        & F.col("m_next_t").eqNullSafe(F.col("next_snapshot_time")),
    })


def pair_minutes(cap: int = DEFAULT_CAP_MINUTES):
    """Capped minutes credited to the pair ending at this row, 0 if offline."""
    minutes = interval_minutes("previous_snapshot_time", T)
    return F.when(is_online("prev_status"), capped_minutes(minutes, cap)).otherwise(F.lit(0)).cast("int")


def level_changes_from(tl: DataFrame, cap: int = DEFAULT_CAP_MINUTES) -> DataFrame:
    """C01 + C14: level differs null-safely between consecutive snapshots."""
    return (tl.filter(F.col("in_previous") & null_safe_differs("level", "prev_level"))
              .select("guild_name", "world", "character_name", "vocation", "guild_rank",
                      F.col("prev_level").alias("previous_level"),
                      F.col("level").alias("current_level"),
                      (F.col("level") - F.col("prev_level")).cast("int").alias("level_gain"),
                      "previous_snapshot_time",
                      F.col(T).alias("latest_snapshot_time"),
                      pair_minutes(cap).alias("estimated_online_minutes")))


def joins_from(tl: DataFrame) -> DataFrame:
    """Present in the pair's latest snapshot, absent from the previous."""
    return (tl.filter(F.col("previous_snapshot_time").isNotNull() & ~F.col("in_previous"))
              .select("guild_name", "world", "character_name", "vocation", "level",
                      "guild_rank", "status", F.col("joined").alias("joined_date"),
                      "previous_snapshot_time", F.col(T).alias("latest_snapshot_time")))


def leaves_from(tl: DataFrame) -> DataFrame:
    """Present in the previous snapshot, absent from the latest; the
    previous row's attributes."""
    return (tl.filter(F.col("next_snapshot_time").isNotNull() & ~F.col("in_next"))
              .select("guild_name", "world", "character_name", "vocation", "level",
                      "guild_rank", "status", F.col("joined").alias("joined_date"),
                      F.col(T).alias("previous_snapshot_time"),
                      F.col("next_snapshot_time").alias("latest_snapshot_time")))


def rank_changes_from(tl: DataFrame) -> DataFrame:
    """Rank differs null-safely between consecutive snapshots."""
    return (tl.filter(F.col("in_previous") & null_safe_differs("guild_rank", "prev_rank"))
              .select("guild_name", "world", "character_name",
                      F.col("prev_rank").alias("previous_guild_rank"),
                      F.col("guild_rank").alias("current_guild_rank"),
                      "previous_snapshot_time", F.col(T).alias("latest_snapshot_time")))


def level_changes(roster: DataFrame, cap: int = DEFAULT_CAP_MINUTES) -> DataFrame:
    return level_changes_from(timeline(roster), cap)


def member_joins(roster: DataFrame) -> DataFrame:
    return joins_from(timeline(roster))


def member_leaves(roster: DataFrame) -> DataFrame:
    return leaves_from(timeline(roster))


def rank_changes(roster: DataFrame) -> DataFrame:
    return rank_changes_from(timeline(roster))


# ---------------------------------------------------------------------------
# Older rules.
# ---------------------------------------------------------------------------

def level_changes_strict(roster: DataFrame) -> DataFrame:
    """Per-guild pairs, ``<>`` comparison (null on either side drops)."""
    tl = timeline(roster)
    return (tl.filter(F.col("in_previous") & (F.col("level") != F.col("prev_level")))
              .select("guild_name", "world", "character_name", "vocation", "guild_rank",
                      F.col("prev_level").alias("previous_level"),
                      F.col("level").alias("current_level"),
                      (F.col("level") - F.col("prev_level")).cast("int").alias("level_gain"),
                      "previous_snapshot_time", F.col(T).alias("latest_snapshot_time")))


def level_changes_alltime_minutes(roster: DataFrame, totals: DataFrame) -> DataFrame:
    """Level changes carrying the member's all-time minutes (older rule)."""
    lc = level_changes(roster).drop("estimated_online_minutes")
    t = totals.select(*MEMBER_KEY, F.col("estimated_online_minutes").alias("_m"))
    return (lc.join(t, MEMBER_KEY, "left")
              .withColumn("estimated_online_minutes", F.coalesce(F.col("_m"), F.lit(0)).cast("int"))
              .drop("_m"))


def level_changes_global_pairs(roster: DataFrame) -> DataFrame:
    """Pairs of consecutive times over *all* guilds (the first historical
    view), member matched on (guild, world, name), ``<>`` comparison."""
    pairs = snapshot_pairs_global(roster)
    latest = roster.join(pairs, roster[T] == pairs.latest_snapshot_time)
    prev = (roster.join(pairs, roster[T] == pairs.previous_snapshot_time)
                  .select("guild_name", "world", "character_name", "previous_snapshot_time",
                          "latest_snapshot_time", F.col("level").alias("previous_level")))
    j = latest.join(prev, ["guild_name", "world", "character_name",
                           "previous_snapshot_time", "latest_snapshot_time"])
    return (j.filter(F.col("level") != F.col("previous_level"))
             .select("guild_name", "world", "character_name", "vocation", "guild_rank",
                     "previous_level", F.col("level").alias("current_level"),
                     (F.col("level") - F.col("previous_level")).cast("int").alias("level_gain"),
                     "previous_snapshot_time", "latest_snapshot_time"))


def _rank12(roster: DataFrame):
    """Rows of the newest and second-newest snapshot times (global ranking)."""
    ranks = newest_two_times(roster)
    r = roster.join(F.broadcast(ranks), roster[T] == ranks.snapshot_time)
    return (r.filter(F.col("snapshot_rank") == 1).drop("snapshot_time", "snapshot_rank"),
            r.filter(F.col("snapshot_rank") == 2).drop("snapshot_time", "snapshot_rank"))


def level_changes_latest(roster: DataFrame) -> DataFrame:
    """Newest vs second-newest snapshot, member matched by name and
    guild, ``<>`` comparison."""
    latest, previous = _rank12(roster)
    p = previous.select("guild_name", "world", "character_name",
                        F.col("level").alias("previous_level"),
                        F.col(T).alias("previous_snapshot_time"))
    j = latest.join(p, ["guild_name", "world", "character_name"])
    return (j.filter(F.col("level") != F.col("previous_level"))
             .select("guild_name", "world", "character_name", "vocation", "guild_rank",
                     "previous_level", F.col("level").alias("current_level"),
                     (F.col("level") - F.col("previous_level")).cast("int").alias("level_gain"),
                     "previous_snapshot_time", F.col(T).alias("latest_snapshot_time")))


def member_joins_latest(roster: DataFrame) -> DataFrame:
    """In the newest snapshot, absent from the second newest."""
    latest, previous = _rank12(roster)
    p = previous.select("guild_name", "world", "character_name")
    return (latest.join(p, ["guild_name", "world", "character_name"], "left_anti")
                  .select("guild_name", "world", "character_name", "vocation", "level",
                          "guild_rank", "status", F.col("joined").alias("joined_date"),
                          F.col(T).alias("latest_snapshot_time")))


def member_leaves_latest(roster: DataFrame) -> DataFrame:
    """In the second-newest snapshot, absent from the newest."""
    latest, previous = _rank12(roster)
    lt = latest.select("guild_name", "world", "character_name")
    return (previous.join(lt, ["guild_name", "world", "character_name"], "left_anti")
                    .select("guild_name", "world", "character_name", "vocation", "level",
                            "guild_rank", "status", F.col("joined").alias("joined_date"),
                            F.col(T).alias("previous_snapshot_time")))


def rank_changes_latest(roster: DataFrame) -> DataFrame:
    """C11: newest vs second newest, ``<>`` comparison."""
    latest, previous = _rank12(roster)
    p = previous.select("guild_name", "world", "character_name",
                        F.col("guild_rank").alias("previous_guild_rank"),
                        F.col(T).alias("previous_snapshot_time"))
    j = latest.join(p, ["guild_name", "world", "character_name"])
    return (j.filter(F.col("guild_rank") != F.col("previous_guild_rank"))
             .select("guild_name", "world", "character_name", "previous_guild_rank",
                     F.col("guild_rank").alias("current_guild_rank"),
                     "previous_snapshot_time", F.col(T).alias("latest_snapshot_time")))


def _global_sides(roster: DataFrame):
    """Member rows at the latest / previous time of each global pair."""
    pairs = snapshot_pairs_global(roster)
    latest = roster.join(pairs, roster[T] == pairs.latest_snapshot_time).drop(T)
    previous = roster.join(pairs, roster[T] == pairs.previous_snapshot_time).drop(T)
    return latest, previous


_GLOBAL_KEY = ["guild_name", "world", "character_name", "previous_snapshot_time", "latest_snapshot_time"]


def _move_columns():
    return ["guild_name", "world", "character_name", "vocation", "level", "guild_rank", "status",
            F.col("joined").alias("joined_date"), "previous_snapshot_time", "latest_snapshot_time"]


def member_joins_global_pairs(roster: DataFrame) -> DataFrame:
    """C07 (first historical view): in the latest snapshot of a global pair,
    absent from its previous one (anti-join)."""
    latest, previous = _global_sides(roster)
    return latest.join(previous.select(*_GLOBAL_KEY), _GLOBAL_KEY, "left_anti").select(*_move_columns())


def member_leaves_global_pairs(roster: DataFrame) -> DataFrame:
    """C09 (first historical view): in the previous snapshot of a global
    pair, absent from its latest one."""
    latest, previous = _global_sides(roster)
    return previous.join(latest.select(*_GLOBAL_KEY), _GLOBAL_KEY, "left_anti").select(*_move_columns())


def rank_changes_global_pairs(roster: DataFrame) -> DataFrame:
    """C11 (first historical view): rank differs (``<>``) across a global pair."""
    latest, previous = _global_sides(roster)
    p = previous.select(*_GLOBAL_KEY, F.col("guild_rank").alias("previous_guild_rank"))
    j = latest.join(p, _GLOBAL_KEY)
    return (j.filter(F.col("guild_rank") != F.col("previous_guild_rank"))
             .select("guild_name", "world", "character_name", "previous_guild_rank",
                     F.col("guild_rank").alias("current_guild_rank"),
                     "previous_snapshot_time", "latest_snapshot_time"))
