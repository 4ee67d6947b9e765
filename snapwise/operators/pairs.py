"""Snapshot index, consecutive pairs, ranks and due pairs.

The snapshot index is built from the *distinct* snapshot times only (one row
per (world, guild, time)), never from the member rows, so its windows work on a
table whose size is the number of polls, not the number of members.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapwise.operators.ordering import global_row_number, neighbours

T = "extracted_at_utc"
GUILD_KEY = ["world", "guild_name"]
PAIR_KEY = ["guild_name", "world", "previous_snapshot_time", "latest_snapshot_time"]


def scope(df: DataFrame, world: str | None = None, guild_name: str | None = None) -> DataFrame:
    """Optional scope: a None argument means "all" (B02/B03)."""
    if world is not None:
        df = df.filter(F.col("world") == F.lit(world))
    if guild_name is not None:
        df = df.filter(F.col("guild_name") == F.lit(guild_name))
    return df


def snapshots(roster: DataFrame) -> DataFrame:
    """Distinct (guild, world, time)."""
    return roster.select("guild_name", "world", T).distinct()


def snapshot_index(roster: DataFrame) -> DataFrame:
    """Per guild: each snapshot with its predecessor and successor time.

    Columns: world, guild_name, extracted_at_utc, seq, previous_snapshot_time,
    next_snapshot_time. A null world is kept out (its pairs cannot be
    recorded in a ledger whose key is NOT NULL).

    The window is keyed by guild but only ever sees the guild's *distinct*
    poll times (one row per poll, never per member), so a group is bounded
    by the polling cadence times the retention window, whatever the guild's
    size; it stays lazy (no materialization) because every timeline uses it.
    """
    w = Window.partitionBy(*GUILD_KEY).orderBy(T)
    return (snapshots(roster.filter(F.col("world").isNotNull()))
            .withColumns({
                "seq": F.row_number().over(w),
                "previous_snapshot_time": F.lag(T).over(w),
                "next_snapshot_time": F.lead(T).over(w),
            }))


def snapshot_pairs(roster: DataFrame) -> DataFrame:
    """Consecutive pairs per guild."""
    idx = snapshot_index(roster)
    return (idx.filter(F.col("previous_snapshot_time").isNotNull())
               .select("guild_name", "world", "previous_snapshot_time",
                       F.col(T).alias("latest_snapshot_time")))


def snapshot_times(roster: DataFrame) -> DataFrame:
    """Distinct snapshot times across all guilds (input of the global windows)."""
    return roster.select(F.col(T).alias("snapshot_time")).distinct()


def snapshot_pairs_global(roster: DataFrame) -> DataFrame:
    """Consecutive pairs over all guilds' times (the older, global rule).

    Computed on the distinct times with positions and an equi-join on
    position - 1 (``ordering.neighbours``), never a one-task window.
    """
    n = neighbours(snapshot_times(roster), [], "snapshot_time", prev_name="previous_snapshot_time")
    return (n.filter(F.col("previous_snapshot_time").isNotNull())
             .select("previous_snapshot_time", F.col("snapshot_time").alias("latest_snapshot_time")))


def snapshot_ranks(roster: DataFrame) -> DataFrame:
    """Dense rank of snapshot times, newest first (global). Over the
    distinct times the dense rank is the row position."""
    return global_row_number(snapshot_times(roster), [F.col("snapshot_time").desc()], "snapshot_rank")


def newest_two_times(roster: DataFrame) -> DataFrame:
    """Ranks 1 and 2 of E04 only: a bounded top-2 (each task keeps 2 rows)."""
    top = snapshot_times(roster).orderBy(F.col("snapshot_time").desc()).limit(2)
    # Two rows at most: their window needs no distribution.
    return top.withColumn("snapshot_rank", F.row_number().over(Window.orderBy(F.col("snapshot_time").desc())))


def _with_floor(roster: DataFrame, times: DataFrame) -> DataFrame:
    """The rows of some (world, guild, time) polls. The oldest of the times (one
    value) is a filter that the scan takes."""
    floor = times.agg(F.min(T)).first()[0]
    if floor is None:
        return roster.limit(0)
    return roster.filter(F.col(T) >= F.lit(floor).cast("timestamp_ntz")).join(times, [*GUILD_KEY, T], "left_semi")


def around_range(roster: DataFrame, start: str, end: str) -> DataFrame:
    """The rows that pairs ending on the days ``start`` to ``end`` have: those of
    the days and each guild's newest poll before them. Windows over the result
    hold no other history."""
    first = F.lit(f"{start} 00:00:00").cast("timestamp_ntz")
    last = F.lit(f"{end} 23:59:59.999999").cast("timestamp_ntz")
    before = roster.filter(F.col(T) < first).groupBy(*GUILD_KEY).agg(F.max(T).alias(T))
    return roster.filter(F.col(T).between(first, last)).unionByName(
        _with_floor(roster.filter(F.col(T) < first), before))


def newest_pair_rows(roster: DataFrame) -> DataFrame:
    """The rows of each guild's two newest polls."""
    w = Window.partitionBy(*GUILD_KEY).orderBy(F.col(T).desc())
    newest = snapshots(roster).withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= 2).drop("_k")
    return _with_floor(roster, newest)


def due_pairs(roster: DataFrame, ledger: DataFrame, pair_limit: int | None,
              world: str | None = None, guild_name: str | None = None) -> DataFrame:
    """C19 + S01: pairs not in the ledger, oldest latest time first, at most n
    (None: all of them, without a sort).

    The limit is the feature (a run's batch size); ties are broken by world
    and guild so the batch is deterministic.
    """
    pairs = snapshot_pairs(scope(roster, world, guild_name))
    return oldest_pairs(pairs.join(ledger.select(*PAIR_KEY), PAIR_KEY, "left_anti"), pair_limit)


#: Pairs that one task may sort and keep for a limit; larger limits go by position.
ONE_TASK = 10_000


def oldest_pairs(pairs: DataFrame, pair_limit: int | None) -> DataFrame:
    """The ``pair_limit`` oldest of some pairs, ties by world and guild (None: all
    of them, without a sort). A limit beyond ``ONE_TASK`` keeps the same rows by
    their positions (``ordering``), so that no task merges them all."""
    if pair_limit is None:
        return pairs
    if pair_limit < 1:
        raise ValueError("pair_limit must be at least 1")
    order = ["latest_snapshot_time", "world", "guild_name"]
    if pair_limit <= ONE_TASK:
        return pairs.orderBy(*order).limit(pair_limit)
    numbered = global_row_number(pairs, [F.col(c) for c in order], "_position")
    return numbered.filter(F.col("_position") <= pair_limit).drop("_position")
