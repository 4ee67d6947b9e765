"""Incremental online-activity and general-analytics increments.

Each increment is a pure function ``(roster, state, params) -> new state +
report``: due pairs (pairs not in the ledger, oldest first, at most
``pair_limit``) -> results for those pairs only -> keyed upserts / guarded
appends -> ledger. The job layer (``plans.jobs``) persists the new state as
new table versions, results first and the ledger last, so a crash before the
ledger write replays the same batch idempotently.

Only the snapshots a due pair touches are read through the member window
(the roster is semi-joined to the due times first); the guild-level
neighbours come from the full snapshot index, so a member's presence in the
previous snapshot is decided exactly as in a full rebuild.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapwise.functions.exprs import DEFAULT_CAP_MINUTES
from snapwise.operators import activity as AC
from snapwise.operators import changes as CH
from snapwise.operators import roster as RO
from snapwise.operators.pairs import PAIR_KEY, T, due_pairs, scope, snapshot_index
from snapwise.plans.upsert import guarded_append, new_rows, upsert

INTERVAL_KEY = ["world", "guild_name", "character_name", "previous_snapshot_time", "latest_snapshot_time"]
DAY_KEY = ["world", "guild_name", "character_name", "activity_date"]
MEMBER_KEY = ["world", "guild_name", "character_name"]
LEDGER_COLUMNS = [*PAIR_KEY, "processed_at_utc"]


@dataclass
class OnlineState:
    intervals: DataFrame
    days: DataFrame
    totals: DataFrame
    ledger: DataFrame


@dataclass
class GeneralState:
    pairs: DataFrame
    level_changes: DataFrame
    joins: DataFrame
    leaves: DataFrame
    rank_changes: DataFrame
    latest_members: DataFrame
    ledger: DataFrame
    intervals: DataFrame  # read only: the online job's interval table


@dataclass
class Increment:
    state: object
    report: DataFrame
    due: DataFrame
    extra: dict = field(default_factory=dict)


def due_timeline(roster: DataFrame, due: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """The member timeline restricted to the snapshots of the due pairs.

    ``index`` is the guild snapshot index; a job passes the one built from
    its small snapshots table, and ``roster`` may then hold only the member
    rows of the batch's snapshot dates."""
    idx = index if index is not None else snapshot_index(roster)
    times = (due.select("world", "guild_name", F.col("previous_snapshot_time").alias(T))
                .unionByName(due.select("world", "guild_name", F.col("latest_snapshot_time").alias(T)))
                .distinct())
    r = roster.join(times, ["world", "guild_name", T], "left_semi")
    return CH.timeline(r, index=idx)


def _in_due(events: DataFrame, due: DataFrame) -> DataFrame:
    return events.join(due.select(*PAIR_KEY), PAIR_KEY, "left_semi")


def _ledger_rows(due: DataFrame, as_of: Column) -> DataFrame:
    return due.select(*PAIR_KEY, as_of.alias("processed_at_utc"))


def plan_online(roster: DataFrame, state: OnlineState, pair_limit: int = 100,
                world: str | None = None, guild_name: str | None = None,
                cap: int = DEFAULT_CAP_MINUTES, dense: bool = False) -> tuple[DataFrame, DataFrame]:
    """Due pairs and the interval rows of exactly those pairs."""
    due = due_pairs(roster, state.ledger, pair_limit, world, guild_name)
    tl = due_timeline(scope(roster, world, guild_name), due)
    return due, batch_intervals(tl, due, cap, dense)


def batch_intervals(tl: DataFrame, due: DataFrame, cap: int = DEFAULT_CAP_MINUTES,
                    dense: bool = False) -> DataFrame:
    """Interval rows of exactly the due pairs, from a batch timeline."""
    new_iv = AC.dense_intervals_from(tl, cap) if dense else AC.intervals_from(tl, cap)
    return _in_due(new_iv, due)


def apply_online(state: OnlineState, due: DataFrame, new_iv: DataFrame, as_of: Column,
                 pair_limit: int = 100, world: str | None = None, guild_name: str | None = None,
                 dense: bool = False) -> Increment:
    """Upsert intervals, recompute the affected days and members, ledger."""
    intervals = upsert(state.intervals, new_iv, INTERVAL_KEY)

    affected_days = new_iv.select(*MEMBER_KEY, F.to_date("latest_snapshot_time").alias("activity_date")).distinct()
    iv_days = intervals.withColumn("activity_date", F.to_date("latest_snapshot_time"))
    day_rows = AC.minutes_by_day(iv_days.join(affected_days, DAY_KEY, "left_semi"), keep_zero=dense)
    days = upsert(state.days, day_rows, DAY_KEY)

    affected_members = new_iv.select(*MEMBER_KEY).distinct()
    total_rows = AC.minutes_total(intervals.join(affected_members, MEMBER_KEY, "left_semi"), keep_zero=dense)
    totals = upsert(state.totals, total_rows, MEMBER_KEY)

    ledger_new = _ledger_rows(due, as_of)
    ledger = upsert(state.ledger, ledger_new, PAIR_KEY)
    report = _counts_report(
        {"processed_pairs": due, "online_interval_rows": new_iv, "daily_online_minutes_rows": day_rows,
         "all_time_online_minutes_rows": total_rows, "processed_pair_rows_written": ledger_new},
        {"scope_world": world, "scope_guild_name": guild_name, "pair_limit": pair_limit,
         "storage_policy": "dense_intervals" if dense else "store_previous_online_intervals_only"})
    return Increment(OnlineState(intervals, days, totals, ledger), report, due,
                     {"intervals": new_iv, "online_ledger": ledger_new, "days": day_rows,
                      "totals": total_rows})


def online_increment(roster: DataFrame, state: OnlineState, as_of: Column,
                     pair_limit: int = 100, world: str | None = None, guild_name: str | None = None,
                     cap: int = DEFAULT_CAP_MINUTES, dense: bool = False) -> Increment:
    """K01 (sparse, zero-minute days/totals not stored) or K02 (``dense``)."""
    due, new_iv = plan_online(roster, state, pair_limit, world, guild_name, cap, dense)
    return apply_online(state, due, new_iv, as_of, pair_limit, world, guild_name, dense)


def batch_events(tl: DataFrame, due: DataFrame, intervals: DataFrame,
                 cap: int = DEFAULT_CAP_MINUTES) -> dict[str, DataFrame]:
    """The event rows of exactly the due pairs, from a batch timeline."""
    lc = _in_due(CH.level_changes_from(tl, cap), due)
    # Minutes come from the stored interval table, 0 when absent.
    iv = intervals.select(*INTERVAL_KEY, F.col("estimated_online_minutes").alias("_m"))
    lc = (lc.drop("estimated_online_minutes").join(iv, INTERVAL_KEY, "left")
            .withColumn("estimated_online_minutes", F.coalesce(F.col("_m"), F.lit(0)).cast("int"))
            .drop("_m"))
    return {"pairs": due.select(*PAIR_KEY), "level_changes": lc,
            "joins": _in_due(CH.joins_from(tl), due), "leaves": _in_due(CH.leaves_from(tl), due),
            "rank_changes": _in_due(CH.rank_changes_from(tl), due)}


def general_increment(roster: DataFrame, state: GeneralState, as_of: Column,
                      pair_limit: int = 100, world: str | None = None, guild_name: str | None = None,
                      cap: int = DEFAULT_CAP_MINUTES, roster_mode: str = "replace",
                      due: DataFrame | None = None, timeline: DataFrame | None = None) -> Increment:
    """Pairs, level changes (with that interval's minutes), joins,
    leaves, rank changes (all guarded appends), latest roster of the touched
    guilds, ledger.

    ``roster_mode="replace"`` rewrites the touched guilds' latest roster
    (leavers disappear); ``"accumulate"`` upserts by member and keeps leavers
    with their old time, as the reference's incremental job does (N09).
    A job may pass the ``due`` batch and its restricted ``timeline`` already
    written (lineage cut)."""
    due = due_pairs(roster, state.ledger, pair_limit, world, guild_name) if due is None else due
    r = scope(roster, world, guild_name)
    tl = due_timeline(r, due) if timeline is None else timeline

    new = batch_events(tl, due, state.intervals, cap)
    pairs_in, lc_in, joins_in, leaves_in, rank_in = (
        new[k] for k in ("pairs", "level_changes", "joins", "leaves", "rank_changes"))

    pairs = guarded_append(state.pairs, pairs_in, PAIR_KEY)
    level_changes = guarded_append(state.level_changes, lc_in, INTERVAL_KEY)
    joins = guarded_append(state.joins, joins_in, INTERVAL_KEY)
    leaves = guarded_append(state.leaves, leaves_in, INTERVAL_KEY)
    rank_changes = guarded_append(state.rank_changes, rank_in, INTERVAL_KEY)

    touched = due.select("world", "guild_name").distinct()
    r_touched = r.join(touched, ["world", "guild_name"], "left_semi")
    iv_touched = state.intervals.join(touched, ["world", "guild_name"], "left_semi")
    lc_touched = level_changes.join(touched, ["world", "guild_name"], "left_semi")
    fresh = RO.latest_members(r_touched, iv_touched, lc_touched)
    if roster_mode == "replace":
        kept = state.latest_members.join(touched, ["world", "guild_name"], "left_anti")
        latest_members = kept.unionByName(fresh.select(*state.latest_members.columns))
    elif roster_mode == "accumulate":
        latest_members = upsert(state.latest_members, fresh, MEMBER_KEY)
    else:
        raise ValueError(f"unknown roster_mode {roster_mode}")

    ledger_new = _ledger_rows(due, as_of)
    ledger = upsert(state.ledger, ledger_new, PAIR_KEY)
    report = _counts_report(
        {"processed_pairs": due,
         "snapshot_pair_rows": new_rows(state.pairs, pairs_in, PAIR_KEY),
         "level_change_rows": new_rows(state.level_changes, lc_in, INTERVAL_KEY),
         "join_rows": new_rows(state.joins, joins_in, INTERVAL_KEY),
         "leave_rows": new_rows(state.leaves, leaves_in, INTERVAL_KEY),
         "rank_change_rows": new_rows(state.rank_changes, rank_in, INTERVAL_KEY),
         "latest_member_rows": fresh,
         "processed_pair_rows_written": ledger_new},
        {"scope_world": world, "scope_guild_name": guild_name, "pair_limit": pair_limit})
    new_state = GeneralState(pairs, level_changes, joins, leaves, rank_changes, latest_members,
                             ledger, state.intervals)
    incoming = {"pairs": pairs_in, "level_changes": lc_in, "joins": joins_in, "leaves": leaves_in,
                "rank_changes": rank_in, "general_ledger": ledger_new, "latest_members": fresh}
    return Increment(new_state, report, due, incoming)


def _counts_report(frames: dict[str, DataFrame], params: dict[str, object]) -> DataFrame:
    """One report row: a count per step (all of them one aggregate of one-row
    partial counts) plus the run's parameters."""
    counts = None
    for name, df in frames.items():
        one = df.agg(F.count(F.lit(1)).alias("_n")).select(F.lit(name).alias("_step"), "_n")
        counts = one if counts is None else counts.unionByName(one)
    row = counts.agg(*[F.max(F.when(F.col("_step") == name, F.col("_n"))).alias(name) for name in frames])
    given = [F.lit(v).cast("string").alias(k) if v is None else F.lit(v).alias(k) for k, v in params.items()]
    return row.select(F.lit(True).alias("success"), *frames, *given)


def seed_ledger(intervals: DataFrame, as_of: Column) -> DataFrame:
    """Seed a ledger from already stored results (distinct pairs)."""
    return intervals.select(*PAIR_KEY).distinct().withColumn("processed_at_utc", as_of)
