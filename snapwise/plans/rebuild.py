"""Full and scoped rebuilds.

A rebuild recomputes every result table from the member snapshots with the
one-pass timeline. A scoped rebuild recomputes one (world, guild) and
replaces only that guild's rows (the stored form, which touches no other guild,
is ``SnapshotJobs.rebuild``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapwise.functions.exprs import DEFAULT_CAP_MINUTES
from snapwise.operators import activity as AC
from snapwise.operators import changes as CH
from snapwise.operators import pairs as PR
from snapwise.operators import roster as RO

RESULT_TABLES = ("pairs", "level_changes", "joins", "leaves", "rank_changes", "intervals",
                 "days", "totals", "latest_members")


def rebuild_all(roster: DataFrame, cap: int = DEFAULT_CAP_MINUTES,
                timeline: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every result table, in dependency order, from one timeline (a caller
    that uses several of them passes the timeline written once)."""
    tl = CH.timeline(roster) if timeline is None else timeline
    iv = AC.intervals_from(tl, cap)
    lc = CH.level_changes_from(tl, cap)
    return {
        "pairs": PR.snapshot_pairs(roster),
        "level_changes": lc,
        "joins": CH.joins_from(tl),
        "leaves": CH.leaves_from(tl),
        "rank_changes": CH.rank_changes_from(tl),
        "intervals": iv,
        "days": AC.minutes_by_day(iv),
        "totals": AC.minutes_total(iv),
        "latest_members": RO.latest_members(roster, iv, lc),
    }


def rebuild_scope(roster: DataFrame, stored: dict[str, DataFrame], world: str, guild_name: str,
                  cap: int = DEFAULT_CAP_MINUTES) -> dict[str, DataFrame]:
    """Delete the scope's rows from every table, insert the scope's
    recomputed rows; other guilds are untouched."""
    fresh = rebuild_all(PR.scope(roster, world, guild_name), cap)
    in_scope = (F.col("world") == F.lit(world)) & (F.col("guild_name") == F.lit(guild_name))
    out = {}
    for name in RESULT_TABLES:
        keep = stored[name].filter(~F.coalesce(in_scope, F.lit(False)))
        out[name] = keep.unionByName(fresh[name].select(*stored[name].columns))
    return out
