"""Refresh queue and discovery, as batch table transitions.

The reference mutates one row at a time under row locks. Here every
transition is a whole-table step: ``next_state = f(state, inputs, as_of)``,
a left join of the inputs (batch of outcomes, due set, names) by key and a
``when`` chain; the new table is written as a new version by the job layer.
``as_of`` is always a parameter, never the wall clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapwise.functions.exprs import (QUEUE_ERROR_MAX_CHARS, QUEUE_ERROR_PREVIEW_CHARS,
                                      QUEUE_FAILURE_BACKOFF_MINUTES, QUEUE_STALE_MINUTES,
                                      idiv, micros_between)

# Fixed queue values.
STATUS_RUNNING = "running"
STATUS_SUCCESS = "success"
STATUS_FAILED = "failed"
STATUS_RETRY = "retry_ready"
STATUS_DISCOVERED = "discovered"
STALE_RELEASE_MESSAGE = "Released from stale running status"
DEFAULT_INTERVAL_MINUTES = 120
DEFAULT_PRIORITY = 100
EPOCH = "1970-01-01 00:00:00"

QUEUE_COLUMNS = ["guild_id", "guild_name", "world", "is_active", "refresh_interval_minutes",
                 "next_refresh_after_utc", "last_refresh_started_at_utc",
                 "last_refresh_completed_at_utc", "last_refresh_status", "last_refresh_error",
                 "refresh_priority", "discovered_at_utc", "updated_at_utc"]


def _minutes_after(t: Column, minutes) -> Column:
    m = minutes if isinstance(minutes, Column) else F.lit(int(minutes))
    return F.timestamp_add("MINUTE", m, t)


def due_entities(queue: DataFrame, as_of: Column, batch_size: int,
                 world: str | None = None) -> DataFrame:
    """Active guilds whose next refresh is due, by priority, due time
    (null first), name; the first ``batch_size`` (the claim batch)."""
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    q = queue.filter(F.col("is_active") & (F.col("next_refresh_after_utc").isNull()
                                           | (F.col("next_refresh_after_utc") <= as_of)))
    if world is not None:
        q = q.filter(F.col("world") == F.lit(world))
    order = [F.col("refresh_priority").asc(),
             F.coalesce(F.col("next_refresh_after_utc"), F.lit(EPOCH).cast("timestamp_ntz")).asc(),
             F.col("guild_name").asc(), F.col("guild_id").asc()]
    top = q.orderBy(*order).limit(batch_size)
    return top.select("guild_id", "guild_name", "world",
                      F.row_number().over(Window.orderBy(*order)).alias("claim_rank"))


def claim(queue: DataFrame, claimed: DataFrame, as_of: Column) -> DataFrame:
    """K13 claim: claimed rows become running, started now, error cleared."""
    c = claimed.select("guild_id").withColumn("_hit", F.lit(True))
    j = queue.join(c, "guild_id", "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    return j.select(*[
        F.when(hit, as_of).otherwise(F.col(n)).alias(n) if n in ("last_refresh_started_at_utc", "updated_at_utc")
        else F.when(hit, F.lit(STATUS_RUNNING)).otherwise(F.col(n)).alias(n) if n == "last_refresh_status"
        else F.when(hit, F.lit(None).cast("string")).otherwise(F.col(n)).alias(n) if n == "last_refresh_error"
        else F.col(n)
        for n in QUEUE_COLUMNS])


def apply_outcomes(queue: DataFrame, outcomes: DataFrame, as_of: Column) -> DataFrame:
    """K13 success / failure for a batch of (guild_id, succeeded, error_message).

    Success: completed now, next = now + the guild's interval, error cleared.
    Failure: completed now, next = now + 30 min, error cut to 1000 chars."""
    o = outcomes.select("guild_id", F.col("succeeded").alias("_ok"), F.col("error_message").alias("_err"))
    j = queue.join(o, "guild_id", "left")
    hit = F.col("_ok").isNotNull()
    ok = hit & F.col("_ok")
    bad = hit & ~F.col("_ok")
    cols = {
        "last_refresh_completed_at_utc": F.when(hit, as_of).otherwise(F.col("last_refresh_completed_at_utc")),
        "last_refresh_status": F.when(ok, F.lit(STATUS_SUCCESS)).when(bad, F.lit(STATUS_FAILED))
                                .otherwise(F.col("last_refresh_status")),
        "last_refresh_error": F.when(ok, F.lit(None).cast("string"))
                               .when(bad, F.left(F.col("_err"), F.lit(QUEUE_ERROR_MAX_CHARS)))
                               .otherwise(F.col("last_refresh_error")),
        "next_refresh_after_utc": F.when(ok, _minutes_after(as_of, F.col("refresh_interval_minutes")))
                                   .when(bad, _minutes_after(as_of, QUEUE_FAILURE_BACKOFF_MINUTES))
                                   .otherwise(F.col("next_refresh_after_utc")),
        "updated_at_utc": F.when(hit, as_of).otherwise(F.col("updated_at_utc")),
    }
    return j.select(*[cols[n].alias(n) if n in cols else F.col(n) for n in QUEUE_COLUMNS])


def release_stale(queue: DataFrame, as_of: Column, stale_minutes: int = QUEUE_STALE_MINUTES) -> DataFrame:
    """K13 release: running for longer than ``stale_minutes`` -> retry_ready, due now."""
    stale = (F.col("last_refresh_status") == STATUS_RUNNING) & \
            (F.col("last_refresh_started_at_utc") < _minutes_after(as_of, -int(stale_minutes)))
    stale = F.coalesce(stale, F.lit(False))
    cols = {
        "last_refresh_status": F.when(stale, F.lit(STATUS_RETRY)).otherwise(F.col("last_refresh_status")),
        "last_refresh_error": F.when(stale, F.lit(STALE_RELEASE_MESSAGE)).otherwise(F.col("last_refresh_error")),
        "next_refresh_after_utc": F.when(stale, as_of).otherwise(F.col("next_refresh_after_utc")),
        "updated_at_utc": F.when(stale, as_of).otherwise(F.col("updated_at_utc")),
    }
    return queue.select(*[cols[n].alias(n) if n in cols else F.col(n) for n in QUEUE_COLUMNS])


def reset_interval(queue: DataFrame, world: str, as_of: Column, minutes: int) -> DataFrame:
    """K13 interval reset for the active guilds of one world, re-scheduling
    with LEAST(current next or now, last completion + minutes)."""
    hit = F.coalesce((F.col("world") == F.lit(world)) & F.col("is_active"), F.lit(False))
    nxt = F.when(F.col("last_refresh_completed_at_utc").isNull(), as_of).otherwise(
        F.least(F.coalesce(F.col("next_refresh_after_utc"), as_of),
                _minutes_after(F.col("last_refresh_completed_at_utc"), minutes)))
    cols = {
        "refresh_interval_minutes": F.when(hit, F.lit(int(minutes))).otherwise(F.col("refresh_interval_minutes")),
        "next_refresh_after_utc": F.when(hit, nxt).otherwise(F.col("next_refresh_after_utc")),
        "updated_at_utc": F.when(hit, as_of).otherwise(F.col("updated_at_utc")),
    }
    return queue.select(*[cols[n].alias(n) if n in cols else F.col(n) for n in QUEUE_COLUMNS])


def force_due(queue: DataFrame, names: DataFrame, as_of: Column) -> DataFrame:
    """Operations recipe: make the named (world, guild) entries due now."""
    n = names.select("world", "guild_name").distinct().withColumn("_hit", F.lit(True))
    j = queue.join(n, ["world", "guild_name"], "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    cols = {"next_refresh_after_utc": F.when(hit, as_of).otherwise(F.col("next_refresh_after_utc")),
            "updated_at_utc": F.when(hit, as_of).otherwise(F.col("updated_at_utc"))}
    return j.select(*[cols[c].alias(c) if c in cols else F.col(c) for c in QUEUE_COLUMNS])


def status_board(queue: DataFrame, n: int = 50) -> DataFrame:
    """Newest n by completion then update time (nulls last), with a
    200-character error preview."""
    order = [F.col("last_refresh_completed_at_utc").desc_nulls_last(),
             F.col("updated_at_utc").desc_nulls_last(), F.col("guild_id").asc()]
    top = queue.orderBy(*order).limit(n)
    return top.select("world", "guild_name", "last_refresh_status", "last_refresh_started_at_utc",
                      "last_refresh_completed_at_utc", "next_refresh_after_utc",
                      F.left(F.coalesce(F.col("last_refresh_error"), F.lit("")),
                             F.lit(QUEUE_ERROR_PREVIEW_CHARS)).alias("error_preview"),
                      F.row_number().over(Window.orderBy(*order)).alias("board_rank"))


def stuck_runs(queue: DataFrame, as_of: Column) -> DataFrame:
    """Guilds in running state, with how long they have been running."""
    return (queue.filter(F.col("last_refresh_status") == STATUS_RUNNING)
                 .select("world", "guild_name", "last_refresh_status", "last_refresh_started_at_utc",
                         idiv(micros_between("last_refresh_started_at_utc", as_of), 60_000_000)
                         .cast("bigint").alias("running_minutes")))


def api_worlds(worlds: DataFrame) -> DataFrame:
    """Active worlds for the selector."""
    return worlds.filter("is_active").select("world_name", "is_active", "updated_at_utc")


def api_guilds(queue: DataFrame) -> DataFrame:
    """Active guilds for the selector."""
    return queue.filter("is_active").select(
        "guild_name", "world", "is_active", "refresh_interval_minutes",
        "last_refresh_completed_at_utc", "last_refresh_status", "updated_at_utc")


def guilds_of_world(guilds: DataFrame, chosen: DataFrame) -> DataFrame:
    """Each requested (world, guild): the chosen guild when that world
    lists it, else the world's first guild by name."""
    first = guilds.groupBy("world").agg(F.min("guild_name").alias("_first"))
    listed = guilds.select("world", F.col("guild_name").alias("_listed"))
    c = chosen.select("world", F.col("guild_name").alias("requested_guild"))
    j = (c.join(listed, (c.world == listed.world) & (c.requested_guild == listed._listed), "left")
          .drop(listed.world)
          .join(first, "world", "left"))
    return j.select("world", "requested_guild",
                    F.coalesce(F.col("_listed"), F.col("_first")).alias("selected_guild"))


def world_upsert(stored: DataFrame, names: DataFrame, as_of: Column) -> DataFrame:
    """Insert new worlds active; on conflict re-activate and touch the
    update time, keeping the discovery time."""
    n = names.select(F.col("world_name")).distinct().withColumn("_in", F.lit(True))
    j = stored.join(n, "world_name", "full_outer")
    new = F.col("is_active").isNull() & F.col("_in")
    hit = F.coalesce(F.col("_in"), F.lit(False))
    return j.select(
        "world_name",
        F.when(hit, F.lit(True)).otherwise(F.col("is_active")).alias("is_active"),
        F.when(new, as_of).otherwise(F.col("discovered_at_utc")).alias("discovered_at_utc"),
        F.when(hit, as_of).otherwise(F.col("updated_at_utc")).alias("updated_at_utc"))


def guild_upsert(stored: DataFrame, names: DataFrame, as_of: Column) -> DataFrame:
    """Insert new guilds with queue defaults (due now, 'discovered');
    on conflict only re-activate and touch, queue columns kept."""
    key = ["world", "guild_name"]
    n = names.select(*key).distinct().withColumn("_in", F.lit(True))
    j = stored.join(n, key, "full_outer")
    new = F.col("is_active").isNull() & F.col("_in")
    hit = F.coalesce(F.col("_in"), F.lit(False))
    cols = {
        "is_active": F.when(hit, F.lit(True)).otherwise(F.col("is_active")),
        "refresh_interval_minutes": F.when(new, F.lit(DEFAULT_INTERVAL_MINUTES))
                                     .otherwise(F.col("refresh_interval_minutes")),
        "next_refresh_after_utc": F.when(new, as_of).otherwise(F.col("next_refresh_after_utc")),
        "last_refresh_status": F.when(new, F.lit(STATUS_DISCOVERED)).otherwise(F.col("last_refresh_status")),
        "refresh_priority": F.when(new, F.lit(DEFAULT_PRIORITY)).otherwise(F.col("refresh_priority")),
        "discovered_at_utc": F.when(new, as_of).otherwise(F.col("discovered_at_utc")),
        "updated_at_utc": F.when(hit, as_of).otherwise(F.col("updated_at_utc")),
    }
    out_cols = [c for c in QUEUE_COLUMNS if c != "guild_id"]
    return j.select(*[cols[c].alias(c) if c in cols else F.col(c) for c in out_cols])
