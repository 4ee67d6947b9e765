"""Registry of named queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables (through the adapters) and runs over the
whole tables; parameters that are part of a feature (a top-n report, a pair
batch size, a date range, a search string) are fixed here and stated
identically in the oracle SQL.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapwise.operators import activity as AC
from snapwise.operators import changes as CH
from snapwise.operators import pairs as PR
from snapwise.operators import roster as RO
from snapwise.session import fresh_dir
from snapwise.sources import adapters as AD
from snapwise.sources import landing as LD
from snapwise.sources.tables import table_path

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        REGISTRY[name] = fn
        return fn
    return deco


#: Folder of the landed roster by application, input and its time of change.
_LANDED: dict[tuple, str] = {}


def _roster(spark, sf):
    """The stored member snapshots of a set of driver tables.

    As in production, queries read a stored table, lazily: the adapter's output
    is landed once per session and input as Parquet ordered by time, so that
    column pruning and pushed filters (time, world, guild) reach the scan. The
    folder goes when the driver ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table_path(sf, "events"))
    changed = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).getModificationTime()
    key = (spark.sparkContext.applicationId, sf, changed)
    if key not in _LANDED:
        folder = fresh_dir(spark, "roster")
        AD.roster(spark, sf).repartitionByRange("extracted_at_utc", "world", "guild_name", F.xxhash64("character_name")) \
            .sortWithinPartitions("extracted_at_utc", "world", "guild_name").write.parquet(folder)
        _LANDED[key] = folder
    return spark.read.parquet(_LANDED[key])


def _timeline(spark, roster):
    """The member timeline, written once for a query that derives several
    results from it: one window over the members however many there are."""
    folder = fresh_dir(spark, "timeline")
    tl = CH.timeline(roster)
    tl.write.parquet(folder)
    return spark.read.schema(tl.schema).parquet(folder)


# ---------------------------------------------------------------------------
# Pairs and change events (C, E, D24)
# ---------------------------------------------------------------------------

@register("snapshots")
def q_snapshots(spark, sf):
    return PR.snapshots(_roster(spark, sf))


@register("snapshot_pairs")
def q_snapshot_pairs(spark, sf):
    return PR.snapshot_pairs(_roster(spark, sf))


@register("snapshot_pairs_global")
def q_snapshot_pairs_global(spark, sf):
    return PR.snapshot_pairs_global(_roster(spark, sf))


@register("snapshot_ranks")
def q_snapshot_ranks(spark, sf):
    return PR.snapshot_ranks(_roster(spark, sf)).select(
        F.col("snapshot_time").alias("extracted_at_utc"), "snapshot_rank")


@register("level_changes")
def q_level_changes(spark, sf):
    return CH.level_changes(_roster(spark, sf))


@register("member_joins")
def q_member_joins(spark, sf):
    return CH.member_joins(_roster(spark, sf))


@register("member_leaves")
def q_member_leaves(spark, sf):
    return CH.member_leaves(_roster(spark, sf))


@register("rank_changes")
def q_rank_changes(spark, sf):
    return CH.rank_changes(_roster(spark, sf))


@register("level_changes_strict")
def q_level_changes_strict(spark, sf):
    return CH.level_changes_strict(_roster(spark, sf))


@register("level_changes_global_pairs")
def q_level_changes_global_pairs(spark, sf):
    return CH.level_changes_global_pairs(_roster(spark, sf))


@register("level_changes_latest")
def q_level_changes_latest(spark, sf):
    return CH.level_changes_latest(_roster(spark, sf))


def _of_last_pair(spark, sf, events):
    """The events of each guild's newest snapshot pair, from its polls alone."""
    return events(PR.newest_pair_rows(_roster(spark, sf)))


@register("level_changes_last_pair")
def q_level_changes_last_pair(spark, sf):
    """C02 by guild: what changed in each guild's newest pair."""
    return _of_last_pair(spark, sf, CH.level_changes_strict)


@register("rank_changes_last_pair")
def q_rank_changes_last_pair(spark, sf):
    """C11 by guild."""
    return _of_last_pair(spark, sf, CH.rank_changes)


@register("member_joins_latest")
def q_member_joins_latest(spark, sf):
    return CH.member_joins_latest(_roster(spark, sf))


@register("member_leaves_latest")
def q_member_leaves_latest(spark, sf):
    return CH.member_leaves_latest(_roster(spark, sf))


@register("rank_changes_latest")
def q_rank_changes_latest(spark, sf):
    return CH.rank_changes_latest(_roster(spark, sf))


# ---------------------------------------------------------------------------
# Activity (C12, C13, D05-D08)
# ---------------------------------------------------------------------------

@register("online_intervals")
def q_online_intervals(spark, sf):
    return AC.online_intervals(_roster(spark, sf))


@register("online_intervals_cap720")
def q_online_intervals_cap720(spark, sf):
    return AC.online_intervals(_roster(spark, sf), cap=720)


@register("online_intervals_dense")
def q_online_intervals_dense(spark, sf):
    return AC.online_intervals_dense(_roster(spark, sf))


@register("online_minutes_by_day")
def q_online_minutes_by_day(spark, sf):
    return AC.minutes_by_day(AC.online_intervals(_roster(spark, sf)))


@register("online_minutes_total")
def q_online_minutes_total(spark, sf):
    return AC.minutes_total(AC.online_intervals(_roster(spark, sf)))


@register("online_minutes_fractional")
def q_online_minutes_fractional(spark, sf):
    return AC.online_minutes_fractional(_roster(spark, sf), cap=720)


@register("last_online")
def q_last_online(spark, sf):
    return AC.last_online_snapshot(_roster(spark, sf))


@register("last_online_interval")
def q_last_online_interval(spark, sf):
    return AC.last_online_interval(AC.online_intervals(_roster(spark, sf)))


@register("level_changes_alltime_minutes")
def q_level_changes_alltime_minutes(spark, sf):
    r = _roster(spark, sf)
    return CH.level_changes_alltime_minutes(r, AC.minutes_total(AC.online_intervals(r)))


# ---------------------------------------------------------------------------
# Latest state and overviews
# ---------------------------------------------------------------------------

def _latest_members(spark, sf):
    r = _roster(spark, sf)
    tl = CH.timeline(r)
    return RO.latest_members(r, AC.intervals_from(tl), CH.level_changes_from(tl))


@register("latest_members")
def q_latest_members(spark, sf):
    return _latest_members(spark, sf)


@register("latest_roster_global")
def q_latest_roster_global(spark, sf):
    return RO.latest_roster_global(_roster(spark, sf))


@register("latest_roster_by_guild")
def q_latest_roster_by_guild(spark, sf):
    return RO.latest_roster_by_guild(_roster(spark, sf))


@register("overview_by_snapshot")
def q_overview_by_snapshot(spark, sf):
    return RO.overview_by_snapshot(_roster(spark, sf), 1)


@register("overview_by_snapshot_r0")
def q_overview_by_snapshot_r0(spark, sf):
    return RO.overview_by_snapshot(_roster(spark, sf), 0)


@register("overview_latest")
def q_overview_latest(spark, sf):
    return RO.overview_latest(_roster(spark, sf))


@register("date_bounds")
def q_date_bounds(spark, sf):
    return RO.date_bounds(_roster(spark, sf))


@register("date_bounds_global")
def q_date_bounds_global(spark, sf):
    return RO.date_bounds_global(_roster(spark, sf))


@register("vocation_summary")
def q_vocation_summary(spark, sf):
    return RO.vocation_summary(RO.latest_roster_global(_roster(spark, sf)))


@register("level_bands")
def q_level_bands(spark, sf):
    return RO.level_bands(RO.latest_roster_global(_roster(spark, sf)))


@register("top_characters")
def q_top_characters(spark, sf):
    return RO.latest_roster_global(_roster(spark, sf))


@register("vocation_rows")
def q_vocation_rows(spark, sf):
    return RO.vocation_rows(_latest_members(spark, sf))


@register("level_range")
def q_level_range(spark, sf):
    return RO.vocation_rows(_latest_members(spark, sf), min_level=100, max_level=300)


@register("vocation_pie")
def q_vocation_pie(spark, sf):
    return RO.vocation_pie(RO.vocation_rows(_latest_members(spark, sf)))


def queries() -> dict[str, QueryFn]:
    return dict(REGISTRY)


# ---------------------------------------------------------------------------
# Panels, filters, orders, top-n
# ---------------------------------------------------------------------------
from snapwise.operators import panels as PN  # noqa: E402

# Fixed panel parameters (stated identically in the oracle).
RANGE_START, RANGE_END = "2024-01-10", "2024-01-20"
SCOPE_WORLD, SCOPE_GUILD = "w0", "g1"
NAME_SEARCH = " C1 "
VOCATION_SELECTION = ["Knight", "Paladin"]


def _tl(spark, sf):
    return CH.timeline(_roster(spark, sf))


@register("range_ts")
def q_range_ts(spark, sf):
    r = PR.around_range(_roster(spark, sf), RANGE_START, RANGE_END)
    return PN.filter_ts_range(CH.level_changes(r), RANGE_START, RANGE_END)


@register("range_date")
def q_range_date(spark, sf):
    r = PR.around_range(_roster(spark, sf), RANGE_START, RANGE_END)
    return PN.filter_date_range(AC.minutes_by_day(AC.online_intervals(r)), RANGE_START, RANGE_END)


@register("default_range")
def q_default_range(spark, sf):
    return PN.default_range(RO.date_bounds(_roster(spark, sf)))


@register("scope_filter")
def q_scope_filter(spark, sf):
    return PN.scope_filter(CH.level_changes(_roster(spark, sf)), SCOPE_WORLD, SCOPE_GUILD)


@register("pairs_scoped")
def q_pairs_scoped(spark, sf):
    return PR.snapshot_pairs(PR.scope(_roster(spark, sf), world="w1"))


@register("name_contains")
def q_name_contains(spark, sf):
    return PN.name_contains(_latest_members(spark, sf), NAME_SEARCH)


@register("vocation_in")
def q_vocation_in(spark, sf):
    return PN.vocation_in(RO.vocation_rows(_latest_members(spark, sf)), VOCATION_SELECTION)


@register("level_panel")
def q_level_panel(spark, sf):
    tl = _timeline(spark, PR.around_range(_roster(spark, sf), RANGE_START, RANGE_END))
    daily = AC.minutes_by_day(AC.intervals_from(tl))
    return PN.level_panel(CH.level_changes_from(tl), daily, RANGE_START, RANGE_END)


@register("panel_level")
def q_panel_level(spark, sf):
    return PN.ranked(CH.level_changes(_roster(spark, sf)),
                     [F.col("latest_snapshot_time").desc(), F.col("level_gain").desc_nulls_first(),
                      F.col("current_level").desc_nulls_first(), F.col("character_name").asc()])


@register("panel_joins")
def q_panel_joins(spark, sf):
    return PN.ranked(CH.member_joins(_roster(spark, sf)),
                     [F.col("latest_snapshot_time").desc(), F.col("level").desc_nulls_first(),
                      F.col("character_name").asc()])


@register("panel_leaves")
def q_panel_leaves(spark, sf):
    return PN.ranked(CH.member_leaves(_roster(spark, sf)),
                     [F.col("latest_snapshot_time").desc(), F.col("level").desc_nulls_first(),
                      F.col("character_name").asc()])


@register("panel_rank_changes")
def q_panel_rank_changes(spark, sf):
    return PN.ranked(CH.rank_changes(_roster(spark, sf)),
                     [F.col("latest_snapshot_time").desc(), F.col("character_name").asc()])


@register("panel_members")
def q_panel_members(spark, sf):
    return PN.ranked(_latest_members(spark, sf),
                     [F.col("current_level").desc_nulls_first(), F.col("character_name").asc()])


@register("panel_daily_minutes")
def q_panel_daily_minutes(spark, sf):
    return PN.ranked(AC.minutes_by_day(AC.online_intervals(_roster(spark, sf))),
                     [F.col("activity_date").desc(), F.col("character_name").asc()])


@register("sort_panel")
def q_sort_panel(spark, sf):
    m = _latest_members(spark, sf)
    order = PN.sort_any(m, "last_connected_at", ascending=False,
                        tie=[F.col("current_level").desc_nulls_first(), F.col("character_name").asc()])
    return PN.ranked(m, order, rank_col="sort_rank")


@register("top_level_gains")
def q_top_level_gains(spark, sf):
    return PN.top_n(CH.level_changes(_roster(spark, sf)),
                    [F.col("level_gain").desc_nulls_first(), F.col("current_level").desc_nulls_first(),
                     F.col("latest_snapshot_time").desc(), F.col("world"), F.col("guild_name"),
                     F.col("character_name")], 25)


@register("top_joins")
def q_top_joins(spark, sf):
    return PN.top_n(CH.member_joins(_roster(spark, sf)),
                    [F.col("level").desc_nulls_first(), F.col("character_name"),
                     F.col("latest_snapshot_time").desc(), F.col("world"), F.col("guild_name")], 20)


@register("top_leaves")
def q_top_leaves(spark, sf):
    return PN.top_n(CH.member_leaves(_roster(spark, sf)),
                    [F.col("level").desc_nulls_first(), F.col("character_name"),
                     F.col("previous_snapshot_time").desc(), F.col("world"), F.col("guild_name")], 20)


@register("top_rank_changes")
def q_top_rank_changes(spark, sf):
    return PN.top_n(CH.rank_changes(_roster(spark, sf)),
                    [F.col("character_name"), F.col("latest_snapshot_time"), F.col("world"),
                     F.col("guild_name")], 20)


def _event_frames(spark, sf):
    r = _roster(spark, sf)
    tl = _timeline(spark, r)
    return r, {
        "level_changes": CH.level_changes_from(tl),
        "guild_joins": CH.joins_from(tl),
        "guild_leaves": CH.leaves_from(tl),
        "rank_changes": CH.rank_changes_from(tl),
    }


@register("change_counts")
def q_change_counts(spark, sf):
    r, frames = _event_frames(spark, sf)
    frames = {"member_snapshots": r, "snapshots": PR.snapshots(r), **frames}
    return PN.tagged_counts(frames)


@register("api_summary")
def q_api_summary(spark, sf):
    r, frames = _event_frames(spark, sf)
    counts = PN.one_row_join([df.agg(F.count(F.lit(1)).alias(f"{name}_count"))
                              for name, df in frames.items()])
    return PN.api_summary(PR.snapshot_ranks(r), counts)


# ---------------------------------------------------------------------------
# Market (A09, B10, B11, B14, B15, C18, C26, C27, D15-D17, E05, F07, F13, K08, K12, K19)
# ---------------------------------------------------------------------------
from snapwise.operators import market as MK  # noqa: E402

MARKET_AS_OF = "2024-01-30 12:00:00"
MARKET_SEARCH = "ring"
MARKET_DUE_RANGE = ("2024-01-29", "2024-01-30")


def _valid(spark, sf):
    return MK.valid_observations(AD.market_observations(spark, sf))


def _daily(spark, sf):
    return MK.daily_merge(_valid(spark, sf))


def _stored_history(spark, sf):
    """Daily history with the deterministic load time of the adapters."""
    d = _daily(spark, sf)
    return d.withColumn("loaded_at_utc", MK.loaded_at(F.col("observed_at_utc")))


def _as_of():
    return F.lit(MARKET_AS_OF).cast("timestamp_ntz")


@register("market_valid")
def q_market_valid(spark, sf):
    return _valid(spark, sf)


@register("market_daily")
def q_market_daily(spark, sf):
    return _daily(spark, sf)


@register("market_dedupe_daily")
def q_market_dedupe_daily(spark, sf):
    v = _valid(spark, sf).withColumn("loaded_at_utc", MK.loaded_at(F.col("observed_at_utc")))
    return MK.dedupe_daily(v)


@register("market_upsert")
def q_market_upsert(spark, sf):
    v = _valid(spark, sf)
    stored = MK.daily_merge(v.filter(F.col("observed_at_utc") < AD.ts_lit(AD.MARKET_STORED_BEFORE)))
    incoming = MK.daily_merge(v.filter(F.col("observed_at_utc") >= AD.ts_lit(AD.MARKET_INCOMING_FROM)))
    return MK.upsert_keep_valid(stored, incoming)


@register("market_two_loads")
def q_market_two_loads(spark, sf):
    """Stored market history after two overlapping loads, the second given twice."""
    from snapwise.plans.state_jobs import MarketJobs
    jobs = MarketJobs(spark, fresh_dir(spark, "market"))
    v = _valid(spark, sf)
    first = v.filter(F.col("observed_at_utc") < AD.ts_lit(AD.MARKET_STORED_BEFORE))
    second = v.filter(F.col("observed_at_utc") >= AD.ts_lit(AD.MARKET_INCOMING_FROM))
    for part in (first, second, second):
        rows = jobs.load(part)
    return jobs.history(rows)


@register("panel_market")
def q_panel_market(spark, sf):
    """One item's history on one world within a range of days, in time order."""
    history = MK.api_market_history(_daily(spark, sf), AD.market_items(spark, sf))
    busiest = history.groupBy("world", "item_id").agg(F.count("*").alias("n")) \
        .orderBy(F.desc("n"), "world", "item_id").limit(1).select("world", "item_id")
    t = F.col("observed_at_utc")
    one = history.join(busiest, ["world", "item_id"]).filter(
        (t >= AD.ts_lit("2024-01-05 00:00:00")) & (t < AD.ts_lit("2024-01-21 00:00:00")))
    return one.select(*history.columns).orderBy("observed_at_utc")


@register("api_market_items")
def q_api_market_items(spark, sf):
    return MK.api_market_items(AD.market_items(spark, sf))


@register("api_market_history")
def q_api_market_history(spark, sf):
    return MK.api_market_history(_daily(spark, sf), AD.market_items(spark, sf))


@register("item_search")
def q_item_search(spark, sf):
    return MK.item_search(AD.market_items(spark, sf), MARKET_SEARCH)


@register("item_resolve")
def q_item_resolve(spark, sf):
    items = AD.market_items(spark, sf)
    requests = (items.select(F.col("name").alias("item_name"))
                     .unionByName(items.select(F.upper("wiki_name").alias("item_name"))))
    return MK.item_resolve(requests, items)


@register("market_request_check")
def q_market_request_check(spark, sf):
    from snapwise.sources.tables import read_table
    requested = (AD.market_observations(spark, sf).select("item_id")
                 .unionByName(read_table(spark, sf, "customer").select(F.col("c_custkey").alias("item_id"))))
    return MK.request_check(requested, AD.market_items(spark, sf))


@register("market_summary")
def q_market_summary(spark, sf):
    return MK.market_summary(MK.api_market_history(_daily(spark, sf), AD.market_items(spark, sf)))


@register("market_freshness")
def q_market_freshness(spark, sf):
    return MK.freshness(_stored_history(spark, sf), _as_of())


@register("history_days")
def q_history_days(spark, sf):
    from snapwise.functions.exprs import history_days
    first = _daily(spark, sf).groupBy("world", "item_id").agg(F.min("observed_date").alias("start_date"))
    return first.withColumn("days", history_days(F.col("start_date"), _as_of()))


@register("market_due")
def q_market_due(spark, sf):
    requests = AD.market_observations(spark, sf).select("world", "item_id")
    return MK.due_loads(requests, _stored_history(spark, sf), _as_of(), *MARKET_DUE_RANGE)


@register("items_upsert")
def q_items_upsert(spark, sf):
    items = AD.market_items(spark, sf)
    incoming = items.filter(F.col("tier") > 25).withColumn("name", F.upper("name"))
    return MK.items_upsert(items, incoming)


# ---------------------------------------------------------------------------
# Refresh queue and discovery
# ---------------------------------------------------------------------------
from snapwise.operators import refresh_queue as RQ  # noqa: E402
from snapwise.sources import discovery as DS  # noqa: E402

CLAIM_WORLD, CLAIM_BATCH = "NATION_1", 25
RESET_WORLD, RESET_MINUTES = "NATION_2", 30
FORCE_WORLD = "NATION_3"
CHOSEN_GUILD = "Customer#000000001"


def _q_as_of():
    return F.lit(AD.QUEUE_AS_OF).cast("timestamp_ntz")


def _queue(spark, sf):
    return AD.guild_queue(spark, sf)


def _worlds_table(spark, sf):
    """Stored worlds: region names, inactive, known since the epoch."""
    from snapwise.sources.tables import read_table
    epoch = F.lit(RQ.EPOCH).cast("timestamp_ntz")
    return read_table(spark, sf, "region").select(
        F.col("r_name").alias("world_name"), F.lit(False).alias("is_active"),
        epoch.alias("discovered_at_utc"), epoch.alias("updated_at_utc"))


def _upserted_worlds(spark, sf):
    names = DS.discover_worlds(DS.world_payloads(spark, sf))
    return RQ.world_upsert(_worlds_table(spark, sf), names, _q_as_of())


@register("due_entities")
def q_due_entities(spark, sf):
    return RQ.due_entities(_queue(spark, sf), _q_as_of(), CLAIM_BATCH, CLAIM_WORLD)


@register("queue_claim")
def q_queue_claim(spark, sf):
    q = _queue(spark, sf)
    return RQ.claim(q, RQ.due_entities(q, _q_as_of(), CLAIM_BATCH, CLAIM_WORLD), _q_as_of())


@register("queue_outcomes")
def q_queue_outcomes(spark, sf):
    q = _queue(spark, sf)
    outcomes = q.filter(F.col("last_refresh_status") == RQ.STATUS_RUNNING).select(
        "guild_id", F.col("is_active").alias("succeeded"),
        F.repeat(F.col("guild_name"), 60).alias("error_message"))
    return RQ.apply_outcomes(q, outcomes, _q_as_of())


@register("queue_release_stale")
def q_queue_release_stale(spark, sf):
    return RQ.release_stale(_queue(spark, sf), _q_as_of())


@register("queue_two_runs")
def q_queue_two_runs(spark, sf):
    """Stored queue over two runs: a claim, the outcomes of two in three of the
    claimed guilds, and 20 minutes later the release of what still runs."""
    from snapwise.plans.state_jobs import QueueJobs
    jobs = QueueJobs(spark, fresh_dir(spark, "queue"))
    jobs.load(_queue(spark, sf))
    claimed = jobs.claim(_q_as_of(), CLAIM_BATCH, CLAIM_WORLD)
    jobs.outcomes(claimed.filter("guild_id % 3 > 0").select(
        "guild_id", (F.col("guild_id") % 3 == 1).alias("succeeded"),
        F.repeat(F.col("guild_name"), 60).alias("error_message")), _q_as_of())
    return jobs.release_stale(F.timestamp_add("MINUTE", F.lit(20), _q_as_of()))


@register("queue_reset_interval")
def q_queue_reset_interval(spark, sf):
    return RQ.reset_interval(_queue(spark, sf), RESET_WORLD, _q_as_of(), RESET_MINUTES)


@register("queue_force_due")
def q_queue_force_due(spark, sf):
    q = _queue(spark, sf)
    names = q.filter((F.col("world") == FORCE_WORLD) & (F.col("refresh_priority") == AD.QUEUE_PRIORITY_BUILDING))
    return RQ.force_due(q, names, _q_as_of())


@register("queue_status")
def q_queue_status(spark, sf):
    return RQ.status_board(_queue(spark, sf), 50)


@register("queue_stuck")
def q_queue_stuck(spark, sf):
    return RQ.stuck_runs(_queue(spark, sf), _q_as_of())


@register("api_worlds")
def q_api_worlds(spark, sf):
    return RQ.api_worlds(_upserted_worlds(spark, sf))


@register("api_guilds")
def q_api_guilds(spark, sf):
    return RQ.api_guilds(_queue(spark, sf))


@register("guilds_of_world")
def q_guilds_of_world(spark, sf):
    from snapwise.sources.tables import read_table
    chosen = read_table(spark, sf, "nation").select(
        F.col("n_name").alias("world"), F.lit(CHOSEN_GUILD).alias("guild_name"))
    return RQ.guilds_of_world(RQ.api_guilds(_queue(spark, sf)), chosen)


@register("world_upsert")
def q_world_upsert(spark, sf):
    return _upserted_worlds(spark, sf)


@register("guild_upsert")
def q_guild_upsert(spark, sf):
    from snapwise.sources.tables import read_table
    found = DS.discover_guilds(DS.guild_payloads(spark, sf))
    sup = read_table(spark, sf, "supplier")
    nation = read_table(spark, sf, "nation")
    extra = sup.join(F.broadcast(nation), sup.s_nationkey == nation.n_nationkey).select(
        F.col("n_name").alias("world"), F.col("s_name").alias("guild_name"))
    return RQ.guild_upsert(_queue(spark, sf), found.unionByName(extra), _q_as_of())


@register("discover_worlds")
def q_discover_worlds(spark, sf):
    return DS.discover_worlds(DS.world_payloads(spark, sf))


@register("discover_guilds")
def q_discover_guilds(spark, sf):
    return DS.discover_guilds(DS.guild_payloads(spark, sf))


@register("discover_worlds_top")
def q_discover_worlds_top(spark, sf):
    return DS.first_names(DS.discover_worlds(DS.world_payloads(spark, sf)), "world_name", 3)


# ---------------------------------------------------------------------------
# Quality checks
# ---------------------------------------------------------------------------
from snapwise.operators import quality as QA  # noqa: E402

CACHE_CUTOFF = "2024-01-25 00:00:00"


def _stale_cache(spark, sf):
    """A latest-members cache last refreshed before CACHE_CUTOFF."""
    r = _roster(spark, sf).filter(F.col("extracted_at_utc") < AD.ts_lit(CACHE_CUTOFF))
    return RO.latest_roster_by_guild(r)


@register("freshness_check")
def q_freshness_check(spark, sf):
    return QA.freshness_check(_roster(spark, sf), _stale_cache(spark, sf))


@register("roster_diff")
def q_roster_diff(spark, sf):
    return QA.roster_diff(RO.latest_roster_by_guild(_roster(spark, sf)), _stale_cache(spark, sf))


@register("snapshot_freshness")
def q_snapshot_freshness(spark, sf):
    return QA.snapshot_freshness(_roster(spark, sf), 50)


@register("dup_check")
def q_dup_check(spark, sf):
    return QA.dup_check(_roster(spark, sf), ["guild_name", "world", "character_name", "extracted_at_utc"])


@register("dup_check_replayed")
def q_dup_check_replayed(spark, sf):
    """D20 on a table that took a delivery twice, without the insert guard."""
    r = _roster(spark, sf)
    again = r.filter(F.col("extracted_at_utc") >= AD.ts_lit("2024-01-28 00:00:00"))
    return QA.dup_check(r.unionByName(again), ["guild_name", "world", "character_name", "extracted_at_utc"])


@register("snapshot_inventory")
def q_snapshot_inventory(spark, sf):
    return QA.snapshot_inventory(_roster(spark, sf))


@register("snapshot_count")
def q_snapshot_count(spark, sf):
    return QA.snapshot_count(_roster(spark, sf))


@register("latest_snapshot_rows")
def q_latest_snapshot_rows(spark, sf):
    return QA.latest_snapshot_rows(_roster(spark, sf))


@register("object_counts")
def q_object_counts(spark, sf):
    r = _roster(spark, sf)
    tl = _timeline(spark, r)
    iv = AC.intervals_from(tl)
    lc = CH.level_changes_from(tl)
    frames = {
        "guild_member_snapshot": r,
        "snapshot_pairs": PR.snapshot_pairs(r),
        "level_changes": lc,
        "guild_joins": CH.joins_from(tl),
        "guild_leaves": CH.leaves_from(tl),
        "rank_changes": CH.rank_changes_from(tl),
        "online_intervals": iv,
        "online_minutes_by_day": AC.minutes_by_day(iv),
        "online_minutes_total": AC.minutes_total(iv),
        "latest_guild_members": RO.latest_members(r, iv, lc),
    }
    return PN.tagged_counts(frames, name_col="object_name", value_col="row_count")


# ---------------------------------------------------------------------------
# Sources: raw documents, flatten, cleaning, catalogue and history loads
# (A01-A05, A08-A10, B01, B16, F01, F02, F12)
# ---------------------------------------------------------------------------
from snapwise.functions import exprs as FX  # noqa: E402
from snapwise.sources import market_load as ML  # noqa: E402
from snapwise.sources import raw as RW  # noqa: E402

INSERT_STORED_BEFORE = "2024-01-20 00:00:00"
INSERT_INCOMING_FROM = "2024-01-15 00:00:00"


def _landed_tree(spark, sf):
    """The roster landed as a tree of one document per file."""
    path = RW.fresh_dir(spark, "raw")
    LD.land(RW.envelopes_from_roster(_roster(spark, sf)), path)
    return path


def _landed_envelopes(spark, sf):
    """Documents written to their files in a fresh tree, read back with the schema."""
    return LD.scan(spark, _landed_tree(spark, sf))


@register("raw_scan")
def q_raw_scan(spark, sf):
    return RW.flatten(_landed_envelopes(spark, sf), clean=False)


@register("raw_scan_days")
def q_raw_scan_days(spark, sf):
    """A01 with a time filter: only the folders of the days are read."""
    docs = LD.scan(spark, _landed_tree(spark, sf), RW.SOURCE_NAME, dt.date(2024, 1, 10), dt.date(2024, 1, 12))
    return RW.flatten(docs, clean=False)


@register("raw_listing")
def q_raw_listing(spark, sf):
    """Newest landed time and number of documents by source and entity, from
    the folder listing."""
    return LD.listing(spark, _landed_tree(spark, sf)).groupBy("source", "slug").agg(
        F.max("written_at").alias("newest"), F.count(F.lit(1)).alias("documents"))


@register("raw_variant")
def q_raw_variant(spark, sf):
    """Raw documents stored with a VARIANT column, flattened from it."""
    folder = RW.fresh_dir(spark, "variant")
    RW.variant_table(RW.raw_table(RW.envelopes_from_roster(_roster(spark, sf)))).write.parquet(folder)
    return RW.flatten_variant(spark.read.parquet(folder))


@register("raw_sink_roundtrip")
def q_raw_sink_roundtrip(spark, sf):
    env = _landed_envelopes(spark, sf)
    return env.groupBy(F.col("metadata.entity_name").alias("guild_name"),
                       F.col("data.guild.world").alias("world"),
                       RW.parse_iso_utc(F.col("metadata.extracted_at_utc")).alias("extracted_at_utc")).agg(
        F.sum(F.size("data.guild.members")).cast("bigint").alias("member_count"))


@register("raw_latest_file")
def q_raw_latest_file(spark, sf):
    """The newest path comes from the listing; only that file is opened."""
    folder = _landed_tree(spark, sf)
    newest = LD.newest_path(spark, folder)
    day = dt.date(*map(int, newest.split("/")[-4:-1]))
    return LD.scan(spark, folder, since=day, until=day).filter(F.col("raw_path") == newest).select(
        "raw_path", F.col("metadata.entity_name").alias("guild_name"),
        RW.parse_iso_utc(F.col("metadata.extracted_at_utc")).alias("extracted_at_utc"))


@register("raw_latest_per_entity")
def q_raw_latest_per_entity(spark, sf):
    env = _landed_envelopes(spark, sf)
    t = RW.parse_iso_utc(F.col("metadata.extracted_at_utc"))
    return env.groupBy(F.col("metadata.entity_name").alias("guild_name")).agg(
        F.max(t).alias("extracted_at_utc"))


@register("raw_table")
def q_raw_table(spark, sf):
    raw = RW.raw_table(RW.envelopes_from_roster(_roster(spark, sf)))
    members = F.size(F.from_json("raw_json", RW.ENVELOPE).getField("data").getField("guild")
                     .getField("members"))
    return raw.groupBy("snapshot_id", "guild_name", "source", "extracted_at_utc").agg(
        F.sum(members).cast("bigint").alias("member_count"))


@register("roster_flatten")
def q_roster_flatten(spark, sf):
    return RW.flatten(RW.envelopes_from_roster(_roster(spark, sf)), clean=False)


@register("roster_clean")
def q_roster_clean(spark, sf):
    return RW.flatten(RW.envelopes_from_roster(_roster(spark, sf)), clean=True)


@register("stg_roster")
def q_stg_roster(spark, sf):
    return RW.staging(_roster(spark, sf))


@register("joined_parse")
def q_joined_parse(spark, sf):
    d = _roster(spark, sf).select("joined").distinct()
    texts = d.select(F.explode(F.array(
        F.date_format("joined", "yyyy-MM-dd"), F.date_format("joined", "MMM d yyyy"),
        F.concat(F.lit("day "), F.date_format("joined", "D")))).alias("joined_text"))
    return texts.distinct().select("joined_text", FX.parse_joined_date("joined_text").alias("joined_date"))


@register("base_vocation")
def q_base_vocation(spark, sf):
    v = _roster(spark, sf).select("vocation").distinct()
    return v.select("vocation", FX.base_vocation("vocation").alias("base_vocation"))


@register("slug")
def q_slug(spark, sf):
    g = _roster(spark, sf).select("guild_name").distinct()
    return g.select("guild_name", FX.slug("guild_name").alias("slug"))


@register("market_items_load")
def q_market_items_load(spark, sf):
    path = RW.fresh_dir(spark, "items")
    ML.item_documents(AD.market_items(spark, sf)).write.json(path)
    return ML.load_market_items(spark, path)


@register("market_history_load")
def q_market_history_load(spark, sf):
    path = RW.fresh_dir(spark, "history")
    ML.history_documents(AD.market_observations(spark, sf)).write.json(path)
    return MK.valid_observations(ML.load_market_history(spark, path))


@register("member_insert_ignore")
def q_member_insert_ignore(spark, sf):
    r = _roster(spark, sf)
    key = ["guild_name", "world", "character_name", "extracted_at_utc"]
    stored = r.filter(F.col("extracted_at_utc") < AD.ts_lit(INSERT_STORED_BEFORE))
    incoming = r.filter(F.col("extracted_at_utc") >= AD.ts_lit(INSERT_INCOMING_FROM))
    incoming = incoming.unionByName(incoming)  # a replayed batch
    return stored.unionByName(RW.insert_ignore(stored, incoming, key))


# ---------------------------------------------------------------------------
# Incremental jobs as queries over derived state
# State per FIXTURES 4.5: the ledger holds every pair whose latest snapshot is
# before LEDGER_SEED_BEFORE, the stored results are those pairs' results; the
# increment processes the oldest DEFAULT_PAIR_LIMIT remaining pairs.
# ---------------------------------------------------------------------------
from snapwise.plans import incremental as INC  # noqa: E402

INC_AS_OF = "2024-01-31 00:00:00"


def _inc_as_of():
    return F.lit(INC_AS_OF).cast("timestamp_ntz")


def _seed(spark, sf, dense=False):
    r = _roster(spark, sf)
    tl = _timeline(spark, r)
    seed_pairs = PR.snapshot_pairs(r).filter(F.col("latest_snapshot_time") < AD.ts_lit(AD.LEDGER_SEED_BEFORE))
    ledger = seed_pairs.withColumn("processed_at_utc", AD.ts_lit(AD.LEDGER_SEED_BEFORE))
    iv_all = AC.dense_intervals_from(tl) if dense else AC.intervals_from(tl)
    iv = iv_all.join(seed_pairs, PR.PAIR_KEY, "left_semi")
    online = INC.OnlineState(iv, AC.minutes_by_day(iv, keep_zero=dense), AC.minutes_total(iv, keep_zero=dense),
                             ledger)
    return r, tl, seed_pairs, online


def _online_inc(spark, sf, dense=False):
    r, _, _, state = _seed(spark, sf, dense)
    return INC.online_increment(r, state, _inc_as_of(), AD.DEFAULT_PAIR_LIMIT, dense=dense)


def _general_inc(spark, sf):
    r, tl, seed_pairs, online = _seed(spark, sf)
    online_after = INC.online_increment(r, online, _inc_as_of(), AD.DEFAULT_PAIR_LIMIT).state
    semi = lambda df: df.join(seed_pairs, PR.PAIR_KEY, "left_semi")
    stored_lc = semi(CH.level_changes_from(tl))
    r_old = r.filter(F.col("extracted_at_utc") < AD.ts_lit(AD.LEDGER_SEED_BEFORE))
    state = INC.GeneralState(
        pairs=seed_pairs, level_changes=stored_lc, joins=semi(CH.joins_from(tl)),
        leaves=semi(CH.leaves_from(tl)), rank_changes=semi(CH.rank_changes_from(tl)),
        latest_members=RO.latest_members(r_old, online.intervals, stored_lc),
        ledger=online.ledger, intervals=online_after.intervals)
    return INC.general_increment(r, state, _inc_as_of(), AD.DEFAULT_PAIR_LIMIT)


@register("due_pairs")
def q_due_pairs(spark, sf):
    r, _, _, state = _seed(spark, sf)
    return PR.due_pairs(r, state.ledger, AD.DEFAULT_PAIR_LIMIT)


@register("ledger_seed")
def q_ledger_seed(spark, sf):
    _, tl, _, _ = _seed(spark, sf, dense=True)
    stored = AC.dense_intervals_from(tl).filter(
        F.col("latest_snapshot_time") < AD.ts_lit(AD.LEDGER_SEED_BEFORE))
    return INC.seed_ledger(stored, AD.ts_lit(AD.LEDGER_SEED_BEFORE))


@register("inc_online_intervals")
def q_inc_online_intervals(spark, sf):
    return _online_inc(spark, sf).state.intervals


@register("inc_online_days")
def q_inc_online_days(spark, sf):
    return _online_inc(spark, sf).state.days


@register("inc_online_totals")
def q_inc_online_totals(spark, sf):
    return _online_inc(spark, sf).state.totals


@register("inc_online_ledger")
def q_inc_online_ledger(spark, sf):
    return _online_inc(spark, sf).state.ledger


@register("inc_online_report")
def q_inc_online_report(spark, sf):
    return _online_inc(spark, sf).report


@register("inc_online_dense")
def q_inc_online_dense(spark, sf):
    return _online_inc(spark, sf, dense=True).state.intervals


@register("affected_recompute")
def q_affected_recompute(spark, sf):
    """The day totals recomputed for the keys an increment touched."""
    inc = _online_inc(spark, sf)
    new_iv = inc.state.intervals.join(inc.due.select(*PR.PAIR_KEY), PR.PAIR_KEY, "left_semi")
    keys = new_iv.select(*INC.MEMBER_KEY, F.to_date("latest_snapshot_time").alias("activity_date")).distinct()
    return inc.state.days.join(keys, INC.DAY_KEY, "left_semi")


@register("inc_general_pairs")
def q_inc_general_pairs(spark, sf):
    return _general_inc(spark, sf).state.pairs


@register("inc_general_level_changes")
def q_inc_general_level_changes(spark, sf):
    return _general_inc(spark, sf).state.level_changes


@register("inc_general_joins")
def q_inc_general_joins(spark, sf):
    return _general_inc(spark, sf).state.joins


@register("inc_general_leaves")
def q_inc_general_leaves(spark, sf):
    return _general_inc(spark, sf).state.leaves


@register("inc_general_rank_changes")
def q_inc_general_rank_changes(spark, sf):
    return _general_inc(spark, sf).state.rank_changes


@register("inc_general_latest_members")
def q_inc_general_latest_members(spark, sf):
    return _general_inc(spark, sf).state.latest_members


@register("inc_general_ledger")
def q_inc_general_ledger(spark, sf):
    return _general_inc(spark, sf).state.ledger


@register("inc_general_report")
def q_inc_general_report(spark, sf):
    return _general_inc(spark, sf).report


@register("insert_guard")
def q_insert_guard(spark, sf):
    """C20: guarded append of every level change over the stored ones."""
    from snapwise.plans.upsert import guarded_append
    r, tl, seed_pairs, _ = _seed(spark, sf)
    all_lc = CH.level_changes_from(tl)
    stored = all_lc.join(seed_pairs, PR.PAIR_KEY, "left_semi")
    return guarded_append(stored, all_lc, INC.INTERVAL_KEY)


@register("upsert_generic")
def q_upsert_generic(spark, sf):
    """Stale all-time totals upserted with a full recompute."""
    from snapwise.plans.upsert import upsert
    r, tl, _, state = _seed(spark, sf)
    return upsert(state.totals, AC.minutes_total(AC.intervals_from(tl)), INC.MEMBER_KEY)


# ---------------------------------------------------------------------------
# Retention, migrations, rebuilds
# ---------------------------------------------------------------------------
from snapwise.plans import rebuild as RB  # noqa: E402
from snapwise.plans import retention as RT  # noqa: E402

CASCADE_AS_OF = "2024-04-20 00:00:00"
REBUILD_WORLD, REBUILD_GUILD = "w0", "g1"


def _retention(spark, sf):
    r = _roster(spark, sf)
    tables = RB.rebuild_all(r, timeline=_timeline(spark, r))
    tables["members"] = r
    tables["raw"] = PR.snapshots(r)
    return RT.apply_retention(tables)


@register("retention_report")
def q_retention_report(spark, sf):
    return _retention(spark, sf)[1]


@register("retention_kept")
def q_retention_kept(spark, sf):
    return _retention(spark, sf)[0]["members"]


@register("retention_check")
def q_retention_check(spark, sf):
    kept = _retention(spark, sf)[0]
    return QA.table_ranges({
        "guild_member_snapshot": (kept["members"], "extracted_at_utc"),
        "raw_guild_snapshot": (kept["raw"], "extracted_at_utc"),
        "character_online_intervals_cache": (kept["intervals"], "latest_snapshot_time"),
        "character_level_changes_with_online_cache": (kept["level_changes"], "latest_snapshot_time"),
        "snapshot_pairs_api_cache": (kept["pairs"], "latest_snapshot_time"),
    })


API_DATABASE = "snapwise_api"


def _served(spark, sf):
    """Catalog views over stored tables that the jobs have filled."""
    from snapwise.plans import serving as SV
    from snapwise.plans.state_jobs import MarketJobs, QueueJobs
    jobs, queue, market = _drained(spark, sf), QueueJobs(spark, fresh_dir(spark, "queue")), MarketJobs(spark, fresh_dir(spark, "market"))
    queue.load(_queue(spark, sf))
    queue.discover_worlds(_worlds_table(spark, sf), DS.discover_worlds(DS.world_payloads(spark, sf)), _q_as_of())
    market.load_items(AD.market_items(spark, sf))
    market.load(_valid(spark, sf))
    return SV.create_api_views(spark, API_DATABASE, jobs.store.root, queue.store.root, market.store.root)


@register("api_views")
def q_api_views(spark, sf):
    """Rows behind each of the 13 serving views, read through its name."""
    return PN.tagged_counts({n: spark.table(f"{API_DATABASE}.{n}") for n in _served(spark, sf)},
                            name_col="view_name", value_col="row_count")


@register("api_views_contract")
def q_api_views_contract(spark, sf):
    """The columns that the catalog gives for each view."""
    from snapwise.plans import serving as SV
    _served(spark, sf)
    return SV.contract(spark, API_DATABASE)


@register("retention_cascade")
def q_retention_cascade(spark, sf):
    r = _roster(spark, sf)
    raw = r.select("snapshot_id", "guild_name", "extracted_at_utc").distinct()
    return RT.cascade_retention(raw, r, F.lit(CASCADE_AS_OF).cast("timestamp_ntz"))[1]


@register("prune_zero")
def q_prune_zero(spark, sf):
    return RT.prune_zero(AC.online_intervals_dense(_roster(spark, sf)))


@register("backfill_days")
def q_backfill_days(spark, sf):
    return AC.minutes_by_day(AC.online_intervals_dense(_roster(spark, sf)), keep_zero=True)


@register("backfill_observed_date")
def q_backfill_observed_date(spark, sf):
    v = _valid(spark, sf)
    legacy = v.withColumn("observed_date", F.when(
        F.col("observed_at_utc") >= AD.ts_lit(AD.MARKET_STORED_BEFORE), F.col("observed_date")))
    return RT.backfill_observed_date(legacy)


def _stale_tables(spark, sf):
    r = _roster(spark, sf)
    old = r.filter(F.col("extracted_at_utc") < AD.ts_lit(AD.LEDGER_SEED_BEFORE))
    return r, RB.rebuild_all(old, timeline=_timeline(spark, old))


@register("rebuild_scope")
def q_rebuild_scope(spark, sf):
    r, stored = _stale_tables(spark, sf)
    return RB.rebuild_scope(r, stored, REBUILD_WORLD, REBUILD_GUILD)["level_changes"]


@register("rebuild_scope_days")
def q_rebuild_scope_days(spark, sf):
    r, stored = _stale_tables(spark, sf)
    return RB.rebuild_scope(r, stored, REBUILD_WORLD, REBUILD_GUILD)["days"]


@register("rebuild_all")
def q_rebuild_all(spark, sf):
    r = _roster(spark, sf)
    tables = RB.rebuild_all(r, timeline=_timeline(spark, r))
    return PN.tagged_counts(tables, name_col="table_name", value_col="row_count")


# ---------------------------------------------------------------------------
# Streaming (K17): landed envelopes -> micro-batches -> stored tables
# ---------------------------------------------------------------------------

#: A time after all documents, and deliveries (text of their times) that overlap.
STREAM_END = "2024-06-01 00:00:00"
STREAM_DELIVERIES = [("2024-01-01", "2024-01-12"), ("2024-01-09", "2024-01-22"), ("2024-01-01", "2025")]


@register("stream_changes")
def q_stream_changes(spark, sf):
    """Level changes produced by the streaming pipeline over landed roster
    documents (several micro-batches, arrival order arbitrary)."""
    from snapwise.streaming import micro_batch as MB
    landing = RW.fresh_dir(spark, "landing")
    RW.write_envelopes(RW.envelopes_from_roster(_roster(spark, sf)), landing)
    root = RW.fresh_dir(spark, "stream-state")
    jobs = MB.run_available_now(spark, landing, root, max_files_per_trigger=120,
                                checkpoint=RW.fresh_dir(spark, "stream-ckpt"))
    return jobs.table("level_changes")


@register("stream_state_events")
def q_stream_state_events(spark, sf):
    """Joins, leaves, rank and level changes and online intervals from the state
    that the stream keeps per guild; documents arrive in any order."""
    from snapwise.streaming import guild_state as GS
    landing, events = RW.fresh_dir(spark, "landing"), RW.fresh_dir(spark, "events")
    roster = _roster(spark, sf)
    RW.write_envelopes(RW.envelopes_from_roster(roster), landing)
    GS.clock_document(spark, STREAM_END, f"{landing}/last")
    GS.start(spark, landing, events, delay="40 days", parts=GS.parts_for(roster), clean=False).awaitTermination()
    return GS.read_events(spark, events).select(
        "kind", "guild_name", "world", "character_name", "vocation", "guild_rank", "level", "status", "joined_date",
        "previous_level", "previous_guild_rank", "previous_status", "interval_minutes", "estimated_online_minutes",
        "previous_snapshot_time", "latest_snapshot_time")


@register("stream_members_once")
def q_stream_members_once(spark, sf):
    """A10 in the stream: deliveries by week, the second with a replay inside the
    bound, the third with one outside of it; every member row comes out once."""
    from snapwise.streaming import event_time as ET
    landing, members, ckpt = (RW.fresh_dir(spark, n) for n in ("landing", "members", "dedupe"))
    docs = RW.envelopes_from_roster(_roster(spark, sf))
    t = F.col("metadata.extracted_at_utc")
    for number, (since, until) in enumerate(STREAM_DELIVERIES):
        RW.write_envelopes(docs.filter((t >= since) & (t < until)), f"{landing}/{number}")
        ET.deduplicate_members(spark, landing, members, ckpt, delay="5 days", clean=False).awaitTermination()
    return spark.read.parquet(members)


@register("stream_minutes_by_day")
def q_stream_minutes_by_day(spark, sf):
    """D07 in the stream: day windows over the event stream's intervals."""
    from snapwise.streaming import event_time as ET
    from snapwise.streaming import guild_state as GS
    landing, events, days = (RW.fresh_dir(spark, n) for n in ("landing", "events", "days"))
    roster = _roster(spark, sf)
    RW.write_envelopes(RW.envelopes_from_roster(roster), landing)
    GS.clock_document(spark, STREAM_END, f"{landing}/last")
    GS.start(spark, landing, events, delay="40 days", parts=GS.parts_for(roster), clean=False).awaitTermination()
    ET.minutes_by_day(spark, events, days, delay="40 days").awaitTermination()
    return ET.read_days(spark, days)


#: Folder of the drained store, by the landed roster it was made from.
_DRAINED: dict[str, str] = {}


def _drained(spark, sf):
    """The stored jobs, run in batches until no pair is due; once per session and
    input, as its readers only read."""
    from snapwise.plans.jobs import SnapshotJobs
    roster = _roster(spark, sf)
    landed = roster.inputFiles()[0]
    if landed not in _DRAINED:
        jobs = SnapshotJobs(spark, fresh_dir(spark, "jobs"))
        jobs.ingest_members(roster)
        jobs.run_until_caught_up(_inc_as_of(), max(1, jobs.snapshots().count() // 2))
        _DRAINED[landed] = jobs.store.root
    return SnapshotJobs(spark, _DRAINED[landed])


@register("inc_drained_days")
def q_inc_drained_days(spark, sf):
    return _drained(spark, sf).table("days")


@register("inc_drained_latest_members")
def q_inc_drained_latest_members(spark, sf):
    return _drained(spark, sf).table("latest_members")


@register("run_report")
def q_run_report(spark, sf):
    """The run-log rows of one online and one general increment,
    the report serialized as JSON text (null parameters kept)."""
    opts = {"ignoreNullFields": "false"}
    on = _online_inc(spark, sf).report
    ge = _general_inc(spark, sf).report
    return (on.select(F.lit("online").alias("run_type"), F.to_json(F.struct(*on.columns), opts).alias("report"))
              .unionByName(ge.select(F.lit("general").alias("run_type"),
                                     F.to_json(F.struct(*ge.columns), opts).alias("report"))))


# First-generation views on global pairs
@register("member_joins_global_pairs")
def q_member_joins_global_pairs(spark, sf):
    return CH.member_joins_global_pairs(_roster(spark, sf))


@register("member_leaves_global_pairs")
def q_member_leaves_global_pairs(spark, sf):
    return CH.member_leaves_global_pairs(_roster(spark, sf))


@register("rank_changes_global_pairs")
def q_rank_changes_global_pairs(spark, sf):
    return CH.rank_changes_global_pairs(_roster(spark, sf))
