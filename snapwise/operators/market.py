"""Price-history domain: sparse daily buy/sell offers per (world, item).

Every step is keyed by (world, item_id[, observed_date]); aggregations are
partial (map-side) so one very active item is combined per task before the
shuffle. The item catalogue is joined by key and left to AQE to broadcast
only when its runtime size is under the threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapwise.functions.exprs import (MARKET_FRESH_HOURS, history_days, micros_between,
                                      spread, spread_pct, unix_seconds_to_ts)

DAY_KEY = ["world", "item_id", "observed_date"]
HISTORY_COLUMNS = ["world", "item_id", "observed_at_utc", "observed_date", "buy_offer", "sell_offer"]


def valid_observations(raw: DataFrame) -> DataFrame:
    """B14 + F09: a non-positive side becomes null; keep rows with at least
    one side and a positive time; unix seconds -> UTC timestamp (ms)."""
    buy = F.when(F.col("buy_offer") > 0, F.col("buy_offer")).cast("bigint")
    sell = F.when(F.col("sell_offer") > 0, F.col("sell_offer")).cast("bigint")
    ts = unix_seconds_to_ts("time")
    return (raw.filter((F.col("time") > 0)
                       & ((F.col("buy_offer") > 0) | (F.col("sell_offer") > 0)))
               .select("world", "item_id", "id",
                       ts.alias("observed_at_utc"), F.to_date(ts).alias("observed_date"),
                       buy.alias("buy_offer"), sell.alias("sell_offer")))


def daily_merge(valid: DataFrame) -> DataFrame:
    """Per (world, item, day): the last valid buy and the last valid sell
    (a missing side never overwrites), and the last observation time.
    Payload order is taken as (time, id), packed into one decimal so that the
    aggregate is a hash aggregate."""
    micros = micros_between(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("observed_at_utc"))
    order = (micros.cast("decimal(18,0)") * F.lit("10000000000000000000").cast("decimal(20,0)")
             + F.coalesce("id", F.lit(0)).cast("decimal(19,0)")).cast("decimal(38,0)")
    return valid.groupBy(*DAY_KEY).agg(
        F.max("observed_at_utc").alias("observed_at_utc"),
        F.max_by("buy_offer", F.when(F.col("buy_offer").isNotNull(), order)).alias("buy_offer"),
        F.max_by("sell_offer", F.when(F.col("sell_offer").isNotNull(), order)).alias("sell_offer"),
    ).select(*HISTORY_COLUMNS)


def loaded_at(observed_at: Column) -> Column:
    """Deterministic load time used by the adapters: the observation's hour."""
    return F.date_trunc("hour", observed_at).cast("timestamp_ntz")


def dedupe_daily(history: DataFrame) -> DataFrame:
    """Keep the most recently loaded row per (world, item, day),
    ties by id. (The reference deletes older twins with a theta self-join.)

    An aggregate, not a window: partial aggregation keeps one row per key
    and task before the shuffle, so a hot key never lands whole in a task."""
    rest = [c for c in history.columns if c not in DAY_KEY]
    newest = history.groupBy(*DAY_KEY).agg(
        F.max_by(F.struct(*rest), F.struct("loaded_at_utc", "id")).alias("_r"))
    return newest.select(*DAY_KEY, "_r.*").select(*history.columns)


def upsert_keep_valid(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """ON CONFLICT (world, item, day): time replaced, each offer side
    ``coalesce(incoming, stored)``; new keys inserted, untouched keys kept."""
    s = stored.select(*DAY_KEY, *[F.col(c).alias("s_" + c) for c in
                                  ("observed_at_utc", "buy_offer", "sell_offer")])
    i = incoming.select(*DAY_KEY, *[F.col(c).alias("i_" + c) for c in
                                    ("observed_at_utc", "buy_offer", "sell_offer")])
    j = s.join(i, DAY_KEY, "full_outer")
    hit = F.col("i_observed_at_utc").isNotNull()
    return j.select(
        "world", "item_id",
        F.when(hit, F.col("i_observed_at_utc")).otherwise(F.col("s_observed_at_utc")).alias("observed_at_utc"),
        "observed_date",
        F.coalesce("i_buy_offer", "s_buy_offer").alias("buy_offer"),
        F.coalesce("i_sell_offer", "s_sell_offer").alias("sell_offer"),
    )


def api_market_items(items: DataFrame) -> DataFrame:
    """Catalogue projection for the item selector."""
    return items.select("item_id", "name", "category", "tier", "wiki_name")


def api_market_history(history: DataFrame, items: DataFrame) -> DataFrame:
    """C18 + F07: history with the item's wiki name, spread and spread %."""
    it = items.select("item_id", F.col("wiki_name").alias("item_name"))
    j = history.join(it, "item_id")
    return j.select("world", "item_id", "item_name", "observed_at_utc", "buy_offer", "sell_offer",
                    spread("buy_offer", "sell_offer").alias("spread"),
                    spread_pct("buy_offer", "sell_offer").alias("spread_pct"))


def item_search(items: DataFrame, search: str, limit: int = 20) -> DataFrame:
    """ILIKE '%s%' on name or wiki name; under 2 characters nothing;
    ordered by wiki name, first ``limit`` rows (the selector's page)."""
    s = (search or "").strip()
    base = api_market_items(items)
    if len(s) < 2:
        return base.limit(0).withColumn("search_rank", F.lit(0))
    pattern = "%" + s.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") + "%"
    hits = base.filter(F.col("name").ilike(pattern) | F.col("wiki_name").ilike(pattern))
    order = [F.col("wiki_name").asc_nulls_last(), F.col("item_id")]
    top = hits.orderBy(*order).limit(limit)
    return top.withColumn("search_rank", F.row_number().over(Window.orderBy(*order)))


def item_resolve(requests: DataFrame, items: DataFrame) -> DataFrame:
    """Exact case-insensitive match of each requested name on name or
    wiki name; ``item_id`` only when exactly one item matches.

    Both names are matched with equi-joins on the lower-cased key (two
    joins, then distinct per (request, item)), never a theta join."""
    req = requests.select("item_name", F.lower("item_name").alias("_key")).distinct()
    by_name = items.select("item_id", F.lower("name").alias("_key"))
    by_wiki = items.select("item_id", F.lower("wiki_name").alias("_key"))
    cand = by_name.unionByName(by_wiki).distinct()
    m = req.join(cand, "_key", "left")
    agg = m.groupBy("item_name").agg(
        F.count("item_id").alias("match_count"),
        F.min("item_id").alias("_one"))
    return agg.select("item_name", "match_count",
                      F.when(F.col("match_count") == 1, F.col("_one")).alias("item_id"))


def request_check(requested_ids: DataFrame, items: DataFrame) -> DataFrame:
    """Does each requested item exist in the catalogue (semi / anti)."""
    req = requested_ids.select("item_id").distinct()
    ok = req.join(items.select("item_id"), "item_id", "left_semi").withColumn("item_exists", F.lit(True))
    bad = req.join(items.select("item_id"), "item_id", "left_anti").withColumn("item_exists", F.lit(False))
    return ok.unionByName(bad)


def market_summary(api_history: DataFrame) -> DataFrame:
    """Per (world, item): observation count and the newest row's values."""
    last = F.struct("buy_offer", "sell_offer", "spread", "spread_pct")
    agg = api_history.groupBy("world", "item_id").agg(
        F.count(F.lit(1)).alias("observation_count"),
        F.max("observed_at_utc").alias("latest_observed_at_utc"),
        F.max_by(last, "observed_at_utc").alias("_l"))
    return agg.select("world", "item_id", "observation_count", "latest_observed_at_utc",
                      F.col("_l.buy_offer").alias("latest_buy_offer"),
                      F.col("_l.sell_offer").alias("latest_sell_offer"),
                      F.col("_l.spread").alias("latest_spread"),
                      F.col("_l.spread_pct").alias("latest_spread_pct"))


def freshness(history: DataFrame, as_of: Column, hours: int = MARKET_FRESH_HOURS) -> DataFrame:
    """Latest load time per (world, item) and whether it is younger than
    ``hours`` at ``as_of``."""
    agg = history.groupBy("world", "item_id").agg(F.max("loaded_at_utc").alias("latest_loaded_at_utc"))
    age = micros_between("latest_loaded_at_utc", as_of)
    return agg.withColumn("is_fresh", age < F.lit(hours * 3600 * 1_000_000))


def due_loads(requests: DataFrame, history: DataFrame, as_of: Column,
              start_date: str, end_date: str, hours: int = MARKET_FRESH_HOURS) -> DataFrame:
    """Work list of (world, item) requests that need a load: no stored
    row in the requested range and no load within ``hours``; with the number
    of history days to ask for."""
    start = F.lit(f"{start_date} 00:00:00").cast("timestamp_ntz")
    end = F.lit(f"{end_date} 23:59:59.999").cast("timestamp_ntz")
    req = requests.select("world", "item_id").distinct()
    in_range = history.filter(F.col("observed_at_utc").between(start, end)).select("world", "item_id")
    missing = req.join(in_range, ["world", "item_id"], "left_anti")
    fresh = freshness(history, as_of, hours).filter("is_fresh").select("world", "item_id")
    due = missing.join(fresh, ["world", "item_id"], "left_anti")
    return due.select("world", "item_id", history_days(F.lit(start_date), as_of).alias("days"))


def items_upsert(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Catalogue upsert, every column replaced on conflict."""
    kept = stored.join(incoming.select("item_id"), "item_id", "left_anti")
    return kept.unionByName(incoming.select(*stored.columns))
