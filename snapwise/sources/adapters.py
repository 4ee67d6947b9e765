"""Adapters from the driver tables to the snapshot data model.

The driver ships TPC-H-like tables; these column rules turn them into the
three inputs of the engine (member snapshots, market observations and the
refresh queue). The DuckDB oracle states the same rules in SQL
(``snapwise.oracle``). Each adapter is one aggregation keyed by the finest
grain it needs, with map-side partial aggregation, so a hot user or guild is
combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapwise.functions.exprs import idiv, micros_between
from snapwise.sources.raw import snapshot_key
from snapwise.sources.tables import read_table

# ---------------------------------------------------------------------------
# Fixed adapter rules (must equal the oracle's).
# ---------------------------------------------------------------------------
ROSTER_EPOCH = "2024-01-01 00:00:00"
ROSTER_BUCKET_MICROS = 12 * 3600 * 1_000_000
ONLINE_EVENT_TYPES = ["click", "view", "purchase"]
# Vocation by k % 6 of the member's last event.
ADAPTER_VOCATIONS = ["Knight", "Elite Knight", "Royal Paladin", "Elder Druid",
                     "Master Sorcerer", "None"]
# Queue adapter.
QUEUE_AS_OF = "2001-08-01 00:00:00"
QUEUE_INTERVAL_MINUTES = 120
QUEUE_PRIORITY_BUILDING = 50
QUEUE_PRIORITY_DEFAULT = 100
QUEUE_STATUS_BY_ORDER = {"F": "success", "O": "running", "P": "failed"}
# Market upsert split: stored before the first date, incoming from the second.
MARKET_STORED_BEFORE = "2024-01-16 00:00:00"
MARKET_INCOMING_FROM = "2024-01-15 00:00:00"
# Ledger seed cut-off for the incremental jobs.
LEDGER_SEED_BEFORE = "2024-01-20 00:00:00"
DEFAULT_PAIR_LIMIT = 100

ROSTER_COLUMNS = ["snapshot_id", "extracted_at_utc", "guild_name", "world",
                  "character_name", "guild_rank", "vocation", "level", "status", "joined"]


def ts_lit(value: str):
    return F.lit(value).cast("timestamp_ntz")


def _k(props):
    return F.get_json_object(props, "$.k").cast("int")


def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Member snapshots: one row per (world, guild, member, snapshot time)."""
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props")
    ev = ev.withColumn("bucket", idiv(micros_between(ts_lit(ROSTER_EPOCH), F.col("ts")),
                                      ROSTER_BUCKET_MICROS))
    # One aggregation at the member x bucket grain (partial agg map-side).
    mb = ev.groupBy("user_id", "bucket").agg(
        F.max_by(F.struct("event_type", "props"), F.struct("ts", "event_id")).alias("last"),
        F.max("value").alias("max_value"),
        F.max("ts").alias("member_max_ts"),
    )
    mb = mb.withColumns({
        "world": F.concat(F.lit("w"), (F.col("user_id") % 2).cast("string")),
        "guild_name": F.concat(F.lit("g"), (F.col("user_id") % 3).cast("string")),
    })
    # Snapshot time = latest event of the (world, guild, bucket): small table.
    snap_time = mb.groupBy("world", "guild_name", "bucket").agg(
        F.max("member_max_ts").alias("extracted_at_utc"))
    first_seen = ev.groupBy("user_id").agg(F.to_date(F.min("ts")).alias("joined"))
    k = _k(F.col("last.props"))
    vocation = F.element_at(F.array(*[F.lit(v) for v in ADAPTER_VOCATIONS]), (k % 6) + 1)
    out = (mb.join(snap_time, ["world", "guild_name", "bucket"])
             .join(first_seen, "user_id")
             .select(
                 F.col("extracted_at_utc"),
                 F.col("guild_name"),
                 F.col("world"),
                 F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("character_name"),
                 F.col("last.event_type").alias("guild_rank"),
                 vocation.alias("vocation"),
                 F.floor(F.col("max_value")).cast("int").alias("level"),
                 F.when(F.col("last.event_type").isin(ONLINE_EVENT_TYPES), F.lit("online"))
                  .otherwise(F.lit("offline")).alias("status"),
                 F.col("joined"),
             ))
    out = out.withColumn("snapshot_id", snapshot_key(F.col("world"), F.col("guild_name"), F.col("extracted_at_utc")))
    return out.select(*ROSTER_COLUMNS)


def market_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw market payload rows: (world, item_id, id, time, buy_offer, sell_offer)."""
    ev = read_table(spark, sf_dir, "events")
    k = _k(F.col("props"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return ev.select(
        F.col("event_type").alias("world"),
        F.col("user_id").alias("item_id"),
        F.col("event_id").alias("id"),
        (micros_between(epoch, F.col("ts")) / F.lit(1_000_000.0)).alias("time"),
        F.when(k % 3 == 0, F.lit(-1)).otherwise(F.floor(F.col("value") * 100))
         .cast("bigint").alias("buy_offer"),
        F.when(k % 5 == 0, F.lit(0)).otherwise(F.floor(F.col("value") * 110))
         .cast("bigint").alias("sell_offer"),
    )


def market_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item catalogue from ``part``."""
    part = read_table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_size").cast("int").alias("tier"),
        F.lit("[]").alias("npc_sell"),
        F.lit("[]").alias("npc_buy"),
        F.concat_ws(" ", F.col("p_brand"), F.col("p_partkey").cast("string")).alias("wiki_name"),
    )


def guild_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refresh queue from customer / orders / nation."""
    cust = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    orders = read_table(spark, sf_dir, "orders")
    last = orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_date"),
        F.max("o_orderdate").alias("last_date"),
        F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("last_status"),
    )
    status = F.col("last_status")
    status_expr = None
    for code, label in QUEUE_STATUS_BY_ORDER.items():
        status_expr = (F.when(status == code, F.lit(label)) if status_expr is None
                       else status_expr.when(status == code, F.lit(label)))
    interval = F.lit(QUEUE_INTERVAL_MINUTES)
    q = (cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey, "left")
             .join(last, cust.c_custkey == last.o_custkey, "left"))
    last_ts = F.col("last_date").cast("timestamp_ntz")
    return q.select(
        F.col("c_custkey").alias("guild_id"),
        F.col("c_name").alias("guild_name"),
        F.col("n_name").alias("world"),
        (F.col("c_acctbal") > 0).alias("is_active"),
        interval.cast("int").alias("refresh_interval_minutes"),
        F.when(F.col("c_custkey") % 10 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.timestamp_add("MINUTE", interval, last_ts)).alias("next_refresh_after_utc"),
        last_ts.alias("last_refresh_started_at_utc"),
        F.when(F.col("last_status") == "F", last_ts).alias("last_refresh_completed_at_utc"),
        status_expr.alias("last_refresh_status"),
        F.when(F.col("last_status") == "P",
               F.concat(F.lit("order "), F.col("c_custkey").cast("string"), F.lit(" failed")))
         .alias("last_refresh_error"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(QUEUE_PRIORITY_BUILDING))
         .otherwise(F.lit(QUEUE_PRIORITY_DEFAULT)).cast("int").alias("refresh_priority"),
        F.col("first_date").cast("timestamp_ntz").alias("discovered_at_utc"),
        last_ts.alias("updated_at_utc"),
    )
