"""Serving views (A11): named, read-only column contracts over the stored
result tables.

``register_api_views`` makes temporary views of tables at hand.
``create_api_views`` makes catalog views that last as long as the catalog: plain
SQL over the stored folders with the rules of a reader in it (committed batches
only, rebuilt guilds voided, additive parts summed, newest state of the queue),
bound to their columns and types. Readers need neither this library nor a run of
it; what the jobs store is there at the next query. ``contract`` holds what a
catalog has against the lists below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapwise.plans.jobs import DAY, KIND, LEDGERS, PARTS, SCHEMAS
from snapwise.plans.tables import Tables
from snapwise.sources import landing as LD

from snapwise.operators import market as MK
from snapwise.operators import refresh_queue as RQ
from snapwise.operators import roster as RO

# Fixed view names and column contracts.
API_VIEWS: dict[str, tuple[str, list[str]]] = {
    "api_historical_character_level_changes": ("level_changes", [
        "guild_name", "world", "character_name", "vocation", "guild_rank", "previous_level",
        "current_level", "level_gain", "previous_snapshot_time", "latest_snapshot_time",
        "estimated_online_minutes"]),
    "api_historical_guild_joins": ("joins", [
        "guild_name", "world", "character_name", "vocation", "level", "guild_rank", "status",
        "joined_date", "previous_snapshot_time", "latest_snapshot_time"]),
    "api_historical_guild_leaves": ("leaves", [
        "guild_name", "world", "character_name", "vocation", "level", "guild_rank", "status",
        "joined_date", "previous_snapshot_time", "latest_snapshot_time"]),
    "api_historical_rank_changes": ("rank_changes", [
        "guild_name", "world", "character_name", "previous_guild_rank", "current_guild_rank",
        "previous_snapshot_time", "latest_snapshot_time"]),
    "api_latest_guild_members": ("latest_members", [
        "guild_name", "world", "character_name", "vocation", "guild_rank", "current_level",
        "latest_snapshot_time", "last_connected_at"]),
    "api_character_online_intervals": ("intervals", [
        "guild_name", "world", "character_name", "previous_snapshot_time", "latest_snapshot_time",
        "previous_status", "latest_status", "interval_minutes", "estimated_online_minutes"]),
    "api_character_online_minutes_by_day": ("days", [
        "guild_name", "world", "character_name", "activity_date", "estimated_online_minutes",
        "online_interval_rows"]),
}
DERIVED_VIEWS = {
    "api_guild_overview_by_snapshot": ["guild_name", "world", "snapshot_time", "number_of_members",
                                       "max_level", "min_level", "average_level"],
    "api_snapshot_date_bounds_by_guild": ["guild_name", "world", "min_snapshot_time", "max_snapshot_time"],
    "api_guilds": ["guild_name", "world", "is_active", "refresh_interval_minutes",
                   "last_refresh_completed_at_utc", "last_refresh_status", "updated_at_utc"],
    "api_worlds": ["world_name", "is_active", "updated_at_utc"],
    "api_market_items": ["item_id", "name", "category", "tier", "wiki_name"],
    "api_market_history": ["world", "item_id", "item_name", "observed_at_utc", "buy_offer", "sell_offer",
                           "spread", "spread_pct"],
}


def register_api_views(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Create every view whose source tables are present; return the names."""
    made = []
    for view, (src, cols) in API_VIEWS.items():
        if src in tables:
            tables[src].select(*cols).createOrReplaceTempView(view)
            made.append(view)
    derived = {}
    if "members" in tables:
        derived["api_guild_overview_by_snapshot"] = RO.overview_by_snapshot(tables["members"])
        derived["api_snapshot_date_bounds_by_guild"] = RO.date_bounds(tables["members"])
    if "queue" in tables:
        derived["api_guilds"] = RQ.api_guilds(tables["queue"])
    if "worlds" in tables:
        derived["api_worlds"] = RQ.api_worlds(tables["worlds"])
    if "items" in tables:
        derived["api_market_items"] = MK.api_market_items(tables["items"])
        if "market_history" in tables:
            derived["api_market_history"] = MK.api_market_history(tables["market_history"], tables["items"])
    for view, df in derived.items():
        df.select(*DERIVED_VIEWS[view]).createOrReplaceTempView(view)
        made.append(view)
    return made


#: Stored tables that the views read.
READ = ("members", "snapshots", "signs", *KIND)


def _seed(store: Tables) -> None:
    """A row that no reader counts (batch -1) in every table that the views name,
    so that they hold before the first run of a kind and where retention or a
    compaction has emptied a folder."""
    tables = {n: SCHEMAS[n] for n in (*READ, "rebuilds")} | {f"due_{k}": SCHEMAS["pairs"] for k in LEDGERS}
    tables |= {"compacting": "id long", "compactions": "name string, replaced long"}
    for name, schema in tables.items():
        parts = {p: "date" if p == DAY else "string" for p in PARTS.get(name, ())}
        types = [c.split() for c in schema.split(", ")] + [[*p] for p in parts.items()]
        store.put(name, store.spark.range(1).select(*[F.lit(None).cast(t).alias(c) for c, t in types]), -1, tuple(parts))


def _stored_sql(store: Tables, name: str) -> str:
    """A stored table as a reader sees it: rows of committed batches that neither
    a later rebuild nor a compaction voids."""
    def there(table: str, rule: str) -> str:
        return f"EXISTS (SELECT 1 FROM parquet.`{store.folder(table)}` x WHERE {rule})"

    rules = ["t.batch >= 0", f"NOT {there('compactions', f'x.name = {chr(39)}{name}{chr(39)} AND x.replaced = t.batch')}",
             f"(NOT {there('compacting', 'x.batch = t.batch')} OR {there('compactions', 'x.batch = t.batch')})"]
    for kind in [KIND[name]] if name in KIND else LEDGERS if name == "signs" else ():
        rules.append(f"(NOT {there(f'due_{kind}', 'x.batch = t.batch')} OR {there(LEDGERS[kind], 'x.batch = t.batch')})")
    if name in KIND or name == "signs":
        rules.append(f"NOT {there('rebuilds', 'x.world = t.world AND x.guild_name = t.guild_name AND x.batch >= t.batch')}")
    return f"(SELECT * FROM parquet.`{store.folder(name)}` t WHERE {' AND '.join(rules)})"


def _ratio_sql(n: str, d: str, scale: int) -> str:
    """n / d rounded half away from zero, in integers (``exprs.round_ratio``)."""
    factor = 10 ** scale
    size = f"(abs({n}) * {2 * factor} + abs({d})) div (abs({d}) * 2)"
    return (f"CASE WHEN {d} <> 0 THEN CAST(CAST(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -({size}) ELSE {size} END "
            f"AS DECIMAL(30, 0)) / {factor} AS DECIMAL(20, {scale})) END")


def _view_sql(snapshots: Tables, queue: Tables, market: Tables) -> dict[str, str]:
    """View name -> SQL."""
    member = "guild_name, world, character_name"
    sql = {}
    for view, (table, columns) in API_VIEWS.items():
        sql[view] = f"SELECT {', '.join(columns)} FROM {_stored_sql(snapshots, table)}" if table not in ("latest_members", "days") else ""
    sql["api_character_online_minutes_by_day"] = (
        f"SELECT {member}, activity_date, CAST(sum(estimated_online_minutes) AS INT) AS estimated_online_minutes, "
        f"CAST(sum(online_interval_rows) AS INT) AS online_interval_rows FROM {_stored_sql(snapshots, 'days')} "
        f"GROUP BY {member}, activity_date HAVING sum(estimated_online_minutes) > 0")
    members = _stored_sql(snapshots, "members")
    sql["api_latest_guild_members"] = (
        "SELECT m.guild_name, m.world, m.character_name, m.vocation, m.guild_rank, m.level AS current_level, "
        "m.extracted_at_utc AS latest_snapshot_time, greatest(s.online, s.level_change) AS last_connected_at "
        f"FROM {members} m JOIN (SELECT world, guild_name, max(extracted_at_utc) AS newest "
        f"FROM {_stored_sql(snapshots, 'snapshots')} GROUP BY world, guild_name) n "
        "ON m.world = n.world AND m.guild_name = n.guild_name AND m.extracted_at_utc = n.newest "
        "AND m.day = CAST(n.newest AS DATE) "
        f"LEFT JOIN (SELECT {member}, max(last_online_at) AS online, max(last_level_change_at) AS level_change "
        f"FROM {_stored_sql(snapshots, 'signs')} GROUP BY {member}) s "
        "ON m.world = s.world AND m.guild_name = s.guild_name AND m.character_name = s.character_name")
    sql["api_guild_overview_by_snapshot"] = (
        "SELECT guild_name, world, extracted_at_utc AS snapshot_time, count(*) AS number_of_members, "
        "max(level) AS max_level, min(level) AS min_level, "
        f"{_ratio_sql('sum(level)', 'count(level)', 1)} AS average_level FROM {members} GROUP BY guild_name, world, extracted_at_utc")
    sql["api_snapshot_date_bounds_by_guild"] = (
        "SELECT guild_name, world, min(extracted_at_utc) AS min_snapshot_time, max(extracted_at_utc) AS max_snapshot_time "
        f"FROM {members} GROUP BY guild_name, world")

    def newest(store: Tables, name: str) -> str:
        path = f"parquet.`{store.folder(name)}`"
        return f"(SELECT * FROM {path} WHERE batch = (SELECT max(batch) FROM {path}))"

    sql["api_guilds"] = f"SELECT {', '.join(DERIVED_VIEWS['api_guilds'])} FROM {newest(queue, 'queue')} WHERE is_active"
    sql["api_worlds"] = f"SELECT {', '.join(DERIVED_VIEWS['api_worlds'])} FROM {newest(queue, 'worlds')} WHERE is_active"
    items = newest(market, "items")
    sql["api_market_items"] = f"SELECT {', '.join(DERIVED_VIEWS['api_market_items'])} FROM {items}"
    # Spread as in ``functions.exprs``: exact integers, halves away from zero.
    sql["api_market_history"] = (
        "SELECT h.world, h.item_id, i.wiki_name AS item_name, h.observed_at_utc, h.buy_offer, h.sell_offer, "
        "h.sell_offer - h.buy_offer AS spread, "
        f"{_ratio_sql('((h.sell_offer - h.buy_offer) * 100)', 'h.buy_offer', 2)} AS spread_pct FROM parquet.`{market.folder('history')}` h JOIN {items} i ON h.item_id = i.item_id")
    return sql


def create_api_views(spark: SparkSession, database: str, snapshots_root: str, queue_root: str, market_root: str) -> list[str]:
    """Create or replace every view in a catalog database; their names. The
    folders are named by full paths, so any session of the catalog can read."""
    stores = [Tables(spark, LD.qualified(spark, root)) for root in (snapshots_root, queue_root, market_root)]
    _seed(stores[0])
    views = _view_sql(*stores)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for view, sql in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{view} WITH SCHEMA BINDING AS {sql}")
    return sorted(views)


def contract(spark: SparkSession, database: str) -> DataFrame:
    """``view_name, columns, as_agreed``: the columns of each view in a catalog
    and whether they are the agreed ones, in their order. The schema comes from
    the catalog; no row is read."""
    agreed = {v: c for v, (_, c) in API_VIEWS.items()} | DERIVED_VIEWS
    rows = []
    for view, columns in agreed.items():
        found = spark.table(f"{database}.{view}").columns if spark.catalog.tableExists(f"{database}.{view}") else []
        rows.append((view, ",".join(found), found == columns))
    return spark.createDataFrame(rows, "view_name string, columns string, as_agreed boolean")
