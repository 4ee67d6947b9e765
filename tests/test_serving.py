"""Every serving view exists with its column contract and the rows that the
jobs give."""

from collections import Counter

from pyspark.sql import functions as F

from snapwise.catalog import _daily, _queue, _upserted_worlds, _valid
from snapwise.operators import market as MK
from snapwise.operators import refresh_queue as RQ
from snapwise.operators import roster as RO
from snapwise.plans import rebuild as RB
from snapwise.plans.jobs import SnapshotJobs
from snapwise.plans.serving import API_VIEWS, DERIVED_VIEWS, contract, create_api_views, register_api_views
from snapwise.plans.state_jobs import MarketJobs, QueueJobs
from snapwise.plans.tables import Tables
from snapwise.sources import adapters as AD
from tests.conftest import SF_SMALL
from tests.test_jobs import Crash, as_of, small_roster


def rows_of(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_api_views_contract(spark):
    r = AD.roster(spark, SF_SMALL)
    tables = RB.rebuild_all(r)
    tables.update(members=r, queue=AD.guild_queue(spark, SF_SMALL), worlds=_upserted_worlds(spark, SF_SMALL),
                  items=AD.market_items(spark, SF_SMALL), market_history=_daily(spark, SF_SMALL))
    made = register_api_views(spark, tables)
    assert set(made) == set(API_VIEWS) | set(DERIVED_VIEWS)
    for view in API_VIEWS:
        assert spark.table(view).columns == API_VIEWS[view][1]
    for view, cols in DERIVED_VIEWS.items():
        assert spark.table(view).columns == cols
    assert spark.sql("SELECT COUNT(*) AS n FROM api_historical_character_level_changes").first().n == 423


def test_catalog_views_follow_the_stored_tables(spark, tmp_root, monkeypatch):
    """Each view gives a reader the rows that the jobs give, after every kind of
    run: increments, one that died half-way, a rebuild, a compaction."""
    roots = [f"{tmp_root}/{n}" for n in ("snapshots", "queue", "market")]
    jobs, queue, market = SnapshotJobs(spark, roots[0]), QueueJobs(spark, roots[1]), MarketJobs(spark, roots[2])
    roster = small_roster(spark)
    jobs.ingest_members(roster.filter("extracted_at_utc < '2024-01-01 02:30:00'"))
    jobs.run_online(as_of(), None)  # no general run yet: its views are there, and empty
    queue.load(_queue(spark, SF_SMALL))
    queue.discover_worlds(_upserted_worlds(spark, SF_SMALL), spark.createDataFrame([("w",), ("v",)], "world_name string"), as_of())
    market.load_items(AD.market_items(spark, SF_SMALL))
    market.load(_valid(spark, SF_SMALL))
    made = create_api_views(spark, "served", *roots)
    assert set(made) == set(API_VIEWS) | set(DERIVED_VIEWS)
    assert contract(spark, "served").filter("NOT as_agreed").isEmpty()

    def check():
        for view, (table, columns) in API_VIEWS.items():
            got = spark.table(f"served.{view}")
            assert got.columns == columns and rows_of(got) == rows_of(jobs.table(table)), view
        assert rows_of(spark.table("served.api_guild_overview_by_snapshot")) == rows_of(RO.overview_by_snapshot(jobs.members()))
        assert rows_of(spark.table("served.api_snapshot_date_bounds_by_guild")) == rows_of(RO.date_bounds(jobs.members()))

    jobs.ingest_members(roster)
    put = Tables.put

    def dies_at_the_ledger(self, name, *a, **k):
        if name == "online_ledger":
            raise Crash
        return put(self, name, *a, **k)

    monkeypatch.setattr(Tables, "put", dies_at_the_ledger)
    try:
        jobs.run_online(as_of(), None)
    except Crash:
        pass
    monkeypatch.setattr(Tables, "put", put)
    check()
    jobs.run_until_caught_up(as_of(), None)
    jobs.rebuild(as_of(), "w", "H")
    jobs.compact()
    check()
    assert rows_of(spark.table("served.api_guilds")) == rows_of(RQ.api_guilds(queue.state()))
    assert rows_of(spark.table("served.api_worlds")) == rows_of(RQ.api_worlds(queue.state("worlds")))
    items = AD.market_items(spark, SF_SMALL)
    assert rows_of(spark.table("served.api_market_items")) == rows_of(MK.api_market_items(items))
    history = MK.api_market_history(_daily(spark, SF_SMALL), items)
    assert rows_of(spark.table("served.api_market_history")) == rows_of(history)
    assert history.filter(F.col("spread_pct") < 0).count() > 0 or history.filter(F.col("spread_pct") > 0).count() > 0


def test_contract_names_what_differs(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS changed")
    spark.sql("CREATE OR REPLACE VIEW changed.api_worlds AS SELECT 1 AS world_name")
    found = {r.view_name: (r.columns, r.as_agreed) for r in contract(spark, "changed").collect()}
    assert len(found) == 13 and found["api_worlds"] == ("world_name", False) and found["api_guilds"] == ("", False)
