"""Hand-made rosters, one check per semantic note of the survey."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from snapwise.functions import exprs as FX
from snapwise.operators import activity as AC
from snapwise.operators import changes as CH
from snapwise.operators import market as MK
from snapwise.operators import pairs as PR
from snapwise.operators import panels as PN
from snapwise.operators import roster as RO
from snapwise.plans import retention as RT
from snapwise.sources import raw as RW

SCHEMA = ("snapshot_id string, extracted_at_utc timestamp_ntz, guild_name string, world string, "
          "character_name string, guild_rank string, vocation string, level int, status string, joined date")


def ts(h, m=0, s=0, day=1):
    return dt.datetime(2024, 5, day, h, m, s)


def roster(spark, rows):
    full = [("id", t, g, w, n, rank, "Knight", lvl, st, dt.date(2024, 1, 1))
            for (t, g, w, n, rank, lvl, st) in rows]
    return spark.createDataFrame(full, SCHEMA)


def three_snapshots(spark):
    # t1: a, b, c ; t2: a, b, d ; t3: a, d  (guild G on world W)
    t1, t2, t3 = ts(10), ts(10, 20), ts(11, 0)
    return roster(spark, [
        (t1, "G", "W", "a", "r1", 10, "online"),
        (t1, "G", "W", "b", "r1", None, "Offline"),
        (t1, "G", "W", "c", "r1", 5, "ONLINE"),
        (t2, "G", "W", "a", "r2", 12, "offline"),
        (t2, "G", "W", "b", "r1", 7, "online"),
        (t2, "G", "W", "d", "r1", 1, None),
        (t3, "G", "W", "a", "r2", 12, "online"),
        (t3, "G", "W", "d", None, 3, "online"),
    ]), (t1, t2, t3)


def test_pairs_and_events(spark):
    r, (t1, t2, t3) = three_snapshots(spark)
    assert PR.snapshot_pairs(r).count() == 2
    lc = {(x.character_name, x.latest_snapshot_time): x for x in CH.level_changes(r).collect()}
    # Null -> 7 is a change (null-safe), gain null; strict drops it.
    assert lc[("b", t2)].level_gain is None and lc[("b", t2)].previous_level is None
    strict = {(x.character_name, x.latest_snapshot_time) for x in CH.level_changes_strict(r).collect()}
    assert ("b", t2) not in strict and ("a", t2) in strict
    # C14: a was online at t1 -> 20 minutes capped at 15.
    assert lc[("a", t2)].estimated_online_minutes == 15
    assert ("a", t3) not in lc  # 12 -> 12
    joins = {(x.character_name, x.latest_snapshot_time) for x in CH.member_joins(r).collect()}
    leaves = {(x.character_name, x.latest_snapshot_time) for x in CH.member_leaves(r).collect()}
    assert joins == {("d", t2)}
    assert leaves == {("c", t2), ("b", t3)}
    # invariant: joins - leaves = size(last) - size(first)
    assert len(joins) - len(leaves) == 2 - 3
    ranks = {(x.character_name, x.previous_guild_rank, x.current_guild_rank)
             for x in CH.rank_changes(r).collect()}
    assert ranks == {("a", "r1", "r2"), ("d", "r1", None)}


def test_interval_rules(spark):
    r, (t1, t2, t3) = three_snapshots(spark)
    iv = {(x.character_name, x.previous_snapshot_time): x for x in AC.online_intervals(r).collect()}
    # Online at start counts; case-insensitive; missing at end -> latest_status null.
    assert set(iv) == {("a", t1), ("c", t1), ("b", t2)}
    assert iv[("c", t1)].latest_status is None
    assert iv[("a", t1)].interval_minutes == 20 and iv[("a", t1)].estimated_online_minutes == 15
    assert iv[("b", t2)].interval_minutes == 40
    dense = AC.online_intervals_dense(r).collect()
    # full outer of previous and latest member sets per pair: {a,b,c,d} + {a,b,d}
    assert len(dense) == 4 + 3
    assert sum(x.estimated_online_minutes for x in dense) == 15 + 15 + 15
    # The day of the interval end
    days = AC.minutes_by_day(AC.online_intervals(r)).collect()
    assert {x.activity_date for x in days} == {dt.date(2024, 5, 1)}


def test_null_world_is_not_paired(spark):
    rows = [(ts(1), "G", None, "a", "r", 1, "online"), (ts(2), "G", None, "a", "r", 2, "online")]
    r = roster(spark, rows)
    assert PR.snapshot_pairs(r).count() == 0
    assert CH.level_changes(r).count() == 0


def test_interval_minutes_rounding(spark):
    df = spark.createDataFrame([(ts(0), ts(0, 0, 29)), (ts(0), ts(0, 0, 30)), (ts(0), ts(0, 1, 29)),
                                (ts(0), ts(0, 1, 30)), (ts(1), ts(0))], "a timestamp_ntz, b timestamp_ntz")
    got = [x.m for x in df.select(FX.interval_minutes("a", "b").alias("m")).collect()]
    assert got == [0, 1, 1, 2, 0]  # half away from zero, floor 0


def test_round_ratio_half_away(spark):
    df = spark.createDataFrame([(2345, 1000), (-25, 10), (5, 2), (-5, 2), (1, 0), (None, 3)], "n long, d long")
    got = [x.v for x in df.select(FX.round_ratio("n", "d", 2).alias("v")).collect()]
    assert got == [Decimal("2.35"), Decimal("-2.50"), Decimal("2.50"), Decimal("-2.50"), None, None]
    got1 = [x.v for x in df.select(FX.round_ratio("n", "d", 0).alias("v")).collect()]
    assert got1[:4] == [Decimal("2"), Decimal("-3"), Decimal("3"), Decimal("-3")]


def test_level_band_null_goes_to_else(spark):
    df = spark.createDataFrame([(None,), (49,), (50,), (499,), (500,)], "level int")
    got = [x.b for x in df.select(FX.level_band("level").alias("b")).collect()]
    assert got == ["500+", "001-049", "050-099", "300-499", "500+"]


def test_base_vocation_order(spark):
    df = spark.createDataFrame([("Elite Knight",), ("Exalted Monk",), ("Royal Paladin",), (None,), ("None",)], "v string")
    got = [x.b for x in df.select(FX.base_vocation("v").alias("b")).collect()]
    assert got == ["Knight", "Monk", "Paladin", "Unknown", "Unknown"]


def test_joined_date_formats(spark):
    df = spark.createDataFrame([("2024-05-13",), ("May 13 2024",), ("13/05/2024",), (None,)], "v string")
    got = [x.d for x in df.select(FX.parse_joined_date("v").alias("d")).collect()]
    assert got == [dt.date(2024, 5, 13), dt.date(2024, 5, 13), None, None]


def test_range_end_is_999_ms(spark):
    end = dt.datetime(2024, 5, 2, 23, 59, 59, 999000)
    df = spark.createDataFrame([(end,), (end + dt.timedelta(microseconds=1),), (dt.datetime(2024, 5, 1),)],
                               "latest_snapshot_time timestamp_ntz")
    assert PN.filter_ts_range(df, "2024-05-01", "2024-05-02").count() == 2
    assert PN.filter_ts_range(df, None, "2024-05-02").count() == 3


def test_name_search_is_literal(spark):
    df = spark.createDataFrame([("Ab_c",), ("abXc",), ("x%y",)], "character_name string")
    assert [x.character_name for x in PN.name_contains(df, " B_C ").collect()] == ["Ab_c"]
    assert PN.name_contains(df, "  ").count() == 3


def test_truthiness_flatten(spark):
    r = roster(spark, [(ts(1), "G", "W", "a", "", 0, ""), (ts(1), "G", "W", "", "r", 3, "online")])
    env = RW.envelopes_from_roster(r)
    out = RW.flatten(env, clean=True).collect()
    assert len(out) == 1 and out[0].level is None and out[0].guild_rank is None and out[0].status is None
    assert RW.flatten(env, clean=False).count() == 2


def test_latest_members_last_connected(spark):
    r, (t1, t2, t3) = three_snapshots(spark)
    tl = CH.timeline(r)
    m = {x.character_name: x for x in
         RO.latest_members(r, AC.intervals_from(tl), CH.level_changes_from(tl)).collect()}
    assert set(m) == {"a", "d"}
    # a: last online interval start t1, last level change t2 -> t2
    assert m["a"].last_connected_at == t2
    # d: online only at t3 (newest, no interval yet) but level change at t3
    assert m["d"].last_connected_at == t3


def test_market_merge_keeps_valid_sides(spark):
    base = dt.datetime(2024, 1, 2, 0, 0).timestamp()
    rows = [("W", 1, 1, base + 10, 100, 0), ("W", 1, 2, base + 20, -1, 130), ("W", 1, 3, base + 30, 0, -1),
            ("W", 1, 4, base + 86400 + 5, -1, 0)]
    raw = spark.createDataFrame(rows, "world string, item_id long, id long, time double, buy_offer long, sell_offer long")
    valid = MK.valid_observations(raw)
    assert valid.count() == 2  # both sides invalid -> dropped (N24)
    d = MK.daily_merge(valid).collect()
    assert len(d) == 1
    assert d[0].buy_offer == 100 and d[0].sell_offer == 130
    assert d[0].observed_at_utc == dt.datetime(2024, 1, 2, 0, 0, 20)
    items = spark.createDataFrame([(1, "n", "c", 1, "[]", "[]", "wiki 1")],
                                  "item_id long, name string, category string, tier int, npc_sell string, "
                                  "npc_buy string, wiki_name string")
    h = MK.api_market_history(MK.daily_merge(valid), items).first()
    assert h.spread == 30 and h.spread_pct == Decimal("30.00") and h.item_name == "wiki 1"


def test_market_upsert_coalesces(spark):
    cols = "world string, item_id long, observed_at_utc timestamp_ntz, observed_date date, buy_offer long, sell_offer long"
    d = dt.date(2024, 1, 2)
    stored = spark.createDataFrame([("W", 1, dt.datetime(2024, 1, 2, 1), d, 10, 20)], cols)
    inc = spark.createDataFrame([("W", 1, dt.datetime(2024, 1, 2, 5), d, None, 25)], cols)
    out = MK.upsert_keep_valid(stored, inc).first()
    assert (out.buy_offer, out.sell_offer, out.observed_at_utc) == (10, 25, dt.datetime(2024, 1, 2, 5))


def test_day_retention_keeps_cutoff_day(spark):
    members = roster(spark, [(dt.datetime(2024, 5, 10, 12), "G", "W", "a", "r", 1, "online"),
                             (dt.datetime(2024, 5, 3, 6), "G", "W", "a", "r", 1, "online")])
    days = spark.createDataFrame([("G", "W", "a", dt.date(2024, 5, 3), 5, 1), ("G", "W", "a", dt.date(2024, 5, 2), 5, 1)],
                                 "guild_name string, world string, character_name string, activity_date date, "
                                 "estimated_online_minutes int, online_interval_rows int")
    empty_iv = AC.online_intervals(members.limit(0))
    tables = {"days": days, "intervals": empty_iv, "level_changes": CH.level_changes(members.limit(0)),
              "joins": CH.member_joins(members.limit(0)), "leaves": CH.member_leaves(members.limit(0)),
              "rank_changes": CH.rank_changes(members.limit(0)), "pairs": PR.snapshot_pairs(members.limit(0)),
              "members": members, "raw": members.select("guild_name", "world", "extracted_at_utc")}
    kept, report = RT.apply_retention(tables)
    # cutoff = 2024-05-03 12:00 -> the 05-03 06:00 member row goes, the 05-03 day stays
    assert kept["members"].count() == 1
    assert [x.activity_date for x in kept["days"].collect()] == [dt.date(2024, 5, 3)]
    rep = {x.step_name: x.deleted_rows for x in report.collect()}
    assert rep["guild_member_snapshot"] == 1 and rep["character_online_minutes_by_day_cache"] == 1
    assert rep["analyze_completed"] == 0


def test_retention_empty_source_single_row(spark):
    members = roster(spark, []) if False else spark.createDataFrame([], SCHEMA)
    tables = {k: members for k in ("members",)}
    tables["raw"] = members.select("guild_name", "world", "extracted_at_utc")
    for k in ("days",):
        tables[k] = spark.createDataFrame([], "activity_date date")
    for k in ("intervals", "level_changes", "joins", "leaves", "rank_changes", "pairs"):
        tables[k] = spark.createDataFrame([], "latest_snapshot_time timestamp_ntz")
    _, report = RT.apply_retention(tables)
    rows = report.collect()
    assert [(x.step_name, x.deleted_rows) for x in rows] == [("no_raw_snapshots_found", 0)]


def test_latest_raw_file_by_path(spark):
    # Across entities the slug outranks the time within a day.
    df = spark.createDataFrame([("Zeta Guild", dt.datetime(2024, 5, 1, 1)), ("Alpha", dt.datetime(2024, 5, 1, 23))],
                               "e string, t timestamp_ntz")
    p = df.select(RW.logical_path(F.lit("roster_api"), F.col("e"), F.col("t")).alias("p"), "e")
    top = p.orderBy(F.col("p").desc()).first()
    assert top.e == "Zeta Guild" and top.p.endswith("zeta_guild_20240501T010000Z.json")
