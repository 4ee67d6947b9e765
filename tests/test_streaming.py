"""The streaming pipeline equals the batch results (several micro-batches,
arbitrary arrival order)."""

import datetime as dt
import random
import time
from collections import Counter

import pandas as pd
from pyspark.sql import functions as F

from snapwise.plans import rebuild as RB
from snapwise.plans.jobs import SnapshotJobs
from snapwise.sources import adapters as AD
from snapwise.sources import raw as RW
from snapwise.streaming import event_time as ET
from snapwise.streaming import guild_state as GS
from snapwise.streaming import micro_batch as MB
from snapwise.streaming import staged as ST
from tests.conftest import SF_SMALL
from tests.test_jobs import small_roster

KINDS = {"level_change": "level_changes", "join": "joins", "leave": "leaves", "rank_change": "rank_changes",
         "interval": "intervals"}


def rows_of(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def land(docs, path):
    """One file per call, after all that landed before."""
    RW.write_envelopes(docs.coalesce(1), f"{path}/{time.time_ns()}")


def test_stream_equals_batch(spark):
    roster = AD.roster(spark, SF_SMALL)
    landing = RW.fresh_dir(spark, "landing")
    RW.write_envelopes(RW.envelopes_from_roster(roster), landing)
    root = RW.fresh_dir(spark, "state")
    jobs = MB.run_available_now(spark, landing, root, max_files_per_trigger=25, clean=False,
                                checkpoint=RW.fresh_dir(spark, "ckpt"))
    full = RB.rebuild_all(roster)
    for name in ("level_changes", "joins", "leaves", "rank_changes", "intervals", "days", "totals",
                 "latest_members"):
        a, b = jobs.table(name), full[name]
        cols = sorted(a.columns)
        assert a.select(*cols).exceptAll(b.select(*cols)).isEmpty(), name
        assert b.select(*cols).exceptAll(a.select(*cols)).isEmpty(), name
    # a second drain of the same landing folder is a no-op
    again = MB.run_available_now(spark, landing, root, max_files_per_trigger=25, clean=False,
                                 checkpoint=RW.fresh_dir(spark, "ckpt2"))
    assert again.table("level_changes").count() == full["level_changes"].count()


def test_guild_state_equals_rebuild_in_any_order(spark):
    """Split documents (one member each), shuffled over triggers, some twice;
    guilds with and without a world, a guild that empties and comes back."""
    roster = small_roster(spark, (0, 1, 2, 3, 30, 31, 32))
    single = RW.envelopes_from_roster(roster).withColumn(
        "m", F.explode("data.guild.members")).withColumn("data", F.struct(F.struct(
            F.col("data.guild.name").alias("name"), F.col("data.guild.world").alias("world"),
            F.array("m").alias("members")).alias("guild"))).drop("m")
    landing, events = RW.fresh_dir(spark, "landing"), RW.fresh_dir(spark, "events")
    order = list(range(6))
    random.Random(3).shuffle(order)
    split = F.pmod(F.xxhash64(F.to_json("data"), F.to_json("metadata")), F.lit(6))
    for k in [*order, order[0]]:
        land(single.filter(split == k), landing)
    GS.clock_document(spark, "2024-03-01 00:00:00", f"{landing}/last")
    q = GS.start(spark, landing, events, delay="3 days", parts=3, clean=False, max_files_per_trigger=2)
    q.awaitTermination()
    assert q.exception() is None
    got, want = GS.read_events(spark, events), RB.rebuild_all(roster)
    for kind, table in KINDS.items():
        assert rows_of(GS.of_kind(got, kind)) == rows_of(want[table]), kind
    assert len([p for p in q.recentProgress if p["numInputRows"]]) >= 3
    # All that waited is processed: what stays is the roster of each group.
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] < 40


def test_guild_state_goes_on_where_it_stopped(spark):
    """Three runs over one checkpoint; a document behind the watermark is dropped
    and counted, and an expired roster starts anew."""
    landing, events, ckpt = (RW.fresh_dir(spark, n) for n in ("landing", "events", "ckpt"))
    roster = small_roster(spark, (0, 1, 30, 31, 200, 201))
    docs = RW.envelopes_from_roster(roster)
    t = F.col("metadata.extracted_at_utc")
    for lo, hi in (("2024-01-01", "2024-01-02"), ("2024-01-02", "2024-01-05"), ("2024-01-05", "2024-02-01")):
        land(docs.filter((t >= lo) & (t < hi)), landing)
        if lo == "2024-01-05":  # far behind by now
            land(docs.filter(t < "2024-01-01T00:30:00"), landing)
            GS.clock_document(spark, "2024-03-01 00:00:00", f"{landing}/last")
        q = GS.start(spark, landing, events, ckpt, delay="1 hour", parts=2, clean=False,
                     expire_ms=3 * 24 * 3600 * 1000)
        q.awaitTermination()
        assert q.exception() is None
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in q.recentProgress if p["stateOperators"]) > 0
    got = GS.read_events(spark, events)
    near, far = roster.filter("extracted_at_utc < '2024-01-05'"), roster.filter("extracted_at_utc >= '2024-01-05'")
    for kind, table in KINDS.items():
        want = rows_of(RB.rebuild_all(near)[table]) + rows_of(RB.rebuild_all(far)[table])
        have = rows_of(GS.of_kind(got, kind))
        assert have == want, (kind, have - want, want - have)


def big_guild(spark, members, hours=(0, 1, 2, 30)):
    """A guild whose members all level up from snapshot to snapshot, one of seven away in each."""
    polls = spark.createDataFrame([(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)) for i, h in enumerate(hours)],
                                  "i int, extracted_at_utc timestamp_ntz")
    return spark.range(members).crossJoin(polls).filter((F.col("id") + F.col("i")) % 7 > 0).select(
        F.concat(F.lit("s"), "i").alias("snapshot_id"), "extracted_at_utc", F.lit("g").alias("guild_name"),
        F.lit("w").alias("world"), F.concat(F.lit("c"), "id").alias("character_name"),
        F.when(F.col("id") % 3 == 0, "elder").otherwise(F.concat(F.lit("r"), "i")).alias("guild_rank"),
        F.lit("knight").alias("vocation"), F.when(F.col("id") % 5 > 0, (F.col("id") + F.col("i")).cast("int")).alias("level"),
        F.when(F.col("id") % 2 == 0, "online").otherwise("offline").alias("status"), F.lit(None).cast("date").alias("joined"))


def test_state_calls_do_not_grow_with_the_members(spark):
    """A snapshot costs a group a few rows of state, not one per member."""
    roster = big_guild(spark, 1500)  # four documents a snapshot
    landing, events = RW.fresh_dir(spark, "landing"), RW.fresh_dir(spark, "events")
    land(RW.envelopes_from_roster(roster), landing)
    GS.clock_document(spark, "2024-03-01 00:00:00", f"{landing}/last")
    q = GS.start(spark, landing, events, delay="3 days", parts=3, clean=False)
    q.awaitTermination()
    assert q.exception() is None
    got, want = GS.read_events(spark, events), RB.rebuild_all(roster)
    for kind, table in KINDS.items():
        assert rows_of(GS.of_kind(got, kind)) == rows_of(want[table]), kind
    changed = [p["stateOperators"][0][k] for p in q.recentProgress if p["stateOperators"] for k in ("numRowsUpdated", "numRowsRemoved")]
    assert sum(changed) < 200, changed


class FakeState(dict):
    """Value and map states, timers and times of one group, as Spark gives them."""
    def getValueState(self, name, schema): return FakeState()
    def getMapState(self, name, key, value): return FakeState()
    def get(self): return dict.get(self, ())
    def update(self, value): self[()] = value
    def clear(self): self.pop((), None)
    def updateValue(self, key, value): self[key] = value
    def getValue(self, key): return self[key]
    def removeKey(self, key): del self[key]
    def registerTimer(self, at): self[at] = at
    def getCurrentWatermarkInMs(self): return 10_000
    def getExpiryTimeInMs(self): return min(self)


def test_snapshot_of_many_rows_is_written_in_parts(spark):
    """More rows of a group than a task holds: written in parts, none read again."""
    handle, state = FakeState(), GS.GuildState(720, None)
    state.init(handle)
    n = GS.HELD_ROWS // 2 + 5_000
    rows = pd.DataFrame({"micros": [1_000_000, 2_000_000] * n, "name": [f"c{i // 2}" for i in range(2 * n)], "guild_rank": "r",
                         "vocation": None, "level": [1.0, 2.0] * n, "status": "online", "joined": None})
    rows.loc[0, "name"], rows.loc[3, "level"] = None, None  # nobody; no level
    assert not list(state.handleInputRows(("w", "g", 0), (rows[i:i + 10_000] for i in range(0, len(rows), 10_000)), handle))
    assert sorted(state.waiting) == [(1_000_000, 0), (1_000_000, 1), (2_000_000, 0), (2_000_000, 1)]
    kinds = Counter()
    for frame in state.handleExpiredTimer(("w", "g", 0), handle, handle):
        kinds.update(frame["kind"])
        assert list(frame.columns) == GS.COLUMNS
    assert kinds == {"join": 1, "level_change": n - 1, "interval": n - 1}
    assert list(handle) == [1001]  # one timer for both
    assert not state.waiting and not list(state.handleExpiredTimer(("w", "g", 0), handle, handle))


def test_parts_follow_the_largest_snapshot(spark):
    assert GS.parts_for(big_guild(spark, 10).limit(0)) == GS.parts_for(big_guild(spark, 700)) == GS.LEAST_PARTS
    assert GS.parts_for(big_guild(spark, 14 * GS.MEMBERS_PER_PART)) == 12


def test_empty_landing_gives_no_events(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    GS.clock_document(spark, "2024-03-01 00:00:00", f"{tmp_path}/landing/last")
    q = GS.start(spark, f"{tmp_path}/landing", f"{tmp_path}/events", str(tmp_path / "ckpt"))
    q.awaitTermination()
    assert GS.read_events(spark, f"{tmp_path}/events").count() == 0


def test_replays_inside_and_outside_the_bound(spark):
    roster = small_roster(spark, (0, 1, 30, 31, 100, 101, 200))
    docs = RW.envelopes_from_roster(roster)
    t = F.col("metadata.extracted_at_utc")
    landing, members, ckpt = (RW.fresh_dir(spark, n) for n in ("landing", "members", "ckpt"))
    held = []
    for lo, hi, again in (("2024-01-01", "2024-01-03", None), ("2024-01-03", "2024-01-06", "2024-01-02"),
                          ("2024-01-06", "2024-02-01", "2024-01-01")):
        land(docs.filter((t >= lo) & (t < hi)), landing)
        if again:
            land(docs.filter((t >= again) & (t < lo)), landing)
        q = ET.deduplicate_members(spark, landing, members, ckpt, delay="2 days", clean=False)
        q.awaitTermination()
        assert q.exception() is None
        held.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert rows_of(spark.read.parquet(members).select(*roster.columns[1:])) == rows_of(roster.select(*roster.columns[1:]))
    assert max(held) < roster.count()  # keys behind the watermark are gone


def test_day_windows_equal_the_batch(spark):
    roster = small_roster(spark, (0, 1, 2, 3, 23, 24, 25, 30, 50))
    events, days = RW.fresh_dir(spark, "events"), RW.fresh_dir(spark, "days")
    want = RB.rebuild_all(roster)
    micros = lambda c: F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c)
    rows = want["intervals"].withColumns({
        "kind": F.lit("interval"), "previous_micros": micros(F.col("previous_snapshot_time")),
        "latest_micros": micros(F.col("latest_snapshot_time"))})
    columns = {f.split()[0]: f.split()[1] for f in GS.EVENTS.split(", ")}
    rows = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in columns.items()])
    for k in (2, 0, 3, 1):  # late rows among them
        rows.filter(F.pmod(F.xxhash64("character_name", "latest_micros"), F.lit(4)) == k).coalesce(1) \
            .write.mode("append").parquet(events)
    q = ET.minutes_by_day(spark, events, days, delay="5 days", max_files_per_trigger=1)
    q.awaitTermination()
    assert q.exception() is None
    assert rows_of(ET.read_days(spark, days)) == rows_of(want["days"]) and sum(rows_of(want["days"]).values()) > 4


def test_day_windows_keep_their_state_on_disk(spark):
    """The sums of all members and days are not held in the heap."""
    events, days = RW.fresh_dir(spark, "events"), RW.fresh_dir(spark, "days")
    spark.range(1).selectExpr("'interval' kind", "'g' guild_name", "'w' world", "'c' character_name",
                              "30 estimated_online_minutes", "1704067200000000L latest_micros").coalesce(1).write.parquet(events)
    before = spark.conf.get(GS.STATE_STORE[0])
    q = ET.minutes_by_day(spark, events, days)
    q.awaitTermination()
    state = next(p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"])
    assert any(name.startswith("rocksdb") for name in state["customMetrics"])
    assert spark.conf.get(GS.STATE_STORE[0]) == before and ET.read_days(spark, days).count() == 1


def test_staged_triggers_overlap_and_lose_nothing(spark):
    roster = small_roster(spark, (0, 1, 2, 3, 30))
    landing, root = RW.fresh_dir(spark, "landing"), RW.fresh_dir(spark, "store")
    docs = RW.envelopes_from_roster(roster)
    land(docs.filter(F.col("metadata.extracted_at_utc") < "2024-01-01T02:30:00"), landing)
    queries = ST.start(spark, landing, root, every="1 second", pair_limit=2, clean=False)
    land(docs.filter(F.col("metadata.extracted_at_utc") >= "2024-01-01T02:30:00"), landing)
    jobs, until = SnapshotJobs(spark, root), time.time() + 240
    while time.time() < until and jobs.table("general_ledger").count() < 8:
        assert all(q.exception() is None for q in queries.values())
        time.sleep(1)
    for q in queries.values():
        q.stop()
    jobs.run_until_caught_up(F.lit(dt.datetime(2024, 2, 1)).cast("timestamp_ntz"), None)
    want = RB.rebuild_all(roster)
    for name in ("level_changes", "joins", "leaves", "rank_changes", "intervals", "days", "totals", "latest_members"):
        assert rows_of(jobs.table(name)) == rows_of(want[name]), name
    assert jobs.table("general_ledger").count() == 8
