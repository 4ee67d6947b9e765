"""Persistent jobs: increments in any batch size equal a full rebuild; reruns,
redelivered data and crashes at any write change nothing."""

import datetime as dt
import os
import threading
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from snapwise.plans import rebuild as RB
from snapwise.plans.jobs import SCHEMAS, SnapshotJobs
from snapwise.plans.tables import Tables
from snapwise.sources import adapters as AD
from snapwise.sources import raw as RW
from tests.conftest import SF_SMALL

RESULTS = ("intervals", "days", "totals", "pairs", "level_changes", "joins", "leaves", "rank_changes", "latest_members")
DAY = dt.datetime(2024, 1, 1)


def as_of():
    return F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")


def rows_of(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def rebuilt(roster):
    """The result tables that a full rebuild gives."""
    return {n: rows_of(d) for n, d in RB.rebuild_all(roster).items()}


def differing(jobs, want):
    return [n for n in RESULTS if rows_of(jobs.table(n)) != want[n]]


@pytest.fixture(scope="module")
def small(spark):
    roster = small_roster(spark)
    return roster, rebuilt(roster)


def small_roster(spark, hours=(0, 1, 2, 3, 30)):
    """Two guilds; members come, go, rise and change rank; nulls among them."""
    rows = []
    for guild, world in (("G", "w"), ("H", "w")):
        for k, hour in enumerate(hours):
            t = DAY + dt.timedelta(hours=hour, minutes=7 * (guild == "H"))
            for name in "abcd":
                if (name == "b" and k == 2) or (name == "c" and k < 1) or (name == "d" and k > 2):
                    continue
                rows.append((f"{guild}{k}", t, guild, world, name, "lead" if name == "a" and k > 1 else "member",
                             None if name == "c" else "knight", None if name == "d" and k == 1 else 10 + k * (name != "b"),
                             [None, "online", "offline"][(k + ord(name)) % 3], None))
    return spark.createDataFrame(rows, SCHEMAS["members"])


def files(root):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(root) for f in names if "_work" not in d)


def test_incremental_equals_rebuild_and_reruns_are_noops(spark, tmp_root):
    roster = AD.roster(spark, SF_SMALL)
    jobs = SnapshotJobs(spark, tmp_root)
    jobs.ingest_members(roster)
    assert jobs.run_until_caught_up(as_of(), pair_limit=130) >= 3
    assert differing(jobs, rebuilt(roster)) == []
    before = files(tmp_root)
    assert jobs.run_online(as_of(), 130).first()["processed_pairs"] == 0
    assert jobs.run_general(as_of(), 130).first()["processed_pairs"] == 0
    jobs.ingest_members(roster)  # a redelivery
    assert files(tmp_root) == before
    assert jobs.members().count() == roster.count()


def test_small_batches_and_no_limit_agree(spark, tmp_root, small):
    roster, want = small
    for limit in (3, None):
        jobs = SnapshotJobs(spark, os.path.join(tmp_root, str(limit)))
        jobs.ingest_members(roster)
        jobs.run_until_caught_up(as_of(), limit)
        assert differing(jobs, want) == [], limit
    assert jobs.table("online_ledger").count() == jobs.table("general_ledger").count() == 8


class Crash(Exception):
    pass


@pytest.mark.parametrize("job", ["online", "general", "ingest_late", "rebuild"])
def test_crash_at_every_write(spark, tmp_root, monkeypatch, small, job):
    """A crash at the first write, then at the second of the next attempt, and so
    on until an attempt gets through."""
    roster, want = small
    late = F.col("extracted_at_utc") == F.lit(DAY + dt.timedelta(hours=1)).cast("timestamp_ntz")
    put, at, crashed = Tables.put, 0, True
    jobs = SnapshotJobs(spark, tmp_root)
    jobs.ingest_members(roster.filter(~late) if job == "ingest_late" else roster)
    if job != "online":
        jobs.run_online(as_of(), None)
    if job in ("ingest_late", "rebuild"):
        jobs.run_general(as_of(), None)
    # A rebuild is its mark, then the two jobs above.
    while crashed and not (job == "rebuild" and at == 4):
        at += 1
        jobs, calls = SnapshotJobs(spark, tmp_root), [0]

        def failing(self, *a, **k):
            calls[0] += 1
            if calls[0] == at:
                raise Crash
            return put(self, *a, **k)

        monkeypatch.setattr(Tables, "put", failing)
        try:
            {"online": lambda: jobs.run_online(as_of(), 3), "general": lambda: jobs.run_general(as_of(), 3),
             "ingest_late": lambda: jobs.ingest_members(roster), "rebuild": lambda: jobs.rebuild(as_of(), "w", "G")}[job]()
            crashed = False
        except Crash:
            pass
    monkeypatch.setattr(Tables, "put", put)
    jobs.run_until_caught_up(as_of(), None)
    assert differing(jobs, want) == []
    assert at > 3


def test_late_and_split_snapshots_rebuild_the_guild(spark, tmp_root, small):
    roster, want = small
    split = F.col("character_name") == "b"
    late = F.col("extracted_at_utc") == F.lit(DAY + dt.timedelta(hours=2)).cast("timestamp_ntz")
    jobs = SnapshotJobs(spark, tmp_root)
    for part in (roster.filter(~split & ~late), roster.filter(split & ~late), roster.filter(late)):
        assert jobs.ingest_members(part).count() == part.count()
        jobs.run_until_caught_up(as_of(), None)
    assert differing(jobs, want) == []


def test_ingest_stores_documents_and_reports(spark, tmp_root, small):
    roster = small[0]
    docs = RW.envelopes_from_roster(roster).drop("snapshot_date")
    jobs = SnapshotJobs(spark, tmp_root)
    report = jobs.ingest_envelopes(docs, as_of(), clean=False).first()
    assert (report["document_rows"], report["raw_rows"], report["member_rows"], report["rebuilt_guilds"]) == \
        (10, 10, roster.count(), 0)
    report = jobs.ingest_envelopes(docs, as_of(), clean=False).first()
    assert (report["raw_rows"], report["member_rows"]) == (0, 0)
    assert jobs.table("raw").count() == 10
    assert [r.run_type for r in jobs.table("run_log").collect()] == ["ingest"] * 2


def test_rebuild_one_guild(spark, tmp_root, small):
    roster, want = small
    jobs = SnapshotJobs(spark, tmp_root)
    jobs.ingest_members(roster)
    jobs.run_until_caught_up(as_of(), None)
    report = jobs.rebuild(as_of(), "w", "G").first()
    columns = {n: sorted(d.columns).index("guild_name") for n, d in ((n, jobs.table(n)) for n in want)}
    full = {n: sum(k for r, k in rows.items() if r[columns[n]] == "G") for n, rows in want.items()}
    assert {n: report[f"{n}_rows"] for n in full} == full
    assert differing(jobs, want) == []
    assert jobs.run_online(as_of()).first()["processed_pairs"] == 0  # the ledgers hold its pairs


def test_retention_drops_old_rows_only(spark, tmp_root, small):
    roster = small[0]
    jobs = SnapshotJobs(spark, tmp_root)
    jobs.ingest_members(roster)
    jobs.run_until_caught_up(as_of(), 3)
    cutoff = roster.agg(F.max("extracted_at_utc")).first()[0] - dt.timedelta(days=1)
    kept = {n: {tuple(r) for r in jobs.table(n).filter(F.col(c) >= F.lit(cutoff).cast("timestamp_ntz")).collect()}
            for n, c in (("members", "extracted_at_utc"), ("intervals", "latest_snapshot_time"),
                         ("joins", "latest_snapshot_time"), ("pairs", "latest_snapshot_time"))}
    totals = jobs.table("totals").collect()
    report = {r.step_name: r.deleted_rows for r in jobs.run_retention(1).collect()}
    assert report["guild_member_snapshot"] == roster.count() - len(kept["members"]) > 0
    for name, rows in kept.items():
        assert {tuple(r) for r in jobs.table(name).collect()} == rows, name
    assert sorted(jobs.table("totals").collect()) == sorted(totals)
    assert sum(r.deleted_rows for r in jobs.run_retention(1).collect()) == 0


def spoil(root, tables, before):
    """Make the stored files of older days unreadable."""
    spoilt = 0
    for path in files(root):
        parts = dict(p.split("=") for p in path.split("/") if "=" in p)
        if path.split(root)[1].split("/")[1] in tables and path.endswith(".parquet") and parts.get("day", "9") < before:
            with open(path, "wb") as f:
                f.write(b"spoilt")
            os.path.exists(crc := os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")) and os.remove(crc)
            spoilt += 1
    return spoilt


def test_increments_read_only_their_batch(spark, tmp_root):
    """Members, documents and results of older days cannot be read any more, and
    nor can the ledgers and definitions of runs before the last that left no
    pair over: ingest, online and general still run and give what a rebuild
    gives of the new days."""
    roster = small_roster(spark, (0, 1, 2, 26, 27, 50, 51, 74, 75))
    RW.envelopes_from_roster(roster).drop("snapshot_date").write.parquet(f"{tmp_root}-docs")  # one text per document
    docs = spark.read.parquet(f"{tmp_root}-docs")
    t = F.col("metadata.extracted_at_utc")
    jobs = SnapshotJobs(spark, tmp_root)
    jobs.ingest_envelopes(docs.filter(t < "2024-01-03"), as_of(), clean=False)
    jobs.run_until_caught_up(as_of(), None)
    jobs.ingest_envelopes(docs.filter((t >= "2024-01-03") & (t < "2024-01-04")), as_of(), clean=False)
    jobs.run_until_caught_up(as_of(), None)
    old = [p for p in files(tmp_root) if "/due_" in p or "_ledger/" in p]
    tables = ("members", "raw", "snapshots", "intervals", "days", "pairs", "level_changes", "joins", "leaves", "rank_changes")
    assert spoil(tmp_root, tables, "2024-01-03") > 10
    heads = {k: max(jobs.store.batches(f"heads_{k}")) for k in ("online", "general")}
    for path in old:
        if path.endswith(".parquet") and int(path.split("batch=")[1].split("/")[0]) < min(heads.values()):
            with open(path, "wb") as f:
                f.write(b"spoilt")
    report = jobs.ingest_envelopes(docs.filter(t >= "2024-01-04"), as_of(), clean=False).first()
    assert report["member_rows"] == roster.filter("extracted_at_utc >= '2024-01-04'").count() > 0
    assert jobs.ingest_envelopes(docs.filter(t >= "2024-01-04"), as_of(), clean=False).first()["raw_rows"] == 0
    jobs.run_until_caught_up(as_of(), None)
    want = RB.rebuild_all(roster)
    days = [dt.date(2024, 1, 4)]
    for name in ("intervals", "level_changes", "joins", "leaves", "rank_changes", "pairs"):
        fresh = F.to_date("latest_snapshot_time") == F.lit(days[0])
        assert rows_of(jobs.table(name, days)) == rows_of(want[name].filter(fresh)), name
    assert rows_of(jobs.table("days", days)) == rows_of(want["days"].filter(F.col("activity_date") == F.lit(days[0])))
    assert rows_of(jobs.latest_members().select("character_name", "current_level", "latest_snapshot_time")) == \
        rows_of(want["latest_members"].select("character_name", "current_level", "latest_snapshot_time"))


def test_stored_reads_name_their_days(spark, tmp_root, small):
    jobs = SnapshotJobs(spark, tmp_root)
    jobs.ingest_members(small[0])
    jobs.run_until_caught_up(as_of(), None)
    plan = jobs.table("intervals", [dt.date(2024, 1, 2)])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan.replace("\n", " ") or "day#" in plan.split("PartitionFilters")[1][:80]


def test_numbers_and_leases_belong_to_one(spark, tmp_root):
    t, got = Tables(spark, tmp_root), []
    threads = [threading.Thread(target=lambda: got.extend(t.claim() for _ in range(10))) for _ in range(6)]
    [x.start() for x in threads], [x.join() for x in threads]
    assert sorted(got) == list(range(1, 61))
    t.forget_claims(60)
    assert t.claim() == 61
    with t.lease("online") as first, t.lease("online") as second, t.lease("general") as other:
        assert (first, second, other) == (True, False, True)
    with t.lease("online"):
        os.utime(f"{tmp_root}/_leases/online", (1, 1))  # its run died long ago
        with t.lease("online") as taken_over:
            assert taken_over


def test_overlapping_runs_lose_nothing(spark, tmp_root, small):
    """Ingest in pieces, two online and two general runs, all at once."""
    roster, want = small
    jobs, failed = SnapshotJobs(spark, tmp_root), []
    pieces = [roster.filter(F.pmod(F.xxhash64("extracted_at_utc", "guild_name"), F.lit(3)) == k) for k in range(3)]
    ingested = threading.Event()

    def guarded(work):
        def run():
            try:
                work()
            except Exception as e:  # noqa: BLE001
                failed.append(e)
        return threading.Thread(target=run)

    def ingest():
        for piece in pieces:
            jobs.ingest_members(piece)
        ingested.set()

    def drain(job, **kw):
        def run():
            until = time.time() + 240
            while time.time() < until:
                last = ingested.is_set()
                if not job(as_of(), 3, **kw).first()["processed_pairs"] and last and not jobs._open("online"):
                    return
        return run

    threads = [guarded(ingest)] + [guarded(drain(jobs.run_online)) for _ in range(2)] + \
        [guarded(drain(jobs.run_general, after_online=True)) for _ in range(2)]
    [x.start() for x in threads], [x.join() for x in threads]
    assert failed == []
    jobs.run_until_caught_up(as_of(), None)
    assert differing(jobs, want) == []


def test_compaction_changes_nothing_that_is_read(spark, tmp_root, small):
    roster, want = small
    jobs = SnapshotJobs(spark, tmp_root)
    jobs.ingest_members(roster.filter("extracted_at_utc < '2024-01-01 02:30:00'"))
    jobs.run_until_caught_up(as_of(), None)
    jobs.ingest_members(roster)
    jobs.run_online(as_of(), 1)
    jobs.run_until_caught_up(as_of(), None)
    jobs.rebuild(as_of(), "w", "G")
    before = {n: rows_of(jobs.table(n)) for n in (*RESULTS, "members", "snapshots", "signs", "online_ledger", "general_ledger")}
    assert jobs.compact() > 3
    assert {n: rows_of(jobs.table(n)) for n in before} == before and differing(jobs, want) == []
    for name in ("intervals", "online_ledger", "signs", "members"):
        assert len({b for b, _ in jobs.store.partitions(name, 2 if name in ("intervals", "members") else 0)}) == 1
    assert jobs.compact() == 0
    assert jobs.run_online(as_of()).first()["processed_pairs"] == 0
    more = small_roster(spark, (0, 1, 2, 3, 30, 40))
    jobs.ingest_members(more)
    jobs.run_until_caught_up(as_of(), 1)
    assert differing(jobs, rebuilt(more)) == []


def test_compaction_that_dies(spark, tmp_root, monkeypatch, small):
    """A crash at each write of a compaction, then at each folder it removes."""
    roster, want = small
    jobs = SnapshotJobs(spark, tmp_root)
    jobs.ingest_members(roster.filter("extracted_at_utc < '2024-01-01 02:30:00'"))
    jobs.run_until_caught_up(as_of(), None)
    jobs.ingest_members(roster)
    jobs.run_until_caught_up(as_of(), None)
    for method, steps in (("put", (2, 6, 99)), ("delete", (2,))):
        for at in steps:
            real, calls = getattr(Tables, method), [0]

            def failing(self, *a, **k):
                calls[0] += 1
                if calls[0] == at:
                    raise Crash
                return real(self, *a, **k)

            monkeypatch.setattr(Tables, method, failing)
            try:
                jobs.compact()
            except Crash:
                pass
            monkeypatch.setattr(Tables, method, real)
            assert differing(jobs, want) == [], (method, at)
            if at == 99:  # one that got through; then something to merge again
                jobs.ingest_members(small_roster(spark, (0, 1, 2, 3, 30, 31)))
                jobs.run_until_caught_up(as_of(), None)
                want = rebuilt(small_roster(spark, (0, 1, 2, 3, 30, 31)))
    jobs.compact()
    assert differing(jobs, want) == [] and not jobs.store.batches("compactions") | jobs.store.batches("compacting")


def test_large_limits_keep_the_oldest_pairs(spark, monkeypatch, small):
    from snapwise.operators import pairs as PR
    due = PR.snapshot_pairs(small[0])
    for limit in (1, 3, 7, 100):
        monkeypatch.setattr(PR, "ONE_TASK", 10 ** 6)
        want = rows_of(PR.oldest_pairs(due, limit))
        monkeypatch.setattr(PR, "ONE_TASK", 0)
        assert rows_of(PR.oldest_pairs(due, limit)) == want
    with pytest.raises(ValueError):
        PR.oldest_pairs(due, 0)


def test_ranges_and_newest_pairs_window_their_rows_only(spark, small):
    from snapwise.operators import changes as CH
    from snapwise.operators import pairs as PR
    roster = small_roster(spark, (0, 1, 2, 26, 50, 51, 90))
    cut = PR.around_range(roster, "2024-01-02", "2024-01-03")
    assert {r[0] for r in cut.filter("guild_name = 'G'").select("extracted_at_utc").distinct().collect()} == {
        DAY + dt.timedelta(hours=h) for h in (2, 26, 50, 51)}
    day = F.to_date("latest_snapshot_time").between(F.lit("2024-01-02"), F.lit("2024-01-03"))
    for events in (CH.level_changes, CH.member_joins, CH.member_leaves, CH.rank_changes):
        assert rows_of(events(cut).filter(day)) == rows_of(events(roster).filter(day))
    last = PR.newest_pair_rows(roster)
    newest = F.to_date("latest_snapshot_time") == F.lit("2024-01-04")
    assert rows_of(CH.member_leaves(last)) == rows_of(CH.member_leaves(roster).filter(newest))
    assert PR.around_range(roster, "2030-01-01", "2030-01-02").select("extracted_at_utc").distinct().count() == 2
    assert PR.newest_pair_rows(roster.limit(0)).count() == 0


def test_tables_overwrite_their_own_partitions(spark, tmp_root):
    t = Tables(spark, tmp_root)
    assert t.put("t", spark.range(3), 1) == 3
    assert t.put("t", spark.range(5), 2) == 5
    assert t.put("empty", spark.range(5).filter("id < 0"), 1) == 0
    t.put("t", spark.range(4), 1)  # the batch runs again
    df = t.read("t", "id long")
    assert sorted((r.batch, r.id) for r in df.collect()) == [(1, k) for k in range(4)] + [(2, k) for k in range(5)]
    assert t.batches("t") == {1, 2} and t.batches("none") == set()
    t.keep("t", df, F.col("id") == 4)
    assert [(r.batch, r.id) for r in t.read("t", "id long").collect()] == [(2, 4)]


def test_thin_folders_are_dealt_to_all_cores(spark, tmp_root):
    """A row per poll in a folder per day: no single task writes all of them."""
    jobs = SnapshotJobs(spark, tmp_root)
    jobs.ingest_members(small_roster(spark, tuple(range(0, 24 * 40, 12))))
    jobs.run_online(as_of(), None)
    jobs.run_general(as_of(), None)
    for name in ("snapshots", "pairs"):
        files = jobs.table(name).inputFiles()
        assert len(files) >= 40, name  # still one file for each folder
        assert len({f.rsplit("/part-", 1)[1][:5] for f in files}) > 3, name
