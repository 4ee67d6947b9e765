"""Persistent jobs over partitioned tables: ingest, online / general increments,
rebuilds, retention, compaction.

A job claims a batch number of its own, writes its definition (the due pairs)
under it, then its result rows, and its ledger rows last. Rows of a batch without
ledger rows are not read. A job that died is taken up again with the same
definition and number, and overwrites the partitions it had written.

What a run reads is its batch, whatever is stored: result tables, members and raw
documents are partitioned by world and day, and every read names the days of the
batch. The due pairs come from the snapshots stored since the last run that left
none over (its ``heads``: the newest snapshot of each guild then) and from the
guilds marked for a rebuild since.

A guild is rebuilt by one small append to ``rebuilds``: its derived and ledger
rows of all batches up to that number no longer count, so the next increments
see all its pairs as due. That append is atomic; nothing is rewritten.

Additive results are stored as parts per batch and summed when read: minutes per
day and member, and the last signs of life. The latest roster is the stored
members of each guild's newest snapshot with these signs. ``compact`` merges the
parts of many batches into one.

Runs of one kind exclude each other by a lease, and ingest and the taking of due
pairs by another, so ingest, online and general runs may overlap.
"""

from __future__ import annotations

import contextlib
import datetime as dt
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapwise.functions.exprs import DEFAULT_CAP_MINUTES, is_online
from snapwise.operators import activity as AC
from snapwise.operators.pairs import PAIR_KEY, due_pairs, oldest_pairs, scope
from snapwise.plans import incremental as INC
from snapwise.plans import retention as RT
from snapwise.plans.tables import BATCH, Tables
from snapwise.sources import raw as RW

TS = "timestamp_ntz"
# The column contracts of the stored tables.
SCHEMAS = {
    "members": f"snapshot_id string, extracted_at_utc {TS}, guild_name string, world string, "
               "character_name string, guild_rank string, vocation string, level int, status string, "
               "joined date",
    "intervals": f"guild_name string, world string, character_name string, previous_snapshot_time {TS}, "
                 f"latest_snapshot_time {TS}, previous_status string, latest_status string, "
                 "interval_minutes int, estimated_online_minutes int",
    "days": "guild_name string, world string, character_name string, activity_date date, "
            "estimated_online_minutes int, online_interval_rows int",
    "totals": "guild_name string, world string, character_name string, estimated_online_minutes int",
    "online_ledger": f"guild_name string, world string, previous_snapshot_time {TS}, "
                     f"latest_snapshot_time {TS}, processed_at_utc {TS}",
    "general_ledger": f"guild_name string, world string, previous_snapshot_time {TS}, "
                      f"latest_snapshot_time {TS}, processed_at_utc {TS}",
    "pairs": f"guild_name string, world string, previous_snapshot_time {TS}, latest_snapshot_time {TS}",
    "signs": f"guild_name string, world string, character_name string, last_online_at {TS}, "
             f"last_level_change_at {TS}",
    "raw": f"snapshot_id string, guild_name string, source string, extracted_at_utc {TS}, raw_json string, "
           "raw_hash string",
    "rebuilds": "guild_name string, world string",
    "run_log": f"run_type string, run_at_utc {TS}, report string",
    "snapshots": f"guild_name string, world string, extracted_at_utc {TS}",
    "heads": f"guild_name string, world string, extracted_at_utc {TS}",
    "level_changes": f"guild_name string, world string, character_name string, vocation string, "
                     f"guild_rank string, previous_level int, current_level int, level_gain int, "
                     f"previous_snapshot_time {TS}, latest_snapshot_time {TS}, estimated_online_minutes int",
    "joins": f"guild_name string, world string, character_name string, vocation string, level int, "
             f"guild_rank string, status string, joined_date date, previous_snapshot_time {TS}, "
             f"latest_snapshot_time {TS}",
    "leaves": f"guild_name string, world string, character_name string, vocation string, level int, "
              f"guild_rank string, status string, joined_date date, previous_snapshot_time {TS}, "
              f"latest_snapshot_time {TS}",
    "rank_changes": f"guild_name string, world string, character_name string, previous_guild_rank string, "
                    f"current_guild_rank string, previous_snapshot_time {TS}, latest_snapshot_time {TS}",
    "latest_members": f"guild_name string, world string, character_name string, vocation string, "
                      f"guild_rank string, current_level int, latest_snapshot_time {TS}, "
                      f"last_connected_at {TS}",
}
SNAPSHOT_KEY = ["world", "guild_name", "extracted_at_utc"]
MEMBER_KEY = ["guild_name", "world", "character_name"]
ROW_KEY = [*MEMBER_KEY, "extracted_at_utc"]
GUILD_KEY = ["guild_name", "world"]
#: The ledger that commits the batches of each kind of job, and the tables of
#: the kind that a reader must not see before.
LEDGERS = {"online": "online_ledger", "general": "general_ledger"}
KIND = {"intervals": "online", "days": "online", "totals": "online", "online_ledger": "online",
        "pairs": "general", "level_changes": "general", "joins": "general", "leaves": "general",
        "rank_changes": "general", "general_ledger": "general"}


#: The time column whose date is the partition of a table, and the partitions
#: (beside the batch) of the tables that have any.
TIME = {**dict.fromkeys(("members", "raw", "snapshots"), "extracted_at_utc"), "days": "activity_date",
        **dict.fromkeys(("intervals", "pairs", "level_changes", "joins", "leaves", "rank_changes"), "latest_snapshot_time")}
WORLD, DAY = "in_world", "day"
#: Tables with a row per poll, however many members it has.
THIN = ("snapshots", "pairs")
PARTS = {n: (DAY,) if n in ("raw", "snapshots") else (WORLD, DAY) for n in TIME}
#: Tables whose batches are merged by ``compact``, with the sums or maxima of the
#: additive ones.
ADDITIVE = {"days": F.sum, "totals": F.sum, "signs": F.max}
COMPACTED = ("members", "raw", "snapshots", *KIND, "signs")
#: Leases that whoever changes what others have read must hold.
ALL_LEASES = ("online", "general", "pairs")
WAIT_S = 600


class SnapshotJobs:
    """``dense`` keeps days and members without minutes."""

    def __init__(self, spark: SparkSession, root: str, dense: bool = False):
        self.spark = spark
        self.dense = dense
        self.store = Tables(spark, root)

    # -- state --------------------------------------------------------------
    def _open(self, kind: str) -> set[int]:
        """Batches of a kind that are defined and not committed: at most one."""
        return self.store.batches(f"due_{kind}") - self.store.batches(LEDGERS[kind])

    def _put(self, name: str, rows: DataFrame, batch: int) -> int:
        """Write a batch's rows of a table in its partitions; their number."""
        rows = rows.select(*self._columns(name))
        if name in TIME:
            rows = rows.withColumn(DAY, F.to_date(TIME[name]))
        if WORLD in PARTS.get(name, ()):
            rows = rows.withColumn(WORLD, F.col("world"))
        return self.store.put(name, rows, batch, PARTS.get(name, ()), thin=name in THIN)

    def _read(self, name: str, days: list | None = None, after: int | None = None) -> DataFrame:
        """Stored rows of a table with their partition columns: of the given days,
        or of batches after a number."""
        by = ", ".join(f"{p} {'date' if p == DAY else 'string'}" for p in PARTS.get(name, ()))
        df = self.store.read(name, SCHEMAS[name], f"{by}, {BATCH} long" if by else f"{BATCH} long").filter(F.col(BATCH) >= 0)
        if days is not None:
            df = df.filter(F.col(DAY).isin(*days) if None not in days
                           else F.col(DAY).isNull() | F.col(DAY).isin(*(set(days) - {None})))
        return df if after is None else df.filter(F.col(BATCH) > after)

    def _hidden(self, name: str) -> set[int]:
        """Batches whose rows of a table do not count: open ones, a compaction
        that is not committed, and what a committed one replaces."""
        kinds = [KIND[name]] if name in KIND else list(LEDGERS) if name == "signs" else []
        hidden = set().union(*(self._open(k) for k in kinds))
        done = self.store.batches("compactions")
        hidden |= self.store.batches("compacting") - done
        if done:
            rows = self.store.read("compactions", "name string, replaced long").filter(F.col("name") == name)
            hidden |= {r.replaced for r in rows.select("replaced").collect()}
        return hidden

    def _stored(self, name: str, days: list | None = None, after: int | None = None) -> DataFrame:
        """Rows of committed batches that no later rebuild voids."""
        df = self._read(name, days, after)
        if gone := self._hidden(name):
            df = df.filter(~F.col(BATCH).isin(*gone))
        if (name in KIND or name == "signs") and self.store.exists("rebuilds"):
            void = self.store.read("rebuilds", SCHEMAS["rebuilds"]).groupBy(*GUILD_KEY).agg(F.max(BATCH).alias("_void"))
            df = df.join(void, GUILD_KEY, "left").filter(F.col(BATCH) > F.coalesce("_void", F.lit(-1))).drop("_void")
        return df

    def table(self, name: str, days: list | None = None) -> DataFrame:
        """The rows of a table as a reader sees them, all or of the given days."""
        if name == "latest_members":
            return self.latest_members()
        rows = self._stored(name, days)
        columns = self._columns(name)
        if name in ADDITIVE:
            rows = self._summed(name, rows)
            if name != "signs" and not self.dense:
                rows = rows.filter(F.col("estimated_online_minutes") > 0)
        return rows.select(*columns)

    def _summed(self, name: str, rows: DataFrame) -> DataFrame:
        key = [*MEMBER_KEY, "activity_date"] if name == "days" else MEMBER_KEY
        sums = [c for c in self._columns(name) if c not in key]
        types = dict(rows.dtypes)
        return rows.groupBy(*key).agg(*[ADDITIVE[name](c).cast(types[c]).alias(c) for c in sums])

    @staticmethod
    def _columns(name: str) -> list[str]:
        return [c.split()[0] for c in SCHEMAS[name].split(", ")]

    @staticmethod
    def _days(times: DataFrame, column: str) -> list:
        """The days of a batch (calendar days come to the driver, never rows)."""
        return [r[0] for r in times.select(F.to_date(column)).distinct().collect()]

    def members(self) -> DataFrame:
        return self.table("members")

    def snapshots(self) -> DataFrame:
        """One row per stored poll (world, guild, time)."""
        return self.table("snapshots")

    def members_at(self, times: DataFrame) -> DataFrame:
        """Member rows of the given (world, guild, time) snapshots; only the
        folders of their days are read."""
        times = self.store.work(times.select(*SNAPSHOT_KEY).distinct())
        return self._stored("members", self._days(times, "extracted_at_utc")) \
            .join(times, SNAPSHOT_KEY, "left_semi").select(*self._columns("members"))

    def newest_snapshots(self) -> DataFrame:
        """The newest poll of each guild: the last heads and what came since."""
        heads, after = self._heads()
        return heads.unionByName(self._stored("snapshots", after=after).select(*SNAPSHOT_KEY)) \
            .groupBy("world", "guild_name").agg(F.max("extracted_at_utc").alias("extracted_at_utc"))

    def latest_members(self) -> DataFrame:
        return self.members_at(self.newest_snapshots()).join(self.table("signs"), MEMBER_KEY, "left").select(
            *MEMBER_KEY, "vocation", "guild_rank", F.col("level").alias("current_level"),
            F.col("extracted_at_utc").alias("latest_snapshot_time"),
            F.greatest("last_online_at", "last_level_change_at").alias("last_connected_at")) \
            .select(*self._columns("latest_members"))

    def online_state(self) -> INC.OnlineState:
        return INC.OnlineState(*(self.table(n) for n in ("intervals", "days", "totals", "online_ledger")))

    def _log(self, run_type: str, as_of: Column, report: DataFrame, batch: int) -> DataFrame:
        row = report.select(F.lit(run_type).alias("run_type"), as_of.alias("run_at_utc"),
                            F.to_json(F.struct(*report.columns)).alias("report"))
        self.store.put("run_log", row, batch)
        return report

    def _report(self, counts: dict[str, int], **given) -> DataFrame:
        """One row of the counts taken while a run wrote, and its parameters."""
        values = [F.lit(n).cast("bigint").alias(name) for name, n in counts.items()]
        params = [F.lit(v).cast("string").alias(k) if v is None else F.lit(v).alias(k) for k, v in given.items()]
        return self.spark.range(1).select(F.lit(True).alias("success"), *values, *params)

    # -- ingest (A04, A10) --------------------------------------------------
    def ingest_envelopes(self, envelopes: DataFrame, as_of: Column | None = None, clean: bool = True) -> DataFrame:
        """Store the raw documents, insert their new member rows, log the run;
        returns its one-row report. A document is known by its snapshot and the
        hash of its text among those of its day; no stored text is read."""
        envelopes = self.store.work(envelopes)
        raw = self.store.work(RW.raw_table(envelopes).withColumn("raw_hash", F.sha2("raw_json", 256))
                              .dropDuplicates(["snapshot_id", "raw_hash"]))
        known = self._stored("raw", self._days(raw, "extracted_at_utc")).select("snapshot_id", "raw_hash")
        fresh = raw.join(known, ["snapshot_id", "raw_hash"], "left_anti")
        rows = RW.flatten(envelopes, clean=clean).filter(F.col("world").isNotNull())
        batch, counts = self._ingest(rows, fresh)
        if batch is None:
            batch = self.store.claim()
        as_of = F.lit(None).cast(TS) if as_of is None else as_of
        return self._log("ingest", as_of, self._report({"document_rows": envelopes.count(), **counts}), batch)

    def ingest_members(self, rows: DataFrame) -> DataFrame:
        """A10 insert-ignore; returns the rows that were added.

        The guard reads only the stored rows of the incoming days, so a
        redelivered batch writes nothing and a new one costs O(batch)."""
        batch, _ = self._ingest(rows)
        if batch is None:
            return rows.select(*self._columns("members")).limit(0)
        return self._rows_of("members", batch)

    def _ingest(self, rows: DataFrame, raw: DataFrame | None = None) -> tuple[int | None, dict[str, int]]:
        """The batch number (None where nothing is new) and the counts."""
        rows = self.store.work(rows.select(*self._columns("members")))
        raw = None if raw is None else self.store.work(raw)
        # Pairs are not taken while snapshots are stored, nor the other way round.
        with self.store.lease("pairs", WAIT_S) as mine:
            if not mine:
                raise TimeoutError("another run keeps the lease on the pairs")
            snaps = self.store.work(rows.select(*SNAPSHOT_KEY).distinct())
            days = self._days(snaps, "extracted_at_utc")
            new = self.store.work(RW.insert_ignore(self._stored("members", days), rows, ROW_KEY))
            late = self.store.work(late_guilds(new, self._taken_pairs()))
            unknown = self.store.work(snaps.join(self._stored("snapshots", days), SNAPSHOT_KEY, "left_anti"))
            nothing = (new.isEmpty(), unknown.isEmpty(), raw is None or raw.isEmpty())
            counts = {"raw_rows": 0, "member_rows": 0, "rebuilt_guilds": 0}
            if all(nothing):
                return None, counts
            batch = self.store.claim()
            # First the mark: a crash after it costs a rebuild, one before the
            # members are stored leaves the delivery to be repeated.
            if not late.isEmpty():
                counts["rebuilt_guilds"] = self._put("rebuilds", late, batch)
            if not nothing[0]:
                counts["member_rows"] = self._put("members", new, batch)
            if not nothing[1]:
                self._put("snapshots", unknown, batch)
            if not nothing[2]:
                counts["raw_rows"] = self._put("raw", raw, batch)
        return batch, counts

    # -- increments (K01-K03) ----------------------------------------------
    def _heads(self, kind: str = "online") -> tuple[DataFrame, int]:
        """The newest snapshot of each guild when a committed run of a kind last
        left no pair over, and that run's number (-1: never)."""
        done = self.store.batches(f"heads_{kind}") - self._open(kind)
        last = max(done, default=-1)
        return self.store.read(f"heads_{kind}", SCHEMAS["heads"]).filter(F.col(BATCH) == last).select(*SNAPSHOT_KEY), last

    def _taken_pairs(self) -> DataFrame:
        """The pairs of committed and open batches; of those before the last
        heads, the guild's newest snapshot stands for all."""
        frames = []
        for kind in LEDGERS:
            heads, after = self._heads(kind)
            frames.append(heads.select("guild_name", "world", F.col("extracted_at_utc").alias("previous_snapshot_time"),
                                       F.col("extracted_at_utc").alias("latest_snapshot_time")))
            frames.append(self._stored(LEDGERS[kind], after=after).select(*PAIR_KEY))
            if left := self._open(kind):
                frames.append(self.store.read(f"due_{kind}", SCHEMAS["pairs"]).filter(F.col(BATCH).isin(*left)).select(*PAIR_KEY))
        pairs = frames[0]
        for f in frames[1:]:
            pairs = pairs.unionByName(f)
        return pairs

    def _recent_snapshots(self, kind: str) -> tuple[DataFrame, int]:
        """The snapshots that due pairs can have: the heads, those stored since,
        and all of the guilds that a rebuild was marked for since."""
        heads, after = self._heads(kind)
        since = self._stored("snapshots", after=after).select(*SNAPSHOT_KEY)
        recent = heads.unionByName(since)
        if after >= 0 and self.store.exists("rebuilds"):
            marked = self.store.read("rebuilds", SCHEMAS["rebuilds"]).filter(F.col(BATCH) > after).select(*GUILD_KEY).distinct()
            if not marked.isEmpty():
                recent = recent.unionByName(self._stored("snapshots").join(marked, GUILD_KEY, "left_semi").select(*SNAPSHOT_KEY))
        return recent.distinct(), after

    def _take(self, kind: str, pair_limit: int | None, world: str | None, guild_name: str | None,
              after_online: bool = False):
        """(batch number, due pairs) of an open batch, else of a new one; the
        number is None where nothing is due."""
        name = f"due_{kind}"
        with self.store.lease("pairs", WAIT_S) as mine:
            if not mine:
                raise TimeoutError("another run keeps the lease on the pairs")
            left = self._open(kind)
            if not left:
                recent, after = self._recent_snapshots(kind)
                recent = self.store.work(recent)
                pairs = due_pairs(recent, self._stored(LEDGERS[kind], after=after), None)
                if after_online:
                    pairs = pairs.join(self._stored("online_ledger", after=after).select(*PAIR_KEY), PAIR_KEY, "left_semi")
                due = self.store.work(oldest_pairs(scope(pairs, world, guild_name), pair_limit))
                if due.isEmpty():
                    return None, due
                left = {self.store.claim()}
                if due_pairs(recent, self._stored(LEDGERS[kind], after=after), None).count() == due.count():
                    newest = recent.groupBy("world", "guild_name").agg(F.max("extracted_at_utc").alias("extracted_at_utc"))
                    self.store.put(f"heads_{kind}", newest.select(*self._columns("heads")), *left)
                self.store.put(name, due.select(*PAIR_KEY), *left)
        batch = min(left)
        due = self.store.read(name, SCHEMAS["pairs"]).filter(F.col(BATCH) == batch).select(*PAIR_KEY)
        return batch, due

    def _timeline(self, due: DataFrame) -> DataFrame:
        """The timeline of the due pairs' own snapshots; nothing older is read.
        Its neighbours are those of the pairs."""
        ends = due.select("world", "guild_name", F.col("latest_snapshot_time").alias("extracted_at_utc"),
                          "previous_snapshot_time", F.lit(None).cast(TS).alias("next_snapshot_time"))
        begins = due.select("world", "guild_name", F.col("previous_snapshot_time").alias("extracted_at_utc"),
                            F.lit(None).cast(TS).alias("previous_snapshot_time"),
                            F.col("latest_snapshot_time").alias("next_snapshot_time"))
        index = ends.unionByName(begins).groupBy(*SNAPSHOT_KEY).agg(
            F.max("previous_snapshot_time").alias("previous_snapshot_time"),
            F.max("next_snapshot_time").alias("next_snapshot_time"))
        return INC.due_timeline(self.members_at(index), due, index=index)

    def _commit(self, kind: str, due: DataFrame, as_of: Column, batch: int) -> int:
        return self._put(LEDGERS[kind], due.select(*PAIR_KEY, as_of.alias("processed_at_utc")), batch)

    def _rows_of(self, name: str, batch: int, days: list | None = None) -> DataFrame:
        return self._read(name, days).filter(F.col(BATCH) == batch).select(*self._columns(name))

    def run_online(self, as_of: Column, pair_limit: int | None = 100, world: str | None = None,
                   guild_name: str | None = None, cap: int = DEFAULT_CAP_MINUTES) -> DataFrame:
        with self.store.lease("online") as mine:
            if not mine:
                return self._empty_report("Another run is processing")
            batch, due = self._take("online", pair_limit, world, guild_name)
            if batch is None:
                return self._empty_report()
            rows = INC.batch_intervals(self._timeline(due), due, cap, self.dense)
            counts = {"online_interval_rows": self._put("intervals", rows, batch)}
            new = self._rows_of("intervals", batch, self._days(due, "latest_snapshot_time"))
            # Stored parts include zeros; the report counts what the batch adds to.
            self._put("days", AC.minutes_by_day(new, keep_zero=True), batch)
            self._put("totals", AC.minutes_total(new, keep_zero=True), batch)
            self._put("signs", new.filter(is_online(F.col("previous_status"))).groupBy(*MEMBER_KEY).agg(
                F.max("previous_snapshot_time").alias("last_online_at"),
                F.lit(None).cast(TS).alias("last_level_change_at")), batch)
            pairs = self._commit("online", due, as_of, batch)
            parts = (("daily_online_minutes_rows", self._rows_of("days", batch, self._days(due, "latest_snapshot_time"))),
                     ("all_time_online_minutes_rows", self._rows_of("totals", batch)))
            for name, part in parts:
                counts[name] = part.filter(F.lit(self.dense) | (F.col("estimated_online_minutes") > 0)).count()
            report = self._report(
                {"processed_pairs": pairs, **counts, "processed_pair_rows_written": pairs},
                scope_world=world, scope_guild_name=guild_name, pair_limit=pair_limit,
                storage_policy="dense_intervals" if self.dense else "store_previous_online_intervals_only")
            return self._log("online", as_of, report, batch)

    def run_general(self, as_of: Column, pair_limit: int | None = 100, world: str | None = None,
                    guild_name: str | None = None, cap: int = DEFAULT_CAP_MINUTES,
                    after_online: bool = False) -> DataFrame:
        """``after_online`` leaves pairs to a later run that no online run has
        committed yet (N07 where the two overlap)."""
        with self.store.lease("general") as mine:
            if not mine:
                return self._empty_report("Another run is processing")
            batch, due = self._take("general", pair_limit, world, guild_name, after_online)
            if batch is None:
                return self._empty_report()
            days = self._days(due, "latest_snapshot_time")
            minutes = self.table("intervals", days).join(due, PAIR_KEY, "left_semi")
            events = INC.batch_events(self.store.work(self._timeline(due)), due, minutes, cap)
            rows = {name: self._put(name, df, batch) for name, df in events.items()}
            self._put("signs", self._rows_of("level_changes", batch, days).groupBy(*MEMBER_KEY).agg(
                F.lit(None).cast(TS).alias("last_online_at"),
                F.max("latest_snapshot_time").alias("last_level_change_at")), batch)
            pairs = self._commit("general", due, as_of, batch)
            newest = self.newest_snapshots().join(due.select(*GUILD_KEY).distinct(), GUILD_KEY, "left_semi")
            report = self._report(
                {"processed_pairs": pairs, "snapshot_pair_rows": rows["pairs"], "level_change_rows": rows["level_changes"],
                 "join_rows": rows["joins"], "leave_rows": rows["leaves"], "rank_change_rows": rows["rank_changes"],
                 "latest_member_rows": self.members_at(newest).count(), "processed_pair_rows_written": pairs},
                scope_world=world, scope_guild_name=guild_name, pair_limit=pair_limit)
            return self._log("general", as_of, report, batch)

    def run_until_caught_up(self, as_of: Column, pair_limit: int | None = 100) -> int:
        """Online then general (N07 order) until no pair is due; the number of
        rounds. Each round commits its pairs, so their number only falls."""
        rounds = 0
        while True:
            resumed = any(self._open(kind) for kind in LEDGERS)
            done = [job(as_of, pair_limit).first()["processed_pairs"] for job in (self.run_online, self.run_general)]
            self.store.clear_work()
            rounds += 1
            # A new batch below the limit leaves nothing over.
            if not any(done) or not resumed and all(n < (pair_limit or n + 1) for n in done):
                return rounds

    def _empty_report(self, message: str = "No unprocessed snapshot pairs found") -> DataFrame:
        return self.spark.range(1).select(F.lit(True).alias("success"),
                                          F.lit(0).cast("bigint").alias("processed_pairs"),
                                          F.lit(message).alias("message"))

    # -- rebuild / retention / compaction (K04, K06, K14) -------------------
    @contextlib.contextmanager
    def _alone(self) -> Iterator[None]:
        """No other run takes pairs, processes or stores meanwhile."""
        with contextlib.ExitStack() as held:
            for name in ALL_LEASES:
                if not held.enter_context(self.store.lease(name, WAIT_S)):
                    raise TimeoutError(f"another run keeps the lease {name}")
            yield

    def rebuild(self, as_of: Column, world: str | None = None, guild_name: str | None = None,
                pair_limit: int | None = None) -> DataFrame:
        """Recompute a guild, a world or everything from the members:
        mark it, then run the increments over all its pairs at once (or in
        batches). Other guilds' rows are neither read nor written. Returns the
        row counts of the scope by table; the ledgers hold its pairs."""
        with self.store.lease("pairs", WAIT_S) as mine:
            if not mine:
                raise TimeoutError("another run keeps the lease on the pairs")
            guilds = scope(self.snapshots(), world, guild_name).select(*GUILD_KEY).distinct()
            self._put("rebuilds", guilds, self.store.claim())
        for job in (self.run_online, self.run_general):
            while job(as_of, pair_limit, world, guild_name).first()["processed_pairs"]:
                pass
        names = ("pairs", "level_changes", "joins", "leaves", "rank_changes", "intervals", "days", "totals",
                 "latest_members")
        return self.store.work(INC._counts_report(
            {f"{n}_rows": scope(self.table(n), world, guild_name) for n in names},
            {"scope_world": world, "scope_guild_name": guild_name}))

    def run_retention(self, days: int = 7) -> DataFrame:
        """Report the rows older than the cutoff, then drop them. Days
        before the cutoff's are read from their folders and the folders dropped;
        only the cutoff's own day is rewritten. A crash leaves rows that the
        next run drops."""
        names = ("days", "intervals", "level_changes", "joins", "leaves", "rank_changes", "pairs", "members", "raw")
        with self._alone():
            # Snapshots that came without a document still age (A10 alone).
            source = "raw" if self.store.exists("raw") else "snapshots"
            cutoff = self._read(source).agg(F.max("extracted_at_utc")).first()[0]
            if cutoff is None:
                empty = {n: self.table(n if n != "raw" else source) for n in names}
                return self.store.work(RT.apply_retention(empty, days)[1])
            cutoff -= dt.timedelta(days=int(days))
            cut = F.lit(cutoff).cast(TS)
            old = (F.col(DAY) <= F.lit(cutoff.date())) | F.col(DAY).isNull()
            tables = {}
            for name in names:
                rows = self._stored(name if name != "raw" else source).filter(old)
                tables[name] = self._summed(name, rows).filter(F.lit(self.dense) | (F.col("estimated_online_minutes") > 0)) \
                    if name == "days" else rows
            report = self.store.work(RT.apply_retention(tables, days, cut)[1])
            steps = {key: (col, by_date) for _, key, col, by_date in RT.RETENTION_STEPS}
            for name in (*names, "snapshots"):
                if self.store.exists(name):
                    col, by_date = steps.get(name, ("extracted_at_utc", False))
                    fresh = F.coalesce(F.col(col) >= (F.to_date(cut) if by_date else cut), F.lit(True))
                    self.store.keep(name, self._read(name).filter(old), fresh, PARTS[name])
            # Heads may name snapshots that are gone.
            for kind in LEDGERS:
                self.store.drop_table(f"heads_{kind}")
            return report

    def compact(self) -> int:
        """Merge all committed batches of every table into one; the number of
        batches that it replaced. Readers see the same rows before and after.

        The merged rows are written under a new number that no reader counts
        until the list of replaced numbers is committed; then the old folders
        go. A compaction that died before its commit is undone by the next one,
        one that died after it is finished. Voided rows go with it."""
        with self._alone():
            self._finish_compaction()
            if any(self._open(kind) for kind in LEDGERS):
                return 0
            found = {n: sorted({b for b, _ in self.store.partitions(n, len(PARTS.get(n, ())))}) for n in COMPACTED}
            found = {n: b for n, b in found.items() if len(b) > 1}
            if not found:
                return 0
            batch = self.store.claim()
            self.store.put("compacting", self.spark.range(1), batch)
            for name in found:
                rows = self._stored(name)
                self._put(name, self.store.work(self._summed(name, rows) if name in ADDITIVE else rows), batch)
            # A definition whose ledger rows are merged is no open batch.
            done = {n: b for n, b in found.items()}
            for kind, ledger in LEDGERS.items():
                if ledger in found:
                    done[f"due_{kind}"] = found[ledger]
            rows = [(n, b) for n, numbers in done.items() for b in numbers]
            self.store.put("compactions", self.spark.createDataFrame(rows, "name string, replaced long"), batch)
            self._finish_compaction()
            self.store.forget_claims(batch)
            self.store.clear_work()
            return len(set().union(*found.values()))

    def _finish_compaction(self) -> None:
        committed = self.store.batches("compactions")
        for batch in self.store.batches("compacting") - committed:
            for name in COMPACTED:
                for number, folder in self.store.partitions(name, len(PARTS.get(name, ()))):
                    if number == batch:
                        self.store.delete(folder)
            self.store.drop("compacting", batch)
        for batch in committed:
            replaced = {}
            for r in self.store.read("compactions", "name string, replaced long").filter(F.col(BATCH) == batch).collect():
                replaced.setdefault(r.name, set()).add(r.replaced)
            # Definitions first: a ledger's batches are open without its rows.
            for name in sorted(replaced, key=lambda n: not n.startswith("due_")):
                for number, folder in self.store.partitions(name, len(PARTS.get(name, ()))):
                    if number in replaced[name]:
                        self.store.delete(folder)
            self.store.drop("compacting", batch)
            self.store.drop("compactions", batch)


def late_guilds(new_members: DataFrame, ledger: DataFrame) -> DataFrame:
    """Guilds that received rows of a snapshot at or before their newest
    processed pair end: an older snapshot splits a processed pair, further rows
    of a processed one change its joins, leaves and roster."""
    frontier = ledger.groupBy("world", "guild_name").agg(F.max("latest_snapshot_time").alias("_f"))
    t = new_members.select(*SNAPSHOT_KEY).distinct()
    return (t.join(frontier, ["world", "guild_name"])
             .filter(F.col("extracted_at_utc") <= F.col("_f"))
             .select("world", "guild_name").distinct())
