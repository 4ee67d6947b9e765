"""Roster changes from state that the stream keeps per guild.

A guild's previous roster is state, so joins, leaves, level and rank changes and
online intervals of a new snapshot come out without reading a stored member row.
Documents wait in state until the watermark has passed their time: late, split
and shuffled arrival inside the watermark's delay gives the same events as a
rebuild. A guild is dealt by member into ``parts`` groups of its own; every
document reaches all of them (a member who left is one a document does not name),
so a guild with a third of all rows is no single task's.

State of a group: the time of its last processed snapshot and the members of that
snapshot (values), the members of snapshots that wait, by time and number of the
write (a map). Members are kept as one Arrow record batch, so a snapshot costs a
group a few state calls however many members it has, and documents that add to a
snapshot write what they bring and read nothing. An event-time timer for the oldest
waiting snapshot processes all that the watermark has passed; one more lets the
roster of a guild go that has not been seen for ``expire_ms``, if given.

The events are one table, appended by Spark's file sink (exactly once); ``of_kind``
gives the rows of one kind with the columns of its result table.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from snapwise.functions.exprs import DEFAULT_CAP_MINUTES, ONLINE_STATUS, nonempty, parse_joined_date
from snapwise.session import fresh_dir
from snapwise.sources import raw as RW

# The columns of the events, and those of each kind's result table.
MEMBER = "name string, guild_rank string, vocation string, level int, status string, joined date"
STORED = pa.schema([("name", pa.string()), ("guild_rank", pa.string()), ("vocation", pa.string()),
                    ("level", pa.int32()), ("status", pa.string()), ("joined", pa.date32())])
EVENTS = ("kind string, guild_name string, world string, character_name string, vocation string, "
          "guild_rank string, level int, status string, joined_date date, previous_level int, "
          "previous_guild_rank string, previous_status string, interval_minutes int, "
          "estimated_online_minutes int, previous_micros long, latest_micros long")
_PAIR = ["previous_snapshot_time", "latest_snapshot_time"]
_MOVE = ["guild_name", "world", "character_name", "vocation", "level", "guild_rank", "status", "joined_date", *_PAIR]
KINDS = {
    "level_change": ["guild_name", "world", "character_name", "vocation", "guild_rank", "previous_level",
                     "level AS current_level", "level - previous_level AS level_gain", *_PAIR, "estimated_online_minutes"],
    "join": _MOVE, "leave": _MOVE,
    "rank_change": ["guild_name", "world", "character_name", "previous_guild_rank",
                    "guild_rank AS current_guild_rank", *_PAIR],
    "interval": ["guild_name", "world", "character_name", *_PAIR, "previous_status", "status AS latest_status",
                 "interval_minutes", "estimated_online_minutes"],
}
#: Members of a guild's snapshot that one group is to hold, and the least number
#: of groups that a guild is dealt into.
MEMBERS_PER_PART, LEAST_PARTS = 1000, 4
#: Rows of a group that a task collects before it writes them to the state, and
#: events that it collects before it hands them on.
HELD_ROWS, FRAME_ROWS = 50_000, 5_000
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def minutes_between(start: int, end: int) -> int:
    """Whole minutes between two times in microseconds, rounded half up, at least 0."""
    return max(0, (end - start + 30_000_000) // 60_000_000)


def changes(before: dict, now: dict, start: int, end: int, cap: int) -> Iterator[dict]:
    """Events between two rosters (name -> member), as columns of ``EVENTS``."""
    minutes = minutes_between(start, end)
    for name, m in now.items():
        old = before.get(name)
        if old is None:
            yield {"kind": "join", "character_name": name, "vocation": m["vocation"], "guild_rank": m["guild_rank"],
                   "level": m["level"], "status": m["status"], "joined_date": m["joined"]}
            continue
        online = (old["status"] or "").lower() == ONLINE_STATUS
        if m["level"] != old["level"]:
            yield {"kind": "level_change", "character_name": name, "vocation": m["vocation"],
                   "guild_rank": m["guild_rank"], "level": m["level"], "previous_level": old["level"],
                   "estimated_online_minutes": min(minutes, cap) if online else 0}
        if m["guild_rank"] != old["guild_rank"]:
            yield {"kind": "rank_change", "character_name": name, "guild_rank": m["guild_rank"],
                   "previous_guild_rank": old["guild_rank"]}
    for name, old in before.items():
        m = now.get(name)
        if m is None:
            yield {"kind": "leave", "character_name": name, "vocation": old["vocation"], "guild_rank": old["guild_rank"],
                   "level": old["level"], "status": old["status"], "joined_date": old["joined"]}
        if (old["status"] or "").lower() == ONLINE_STATUS:
            yield {"kind": "interval", "character_name": name, "previous_status": old["status"],
                   "status": m["status"] if m else None, "interval_minutes": minutes,
                   "estimated_online_minutes": min(minutes, cap)}


FIELDS = [c.split()[0] for c in MEMBER.split(", ")]
COLUMNS = [c.split()[0] for c in EVENTS.split(", ")]


def packed(members: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, STORED) as writer:
        writer.write_batch(members)
    return sink.getvalue().to_pybytes()


def pack_rows(rows: pd.DataFrame) -> bytes:
    return packed(pa.RecordBatch.from_arrays([pa.Array.from_pandas(rows[f.name], type=f.type) for f in STORED], schema=STORED))


def pack_roster(roster: dict) -> bytes:
    columns = [list(roster), *([m[f] for m in roster.values()] for f in FIELDS[1:])]
    return packed(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, STORED)], schema=STORED))


def unpack(stored: Iterable[bytes]) -> dict:
    """Members by name; the first of repeated ones counts (insert-ignore)."""
    roster = {}
    for data in stored:
        with pa.ipc.open_stream(data) as reader:
            for batch in reader:
                for m in batch.to_pylist():
                    roster.setdefault(m.pop("name"), m)
    return roster


class GuildState(StatefulProcessor):
    def __init__(self, cap: int, expire_ms: int | None):
        self.cap, self.expire_ms = cap, expire_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "micros long")
        self.roster = handle.getValueState("roster", "members binary")
        self.writes = handle.getValueState("writes", "number long")
        self.timer = handle.getValueState("timer", "millis long")
        self.waiting = handle.getMapState("waiting", "micros long, number long", "members binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        done, written = self.last.get(), self.writes.get()
        number, times = written[0] if written is not None else 0, set()
        held, n = [], 0
        for frame in rows:
            # What the watermark has passed is dropped before; a snapshot that
            # is processed already takes no more members.
            if done is not None:
                frame = frame[frame["micros"] > done[0]]
            held.append(frame)
            n += len(frame)
            if n >= HELD_ROWS:
                number, held, n = self._hold(held, number, times), [], 0
        number = self._hold(held, number, times)
        if times:
            self.writes.update((number,))
            self._time(min(times), self.timer.get())
        return iter(())

    def _time(self, micros: int, timer: tuple | None) -> None:
        """Set the timer for a snapshot, unless one fires before."""
        at = micros // 1000 + 1
        if timer is None or at < timer[0]:
            self.handle.registerTimer(at)
            self.timer.update((at,))

    def _hold(self, frames: list, number: int, times: set) -> int:
        if not frames:
            return number
        for micros, snapshot in pd.concat(frames).groupby("micros"):
            # A row without a name stands for a document without members of the group.
            self.waiting.updateValue((int(micros), number), (pack_rows(snapshot[snapshot["name"].notna()]),))
            times.add(int(micros))
        return number + 1

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        due, later = {}, None
        for micros, number in self.waiting.keys():
            if micros // 1000 + 1 <= passed:
                due.setdefault(micros, []).append(number)
            else:
                later = micros if later is None else min(later, micros)
        last = self.last.get()
        last = None if last is None else last[0]
        if due:
            kept = self.roster.get() if last is not None else None
            roster, events = unpack([] if kept is None else [kept[0]]), []
            for micros in sorted(due):
                numbers = sorted(due[micros])
                now = unpack(self.waiting.getValue((micros, n))[0] for n in numbers)
                if last is not None and not self._expired(last, micros // 1000):
                    events += self._events(key, roster, now, last, micros)
                    if len(events) >= FRAME_ROWS:
                        yield pd.DataFrame(events, columns=COLUMNS, dtype=object)
                        events = []
                roster, last = now, micros
                for n in numbers:
                    self.waiting.removeKey((micros, n))
            if events:
                yield pd.DataFrame(events, columns=COLUMNS, dtype=object)
            self.timer.clear()
            if later is not None:
                self._time(later, None)
            self.roster.update((pack_roster(roster),))
            self.last.update((last,))
            if self.expire_ms is not None:
                self.handle.registerTimer(last // 1000 + self.expire_ms)
        if last is not None and self._expired(last, passed):
            self.roster.clear()
            self.last.clear()

    def _events(self, key, before: dict, now: dict, start: int, end: int) -> list[tuple]:
        world, guild, _ = key
        pair = {"guild_name": guild, "world": world, "previous_micros": start, "latest_micros": end}
        return [tuple(map((pair | event).get, COLUMNS)) for event in changes(before, now, start, end, self.cap)]

    def _expired(self, last: int, now_ms: int) -> bool:
        return self.expire_ms is not None and last // 1000 + self.expire_ms <= now_ms

    def close(self) -> None:
        pass


def parts_for(members: DataFrame) -> int:
    """The number of groups to deal each guild into, by the largest snapshot (one
    number) of some member rows."""
    sizes = members.groupBy("world", "guild_name", "extracted_at_utc").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.agg(F.max("n")).first()[0] or 0
    return max(LEAST_PARTS, -(-largest // MEMBERS_PER_PART))


def grouped_documents(envelopes: DataFrame, parts: int, clean: bool) -> DataFrame:
    """One row per document and member with the member's part, and one without a
    name for each part that the document has no member of. Documents without a
    world are no guild's; members without a name go."""
    t = RW.parse_iso_utc(F.col("metadata.extracted_at_utc"))
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), t)

    def member(m):
        rank, vocation, status = ((nonempty(m[c]) if clean else m[c]) for c in ("rank", "vocation", "status"))
        level = m["level"].cast("int")
        return F.struct(F.pmod(F.xxhash64(m["name"]), F.lit(parts)).cast("int").alias("part"),
                        m["name"].alias("name"), rank.alias("guild_rank"), vocation.alias("vocation"),
                        (F.nullif(level, F.lit(0)) if clean else level).alias("level"), status.alias("status"),
                        parse_joined_date(m["joined"]).alias("joined"))

    def nobody(part):
        return F.struct(part.alias("part"), *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in MEMBER.split(", ")])

    members = F.coalesce(F.col("data.guild.members"), F.array().cast(RW.ENVELOPE["data"].dataType["guild"].dataType["members"].dataType))
    named = F.filter(members, lambda m: m["name"].isNotNull() & (m["name"] != ""))
    absent = F.array_except(F.sequence(F.lit(0), F.lit(parts - 1)), F.transform("dealt", lambda m: m["part"]))
    rows = envelopes.filter(F.col("data.guild.world").isNotNull() & t.isNotNull()).select(
        F.col("data.guild.world").alias("world"), F.col("metadata.entity_name").alias("guild_name"),
        t.cast("timestamp").alias("event_time"), micros.alias("micros"), F.transform(named, member).alias("dealt"))
    rows = rows.withColumn("m", F.explode(F.concat("dealt", F.transform(absent, nobody))))
    return rows.select("world", "guild_name", "event_time", "micros", "m.*")


@contextlib.contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, not in the heap (a query
    keeps the setting it starts with)."""
    name, provider = STATE_STORE
    before = spark.conf.get(name)
    spark.conf.set(name, provider)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def start(spark: SparkSession, landing_dir: str, events_dir: str, checkpoint: str | None = None,
          delay: str = "1 day", parts: int = 4, cap: int = DEFAULT_CAP_MINUTES, expire_ms: int | None = None,
          clean: bool = True, max_files_per_trigger: int | None = None, available_now: bool = True,
          processing_time: str | None = None) -> StreamingQuery:
    """Start the stream from landed envelopes to the table of events. Documents
    more than ``delay`` older than the newest seen are dropped by the watermark
    (the stored jobs rebuild their guild instead)."""
    reader = spark.readStream.schema(RW.ENVELOPE).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    rows = grouped_documents(reader.json(landing_dir), parts, clean).withWatermark("event_time", delay)
    events = rows.groupBy("world", "guild_name", "part").transformWithStateInPandas(
        GuildState(cap, expire_ms), EVENTS, "append", "eventTime")
    writer = events.writeStream.format("parquet").partitionBy("kind").outputMode("append") \
        .option("path", events_dir).option("checkpointLocation", checkpoint or fresh_dir(spark, "guild-state"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    with state_on_disk(spark):
        return writer.start()


def read_events(spark: SparkSession, events_dir: str) -> DataFrame:
    """The committed events, with times instead of microseconds."""
    df = spark.read.schema(EVENTS).parquet(events_dir)
    for column, micros in (("previous_snapshot_time", "previous_micros"), ("latest_snapshot_time", "latest_micros")):
        df = df.withColumn(column, F.timestamp_micros(micros).cast("timestamp_ntz"))
    return df.drop("previous_micros", "latest_micros")


def of_kind(events: DataFrame, kind: str) -> DataFrame:
    """The events of a kind as rows of its result table."""
    return events.filter(F.col("kind") == kind).selectExpr(*KINDS[kind])


def clock_document(spark: SparkSession, time: str, path: str) -> None:
    """Land a document without members that only moves the watermark on: what
    waits for later documents of a source that has ended is processed."""
    t = F.lit(time).cast("timestamp_ntz")
    spark.range(1).select(
        F.struct(F.lit("clock").alias("source"), F.lit("clock").alias("entity_type"), F.lit("clock").alias("entity_name"),
                 RW.iso_utc(t).alias("extracted_at_utc")).alias("metadata"),
        F.struct(F.struct(F.lit("clock").alias("name"), F.lit("").alias("world")).alias("guild")).alias("data"),
        F.to_date(t).alias("snapshot_date")).coalesce(1).write.mode("append").partitionBy("snapshot_date").json(path)
