"""Event-time operators of the stream: deduplication and day windows.

Both keep state in Spark's state store only as long as the watermark allows:
deduplication one key per member row of the last ``delay``, windows one sum per
member and day that may still change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from snapwise.session import fresh_dir
from snapwise.sources import raw as RW
from snapwise.streaming import guild_state as GS

MEMBER_ROW = ["guild_name", "world", "character_name", "event_time"]
DAY_KEY = ["guild_name", "world", "character_name"]


def deduplicate_members(spark: SparkSession, landing_dir: str, members_dir: str, checkpoint: str,
                        delay: str = "1 day", clean: bool = True) -> StreamingQuery:
    """A10 in the stream: landed envelopes to member rows, each (guild, world,
    member, time) once. A row that is delivered again within ``delay`` of its
    time is known to the state; a later one is behind the watermark and goes."""
    envelopes = spark.readStream.schema(RW.ENVELOPE).option("recursiveFileLookup", "true").json(landing_dir)
    rows = RW.flatten(envelopes, clean=clean).withColumn("event_time", F.col("extracted_at_utc").cast("timestamp"))
    once = rows.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(MEMBER_ROW).drop("event_time")
    return once.writeStream.format("parquet").outputMode("append").option("path", members_dir) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def minutes_by_day(spark: SparkSession, events_dir: str, days_dir: str, checkpoint: str | None = None,
                   delay: str = "2 days", max_files_per_trigger: int | None = None) -> StreamingQuery:
    """D07 in the stream: intervals of the event stream summed in windows of a
    calendar day of their end. Late intervals correct the day while the watermark
    allows; a trigger writes the days that it changed under its own number, and
    writing it again gives the same folder."""
    reader = spark.readStream.schema(GS.EVENTS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    intervals = reader.parquet(events_dir).filter(F.col("kind") == "interval") \
        .select(*DAY_KEY, "estimated_online_minutes", F.timestamp_micros("latest_micros").alias("end"))
    days = intervals.withWatermark("end", delay).groupBy(F.window("end", "1 day").alias("w"), *DAY_KEY).agg(
        F.sum("estimated_online_minutes").cast("int").alias("estimated_online_minutes"),
        F.count(F.lit(1)).cast("int").alias("online_interval_rows"))

    def write(batch: DataFrame, number: int) -> None:
        batch.select(*DAY_KEY, F.to_date("w.start").alias("activity_date"), "estimated_online_minutes",
                     "online_interval_rows", F.lit(number).cast("long").alias("trigger")) \
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("trigger").parquet(days_dir)

    with GS.state_on_disk(spark):  # a sum per member and day
        return days.writeStream.outputMode("update").foreachBatch(write) \
            .option("checkpointLocation", checkpoint or fresh_dir(spark, "day-windows")).trigger(availableNow=True).start()


def read_days(spark: SparkSession, days_dir: str) -> DataFrame:
    """The newest sums of each member and day, days without minutes left out."""
    rows = spark.read.parquet(days_dir)
    key = [*DAY_KEY, "activity_date"]
    # Minutes and rows of a day only grow, so the newest sums are the largest.
    return rows.groupBy(*key).agg(F.max("estimated_online_minutes").alias("estimated_online_minutes"),
                                  F.max("online_interval_rows").alias("online_interval_rows")) \
        .filter(F.col("estimated_online_minutes") > 0)
