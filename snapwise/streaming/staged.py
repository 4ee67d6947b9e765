"""Staged triggers over one store (K17): ingest, online and general run as three
streaming queries of their own.

Ingest follows the landed documents, online the stored snapshots, general the
online ledger, so each stage starts on what the one before has committed; a
processing-time trigger gives their cadence. They may overlap: batch numbers are
claimed (create if absent), runs of one kind and the taking of pairs hold leases
(``plans.jobs``), and general leaves a pair to its next run until online has
committed it. Each stage drains what is due at its trigger, so a trigger that
found the lease taken loses nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from snapwise.plans.jobs import PARTS, SCHEMAS, SnapshotJobs
from snapwise.plans.tables import BATCH
from snapwise.session import fresh_dir
from snapwise.sources import raw as RW


def _stored_stream(spark: SparkSession, jobs: SnapshotJobs, name: str) -> DataFrame:
    """The files of a stored table as they appear (its folder may not be there
    before the first run)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(jobs.store.folder(name))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    parts = [f"{p} {'date' if p == 'day' else 'string'}" for p in PARTS.get(name, ())]
    return spark.readStream.schema(", ".join([SCHEMAS[name], *parts, f"{BATCH} long"])).parquet(jobs.store.folder(name))


def _start(stream: DataFrame, run: Callable[[DataFrame], None], checkpoint: str, every: str | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(lambda batch, _: run(batch)).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def start(spark: SparkSession, landing_dir: str, root: str, every: str | None = "5 minutes", pair_limit: int = 100,
          clean: bool = True, max_files_per_trigger: int | None = None) -> dict[str, StreamingQuery]:
    """Start the three queries (``every`` None: each drains what is there now and
    stops). A run's time is that of the newest stored snapshot."""
    jobs = SnapshotJobs(spark, root)
    reader = spark.readStream.schema(RW.ENVELOPE).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))

    def newest():
        return F.lit(jobs.newest_snapshots().agg(F.max("extracted_at_utc")).first()[0]).cast("timestamp_ntz")

    def ingest(batch: DataFrame) -> None:
        SnapshotJobs(batch.sparkSession, root).ingest_envelopes(batch, clean=clean)

    def drain(job: Callable) -> Callable[[DataFrame], None]:
        def run(_: DataFrame) -> None:
            while job(newest(), pair_limit).first()["processed_pairs"]:
                pass
        return run

    def general(as_of, limit):
        return jobs.run_general(as_of, limit, after_online=True)

    stages = {"ingest": (reader.json(landing_dir), ingest),
              "online": (_stored_stream(spark, jobs, "snapshots"), drain(jobs.run_online)),
              "general": (_stored_stream(spark, jobs, "online_ledger"), drain(general))}
    return {name: _start(stream, run, fresh_dir(spark, f"staged-{name}"), every) for name, (stream, run) in stages.items()}
