"""Stored tables: plain Parquet folders with partitions, nothing else.

Every row a job writes carries the number of its batch, and the batch is a
partition column. A write replaces exactly the partitions of its batch
(``partitionOverwriteMode=dynamic``), so a batch that runs again after a crash
or a lost executor writes the same partitions once more instead of adding rows.
Rows are counted while they are written. Readers are ordinary partitioned scans.

Writers exclude each other by files that are created only if they are not there:
a claimed number belongs to one writer, a lease to one run at a time.
"""

from __future__ import annotations

import contextlib
import os
import re
import time
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "batch"


class Tables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def folder(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(self.folder(name)))

    def batches(self, name: str) -> set[int]:
        """Batch numbers of a table that is partitioned by batch alone."""
        folder = self._path(self.folder(name))
        if not self._fs.exists(folder):
            return set()
        found = (re.fullmatch(rf"{BATCH}=(\d+)", s.getPath().getName()) for s in self._fs.listStatus(folder))
        return {int(m[1]) for m in found if m}

    def create(self, path: str) -> bool:
        """Create an empty file if it is not there; False if it is. One of any
        number of writers gets True."""
        p = self._path(path)
        if self._fs.getScheme() == "file":  # Hadoop's local file system looks first and creates then
            local = p.toUri().getPath()
            os.makedirs(os.path.dirname(local), exist_ok=True)
            try:
                os.close(os.open(local, os.O_CREAT | os.O_EXCL | os.O_WRONLY))
                return True
            except FileExistsError:
                return False
        try:
            self._fs.create(p, False).close()
            return True
        except Py4JJavaError as e:
            if "AlreadyExists" in str(e) or "already exists" in str(e):
                return False
            raise

    def claim(self) -> int:
        """A new batch number, greater than all before; no two writers get the same."""
        folder = self._path(f"{self.root}/_claims")
        taken = [int(s.getPath().getName()) for s in self._fs.listStatus(folder)
                 if s.getPath().getName().isdigit()] if self._fs.exists(folder) else []
        number = max(taken, default=0) + 1
        while not self.create(f"{self.root}/_claims/{number}"):
            number += 1
        return number

    def forget_claims(self, below: int) -> None:
        """Remove the files of older numbers; the newest says where to go on."""
        folder = self._path(f"{self.root}/_claims")
        for s in self._fs.listStatus(folder):
            name = s.getPath().getName()
            if name.isdigit() and int(name) < below:
                self._fs.delete(s.getPath(), False)

    @contextlib.contextmanager
    def lease(self, name: str, wait_s: float = 0, stale_s: float = 3600) -> Iterator[bool]:
        """Whether this run alone holds ``name`` now; it is given back at the end.
        A lease older than ``stale_s`` is of a run that died: whoever renames it
        away may take it."""
        path, until = f"{self.root}/_leases/{name}", time.monotonic() + wait_s
        while not (mine := self.create(path)):
            try:
                age = time.time() - self._fs.getFileStatus(self._path(path)).getModificationTime() / 1000
            except Py4JJavaError:  # given back meanwhile
                continue
            if age > stale_s:
                with contextlib.suppress(Py4JJavaError):
                    self._fs.rename(self._path(path), self._path(f"{self.root}/_leases/_stale-{uuid.uuid4().hex}"))
            elif time.monotonic() >= until:
                break
            else:
                time.sleep(0.1)
        try:
            yield mine
        finally:
            if mine:
                self._fs.delete(self._path(path), False)

    def put(self, name: str, df: DataFrame, batch: int, by: tuple[str, ...] = (), thin: bool = False) -> int:
        """Write a batch's rows of a table (also partitioned ``by`` columns); the
        number of rows, counted while they are written. ``thin``: many folders of
        a few rows each."""
        seen = Observation()
        # Rows of one folder meet in one task, unless they are many (split at run
        # time). Thin folders cost by their number, not by their bytes, by which
        # they would all meet in one task: they are dealt to all cores.
        if by:
            df = df.repartition(self.spark.sparkContext.defaultParallelism, *by) if thin else df.hint("rebalance", *by)
        df.withColumn(BATCH, F.lit(batch).cast("long")).observe(seen, F.count(F.lit(1)).alias("n")) \
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy(*by, BATCH).parquet(self.folder(name))
        return seen.get["n"]

    def replace(self, name: str, df: DataFrame, by: tuple[str, ...]) -> None:
        """Write the partitions (``by`` columns) that ``df`` has rows of. ``df``
        must not read the table: pass it through ``work`` if it does."""
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by) \
            .parquet(self.folder(name))

    def drop(self, name: str, batch: int) -> None:
        self._fs.delete(self._path(f"{self.folder(name)}/{BATCH}={batch}"), True)

    def drop_table(self, name: str) -> None:
        self._fs.delete(self._path(self.folder(name)), True)

    def partitions(self, name: str, levels: int) -> list[tuple[int, str]]:
        """(batch number, folder) of a table with ``levels`` partition columns
        before the batch."""
        pattern = self._path(f"{self.folder(name)}/" + "*/" * levels + f"{BATCH}=*")
        found = self._fs.globStatus(pattern) if self.exists(name) else []
        numbered = [(int(s.getPath().getName().split("=")[1]), s.getPath().toString()) for s in found or []]
        return [(number, path) for number, path in numbered if number >= 0]

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def read(self, name: str, schema: str, by: str = f"{BATCH} long") -> DataFrame:
        """All rows, with the partition columns (given as a schema)."""
        full = f"{schema}, {by}"
        if not self.exists(name):
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(T._parse_datatype_string(full)).parquet(self.folder(name))

    def work(self, df: DataFrame) -> DataFrame:
        """Write an intermediate result of a job beside the tables and read it
        back: evaluated once, lineage cut. ``clear_work`` removes them all."""
        path = f"{self.root}/_work/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear_work(self) -> None:
        self._fs.delete(self._path(f"{self.root}/_work"), True)

    def keep(self, name: str, df: DataFrame, keep: Column, by: tuple[str, ...] = ()) -> None:
        """Delete the rows of ``df`` (as read from the table) that fail ``keep``:
        only partitions that hold such rows are written again or dropped. Only
        the names of these partitions come to the driver."""
        parts = [*by, BATCH]
        hit = df.filter(~keep).select(*parts).distinct()
        staged = self.work(df.filter(keep).join(hit, parts, "left_semi"))
        touched = {tuple(r) for r in hit.collect()}
        left = {tuple(r) for r in staged.select(*parts).distinct().collect()}
        if left:
            self.replace(name, staged, tuple(parts))
        escape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        for values in touched - left:
            where = "/".join(f"{p}={'__HIVE_DEFAULT_PARTITION__' if v is None else escape(str(v))}" for p, v in zip(parts, values))
            self._fs.delete(self._path(f"{self.folder(name)}/{where}"), True)
