"""The landed tree: one pretty-printed document per file under
``<source>/guild/YYYY/MM/DD/<slug>_<UTC time>.json`` (A01-A03).

The sink writes every document to its file from the task that holds it, under a
name of its own first and renamed at the end, so a task that runs again replaces
its files. Scans read the folders of the days asked for, with an explicit schema;
a file that is no document keeps its text in ``_corrupt_record``. What the paths
tell (source, slug, day, time) is answered from the listing alone.
"""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapwise.sources import raw as RW

CORRUPT = "_corrupt_record"
LANDED = T.StructType([*RW.ENVELOPE.fields, T.StructField(CORRUPT, T.StringType())])
#: Source, year, month, day, slug and time of a landed path (fixed layout).
PATH_PATTERN = r"([^/]+)/guild/(\d{4})/(\d{2})/(\d{2})/([^/]*)_(\d{8}T\d{6}Z)(?:-\d+)?\.json$"
#: Schemes of Spark paths and of the file systems that tasks open them with.
SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "gs": "gs", "abfs": "abfs",
           "abfss": "abfss"}


def qualified(spark: SparkSession, path: str) -> str:
    """A path as Spark understands it, with scheme; raises for a store that tasks
    cannot write files to, before any job."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()
    if urlparse(full).scheme not in SCHEMES:
        raise ValueError(f"cannot write files to {full}")
    return full


def _open(folder: str):
    from pyarrow import fs
    u = urlparse(folder)
    if u.scheme == "file":
        return fs.LocalFileSystem(), unquote(u.path)
    return fs.FileSystem.from_uri(folder.replace(u.scheme, SCHEMES[u.scheme], 1))


def documents(envelopes: DataFrame) -> DataFrame:
    """``path, document``: where a document lands, and its text. Documents with
    the same name and second are numbered from the second one on."""
    t = RW.parse_iso_utc(F.col("metadata.extracted_at_utc"))
    named = envelopes.select(
        F.regexp_replace(RW.logical_path(F.col("metadata.source"), F.col("metadata.entity_name"), t), r"\.json$", "").alias("name"),
        F.to_json(F.struct("metadata", "data"), {"pretty": "true"}).alias("document"), t.alias("t"))
    k = F.row_number().over(Window.partitionBy("name").orderBy("t", F.xxhash64("document"), "document"))
    return named.withColumn("k", k).select(
        F.concat("name", F.when(F.col("k") > 1, F.concat(F.lit("-"), F.col("k").cast("string"))).otherwise(""),
                 F.lit(".json")).alias("path"), "document")


def land(envelopes: DataFrame, folder: str) -> int:
    """Write every document to its file below ``folder``; their number."""
    root = qualified(envelopes.sparkSession, folder)

    def write(batches):
        import uuid

        import pyarrow as pa
        fs, base = _open(root)
        for batch in batches:
            for path, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at, _, name = f"{base}/{path}".rpartition("/")
                fs.create_dir(at, recursive=True)
                mine = f"{at}/.{name}-{uuid.uuid4().hex}"
                with fs.open_output_stream(mine) as out:
                    out.write(text.encode())
                fs.move(mine, f"{at}/{name}")
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    return documents(envelopes).mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _folders(spark: SparkSession, folder: str, source: str, since: dt.date | None, until: dt.date | None) -> list[str]:
    """The folders of the days asked for that are there; the tree itself without
    days."""
    if since is None and until is None and source == "*":
        return [folder]
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{source}/guild/*/*/*")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    days = []
    for status in found:
        at = status.getPath().toString()
        day = dt.date(*map(int, at.split("/")[-3:]))
        if (since is None or day >= since) and (until is None or day <= until):
            days.append(at)
    return days


def from_path(column: str = "raw_path") -> dict:
    """What a landed path says: its part below the tree, source, slug, time."""
    parts = {"source": 1, "slug": 5}
    out = {name: F.regexp_extract(column, PATH_PATTERN, k) for name, k in parts.items()}
    out["written_at"] = F.try_to_timestamp(F.regexp_extract(column, PATH_PATTERN, 6), F.lit("yyyyMMdd'T'HHmmss'Z'")).cast("timestamp_ntz")
    out["raw_path"] = F.regexp_extract(column, PATH_PATTERN, 0)
    return out


def scan(spark: SparkSession, folder: str, source: str = "*", since: dt.date | None = None,
         until: dt.date | None = None) -> DataFrame:
    """The documents of a tree (of a source, of days) with ``raw_path`` and
    what it says; ``_corrupt_record`` holds the text of a file that is none."""
    folders = _folders(spark, folder, source, since, until)
    if not folders:
        return spark.createDataFrame([], T.StructType([*LANDED.fields, T.StructField("raw_path", T.StringType())]))
    docs = spark.read.schema(LANDED).option("multiLine", "true").option("recursiveFileLookup", "true") \
        .option("pathGlobFilter", "*.json").option("columnNameOfCorruptRecord", CORRUPT).json(folders)
    return docs.withColumn("raw_path", F.regexp_extract(F.url_decode("_metadata.file_path"), PATH_PATTERN, 0))


def listing(spark: SparkSession, folder: str, source: str = "*", since: dt.date | None = None,
            until: dt.date | None = None) -> DataFrame:
    """``raw_path, source, slug, written_at, length`` of the landed files, from
    the folder listing: no file is opened."""
    folders = _folders(spark, folder, source, since, until)
    if not folders:
        return spark.createDataFrame([], "raw_path string, source string, slug string, written_at timestamp_ntz, length long")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json") \
        .load(folders).select("path", "length")
    parts = from_path("path")
    return files.select(parts["raw_path"].alias("raw_path"), *[parts[c].alias(c) for c in ("source", "slug", "written_at")],
                        "length").filter(F.col("raw_path") != "")


def newest_path(spark: SparkSession, folder: str) -> str | None:
    """The path of the newest document (the last in path order)."""
    return listing(spark, folder).agg(F.max("raw_path")).first()[0]
