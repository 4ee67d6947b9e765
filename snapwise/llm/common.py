"""Helpers shared by the operators of this folder.

Intermediate tables go to the folder that the session names in
``spark.checkpoint.dir`` (every executor reaches it), so a lost executor costs
a re-read of a file and never a recomputation of the whole lineage.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapwise.session import ensure_checkpoint_dir

#: A word is a run of characters outside ASCII white space.
SEPARATORS = "[\\x20\\x09-\\x0D]+"

#: Rows handed to Python at once in loops over long texts.
SLICE = 256


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder, removed when the
    driver ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder made by ``shared_folder`` that nothing reads any more."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


class Staged:
    """A DataFrame written to the shared folder and read back."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = shared_folder(self.spark, name)
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        remove_folder(self.spark, self.path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and
    fixes row identifiers drawn by ``monotonically_increasing_id``."""
    return Staged(df, name).df


def words(text: Column) -> Column:
    """The words of a text as an array (null text: no words)."""
    parts = F.split(F.coalesce(text, F.lit("")), SEPARATORS)
    return F.filter(parts, lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def rows_of(batches, *names: str) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples of the named columns, a slice at a time,
    so that a batch of long texts is never held twice."""
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
        for at in range(0, batch.num_rows, SLICE):
            yield from zip(*(c.slice(at, SLICE).to_pylist() for c in columns), strict=True)


#: Schemes of Hadoop file systems and pyarrow's names for the same stores.
SCHEMES = {"s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "gcs": "gs", "hdfs": "hdfs", "viewfs": "viewfs",
           "abfs": "abfs", "abfss": "abfss"}


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of Spark's default file system where it has none,
    refused on the driver if tasks could not open it."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(jpath).toString()
    scheme = urlparse(full).scheme
    if scheme != "file" and scheme not in SCHEMES:
        raise ValueError(f"files under {scheme}:// cannot be opened from tasks; set spark.checkpoint.dir to one of "
                         f"file, {', '.join(sorted(SCHEMES))}")
    return full


def filesystem(uri: str):
    """(pyarrow file system, path) of a folder URI; a bare path is local."""
    from pyarrow import fs
    scheme = urlparse(uri).scheme
    if scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(urlparse(uri).path) if scheme else uri
    if scheme not in SCHEMES:
        raise ValueError(f"no file system for {scheme}://")
    return fs.FileSystem.from_uri(SCHEMES[scheme] + uri[len(scheme):])


def smallest_reachable(a, b, n: int):
    """Smallest reachable position of each of ``n`` positions over the links
    (a[i], b[i]): min-label propagation with pointer jumping, in numpy."""
    import numpy as np
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = np.minimum(new, new[new])
        if np.array_equal(new, label):
            break
        label = new
    return label
