"""Sharding by a permutation of global row numbers.

Rows are numbered 0 to n - 1 in the order the caller names: a range partitioning,
a position inside each partition, and the row counts of the partitions before it.
A Feistel network then permutes the numbers. Its halves are numbers below a and b
with a * b just over n, so fewer than sqrt(n) + 1 of the products lie outside the
table; a row that lands there walks on through the network until it is inside
(cycle walking). How many steps the longest walk takes is found beforehand on
those few outside numbers, so the walk of all rows is a fixed chain of column
expressions. Place x is shard x mod shards, slot x div shards: row counts differ
by one at most, slots have no gaps, and where a row goes, or which row is at a
place, is computed from n, the seed and the number of shards alone.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapwise.llm.common import Staged

#: Rounds of the network, alternately on either half.
ROUNDS = 8


def halves(n: int) -> tuple[int, int]:
    """The sizes (a, b) of the halves: the least a * b >= n with a about sqrt(n)."""
    a = max(1, isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def _network(x: Column, n: int, seed: int, back: bool = False) -> Column:
    """A number once through the network (``back``: through its inverse). A round
    adds to the first half what the second one's hash is worth there, and the
    halves change places with their sizes."""
    a, b = (F.lit(k).cast("long") for k in halves(n))

    def worth(k: Column, v: Column, size: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed * ROUNDS).cast("long") + k, v), size)

    def ahead(s: Column, k: Column) -> Column:
        return F.struct(s["v"].alias("u"), F.pmod(s["u"] + worth(k, s["v"], s["su"]), s["su"]).alias("v"),
                        s["sv"].alias("su"), s["su"].alias("sv"))

    def behind(s: Column, k: Column) -> Column:
        return F.struct(F.pmod(s["v"] - worth(k, s["u"], s["sv"]), s["sv"]).alias("u"), s["u"].alias("v"),
                        s["sv"].alias("su"), s["su"].alias("sv"))

    start = F.struct(F.call_function("div", x, b).alias("u"), (x % b).alias("v"), a.alias("su"), b.alias("sv"))
    rounds = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if back else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(rounds, start, behind if back else ahead, lambda s: s["u"] * s["sv"] + s["v"])


def _walk(x: Column, n: int, seed: int, passes: int, back: bool = False) -> Column:
    """A number through the network until it is inside, in at most ``passes``;
    the first pass is made anyhow."""
    return F.aggregate(F.sequence(F.lit(1), F.lit(passes)), x.cast("long"), lambda y, k: F.when(
        (k == 1) | (y >= n), _network(y, n, seed, back)).otherwise(y))


def walk_length(spark: SparkSession, n: int, seed: int) -> int:
    """Passes through the network after which every row number is inside (at most
    twice what the longest walk takes), found on the numbers outside, which are
    fewer than sqrt(n) + 1."""
    a, b = halves(n)
    outside = spark.range(n, a * b).filter(_network(F.col("id"), n, seed, True) < n)
    passes = 1
    while not outside.filter(_walk(F.col("id"), n, seed, passes) >= n).isEmpty():
        passes *= 2
    return passes + (a * b > n)


def places_of(rows: DataFrame, n: int, shards: int, seed: int = 0) -> DataFrame:
    """``rows`` (a column ``row``, 0 to n - 1) with the ``shard`` and ``slot`` of
    each; no data is read."""
    x = _walk(F.col("row"), n, seed, walk_length(rows.sparkSession, n, seed))
    return rows.withColumn("_place", x).withColumns({
        "shard": (F.col("_place") % shards).cast("int"),
        "slot": F.call_function("div", F.col("_place"), F.lit(shards).cast("long"))}).drop("_place")


def rows_at(places: DataFrame, n: int, shards: int, seed: int = 0) -> DataFrame:
    """``places`` (columns ``shard`` and ``slot``) with the ``row`` at each: the
    inverse of ``places_of``."""
    x = F.col("slot") * F.lit(shards).cast("long") + F.col("shard")
    return places.withColumn("row", _walk(x, n, seed, walk_length(places.sparkSession, n, seed), True))


def number_rows(rows: DataFrame, order: list[Column]) -> tuple[DataFrame, int]:
    """``row`` (from 0, in the given order) and ``r``, a struct of all columns;
    and the number of rows.

    Rows are dealt by ranges of the order, which Spark samples; the last key is
    the row's place in the input, so that any number of equal rows spreads over
    partitions. Rows that tie in the whole order are numbered as they are read."""
    keys = [f"k{i}" for i in range(len(order))]
    packed = rows.select(*[c.alias(k) for c, k in zip(order, keys, strict=True)], F.struct("*").alias("r")) \
        .withColumn("tie", F.monotonically_increasing_id())
    keys.append("tie")
    staged = Staged(packed.repartitionByRange(*keys).sortWithinPartitions(*keys)
                    .select("r", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")),
                    "numbered").df
    # One row per partition: its window and its broadcast are bounded by their number.
    parts = staged.groupBy("part").agg(F.count(F.lit(1)).alias("count"), F.min("at").alias("first"))
    before = F.sum("count").over(Window.orderBy("part")) - F.col("count")
    bases = F.broadcast(parts.select("part", (before - F.col("first")).alias("base")))
    n = parts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    return staged.join(bases, "part").select((F.col("at") + F.col("base")).alias("row"), "r"), n


def shard_rows(rows: DataFrame, order: list[Column], shards: int, seed: int = 0) -> DataFrame:
    """``rows`` (any table) with ``row`` (its global number), ``shard`` and
    ``slot``; columns of these names in the input are replaced.

    Shards hold equally many rows, one at most more or less; slots run from 0
    without gaps. The same rows, order, seed and number of shards give the same
    places, however the table is split or read. Rows that tie in the whole order
    change places with each other only. Nulls sort first; null, empty and very
    long texts are rows like any other, repeated rows have places of their own,
    and an empty table stays empty. Equal texts are not kept together: a group
    of copies with a third of all rows is dealt over all shards."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    numbered, n = number_rows(rows, order)
    kept = [F.col("r")[c].alias(c) for c in rows.columns if c not in ("row", "shard", "slot")]
    return places_of(numbered, n, shards, seed).select(*kept, "row", "shard", "slot")


def write_shards(sharded: DataFrame, folder: str) -> None:
    """Write a result of ``shard_rows`` as a folder per shard, rows in the order
    of their slots, one range of slots per file."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot") \
        .write.partitionBy("shard").parquet(folder)


def shard_documents(docs: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row of
    ``docs`` (doc_id, text; other columns are ignored), numbered by id, size and
    checksum of the text.

    size is the UTF-8 bytes of the text (null: none) plus 8; law is ``rows``: the
    shards' row counts differ by one at most; grown_shard, which a law over keys
    would give, is null. Texts are read once and not shuffled."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    digests = Staged(docs.select(F.col("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                                 F.crc32(text).alias("text_crc32")), "digests").df
    order = [F.col(c) for c in ("doc_id", "size", "text_crc32")]
    return shard_rows(digests, order, shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
