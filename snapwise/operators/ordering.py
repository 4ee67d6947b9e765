"""Row positions over large ordered sets without single-task windows.

``row_number() OVER (PARTITION BY g ORDER BY o)`` puts each group ``g`` in
one task; ``OVER (ORDER BY o)`` puts the whole table in one. Both break when
one group (or the table) is huge. Here the rows are range-partitioned on
``(g, o)`` (Spark samples the key distribution, so a hot group is split
over many tasks), sorted within each partition, numbered locally, and each
(partition, group) slice is shifted by the row count of the same group in
the partitions before it. The per-slice counts form a table of at most
``#groups + #partitions`` rows; only that table is windowed.

The order must be total (add tie-breakers): positions are then
deterministic. The numbered rows are checkpointed once, so the slice counts
and the rows they shift come from the same materialized partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapwise.session import fresh_dir

_PID, _POS = "_rn_pid", "_rn_pos"


def _cols(cols):
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def row_number_by(df: DataFrame, by: list[str], order: list[Column], name: str,
                  num_partitions: int | None = None) -> DataFrame:
    """Skew-safe ``row_number() OVER (PARTITION BY by ORDER BY order)``."""
    keys = [*_cols(by), *order]
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                .withColumn(_PID, F.spark_partition_id())
                .withColumn(_POS, F.monotonically_increasing_id()))
    # Partition ids and positions must be identical in both uses below, so the
    # numbered rows are written once, to the shared folder.
    folder = fresh_dir(df.sparkSession, "numbered")
    ranged.write.parquet(folder)
    ranged = df.sparkSession.read.schema(ranged.schema).parquet(folder)
    slices = ranged.groupBy(_PID, *by).agg(F.min(_POS).alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*by).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    # The slice table is small (<= #groups + #partitions rows); AQE broadcasts
    # it from its runtime size, else the join is a regular shuffle join.
    s = slices.select(F.col(_PID).alias("_s_pid"), *[F.col(c).alias("_s_" + c) for c in by],
                      "_first", "_before")
    cond = [F.col(_PID) == F.col("_s_pid")] + [F.col(c).eqNullSafe(F.col("_s_" + c)) for c in by]
    out = ranged.join(s, cond)
    return (out.withColumn(name, (F.col("_before") + F.col(_POS) - F.col("_first") + 1).cast("int"))
               .drop(_PID, _POS, "_first", "_before", "_s_pid", *["_s_" + c for c in by]))


def global_row_number(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Skew-safe ``row_number() OVER (ORDER BY order)``."""
    return row_number_by(df, [], order, name)


def neighbours(df: DataFrame, by: list[str], t: str, prev_name: str | None = None,
               next_name: str | None = None, seq_name: str = "seq") -> DataFrame:
    """``lag(t)`` / ``lead(t)`` over distinct ``t`` per ``by`` as equi-joins on
    the position: no window holds a whole group."""
    numbered = row_number_by(df, by, [F.col(t).asc()], seq_name)
    out = numbered
    if prev_name:
        prev = numbered.select(*by, (F.col(seq_name) + 1).alias(seq_name), F.col(t).alias(prev_name))
        out = out.join(prev, [*by, seq_name], "left")
    if next_name:
        nxt = numbered.select(*by, (F.col(seq_name) - 1).alias(seq_name), F.col(t).alias(next_name))
        out = out.join(nxt, [*by, seq_name], "left")
    return out
