"""Property checks of the building blocks against straightforward references."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from snapwise.functions import exprs as FX
from snapwise.operators.ordering import global_row_number, row_number_by


def test_row_number_by_matches_window_with_hot_group(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        g = "hot" if i % 3 else rnd.choice(["a", "b", "c", None])  # one group holds 2/3 of the rows
        rows.append((g, rnd.randint(0, 50), i))
    df = spark.createDataFrame(rows, "g string, v int, id int")
    order = [F.col("v").desc(), F.col("id").asc()]  # total order
    mine = row_number_by(df, ["g"], order, "rn", num_partitions=16)
    ref = df.withColumn("rn_ref", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    j = mine.join(ref, "id")
    assert j.count() == 3000
    assert j.filter(F.col("rn") != F.col("rn_ref")).count() == 0
    g = global_row_number(df, [F.col("id").desc()], "pos").filter(F.col("id") == 0).first()
    assert g.pos == 3000


def test_round_ratio_matches_decimal(spark):
    rnd = random.Random(11)
    cases = [(rnd.randint(-10**9, 10**9), rnd.choice([-1, 1]) * rnd.randint(1, 10**6)) for _ in range(2000)]
    cases += [(5, 2), (-5, 2), (25, 10), (-25, 10), (1, 3), (2, 3), (0, 7)]
    df = spark.createDataFrame(cases, "n long, d long")
    for scale in (0, 1, 2):
        got = {(r.n, r.d): r.v for r in df.select("n", "d", FX.round_ratio("n", "d", scale).alias("v")).collect()}
        q = Decimal(1).scaleb(-scale)
        for n, d in cases:
            # ROUND_HALF_UP on Decimal rounds half away from zero
            assert got[(n, d)] == (Decimal(n) / Decimal(d)).quantize(q, rounding=ROUND_HALF_UP), (n, d, scale)


def test_interval_minutes_matches_decimal(spark):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    pairs = [(base, base + dt.timedelta(microseconds=rnd.randint(0, 10**11))) for _ in range(2000)]
    pairs += [(base, base + dt.timedelta(seconds=30)), (base, base + dt.timedelta(seconds=29, microseconds=999999))]
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    got = df.select("a", "b", FX.interval_minutes("a", "b").alias("m")).collect()
    for r in got:
        us = (r.b - r.a) // dt.timedelta(microseconds=1)
        expect = int((Decimal(us) / Decimal(60_000_000)).quantize(Decimal(1), rounding=ROUND_HALF_UP))
        assert r.m == max(expect, 0)
