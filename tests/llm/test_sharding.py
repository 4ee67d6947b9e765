"""Sharding against a plain Feistel network, and its laws."""

import struct
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapwise.llm.common import shared_folder
from snapwise.llm.sharding import (ROUNDS, halves, places_of, rows_at, shard_documents, shard_rows, walk_length,
                                   write_shards)
from tests.llm.test_llm import DOCS, EXTRA, ODD


def plain_pass(x, n, seed):
    a, b = halves(n)
    parts, sizes = [x // b, x % b], [a, b]
    for k in range(ROUNDS):
        key = xxhash.xxh64_intdigest(struct.pack("<q", parts[1 - k % 2]),
                                     xxhash.xxh64_intdigest(struct.pack("<q", seed * ROUNDS + k), 42))
        key -= 2 ** 64 * (key >= 2 ** 63)
        parts[k % 2] = (parts[k % 2] + key % sizes[k % 2]) % sizes[k % 2]
    return parts[0] * b + parts[1]


def plain_place(x, n, seed):
    x = plain_pass(x, n, seed)
    while x >= n:
        x = plain_pass(x, n, seed)
    return x


@settings(max_examples=60, deadline=None)
@given(n=st.integers(1, 400), seed=st.integers(0, 50))
def test_halves_and_network(n, seed):
    a, b = halves(n)
    assert n <= a * b < n + a
    assert sorted(plain_place(x, n, seed) for x in range(n)) == list(range(n))


@pytest.mark.parametrize("n,shards,seed", [(1, 24, 0), (2, 1, 0), (47, 24, 3), (1000, 24, 0), (4099, 7, 11)])
def test_places_are_the_plain_networks(spark, n, shards, seed):
    got = places_of(spark.range(n).withColumnRenamed("id", "row"), n, shards, seed)
    rows = {r.row: (r.shard, r.slot) for r in got.collect()}
    want = {x: plain_place(x, n, seed) for x in range(n)}
    assert rows == {x: (p % shards, p // shards) for x, p in want.items()}
    assert walk_length(spark, n, seed) >= 1
    back = rows_at(got.withColumnRenamed("row", "was"), n, shards, seed)
    assert back.filter("row <> was").isEmpty()
    sizes = Counter(s for s, _ in rows.values())
    assert max(sizes.values()) - min([sizes[s] for s in range(shards)]) <= 1


def test_walks_of_all_lengths_end(spark):
    """Some seed makes a walk of two passes and more."""
    lengths = {walk_length(spark, 10, seed) for seed in range(12)}
    assert max(lengths) >= 2


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, None, *["x"] * len(EXTRA)) for i, t, lang, s in rows], DOCS)


def check_laws(rows, want):
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=str) == sorted(want, key=str)
    slots = defaultdict(list)
    for r in rows:
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < 24
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[k]) for k in range(24)]
    assert max(sizes) - min(sizes) <= 1


def test_documents_with_odd_rows(spark):
    docs = docs_of(spark, ODD)
    want = [(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _, _ in ODD]
    first = sorted(map(tuple, shard_documents(docs.repartition(5), 24).collect()), key=str)
    check_laws(shard_documents(docs, 24).collect(), want)
    # However the rows are split and ordered.
    assert first == sorted(map(tuple, shard_documents(docs.orderBy(F.rand(3)).coalesce(1), 24).collect()), key=str)


def test_empty_table(spark):
    assert shard_documents(spark.createDataFrame([], DOCS), 24).collect() == []
    assert shard_rows(spark.createDataFrame([], "a int"), [F.col("a")], 3).columns == ["a", "row", "shard", "slot"]
    with pytest.raises(ValueError):
        shard_rows(spark.range(3), [F.col("id")], 0)


def test_a_third_of_all_rows_is_one_row(spark):
    rows = [(7, "same", "en", "a")] * 300 + [(k, f"t{k}", "en", "b") for k in range(600)]
    got = shard_documents(docs_of(spark, rows).repartition(4), 24).collect()
    check_laws(got, [(i, len(t) + 8, zlib.crc32(t.encode())) for i, t, _, _ in rows])
    assert len({r.shard for r in got if r.doc_id == 7 and r.size == 12}) > 18


def test_the_seed_shuffles_anew(spark):
    docs = docs_of(spark, [(k, "t", "en", "b") for k in range(500)])
    a, b = ({r.doc_id: (r.shard, r.slot) for r in shard_documents(docs, 24, seed).collect()} for seed in (0, 1))
    assert sum(a[k] == b[k] for k in a) < 30
    assert Counter(s for s, _ in a.values()) == Counter(s for s, _ in b.values())


def test_whole_rows_in_files(spark):
    """Rows keep all columns, also those named as the operator's; a shard's files
    hold its rows in the order of their slots."""
    docs = docs_of(spark, ODD).withColumn("shard", F.lit("mine")).withColumn("r", F.lit(1))
    got = shard_rows(docs, [F.col("doc_id"), F.xxhash64("text")], 3)
    assert set(got.columns) == set(docs.columns) | {"row", "slot"}
    folder = shared_folder(spark, "shards")
    write_shards(got, folder)
    back = spark.read.parquet(folder)
    assert sorted((r.shard, r.slot, str(r.text)) for r in back.collect()) == \
        sorted((r.shard, r.slot, str(r.text)) for r in got.collect())
    assert {r.shard for r in back.collect()} == {0, 1, 2}
    assert sorted(r.row for r in got.collect()) == list(range(len(ODD)))
