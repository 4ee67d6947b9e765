"""The landed tree: paths, days, listing, broken files; VARIANT documents."""

import datetime as dt
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from snapwise.sources import landing as LD
from snapwise.sources import raw as RW
from tests.test_jobs import small_roster


def rows_of(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def tree(folder):
    return sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, names in os.walk(folder) for f in names
                  if not f.endswith(".crc"))


@pytest.fixture(scope="module")
def roster(spark):
    return small_roster(spark, (0, 1, 2, 26, 50))


def test_a_file_per_document(spark, tmp_root, roster):
    docs = RW.envelopes_from_roster(roster)
    assert LD.land(docs, tmp_root) == docs.count() == 10
    names = tree(tmp_root)
    assert names[0] == "roster_api/guild/2024/01/01/g_20240101T000000Z.json" and len(names) == 10
    with open(f"{tmp_root}/{names[0]}") as f:
        assert f.read().count("\n") > 10  # pretty-printed
    back = LD.scan(spark, tmp_root)
    assert rows_of(RW.flatten(back, clean=False)) == rows_of(RW.flatten(docs, clean=False))
    assert sorted(r.raw_path for r in back.select("raw_path").collect()) == names
    assert LD.land(docs, tmp_root) == 10 and tree(tmp_root) == names  # again: the same files


def test_same_name_and_second(spark, tmp_root, roster):
    """Documents of one second keep files of their own."""
    docs = RW.envelopes_from_roster(roster)
    other = docs.withColumn("data", F.col("data").withField("guild.world", F.lit("other")))
    assert LD.land(docs.unionByName(other), tmp_root) == 20
    assert sum(n.endswith("-2.json") for n in tree(tmp_root)) == 10
    assert LD.scan(spark, tmp_root).count() == 20 == LD.listing(spark, tmp_root).count()


def test_days_and_listing(spark, tmp_root, roster):
    LD.land(RW.envelopes_from_roster(roster), tmp_root)
    second = LD.scan(spark, tmp_root, since=dt.date(2024, 1, 2), until=dt.date(2024, 1, 2))
    assert {r.raw_path.split("/")[4] for r in second.collect()} == {"02"} and second.count() == 2
    assert all("/2024/01/02/" in f for f in second.inputFiles())
    assert LD.scan(spark, tmp_root, since=dt.date(2030, 1, 1)).count() == 0
    assert LD.scan(spark, tmp_root, source="none").count() == 0 == LD.listing(spark, tmp_root, source="none").count()
    assert LD.newest_path(spark, tmp_root) == tree(tmp_root)[-1]
    got = LD.listing(spark, tmp_root)
    # No content column is asked for, so no file is opened.
    assert "content" not in got._jdf.queryExecution().executedPlan().toString()
    assert {(r.raw_path, r.source, r.slug) for r in got.collect()} == {(n, "roster_api", n.split("/")[-1].split("_")[0]) for n in tree(tmp_root)}
    assert {r.written_at for r in got.filter("slug = 'g'").collect()} == {
        dt.datetime(2024, 1, 1) + dt.timedelta(hours=h) for h in (0, 1, 2, 26, 50)}


def test_broken_files_are_kept_apart(spark, tmp_root, roster):
    LD.land(RW.envelopes_from_roster(roster), tmp_root)
    broken = f"{tmp_root}/roster_api/guild/2024/01/01/broken_20240101T000000Z.json"
    with open(broken, "w") as f:
        f.write('{"metadata": {"source": "cut off')
    docs = LD.scan(spark, tmp_root)
    bad = [r for r in docs.collect() if r[LD.CORRUPT] is not None]
    assert [r.raw_path.split("/")[-1] for r in bad] == ["broken_20240101T000000Z.json"] and "cut off" in bad[0][LD.CORRUPT]
    assert docs.count() == 11


def test_stores_that_tasks_cannot_write_to(spark, tmp_root):
    assert LD.qualified(spark, tmp_root).startswith("file:/")
    with pytest.raises(Exception):
        LD.qualified(spark, "nosuch://host/x")


def test_variant_documents(spark, tmp_root, roster):
    docs = RW.envelopes_from_roster(roster)
    raw = RW.raw_table(docs)
    odd = raw.limit(1).withColumn("raw_json", F.lit("{not json")).unionByName(
        raw.limit(1).withColumn("raw_json", F.lit('{"metadata": {"entity_name": 7}, "data": {"guild": {"members": "none"}}}')))
    folder = f"{tmp_root}/variant"
    RW.variant_table(raw.unionByName(odd)).write.parquet(folder)
    stored = spark.read.parquet(folder)
    assert dict(stored.dtypes)["document"] == "variant" and stored.filter("document IS NULL").count() == 1
    assert rows_of(RW.flatten_variant(stored)) == rows_of(RW.flatten(docs, clean=False))
