"""The registered training-data queries against DuckDB, and the pipeline."""

from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline
from snapwise.llm import mixing, quality
from snapwise.llm.oracle import ORACLE_SQL
from snapwise.llm.queries import QUERIES, TARGETS
from tests.conftest import SF_SMALL
from tests.llm.test_llm import DOCS, EXTRA, LABELS, ODD, check_gapless, components_of, plain_counts, plain_fingerprint
from tools.compare import canon, duck


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    cur = duck(SF_SMALL).execute(ORACLE_SQL[name])
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    assert got == canon([d[0] for d in cur.description], cur.fetchall())


def test_every_operator_is_registered():
    names = set(E.queries())
    assert set(QUERIES) < names and "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert E.oracle_sql().keys() & QUERIES.keys() == ORACLE_SQL.keys()


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    sizes = [docs.count()]
    for number, (_, function) in enumerate(corpus_pipeline.STAGES):
        out = function(spark, docs, SF_SMALL)
        if number < 4:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(number)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(number)))
        sizes.append(docs.count())
        if number == 0:
            scores = quality.score_quality(before, spark.read.parquet(f"{SF_SMALL}/labels.parquet")).collect()
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in scores if r.predicted}
        if number == 1:
            kept = {r.doc_id for r in docs.collect()}
            assert kept == {r.doc_id for r in before.collect() if not plain_counts(r.text)[5]}
        if number == 2:
            rows = sorted((r.doc_id, r.text) for r in before.collect())
            fps = np.array([plain_fingerprint(t) for _, t in rows], "u8")
            label = components_of(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4)
            assert sorted(r.doc_id for r in docs.collect()) == sorted(rows[k][0] for k in set(label.tolist()))
            assert sizes[-1] < sizes[-2]
        if number == 3:
            labels = mixing.label_domains(spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
            rates = {r.doc_id: r.rate for r in mixing.mixture(before, labels, TARGETS).collect()}
            copies = Counter(r.doc_id for r in docs.collect())
            assert all(int(rate) <= copies[i] <= int(rate) + 1 for i, rate in rates.items())
    assert sizes[0] > sizes[1] >= sizes[2] > sizes[3] > 0
    assert 0 < len(check_gapless(docs.collect()))


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_of_odd_tables(spark, tmp_path, empty):
    rows = [] if empty else [(i, t, lang, s, None, *["x"] * len(EXTRA)) for i, t, lang, s in ODD]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [] if empty else [(5, 1, 0), (10, 1, 0), (8, 0, 0), (None, None, None)]
    spark.createDataFrame(labels, LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    check_gapless(out.collect())
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns)
