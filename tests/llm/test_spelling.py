"""Spelling variants against edits tried one by one."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from snapwise.llm import spelling
from snapwise.llm.spelling import count_words, one_edit_pairs, spelling_groups, spelling_variants
from tests.llm.test_llm import DOCS, EXTRA, ODD, SMALL


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain_counts(rows, least=6, often=5):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= often}


def plain_groups(counts):
    out = {}
    for w, n in counts.items():
        best = sorted((-m, v) for v, m in counts.items() if near(w, v))
        form = best[0][1] if best and -best[0][0] >= 5 * n else None
        out[w] = [form, n, len(best), counts[form] if form else None]
    def root(w):
        return w if out[w][0] is None else root(out[w][0])
    return sorted((w, f or "", root(w), n, k, fn) for w, (f, n, k, fn) in out.items())


def rows_of(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def table(spark, counts):
    return spark.createDataFrame([(w, n, "x", "y") for w, n in counts.items()] or [], "word string, n long, node string, side string")


FAMILIES = {
    "chains": ["a" * k for k in range(1, 14)] + ["a" * k + "b" for k in range(1, 9)] + ["b" + "a" * k for k in range(1, 9)],
    "ends": ["nearby", "earby", "xnearby", "nearbyx", "nearb", "nerby", "nearbby", "nnearby", "mearby", "nearbz", "neaxby"],
    "accents": ["élèves", "élèvés", "eleves", "élève", "÷×ÿßàà", "÷×ÿßà", "×÷ÿßàà", "x÷ÿßàà"],
    "one": ["single"], "none": [],
    "long": ["z" * 3000, "z" * 3001, "z" * 1500 + "y" + "z" * 1499, "z" * 1500 + "y" + "z" * 1500],
}


@pytest.mark.parametrize("name", sorted(FAMILIES))
def test_families(spark, name):
    rng = np.random.default_rng(len(name))
    counts = {w: int(rng.integers(5, 5000)) for w in FAMILIES[name]}
    assert rows_of(spelling_groups(table(spark, counts))) == plain_groups(counts)


def test_random_words_of_a_small_alphabet(spark):
    """Thousands of near pairs, every edit at every place."""
    rng = np.random.default_rng(5)
    words = {"".join(rng.choice(list("abé"), rng.integers(1, 8))) for _ in range(700)}
    counts = {w: int(5 ** rng.uniform(1, 6)) for w in words}
    assert rows_of(spelling_groups(table(spark, counts))) == plain_groups(counts)
    pairs = one_edit_pairs(table(spark, counts).select("word", "n")).collect()
    assert len(pairs) == len({(r.word, r.near) for r in pairs})


def test_a_third_of_all_words_share_a_prefix(spark):
    words = {f"prefixprefix{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"} | {f"{a}{b}word" for a in "abcdefghijkl" for b in "mnopqrstuvwx"}
    counts = {w: 5 + len(w) * 7 ** (sum(map(ord, w)) % 3) for w in words}
    assert rows_of(spelling_groups(table(spark, counts))) == plain_groups(counts)


def test_roots_of_long_chains(spark):
    """Forms of forms: each word five times as often as the one before."""
    words, w = [], list("abcdefghijklmnopqrstuvwxyz")
    for k in range(25):
        words.append("".join(w))
        w[k] = "é"
    counts = {w: 5 ** (k + 2) for k, w in enumerate(words)}
    got = rows_of(spelling_groups(table(spark, counts)))
    assert got == plain_groups(counts) and {r[2] for r in got} == {words[-1]}


def test_words_of_documents(spark, monkeypatch):
    monkeypatch.setattr(spelling, "WINDOW", 64)
    base = "Planets PLANETS planéts planet's Straße straße naïve-looking looking×looking ÀÉÎÕÜ àéîõü " * 9
    rows = [(i, t, lang, s, None, *["x"] * len(EXTRA)) for i, t, lang, s in ODD]
    rows += [(100 + k, base + "telescope " * k, "en", "a", None, *["x"] * len(EXTRA)) for k in range(60)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    want = plain_counts([(r[0], r[1]) for r in rows])
    assert {r.word: r.n for r in count_words(docs).collect()} == want
    assert "telescope" in want and "×looking" not in want and "looking×looking" in want
    assert rows_of(spelling_variants(docs)) == plain_groups(want)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    assert spelling_variants(docs).collect() == []
    nulls = spark.createDataFrame([(None, 5), ("planet", 9)], "word string, n long")
    assert rows_of(spelling_groups(nulls)) == [("planet", "", "planet", 9, 0, None)]


def test_query_on_the_small_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = plain_counts([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = spelling_variants(docs)
    assert {r.word: r.n for r in got.collect()} == want
    by_gap = {}
    for w in want:  # near words share what is left when a character goes
        for k in range(len(w)):
            by_gap.setdefault(w[:k] + w[k + 1:], set()).add(w)
        by_gap.setdefault(w, set()).add(w)
    links = {(a, b) for group in by_gap.values() for a in group for b in group if a != b and near(a, b)}
    assert {r.word: r.n_near for r in got.collect()} == {w: sum(a == w for a, _ in links) for w in want}
