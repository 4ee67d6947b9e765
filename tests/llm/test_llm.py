"""The training-data operators against brute force, round trips and edge cases."""

import base64
import hashlib
import re
import zlib
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapwise.llm import chat, common, embeddings, host_rules, lm_scoring, mixing, packing, quality, simhash, warc
from snapwise.llm.common import shared_folder, smallest_reachable
from snapwise.llm.components import connected_components
from snapwise.llm.queries import tokenizer_path
from snapwise.llm.token_files import read_manifest, read_token_files, write_token_files
from snapwise.llm.tokens import Encoder

BYTE, WORD = ("byte_bpe_50k.json", "byte_level"), ("word_bpe_49k.json", "words")
SMALL = "/root/testdata/sf0.001"

#: Extra columns whose names the operators use inside.
EXTRA = ["row", "fp", "score", "words", "doc", "c", "host", "bucket", "n", "kept", "component", "length", "piece", "p"]
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())] + [T.StructField(n, T.StringType()) for n in EXTRA])
LABELS = "doc_id long, quality int, toxic int"


def sentence(seed, n=60):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 7))) for _ in range(n)) + "."


ODD = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n ", None, None), (None, sentence(3), "en", "a"),
    (5, sentence(5), None, None), (5, sentence(5), None, None), (6, sentence(5), "de", "b"), (6, sentence(6), "de", "b"),
    (7, "É" * 3 + " " + sentence(7, 30000), "fr", "b"), (8, "word " * 500, "en", "c"), (9, "a  b\r\n\x1c <|endoftext|> 'll", "en", "c"),
    (10, sentence(10), "en", "a"), (11, "short", "en", "a"), (None, None, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, lang, s, None if t is None else len(t), *["x"] * len(EXTRA)) for i, t, lang, s in ODD]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def plain(tokenizer, text, end=2):
    return array("I", tokenizer.encode(text or "", add_special_tokens=False).ids + [end]).tobytes()


# -- tokens ------------------------------------------------------------------

TEXTS = st.lists(st.sampled_from(list(" \n\t\r aAzZéßİΣσ1२,.!%'-|<>日́ \x1c $*#&") + ["'ll", "<|endoftext|>", "the "]), max_size=40).map("".join)


@pytest.mark.parametrize("name,cut", [BYTE, WORD])
@settings(max_examples=400, deadline=None)
@given(text=TEXTS)
def test_ids_are_the_librarys(name, cut, text):
    e = Encoder.load(tokenizer_path(name), cut)
    assert e.encode(text) == plain(e.tokenizer, text)[:-4]


def test_packing_covers_every_document(spark, odd):
    rows = packing.pack_documents(odd, tokenizer_path(BYTE[0]), BYTE[1]).collect()
    tokenizer = Encoder.load(tokenizer_path(BYTE[0]), BYTE[1]).tokenizer
    want = Counter()
    for i, text, *_ in ODD:
        ids = plain(tokenizer, text)
        n, at, piece = len(ids) // 4, 0, 0
        while at < n:
            to = at + (n % 1024 or 1024) if at == 0 and n > 1024 else min(n, at + 1024)
            want[i, piece, at, to - at, zlib.crc32(ids[4 * at:4 * to])] += 1
            at, piece = to, piece + 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    fills = check_gapless(rows)
    assert len(fills) <= -(-sum(fills.values()) // 1024) + 1


def check_gapless(rows):
    fills = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fills[r.sequence_id]
        fills[r.sequence_id] += r.length
    assert max(fills.values(), default=0) <= 1024
    return fills


def test_packing_over_several_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 64)
    lengths = np.random.default_rng(1).integers(1, 1025, 700).tolist()
    pieces = spark.createDataFrame([(None if k % 9 == 0 else k, n, "x") for k, n in enumerate(lengths)],
                                   "doc_id long, length long, offset_of string")
    rows = packing.pack(pieces).collect()
    assert sorted(r.length for r in rows) == sorted(lengths)
    assert len(check_gapless(rows)) <= 1.05 * sum(lengths) / 1024 + 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=40))
def test_local_search_never_opens_bins(lengths):
    lengths = np.array(lengths, "int64")
    one_each = packing.local_search(lengths, np.arange(len(lengths)), 20)
    for bins in (one_each, packing.pack_lengths(lengths, 20)):
        fill = np.bincount(bins, lengths) if len(lengths) else np.zeros(0)
        assert (fill <= 20).all()
        used = np.count_nonzero(fill)
        assert -(-lengths.sum() // 20) <= used <= max(len(lengths), 0)
    # No two bins that the search leaves fit into one.
    fill = sorted(f for f in np.bincount(one_each, lengths) if f) if len(lengths) else []
    assert len(fill) < 2 or fill[0] + fill[1] > 20


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=30), st.lists(st.tuples(st.integers(1, 20), st.integers(0, 19)), min_size=1, max_size=20))
def test_every_exchange_is_tried(mine, others):
    size_of = np.array(mine + [n for n, _ in others])
    room = np.array([0] * len(mine) + [r for _, r in others])
    given_up = packing.two_of_each(range(len(mine)), size_of)
    pairs = {int(size_of[i] + size_of[j]): (i, j) for i in given_up for j in given_up if i < j}
    gain, out, back = packing.best_exchange(pairs, size_of, room)
    every = [a + b - n for k, a in enumerate(mine) for b in mine[k + 1:] for n, r in others if 0 < a + b - n <= r]
    assert gain == max(every, default=0)
    if gain:
        assert sum(size_of[i] for i in out) - size_of[back] == gain and len(set(out)) == 2 and 0 < gain <= room[back]


def test_paths_and_widths(spark, odd, tmp_path):
    import pyarrow.fs as pafs
    assert common.filesystem(str(tmp_path))[1] == str(tmp_path)
    assert common.filesystem("file:/a%20b/c")[1] == "/a b/c"
    assert isinstance(common.filesystem(common.qualified(spark, str(tmp_path)))[0], pafs.LocalFileSystem)
    with pytest.raises(ValueError, match="wasbs"):
        common.filesystem("wasbs://a@b/c")
    with pytest.raises(ValueError, match="does not fit"):
        write_token_files(odd, shared_folder(spark, "tokens"), tokenizer_path(WORD[0]), WORD[1], 70_000, 2)


def test_token_files_round_trip(spark, odd):
    folder = shared_folder(spark, "tokens")
    write_token_files(odd, folder, tokenizer_path(WORD[0]), WORD[1], 2, 2)
    rows = sorted(read_token_files(spark, folder, True).collect(), key=lambda r: r.start)
    tokenizer = Encoder.load(tokenizer_path(WORD[0]), WORD[1]).tokenizer
    assert Counter((r.doc_id, bytes(r.ids)) for r in rows) == Counter((i, plain(tokenizer, t)) for i, t, *_ in ODD)
    at = 0
    for r in rows:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids) // 4, zlib.crc32(bytes(r.ids)))
        at += r.n_tokens
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    shards = read_manifest(folder)
    assert [s["ids_before"] for s in shards] == np.cumsum([0] + [s["ids"] for s in shards])[:-1].tolist()


def test_token_files_of_an_empty_table(spark, none):
    folder = shared_folder(spark, "tokens")
    assert write_token_files(none, folder, tokenizer_path(WORD[0]), WORD[1]) == []
    assert read_token_files(spark, folder).count() == 0


# -- near duplicates ------------------------------------------------------------

def components_of(near):
    label = np.arange(len(near))
    while True:
        new = np.array([label[row].min() for row in near]) if len(near) else label
        if (new == label).all():
            return label
        label = new


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 30).flatmap(lambda n: st.tuples(st.just(n), st.lists(st.tuples(st.integers(0, n - 1), st.integers(0, n - 1))))))
def test_smallest_reachable(case):
    n, links = case
    near = np.eye(n, dtype=bool)
    for a, b in links:
        near[a, b] = near[b, a] = True
    a, b = (np.array([x[k] for x in links], "int64") for k in (0, 1))
    assert smallest_reachable(a, b, n).tolist() == components_of(near).tolist()


def test_connected_components(spark):
    chain = [(k, k + 1) for k in range(0, 60)]
    star = [(100, 100 + k) for k in range(1, 50)]
    links = chain + star + [(200, 200), (7, 3), (7, 3), (-5, 300)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(61)} | {k: 100 for k in range(100, 150)} | {-5: -5, 300: -5}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) > 3 else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_of_odd_rows(spark, odd, none):
    rows = simhash.simhash_groups(odd).collect()
    fps = np.array([plain_fingerprint(t) for _, t, *_ in ODD], "u8")
    label = components_of(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4)
    ids = [r[0] for r in ODD]
    want = Counter()
    for k, fp in enumerate(fps.tolist()):
        mine = [ids[j] for j in np.flatnonzero(label == label[k]) if ids[j] is not None]
        want[ids[k], f"{fp:016x}", min(mine, default=None)] += 1
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in rows) == want
    assert simhash.simhash_groups(none).count() == 0
    assert simhash.keep_one_of_each_group(none).columns == none.columns
    kept = simhash.keep_one_of_each_group(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len(set(label.tolist()))


@pytest.mark.parametrize("chunk,tile", [(4096, 1024), (16, 4)])
def test_fingerprint_links_find_every_component(spark, monkeypatch, chunk, tile):
    """Clusters around hot fingerprints, small chunks and tiles."""
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    monkeypatch.setattr(simhash, "TILE", tile)
    rng = np.random.default_rng(5)
    fps = set(rng.integers(0, 2 ** 64, 150, dtype="u8").tolist()) | {0, 2 ** 64 - 1}
    for centre in list(fps)[:8]:
        for _ in range(40):
            fps.add(centre ^ sum({1 << int(b) for b in rng.choice(64, rng.integers(1, 7), replace=False)}))
    fps = np.array(sorted(fps), "u8")
    label = components_of(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4)
    distinct = spark.createDataFrame([(int(f),) for f in fps.view("i8")], "fp long")
    got = connected_components(simhash.fingerprint_links(distinct, 4)).collect()
    found = {r.node: r.component for r in got}
    groups = {}
    for k, f in enumerate(fps.view("i8").tolist()):
        groups.setdefault(label[k], set()).add(found.get(f, f))
    assert all(len(g) == 1 for g in groups.values())
    assert len(set.union(*groups.values())) == len(groups)


def test_tiles_and_block_scheme():
    rng = np.random.default_rng(2)
    fps = np.concatenate([rng.integers(0, 2 ** 64, 50, dtype="u8")] * 2)
    fps[50:] ^= np.uint64(0b1011)
    a, b = simhash._compare(fps, 4)
    assert len(a) == 50 and (np.bitwise_count(a ^ b) <= 4).all()
    side = np.r_[np.ones(50, int), np.full(50, 2)]
    a, b = simhash._compare(np.concatenate([fps[:50], fps[:50]]), 4, side)
    assert len(a) == 50
    assert [simhash.block_scheme(n, 4) for n in (1, 10 ** 6, 10 ** 8, 10 ** 11)] == [5, 5, 6, 7]


def test_embedding_groups(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 24))
    rows = [(k, (centres[k % 12] + rng.normal(size=24) * 0.28).astype("f4").tolist()) for k in range(300)]
    rows += [(400 + k, rows[0][1]) for k in range(30)] + [(500, [2 * x for x in rows[1][1]])]
    rows += [(600, None), (601, []), (602, [0.0] * 24), (603, [1.0, None] + [0.0] * 22), (604, [float("nan")] + [1.0] * 23),
             (605, [float("inf")] + [1.0] * 23), (None, rows[2][1]), (606, [1.0, 1.0]), (607, [1.0, 1.1]), (608, [1e38] * 24),
             (0, rows[5][1])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, cid string")
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    near = np.zeros((len(rows), len(rows)), bool)
    for i in range(len(rows)):
        for j in range(len(rows)):
            if i != j and ok[i] and ok[j] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], "f8"), np.array(rows[j][1], "f8")
                near[i, j] = a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= 0.9
    label = components_of(near | np.eye(len(rows), dtype=bool))
    want = Counter()
    for k, (i, _) in enumerate(rows):
        least = min((rows[j][0] for j in np.flatnonzero(label == label[k]) if rows[j][0] is not None), default=None)
        want[i, int(near[k].sum()), least, i is None and least is None or i == least if i is not None else True] += 1
    got = embeddings.embedding_groups(df, 0.9).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == Counter(k[:3] for k in want.elements())
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    assert embeddings.embedding_groups(df.limit(0), 0.9).count() == 0


def test_near_pairs_in_tiles(monkeypatch):
    rng = np.random.default_rng(4)
    x = np.repeat(rng.normal(size=(20, 32)), 25, 0) + rng.normal(size=(500, 32)) * 0.4
    u = embeddings._unit(pa.array(x.tolist(), pa.list_(pa.float64())))
    axes = np.linalg.eigh(u.T @ u)[1][:, ::-1].copy()
    monkeypatch.setattr(embeddings, "BLOCK", 64)
    for step in (4, 24, 40):
        monkeypatch.setattr(embeddings, "STEP", step)
        for side in (np.zeros(500, "int64"), rng.integers(1, 3, 500)):
            near = u @ u.T >= 0.9
            np.fill_diagonal(near, False)
            if side.any():
                near &= side[:, None] != side[None, :]
            table = pa.table({"cid": np.arange(500), "n": np.arange(500) + 1,
                              "embedding": pa.array(x.tolist(), pa.list_(pa.float64()))})
            tiles = [embeddings.Tile(table.filter(pa.array(side == k)), axes) for k in sorted(set(side.tolist()))]
            cid, links, to = embeddings.pair_links(tiles[0], tiles[-1], 0.9)
            assert dict(zip(cid.tolist(), links.tolist())) == {
                k: int((near[k] * (np.arange(500) + 1)).sum()) for k in range(500) if near[k].any()}
            label = components_of(near | np.eye(500, dtype=bool))
            linked = np.array([[label[c], label[t]] for c, t in zip(cid, to)]).reshape(-1, 2)
            assert (linked[:, 0] == linked[:, 1]).all()


def test_tiles_of_a_hot_direction_stay_bounded(spark, monkeypatch):
    """Scaled copies of one vector and vectors around many centres: every link is
    found, tiles are bounded, and pairs of tiles out of reach are left out."""
    monkeypatch.setattr(embeddings, "TILE", 64)
    rng = np.random.default_rng(8)
    one = rng.normal(size=16)
    x = np.concatenate([one[None, :] * np.arange(1, 401)[:, None],
                        np.repeat(rng.normal(size=(8, 16)), 100, 0) + rng.normal(size=(800, 16)) * 0.2])
    df = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<double>").repartition(5)
    u = x / np.sqrt((x * x).sum(1))[:, None]
    near = u @ u.T >= 0.9
    label = components_of(near)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.embedding_groups(df, 0.9).collect()}
    assert got == {k: (int(near[k].sum()) - 1, int(label[k])) for k in range(len(x))}
    classes = df.select(F.col("vec_id").alias("cid"), F.lit(1).cast("long").alias("n"), "embedding")
    axes, mean = embeddings.principal_axes(classes, 16)
    tiles = embeddings.write_tiles(classes, axes, mean, len(x))
    assert len(tiles) >= len(x) / 64
    low, high, rest = (np.array([t[k] for t in tiles]) for k in (2, 3, 4))
    bounds = np.array([embeddings.box_bound(low, high, rest, k, np.arange(len(tiles))) for k in range(len(tiles))])
    assert (bounds < 0.9).mean() > 0.3


# -- classifier, rules, language models, mixing ---------------------------------------

def test_quality_separates_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    got = quality.score_quality(docs, labels).join(labels, "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and ((got.score >= 0.7).astype(int) == got.predicted).all()
    held = got[got.held_out]
    assert (held.predicted == held.quality).mean() > 0.9


def test_quality_does_not_read_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS string) AS binary)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    one = {r.doc_id: r.score for r in quality.score_quality(docs, labels).collect()}
    assert one == {r.doc_id: r.score for r in quality.score_quality(docs.drop("lang", "source"), flipped).collect()}


def test_dual_coordinate_descent_meets_the_optimum():
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 12, 5)) for _ in range(60)]
    y, values = rng.choice([-1.0, 1.0], 60), rng.normal(size=12)
    w = quality.dual_coordinate_descent(rows, values, y, 0.5, 2000)
    x = np.zeros((60, 12))
    for k, r in enumerate(rows):
        x[k, r] = values[r]

    def loss(v):
        return v @ v / 2 + 0.5 * np.maximum(0, 1 - y * (x @ v)).sum()
    assert all(loss(w) <= loss(w + rng.normal(size=12) * s) + 1e-6 for s in (1e-3, 1e-2, 0.1) for _ in range(50))


@pytest.mark.parametrize("labels", [[], [(5, 1, 0)], [(5, 1, 0), (10, 0, 1), (10, 1, 0), (None, 1, 0), (8, None, None)]])
def test_quality_of_odd_rows(spark, odd, none, labels):
    known = spark.createDataFrame(labels, LABELS)
    got = quality.score_quality(odd, known).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, *_ in ODD)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    kept = quality.keep_by_quality(odd, known)
    assert kept.columns == odd.columns and kept.count() == sum(r.predicted for r in got)
    assert quality.score_quality(none, known).count() == 0


@pytest.mark.parametrize("good,bad", [("careful report found useful", "casino jackpot cheap pills"),
                                      ("研究報告書詳細", "賭場大獎廉價藥"), ("отчёт найден полезным", "казино дешёвые таблетки")])
def test_quality_by_words_of_any_script(spark, good, bad):
    rng = np.random.default_rng(4)
    gap = " " if " " in good else ""
    rest = list("的一是不了人我在") if not gap else ["the", "and", "with", "then", "this"]
    texts = [gap.join(rng.choice([*rest, *(good if k % 3 else bad).split()] if gap else [*rest, *(good if k % 3 else bad)], 30))
             for k in range(240)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(240)], LABELS)
    held = [r for r in quality.score_quality(docs, labels).collect() if r.held_out]
    assert len(held) > 30 and all(r.predicted == int(r.doc_id % 3 > 0) for r in held)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("abAB \n\té日本𝄞"), max_size=60), st.sampled_from([1 << 20, 64]))
def test_word_and_code_point_features(text, piece):
    old, quality.PIECE = quality.PIECE, piece
    try:
        got = quality._word_features(text.encode())
    finally:
        quality.PIECE = old
    words = text.encode().lower().split()
    points = [(x,) for x in text if ord(x) > 127] + [x for x in zip(text.encode().lower().decode(), text[1:]) if ord(x[0]) > 127]
    many = len(set(words)) + len(set(zip(words, words[1:]))) + len({tuple(y.encode().lower() for y in x) for x in points})
    assert len(got) == many and (got >= quality.SHAPES).all() and (got < quality.FEATURES).all()
    if len(text.encode()) <= 64:
        assert (got == quality._word_features(text.encode())).all()


def test_score_is_the_curve_of_the_summed_weights():
    texts = [sentence(k) if k % 2 else "Buy $$$ " + sentence(k) for k in range(60)]
    rows = [quality.features(t.encode()) for t in texts]
    w, a, b = quality.fit(rows, [k % 2 for k in range(60)])
    model = quality.Model(w, a, b)
    for t, r in zip(texts, rows):
        assert model.score(t.encode()) == pytest.approx(1 / (1 + np.exp(-(a * sum(w[j] for j in r.tolist()) + b))))
    assert model.score(None) == model.score(b"") == pytest.approx(1 / (1 + np.exp(-(a * w[0] + b))))


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[k:k + 8]) for k in range(len(words) - 7)]
    often = Counter(windows)
    covered = {q for k, x in enumerate(windows) if often[x] > 1 for q in range(k, k + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


def rule_row(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_base_counts(spark, odd, none):
    got = host_rules.host_rules(odd).collect()
    assert Counter((r.doc_id, *rule_row(r)) for r in got) == Counter((i, *plain_counts(t)) for i, t, *_ in ODD)
    assert host_rules.host_rules(none).count() == 0
    kept = host_rules.keep_by_host_rules(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r.kept for r in got)


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab \n|é\t"), max_size=80), min_size=60, max_size=60))
def test_base_counts_of_any_text(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'s' AS source")
    assert {r.doc_id: rule_row(r) for r in host_rules.host_rules(docs).collect()} == {k: plain_counts(t) for k, t in enumerate(texts)}


def test_bad_hosts_take_their_documents_along(spark):
    good, bad = sentence(1), "short"
    rows = [("good", good)] * 40 + [("bad", bad)] * 38 + [("bad", good)] * 2 + [("tiny", bad)] + [(None, good)] * 5 + [("mixed", good)] * 30 + [("mixed", bad)] * 3
    docs = spark.createDataFrame([(k, t, h) for k, (h, t) in enumerate(rows)], "doc_id long, text string, source string")
    kept = {r.doc_id: r.kept for r in host_rules.host_rules(docs).collect()}
    assert [kept[k] for k in range(len(rows))] == [t == good and h != "bad" for h, t in rows]


def test_the_prior_leaves_out_chance(spark):
    """Small hosts of one common rate shrink to it; a host beyond chance does not."""
    rng = np.random.default_rng(8)
    rows = [(f"h{h}", bool(rng.random() < 0.2)) for h in range(300) for _ in range(5)]

    def verdicts(rows):
        return {r.host: r for r in host_rules.host_verdicts(spark.createDataFrame(rows, "host string, failed boolean")).collect()}
    alike = verdicts(rows)
    assert all(r.host_kept and 0.1 < r.host_rate < 0.35 for r in alike.values())
    mixed = verdicts(rows + [("bad", k % 10 > 0) for k in range(500)])
    assert [h for h, r in mixed.items() if not r.host_kept] == ["bad"] and mixed["bad"].host_rate > 0.8
    assert verdicts([("a", True), ("a", False)])["a"].host_rate == 0.5
    assert verdicts([("a", False), ("b", False)])["b"].host_rate == 0


def plain_loss(docs, chosen, own, text, types):
    """The loss of a text under the chosen texts other than ``own``, by plain counts."""
    texts = [["|", *t.split(), "|"] for k, t in docs if k in set(chosen) and k != own]
    pairs, words = Counter(p for t in texts for p in zip(t, t[1:])), Counter(w for t in texts for w in t[1:])
    total = sum(words.values())
    w = ["|", *text.split(), "|"]
    share = {x: 0.99 * words[x] / total + 0.01 / types if total else 1 / types for x in w}
    return -np.mean([np.log((pairs[a, b] + 16 * share[b]) / (words[a] + 16)) for a, b in zip(w, w[1:])])


def test_two_halves_of_one_kind_score_alike(spark):
    """Texts of the target score as others of their kind do, not as known ones."""
    rng = np.random.default_rng(6)
    kinds = [[f"{c}{k}" for k in range(400)] for c in "gb"]
    docs = [(k, " ".join(kinds[k % 4 == 3][min(int(x), 399)] for x in rng.pareto(0.6, 60))) for k in range(400)]
    target = spark.createDataFrame([(k,) for k in range(400) if k % 4 == 0], "doc_id long")
    got = {r.doc_id: r.score for r in lm_scoring.cross_entropy_difference(
        spark.createDataFrame(docs, "doc_id long, text string"), target).collect()}
    inside, outside, other = ([got[k] for k in range(400) if k % 4 in of] for of in ((0,), (1, 2), (3,)))
    assert abs(np.median(inside) - np.median(outside)) < 0.15
    assert min(other) > max(*inside, *outside)


def test_cross_entropy_difference(spark, odd, none):
    rng = np.random.default_rng(1)
    mine, other = list("abcdef"), list("uvwxyz")
    docs = [(k, " ".join(rng.choice(mine if k % 2 else other, 40))) for k in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    target = spark.createDataFrame([(k,) for k in range(1, 40, 2)], "doc_id long")
    got = {r.doc_id: r for r in lm_scoring.cross_entropy_difference(df, target).collect()}
    assert max(got[k].score for k in range(1, 60, 2)) < min(got[k].score for k in range(0, 60, 2))
    for k, t in docs[:6]:
        assert got[k].n_tokens == 41
        assert got[k].background_loss == pytest.approx(plain_loss(docs, range(60), k, t, 12 + 2))
        assert got[k].target_loss == pytest.approx(plain_loss(docs, range(1, 40, 2), k, t, 12 + 2))
    for ids in ([], [(5,), (None,), (5,), (10,)]):
        rows = lm_scoring.cross_entropy_difference(odd, spark.createDataFrame(ids, "doc_id long")).collect()
        assert Counter(r.doc_id for r in rows) == Counter(i for i, *_ in ODD)
        assert all(r.score == 0 for r in rows if r.n_tokens == 0) and all(np.isfinite(r.score) for r in rows)
    assert lm_scoring.cross_entropy_difference(none, target).count() == 0


def test_rare_words_and_pairs_of_a_large_corpus_count(spark, monkeypatch):
    rng = np.random.default_rng(2)
    docs = [(k, " ".join(rng.choice(list("abcdefgh"), 1500))) for k in range(80)]
    docs += [(80, "a rare gem b"), (81, "a rare gem c"), (82, "gem h rare"), (83, "odd one")]
    some = {0, 1, 80}
    monkeypatch.setattr(lm_scoring, "CHUNK", 20_000)
    monkeypatch.setattr(lm_scoring, "BUCKET", 1 << 16)
    got = {r.doc_id: r for r in lm_scoring.cross_entropy_difference(
        spark.createDataFrame(docs, "doc_id long, text string").coalesce(2),
        spark.createDataFrame([(k,) for k in some], "doc_id long")).collect()}
    size = len({w for _, t in docs for w in t.split()}) + 2

    for k, t in docs[-8:]:
        assert got[k].n_tokens == len(t.split()) + 1
        assert got[k].background_loss == pytest.approx(plain_loss(docs, range(84), k, t, size))
        assert got[k].target_loss == pytest.approx(plain_loss(docs, some, k, t, size))
    assert len(got) == len(docs)


def test_model_shares_add_up_to_one():
    words, pairs = np.array([3, 5, 4]), np.array([[0, 3, 0], [2, 0, 3], [1, 2, 1]])
    for first in range(3):
        loss = lm_scoring.losses(words, words[first], pairs[first], 12, 3)
        assert pairs[first].sum() == words[first] and np.exp(-loss).sum() == pytest.approx(1)
    assert np.exp(-lm_scoring.losses(np.zeros(3), np.zeros(3), np.zeros(3), 0, 3)).sum() == pytest.approx(1)


def mixing_tables(spark, n=240):
    marks = {"general": "calm", "toxic": "nasty", "low_quality": "junk"}
    names = ["general"] * 4 + ["toxic", "low_quality"]
    docs = [(k, sentence(k, 30 + k % 7) + (" " + marks[names[k % 6]]) * 2, "en", "s") for k in range(n)]
    labels = [(k, int(names[k % 6] != "low_quality"), int(names[k % 6] == "toxic")) for k in range(0, n, 2)] + \
             [(k, int(names[k % 6] != "low_quality"), int(names[k % 6] == "toxic")) for k in range(1, n, 2)][:60]
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"),
            spark.createDataFrame(labels, LABELS), names)


def test_mixing_meets_its_targets(spark):
    docs, labels, names = mixing_tables(spark)
    targets = {"general": 0.8, "toxic": 0.05, "low_quality": 0.15}
    got = mixing.mixture(docs, mixing.label_domains(labels), targets).toPandas()
    p = np.array(got.p.tolist())
    assert np.allclose(p.sum(1), 1) and (got.rate >= 0).all()
    right = [sorted(targets)[k] == names[i % 6] for k, i in zip(p.argmax(1), got.doc_id)]
    assert np.mean(right) > 0.95
    reached = (p * (got.n_tokens * got.rate).values[:, None]).sum(0) / got.n_tokens.sum()
    assert np.allclose(reached, [targets[d] for d in sorted(targets)], atol=1e-4)
    shares = mixing.reached_shares(spark.createDataFrame(got[["n_tokens", "rate", "p"]]), targets).collect()
    assert [(r.domain, r.target) for r in shares] == [(d, pytest.approx(targets[d])) for d in sorted(targets)]
    assert [r.reached for r in shares] == pytest.approx((reached / reached.sum()).tolist())
    mixed = mixing.mix_documents(docs, mixing.label_domains(labels), targets).toPandas()
    share = Counter(names[i % 6] for i in mixed.doc_id)
    assert abs(share["general"] / len(mixed) - 0.8) < 0.08


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100}, {"a": 60, "b": 60, "c": 60}, {"a": 40, "low": 160}])
def test_mixing_tells_domains_of_any_size_apart(spark, sizes):
    names = [d for d, n in sizes.items() for _ in range(n)]
    # A word in every document of the first domain and in none of the others, and
    # one that is less than twice as common in the last one.
    docs = [(k, sentence(k, 20) + (" mark" if d == "a" else "") + (" often" if k % 4 or d == names[-1] else ""))
            for k, d in enumerate(names)]
    labels = [(k, d) for k, d in enumerate(names) if k % 2]
    got = mixing.mixture(spark.createDataFrame(docs, "doc_id long, text string"),
                         spark.createDataFrame(labels, "doc_id long, domain string"), {d: 1 / len(sizes) for d in sizes}).toPandas()
    a = got.doc_id.map(lambda k: names[k] == "a")
    p = np.array(got.p.tolist())[:, 0]
    assert (p[a] > 0.5).mean() > 0.95 and (p[~a] < 0.5).mean() > 0.95


def test_mixing_of_odd_rows(spark, odd, none):
    targets = {"general": 0.9, "toxic": 0.05, "low_quality": 0.05}
    for rows in ([], [(5, 1, 0), (10, 0, 0), (10, 1, 1), (None, 1, 0), (8, None, None)]):
        labels = mixing.label_domains(spark.createDataFrame(rows, LABELS))
        got = mixing.mixture(odd, labels, targets).collect()
        assert Counter(r.doc_id for r in got) == Counter(i for i, *_ in ODD)
        assert all(np.isfinite(r.rate) and r.rate >= 0 for r in got)
        assert mixing.mix_documents(odd, labels, targets).columns == odd.columns
        assert mixing.mixture(none, labels, targets).count() == 0
        assert mixing.mix_documents(none, labels, targets).count() == 0


def test_small_systems():
    assert mixing._solve([[2.0, 1.0], [1.0, 3.0]], [3.0, 5.0]) == pytest.approx([0.8, 1.4])
    assert mixing._solve([[0.0, 0.0], [0.0, 4.0]], [1.0, 2.0]) == pytest.approx([0.0, 0.5])


# -- archives and conversations -------------------------------------------------

PAGES = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, None, None), (4, "http://a/\r\n4", ""), (None, "u", "same"),
         (5, "u", "é" * 300), (5, "u", "é" * 300), (6, "u", "WARC/1.1\r\n\r\n\r\n"), (7, "u", "x" * 5000), (None, None, None)]


@pytest.mark.parametrize("chunk", [64, 1 << 18])
def test_warc_round_trip(spark, chunk):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, sha1 string")
    folder = shared_folder(spark, "warc")
    names = warc.write_warc(pages, folder, 0, chunk)
    table = warc.read_warc(spark, folder, names, chunk)
    chunks = sorted(table.collect(), key=lambda r: (r.record_id, r.chunk_no))
    assert max(len(r.chunk) for r in chunks) <= chunk
    payloads = {}
    for r in chunks:
        if r.record_type == "response":
            payloads[r.record_id] = payloads.get(r.record_id, b"") + bytes(r.chunk)
            so_far = payloads[r.record_id]
            assert (r.digest_so_far, r.payload_bytes) == (base64.b32encode(hashlib.sha1(so_far).digest()).decode(), len(so_far))
    assert Counter(payloads.values()) == Counter({(h or "").encode() for *_, h in PAGES})
    want = Counter()
    for k, (i, _, h) in enumerate(PAGES):
        data = (h or "").encode()
        same = [(-1 if p[0] is None else p[0]) for p in PAGES if (p[2] or "") == (h or "")]
        # Of equal ids any one is the response.
        later = any((p[2] or "") == (h or "") and p[0] == i for p in PAGES[k + 1:])
        top = (-1 if i is None else i) == max(same) and not later
        want[i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if top else "revisit",
             None if top else max(same)] += 1
    got = warc.page_records(table).collect()
    assert Counter(map(tuple, got)) == want


def test_warc_threshold_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "u", "aa"), (2, "u", "aa"), (3, "u", "bbbbbb"), (4, "u", "bbbbbb")], "page_id long, url string, html string")
    folder = shared_folder(spark, "warc")
    got = warc.page_records(warc.read_warc(spark, folder, warc.write_warc(pages, folder, 5))).collect()
    assert {r.page_id: (r.record_type, r.refers_to) for r in got} == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}
    folder = shared_folder(spark, "warc")
    names = warc.write_warc(pages.limit(0), folder)
    assert names == [] and warc.read_warc(spark, folder, names).count() == 0


def test_preferences(spark):
    schema = "pair_id long, turn long, role string, text string, part string"
    chosen = [(1, 0, "user", "q"), (1, 1, "assistant", "good <|x"), (2, 0, "user", "same"), (2, 1, "assistant", "same"),
              (3, 0, "user", "a"), (3, 1, "assistant", "b"), (3, 2, "user", "c"), (3, 2, "user", "c"), (3, 3, "assistant", "d"),
              (4, 0, None, None), (None, 0, "user", "z"), (4, None, "user", "z")]
    rejected = [(1, 0, "user", "q"), (1, 1, "assistant", "bad"), (2, 0, "user", "same"), (2, 1, "assistant", "same"),
                (3, 0, "user", "a"), (3, 1, "assistant", "B"), (3, 2, "user", "c"), (5, 0, "user", "only here")]
    got = chat.format_preferences(*(spark.createDataFrame([(*r, "x") for r in rows], schema) for rows in (chosen, rejected))).collect()
    text = {}
    for r in sorted(got, key=lambda r: (r.pair_id, r.part, r.turn)):
        text[r.pair_id, r.part] = text.get((r.pair_id, r.part), "") + r.rendered
        trained = r.role == "assistant" and r.part != "prompt"
        assert (r.mask_start is not None) == trained
        if trained:
            assert r.rendered[:r.mask_start] == "<|assistant|>\n" and r.mask_end == len(r.rendered)

    def turn(role, words):
        return f"<|{role}|>\n{words}\n<|end|>\n"
    assert text == {
        (1, "prompt"): turn("user", "q"), (1, "chosen"): turn("assistant", "good <\\|x"), (1, "rejected"): turn("assistant", "bad"),
        (2, "prompt"): turn("user", "same") + turn("assistant", "same"),
        (3, "prompt"): turn("user", "a"), (3, "chosen"): turn("assistant", "b") + turn("user", "c") + turn("assistant", "d"),
        (3, "rejected"): turn("assistant", "B") + turn("user", "c"), (4, "chosen"): turn("", ""), (5, "rejected"): turn("user", "only here")}


def test_reply_swaps_of_odd_turns(spark):
    schema = "conv_id long, turn long, role string, text string, last string"
    rows = [(1, 0, "user", "q1"), (1, 1, "assistant", "r1"), (1, 2, "user", "bye"), (2, 0, "user", "q2"), (2, 1, "assistant", None),
            (4, 0, "user", "no reply"), (None, 0, "assistant", "x"), (9, None, "assistant", "x"), (2 ** 63 - 1, 0, "assistant", "end")]
    chosen, rejected = chat.reply_swaps(spark.createDataFrame([(*r, "x") for r in rows], schema))
    assert sorted((r.pair_id, r.turn, r.text or "") for r in chosen.collect()) == [
        (1, 0, "q1"), (1, 1, "r1"), (1, 2, "bye"), (2, 0, "q2"), (2, 1, ""), (4, 0, "no reply"), (2 ** 63 - 1, 0, "end")]
    # The reply of the next id that has one, across the gaps; what follows it stays.
    assert sorted((r.pair_id, r.turn, r.text) for r in rejected.collect()) == [
        (1, 0, "q1"), (1, 1, ""), (1, 2, "bye"), (2, 0, "q2"), (2, 1, "end"), (4, 0, "no reply"), (2 ** 63 - 1, 0, "")]
    got = chat.format_preferences(chosen, rejected).collect()
    assert {(r.pair_id, r.turn) for r in got} == {(r.pair_id, r.turn) for r in chosen.collect()}
    assert [r.part for r in got if r.pair_id == 4] == ["prompt"]
    assert all(r.mask_start is None for r in got if r.role != "assistant")
    empty = spark.createDataFrame([], schema)
    assert chat.format_preferences(*chat.reply_swaps(empty)).count() == 0
