"""Fill-in-the-middle against plain string work on output texts."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from snapwise.llm.fill_in_middle import BLOCK, CodePoints, arrange, cut, fill_in_middle, restore, stream, transform
from tests.llm.test_llm import DOCS, EXTRA, ODD, sentence

TEXTS = st.text(st.sampled_from(list("ab<>PSM \n\té€👍́\x00")), max_size=60)


def plain(doc_id, text, seed="1"):
    """(n, form, prefix_chars, middle_chars, output) by slicing the text."""
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def restored(output, form):
    """The text from the output's characters alone."""
    if form == "plain":
        return output
    x, y, m = re.fullmatch(r"<[PS]>(.*)<[SP]>(.*)<M>(.*)", output, re.S).groups()
    return (x + m + y) if form == "psm" else (y + m + x)


@settings(max_examples=500, deadline=None)
@given(text=TEXTS, doc_id=st.integers(-5, 10 ** 12))
def test_pieces_spell_the_output_and_restore_the_text(text, doc_id):
    view = memoryview(text.encode())
    n, form, a, m, pieces = transform(str(doc_id), view, "1", 90, 20)
    output = b"".join(stream(pieces, view)).decode()
    assert (n, form, a, m, output) == plain(doc_id, text)
    assert b"".join(stream(restore(pieces, form), view)).decode() == text == restored(output, form)


def test_cut_and_permutations():
    whole = (0, 0, 10)
    head, suffix = cut(whole, 7)
    prefix, middle = cut(head, 3)
    assert (prefix, middle, suffix) == ((0, 0, 3), (0, 3, 4), (0, 7, 3))
    for form in ("psm", "spm"):
        pieces = arrange([prefix, middle, suffix], form)
        assert len(pieces) == 6 and restore(pieces, form) == [prefix, middle, suffix]


def test_offsets_over_blocks():
    text = "é€a👍" * (BLOCK // 8)
    points = CodePoints(memoryview(text.encode()))
    assert points.n == len(text) and len(points.counts) > 1
    for k in (0, 1, 5, points.counts[0] - 1, points.counts[0], points.counts[0] + 1, len(text) - 1, len(text)):
        assert points.offset(k) == len(text[:k].encode())


def rows_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, None, *["x"] * len(EXTRA)) for i, t, lang, s in rows], DOCS)


def test_documents_with_odd_rows(spark):
    rows = ODD + [(20 + k, sentence(k) + mark, "en", "a") for k, mark in enumerate(["<P>", "<S>", "<M>", "<P", "€" * 3000])]
    rows.append((40, "x👍" * BLOCK, "en", "a"))
    got = fill_in_middle(rows_of(spark, rows).repartition(3), with_output=True).collect()
    want = []
    for i, t, _, _ in rows:
        n, form, a, m, output = plain(i, t)
        want.append((i, n, form, a, m, hashlib.sha256(output.encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest(), output))
    assert sorted((tuple(r[:5]) + tuple(r[6:]) for r in got), key=str) == sorted(want, key=str)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert all(restored(r.output, r.form) in {t or "" for _, t, _, _ in rows} for r in got)


def test_empty_table(spark):
    got = fill_in_middle(spark.createDataFrame([], DOCS))
    assert got.collect() == [] and got.columns[:3] == ["doc_id", "n", "form"]
