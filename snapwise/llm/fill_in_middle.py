"""Fill-in-the-middle documents as piece tables.

A document is a list of descriptors (buffer, start, length in bytes) over two
buffers that never change: its text, which stays where Arrow put it, and the
sentinels. Cutting splits a descriptor in two, an arrangement permutes the
descriptors of the three parts and their sentinels, and the inverse permutation
brings them back. Output and restored text are hashed by streaming the bytes that
the descriptors name; neither is ever put together, so a row needs no memory
beyond its text. There is no shuffle: a lost task reads its rows again.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The sentinel buffer; a sentinel is three bytes of it.
SENTINELS = b"<P><S><M>"
TEXT, MARKS = 0, 1
PREFIX, SUFFIX, MIDDLE = ((MARKS, at, 3) for at in (0, 3, 6))
HAS_SENTINEL = re.compile(rb"<[PSM]>")

#: The pieces sentinel, prefix, sentinel, suffix, sentinel, middle in output order.
ORDERS = {"psm": (0, 1, 2, 3, 4, 5), "spm": (2, 3, 0, 1, 4, 5)}

#: Bytes looked at once when code points are counted.
BLOCK = 1 << 20

PIECES = "array<struct<buffer:int,start:long,length:long>>"


def cut(piece: tuple, at: int) -> tuple[tuple, tuple]:
    """A descriptor split ``at`` bytes from its start."""
    buffer, start, length = piece
    return (buffer, start, at), (buffer, start + at, length - at)


def arrange(parts: list[tuple], form: str) -> list[tuple]:
    """The output's descriptors of (prefix, middle, suffix); plain: unchanged."""
    if form == "plain":
        return parts
    prefix, middle, suffix = parts
    pieces = [PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle]
    return [pieces[k] for k in ORDERS[form]]


def restore(pieces: list[tuple], form: str) -> list[tuple]:
    """The text's descriptors from the output's: the inverse permutation, without
    the sentinels."""
    if form == "plain":
        return pieces
    back = [pieces[ORDERS[form].index(k)] for k in range(6)]
    return [back[1], back[5], back[3]]


def stream(pieces: list[tuple], text: memoryview):
    """The bytes of the pieces, one view each."""
    buffers = (text, memoryview(SENTINELS))
    for buffer, start, length in pieces:
        yield buffers[buffer][start:start + length]


def digest(pieces: list[tuple], text: memoryview) -> str:
    sha = hashlib.sha256()
    for view in stream(pieces, text):
        sha.update(view)
    return sha.hexdigest()


class CodePoints:
    """Byte offsets of code points of UTF-8 bytes, a block at a time."""

    def __init__(self, text: memoryview):
        import numpy as np
        self.bytes = np.frombuffer(text, "i1") if len(text) else np.empty(0, "i1")  # continuation bytes are below -64
        self.counts = [int(np.count_nonzero(self.bytes[at:at + BLOCK] >= -64)) for at in range(0, len(self.bytes), BLOCK)]
        self.n = sum(self.counts)

    def offset(self, k: int) -> int:
        """Where code point ``k`` begins (n: the end)."""
        import numpy as np
        if k == self.n or self.n == len(self.bytes):
            return len(self.bytes) if k == self.n else k
        block = 0
        while k >= self.counts[block]:
            k -= self.counts[block]
            block += 1
        return block * BLOCK + int(np.flatnonzero(self.bytes[block * BLOCK:(block + 1) * BLOCK] >= -64)[k])


def transform(doc_id: str, text: memoryview, seed: str, fim_percent: int, spm_percent: int):
    """(n, form, prefix_chars, middle_chars, output pieces) of one document."""
    key = hashlib.sha256(f"{seed}:{doc_id}".encode()).digest()
    h1, h2, h3, h4 = (int.from_bytes(key[k:k + 4]) for k in (0, 4, 8, 12))
    points = CodePoints(text)
    n, whole = points.n, (TEXT, 0, len(text))
    if not n or h3 % 100 >= fim_percent or HAS_SENTINEL.search(text):
        return n, "plain", None, None, [whole]
    form = "spm" if h4 % 100 < spm_percent else "psm"
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    head, suffix = cut(whole, points.offset(b))
    prefix, middle = cut(head, points.offset(a))
    return n, form, a, b - a, arrange([prefix, middle, suffix], form)


def fill_in_middle(docs: DataFrame, seed: str = "1", fim_percent: int = 90, spm_percent: int = 20,
                   with_output: bool = False) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, pieces, output_sha256,
    restored_sha256`` of every row of ``docs`` (doc_id, text; other columns are
    ignored), and the ``output`` text if asked for.

    n is the number of code points; prefix_chars and middle_chars are null in
    plain rows. ``pieces`` are the output's descriptors: buffer 0 is the text's
    UTF-8 bytes, 1 is ``SENTINELS``. The seed and the id decide form and cuts.
    Null text is an empty one, and empty texts, texts that hold a sentinel and
    the share above ``fim_percent`` stay plain; a null id counts as no digits.
    Rows with equal ids and texts have equal results; very long texts are cut
    like any other; an empty table stays empty."""
    schema = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, "
              f"pieces {PIECES}, output_sha256 string, restored_sha256 string")
    if with_output:
        schema += ", output string"

    def run(batches):
        import pyarrow as pa
        piece = pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())])
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(piece), pa.string(), pa.string()]
        types += [pa.string()] * with_output
        for batch in batches:
            ids, keys, texts = batch.columns
            # A slice at a time, so that outputs of long texts are not all held at once.
            for lo in range(0, batch.num_rows, 256):
                rows = []
                for k in range(lo, min(lo + 256, batch.num_rows)):
                    text = memoryview(texts[k].as_buffer())
                    n, form, a, m, pieces = transform(keys[k].as_py(), text, seed, fim_percent, spm_percent)
                    row = (ids[k].as_py(), n, form, a, m,
                           [dict(zip(("buffer", "start", "length"), p)) for p in pieces],
                           digest(pieces, text), digest(restore(pieces, form), text))
                    rows.append((*row, b"".join(stream(pieces, text)).decode()) if with_output else row)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    names = [c.split()[0] for c in schema.split(", ")]
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")).mapInArrow(run, schema)
