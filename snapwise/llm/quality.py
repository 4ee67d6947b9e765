"""Quality scores by Naive Bayes support vectors.

A text becomes a set of n-gram indicators: n-grams of its word shapes (runs of
capitals, letters, digits and each mark, white space kept as it stands) and of
repeated words, each at several frequency levels; its words and pairs of
neighbouring words, A-Z lower-cased; and its code points beyond ASCII, alone and
with the next one, which stand for words where a script puts no spaces. All are
hashed to a fixed number of features. Indicators are scaled by the classes'
smoothed log-count ratios, a linear hinge-loss model is fitted by dual coordinate
descent, and its margins are mapped to 0..1 by a logistic curve fitted on rows
kept out of that fit.

The model is fitted on the driver on at most ``MAX_ROWS`` labelled rows, taken
by the order of a hash of their id; every document is scored, in Arrow batches.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from snapwise.llm.common import rows_of

#: Features of the shapes and of words and code points, the bound on labelled rows
#: for the fit, n-gram orders, and the shares of a text at which an n-gram's
#: indicators switch on. A word or code-point feature counts if at least
#: ``MIN_SEEN`` of the fitted rows have it.
SHAPES, WORDS, MAX_ROWS, ORDERS, MIN_SEEN = 1 << 18, 1 << 20, 12_000, (1, 2, 3, 4, 5), 3
FEATURES = SHAPES + WORDS
LEVELS = (0.0, 1 / 512, 1 / 128, 1 / 32, 1 / 8)
PIECE = 1 << 20

_CLASSES = bytes(
    0x61 if 0x61 <= b <= 0x7A or b >= 0x80 else 0x41 if 0x41 <= b <= 0x5A else 0x30 if 0x30 <= b <= 0x39
    else 0x20 if b in (0x09, 0x0B, 0x0C, 0x0D) else b for b in range(256))


def _shape_grams(data: bytes):
    """(hash, count) of the shape n-grams of a text, and the shape's length."""
    import numpy as np
    shape = np.frombuffer(data.translate(_CLASSES), "u1")
    keep = np.empty(len(shape), bool)
    keep[:1] = True
    np.not_equal(shape[1:], shape[:-1], out=keep[1:])
    shape = shape[keep].astype("u8")
    found = {}
    for order in ORDERS:
        for at in range(0, len(shape) - order + 1, PIECE):
            part = shape[at:at + PIECE + order - 1]
            n = len(part) - order + 1
            code = np.full(n, order, "u8")
            for k in range(order):
                code = code * np.uint64(257) + part[k:k + n]
            for c, m in zip(*(x.tolist() for x in np.unique(code, return_counts=True))):
                found[c] = found.get(c, 0) + m
    return found, len(shape)


_ODD = 0x9E3779B97F4A7C15


@functools.cache
def _powers(base: int, n: int):
    """The powers 0 to n of an odd base, modulo 2^64."""
    import numpy as np
    out = np.full(n + 1, base, "u8")
    out[0] = 1
    return np.multiply.accumulate(out)


@functools.cache
def _byte_values():
    """A number for each byte, and whether it is white space."""
    import numpy as np
    return _mixed(np.arange(1, 257, dtype="u8"), 5), np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def _mixed(code, kind: int):
    import numpy as np
    code = (code ^ (code >> np.uint64(29))) * np.uint64(_ODD) + np.uint64(kind)
    return (code ^ (code >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)


def _spans(data: bytes):
    """Pieces of a text of at most ``PIECE`` bytes as (start, end), cut at the last
    space of a piece, else before a code point."""
    start = 0
    while len(data) - start > PIECE:
        end = data.rfind(b" ", start, start + PIECE) + 1
        if end <= start:
            end = start + PIECE
            while data[end] & 0xC0 == 0x80 and end > start + PIECE - 4:
                end -= 1
        yield start, end
        start = end
    yield start, len(data)


def _word_features(data: bytes):
    """Distinct features of the words, word pairs and code points of a text. A word
    or code point is hashed by the difference of two prefix sums of its bytes."""
    import numpy as np
    value, blank = _byte_values()
    size = 1 << (min(len(data), PIECE) + 8).bit_length()
    power, inverse = _powers(_ODD, size), _powers(pow(_ODD, -1, 1 << 64), size)
    found, before = [], np.zeros(0, "u8")
    for start, end in _spans(data):
        part = np.frombuffer(data[start:end + 4].lower(), "u1")  # the code point after the piece comes along
        own = end - start
        sums = np.concatenate([np.zeros(1, "u8"), np.cumsum(value[part] * power[:len(part)], dtype="u8")])
        edge = np.diff(blank[part[:own]].view("i1"), prepend=1, append=1)
        first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        word = (sums[last] - sums[first]) * inverse[first]
        chain = np.concatenate([before, word])
        found += [_mixed(word, 1), _mixed(chain[:-1] * np.uint64(3) + _mixed(chain[1:], 7), 2)]
        before = chain[-1:]
        if part.max(initial=0) >= 0x80:
            begin = np.flatnonzero((part & 0xC0) != 0x80)
            stop = np.append(begin[1:], len(part))[:len(begin)]
            odd = (part[begin] >= 0x80) & (begin < own)
            found.append(_mixed((sums[stop] - sums[begin])[odd] * inverse[begin[odd]], 3))
            odd[-1:] = False  # the last code point of the text has no next one
            at = np.flatnonzero(odd)
            found.append(_mixed((sums[stop[at + 1]] - sums[begin[at]]) * inverse[begin[at]], 4))
    return np.unique(np.concatenate(found) >> np.uint64(40)) % np.uint64(WORDS) + np.uint64(SHAPES)


def features(data: bytes | None):
    """Sorted feature numbers of a text (null, empty: only the bias 0)."""
    import numpy as np
    if not data:
        return np.zeros(1, "int32")
    grams, length = _shape_grams(data)
    words = data.split()
    same = sum(a == b for a, b in zip(words, words[1:]))
    code = np.fromiter(grams.keys(), "u8", len(grams))
    share = np.fromiter(grams.values(), "f8", len(grams)) / length
    out = [np.zeros(1, "u8")]
    if same:
        code, share = np.append(code, np.uint64(3)), np.append(share, same / len(words))
    for level, least in enumerate(LEVELS):
        mixed = (code[share >= least] * np.uint64(8) + np.uint64(level)) * np.uint64(0x9E3779B97F4A7C15)
        out.append((mixed >> np.uint64(32)) % np.uint64(SHAPES - 1) + np.uint64(1))
    out.append(_word_features(data))
    return np.unique(np.concatenate(out)).astype("int32")


def dual_coordinate_descent(rows, values, y, cost: float = 1.0, epochs: int = 20, seed: int = 7):
    """Weights of the L2-regularized hinge-loss model over sparse ``rows``
    (feature numbers), feature j having the value ``values[j]`` where present."""
    import numpy as np
    rng = np.random.default_rng(seed)
    w, alpha = np.zeros(len(values)), np.zeros(len(rows))
    xs = [values[r] for r in rows]
    q = np.array([max(float(x @ x), 1e-12) for x in xs])
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(len(rows)):
            r, x = rows[i], xs[i]
            g = y[i] * float(w[r] @ x) - 1.0
            new = min(max(alpha[i] - g / q[i], 0.0), cost)
            if new != alpha[i]:
                most = max(most, abs(new - alpha[i]))
                w[r] += (new - alpha[i]) * y[i] * x
                alpha[i] = new
        if most < 1e-4 * cost:
            break
    return w


def _logistic(margin, y, steps: int = 50):
    """(a, b) of the curve 1 / (1 + exp(-(a m + b))), by damped Newton steps on
    smoothed targets."""
    import numpy as np
    good, bad = max(1, (y > 0).sum()), max(1, (y < 0).sum())
    t = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([margin, np.ones_like(margin)], 1)
    p = np.array([1.0, 0.0])
    for _ in range(steps):
        s = 1 / (1 + np.exp(-np.clip(x @ p, -30, 30)))
        h = (x * (s * (1 - s))[:, None]).T @ x + 1e-3 * np.eye(2)
        p = p + np.clip(np.linalg.solve(h, x.T @ (t - s) - 1e-3 * (p - [1.0, 0.0])), -1, 1)
    return float(max(p[0], 1e-6)), float(p[1])


def fit(rows, labels, beta: float = 0.25):
    """(weights over all features, a, b) of labelled rows; weights None and a
    constant score where only one class, or none, is labelled."""
    import numpy as np
    y = np.where(np.asarray(labels) > 0, 1.0, -1.0)
    if len(set(y)) < 2:
        share = ((y > 0).sum() + 1) / (len(y) + 2)
        return None, 0.0, float(np.log(share / (1 - share)))

    def weights(at):
        counts = {s: np.ones(FEATURES) for s in (1.0, -1.0)}
        for i in at:
            counts[y[i]][rows[i]] += 1
        ratio = np.log(counts[1.0] / counts[1.0].sum()) - np.log(counts[-1.0] / counts[-1.0].sum())
        ratio[0] = 1.0
        ratio[SHAPES:][(counts[1.0] + counts[-1.0])[SHAPES:] < 2 + MIN_SEEN] = 0.0
        w = dual_coordinate_descent([rows[i] for i in at], ratio, y[at])
        used = w != 0
        w = np.where(used, (1 - beta) * np.abs(w[used]).mean() + beta * w, 0.0) if used.any() else w
        return w * ratio

    out = np.arange(len(y)) % 5 == 0
    inner = np.flatnonzero(~out) if len(set(y[~out])) == 2 and out.any() else np.arange(len(y))
    w = weights(inner)
    at = np.flatnonzero(out) if out.any() else inner
    a, b = _logistic(np.array([w[rows[i]].sum() for i in at]), y[at])
    return w, a, b


class Model:
    """A fitted model; its weights are of fixed size."""

    def __init__(self, w, a: float, b: float):
        self.w, self.a, self.b = w, a, b

    def score(self, data: bytes | None) -> float:
        import math
        margin = 0.0 if self.w is None else float(self.w[features(data)].sum())
        return 1 / (1 + math.exp(-min(max(self.a * margin + self.b, -30.0), 30.0)))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Fit on labelled rows that are not held out. Of several labels of one id
    the smallest counts; null labels and ids do not. Of rows with equal ids each
    is a training row with that label."""
    spark = docs.sparkSession
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()) \
        .groupBy("doc_id").agg(F.min("quality").alias("quality")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    sample = known.select(F.col("doc_id").alias("_sw_id"), "quality")

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            ids, label, rows = [], [], []
            for i, q, data in rows_of([batch], "_sw_id", "quality", "data"):
                ids.append(i)
                label.append(q)
                rows.append(features(data).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(label, pa.int32()), pa.array(rows, pa.binary())],
                                             names=["id", "label", "features"])

    # At most max_rows labels are broadcast; the ids repeat only as documents do.
    found = docs.select("doc_id", F.col("text").cast("binary").alias("data")) \
        .join(F.broadcast(sample), F.col("doc_id") == F.col("_sw_id")) \
        .select(F.col("_sw_id").cast("long").alias("_sw_id"), F.col("quality").cast("int").alias("quality"), "data") \
        .mapInArrow(run, "id long, label int, features binary") \
        .orderBy(F.xxhash64("id"), "id", "features").limit(max_rows).collect()
    import numpy as np
    return Model(*fit([np.frombuffer(r.features, "int32") for r in found], [r.label for r in found]))


def _scored(docs: DataFrame, model: Model, keep: bool) -> DataFrame:
    """All columns of ``docs`` with ``_sw_score`` (``keep``: only rows scored at
    least 0.7, without it)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            at = [text.slice(i, 256).cast(pa.binary()).to_pylist() for i in range(0, len(text), 256)]
            scores = [shared.value.score(d) for part in at for d in part]
            if keep:
                yield batch.filter(pa.array([s >= 0.7 for s in scores], pa.bool_()))
            else:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())],
                                                 names=[*batch.schema.names, "_sw_score"])

    schema = docs.schema if keep else StructType([*docs.schema.fields, StructField("_sw_score", DoubleType())])
    return docs.mapInArrow(run, schema)


def score_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs`` (doc_id,
    text; other columns are ignored). Null and empty texts have no n-gram and
    get the score of the bias alone."""
    model = fit_quality(docs, labels, max_rows)
    return _scored(docs.select("doc_id", "text"), model, False).select(
        "doc_id", held_out().alias("held_out"), F.col("_sw_score").alias("score"),
        (F.col("_sw_score") >= 0.7).cast("int").alias("predicted"))


def keep_by_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The rows of ``docs`` scored at least 0.7, with all their columns."""
    return _scored(docs, fit_quality(docs, labels, max_rows), True)
