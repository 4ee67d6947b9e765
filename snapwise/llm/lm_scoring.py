"""Cross-entropy difference of two matched n-gram language models.

Target and background model are word bigram models of one form, shrunk towards
unigrams as far as the word before is rare, over one vocabulary: every word of the
corpus, one unknown word, and one mark before and after each text. Counts come from
every whole text, and every word and pair counts, however rare. A text is scored by
models without its own counts, so that texts of the target and others of its kind
score alike. A document's score is the mean, over its tokens, of the loss under the
target model less that under the background model: the lower, the more it is like
the target.

Neither words nor pairs are broadcast or sent to the driver. Tasks cut their texts
into chunks and number the words of each; a chunk's distinct words and pairs, as
hashes in order, go to buckets of hashes, which add them up and send the sums
back to the chunk, whose documents they score. A common word or a repeated text is
one item per chunk, and the number of buckets grows with the texts. Two of n items
share their 63-bit hash, and so their count, with a chance of n * n / 2^64.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapwise.llm.common import rows_of, stage

#: Pairs that a word's own share weighs in the shares of the words after it, and
#: the weight of the uniform share.
PRIOR, UNIFORM = 16, 0.01
BOUNDARY = 0
#: Tokens of a chunk, bytes of text for each bucket, and the number of target ids
#: up to which they are broadcast.
CHUNK, BUCKET, BROADCAST = 1_500_000, 16 << 20, 2_000_000


def _words(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def _pack(*arrays) -> bytes:
    """Arrays as bytes: the first bytes of all numbers, then the second ones."""
    import pickle

    import numpy as np
    import pyarrow as pa
    return pickle.dumps([(a.dtype.str, len(a), pa.compress(
        np.ascontiguousarray(a.view("u1").reshape(len(a), a.itemsize).T).tobytes(), codec="zstd", asbytes=True)) for a in arrays])


def _unpack(data: bytes) -> list:
    import pickle

    import numpy as np
    import pyarrow as pa
    out = []
    for kind, n, body in pickle.loads(data):
        wide = np.dtype(kind).itemsize
        planes = np.frombuffer(pa.decompress(body, n * wide, codec="zstd"), "u1").reshape(wide, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
    return out


def _item_keys(hashes, first, second):
    """Hashes of all words, then of the pairs of words ``first`` and ``second``;
    the last bit tells words from pairs."""
    import numpy as np
    alone = np.zeros(len(hashes), "u8")
    key = np.concatenate([hashes, hashes[first]]) * np.uint64(0x9E3779B97F4A7C15) + np.concatenate([alone, hashes[second]])
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        key = (key ^ (key >> np.uint64(shift))) * np.uint64(factor)
    key = (key ^ (key >> np.uint64(31))) & np.uint64(2**64 - 2)
    key[:len(hashes)] |= np.uint64(1)
    return key


def _pairs(words):
    """Word numbers of the distinct pairs of a chunk (the words of its texts, each
    text followed by a boundary), and the pair that each word ends."""
    import numpy as np
    before = np.concatenate([np.full(min(len(words), 1), BOUNDARY, "int64"), words[:-1].astype("int64")])
    pair, at = np.unique(before << 32 | words, return_inverse=True)
    return pair >> 32, pair & 0xFFFFFFFF, at


def _encoded(names, words, lengths, targets) -> bytes:
    """A chunk's texts. ``names``: its words by number; ``words``: their numbers,
    a boundary after each text; ``lengths``: tokens of each text."""
    from hashlib import blake2b

    import numpy as np
    often = np.bincount(words, minlength=len(names))
    order = np.argsort(-often[1:], kind="stable") + 1  # frequent words get small numbers
    number = np.zeros(len(names), "int32")
    number[order] = np.arange(1, len(names))
    hashes = np.frombuffer(b"".join(blake2b(names[k].encode("utf-8", "surrogatepass"), digest_size=8).digest()
                                    for k in (0, *order)), "u8")
    return _pack(np.asarray(lengths, "int64"), np.asarray(targets, "u1"), number[words], hashes)


def _items(texts: bytes, buckets: int):
    """(bucket, items) with the counts of a chunk's distinct words and pairs in the
    order of their hashes."""
    import numpy as np
    lengths, targets, words, hashes = _unpack(texts)
    first, second, at = _pairs(words)
    mine = np.repeat(targets, lengths)
    n, n_target = (np.concatenate([np.bincount(words[own], minlength=len(hashes)), np.bincount(at[own], minlength=len(first))])
                   for own in (slice(None), mine > 0))
    del at, words, mine
    key = _item_keys(hashes, first, second)
    order = np.argsort(key, kind="stable")
    key, n, n_target = key[order], n[order], n_target[order]
    edges = np.searchsorted((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32), np.arange(buckets + 1))
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        if a < b:
            yield k, _pack(np.diff(key[a:b], prepend=np.uint64(0)), n[a:b], n_target[a:b])


def encode(rows: DataFrame) -> DataFrame:
    """``chunk, doc_ids, body``: a row per chunk of ``rows`` (doc_id, text, target)."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        start = TaskContext.get().partitionId() << 32

        def out(chunk):
            body = _encoded(list(number), np.concatenate([np.zeros(0, "int32"), *held]), lengths, targets)
            return pa.RecordBatch.from_arrays(
                [pa.array([start + chunk], pa.int64()), pa.array([ids], pa.list_(id_kind)), pa.array([body], pa.binary())],
                names=["chunk", "doc_ids", "body"])

        chunk, size, ids, lengths, targets, held, number = 0, 0, [], [], [], [], {"": BOUNDARY}
        for batch in batches:
            id_kind = batch.schema.field("doc_id").type
            for doc_id, text, target in rows_of([batch], "doc_id", "text", "target"):
                words = _words(text)
                for w in words:
                    if w not in number:
                        number[w] = len(number)
                if words:
                    held.append(np.fromiter((number[w] for w in (*words, "")), "int32", len(words) + 1))
                ids.append(doc_id)
                lengths.append(len(words) + 1 if words else 0)
                targets.append(bool(target))
                size += lengths[-1] + 1
                if size > CHUNK:
                    yield out(chunk)
                    chunk, size, ids, lengths, targets, held, number = chunk + 1, 0, [], [], [], [], {"": BOUNDARY}
        if ids:
            yield out(chunk)

    return rows.select("doc_id", "text", "target").mapInArrow(run, f"chunk long, doc_ids array<{kind}>, body binary")


def chunk_items(encoded: DataFrame, buckets: int) -> DataFrame:
    """``chunk, bucket, body``: the items of each chunk by bucket of their hashes."""
    def run(batches):
        import pyarrow as pa
        for chunk, texts in ((c, x) for batch in batches for c, x in zip(batch.column("chunk").to_pylist(), batch.column("body"))):
            for bucket, body in _items(texts.as_py(), buckets):
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([bucket], pa.int32()),
                                                  pa.array([body], pa.binary())], names=["chunk", "bucket", "body"])

    return encoded.select("chunk", "body").mapInArrow(run, "chunk long, bucket int, body binary")


def sum_items(items: DataFrame) -> DataFrame:
    """``items`` (chunk, bucket, body) with the counts of each over all chunks as
    ``body``; ``types``, ``tokens`` and ``target_tokens`` add up to those of the corpus."""
    def run(table):
        import numpy as np
        import pyarrow as pa
        found = [_unpack(x) for x in table.column("body").to_pylist()]
        key, at = np.unique(np.concatenate([np.cumsum(k, dtype="u8") for k, _, _ in found]), return_inverse=True)
        n, n_target = (np.bincount(at, np.concatenate([x[k] for x in found]), len(key)).astype("int64") for k in (1, 2))
        word = (key & np.uint64(1)).astype(bool)
        edges = np.cumsum([0, *(len(k) for k, _, _ in found)])
        bodies = [_pack(n[at[a:b]], n_target[at[a:b]]) for a, b in zip(edges[:-1], edges[1:])]
        rest = [0] * (len(found) - 1)
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "body": pa.array(bodies, pa.binary()),
                         **{c: pa.array([int(v), *rest], pa.int64()) for c, v in (
                             ("types", word.sum()), ("tokens", n[word].sum()), ("target_tokens", n_target[word].sum()))}})

    return items.select("chunk", "bucket", "body").groupBy("bucket").applyInArrow(
        run, "chunk long, bucket int, body binary, types long, tokens long, target_tokens long")


def losses(n_word, n_before, n_pair, total, types: int):
    """Loss (a natural log) of each token: the pair's share of the word before it,
    shrunk by ``PRIOR`` pairs towards the word's own share, which is shrunk towards
    the uniform one. ``total``: tokens counted; without any, it is uniform."""
    import numpy as np
    share = (1 - UNIFORM) * n_word / np.maximum(total, 1) + np.where(total > 0, UNIFORM, 1.0) / types
    return -np.log((n_pair + PRIOR * share) / (n_before + PRIOR))


def _own(of_text, items):
    """How often each token's item stands in the token's own text."""
    import numpy as np
    _, at, n = np.unique(of_text * (int(items.max(initial=0)) + 1) + items, return_inverse=True, return_counts=True)
    return n[at]


def _score_chunk(texts: bytes, sums: list[tuple[int, bytes]], types: int, totals):
    """Tokens, and mean loss under the target and the background model, of each
    text of a chunk; zeros for a text without words. ``sums``: the counts of its
    items by bucket; ``totals``: target and background tokens."""
    import numpy as np
    lengths, targets, words, hashes = _unpack(texts)
    first, second, at = _pairs(words)
    order = np.argsort(_item_keys(hashes, first, second), kind="stable")
    parts = [_unpack(x) for _, x in sorted(sums, key=lambda s: s[0])]
    size, some = len(hashes), lengths > 0
    if not some.any():
        return [lengths, np.zeros(len(lengths)), np.zeros(len(lengths))]
    of_text = np.repeat(np.arange(len(lengths)), lengths)
    before = np.concatenate([np.full(1, BOUNDARY, words.dtype), words[:-1]])
    own_word, own_pair = _own(of_text, words), _own(of_text, at)
    own_before = np.concatenate([np.ones(1, own_word.dtype), own_word[:-1]])  # a boundary stands once in a text
    starts = (np.cumsum(lengths) - lengths)[some]
    out = [lengths]
    for k, total, counted in ((1, totals[0], targets.astype("int64")), (0, totals[1], np.ones(len(lengths), "int64"))):
        n = np.empty(len(order), "int64")
        n[order] = np.concatenate([p[k] for p in parts])
        mine = counted[of_text]
        loss = losses(n[words] - mine * own_word, n[before] - mine * own_before, n[size:][at] - mine * own_pair,
                      (total - counted * lengths)[of_text], types)
        mean = np.zeros(len(lengths))
        mean[some] = np.add.reduceat(loss, starts) / lengths[some]
        out.append(mean)
    return out


def cross_entropy_difference(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, target_loss, background_loss, score`` for every row of
    ``docs`` (doc_id, text; other columns are ignored). The target is the
    documents whose id is in ``targets`` (doc_id); the background is all of them.
    The row itself is left out of the models that score it, and so of the target if
    it is in there; repeated rows stay in each other's models.

    A null, empty or blank text has no token and scores zero. Repeated rows count
    and are scored as often as they stand. Null ids are in no target; without a
    target the target model is the uniform one."""
    ids = stage(targets.select("doc_id").filter(F.col("doc_id").isNotNull()).distinct()
                .select(F.col("doc_id").alias("_sw_id"), F.lit(True).alias("_sw_in")), "target")
    few = ids.count() <= BROADCAST
    rows = docs.select("doc_id", "text").join(F.broadcast(ids) if few else ids, F.col("doc_id") == F.col("_sw_id"), "left") \
        .select("doc_id", "text", F.coalesce("_sw_in", F.lit(False)).alias("target"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    encoded = stage(encode(rows), "chunks")
    sums = stage(sum_items(chunk_items(encoded, -(-size // BUCKET) or 1)), "sums")
    types, tokens, target_tokens = (x or 0 for x in sums.agg(*[F.sum(c) for c in ("types", "tokens", "target_tokens")]).first())

    def score(table):
        import pyarrow as pa
        found = list(zip(*(table.column(c).to_pylist() for c in ("bucket", "body"))))
        texts = next(x for b, x in found if b is None)
        # One more type: the unknown word.
        n, target, background = _score_chunk(texts, [x for x in found if x[0] is not None], types + 1, (target_tokens, tokens))
        return pa.table({"doc_id": table.column("doc_ids").combine_chunks().flatten(), "n_tokens": pa.array(n, pa.int64()),
                         "target_loss": pa.array(target), "background_loss": pa.array(background)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return encoded.unionByName(sums.select("chunk", "bucket", "body"), allowMissingColumns=True) \
        .groupBy("chunk").applyInArrow(score, f"doc_id {kind}, n_tokens long, target_loss double, background_loss double") \
        .withColumn("score", F.col("target_loss") - F.col("background_loss"))
