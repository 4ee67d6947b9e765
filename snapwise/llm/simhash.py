"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are cut into blocks of bits; two of them within the radius agree on
all but ``radius`` blocks, so comparing the fingerprints that share the other
blocks finds every link. What shares them is a bucket. Large buckets are dealt
into chunks, and every pair of chunks is a unit of work of bounded size, so a hot
bucket is spread over tasks. A unit sorts its fingerprints by population count,
cuts them into tiles, skips tile pairs whose counts differ by more than the
radius, and compares the rest by exclusive-or and bit count in numpy. It returns
one link per fingerprint at most, from it to the smallest it reaches inside the
unit, and never the pairs of a large group.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapwise.llm.common import rows_of, smallest_reachable, stage
from snapwise.llm.components import connected_components

#: Fingerprints of a chunk of a large bucket, and of a tile inside a unit.
CHUNK, TILE = 4096, 1024


def fingerprint(data: bytes | None, shingle: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of UTF-8 text: bit set where over half of the word
    shingles' XXH64 have it. ASCII letters are lower-cased. Fewer words than a
    shingle: their whole sequence; no word: zero."""
    import numpy as np
    from itertools import repeat
    from xxhash import xxh64_intdigest
    words = data.lower().split() if data else []
    if not words:
        return 0
    if len(words) < shingle:
        hashes = np.array([xxh64_intdigest(b" ".join(words), seed)], "<u8")
    else:
        tuples = zip(*(words[k:] for k in range(shingle)))
        hashes = np.fromiter(map(xxh64_intdigest, map(b" ".join, tuples), repeat(seed)), "<u8", len(words) - shingle + 1)
    counts = np.zeros(64, "int64")
    for at in range(0, len(hashes), 8192):
        bits = np.unpackbits(hashes[at:at + 8192].view("u1").reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype="uint32")
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``row, doc_id, fp`` (the 64 bits as a signed long) of every whole text;
    ``row`` numbers the rows as they are read."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            fps = [fingerprint(data, shingle) for (data,) in rows_of([batch], "data")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.array(fps, "u8").view("i8"))], names=["row", "doc_id", "fp"])

    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("binary").alias("data")).mapInArrow(run, "row long, doc_id long, fp long")


def block_scheme(count: int, radius: int) -> int:
    """Blocks to cut 64 bits into, so that a bucket of evenly spread
    fingerprints holds about a thousand at most (the links do not depend on
    it): the fewest blocks, hence copies, that do."""
    for blocks in range(radius + 1, 9):
        if count >> (64 * (blocks - radius) // blocks) <= 1024:
            break
    return blocks


def _compare(fps, radius: int, left=None):
    """Links inside a sorted-by-count array of fingerprints (``left`` given:
    only between the two sides), each to the smallest it reaches."""
    import numpy as np
    counts = np.bitwise_count(fps).astype("int16")
    order = np.argsort(counts, kind="stable")
    fps, counts = fps[order], counts[order]
    side = None if left is None else left[order]
    ends_a, ends_b = [np.zeros(0, "int64")], [np.zeros(0, "int64")]
    for i in range(0, len(fps), TILE):
        for j in range(i, len(fps), TILE):
            if counts[j] - counts[min(i + TILE, len(fps)) - 1] > radius:
                break  # this and all later tiles differ too much
            near = np.bitwise_count(fps[i:i + TILE, None] ^ fps[None, j:j + TILE]) <= radius
            if side is not None:
                near &= side[i:i + TILE, None] != side[None, j:j + TILE]
            a, b = np.nonzero(near)
            a, b = a + i, b + j
            a, b = a[a < b], b[a < b]
            if len(a):  # reduce at once: a tile pair may hold a million links
                low = smallest_reachable(a, b, len(fps))
                node = np.flatnonzero(low != np.arange(len(fps)))
                ends_a.append(node)
                ends_b.append(low[node])
    a, b = np.concatenate(ends_a), np.concatenate(ends_b)
    low = smallest_reachable(a, b, len(fps))
    node = np.flatnonzero(low != np.arange(len(fps)))
    return fps[node], fps[low[node]]


def fingerprint_links(distinct: DataFrame, radius: int = 4) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (``fp`` long) within
    ``radius`` differing bits, directly or through others."""
    blocks = block_scheme(distinct.count(), radius)
    edge = [64 * k // blocks for k in range(blocks + 1)]
    keys = []
    for chosen in combinations(range(blocks), blocks - radius):
        mask = sum(((1 << (edge[k + 1] - edge[k])) - 1) << edge[k] for k in chosen)
        keys.append(mask - (1 << 64) if mask >> 63 else mask)
    entries = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in keys]))
                              .alias("scheme", "block"))
    # Chunks of a bucket: as many as its size asks for. Most buckets have one.
    large = entries.groupBy("scheme", "block").count().filter(F.col("count") > CHUNK) \
        .select("scheme", "block", F.ceil(F.col("count") / CHUNK).cast("int").alias("chunks"))
    dealt = entries.join(large, ["scheme", "block"], "left") \
        .withColumn("chunks", F.coalesce("chunks", F.lit(1))) \
        .withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    units = dealt.select("scheme", "block", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                         F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1)
                         .otherwise(2).alias("side"), "fp")
    unit = ["scheme", "block", "i", "j"]

    def compare(batches):
        import numpy as np
        import pyarrow as pa

        def links(parts):
            fps = np.concatenate([p[0] for p in parts]).view("u8")
            side = np.concatenate([p[1] for p in parts])
            a, b = _compare(fps, radius, side if side.any() else None)
            return pa.RecordBatch.from_arrays([pa.array(a.view("i8")), pa.array(b.view("i8"))], names=["a", "b"])

        held, of = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = [batch.column(batch.schema.get_field_index(n)).to_numpy() for n in unit]
            fps, side = (batch.column(batch.schema.get_field_index(n)).to_numpy() for n in ("fp", "side"))
            new = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
            for lo, hi in zip([0, *new], [*new, len(fps)]):
                mine = tuple(k[lo] for k in key)
                if mine != of and held:
                    if sum(len(h[0]) for h in held) > 1:
                        yield links(held)
                    held = []
                of = mine
                held.append((fps[lo:hi], side[lo:hi]))
        if held and sum(len(h[0]) for h in held) > 1:
            yield links(held)

    return units.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(compare, "a long, b long").distinct()


def _members(rows: DataFrame, radius: int) -> DataFrame:
    """``fp, component, least`` of the distinct fingerprints of ``rows``."""
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    nodes = stage(connected_components(fingerprint_links(distinct.select("fp"), radius)), "nodes")
    return distinct.join(nodes.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("component", F.coalesce("component", "fp"))


def simhash_groups(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs`` (doc_id,
    text; other columns are ignored). Null and empty texts have fingerprint zero
    and link like any other. Rows with equal ids are each returned; component_id
    is the smallest id that is not null, null if a component has none."""
    rows = stage(fingerprints(docs, shingle), "fingerprints")
    member = _members(rows, radius)
    smallest = member.groupBy("component").agg(F.min("least").alias("component_id"))
    of_fp = member.join(smallest, "component").select("fp", "component_id")
    return rows.join(of_fp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one_of_each_group(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """The rows of ``docs``, a table that reads the same twice, without all but
    one of each component: the one with the smallest id stays (null ids last; of
    equal ids the first row), with all its columns."""
    rows = stage(fingerprints(docs, shingle), "fingerprints")
    placed = stage(rows.join(_members(rows, radius).select("fp", "component"), "fp")
                   .select("row", "doc_id", "component"), "placed")
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    kept = placed.groupBy("component").agg(F.min(key).alias("k"), F.count("*").alias("n")) \
        .filter("n > 1").select("component", F.col("k.row").alias("stays"))
    # Only the rows that go are joined with the texts.
    gone = placed.join(kept, "component").filter(F.col("row") != F.col("stays")).select(F.col("row").alias("_sw_row"))
    return docs.withColumn("_sw_row", F.monotonically_increasing_id()).join(gone, "_sw_row", "left_anti") \
        .select(*[F.col(f"`{c}`") for c in docs.columns])
