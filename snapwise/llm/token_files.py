"""Token-id files: flat unsigned integers plus 64-bit document offsets.

A folder holds, per shard, ``part-N.bin`` (ids, little-endian unsigned 16 or 32
bits), ``part-N.idx`` (unsigned 64-bit offsets into it, one more than there are
documents) and ``part-N.docs`` (signed 64-bit document ids; a null id is stored
as the smallest 64-bit integer). Shards hold ascending document ids, so their
order is that of a range partitioning. ``manifest.json`` is written last: it
lists the shards with the documents and ids before each, which are prefix sums
over one row per shard. A document's place in the whole is its shard's base plus
its offset there.

A task writes under a name of its own and renames at the end, so a task that
runs again after an executor was lost replaces its file with the same content.
"""

from __future__ import annotations

import json
import zlib
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapwise.llm.common import filesystem, qualified, rows_of
from snapwise.llm.tokens import Encoder

NULL_ID = -(2 ** 63)
DTYPES = {2: "<u2", 4: "<u4"}


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, cut: str,
                      end_id: int = 2, width: int = 4) -> list[dict]:
    """Encode every whole text of ``docs`` (doc_id, text; other columns are
    ignored) and write the folder; returns the manifest's shards.

    Null text is an empty one: only the end id. Documents with equal ids are
    ordered by text; repeated rows are written as often as they stand. An empty
    table gives a manifest without shards. ``width`` is 2 or 4 bytes an id; a
    vocabulary or end id that it cannot hold is refused."""
    spark = docs.sparkSession
    folder, dtype = qualified(spark, folder), DTYPES[width]
    most = max(end_id, *Encoder.load(tokenizer, cut).tokenizer.get_vocab(with_added_tokens=True).values())
    if most >= 1 << 8 * width:
        raise ValueError(f"id {most} does not fit into {width} bytes")

    def write(batches):
        import uuid

        import numpy as np
        from pyspark import TaskContext
        shard = TaskContext.get().partitionId()
        encoder = Encoder.load(tokenizer, cut)
        end = end_id.to_bytes(4, "little")
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        mine = f"{root}/.{shard}-{uuid.uuid4().hex}"
        count = tokens = 0
        streams = {}
        for rows in batches:
            ids, starts = [], []
            if rows.num_rows and not streams:
                streams = {k: fs.open_output_stream(f"{mine}.{k}") for k in ("bin", "idx", "docs")}
            for doc_id, text in rows_of([rows], "doc_id", "text"):
                data = np.frombuffer(encoder.encode(text) + end, "<u4")
                streams["bin"].write(data.astype(dtype).tobytes())
                ids.append(NULL_ID if doc_id is None else doc_id)
                starts.append(tokens)
                tokens += len(data)
            if ids:
                streams["idx"].write(np.array(starts, "<u8").tobytes())
                streams["docs"].write(np.array(ids, "<i8").tobytes())
                count += len(ids)
        if not streams:
            return
        streams["idx"].write(np.array([tokens], "<u8").tobytes())
        for kind, stream in streams.items():
            stream.close()
            fs.move(f"{mine}.{kind}", f"{root}/part-{shard:06d}.{kind}")
        import pyarrow as pa
        yield pa.RecordBatch.from_pydict({"shard": [shard], "docs": [count], "ids": [tokens]},
                                         schema=pa.schema([("shard", pa.int64()), ("docs", pa.int64()), ("ids", pa.int64())]))

    order = ["doc_id", F.xxhash64("text"), "text"]
    ranged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions(*order)
    # One row per shard comes to the driver.
    found = sorted(tuple(r) for r in ranged.mapInArrow(write, "shard long, docs long, ids long").collect())
    before_docs = list(accumulate((f[1] for f in found), initial=0))
    before_ids = list(accumulate((f[2] for f in found), initial=0))
    shards = [{"shard": s, "docs": d, "ids": n, "docs_before": a, "ids_before": b, "width": width}
              for (s, d, n), a, b in zip(found, before_docs, before_ids)]
    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/manifest.json") as out:
        out.write(json.dumps({"width": width, "end_id": end_id, "shards": shards}).encode())
    return shards


def read_manifest(folder: str) -> list[dict]:
    fs, root = filesystem(folder)
    with fs.open_input_stream(f"{root}/manifest.json") as f:
        return json.loads(f.read())["shards"]


def _mapped(fs, path: str, dtype: str):
    """An array over a file: memory-mapped on a local or mounted file system,
    else read."""
    import numpy as np
    from pyarrow.fs import LocalFileSystem
    if isinstance(fs, LocalFileSystem):
        return np.memmap(path, dtype, "r")
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """One row per document of a folder: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32 (over the ids as little-endian unsigned 32
    bits) and, if asked for, the ids themselves in that form."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    folder = qualified(spark, folder)
    shards = [(s["shard"], s["ids_before"], s["width"]) for s in read_manifest(folder)]
    if not shards:
        return spark.createDataFrame([], schema)

    def read(batches):
        import pandas as pd
        fs, root = filesystem(folder)
        for shard, base, width in rows_of(batches, "shard", "base", "width"):
            name = f"{root}/part-{shard:06d}"
            ids, at, docs = (_mapped(fs, f"{name}.{k}", t) for k, t in
                             (("bin", DTYPES[width]), ("idx", "<u8"), ("docs", "<i8")))
            step = 1024
            for lo in range(0, len(docs), step):
                part = [ids[a:b].astype("<u4").tobytes() for a, b in
                        zip(at[lo:lo + step].tolist(), at[lo + 1:lo + step + 1].tolist())]
                out = pd.DataFrame({"doc_id": pd.array(docs[lo:lo + len(part)], "Int64"),
                                    "start": at[lo:lo + len(part)].astype("int64") + base,
                                    "n_tokens": [len(p) // 4 for p in part],
                                    "ids_crc32": [zlib.crc32(p) for p in part]})
                out.loc[out["doc_id"] == NULL_ID, "doc_id"] = pd.NA
                if with_ids:
                    out["ids"] = part
                import pyarrow as pa
                yield from pa.Table.from_pandas(out, preserve_index=False).to_batches()

    files = spark.createDataFrame(shards, "shard long, base long, width int").repartition(len(shards), "shard")
    return files.mapInArrow(read, schema)
