"""WARC archives as a chunked record table.

Payloads are cut into (record, chunk number) rows in Spark and streamed chunk by
chunk into gzip members, one per record. The reader streams an archive the same
way: a row per chunk, each with the digest of the payload so far, so neither side
allocates a whole record. Of records with equal payloads one is written as
``response``, the others as ``revisit`` records that hold the HTTP header only
(whose Content-Length and the record's payload digest describe the payload).

A task writes under a name of its own and renames its files at the end; only
the names of the files come to the driver.
"""

from __future__ import annotations

import base64
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapwise.llm.common import Staged, filesystem, qualified, rows_of

#: Bytes of a chunk, the size at which a task begins a further archive, and the
#: number of repeated payloads up to which their list is broadcast.
CHUNK, ARCHIVE, BROADCAST = 1 << 18, 1 << 29, 50_000
DATE = "2024-01-01T00:00:00Z"

CHUNKS = ("record_id string, page_id long, record_type string, refers_to long, chunk_no long, chunk binary, "
          "digest_so_far string, payload_bytes long, payload_digest string, is_last boolean")


def chunk_rows(pages: DataFrame, min_bytes: int = 0, chunk: int = CHUNK) -> DataFrame:
    """The chunks to write of ``pages`` (page_id, url, html): every page has a
    chunk 0; revisits have nothing else."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce("html", F.lit("")).cast("binary").alias("payload"),
                        F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumn("sha1", F.sha1("payload")).withColumn("bytes", F.length("payload").cast("long"))
    # (page_id, row) of the response of each payload that stands twice or more.
    repeated = Staged(rows.filter(F.col("bytes") >= min_bytes).groupBy("sha1", "bytes").agg(
        F.max(F.struct("page_id", "row")).alias("first"), F.count("*").alias("n")).filter("n > 1")
        .select("sha1", "bytes", F.col("first.page_id").alias("first_page"), F.col("first.row").alias("first_row")),
        "payloads").df
    if repeated.count() <= BROADCAST:
        repeated = F.broadcast(repeated)
    revisit = F.coalesce(F.col("first_row") != F.col("row"), F.lit(False))
    rows = rows.join(repeated, ["sha1", "bytes"], "left").withColumn("revisit", revisit)
    last = F.when(F.col("revisit"), 0).otherwise(F.greatest(F.lit(0), F.ceil(F.col("bytes") / chunk) - 1)).cast("long")
    # The payload is cut before its row is multiplied, so no chunk's row holds it all.
    chunks = F.transform(F.sequence(F.lit(0).cast("long"), last), lambda k: F.struct(k.alias("chunk_no"), F.when(
        ~F.col("revisit"), F.substring("payload", (k * chunk + 1).cast("int"), F.lit(chunk))).alias("chunk")))
    return rows.select("row", "page_id", "url", "sha1", "bytes", "revisit", "first_page", "first_row",
                       last.alias("last"), F.explode(chunks).alias("at")) \
        .select("row", "page_id", "url", "sha1", "bytes", "revisit", "first_page", "first_row", "at.chunk_no", "last", "at.chunk")


def _record_id(folder: str, row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{folder}/{row}')}>"


def _headers(folder, row, page_id, url, sha1, size, revisit, first_page, first_row) -> bytes:
    """The WARC and HTTP headers of a record, up to its payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n").encode()
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: {_record_id(folder, row)}", f"WARC-Date: {DATE}",
             f"Content-Length: {len(http) + (0 if revisit else size)}",
             "Content-Type: application/http; msgtype=response",
             f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}"]
    if url:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {_record_id(folder, first_row)}"]
        if first_page is not None:
            lines.append(f"X-Refers-To-Page-Id: {first_page}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + http


def write_warc(pages: DataFrame, folder: str, min_bytes: int = 0, chunk: int = CHUNK) -> list[str]:
    """Write ``pages`` (page_id, url, html; other columns are ignored) as
    ``*.warc.gz`` files below ``folder``; returns their names.

    Payloads are the html in UTF-8 (null: empty). Of records with equal payloads
    of at least ``min_bytes`` that with the largest page_id (of equal ids, the
    later row) is the response and the others revisit it. Null ids count as
    smallest and their header is left out. An empty table writes no file."""
    folder = qualified(pages.sparkSession, folder)
    columns = ["row", "page_id", "url", "sha1", "bytes", "revisit", "first_page", "first_row", "chunk_no", "last", "chunk"]

    def write(batches):
        import zlib

        import pyarrow as pa
        from pyspark import TaskContext
        part, mine = TaskContext.get().partitionId(), uuid.uuid4().hex
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        names, out, packer, size = [], None, None, 0
        for row, page, url, sha1, length, revisit, first_page, first_row, no, last, data in rows_of(batches, *columns):
            if no == 0:
                if out is not None and size > ARCHIVE:
                    out.close()
                    out = None
                if out is None:
                    names.append(f"part-{part:06d}-{len(names):04d}.warc.gz")
                    out, size = fs.open_output_stream(f"{root}/.{mine}-{names[-1]}", compression=None), 0
                packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                out.write(packer.compress(_headers(folder, row, page, url, sha1, length, revisit, first_page, first_row)))
            written = packer.compress(data or b"")
            if no == last:
                written += packer.compress(b"\r\n\r\n") + packer.flush()
            out.write(written)
            size += len(written)
        if out is not None:
            out.close()
        for name in names:
            fs.move(f"{root}/.{mine}-{name}", f"{root}/{name}")
        yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string())})

    return sorted(r["name"] for r in chunk_rows(pages, min_bytes, chunk).select(*columns)
                  .mapInArrow(write, "name string").collect())


def read_records(stream, chunk: int):
    """Rows of CHUNKS of one archive: the payload chunk by chunk."""
    import hashlib

    def header_lines():
        lines = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            lines[name.strip().lower()] = value.strip()
        return lines

    def number(text):
        return None if text is None else int(text)

    while start := stream.readline():
        if not start.strip():
            continue
        if not start.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {start[:40]!r}")
        warc = header_lines()
        block = int(warc["content-length"])
        status = stream.readline()
        before = len(status)
        http = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            before += len(line)
            name, _, value = line.decode().partition(":")
            http[name.strip().lower()] = value.strip()
        left = block - before - 2
        kind, digest = warc["warc-type"], hashlib.sha1()
        known = (warc["warc-record-id"], number(warc.get("x-page-id")), kind, number(warc.get("x-refers-to-page-id")))
        no = done = 0
        while True:
            data = stream.read(min(chunk, left))
            if len(data) < min(chunk, left):
                raise ValueError(f"truncated record {known[0]}")
            left -= len(data)
            done += len(data)
            digest.update(data)
            so_far = base64.b32encode(digest.digest()).decode()
            if kind == "revisit":
                yield *known, no, data, so_far, int(http["content-length"]), warc["warc-payload-digest"][5:], True
            else:
                yield *known, no, data, so_far, done, so_far, left == 0
            no += 1
            if not left:
                break


def read_warc(spark: SparkSession, folder: str, names: list[str], chunk: int = CHUNK) -> DataFrame:
    """The chunk table of archives: a row per chunk of every record's payload,
    in CHUNKS' columns. payload_bytes and payload_digest are those of the payload
    up to the chunk (of revisits, those that the record states), so the row with
    ``is_last`` has those of the full payload."""
    if not names:
        return spark.createDataFrame([], CHUNKS)
    folder = qualified(spark, folder)

    def read(batches):
        import gzip

        import pyarrow as pa
        fields = [f.split() for f in CHUNKS.split(", ")]
        kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
        schema = pa.schema([(n, kinds[k]) for n, k in fields])

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        fs, root = filesystem(folder)
        for (name,) in rows_of(batches, "name"):
            with fs.open_input_stream(f"{root}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                rows, held = [], 0
                for row in read_records(stream, chunk):
                    rows.append(row)
                    held += len(row[5])
                    if held > 8 * CHUNK or len(rows) > 2048:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    files = spark.createDataFrame([(n,) for n in names], "name string").repartition(len(names), "name")
    return files.mapInArrow(read, CHUNKS)


def page_records(chunks: DataFrame) -> DataFrame:
    """One row per record of a chunk table."""
    return chunks.filter("is_last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
