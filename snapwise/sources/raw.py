"""Raw roster documents: envelope schema, sink, scan, flatten.

A document is one envelope ``{metadata, data}`` holding a guild payload with
its member list. The scan reads a folder tree of documents with an explicit
schema (no inference); the flatten turns each document into one row per
member. The sink writes envelopes from member rows; members of one snapshot
are split into envelopes of about ``MEMBERS_PER_DOCUMENT`` members (hash
chunks), so no single task ever builds one unbounded document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapwise.functions.exprs import nonempty, parse_joined_date, slug
from snapwise.session import fresh_dir  # noqa: F401  (landing folders)

SOURCE_NAME = "roster_api"
ENTITY_TYPE = "guild"
MEMBERS_PER_DOCUMENT = 500

MEMBER = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("rank", T.StringType()),
    T.StructField("vocation", T.StringType()),
    T.StructField("level", T.LongType()),
    T.StructField("joined", T.StringType()),
    T.StructField("status", T.StringType()),
])
ENVELOPE = T.StructType([
    T.StructField("metadata", T.StructType([
        T.StructField("source", T.StringType()),
        T.StructField("entity_type", T.StringType()),
        T.StructField("entity_name", T.StringType()),
        T.StructField("extracted_at_utc", T.StringType()),
    ])),
    T.StructField("data", T.StructType([
        T.StructField("guild", T.StructType([
            T.StructField("name", T.StringType()),
            T.StructField("world", T.StringType()),
            T.StructField("members", T.ArrayType(MEMBER)),
        ])),
    ])),
])


def iso_utc(t) -> F.Column:
    """Timestamp -> ISO-8601 text with microseconds and +00:00."""
    return F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def parse_iso_utc(s) -> F.Column:
    """ISO-8601 text (any offset) -> UTC wall-clock timestamp (session zone UTC)."""
    return F.to_timestamp(s).cast("timestamp_ntz")


def snapshot_key(world, entity, t) -> F.Column:
    """Deterministic snapshot id from world (null: empty), entity and time
    (replays give the same id)."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), t)
    return F.sha2(F.concat_ws("|", F.coalesce(world, F.lit("")), entity, micros.cast("string")), 256)


def envelopes_from_roster(roster: DataFrame, source: str = SOURCE_NAME) -> DataFrame:
    """A02 (document side): member rows -> envelopes, chunked per snapshot.

    Columns: the envelope struct fields plus ``snapshot_date`` (partition).
    """
    snap = ["world", "guild_name", "extracted_at_utc"]
    sizes = roster.groupBy(*snap).agg(F.count(F.lit(1)).alias("_n")).select(
        *[F.col(c).alias(f"_{c}") for c in snap], "_n")
    chunks = F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(MEMBERS_PER_DOCUMENT)))
    # Documents without a world are landed too.
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in snap]
    r = roster.join(sizes, same[0] & same[1] & same[2]).withColumn(
        "_chunk", F.pmod(F.xxhash64("character_name"), chunks.cast("bigint")))
    member = F.struct(
        F.col("character_name").alias("name"), F.lit(None).cast("string").alias("title"),
        F.col("guild_rank").alias("rank"), F.col("vocation").alias("vocation"),
        F.col("level").cast("bigint").alias("level"),
        F.date_format("joined", "yyyy-MM-dd").alias("joined"), F.col("status").alias("status"))
    docs = r.groupBy(*snap, "_chunk").agg(F.collect_list(member).alias("members"))
    return docs.select(
        F.struct(F.lit(source).alias("source"), F.lit(ENTITY_TYPE).alias("entity_type"),
                 F.col("guild_name").alias("entity_name"),
                 iso_utc(F.col("extracted_at_utc")).alias("extracted_at_utc")).alias("metadata"),
        F.struct(F.struct(F.col("guild_name").alias("name"), F.col("world").alias("world"),
                          F.col("members").alias("members")).alias("guild")).alias("data"),
        F.to_date("extracted_at_utc").alias("snapshot_date"),
    )


def write_envelopes(envelopes: DataFrame, path: str) -> str:
    """A02 sink: one JSON envelope per line, partitioned by snapshot date."""
    envelopes.write.mode("errorifexists").partitionBy("snapshot_date").json(path)
    return path


def scan_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Read a folder tree of envelopes, one JSON document per line, with the
    explicit schema (``sources.landing`` has the tree of one document per file).
    ``raw_path`` carries the file path.
    """
    df = spark.read.schema(ENVELOPE).option("recursiveFileLookup", "true").json(path)
    return df.withColumn("raw_path", F.col("_metadata.file_path"))


def logical_path(source, entity, t) -> F.Column:
    """The landed file path of a document: date folders, slug, compact UTC time."""
    return F.concat(source, F.lit("/guild/"), F.date_format(t, "yyyy/MM/dd"), F.lit("/"),
                    slug(entity), F.lit("_"), F.date_format(t, "yyyyMMdd'T'HHmmss'Z'"), F.lit(".json"))


def raw_table(envelopes: DataFrame) -> DataFrame:
    """Raw document rows with id, entity, source, time and full JSON."""
    t = parse_iso_utc(F.col("metadata.extracted_at_utc"))
    return envelopes.select(
        snapshot_key(F.col("data.guild.world"), F.col("metadata.entity_name"), t).alias("snapshot_id"),
        F.col("metadata.entity_name").alias("guild_name"),
        F.col("metadata.source").alias("source"),
        t.alias("extracted_at_utc"),
        F.to_json(F.struct("metadata", "data")).alias("raw_json"))


def flatten(envelopes: DataFrame, clean: bool = True) -> DataFrame:
    """A05 (+ B16 when ``clean``): one row per member of every document.

    Cleaning follows the ingest function's truthiness: members without a
    name are dropped, empty strings and level 0 become null.
    """
    t = parse_iso_utc(F.col("metadata.extracted_at_utc"))
    base = envelopes.select(
        snapshot_key(F.col("data.guild.world"), F.col("metadata.entity_name"), t).alias("snapshot_id"),
        t.alias("extracted_at_utc"),
        F.col("metadata.entity_name").alias("guild_name"),
        F.col("data.guild.world").alias("world"),
        F.explode("data.guild.members").alias("m"))
    rank, voc, status = F.col("m.rank"), F.col("m.vocation"), F.col("m.status")
    level = F.col("m.level").cast("int")
    if clean:
        base = base.filter(F.col("m.name").isNotNull() & (F.col("m.name") != ""))
        rank, voc, status = nonempty(rank), nonempty(voc), nonempty(status)
        level = F.nullif(level, F.lit(0))
    return base.select(
        "snapshot_id", "extracted_at_utc", "guild_name", "world",
        F.col("m.name").alias("character_name"), rank.alias("guild_rank"), voc.alias("vocation"),
        level.alias("level"), status.alias("status"), parse_joined_date(F.col("m.joined")).alias("joined"))


#: Members as a variant holds them; fields that a document does not have are null.
MEMBERS_OF = "array<struct<name:string,rank:string,vocation:string,level:bigint,joined:string,status:string>>"


def variant_table(raw: DataFrame) -> DataFrame:
    """A04 with a semi-structured column: ``raw_table`` rows with the document
    parsed once into a VARIANT instead of text (null where it is no JSON)."""
    return raw.withColumn("document", F.try_parse_json("raw_json")).drop("raw_json")


def flatten_variant(documents: DataFrame) -> DataFrame:
    """A05 from the semi-structured column: only the paths that the roster needs
    are decoded. Rows equal those of ``flatten(clean=False)``."""
    doc = F.col("document")
    base = documents.select(
        F.try_variant_get(doc, "$.metadata.entity_name", "string").alias("guild_name"),
        F.try_variant_get(doc, "$.data.guild.world", "string").alias("world"),
        parse_iso_utc(F.try_variant_get(doc, "$.metadata.extracted_at_utc", "string")).alias("extracted_at_utc"),
        F.explode(F.try_variant_get(doc, "$.data.guild.members", MEMBERS_OF)).alias("m"))
    return base.select(
        snapshot_key(F.col("world"), F.col("guild_name"), F.col("extracted_at_utc")).alias("snapshot_id"),
        "extracted_at_utc", "guild_name", "world", F.col("m.name").alias("character_name"),
        F.col("m.rank").alias("guild_rank"), F.col("m.vocation").alias("vocation"),
        F.col("m.level").cast("int").alias("level"), F.col("m.status").alias("status"),
        parse_joined_date(F.col("m.joined")).alias("joined"))


def staging(roster: DataFrame) -> DataFrame:
    """Staging projection: integer level, ``joined_date``, named rows only."""
    return roster.filter(F.col("character_name").isNotNull()).select(
        "snapshot_id", "extracted_at_utc", "guild_name", "world", "character_name", "guild_rank",
        "vocation", F.col("level").cast("int").alias("level"), "status",
        F.col("joined").alias("joined_date"))


def insert_ignore(stored: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """A10: rows of ``incoming`` whose key is not stored yet (deduplicated)."""
    fresh = incoming.dropDuplicates(key)
    return fresh.join(stored.select(*key), key, "left_anti")
