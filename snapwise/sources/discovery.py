"""World / guild discovery payloads.

The reference fetches one JSON document per API call and flattens it in
Python. Here payloads are a column of JSON strings, parsed with an explicit
schema (``from_json``), exploded and cleaned in Spark. The adapters build the
payloads from the driver tables: one world document per nation row and guild
documents in pages of at most ``GUILD_PAGE_SIZE`` names, so no document (and
no task) ever holds an unbounded list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapwise.functions.exprs import idiv
from snapwise.sources.tables import read_table

GUILD_PAGE_SIZE = 100

_NAME_LIST = T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))
WORLDS_PAYLOAD = T.StructType([T.StructField("worlds", T.StructType([
    T.StructField("regular_worlds", _NAME_LIST)]))])
GUILDS_PAYLOAD = T.StructType([T.StructField("guilds", T.StructType([
    T.StructField("world", T.StringType()),
    T.StructField("active", _NAME_LIST)]))])


def _name(c):
    return F.struct(c.alias("name"))


def world_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One worlds document per nation; each lists the nation, an empty name
    and the nation again (the parser must drop blanks and duplicates)."""
    nation = read_table(spark, sf_dir, "nation")
    doc = F.struct(F.struct(F.array(_name(F.col("n_name")), _name(F.lit("")),
                                    _name(F.col("n_name"))).alias("regular_worlds")).alias("worlds"))
    return nation.select(F.to_json(doc).alias("payload"))


def guild_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guild documents per world in pages of at most GUILD_PAGE_SIZE names
    (customers by nation); every page also carries an empty name."""
    cust = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    c = cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey)
    pages = c.groupBy(F.col("n_name").alias("world"),
                      idiv(F.col("c_custkey"), GUILD_PAGE_SIZE).alias("page")).agg(
        F.collect_list(_name(F.col("c_name"))).alias("names"))
    doc = F.struct(F.struct(F.col("world").alias("world"),
                            F.concat(F.col("names"), F.array(_name(F.lit("")))).alias("active"))
                   .alias("guilds"))
    return pages.select(F.to_json(doc).alias("payload"))


def discover_worlds(payloads: DataFrame) -> DataFrame:
    """Regular world names, blanks dropped, distinct."""
    p = payloads.select(F.from_json("payload", WORLDS_PAYLOAD).alias("p"))
    names = p.select(F.explode_outer("p.worlds.regular_worlds").alias("w")).select(
        F.col("w.name").alias("world_name"))
    return names.filter(F.col("world_name").isNotNull() & (F.col("world_name") != "")).distinct()


def discover_guilds(payloads: DataFrame) -> DataFrame:
    """Active guild names per world, blanks dropped, distinct."""
    p = payloads.select(F.from_json("payload", GUILDS_PAYLOAD).alias("p"))
    rows = p.select(F.col("p.guilds.world").alias("world"),
                    F.explode_outer("p.guilds.active").alias("g"))
    rows = rows.select("world", F.col("g.name").alias("guild_name"))
    return rows.filter(F.col("guild_name").isNotNull() & (F.col("guild_name") != "")).distinct()


def first_names(names: DataFrame, column: str, n: int) -> DataFrame:
    """The first ``n`` names in order (the discovery cap)."""
    order = [F.col(column).asc()]
    top = names.orderBy(*order).limit(n)
    return top.withColumn("name_rank", F.row_number().over(Window.orderBy(*order)))
