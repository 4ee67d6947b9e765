"""Item catalogue and market-history document loads.

Both read JSON with an explicit schema; nested arrays are exploded in Spark
and every scalar rule (validity, unix time) is a built-in expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NPC_OFFER = T.ArrayType(T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("price", T.LongType()),
]))
ITEM_DOC = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("tier", T.IntegerType()),
    T.StructField("npc_sell", NPC_OFFER),
    T.StructField("npc_buy", NPC_OFFER),
    T.StructField("wiki_name", T.StringType()),
])
HISTORY_DOC = T.StructType([
    T.StructField("world", T.StringType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("history", T.ArrayType(T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("time", T.DoubleType()),
        T.StructField("is_full_data", T.BooleanType()),
        T.StructField("buy_offer", T.LongType()),
        T.StructField("sell_offer", T.LongType()),
    ]))),
])


def item_documents(items: DataFrame) -> DataFrame:
    """Catalogue rows as item documents (the shape of the item API)."""
    return items.select(F.col("item_id").alias("id"), "name", "category", "tier",
                        F.from_json(F.col("npc_sell"), NPC_OFFER).alias("npc_sell"),
                        F.from_json(F.col("npc_buy"), NPC_OFFER).alias("npc_buy"), "wiki_name")


def load_market_items(spark: SparkSession, path: str) -> DataFrame:
    """Project item documents; NPC offer arrays kept as JSON text, '[]'
    when missing."""
    docs = spark.read.schema(ITEM_DOC).json(path)
    return docs.select(
        F.col("id").alias("item_id"), "name", "category", "tier",
        F.coalesce(F.to_json("npc_sell"), F.lit("[]")).alias("npc_sell"),
        F.coalesce(F.to_json("npc_buy"), F.lit("[]")).alias("npc_buy"),
        "wiki_name")


def history_documents(observations: DataFrame) -> DataFrame:
    """Observations as history documents, one observation per document (so
    no document grows with an item's activity)."""
    entry = F.struct(F.col("id"), F.col("time"), F.lit(True).alias("is_full_data"),
                     F.col("buy_offer"), F.col("sell_offer"))
    return observations.select("world", "item_id", F.array(entry).alias("history"))


def load_market_history(spark: SparkSession, path: str) -> DataFrame:
    """Typed observation rows from history documents."""
    docs = spark.read.schema(HISTORY_DOC).json(path)
    h = docs.select("world", "item_id", F.explode("history").alias("h"))
    return h.select("world", "item_id", F.col("h.id").alias("id"), F.col("h.time").alias("time"),
                    F.col("h.buy_offer").alias("buy_offer"), F.col("h.sell_offer").alias("sell_offer"))
