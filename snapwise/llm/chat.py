"""Preference formatting of chosen and rejected conversations.

The turns of both sides are grouped by their full content, so a turn that stands
on both sides is one row. The first turn number at which the sides differ ends
the common prefix: what is before it is rendered once as the prompt, what follows
is rendered for each side, and only assistant turns there carry a loss mask. All
of it is keyed aggregates and a join on the pair, with one output row per
rendered turn, so that neither a long conversation nor a pair with a third of
all rows has to fit into one row or task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapwise.llm.common import stage
from snapwise.operators.ordering import neighbours

#: Template of a turn.
OPEN, AFTER_ROLE, CLOSE = "<|", "|>\n", "\n<|end|>\n"


def format_preferences(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """``pair_id, part, turn, role, rendered, mask_start, mask_end`` of two
    tables of turns (pair_id, turn, role, text; other columns are ignored).

    part is prompt, chosen or rejected; the turns of a part, ordered by turn,
    role and text, are its text. The mask holds the characters of ``rendered``
    that are trained on (the text and its closing mark of assistant turns in
    completions), null elsewhere. Rows with a null pair or turn are no turns;
    null roles and texts are empty ones; repeated rows are one turn; several
    texts under one number are one position, equal only if all are. Sides that
    are equal throughout give only a prompt. Marks inside a text are escaped."""
    def side(df, name):
        return df.select("pair_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                         F.coalesce("text", F.lit("")).alias("text"),
                         F.lit(name == "chosen").alias("_c"), F.lit(name == "rejected").alias("_r")) \
            .filter(F.col("pair_id").isNotNull() & F.col("turn").isNotNull())

    turns = side(chosen, "chosen").unionByName(side(rejected, "rejected")) \
        .groupBy("pair_id", "turn", "role", "text").agg(F.max("_c").alias("_c"), F.max("_r").alias("_r"))
    parts = turns.groupBy("pair_id").agg(
        F.min(F.when(~(F.col("_c") & F.col("_r")), F.col("turn"))).alias("_first"))
    after = F.array_compact(F.array(F.when(F.col("_c"), "chosen"), F.when(F.col("_r"), "rejected")))
    common = F.col("_first").isNull() | (F.col("turn") < F.col("_first"))
    placed = turns.join(parts, "pair_id") \
        .withColumn("part", F.explode(F.when(common, F.array(F.lit("prompt"))).otherwise(after)))
    head = F.concat(F.lit(OPEN), F.col("role"), F.lit(AFTER_ROLE))
    body = F.concat(F.replace("text", F.lit(OPEN), F.lit("<\\|")), F.lit(CLOSE))
    trained = (F.col("role") == "assistant") & (F.col("part") != "prompt")
    return placed.select(
        "pair_id", "part", "turn", "role", F.concat(head, body).alias("rendered"),
        F.when(trained, F.length(head)).alias("mask_start"),
        F.when(trained, F.length(head) + F.length(body)).alias("mask_end"))


def reply_swaps(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Preference pairs from plain conversations (conv_id, turn, role, text):
    chosen is a whole conversation, rejected the same with its last assistant
    turn exchanged for that of the conversation with the next id that has one
    (an empty reply where there is none). What follows that turn stands on both
    sides; a conversation without an assistant turn is the same on both and so
    only a prompt. Of several assistant texts under the last number the greatest
    is the reply."""
    turns = conversations.select("conv_id", "turn", "role", "text") \
        .filter(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    said = turns.filter(F.col("role") == "assistant").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"))
    last = said.groupBy("conv_id").agg(F.max("turn").alias("last"))
    reply = stage(said.join(last, "conv_id").filter(F.col("turn") == F.col("last"))
                  .groupBy("conv_id", "last").agg(F.max("text").alias("reply")), "replies")
    following = neighbours(reply.select("conv_id"), [], "conv_id", next_name="next").select("conv_id", "next")
    other = reply.select(F.col("conv_id").alias("next"), F.col("reply").alias("other"))
    swapped = reply.join(following, "conv_id").join(other, "next", "left").select(
        "conv_id", F.col("last").alias("turn"), F.lit("assistant").alias("role"),
        F.coalesce("other", F.lit("")).alias("text"))
    is_reply = (F.col("turn") == F.col("last")) & F.col("role").eqNullSafe("assistant") \
        & (F.coalesce("text", F.lit("")) == F.col("reply"))
    kept = turns.join(reply, "conv_id", "left").filter(~F.coalesce(is_reply, F.lit(False))).select("conv_id", "turn", "role", "text")
    columns = [F.col("conv_id").alias("pair_id"), "turn", "role", "text"]
    return turns.select(*columns), kept.unionByName(swapped).select(*columns)
