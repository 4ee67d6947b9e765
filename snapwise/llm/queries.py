"""Registered queries of this folder: ``name -> fn(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from snapwise.llm import common
from snapwise.sources.tables import read_table

QUERIES = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


@register
def op1_pack_documents(spark, sf_dir):
    from snapwise.llm.packing import pack_documents
    return pack_documents(read_table(spark, sf_dir, "documents"),
                          tokenizer_path("byte_bpe_50k.json"), "byte_level", 1024, 2)


@register
def op8_token_files(spark, sf_dir):
    from snapwise.llm.token_files import read_token_files, write_token_files
    folder = common.shared_folder(spark, "tokens")
    write_token_files(read_table(spark, sf_dir, "documents"), folder,
                      tokenizer_path("word_bpe_49k.json"), "words", 2, 2)
    return read_token_files(spark, folder)


@register
def op10_simhash(spark, sf_dir):
    from snapwise.llm.simhash import simhash_groups
    return simhash_groups(read_table(spark, sf_dir, "documents"), 4, 4)


@register
def op3_quality(spark, sf_dir):
    from snapwise.llm.quality import score_quality
    return score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@register
def op7_host_rules(spark, sf_dir):
    from snapwise.llm.host_rules import host_rules
    return host_rules(read_table(spark, sf_dir, "documents"))


@register
def op2_embedding_groups(spark, sf_dir):
    from snapwise.llm.embeddings import embedding_groups
    return embedding_groups(read_table(spark, sf_dir, "embeddings"), 0.9)


@register
def op5_warc(spark, sf_dir):
    from snapwise.llm.warc import page_records, read_warc, write_warc
    folder = common.shared_folder(spark, "warc")
    names = write_warc(read_table(spark, sf_dir, "pages"), folder, 0)
    return page_records(read_warc(spark, folder, names))


#: Shares of the tokens that the mixture is to have.
TARGETS = {"general": 0.96, "low_quality": 0.02, "toxic": 0.02}


@register
def op6_mixing(spark, sf_dir):
    from pyspark.sql import functions as F

    from snapwise.llm.mixing import label_domains, mixture
    mixed = mixture(read_table(spark, sf_dir, "documents"),
                    label_domains(read_table(spark, sf_dir, "labels")), TARGETS)
    return mixed.select("doc_id", "n_tokens",
                        *[F.col("p")[k].alias(f"p_{d}") for k, d in enumerate(sorted(TARGETS))], "rate")


@register
def op9_chat_preferences(spark, sf_dir):
    from snapwise.llm.chat import format_preferences, reply_swaps
    return format_preferences(*reply_swaps(read_table(spark, sf_dir, "conversations")))


@register
def op4_lm_scoring(spark, sf_dir):
    from snapwise.llm.lm_scoring import cross_entropy_difference
    good = read_table(spark, sf_dir, "labels").filter("quality = 1")
    return cross_entropy_difference(read_table(spark, sf_dir, "documents"), good)


@register
def op11_sharding(spark, sf_dir):
    from snapwise.llm.sharding import shard_documents
    return shard_documents(read_table(spark, sf_dir, "documents"), 24)


@register
def op12_fill_in_middle(spark, sf_dir):
    from snapwise.llm.fill_in_middle import fill_in_middle
    return fill_in_middle(read_table(spark, sf_dir, "documents")).drop("pieces")


@register
def op13_spelling(spark, sf_dir):
    from snapwise.llm.spelling import spelling_variants
    return spelling_variants(read_table(spark, sf_dir, "documents"))
