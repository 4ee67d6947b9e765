"""Quality rules judged per document and per host.

Every document gets its base counts and a base verdict in built-in functions.
Failures are then counted by host (a combined aggregate, so a host with a third
of all rows is one partial row per task), host failure rates are shrunk towards
an empirical beta prior, and the host verdicts are joined back: a document stays
if it passed itself and its host's shrunk rate is not above ``MAX_HOST_RATE``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapwise.llm.common import SEPARATORS, let, stage, words

#: Base rules and the host rule.
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW, SYMBOLS, MAX_HOST_RATE = 20, 30, 8, "[#*$%&|<>]+", 0.5


def _window_hashes(w: Column) -> Column:
    """Hash of every window of WINDOW words, in order."""
    return F.when(F.size(w) >= WINDOW,
                  F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)),
                              lambda i: F.xxhash64(F.slice(w, i, WINDOW)))) \
        .otherwise(F.array().cast("array<bigint>"))


def _covered(h: Column) -> Column:
    """Words inside windows whose hash stands twice or more in ``h``: sort
    (hash, place), keep the places of equal neighbours, and add up how far each
    of them reaches before the next begins."""
    def places(s):
        equal = F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1),
                           lambda a, b: F.when(a["h"] == b["h"], F.array(a["p"], b["p"])))
        return F.sort_array(F.array_distinct(F.flatten(F.filter(equal, lambda e: e.isNotNull()))))

    def reach(p):
        steps = F.zip_with(p, F.slice(p, 2, F.size(p)),
                           lambda a, b: F.when(b.isNull(), WINDOW).otherwise(F.least(F.lit(WINDOW), b - a)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))
    return let(F.sort_array(pairs), lambda s: let(places(s), reach))


def base_counts(text: Column) -> Column:
    """A struct of the base counts of a whole text (null: no words)."""
    text = F.coalesce(text, F.lit(""))

    def of_words(w):
        repeated = let(_window_hashes(w), lambda h: F.when(
            F.size(F.array_distinct(h)) < F.size(h), _covered(h)).otherwise(F.lit(0).cast("long")))
        return F.struct(F.size(w).cast("long").alias("n_words"), repeated.alias("n_repeat_words"))

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    dup = let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    return F.struct(
        let(words(text), of_words).alias("words"),
        F.length(F.regexp_replace(text, SEPARATORS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        dup.alias("n_dup_lines"))


def host_verdicts(failures: DataFrame) -> DataFrame:
    """``host, host_rate, host_kept`` of (host, failed boolean) rows.

    The prior is the beta distribution with the mean of the hosts' failure rates and
    their variance beyond chance: what hosts of these sizes would vary by at one
    common rate is taken off. Where nothing is left, hosts do not differ and the
    prior weighs as much as all documents; where there are fewer than two hosts, or
    more variance than a beta can have, it weighs one document at the mean. A null
    host is a host of its own."""
    hosts = stage(failures.groupBy("host").agg(
        F.count("*").alias("n"), F.sum(F.col("failed").cast("long")).alias("fails")), "hosts")
    rate = F.col("fails") / F.col("n")
    mean, variance, chance, rows = hosts.agg(
        F.avg(rate), F.var_samp(rate), F.avg(1 / F.col("n")), F.sum("n")).first()
    mean, strength = mean or 0.0, 1.0
    if variance is not None:
        spread = variance - mean * (1 - mean) * chance
        strength = mean * (1 - mean) / spread - 1 if spread > 0 else float(rows)
    strength = strength if strength > 0 else 1.0
    shrunk = (F.col("fails") + mean * strength) / (F.col("n") + strength)
    return hosts.select("host", shrunk.alias("host_rate"), (shrunk <= MAX_HOST_RATE).alias("host_kept"))


def judged(docs: DataFrame, carry: Column, host: str = "source", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc`` (what ``carry`` gives), the base
    counts, base_failed, host_rate, host_kept and kept. Repeated rows are judged
    as often as they stand; a null or empty text fails (it has no words)."""
    counted = docs.select(carry.alias("doc"), F.col(host).alias("host"), base_counts(F.col(text)).alias("c"))
    rows = stage(counted.select(
        "doc", "host", "c.words.n_words", "c.word_chars", "c.n_symbols", "c.n_dup_lines", "c.words.n_repeat_words",
        ((F.col("c.words.n_words") < MIN_WORDS) |
         (100 * F.col("c.words.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("c.words.n_words"))).alias("base_failed")),
        "rules")
    hosts = host_verdicts(rows.select("host", F.col("base_failed").alias("failed"))) \
        .withColumnRenamed("host", "host_of")
    return rows.join(hosts, F.col("host").eqNullSafe(F.col("host_of"))).drop("host_of") \
        .withColumn("kept", ~F.col("base_failed") & F.col("host_kept"))


def host_rules(docs: DataFrame) -> DataFrame:
    """Counts and verdicts of ``docs`` (doc_id, source, text; other columns are
    ignored)."""
    return judged(docs, F.col("doc_id")).select(
        F.col("doc").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def keep_by_host_rules(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    return judged(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns])).filter("kept").select("doc.*")
