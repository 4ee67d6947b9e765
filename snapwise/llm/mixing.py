"""Mixing documents to target domain weights, with soft membership.

A Naive Bayes classifier over hashed word presence, counted on a labelled table,
gives every document a posterior over the domains. Nonnegative document rates r
are then fitted so that the expected tokens of each domain, sum of n_i p_id r_i,
match the targets t_d: projected gradient on the least squares of the gaps
s - t, measured in the metric of M = sum of n_i p_i p_i'. With y = M^-1 (s - t), a
row's gradient divided by its tokens is p_i y, and a step of length one along it
never overshoots, as the curvature is M or, where rates stand at zero, less. Each
step is one aggregate: as many sums as there are domains, and their square for M.
Everything runs in built-in functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapwise.llm.common import let, stage, words

#: Hash buckets of the classifier, the bound on labelled rows it is counted on,
#: the smoothing of counts, what makes a bucket speak for a domain (standard
#: errors above, and factor over, its share of the other domains), and the fit's end.
BUCKETS, MAX_LABELLED, SMOOTHING, SURENESS, EFFECT, STEPS, TOLERANCE = 1 << 17, 20_000, 0.5, 5.0, 2.0, 25, 1e-6


def _counted(text: Column) -> Column:
    """A struct of a whole text: its number of words, and the distinct buckets of
    its lower-cased letter runs and of the last two characters of its words."""
    def bucket(x):
        return F.pmod(F.xxhash64(x), F.lit(BUCKETS)).cast("int")

    runs = F.transform(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}]+"), bucket)
    return let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_tokens"),
        F.array_distinct(F.concat(runs, F.transform(w, lambda x: bucket(F.concat(F.lit("-"), F.substring(x, -2, 2))))))
        .alias("buckets")))


def domain_model(docs: DataFrame, labels: DataFrame, domains: list[str]) -> tuple[DataFrame, list[float]]:
    """A row per bucket that speaks for a domain, with a weight per domain (its
    presence against its absence, by the log of the bucket's share of the domain's
    documents over its share of all, which cancels between the domains), and the
    domains' scores of a text that has none of the buckets."""
    known = labels.filter(F.col("domain").isin(domains) & F.col("doc_id").isNotNull()) \
        .groupBy("doc_id").agg(F.min("domain").alias("domain")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED) \
        .select(F.col("doc_id").alias("_sw_id"), "domain")
    # At most MAX_LABELLED rows are broadcast.
    labelled = stage(docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("_sw_id"))
                     .select("domain", _counted(F.col("text"))["buckets"].alias("buckets")), "labelled")
    total = {r["domain"]: r["n"] for r in labelled.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    every = sum(total.values())
    counts = labelled.select("domain", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(
        F.count("*").alias("n"), *[F.count(F.when(F.col("domain") == d, 1)).alias(f"n{k}") for k, d in enumerate(domains)])
    overall = (F.col("n") + SMOOTHING) / (every + 2 * SMOOTHING)
    weights, speaks = [], F.lit(False)
    for k, d in enumerate(domains):
        own, other = float(total.get(d, 0)), float(every - total.get(d, 0))
        share = (F.col(f"n{k}") + SMOOTHING) / (own + 2 * SMOOTHING)
        rest = (F.col("n") - F.col(f"n{k}") + SMOOTHING) / (other + 2 * SMOOTHING)
        error = F.sqrt(overall * (1 - overall) * (1 / (own + 1) + 1 / (other + 1)))
        speaks |= (share - rest >= SURENESS * error) & (share >= EFFECT * rest)
        # Counted against expected documents, so that a bucket too rare to be
        # expected in a small domain doesn't speak against it.
        here = overall * (F.col(f"n{k}") + SMOOTHING) / (own * overall + SMOOTHING)
        there, absent = F.log(here / overall), F.log((1 - here) / (1 - overall))
        weights += [(there - absent).alias(f"w{k}"), absent.alias(f"a{k}")]
    model = stage(counts.filter(speaks).select("bucket", *weights), "model")
    absent = model.agg(*[F.sum(f"a{k}") for k in range(len(domains))]).first()
    bases = [math.log((total.get(d, 0) + 1) / (every + len(domains))) + float(absent[k] or 0.0)
             for k, d in enumerate(domains)]
    return model.select("bucket", *[f"w{k}" for k in range(len(domains))]), bases


def with_posteriors(docs: DataFrame, model: DataFrame, bases: list[float]) -> DataFrame:
    """``row, doc_id, n_tokens`` (words) and ``p``, the posterior over the
    domains, of each row of ``docs``. A text without words has none of the buckets. A
    document's buckets are summed up in the task that reads it; only a row per
    document is shuffled."""
    counted = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", _counted(F.col("text")).alias("c"))
    # The model has at most BUCKETS rows.
    sums = counted.select("row", "doc_id", F.col("c.n_tokens").alias("n_tokens"), F.explode_outer("c.buckets").alias("bucket")) \
        .join(F.broadcast(model), "bucket", "left").groupBy("row", "doc_id", "n_tokens") \
        .agg(*[F.sum(F.coalesce(f"w{k}", F.lit(0.0))).alias(f"s{k}") for k in range(len(bases))])
    score = [F.col(f"s{k}") + F.lit(p) for k, p in enumerate(bases)]
    most = F.greatest(*score) if len(score) > 1 else score[0]
    raised = [F.exp(s - most) for s in score]
    return sums.select("row", "doc_id", "n_tokens", F.array(*[e / sum(raised, F.lit(0.0)) for e in raised]).alias("p"))


def _solve(matrix: list[list[float]], values: list[float]) -> list[float]:
    """Solve a small symmetric system; a direction without weight gives zero."""
    n = len(values)
    rows = [[*r, v] for r, v in zip(matrix, values)]
    least = 1e-12 * max([abs(r[k]) for k, r in enumerate(matrix)] or [0.0])
    for k in range(n):
        best = max(range(k, n), key=lambda i: abs(rows[i][k]))
        rows[k], rows[best] = rows[best], rows[k]
        if abs(rows[k][k]) <= least:
            rows[k] = [float(j == k) for j in range(n)] + [0.0]
        for i in range(n):
            if i != k and rows[i][k]:
                f = rows[i][k] / rows[k][k]
                rows[i] = [x - f * y for x, y in zip(rows[i], rows[k])]
    return [rows[k][n] / rows[k][k] for k in range(n)]


def fit_rates(rows: DataFrame, domains: list[str], targets: dict[str, float], total: float | None = None) -> Column:
    """The rate of each row as an expression over (n_tokens, p). ``targets`` are
    the domains' shares of ``total`` tokens (None: as many as there are)."""
    count = range(len(domains))
    part = [F.get("p", F.lit(k)) for k in count]
    tokens = F.col("n_tokens")

    def state(rate):
        """Expected tokens by domain, and the metric of the rows above zero."""
        at = F.col("_sw_rate")
        row = rows.withColumn("_sw_rate", rate).agg(
            *[F.sum(tokens * p * at) for p in part],
            *[F.sum(F.when(at > 0, tokens * part[j] * part[k])) for j in count for k in count]).first()
        found, n = [float(x or 0.0) for x in row], len(domains)
        return found[:n], [found[n + j * n:n + j * n + n] for j in count]

    rate: Column = F.lit(1.0)
    reached, metric = state(rate)
    whole = metric
    total = sum(reached) if total is None else total
    goal = [total * targets[d] / sum(targets.values()) for d in domains]

    def gap_of(reached):
        return [s - t for s, t in zip(reached, goal)]

    def stepped(metric):
        step = _solve(metric, gap_of(reached))
        new = F.greatest(F.lit(0.0), rate - sum((p * y for p, y in zip(part, step)), F.lit(0.0)))
        return new, *state(new)

    for _ in range(STEPS):
        far = sum(map(abs, gap_of(reached)))
        if far <= TOLERANCE * total:
            break
        # The metric of the rows above zero gives longer steps; where such a
        # step overshoots, that of all rows is taken.
        new = stepped(metric)
        if metric is not whole and sum(map(abs, gap_of(new[1]))) >= far:
            new = stepped(whole)
        rate, reached, metric = new
        if sum(map(abs, gap_of(reached))) > 0.99 * far:
            break  # the targets cannot be met more closely
    return rate


def reached_shares(mixed: DataFrame, targets: dict[str, float]) -> DataFrame:
    """``domain, target, reached``: each domain's share of the targets and of the
    expected tokens of a ``mixture`` by its rates (null if there are none), so a
    difference tells how far the fit was from its targets when it ended."""
    domains, whole = sorted(targets), sum(targets.values())
    tokens = F.col("n_tokens") * F.col("rate")
    sums = mixed.agg(F.sum(tokens).alias("all"), *[F.sum(tokens * F.get("p", F.lit(k))).alias(f"s{k}") for k in range(len(domains))])
    return sums.select(F.explode(F.array(*[
        F.struct(F.lit(d).alias("domain"), F.lit(targets[d] / whole).alias("target"),
                 F.try_divide(f"s{k}", "all").alias("reached")) for k, d in enumerate(domains)])).alias("at")).select("at.*")


def mixture(docs: DataFrame, labels: DataFrame, targets: dict[str, float]) -> DataFrame:
    """``row, doc_id, n_tokens, p, rate`` for every row of ``docs`` (doc_id,
    text; other columns are ignored), given ``labels`` (doc_id, domain) and each
    domain's target share. ``row`` numbers the rows as they are read. Repeated
    rows count as often as they stand; of several labels of an id the first by
    name counts; null texts have no words; an empty table gives an empty one. A
    domain that no document belongs to is left out of the fit."""
    domains = sorted(targets)
    rows = stage(with_posteriors(docs, *domain_model(docs, labels, domains)), "posteriors")
    return rows.withColumn("rate", fit_rates(rows, domains, targets))


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of a table with quality and toxic marks."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low_quality")
                         .when(F.col("quality") == 1, "general").alias("domain"))


def mix_documents(docs: DataFrame, labels: DataFrame, targets: dict[str, float]) -> DataFrame:
    """``docs`` with each row as often as its rate says: its whole part, and once
    more where a hash of its content falls below the rest."""
    rate, draw = F.col("_sw_rate"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    rates = mixture(docs, labels, targets).select(F.col("row").alias("_sw_row"), F.col("rate").alias("_sw_rate"))
    copies = (F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)).cast("int")
    return docs.withColumn("_sw_row", F.monotonically_increasing_id()).join(rates, "_sw_row") \
        .withColumn("_sw_copies", copies).filter("_sw_copies > 0") \
        .withColumn("_sw_copy", F.explode(F.sequence(F.lit(1), F.col("_sw_copies")))) \
        .select(*[F.col(f"`{c}`") for c in docs.columns])
