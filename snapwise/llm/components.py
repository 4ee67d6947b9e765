"""Connected components of a link table by alternating star contraction.

Every round is two keyed aggregations and joins over the remaining links:
"large star" hangs a node's larger neighbours on its smallest neighbour, "small
star" hangs its smaller neighbours there. The links shrink to one per node, from
the node to the smallest node of its component. A hot node is only a hot join
key (split at run time) and a combined minimum; no neighbour list is gathered.
Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapwise.llm.common import Staged


def _hang(links: DataFrame, larger: bool) -> DataFrame:
    """Hang each node's larger (or smaller) neighbours on its least neighbour."""
    both = links.select("a", "b")
    if larger:
        both = both.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("m"))
    hung = both.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if larger:  # only neighbours above the node itself move
        hung = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        hung = hung.unionByName(least.select("a", F.col("m").alias("b")))
    return hung.filter(F.col("a") != F.col("b")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: long); component is
    the smallest node that it reaches. Self links, repeated links and links in
    either direction are allowed; an empty table gives an empty one."""
    last = Staged(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .filter(F.col("a") != F.col("b")).distinct(), "links")
    mark = None
    while True:
        large = Staged(_hang(last.df, True), "links")
        small = Staged(_hang(large.df, False), "links")
        large.drop()
        last.drop()
        last = small
        now = last.df.agg(F.count("*"), F.sum(F.hash("a", "b").cast("decimal(38,0)")),
                          F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    nodes = last.df.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())
