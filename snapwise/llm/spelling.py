"""Spelling variants: words one edit apart, by a relational trie frontier.

The trie is a table of edges. Its nodes are the words, the root and the prefixes
at which words part: the common prefixes of words that are neighbours in sorted
order. A node's parent is what it shares with the node before it, so two passes
of positions and neighbours build the table without gathering the words. A path
without a parting is one edge with a label of several characters.

The frontier is a table of states (word, position, node, edits). A level joins
the states at nodes of one depth with the edges that leave them. With no edit
made, a state follows its word's own path and, past the middle of the word, may
replace the next character or take one in addition; with one edit made, the
label must match the word. A state whose word is used up at a word's node with
one edit made is a neighbour. Edits are made only where the two words part, so
each pair arises once. Edits before the middle are found in the trie of the
reversed words, whose states run in the same table: near the root, where a node
has many edges, none are made.

Edges of a node differ in their first character, so a node has as many as the
alphabet at most, and what a level makes is in proportion to the words. Nodes at
depth 0 and 1 are as few as the alphabet: their edges are broadcast. Deeper
levels are joined by node, and a node that many words share is split at run time
(skew join).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from os.path import commonprefix

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapwise.llm.common import Staged, remove_folder, rows_of, shared_folder, stage
from snapwise.operators.ordering import neighbours

#: Letters of words (fixed value): ASCII letters and U+00C0 to U+00FF.
LETTERS = "A-Za-zÀ-ÿ"

#: Distinct words that a task counts before it hands them on.
HELD = 400_000

#: Code points of a text whose runs are held at once (a window ends with a run).
WINDOW = 1 << 20

#: A form has at least so many times the occurrences of its variant, so a chain
#: of forms is shorter than log5(2^63) = 28, and five doublings reach its end.
RATIO, DOUBLINGS = 5, 5


def _windows(text: str):
    """The text in pieces that end outside of words."""
    gap = re.compile(f"[^{LETTERS}]")
    at = 0
    while len(text) - at > WINDOW:
        end = gap.search(text, at + WINDOW)
        if end is None:
            break
        yield text[at:end.end()]
        at = end.end()
    yield text[at:]


def _runs(text: str, pattern) -> Counter:
    """How often each run of letters stands in a text; A-Z are lower-cased (as
    bytes, where only ASCII letters have a case)."""
    found = Counter()
    for part in _windows(text):
        found.update(pattern.findall(part.encode().lower().decode()))
    return found


def count_words(docs: DataFrame, min_length: int = 6, min_count: int = 5, drop: int = 199) -> DataFrame:
    """``word, n`` of every word of at least ``min_length`` code points and
    ``min_count`` occurrences.

    A word is a maximal run of LETTERS with A-Z lower-cased. Where ``drop``
    divides the crc32 of ``<doc_id>:<run>``, the code point of that number
    (modulo the length) is deleted. A null id counts as no digits."""
    def run(batches):
        import pyarrow as pa
        pattern = re.compile(f"[{LETTERS}]{{{min_length},}}")
        total = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())],
                                              names=["word", "n"])
        for batch in batches:
            for doc_id, text in rows_of([batch], "doc_id", "text"):
                base = zlib.crc32(f"{doc_id}:".encode())
                for word, n in _runs(text, pattern).items():
                    h = zlib.crc32(word.encode(), base)
                    if h % drop == 0:
                        h %= len(word)
                        word = word[:h] + word[h + 1:]
                        if len(word) < min_length:
                            continue
                    total[word] += n
                if len(total) > HELD:
                    yield out()
                    total.clear()
        yield out()

    runs = docs.filter(F.col("text").isNotNull()).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text").mapInArrow(run, "word string, n long")
    return runs.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


@F.pandas_udf(T.IntegerType())
def _shared(a: pd.Series, b: pd.Series) -> pd.Series:
    """Length of the common prefix."""
    return pd.Series([len(commonprefix(pair)) for pair in zip(a, b)], dtype="int32")


def _with_shared(nodes: DataFrame) -> DataFrame:
    """Each node of a side with the prefix that it shares with the one before."""
    pairs = neighbours(nodes, ["side"], "node", prev_name="before").filter(F.col("before").isNotNull())
    return pairs.select("side", "node", F.substring("node", F.lit(1), _shared("before", "node")).alias("shared"))


def trie_edges(words: DataFrame) -> DataFrame:
    """``side, node, next, at`` of ``words`` (side, word, n): ``next`` maps the
    first character of each edge that leaves the node to (label, child's n where
    it is a word, whether edges leave the child); ``at`` is the node's depth."""
    spelled = words.select("side", F.col("word").alias("node"))
    sides = words.select("side").distinct()
    nodes = stage(spelled.unionByName(_with_shared(spelled).select("side", F.col("shared").alias("node")))
                  .unionByName(sides.select("side", F.lit("").alias("node"))).distinct(), "nodes")
    # The closure of the words under common prefixes: what a node shares with
    # the node before it is its parent.
    edges = stage(_with_shared(nodes).withColumnRenamed("shared", "parent"), "edges")
    inner = edges.select("side", F.col("parent").alias("node")).distinct().withColumn("inner", F.lit(True))
    known = edges.join(words.select("side", F.col("word").alias("node"), "n"), ["side", "node"], "left") \
        .join(inner, ["side", "node"], "left")
    label = F.substring("node", F.length("parent") + 1, F.length("node"))
    edge = F.struct(label.alias("label"), "n", F.coalesce("inner", F.lit(False)).alias("inner"))
    return known.groupBy("side", F.col("parent").alias("node")) \
        .agg(F.map_from_entries(F.collect_list(F.struct(F.left(label, F.lit(1)), edge))).alias("next")) \
        .withColumn("at", F.length("node"))


def _rest(start: Column, length: Column) -> Column:
    """``length`` characters of the word, ``start`` of them skipped."""
    return F.substring("word", start + 1, length)


def _step(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states and neighbours (``at`` = -1) that one level makes."""
    size, p, follows = F.length("word"), F.col("position"), F.length("label")
    ahead = F.substring("word", p + 1, F.lit(1))
    free = F.col("edits") == 0
    # Only past the middle may an edit be made: there all edges are candidates.
    open_ = free & (2 * p >= size - 1 + F.col("side"))
    tried = states.join(edges, ["side", "node"]).select(
        "side", "word", "n", "position", "edits", "node",
        F.explode(F.when(open_, F.map_values("next")).otherwise(F.array(F.try_element_at("next", ahead)))).alias("e")) \
        .filter(F.col("e").isNotNull()) \
        .select("side", "word", "n", "position", "edits", "node", F.col("e.label").alias("label"),
                F.col("e.n").alias("near_n"), "e.inner")
    first, tail = F.left("label", F.lit(1)), F.substring("label", F.lit(2), follows)
    same = first == ahead
    match = same & (F.col("label") == _rest(p, follows))
    replaced = open_ & ~same & (first > ahead) & (ahead != "") & (tail == _rest(p + 1, follows - 1)) & (p + follows <= size)
    added = free & (2 * p >= size + F.col("side")) & ~same & (tail == _rest(p, follows - 1)) & (p + follows - 1 <= size)

    def move(when: Column, position: Column, edits: Column) -> Column:
        return F.when(when, F.struct(position.alias("position"), edits.cast("int").alias("edits")))

    moves = F.array_compact(F.array(move(match, p + follows, F.col("edits")),
                                    move(replaced, p + follows, F.lit(1)), move(added, p + follows - 1, F.lit(1))))
    moved = tried.select("side", "word", "n", "near_n", "inner", F.concat("node", "label").alias("node"),
                         F.explode(moves).alias("m")) \
        .select("side", "word", "n", "near_n", "inner", "node", "m.position", "m.edits")
    done = F.col("position") == size
    # A character added past the middle of both directions is left to the first.
    again = (F.col("side") == 1) & (F.length("node") > size) \
        & (F.right("word", F.ceil(size / 2).cast("int")) == F.right("node", F.ceil(size / 2).cast("int")))
    near = (F.col("edits") == 1) & done & F.col("near_n").isNotNull() & ~again
    goes_on = F.col("inner") & ((F.col("edits") == 0) | ~done)
    both = F.array_compact(F.array(F.when(near, F.lit(-1)), F.when(goes_on, F.length("node"))))
    return moved.select("side", "word", "n", "position", "edits", "node", "near_n", F.explode(both).alias("at"))


STATE = "side int, word string, n long, position int, edits int, node string, near_n long"


def one_edit_pairs(words: DataFrame) -> DataFrame:
    """``word, n, near, near_n``: every ordered pair of ``words`` (word, n; words
    are distinct) that one inserted, deleted or replaced code point parts."""
    spark = words.sparkSession
    both = stage(words.select(F.lit(0).alias("side"), "word", "n")
                 .unionByName(words.select(F.lit(1).alias("side"), F.reverse("word").alias("word"), "n")), "words")
    folder = shared_folder(spark, "trie")
    trie_edges(both).write.partitionBy("at").parquet(folder)
    edges = spark.read.parquet(folder) if not both.isEmpty() else None
    # As many numbers as a word has characters at most.
    depths = sorted(r[0] for r in edges.select("at").distinct().collect()) if edges is not None else []
    frontier = shared_folder(spark, "frontier")

    def put(states: DataFrame) -> None:
        states.write.mode("append").partitionBy("at").parquet(frontier)

    def at(depth: int) -> DataFrame | None:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{frontier}/at={depth}")
        there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
        return spark.read.schema(STATE).parquet(f"{frontier}/at={depth}") if there else None

    put(both.select("side", "word", "n", F.lit(0).alias("position"), F.lit(0).alias("edits"), F.lit("").alias("node"),
                    F.lit(None).cast("long").alias("near_n"), F.lit(0).alias("at")))
    for depth in depths:
        if (states := at(depth)) is not None:
            leaving = edges.filter(F.col("at") == depth).drop("at")
            put(_step(states, F.broadcast(leaving) if depth < 2 else leaving))
            remove_folder(spark, f"{frontier}/at={depth}")
    found = at(-1)
    if found is None:
        found = spark.createDataFrame([], STATE)

    def forward(name: str) -> Column:
        return F.when(F.col("side") == 1, F.reverse(name)).otherwise(F.col(name))

    pairs = found.select(forward("word").alias("word"), "n", forward("node").alias("near"), "near_n")
    return pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"),
                                          F.col("word").alias("near"), F.col("n").alias("near_n")))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``forms`` (word, form): the last form of each chain."""
    reach = Staged(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(DOUBLINGS):
        ahead = reach.df.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = Staged(reach.df.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                                 F.col("further").isNotNull().alias("moved")), "roots")
        reach.drop()
        reach = step
        if reach.df.filter("moved").isEmpty():
            break
    return reach.df.select("word", "root")


def spelling_groups(words: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every row of ``words`` (word, n;
    words are distinct, null words are no words, other columns are ignored).

    n_near is the number of words one edit away. The form of a word is its near
    word of largest n (ties: the smallest in code-point order) if that n is at
    least RATIO times the word's own, else null; form_n is its n. The root is
    where the chain of forms ends (the word itself without a form). A word of
    any length takes part; an empty table stays empty."""
    words = stage(words.filter(F.col("word").isNotNull()).select("word", "n"), "vocabulary")
    near = one_edit_pairs(words).groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    best_n = -F.col("best.less")
    is_form = best_n >= RATIO * F.col("n")
    judged = stage(near.select("word", "n_near", F.when(is_form, F.col("best.near")).alias("form"),
                               F.when(is_form, best_n).alias("form_n")), "forms")
    roots = _roots(judged.filter(F.col("form").isNotNull()))
    return words.join(judged, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


def spelling_variants(docs: DataFrame, min_length: int = 6, min_count: int = 5, drop: int = 199) -> DataFrame:
    """``spelling_groups`` of the words of ``docs`` (doc_id, text; other columns are
    ignored), counted by ``count_words`` over all whole texts. Null and empty
    texts have no words, and a repeated row counts as often as it stands."""
    return spelling_groups(count_words(docs, min_length, min_count, drop))
