"""Stored forms of a node table that answer a question without reading all nodes: intervals and trigrams."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from claimtree.functions.text import search_predicate
from claimtree.operators.metadata import HierarchyMeta
from claimtree.operators.tree import path_columns, prefixes
from claimtree.operators.tree_order import preorder

GRAM = 3
NUMBER = "_number"
# Stretches of nodes that a search asks its scan for at most.
STRETCHES = 64


# --- intervals ------------------------------------------------------------------------------------


def label_intervals(nodes: DataFrame, order: Sequence[Column], max_depth: int) -> DataFrame:
    """Stored nodes with ``preorder`` and ``last``: a node's sub-tree is the numbers from its own to its last.

    Numbers are depth-first inside each root. Sizes are partial sums over ancestors, so no tree is held by a task.
    """
    below = nodes.where(F.col("depth") > 1).select(F.explode(prefixes(F.col("parent_path"))).alias("_inner"))
    below = below.groupBy("_inner").agg(F.count("*").alias("_below"))
    numbered = preorder(nodes, order, max_depth)
    joined = numbered.join(below, F.col("path") == F.col("_inner"), "left")
    return joined.withColumn("last", F.col("preorder") + F.coalesce("_below", F.lit(0))).drop("_inner", "_below")


def store_intervals(labelled: DataFrame, path: str) -> DataFrame:
    """Writes labelled nodes in the order of their numbers, so that file statistics bound what a range reads."""
    ranged = labelled.repartitionByRange("root", "preorder").sortWithinPartitions("root", "preorder")
    ranged.write.mode("overwrite").parquet(path)
    return labelled.sparkSession.read.parquet(path)


def subtree_by_interval(stored: DataFrame, path: Sequence[str]) -> DataFrame:
    """The rows of ``tree.subtree``, read as one range of numbers. An unknown path gives no rows.

    The node itself is looked up first; that is one row on the driver.
    """
    own = stored.where((F.col("root") == path[0]) & (F.col("depth") == len(path)) & (F.col("path") == F.array(*map(F.lit, path))))
    found = own.select("preorder", "last").first()
    low, high = (found.preorder, found.last) if found else (1, 0)
    rows = stored.where((F.col("root") == path[0]) & (F.col("preorder") >= low) & (F.col("preorder") <= high))
    skip = len(path) - 1
    labels = ("path", "depth", "root", "node_id", "parent_path", "preorder", "last")
    rooted = F.slice("path", F.lit(skip + 1), F.size("path") - skip)
    return rows.select(*path_columns(rooted), *[c for c in stored.columns if c not in labels])


# --- trigrams -------------------------------------------------------------------------------------


def build_search_index(nodes: DataFrame, meta: HierarchyMeta, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Writes postings (``gram``, ``_number``), their counts (``gram``, ``n``) and the numbered rows of ``nodes``.

    A node's number stands once under each run of three characters of its lower-case name; its columns are
    stored once, however long its name is. Postings are in the order of the grams, so that a search reads the files
    of one; a frequent gram is spread over many. Nodes are numbered through the files that hold them, in each by
    name. Names too short to be found, and dummies, are left out. ``nodes`` should carry only what a result shows.
    """
    spark, folder = nodes.sparkSession, path.rstrip("/")

    def written(df: DataFrame, part: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{part}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{part}")

    name = F.lower(meta.name_key)
    found = nodes.where((F.length(name) >= GRAM) & ~F.col(meta.name_key).contains("(Filled)"))
    # Stored before they are used: another run may number the rows otherwise.
    numbered = found.sortWithinPartitions(name).withColumn(NUMBER, F.monotonically_increasing_id())
    numbered = written(numbered, "nodes")
    places = numbered.select(NUMBER, name.alias("_name")).select("*", F.explode(F.sequence(F.lit(1), F.length("_name") - (GRAM - 1))).alias("_at"))
    runs = places.withColumn("gram", F.substring("_name", F.col("_at"), F.lit(GRAM)))
    postings = runs.where("locate(gram, _name) = _at").select("gram", NUMBER)  # each run where it comes first
    postings = written(postings.repartitionByRange("gram", NUMBER).sortWithinPartitions("gram", NUMBER), "postings")
    counts = written(postings.groupBy("gram").agg(F.count("*").alias("n")), "counts")
    return postings, counts, numbered


def search_index(postings: DataFrame, counts: DataFrame, numbered: DataFrame, meta: HierarchyMeta, term: str) -> DataFrame:
    """The nodes whose name holds the term, as ``search_predicate`` says, from the postings of its rarest gram.

    The counts of the term's grams come to the driver, one row each, and of every file of nodes the least and
    greatest number met, so that only these stretches are read; every node met is verified by its name.
    """
    wanted = (term or "").strip().lower()
    grams = sorted({wanted[k : k + GRAM] for k in range(len(wanted) - GRAM + 1)})
    known = {r.gram: r.n for r in counts.where(F.col("gram").isin(grams)).collect()} if grams else {}
    if not grams or len(known) < len(grams):
        return numbered.where("false").drop(NUMBER)
    rarest = min(grams, key=lambda g: (known[g], g))
    met = postings.where(F.col("gram") == rarest).select(F.col(NUMBER).alias("_met"))
    inside = reduce(Column.__or__, [F.col(NUMBER).between(low, high) for low, high in stretches(met)])
    rows = numbered.where(inside & search_predicate(F.col(meta.name_key), term))
    return rows.join(met, F.col(NUMBER) == F.col("_met"), "left_semi").drop(NUMBER)


def stretches(met: DataFrame) -> list[tuple[int, int]]:
    """Least and greatest of the numbers ``_met`` of each file; neighbours are one beyond ``STRETCHES`` files."""
    files = met.groupBy(F.shiftright("_met", 33)).agg(F.min("_met").alias("low"), F.max("_met").alias("high"))
    spans = sorted((r.low, r.high) for r in files.collect())
    size = -(-len(spans) // STRETCHES)
    return [(spans[k][0], spans[min(k + size, len(spans)) - 1][1]) for k in range(0, len(spans), size)]
