"""Connected components of a links table, by hooking to the smallest neighbour and shortening paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from claimtree.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has a link; ``root`` is one node of its component.

    A round gives every node its smallest neighbour (itself included), follows these pointers until they
    no longer change, and contracts the links to the roots found; the roots left with links go into the
    next round. Rounds grow with the logarithm of the component's size. Links, pointers and roots stay
    tables: the driver only sees whether rows are left. A round's tables are written, so that a lost
    executor costs no recomputation of the rounds before.
    """
    links = stored(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "links")
    rounds = []
    while not links.isEmpty():
        both = links.union(links.select("b", "a")).toDF("node", "other")
        pointers = both.groupBy("node").agg(F.least("node", F.min("other")).alias("root"))
        pointers = _followed(stored(pointers, "pointers"))
        rounds.append(pointers)
        links = stored(_contracted(links, pointers), "links")
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    # From the last round back: a root of one round is a node of the next, or is final.
    final = rounds[-1]
    for pointers in reversed(rounds[:-1]):
        later = final.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
        joined = pointers.join(later, F.col("root") == F.col("_node"), "left")
        final = stored(joined.select("node", F.coalesce("_root", "root").alias("root")), "roots")
    return final


def _followed(pointers: DataFrame) -> DataFrame:
    """Every node pointing to the end of its chain; a step doubles the length that pointers cover."""
    while True:
        ahead = pointers.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
        jumped = pointers.join(ahead, F.col("root") == F.col("_node"), "left")
        jumped = jumped.select("node", F.coalesce("_root", "root").alias("root"), (F.col("_root") < F.col("root")).alias("moved"))
        jumped = stored(jumped, "pointers")
        pointers = jumped.select("node", "root")
        if jumped.where("moved").isEmpty():
            return pointers


def _contracted(links: DataFrame, pointers: DataFrame) -> DataFrame:
    of_a = pointers.select(F.col("node").alias("_a"), F.col("root").alias("a_root"))
    of_b = pointers.select(F.col("node").alias("_b"), F.col("root").alias("b_root"))
    joined = links.join(of_a, F.col("a") == F.col("_a")).join(of_b, F.col("b") == F.col("_b"))
    ends = joined.select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b"))
    return ends.where("a <> b").distinct()
