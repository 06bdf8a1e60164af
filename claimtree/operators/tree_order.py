"""Sibling order, pages, pre-order numbers and path location."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from claimtree.operators.metadata import HierarchyMeta
from claimtree.operators.scale import GROUP_ROWS, ranked
from claimtree.operators.tree import attach_ancestors, level_sizes
from claimtree.session import scratch_path
from claimtree.sources.sinks import materialize

# Rank of text tiers, and nodes per page.
TIER_RANK = {"high": 3, "medium": 2, "low": 1}
PAGE_SIZE = 3
# Up to this many rows per group Spark applies a bound on the row number before the shuffle.
BOUNDED_ROWS = 1000
LAST = 2**63 - 1

# One page for every parent, or a page per parent path.
Pages = int | Mapping[tuple[str, ...], int]
# Siblings share a parent; every root is a group of its own.
SIBLINGS = ["parent_path", "sibling_root"]


def name_order(meta: HierarchyMeta, collation: str | None = None) -> list[Column]:
    """Ascending keys by name, ties by the last step of the path, which is unique among siblings.

    ``collation='UNICODE'`` orders as a reader would.
    """
    name = F.coalesce(F.col(meta.name_key), F.lit(""))
    return [F.collate(name, collation) if collation else name, F.element_at("path", -1)]


def metric_order(meta: HierarchyMeta, metric: str, dtype: str | None = None) -> list[Column]:
    """Ascending keys for a metric from high to low: tiers by rank, numbers cut to integers.

    Values that cannot be compared come last; ties are in name order.
    """
    if metric == meta.name_key:
        return name_order(meta)
    if (dtype or meta.attribute(metric).dtype) == "String":
        tier = F.lower(metric)
        value = F.coalesce(*[F.when(tier == word, rank) for word, rank in TIER_RANK.items()]).cast("bigint")
    else:
        value = F.col(metric).cast("bigint")
    return [F.coalesce(-value, F.lit(LAST)), *name_order(meta)]


def _by_sibling(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("sibling_root", F.when(F.col("depth") == 1, F.col("root")))


def sibling_positions(
    nodes: DataFrame, order: Sequence[Column], total: str | None = None, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """1-based ``position`` of every node among its siblings."""
    return ranked(_by_sibling(nodes), SIBLINGS, order, "position", total, group_rows).drop("sibling_root")


def sort_by_name(nodes: DataFrame, meta: HierarchyMeta, collation: str | None = None) -> DataFrame:
    return sibling_positions(nodes, name_order(meta, collation))


def sort_by_metric(nodes: DataFrame, meta: HierarchyMeta, metric: str, dtype: str | None = None) -> DataFrame:
    return sibling_positions(nodes, metric_order(meta, metric, dtype))


def pages(nodes: DataFrame, order: Sequence[Column], size: int = PAGE_SIZE, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Page number of every node among its siblings, the page count, and whether pages surround it."""
    placed = sibling_positions(nodes, order, "siblings", group_rows)
    page = F.ceil(F.col("position") / size).cast("int")
    total = F.ceil(F.col("siblings") / size).cast("int")
    return placed.withColumns({
        "page_no": page, "total_pages": total, "has_prev": page > 1, "has_next": page < total,
    })


def on_page(nodes: DataFrame, order: Sequence[Column], page: Pages = 1, size: int = PAGE_SIZE) -> DataFrame:
    """Nodes on the shown page of their parent; roots are always shown.

    ``page`` is one number for all parents, or the page of each parent path that has left page 1. Early
    pages bound the row number, so Spark keeps only that many rows per group before the shuffle; later ones
    are numbered by range. The parents of a page map are taken apart first, so they change nothing for the rest.
    """
    columns = [*_but(nodes, "position"), "position"]
    if isinstance(page, int):
        return _shown(nodes, order, F.lit(page), page, size).select(*columns)
    if not page:
        return on_page(nodes, order, 1, size)
    rows = [(list(path), number) for path, number in page.items()]
    # The caller's own list; left to Spark's choice of join.
    turned = nodes.sparkSession.createDataFrame(rows, "_parent array<string>, _page int")
    same = F.col("parent_path") == F.col("_parent")
    rest = _shown(nodes.join(turned, same, "left_anti"), order, F.lit(1), 1, size)
    moved = _shown(nodes.join(turned, same), order, F.col("_page"), max(page.values()), size)
    return rest.select(*columns).unionByName(moved.select(*columns))


def _shown(nodes: DataFrame, order: Sequence[Column], page: Column, last: int, size: int) -> DataFrame:
    on = (F.col("position") > (page - 1) * size) & (F.col("position") <= page * size)
    if last * size <= BOUNDED_ROWS:
        number = F.row_number().over(Window.partitionBy(*SIBLINGS).orderBy(*order))
        placed = _by_sibling(nodes).withColumn("position", number).where(F.col("position") <= last * size)
    else:
        placed = sibling_positions(nodes, order, group_rows=0)
    return placed.where(on | (F.col("depth") == 1))


def _but(nodes: DataFrame, name: str) -> list[str]:
    return [c for c in nodes.columns if c != name]


def visible(nodes: DataFrame, order: Sequence[Column], page: Pages = 1, size: int = PAGE_SIZE) -> DataFrame:
    """What is shown at first: roots and one page of their children."""
    return on_page(nodes.where(F.col("depth") <= 2), order, page, size)


def to_depth(nodes: DataFrame, depth: int, order: Sequence[Column], page: Pages = 1, size: int = PAGE_SIZE) -> DataFrame:
    """Nodes shown when all is expanded down to ``depth``: every step of the path is on its page.

    The nodes on their parent's page are stored, since each level of the path is looked up in them.
    """
    shown = on_page(nodes.where(F.col("depth") <= depth), order, page, size)
    if depth > 2:
        shown = materialize(shown, scratch_path(nodes.sparkSession, "shown"))
    rows = attach_ancestors(shown, shown, range(2, depth), F.lit(1), lambda k: f"_shown_{k}")
    for level in range(2, depth):
        rows = rows.where((F.col("depth") <= level) | F.col(f"_shown_{level}").isNotNull()).drop(f"_shown_{level}")
    return rows


def preorder(
    nodes: DataFrame, order: Sequence[Column], max_depth: int, start: int = 1, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Depth-first number of every node inside its tree.

    A node comes after its parent, and after the whole sub-trees of the siblings before it. So the
    number is a sum over the path of such sub-tree sizes, and siblings are all that must be sorted:
    no task ever holds a whole tree. Pass stored nodes, as they are read several times; the sibling
    sums are stored for the same reason.
    """
    strict = F.transform(F.sequence(F.lit(1), F.size("parent_path")), lambda k: F.slice("parent_path", F.lit(1), k))
    below = nodes.where(F.col("depth") > 1).select(F.explode(strict).alias("_inner")).groupBy("_inner")
    below = below.agg(F.count("*").alias("_below"))
    sized = nodes.join(below, F.col("path") == F.col("_inner"), "left").drop("_inner")
    sized = _by_sibling(sized).withColumn("_size", F.coalesce("_below", F.lit(0)) + 1)
    running = ("_size", "_earlier")
    placed = ranked(sized, SIBLINGS, order, "_position", None, group_rows, running, _by_sibling(nodes))
    step = F.when(F.col("depth") > 1, F.col("_earlier") + 1).otherwise(0)
    placed = placed.select(*nodes.columns, step.alias("_step"))
    placed = materialize(placed, scratch_path(nodes.sparkSession, "siblings"))
    levels = range(2, max_depth)
    rows = attach_ancestors(placed, placed, levels, F.col("_step"), lambda k: f"_step_{k}", level_sizes(placed))
    steps = [F.col("_step"), *[F.coalesce(f"_step_{k}", F.lit(0)) for k in levels]]
    return rows.select(*nodes.columns, (reduce(Column.__add__, steps) + start).alias("preorder"))


def locate(nodes: DataFrame, path: Sequence[str], order: Sequence[Column], size: int = PAGE_SIZE) -> DataFrame:
    """The steps from the root to a node with the page that shows each.

    Siblings of each step are counted, not sorted: the position is one more than those before it.
    """
    steps = [list(path[:k]) for k in range(1, len(path) + 1)]
    literals = [F.array(*map(F.lit, s)) for s in steps]
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    keyed = nodes.select("path", "depth", "parent_path", "node_id", key.alias("_key"))
    # At most one row per step, hence a bounded broadcast below.
    targets = keyed.where(F.col("path").isin(literals)).select(
        F.col("depth").alias("step"), F.col("parent_path").alias("_parent"),
        F.col("node_id").alias("step_id"), F.col("_key").alias("_step_key"),
    )
    around = keyed.where(F.col("parent_path").isin(literals) | F.col("path").isin(literals[:1]))
    joined = around.join(
        F.broadcast(targets), (F.col("parent_path") == F.col("_parent")) & (F.col("depth") == F.col("step"))
    )
    before = F.count_if(F.col("_key") < F.col("_step_key"))
    counted = joined.groupBy("step", "step_id").agg((before + 1).cast("int").alias("position"))
    return counted.withColumn("page_no", F.ceil(F.col("position") / size).cast("int"))
