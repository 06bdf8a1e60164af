"""Node and edge tables from a wide level table, and set operators on them.

A node is one root-to-entity path, so an entity under two parents is two nodes. ``path`` (an array of
ids) identifies the node and its ancestors are the prefixes of ``path``, so nothing here recurses.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from claimtree.functions.codes import null_token
from claimtree.functions.text import is_filled, typed_cast
from claimtree.operators.metadata import HierarchyMeta, filter_values
from claimtree.operators.scale import BROADCAST_BYTES, dim_side, left_lookup
from claimtree.sources.tables import resolve_column

# Primary flags that count as set; a missing flag reads as NULL.
PRIMARY_TRUE = ["TRUE", "NULL"]
PATH_MARK = "\u0001"
# Generous size of one ancestor row in memory: its path and one attached value.
ANCESTOR_BYTES = 512


# --- wide-table filters ---------------------------------------------------------------------------


def filter_root(wide: DataFrame, meta: HierarchyMeta, name: str) -> DataFrame:
    """Rows of one level-1 entity, by exact name; an empty name keeps all."""
    if name == "":
        return wide
    return wide.where(F.col(level_column(wide, meta, 1, meta.name_key)) == name)


def filter_levels(
    wide: DataFrame, meta: HierarchyMeta, field: str, values: str | Sequence[str] | None, mode: str = "any"
) -> DataFrame:
    """Rows where the field matches, case ignored, in any (or in all) of the levels from 2 that hold it."""
    wanted = filter_values(values)
    if wanted is None:
        return wide
    wanted = [v.upper() for v in wanted]
    levels = [lv for lv in range(2, meta.max_depth + 1) if meta.column(lv, field)]
    columns = [F.col(level_column(wide, meta, lv, field)).cast("string") for lv in levels]
    tests = [F.upper(F.coalesce(c, F.lit("NULL"))).isin(wanted) for c in columns]
    if mode == "all":
        return wide.where(reduce(Column.__and__, tests, F.lit(True)))
    return wide.where(reduce(Column.__or__, tests, F.lit(False)))


def filter_primary(wide: DataFrame, meta: HierarchyMeta) -> DataFrame:
    return filter_levels(wide, meta, meta.primary_key, PRIMARY_TRUE, "all") if meta.has_primary else wide


def apply_filters(wide: DataFrame, meta: HierarchyMeta, spec: Sequence[tuple[str, str | Sequence[str] | None]]) -> DataFrame:
    """All of several ``(field, values)`` filters."""
    return reduce(lambda df, one: filter_levels(df, meta, *one), spec, wide)


def first_seen(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key by the order columns, numbers that make it unique inside the key.

    Two phases and no sorted aggregate: the least number of each key is a hash aggregate that carries nothing
    else, and the rows that have it are joined back. A key with many rows is split by the join, as there is
    one least row on the other side. ``df`` is read once more for each order column.
    """
    rest = [c for c in df.columns if c not in (*keys, *order)]
    for column in order:
        least = df.groupBy(*[F.col(k).alias(f"_first_{k}") for k in keys]).agg(F.min(column).alias("_first"))
        same = [F.col(k).eqNullSafe(F.col(f"_first_{k}")) for k in keys]
        df = df.join(least, reduce(Column.__and__, same, F.col(column) == F.col("_first")), "left_semi")
    return df.select(*keys, *order, *rest)


# --- nodes and edges ------------------------------------------------------------------------------


def level_column(wide: DataFrame, meta: HierarchyMeta, level: int, key: str) -> str:
    column = meta.column(level, key)
    if column is None:
        raise ValueError(f"level {level} has no column for {key!r}")
    return resolve_column(wide, column.name)


def level_ids(wide: DataFrame, meta: HierarchyMeta) -> list[Column]:
    return [null_token(F.col(level_column(wide, meta, lv, meta.id_key))) for lv in range(1, meta.max_depth + 1)]


def level_value(wide: DataFrame, meta: HierarchyMeta, level: int, key: str) -> Column:
    """The level's attribute in its declared type, NULL where the level lacks it."""
    column = meta.column(level, key)
    if column is None:
        return typed_cast(F.lit(None).cast("string"), meta.attribute(key).dtype)
    name = resolve_column(wide, column.name)
    return typed_cast(F.col(name), column.dtype, wide.schema[name].dataType)


def build_nodes(
    wide: DataFrame, meta: HierarchyMeta, order: str = "row_order", attributes: Sequence[str] | None = None
) -> DataFrame:
    """One row per distinct path, with the attributes of its first row by ``order`` (a unique number).

    Each wide row yields its levels down to the first missing id. One hash aggregation on ``path`` finds the
    nodes and the number of their first row; it carries ids only, and rows of a large root are combined inside
    each task before its shuffle. The attributes come from a join with the wide rows by that number, of which
    each has at most as many nodes as levels. ``attributes`` (default: all) limits what that join carries.
    """
    ids = level_ids(wide, meta)
    keys = [k for k in meta.keys() if k != meta.id_key and (attributes is None or k in attributes)]
    # Ids are read once per row, and a row has as many nodes as ids before the first missing one.
    named = [f"_id_{level}" for level in range(1, meta.max_depth + 1)]
    read = wide.select(F.col(order).alias("row_order"), *[i.alias(n) for i, n in zip(ids, named, strict=True)])
    held = reduce(lambda c, k: c.when(F.col(named[k]).isNull(), k), range(meta.max_depth), F).otherwise(meta.max_depth)
    read = read.select("row_order", F.array(*named).alias("ids"), held.alias("held")).where("held > 0")
    rows = read.select("row_order", "ids", "held", F.explode(F.sequence(F.lit(1), F.col("held"))).alias("level"))
    rows = rows.select("row_order", F.slice("ids", F.lit(1), F.col("level")).alias("path"), (F.col("level") < F.col("held")).alias("deeper"))
    first = rows.groupBy("path").agg(F.min("row_order").alias("row_order"), F.max("deeper").alias("has_children"))
    if not keys:
        return first.select(*path_columns(F.col("path")), "row_order", "has_children")
    found = first.select(*[F.col(c).alias(f"_node_{c}") for c in first.columns])
    joined = found.join(wide, F.col("_node_row_order") == F.col(order))

    def seen(key: str) -> Column:
        values = [level_value(wide, meta, level, key) for level in range(1, meta.max_depth + 1)]
        case = reduce(lambda c, k: c.when(F.size("_node_path") == k, values[k - 1]), range(1, meta.max_depth + 1), F)
        return case.alias(key)

    return joined.select(
        *path_columns(F.col("_node_path")), F.col("_node_row_order").alias("row_order"), *map(seen, keys),
        F.col("_node_has_children").alias("has_children"),
    )


def path_columns(path: Column) -> list[Column]:
    return [
        path.alias("path"),
        F.size(path).alias("depth"),
        F.get(path, F.lit(0)).alias("root"),
        F.element_at(path, -1).alias("node_id"),
        F.slice(path, F.lit(1), F.size(path) - 1).alias("parent_path"),
    ]


def build_edges(
    wide: DataFrame, meta: HierarchyMeta, order: str = "row_order", attributes: Sequence[str] | None = None
) -> DataFrame:
    """Distinct child and parent pairs over all levels, with first-seen parent attributes.

    The primary flag and relation type are the child's. Dummy ('filled') children give no edge. Found like
    nodes: a hash aggregate of the pairs, then a join with the rows that hold each pair first; of several
    levels of that row the highest counts. ``attributes`` limits the parent attributes carried.
    """
    ids = level_ids(wide, meta)
    own = [meta.primary_key, meta.relation_key]
    keys = [k for k in meta.keys() if k not in (meta.id_key, *own) and (attributes is None or k in attributes)]
    levels = range(2, meta.max_depth + 1)

    def is_edge(level: int) -> Column:
        held = reduce(Column.__and__, [i.isNotNull() for i in ids[1:level]])
        return held & ~F.coalesce(is_filled(level_value(wide, meta, level, meta.relation_key)), F.lit(False))

    def pair(level: int) -> Column:
        return F.struct(ids[level - 1].alias("child_id"), ids[level - 2].alias("parent_id"))

    pairs = F.filter(F.array(*[F.when(is_edge(k), pair(k)) for k in levels]), lambda e: e.isNotNull())
    rows = wide.select(F.col(order).alias("row_order"), F.explode(pairs).alias("e"))
    first = rows.groupBy("e.child_id", "e.parent_id").agg(F.min("row_order").alias("row_order"))
    found = first.select(*[F.col(c).alias(f"_edge_{c}") for c in first.columns])
    joined = found.join(wide, F.col("_edge_row_order") == F.col(order))

    def seen(level: int) -> Column:
        values = [level_value(wide, meta, level, k).alias(k) for k in own]
        values += [level_value(wide, meta, level - 1, k).alias(k) for k in keys]
        parent = ids[level - 2].eqNullSafe(F.col("_edge_parent_id"))
        here = is_edge(level) & (ids[level - 1] == F.col("_edge_child_id")) & parent
        return F.when(here, F.struct(F.lit(level).alias("level"), *values))

    picked = joined.withColumn("_edge_seen", F.coalesce(*map(seen, levels)))
    renamed = [F.col(f"_edge_{c}").alias(c) for c in ("child_id", "parent_id", "row_order")]
    return picked.select(*renamed, "_edge_seen.*")


def conflicting_children(edges: DataFrame, meta: HierarchyMeta) -> DataFrame:
    """Children whose primary flag is TRUE under two or more parents."""
    primary = edges.where(F.upper(meta.primary_key) == "TRUE")
    return primary.groupBy("child_id").agg(F.count("*").alias("primary_parents")).where("primary_parents >= 2")


def is_bold(edges: DataFrame, meta: HierarchyMeta) -> Column:
    return F.coalesce(F.col(meta.primary_key), F.lit("NULL")).isin(PRIMARY_TRUE)


def parents_of(edges: DataFrame, meta: HierarchyMeta, child_id: str | None = None) -> DataFrame:
    """Parent rows of one child (or of all), with the primary parent of a shared child marked.

    Kept as rows: a shared child may have any number of parents, and repeating the list on each of
    its nodes would square that number.
    """
    rows = edges if child_id is None else edges.where(F.col("child_id") == child_id)
    counts = rows.groupBy("child_id").agg(F.count("*").alias("n_parents"))
    marked = rows.join(counts, "child_id")
    return marked.withColumn("is_primary_parent", is_bold(edges, meta) & (F.col("n_parents") > 1))


def with_parents(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Add the number of parents of each node's entity and whether it has several."""
    counts = edges.groupBy("child_id").agg(F.count("*").alias("n_parents"))
    joined = nodes.join(counts, (nodes["node_id"] == counts["child_id"]) & (nodes["depth"] > 1), "left")
    total = F.coalesce("n_parents", F.lit(0))
    return joined.select(*nodes.columns, total.alias("n_parents"), (total > 1).alias("multi_parent"))


# --- sets of nodes --------------------------------------------------------------------------------


def prefixes(path: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(path)), lambda k: F.slice(path, F.lit(1), k))


def leaves(nodes: DataFrame) -> DataFrame:
    """Nodes without children; after a filter, pass the nodes through ``current_children`` first."""
    return nodes.where(~F.col("has_children"))


def current_children(nodes: DataFrame) -> DataFrame:
    """The same nodes with ``has_children`` as it is in this table: filters can take a parent's children away."""
    parents = nodes.where(F.col("depth") > 1).select(F.col("parent_path").alias("_parent")).distinct()
    joined = nodes.join(parents, F.col("path") == F.col("_parent"), "left")
    flag = F.col("_parent").isNotNull().alias("has_children")
    return joined.select(*[flag if c == "has_children" else F.col(c) for c in nodes.columns])


def child_count(nodes: DataFrame) -> DataFrame:
    children = nodes.where(F.col("depth") > 1).groupBy(F.col("parent_path").alias("path"))
    return children.agg(F.count("*").alias("child_count"))


def exclude(nodes: DataFrame, bad: DataFrame) -> DataFrame:
    """Drop the entities in ``bad.child_id`` under every parent, with their sub-trees.

    Pass ``bad`` as a stored table: its size is then known, and while it is small the steps of all
    paths are tested without a shuffle.
    """
    steps = nodes.select("path", F.explode("path").alias("_step"))
    ids = dim_side(bad.select(F.col("child_id").alias("_step")))
    doomed = steps.join(ids, "_step", "left_semi").select("path").distinct()
    return nodes.join(doomed, "path", "left_anti")


def prune(nodes: DataFrame, field: str, values: str | Sequence[str] | None) -> DataFrame:
    """Keep nodes whose field equals one of the values, their ancestors, and the roots."""
    wanted = filter_values(values)
    if wanted is None:
        return nodes
    matching = nodes.where(F.col(field).cast("string").isin(wanted) | (F.col("depth") == 1))
    kept = matching.select(F.explode(prefixes(F.col("path"))).alias("path")).distinct()
    return nodes.join(kept, "path", "left_semi")


def attach_ancestors(
    nodes: DataFrame,
    source: DataFrame,
    levels: Sequence[int],
    value: Column,
    name: Callable[[int], str],
    sizes: dict[int, int] | None = None,
) -> DataFrame:
    """For each level add ``value`` of the node's ancestor at that level (NULL at or above it).

    ``source`` holds one row per path (a node that was built without children never gets any), so a join never
    multiplies rows. Nodes at or above the level have no ancestor there and are spread over all tasks; the
    nodes below a large ancestor are the side that adaptive execution may split. ``sizes`` gives the node count
    of each level where known, and a level that fits ``BROADCAST_BYTES`` is then joined without a shuffle.
    """
    for level in levels:
        key = f"_at_{level}"
        inner = source.where((F.col("depth") == level) & F.col("has_children"))
        above = inner.select(F.col("path").alias(key), value.alias(name(level)))
        small = sizes is not None and sizes.get(level, 0) * ANCESTOR_BYTES <= BROADCAST_BYTES
        nodes = nodes.withColumn("_own", F.when(F.col("depth") > level, F.slice("parent_path", 1, level)))
        side = F.broadcast if small else lambda df: df
        nodes = left_lookup(nodes, above, [("_own", key)], side, heavy_rows=None).drop("_own", key)
    return nodes


def level_sizes(nodes: DataFrame) -> dict[int, int]:
    """Count of nodes with children per level: one row per level on the driver."""
    return {r["depth"]: r["count"] for r in nodes.where("has_children").groupBy("depth").count().collect()}


def promote(nodes: DataFrame, field: str, values: str | Sequence[str] | None, max_depth: int) -> DataFrame:
    """Keep levels 1-2 and matching nodes; each hangs under its nearest kept ancestor.

    ``path`` is rewritten: skipped ids are folded into the next kept step (``a>b``), which keeps paths
    unique and every parent a prefix. ``node_id`` stays the entity's own id.
    """
    wanted = filter_values(values)
    if wanted is None:
        return nodes
    kept = nodes.where((F.col("depth") <= 2) | F.col(field).cast("string").isin(wanted))
    rows = attach_ancestors(kept, kept, range(3, max_depth), F.lit(True), lambda k: f"_kept_{k}")

    def step(level: int) -> Column:
        end = F.lit("")
        if level < max_depth:
            after = F.when(F.col(f"_kept_{level}"), PATH_MARK).otherwise(">")
            end = F.when(F.col("depth") > level, after).otherwise("")
        return F.when(F.col("depth") >= level, F.concat(F.get("path", F.lit(level - 1)), end)).otherwise("")

    folded = F.split(F.concat(*[step(k) for k in range(3, max_depth + 1)]), PATH_MARK) if max_depth > 2 else None
    if folded is None:
        return kept
    path = F.when(F.col("depth") <= 2, F.col("path")).otherwise(F.concat(F.slice("path", 1, 2), folded))
    attributes = [c for c in nodes.columns if c not in ("path", "depth", "root", "node_id", "parent_path")]
    return rows.withColumn("path", path).select(
        "path", F.size("path").alias("depth"), "root", "node_id",
        F.slice("path", F.lit(1), F.size("path") - 1).alias("parent_path"), *attributes,
    )


def rollup(nodes: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Replace each metric by the sum over the node and everything below it.

    Every node adds its value to all its ancestors; partial sums inside each task keep a large root
    from meeting in one place. Only inner nodes have such a sum, so the joined side is small.
    """
    above = nodes.where(F.col("depth") > 1).select(*metrics, F.explode(prefixes(F.col("parent_path"))).alias("_inner"))
    totals = above.groupBy("_inner").agg(*[F.sum(m).alias(f"_{m}") for m in metrics])
    joined = nodes.join(totals, F.col("path") == F.col("_inner"), "left")

    def total(metric: str) -> Column:
        both = F.coalesce(F.col(metric), F.lit(0)) + F.coalesce(F.col(f"_{metric}"), F.lit(0))
        return F.when(F.col(metric).isNotNull() | F.col(f"_{metric}").isNotNull(), both).alias(metric)

    return joined.select(*[total(c) if c in metrics else F.col(c) for c in nodes.columns])


def subtree(nodes: DataFrame, path: Sequence[str]) -> DataFrame:
    """A node and everything below it, re-rooted: depth 1 is the chosen node. Unknown paths give no rows."""
    skip = len(path) - 1
    below = nodes.where((F.col("depth") >= len(path)) & (F.slice("path", 1, len(path)) == F.array(*map(F.lit, path))))
    attributes = [c for c in nodes.columns if c not in ("path", "depth", "root", "node_id", "parent_path")]
    rooted = F.slice("path", F.lit(skip + 1), F.size("path") - skip)
    return below.select(*path_columns(rooted), *attributes)


def has_subtree(nodes: DataFrame) -> DataFrame:
    """Nodes that can be opened as a tree of their own: not a root, and with children (see ``leaves``)."""
    return nodes.where((F.col("depth") > 1) & F.col("has_children"))
