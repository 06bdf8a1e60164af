"""The hierarchy view: filters on rows, tree, conflict removal, filters and sort on nodes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from claimtree.operators import tree, tree_order
from claimtree.operators.metadata import HierarchyMeta, filter_values, load_config, load_meta, resolve_sort
from claimtree.session import scratch_path
from claimtree.sources.sinks import materialize
from claimtree.sources.tables import read_table, require_nonempty, require_sources

# Config keys of the row filters, node filters and the sort.
ROW_FILTERS, NODE_FILTERS = "func_csv", "func_json"


def check_filters(config: dict, params: dict) -> None:
    """Every filter that the configuration names must have a parameter."""
    for kind in (ROW_FILTERS, NODE_FILTERS, "func_sort"):
        for name in config.get("filters", {}).get(kind, {}):
            if name not in params:
                raise ValueError(f"Cannot find filter {name}: please check the filter name in the config")


def hierarchy_nodes(
    wide: DataFrame, meta: HierarchyMeta, config: dict, params: dict, root: str = "", order: str = "row_order"
) -> DataFrame:
    """Nodes after the root, row and primary filters, without entities that have two primary parents.

    Conflicts are looked for in the whole table, before any filter.
    """
    check_filters(config, params)
    rows = tree.filter_root(wide, meta, root)
    spec = [(s["value"], params[name]) for name, s in config.get("filters", {}).get(ROW_FILTERS, {}).items()]
    rows = tree.filter_primary(tree.apply_filters(rows, meta, spec), meta)
    nodes = tree.build_nodes(rows, meta, order)
    if not meta.has_primary:
        return nodes
    bad = tree.conflicting_children(tree.build_edges(wide, meta, order, attributes=[]), meta)
    return tree.exclude(nodes, materialize(bad, scratch_path(wide.sparkSession, "conflicts")))


def no_node_filter(value: str | Sequence[str] | None) -> bool:
    """Node filters are off when their first value says so, whatever follows it."""
    first = value if value is None or isinstance(value, str) else next(iter(value), None)
    return filter_values(first) is None


def arrange(nodes: DataFrame, meta: HierarchyMeta, config: dict, params: dict) -> DataFrame:
    """Node filters (prune, or promote where the setting says so), then sibling positions."""
    for name, setting in config.get("filters", {}).get(NODE_FILTERS, {}).items():
        if no_node_filter(params[name]):
            continue
        if str(setting["parameters"]).lower() == "true":
            nodes = tree.promote(nodes, setting["value"], params[name], meta.max_depth)
        else:
            nodes = tree.prune(nodes, setting["value"], params[name])
    nodes = tree.current_children(nodes)
    metric = resolve_sort(config, params)
    order = tree_order.metric_order(meta, metric) if metric else tree_order.name_order(meta)
    return tree_order.sibling_positions(nodes, order)


def hierarchy_view(
    wide: DataFrame,
    meta: HierarchyMeta,
    config: dict,
    params: dict,
    root: str = "",
    order: str = "row_order",
    workdir: str | None = None,
) -> DataFrame:
    """The filtered, sorted node table. The unfiltered nodes are stored once, since later steps join
    the node table with itself; the folder is ``workdir`` or one under the session's scratch folder.
    Filters that leave no row raise ``ValueError``."""
    nodes = hierarchy_nodes(wide, meta, config, params, root, order)
    nodes = require_nonempty(materialize(nodes, workdir or scratch_path(wide.sparkSession, "nodes")))
    return arrange(nodes, meta, config, params)


def catalog_view(
    spark: SparkSession, names: dict[str, str], params: dict, root: str = "", order: str = "row_order",
    settings_order: str | None = None, workdir: str | None = None,
) -> tuple[DataFrame, HierarchyMeta, dict]:
    """The view of catalog tables, with its metadata and configuration.

    ``names`` gives the tables of the roles ``columns``, ``config`` and ``hierarchy`` (more roles may be named);
    each must exist before anything is read. ``settings_order`` is the order column of the first two.
    """
    missing = {"columns", "config", "hierarchy"} - names.keys()
    if missing:
        raise ValueError(f"no source is named for {', '.join(sorted(missing))}")
    require_sources(spark, names)
    config = load_config(read_table(spark, names["config"]), settings_order)
    meta = load_meta(read_table(spark, names["columns"]), config, settings_order)
    view = hierarchy_view(read_table(spark, names["hierarchy"]), meta, config, params, root, order, workdir)
    return view, meta, config


def subtree_view(nodes: DataFrame, path: list[str], meta: HierarchyMeta, config: dict, params: dict) -> DataFrame:
    """One node's sub-tree with the node filters and the sort applied again (row filters are not)."""
    return arrange(tree.subtree(nodes, path), meta, config, params)
