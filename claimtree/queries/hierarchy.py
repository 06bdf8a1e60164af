"""Registered queries of the hierarchy side."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from claimtree.functions.text import is_filled
from claimtree.operators import metadata, tree, tree_index, tree_order, tree_view
from claimtree.plans.hierarchy import hierarchy_view, subtree_view
from claimtree.queries.fixtures import HIER_META as META, Inputs
from claimtree.queries.hierarchy_oracle import check
from claimtree.queries.registry import Registry
from claimtree.session import scratch_path
from claimtree.sources.sinks import materialize

QUERIES = Registry(check)
query = QUERIES.query
# Settings of the hierarchy queries.
CONFIG = {
    "filters": {
        "func_csv": {"Relation": {"value": "RelationType", "parameters": "-", "content": "-"}},
        "func_json": {"Tier": {"value": "Tier", "parameters": "false", "content": "-"}},
        "func_sort": {"Metric": {"value": "{Metric}", "parameters": "-", "content": "-"}},
    }
}
PARAMS = {"Relation": ["Owned", "managed"], "Tier": ["High", "HIGH"], "Metric": "Balance"}
TEXT = {
    "title_text": {"value": "###0 (###1)", "parameters": "EntityName|EntityId", "content": "-"},
    "subtitle_text": {"value": "###0", "parameters": "RelationType", "content": "-"},
    "caption_text": {"value": "{Metric}", "parameters": "{Metric}", "content": "-"},
}
SEARCH_TEXT = {**TEXT, "caption_text": {"value": "tier ###0", "parameters": "Tier", "content": "-"}}
LINKS = {
    "profile": {"value": "open ###0", "parameters": "EntityName|EntityId", "content": "/entity/###1"},
    "help": {"value": "help", "parameters": "-", "content": "/help"},
}
NODE_COLUMNS = [
    "depth", "node_id", "EntityName", "RelationType", "PrimaryFlag", "Tier", "Balance", "Rate", "row_order",
    "has_children",
]


def name_order() -> list[Column]:
    return tree_order.name_order(META)


def label(path: str = "path") -> Column:
    return F.array_join(path, "/").alias(path)


def nodes(t: Inputs, *attributes: str):
    return tree.build_nodes(t.hier, META, attributes=attributes)


def all_nodes(t: Inputs):
    return tree.build_nodes(t.hier, META)


def stored_nodes(t: Inputs, *attributes: str):
    """The node table as a stage file, for operators that read it three times or more."""
    return materialize(nodes(t, *attributes), scratch_path(t.spark, "nodes"))


def edges(t: Inputs, *attributes: str):
    return tree.build_edges(t.hier, META, attributes=attributes)


def path_of(rows, node_id: str) -> list[str]:
    """The first path of an entity; one row on the driver, as when a reader clicks a search result."""
    return rows.where(F.col("node_id") == node_id).agg(F.min("path")).first()[0]


# --- wide-table filters

WIDE_KEY = ["row_order", "l1_id", "l2_id", "l3_id", "l4_id"]


@query("hier_filter_root", "SELECT row_order, l1_id, l2_id, l3_id, l4_id FROM fx_hier WHERE l1_name = 'ASIA'")
def _(t):
    return tree.filter_root(t.hier, META, "ASIA").select(*WIDE_KEY)


@query(
    "hier_filter_any",
    """SELECT row_order, l1_id, l2_id, l3_id, l4_id FROM fx_hier WHERE upper(l2_relation) IN ('FILLED', 'MANAGED')
       OR upper(l3_relation) IN ('FILLED', 'MANAGED') OR upper(l4_relation) IN ('FILLED', 'MANAGED')""",
)
def _(t):
    return tree.filter_levels(t.hier, META, "RelationType", ["filled", "Managed"]).select(*WIDE_KEY)


@query("hier_filter_all", "SELECT row_order, l1_id, l2_id, l3_id, l4_id FROM fx_hier WHERE {primary}")
def _(t):
    return tree.filter_primary(t.hier, META).select(*WIDE_KEY)


@query(
    "hier_filter_chain",
    """SELECT row_order, l1_id, l2_id, l3_id, l4_id FROM fx_hier
       WHERE (upper(l2_relation) = 'OWNED' OR upper(l3_relation) = 'OWNED' OR upper(l4_relation) = 'OWNED')
       AND (upper(l3_tier) IN ('MEDIUM', 'LOW') OR upper(l4_tier) IN ('MEDIUM', 'LOW'))""",
)
def _(t):
    spec = [("RelationType", "owned"), ("Tier", ["medium", "low"]), ("Balance", "All")]
    return tree.apply_filters(t.hier, META, spec).select(*WIDE_KEY)


# --- nodes, edges, conflicts


@query("hier_nodes", "SELECT {node} FROM nodes")
def _(t):
    return all_nodes(t).select(label(), *NODE_COLUMNS)


@query("hier_leaf", "SELECT path FROM nodes LEFT JOIN (SELECT DISTINCT parent_path AS parent FROM nodes) ON parent = path WHERE parent IS NULL")
def _(t):
    return tree.leaves(nodes(t)).select(label())


@query("hier_edges", "SELECT child_id, parent_id, row_order, level, PrimaryFlag, RelationType, EntityName, Balance FROM edges")
def _(t):
    columns = ["child_id", "parent_id", "row_order", "level", "PrimaryFlag", "RelationType", "EntityName", "Balance"]
    return edges(t, "EntityName", "Balance").select(*columns)


@query("hier_conflicts", "SELECT child_id, primary_parents FROM conflicts")
def _(t):
    return tree.conflicting_children(edges(t), META)


@query("hier_exclude", """SELECT path, parent IS NOT NULL AS has_children FROM kept_nodes
       LEFT JOIN (SELECT DISTINCT parent_path AS parent FROM kept_nodes) ON parent = path""")
def _(t):
    bad = materialize(tree.conflicting_children(edges(t), META), scratch_path(t.spark, "conflicts"))
    return tree.current_children(tree.exclude(nodes(t), bad)).select(label(), "has_children")


@query(
    "hier_parents",
    """SELECT path, coalesce(n, 0) AS n_parents, coalesce(n, 0) > 1 AS multi_parent FROM nodes
       LEFT JOIN (SELECT child_id, count(*) AS n FROM edges GROUP BY 1) ON node_id = child_id AND depth > 1""",
)
def _(t):
    return tree.with_parents(nodes(t), edges(t)).select(label(), "n_parents", "multi_parent")


@query(
    "hier_parent_rows",
    """SELECT child_id, parent_id, EntityName, n AS n_parents,
         coalesce(PrimaryFlag, 'NULL') IN ('TRUE', 'NULL') AND n > 1 AS is_primary_parent
       FROM edges JOIN (SELECT child_id, count(*) AS n FROM edges GROUP BY 1) USING (child_id)""",
)
def _(t):
    return tree.parents_of(edges(t, "EntityName"), META).select("child_id", "parent_id", "EntityName", "n_parents", "is_primary_parent")


@query("hier_child_count", "SELECT parent_path AS path, count(DISTINCT node_id) AS child_count FROM nodes WHERE depth > 1 GROUP BY 1")
def _(t):
    return tree.child_count(nodes(t)).select(label(), "child_count")


@query("hier_filled_flag", "SELECT path, coalesce(lower(RelationType) LIKE '%filled%', false) AS is_filled FROM nodes")
def _(t):
    return nodes(t, "RelationType").select(label(), F.coalesce(is_filled(F.col("RelationType")), F.lit(False)).alias("is_filled"))


# --- filters on nodes, roll-up, sub-tree


@query("hier_prune", """SELECT * FROM (WITH kept AS MATERIALIZED (SELECT path, depth, parent_path FROM nodes n WHERE depth = 1
       OR EXISTS (SELECT 1 FROM nodes m WHERE m.Tier IN ('High', 'HIGH') AND (m.path = n.path OR starts_with(m.path, n.path || '/'))))
       SELECT path, depth, parent IS NOT NULL AS has_children FROM kept
       LEFT JOIN (SELECT DISTINCT parent_path AS parent FROM kept) ON parent = path)""")  # fmt: skip
def _(t):
    kept = tree.current_children(tree.prune(nodes(t, "Tier"), "Tier", ["High", "HIGH"]))
    return kept.select(label(), "depth", "has_children")


@query(
    "hier_promote",
    """SELECT * FROM (WITH kept AS MATERIALIZED (SELECT n.node_id, CASE WHEN n.depth < 4 THEN n.path WHEN p.path IS NOT NULL THEN n.path
         ELSE n.p2 || '/' || n.a3 || '>' || n.a4 END AS path,
         CASE WHEN n.depth < 4 THEN n.parent_path WHEN p.path IS NOT NULL THEN p.path ELSE n.p2 END AS parent_path,
         CASE WHEN n.depth < 4 THEN n.depth WHEN p.path IS NOT NULL THEN 4 ELSE 3 END AS depth
       FROM nodes n LEFT JOIN nodes p ON n.parent_path = p.path AND p.depth = 3 AND p.Tier IN ('High', 'medium')
       WHERE n.depth <= 2 OR n.Tier IN ('High', 'medium'))
       SELECT kept.*, parent IS NOT NULL AS has_children FROM kept
       LEFT JOIN (SELECT DISTINCT parent_path AS parent FROM kept) ON parent = path)""",
)
def _(t):
    rows = tree.promote(stored_nodes(t, "Tier"), "Tier", ["High", "medium"], META.max_depth)
    return tree.current_children(rows).select("node_id", label(), label("parent_path"), "depth", "has_children")


@query("hier_rollup", """SELECT n.path, CAST(sum(d.Balance) AS BIGINT) AS Balance FROM nodes n JOIN
       (SELECT Balance, unnest(CASE depth WHEN 1 THEN [p1] WHEN 2 THEN [p1, p2] WHEN 3 THEN [p1, p2, p3]
          ELSE [p1, p2, p3, p4] END) AS up FROM nodes) d ON d.up = n.path GROUP BY 1""")  # fmt: skip
def _(t):
    return tree.rollup(nodes(t, "Balance"), ["Balance"]).select(label(), "Balance")


@query("hier_subtree", """SELECT substr(path, length(p1) + 2) AS path, depth - 1 AS depth, a2 AS root, Balance FROM nodes
       WHERE a2 = 'N7'""")  # fmt: skip
def _(t):
    rows = nodes(t, "Balance")
    return tree.subtree(rows, path_of(rows, "N7")).select(label(), "depth", "root", "Balance")


@query("hier_subtree_interval", """SELECT substr(path, length(p1) + 2) AS path, depth - 1 AS depth, a2 AS root, Balance FROM nodes
       WHERE a2 = 'N7'""")  # fmt: skip
def _(t):
    """The same sub-tree as a range of numbers in a stored, labelled table."""
    rows = stored_nodes(t, "EntityName", "Balance")
    labelled = tree_index.label_intervals(rows, name_order(), META.max_depth)
    kept = tree_index.store_intervals(labelled, scratch_path(t.spark, "intervals"))
    return tree_index.subtree_by_interval(kept, path_of(rows, "N7")).select(label(), "depth", "root", "Balance")


@query(
    "hier_subtree_eligible",
    "SELECT path FROM nodes JOIN (SELECT DISTINCT parent_path AS parent FROM nodes) ON parent = path WHERE depth > 1",
)
def _(t):
    return tree.has_subtree(nodes(t)).select(label())


# --- order, pages, numbering


@query("hier_sort_name", "SELECT path, position FROM by_name")
def _(t):
    return tree_order.sort_by_name(nodes(t, "EntityName"), META).select(label(), "position")


@query("hier_sort_metric", "SELECT path, position FROM by_balance")
def _(t):
    return tree_order.sort_by_metric(nodes(t, "EntityName", "Balance"), META, "Balance").select(label(), "position")


@query(
    "hier_sort_tier",
    """SELECT path, CAST(row_number() OVER (PARTITION BY parent_path, CASE WHEN depth = 1 THEN path END ORDER BY
         CASE lower(Tier) WHEN 'high' THEN 1 WHEN 'medium' THEN 2 WHEN 'low' THEN 3 ELSE 4 END, EntityName, path) AS INTEGER) AS position
       FROM nodes""",
)
def _(t):
    return tree_order.sort_by_metric(nodes(t, "EntityName", "Tier"), META, "Tier").select(label(), "position")


@query(
    "hier_pages",
    """SELECT path, position, page_no, total_pages, page_no > 1 AS has_prev, page_no < total_pages AS has_next FROM (
       SELECT path, position, CAST((position + 2) // 3 AS INTEGER) AS page_no, CAST((siblings + 2) // 3 AS INTEGER) AS total_pages FROM by_name)""",
)
def _(t):
    columns = ["position", "page_no", "total_pages", "has_prev", "has_next"]
    return tree_order.pages(nodes(t, "EntityName"), name_order()).select(label(), *columns)


@query("hier_preorder", """SELECT path, CAST(row_number() OVER (PARTITION BY root ORDER BY s1 NULLS FIRST, s2 NULLS FIRST,
       s3 NULLS FIRST, s4 NULLS FIRST) AS INTEGER) AS preorder FROM steps""")  # fmt: skip
def _(t):
    return tree_order.preorder(stored_nodes(t, "EntityName"), name_order(), META.max_depth).select(label(), "preorder")


@query(
    "hier_locate",
    """SELECT n.depth AS step, n.node_id AS step_id, n.position, CAST((n.position + 2) // 3 AS INTEGER) AS page_no FROM by_name n
       JOIN (SELECT * FROM nodes WHERE path = (SELECT min(path) FROM nodes WHERE node_id = 'O0')) o
       ON n.path IN (o.p1, o.p2, o.p3, o.p4)""",
)
def _(t):
    rows = nodes(t, "EntityName")
    return tree_order.locate(rows, path_of(rows, "O0"), name_order())


@query("hier_visible", "SELECT path, position FROM by_name WHERE depth = 1 OR (depth = 2 AND position <= 3)")
def _(t):
    return tree_order.visible(nodes(t, "EntityName"), name_order()).select(label(), "position")


@query("hier_to_depth", "SELECT path, position FROM shown")
def _(t):
    return tree_order.to_depth(stored_nodes(t, "EntityName"), META.max_depth, name_order()).select(label(), "position")


@query("hier_nested", """SELECT root, parent_path, page_no, count(*) AS n_children, string_agg(node_id, '|' ORDER BY position) AS ids
       FROM (SELECT root, CASE WHEN depth > 1 THEN parent_path ELSE '' END AS parent_path, node_id, position,
         CAST(CASE WHEN depth > 1 THEN ceil(position / 3.0) ELSE 1 END AS INTEGER) AS page_no FROM by_name) GROUP BY 1, 2, 3""")  # fmt: skip
def _(t):
    rows = tree_view.nest(stored_nodes(t, "EntityName", "RelationType", "Balance"), META, name_order())
    kids = F.from_json("children", f"array<struct<{META.id_key}:string>>")
    return rows.select(
        "root", label("parent_path"), "page_no", F.size(kids).cast("bigint").alias("n_children"),
        F.array_join(kids[META.id_key], "|").alias("ids"),
    )


# --- what a reader sees


@query(
    "hier_search",
    """SELECT path, {title}(concat(EntityName, ' (', node_id, ')')) AS title, {title}(coalesce(RelationType, 'null')) AS subtitle,
         CASE WHEN Tier = '-' THEN '' ELSE {title}(concat('tier ', coalesce(Tier, 'null'))) END AS caption
       FROM nodes WHERE lower(EntityName) LIKE '%omer#00000%' AND EntityName NOT LIKE '%(Filled)%'""",
)
def _(t):
    found = tree_view.search(nodes(t, "EntityName", "RelationType", "Tier"), META, " omer#00000", SEARCH_TEXT)
    return found.select(label(), "title", "subtitle", "caption")


@query(
    "hier_search_index",
    """SELECT path, {title}(concat(EntityName, ' (', node_id, ')')) AS title, {title}(coalesce(RelationType, 'null')) AS subtitle,
         CASE WHEN Tier = '-' THEN '' ELSE {title}(concat('tier ', coalesce(Tier, 'null'))) END AS caption
       FROM nodes WHERE lower(EntityName) LIKE '%omer#00000%' AND EntityName NOT LIKE '%(Filled)%'""",
)
def _(t):
    rows = nodes(t, "EntityName", "RelationType", "Tier").select("path", "node_id", "EntityName", "RelationType", "Tier")
    index = tree_index.build_search_index(rows, META, scratch_path(t.spark, "trigrams"))
    found = tree_index.search_index(*index, META, " omer#00000")
    return tree_view.search(found, META, " omer#00000", SEARCH_TEXT).select(label(), "title", "subtitle", "caption")


@query("hier_search_total", "SELECT count(*) AS results FROM nodes WHERE lower(EntityName) LIKE '%urgent%'")
def _(t):
    return tree_view.search(nodes(t, "EntityName"), META, "URGENT").agg(F.count("*").alias("results"))


@query(
    "hier_cards",
    """SELECT path, CASE WHEN length(full_title) <= 70 THEN full_title ELSE concat(regexp_replace(substr(full_title, 1, 70), ' [^ ]*$', ''), ' ...') END AS title,
         CASE WHEN RelationType IS NULL THEN '' WHEN length(RelationType) > 27 THEN concat(substr(RelationType, 1, 24), '...') ELSE RelationType END AS subtitle,
         CASE WHEN Balance IS NOT NULL THEN concat('Balance : $', {short}) END AS caption
       FROM (SELECT *, {title}(concat(EntityName, ' (', node_id, ')')) AS full_title FROM nodes)""",
)
def _(t):
    return tree_view.node_cards(nodes(t, "EntityName", "RelationType", "Balance"), META, TEXT, "Balance").select(label(), "title", "subtitle", "caption")


@query(
    "hier_detail",
    """SELECT path, category, item, field, label, CASE WHEN length(t) > 20 THEN concat(substr(t, 1, 17), '...') ELSE t END AS text,
         field = 'Rate' AS is_selected FROM (
       SELECT path, 'Finance' AS category, 1 AS item, 'Balance' AS field, 'Balance' AS label, concat('$', {short}) AS t FROM nodes WHERE Balance IS NOT NULL
       UNION ALL SELECT path, 'Finance', 2, 'Rate', 'Rate', concat(CASE WHEN Rate = floor(Rate) THEN CAST(CAST(Rate AS BIGINT) AS VARCHAR) ELSE CAST(Rate AS VARCHAR) END, ' per unit of trade') FROM nodes WHERE Rate IS NOT NULL
       UNION ALL SELECT path, 'Profile', 3, 'RelationType', 'Relation', RelationType FROM nodes WHERE RelationType IS NOT NULL
       UNION ALL SELECT path, 'Profile', 4, 'Tier', 'Tier', concat('tier <', Tier, '>') FROM nodes WHERE Tier IS NOT NULL)""",
)
def _(t):
    rows = tree_view.detail_rows(nodes(t, "Balance", "Rate", "RelationType", "Tier"), META, "Finance | Profile", "Rate")
    return rows.select(label(), "category", "item", "field", "label", "text", "is_selected")


@query(
    "hier_links",
    """SELECT path, 'profile' AS link, {title}(concat('open ', EntityName)) AS link_text, concat('/entity/', node_id) AS href FROM nodes
       UNION ALL SELECT path, 'help', 'Help', '/help' FROM nodes""",
)
def _(t):
    return tree_view.links(nodes(t, "EntityName"), META, LINKS).select(label(), "link", "link_text", "href")


@query("relation_legend", "SELECT relation_type, ordinal, colour FROM legend")
def _(t):
    return tree_view.relation_legend(stored_nodes(t, "RelationType"), META)


@query("hier_links_coloured", """SELECT parent_path AS source, path AS target, RelationType, colour FROM nodes
       LEFT JOIN legend ON relation_type = RelationType WHERE depth > 1""")  # fmt: skip
def _(t):
    rows = stored_nodes(t, "RelationType")
    drawn = tree_view.edge_list(rows, META, tree_view.relation_legend(rows, META))
    return drawn.select(label("source"), label("target"), "RelationType", "colour")


@query("image_lookup", """SELECT n.path, i.path AS image_path FROM nodes n LEFT JOIN
       (SELECT value, arg_max(path, image_order) AS path FROM fx_images WHERE view = 'node' GROUP BY 1) i
       ON n.RelationType = i.value""")  # fmt: skip
def _(t):
    found = tree_view.image_lookup(nodes(t, "RelationType"), t.images, "node", "RelationType", "image_order")
    return found.select(label(), "image_path")


# --- settings tables


@query(
    "config_pivot",
    """SELECT section, nullif(subsection, '-') AS subsection, attribute, arg_max(value, config_order) AS value,
         arg_max(parameter, config_order) AS parameters, arg_max(content, config_order) AS content
       FROM fx_config GROUP BY 1, 2, 3""",
)
def _(t):
    return metadata.config_pivot(t.config, "config_order")


@query(
    "meta_categories",
    """SELECT category, key, CAST(row_number() OVER (PARTITION BY category ORDER BY first) AS INTEGER) AS position FROM (
       SELECT category, key, min(column_order) AS first FROM fx_columns WHERE category <> '-' GROUP BY 1, 2)""",
)
def _(t):
    return metadata.meta_categories(t.columns, "column_order")


# --- the whole view


@query("hierarchy_view", """SELECT path, depth, node_id, Balance, position, parent IS NOT NULL AS has_children FROM view_nodes
       LEFT JOIN (SELECT DISTINCT parent_path AS parent FROM view_nodes) ON parent = path""")
def _(t):
    view = hierarchy_view(t.hier, META, CONFIG, PARAMS, root="ASIA")
    return view.select(label(), "depth", "node_id", "Balance", "position", "has_children")


@query("hierarchy_view_selected", """SELECT * FROM (WITH shown AS MATERIALIZED (SELECT n.node_id, n.Balance, n.EntityName,
         CASE WHEN n.depth < 4 OR p.path IS NOT NULL THEN n.path ELSE n.p2 || '/' || n.a3 || '>' || n.a4 END AS path,
         CASE WHEN n.depth < 4 OR p.path IS NOT NULL THEN n.parent_path ELSE n.p2 END AS parent_path,
         CASE WHEN n.depth = 4 AND p.path IS NULL THEN 3 ELSE n.depth END AS depth
       FROM view_kept n LEFT JOIN view_kept p ON n.parent_path = p.path AND p.depth = 3 AND p.Tier IN ('High', 'HIGH')
       WHERE n.depth <= 2 OR n.Tier IN ('High', 'HIGH'))
       SELECT path, depth, node_id, Balance, parent IS NOT NULL AS has_children, CAST(row_number() OVER (PARTITION BY parent_path,
         CASE WHEN depth = 1 THEN path END ORDER BY Balance DESC NULLS LAST, EntityName, path) AS INTEGER) AS position
       FROM shown LEFT JOIN (SELECT DISTINCT parent_path AS parent FROM shown) ON parent = path)""")  # fmt: skip
def _(t):
    """The setting that shows selected nodes only, under the nearest selected node above them."""
    filters = {**CONFIG["filters"], "func_json": {"Tier": {"value": "Tier", "parameters": "true", "content": "-"}}}
    view = hierarchy_view(t.hier, META, {"filters": filters}, PARAMS, root="ASIA")
    return view.select(label(), "depth", "node_id", "Balance", "has_children", "position")


@query("hier_subtree_view", """SELECT * FROM (WITH own AS (SELECT *, substr(path, length(p1) + 2) AS own_path,
         CASE WHEN depth > 2 THEN substr(parent_path, length(p1) + 2) ELSE '' END AS own_parent FROM nodes WHERE a2 = 'N7'),
       hits AS (SELECT unnest([p2, p3, p4]) AS hit FROM own WHERE Tier IN ('High', 'HIGH')),
       shown AS MATERIALIZED (SELECT own_path AS path, own_parent AS parent_path, depth - 1 AS depth, node_id, Balance, EntityName FROM own
         WHERE depth = 2 OR path IN (SELECT hit FROM hits WHERE hit IS NOT NULL))
       SELECT path, depth, node_id, Balance, parent IS NOT NULL AS has_children, CAST(row_number() OVER (PARTITION BY parent_path,
         CASE WHEN depth = 1 THEN path END ORDER BY Balance DESC NULLS LAST, EntityName, path) AS INTEGER) AS position
       FROM shown LEFT JOIN (SELECT DISTINCT parent_path AS parent FROM shown) ON parent = path)""")  # fmt: skip
def _(t):
    """One node opened as a tree of its own, with the node filter and the sort applied again."""
    rows = stored_nodes(t, "EntityName", "Tier", "Balance")
    view = subtree_view(rows, path_of(rows, "N7"), META, CONFIG, PARAMS)
    return view.select(label(), "depth", "node_id", "Balance", "has_children", "position")
