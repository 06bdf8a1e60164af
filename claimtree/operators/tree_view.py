"""What a reader sees of a hierarchy: search, details, links, legend, images, nested output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from claimtree.functions.text import (
    abbreviate_number,
    apply_mask,
    display,
    format_metric,
    is_blank_setting,
    render_template,
    search_predicate,
    title_case,
    trim_subtitle,
    trim_tail,
    trim_title,
)
from claimtree.operators.metadata import HierarchyMeta
from claimtree.operators.scale import dim_side, ranked
from claimtree.operators.tree import attach_ancestors, level_sizes
from claimtree.operators.tree_order import PAGE_SIZE, pages

# Link colours in order of use.
LINK_COLOURS = [
    "#000000", "#FF0000", "#0000FF", "#FFA500", "#228B22", "#FF00FF", "#708090", "#FA8072",
    "#8B4513", "#008080", "#00FF00",
]


def display_fields(nodes: DataFrame, meta: HierarchyMeta) -> dict[str, Column]:
    """Display text of every attribute that templates may name."""
    fields = {k: display(F.col(k), nodes.schema[k].dataType) for k in meta.keys() if k in nodes.columns}
    return {**fields, meta.id_key: F.col("node_id")}


def node_texts(nodes: DataFrame, meta: HierarchyMeta, section: dict) -> dict[str, Column]:
    """Title, subtitle and caption of a node from the ``text`` part of a config section."""
    fields = display_fields(nodes, meta)
    out = {}
    for name in ("title_text", "subtitle_text", "caption_text"):
        setting = section.get(name)
        if setting and not is_blank_setting(setting["value"]):
            out[name] = render_template(setting["value"], setting["parameters"], fields)
    return out


def node_cards(nodes: DataFrame, meta: HierarchyMeta, section: dict, metric: str | None = None) -> DataFrame:
    """Card texts per node: trimmed title and subtitle, and a caption that may show the chosen metric."""
    texts = node_texts(nodes, meta, section)
    cards = {}
    if "title_text" in texts:
        cards["title"] = trim_title(title_case(texts["title_text"]))
    if "subtitle_text" in texts:
        cards["subtitle"] = trim_subtitle(texts["subtitle_text"])
    if "caption_text" in texts:
        cards["caption"] = caption(nodes, meta, section["caption_text"], texts["caption_text"], metric)
    return nodes.withColumns(cards)


def caption(nodes: DataFrame, meta: HierarchyMeta, setting: dict, rendered: Column, metric: str | None) -> Column:
    field = setting["parameters"]
    if field == "{Metric}":
        if metric is None:
            return F.lit("")
        field = metric
    elif "|" in field or field not in meta.shorten:
        return rendered
    attribute = meta.attribute(field)
    return format_metric(shown_value(nodes, meta, field), attribute.format, attribute.text)


def shown_value(nodes: DataFrame, meta: HierarchyMeta, key: str) -> Column:
    value = F.col("node_id") if key == meta.id_key else F.col(key)
    if key in meta.shorten:
        return abbreviate_number(value)
    return display(value, nodes.schema[key].dataType if key in nodes.columns else None)


def search(nodes: DataFrame, meta: HierarchyMeta, term: str, section: dict | None = None) -> DataFrame:
    """Nodes whose name holds the term, with their rendered texts in title case. Count the rows for the total."""
    found = nodes.where(search_predicate(F.col(meta.name_key), term))
    texts = node_texts(found, meta, section or {})
    return found.withColumns({name.removesuffix("_text"): title_case(text) for name, text in texts.items()})


def detail_rows(
    nodes: DataFrame, meta: HierarchyMeta, categories: str | Sequence[str], metric: str | None = None
) -> DataFrame:
    """One row per node, category and attribute that has a value, formatted and trimmed to 20."""
    known = meta.categories()
    wanted = [c.strip() for c in (categories.split("|") if isinstance(categories, str) else categories)]
    entries = []
    for category in wanted:
        if category not in known:
            raise ValueError(f"Invalid category {category}: please check whether it exists in the columns table")
        for key in known[category]:
            attribute = meta.attribute(key)
            value = F.col("node_id") if key == meta.id_key else F.col(key)
            text = F.when(value.isNotNull(), apply_mask(shown_value(nodes, meta, key), attribute.format))
            entries.append(
                F.struct(
                    F.lit(category).alias("category"), F.lit(len(entries) + 1).alias("item"),
                    F.lit(key).alias("field"), F.lit(attribute.text).alias("label"), text.alias("text"),
                    F.lit(key == metric).alias("is_selected"),
                )
            )
    rows = nodes.select("path", "node_id", F.explode(F.array(*entries)).alias("d")).select("path", "node_id", "d.*")
    rows = rows.where((F.col("text") != "") & ~F.lower("text").isin("null", "undefined"))
    return rows.withColumn("text", trim_tail(F.col("text"), 20))


def links(nodes: DataFrame, meta: HierarchyMeta, settings: dict[str, dict]) -> DataFrame:
    """One row per node and configured link: title-case text and target."""
    fields = display_fields(nodes, meta)
    entries = [
        F.struct(
            F.lit(name).alias("link"),
            title_case(render_template(s["value"], s["parameters"], fields)).alias("link_text"),
            render_template(s["content"], s["parameters"], fields).alias("href"),
        )
        for name, s in settings.items()
    ]
    return nodes.select("path", "node_id", F.explode(F.array(*entries)).alias("l")).select("path", "node_id", "l.*")


def relation_legend(
    nodes: DataFrame, meta: HierarchyMeta, colours: Sequence[str] = tuple(LINK_COLOURS)
) -> DataFrame:
    """Relation types with the colour of their first appearance; types beyond the colours have none.

    Appearance is depth-first over first-seen rows. Siblings of one type are first reduced to their
    earliest. Every type has its ordinal, however many there are.
    """
    type_key = F.col(meta.relation_key).alias("relation_type")
    typed = nodes.where(F.col(meta.relation_key).isNotNull())
    earliest = typed.groupBy("parent_path", "depth", type_key).agg(F.min("row_order").alias("row_order"))
    levels = range(1, meta.max_depth)
    placed = attach_ancestors(earliest, nodes, levels, F.col("row_order"), lambda k: f"_{k}", level_sizes(nodes))
    steps = F.filter(F.array(*[F.col(f"_{k}") for k in levels], F.col("row_order")), lambda s: s.isNotNull())
    types = placed.groupBy("relation_type").agg(F.min(steps).alias("_first"))
    numbered = ranked(types.withColumn("_all", F.lit(0)), ["_all"], [F.col("_first"), F.col("relation_type")], "ordinal")
    palette = F.array(*map(F.lit, colours))
    return numbered.select("relation_type", "ordinal", F.get(palette, F.col("ordinal") - 1).alias("colour"))


def edge_list(nodes: DataFrame, meta: HierarchyMeta, legend: DataFrame) -> DataFrame:
    """Parent and child path of every link with the colour of its relation type."""
    rows = nodes.where(F.col("depth") > 1)
    joined = rows.join(dim_side(legend), rows[meta.relation_key] == legend["relation_type"], "left")
    return joined.select(
        F.col("parent_path").alias("source"), F.col("path").alias("target"), rows[meta.relation_key], "colour"
    )


def image_lookup(nodes: DataFrame, images: DataFrame, view: str, field: str, order: str | None = None) -> DataFrame:
    """The image path of a node by the value of a field; the last image row of a value wins."""
    rows = images.where(F.col("View") == view)
    last = F.max(F.struct(*([order] if order else []), "Path"))
    dim = rows.groupBy(F.col("Value").alias("_value")).agg(last.alias("_last"))
    dim = dim.select("_value", F.col("_last.Path").alias("image_path"))
    return nodes.join(dim_side(dim), F.col(field) == F.col("_value"), "left").drop("_value")


def nest(nodes: DataFrame, meta: HierarchyMeta, order: Sequence[Column], size: int = PAGE_SIZE) -> DataFrame:
    """The whole tree, a row per parent and page: the children on that page as a JSON array.

    Every node is in exactly one row, and a row has at most ``size`` nodes, so no parent is ever gathered.
    Each root is a page of its own, with an empty ``parent_path``.
    """
    members = [F.col("node_id").alias(meta.id_key), *[F.col(k) for k in meta.keys() if k in nodes.columns], "has_children"]
    placed = pages(nodes, order, size)
    pair = F.struct("position", F.struct(*members).alias("node"))
    grouped = placed.groupBy("root", "parent_path", "page_no").agg(F.sort_array(F.collect_list(pair)).alias("_kids"))
    return grouped.select(
        "root", "parent_path", "page_no", F.to_json("_kids.node", {"ignoreNullFields": "false"}).alias("children")
    )
