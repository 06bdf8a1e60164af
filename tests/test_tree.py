"""Hierarchy operators against a plain recursive model on random trees, and their edge cases."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from claimtree.operators import metadata, tree, tree_order, tree_view
from claimtree.operators.metadata import HierarchyMeta, LevelColumn
from claimtree.plans.hierarchy import arrange, hierarchy_view, subtree_view
from claimtree.plans.pushdown import plan_text

DEPTH = 4
META = HierarchyMeta(
    tuple(
        LevelColumn(f"l{k}_{short}", k, key, key, dtype, "%s", "Money" if key == "Pay" else "-")
        for k in range(1, DEPTH + 1)
        for short, key, dtype in (
            ("id", "EntityId", "String"), ("name", "EntityName", "String"), ("rel", "RelationType", "String"),
            ("flag", "PrimaryFlag", "String"), ("pay", "Pay", "Integer"),
        )
    )
)


def order():
    return tree_order.name_order(META)


def random_wide(seed: int, rows: int = 60):
    rnd = random.Random(seed)
    out = []
    for i in range(rows):
        row = {"row_order": i}
        stop = rnd.choice([2, 3, 4, 4, 4])
        for k in range(1, DEPTH + 1):
            ident = f"E{rnd.randint(0, 1 if k == 1 else 4)}" if k <= stop else rnd.choice([None, "-", "NULL"])
            row |= {
                f"l{k}_id": f"L{k}{ident}" if ident and ident.startswith("E") else ident,
                f"l{k}_name": f"name {rnd.randint(0, 5)}", f"l{k}_rel": rnd.choice(["Owned", "Managed", "pre-Filled"]),
                f"l{k}_flag": rnd.choice(["TRUE", "FALSE", None]), f"l{k}_pay": str(rnd.randint(0, 50)),
            }
        out.append(row)
    return out


def to_df(spark, rows):
    columns = [f"l{k}_{c} string" for k in range(1, DEPTH + 1) for c in ("id", "name", "rel", "flag", "pay")]
    names = ["row_order", *[c.split()[0] for c in columns]]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ", ".join(["row_order long", *columns]))


class Model:
    """Node per path with first-seen attributes, held in nested dictionaries."""

    def __init__(self, rows):
        self.nodes: dict[tuple, dict] = {}
        self.edges: dict[tuple, dict] = {}
        for r in rows:
            path = ()
            for k in range(1, DEPTH + 1):
                ident = r[f"l{k}_id"]
                if ident is None or ident.lower() in ("null", "-"):
                    break
                path += (ident,)
                values = {"name": r[f"l{k}_name"], "rel": r[f"l{k}_rel"], "pay": int(r[f"l{k}_pay"])}
                self.nodes.setdefault(path, values)
                if k > 1 and "FILLED" not in r[f"l{k}_rel"].upper():
                    self.edges.setdefault((path[-1], path[-2]), {"flag": r[f"l{k}_flag"]})

    def children(self, path, kept=None):
        return sorted(
            (p for p in (kept or self.nodes) if len(p) == len(path) + 1 and p[: len(path)] == path),
            key=lambda p: (self.nodes[p]["name"], p),
        )

    def roots(self):
        return sorted(p for p in self.nodes if len(p) == 1)

    def bad(self):
        flags: dict = {}
        for (child, _), e in self.edges.items():
            flags[child] = flags.get(child, 0) + (e["flag"] == "TRUE")
        return {c for c, n in flags.items() if n > 1}

    def prune(self, rel):
        def keep(path):
            below = [k for c in self.children(path) for k in keep(c)]
            return [path, *below] if below or self.nodes[path]["rel"] in rel or len(path) == 1 else []

        return {p for r in self.roots() for p in keep(r)}

    def promote(self, rel):
        """Pairs of (node, parent it ends under), by original paths."""
        out = set()

        def walk(path, holder):
            kept = len(path) <= 2 or self.nodes[path]["rel"] in rel
            if kept and holder is not None:
                out.add((path, holder))
            for c in self.children(path):
                walk(c, path if kept else holder)

        for r in self.roots():
            walk(r, None)
        return out

    def total(self, path):
        return self.nodes[path]["pay"] + sum(self.total(c) for c in self.children(path))

    def preorder(self, root):
        out = []

        def walk(path):
            out.append(path)
            for c in self.children(path):
                walk(c)

        walk(root)
        return out

    def shown(self, pages=None):
        out = set()

        def walk(path):
            out.add(path)
            skip = ((pages or {}).get(path, 1) - 1) * tree_order.PAGE_SIZE
            for c in self.children(path)[skip : skip + tree_order.PAGE_SIZE]:
                walk(c)

        for r in self.roots():
            walk(r)
        return out


def paths(df):
    return {tuple(r[0]) for r in df.select("path").collect()}


@pytest.fixture(scope="module", params=[1, 2, 3])
def case(request, spark):
    rows = random_wide(request.param)
    wide = to_df(spark, rows).cache()
    return Model(rows), wide, tree.build_nodes(wide, META).cache(), tree.build_edges(wide, META).cache()


def test_nodes(case):
    model, _, nodes, _ = case
    got = {tuple(r.path): (r.EntityName, r.Pay, r.has_children) for r in nodes.collect()}
    assert got == {p: (v["name"], v["pay"], bool(model.children(p))) for p, v in model.nodes.items()}
    assert paths(tree.leaves(nodes)) == {p for p in model.nodes if not model.children(p)}
    assert paths(tree.has_subtree(nodes)) == {p for p in model.nodes if len(p) > 1 and model.children(p)}


def test_edges_and_conflicts(case):
    model, _, nodes, edges = case
    assert {(r.child_id, r.parent_id, r.PrimaryFlag) for r in edges.collect()} == {
        (*k, v["flag"]) for k, v in model.edges.items()
    }
    bad = tree.conflicting_children(edges, META)
    assert {r.child_id for r in bad.collect()} == model.bad()
    assert paths(tree.exclude(nodes, bad)) == {p for p in model.nodes if not set(p) & model.bad()}


def test_parents(case):
    model, _, nodes, edges = case
    parents: dict = {}
    for child, parent in model.edges:
        parents.setdefault(child, set()).add(parent)
    for r in tree.with_parents(nodes, edges).collect():
        expected = len(parents.get(r.node_id, ())) if r.depth > 1 else 0
        assert (r.n_parents, r.multi_parent) == (expected, expected > 1)
    some = next(iter(parents))
    rows = tree.parents_of(edges, META, some).collect()
    assert {r.parent_id for r in rows} == parents[some]
    for r in rows:
        assert r.is_primary_parent == (model.edges[some, r.parent_id]["flag"] in ("TRUE", None) and len(rows) > 1)


def test_prune(case):
    model, _, nodes, _ = case
    assert paths(tree.prune(nodes, "RelationType", ["Managed"])) == model.prune({"Managed"})
    pay = str(max(v["pay"] for v in model.nodes.values()))
    assert paths(tree.prune(nodes, "Pay", pay)) > set(model.roots())
    for none in (None, "All", "", [], ["none"]):
        assert tree.prune(nodes, "RelationType", none) is nodes


def test_promote(case):
    model, _, nodes, _ = case
    rows = tree.promote(nodes, "RelationType", ["Managed"], DEPTH).collect()
    unfold = lambda path: tuple(i for step in path for i in step.split(">"))
    got = {(unfold(r.path), unfold(r.parent_path)) for r in rows if r.depth > 1}
    assert got == model.promote({"Managed"})
    assert len({tuple(r.path) for r in rows}) == len(rows)
    every = {tuple(r.path) for r in rows}
    assert all(tuple(r.parent_path) in every for r in rows if r.depth > 1)


def test_rollup(case):
    model, _, nodes, _ = case
    got = {tuple(r.path): r.Pay for r in tree.rollup(nodes, ["Pay"]).collect()}
    assert got == {p: model.total(p) for p in model.nodes}


def test_preorder(case):
    model, _, nodes, _ = case
    rows = tree_order.preorder(nodes, order(), DEPTH).collect()
    for root in model.roots():
        mine = sorted((r.preorder, tuple(r.path)) for r in rows if r.root == root[0])
        assert mine == list(enumerate(model.preorder(root), 1))


def test_pages(case):
    model, _, nodes, _ = case
    for r in tree_order.pages(nodes, order()).collect():
        if r.depth > 1:
            kids = model.children(tuple(r.parent_path))
            at = kids.index(tuple(r.path)) + 1
            total = math.ceil(len(kids) / 3)
            page = math.ceil(at / 3)
            assert (r.position, r.page_no, r.total_pages) == (at, page, total)
            assert (r.has_prev, r.has_next) == (page > 1, page < total)


def test_shown_sets(case):
    model, _, nodes, _ = case
    assert paths(tree_order.to_depth(nodes, DEPTH, order())) == model.shown()
    assert paths(tree_order.visible(nodes, order())) == {p for p in model.shown() if len(p) <= 2}
    second = {p for p in model.nodes if len(p) == 2 and model.children(p[:1]).index(p) in (3, 4, 5)}
    assert paths(tree_order.visible(nodes, order(), page=2)) == second | set(model.roots())
    moved = {p: 2 for p in model.nodes if len(model.children(p)) > 3}
    assert moved and paths(tree_order.to_depth(nodes, DEPTH, order(), moved)) == model.shown(moved)


def test_located_pages_show_the_node(case):
    model, _, nodes, _ = case
    target = max(model.nodes, key=lambda p: (len(p), model.children(p[:-1]).index(p) if len(p) > 1 else 0))
    steps = tree_order.locate(nodes, list(target), order()).collect()
    moved = {target[: r.step - 1]: r.page_no for r in steps if r.step > 1}
    assert target in paths(tree_order.to_depth(nodes, len(target), order(), moved))


def test_first_seen(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, None)], "k string, n int, v string")
    assert {tuple(r) for r in tree.first_seen(rows, ["k"], ["n"]).collect()} == {("a", 1, "y"), ("b", 5, None)}


def test_nest(case):
    model, _, nodes, _ = case
    rows = tree_view.nest(nodes, META, order()).collect()
    roots, found = [], {}
    for r in rows:
        kids = [k["EntityId"] for k in json.loads(r.children)]
        assert 0 < len(kids) <= tree_order.PAGE_SIZE
        if r.parent_path:
            found.setdefault(tuple(r.parent_path), {})[r.page_no] = kids
        else:
            roots += kids
    assert sorted(roots) == sorted(r[0] for r in model.roots())
    assert found.keys() == {p for p in model.nodes if model.children(p)}
    for path, pages in found.items():
        assert [k for page in sorted(pages) for k in pages[page]] == [c[-1] for c in model.children(path)]


def test_late_pages_are_numbered_by_range(spark):
    rows = [(["r"], 1, "r", "r", [], "r", True)]
    rows += [(["r", f"n{i:05d}"], 2, "r", f"n{i:05d}", ["r"], f"n{i:05d}", False) for i in range(1500)]
    schema = "path array<string>, depth int, root string, node_id string, parent_path array<string>, EntityName string, has_children boolean"
    nodes = spark.createDataFrame(rows, schema)
    want = {"r", *(f"n{i:05d}" for i in range(1197, 1200))}
    assert {r.node_id for r in tree_order.visible(nodes, order(), page=400).collect()} == want
    late = tree_order.visible(nodes, order(), page={("r",): 400})
    assert {r.node_id for r in late.collect()} == want


def test_children_after_filters(case):
    model, _, nodes, _ = case
    top = tree.current_children(nodes.where(F.col("depth") <= 2))
    assert paths(top.where("has_children")) == {p for p in model.nodes if len(p) == 1 and model.children(p)}


def test_locate(case):
    model, _, nodes, _ = case
    target = max(model.nodes, key=len)
    rows = {r.step: (r.step_id, r.position, r.page_no) for r in tree_order.locate(nodes, list(target), order()).collect()}
    expected = {1: (target[0], 1, 1)}
    for k in range(2, len(target) + 1):
        at = model.children(target[: k - 1]).index(target[:k]) + 1
        expected[k] = (target[k - 1], at, math.ceil(at / 3))
    assert rows == expected


def test_subtree(case):
    model, _, nodes, _ = case
    top = next(p for p in model.nodes if len(p) == 2 and model.children(p))
    rows = tree.subtree(nodes, list(top)).collect()
    assert {tuple(r.path) for r in rows} == {p[1:] for p in model.nodes if p[:2] == top}
    assert {r.root for r in rows} == {top[1]}
    assert tree.subtree(nodes, ["absent"]).count() == 0


def test_legend_follows_depth_first_appearance(case):
    model, _, nodes, _ = case
    seen = []

    def walk(path):
        if model.nodes[path]["rel"] not in seen:
            seen.append(model.nodes[path]["rel"])
        for c in sorted(model.children(path), key=list(model.nodes).index):
            walk(c)

    for r in sorted(model.roots(), key=list(model.nodes).index):
        walk(r)
    rows = tree_view.relation_legend(nodes, META, ["#1", "#2"]).collect()
    got = {r.relation_type: (r.ordinal, r.colour) for r in rows}
    assert got == {rel: (n, f"#{n}" if n <= 2 else None) for n, rel in enumerate(seen, 1)}


def test_whole_view(case, spark):
    model, wide, _, _ = case
    config = {"filters": {"func_json": {"Rel": {"value": "RelationType", "parameters": "true"}},
                          "func_sort": {"Sort": {"value": "{x}", "parameters": "-"}}}}
    params = {"Rel": "Managed", "Sort": "Pay"}
    view = hierarchy_view(wide, META, config, params)
    assert view.count() > 0
    kept = [r for r in view.collect() if r.depth > 2]
    assert all(r.RelationType == "Managed" for r in kept)
    one = hierarchy_view(wide, META, {}, {}, root=model.nodes[model.roots()[0]]["name"])
    assert one.count() <= view.sparkSession.createDataFrame([], view.schema).count() + len(model.nodes)
    nodes = tree.build_nodes(wide, META)
    top = next(p for p in model.nodes if len(p) == 2 and model.children(p))
    sub = subtree_view(nodes, list(top), META, config, {"Rel": "All", "Sort": "none"})
    assert sub.count() == sum(p[:2] == top for p in model.nodes)


# --- edge cases


def test_level_filters(spark):
    wide = to_df(spark, random_wide(9))
    rows = wide.collect()
    count = lambda value, mode="any": tree.filter_levels(wide, META, "RelationType", value, mode).count()
    match = lambda r, words: [str(r[f"l{k}_rel"]).upper() in words for k in (2, 3, 4)]
    for none in (None, "All", "", "NONE", []):
        assert count(none) == len(rows)
    assert count("owned") == count(["Owned"]) == sum(any(match(r, ["OWNED"])) for r in rows)
    assert count(["owned", "MANAGED"], "all") == sum(all(match(r, ["OWNED", "MANAGED"])) for r in rows)
    flags = lambda r: all((r[f"l{k}_flag"] or "NULL") in ("TRUE", "NULL") for k in (2, 3, 4))
    assert tree.filter_primary(wide, META).count() == sum(map(flags, rows))
    assert tree.filter_levels(wide, META, "absent", "x").count() == 0
    assert tree.filter_root(wide, META, "").count() == len(rows)


def test_metric_order(spark):
    rows = [("R",), ("a", "High", 5.9), ("b", "medium", 5.1), ("c", "LOW", 7.0), ("d", "odd", None), ("e", "high", 6.0)]
    meta = HierarchyMeta((LevelColumn("x", 1, "EntityName", "", "String"), LevelColumn("t", 1, "Tier", "", "String"),
                          LevelColumn("v", 1, "Value", "", "Float")))
    data = [(["R"], 1, "R", "R", None, None)] + [(["R", n], 2, "R", n, t, v) for n, t, v in rows[1:]]
    nodes = spark.createDataFrame(data, "path array<string>, depth int, root string, EntityName string, Tier string, Value double")
    nodes = nodes.withColumn("parent_path", F.slice("path", F.lit(1), F.size("path") - 1))
    by = lambda metric: [r.EntityName for r in tree_order.sort_by_metric(nodes, meta, metric).where("depth = 2").orderBy("position").collect()]
    assert by("Tier") == ["a", "e", "b", "c", "d"]
    assert by("Value") == ["c", "e", "a", "b", "d"]
    assert by("EntityName") == ["a", "b", "c", "d", "e"]


def test_collated_order(spark):
    nodes = spark.createDataFrame([(["R", n], 2, "R", n, ["R"]) for n in ("b", "a", "B", "é")],
                                  "path array<string>, depth int, root string, EntityName string, parent_path array<string>")
    rows = tree_order.sort_by_name(nodes, META, "UNICODE").orderBy("position").collect()
    assert [r.EntityName for r in rows] == ["a", "b", "B", "é"]


def test_missing_middle_level_and_two_depths(spark):
    base = {f"l{k}_{c}": None for k in range(1, 5) for c in ("id", "name", "rel", "flag", "pay")}
    fill = lambda **ids: base | {f"{k}_rel": "Owned" for k in ids if k.startswith("l")} | {f"{k}_id": v for k, v in ids.items() if k != "row_order"} | {"row_order": ids["row_order"]}  # noqa: E731, E501
    rows = [fill(row_order=1, l1="A", l2=None, l3="C"), fill(row_order=2, l1="A", l2="X", l3="Y"), fill(row_order=3, l1="A", l2="Y")]
    wide = to_df(spark, rows)
    assert paths(tree.build_nodes(wide, META)) == {("A",), ("A", "X"), ("A", "X", "Y"), ("A", "Y")}
    edges = {(r.child_id, r.parent_id, r.level) for r in tree.build_edges(wide, META).collect()}
    assert edges == {("X", "A", 2), ("Y", "X", 3), ("Y", "A", 2)}


def test_details_reject_unknown_category(spark):
    nodes = tree.build_nodes(to_df(spark, random_wide(1)), META)
    with pytest.raises(ValueError, match="Invalid category"):
        tree_view.detail_rows(nodes, META, "Money|Unknown")
    rows = tree_view.detail_rows(nodes, META, "Money", "Pay").collect()
    assert rows and all(r.is_selected and r.field == "Pay" for r in rows)


def test_filters_need_parameters(spark):
    wide = to_df(spark, random_wide(1))
    config = {"filters": {"func_csv": {"Missing": {"value": "RelationType", "parameters": "-"}}}}
    with pytest.raises(ValueError, match="Cannot find filter Missing"):
        hierarchy_view(wide, META, config, {})


def test_settings_tables(spark):
    columns = spark.createDataFrame(
        [("l1_id", 1, "EntityId", "Id", "String", "%s", "-"), ("l2_pay", 2, "Pay", "Pay", "Integer", "$%s", "Money"),
         ("l1_pay", 1, "Pay", "Pay", "Integer", "$%s", "Money")],
        metadata.META_HEADERS,
    )
    config = spark.createDataFrame(
        [(1, "data", "column_name", "entity_id", "Id", "-", "-"), (2, "data", "column_name", "entity_id", "EntityId", "-", "-"),
         (3, "data", "format_value", "short_value", "Pay | Rate", "-", "-"), (4, "view", "-", "mode", "x", "p", "c")],
        ["n", *metadata.CONFIG_HEADERS],
    )
    settings = metadata.load_config(config, "n")
    assert settings["view"]["mode"] == {"value": "x", "parameters": "p", "content": "c"}
    meta = metadata.load_meta(columns, settings)
    assert (meta.id_key, meta.max_depth, meta.shorten) == ("EntityId", 2, ("Pay", "Rate"))
    assert meta.categories() == {"Money": ["Pay"]} and not meta.has_primary
    assert metadata.max_depth(columns).first()[0] == 2
    with pytest.raises(ValueError, match="not a settings table"):
        metadata.load_config(spark.range(20_000).select(*[F.col("id").cast("string").alias(h) for h in metadata.CONFIG_HEADERS]))


def test_resolve_sort():
    config = {"filters": {"func_sort": {"Metric": {"value": "{Metric}"}}}}
    assert metadata.resolve_sort(config, {"Metric": "Pay"}) == "Pay"
    assert metadata.resolve_sort(config, {"Metric": "None"}) is None
    assert metadata.resolve_sort({"filters": {"func_sort": {"M": {"value": "Fixed"}}}}, {"M": "x"}) == "Fixed"
    assert metadata.resolve_sort({}, {}) is None
    with pytest.raises(ValueError):
        metadata.resolve_sort(config, {})


def test_sort_column_and_shown_metric_with_two_settings():
    config = {"filters": {"func_sort": {"A": {"value": "Fixed"}, "B": {"value": "{B}"}}}}
    assert metadata.resolve_sort(config, {"A": "Pay", "B": "Rate"}) == "Rate"
    assert metadata.resolve_metric(config, {"A": "Pay", "B": "Rate"}) == "Rate"
    # A later none clears the metric and leaves the rows in their order.
    assert metadata.resolve_sort(config, {"A": "Pay", "B": "none"}) == "Fixed"
    assert metadata.resolve_metric(config, {"A": "Pay", "B": "none"}) is None
    assert metadata.resolve_metric({"filters": {"func_sort": {"A": {"value": "Fixed"}}}}, {"A": "Pay"}) == "Pay"
    assert metadata.resolve_metric({}, {}) is None


def test_view_without_rows_is_refused(spark):
    with pytest.raises(ValueError, match="Empty data"):
        hierarchy_view(to_df(spark, random_wide(2)), META, {}, {}, root="no such root")


def test_arrange_without_settings(spark):
    nodes = tree.build_nodes(to_df(spark, random_wide(2)), META)
    assert arrange(nodes, META, {}, {}).count() == nodes.count()


def test_nodes_and_edges_are_found_without_sorted_aggregates(spark):
    wide = to_df(spark, random_wide(3))
    for rows in (tree.build_nodes(wide, META), tree.build_edges(wide, META), tree.build_nodes(wide, META, attributes=[])):
        text = plan_text(rows)
        assert "HashAggregate" in text and "SortAggregate" not in text


def test_first_seen_of_null_keys_and_several_order_columns(spark):
    rows = [(None, 2, 1, "a"), (None, 1, 9, "b"), (None, 1, 3, "c"), ("x", 5, 5, None), ("x", 5, 4, "d")]
    df = spark.createDataFrame(rows, "k string, n int, m int, v string")
    found = tree.first_seen(df, ["k"], ["n", "m"])
    assert {tuple(r) for r in found.collect()} == {(None, 1, 3, "c"), ("x", 5, 4, "d")}
    assert "SortAggregate" not in plan_text(found)


def test_catalog_view_checks_its_sources_first(spark):
    from claimtree.plans.hierarchy import catalog_view

    wide = to_df(spark, random_wide(5))
    columns = [(c.name, str(c.level), c.key, c.text, c.dtype, c.format, c.category) for c in META.columns]
    config = [("filters", "func_sort", "Metric", "Pay", "-", "-")]
    wide.createOrReplaceTempView("cv_hier")
    spark.createDataFrame(columns, metadata.META_HEADERS).createOrReplaceTempView("cv_columns")
    spark.createDataFrame(config, metadata.CONFIG_HEADERS).createOrReplaceTempView("cv_config")
    names = {"columns": "cv_columns", "config": "cv_config", "hierarchy": "cv_hier"}
    try:
        with pytest.raises(ValueError, match="Cannot find images data"):
            catalog_view(spark, {**names, "images": "cv_none"}, {"Metric": "Pay"})
        with pytest.raises(ValueError, match="no source is named for config"):
            catalog_view(spark, {"columns": "cv_columns", "hierarchy": "cv_hier"}, {"Metric": "Pay"})
        view, meta, settings = catalog_view(spark, names, {"Metric": "Pay"})
        plain = hierarchy_view(wide, META, settings, {"Metric": "Pay"})
        key = lambda df: sorted((tuple(r.path), r.position) for r in df.collect())
        assert key(view) == key(plain) and meta.max_depth == DEPTH
    finally:
        for name in names.values():
            spark.catalog.dropTempView(name)
