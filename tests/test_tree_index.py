"""Interval labels and the trigram index against the forms that read every node."""

import random

import pytest
from pyspark.sql import functions as F

from claimtree.operators import tree, tree_index, tree_order, tree_view
from claimtree.plans import pushdown as lab
from claimtree.queries.fixtures import HIER_META as META, Inputs

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def nodes(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("nodes") / "n")
    tree.build_nodes(Inputs(spark, SMALL).hier, META, attributes=["EntityName", "Balance"]).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def labelled(nodes, tmp_path_factory):
    rows = tree_index.label_intervals(nodes, tree_order.name_order(META), META.max_depth)
    return tree_index.store_intervals(rows, str(tmp_path_factory.mktemp("intervals")))


def keyed(df):
    return sorted((tuple(r.path), r.depth, r.root, r.node_id, r.EntityName, r.Balance) for r in df.collect())


def test_labels_nest(labelled):
    """A node's numbers hold exactly those of the nodes below it."""
    rows = [(tuple(r.path), r.preorder, r.last) for r in labelled.collect()]
    for root in {p[0] for p, *_ in rows}:
        own = sorted((low, high, p) for p, low, high in rows if p[0] == root)
        assert [low for low, *_ in own] == list(range(1, len(own) + 1))
        for low, high, path in random.Random(1).sample(own, min(60, len(own))):
            assert [p for _, _, p in own[low - 1 : high]] == [p for *_, p in own if p[: len(path)] == path]


def test_subtree_is_a_range(nodes, labelled):
    paths = [r.path for r in nodes.orderBy("depth", "path").limit(400).collect()]
    for path in [paths[0], *random.Random(2).sample(paths, 5), ["AMERICA"], ["no such"], [*paths[0], "no such"]]:
        assert keyed(tree_index.subtree_by_interval(labelled, path)) == keyed(tree.subtree(nodes, path)), path
    found = tree_index.subtree_by_interval(labelled, paths[0])
    lab.assert_scan(found, pushed=["EqualTo(root,", "GreaterThanOrEqual(preorder,", "LessThanOrEqual(preorder,"])


@pytest.fixture(scope="module")
def index(spark, nodes, tmp_path_factory):
    extra = spark.createDataFrame(
        [(["x", k], 2, "x", k, ["x"], name) for k, name in (
            ("1", "Éclair Straße"), ("2", "東京タワー 東京"), ("3", "ab"), ("4", None), ("5", "Some (Filled) name"), ("6", "aaaaaa"), ("7", "İstanbul"), ("8", ""),
        )], "path array<string>, depth int, root string, node_id string, parent_path array<string>, EntityName string",
    )
    rows = nodes.unionByName(extra, allowMissingColumns=True).select("path", "node_id", "EntityName")
    return rows, tree_index.build_search_index(rows, META, str(tmp_path_factory.mktemp("trigrams")))


@pytest.mark.parametrize(
    "term", ["omer#0000", " URGENT ", "éclair", "STRASSE", "straße", "東京タ", "東京", "aaa", "ab", "", None, "xyz", "(Filled)", "some", "istanbul", "i̇st", "order 1", "r 1", "%", "a_a", "aaaaaaa"]
)
def test_search_by_index(index, term):
    rows, stored = index
    plain = tree_view.search(rows, META, term)
    found = tree_index.search_index(*stored, META, term)
    assert sorted(map(tuple, (r.path for r in found.collect()))) == sorted(map(tuple, (r.path for r in plain.collect())))


def test_a_search_reads_one_gram(index):
    _, stored = index
    found = tree_index.search_index(*stored, META, "omer#00000")
    lab.assert_scan(found, pushed=["EqualTo(gram,"])
    assert stored[0].where(F.col("gram") == "ome").count() > 0


def test_an_index_stores_columns_once(index):
    """Postings hold numbers only, once per gram, so that a node's other columns do not grow with its name."""
    rows, (postings, counts, numbered) = index
    assert postings.columns == ["gram", tree_index.NUMBER]
    named = {r[tree_index.NUMBER]: r.EntityName for r in numbered.collect()}
    can_be_found = [r.EntityName for r in rows.collect() if len(r.EntityName or "") >= 3 and "(Filled)" not in r.EntityName]
    assert sorted(named.values()) == sorted(can_be_found)
    held = sorted((r.gram, r[tree_index.NUMBER]) for r in postings.collect())
    # Spark lower-cases the dotted capital I to two characters, as Python does.
    assert held == sorted((g, k) for k, n in named.items() for g in {n.lower()[i : i + 3] for i in range(len(n.lower()) - 2)})
    assert sum(r.n for r in counts.collect()) == len(held)


def test_a_search_reads_stretches_of_nodes(index):
    _, stored = index
    found = tree_index.search_index(*stored, META, "東京タ")
    lab.assert_scan(found, pushed=[f"GreaterThanOrEqual({tree_index.NUMBER},", f"LessThanOrEqual({tree_index.NUMBER},"])


def test_stretches_cover_all_numbers(spark, monkeypatch):
    numbers = [(f << 33) + k for f in (0, 1, 2, 5, 9) for k in range(f + 1, 2 * f + 3)]
    met = spark.createDataFrame([(n,) for n in numbers], "_met long")
    assert tree_index.stretches(met) == [(1, 2), ((1 << 33) + 2, (1 << 33) + 4), ((2 << 33) + 3, (2 << 33) + 6), ((5 << 33) + 6, (5 << 33) + 12), ((9 << 33) + 10, (9 << 33) + 20)]
    monkeypatch.setattr(tree_index, "STRETCHES", 2)
    assert tree_index.stretches(met) == [(1, (2 << 33) + 6), ((5 << 33) + 6, (9 << 33) + 20)]
