"""Large groups, broadcast bounds, plans and skew."""

import re

from pyspark.sql import functions as F

from claimtree.operators import claims as ops, scale, tree, tree_order
from claimtree.plans.pushdown import plan_text
from claimtree.queries.fixtures import HIER_META, Inputs

SMALL = "/root/testdata/sf0.001"


def test_range_ranking_equals_window(spark):
    """A group that holds most rows gives the same positions when it is split over tasks."""
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 7 > 0, F.concat(F.lit("g"), (F.col("id") % 50).cast("string"))).alias("g"),
        (F.xxhash64("id") % 100).alias("v"), "id",
    )
    order = [F.col("v"), F.col("id")]
    by_window = scale.ranked(rows, ["g"], order, "position", "n").select("g", "v", "id", "position", F.col("n").cast("long"))
    by_range = scale.ranked(rows, ["g"], order, "position", "n", group_rows=100).select("g", "v", "id", "position", "n")
    assert by_window.exceptAll(by_range).count() == 0
    assert by_range.count() == 5000
    # No window over the hot group's rows: the only windows run over per-task counts.
    assert "Window" in plan_text(by_window) and by_range.where("g = 'hot'").agg(F.max("position")).first()[0] > 3000


def test_pages_and_preorder_with_large_groups(spark):
    nodes = tree.build_nodes(Inputs(spark, SMALL).hier, HIER_META).cache()
    order = tree_order.name_order(HIER_META)
    for make in (
        lambda n: tree_order.pages(nodes, order, group_rows=n),
        lambda n: tree_order.preorder(nodes, order, HIER_META.max_depth, group_rows=n),
    ):
        wide, split = make(10**9), make(5)
        split = split.select(*[F.col(c).cast(wide.schema[c].dataType) for c in wide.columns])
        assert wide.exceptAll(split).count() == 0 and wide.count() == split.count()


def test_broadcast_is_bounded(spark):
    small, large = spark.range(10).toDF("k"), spark.range(200_000).toDF("k")
    hinted = lambda df, n: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString() or bool(n)
    assert hinted(scale.dim_side(small), 0)
    assert not hinted(scale.dim_side(large, max_bytes=64_000), 0)


def test_product_estimates_are_counted(spark, tmp_path):
    """Two small tables joined look huge to the optimizer; the count shows they are not."""
    for name in ("a", "b"):
        spark.range(50_000).withColumn("t", F.lit("text" * 20)).write.parquet(str(tmp_path / name))
    a, b = (spark.read.parquet(str(tmp_path / n)) for n in ("a", "b"))
    joined = a.join(b.select("id"), "id").where("id < 100")
    assert scale.estimated_bytes(joined) > scale.BROADCAST_BYTES // 4
    assert "ResolvedHint" in scale.dim_side(joined)._jdf.queryExecution().analyzed().toString()


def test_large_dimension_is_shuffled_and_skew_is_split(spark):
    """With no broadcast a hot key still spreads: adaptive execution splits its partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        facts = spark.range(0, 60_000, 1, 16).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).alias("plan_id"), "id")
        plan = spark.range(60_000).select(F.col("id").alias("plan_id"), F.col("id").cast("string").alias("plan_name"))
        original, scale_bytes = ops.dim_side, 1000
        ops.dim_side = lambda df: scale.dim_side(df, scale_bytes)
        try:
            joined = ops.enrich_plan(facts, plan)
        finally:
            ops.dim_side = original
        assert joined.count() == 60_000
        joined.write.format("noop").mode("overwrite").save()
        rows = joined.collect()
        assert sum(r.plan_name == "1" for r in rows) == 40_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_distinct_counts_spread_a_hot_key(spark):
    """The first shuffle of the distinct counts is on the counted columns as well as the keys."""
    t = Inputs(spark, SMALL)
    text = plan_text(ops.monthly_physician_plan(t.claim, t.drug), "formatted")
    shuffles = re.findall(r"hashpartitioning\((physician_id.*)\)", text)
    assert any("patient_id#" in s and "claim_id#" in s for s in shuffles), shuffles


def test_page_limit_runs_before_the_shuffle(spark):
    nodes = tree.build_nodes(Inputs(spark, SMALL).hier, HIER_META)
    text = plan_text(tree_order.visible(nodes, tree_order.name_order(HIER_META)))
    assert "WindowGroupLimit" in text


def test_drug_ranking_is_a_top_k(spark):
    t = Inputs(spark, SMALL)
    assert "TakeOrderedAndProject" in plan_text(ops.drug_ranking(t.claim, t.drug))


def test_lookup_is_even_whatever_the_keys_are(spark):
    """Half of the keys are NULL and one key holds a third of the rows; nothing is broadcast or split at run time."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    key = F.when(F.col("id") % 6 < 3, None).when(F.col("id") % 6 < 5, 7).otherwise(F.col("id") % 5000)
    facts = spark.range(0, 300_000, 1, 8).select(key.alias("plan_id"), "id")
    plan = spark.range(4000).select(F.col("id").alias("plan_id"), F.col("id").cast("string").alias("plan_name"))
    plan = plan.unionByName(plan.where("plan_id % 100 = 7"))  # repeated keys, the hot one too
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        dim = plan.select(F.col("plan_id").alias("_plan"), "plan_name")
        plain = facts.join(dim, F.col("plan_id") == F.col("_plan"), "left")
        for heavy_rows in (2000, None):
            joined = scale.left_lookup(facts, dim, [("plan_id", "_plan")], lambda df: df, heavy_rows)
            assert joined.columns == plain.columns
            assert joined.exceptAll(plain).count() == 0 and plain.exceptAll(joined).count() == 0
        rows = scale.left_lookup(facts, dim, [("plan_id", "_plan")], lambda df: df, 2000)
        sizes = sorted(r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect())
        assert len(sizes) == 8 and sizes[-1] <= 1.5 * sizes[len(sizes) // 2]
        nulls = scale.left_lookup(facts.where("plan_id IS NULL OR plan_id <> 7"), dim, [("plan_id", "_plan")], lambda df: df, None)
        sizes = sorted(r["count"] for r in nulls.groupBy(F.spark_partition_id()).count().collect())
        assert len(sizes) == 8 and sizes[-1] <= 1.5 * sizes[len(sizes) // 2]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_lookup_plans_run_no_job(spark):
    facts, dim = spark.range(10).toDF("k"), spark.range(100).select(F.col("id").alias("d"))
    tracker, group = spark.sparkContext.statusTracker(), "lookup-plan"
    spark.sparkContext.setJobGroup(group, group)
    try:
        scale.left_lookup(facts, dim, [("k", "d")], lambda df: df)
        assert list(tracker.getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
