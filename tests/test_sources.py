"""Sources, sinks and scan pruning."""

import pytest
from pyspark.sql import functions as F

from claimtree.operators import claims
from claimtree.plans import pushdown as lab
from claimtree.queries.fixtures import Inputs
from claimtree.queries.lab import CITY, YEAR, partitioned_sales
from claimtree.session import scratch_path, scratch_root
from claimtree.sources import sinks, tables

SMALL = "/root/testdata/sf0.001"


def test_csv_without_schema_is_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,Plan #\n007,x\n,y\n")
    rows = tables.clean_columns(tables.read_csv(spark, str(tmp_path / "a.csv")))
    assert rows.dtypes == [("id", "string"), ("Planno", "string")]
    assert [tuple(r) for r in rows.collect()] == [("007", "x"), (None, "y")]
    typed = tables.read_csv(spark, str(tmp_path / "a.csv"), "id long, name string")
    assert typed.first().id == 7


def test_clean_names(spark):
    assert tables.clean_name("A b#(c)-d:e.f") == "Abnocd_ef"
    with pytest.raises(ValueError, match="both become"):
        tables.clean_columns(spark.createDataFrame([(1, 2)], ["a b", "ab"]))


def test_resolve_column(spark):
    df = spark.createDataFrame([(1, 2)], ["Entity Name", "exact_name"])
    assert tables.resolve_column(df, "entity_name") == "Entity Name"
    assert tables.resolve_column(df, "exact_name") == "exact_name"
    with pytest.raises(ValueError):
        tables.resolve_column(df, "other")


def test_require(spark, tmp_path):
    spark.range(1).createOrReplaceTempView("known")
    tables.require_sources(spark, {"columns": "known"})
    with pytest.raises(ValueError, match="Cannot find config data"):
        tables.require_sources(spark, {"columns": "known", "config": "unknown"})
    with pytest.raises(ValueError, match="Empty data"):
        tables.require_nonempty(spark.range(0))
    assert tables.require_nonempty(spark.range(1)).count() == 1


def test_tables_and_stages(spark, tmp_path):
    df = spark.range(10).withColumn("p", F.col("id") % 2)
    sinks.save_table(df, "ext_numbers", str(tmp_path / "ext"))
    sinks.save_table(df.where("id < 4"), "ext_numbers", str(tmp_path / "ext"))
    assert tables.read_table(spark, "ext_numbers").count() == 4
    again = sinks.materialize(df, str(tmp_path / "stage"))
    assert again.count() == 10 and "FileScan" in again._jdf.queryExecution().executedPlan().toString()
    sinks.write_parquet(df, str(tmp_path / "parts"), "p")
    assert tables.read_partitioned(spark, str(tmp_path / "parts")).where("p = 1").count() == 5
    assert tables.read_parquet(spark, str(tmp_path / "stage")).count() == 10
    kept = df.persist()
    sinks.force(kept)
    assert kept.storageLevel.useMemory
    kept.unpersist()


def test_exports(spark, tmp_path):
    df = spark.range(0, 100, 1, 4)
    sinks.export_csv(df, str(tmp_path / "one"))
    assert len(list((tmp_path / "one").glob("part-*"))) == 1
    sinks.export_csv(df, str(tmp_path / "many"), files=None)
    assert len(list((tmp_path / "many").glob("part-*"))) > 1
    assert tables.read_csv(spark, str(tmp_path / "many")).count() == 100


def test_manifest_reads_no_content(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "a.bin").write_bytes(b"12345")
    (tmp_path / "in" / "deep" / "b.bin").write_bytes(b"1")
    rows = tables.copy_manifest(spark, str(tmp_path / "in"), "dest/prefix/")
    assert {(r.dest_key, r.length) for r in rows.collect()} == {("dest/prefix/a.bin", 5), ("dest/prefix/deep/b.bin", 1)}
    assert "content" not in lab.scan_filters(rows)["ReadSchema"][0]


def test_relocation_notices_a_difference(spark, tmp_path, monkeypatch):
    source, dest = str(tmp_path / "s"), str(tmp_path / "d")
    spark.range(50).write.parquet(source)
    assert tuple(sinks.relocate(spark, source, dest).first()) == (50, 50, True, True)
    real = sinks.write_parquet
    monkeypatch.setattr(sinks, "write_parquet", lambda df, *rest: real(df.withColumn("id", F.col("id") + 1), *rest))
    assert tuple(sinks.relocate(spark, source, dest + "2").first()) == (50, 50, True, False)


def test_relocation_keeps_partitions(spark, tmp_path):
    source, dest = str(tmp_path / "s"), str(tmp_path / "d")
    spark.range(30).withColumn("p", F.col("id") % 3).write.partitionBy("p").parquet(source)
    assert tuple(sinks.relocate(spark, source, dest).first()) == (30, 30, True, True)
    assert {x.name for x in (tmp_path / "d").glob("p=*")} == {"p=0", "p=1", "p=2"}


def test_reconciliation_does_not_depend_on_row_order(spark):
    rows = spark.range(20_000).select((F.rand(1) * 100).alias("x"))
    assert claims.reconcile(rows, rows.repartition(7), ["x"]).first()["diff"] == 0


def test_scratch_follows_the_session(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_what_reaches_the_scan(spark):
    t = Inputs(spark, SMALL)
    sales, parts = t.sales, partitioned_sales(t)
    city = f"EqualTo(city_id,{CITY})"
    lab.assert_scan(lab.full_scan(parts), absent=["EqualTo"])
    lab.assert_scan(lab.city_computed_year(parts, CITY, YEAR), pushed=[city], absent=["p_transacted_year"])
    lab.assert_scan(lab.city_year_range(parts, CITY, YEAR), pushed=[city, "GreaterThanOrEqual(transacted_at", "LessThan(transacted_at"])
    lab.assert_scan(lab.city_partition_year(parts, CITY, YEAR), pushed=[city], partition=[f"p_transacted_year#", f"= {YEAR}"])
    lab.assert_scan(lab.city_total(parts, CITY), pushed=[city])
    lab.assert_scan(lab.derived_total(parts), pushed=["IsNotNull(amount)"], absent=["GreaterThan"])
    cached = lab.cached_then_filtered(parts, CITY, YEAR)
    assert "InMemoryTableScan" in lab.plan_text(cached)
    lab.assert_scan(cached, absent=[city, "= 1997"])
    parts.unpersist()
    with pytest.raises(AssertionError):
        lab.assert_scan(lab.full_scan(sales), pushed=["EqualTo"])
    same = lab.city_partition_year(parts, CITY, YEAR)
    assert same.exceptAll(lab.city_computed_year(parts, CITY, YEAR).select(*same.columns)).count() == 0


def test_narrow_reads(spark):
    """A report that needs three claim columns reads no more of the claim files."""
    from claimtree.operators import claims as ops

    t = Inputs(spark, SMALL)
    schemas = lab.scan_filters(ops.claims_per_plan(t.claim))["ReadSchema"]
    assert not any("l_extendedprice" in s or "l_discount" in s for s in schemas)
