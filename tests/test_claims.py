"""Edge cases of the claims operators on small hand-made tables."""

import pytest
from pyspark.sql import functions as F

from claimtree.functions.codes import month_bucket, pad_code
from claimtree.operators import claims as ops
from claimtree.plans.attribution import ClaimSources, Cohort, ClaimRun, publish
from claimtree.queries import claims as registered
from claimtree.queries.fixtures import Inputs

SMALL = "/root/testdata/sf0.001"


def org_rows(spark):
    schema = """hospital_id int, hospital_name string, hospital_type string, hospital_network_id int, hospital_network_name string,
      pg_id int, pg_name string, physician_group_type string, pg_network_id int, pg_network_name string,
      `340b_id_number` string, `340b_flag` string, plan_id int, claim_count long, patient_pay_norm double, plan_pay_norm double"""
    hosp, none5 = (1, "H", "acute", 11, "HN"), (None,) * 5
    group = (2, "G", "multi", 22, "GN")
    return spark.createDataFrame(
        [
            (*hosp, *none5, "H1", "yes", 1, 10, 4.0, 6.0),
            (*none5, *group, None, None, 2, 20, 8.0, 2.0),
            (*hosp, *group, "H1", "yes", 3, 5, 3.0, 1.0),
            (*none5, *none5, None, None, 4, 7, 1.0, 1.0),
        ],
        schema,
    )


def test_split_cases(spark):
    rows = ops.claims_split(org_rows(spark)).collect()
    got = {(r.plan_id, r.child_type, r.child_id, r.parent_id, r["340b_flag"], r.claim_count) for r in rows}
    assert got == {
        (1, "Hospital", 1, 11, "yes", 10.0),
        (2, "PG", 2, 22, "Null", 20.0),
        (3, "PG", 2, 22, "Null", 2.5),
        (3, "Hospital", 1, 11, "yes", 2.5),
        (4, "Null", None, None, None, 7.0),
    }


def test_split_conserves(spark):
    rows = org_rows(spark)
    for r in ops.reconcile(rows, ops.claims_split(rows), ops.SPLIT_MEASURES).collect():
        assert r.diff == 0


def test_split_reads_its_input_once(spark):
    t = Inputs(spark, SMALL)
    text = ops.claims_split(t.table("nation").select(  # any file scan will do
        *[F.col("n_nationkey").alias(c) for c in ("hospital_id", "pg_id", "hospital_network_id", "pg_network_id")],
        *[F.col("n_name").alias(c) for c in ("hospital_name", "pg_name", "hospital_type", "physician_group_type",
          "hospital_network_name", "pg_network_name", "340b_id_number", "340b_flag")],
        *[F.lit(1).alias(c) for c in ops.SPLIT_MEASURES],
    ))._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Exchange" not in text


def test_month_bucket(spark):
    rows = spark.createDataFrame([("03-05-2019",), ("2019-03-05",), ("3-5-2019",), (None,)], "d string")
    got = [r[0] for r in rows.select(month_bucket(F.col("d"))).collect()]
    assert got == ["2019-03", None, None, None]


def test_pad_code(spark):
    rows = spark.createDataFrame([("12",), ("123456789012",), ("12345678901",)], "c string")
    assert [r[0] for r in rows.select(pad_code(F.col("c"))).collect()] == ["00000000012", "12345678901", "12345678901"]


def claims(spark):
    return spark.createDataFrame(
        [
            (1, 100, 1, 7, 1, "01-02-2019", 30, 10.0, 20.0, 1, "Y"),
            (1, 100, 1, 7, 1, "01-09-2019", 15, 10.0, 20.0, 1, "Y"),
            (2, 100, 1, 7, 1, "01-09-2019", 10, 10.0, 20.0, 1, "Y"),
            (3, 101, 1, 7, 1, "01-09-2019", 0, 10.0, 20.0, 1, "Y"),
            (4, 101, 1, 7, 1, "01-09-2019", None, 10.0, 20.0, 1, "Y"),
            (5, 101, 1, 7, 1, "01-09-2019", 10, 10.0, 20.0, 0, "Y"),
            (6, 101, 1, 7, 1, "01-09-2019", 10, 10.0, 20.0, 1, "N"),
            (7, 102, 1, 8, 1, "02-09-2019", 30, 1.0, 2.0, 1, "Y"),
        ],
        """claim_id long, patient_id long, physician_id long, drug_id long, plan_id long, rx_fill_date string,
        days_supply long, patient_pay double, plan_pay double, claim_status int, final_claim_ind string""",
    )


def drug(spark, *rows):
    return spark.createDataFrame(list(rows), "drug_id long, ndc11 string, drug_name string, drug_generic_name string, bgi string")


def test_monthly(spark):
    names = drug(spark, (7, "00000000007", "Remi X", "g", "B"), (7, "00000000007", "Remi X", "other", "B"))
    inner = ops.monthly_physician_plan(claims(spark), names).collect()
    assert [(r.month, r.claim_count, r.patient_count) for r in inner] == [("2019-01", 2, 1)]
    assert inner[0].patient_pay_norm == pytest.approx(10 + 20 + 30)
    assert inner[0].plan_pay_norm == pytest.approx(20 + 40 + 60)
    left = ops.monthly_physician_plan(claims(spark), names, "left")
    assert {(r.month, r.drug_name) for r in left.collect()} == {("2019-01", "Remi X"), ("2019-02", None)}


def test_cohort_fan_out(spark):
    names = drug(spark, (7, "00000000007", "REMI x", "g", "B"), (7, "00000000007", "remi y", "g", "B"))
    areas = spark.createDataFrame([("7", "A"), ("7", "B"), ("9", "A")], "ndc11 string, therapy_area string")
    assert ops.cohort_by_name(claims(spark), names, ["remi"]).count() == 14
    assert ops.cohort_by_name(claims(spark), names, ["remi"], dedup=True).count() == 7
    assert ops.cohort_by_area(claims(spark), names, areas, ["A", "B"]).count() == 28
    assert ops.cohort_by_area(claims(spark), names, areas, ["A", "B"], dedup=True).count() == 14
    assert [tuple(r) for r in ops.dim_fanout(names, ["drug_id"]).collect()] == [(7, 2)]


def test_unmatched_keys_come_from_the_dimension(spark):
    facts = spark.createDataFrame([(1, 5), (9, 6), (8, 7)], "plan_id long, physician_id long")
    plan = spark.createDataFrame([(1, "one")], "plan_id long, plan_name string")
    docs = spark.createDataFrame([(5, "n5", "s"), (6, "n6", "s"), (7, None, "s")], "physician_id long, npi string, specialty_description string")
    profile = spark.createDataFrame([("n5", 1), (None, 2)], "npi string, hospital_id int")
    rows = ops.enrich_affiliation(ops.enrich_physician(ops.enrich_plan(facts, plan), docs), profile)
    got = {(r.physician_id, r.plan_id, r.npi, r.hospital_id) for r in rows.collect()}
    assert got == {(5, 1, "n5", 1), (6, None, None, None), (7, None, None, None)}


def test_narrow_aggregation_equals_the_long_way(spark):
    """Ids first, names later, also with duplicated dimension rows and unmatched plans."""
    t = Inputs(spark, SMALL)
    plan = t.plan.unionByName(t.plan.where("plan_id % 7 = 0"))
    affiliation = t.affiliation.unionByName(t.affiliation.where("npi like '%1'").withColumn("pg_id", F.lit(103)))
    monthly = registered.monthly(t).cache()
    profile = ops.affiliation_profile(affiliation, t.hospital, t.physician_group)
    long_way = ops.claims_by_org(
        ops.enrich_affiliation(ops.enrich_physician(ops.enrich_plan(monthly, plan), t.physician), profile)
    )
    short_way = ops.org_claims(monthly, plan, t.physician, affiliation, t.hospital, t.physician_group)
    short_way = short_way.select(*long_way.columns)
    assert long_way.count() == short_way.count() > 0
    assert long_way.exceptAll(short_way).count() == 0


def test_group_by_measures_keeps_totals(spark):
    t = Inputs(spark, SMALL)
    rows = registered.enriched(t).cache()
    plain, split_up = ops.claims_by_npi(rows), ops.claims_by_npi(rows, group_measures=True)
    assert split_up.count() >= plain.count()
    a, b = (ops.stage_total(d, ops.MEASURES).first() for d in (plain, split_up))
    assert a == b


def test_run_with_stage_files_and_publishing(spark, tmp_path):
    t = Inputs(spark, SMALL)
    src = registered.sources(t)
    lazy = ClaimRun(src, Cohort(patterns=["ring"]), 1999, exact_cents=True)
    stored = ClaimRun(src, Cohort(patterns=["ring"]), 1999, str(tmp_path / "run"), exact_cents=True)
    for (name, a), (_, b) in zip(lazy.items(), stored.items()):
        assert a.columns == b.columns and a.count() == b.count(), name
    assert stored.yearly.count() > 0
    total = lambda df: ops.stage_total(df, ["claim_count"]).first()[0]
    assert total(stored.by_npi) == total(stored.by_org) == total(stored.attributed)
    publish(stored, {"yearly": ("claims_yearly", str(tmp_path / "yearly"))}, {"crosstab": str(tmp_path / "crosstab")})
    assert spark.table("claims_yearly").count() == stored.yearly.count()
    assert len(list((tmp_path / "crosstab").glob("part-*.csv"))) == 1


def test_published_stages_that_grow_are_not_one_file(spark, tmp_path, monkeypatch):
    asked = {}
    monkeypatch.setattr("claimtree.plans.attribution.export_csv", lambda df, path, files=1: asked.update({path: files}))
    run = ClaimRun(registered.sources(Inputs(spark, SMALL)), Cohort(patterns=["ring"]), 1999)
    publish(run, {}, {s: s for s in ("split", "attributed", "by_org", "crosstab")}, files={"by_org": 7})
    assert asked == {"split": None, "attributed": None, "by_org": 7, "crosstab": 1}


def test_crosstab_pivot(spark):
    t = Inputs(spark, SMALL)
    rows = ops.claims_split(registered.by_org(t))
    wide = ops.facility_plan_crosstab(rows, ["ASIA", "EUROPE"])
    assert {"ASIA", "EUROPE"} <= set(wide.columns)


def test_sources_are_parameters():
    assert {"slices", "ndc_map", "product_class"} <= set(ClaimSources.__dataclass_fields__)
