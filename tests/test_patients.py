"""Patient sets: numbers without gaps, unions that count exactly at any level, plans that never count rows again."""

from pyspark.sql import functions as F

from claimtree.operators import patients
from claimtree.plans.pushdown import plan_text


def facts(spark):
    """70,000 patients over several bitmaps, one key with most rows, repeated rows, NULL patients and keys."""
    rows = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 11 == 0, None).otherwise(F.concat(F.lit("p"), F.pmod(F.xxhash64("id"), F.lit(70_000)))).alias("patient_id"),
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 7 > 0, F.concat(F.lit("n"), F.col("id") % 40)).alias("network"),
        F.concat(F.lit("2020-0"), F.col("id") % 5 + 1).alias("month"),
    )
    return rows.unionByName(rows.limit(500))


def test_numbers_have_no_gaps(spark):
    rows = facts(spark)
    numbers = patients.number_patients(rows, ["network"])
    n = rows.select("patient_id").where("patient_id IS NOT NULL").distinct().count()
    found = numbers.agg(F.min("patient_no"), F.max("patient_no"), F.count_distinct("patient_no"), F.count_distinct("patient_id"), F.count("*")).first()
    assert tuple(found) == (0, n - 1, n, n, n)


def test_any_level_counts_exactly(spark):
    rows = facts(spark)
    numbers = patients.number_patients(rows, ["network"])
    sets = patients.patient_sets(rows, numbers, ["network", "month"]).cache()
    merged = patients.merge_sets(sets, ["month"])
    for stage, keys in ((sets, ["network", "month"]), (sets, ["network"]), (sets, ["month"]), (sets, []), (merged, ["month"]), (merged, [])):
        wanted = rows.groupBy(*keys).agg(F.count_distinct("patient_id").alias("patients"))
        found = patients.count_sets(stage, keys)
        assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect())), keys


def test_empty_claims(spark):
    rows = facts(spark).where("false")
    sets = patients.patient_sets(rows, patients.number_patients(rows, ["network"]), ["network"])
    assert patients.count_sets(sets, ["network"]).count() == 0


def test_a_roll_up_reads_only_the_sets(spark, tmp_path):
    rows = facts(spark)
    path = str(tmp_path / "sets")
    patients.patient_sets(rows, patients.number_patients(rows, ["network"]), ["network", "month"]).write.parquet(path)
    text = plan_text(patients.count_sets(spark.read.parquet(path), ["network"]))
    assert text.count("Scan parquet") == 2 and "patient_id" not in text  # the line of the tree and its details
