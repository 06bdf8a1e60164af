"""Distinct patients that add up: dense patient numbers and exact bitmaps that merge.

A summed distinct count counts a patient once per finer group. Here a table of groups carries, instead of a
count, the set of its patients as bitmaps of a fixed size; the set of any coarser group is the union of those of
its parts, so any roll-up counts exactly without reading the claims again. Numbers have no gaps, and patients of
one organisation have numbers near each other, so a group's set lies in few bitmaps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from claimtree.operators.claims import AFFILIATION_COLUMNS, enrich_affiliation, enrich_physician, valid_claims
from claimtree.operators.scale import numbered
from claimtree.functions.codes import month_bucket

# Columns of the stored sets: which numbers a bitmap is about, and the bitmap.
BUCKET, BITMAP = "patient_bucket", "patient_bitmap"


def claim_keys(claims: DataFrame, physician: DataFrame, affiliation: DataFrame, area: str | None = None) -> DataFrame:
    """Valid claims with their month, specialty and organisation ids: the columns that groups are made of."""
    rows = valid_claims(claims, area).withColumn("month", month_bucket(F.col("rx_fill_date")))
    return enrich_affiliation(enrich_physician(rows, physician), affiliation.select("npi", *AFFILIATION_COLUMNS[:4]))


def number_patients(rows: DataFrame, near: Sequence[str]) -> DataFrame:
    """(patient_id, patient_no): every patient once, numbered from 0 without gaps, NULL left out.

    Patients are in the order of the smallest hash of their ``near`` columns, so that those who share them have
    numbers close together. The sort is spread over all tasks and its result is stored.
    """
    known = rows.where(F.col("patient_id").isNotNull())
    patients = known.groupBy("patient_id").agg(F.min(F.xxhash64(*near)).alias("_near"))
    return numbered(patients, [F.col("_near"), F.col("patient_id")], "patient_no").drop("_near")


def patient_sets(rows: DataFrame, numbers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The groups' patients: ``keys``, ``patient_bucket`` and a bitmap of the numbers in that bucket.

    Rows are reduced to each group's different numbers before bitmaps are built, so no group is too large.
    """
    seen = rows.select(*keys, "patient_id").distinct()
    numbers = numbers.select(F.col("patient_id").alias("_patient"), "patient_no")
    met = seen.join(numbers, F.col("patient_id") == F.col("_patient"))
    groups = met.groupBy(*keys, F.bitmap_bucket_number("patient_no").alias(BUCKET))
    return groups.agg(F.bitmap_construct_agg(F.bitmap_bit_position("patient_no")).alias(BITMAP))


def merge_sets(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sets of coarser groups: ``keys`` are some of the columns that ``sets`` has, or none for all patients."""
    return sets.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))


def count_sets(sets: DataFrame, keys: Sequence[str], name: str = "patients") -> DataFrame:
    """Distinct patients of each group of ``keys``; groups without a patient have no row in ``sets``."""
    merged = merge_sets(sets, keys)
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count(BITMAP)).alias(name))
