"""Registered queries of the claims side: name -> (Spark query, checking SQL or None)."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimtree.functions.codes import month_bucket, pad_code
from claimtree.operators import claims as ops, patients
from claimtree.plans import stages
from claimtree.plans.attribution import ClaimSources, Cohort, ClaimRun
from claimtree.queries.fixtures import Inputs
from claimtree.queries.oracle import check
from claimtree.queries.registry import Registry
from claimtree.session import scratch_path
from claimtree.sources import sinks, tables

PATTERNS = ["ring", "Bolt"]
AREAS = ["SMALL", "ECONOMY", "PROMO"]
AREA = "ECONOMY"
YEAR = 1999

CLAIM_COLUMNS = [
    "claim_id", "patient_id", "physician_id", "drug_id", "plan_id", "rx_fill_date", "days_supply",
    "patient_pay", "plan_pay", "claim_status", "final_claim_ind", "slice",
]
QUERIES = Registry(check)
query = QUERIES.query


def cohort(t: Inputs):
    return ops.cohort_by_name(t.claim, t.drug, PATTERNS)


def area_cohort(t: Inputs):
    return ops.cohort_by_area(t.claim, t.drug, t.ndc_map, AREAS)


def monthly(t: Inputs):
    return ops.monthly_physician_plan(cohort(t), t.drug, exact_cents=True)


def enriched(t: Inputs):
    profile = ops.affiliation_profile(t.affiliation, t.hospital, t.physician_group)
    return ops.enrich_affiliation(ops.enrich_physician(ops.enrich_plan(monthly(t), t.plan), t.physician), profile)


def by_org(t: Inputs):
    return ops.org_claims(monthly(t), t.plan, t.physician, t.affiliation, t.hospital, t.physician_group)


def attributed(t: Inputs):
    return ops.enrich_entity(ops.enrich_channel(ops.claims_split(by_org(t)), t.plan_channel), t.entity_type)


def sources(t: Inputs, with_class: bool = False) -> ClaimSources:
    # The three slices are one table here, so it is scanned once.
    return ClaimSources(
        [t.claim],
        t.drug, t.plan, t.physician, t.affiliation, t.hospital, t.physician_group, t.plan_channel, t.entity_type,
        t.ndc_map, t.product_class if with_class else None,
    )


# --- cohort and claim rows


@query("cohort_by_name", f"SELECT {', '.join(CLAIM_COLUMNS)} FROM p01")
def _(t):
    return cohort(t).select(*CLAIM_COLUMNS)


@query("cohort_by_area", f"SELECT {', '.join(CLAIM_COLUMNS)}, therapy_area FROM p01_area")
def _(t):
    return area_cohort(t).select(*CLAIM_COLUMNS, "therapy_area")


@query("cohort_union", f"SELECT {', '.join(CLAIM_COLUMNS)} FROM p01")
def _(t):
    drug = t.drug
    slices = [ops.cohort_by_name(s, drug, PATTERNS).select(*CLAIM_COLUMNS) for s in sources(t).slices]
    return ops.cohort_union(*slices)


@query("valid_claims", f"SELECT {', '.join(CLAIM_COLUMNS)}, therapy_area FROM p01_area WHERE {{valid}} AND therapy_area = '{AREA}'")
def _(t):
    return ops.valid_claims(area_cohort(t), AREA).select(*CLAIM_COLUMNS, "therapy_area")


@query("normalize_pay", "SELECT claim_id, slice, {norm} FROM fx_claim WHERE {valid}")
def _(t):
    rows = ops.normalize_pay(ops.valid_claims(t.claim), exact_cents=True)
    return rows.select("claim_id", "slice", *ops.PAYS)


@query(
    "normalize_pay_double",
    "SELECT claim_id, slice, patient_pay::DOUBLE / days_supply * 30 AS patient_pay_norm, plan_pay::DOUBLE / days_supply * 30 AS plan_pay_norm FROM fx_claim WHERE {valid}",
)
def _(t):
    return ops.normalize_pay(ops.valid_claims(t.claim)).select("claim_id", "slice", *ops.PAYS)


@query(
    "month_bucket",
    """SELECT claim_id, fill_text, strftime(try_strptime(fill_text, '%m-%d-%Y'), '%Y-%m') AS month FROM (
       SELECT claim_id, CASE WHEN claim_id % 7 = 0 THEN 'n/a' WHEN claim_id % 11 = 0 THEN NULL ELSE rx_fill_date END AS fill_text
       FROM fx_claim)""",
)
def _(t):
    text = F.when(F.col("claim_id") % 7 == 0, "n/a").when(F.col("claim_id") % 11 != 0, F.col("rx_fill_date"))
    return t.claim.select("claim_id", text.alias("fill_text"), month_bucket(text).alias("month"))


@query(
    "ndc_pad",
    """SELECT drug_id, lpad(code, 11, '0') AS ndc11 FROM (
       SELECT drug_id, CASE WHEN drug_id % 5 = 0 THEN concat(drug_id, '987654321012') ELSE concat('', drug_id) END AS code
       FROM fx_drug)""",
)
def _(t):
    own = F.col("drug_id").cast("string")
    code = F.when(F.col("drug_id") % 5 == 0, F.concat(own, F.lit("987654321012"))).otherwise(own)
    return t.drug.select("drug_id", pad_code(code).alias("ndc11"))


# --- aggregation and enrichment


@query("monthly_physician_plan", "SELECT * FROM p02")
def _(t):
    return monthly(t)


@query("monthly_physician_plan_left", "SELECT * FROM p02_area")
def _(t):
    # Every third drug gets a key that no claim has, so that the left join meets claims without a drug.
    drug = t.drug.withColumn("drug_id", F.when(F.col("drug_id") % 3 == 0, -1 - F.col("drug_id")).otherwise(F.col("drug_id")))
    return ops.monthly_physician_plan(area_cohort(t), drug, "left", AREA, exact_cents=True)


@query("enrich_plan", "SELECT physician_id, month, drug_name, bgi, claim_count, patient_count, patient_pay_norm, plan_pay_norm, {plan} FROM p02_plan")
def _(t):
    return ops.enrich_plan(monthly(t), t.plan)


@query("enrich_physician", """SELECT p02.*, npi, specialty_description FROM p02
       LEFT JOIN (SELECT DISTINCT physician_id, npi, specialty_description FROM fx_physician) b USING (physician_id)""")  # fmt: skip
def _(t):
    return ops.enrich_physician(monthly(t), t.physician)


@query("affiliation_profile", "SELECT npi, {affiliation} FROM profile")
def _(t):
    return ops.affiliation_profile(t.affiliation, t.hospital, t.physician_group)


@query("enrich_affiliation", "SELECT * FROM p03_rows")
def _(t):
    return enriched(t)


@query("enrich_class", """SELECT p02.*, overall_class, initial_class, drug_class FROM p02
       LEFT JOIN fx_product_class c ON c.drug_name = p02.drug_name""")  # fmt: skip
def _(t):
    return ops.enrich_class(monthly(t), t.product_class)


@query("claims_by_npi", "SELECT npi, {dims}, {sums} FROM p03_rows GROUP BY ALL")
def _(t):
    return ops.claims_by_npi(enriched(t))


@query(
    "claims_by_npi_and_counts",
    """SELECT npi, month, drug_name, sum(claim_count)::BIGINT AS claim_count, sum(patient_count)::BIGINT AS patient_count,
       sum(patient_pay_norm)::BIGINT AS patient_pay_norm, sum(plan_pay_norm)::BIGINT AS plan_pay_norm
       FROM p03_rows r GROUP BY npi, month, drug_name, r.claim_count, r.patient_count""",
)
def _(t):
    return ops.claims_by_npi(enriched(t), ["npi", "month", "drug_name"], group_measures=True)


@query("claims_by_org", "SELECT * FROM p04")
def _(t):
    return by_org(t)


@query(
    "affiliation_case",
    """SELECT CASE WHEN hospital_id IS NOT NULL AND pg_id IS NOT NULL THEN 'both' WHEN hospital_id IS NOT NULL THEN 'hospital_only'
       WHEN pg_id IS NOT NULL THEN 'group_only' ELSE 'neither' END AS affiliation_case, count(*) AS n,
       sum(claim_count)::BIGINT AS claim_count FROM p04 GROUP BY 1""",
)
def _(t):
    rows = by_org(t)
    case = ops.affiliation_case(rows).alias("affiliation_case")
    return rows.groupBy(case).agg(F.count("*").alias("n"), F.sum("claim_count").alias("claim_count"))


@query("claims_split", "SELECT * FROM p04_split")
def _(t):
    return ops.claims_split(by_org(t))


@query("enrich_channel", """SELECT a.*, plan_channel_type FROM p04_split a LEFT JOIN fx_plan_channel c
       USING (plan_type_description, plan_subtype, payment_type)""")  # fmt: skip
def _(t):
    return ops.enrich_channel(ops.claims_split(by_org(t)), t.plan_channel)


@query("enrich_entity", "SELECT a.*, c.* FROM p04_split a LEFT JOIN fx_entity_type c ON a.child_id = c.final_child")
def _(t):
    return ops.enrich_entity(ops.claims_split(by_org(t)), t.entity_type)


@query("rollup_year", f"""SELECT * EXCLUDE (month, claim_count, patient_pay_norm, plan_pay_norm), sum(claim_count) AS claim_count,
       sum(patient_pay_norm) AS patient_pay_norm, sum(plan_pay_norm) AS plan_pay_norm
       FROM p04_full WHERE month LIKE '{YEAR}-%' GROUP BY ALL""")  # fmt: skip
def _(t):
    return ops.rollup_year(attributed(t), YEAR)


# --- whole runs


@query("claims_attribution_by_name", "SELECT * FROM p04_full")
def _(t):
    return ClaimRun(sources(t), Cohort(patterns=PATTERNS), YEAR, exact_cents=True).attributed


@query("claims_attribution_by_area", "SELECT * FROM p04_area_full")
def _(t):
    run = ClaimRun(sources(t, True), Cohort(areas=AREAS, area=AREA), YEAR, exact_cents=True)
    return run.attributed


# --- reports and checks


@query(
    "facility_plan_crosstab",
    """SELECT child_subtype, plan_type_description, plan_subtype, payment_type, sum(claim_count) AS claim_count
       FROM p04_split GROUP BY ALL""",
)
def _(t):
    return ops.facility_plan_crosstab(ops.claims_split(by_org(t)))


@query(
    "claims_per_plan",
    "SELECT plan_id, count(DISTINCT claim_id) AS claim_count FROM p01 WHERE claim_status = 1 AND final_claim_ind = 'Y' GROUP BY 1",
)
def _(t):
    return ops.claims_per_plan(cohort(t))


@query(
    "plan_mix",
    """SELECT kind.* EXCLUDE (plan_id), count(claim_id) AS claim_count
       FROM (SELECT plan_id, claim_id FROM p01 WHERE claim_status = 1 AND final_claim_ind = 'Y' GROUP BY ALL) pair
       LEFT JOIN (SELECT plan_id, plan_type_description, plan_subtype, payment_type FROM fx_plan GROUP BY ALL) kind
         ON kind.plan_id = pair.plan_id
       GROUP BY ALL""",
)
def _(t):
    return ops.plan_mix(ops.claims_per_plan(cohort(t)), t.plan)


@query(
    "drug_ranking",
    """SELECT drug_name, drug_generic_name, claim_count FROM (
         SELECT *, row_number() OVER (ORDER BY claim_count DESC, drug_name, drug_generic_name) AS place FROM (
           SELECT drug_name, drug_generic_name, sum(n)::BIGINT AS claim_count
           FROM (SELECT drug_id, count(claim_id) FILTER (claim_status = 1 AND final_claim_ind = 'Y') AS n,
               bool_or(claim_status = 1 AND final_claim_ind = 'Y') AS paid FROM fx_claim GROUP BY drug_id)
           JOIN (SELECT drug_id, drug_name, drug_generic_name FROM fx_drug GROUP BY ALL) USING (drug_id) WHERE paid GROUP BY ALL))
       WHERE place <= 200""",
)
def _(t):
    return ops.drug_ranking(t.claim, t.drug)


@query(
    "stage_total",
    "SELECT sum(claim_count)::BIGINT AS claim_count, sum(patient_count)::BIGINT AS patient_count FROM p02",
)
def _(t):
    return ops.stage_total(monthly(t), ["claim_count", "patient_count"])


@query(
    "reconcile_totals",
    """SELECT measure, before_total, after_total, after_total - before_total AS diff FROM (
       SELECT 'claim_count' AS measure, (SELECT sum(claim_count)::DOUBLE FROM p04) AS before_total, (SELECT sum(claim_count) FROM p04_split) AS after_total
       UNION ALL SELECT 'patient_pay_norm', (SELECT sum(patient_pay_norm)::DOUBLE FROM p04), (SELECT sum(patient_pay_norm) FROM p04_split)
       UNION ALL SELECT 'plan_pay_norm', (SELECT sum(plan_pay_norm)::DOUBLE FROM p04), (SELECT sum(plan_pay_norm) FROM p04_split))""",
)
def _(t):
    before = sinks.materialize(by_org(t), scratch_path(t.spark, "by_org"))
    return ops.reconcile(before, ops.claims_split(before), ops.SPLIT_MEASURES)


@query(
    "reconcile_stages",
    """SELECT measure, before_total, after_total, after_total - before_total AS diff FROM (
       SELECT 'claim_count' AS measure, (SELECT sum(claim_count)::DOUBLE FROM p03_rows) AS before_total, (SELECT sum(claim_count)::DOUBLE FROM p04) AS after_total
       UNION ALL SELECT 'patient_count', (SELECT sum(patient_count)::DOUBLE FROM p03_rows), (SELECT sum(patient_count)::DOUBLE FROM p04))""",
)
def _(t):
    rows = sinks.materialize(enriched(t), scratch_path(t.spark, "enriched"))
    return ops.reconcile(ops.claims_by_npi(rows), ops.claims_by_org(rows), ops.COUNTS)


@query(
    "patient_recount",
    f"""SELECT hospital_id, pg_id, strftime(strptime(rx_fill_date, '%m-%d-%Y'), '%Y-%m') AS month, count(DISTINCT patient_id) AS patients
       FROM p01 LEFT JOIN fx_physician d USING (physician_id) LEFT JOIN fx_affiliation a ON a.npi = d.npi
       WHERE {{valid}} GROUP BY 1, 2, 3""",
)
def _(t):
    return ops.patient_recount(cohort(t), t.physician, t.affiliation, ["hospital_id", "pg_id", "month"])


PATIENT_LEVELS = {
    "organisation and month": ["hospital_network_id", "pg_network_id", "month"], "network": ["hospital_network_id"], "all": [],
}


def _counted(level: str, keys: list[str]) -> str:
    shown = ", ".join(k if k in keys else f"NULL AS {k}" for k in ("hospital_network_id", "pg_network_id", "month"))
    group = f"GROUP BY {', '.join(keys)}" if keys else ""
    return f"SELECT '{level}' AS level, {shown}, count(DISTINCT patient_id) AS patients FROM org_rows {group}"


@query(
    "patient_rollups",
    f"""SELECT * FROM (WITH org_rows AS (SELECT hospital_network_id, pg_network_id, strftime(strptime(rx_fill_date, '%m-%d-%Y'), '%Y-%m') AS month, patient_id
       FROM p01 LEFT JOIN fx_physician d USING (physician_id) LEFT JOIN fx_affiliation a ON a.npi = d.npi WHERE {{valid}})
       {' UNION ALL '.join(_counted(*x) for x in PATIENT_LEVELS.items())})""",
)
def _(t):
    """Three levels from one stored table of patient sets."""
    rows = patients.claim_keys(cohort(t), t.physician, t.affiliation)
    numbers = patients.number_patients(rows, ["hospital_network_id", "pg_network_id"])
    finest = PATIENT_LEVELS["organisation and month"]
    sets = sinks.materialize(patients.patient_sets(rows, numbers, finest), scratch_path(t.spark, "patient-sets"))
    shown = lambda keys: [F.col(k) if k in keys else F.lit(None).cast(rows.schema[k].dataType).alias(k) for k in finest]
    levels = [
        patients.count_sets(sets, keys).select(F.lit(level).alias("level"), *shown(keys), "patients")
        for level, keys in PATIENT_LEVELS.items()
    ]
    return levels[0].unionByName(levels[1]).unionByName(levels[2])


@query("dim_fanout", "SELECT drug_name, count(*) AS rows_per_key FROM fx_drug GROUP BY 1 HAVING count(*) > 1")
def _(t):
    return ops.dim_fanout(t.drug, ["drug_name"])


# --- sources and sinks


@query("csv_roundtrip", "SELECT drug_id, ndc11, drug_name, drug_generic_name, bgi FROM fx_drug")
def _(t):
    path = scratch_path(t.spark, "csv")
    t.drug.write.option("header", True).csv(path)
    return tables.read_csv(t.spark, path, t.drug.schema)


@query(
    "csv_export",
    """SELECT child_subtype, plan_type_description, plan_subtype, payment_type, CAST(sum(claim_count) AS VARCHAR) AS claim_count
       FROM p04_split GROUP BY ALL""",
)
def _(t):
    path = scratch_path(t.spark, "export")
    sinks.export_csv(ops.facility_plan_crosstab(ops.claims_split(by_org(t))), path)
    return tables.read_csv(t.spark, path)


@query("stage_materialize", f"SELECT {', '.join(CLAIM_COLUMNS)} FROM p01")
def _(t):
    return sinks.materialize(cohort(t).select(*CLAIM_COLUMNS), scratch_path(t.spark, "cohort"))


@query("stage_resume", "SELECT * FROM p04")
def _(t):
    """A second run takes over the stages that the first has finished, and goes on from there."""
    folder, state = scratch_path(t.spark, "resumable"), stages.input_state(t.spark, t.path("lineitem"), t.path("orders"))
    options = {"workdir": folder, "exact_cents": True, "inputs": state}
    ClaimRun(sources(t), Cohort(patterns=PATTERNS), YEAR, **options).monthly
    return ClaimRun(sources(t), Cohort(patterns=PATTERNS), YEAR, **options).by_org


@query(
    "clean_columns",
    """SELECT drug_id AS DrugId, drug_name AS Drugno, drug_generic_name AS GenericName_brand, bgi AS BGInew FROM fx_drug""",
)
def _(t):
    raw = t.drug.select(
        F.col("drug_id").alias("Drug Id"), F.col("drug_name").alias("Drug #"),
        F.col("drug_generic_name").alias("Generic-Name:brand"), F.col("bgi").alias("B.G.I (new)"),
    )
    return tables.clean_columns(raw)


@query("copy_manifest", None)
def _(t):
    return tables.copy_manifest(t.spark, t.folder, "archive/copy")


@query("relocate_report", "SELECT count(*) AS source_rows, count(*) AS dest_rows, true AS rows_match, true AS content_match FROM lineitem")
def _(t):
    return sinks.relocate(t.spark, t.path("lineitem"), scratch_path(t.spark, "relocated"))
