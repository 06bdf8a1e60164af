"""Checking SQL: named common table expressions, pulled in where a query mentions them."""

from __future__ import annotations

import re

from claimtree.operators.claims import AFFILIATION_COLUMNS, ENTITY_COLUMNS, PLAN_COLUMNS
from claimtree.queries.fixtures import FIXTURES, checking_cte

VALID = "claim_status = 1 AND final_claim_ind = 'Y' AND coalesce(days_supply, 0) <> 0"
NORM = "(patient_pay * 30) // days_supply AS patient_pay_norm, (plan_pay * 30) // days_supply AS plan_pay_norm"
AFFILIATION = ", ".join(f'"{c}"' for c in AFFILIATION_COLUMNS)
PLAN = ", ".join(PLAN_COLUMNS)
ENTITY = ", ".join(ENTITY_COLUMNS)
DIMS = f"month, drug_name, bgi, {PLAN}, specialty_description, {AFFILIATION}"
SUMS = ", ".join(
    f"sum({m})::BIGINT AS {m}" for m in ("patient_count", "claim_count", "patient_pay_norm", "plan_pay_norm")
)
MONTH = "strftime(strptime(rx_fill_date, '%m-%d-%Y'), '%Y-%m') AS month"


# The four cases of a row with or without a hospital and a group: who gets what share.
SHARES = """(VALUES (true, false, 'hospital', 'Hospital', 1.0), (false, true, 'pg', 'PG', 1.0), (true, true, 'hospital', 'Hospital', 0.5),
  (true, true, 'pg', 'PG', 0.5), (false, false, 'hospital', 'Null', 1.0)) AS share(with_hospital, with_pg, side, child_type, weight)"""


def split(table: str, kept: str) -> str:
    """Rows meet the shares of their case; each share picks its side as one structure."""

    def side(name: str, subtype: str, code: str, flag: str) -> str:
        return f"""{{'child_id': {name}_id, 'child_name': {name}_name, 'child_subtype': {subtype}, 'parent_id': {name}_network_id,
  'parent_name': {name}_network_name, '340b_id_number': {code}, '340b_flag': {flag}}}"""

    hospital = side("hospital", "hospital_type", '"340b_id_number"', '"340b_flag"')
    group = side("pg", "physician_group_type", "'Null'", "'Null'")
    shared = ", ".join(f"{m} * weight::DOUBLE AS {m}" for m in ("claim_count", "patient_pay_norm", "plan_pay_norm"))
    return f"""SELECT unnest(CASE side WHEN 'pg' THEN {group} ELSE {hospital} END), child_type, {kept}, {shared}
  FROM {table} JOIN {SHARES} ON with_hospital = (hospital_id IS NOT NULL) AND with_pg = (pg_id IS NOT NULL)"""


def monthly(rows: str, keys: str, join: str = "JOIN", drugs: str = "drug_label") -> str:
    """Distinct ids counted as rows that come first among those of their group with the same id."""
    return f"""SELECT {keys}, sum((nth_claim = 1 AND claim_id IS NOT NULL)::INT)::BIGINT AS claim_count,
  sum((nth_patient = 1 AND patient_id IS NOT NULL)::INT)::BIGINT AS patient_count,
  sum(patient_pay_norm)::BIGINT AS patient_pay_norm, sum(plan_pay_norm)::BIGINT AS plan_pay_norm
  FROM (SELECT *, row_number() OVER (PARTITION BY {keys}, claim_id) AS nth_claim,
      row_number() OVER (PARTITION BY {keys}, patient_id) AS nth_patient
    FROM (SELECT *, {NORM}, {MONTH} FROM {rows} WHERE {VALID}) {join} {drugs} USING (drug_id))
  GROUP BY ALL"""


def enriched(table: str, columns: str) -> str:
    return f"""SELECT p.npi, {columns}, {PLAN}, specialty_description, {AFFILIATION},
  claim_count, patient_count, patient_pay_norm, plan_pay_norm
  FROM {table} a LEFT JOIN fx_plan b ON a.claim_plan_id = b.plan_id
  LEFT JOIN (SELECT DISTINCT physician_id AS doc_id, npi AS doc_npi, specialty_description FROM fx_physician) d ON a.physician_id = doc_id
  LEFT JOIN profile p ON p.npi = doc_npi"""


def full(table: str) -> str:
    return f"""SELECT a.*, plan_channel_type, {ENTITY} FROM {table} a
  LEFT JOIN fx_plan_channel c USING (plan_type_description, plan_subtype, payment_type)
  LEFT JOIN fx_entity_type e ON a.child_id = e.final_child"""


KEPT = f"month, drug_name, bgi, {PLAN}, specialty_description"
AREA_KEPT = f"month, overall_class, initial_class, drug_class, drug_name, bgi, therapy_area, {PLAN}, specialty_description"

CTES: dict[str, str] = {name: checking_cte(name) for name in FIXTURES}
CTES |= {
    "drug_label": "SELECT drug_id, drug_name, bgi FROM fx_drug GROUP BY ALL",
    # Every third drug under a key that no claim has.
    "drug_label_gaps": "SELECT CASE WHEN drug_id % 3 = 0 THEN -1 - drug_id ELSE drug_id END AS drug_id, drug_name, bgi FROM drug_label",
    "p01": """SELECT * FROM fx_claim
  WHERE drug_id IN (SELECT drug_id FROM fx_drug WHERE regexp_matches(drug_name, 'ring|bolt', 'i'))""",
    "code_areas": "SELECT lpad(ndc11, 11, '0') AS ndc11, list(therapy_area) AS areas FROM fx_ndc_map GROUP BY 1",
    "drug_area": "SELECT drug_id, unnest(areas) AS therapy_area FROM fx_drug JOIN code_areas USING (ndc11)",
    "p01_area": "SELECT * FROM fx_claim JOIN drug_area USING (drug_id) WHERE list_contains(['SMALL', 'ECONOMY', 'PROMO'], therapy_area)",
    "economy": "SELECT * FROM p01_area WHERE therapy_area = 'ECONOMY'",
    "p02": monthly("p01", "physician_id, plan_id, month, drug_name, bgi"),
    "p02_area": monthly("economy", "physician_id, plan_id, month, therapy_area, drug_name, bgi", "LEFT JOIN", "drug_label_gaps"),
    "p02_area_all": f"""SELECT * RENAME (plan_id AS claim_plan_id)
  FROM ({monthly("economy", "physician_id, plan_id, month, therapy_area, drug_name, bgi", "LEFT JOIN")})""",
    "p02_class": """SELECT a.*, overall_class, initial_class, drug_class FROM p02_area_all a
  LEFT JOIN fx_product_class c ON a.drug_name = c.drug_name""",
    "p02_plan": """SELECT a.* EXCLUDE (plan_id), b.* FROM p02 a LEFT JOIN fx_plan b ON a.plan_id = b.plan_id""",
    # One table of what is known of an organisation in a role; a physician's four roles are rows that look it up.
    "org_fact": """SELECT 'hospital' AS role, definitive_id AS id, hospital_name AS title, hospital_type AS kind, id_340b AS code,
    if(id_340b IS NULL, 'No', 'yes') AS flag FROM fx_hospital
  UNION SELECT 'hospital_network', definitive_idn_id, idn, NULL, NULL, NULL FROM fx_hospital
  UNION SELECT 'pg', definitive_id, physician_group_name, physician_group_type, NULL, NULL FROM fx_physician_group
  UNION SELECT 'pg_network', definitive_network_id, network_name, NULL, NULL, NULL FROM fx_physician_group""",
    "profile": "SELECT npi, hospital_id, pg_id, hospital_network_id, pg_network_id, "
    + ", ".join(
        f"""max({fact}) FILTER (WHERE role = '{role}') AS "{name}\""""
        for name, role, fact in (
            ("hospital_name", "hospital", "title"), ("hospital_type", "hospital", "kind"), ("340b_id_number", "hospital", "code"),
            ("340b_flag", "hospital", "flag"), ("hospital_network_name", "hospital_network", "title"), ("pg_name", "pg", "title"),
            ("physician_group_type", "pg", "kind"), ("pg_network_name", "pg_network", "title"),
        )
    )
    + """ FROM (SELECT *, row_number() OVER () AS line, unnest(['hospital', 'pg', 'hospital_network', 'pg_network']) AS role,
    unnest([hospital_id, pg_id, hospital_network_id, pg_network_id]) AS id FROM fx_affiliation)
  LEFT JOIN org_fact USING (role, id) GROUP BY line, npi, hospital_id, pg_id, hospital_network_id, pg_network_id""",
    "p02_keyed": "SELECT * RENAME (plan_id AS claim_plan_id) FROM p02",
    "p03_rows": "SELECT * FROM (" + enriched("p02_keyed", "physician_id, month, drug_name, bgi") + ")",
    "p04": f"SELECT {DIMS}, {SUMS} FROM p03_rows GROUP BY ALL",
    "p04_split": split("p04", KEPT),
    "p04_full": full("p04_split"),
    "p03_area_rows": enriched(
        "p02_class", "physician_id, month, overall_class, initial_class, drug_class, drug_name, bgi, therapy_area"
    ),
    "p04_area": f"SELECT {AREA_KEPT}, {AFFILIATION}, {SUMS} FROM p03_area_rows GROUP BY ALL",
    "p04_area_split": split("p04_area", AREA_KEPT),
    "p04_area_full": full("p04_area_split"),
}


def check(body: str) -> str:
    """The body with its marks filled and every expression it needs, directly or not, in front."""
    marks = {"valid": VALID, "norm": NORM, "plan": PLAN, "affiliation": AFFILIATION, "dims": DIMS, "sums": SUMS}
    for name, text in marks.items():
        body = body.replace("{" + name + "}", text)
    needed, todo = set(), [body]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in words & CTES.keys() - needed:
            needed.add(name)
            todo.append(CTES[name])
    if not needed:
        return body
    front = ",\n".join(f"{name} AS (\n{CTES[name]}\n)" for name in CTES if name in needed)
    return f"WITH {front}\n{body}"
