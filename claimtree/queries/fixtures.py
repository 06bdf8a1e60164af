"""The library's input tables, derived from the driver's tables by SQL that both engines run.

``{name}`` stands for a driver table. The same text builds the Spark inputs and, as common table
expressions, the inputs of the checking SQL.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, types as T

from claimtree.operators.metadata import HierarchyMeta, LevelColumn

FIXTURES = {
    "fx_drug": """
SELECT p_partkey AS drug_id, lpad(concat('', p_partkey), 11, '0') AS ndc11, p_name AS drug_name,
  p_brand AS drug_generic_name, CASE WHEN p_partkey % 2 = 0 THEN 'B' ELSE 'G' END AS bgi
FROM {part}""",
    "fx_ndc_map": """
SELECT CASE WHEN p_partkey % 10 = 9 THEN concat('X', p_partkey) ELSE concat('', p_partkey) END AS ndc11, p_type AS therapy_area
FROM {part}""",
    "fx_product_class": """
SELECT DISTINCT CASE WHEN split_part(p_name, ' ', 1) = 'red' THEN concat('old ', p_name) ELSE p_name END AS drug_name,
  split_part(p_name, ' ', 1) AS overall_class,
  split_part(p_name, ' ', 2) AS initial_class, concat('CLS-', split_part(p_name, ' ', 2)) AS drug_class
FROM {part}""",
    "fx_claim": """
SELECT l_orderkey * 10 + l_linenumber AS claim_id, o_custkey AS patient_id, l_suppkey AS physician_id,
  l_partkey AS drug_id, o_custkey % 25 AS plan_id,
  concat(lpad(concat('', month(l_shipdate)), 2, '0'), '-', lpad(concat('', day(l_shipdate)), 2, '0'), '-',
    concat('', year(l_shipdate))) AS rx_fill_date,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity AS BIGINT) % 31 END AS days_supply,
  CAST(round(l_extendedprice * 100) AS BIGINT) % 5000 AS patient_pay,
  CAST(round(l_extendedprice * 100) AS BIGINT) - CAST(round(l_extendedprice * 100) AS BIGINT) % 5000 AS plan_pay,
  CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS claim_status,
  CASE WHEN l_returnflag = 'R' THEN 'N' ELSE 'Y' END AS final_claim_ind, l_orderkey % 3 + 1 AS slice
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "fx_plan": """
SELECT CAST(CASE WHEN n_nationkey < 20 THEN n_nationkey ELSE -1 - n_nationkey END AS BIGINT) AS plan_id, n_name AS plan_name, concat('T', n_regionkey) AS plan_type,
  r_name AS plan_type_description, concat('S', n_nationkey % 2) AS plan_subtype,
  concat('P', n_nationkey % 3) AS payment_type, concat('Insurer ', n_regionkey) AS national_insurer_name,
  concat('NT', n_nationkey % 2) AS national_type, concat('Regional ', n_nationkey % 4) AS regional_name,
  concat('RT', n_nationkey % 3) AS regional_type, concat('Org ', n_nationkey % 6) AS organization_name,
  concat('OT', n_nationkey % 2) AS organization_type, concat('Admin ', n_nationkey % 7) AS admin_name,
  concat('AT', n_nationkey % 2) AS admin_type
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "fx_physician": """
SELECT s_suppkey AS physician_id, CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE concat('NPI', s_suppkey) END AS npi,
  concat('Specialty ', s_nationkey % 4) AS specialty_description
FROM {supplier}""",
    "fx_affiliation": """
SELECT CASE WHEN s_suppkey % 5 = 0 THEN concat('OLD', s_suppkey) ELSE concat('NPI', s_suppkey) END AS npi,
  CASE WHEN s_suppkey % 4 IN (0, 1) THEN s_nationkey END AS hospital_id,
  CASE WHEN s_suppkey % 4 IN (1, 2) THEN 100 + s_nationkey END AS pg_id,
  CASE WHEN s_suppkey % 4 IN (0, 1) THEN n_regionkey END AS hospital_network_id,
  CASE WHEN s_suppkey % 4 IN (1, 2) THEN n_regionkey END AS pg_network_id
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    "fx_hospital": """
SELECT n_nationkey AS definitive_id, concat('Hospital ', n_nationkey) AS hospital_name, r_name AS hospital_type,
  CASE WHEN n_nationkey % 2 = 0 THEN concat('H', n_nationkey) END AS id_340b, n_regionkey AS definitive_idn_id,
  concat('IDN ', r_name) AS idn
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "fx_physician_group": """
SELECT 100 + n_nationkey AS definitive_id, concat('Group ', n_nationkey) AS physician_group_name,
  concat('GT', n_nationkey % 3) AS physician_group_type, n_regionkey AS definitive_network_id,
  concat('Net ', r_name) AS network_name
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "fx_plan_channel": """
SELECT DISTINCT CASE WHEN n_nationkey % 4 = 0 THEN concat('OLD ', r_name) ELSE r_name END AS plan_type_description, concat('S', n_nationkey % 2) AS plan_subtype,
  concat('P', n_nationkey % 3) AS payment_type,
  CASE WHEN n_nationkey % 3 = 0 THEN 'Commercial' ELSE 'Government' END AS plan_channel_type
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "fx_entity_type": """
SELECT CASE WHEN n_nationkey % 3 = 0 THEN -1 - n_nationkey ELSE n_nationkey END AS final_child, concat('COT', n_nationkey % 3) AS child_cot_type,
  concat(n_nationkey, ' Main St') AS address, n_name AS city, concat('ST', n_regionkey) AS state,
  lpad(concat('', n_nationkey * 7), 5, '0') AS zip_code, n_nationkey % 6 AS lhm_id,
  concat('Market ', n_nationkey % 6) AS lhm_name, n_nationkey % 8 AS cbsa, concat('CBSA ', n_nationkey % 8) AS cbsa_name,
  concat('CT', n_nationkey % 2) AS cbsa_type, n_regionkey AS entity_id, r_name AS entity_name,
  CASE WHEN n_nationkey % 2 = 0 THEN 'Y' ELSE 'N' END AS ahrq_flag, concat('FT', n_nationkey % 4) AS entity_firm_type,
  concat('ET', n_nationkey % 3) AS final_entity_type, concat('RET', n_nationkey % 5) AS refined_entity_type,
  concat('Level ', n_nationkey % 3) AS idn_integration_level
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "fx_sales": """
SELECT l_suppkey AS city_id, l_shipdate AS transacted_at, l_extendedprice AS amount,
  CAST(round(l_extendedprice * 100) AS BIGINT) AS amount_cents, year(l_shipdate) AS p_transacted_year
FROM {lineitem}""",
    # Region, nation, customer, order. Every tenth order is also placed under a second customer; ids
    # are missing or '-' at places; every twentieth order is flagged primary under both customers.
    "fx_hier": """
SELECT o_orderkey * 2 + extra AS row_order, concat('R', r_regionkey) AS l1_id, r_name AS l1_name,
  concat('N', n_nationkey) AS l2_id, n_name AS l2_name,
  CASE WHEN n_nationkey % 7 = 3 THEN 'Filled' ELSE 'Owned' END AS l2_relation, 'TRUE' AS l2_primary,
  CASE WHEN c_custkey % 50 <> 49 THEN concat('C', c_custkey) END AS l3_id,
  CASE WHEN c_custkey % 13 = 5 THEN concat(c_name, ' (Filled)') ELSE c_name END AS l3_name,
  CASE WHEN c_mktsegment = 'FURNITURE' THEN 'FILLED dummy' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Owned'
    ELSE 'Affiliated' END AS l3_relation,
  CASE WHEN c_custkey % 4 = 1 THEN NULL ELSE 'true' END AS l3_primary,
  CASE WHEN o_orderkey % 5 < 2 THEN 'High' WHEN o_orderkey % 5 = 2 THEN 'medium' ELSE 'Other' END AS l3_tier,
  CAST(round(c_acctbal * 100) AS BIGINT) AS l3_balance,
  CASE WHEN o_orderkey % 9 = 8 THEN NULL WHEN o_orderkey % 9 = 7 THEN '-' ELSE concat('O', o_orderkey) END AS l4_id,
  concat('order ', o_orderkey % 97, ' (', lower(o_orderpriority), ')') AS l4_name,
  CASE WHEN o_orderstatus = 'O' THEN 'Owned' WHEN o_orderstatus = 'F' THEN 'Managed' ELSE 'Affiliated' END AS l4_relation,
  CASE WHEN extra = 1 AND o_orderkey % 20 <> 0 THEN 'FALSE' WHEN o_orderkey % 4 = 3 THEN NULL ELSE 'TRUE' END AS l4_primary,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'High' WHEN o_orderpriority = '2-HIGH' THEN 'HIGH'
    WHEN o_orderpriority = '3-MEDIUM' THEN 'Medium' WHEN o_orderpriority = '5-LOW' THEN 'low' ELSE 'Other' END AS l4_tier,
  CAST(round(o_totalprice * 100) AS BIGINT) AS l4_balance, o_totalprice AS l4_rate
FROM (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice, 0 AS extra FROM {orders}
  UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice, 1 AS extra
  FROM {orders} WHERE o_orderkey % 10 = 0) o
JOIN {customer} ON c_custkey = o_custkey + extra
JOIN {nation} ON n_nationkey = c_nationkey JOIN {region} ON r_regionkey = n_regionkey""",
    "fx_images": """
SELECT o_orderkey AS image_order, CASE WHEN o_orderkey % 2 = 0 THEN 'node' ELSE 'sidebar' END AS view,
  CASE WHEN o_orderstatus = 'O' THEN 'Owned' WHEN o_orderstatus = 'F' THEN 'Managed' ELSE 'Joint' END AS value,
  concat('img/', o_orderkey, '.svg') AS path
FROM {orders}""",
    "fx_config": """
SELECT o_orderkey AS config_order, o_orderstatus AS section,
  CASE WHEN o_orderkey % 4 = 0 THEN '-' ELSE o_orderpriority END AS subsection,
  concat('attr', o_custkey % 20) AS attribute, concat('v', o_orderkey) AS value,
  concat('p', o_custkey) AS parameter, concat('c', o_orderkey % 100) AS content
FROM {orders}""",
    "fx_columns": """
SELECT p_partkey AS column_order, CASE WHEN p_partkey % 10 = 0 THEN '-' ELSE p_type END AS category, p_brand AS key
FROM {part}""",
}

# The column metadata of fx_hier.
HIER_META = HierarchyMeta(
    (
        LevelColumn("l1_id", 1, "EntityId", "Id", "String"),
        LevelColumn("l1_name", 1, "EntityName", "Name", "String"),
        LevelColumn("l2_id", 2, "EntityId", "Id", "String"),
        LevelColumn("l2_name", 2, "EntityName", "Name", "String"),
        LevelColumn("l2_relation", 2, "RelationType", "Relation", "String", "%s", "Profile"),
        LevelColumn("l2_primary", 2, "PrimaryFlag", "Primary", "String"),
        LevelColumn("l3_id", 3, "EntityId", "Id", "String"),
        LevelColumn("l3_name", 3, "EntityName", "Name", "String"),
        LevelColumn("l3_relation", 3, "RelationType", "Relation", "String", "%s", "Profile"),
        LevelColumn("l3_primary", 3, "PrimaryFlag", "Primary", "String"),
        LevelColumn("l3_tier", 3, "Tier", "Tier", "String", "tier <%s>", "Profile"),
        LevelColumn("l3_balance", 3, "Balance", "Balance", "Integer", "$%s", "Finance"),
        LevelColumn("l4_id", 4, "EntityId", "Id", "String"),
        LevelColumn("l4_name", 4, "EntityName", "Name", "String"),
        LevelColumn("l4_relation", 4, "RelationType", "Relation", "String", "%s", "Profile"),
        LevelColumn("l4_primary", 4, "PrimaryFlag", "Primary", "String"),
        LevelColumn("l4_tier", 4, "Tier", "Tier", "String", "tier <%s>", "Profile"),
        LevelColumn("l4_balance", 4, "Balance", "Balance", "Integer", "$%s", "Finance"),
        LevelColumn("l4_rate", 4, "Rate", "Rate", "Float", "%s per unit of trade", "Finance"),
    ),
    shorten=("Balance",),
)


_schemas: dict[str, T.StructType] = {}
# Tables that the large fixtures start from.
FACTS = {"fx_claim": ["lineitem"], "fx_hier": ["orders"]}


class Inputs:
    """Driver tables and fixtures of one scale folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}.parquet"

    def table(self, name: str) -> DataFrame:
        """A driver table; its schema is read from the files once."""
        path = self.path(name)
        if path not in _schemas:
            _schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[path]).parquet(path)

    def sql(self, text: str, facts: list[str] = ()) -> DataFrame:
        names = set(re.findall(r"\{(\w+)\}", text))
        return self.spark.sql(text, **{t: self.table(t) for t in names})

    def __getattr__(self, name: str) -> DataFrame:
        if f"fx_{name}" not in FIXTURES:
            raise AttributeError(name)
        df = self.sql(FIXTURES[f"fx_{name}"], FACTS.get(f"fx_{name}", ()))
        return df.withColumnRenamed("id_340b", "340b_id_number") if name == "hospital" else df


def checking_cte(name: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", FIXTURES[name]).strip()
