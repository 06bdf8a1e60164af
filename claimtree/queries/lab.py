"""Registered queries of the pushdown side and of the text functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from claimtree.functions import text as tx
from claimtree.plans import pushdown as lab
from claimtree.queries.fixtures import Inputs
from claimtree.queries.oracle import check
from claimtree.queries.registry import Registry
from claimtree.session import scratch_path
from claimtree.sources import sinks, tables

CITY, YEAR = 7, 1997
QUERIES = Registry(check)
query = QUERIES.query
_partitioned: dict[tuple[str, str], str] = {}


def partitioned_sales(t: Inputs) -> DataFrame:
    """The sales table stored by year, written once per application and folder."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _partitioned:
        path = scratch_path(t.spark, "sales")
        sinks.write_partitioned(t.sales, path, lab.PARTITION, "city_id", "transacted_at")
        _partitioned[key] = path
    return tables.read_partitioned(t.spark, _partitioned[key])


CITY_YEAR = f"SELECT * FROM fx_sales WHERE city_id = {CITY} AND year(transacted_at) = {YEAR}"


@query("lab_full_scan", "SELECT * FROM fx_sales")
def _(t):
    return lab.full_scan(t.sales)


@query("lab_predicate", CITY_YEAR)
def _(t):
    return lab.city_computed_year(t.sales, CITY, YEAR)


@query("lab_year_range", CITY_YEAR)
def _(t):
    return lab.city_year_range(t.sales, CITY, YEAR)


@query("lab_partition", CITY_YEAR)
def _(t):
    return lab.city_partition_year(partitioned_sales(t), CITY, YEAR)


@query("lab_unpruned", CITY_YEAR)
def _(t):
    return lab.city_computed_year(partitioned_sales(t), CITY, YEAR)


FROM, TO = "1996-07-01 00:00:00", "1997-03-15 12:00:00"


@query("lab_implied", f"SELECT * FROM fx_sales WHERE city_id = {CITY} AND transacted_at >= '{FROM}' AND transacted_at < '{TO}'")
def _(t):
    """A range of timestamps; the years to read follow from it."""
    rows = partitioned_sales(t).where(F.col("city_id") == CITY)
    return lab.where_time(rows, lab.SALES_YEAR, (">=", FROM), ("<", TO))


@query("lab_implied_year", CITY_YEAR)
def _(t):
    """The computed year as in ``lab_unpruned``, but only that year's folder is read."""
    return lab.where_derived(partitioned_sales(t).where(F.col("city_id") == CITY), lab.SALES_YEAR, [YEAR])


@query("lab_cached", CITY_YEAR)
def _(t):
    # A projection of its own, so that other queries on the stored table do not read this cache.
    rows = partitioned_sales(t).select("city_id", "transacted_at", "amount", "amount_cents", lab.PARTITION)
    return lab.cached_then_filtered(rows.withColumn("from_cache", F.lit(True)), CITY, YEAR).drop("from_cache")


@query("lab_agg_filter", f"SELECT city_id, sum(amount_cents)::BIGINT AS total_amount FROM fx_sales WHERE city_id = {CITY} GROUP BY 1")
def _(t):
    return lab.city_total(partitioned_sales(t), CITY, "amount_cents")


@query(
    "derived_total_filter",
    """SELECT *, amount * 0.2::DOUBLE AS tax, amount + amount * 0.2::DOUBLE AS total FROM fx_sales
       WHERE amount + amount * 0.2::DOUBLE > 60000""",
)
def _(t):
    return lab.derived_total(partitioned_sales(t), 0.2, 60000)


@query(
    "partition_scan",
    "SELECT p_transacted_year, count(*) AS n, sum(amount_cents)::BIGINT AS cents FROM fx_sales GROUP BY 1",
)
def _(t):
    rows = partitioned_sales(t).groupBy("p_transacted_year")
    return rows.agg(F.count("*").alias("n"), F.sum("amount_cents").alias("cents"))


# --- text functions, each over a whole column


@query(
    "title_case",
    r"""SELECT doc_id, array_to_string(list_transform(string_split(text, ' '), lambda w: concat(
         regexp_extract(w, '(?s)^([^A-Za-z]*)([A-Za-z]?)(.*)$', 1),
         upper(regexp_extract(w, '(?s)^([^A-Za-z]*)([A-Za-z]?)(.*)$', 2)),
         lower(regexp_extract(w, '(?s)^([^A-Za-z]*)([A-Za-z]?)(.*)$', 3)))), ' ') AS title FROM documents""",
)
def _(t):
    return t.table("documents").select("doc_id", tx.title_case(F.col("text")).alias("title"))


@query(
    "split_list",
    """SELECT p_partkey, len(items) AS n_items, array_to_string(items, ';') AS items FROM (
       SELECT p_partkey, list_transform(string_split(concat(p_brand, ' | ', replace(p_name, ' ', '| ')), '|'), lambda x: trim(x)) AS items
       FROM part)""",
)
def _(t):
    listed = F.concat("p_brand", F.lit(" | "), F.replace("p_name", F.lit(" "), F.lit("| ")))
    items = tx.split_list(listed)
    return t.table("part").select("p_partkey", F.size(items).alias("n_items"), F.array_join(items, ";").alias("items"))


def _first(text: str, mark: str, value: str) -> str:
    """Checking SQL for one replacement."""
    at = f"instr({text}, '{mark}')"
    return f"CASE WHEN {at} > 0 THEN concat(substr({text}, 1, {at} - 1), {value}, substr({text}, {at} + {len(mark)})) ELSE {text} END"


@query(
    "render_template",
    f"""SELECT c_custkey, CASE WHEN f0 <> '-' OR f1 <> '-' THEN {_first("s0", "###1", "f1")} ELSE '' END AS rendered
        FROM (SELECT *, {_first("'###0 buys ###1 (###0)'", "###0", "f0")} AS s0 FROM (
          SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '-' ELSE c_name END AS f0,
            CASE WHEN c_custkey % 2 = 0 THEN '-' WHEN c_custkey % 5 = 0 THEN 'null' ELSE c_mktsegment END AS f1 FROM customer))""",
)
def _(t):
    name = F.when(F.col("c_custkey") % 3 == 0, "-").otherwise(F.col("c_name"))
    segment = F.when(F.col("c_custkey") % 2 == 0, "-").when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment"))
    rows = t.table("customer").select("c_custkey", name.alias("Name"), segment.alias("Segment"))
    fields = {c: tx.display(F.col(c)) for c in ("Name", "Segment")}
    return rows.select("c_custkey", tx.render_template("###0 buys ###1 (###0)", "Name | Segment", fields).alias("rendered"))


@query(
    "abbreviate_number",
    """SELECT o_orderkey, CASE WHEN v > 1000 THEN concat(substr(s, 1, lead), '.', substr(s, lead + 1, 3),
         CASE (length(s) - 1) // 3 WHEN 1 THEN ' K' WHEN 2 THEN ' M' WHEN 3 THEN ' B' WHEN 4 THEN ' T' ELSE '' END) ELSE s END AS short
       FROM (SELECT *, (length(s) - 1) % 3 + 1 AS lead FROM (SELECT o_orderkey, v, CAST(CAST(floor(v) AS BIGINT) AS VARCHAR) AS s FROM (
         SELECT o_orderkey, o_totalprice * CASE o_orderkey % 4 WHEN 0 THEN 0.0009765625::DOUBLE WHEN 1 THEN 1::DOUBLE WHEN 2 THEN 1024::DOUBLE ELSE 16777216::DOUBLE END AS v
         FROM orders)))""",
)
def _(t):
    turn = F.col("o_orderkey") % 4
    factor = F.when(turn == 0, 1 / 1024).when(turn == 1, 1.0).when(turn == 2, 1024.0).otherwise(16777216.0)
    short = tx.abbreviate_number(F.col("o_totalprice") * factor)
    return t.table("orders").select("o_orderkey", short.alias("short"))


@query(
    "trim_title",
    """SELECT doc_id, CASE WHEN length(text) <= 70 THEN text WHEN instr(head, ' ') = 0 THEN ' ...'
         ELSE concat(regexp_replace(head, ' [^ ]*$', ''), ' ...') END AS title
       FROM (SELECT doc_id, text, substr(text, 1, 70) AS head FROM documents)""",
)
def _(t):
    return t.table("documents").select("doc_id", tx.trim_title(F.col("text")).alias("title"))


@query(
    "trim_subtitle",
    """SELECT conv_id, turn, CASE WHEN text IS NULL OR lower(text) = 'null' THEN '' WHEN length(text) > 27
       THEN concat(substr(text, 1, 24), '...') ELSE text END AS subtitle FROM conversations""",
)
def _(t):
    return t.table("conversations").select("conv_id", "turn", tx.trim_subtitle(F.col("text")).alias("subtitle"))


@query("trim_value", "SELECT page_id, CASE WHEN length(url) > 20 THEN concat(substr(url, 1, 17), '...') ELSE url END AS short_url FROM pages")
def _(t):
    return t.table("pages").select("page_id", tx.trim_tail(F.col("url"), 20).alias("short_url"))


@query("format_metric", "SELECT s_suppkey, concat('Balance : ', '$', CAST(CAST(floor(s_acctbal) AS BIGINT) AS VARCHAR), ' (%s)') AS caption FROM supplier")
def _(t):
    value = F.floor("s_acctbal").cast("bigint").cast("string")
    return t.table("supplier").select("s_suppkey", tx.format_metric(value, "$%s (%s)", "Balance").alias("caption"))


@query(
    "typed_cast",
    r"""SELECT p_partkey, raw, TRY_CAST(nullif(regexp_extract(raw, '^\s*([+-]?\d+)', 1), '') AS BIGINT) AS as_integer,
         TRY_CAST(nullif(regexp_extract(raw, '^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)', 1), '') AS DOUBLE) AS as_float
       FROM (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN concat(p_size, 'abc') WHEN 1 THEN concat('-', p_size, '.5e2x')
         WHEN 2 THEN p_name WHEN 3 THEN concat(' ', p_partkey, '.25') ELSE concat('.', p_size, ' kg') END AS raw FROM part)""",
)
def _(t):
    size, turn = F.col("p_size").cast("string"), F.col("p_partkey") % 5
    raw = (
        F.when(turn == 0, F.concat(size, F.lit("abc")))
        .when(turn == 1, F.concat(F.lit("-"), size, F.lit(".5e2x")))
        .when(turn == 2, F.col("p_name"))
        .when(turn == 3, F.concat(F.lit(" "), F.col("p_partkey").cast("string"), F.lit(".25")))
        .otherwise(F.concat(F.lit("."), size, F.lit(" kg")))
    )
    rows = t.table("part").select("p_partkey", raw.alias("raw"))
    whole, real = (tx.typed_cast(F.col("raw"), kind) for kind in ("Integer", "Float"))
    return rows.select("p_partkey", "raw", whole.alias("as_integer"), real.alias("as_float"))
