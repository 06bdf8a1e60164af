"""Checking SQL of the hierarchy queries. Paths are ``/``-joined ids; p1..p4 are the prefixes."""

from __future__ import annotations

from claimtree.queries import oracle

PRIMARY = " AND ".join(f"coalesce(upper(l{k}_primary), 'NULL') IN ('TRUE', 'NULL')" for k in (2, 3, 4))
ATTRIBUTES = {
    "EntityName": ("name", "VARCHAR"), "RelationType": ("relation", "VARCHAR"), "PrimaryFlag": ("primary", "VARCHAR"),
    "Tier": ("tier", "VARCHAR"), "Balance": ("balance", "BIGINT"), "Rate": ("rate", "DOUBLE"),
}
HELD = {1: ("name",), 2: ("name", "relation", "primary"), 3: ("name", "relation", "primary", "tier", "balance"),
        4: ("name", "relation", "primary", "tier", "balance", "rate")}


def attribute(level: int, key: str) -> str:
    column, dtype = ATTRIBUTES[key]
    return f"l{level}_{column}" if column in HELD[level] else f"NULL::{dtype}"


def wide(table: str, where: str = "true") -> str:
    ids = ", ".join(f"CASE WHEN lower(l{k}_id) NOT IN ('null', '-') THEN l{k}_id END AS l{k}_id" for k in range(1, 5))
    return f"SELECT * REPLACE ({ids}) FROM {table} WHERE {where}"


def levels(table: str) -> str:
    parts = []
    for k in range(1, 5):
        steps = ", ".join(f"l{j}_id AS a{j}" if j <= k else f"NULL::VARCHAR AS a{j}" for j in range(1, 5))
        prefix = ", ".join(
            f"{' || chr(47) || '.join(f'l{i}_id' for i in range(1, j + 1))} AS p{j}" if j <= k else f"NULL::VARCHAR AS p{j}"
            for j in range(1, 5)
        )
        values = ", ".join(f"{attribute(k, key)} AS {key}" for key in ATTRIBUTES)
        deeper = f"l{k + 1}_id IS NOT NULL" if k < 4 else "false"
        parts.append(f"""SELECT {k} AS depth, l{k}_id AS node_id, {steps}, {prefix}, {values}, row_order, {deeper} AS deeper
  FROM {table} WHERE {' AND '.join(f'l{j}_id IS NOT NULL' for j in range(1, k + 1))}""")
    return " UNION ALL ".join(parts)


def nodes(rows: str) -> str:
    return f"""SELECT * EXCLUDE (deeper, seen), coalesce(p4, p3, p2, p1) AS path,
  CASE depth WHEN 1 THEN '' WHEN 2 THEN p1 WHEN 3 THEN p2 ELSE p3 END AS parent_path, a1 AS root FROM (
  SELECT *, bool_or(deeper) OVER (PARTITION BY coalesce(p4, p3, p2, p1)) AS has_children,
    row_number() OVER (PARTITION BY coalesce(p4, p3, p2, p1) ORDER BY row_order) AS seen FROM {rows}) WHERE seen = 1"""


def edges() -> str:
    parts = []
    for k in (2, 3, 4):
        parts.append(f"""SELECT l{k}_id AS child_id, l{k - 1}_id AS parent_id, row_order, {k} AS level, l{k}_primary AS PrimaryFlag,
  l{k}_relation AS RelationType, l{k - 1}_name AS EntityName, {attribute(k - 1, 'Balance')} AS Balance FROM w
  WHERE {' AND '.join(f'l{j}_id IS NOT NULL' for j in range(2, k + 1))} AND NOT contains(upper(l{k}_relation), 'FILLED')""")
    return f"""SELECT * EXCLUDE (seen) FROM (SELECT *, row_number() OVER (PARTITION BY child_id, parent_id ORDER BY row_order, level) AS seen
  FROM ({' UNION ALL '.join(parts)})) WHERE seen = 1"""


SIBLINGS = "PARTITION BY parent_path, CASE WHEN depth = 1 THEN path END"
VIEW_WHERE = (
    "l1_name = 'ASIA' AND (" + " OR ".join(f"upper(l{k}_relation) IN ('OWNED', 'MANAGED')" for k in (2, 3, 4)) + ") AND " + PRIMARY
)

oracle.CTES |= {
    "w": wide("fx_hier"),
    "levels": levels("w"),
    "nodes": nodes("levels"),
    "edges": edges(),
    "conflicts": "SELECT child_id, count(*) AS primary_parents FROM edges WHERE upper(PrimaryFlag) = 'TRUE' GROUP BY 1 HAVING count(*) > 1",
    "bad_ids": "SELECT child_id FROM conflicts",
    "kept_nodes": " ".join(
        ["SELECT * FROM nodes WHERE true", *[f"AND (a{k} IS NULL OR a{k} NOT IN (FROM bad_ids))" for k in range(1, 5)]]
    ),
    "by_name": f"""SELECT *, CAST(row_number() OVER ({SIBLINGS} ORDER BY EntityName, path) AS INTEGER) AS position,
  count(*) OVER ({SIBLINGS}) AS siblings FROM nodes""",
    "by_balance": f"""SELECT *, CAST(row_number() OVER ({SIBLINGS} ORDER BY Balance DESC NULLS LAST, EntityName, path) AS INTEGER) AS position
  FROM nodes""",
    "steps": """SELECT n.path, n.root,
  {'n': n1.EntityName, 'p': n1.path} AS s1,
  CASE WHEN n2.path IS NOT NULL THEN {'n': n2.EntityName, 'p': n2.path} END AS s2,
  CASE WHEN n3.path IS NOT NULL THEN {'n': n3.EntityName, 'p': n3.path} END AS s3,
  CASE WHEN n4.path IS NOT NULL THEN {'n': n4.EntityName, 'p': n4.path} END AS s4
  FROM nodes n JOIN nodes n1 ON n.p1 = n1.path LEFT JOIN nodes n2 ON n.p2 = n2.path
  LEFT JOIN nodes n3 ON n.p3 = n3.path LEFT JOIN nodes n4 ON n.p4 = n4.path""",
    "page_one": "SELECT * FROM by_name WHERE depth = 1 OR position <= 3",
    "shown": """SELECT * FROM page_one WHERE (depth <= 2 OR p2 IN (SELECT path FROM page_one))
  AND (depth <= 3 OR p3 IN (SELECT path FROM page_one))""",
    "first_steps": """SELECT n.RelationType, n1.row_order AS r1, n2.row_order AS r2, n3.row_order AS r3, n4.row_order AS r4, n.depth
  FROM nodes n JOIN nodes n1 ON n.p1 = n1.path LEFT JOIN nodes n2 ON n.p2 = n2.path
  LEFT JOIN nodes n3 ON n.p3 = n3.path LEFT JOIN nodes n4 ON n.p4 = n4.path WHERE n.RelationType IS NOT NULL""",
    "legend": """SELECT relation_type, CAST(ordinal AS INTEGER) AS ordinal, ['#000000', '#FF0000', '#0000FF', '#FFA500', '#228B22', '#FF00FF', '#708090',
  '#FA8072', '#8B4513', '#008080', '#00FF00'][ordinal] AS colour FROM (
  SELECT RelationType AS relation_type, row_number() OVER (ORDER BY min(seq)) AS ordinal FROM (SELECT RelationType,
    row_number() OVER (ORDER BY r1, r2 NULLS FIRST, r3 NULLS FIRST, r4 NULLS FIRST) AS seq FROM first_steps) GROUP BY 1)""",
    "view_rows": wide("fx_hier", VIEW_WHERE),
    "view_levels": levels("view_rows"),
    "view_all": nodes("view_levels"),
    "view_kept": " ".join(
        ["SELECT * FROM view_all WHERE true", *[f"AND (a{k} IS NULL OR a{k} NOT IN (FROM bad_ids))" for k in range(1, 5)]]
    ),
    "view_hits": "SELECT unnest([p1, p2, p3, p4]) AS hit FROM view_kept WHERE Tier IN ('High', 'HIGH')",
    "view_nodes": f"""SELECT *, CAST(row_number() OVER ({SIBLINGS} ORDER BY Balance DESC NULLS LAST, EntityName, path) AS INTEGER) AS position
  FROM view_kept WHERE depth = 1 OR path IN (SELECT hit FROM view_hits WHERE hit IS NOT NULL)""",
}

TITLE = """array_to_string(list_transform(string_split(ARG, ' '), lambda w: concat(
  regexp_extract(w, '(?s)^([^A-Za-z]*)([A-Za-z]?)(.*)$', 1), upper(regexp_extract(w, '(?s)^([^A-Za-z]*)([A-Za-z]?)(.*)$', 2)),
  lower(regexp_extract(w, '(?s)^([^A-Za-z]*)([A-Za-z]?)(.*)$', 3)))), ' ')"""
DIGITS = "CAST(Balance AS VARCHAR)"
LEAD = f"((length({DIGITS}) - 1) % 3 + 1)"
SHORT = f"""CASE WHEN Balance > 1000 THEN concat(substr({DIGITS}, 1, {LEAD}), '.', substr({DIGITS}, {LEAD} + 1, 3),
  CASE (length({DIGITS}) - 1) // 3 WHEN 1 THEN ' K' WHEN 2 THEN ' M' WHEN 3 THEN ' B' ELSE ' T' END) ELSE {DIGITS} END"""


def fill_title(body: str) -> str:
    """Replace ``{title}(argument)`` by the title-case expression over the argument."""
    mark = "{title}("
    while mark in body:
        start = body.index(mark)
        at = start + len(mark)
        depth, quoted = 1, False
        while depth:
            quoted ^= body[at] == "'"
            depth += 0 if quoted else {"(": 1, ")": -1}.get(body[at], 0)
            at += 1
        argument = body[start + len(mark) : at - 1]
        body = body[:start] + TITLE.replace("ARG", argument) + body[at:]
    return body


def check(body: str) -> str:
    node = "path, depth, node_id, EntityName, RelationType, PrimaryFlag, Tier, Balance, Rate, row_order, has_children"
    body = fill_title(body).replace("{primary}", PRIMARY).replace("{node}", node).replace("{short}", SHORT)
    return oracle.check(body)
