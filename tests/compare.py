"""Side-by-side run of registered queries in Spark and DuckDB."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def kind(value) -> str:
    return "null" if value is None else type(value).__name__


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    return Counter(tuple(row[i] for i in order) for row in rows)


def compare(spark_df, con, sql) -> list[str]:
    """Differences in columns, row count, values and value types; empty when equal."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    expected = cur.fetchall()
    got = [tuple(r) for r in spark_df.collect()]
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns: spark only {set(spark_df.columns) - set(names)}, sql only {set(names) - set(spark_df.columns)}"]
    problems = []
    if len(got) != len(expected):
        problems.append(f"rows: spark {len(got)}, sql {len(expected)}")
    a, b = rows_of(spark_df.columns, got), rows_of(names, expected)
    if a != b:
        only_a, only_b = list((a - b).elements())[:2], list((b - a).elements())[:2]
        problems.append(f"values: {sum((a - b).values())} differ\n   spark {only_a}\n   sql   {only_b}")
    for i, name in enumerate(names):
        j = spark_df.columns.index(name)
        kinds = {kind(r[i]) for r in expected} ^ {kind(r[j]) for r in got}
        if kinds:
            problems.append(f"types of {name}: {kinds}")
    return problems


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from claimtree.session import build_session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(folder), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if sys.argv[1:] and name not in sys.argv[1:]:
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            if name in sqls:
                problems = compare(df, con, sqls[name])
                note = "ok" if not problems else "\n  ".join(["DIFF", *problems])
            else:
                problems, note = [], f"no sql, {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            problems, note = [error], f"ERROR {str(error)[:1500]}"
        bad += bool(problems)
        print(f"{name}: {note} ({time.time() - start:.1f}s, {df.count() if not problems else '?'} rows)", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
