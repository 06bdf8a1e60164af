"""Partition tests that follow from timestamp tests, and the entry module without its optional part."""

import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from claimtree.plans import pushdown as lab
from claimtree.sources import sinks

TIMES = [
    "1995-12-31 23:59:59.999999", "1996-01-01 00:00:00", "1996-01-01 00:00:00.000001", "1996-07-04 12:00:00", "1996-12-31 23:59:59.999999",
    "1997-01-01 00:00:00", "1997-06-01 00:00:00", "1998-01-01 00:00:00", None,
]


@pytest.fixture(scope="module", params=["timestamp", "timestamp_ntz", "date"])
def sales(request, spark, tmp_path_factory):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(TIMES)], "city_id int, t string")
    rows = rows.select("city_id", F.col("t").cast(request.param).alias("transacted_at")).withColumn(lab.PARTITION, F.year("transacted_at"))
    path = str(tmp_path_factory.mktemp("sales") / request.param)
    sinks.write_partitioned(rows, path, lab.PARTITION, "city_id")
    return spark.read.parquet(path)


def ids(df):
    return sorted(r.city_id for r in df.collect())


@pytest.mark.parametrize("value", [t for t in TIMES if t])
@pytest.mark.parametrize("test", ["=", "<", "<=", ">", ">="])
def test_no_row_is_lost(sales, test, value):
    kind = sales.schema["transacted_at"].dataType
    if kind.typeName() == "date" and "00:00:00" not in value:
        pytest.skip("not a date")
    value = value[:10] if kind.typeName() == "date" else value
    plain = sales.where(F.expr(f"transacted_at {test} CAST('{value}' AS {kind.simpleString()})"))
    assert ids(lab.where_time(sales, lab.SALES_YEAR, (test, value))) == ids(plain)


def test_folders_are_left_out(sales):
    found = lab.where_time(sales, lab.SALES_YEAR, (">=", "1996-01-01 00:00:00"), ("<", "1997-01-01 00:00:00"))
    lab.assert_scan(found, partition=[">= 1996", "<= 1996"])
    assert {f.split(f"{lab.PARTITION}=")[1][:4] for f in found.inputFiles()} >= {"1996"}
    lab.assert_scan(sales.where("transacted_at >= '1996-01-01'"), absent=["1996)"])  # not without the relation
    year = lab.where_derived(sales, lab.SALES_YEAR, [1997])
    lab.assert_scan(year, partition=["= 1997"])
    assert ids(year) == ids(sales.where("year(transacted_at) = 1997"))


def test_relation_is_checked(sales):
    assert lab.SALES_YEAR.violations(sales).count() == 0
    assert lab.SALES_YEAR.violations(sales.withColumn(lab.PARTITION, F.lit(1996))).count() > 0
    with pytest.raises(ValueError):
        lab.where_time(sales, lab.SALES_YEAR, ("<>", "1996-01-01"))


@pytest.mark.parametrize("missing", ["xxhash", "claimtree.llm", "tokenizers", "corpus_pipeline"])
def test_entry_without_optional_parts(missing):
    """What the optional part needs may be absent: the library's queries stay."""
    code = (
        f"import sys, warnings; sys.modules['{missing}'] = None; warnings.simplefilter('ignore'); sys.path.insert(0, '.')\n"
        "import __spark_entry__ as e; q = e.queries()\n"
        "from claimtree.queries import all_queries; assert set(all_queries()) <= set(q); print(len(q) - len(all_queries()))"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=__file__.rsplit("/tests/", 1)[0], check=True)
    assert int(out.stdout.split()[-1]) == 0 or missing == "corpus_pipeline"
