"""The same question asked in forms that do or do not let the scan skip data."""

from __future__ import annotations

import contextlib
import io
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

PARTITION = "p_transacted_year"


def full_scan(sales: DataFrame) -> DataFrame:
    return sales


def city_computed_year(sales: DataFrame, city: int, year: int) -> DataFrame:
    """City and the year computed from the timestamp: the city test reaches the scan, the year does not."""
    return sales.where(F.col("city_id") == city).where(F.year("transacted_at") == year)


def city_year_range(sales: DataFrame, city: int, year: int) -> DataFrame:
    """The same rows with the year as a timestamp range, which does reach the scan."""
    start, end = (F.lit(f"{y}-01-01 00:00:00").cast("timestamp_ntz") for y in (year, year + 1))
    return sales.where((F.col("city_id") == city) & (F.col("transacted_at") >= start) & (F.col("transacted_at") < end))


def city_partition_year(sales: DataFrame, city: int, year: int) -> DataFrame:
    """City and the partition column: only that year's directory is listed."""
    return sales.where(F.col("city_id") == city).where(F.col(PARTITION) == year)


@dataclass(frozen=True)
class PartitionRelation:
    """What is known of a partitioned table: in every row ``column`` is ``derive(source)``.

    ``derive`` grows with its argument, as ``F.year`` and ``F.to_date`` do, so every test on the timestamp
    implies one on the partition column, which is all that a scan can leave folders out by.
    """

    column: str
    source: str
    derive: Callable[[Column], Column]

    def implied(self, test: str, value: Column) -> Column:
        """What a comparison of the timestamp with a constant says about the partition column."""
        own, instant = F.col(self.column), F.expr("INTERVAL 1 MICROSECOND")
        if test == "=":
            return own == self.derive(value)
        if test in (">", ">="):
            return own >= self.derive(value + instant if test == ">" else value)
        if test in ("<", "<="):
            return own <= self.derive(value - instant if test == "<" else value)
        raise ValueError(f"{test!r} is none of =, <, <=, >, >=")

    def violations(self, df: DataFrame) -> DataFrame:
        """Rows for which the relation does not hold; with any, implied tests would lose rows."""
        return df.where(~F.col(self.column).eqNullSafe(self.derive(F.col(self.source))))


SALES_YEAR = PartitionRelation(PARTITION, "transacted_at", F.year)


def where_time(df: DataFrame, relation: PartitionRelation, *tests: tuple[str, object]) -> DataFrame:
    """Rows that pass all ``(comparison, constant)`` tests on the timestamp; the implied partition tests are added.

    The caller names the timestamp only. NULL timestamps pass no test, as ever.
    """
    kind = df.schema[relation.source].dataType

    def both(test: str, value: object) -> Column:
        value, own = F.lit(value).cast(kind), F.col(relation.source)
        asked = {"=": own == value, ">": own > value, ">=": own >= value, "<": own < value, "<=": own <= value}
        return relation.implied(test, value) & asked[test]

    return df.where(reduce(Column.__and__, [both(*t) for t in tests], F.lit(True)))


def where_derived(df: DataFrame, relation: PartitionRelation, values: Sequence[object]) -> DataFrame:
    """Rows whose derived value, computed from the timestamp, is one of ``values``: the partition column says so."""
    computed = relation.derive(F.col(relation.source)).isin(list(values))
    return df.where(computed & F.col(relation.column).isin(list(values)))


def city_total(sales: DataFrame, city: int, amount: str = "amount") -> DataFrame:
    """Filter written after the aggregation; Spark moves it below, as it tests the grouping key."""
    return sales.groupBy("city_id").agg(F.sum(amount).alias("total_amount")).where(F.col("city_id") == city)


def derived_total(sales: DataFrame, rate: float = 0.2, min_total: float = 400) -> DataFrame:
    """A test on a computed column; it runs inside the scan stage but cannot be pushed to the files."""
    taxed = sales.withColumn("tax", F.col("amount") * rate).withColumn("total", F.col("amount") + F.col("tax"))
    return taxed.where(F.col("total") > min_total)


def cached_then_filtered(sales: DataFrame, city: int, year: int) -> DataFrame:
    """Cache first, filter second: the filters stop at the cache. For comparison only."""
    return city_partition_year(sales.persist(), city, year)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def scan_filters(df: DataFrame) -> dict[str, list[str]]:
    """``PushedFilters``, ``PartitionFilters`` and ``ReadSchema`` of every file scan in the plan."""
    found: dict[str, list[str]] = {"PushedFilters": [], "PartitionFilters": [], "ReadSchema": []}
    for line in plan_text(df).splitlines():
        name, _, value = line.partition(": ")
        if name in found:
            found[name].append(value.strip())
    return found


def assert_scan(df: DataFrame, pushed: list[str] = (), partition: list[str] = (), absent: list[str] = ()) -> None:
    """Check what the scan was told: wanted tests among the pushed and partition filters, others absent."""
    scans = scan_filters(df)
    pushed_text, partition_text = " ".join(scans["PushedFilters"]), " ".join(scans["PartitionFilters"])
    for test in pushed:
        if test not in pushed_text:
            raise AssertionError(f"{test} is not pushed: {pushed_text}")
    for test in partition:
        if test not in partition_text:
            raise AssertionError(f"{test} does not prune: {partition_text}")
    for test in absent:
        if test in pushed_text or test in partition_text:
            raise AssertionError(f"{test} reaches the scan: {pushed_text} {partition_text}")
