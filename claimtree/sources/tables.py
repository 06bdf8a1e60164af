"""Reading tables: files, catalog tables, partitioned lake tables, object listings."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Comma-separated file with a header. Without a schema every column is text; nothing is inferred."""
    reader = spark.read.option("header", True).option("delimiter", ",")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_partitioned(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A directory-partitioned table. ``fmt='delta'`` works where that connector is installed."""
    return spark.read.format(fmt).load(path)


# Replacements for column names, applied in this order.
NAME_CLEANUP = [(" ", ""), ("#", "no"), ("(", ""), (")", ""), ("-", ""), (":", "_"), (".", "")]


def clean_name(name: str) -> str:
    for old, new in NAME_CLEANUP:
        name = name.replace(old, new)
    return name


def clean_columns(df: DataFrame) -> DataFrame:
    """Rename every column to its cleaned name; two names that clean to the same one are an error."""
    names = [clean_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, new in zip(df.columns, names):
        if new.lower() in seen:
            raise ValueError(f"columns {seen[new.lower()]!r} and {old!r} both become {new!r}")
        seen[new.lower()] = old
    return df.toDF(*names)


def resolve_column(df: DataFrame, name: str) -> str:
    """The column called ``name`` or, for ``snake_case`` names, its ``Title Case`` spelling."""
    if name in df.columns:
        return name
    words = [re.match("([^A-Za-z]*)(.?)(.*)", w, re.DOTALL).groups() for w in name.split("_")]
    titled = " ".join(lead + first.upper() + rest.lower() for lead, first, rest in words)
    if titled in df.columns:
        return titled
    raise ValueError(f"no column {name!r} or {titled!r} among {df.columns}")


def require_sources(spark: SparkSession, names: dict[str, str]) -> None:
    """``names`` maps a role (columns, config, hierarchy, images) to a catalog table or view."""
    for role, name in names.items():
        if not spark.catalog.tableExists(name):
            raise ValueError(f"Cannot find {role} data {name!r}: ensure the {role} source name is valid.")


def require_nonempty(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("Empty data on filtering: check whether the value exists in the data.")
    return df


def copy_manifest(spark: SparkSession, source: str, dest_prefix: str) -> DataFrame:
    """One row per object under ``source`` with its size and rewritten destination key.

    Only file status is read; the ``content`` column is pruned from the scan.
    """
    prefix = source.rstrip("/") + "/"
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    key = F.substring(F.col("path"), F.instr("path", prefix) + len(prefix), F.length("path"))
    return listing.select(
        F.col("path").alias("source_path"),
        key.alias("relative_key"),
        F.concat(F.lit(dest_prefix.rstrip("/") + "/"), key).alias("dest_key"),
        F.col("length"),
    )


def bounded_rows(df: DataFrame, limit: int, what: str) -> list:
    """Rows of a settings table on the driver; a table above ``limit`` rows is refused, not cut."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what} has more than {limit} rows; it is not a settings table")
    return rows
