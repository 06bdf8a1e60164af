"""Writing tables: stage outputs, external tables, exports, relocation with verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def write_parquet(df: DataFrame, path: str, *partition_by: str) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write a stage and read it back: later plans start at the files and know their true size."""
    write_parquet(df, path)
    return df.sparkSession.read.parquet(path)


def write_partitioned(df: DataFrame, path: str, partition: str, *cluster_by: str) -> None:
    """Write one directory per ``partition`` value, rows inside clustered by ``cluster_by``.

    The range shuffle spreads a large partition value over many tasks, gives each task few
    directories to write and narrows the min/max statistics that a scan skips by.
    """
    ranged = df.repartitionByRange(*[F.col(c) for c in (partition, *cluster_by)])
    ranged.sortWithinPartitions(partition, *cluster_by).write.mode("overwrite").partitionBy(partition).parquet(path)


def save_table(df: DataFrame, name: str, path: str) -> None:
    """Overwrite an external catalog table stored at ``path``."""
    df.write.mode("overwrite").option("path", path).saveAsTable(name)


def export_csv(df: DataFrame, path: str, files: int | None = 1) -> None:
    """CSV with header in the given number of files, one for a report; None leaves it to the plan."""
    # repartition, not coalesce: what computes the report keeps its tasks, only its rows are gathered.
    report = df.repartition(files) if files else df
    report.write.mode("overwrite").option("header", True).csv(path)


def force(df: DataFrame) -> None:
    """Run the whole plan and drop the rows."""
    df.write.format("noop").mode("overwrite").save()


def content_hash(df: DataFrame) -> Column:
    """Order-free content sum over all rows; decimal, because a BIGINT sum of hashes can overflow."""
    return F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)"))


def partition_columns(df: DataFrame, path: str) -> list[str]:
    """Columns that a data set's folders stand for, outermost first, read from the name of one of its files."""
    first = next(iter(df.inputFiles()), "")
    folders = [part.split("=", 1)[0] for part in first.split("/")[:-1] if "=" in part]
    return [name for name in folders if name in df.columns and f"{name}=" not in path]


def relocate(spark: SparkSession, source: str, dest: str) -> DataFrame:
    """Copy a Parquet data set with its partitions and report both sides' row count and content hash."""
    original = spark.read.parquet(source)
    write_parquet(original, dest, *partition_columns(original, source))
    copied = spark.read.parquet(dest).select(*original.columns)

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias("n"), content_hash(df).alias("h")).select(F.lit(name).alias("side"), "n", "h")

    both = side(original, "source").unionByName(side(copied, "dest"))
    pick = {(s, c): F.max(F.when(F.col("side") == s, F.col(c))) for s in ("source", "dest") for c in ("n", "h")}
    return both.agg(
        pick["source", "n"].alias("source_rows"),
        pick["dest", "n"].alias("dest_rows"),
        (pick["source", "n"] == pick["dest", "n"]).alias("rows_match"),
        pick["source", "h"].eqNullSafe(pick["dest", "h"]).alias("content_match"),
    )
