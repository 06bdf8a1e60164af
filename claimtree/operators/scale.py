"""Size-checked broadcast, joins that no key can skew, and ranking inside groups of any size."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F, types as T

from claimtree.session import scratch_path
from claimtree.sources.sinks import materialize

BROADCAST_BYTES = 64 * 1024 * 1024
GROUP_ROWS = 2_000_000
# Rows of a key from which they are dealt out in pieces, each of about this many, and keys treated so at most: one
# beyond them holds less than a thousandth of the rows.
HEAVY_ROWS, HEAVY_KEYS = 50_000, 1000


def row_width(schema: T.StructType) -> int:
    """Generous in-memory bytes per row: 64 for text, 16 for the rest, 16 of overhead."""
    return 16 + sum(64 if isinstance(f.dataType, T.StringType) else 16 for f in schema)


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate, or None where the session does not expose it."""
    plan = getattr(df, "_jdf", None)
    return None if plan is None else int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def dim_side(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only for a side known to be small; otherwise leave a shuffle join.

    The optimizer's estimate is trusted when it is already below the bound. Above it the estimate may
    merely be the product of two small tables, so the rows are counted, and the count stops at the
    bound. An unhinted side is joined by shuffle, where adaptive execution splits skewed partitions.
    """
    size = estimated_bytes(df)
    if size is not None and size <= max_bytes // 4:
        return F.broadcast(df)
    max_rows = max_bytes // row_width(df.schema)
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def left_lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[str, str]],
    side: Callable[[DataFrame], DataFrame] = dim_side,
    heavy_rows: int | None = HEAVY_ROWS,
) -> DataFrame:
    """Left join of ``fact`` with ``dim`` on pairs of columns with different names; all columns of both are kept.

    A small ``dim`` is broadcast. A larger one is joined by shuffle, evenly whatever the keys are: rows with a
    NULL key, which meet nothing, are dealt out by their own hash, and so are the rows of a key that has at
    least ``heavy_rows`` of them (None: no key), whose rows in ``dim`` are repeated for each piece. Heavy keys
    are counted by the plan itself, from the key columns only, so nothing runs while the plan is built.
    """
    hinted = side(dim)
    matches = reduce(Column.__and__, [F.col(a) == F.col(b) for a, b in on])
    if hinted is not dim:
        return fact.join(hinted, matches, "left")
    keys, dim_keys = [a for a, _ in on], [b for _, b in on]
    # The partition's number tells repeated rows of one key apart; both are the same when a task is repeated.
    own_hash = F.xxhash64(*fact.columns, F.spark_partition_id())
    missing = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    piece, pieces = F.when(missing, own_hash), F.lit(1)
    if heavy_rows is not None:
        names = [f"_heavy_{i}" for i in range(len(keys))]
        counts = fact.where(~missing).groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]).count()
        heavy = counts.where(F.col("count") >= heavy_rows).orderBy(F.desc("count"), *names).limit(HEAVY_KEYS)
        heavy = F.broadcast(heavy.select(*names, F.ceil(F.col("count") / heavy_rows).alias("_pieces")))
        same = lambda columns: reduce(Column.__and__, [F.col(c) == F.col(n) for c, n in zip(columns, names, strict=True)])
        fact, dim = fact.join(heavy, same(keys), "left"), dim.join(heavy, same(dim_keys), "left").drop(*names)
        piece, pieces = piece.when(F.col("_pieces").isNotNull(), F.pmod(own_hash, F.col("_pieces"))), F.coalesce("_pieces", F.lit(1))
        fact = fact.drop(*names)
    # Never more than 0 for a key that is not heavy, but no constant, so that it stays part of the join's key.
    first = F.pmod(F.xxhash64(*dim_keys), F.lit(1))
    dealt = fact.withColumn("_piece", piece.otherwise(F.lit(0))).drop("_pieces")
    repeated = dim.withColumn("_copy", F.explode(F.sequence(first, pieces - 1))).drop("_pieces")
    return dealt.join(repeated, matches & (F.col("_piece") == F.col("_copy")), "left").drop("_piece", "_copy")


def ranked(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    position: str = "position",
    total: str | None = None,
    group_rows: int = GROUP_ROWS,
    running: tuple[str, str] | None = None,
    probe: DataFrame | None = None,
) -> DataFrame:
    """1-based ``position`` of each row in its group, and the group's row count as ``total``.

    ``running=(column, name)`` also adds the sum of a column over the rows before this one.
    ``order`` must be unique inside a group. Groups are first counted (a partial aggregate over the
    group columns only, of ``probe`` where that is a cheaper table with the same groups). While the largest fits one task, a window ranks them in one shuffle. If one
    is larger, all rows are range-sorted by group and order instead, which splits that group over
    many tasks, and positions are made from per-task counts.
    """
    largest = (probe or df).groupBy(*group).count().agg(F.max("count")).first()[0] or 0
    if largest > group_rows:
        return _ranked_by_range(df, group, order, position, total, running)
    whole = Window.partitionBy(*group)
    added = {position: F.row_number().over(whole.orderBy(*order))}
    if running:
        added[running[1]] = sum_before(running[0], whole.orderBy(*order))
    if total:
        added[total] = F.count("*").over(whole)
    return df.withColumns(added)


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """All rows with their place in ``order``, from 0 without gaps; stored, since a second sort may cut elsewhere.

    Rows are range-sorted over all tasks, and a task's numbers start behind those of the tasks before it.
    """
    spark = df.sparkSession
    placed = df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id())
    placed = materialize(placed, scratch_path(spark, "numbered")).withColumn("_task", F.shiftright("_id", 33))
    # One row per task.
    tasks = placed.groupBy("_task").agg(F.count("*").alias("_rows"))
    before = tasks.select(F.col("_task").alias("_own"), sum_before("_rows", Window.orderBy("_task")).alias("_before"))
    inside = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    met = placed.join(F.broadcast(before), F.col("_task") == F.col("_own"))
    return met.select(*df.columns, (inside + F.col("_before")).alias(name))


def sum_before(column: str, window: WindowSpec) -> Column:
    return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _ranked_by_range(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    position: str,
    total: str | None,
    running: tuple[str, str] | None,
) -> DataFrame:
    # Ids grow by 1 inside a task and tasks are numbered in sort order. They must be stored before
    # use: the range bounds come from a sample, so a second run of the sort may cut elsewhere.
    spark = df.sparkSession
    sorted_rows = df.orderBy(*group, *order).withColumn("_id", F.monotonically_increasing_id())
    stored = materialize(sorted_rows, scratch_path(spark, "ranked")).withColumn("_task", F.shiftright("_id", 33))
    counts = [F.min("_id").alias("_first"), F.count("*").alias("_rows")]
    if running:
        counts.append(F.sum(running[0]).alias("_sum"))
    pieces = stored.groupBy(*group, "_task").agg(*counts)
    in_order = Window.partitionBy(*group).orderBy("_task")
    pieces = pieces.withColumn("_before", sum_before("_rows", in_order))
    carried = ["_first", "_before"]
    if running:
        pieces = pieces.withColumn("_sum_before", sum_before("_sum", in_order))
        carried.append("_sum_before")
    if total:
        pieces = pieces.withColumn(total, F.sum("_rows").over(Window.partitionBy(*group)))
        carried.append(total)
    keys = [*group, "_task"]
    piece = pieces.select(*[F.col(k).alias(f"_piece_{k}") for k in keys], *carried)
    joined = stored.join(piece, [F.col(k).eqNullSafe(F.col(f"_piece_{k}")) for k in keys])
    added = [(F.col("_id") - F.col("_first") + F.col("_before") + 1).cast("int").alias(position)]
    if running:
        inside = sum_before(running[0], Window.partitionBy(*keys).orderBy("_id"))
        added.append((inside + F.col("_sum_before")).alias(running[1]))
    if total:
        added.append(F.col(total))
    return joined.select(*df.columns, *added)
