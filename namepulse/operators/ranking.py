"""Positions and top rows of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import as_column
from ..streaming.storage import fresh_dir

# About so many rows of one group at most are put in order by one task.
RUN_ROWS = 1 << 18

# Quantiles of the order that are looked up; each part between two may be cut further.
QUANTILES = 512


def _part_of(order: Column, bounds: Sequence, first: int = 0) -> Column:
    """How many bounds are at or below a value, by a search tree of conditions."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    return F.when(
        order < F.lit(bounds[middle]), _part_of(order, bounds[:middle], first)
    ).otherwise(_part_of(order, bounds[middle + 1 :], first + middle + 1))


def order_runs(df: DataFrame, order: str, run_rows: int | None = None) -> Column:
    """A run number that never falls as the integer column `order` grows.

    Runs are cut at quantiles of the column, whatever its values are: dense, sparse or
    random ids. All rows of a run together are about `run_rows`, so those of one group are
    no more, and a group has no more runs than there are. Costs one pass over the column.
    """
    run_rows = run_rows or RUN_ROWS
    shares = F.array(*[F.lit(i / QUANTILES) for i in range(1, QUANTILES)])
    found = df.agg(
        F.count(order).alias("n"),
        F.max(order).alias("last"),
        F.percentile_approx(order, shares, 20 * QUANTILES).alias("bounds"),
        F.min(order).alias("first"),
    ).first()
    wanted = -(-found["n"] // run_rows)
    if wanted <= 1:
        return F.lit(0)
    every = max(1, QUANTILES // wanted)
    bounds = sorted(set(found["bounds"][every - 1 :: every]))
    part = _part_of(F.col(order), bounds)
    further = -(-wanted // (len(bounds) + 1))
    if further == 1:
        return part
    # Evenly within a part, in floating point: rounding keeps the order of values.
    edges = [found["first"], *bounds, found["last"] + 1]
    low, high = (
        F.get(F.array(*[F.lit(float(e)) for e in side]), part) for side in (edges[:-1], edges[1:])
    )
    within = F.floor((F.col(order).cast("double") - low) / (high - low) * further)
    return part * further + F.least(F.greatest(within, F.lit(0)), F.lit(further - 1))


def position_in_group(
    df: DataFrame,
    keys: Sequence[str],
    chunk: Column | str,
    order: Sequence[str],
    first: Column | None = None,
) -> DataFrame:
    """Add the position of each row in its group (from 0) and the group's total.

    `chunk` cuts a group into consecutive runs of bounded size, as `order_runs` does. Only a
    run is ever put in order by one task; a group's runs are placed by their row counts, so a
    group may hold any share of the rows. With `first`, also that value of the group's first
    row. `order` must be a single numeric column then. Rows with a NULL key are dropped.
    """
    keys = list(keys)
    runs = [*keys, "_chunk"]
    chunked = df.withColumn("_chunk", as_column(chunk))
    counts = [F.count(F.lit(1)).alias("_n")]
    if first is not None:
        (by,) = order
        counts.append(F.min_by(first, F.col(by)).alias("_first"))
    sizes = chunked.groupBy(*runs).agg(*counts)

    group = Window.partitionBy(*keys)
    in_order = group.orderBy("_chunk")
    before = F.sum("_n").over(
        in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ) - F.col("_n")
    placed = [before.alias("_before"), F.sum("_n").over(group).alias("total")]
    if first is not None:
        placed.append(F.first("_first").over(in_order).alias("first"))
    starts = sizes.select(*runs, *placed)

    run = Window.partitionBy(*runs).orderBy(*order)
    at = chunked.withColumn("_at", F.row_number().over(run) - 1)
    return (
        at.join(starts, runs)
        .withColumn("position", F.col("_before") + F.col("_at"))
        .drop("_chunk", "_at", "_before")
    )


def placed_in_order(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    first: Column | None = None,
    run_rows: int | None = None,
) -> DataFrame:
    """What `position_in_group` adds, by one ordering column and without runs given.

    Up to `run_rows` rows are put in order group by group. More are dealt out by range of keys
    and order, so that a task holds about that many of them, whosever they are, and written to
    the shared folder in this order. A row's position is its place in its partition, less where
    its group begins there, plus the group's rows in the partitions before: a running sum over
    one count per partition and group. A group spans neighbouring partitions, so these counts
    are at most as many as partitions and groups together. Rows with a NULL key are dropped.
    """
    keys, run_rows = list(keys), run_rows or RUN_ROWS
    known = df.dropna(subset=keys)
    rows = known.count()
    if rows <= run_rows:
        group = Window.partitionBy(*keys)
        placed = known.withColumn("position", (F.row_number().over(group.orderBy(order)) - 1).cast("bigint"))
        placed = placed.withColumn("total", F.count(F.lit(1)).over(group))
        return placed if first is None else placed.withColumn("first", F.min_by(first, order).over(group))

    spark = df.sparkSession
    path = fresh_dir(spark, "positions")
    dealt = known.repartitionByRange(-(-rows // run_rows), *keys, order).sortWithinPartitions(*keys, order)
    in_order = dealt.withColumns({"_run": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    in_order.write.parquet(path)
    written = spark.read.schema(in_order.schema).parquet(path)

    counts = [F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_begins")]
    if first is not None:
        counts.append(F.min_by(first, "_at").alias("_first"))
    runs = written.groupBy(*keys, "_run").agg(*counts)
    group = Window.partitionBy(*keys)
    before = F.sum("_n").over(group.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1))
    placed = [F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_n").over(group).alias("total"), "_begins"]
    if first is not None:
        placed.append(F.first("_first").over(group.orderBy("_run")).alias("first"))
    return (
        written.join(runs.select(*keys, "_run", *placed), [*keys, "_run"])
        .withColumn("position", F.col("_before") + F.col("_at") - F.col("_begins"))
        .drop("_run", "_at", "_before", "_begins")
    )


def top_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int
) -> DataFrame:
    """The first `n` rows of each group with their `rank` (from 1).

    Each task cuts its own rows to `n` per group before the shuffle.
    """
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (
        df.withColumn("_rank", ranked)
        .where(F.col("_rank") <= n)
        .withColumn("rank", F.col("_rank").cast("bigint"))
        .drop("_rank")
    )
