"""Top-n, global positions and running totals without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def top_n(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows of each group; Spark trims each map task to ``n`` before the shuffle."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def running_total(
    df: DataFrame,
    order: Sequence[str],
    sums: dict[str, Column],
    by: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Add inclusive running sums over a total order, per group, spread over range partitions.

    Rows are range-partitioned by group and order, so a group holding most rows still
    spans many tasks. The partition number is frozen by a checkpoint; partition totals
    then give each partition the sum of everything before it. ``order`` must be unique
    inside a group, or at least tie-free for the result to be repeatable.
    """
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    keys = [F.col(c).asc() for c in by] + [direction(c) for c in order]
    staged = df.select("*", *[expr.alias(f"_in_{name}") for name, expr in sums.items()])
    ranged = cut(staged.repartitionByRange(*keys).withColumn("_slice", F.spark_partition_id()))

    slices = ranged.groupBy(*by, "_slice").agg(*[F.sum(f"_in_{n}").alias(f"_slice_{n}") for n in sums])
    # one row per group and range partition
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(
        *by,
        "_slice",
        *[F.coalesce(F.sum(f"_slice_{n}").over(before), F.lit(0)).alias(f"_before_{n}") for n in sums],
    )
    inside = (
        Window.partitionBy(*by, "_slice")
        .orderBy(*[direction(c) for c in order])
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    summed = ranged.select("*", *[F.sum(f"_in_{n}").over(inside).alias(f"_inside_{n}") for n in sums])
    joined = summed.join(offsets, [*by, "_slice"])
    return joined.select(
        *df.columns, *[(F.col(f"_before_{n}") + F.col(f"_inside_{n}")).alias(n) for n in sums]
    )


def global_row_number(
    df: DataFrame, order: Sequence[str], by: Sequence[str] = (), name: str = "row_no", descending: bool = False
) -> DataFrame:
    """Number all rows 1..n in a unique order."""
    return running_total(df, order, {name: F.lit(1).cast("bigint")}, by, descending)


def contiguous_folds(df: DataFrame, order: Sequence[str], folds: int, name: str = "fold") -> DataFrame:
    """Contiguous folds 1..k over a unique order; the first ``n % k`` folds hold one row more."""
    total = df.count()
    size, longer = divmod(total, folds)
    head = longer * (size + 1)
    numbered = global_row_number(df, order, name="_row")
    zero_based = F.col("_row") - 1
    fold = F.when(zero_based < head, F.floor(zero_based / (size + 1)) + 1).otherwise(
        longer + F.floor((zero_based - head) / max(size, 1)) + 1
    )
    return numbered.withColumn(name, fold.cast("int")).drop("_row")


def hash_unit(*columns: str) -> Column:
    """A number in [0, 1) that depends on the row's key alone, never on partitioning."""
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
