"""Cleaning and feature preparation: each step learns small aggregates, then applies them by a join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import global_row_number
from ..operators.quantiles import exact_quantiles, melt, quantile_columns


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact medians of several columns, one number per column."""
    found = exact_quantiles(melt(df, columns), "value", [0.5], ["column_name"]).collect()
    return {r["column_name"]: r["quantile"] for r in found}


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values become the column's median."""
    middle = medians(df, columns)
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(middle[c])) for c in columns})


def zero_to_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Zeros become the column's median, which still counts the zeros."""
    middle = medians(df, columns)
    return df.withColumns({c: F.when(F.col(c) == 0, F.lit(middle[c])).otherwise(F.col(c)) for c in columns})


def parse_or(df: DataFrame, column: str, default: str | float) -> DataFrame:
    """Text to numbers; text that is no number becomes ``default`` or, for "mean", the mean of the rest."""
    parsed = df.withColumn(column, F.col(column).try_cast("double"))
    if default == "mean":
        default = parsed.agg(F.avg(column)).first()[0]
    return parsed.withColumn(column, F.coalesce(column, F.lit(float(default))))


def outside_to_mean(df: DataFrame, column: str, low: float, high: float, valid_only: bool = False) -> DataFrame:
    """Values outside [low, high] become the mean of all values, or of the valid ones only."""
    inside = F.col(column).between(low, high)
    mean = df.agg(F.avg(F.when(inside, F.col(column)) if valid_only else F.col(column))).first()[0]
    return df.withColumn(column, F.when(inside, F.col(column).cast("double")).otherwise(F.lit(mean)))


def cap_high(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values from the upper fence, third quartile plus 1.5 quartile ranges, become the fence."""
    found = quantile_columns(melt(df, columns), "value", {"q1": 0.25, "q3": 0.75}, ["column_name"]).collect()
    fence = {r["column_name"]: r["q3"] + 1.5 * (r["q3"] - r["q1"]) for r in found}
    return df.withColumns({c: F.least(F.col(c).cast("double"), F.lit(fence[c])) for c in columns})


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """Distinct values with codes 0..k-1 in sorted order."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return global_row_number(values, [column], name="code").withColumn("code", (F.col("code") - 1).cast("int"))


def encode_labels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_code`` for each column."""
    for column in columns:
        codes = label_codes(df, column).withColumnRenamed("code", f"{column}_code")
        df = df.join(codes, column, "left")
    return df


def dummies(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """One 0/1 column per value, none left out."""
    return df.withColumns({f"{column}_{v}": (F.col(column) == v).cast("int") for v in values})


def standard_scales(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each column."""
    row = df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in columns}


def standardize(df: DataFrame, scales: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in scales.items()})


def z_scores_by_row(values: Column) -> Column:
    """An array's values about its own mean in its own population deviation."""
    n = F.size(values)
    mean = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x) / n
    spread = F.sqrt(F.aggregate(values, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean)) / n)
    return F.transform(values, lambda x: F.try_divide(x - mean, spread))


def poisson_steps() -> list[float]:
    """The distribution function of Poisson(1) at 0, 1, 2, ..., as far as 48 bits tell it from 1."""
    probability, total, steps = 2.718281828459045**-1, 0.0, []
    while total + probability <= 1 - 2.0**-48:
        total += probability
        steps.append(total)
        probability /= len(steps)
    return steps


def poisson_draws(uniform: Column) -> Column:
    """Poisson(1): how many steps of its distribution function do not exceed the number drawn."""
    return sum(((uniform >= step).cast("int") for step in poisson_steps()), F.lit(0))


def hash_uniform(seed: str, key: Column, replicate: Column) -> Column:
    """A number in [0, 1) of 48 bits that depends on row and replicate alone."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), key.cast("string"), replicate.cast("string")))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def bootstrap(df: DataFrame, key: str, value: str, replicates: int, seed: str = "") -> DataFrame:
    """Means of resampled rows: each row enters a replicate a Poisson(1) number of times.

    The counts come from a hash of row and replicate, so all replicates are one pass, the
    same on every run, and a row's share of the shuffle is one partial sum per replicate.
    """
    rows = df.withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    rows = rows.withColumn("weight", poisson_draws(hash_uniform(seed, F.col(key), F.col("replicate"))))
    return rows.groupBy("replicate").agg(
        (F.sum(F.col(value) * F.col("weight")) / F.sum("weight")).alias("mean"), F.sum("weight").alias("n")
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Largest class count divided by each class count."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    # one row per class
    return counts.withColumn("weight", F.max("n").over(Window.partitionBy(F.lit(0))) / F.col("n"))
