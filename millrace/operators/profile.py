"""Shapes, counts and per-column summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import join_groups
from .quantiles import melt, quantile_columns

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, kind in df.dtypes if kind in NUMERIC or kind.startswith("decimal")]


def text_columns(df: DataFrame) -> list[str]:
    return [c for c, kind in df.dtypes if kind == "string"]


def long_row(wide: DataFrame, fields: dict[str, list[tuple[str, Column]]]) -> DataFrame:
    """Turn one aggregated row into one row per entry of ``fields``."""
    structs = [
        F.struct(F.lit(name).alias("column_name"), *[c.alias(alias) for alias, c in columns])
        for name, columns in fields.items()
    ]
    return wide.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def column_profile(df: DataFrame) -> DataFrame:
    """Kind, rows, non-null values and distinct values of every column.

    Values are counted per column first, so a value that fills a third of the table is
    one record per map task.
    """
    numbers = set(numeric_columns(df))
    cells = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in df.columns]
    )
    counted = (
        df.select(F.explode(cells).alias("_c")).select("_c.*").groupBy("column_name", "value").agg(F.count("*").alias("n"))
    )
    kinds = F.create_map(*[F.lit(x) for c in df.columns for x in (c, "number" if c in numbers else "other")])
    return counted.groupBy("column_name").agg(
        F.sum("n").alias("row_count"),
        F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("non_null"),
        F.count("value").alias("distinct_values"),
    ).withColumn("kind", kinds[F.col("column_name")])


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values of every column in one pass."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return long_row(wide, {c: [("nulls", F.col(c))] for c in df.columns})


def low_variance_columns(df: DataFrame, below: float = 1.0) -> list[str]:
    """Numeric columns with a sample variance under ``below``."""
    names = numeric_columns(df)
    row = df.agg(*[F.var_samp(c).alias(c) for c in names]).first()
    return [c for c in names if row[c] is not None and row[c] < below]


def identifier_columns(df: DataFrame) -> list[str]:
    """Columns whose values are all different and never missing."""
    profile = column_profile(df).filter("distinct_values = row_count").select("column_name").collect()
    return sorted(r[0] for r in profile)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each value that is not null, most frequent first."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counted.orderBy(F.col("n").desc(), column)


def describe(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample deviation and variance, range and exact quartiles per column."""
    cells = melt(df, columns, by).filter(F.col("value").isNotNull())
    keys = [*by, "column_name"]
    moments = cells.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.var_samp("value").alias("variance"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        (F.max("value") - F.min("value")).alias("range"),
    )
    quartiles = quantile_columns(cells, "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}, keys)
    return moments.join(quartiles, keys)


def mean_abs_deviation(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean distance from the mean."""
    cells = melt(df, columns, by).filter(F.col("value").isNotNull())
    keys = [*by, "column_name"]
    means = cells.groupBy(*keys).agg(F.avg("value").alias("mean"))
    return join_groups(cells, means, keys).groupBy(*keys).agg(F.avg(F.abs(F.col("value") - F.col("mean"))).alias("mad"))


def adjusted_skewness(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Sample skewness with bias correction; Spark's own is the population form."""
    cells = melt(df, columns, by).filter(F.col("value").isNotNull())
    n = F.count("*").cast("double")
    return cells.groupBy(*by, "column_name").agg(
        F.when(n > 2, F.skewness("value") * F.sqrt(n * (n - 1)) / (n - 2)).alias("skew")
    )


def pairwise(df: DataFrame, columns: Sequence[str], measure) -> DataFrame:
    """Long-form symmetric matrix of a two-column aggregate, from one pass over the rows."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.agg(*[measure(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    entries = {}
    for a, b in pairs:
        entries[(a, b)] = entries[(b, a)] = F.col(f"`{a}|{b}`")
    structs = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), value.alias("value")) for (a, b), value in entries.items()
    ]
    return wide.select(F.explode(F.array(*structs)).alias("_p")).select("_p.*")


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return pairwise(df, columns, F.corr)


def covariances(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return pairwise(df, columns, F.covar_samp)


def uncorrelated_columns(df: DataFrame, columns: Sequence[str], limit: float = 0.5) -> DataFrame:
    """Columns whose correlation with every other one stays within ``limit``."""
    others = correlations(df, columns).filter("a <> b")
    strongest = others.groupBy("a").agg(F.max(F.abs("value")).alias("strongest"))
    return strongest.filter(F.col("strongest") <= limit).select(F.col("a").alias("column_name"), "strongest")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins from minimum to maximum; the last bin is closed on the right."""
    span = df.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi")).first()
    width = (span.hi - span.lo) / bins or 1.0
    bin_no = F.least(F.floor((F.col(column) - F.lit(span.lo)) / F.lit(width)), F.lit(bins - 1))
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(bin_no.cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
        .withColumn("lower", F.lit(span.lo) + F.col("bin") * F.lit(width))
    )


def box_stats(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Quartiles, whisker ends and the number of points beyond the fences."""
    cells = melt(df, columns, by).filter(F.col("value").isNotNull())
    keys = [*by, "column_name"]
    boxes = quantile_columns(cells, "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}, keys)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    fenced = boxes.withColumn("low_fence", F.col("q1") - reach).withColumn("high_fence", F.col("q3") + reach)
    inside = (F.col("value") >= F.col("low_fence")) & (F.col("value") <= F.col("high_fence"))
    return (
        join_groups(cells, fenced, keys)
        .groupBy(*keys, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )
