"""Hypothesis tests: moments per group on Spark, then the statistic, then the p-value on few rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import distributions as dist
from ..operators.joins import join_groups
from ..operators.quantiles import quantile_columns
from ..session import shuffle_width


def t_one_sample(df: DataFrame, value: str, expected: float = 0.0, by: Sequence[str] = ()) -> DataFrame:
    """n, mean, standard error, t and degrees of freedom."""
    moments = df.groupBy(*by).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        (F.stddev_samp(value) / F.sqrt(F.count(value))).alias("se"),
    )
    return moments.withColumn("t", F.try_divide(F.col("mean") - F.lit(expected), F.col("se"))).withColumn(
        "df", (F.col("n") - 1).cast("double")
    )


def t_paired(first: DataFrame, second: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """One-sample test of the differences of two measures of the same key."""
    pairs = first.select(*key, F.col(value).alias("_a")).join(second.select(*key, F.col(value).alias("_b")), list(key))
    return t_one_sample(pairs.withColumn("difference", F.col("_a") - F.col("_b")), "difference")


def two_groups(df: DataFrame, group: str, value: str, a, b) -> DataFrame:
    """Size, mean and sample variance of two groups in one row."""
    inside = lambda g: F.when(F.col(group) == g, F.col(value))
    return df.filter(F.col(group).isin(a, b)).agg(
        *[
            f(inside(g)).alias(f"{name}_{side}")
            for side, g in (("a", a), ("b", b))
            for name, f in (("n", F.count), ("mean", F.avg), ("var", F.var_samp))
        ]
    )


def t_welch(df: DataFrame, group: str, value: str, a, b) -> DataFrame:
    """Two samples of unequal variance."""
    moments = two_groups(df, group, value, a, b)
    va, vb = F.col("var_a") / F.col("n_a"), F.col("var_b") / F.col("n_b")
    return moments.select(
        "n_a",
        "n_b",
        ((F.col("mean_a") - F.col("mean_b")) / F.sqrt(va + vb)).alias("t"),
        ((va + vb) * (va + vb) / (va * va / (F.col("n_a") - 1) + vb * vb / (F.col("n_b") - 1))).alias("df"),
    )


def anova_oneway(df: DataFrame, group: str, value: str) -> DataFrame:
    """Between and within sums of squares, degrees of freedom, mean squares and F in one row.

    Group deviations are summed per group around the group's own mean, so large means lose
    no digits.
    """
    groups = df.filter(F.col(value).isNotNull() & F.col(group).isNotNull()).groupBy(group).agg(
        F.count("*").alias("n"), F.avg(value).alias("mean"), (F.var_pop(value) * F.count("*")).alias("inner")
    )
    one = F.lit(1).alias("_one")
    grand = groups.select(one, "n", "mean").groupBy("_one").agg(
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand")
    )
    gap = F.col("mean") - F.col("grand")
    # the right side is a single row
    table = (
        groups.select("*", one)
        .join(grand, "_one")
        .agg(
            F.sum(F.col("n") * gap * gap).alias("ss_between"),
            F.sum("inner").alias("ss_within"),
            (F.count("*") - 1).cast("double").alias("df_between"),
            (F.sum("n") - F.count("*")).cast("double").alias("df_within"),
        )
    )
    ms_between, ms_within = F.col("ss_between") / F.col("df_between"), F.col("ss_within") / F.col("df_within")
    return table.withColumns({"ms_between": ms_between, "ms_within": ms_within, "f": ms_between / ms_within})


def levene(df: DataFrame, group: str, value: str) -> DataFrame:
    """Equality of variances: one-way table of the distances from the group medians."""
    centres = quantile_columns(df, value, {"_median": 0.5}, [group])
    distances = join_groups(df, centres, [group]).withColumn("_distance", F.abs(F.col(value) - F.col("_median")))
    return anova_oneway(distances, group, "_distance")


def regression_f(df: DataFrame, target: str, predictor: str) -> DataFrame:
    """F of a straight line with one numeric predictor."""
    fit = df.agg(
        F.regr_count(target, predictor).alias("n"),
        F.regr_slope(target, predictor).alias("slope"),
        F.regr_intercept(target, predictor).alias("intercept"),
        F.regr_r2(target, predictor).alias("r2"),
    )
    residual_df = (F.col("n") - 2).cast("double")
    return fit.withColumns({"df_residual": residual_df, "f": F.col("r2") / (1 - F.col("r2")) * residual_df})


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """Observed and expected counts for every pair of values, empty cells included."""
    observed = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count("*").alias("observed"))
    rows = observed.groupBy(a).agg(F.sum("observed").alias("_row"))
    columns = observed.groupBy(b).agg(F.sum("observed").alias("_column"))
    total = observed.agg(F.sum("observed")).first()[0] or 0
    # the grid is what is asked for; it is laid out by shares of the columns, so that no task holds a whole margin
    shares = shuffle_width(df)
    grid = (
        rows.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
        .join(columns.withColumn("_share", F.pmod(F.xxhash64(b), F.lit(shares)).cast("int")), "_share")
        .select(a, b, (F.col("_row") * F.col("_column") / F.lit(total)).alias("expected"))
    )
    return grid.join(observed, [a, b], "left").na.fill(0, ["observed"])


def chi_square(df: DataFrame, a: str, b: str) -> DataFrame:
    """Chi-square statistic and degrees of freedom of a contingency table.

    Empty cells add what the sum over all cells of the expected counts leaves, so only cells with
    rows are needed: n times the sum of observed ** 2 / (row * column), less n.
    """
    observed = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count("*").alias("observed"))
    rows = observed.groupBy(a).agg(F.sum("observed").alias("_row"))
    columns = observed.groupBy(b).agg(F.sum("observed").alias("_column"))
    share = F.col("observed") / F.col("_row") * (F.col("observed") / F.col("_column"))
    return (
        observed.join(rows, a).join(columns, b)
        .agg(
            (F.sum("observed") * (F.sum(share) - 1)).alias("chi2"),
            ((F.countDistinct(a) - 1) * (F.countDistinct(b) - 1)).cast("double").alias("df"),
        )
    )


def z_two_proportions(df: DataFrame, group: str, flag: str, a, b) -> DataFrame:
    """Pooled z of two shares; ``flag`` is 0/1."""
    moments = two_groups(df.withColumn(flag, F.col(flag).cast("double")), group, flag, a, b)
    pooled = (F.col("mean_a") * F.col("n_a") + F.col("mean_b") * F.col("n_b")) / (F.col("n_a") + F.col("n_b"))
    spread = F.sqrt(pooled * (1 - pooled) * (1 / F.col("n_a") + 1 / F.col("n_b")))
    return moments.select(
        "n_a", "n_b", F.col("mean_a").alias("share_a"), F.col("mean_b").alias("share_b"), ((F.col("mean_a") - F.col("mean_b")) / spread).alias("z")
    )


def with_t_p(df: DataFrame) -> DataFrame:
    return df.withColumns({"p": dist.t_two_sided_column("t", "df"), "critical": dist.t_critical_column("df")})


def with_f_p(df: DataFrame, df1, df2) -> DataFrame:
    return df.withColumn("p", dist.f_tail_column(F.col("f"), df1, df2))


def with_chi2_p(df: DataFrame) -> DataFrame:
    return df.withColumn("p", dist.chi2_tail_column("chi2", "df"))


def with_z_p(df: DataFrame) -> DataFrame:
    return df.withColumn("p", 2 * dist.normal_tail_column(F.abs("z")))
