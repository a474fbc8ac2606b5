"""Array, vector and long-form matrix helpers that Spark has no single call for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import sized

#: Cells of an inner index of a matrix product in one task.
CELLS_PER_SALT = 10_000


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)


def mean(a: Column) -> Column:
    return F.try_divide(total(a), F.size(a))


def count_of(a: Column, value) -> Column:
    return F.size(F.filter(a, lambda x: x == value))


def remove_first(a: Column, value) -> Column:
    """Drop the first match only; ``array_remove`` would drop them all."""
    at = F.array_position(a, value).cast("int")
    rest = F.concat(F.slice(a, F.lit(1), at - 1), F.slice(a, at + 1, F.size(a)))
    return F.when(at > 0, rest).otherwise(a)


def one_hot(label: Column, classes: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda i: (i == label).cast("int"))


def arg_max(scores: Column) -> Column:
    """Zero-based place of the largest score, the first one on ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def l2_normalized(a: Column) -> Column:
    length = norm(a)
    return F.when(length > 0, F.transform(a, lambda x: x / length)).otherwise(a)


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y))))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def doubles(a: Column) -> Column:
    return F.transform(a, lambda x: x.cast("double"))


def transpose(matrix: DataFrame) -> DataFrame:
    """Swap rows and columns of an (i, j, v) matrix."""
    return matrix.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def identity(matrix: DataFrame) -> DataFrame:
    """Identity over the row labels of an (i, j, v) matrix, ones only."""
    rows = matrix.select("i").distinct()
    return rows.select("i", F.col("i").alias("j"), F.lit(1.0).alias("v"))


def product(a: DataFrame, b: DataFrame) -> DataFrame:
    """Matrix product in long form: join on the inner index, sum map-side.

    An inner index with n cells on the left and m on the right makes n * m products. Those with
    many cells on the left are cut into salts of bounded size, each of which meets a copy of the
    right cells.
    """
    left = a.select("i", F.col("j").alias("_k"), F.col("v").alias("_a"))
    right = b.select(F.col("i").alias("_k"), "j", F.col("v").alias("_b"))
    sizes = left.groupBy("_k").agg(F.ceil(F.count("*") / CELLS_PER_SALT).cast("int").alias("_salts"))
    hot = sized(sizes.filter("_salts > 1"))
    salts = F.coalesce("_salts", F.lit(1))
    left = left.join(hot, "_k", "left").withColumn("_salt", F.pmod(F.xxhash64("i"), salts).cast("int")).drop("_salts")
    right = right.join(hot, "_k", "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return left.join(right, ["_k", "_salt"]).groupBy("i", "j").agg(F.sum(F.col("_a") * F.col("_b")).alias("v"))
