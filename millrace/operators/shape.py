"""Column and row selection that has no single Spark call."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import global_row_number


def column_slice(df: DataFrame, start: int, stop: int) -> DataFrame:
    """Columns by position, the last one excluded."""
    return df.select(*df.columns[start:stop])


def row_slice(df: DataFrame, order: Sequence[str], start: int, stop: int) -> DataFrame:
    """Rows by zero-based position in a unique order, the last one excluded."""
    numbered = global_row_number(df, order, name="_position")
    wanted = (F.col("_position") > start) & (F.col("_position") <= stop)
    return numbered.filter(wanted).drop("_position")


def head(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*[F.col(c).asc() for c in order]).limit(n)


def tail(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key, chosen by map-side partial minima."""
    rest = [c for c in df.columns if c not in (*key, *order)]
    first = df.groupBy(*key).agg(F.min_by(F.struct(*order, *rest), F.struct(*order)).alias("_first"))
    return first.select(*key, "_first.*").select(*df.columns)


def differs(column: Column, value) -> Column:
    """Not equal, where a missing value counts as different."""
    return ~column.eqNullSafe(F.lit(value))


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def unique_lookup(df: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """A lookup table for a scalar subquery; reading a key that has two rows raises."""
    one = F.when(F.count("*") <= 1, F.max(value)).otherwise(
        F.raise_error(F.lit(f"more than one {value} for a key")).cast(dict(df.dtypes)[value])
    )
    return df.groupBy(*key).agg(one.alias(value))
