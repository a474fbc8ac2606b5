"""Publishing results: snapshots, run history, and the ledger of runs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut

POINTER = "version string, path string, published_at timestamp"


class EmptyResultError(ValueError):
    """Raised instead of publishing a result without rows."""


def refuse_empty(stored: DataFrame, name: str) -> DataFrame:
    """``stored`` if it has rows; it should be written already, as an unwritten result would be computed for this alone."""
    if stored.isEmpty():
        raise EmptyResultError(f"{name} has no rows to publish")
    return stored


def publish_snapshot(df: DataFrame, root: str, name: str = "result") -> str:
    """Replace a table as a whole.

    Rows go to a new version folder; only when that is complete and has rows does one record in the
    pointer table make it current, so readers see the old version or the new one.
    """
    version = uuid.uuid4().hex
    path = f"{root}/versions/{version}"
    df.write.parquet(path)
    refuse_empty(df.sparkSession.read.schema(df.schema).parquet(path), name)
    pointer = df.sparkSession.range(1).select(
        F.lit(version).alias("version"), F.lit(path).alias("path"), F.current_timestamp().alias("published_at")
    )
    pointer.coalesce(1).write.mode("append").parquet(f"{root}/pointer")
    return path


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    current = spark.read.schema(POINTER).parquet(f"{root}/pointer").agg(F.max_by("path", "published_at")).first()[0]
    return spark.read.parquet(current)


def stamp_run(df: DataFrame, run_id: int, numeric: dict[str, str]) -> DataFrame:
    """Add the run id and turn the named columns into numbers; what is no number becomes null."""
    for column, kind in numeric.items():
        df = df.withColumn(column, F.col(column).cast("string").try_cast(kind))
    return df.withColumn("run_id", F.lit(run_id).cast("bigint"))


def append_history(df: DataFrame, path: str, name: str = "result") -> None:
    """Write a run's rows beside earlier runs; repeating a run replaces that run alone.

    A result without rows replaces no run. Rows are gathered by run, so that a task does not leave
    a small file in each; a large run is split again, since only its size tells how many tasks it needs.
    """
    rows = refuse_empty(cut(df), name).hint("rebalance", "run_id")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def string_widths(df: DataFrame) -> DataFrame:
    """Longest value of each string column, all in one pass."""
    names = [c for c, kind in df.dtypes if kind == "string"]
    widths = df.agg(*[F.max(F.length(c)).alias(c) for c in names])
    return widths.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("width")) for c in names])).alias("w")
    ).select("w.*")


def ledger_append(events: DataFrame, path: str) -> None:
    """Add state changes (run_id, status, event_time, message); nothing is ever updated."""
    events.write.mode("append").parquet(path)


def ledger_state(events: DataFrame) -> DataFrame:
    """The latest state of each run, with its start and, once over, its finish."""
    over = F.col("status").isin("Completed", "Failed")
    return events.groupBy("run_id").agg(
        F.max_by("status", "event_time").alias("status"),
        F.min("event_time").alias("start_time"),
        F.max(F.when(over, F.col("event_time"))).alias("finish_time"),
        F.max_by("message", "event_time").alias("message"),
    )
