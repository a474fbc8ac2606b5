"""CSV in its many dialects, run-partitioned datasets, class-labelled files."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_folder


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder all executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = True, **options: str) -> DataFrame:
    """Delimited text with a declared schema; ``sep``, ``encoding`` and ``mode`` go in ``options``."""
    return spark.read.schema(schema).options(header=str(header).lower(), **options).csv(path)


def write_csv(df: DataFrame, path: str, header: bool = True, **options: str) -> None:
    settings = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", **options}
    df.write.mode("overwrite").options(header=str(header).lower(), **settings).csv(path)


def read_second_line_header(spark: SparkSession, path: str, schema: str, **options: str) -> DataFrame:
    """Files whose first line is a title and whose second line names the columns.

    The second line is the first that equals the names; later lines that equal them are data.
    """
    wanted = T.StructType.fromDDL(schema)
    raw = ", ".join(f"`{f.name}` string" for f in wanted)
    rows = read_csv(spark, path, raw, header=True, **options)
    is_header = F.lit(True)
    for field in wanted:
        is_header &= F.col(field.name).eqNullSafe(field.name)
    placed = rows.select(
        *[F.col(f.name) for f in wanted],
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    # lines like the header are few: one for each file, and what repeats it
    first = Window.partitionBy("_file").orderBy("_block", "_line")
    repeats = placed.filter(is_header).withColumn("_nth", F.row_number().over(first)).filter("_nth > 1").drop("_nth")
    kept = placed.filter(~is_header).unionByName(repeats)
    return kept.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in wanted])


def bad_line_counts(spark: SparkSession, path: str, schema: str, **options: str) -> DataFrame:
    """How many lines fit the schema and how many do not."""
    marked = read_csv(
        spark, path, f"{schema}, _corrupt_record string", mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record", **options
    )
    fits = F.col("_corrupt_record").isNull()
    whole = touched([c for c in marked.columns if c != "_corrupt_record"])
    return marked.agg(
        F.count_if(whole & fits).alias("good_lines"), F.count_if(whole & ~fits).alias("bad_lines")
    )


def touched(columns: Sequence[str]) -> Column:
    """Always true, but reads every column: a line is judged only by the columns asked of it."""
    return F.concat_ws("", *[F.col(c).cast("string") for c in columns]) >= ""


def read_runs(spark: SparkSession, path: str, schema: str, runs: Sequence[int]) -> DataFrame:
    """Only the partitions of the given runs; a run without a partition adds no rows."""
    return spark.read.schema(schema).parquet(path).filter(F.col("run_id").isin(list(runs)))


def labelled_files(spark: SparkSession, path: str, label: str = r"([^/=]+)/[^/]+$", pattern: str = "*") -> DataFrame:
    """Path, size and class of files kept in one directory per class; contents are not read."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return listing.select("path", "length", F.regexp_extract("path", label, 1).alias("label"))


def delimited(df: DataFrame, sep: str, *extra: Column) -> DataFrame:
    """Rows as lines of text, with optional trailing pieces."""
    line = F.concat_ws(sep, *[F.col(c).cast("string") for c in df.columns])
    return df.select(F.concat(line, *extra).alias("value") if extra else line.alias("value"))
