"""Named parquet tables below one folder."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "labels": "doc_id bigint, quality int, toxic int",
    "benchmark": "item_id bigint, text string",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


@dataclass(frozen=True)
class Tables:
    """Tables by name, read with declared schemas so that no job has to infer them."""

    spark: SparkSession
    folder: str

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    **options: str,
) -> DataFrame:
    """Pull a SQL result in parallel ranges of a numeric column."""
    reader = spark.read.format("jdbc").options(url=url, fetchsize=str(fetch_size), **options)
    if partition_column is None:
        return reader.option("query", query).load()
    if bounds is None:
        raise ValueError("a partition column needs its bounds")
    return (
        reader.option("dbtable", f"({query}) extract")
        .option("partitionColumn", partition_column)
        .option("lowerBound", str(bounds[0]))
        .option("upperBound", str(bounds[1]))
        .option("numPartitions", str(partitions))
        .load()
    )
