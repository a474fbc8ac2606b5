"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import hash_unit
from ..plans import lists, ratings
from ..sources import files, sinks, standins
from ..sources.tables import SCHEMAS, Tables
from . import recommender_sql as q
from .registry import query


@query(
    "scan_tables",
    "\nUNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count, {len(s.split(','))} AS column_count FROM {n}" for n, s in SCHEMAS.items()),
)
def scan_tables(t: Tables) -> DataFrame:
    parts = [
        getattr(t, n).agg(F.count("*").alias("row_count")).select(
            F.lit(n).alias("table_name"), "row_count", F.lit(len(getattr(t, n).columns)).alias("column_count")
        )
        for n in SCHEMAS
    ]
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


@query("csv_roundtrip", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def csv_roundtrip(t: Tables) -> DataFrame:
    path = files.scratch(t.spark, "csv")
    files.write_csv(t.orders, path)
    return files.read_csv(t.spark, path, SCHEMAS["orders"])


DIALECT_SQL = """
SELECT d.dialect, count(*) AS row_count, CAST(sum(p_partkey) AS BIGINT) AS keys, count(DISTINCT p_name) AS names,
  round(sum(p_retailprice), 2) AS prices
FROM part, (VALUES ('semicolon'), ('tab'), ('title_line'), ('headerless'), ('gzip')) d(dialect)
GROUP BY d.dialect
UNION ALL
SELECT 'latin1', count(*), CAST(sum(doc_id) AS BIGINT), count(DISTINCT md5(body)), round(sum(length(body)), 2)
FROM (SELECT doc_id, trim(regexp_replace(text, '[^\\x{21}-\\x{7E}\\x{C0}-\\x{FF}]+', ' ', 'g')) AS body FROM documents)
"""


@query("csv_dialects", DIALECT_SQL)
def csv_dialects(t: Tables) -> DataFrame:
    spark, schema = t.spark, SCHEMAS["part"]

    def digest(df: DataFrame, dialect: str) -> DataFrame:
        return df.agg(
            F.count("*").alias("row_count"),
            F.sum("p_partkey").alias("keys"),
            F.countDistinct("p_name").alias("names"),
            F.round(F.sum("p_retailprice"), 2).alias("prices"),
        ).select(F.lit(dialect).alias("dialect"), "*")

    found = []
    for dialect, options in {"semicolon": {"sep": ";"}, "tab": {"sep": "\t"}, "gzip": {"compression": "gzip"}}.items():
        path = files.scratch(spark, dialect)
        files.write_csv(t.part, path, **options)
        found.append(digest(files.read_csv(spark, path, schema, **options), dialect))

    path = files.scratch(spark, "headerless")
    files.write_csv(t.part, path, header=False)
    unnamed = ", ".join(f"_c{i} {kind.split()[1]}" for i, kind in enumerate(schema.split(", ")))
    found.append(digest(files.read_csv(spark, path, unnamed, header=False).toDF(*t.part.columns), "headerless"))

    # a title line, then the header, at the top of every file
    path = files.scratch(spark, "title")
    top = ["Parts list", ";".join(t.part.columns)]

    def headed(batches):
        import pandas as pd

        yield pd.DataFrame({"value": top})
        yield from batches

    files.delimited(t.part, ";").mapInPandas(headed, "value string").write.text(path)
    found.append(digest(files.read_second_line_header(spark, path, schema, sep=";"), "title_line"))

    path = files.scratch(spark, "latin1")
    body = F.trim(F.regexp_replace("text", r"[^\x{21}-\x{7E}\x{C0}-\x{FF}]+", " "))
    files.write_csv(t.documents.select("doc_id", body.alias("body")), path, encoding="ISO-8859-1", escape='"')
    texts = files.read_csv(spark, path, "doc_id bigint, body string", encoding="ISO-8859-1", escape='"')
    found.append(
        texts.agg(
            F.count("*").alias("row_count"),
            F.sum("doc_id").alias("keys"),
            F.countDistinct(F.md5("body")).alias("names"),
            F.round(F.sum(F.length("body")).cast("double"), 2).alias("prices"),
        ).select(F.lit("latin1").alias("dialect"), "*")
    )
    first, *rest = found
    for part in rest:
        first = first.unionByName(part)
    return first


@query(
    "csv_bad_lines",
    """SELECT 'PERMISSIVE' AS mode, count(*) FILTER (WHERE o_orderpriority <> '1-URGENT') AS good_lines,
  count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS bad_lines FROM orders
UNION ALL SELECT 'DROPMALFORMED', count(*) FILTER (WHERE o_orderpriority <> '1-URGENT'), 0 FROM orders""",
)
def csv_bad_lines(t: Tables) -> DataFrame:
    """Urgent orders are written with a column too many."""
    path, schema = files.scratch(t.spark, "bad"), SCHEMAS["orders"]
    surplus = F.when(F.col("o_orderpriority") == "1-URGENT", ";surplus").otherwise("")
    files.delimited(t.orders, ";", surplus).write.text(path)
    counted = files.bad_line_counts(t.spark, path, schema, sep=";", header="false")
    kept = files.read_csv(t.spark, path, schema, header=False, sep=";", mode="DROPMALFORMED")
    return counted.select(F.lit("PERMISSIVE").alias("mode"), "*").unionByName(
        kept.agg(F.count_if(files.touched(kept.columns)).alias("good_lines")).select(
            F.lit("DROPMALFORMED").alias("mode"), "good_lines", F.lit(0).cast("bigint").alias("bad_lines")
        )
    )


@query(
    "run_partition_scan",
    """SELECT CAST(week(ts) AS BIGINT) AS run_id, event_type, count(*) AS n, round(sum(value), 4) AS total
FROM events WHERE week(ts) IN (2, 4, 99) GROUP BY ALL""",
)
def run_partition_scan(t: Tables) -> DataFrame:
    """Three runs are asked for; the one that was never written adds nothing."""
    path = files.scratch(t.spark, "runs")
    t.events.select("event_type", "value", F.weekofyear("ts").cast("bigint").alias("run_id")).write.partitionBy(
        "run_id"
    ).parquet(path)
    found = files.read_runs(t.spark, path, "event_type string, value double, run_id bigint", [2, 4, 99])
    return found.groupBy("run_id", "event_type").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")
    )


@query(
    "literal_table",
    """SELECT name, share, count(*) AS parts, round(avg(p_retailprice), 4) AS price
FROM part JOIN (VALUES ('ECONOMY', 0.5::DOUBLE), ('STANDARD', 1.0::DOUBLE), ('PROMO', 2.0::DOUBLE)) v(name, share) ON p_type = name GROUP BY ALL""",
)
def literal_table(t: Tables) -> DataFrame:
    rates = t.spark.createDataFrame([("ECONOMY", 0.5), ("STANDARD", 1.0), ("PROMO", 2.0)], "name string, share double")
    return (
        t.part.join(rates, F.col("p_type") == F.col("name"))
        .groupBy("name", "share")
        .agg(F.count("*").alias("parts"), F.round(F.avg("p_retailprice"), 4).alias("price"))
    )


@query("binary_labels", "SELECT CAST(label AS VARCHAR) AS label, TRUE AS has_bytes FROM embeddings GROUP BY label")
def binary_labels(t: Tables) -> DataFrame:
    """One directory of files per class; the class comes from the path."""
    path = files.scratch(t.spark, "classes")
    t.embeddings.write.partitionBy("label").parquet(path)
    listed = files.labelled_files(t.spark, path, pattern="*.parquet")
    return listed.groupBy("label").agg((F.min("length") > 0).alias("has_bytes"))


@query(
    "sink_snapshot",
    q.chain(standins.ACTIVITY_SQL, q.normalized(), q.rated(), q.trending(), select="SELECT portal, item_id, round(rating, 6) AS rating, rank FROM trend"),
)
def sink_snapshot(t: Tables) -> DataFrame:
    """The second publication replaces the first."""
    root = files.scratch(t.spark, "snapshot")
    trend = lists.trending(ratings.rate(standins.activity(t))).withColumn("rating", F.round("rating", 6))
    sinks.publish_snapshot(trend.filter("rank <= 5"), root, "trending")
    sinks.publish_snapshot(trend, root, "trending")
    return sinks.read_snapshot(t.spark, root)


@query(
    "sink_history",
    """SELECT run_id, c_custkey, TRY_CAST(c_name AS BIGINT) AS c_name, c_acctbal, CAST(c_mktsegment AS VARCHAR) AS c_mktsegment
FROM customer, (VALUES (1::BIGINT), (2::BIGINT)) r(run_id)""",
)
def sink_history(t: Tables) -> DataFrame:
    """Two runs, the first of them written twice."""
    path = files.scratch(t.spark, "history")
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    numeric = {"c_name": "bigint", "c_acctbal": "double"}
    sinks.append_history(sinks.stamp_run(rows.filter("c_acctbal > 0"), 1, numeric), path)
    sinks.append_history(sinks.stamp_run(rows, 2, numeric), path)
    sinks.append_history(sinks.stamp_run(rows, 1, numeric), path)
    return t.spark.read.schema(
        "c_custkey bigint, c_name bigint, c_acctbal double, c_mktsegment string, run_id bigint"
    ).parquet(path)


@query(
    "string_widths",
    """SELECT 'o_orderstatus' AS column_name, CAST(max(length(o_orderstatus)) AS INTEGER) AS width FROM orders
UNION ALL SELECT 'o_orderpriority', CAST(max(length(o_orderpriority)) AS INTEGER) FROM orders
UNION ALL SELECT 'c_name', CAST(max(length(c_name)) AS INTEGER) FROM customer
UNION ALL SELECT 'c_mktsegment', CAST(max(length(c_mktsegment)) AS INTEGER) FROM customer""",
)
def string_widths(t: Tables) -> DataFrame:
    return sinks.string_widths(t.orders).unionByName(sinks.string_widths(t.customer))


@query(
    "run_ledger",
    f"""WITH {standins.JOB_RUNS_SQL}
SELECT run_id, status, start_time, start_time + INTERVAL 1 HOUR AS finish_time,
  CASE status WHEN 'Failed' THEN 'stopped early' END AS message FROM job_runs""",
)
def run_ledger(t: Tables) -> DataFrame:
    path = files.scratch(t.spark, "ledger")
    runs = standins.job_runs(t)
    no_message = F.lit(None).cast("string").alias("message")
    started = runs.select("run_id", F.lit("Running").alias("status"), F.col("start_time").alias("event_time"), no_message)
    over = runs.select(
        "run_id",
        "status",
        (F.col("start_time") + F.expr("INTERVAL '1' HOUR")).alias("event_time"),
        F.when(F.col("status") == "Failed", "stopped early").alias("message"),
    )
    sinks.ledger_append(started, path)
    sinks.ledger_append(over, path)
    events = t.spark.read.schema("run_id bigint, status string, event_time timestamp_ntz, message string").parquet(path)
    return sinks.ledger_state(events)


@query(
    "hash_sample",
    """SELECT o_orderkey, o_totalprice FROM orders
WHERE CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0 < 0.5""",
)
def hash_sample(t: Tables) -> DataFrame:
    """Half of the rows, the same half however the table is partitioned."""
    return t.orders.filter(hash_unit("o_orderkey") < 0.5).select("o_orderkey", "o_totalprice")
