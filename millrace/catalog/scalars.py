"""Scalar, time and array functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import arrays
from ..operators.joins import join_groups
from ..sources.tables import Tables
from .registry import query


@query(
    "string_funcs",
    """SELECT c_custkey, upper(trim(c_name)) AS upper_name, lower(c_mktsegment) AS segment,
  coalesce(nullif(CASE WHEN c_nationkey < 5 THEN '' ELSE c_mktsegment END, ''), 'All') AS filled,
  concat_ws(' ', c_name, CASE WHEN c_acctbal > 0 THEN 'credit' END, replace(c_mktsegment, 'I', '1')) AS joined,
  TRY_CAST(substr(c_name, 16, 3) AS INTEGER) AS tail_no, coalesce(TRY_CAST(substr(c_name, 16, 3) AS INTEGER) BETWEEN 100 AND 199, FALSE) AS in_range,
  contains(c_name, '00') AS has_zeros, length(c_name) AS name_length
FROM customer""",
)
def string_funcs(t: Tables) -> DataFrame:
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    emptied = F.when(F.col("c_nationkey") < 5, "").otherwise(segment)
    tail = F.substring(name, 16, 3).try_cast("int")
    return t.customer.select(
        "c_custkey",
        F.upper(F.trim(name)).alias("upper_name"),
        F.lower(segment).alias("segment"),
        F.coalesce(F.nullif(emptied, F.lit("")), F.lit("All")).alias("filled"),
        F.concat_ws(" ", name, F.when(F.col("c_acctbal") > 0, "credit"), F.replace(segment, F.lit("I"), F.lit("1"))).alias("joined"),
        tail.alias("tail_no"),
        F.coalesce(tail.between(100, 199), F.lit(False)).alias("in_range"),
        name.contains("00").alias("has_zeros"),
        F.length(name).cast("bigint").alias("name_length"),
    )


@query(
    "time_funcs",
    """SELECT event_id, strftime(ts, '%d-%m-%y %H:%M:%S') AS stamp, strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS to_second,
  ts - INTERVAL 20 DAY AS shifted, CAST(ts AS DATE) AS day, CAST(ts + INTERVAL 180 DAY AS DATE) AS later
FROM events""",
)
def time_funcs(t: Tables) -> DataFrame:
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        F.date_format(ts, "dd-MM-yy HH:mm:ss").alias("stamp"),
        F.to_timestamp_ntz(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit("yyyy-MM-dd HH:mm:ss")).alias("to_second"),
        (ts - F.expr("INTERVAL '20' DAY")).alias("shifted"),
        F.to_date(ts).alias("day"),
        F.to_date(ts + F.expr("INTERVAL '180' DAY")).alias("later"),
    )


@query(
    "numeric_casts",
    """SELECT p_partkey, CAST(trunc(p_retailprice) AS BIGINT) AS whole, TRY_CAST(CASE WHEN p_size > 40 THEN '?' ELSE CAST(p_size AS VARCHAR) END AS DOUBLE) AS parsed,
  coalesce(TRY_CAST(CASE WHEN p_size > 40 THEN '-' ELSE CAST(p_size AS VARCHAR) END AS INTEGER), 0) AS or_zero FROM part""",
)
def numeric_casts(t: Tables) -> DataFrame:
    size = F.col("p_size").cast("string")
    return t.part.select(
        "p_partkey",
        F.col("p_retailprice").cast("bigint").alias("whole"),
        F.when(F.col("p_size") > 40, "?").otherwise(size).try_cast("double").alias("parsed"),
        F.coalesce(F.when(F.col("p_size") > 40, "-").otherwise(size).try_cast("int"), F.lit(0)).alias("or_zero"),
    )


@query(
    "score_threshold",
    """SELECT l_orderkey, l_linenumber, round(abs(l_discount - l_tax), 4) AS gap, CAST(round_even(l_quantity / 2, 0) AS INTEGER) AS half_even,
  CAST(round(l_quantity / 2) AS INTEGER) AS half_up, CASE WHEN l_discount * 10 > 0.5 THEN 1 ELSE 0 END AS predicted FROM lineitem""",
)
def score_threshold(t: Tables) -> DataFrame:
    half = F.col("l_quantity") / 2
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.round(F.abs(F.col("l_discount") - F.col("l_tax")), 4).alias("gap"),
        F.bround(half, 0).cast("int").alias("half_even"),
        F.round(half, 0).cast("int").alias("half_up"),
        F.when(F.col("l_discount") * 10 > 0.5, 1).otherwise(0).alias("predicted"),
    )


@query(
    "argmax_label",
    """SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS predicted, coalesce(n_name, 'other') AS class_name
FROM embeddings LEFT JOIN nation ON n_nationkey = list_position(embedding, list_max(embedding)) - 1""",
)
def argmax_label(t: Tables) -> DataFrame:
    """Place of the largest score, named through a lookup table."""
    scored = t.embeddings.select("vec_id", arrays.arg_max(F.col("embedding")).alias("predicted"))
    named = scored.join(t.nation, F.col("predicted") == F.col("n_nationkey"), "left")
    return named.select("vec_id", "predicted", F.coalesce("n_name", F.lit("other")).alias("class_name"))


@query(
    "one_hot_array",
    "SELECT vec_id, array_to_string(list_transform(range(10), lambda i: CASE WHEN i = label THEN 1 ELSE 0 END), ',') AS hot FROM embeddings",
)
def one_hot_array(t: Tables) -> DataFrame:
    hot = F.transform(arrays.one_hot(F.col("label"), 10), lambda x: x.cast("string"))
    return t.embeddings.select("vec_id", F.array_join(hot, ",").alias("hot"))


@query(
    "array_funcs",
    """WITH a AS (SELECT o_orderkey AS k, list(CAST(l_quantity AS BIGINT) ORDER BY l_linenumber, l_quantity) AS q FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT k, array_to_string(list_append(q, 7), ',') AS appended,
  array_to_string(q[1:list_position(q, q[-1]) - 1] || q[list_position(q, q[-1]) + 1:], ',') AS without_last_value,
  len(q || q) AS doubled, list_min(q) AS smallest, list_max(q) AS largest, CAST(list_sum(q) AS DOUBLE) AS total, round(list_avg(q), 6) AS mean,
  CAST(len(list_filter(q, lambda x: x = q[1])) AS INTEGER) AS count_of_first, array_to_string(list_sort(q), ',') AS rising, array_to_string(list_reverse_sort(q), ',') AS falling,
  array_to_string(list_transform(q, lambda x: x + x), ',') AS added, CAST(len(flatten([q, q])) AS BIGINT) AS cells
FROM a""",
)
def array_funcs(t: Tables) -> DataFrame:
    """List operations on the quantities of an order, in line order; an order has a handful of lines."""
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(
        F.sort_array(F.collect_list(F.struct("l_linenumber", F.col("l_quantity").cast("bigint").alias("q")))).alias("s")
    )
    listed = lines.join(t.orders, F.col("k") == F.col("o_orderkey"), "left_semi").select("k", F.col("s.q").alias("q"))
    q = F.col("q")
    text = lambda a: F.array_join(F.transform(a, lambda x: x.cast("string")), ",")
    return listed.select(
        "k",
        text(F.array_append(q, F.lit(7).cast("bigint"))).alias("appended"),
        text(arrays.remove_first(q, F.element_at(q, -1))).alias("without_last_value"),
        F.size(F.concat(q, q)).cast("bigint").alias("doubled"),
        F.array_min(q).alias("smallest"),
        F.array_max(q).alias("largest"),
        arrays.total(q).alias("total"),
        F.round(arrays.mean(q), 6).alias("mean"),
        arrays.count_of(q, F.element_at(q, 1)).alias("count_of_first"),
        text(F.sort_array(q)).alias("rising"),
        text(F.sort_array(q, False)).alias("falling"),
        text(F.zip_with(q, q, lambda x, y: x + y)).alias("added"),
        F.size(F.flatten(F.array(q, q))).cast("bigint").alias("cells"),
    )


M_SQL = "m AS (SELECT l_suppkey AS i, l_linenumber AS j, sum(l_quantity) AS v FROM lineitem GROUP BY ALL)"


@query(
    "matrix_product",
    f"""WITH {M_SQL}
SELECT a.j AS i, b.j AS j, round(sum(a.v * b.v), 4) AS v FROM m a JOIN m b ON a.i = b.i GROUP BY a.j, b.j""",
)
def matrix_product(t: Tables) -> DataFrame:
    """Transposed times identity times itself: line numbers by line numbers over suppliers."""
    m = t.lineitem.groupBy(F.col("l_suppkey").alias("i"), F.col("l_linenumber").alias("j")).agg(F.sum("l_quantity").alias("v"))
    same = arrays.product(arrays.identity(m), m)
    return arrays.product(arrays.transpose(m), same).withColumn("v", F.round("v", 4))


@query(
    "vector_distance",
    """SELECT vec_id, label, round(sqrt(list_sum(list_transform(list_zip(e, c), lambda p: (p[1] - p[2]) ** 2))), 5) AS distance,
  round(list_sum(list_transform(list_zip(e, c), lambda p: p[1] * p[2])) / sqrt(list_sum(list_transform(e, lambda x: x * x)) * list_sum(list_transform(c, lambda x: x * x))), 5) AS cosine
FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
JOIN (SELECT label, list(m ORDER BY pos) AS c FROM (
  SELECT label, pos, avg(x) AS m FROM (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY label, pos) GROUP BY label)
USING (label)""",
)
def vector_distance(t: Tables) -> DataFrame:
    """Each vector against the mean vector of its class."""
    vectors = t.embeddings.select("vec_id", "label", arrays.doubles(F.col("embedding")).alias("e"))
    means = vectors.select("label", F.posexplode("e").alias("at", "x")).groupBy("label", "at").agg(F.avg("x").alias("m"))
    centres = means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("at", "m"))).alias("c")).select("label", F.col("c.m").alias("c"))
    e, c = F.col("e"), F.col("c")
    return join_groups(vectors, centres, ["label"]).select(
        "vec_id", "label", F.round(arrays.euclidean(e, c), 5).alias("distance"), F.round(arrays.cosine(e, c), 5).alias("cosine")
    )
