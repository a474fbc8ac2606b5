"""Cleaning and feature queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..analysis import prep
from ..functions import arrays
from ..operators.ordering import global_row_number, hash_unit
from ..sources.tables import Tables
from .registry import query

HASH_SQL = "CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0"


def r6(column) -> F.Column:
    return F.round(column, 6)


@query(
    "impute_median",
    """WITH g AS (SELECT c_custkey, CASE WHEN c_nationkey >= 3 THEN c_acctbal END AS balance, CASE WHEN c_acctbal > 0 THEN c_nationkey END AS nation FROM customer)
SELECT c_custkey, round(coalesce(balance, (SELECT median(balance) FROM g)), 6) AS balance, round(coalesce(nation, (SELECT median(nation) FROM g)), 6) + 0.0 AS nation FROM g""",
)
def impute_median(t: Tables) -> DataFrame:
    gaps = t.customer.select(
        "c_custkey",
        F.when(F.col("c_nationkey") >= 3, F.col("c_acctbal")).alias("balance"),
        F.when(F.col("c_acctbal") > 0, F.col("c_nationkey")).alias("nation"),
    )
    return prep.fill_median(gaps, ["balance", "nation"]).withColumns({"balance": r6("balance"), "nation": r6("nation") + 0.0})


@query(
    "impute_zero",
    """SELECT l_orderkey, l_linenumber, round(CASE WHEN l_discount = 0 THEN (SELECT median(l_discount) FROM lineitem) ELSE l_discount END, 6) AS discount,
  round(CASE WHEN l_tax = 0 THEN (SELECT median(l_tax) FROM lineitem) ELSE l_tax END, 6) AS tax FROM lineitem""",
)
def impute_zero(t: Tables) -> DataFrame:
    filled = prep.zero_to_median(t.lineitem, ["l_discount", "l_tax"])
    return filled.select("l_orderkey", "l_linenumber", r6("l_discount").alias("discount"), r6("l_tax").alias("tax"))


@query(
    "impute_sentinel",
    """WITH s AS (SELECT p_partkey, CASE WHEN p_size > 40 THEN '?' ELSE CAST(p_size AS VARCHAR) END AS q, CASE WHEN p_size < 5 THEN '-' ELSE CAST(p_retailprice AS VARCHAR) END AS d FROM part)
SELECT p_partkey, round(coalesce(TRY_CAST(q AS DOUBLE), (SELECT avg(TRY_CAST(q AS DOUBLE)) FROM s)), 6) AS size_or_mean,
  coalesce(TRY_CAST(q AS DOUBLE), 0) AS size_or_zero, round(coalesce(TRY_CAST(d AS DOUBLE), 0), 4) AS price_or_zero FROM s""",
)
def impute_sentinel(t: Tables) -> DataFrame:
    size = F.when(F.col("p_size") > 40, "?").otherwise(F.col("p_size").cast("string"))
    price = F.when(F.col("p_size") < 5, "-").otherwise(F.col("p_retailprice").cast("string"))
    raw = t.part.select("p_partkey", size.alias("size_or_mean"), size.alias("size_or_zero"), price.alias("price_or_zero"))
    filled = prep.parse_or(prep.parse_or(prep.parse_or(raw, "size_or_mean", "mean"), "size_or_zero", 0), "price_or_zero", 0)
    return filled.withColumns({"size_or_mean": r6("size_or_mean"), "price_or_zero": F.round("price_or_zero", 4)})


@query(
    "clamp_to_mean",
    """SELECT c_custkey, round(CASE WHEN c_acctbal BETWEEN 0 AND 9000 THEN c_acctbal ELSE (SELECT avg(c_acctbal) FROM customer) END, 6) AS over_all,
  round(CASE WHEN c_acctbal BETWEEN 0 AND 9000 THEN c_acctbal ELSE (SELECT avg(c_acctbal) FROM customer WHERE c_acctbal BETWEEN 0 AND 9000) END, 6) AS over_valid FROM customer""",
)
def clamp_to_mean(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", F.col("c_acctbal").alias("over_all"), F.col("c_acctbal").alias("over_valid"))
    fixed = prep.outside_to_mean(prep.outside_to_mean(rows, "over_all", 0, 9000), "over_valid", 0, 9000, valid_only=True)
    return fixed.withColumns({"over_all": r6("over_all"), "over_valid": r6("over_valid")})


@query(
    "iqr_cap",
    """SELECT o_orderkey, round(least(spent, (SELECT quantile_cont(spent, 0.75) + 1.5 * (quantile_cont(spent, 0.75) - quantile_cont(spent, 0.25)) FROM x)), 6) AS spent FROM x""".replace(
        "SELECT o_orderkey", "WITH x AS (SELECT o_orderkey, o_totalprice * o_totalprice / 1000000 AS spent FROM orders) SELECT o_orderkey", 1
    ),
)
def iqr_cap(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", (F.col("o_totalprice") * F.col("o_totalprice") / 1000000).alias("spent"))
    return prep.cap_high(rows, ["spent"]).withColumn("spent", r6("spent"))


@query(
    "label_encode",
    """SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS priority_code, CAST(dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS INTEGER) AS status_code FROM orders""",
)
def label_encode(t: Tables) -> DataFrame:
    coded = prep.encode_labels(t.orders, ["o_orderpriority", "o_orderstatus"])
    return coded.select("o_orderkey", F.col("o_orderpriority_code").alias("priority_code"), F.col("o_orderstatus_code").alias("status_code"))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "dummies",
    "SELECT c_custkey, " + ", ".join(f"CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END AS segment_{s}" for s in SEGMENTS) + " FROM customer",
)
def dummies(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment"))
    return prep.dummies(rows, "segment", SEGMENTS).drop("segment")


@query(
    "standardize_split",
    f"""WITH s AS (SELECT l_orderkey, l_linenumber, l_quantity, l_tax, {HASH_SQL.format(key='l_orderkey')} < 0.25 AS test FROM lineitem),
f AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_tax) AS mt, stddev_pop(l_tax) AS st FROM s WHERE NOT test)
SELECT l_orderkey, l_linenumber, test, round((l_quantity - mq) / sq, 6) + 0.0 AS quantity, round((l_tax - mt) / st, 6) + 0.0 AS tax FROM s, f""",
)
def standardize_split(t: Tables) -> DataFrame:
    """Scales come from the training rows and apply to both parts."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity"), F.col("l_tax").alias("tax"), (hash_unit("l_orderkey") < 0.25).alias("test"))
    scales = prep.standard_scales(rows.filter("NOT test"), ["quantity", "tax"])
    return prep.standardize(rows, scales).withColumns({c: r6(c) + 0.0 for c in ("quantity", "tax")})


@query(
    "l2_normalize",
    """SELECT vec_id, round(list_sum(list_transform(e, lambda x: x * x / (n * n))), 6) AS squares, round(e[1] / n, 6) + 0.0 AS first, round(e[64] / n, 6) + 0.0 AS last
FROM (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS n FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings))""",
)
def l2_normalize(t: Tables) -> DataFrame:
    unit = t.embeddings.select("vec_id", arrays.doubles(F.col("embedding")).alias("e")).select("vec_id", arrays.l2_normalized(F.col("e")).alias("u"))
    u = F.col("u")
    return unit.select("vec_id", r6(arrays.dot(u, u)).alias("squares"), (r6(u[0]) + 0.0).alias("first"), (r6(u[63]) + 0.0).alias("last"))


@query(
    "hash_split",
    f"""SELECT o_orderkey, {HASH_SQL.format(key='o_orderkey')} < 0.3 AS test,
  row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) <= 300 AS in_300 FROM orders""",
)
def hash_split(t: Tables) -> DataFrame:
    """A share of the rows, and a fixed number of them, both decided by a hash of the key."""
    rows = t.orders.select("o_orderkey", F.md5(F.col("o_orderkey").cast("string")).alias("digest"))
    numbered = global_row_number(rows, ["digest", "o_orderkey"], name="place")
    return numbered.select("o_orderkey", (hash_unit("o_orderkey") < 0.3).alias("test"), (F.col("place") <= 300).alias("in_300"))


@query(
    "bootstrap_mean",
    f"""WITH u AS (SELECT o_totalprice AS x, replicate, CAST('0x' || substr(md5('|' || o_orderkey || '|' || replicate), 1, 12) AS BIGINT) / {float(16**12)}::DOUBLE AS u
  FROM orders, range(1, 51) r(replicate)),
w AS (SELECT replicate, x, {" + ".join(f"(u >= {step!r}::DOUBLE)::INTEGER" for step in prep.poisson_steps())} AS w FROM u),
m AS (SELECT replicate, sum(x * w) / sum(w) AS mean FROM w GROUP BY replicate)
SELECT count(*) AS replicates, round(avg(mean), 4) AS mean, round(stddev_pop(mean), 4) AS deviation FROM m""",
)
def bootstrap_mean(t: Tables) -> DataFrame:
    """Mean and deviation of 50 resampled means."""
    found = prep.bootstrap(t.orders, "o_orderkey", "o_totalprice", 50)
    return found.agg(F.count("*").alias("replicates"), F.round(F.avg("mean"), 4).alias("mean"), F.round(F.stddev_pop("mean"), 4).alias("deviation"))


@query(
    "class_weights",
    "SELECT label, count(*) AS n, round(max(count(*)) OVER () / count(*), 6) AS weight FROM embeddings GROUP BY label",
)
def class_weights(t: Tables) -> DataFrame:
    return prep.class_weights(t.embeddings, "label").withColumn("weight", r6("weight"))


@query(
    "zscore",
    """WITH m AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq FROM lineitem)
SELECT l_orderkey, l_linenumber, round((l_quantity - mq) / sq, 6) + 0.0 AS by_column,
  round((l_quantity - a) / nullif(sqrt(((l_quantity - a) ** 2 + (l_discount * 100 - a) ** 2 + (l_tax * 100 - a) ** 2) / 3), 0), 6) + 0.0 AS by_row
FROM (SELECT *, (l_quantity + l_discount * 100 + l_tax * 100) / 3 AS a FROM lineitem), m""",
)
def zscore(t: Tables) -> DataFrame:
    scales = prep.standard_scales(t.lineitem, ["l_quantity"])
    values = F.array(F.col("l_quantity"), F.col("l_discount") * 100, F.col("l_tax") * 100)
    rows = t.lineitem.withColumn("row", prep.z_scores_by_row(values))
    return prep.standardize(rows, scales).select(
        "l_orderkey", "l_linenumber", (r6("l_quantity") + 0.0).alias("by_column"), (r6(F.col("row")[0]) + 0.0).alias("by_row")
    )
