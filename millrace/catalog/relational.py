"""Projections, filters, joins, aggregations, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import ordering, profile, quantiles, shape
from ..sources import standins
from ..sources.tables import Tables
from .registry import query


def r6(column) -> F.Column:
    return F.round(column, 6)


# ---- projections, filters, row shaping


@query(
    "project_slice",
    "SELECT p_partkey AS part_id, p_name, p_type AS kind, p_size FROM part",
)
def project_slice(t: Tables) -> DataFrame:
    return (
        shape.column_slice(t.part, 0, 5).drop("p_brand").withColumnRenamed("p_partkey", "part_id").withColumnsRenamed({"p_type": "kind"})
    )


@query(
    "row_slice",
    """SELECT 'inclusive' AS part, row_no, o_orderkey, o_totalprice FROM n WHERE row_no BETWEEN 1 AND 11
UNION ALL SELECT 'exclusive', row_no, o_orderkey, o_totalprice FROM n WHERE row_no BETWEEN 1 AND 10
UNION ALL SELECT 'middle', row_no, o_orderkey, o_totalprice FROM n WHERE row_no BETWEEN 1001 AND 1020
UNION ALL SELECT 'last', row_no, o_orderkey, o_totalprice FROM n WHERE row_no > (SELECT count(*) FROM orders) - 5""".join(
        ["WITH n AS (SELECT row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS row_no, o_orderkey, o_totalprice FROM orders)\n", ""]
    ),
)
def row_slice(t: Tables) -> DataFrame:
    """Label slices include their end, position slices do not; the tail counts from the end."""
    numbered = ordering.global_row_number(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"])

    def part(name: str, rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(name).alias("part"), "row_no", "o_orderkey", "o_totalprice")

    return (
        part("inclusive", numbered.filter("row_no <= 11"))
        .unionByName(part("exclusive", shape.head(numbered, ["row_no"], 10)))
        .unionByName(part("middle", numbered.filter("row_no > 1000 AND row_no <= 1020")))
        .unionByName(part("last", shape.tail(numbered, ["row_no"], 5)))
    )


@query(
    "computed_cols",
    """SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net,
  round(l_extendedprice - l_quantity, 4) AS difference,
  round(CASE WHEN l_discount = 0 THEN 0.0 ELSE l_tax / l_discount * 100 END, 4) AS percent
FROM lineitem""",
)
def computed_cols(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("net"),
        F.round(F.col("l_extendedprice") - F.col("l_quantity"), 4).alias("difference"),
        F.round(shape.safe_ratio(F.col("l_tax"), F.col("l_discount")) * 100, 4).alias("percent"),
    )


@query(
    "filters",
    """SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice FROM orders
WHERE o_orderstatus IN ('O', 'F') AND o_totalprice BETWEEN 50000 AND 200000 AND o_custkey > 100
  AND NULLIF(o_orderpriority, '5-LOW') IS DISTINCT FROM '1-URGENT'
  AND o_orderpriority LIKE '%-%' AND lower(o_orderpriority) NOT LIKE '%specified' AND o_orderdate IS NOT NULL AND o_orderstatus <> 'P'""",
)
def filters(t: Tables) -> DataFrame:
    priority = F.col("o_orderpriority")
    return t.orders.filter(
        F.col("o_orderstatus").isin("O", "F")
        & F.col("o_totalprice").between(50000, 200000)
        & (F.col("o_custkey") > 100)
        & shape.differs(F.nullif(priority, F.lit("5-LOW")), "1-URGENT")
        & priority.like("%-%")
        & ~F.lower(priority).like("%specified")
        & F.col("o_orderdate").isNotNull()
        & (F.col("o_orderstatus") != "P")
    ).select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")


MAYBE_SQL = """maybe AS (SELECT o_orderkey, NULLIF(o_orderstatus, 'P') AS status, CASE WHEN o_totalprice > 400000 THEN NULL ELSE o_totalprice END AS price,
  NULLIF(o_orderpriority, '5-LOW') AS priority FROM orders)"""


def maybe(t: Tables) -> DataFrame:
    """Orders with gaps: pending states, high prices and low priorities are missing."""
    return t.orders.select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(F.col("o_totalprice") <= 400000, F.col("o_totalprice")).alias("price"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
    )


@query(
    "na_drop",
    f"""WITH {MAYBE_SQL}
SELECT 'any' AS rule, o_orderkey FROM maybe WHERE status IS NOT NULL AND price IS NOT NULL AND priority IS NOT NULL
UNION ALL SELECT 'subset', o_orderkey FROM maybe WHERE status IS NOT NULL AND price IS NOT NULL""",
)
def na_drop(t: Tables) -> DataFrame:
    rows = maybe(t)
    whole = rows.na.drop().select(F.lit("any").alias("rule"), "o_orderkey")
    return whole.unionByName(rows.na.drop(subset=["status", "price"]).select(F.lit("subset").alias("rule"), "o_orderkey"))


@query(
    "column_profile",
    f"WITH {MAYBE_SQL}\n"
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{kind}' AS kind, count(*) AS row_count, count({c}) AS non_null, count(DISTINCT {c}) AS distinct_values FROM maybe"
        for c, kind in [("o_orderkey", "number"), ("status", "other"), ("price", "number"), ("priority", "other")]
    ),
)
def column_profile(t: Tables) -> DataFrame:
    return profile.column_profile(maybe(t))


LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "low_variance_cols",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(var_samp({c}), 6) AS variance FROM lineitem HAVING var_samp({c}) >= 1"
        for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *LINE_NUMBERS]
    ),
)
def low_variance_cols(t: Tables) -> DataFrame:
    kept = t.lineitem.drop(*profile.low_variance_columns(t.lineitem))
    names = profile.numeric_columns(kept)
    wide = kept.agg(*[F.var_samp(c).alias(c) for c in names])
    return profile.long_row(wide, {c: [("variance", r6(F.col(c)))] for c in names})


CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query(
    "drop_id_cols",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS rows, count(DISTINCT {c}) AS different, count(DISTINCT {c}) = count(*) AS is_identifier FROM customer"
        for c in CUSTOMER_COLUMNS
    ),
)
def drop_id_cols(t: Tables) -> DataFrame:
    """Every column with its different values; identifiers are those that :func:`profile.identifier_columns` drops."""
    dropped = profile.identifier_columns(t.customer)
    return profile.column_profile(t.customer).select(
        "column_name",
        F.col("row_count").alias("rows"),
        F.col("distinct_values").alias("different"),
        F.col("column_name").isin(dropped).alias("is_identifier"),
    )


@query(
    "case_map",
    """SELECT doc, pass_flag, polarity, count(*) AS n FROM (
  SELECT CASE WHEN l_quantity >= 10 AND l_discount >= 0.02 AND l_tax >= 0.02 THEN 1 ELSE 0 END AS pass_flag,
    CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 0 ELSE -1 END AS polarity,
    CASE WHEN l_linestatus = 'O' THEN 'open' ELSE 'done' END AS doc FROM lineitem) GROUP BY ALL""",
)
def case_map(t: Tables) -> DataFrame:
    """Three marks to one pass flag, labels to numbers, codes to words."""
    passed = (F.col("l_quantity") >= 10) & (F.col("l_discount") >= 0.02) & (F.col("l_tax") >= 0.02)
    flag = F.col("l_returnflag")
    mapped = t.lineitem.select(
        F.when(passed, 1).otherwise(0).alias("pass_flag"),
        F.when(flag == "A", 1).when(flag == "R", 0).otherwise(-1).alias("polarity"),
        F.when(F.col("l_linestatus") == "O", "open").otherwise("done").alias("doc"),
    )
    return mapped.groupBy("doc", "pass_flag", "polarity").agg(F.count("*").alias("n"))


@query("distinct_values", "SELECT DISTINCT p_brand, p_type FROM part ORDER BY 1, 2")
def distinct_values(t: Tables) -> DataFrame:
    return t.part.select("p_brand", "p_type").distinct().orderBy("p_brand", "p_type")


@query(
    "dedupe_first",
    "SELECT p_partkey, p_name, p_brand, p_retailprice FROM part QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) = 1",
)
def dedupe_first(t: Tables) -> DataFrame:
    return shape.first_per_key(t.part.select("p_partkey", "p_name", "p_brand", "p_retailprice"), ["p_name"], ["p_partkey"])


# ---- joins


@query(
    "join_chain",
    """SELECT r_name, n_name, o_orderstatus, count(*) AS n, round(sum(l_extendedprice), 2) AS total
FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus <> 'P'
JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0
JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
GROUP BY ALL""",
)
def join_chain(t: Tables) -> DataFrame:
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    buyers = t.customer.filter("c_acctbal > 0").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    sold = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("lines"), F.sum("l_extendedprice").alias("price"))
    return (
        t.orders.filter("o_orderstatus <> 'P'")
        .join(sold, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("r_name", "n_name", "o_orderstatus")
        .agg(F.sum("lines").alias("n"), F.round(F.sum("price"), 2).alias("total"))
    )


@query(
    "left_join_filter",
    """SELECT c_custkey, o_orderkey, o_orderpriority FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 300000
WHERE lower(o_orderpriority) NOT LIKE '%low'""",
)
def left_join_filter(t: Tables) -> DataFrame:
    """The filter rejects nulls, so customers without a match go too."""
    dear = t.orders.filter("o_totalprice > 300000")
    return (
        t.customer.join(dear, F.col("o_custkey") == F.col("c_custkey"), "left")
        .filter(~F.lower("o_orderpriority").like("%low"))
        .select("c_custkey", "o_orderkey", "o_orderpriority")
    )


@query(
    "scalar_lookup",
    """SELECT c_custkey, (SELECT upper(n_name) FROM nation WHERE n_nationkey = c_nationkey) AS nation_name,
  (SELECT r_name FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_nationkey = c_nationkey AND r_name <> 'ASIA') AS region_name
FROM customer""",
)
def scalar_lookup(t: Tables) -> DataFrame:
    names = shape.unique_lookup(
        t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.upper("n_name").alias("nation_name")), ["c_nationkey"], "nation_name"
    )
    regions = t.nation.join(t.region.filter("r_name <> 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    regions = shape.unique_lookup(
        regions.select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("region_name")), ["c_nationkey"], "region_name"
    )
    return (
        t.customer.join(names, "c_nationkey", "left")
        .join(regions, "c_nationkey", "left")
        .select("c_custkey", "nation_name", "region_name")
    )


@query("semi_join", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def semi_join(t: Tables) -> DataFrame:
    builders = t.customer.filter("c_mktsegment = 'BUILDING'")
    return t.orders.join(builders, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey", "o_custkey")


@query("anti_join", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def anti_join(t: Tables) -> DataFrame:
    pending = t.orders.filter("o_orderstatus = 'P'")
    return t.customer.join(pending, F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey", "c_name")


@query(
    "conditional_key_join",
    """WITH l AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN 0 ELSE l_suppkey END AS managed,
  l_suppkey AS own, CASE WHEN l_returnflag = 'A' THEN 'none' ELSE CAST(l_partkey AS VARCHAR) END AS part_text FROM lineitem)
SELECT l_orderkey, l_linenumber, s_name, p_name FROM l
JOIN supplier ON s_suppkey = CASE WHEN managed IS NULL OR managed = 0 THEN own ELSE managed END
JOIN part ON p_partkey = TRY_CAST(part_text AS BIGINT)""",
)
def conditional_key_join(t: Tables) -> DataFrame:
    """A key that falls back to another column, and a key kept as text."""
    line = F.col("l_linenumber")
    lines = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.when(line == 1, F.lit(None)).when(line == 2, F.lit(0)).otherwise(F.col("l_suppkey")).cast("bigint").alias("managed"),
        F.col("l_suppkey").alias("own"),
        F.when(F.col("l_returnflag") == "A", "none").otherwise(F.col("l_partkey").cast("string")).alias("part_text"),
    )
    managed = F.col("managed")
    supplier_key = F.when(managed.isNull() | (managed == 0), F.col("own")).otherwise(managed)
    return (
        lines.join(t.supplier, supplier_key == F.col("s_suppkey"))
        .join(t.part, F.col("part_text").try_cast("bigint") == F.col("p_partkey"))
        .select("l_orderkey", "l_linenumber", "s_name", "p_name")
    )


# ---- aggregations


@query(
    "group_aggs",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 4) AS sum_qty, round(avg(l_extendedprice), 4) AS avg_price,
  round(avg(l_discount), 6) AS avg_discount, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
FROM lineitem GROUP BY ALL""",
)
def group_aggs(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"),
        F.round(F.sum("l_quantity"), 4).alias("sum_qty"),
        F.round(F.avg("l_extendedprice"), 4).alias("avg_price"),
        F.round(F.avg("l_discount"), 6).alias("avg_discount"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
    )


@query("value_counts", f"WITH {MAYBE_SQL} SELECT priority, count(*) AS n FROM maybe WHERE priority IS NOT NULL GROUP BY priority ORDER BY n DESC, priority")
def value_counts(t: Tables) -> DataFrame:
    return profile.value_counts(maybe(t), "priority")


@query(
    "null_counts",
    f"WITH {MAYBE_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM maybe" for c in ["o_orderkey", "status", "price", "priority"]
    ),
)
def null_counts(t: Tables) -> DataFrame:
    return profile.null_counts(maybe(t))


@query(
    "describe_stats",
    "\nUNION ALL ".join(
        f"""SELECT l_returnflag, '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  round(var_samp({c}), 4) AS variance, min({c}) AS min, max({c}) AS max, round(max({c}) - min({c}), 6) AS range,
  round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q3
FROM lineitem GROUP BY l_returnflag"""
        for c in LINE_NUMBERS
    ),
)
def describe_stats(t: Tables) -> DataFrame:
    found = profile.describe(t.lineitem, LINE_NUMBERS, ["l_returnflag"])
    return found.withColumns(
        {c: r6(c) for c in ["mean", "std", "range", "q1", "median", "q3"]} | {"variance": F.round("variance", 4)}
    )


@query(
    "quantiles_iqr",
    """SELECT o_orderstatus, round(quantile_cont(o_totalprice, 0.25), 6) AS q1, round(quantile_cont(o_totalprice, 0.75), 6) AS q3,
  round(quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25), 6) AS iqr FROM orders GROUP BY o_orderstatus""",
)
def quantiles_iqr(t: Tables) -> DataFrame:
    found = quantiles.quantile_columns(t.orders, "o_totalprice", {"q1": 0.25, "q3": 0.75}, ["o_orderstatus"])
    return found.select("o_orderstatus", r6("q1").alias("q1"), r6("q3").alias("q3"), r6(F.col("q3") - F.col("q1")).alias("iqr"))


@query(
    "mean_abs_dev",
    "\nUNION ALL ".join(
        f"""SELECT l_linestatus, '{c}' AS column_name, round(avg(abs({c} - m)), 6) AS mad
FROM (SELECT *, avg({c}) OVER (PARTITION BY l_linestatus) AS m FROM lineitem) GROUP BY l_linestatus"""
        for c in LINE_NUMBERS
    ),
)
def mean_abs_dev(t: Tables) -> DataFrame:
    return profile.mean_abs_deviation(t.lineitem, LINE_NUMBERS, ["l_linestatus"]).withColumn("mad", r6("mad"))


@query(
    "skewness_adj",
    "\nUNION ALL ".join(
        f"SELECT l_returnflag, '{c}' AS column_name, round(skewness({c}), 6) AS skew FROM lineitem GROUP BY l_returnflag" for c in LINE_NUMBERS
    ),
)
def skewness_adj(t: Tables) -> DataFrame:
    return profile.adjusted_skewness(t.lineitem, LINE_NUMBERS, ["l_returnflag"]).withColumn("skew", r6("skew"))


@query(
    "conditional_counts",
    """SELECT l_returnflag, count(*) FILTER (WHERE l_quantity > 25) AS large, count(*) FILTER (WHERE l_discount = 0) AS full_price,
  count(*) FILTER (WHERE l_tax > 0.04 AND l_linestatus = 'O') AS taxed_open FROM lineitem GROUP BY l_returnflag""",
)
def conditional_counts(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count_if(F.col("l_quantity") > 25).alias("large"),
        F.count_if(F.col("l_discount") == 0).alias("full_price"),
        F.count_if((F.col("l_tax") > 0.04) & (F.col("l_linestatus") == "O")).alias("taxed_open"),
    )


@query(
    "min_support_users",
    f"""WITH {standins.ORDER_RATINGS_SQL}
SELECT user_id, item_id, round(rating, 6) AS rating FROM order_ratings
WHERE user_id IN (SELECT user_id FROM order_ratings GROUP BY user_id HAVING count(*) >= 50)""",
)
def min_support_users(t: Tables) -> DataFrame:
    rated = standins.order_ratings(t)
    active = rated.groupBy("user_id").agg(F.count("*").alias("n")).filter("n >= 50")
    return rated.join(active, "user_id", "left_semi").select("user_id", "item_id", r6("rating").alias("rating"))


STATUSES = ["F", "O", "P"]


@query(
    "pivot_unpivot",
    """SELECT o_orderpriority, o_orderstatus, round(avg(o_totalprice), 6) AS avg_price FROM orders WHERE o_orderstatus IN ('F', 'O', 'P') GROUP BY ALL""",
)
def pivot_unpivot(t: Tables) -> DataFrame:
    """To one column per status and back to long form."""
    wide = t.orders.groupBy("o_orderpriority").pivot("o_orderstatus", STATUSES).agg(r6(F.avg("o_totalprice")))
    return wide.unpivot("o_orderpriority", STATUSES, "o_orderstatus", "avg_price").filter("avg_price IS NOT NULL")


@query(
    "attribute_pivot",
    """SELECT p_name, max(p_brand) AS brand, max(p_type) AS kind, max(CAST(p_size AS VARCHAR)) AS size FROM part GROUP BY p_name""",
)
def attribute_pivot(t: Tables) -> DataFrame:
    """Attribute rows (name, value) to one column per attribute, the largest value winning."""
    rows = t.part.select(
        "p_name", F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"), F.col("p_size").cast("string").alias("size")
    ).unpivot("p_name", ["brand", "kind", "size"], "attribute", "value")
    return rows.groupBy("p_name").pivot("attribute", ["brand", "kind", "size"]).agg(F.max("value"))


@query(
    "listagg_names",
    """SELECT l_partkey, string_agg(n_name, '|' ORDER BY n_name) AS marketplaces FROM (
  SELECT DISTINCT l_partkey, n_name FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey)
GROUP BY l_partkey""",
)
def listagg_names(t: Tables) -> DataFrame:
    sellers = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    sold = t.lineitem.select("l_partkey", "l_suppkey").distinct()
    named = sold.join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
    # a set of names is as long as the list of places, not as the number of sales
    return named.groupBy("l_partkey").agg(F.array_join(F.sort_array(F.collect_set("n_name")), "|").alias("marketplaces"))


def matrix_sql(measure: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round({measure}({a}, {b}), 6) + 0.0 AS value FROM lineitem" for a in LINE_NUMBERS for b in LINE_NUMBERS
    )


@query("correlation_matrix", matrix_sql("corr"))
def correlation_matrix(t: Tables) -> DataFrame:
    return profile.correlations(t.lineitem, LINE_NUMBERS).withColumn("value", r6("value") + 0.0)


@query("covariance_matrix", matrix_sql("covar_samp"))
def covariance_matrix(t: Tables) -> DataFrame:
    return profile.covariances(t.lineitem, LINE_NUMBERS).withColumn("value", r6("value") + 0.0)


@query(
    "uncorrelated_cols",
    f"""WITH m AS ({matrix_sql("corr")})
SELECT a AS column_name, max(abs(value)) AS strongest FROM m WHERE a <> b GROUP BY a HAVING max(abs(value)) <= 0.5""",
)
def uncorrelated_cols(t: Tables) -> DataFrame:
    return profile.uncorrelated_columns(t.lineitem, LINE_NUMBERS).withColumn("strongest", r6("strongest"))


# ---- windows, sorts, sets


@query(
    "cumulative_share",
    """WITH s AS (SELECT o_custkey, sum(o_totalprice) AS spent FROM orders GROUP BY o_custkey)
SELECT o_custkey, round(sum(spent) OVER (ORDER BY spent DESC, o_custkey ROWS UNBOUNDED PRECEDING) / sum(spent) OVER (), 6) AS share FROM s""",
)
def cumulative_share(t: Tables) -> DataFrame:
    spent = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("spent"))
    spent = spent.withColumn("falling", -F.col("spent"))
    running = ordering.running_total(spent, ["falling", "o_custkey"], {"upto": F.col("spent")})
    total = spent.agg(F.sum("spent")).first()[0]
    return running.select("o_custkey", r6(F.col("upto") / F.lit(total)).alias("share"))


@query(
    "kfold_assign",
    "SELECT o_orderkey, CAST(ntile(10) OVER (ORDER BY o_orderkey) AS INTEGER) AS fold FROM orders",
)
def kfold_assign(t: Tables) -> DataFrame:
    return ordering.contiguous_folds(t.orders.select("o_orderkey"), ["o_orderkey"], 10)


@query(
    "topk",
    """(SELECT 'top' AS part, o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_custkey, o_orderkey LIMIT 25)
UNION ALL (SELECT 'bottom', o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 1)""",
)
def topk(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    best = rows.orderBy(F.col("o_totalprice").desc(), "o_custkey", "o_orderkey").limit(25)
    least = rows.orderBy("o_totalprice", "o_orderkey").limit(1)
    return best.select(F.lit("top").alias("part"), "*").unionByName(least.select(F.lit("bottom").alias("part"), "*"))


UNION_SQL = """
SELECT DISTINCT o_custkey AS user_id, l_partkey AS item_id, upper(trim(o_orderpriority)) AS action, o_orderdate AS ts
FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag = 'A' JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0
UNION
SELECT DISTINCT o_custkey, l_partkey, 'OPENED', o_orderdate
FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND l_linestatus = 'O' JOIN customer ON c_custkey = o_custkey AND c_mktsegment = 'BUILDING'
UNION
SELECT DISTINCT o_custkey, l_partkey, upper(trim(o_orderpriority)), o_orderdate
FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND l_quantity > 40 JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0
"""


@query("union_branches", UNION_SQL)
def union_branches(t: Tables) -> DataFrame:
    """Three extract branches, each with its own filters, united without repeats.

    The branches share their joins, so the tables are joined once and a row is tagged with
    every branch it belongs to.
    """
    sales = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    rows = sales.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    priority = F.upper(F.trim("o_orderpriority"))
    branches = F.array(
        F.when((F.col("l_returnflag") == "A") & (F.col("c_acctbal") > 0), priority),
        F.when((F.col("l_linestatus") == "O") & (F.col("c_mktsegment") == "BUILDING"), F.lit("OPENED")),
        F.when((F.col("l_quantity") > 40) & (F.col("c_acctbal") > 0), priority),
    )
    actions = F.array_distinct(F.filter(branches, lambda action: action.isNotNull()))
    return rows.select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"), F.col("o_orderdate").alias("ts"), F.explode(actions).alias("action")
    ).distinct()


@query(
    "union_all",
    """SELECT source, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM (
  SELECT 'customer' AS source, c_custkey AS id FROM customer UNION ALL SELECT 'supplier', s_suppkey FROM supplier UNION ALL SELECT 'customer', o_custkey FROM orders)
GROUP BY source""",
)
def union_all(t: Tables) -> DataFrame:
    def named(df: DataFrame, source: str, key: str) -> DataFrame:
        return df.select(F.lit(source).alias("source"), F.col(key).alias("id"))

    rows = (
        named(t.customer, "customer", "c_custkey")
        .unionByName(named(t.supplier, "supplier", "s_suppkey"))
        .unionByName(named(t.orders, "customer", "o_custkey"))
    )
    return rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


@query(
    "popular_items",
    f"""WITH {standins.ORDER_RATINGS_SQL}
SELECT item_id, round(avg(rating), 6) AS mean_rating, count(*) AS ratings FROM order_ratings GROUP BY item_id""",
)
def popular_items(t: Tables) -> DataFrame:
    means = standins.order_ratings(t).groupBy("item_id").agg(r6(F.avg("rating")).alias("mean_rating"), F.count("*").alias("ratings"))
    return means.orderBy(F.col("mean_rating").desc(), F.col("ratings").desc(), "item_id")
