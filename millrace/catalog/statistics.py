"""Hypothesis-test queries: statistics against SQL, p-values by their own tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..analysis import hypothesis as h
from ..analysis import prep
from ..functions import distributions as dist
from ..sources.tables import Tables
from .registry import query


def rounded(df: DataFrame, digits: int = 5) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c, kind in df.dtypes if kind == "double"})


def price_by_status(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), (F.col("o_totalprice") / 1000).alias("price"))


PRICES_SQL = "p AS (SELECT o_orderstatus AS status, o_orderpriority AS priority, o_totalprice / 1000 AS price FROM orders)"


@query(
    "t_one_sample",
    """SELECT l_returnflag, count(*) AS n, round(avg(l_quantity), 5) AS mean, round(stddev_samp(l_quantity) / sqrt(count(*)), 5) AS se,
  round((avg(l_quantity) - 25) / (stddev_samp(l_quantity) / sqrt(count(*))), 5) AS t, (count(*) - 1)::DOUBLE AS df FROM lineitem GROUP BY l_returnflag""",
)
def t_one_sample(t: Tables) -> DataFrame:
    return rounded(h.t_one_sample(t.lineitem, "l_quantity", 25.0, ["l_returnflag"]))


def line_means(t: Tables, number: int) -> DataFrame:
    return t.lineitem.filter(F.col("l_linenumber") == number).groupBy("l_orderkey").agg(F.avg("l_quantity").alias("quantity"))


@query(
    "t_paired",
    """WITH m AS (SELECT l_orderkey, l_linenumber, avg(l_quantity) AS q FROM lineitem WHERE l_linenumber IN (1, 2) GROUP BY ALL),
d AS (SELECT a.q - b.q AS d FROM m a JOIN m b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = 1 AND b.l_linenumber = 2)
SELECT count(*) AS n, round(avg(d), 5) AS mean, round(stddev_samp(d) / sqrt(count(*)), 5) AS se, round(avg(d) / (stddev_samp(d) / sqrt(count(*))), 5) AS t, (count(*) - 1)::DOUBLE AS df FROM d""",
)
def t_paired(t: Tables) -> DataFrame:
    return rounded(h.t_paired(line_means(t, 1), line_means(t, 2), ["l_orderkey"], "quantity"))


@query(
    "t_welch",
    f"""WITH {PRICES_SQL}, g AS (SELECT count(*) FILTER (WHERE status = 'F') AS n_a, count(*) FILTER (WHERE status = 'O') AS n_b,
  avg(price) FILTER (WHERE status = 'F') AS ma, avg(price) FILTER (WHERE status = 'O') AS mb,
  var_samp(price) FILTER (WHERE status = 'F') / n_a AS va, var_samp(price) FILTER (WHERE status = 'O') / n_b AS vb FROM p)
SELECT n_a, n_b, round((ma - mb) / sqrt(va + vb), 5) AS t, round((va + vb) ** 2 / (va ** 2 / (n_a - 1) + vb ** 2 / (n_b - 1)), 5) AS df FROM g""",
)
def t_welch(t: Tables) -> DataFrame:
    return rounded(h.t_welch(price_by_status(t), "status", "price", "F", "O"))


def anova_sql(rows: str, group: str, value: str) -> str:
    return f"""
g AS (SELECT {group}, count(*) AS n, avg({value}) AS m, var_pop({value}) * count(*) AS w FROM {rows} GROUP BY {group}),
s AS (SELECT sum(n * (m - grand) ** 2) AS ss_between, sum(w) AS ss_within, (count(*) - 1)::DOUBLE AS df_between, (sum(n) - count(*))::DOUBLE AS df_within
  FROM g, (SELECT avg({value}) AS grand FROM {rows}))
SELECT round(ss_between, 5) AS ss_between, round(ss_within, 2) AS ss_within, df_between, df_within, round(ss_between / df_between, 5) AS ms_between,
  round(ss_within / df_within, 5) AS ms_within, round((ss_between / df_between) / (ss_within / df_within), 5) AS f FROM s"""


@query(
    "levene",
    f"""WITH {PRICES_SQL}, m AS (SELECT status, median(price) AS med FROM p GROUP BY status),
d AS (SELECT p.status, abs(price - med) AS distance FROM p JOIN m ON m.status = p.status),{anova_sql("d", "status", "distance")}""",
)
def levene(t: Tables) -> DataFrame:
    found = h.levene(price_by_status(t), "status", "price")
    return rounded(found.withColumn("ss_within", F.round("ss_within", 2)))


@query("anova_oneway", f"WITH {PRICES_SQL},{anova_sql('p', 'priority', 'price')}")
def anova_oneway(t: Tables) -> DataFrame:
    found = h.anova_oneway(price_by_status(t), "priority", "price")
    return rounded(found.withColumn("ss_within", F.round("ss_within", 2)))


@query(
    "regression_f",
    """SELECT count(*) AS n, round(regr_slope(l_extendedprice, l_quantity), 5) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 5) AS intercept,
  round(regr_r2(l_extendedprice, l_quantity), 5) AS r2, (count(*) - 2)::DOUBLE AS df_residual,
  round(regr_r2(l_extendedprice, l_quantity) / (1 - regr_r2(l_extendedprice, l_quantity)) * (count(*) - 2), 4) AS f FROM lineitem""",
)
def regression_f(t: Tables) -> DataFrame:
    found = h.regression_f(t.lineitem, "l_extendedprice", "l_quantity")
    return rounded(found.withColumn("f", F.round("f", 4)))


GRID_SQL = """
o AS (SELECT l_returnflag AS a, l_linestatus AS b, count(*) AS n FROM lineitem GROUP BY ALL),
e AS (SELECT r.a, c.b, r.n * c.n / total AS expected FROM (SELECT a, sum(n) AS n FROM o GROUP BY a) r, (SELECT b, sum(n) AS n FROM o GROUP BY b) c, (SELECT sum(n) AS total FROM o)),
cells AS (SELECT e.a, e.b, expected, coalesce(o.n, 0) AS observed FROM e LEFT JOIN o ON o.a = e.a AND o.b = e.b)"""


@query("contingency", f"WITH {GRID_SQL} SELECT a AS l_returnflag, b AS l_linestatus, observed, round(expected, 5) AS expected FROM cells")
def contingency(t: Tables) -> DataFrame:
    return rounded(h.contingency(t.lineitem, "l_returnflag", "l_linestatus"))


@query(
    "chi_square",
    f"WITH {GRID_SQL} SELECT round(sum((observed - expected) ** 2 / expected), 5) AS chi2, ((count(DISTINCT a) - 1) * (count(DISTINCT b) - 1))::DOUBLE AS df FROM cells",
)
def chi_square(t: Tables) -> DataFrame:
    return rounded(h.chi_square(t.lineitem, "l_returnflag", "l_linestatus"))


def returned(t: Tables) -> DataFrame:
    return t.lineitem.select("l_linestatus", (F.col("l_returnflag") == "R").cast("int").alias("returned"))


@query(
    "z_two_prop",
    """WITH g AS (SELECT count(*) FILTER (WHERE l_linestatus = 'F') AS n_a, count(*) FILTER (WHERE l_linestatus = 'O') AS n_b,
  count(*) FILTER (WHERE l_linestatus = 'F' AND l_returnflag = 'R') / n_a AS share_a, count(*) FILTER (WHERE l_linestatus = 'O' AND l_returnflag = 'R') / n_b AS share_b FROM lineitem),
p AS (SELECT *, (share_a * n_a + share_b * n_b) / (n_a + n_b) AS pooled FROM g)
SELECT n_a, n_b, round(share_a, 5) AS share_a, round(share_b, 5) AS share_b, round((share_a - share_b) / sqrt(pooled * (1 - pooled) * (1 / n_a + 1 / n_b)), 5) AS z FROM p""",
)
def z_two_prop(t: Tables) -> DataFrame:
    return rounded(h.z_two_proportions(returned(t), "l_linestatus", "returned", "F", "O"))


@query("test_p_values")
def test_p_values(t: Tables) -> DataFrame:
    """Every test above with its p-value and, for t tests, the critical value."""
    prices = price_by_status(t)
    none = F.lit(None).cast("double")
    found = [
        h.with_t_p(h.t_one_sample(t.lineitem, "l_quantity", 25.0)).select(F.lit("t_one_sample").alias("test"), F.col("t").alias("statistic"), "p", "critical"),
        h.with_t_p(h.t_paired(line_means(t, 1), line_means(t, 2), ["l_orderkey"], "quantity")).select(F.lit("t_paired"), "t", "p", "critical"),
        h.with_t_p(h.t_welch(prices, "status", "price", "F", "O")).select(F.lit("t_welch"), "t", "p", "critical"),
        h.with_f_p(h.levene(prices, "status", "price"), F.col("df_between"), F.col("df_within")).select(F.lit("levene"), "f", "p", none),
        h.with_f_p(h.anova_oneway(prices, "priority", "price"), F.col("df_between"), F.col("df_within")).select(F.lit("anova_oneway"), "f", "p", none),
        h.with_f_p(h.regression_f(t.lineitem, "l_extendedprice", "l_quantity"), F.lit(1.0), F.col("df_residual")).select(F.lit("regression_f"), "f", "p", none),
        h.with_chi2_p(h.chi_square(t.lineitem, "l_returnflag", "l_linestatus")).select(F.lit("chi_square"), "chi2", "p", none),
        h.with_z_p(h.z_two_proportions(returned(t), "l_linestatus", "returned", "F", "O")).select(F.lit("z_two_prop"), "z", "p", none),
    ]
    first, *rest = found
    for part in rest:
        first = first.union(part)
    return first


@query(
    "z_tail_mean",
    # the normal tail as its power series, since the other engine has no error function
    """WITH m AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq FROM lineitem),
d AS (SELECT (l_quantity - mq) / sq AS z, count(*) AS c FROM lineitem, m GROUP BY ALL)
SELECT CAST(sum(c) AS BIGINT) AS n, round(sum(c * (0.5 - list_sum(list_transform(range(0, 40),
  lambda n: CASE WHEN n % 2 = 0 THEN 1 ELSE -1 END * pow(z, 2 * n + 1) / (pow(2, n) * gamma(n + 1) * (2 * n + 1)))) / sqrt(2 * pi()))) / sum(c), 6) AS mean_tail FROM d""",
)
def z_tail_mean(t: Tables) -> DataFrame:
    """Mean upper-tail probability of the standardised quantities."""
    scales = prep.standard_scales(t.lineitem, ["l_quantity"])
    tails = prep.standardize(t.lineitem.select("l_quantity"), scales).select(dist.normal_tail_column("l_quantity").alias("tail"))
    return tails.agg(F.count("*").alias("n"), F.round(F.avg("tail"), 6).alias("mean_tail"))
