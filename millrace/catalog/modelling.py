"""Models, clustering and the scores of predictions."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..analysis import classify, linkage, models, newton, prep, resample, scores, tall, trees
from ..functions import arrays
from ..functions import text as texts
from ..operators import profile
from ..operators.ordering import contiguous_folds, hash_unit
from ..session import cut
from ..sources.tables import Tables
from .registry import query

HELD = 0.25
HELD_SQL = "CAST('0x' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0 < 0.25"
#: Models that are fitted side by side: what one of them leaves idle works for the next.
AT_ONCE = 3
KS = [3, 5, 9, 20, 62]
SWEEP = list(range(1, 20, 2))
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def r6(column) -> F.Column:
    return F.round(column, 6)


def vectors(t: Tables) -> DataFrame:
    rows = t.embeddings.select("vec_id", F.col("label").cast("bigint").alias("label"), arrays.doubles(F.col("embedding")).alias("vector"))
    return cut(rows.withColumn("held", hash_unit("vec_id") < HELD))


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return rows.filter("NOT held"), rows.filter("held")


# ---- scores

PREDICTED_SQL = """
p AS (SELECT vec_id, label, CAST(list_position(embedding[1:10], list_max(embedding[1:10])) - 1 AS INTEGER) AS predicted FROM embeddings),
c AS (SELECT unnest(range(10))::INTEGER AS class),
r AS (SELECT class, (SELECT count(*) FROM p WHERE label = class) AS support, (SELECT count(*) FROM p WHERE predicted = class) AS claimed,
        (SELECT count(*) FROM p WHERE label = class AND predicted = class) AS tp FROM c),
report AS (SELECT class, support, coalesce(tp / nullif(claimed, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall,
        coalesce(2 * tp / nullif(support + claimed, 0), 0) AS f1, tp FROM r)"""


def predictions(t: Tables) -> DataFrame:
    """The class with the largest of the first ten scores."""
    return t.embeddings.select("vec_id", "label", arrays.arg_max(F.slice("embedding", 1, 10)).alias("predicted"))


@query(
    "classifier_metrics",
    f"""WITH {PREDICTED_SQL} SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall, round(avg(f1), 6) AS f1 FROM report""",
)
def classifier_metrics(t: Tables) -> DataFrame:
    found = scores.classifier_metrics(predictions(t))
    return found.select(*[r6(c).alias(c) for c in found.columns])


@query(
    "confusion_matrix",
    f"WITH {PREDICTED_SQL} SELECT a.class AS label, b.class AS predicted, (SELECT count(*) FROM p WHERE label = a.class AND predicted = b.class) AS n FROM c a, c b",
)
def confusion_matrix(t: Tables) -> DataFrame:
    return scores.confusion_matrix(predictions(t), list(range(10)))


@query(
    "class_report",
    f"WITH {PREDICTED_SQL} SELECT class, support, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM report WHERE support > 0 OR class IN (SELECT predicted FROM p)",
)
def class_report(t: Tables) -> DataFrame:
    found = scores.class_report(predictions(t))
    return found.select("class", "support", *[r6(c).alias(c) for c in ("precision", "recall", "f1")])


FLAGS_SQL = """
f AS (SELECT quality, toxic, CASE WHEN n_chars > 500 THEN 1 ELSE 0 END AS quality_predicted, CASE WHEN lang = 'en' AND n_chars < 2000 THEN 1 ELSE 0 END AS toxic_predicted
  FROM documents JOIN labels USING (doc_id))"""


@query(
    "multilabel_metrics",
    f"WITH {FLAGS_SQL}, s AS (SELECT avg((quality = quality_predicted AND toxic = toxic_predicted)::INTEGER) AS a FROM f)\n"
    + "\nUNION ALL ".join(
        f"""SELECT '{n}' AS label, round(2 * sum({n} * {n}_predicted) / sum({n} + {n}_predicted), 6) AS f1, round(sum({n} * {n}_predicted) / sum({n}), 6) AS recall,
  round(any_value(a), 6) AS subset_accuracy FROM f, s"""
        for n in ("quality", "toxic")
    ),
)
def multilabel_metrics(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", "lang", "n_chars").join(t.labels, "doc_id")
    flagged = rows.withColumns(
        {
            "quality_predicted": (F.col("n_chars") > 500).cast("int"),
            "toxic_predicted": ((F.col("lang") == "en") & (F.col("n_chars") < 2000)).cast("int"),
        }
    )
    found = scores.multilabel_metrics(flagged, ["quality", "toxic"])
    return found.withColumns({c: r6(c) for c in ("f1", "recall", "subset_accuracy")})


def label_scores(t: Tables) -> DataFrame:
    """One 0/1 label per return flag; the score is coarse, so many rows tie."""
    return t.lineitem.select(
        F.explode(F.array(*[F.lit(x) for x in "ANR"])).alias("flag"), "l_returnflag", F.round(F.col("l_discount") + F.col("l_quantity") / 100, 2).alias("score")
    ).select("flag", "score", (F.col("l_returnflag") == F.col("flag")).cast("bigint").alias("label"))


STEPS_SQL = """
s AS (SELECT flag, CASE WHEN l_returnflag = flag THEN 1 ELSE 0 END AS label, round(l_discount + l_quantity / 100, 2) AS score FROM lineitem, (VALUES ('A'), ('N'), ('R')) v(flag)),
steps AS (SELECT flag, score, sum(label) AS p, sum(1 - label) AS n FROM s GROUP BY flag, score),
run AS (SELECT *, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER (PARTITION BY flag) AS positives, sum(n) OVER (PARTITION BY flag) AS negatives
  FROM steps WINDOW w AS (PARTITION BY flag ORDER BY score DESC))"""


@query(
    "average_precision",
    f"WITH {STEPS_SQL} SELECT flag, round(sum(p / positives * tp / (tp + fp)), 6) AS average_precision FROM run GROUP BY flag",
)
def average_precision(t: Tables) -> DataFrame:
    return scores.average_precision(label_scores(t), "label", "score", ["flag"]).withColumn("average_precision", r6("average_precision"))


@query(
    "roc_auc",
    f"WITH {STEPS_SQL} SELECT flag, round(sum(n / negatives * (tp - p / 2) / positives), 6) AS auc FROM run GROUP BY flag",
)
def roc_auc(t: Tables) -> DataFrame:
    return scores.roc_auc(label_scores(t), "label", "score", ["flag"]).withColumn("auc", r6("auc"))


@query(
    "roc_points",
    f"WITH {STEPS_SQL} SELECT flag, score, round(tp / positives, 6) AS tpr, round(fp / negatives, 6) AS fpr FROM run",
)
def roc_points(t: Tables) -> DataFrame:
    points = scores.roc_points(label_scores(t), "label", "score", ["flag"])
    return points.select("flag", "score", r6("tpr").alias("tpr"), r6("fpr").alias("fpr"))


@query(
    "box_stats",
    "\nUNION ALL ".join(
        f"""SELECT l_returnflag, '{c}' AS column_name, round(any_value(q1), 6) AS q1, round(any_value(m), 6) AS median, round(any_value(q3), 6) AS q3,
  min({c}) FILTER (WHERE {c} >= q1 - 1.5 * (q3 - q1) AND {c} <= q3 + 1.5 * (q3 - q1)) AS whisker_low,
  max({c}) FILTER (WHERE {c} >= q1 - 1.5 * (q3 - q1) AND {c} <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
  count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers
FROM lineitem JOIN (SELECT l_returnflag, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS m, quantile_cont({c}, 0.75) AS q3 FROM lineitem GROUP BY l_returnflag) USING (l_returnflag)
GROUP BY l_returnflag"""
        for c in LINE_NUMBERS
    ),
)
def box_stats(t: Tables) -> DataFrame:
    return profile.box_stats(t.lineitem, LINE_NUMBERS, ["l_returnflag"]).withColumns({c: r6(c) for c in ("q1", "median", "q3")})


@query(
    "histogram_bins",
    """WITH s AS (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 20 AS w FROM orders)
SELECT CAST(least(floor((o_totalprice - lo) / w), 19) AS INTEGER) AS bin, count(*) AS n, round(any_value(lo) + bin * any_value(w), 4) AS lower FROM orders, s GROUP BY bin""",
)
def histogram_bins(t: Tables) -> DataFrame:
    return profile.histogram(t.orders, "o_totalprice", 20).withColumn("lower", F.round("lower", 4))


# ---- classifiers in SQL terms


def near_sql(k: int) -> str:
    return f"""
v AS (SELECT vec_id, label::BIGINT AS label, CAST(embedding AS DOUBLE[]) AS e, {HELD_SQL} AS held FROM embeddings),
near AS (
  SELECT a.vec_id, a.label AS actual, b.label, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_distance(a.e, b.e), 8), b.vec_id) AS rank
  FROM v a JOIN v b ON a.held AND NOT b.held QUALIFY rank <= {k})"""


def votes_sql(ks) -> str:
    return f"""
votes AS (
  SELECT k, vec_id, any_value(actual) AS actual, label AS predicted FROM near JOIN (SELECT unnest({ks})::INTEGER AS k) ON rank <= k
  GROUP BY k, vec_id, label QUALIFY row_number() OVER (PARTITION BY k, vec_id ORDER BY count(*) DESC, label) = 1)"""


@query("knn_classify", f"WITH {near_sql(max(KS))},{votes_sql(KS)} SELECT k, vec_id, predicted FROM votes")
def knn_classify(t: Tables) -> DataFrame:
    train, test = split(vectors(t))
    nearest = classify.nearest_rows(test, train, max(KS), "vec_id", "vector", "label")
    return classify.vote(nearest, "vec_id", KS)


@query(
    "knn_k_sweep",
    f"WITH {near_sql(max(SWEEP))},{votes_sql(SWEEP)} SELECT k, count(*) AS n, round(avg((actual = predicted)::INTEGER), 6) AS accuracy FROM votes GROUP BY k",
)
def knn_k_sweep(t: Tables) -> DataFrame:
    """One distance pass serves every k."""
    train, test = split(vectors(t))
    voted = classify.vote(classify.nearest_rows(test, train, max(SWEEP), "vec_id", "vector", "label"), "vec_id", SWEEP)
    hits = (F.col("predicted") == F.col("label")).cast("double")
    return voted.join(test.select("vec_id", "label"), "vec_id").groupBy("k").agg(F.count("*").alias("n"), r6(F.avg(hits)).alias("accuracy"))


@query(
    "gaussian_nb",
    f"""WITH v AS (SELECT vec_id, label::BIGINT AS label, {HELD_SQL} AS held, generate_subscripts(embedding, 1) AS pos, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings),
widest AS (SELECT max(v) AS w FROM (SELECT var_pop(x) AS v FROM v WHERE NOT held GROUP BY pos)),
m AS (SELECT label AS class, pos, avg(x) AS mean, var_pop(x) + 1e-9 * any_value(w) AS var, count(*) AS n FROM v, widest WHERE NOT held GROUP BY label, pos),
total AS (SELECT count(DISTINCT vec_id) AS n FROM v WHERE NOT held),
s AS (SELECT vec_id, v.label, class, ln(any_value(m.n) / any_value(total.n)) - 0.5 * sum(ln(2 * pi() * var) + (x - mean) ** 2 / var) AS score
  FROM v JOIN m ON m.pos = v.pos, total WHERE held GROUP BY vec_id, v.label, class)
SELECT vec_id, label, class AS predicted FROM s QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, class) = 1""",
)
def gaussian_nb(t: Tables) -> DataFrame:
    train, test = split(vectors(t))
    model = classify.gaussian_model(train, "vector", "label")
    return test.select("vec_id", "label", classify.gaussian_predict(F.col("vector"), model).alias("predicted"))


# ---- MLlib models: rows only, scores are checked by the tests


def featured(t: Tables) -> tuple[DataFrame, DataFrame]:
    return split(cut(models.from_array(vectors(t), "vector").select("vec_id", F.col("label").cast("double").alias("label"), "features", "held")))


def evaluated(t: Tables, build) -> DataFrame:
    """Accuracy on the rows that were fitted and on the rows that were held out."""
    train, test = featured(t)
    model = build(train).fit(train)
    return (
        models.accuracy(model, train)
        .select(F.lit("train").alias("part"), "*")
        .unionByName(models.accuracy(model, test).select(F.lit("test").alias("part"), "*"))
    )


@query("logreg_eval")
def logreg_eval(t: Tables) -> DataFrame:
    return evaluated(t, lambda train: models.logistic(train.count()))


def scored_trees(forest: trees.Forest, train: DataFrame, test: DataFrame) -> DataFrame:
    hits = F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy")
    parts = [forest.transform(rows, "vector").agg(F.lit(part).alias("part"), F.count("*").alias("rows"), hits) for part, rows in (("train", train), ("test", test))]
    return parts[0].unionByName(parts[1])


@query("dtree_eval")
def dtree_eval(t: Tables) -> DataFrame:
    """A tree without limits, depth 1, and leaves of at least 8 rows."""
    train, test = split(vectors(t))

    def scored(kind: tuple[str, int | None, int]) -> DataFrame:
        name, depth, leaf = kind
        return cut(scored_trees(trees.grow(train, "vector", "label", depth=depth, leaf=leaf), train, test).withColumn("tree", F.lit(name)))

    with ThreadPoolExecutor(AT_ONCE) as pool:
        return reduce(DataFrame.unionByName, pool.map(scored, (("deep", None, 1), ("stump", 1, 1), ("leaf_8", None, 8))))


def best_splits_sql(level: int) -> str:
    """The best split of each node of ``r{level}(path, vec_id, label, v)`` that holds several labels, as ``s{level}``."""
    logs = lambda c: f"CASE WHEN {c} > 0 THEN {c} * ln({c}) ELSE 0 END"
    return f"""
v{level} AS (SELECT path, label, unnest(generate_series(0, len(v) - 1)) AS feature, unnest(v) AS x FROM r{level}),
k{level} AS (SELECT path, feature, x, label AS class, count(*) AS n FROM v{level} GROUP BY ALL),
d{level} AS (SELECT path, feature, x, lead(x) OVER (PARTITION BY path, feature ORDER BY x) AS next FROM (SELECT DISTINCT path, feature, x FROM k{level})),
c{level} AS (SELECT d.path, d.feature, d.x, next, sum(coalesce(n, 0)) OVER (PARTITION BY d.path, d.feature, c.class ORDER BY d.x) AS l, sum(coalesce(n, 0)) OVER (PARTITION BY d.path, d.feature, c.class) AS t
  FROM d{level} d CROSS JOIN classes c LEFT JOIN k{level} k ON k.path = d.path AND k.feature = d.feature AND k.x = d.x AND k.class = c.class),
e{level} AS (SELECT path, feature, x, any_value(next) AS next, sum(l)::DOUBLE AS nl, sum(t)::DOUBLE AS n, sum({logs("l")}) AS sl, sum({logs("(t - l)")}) AS sr, sum({logs("t")}) AS st FROM c{level} GROUP BY path, feature, x),
b{level} AS (SELECT path, feature, (x + next) / 2 AS threshold, n,
    round((n * ln(n) - st - (nl * ln(nl) - sl) - ((n - nl) * ln(n - nl) - sr)) / ln(2) / n, 9) AS gain FROM e{level} WHERE next IS NOT NULL),
s{level} AS (SELECT * FROM b{level} WHERE path IN (SELECT path FROM r{level} GROUP BY path HAVING count(DISTINCT label) > 1)
  QUALIFY row_number() OVER (PARTITION BY path ORDER BY gain DESC, feature, threshold) = 1)"""


@query(
    "dtree_splits",
    f"""WITH classes AS (SELECT DISTINCT label::BIGINT AS class FROM embeddings),
r0 AS (SELECT '' AS path, vec_id, label::BIGINT AS label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE NOT ({HELD_SQL})),{best_splits_sql(0)},
r1 AS (SELECT CASE WHEN v[feature + 1] <= threshold THEN 'L' ELSE 'R' END AS path, vec_id, label, v FROM r0 JOIN s0 USING (path)),{best_splits_sql(1)}
SELECT path, feature::INTEGER AS feature, round(threshold, 6) AS threshold, n::BIGINT AS rows FROM (SELECT * FROM s0 UNION ALL SELECT * FROM s1)""",
)
def dtree_splits(t: Tables) -> DataFrame:
    """The splits of a tree of depth 2 by entropy."""
    train, _ = split(vectors(t))
    found = trees.grow(train, "vector", "label", depth=2).nodes
    rows = [(path, n.feature, round(n.threshold, 6), int(sum(n.counts))) for (_, path), n in found.items() if n.feature is not None]
    return t.spark.createDataFrame(rows, "path string, feature int, threshold double, rows bigint")


def forest(rows: DataFrame, size: int) -> trees.Forest:
    """Trees of resampled rows by Gini impurity, with one feature drawn for each split."""
    return trees.grow(rows, "vector", "label", key="vec_id", trees=size, impurity="gini", per_split=1)


@query("rforest_eval")
def rforest_eval(t: Tables) -> DataFrame:
    train, test = split(vectors(t))
    return scored_trees(forest(train, 21), train, test)


@query("rforest_importances")
def rforest_importances(t: Tables) -> DataFrame:
    train, _ = split(vectors(t))
    return t.spark.createDataFrame(list(enumerate(forest(train, 20).importances())), "feature int, importance double")


@query("mlp_eval")
def mlp_eval(t: Tables) -> DataFrame:
    return evaluated(t, lambda _: models.perceptron([64, 64, 64, 10]))


@query("kfold_scores")
def kfold_scores(t: Tables) -> DataFrame:
    """Ten contiguous folds of a forest, with the mean and population deviation of their accuracies."""
    parts = cut(contiguous_folds(vectors(t), ["vec_id"], 10))

    def scored(fold: int) -> DataFrame:
        asked = forest(parts.filter(F.col("fold") != fold), 20).transform(parts.filter(F.col("fold") == fold), "vector")
        hits = (F.col("prediction") == F.col("label")).cast("double")
        return cut(asked.agg(F.count("*").alias("rows"), F.avg(hits).alias("accuracy"), F.lit(fold).alias("fold")))

    with ThreadPoolExecutor(AT_ONCE) as pool:
        folds = cut(reduce(DataFrame.unionByName, pool.map(scored, range(1, 11))))
    summary = folds.agg(F.avg("accuracy").alias("mean"), F.stddev_pop("accuracy").alias("deviation")).withColumn("_one", F.lit(1))
    return folds.withColumn("_one", F.lit(1)).join(summary, "_one").drop("_one")


PRICE_FEATURES = ["l_quantity", "l_discount", "l_tax"]


def least_squares_sql(rows: str) -> str:
    """Coefficients b1, b2, b3 and the intercept b0 by Cramer's rule on the covariances."""
    x, y = PRICE_FEATURES, "l_extendedprice"

    def det(columns: list[list[str]]) -> str:
        a, b, c = columns
        return (
            f"({a[0]} * ({b[1]} * {c[2]} - {b[2]} * {c[1]}) - {b[0]} * ({a[1]} * {c[2]} - {a[2]} * {c[1]})"
            f" + {c[0]} * ({a[1]} * {b[2]} - {a[2]} * {b[1]}))"
        )

    moments = [f"covar_pop({x[i]}, {x[j]}) AS c{i}{j}" for i in range(3) for j in range(3)]
    moments += [f"covar_pop({x[i]}, {y}) AS y{i}" for i in range(3)]
    moments += [f"avg({c}) AS m{i}" for i, c in enumerate([*x, y])]
    columns = [[f"c{i}{j}" for i in range(3)] for j in range(3)]
    target = [f"y{i}" for i in range(3)]
    solved = [f"{det([target if k == j else columns[k] for k in range(3)])} / {det(columns)} AS b{j + 1}" for j in range(3)]
    return f"""
moments AS (SELECT {", ".join(moments)} FROM {rows}),
solved AS (SELECT *, {", ".join(solved)} FROM moments),
fit AS (SELECT b1, b2, b3, m3 - b1 * m0 - b2 * m1 - b3 * m2 AS b0 FROM solved)"""


@query(
    "linreg_coeffs",
    f"""WITH {least_squares_sql("lineitem")}
SELECT 'l_quantity' AS name, round(b1, 4) AS coefficient FROM fit UNION ALL SELECT 'l_discount', round(b2, 4) FROM fit
UNION ALL SELECT 'l_tax', round(b3, 4) FROM fit UNION ALL SELECT 'intercept', round(b0, 4) FROM fit""",
)
def linreg_coeffs(t: Tables) -> DataFrame:
    rows = models.assembled(t.lineitem, PRICE_FEATURES).select("features", F.col("l_extendedprice").alias("label"))
    model = models.linear().fit(rows)
    named = [*zip(PRICE_FEATURES, map(float, model.coefficients)), ("intercept", float(model.intercept))]
    return t.spark.createDataFrame(named, "name string, coefficient double").withColumn("coefficient", F.round("coefficient", 4))


@query(
    "linreg_mse",
    f"""WITH s AS (SELECT *, {HELD_SQL.replace("vec_id", "l_orderkey")} AS held FROM lineitem), train AS (SELECT * FROM s WHERE NOT held),{least_squares_sql("train")}
SELECT CAST(floor(l_extendedprice / 10000) AS BIGINT) AS price_band, count(*) AS rows,
  round(avg((l_extendedprice - b0 - b1 * l_quantity - b2 * l_discount - b3 * l_tax) ** 2) / 1000000, 4) AS mse_millions
FROM s, fit WHERE held GROUP BY price_band""",
)
def linreg_mse(t: Tables) -> DataFrame:
    """Fitted on scaled training rows; held-out error, and predictions for given rows after the same scaling."""
    rows = t.lineitem.select("l_orderkey", F.col("l_extendedprice").alias("label"), *PRICE_FEATURES).withColumn("held", hash_unit("l_orderkey") < HELD)
    train, test = split(rows)
    scales = prep.standard_scales(train, PRICE_FEATURES)
    model = models.linear().fit(models.assembled(prep.standardize(train, scales), PRICE_FEATURES))
    error = F.col("label") - F.col("prediction")
    return (
        model.transform(models.assembled(prep.standardize(test, scales), PRICE_FEATURES))
        .groupBy(F.floor(F.col("label") / 10000).alias("price_band"))
        .agg(F.count("*").alias("rows"), F.round(F.avg(error * error) / 1_000_000, 4).alias("mse_millions"))
    )


@query("kmeans_elbow")
def kmeans_elbow(t: Tables) -> DataFrame:
    return models.kmeans_elbow(models.from_array(vectors(t), "vector"), range(1, 10))


@query("kmeans_assign")
def kmeans_assign(t: Tables) -> DataFrame:
    """Four groups and the box numbers of every measure in each."""
    grouped = models.kmeans_groups(models.from_array(vectors(t), "vector"), 4)
    names = [f"x_{i + 1}" for i in range(64)]
    measures = grouped.select("cluster", *[F.col("vector")[i].alias(n) for i, n in enumerate(names)])
    return profile.box_stats(cut(measures), names, ["cluster"])


@query("bisecting_groups")
def bisecting_groups(t: Tables) -> DataFrame:
    return models.bisecting_groups(models.from_array(vectors(t), "vector"), 6).groupBy("cluster").agg(F.count("*").alias("n"))


@query(
    "linkage_summary",
    """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
pairs AS (SELECT round(list_distance(a.x, b.x), 10) AS d FROM v a JOIN v b ON a.vec_id < b.vec_id)
SELECT (SELECT count(*) FROM v) AS rows, (SELECT count(*) - 1 FROM v) AS merges, count(*) AS pairs, round(min(d), 6) AS lowest, round(sum(d) / count(*), 5) AS mean_height, 6::BIGINT AS groups FROM pairs""",
)
def linkage_summary(t: Tables) -> DataFrame:
    """What holds for any average-linkage tree: the lowest merge is the least distance, and heights weighted by pairs average to the mean distance."""
    tree = linkage.average_linkage(vectors(t), "vec_id", "vector")
    pairs = sum(m.pairs for m in tree.merges)
    mean = math.fsum(m.pairs * m.height for m in tree.merges) / pairs
    row = (len(tree.keys), len(tree.merges), pairs, round(tree.merges[0].height, 6), round(mean, 5), len(set(tree.groups(6).values())))
    return t.spark.createDataFrame([row], "rows bigint, merges bigint, pairs bigint, lowest double, mean_height double, groups bigint")


@query("linkage_groups")
def linkage_groups(t: Tables) -> DataFrame:
    """Six groups of all rows by average linkage, with the box numbers of a few measures and the cophenetic correlation."""
    rows = vectors(t)
    tree = linkage.average_linkage(rows, "vec_id", "vector")
    grouped = linkage.group_rows(t.spark, rows, tree, 6, "vec_id")
    names = [f"x_{i + 1}" for i in range(64)]
    measures = cut(grouped.select("cluster", *[F.col("vector")[i].alias(n) for i, n in enumerate(names)]))
    return profile.box_stats(measures, names, ["cluster"]).withColumn("cophenetic", F.lit(tree.cophenetic_correlation()))


def jacobi_sql() -> str:
    """Components of the standardised columns: rotations that clear one entry of the covariance matrix after another."""
    scale = ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(LINE_NUMBERS))
    scaled = ", ".join(f"({c} - m{i}) / s{i} AS z{i}" for i, c in enumerate(LINE_NUMBERS))
    matrix = ", ".join(f"covar_samp(z{i}, z{j})" for i in range(4) for j in range(4))
    ones = ", ".join(str(float(i == j)) for i in range(4) for j in range(4))
    columns = "list_transform(range(16), lambda i: CASE i % 4 WHEN p THEN c * {0}[i - i % 4 + p + 1] - s * {0}[i - i % 4 + q + 1] WHEN q THEN s * {0}[i - i % 4 + p + 1] + c * {0}[i - i % 4 + q + 1] ELSE {0}[i + 1] END)"
    rows = "list_transform(range(16), lambda i: CASE i // 4 WHEN p THEN c * b[4 * p + i % 4 + 1] - s * b[4 * q + i % 4 + 1] WHEN q THEN s * b[4 * p + i % 4 + 1] + c * b[4 * q + i % 4 + 1] ELSE b[i + 1] END)"
    return f"""WITH RECURSIVE f AS (SELECT {scale} FROM lineitem),
z AS (SELECT l_orderkey, l_linenumber, {scaled} FROM lineitem, f),
jacobi AS (
  SELECT 0 AS step, [{matrix}]::DOUBLE[] AS a, [{ones}]::DOUBLE[] AS v FROM z
  UNION ALL
  SELECT step + 1, {rows}, w FROM (SELECT *, {columns.format("a")} AS b, {columns.format("v")} AS w FROM (
    SELECT *, 1 / sqrt(1 + t * t) AS c, t / sqrt(1 + t * t) AS s FROM (
      SELECT *, CASE WHEN tau IS NULL THEN 0 WHEN tau >= 0 THEN 1 / (tau + sqrt(1 + tau * tau)) ELSE 1 / (tau - sqrt(1 + tau * tau)) END AS t FROM (
        SELECT *, (a[5 * q + 1] - a[5 * p + 1]) / (2 * nullif(a[4 * p + q + 1], 0)) AS tau FROM (
          SELECT *, [0, 0, 0, 1, 1, 2][step % 6 + 1] AS p, [1, 2, 3, 2, 3, 3][step % 6 + 1] AS q FROM jacobi WHERE step < 60)))))),
e AS (SELECT row_number() OVER (ORDER BY a[5 * i + 1] DESC) AS component, a[5 * i + 1] AS variance, [v[i + 1], v[i + 5], v[i + 9], v[i + 13]] AS u
  FROM jacobi, range(4) r(i) WHERE step = 60)"""


@query(
    "pca_variance",
    jacobi_sql()
    + """
SELECT component, round(variance, 6) AS variance, round(variance / sum(variance) OVER (), 6) AS share,
  round(sum(variance) OVER (ORDER BY component) / sum(variance) OVER (), 6) AS running FROM e""",
)
def pca_variance(t: Tables) -> DataFrame:
    table, _ = tall.principal_components(standard_lines(t), LINE_NUMBERS)
    return t.spark.createDataFrame(table).select("component", *[r6(c).alias(c) for c in ("variance", "share", "running")])


def standard_lines(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", *LINE_NUMBERS)
    return prep.standardize(rows, prep.standard_scales(rows, LINE_NUMBERS))


@query(
    "pca_project",
    jacobi_sql()
    + """,
big AS (SELECT *, list_max(list_transform(u, lambda x: abs(x))) AS most FROM e),
o AS (SELECT component, list_transform(u, lambda x: x * sign(list_filter(u, lambda y: abs(y) >= 0.5 * most)[1])) AS u FROM big)
SELECT l_orderkey, l_linenumber, """
    + ", ".join(f"round({' + '.join(f'z{i} * o{k}.u[{i + 1}]' for i in range(4))}, 5) + 0.0 AS pc_{k}" for k in (1, 2))
    + " FROM z, o o1, o o2 WHERE o1.component = 1 AND o2.component = 2",
)
def pca_project(t: Tables) -> DataFrame:
    rows = standard_lines(t)
    _, loadings = tall.principal_components(rows, LINE_NUMBERS)
    projected = models.project(rows, LINE_NUMBERS, loadings, 2)
    return projected.select("l_orderkey", "l_linenumber", *[(F.round(c, 5) + 0.0).alias(c) for c in ("pc_1", "pc_2")])


def newton_sql(steps: int = 12) -> str:
    """Newton steps from zero over rows ``x(x1, x2, x3, y)``, each solved by elimination; the last CTE is ``w{steps}``."""
    ctes = ["w0 AS (SELECT 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2, 0.0::DOUBLE AS b3)"]
    one = lambda i: "1.0" if i == 0 else f"x{i}"
    for k in range(steps):
        carried = ", ".join(f"any_value(b{i}) AS b{i}" for i in range(4))
        cells = [f"sum(p * (1 - p) * {one(i)} * {one(j)}){' + 1' if i == j > 0 else ''} AS m{i}{j}" for i in range(4) for j in range(4)]
        cells += [f"sum((p - y) * {one(i)}){f' + any_value(b{i})' if i else ''} AS m{i}4" for i in range(4)]
        ctes.append(
            f"g{k}_0 AS (SELECT {carried}, {', '.join(cells)} FROM (SELECT *, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2 + b3 * x3))) AS p FROM x, w{k}))"
        )
        for c in range(3):
            kept = [f"m{i}{j}" for i in range(c + 1) for j in range(i, 5)]
            below = [f"m{i}{j} - m{i}{c} / m{c}{c} * m{c}{j} AS m{i}{j}" for i in range(c + 1, 4) for j in range(c + 1, 5)]
            ctes.append(f"g{k}_{c + 1} AS (SELECT b0, b1, b2, b3, {', '.join(kept + below)} FROM g{k}_{c})")
        d3, d2 = "m34 / m33", "(m24 - m23 * d3) / m22"
        ctes.append(
            f"w{k + 1} AS (SELECT b0 - (m04 - m01 * d1 - m02 * d2 - m03 * d3) / m00 AS b0, b1 - d1 AS b1, b2 - d2 AS b2, b3 - d3 AS b3 FROM ("
            f"SELECT *, (m14 - m12 * d2 - m13 * d3) / m11 AS d1 FROM (SELECT *, {d2} AS d2 FROM (SELECT *, {d3} AS d3 FROM g{k}_3))))"
        )
    return ",\n".join(ctes)


NET_SQL = """f AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_discount) AS md, stddev_pop(l_discount) AS sd, avg(l_tax) AS mt, stddev_pop(l_tax) AS st FROM lineitem),
x AS (SELECT l_orderkey, l_linenumber, (l_quantity - mq) / sq AS x1, (l_discount - md) / sd AS x2, (l_tax - mt) / st AS x3,
  (l_extendedprice > 50000)::INTEGER AS y FROM lineitem, f)"""


@query(
    "logit_newton",
    f"""WITH {NET_SQL},
{newton_sql()}
SELECT name, round(coefficient, 6) + 0.0 AS coefficient, (SELECT count(*) FROM x) AS rows,
  (SELECT round(avg(((b0 + b1 * x1 + b2 * x2 + b3 * x3 > 0)::INTEGER = y)::INTEGER), 6) FROM x, w12) AS accuracy
FROM (SELECT 'l_quantity' AS name, b1 AS coefficient FROM w12 UNION ALL SELECT 'l_discount', b2 FROM w12
  UNION ALL SELECT 'l_tax', b3 FROM w12 UNION ALL SELECT 'intercept', b0 FROM w12)""",
)
def logit_newton(t: Tables) -> DataFrame:
    """Which lines cost more than 50,000, from three scaled features; fitted until the gradient vanishes."""
    rows = t.lineitem.select(*PRICE_FEATURES, (F.col("l_extendedprice") > 50000).cast("int").alias("label"))
    rows = prep.standardize(rows, prep.standard_scales(rows, PRICE_FEATURES))
    found = newton.fit(newton.sparse(rows.withColumn("features", F.array(*PRICE_FEATURES))), len(PRICE_FEATURES))
    named = [*zip(PRICE_FEATURES, map(float, found.weights)), ("intercept", found.intercept)]
    margin = sum((F.col(c) * F.lit(v) for c, v in named[:-1]), F.lit(found.intercept))
    hit = ((margin > 0).cast("int") == F.col("label")).cast("double")
    accuracy = rows.agg(r6(F.avg(hit))).first()[0]
    table = t.spark.createDataFrame(named, "name string, coefficient double")
    return table.select("name", (r6("coefficient") + 0.0).alias("coefficient"), F.lit(found.rows).cast("bigint").alias("rows"), F.lit(accuracy).alias("accuracy"))


@query(
    "bootstrap_model",
    f"""WITH v AS (SELECT vec_id, label::BIGINT AS label, {HELD_SQL} AS held, generate_subscripts(embedding, 1) AS pos, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings),
u AS (SELECT vec_id, replicate, CAST('0x' || substr(md5('|' || vec_id || '|' || replicate), 1, 12) AS BIGINT) / {float(16**12)}::DOUBLE AS u FROM embeddings, range(1, 11) r(replicate)),
w AS (SELECT vec_id, replicate, {" + ".join(f"(u >= {step!r}::DOUBLE)::INTEGER" for step in prep.poisson_steps())} AS w FROM u),
d AS (SELECT replicate, label, pos, x, w FROM v JOIN w USING (vec_id) WHERE NOT held AND w > 0),
widest AS (SELECT replicate, max(s) AS most FROM (SELECT replicate, sum(w * x * x) / sum(w) - (sum(w * x) / sum(w)) ** 2 AS s FROM d GROUP BY replicate, pos) GROUP BY replicate),
m AS (SELECT replicate, label AS class, pos, sum(w) AS n, sum(w * x) / sum(w) AS mean,
  sum(w * x * x) / sum(w) - (sum(w * x) / sum(w)) ** 2 + 1e-9 * any_value(most) AS var FROM d JOIN widest USING (replicate) GROUP BY replicate, label, pos),
total AS (SELECT replicate, sum(n) AS n FROM m WHERE pos = 1 GROUP BY replicate),
s AS (SELECT replicate, vec_id, v.label, class, ln(any_value(m.n) / any_value(total.n)) - 0.5 * sum(ln(2 * pi() * var) + (x - mean) ** 2 / var) AS score
  FROM v JOIN m USING (pos) JOIN total USING (replicate) WHERE held GROUP BY replicate, vec_id, v.label, class),
p AS (SELECT replicate, (label = class)::INTEGER AS hit FROM s QUALIFY row_number() OVER (PARTITION BY replicate, vec_id ORDER BY score DESC, class) = 1),
a AS (SELECT replicate, count(*) AS rows, avg(hit) AS accuracy FROM p GROUP BY replicate)
SELECT replicate::INTEGER AS replicate, rows, round(accuracy, 6) AS accuracy, round(avg(accuracy) OVER (), 6) AS mean, round(stddev_pop(accuracy) OVER (), 6) AS deviation FROM a""",
)
def bootstrap_model(t: Tables) -> DataFrame:
    """Held-out accuracy of ten models, each fitted on its own resample, with their mean and deviation."""
    train, test = split(vectors(t))
    found = cut(resample.gaussian_bootstrap(train, test, "vec_id", "vector", "label", 10))
    mean, deviation = found.agg(r6(F.avg("accuracy")), r6(F.stddev_pop("accuracy"))).first()
    return found.select("replicate", "rows", r6("accuracy").alias("accuracy"), F.lit(mean).alias("mean"), F.lit(deviation).alias("deviation"))


#: When a fit has converged; one that needs as many steps is an error, not a result.
TOLERANCE, MOST_STEPS = 1e-4, 1000


@query("multilabel_eval")
def multilabel_eval(t: Tables) -> DataFrame:
    """One logistic model per label over words and word pairs; predicted and true label names per text."""
    rows = t.documents.select("doc_id", "text").join(t.labels, "doc_id").withColumn("held", hash_unit("doc_id") < HELD)
    rows = cut(rows.withColumn("text", texts.clean_long_text(F.col("text"))))
    train, test = (cut(models.term_vectors(part, "text")) for part in split(rows))
    size = train.count()
    names = ["quality", "toxic"]
    for name in names:
        fitted = models.logistic(size, name, maxIter=MOST_STEPS, tol=TOLERANCE, predictionCol=f"{name}_predicted").fit(train)
        test = models.converged(fitted, MOST_STEPS).transform(test).drop("probability", "rawPrediction")
    listed = lambda suffix: F.filter(
        F.array(*[F.when(F.col(f"{n}{suffix}") == 1, F.lit(n)) for n in names]), lambda x: x.isNotNull()
    )
    return test.select(
        "doc_id", F.array_join(listed(""), ",").alias("true_labels"), F.array_join(listed("_predicted"), ",").alias("predicted_labels")
    )
