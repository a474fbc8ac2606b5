"""Operators, preparation, statistics and models on small tables."""

import math
import random
import statistics as st

import pytest
from pyspark.sql import functions as F

from millrace.analysis import classify, hypothesis, models, prep, scores, tall
from millrace.functions import arrays, distributions, text
from millrace.operators import ordering, profile, quantiles, shape
from millrace.operators.joins import join_groups
from millrace.sources import files, sinks


def one(df):
    return df.first()[0]


def numbers(spark, values, name="x"):
    return spark.createDataFrame([(float(v) if v is not None else None,) for v in values], f"{name} double")


@pytest.mark.parametrize("parts", [1, 7])
def test_global_row_number_and_running_total(spark, parts):
    pick = random.Random(2)
    values = [pick.randrange(10_000) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(values)), "id bigint, v bigint").repartition(parts)
    found = ordering.running_total(df, ["v", "id"], {"upto": F.col("v"), "n": F.lit(1)}).collect()
    total = 0
    for place, (v, i) in enumerate(sorted((v, i) for i, v in enumerate(values)), 1):
        total += v
        row = next(r for r in found if r.id == i)
        assert (row.n, row.upto) == (place, total)


def test_hot_key_does_not_break_running_totals(spark):
    df = spark.createDataFrame([("hot", n) for n in range(300)] + [("cold", n) for n in range(5)], "g string, n bigint")
    found = ordering.global_row_number(df, ["n"], ["g"]).collect()
    assert all(r.row_no == r.n + 1 for r in found) and len(found) == 305


@pytest.mark.parametrize("n,folds", [(23, 5), (20, 5), (3, 5)])
def test_contiguous_folds(spark, n, folds):
    found = ordering.contiguous_folds(spark.range(n), ["id"], folds).groupBy("fold").count().orderBy("fold").collect()
    size, longer = divmod(n, folds)
    assert [r["count"] for r in found] == [size + 1] * longer + [size] * (folds - longer if size else 0)


def test_quantiles_interpolate(spark):
    found = quantiles.exact_quantiles(numbers(spark, [1, 2, 4, 9, None]), "x", [0.0, 0.25, 0.5, 1.0]).collect()
    assert {r.prob: r["quantile"] for r in found} == {0.0: 1.0, 0.25: 1.75, 0.5: 3.0, 1.0: 9.0}


def test_quantiles_with_copies_and_one_value(spark):
    assert one(quantiles.exact_quantiles(numbers(spark, [5] * 100 + [6]), "x", [0.5]).select("quantile")) == 5.0
    assert one(quantiles.exact_quantiles(numbers(spark, [7]), "x", [0.25]).select("quantile")) == 7.0


@pytest.mark.parametrize("buckets", [4096, 256])
def test_quantiles_of_hard_values(spark, monkeypatch, buckets):
    monkeypatch.setattr(quantiles, "BUCKETS", buckets)
    pick = random.Random(buckets)
    groups = {
        "copies": [7.0] * 50 + [8.0],
        "spread": [pick.lognormvariate(0, 6) for _ in range(301)],
        "signs": [-1e300, -1.0, -0.0, 0.0, 5e-324, 1.0, 1e300],
        "ends": [-math.inf, 1.0, 2.0, 3.0, math.inf],
        "one": [4.5],
    }
    df = spark.createDataFrame([(g, x) for g, own in groups.items() for x in [*own, None]], "g string, x double").repartition(4)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    found = {(r.g, r.prob): r.quantile for r in quantiles.exact_quantiles(df, "x", probs, ["g"]).collect()}
    assert len(found) == len(groups) * len(probs)
    for (g, p), value in found.items():
        own = sorted(groups[g])
        at = (len(own) - 1) * p
        low, high = own[math.floor(at)], own[math.ceil(at)]
        part = at - math.floor(at)
        wanted = low + (high - low) * part if high != low else low
        assert value == pytest.approx(wanted, rel=1e-9, nan_ok=True), (g, p)


def test_moments_follow_the_sample_forms(spark):
    df = numbers(spark, [1, 2, 4, 9])
    assert one(profile.adjusted_skewness(df, ["x"]).select("skew")) == pytest.approx(1.3307, abs=1e-3)
    assert one(profile.mean_abs_deviation(df, ["x"]).select("mad")) == pytest.approx(2.5)
    assert one(profile.describe(df, ["x"]).select("std")) == pytest.approx(st.stdev([1, 2, 4, 9]))


def test_profile_counts_nulls_and_distinct_values(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a")], "k int, s string")
    found = {r.column_name: r for r in profile.column_profile(df).collect()}
    assert (found["s"].row_count, found["s"].non_null, found["s"].distinct_values) == (3, 2, 1)
    assert profile.identifier_columns(df) == ["k"]
    assert {r.column_name: r.nulls for r in profile.null_counts(df).collect()} == {"k": 0, "s": 1}


def test_null_aware_difference_and_ratio(spark):
    df = spark.createDataFrame([("x", 1.0, 0.0), (None, 0.0, 0.0), ("y", 1.0, 4.0)], "s string, a double, b double")
    assert df.filter(shape.differs(F.col("s"), "x")).count() == 2
    assert [r[0] for r in df.select(shape.safe_ratio(F.col("a"), F.col("b"))).collect()] == [0.0, 0.0, 0.25]


def test_lookup_refuses_two_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k int, v string")
    with pytest.raises(Exception, match="more than one"):
        shape.unique_lookup(df, ["k"], "v").collect()


def test_first_per_key_is_repeatable(spark):
    df = spark.createDataFrame([("a", 3, "z"), ("a", 1, "y"), ("b", 2, "x")], "k string, n int, v string")
    assert sorted(tuple(r) for r in shape.first_per_key(df.repartition(5), ["k"], ["n"]).collect()) == [("a", 1, "y"), ("b", 2, "x")]


def test_array_helpers(spark):
    df = spark.createDataFrame([([3, 1, 3, 2],)], "a array<bigint>")
    a = F.col("a")
    row = df.select(arrays.remove_first(a, F.lit(3)), arrays.remove_first(a, F.lit(9)), arrays.count_of(a, 3), arrays.arg_max(a)).first()
    assert list(row) == [[1, 3, 2], [3, 1, 3, 2], 2, 0]


def test_matrix_product(spark):
    m = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0), (1, 0, 3.0)], "i int, j int, v double")
    found = {(r.i, r.j): r.v for r in arrays.product(m, m).collect()}
    assert found == {(0, 0): 7.0, (0, 1): 2.0, (1, 0): 3.0, (1, 1): 6.0}


# ---- preparation


def test_medians_include_zeros(spark):
    df = numbers(spark, [0, 0, 4, 6, 8])
    assert sorted(r[0] for r in prep.zero_to_median(df, ["x"]).collect()) == [4.0, 4.0, 4.0, 6.0, 8.0]


def test_means_over_all_or_valid_rows(spark):
    df = numbers(spark, [-10, 2, 4])
    assert sorted(r[0] for r in prep.outside_to_mean(df, "x", 0, 9).collect())[0] == pytest.approx(-4 / 3)
    assert sorted(r[0] for r in prep.outside_to_mean(df, "x", 0, 9, True).collect()) == [2.0, 3.0, 4.0]


def test_codes_are_sorted_and_nulls_stay_null(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "s string")
    assert {r.s: r.s_code for r in prep.encode_labels(df, ["s"]).collect()} == {"a": 0, "b": 1, "c": 2, None: None}


def test_constant_column_scales_to_zero(spark):
    df = numbers(spark, [5, 5])
    assert [r[0] for r in prep.standardize(df, prep.standard_scales(df, ["x"])).collect()] == [0.0, 0.0]


def test_bootstrap_is_repeatable_and_centred(spark):
    df = spark.range(400).withColumn("v", F.col("id").cast("double"))
    first = sorted((r.replicate, r.mean) for r in prep.bootstrap(df, "id", "v", 20).collect())
    again = sorted((r.replicate, r.mean) for r in prep.bootstrap(df.repartition(9), "id", "v", 20).collect())
    assert [m for _, m in first] == pytest.approx([m for _, m in again])
    assert st.mean(m for _, m in first) == pytest.approx(199.5, abs=8)


def test_hash_split_ignores_partitioning(spark):
    rows = spark.range(1000)
    halves = [{r.id for r in rows.repartition(p).filter(ordering.hash_unit("id") < 0.25).collect()} for p in (1, 8)]
    assert halves[0] == halves[1] and 200 < len(halves[0]) < 300


# ---- text


def test_cleaning_and_ngrams(spark):
    df = spark.createDataFrame([("Hello, #World_1! the cat  sat",), (None,)], "t string")
    t = F.col("t")
    row, gap = df.select(text.clean_short_text(t), text.clean_long_text(t), text.ngrams(text.drop_words(text.tokens(t)), (1, 2))).collect()
    assert row[0] == "hello #world_1 the cat  sat"
    assert row[1] == "hello world the cat sat"
    assert row[2] == ["hello", "world_1", "cat", "sat", "hello world_1", "world_1 cat", "cat sat"]
    assert gap[1] == ""


def test_word_degrees_sum_phrase_lengths(spark):
    df = spark.createDataFrame([(1, "fast spark jobs and spark, slow jobs")], "doc bigint, t string")
    found = {r.word: r.degree for r in text.word_degrees(df, "doc", "t").collect()}
    assert found == {"fast": 3, "spark": 4, "jobs": 5, "slow": 2}


# ---- sources and sinks


def test_empty_results_are_not_published(spark):
    with pytest.raises(sinks.EmptyResultError):
        sinks.publish_snapshot(spark.range(0), files.scratch(spark, "t"))
    path = files.scratch(spark, "h")
    sinks.append_history(sinks.stamp_run(spark.range(3), 1, {}), path)
    with pytest.raises(sinks.EmptyResultError):
        sinks.append_history(sinks.stamp_run(spark.range(3).filter("id > 5"), 1, {}), path)
    assert spark.read.parquet(path).count() == 3


def test_history_replaces_only_its_own_run(spark):
    path = files.scratch(spark, "history")
    for run, rows in ((1, 3), (2, 4), (1, 2)):
        sinks.append_history(sinks.stamp_run(spark.range(rows), run, {}), path)
    assert {r.run_id: r["count"] for r in spark.read.parquet(path).groupBy("run_id").count().collect()} == {1: 2, 2: 4}


def test_snapshot_shows_the_latest_version(spark):
    root = files.scratch(spark, "snap")
    sinks.publish_snapshot(spark.range(3), root)
    sinks.publish_snapshot(spark.range(5), root)
    assert sinks.read_snapshot(spark, root).count() == 5


# ---- statistics


@pytest.mark.parametrize(
    "value,expected",
    [
        (distributions.t_two_sided(2.0, 10), 0.07338803),
        (distributions.t_critical(10), 2.22813885),
        (distributions.f_tail(4.0, 2, 12), 0.04665600),
        (distributions.chi2_tail(5.99146455, 2), 0.05),
        # three degrees of freedom have a closed form
        (distributions.chi2_tail(0.5, 3), math.erfc(0.5) + math.exp(-0.25) / math.sqrt(math.pi)),
        (distributions.normal_tail(1.95996398), 0.025),
    ],
)
def test_tail_probabilities(value, expected):
    assert value == pytest.approx(expected, abs=1e-6)


def test_paired_and_welch(spark):
    a = spark.createDataFrame([(n, float(v)) for n, v in enumerate([9, 8, 7, 6])], "k int, v double")
    b = spark.createDataFrame([(n, float(v)) for n, v in enumerate([7, 7, 6, 3])], "k int, v double")
    row = hypothesis.with_t_p(hypothesis.t_paired(a, b, ["k"], "v")).first()
    d = [2, 1, 1, 3]
    assert row.t == pytest.approx(st.mean(d) / (st.stdev(d) / 2))
    both = a.withColumn("g", F.lit("a")).unionByName(b.withColumn("g", F.lit("b")))
    welch = hypothesis.t_welch(both, "g", "v", "a", "b").first()
    va, vb = st.variance([9, 8, 7, 6]) / 4, st.variance([7, 7, 6, 3]) / 4
    assert welch.t == pytest.approx((7.5 - 5.75) / math.sqrt(va + vb))


def test_expected_counts_cover_empty_cells(spark):
    df = spark.createDataFrame([("a", "x")] * 3 + [("b", "y")] * 2, "r string, c string")
    found = {(r.r, r.c): (r.observed, r.expected) for r in hypothesis.contingency(df, "r", "c").collect()}
    assert found["a", "y"] == (0, pytest.approx(6 / 5)) and len(found) == 4


# ---- scores and models


def test_scores_with_a_class_that_is_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0), (2, 2)], "label int, predicted int")
    row = scores.classifier_metrics(df).first()
    assert row.accuracy == pytest.approx(0.75)
    assert row.precision == pytest.approx((2 / 3 + 0 + 1) / 3)
    assert sum(r.n for r in scores.confusion_matrix(df, [0, 1, 2]).collect()) == 4


def test_ranking_scores_treat_ties_as_one_step(spark):
    df = spark.createDataFrame([("g", 1, 0.9), ("g", 0, 0.5), ("g", 1, 0.5), ("g", 0, 0.1)], "g string, y int, s double")
    assert one(scores.roc_auc(df, "y", "s", ["g"]).select("auc")) == pytest.approx(0.875)
    assert one(scores.average_precision(df, "y", "s", ["g"]).select("average_precision")) == pytest.approx(0.5 + 0.5 * 2 / 3)


@pytest.mark.parametrize("rows_per_block,rows_per_cell", [(1024, 4096), (7, 4096), (7, 6), (1024, 1)])
def test_nearest_rows_equal_brute_force(spark, rows_per_block, rows_per_cell):
    pick = random.Random(4)
    points = [(n, [float(pick.randrange(4)) for _ in range(3)], n % 3) for n in range(60)]
    points += [(n, [1.0, 1.0, 1.0], 0) for n in range(60, 100)]  # a crowd on one point
    df = spark.createDataFrame(points, "id bigint, v array<double>, label bigint")
    test, train = df.filter("id < 20"), df.filter("id >= 20")
    near = classify.nearest_rows(test, train, 5, "id", "v", "label", rows_per_block, rows_per_cell)
    found = {(r.id, r["rank"]): r.near_key for r in near.collect()}
    for i, v, _ in points[:20]:
        best = sorted((round(math.dist(v, w), 8), j) for j, w, _ in points[20:])[:5]
        assert [found[i, place] for place in range(1, 6)] == [j for _, j in best]
    few = classify.nearest_rows(test, train.limit(3), 5, "id", "v", "label", rows_per_block, rows_per_cell)
    assert few.count() == 60 and classify.nearest_rows(test, train.limit(0), 5, "id", "v", "label").count() == 0
    votes = {(r.k, r.id): r.predicted for r in classify.vote(near, "id", [1, 5]).collect()}
    assert len(votes) == 40


def test_cells_out_of_reach_are_skipped(spark):
    pick = random.Random(9)
    centres = [[pick.uniform(0, 100) for _ in range(4)] for _ in range(12)]
    points = [(n, [c + pick.gauss(0, 1) for c in centres[n % 12]], n % 2) for n in range(600)]
    df = spark.createDataFrame(points, "id bigint, v array<double>, label bigint")
    placed, cells = classify.cells_of(df.filter("id >= 60").withColumn("label", F.lit(0)), 5, "id", "v", 20)
    assert placed.count() == 540 and placed.groupBy("_cell", "_chunk").count().agg(F.max("count")).first()[0] <= 80
    asked = classify.probes(df.filter("id < 60").withColumn("reach", F.lit(4.0)), cells, 5, "v", "reach")
    seen = asked.agg(F.sum(F.size("_cells"))).first()[0]
    assert 60 <= seen < 0.4 * 60 * len(cells.pivot)
    near = classify.nearest_rows(df.filter("id < 60"), df.filter("id >= 60"), 5, "id", "v", "label", 1024, 20)
    found = {(r.id, r["rank"]): r.near_key for r in near.collect()}
    for i, v, _ in points[:60]:
        best = sorted((round(math.dist(v, w), 8), j) for j, w, _ in points[60:])[:5]
        assert [found[i, place] for place in range(1, 6)] == [j for _, j in best]


def test_fitted_models_beat_the_majority(spark):
    pick = random.Random(6)
    rows = [(n, [pick.gauss(n % 2 * 3, 1), pick.gauss(0, 1)], float(n % 2)) for n in range(200)]
    df = models.from_array(spark.createDataFrame(rows, "id bigint, v array<double>, label double"), "v")
    for estimator in (models.logistic(200), models.decision_tree(3), models.random_forest(5), models.perceptron([2, 4, 2])):
        assert models.accuracy(estimator.fit(df), df).first().accuracy > 0.8
    wide = classify.gaussian_model(df.withColumn("label", F.col("label").cast("bigint")), "v", "label")
    hits = df.select((classify.gaussian_predict(F.col("v"), wide) == F.col("label")).cast("double").alias("h"))
    assert one(hits.agg(F.avg("h"))) > 0.85


def test_elbow_falls_and_components_share_all_variance(spark):
    pick = random.Random(7)
    rows = [(n, [pick.gauss(n % 3 * 9, 1), pick.gauss(0, 1)]) for n in range(90)]
    df = models.from_array(spark.createDataFrame(rows, "id bigint, v array<double>"), "v")
    found = {r.k: r.mean_distance for r in models.kmeans_elbow(df, [1, 3]).collect()}
    assert found[3] < found[1] / 3
    table, loadings = tall.principal_components(df.select(F.col("v")[0].alias("a"), F.col("v")[1].alias("b")), ["a", "b"])
    assert table["running"].iloc[-1] == pytest.approx(1.0) and table["share"].iloc[0] > 0.9
    assert abs(loadings[0, 0]) > 0.99


@pytest.mark.parametrize("limit", [10_000, 1])
def test_group_values_join_alike_with_and_without_broadcast(spark, limit):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "g string, n int")
    groups = spark.createDataFrame([("a", 10), ("b", 20)], "g string, v int")
    found = join_groups(rows, groups, ["g"], limit)
    assert sorted(tuple(r) for r in found.collect()) == [("a", 1, 10), ("a", 2, 10), ("b", 3, 20)]


def test_every_sql_text_belongs_to_a_query():
    from millrace.catalog import QUERIES, SQL

    assert set(SQL) <= set(QUERIES) and len(SQL) > 120


@pytest.mark.parametrize("df", [1e6, 1e8, 1e12])
def test_tails_at_very_many_degrees_of_freedom(df):
    # limits with their first corrections: the median of chi-square, symmetric F, and the normal and chi-square limits
    assert distributions.chi2_tail(df, df) == pytest.approx(0.5 - 1 / (3 * math.sqrt(math.pi * df)), abs=1e-10)
    assert distributions.f_tail(1.0, df, df) == pytest.approx(0.5, abs=1e-12)
    assert distributions.t_two_sided(2.0, df) == pytest.approx(math.erfc(math.sqrt(2)), abs=1 / df + 1e-12)
    assert distributions.f_tail(2.0, 4, df) == pytest.approx(5 * math.exp(-4), abs=1 / df + 1e-12)
    assert distributions.t_critical(df) == pytest.approx(1.959963984540054, abs=3 / df + 1e-9)


def test_tails_against_sums():
    for k, x in ((40, 70.0), (2000, 2100.0), (30_000, 29_000.0)):
        exact = math.fsum(math.exp(i * math.log(x / 2) - x / 2 - math.lgamma(i + 1)) for i in range(k // 2))
        assert distributions.chi2_tail(x, k) == pytest.approx(exact, rel=1e-9)
    assert distributions.t_two_sided(-3.0, 1) == pytest.approx(1 - 2 * math.atan(3.0) / math.pi, rel=1e-12)
    assert distributions.t_two_sided(0.0, 5) == distributions.f_tail(0.0, 2, 3) == distributions.chi2_tail(0.0, 2) == 1.0
    assert distributions.chi2_tail(2e4, 2) == pytest.approx(0.0, abs=1e-300)


def test_second_line_header_goes_and_its_repeats_stay(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Report;;\nk;v\n1;x\nk;v\n2;y\n")
    (tmp_path / "b.csv").write_text("Other;;\nk;v\n3;z\n")
    found = files.read_second_line_header(spark, str(tmp_path), "k string, v string", sep=";").collect()
    assert sorted(map(tuple, found)) == [("1", "x"), ("2", "y"), ("3", "z"), ("k", "v")]


def test_chi_square_needs_only_cells_with_rows(spark):
    rows = [("a", "x")] * 5 + [("a", "y")] * 2 + [("b", "x")] + [("c", "z")] * 4 + [(None, "x"), ("a", None)]
    df = spark.createDataFrame(rows, "g string, h string")
    grid = hypothesis.contingency(df, "g", "h").collect()
    found = hypothesis.chi_square(df, "g", "h").first()
    assert found["chi2"] == pytest.approx(sum((r["observed"] - r["expected"]) ** 2 / r["expected"] for r in grid))
    assert found["df"] == 4.0


def test_hot_inner_index_of_a_product_is_salted(spark, monkeypatch):
    a = [(i, k, float(i + k)) for i in range(12) for k in range(3) if (i + k) % 3 or k == 1]
    b = [(k, j, float(k - j)) for k in range(3) for j in range(5)]
    frames = [spark.createDataFrame(m, "i bigint, j bigint, v double") for m in (a, b)]
    wanted = {}
    for i, k, x in a:
        for m, j, y in b:
            if k == m:
                wanted[i, j] = wanted.get((i, j), 0.0) + x * y
    for cells in (10_000, 2):
        monkeypatch.setattr(arrays, "CELLS_PER_SALT", cells)
        assert {(r["i"], r["j"]): r["v"] for r in arrays.product(*frames).collect()} == wanted
