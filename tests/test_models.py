"""Models against brute force and closed forms."""

import itertools
import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace import session
from millrace.analysis import linkage, newton, prep, resample, tall, trees


def brute_linkage(points):
    """Average linkage by one merge at a time: merges, and the height at which each two rows meet."""
    clusters = {k: [k] for k in points}
    merges, meet = [], {}
    mean = lambda a, b: round(sum(math.dist(points[x], points[y]) for x in a for y in b) / (len(a) * len(b)), 9)
    while len(clusters) > 1:
        h, a, b = min((mean(clusters[a], clusters[b]), a, b) for a, b in itertools.combinations(sorted(clusters), 2))
        merges.append((h, a, b, len(clusters[a]), len(clusters[b])))
        meet |= {frozenset((x, y)): h for x in clusters[a] for y in clusters[b]}
        clusters[a] += clusters.pop(b)
    return merges, meet


@pytest.mark.parametrize("seed,n", [(1, 40), (2, 25), (3, 2)])
def test_average_linkage_equals_one_merge_at_a_time(spark, seed, n):
    pick = random.Random(seed)
    points = {3 * i + 1: [pick.gauss(8 * (i % 3), 1) for _ in range(3)] for i in range(n)}
    df = spark.createDataFrame(list(points.items()), "id bigint, v array<double>").repartition(3)
    tree = linkage.average_linkage(df, "id", "v")
    merges, meet = brute_linkage(points)
    assert tree.keys == sorted(points)
    assert sorted(m[1:] for m in merges) == sorted((m.first, m.second, m.first_size, m.second_size) for m in tree.merges)
    for wanted, found in zip(sorted(merges), tree.merges):
        assert found.height == pytest.approx(wanted[0], abs=1e-7)
    heights = [meet[p] for p in meet]
    apart = [math.dist(*(points[x] for x in p)) for p in meet]
    mh, ma = sum(heights) / len(heights), sum(apart) / len(apart)
    top = sum((h - mh) * (a - ma) for h, a in zip(heights, apart))
    bottom = math.sqrt(sum((h - mh) ** 2 for h in heights) * sum((a - ma) ** 2 for a in apart))
    found = tree.cophenetic_correlation()
    assert (found is None and bottom == 0) or found == pytest.approx(top / bottom, abs=1e-6)
    if n == 40:
        groups = tree.groups(3)
        assert {tuple(sorted(k for k in points if groups[k] == g)) for g in range(3)} == {
            tuple(sorted(3 * i + 1 for i in range(n) if i % 3 == g)) for g in range(3)
        }


def test_linkage_of_copies_and_of_one_row(spark):
    df = spark.createDataFrame([(i, [0.0, 0.0]) for i in range(7)] + [(9, [3.0, 4.0])], "id bigint, v array<double>")
    tree = linkage.average_linkage(df, "id", "v")
    assert [m.height for m in tree.merges] == [0.0] * 6 + [5.0] and tree.groups(2) == {**dict.fromkeys(range(7), 0), 9: 1}
    assert tree.cophenetic_correlation() == pytest.approx(1.0)
    alone = linkage.average_linkage(df.filter("id = 9"), "id", "v")
    assert alone.keys == [9] and alone.merges == [] and alone.cophenetic_correlation() is None and alone.groups(6) == {9: 0}


@pytest.mark.parametrize("stored,rows_per_block", [(1, 6), (20, 64)])
def test_average_linkage_without_stored_distances(spark, stored, rows_per_block):
    pick = random.Random(7)
    # one group outgrows a block
    points = {3 * i + 1: [pick.gauss(30 * (i % 5 == 0), 1 + i % 5) for _ in range(3)] for i in range(45)}
    df = spark.createDataFrame(list(points.items()), "id bigint, v array<double>").repartition(3)
    tree = linkage.average_linkage(df, "id", "v", stored=stored, rows_per_block=rows_per_block)
    merges, _ = brute_linkage(points)
    assert tree.keys == sorted(points)
    assert sorted(m[1:] for m in merges) == sorted((m.first, m.second, m.first_size, m.second_size) for m in tree.merges)
    for wanted, found in zip(sorted(merges), tree.merges):
        assert found.height == pytest.approx(wanted[0], abs=1e-7)
    apart = [math.dist(points[a], points[b]) ** 2 for a, b in itertools.combinations(points, 2)]
    assert tree.squares == pytest.approx(sum(apart))


def test_average_linkage_stores_no_matrix_of_many_rows(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(linkage, "cut", lambda rows: kept.append(stored := session.cut(rows)) or stored)
    df = spark.range(300).select("id", F.array(F.rand(1), F.rand(2), F.rand(3)).alias("v"))
    tree = linkage.average_linkage(session.cut(df), "id", "v", stored=20, rows_per_block=32)
    assert len(tree.merges) == 299
    matrices = [rows for rows in kept if "d" in rows.columns]
    assert matrices and all(rows.agg(F.max(F.size("d"))).first()[0] <= 20 for rows in matrices)


def test_tall_components_equal_those_of_the_covariances(spark):
    pick = np.random.default_rng(5)
    x = pick.normal(size=(700, 5)) @ pick.normal(size=(5, 5)) + 1e6
    names = [f"c.{i}" for i in range(5)]
    rows = [tuple(map(float, r)) for r in x] + [(None, 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names)).repartition(9)
    found = tall.triangle(df, names, fan_in=2)
    assert found.rows == 700 and found.means == pytest.approx(x.mean(0))
    table, loadings = tall.principal_components(df, names)
    values, vectors = np.linalg.eigh(np.cov(x, rowvar=False))
    assert table["variance"].to_numpy() == pytest.approx(values[::-1], rel=1e-6)
    assert np.abs((loadings * vectors[:, ::-1]).sum(0)) == pytest.approx(np.ones(5), abs=1e-6)
    assert table["running"].iloc[-1] == pytest.approx(1.0)


def test_components_keep_small_variances_and_need_two_rows(spark):
    # a product of columns would lose the second variance beside means of 1e8
    rows = [(1e8 + i, 1e8 + i + (1e-3 if i % 2 else -1e-3)) for i in range(40)]
    df = spark.createDataFrame(rows, "a double, b double").repartition(3)
    table, _ = tall.principal_components(df, ["a", "b"])
    assert table["variance"].iloc[1] == pytest.approx(np.linalg.svd(np.array(rows) - np.mean(rows, 0))[1][1] ** 2 / 39, rel=1e-3)
    with pytest.raises(ValueError):
        tall.principal_components(df.limit(1), ["a", "b"])
    with pytest.raises(ValueError):
        tall.principal_components(df.filter("a < 0"), ["a", "b"])
    flat, _ = tall.principal_components(spark.createDataFrame([(2.0, 3.0)] * 4, "a double, b double"), ["a", "b"])
    assert list(flat["variance"]) == pytest.approx([0, 0], abs=1e-12) and np.isfinite(flat["share"]).all()


def labelled(n, width, seed):
    pick = np.random.default_rng(seed)
    x = pick.normal(size=(n, width)) * (pick.random((n, width)) < 0.6)
    y = (x @ pick.normal(size=width) + pick.logistic(size=n) > 0.3).astype(int)
    return x, y


@pytest.mark.parametrize("whole_matrix", [256, 0])
def test_newton_fit_leaves_no_gradient(spark, whole_matrix):
    x, y = labelled(400, 6, 3)
    rows = [(list(map(float, r)), int(c)) for r, c in zip(x, y)] + [([9.0] * 6, None), ([None] * 6, 1), ([], 0), (None, 1)]
    x, y = np.vstack([x, np.zeros((3, 6))]), np.append(y, [1, 0, 1])
    df = newton.sparse(spark.createDataFrame(rows, "features array<double>, label int").repartition(5))
    found = newton.fit(df, 6, penalty=2.0, whole_matrix=whole_matrix)
    p = 1 / (1 + np.exp(-(x @ found.weights + found.intercept)))
    assert found.rows == 403
    assert np.abs(x.T @ (p - y) + 2.0 * found.weights).max() < 1e-5 and abs((p - y).sum()) < 1e-5


def test_newton_fit_refuses_what_it_cannot_fit(spark):
    x, y = labelled(50, 3, 4)
    rows = [(list(map(float, r)), int(c)) for r, c in zip(x, y)]
    df = newton.sparse(spark.createDataFrame(rows, "features array<double>, label int"))
    with pytest.raises(ValueError, match="no convergence"):
        newton.fit(df, 3, most=1)
    for part in ("label = 1", "label > 1"):
        with pytest.raises(ValueError, match="both labels"):
            newton.fit(df.filter(part), 3)


def test_bootstrapped_models_equal_models_of_repeated_rows(spark):
    pick = np.random.default_rng(8)
    y = pick.integers(0, 3, 160)
    x = pick.normal(size=(160, 4)) + 1000 + y[:, None] * np.array([1.0, 0.5, 0.0, -1.0])
    df = spark.createDataFrame([(i, int(c), list(map(float, r))) for i, (c, r) in enumerate(zip(y, x))], "id bigint, label int, x array<double>")
    train, test = df.filter("id % 4 <> 0").repartition(5), df.filter("id % 4 = 0").repartition(3)
    times = {r["id"]: r["w"] for r in train.select("id", resample.draws("id", 3, "s").alias("w")).collect()}
    ids = sorted(times)
    found = {r["replicate"]: r for r in resample.gaussian_bootstrap(train, test, "id", "x", "label", 3, "s").collect()}
    for replicate in (1, 2, 3):
        drawn = np.repeat(ids, [times[i][replicate - 1] for i in ids])
        assert 60 < len(drawn) < 180
        classes = sorted(set(y[drawn]))
        widest = x[drawn].var(0).max()
        held = np.arange(0, 160, 4)
        scores = []
        for c in classes:
            own = x[drawn][y[drawn] == c]
            variance = own.var(0) + 1e-9 * widest
            scores.append(math.log(len(own) / len(drawn)) - 0.5 * (np.log(2 * np.pi * variance) + (x[held] - own.mean(0)) ** 2 / variance).sum(1))
        hits = np.array(classes)[np.argmax(scores, 0)] == y[held]
        assert found[replicate]["rows"] == 40 and found[replicate]["accuracy"] == pytest.approx(hits.mean())


def test_poisson_draws_have_the_moments_of_poisson(spark):
    steps = prep.poisson_steps()
    assert len(steps) > 12 and all(a < b < 1 for a, b in zip(steps, steps[1:])) and 1 - steps[-1] < 1e-13
    row = spark.range(20000).select(F.explode(resample.draws("id", 5)).alias("w")).agg(F.avg("w"), F.var_pop("w")).first()
    assert row[0] == pytest.approx(1, abs=0.02) and row[1] == pytest.approx(1, abs=0.03)


def brute_tree(x, y, impurity, depth, leaf, path=""):
    """Splits by path, every threshold of every feature tried."""

    def weight(rows):
        shares = [sum(y[i] == c for i in rows) / len(rows) for c in set(y[i] for i in rows)]
        return len(rows) * (1 - sum(p * p for p in shares) if impurity == "gini" else -sum(p * math.log2(p) for p in shares))

    def down(rows, path):
        if len({y[i] for i in rows}) < 2 or (depth is not None and len(path) >= depth):
            return
        best = None
        for f in range(len(x[0])):
            values = sorted({x[i][f] for i in rows})
            for a, b in zip(values, values[1:]):
                left, right = [i for i in rows if x[i][f] <= a], [i for i in rows if x[i][f] > a]
                if min(len(left), len(right)) >= leaf:
                    gain = round((weight(rows) - weight(left) - weight(right)) / len(rows), 9)
                    if best is None or gain > best[0]:
                        best = (gain, f, (a + b) / 2, left, right)
        if best:
            found[path] = best[1:3]
            down(best[3], path + "L")
            down(best[4], path + "R")

    found = {}
    down(list(range(len(y))), path)
    return found


@pytest.mark.parametrize("impurity,depth,leaf", [("entropy", None, 1), ("gini", 3, 1), ("entropy", None, 6)])
@pytest.mark.parametrize("cells", [10**6, 30])
def test_trees_try_every_threshold(spark, impurity, depth, leaf, cells):
    pick = random.Random(leaf)
    # few different values, so that ties and equal rows of different labels occur
    x = [[float(pick.randrange(6)), pick.choice([0.0, 0.5, 1e9]), round(pick.random(), 1)] for _ in range(60)]
    y = [int(r[0] > 3) + int(r[2] > 0.5 and pick.random() < 0.9) for r in x]
    df = spark.createDataFrame([(i, v, c) for i, (v, c) in enumerate(zip(x, y))] + [(99, None, 1), (98, [1.0, 1.0, 1.0], None)], "id bigint, x array<double>, y int")
    found = trees.grow(df.repartition(4), "x", "y", depth=depth, leaf=leaf, impurity=impurity, cells_per_task=cells)
    wanted = brute_tree(x, y, impurity, depth, leaf)
    assert {p: (n.feature, n.threshold) for (_, p), n in found.nodes.items() if n.feature is not None} == wanted
    rows = found.transform(df.filter("y IS NOT NULL"), "x").collect()
    assert [r["prediction"] for r in rows if r["x"] is None] == [None]
    by_x: dict[tuple, list[int]] = {}
    for v, c in zip(x, y):
        by_x.setdefault(tuple(v), []).append(c)
    if depth is None and leaf == 1:
        hits = sum(r["prediction"] == r["y"] for r in rows if r["x"] is not None)
        assert hits == sum(max(c.count(k) for k in c) for c in by_x.values())


def test_forests_are_the_same_in_tasks_and_by_levels(spark):
    pick = random.Random(3)
    rows = [(i, [pick.random() for _ in range(4)], int(pick.random() < 0.5)) for i in range(80)]
    rows = [(i, [v[0] + y, *v[1:]], y) for i, v, y in rows]
    df = spark.createDataFrame(rows, "id bigint, x array<double>, y int")
    own = lambda cells: trees.grow(df, "x", "y", key="id", trees=4, impurity="gini", per_split=1, seed="a", cells_per_task=cells)
    inside, by_levels = own(10**6), own(80)
    assert inside.nodes == by_levels.nodes and len(inside.trees) == 4
    shares = inside.importances()
    assert sum(shares) == pytest.approx(1.0) and shares[0] == max(shares)
    hits = inside.transform(df, "x").filter("prediction = y").count()
    assert hits > 68


def test_a_column_in_a_task_and_running_totals_give_the_same_splits(spark):
    """Two trees' nodes of whole and repeated rows; one node cannot be split."""
    pick = random.Random(4)
    rows = [(t, p, [pick.random(), float(pick.randrange(3)), 1.0], pick.randrange(3), float(pick.randrange(1, 4))) for t in (0, 1) for p in ("L", "RL") for _ in range(40)]
    rows += [(1, "RR", [1.0, 2.0, 3.0], c, 1.0) for c in (0, 1)]
    df = spark.createDataFrame(rows, "tree int, path string, x array<double>, y int, w double").repartition(3)
    for impurity, leaf, per_split in (("gini", 1.0, None), ("entropy", 7.0, None), ("gini", 1.0, 1)):
        s = trees.Settings(3, 3, impurity, None, leaf, per_split, "s")
        found = [sorted(tuple(r) for r in f(df, s).collect()) for f in (trees._column_splits, trees._level_splits)]
        assert found[0] == found[1] and len(found[0]) == 4


def test_a_tree_of_many_nodes_is_grown_by_levels_and_not_node_by_node():
    """Thirty thousand rows without any order, a node for nearly each: the time of a search for each node is out of reach."""
    pick = np.random.default_rng(2)
    x, y = pick.normal(size=(30_000, 4)), pick.integers(0, 4, 30_000)
    began = time.process_time()
    found = trees._grown(0, "", x, y, np.ones(30_000), trees.Settings(4, 4, "gini", None, 1.0, 1, ""))
    assert time.process_time() - began < 6 and len(found) > 30_000
    ends = found[found["feature"].isna()]
    assert sum(c.sum() for c in ends["counts"]) == 30_000 and all(np.count_nonzero(c) == 1 for c in ends["counts"])


def test_the_driver_holds_no_node_that_a_task_has_grown(spark, monkeypatch):
    pick = random.Random(8)
    rows = [(i, [pick.random() for _ in range(3)], pick.randrange(3)) for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, x array<double>, y int")
    whole, parts = trees.grow(df, "x", "y"), trees.grow(df, "x", "y", cells_per_task=300)
    assert whole.top == {} and 0 < len(parts.top) < 40 and len(whole.nodes) > 200 and whole.nodes == parts.nodes
    assert whole.importances() == pytest.approx(parts.importances())
    monkeypatch.setattr(trees, "CELLS_PER_TASK", 100)  # rows meet a subtree in chunks
    for forest in (whole, parts):
        found = forest.transform(df.unionByName(spark.createDataFrame([(900, None, 1)], df.schema)), "x").collect()
        assert len(found) == 301 and all(r["prediction"] == (r["y"] if r["x"] else None) for r in found)


def test_trees_of_one_label_and_of_no_rows(spark):
    df = spark.createDataFrame([(1, [1.0], 7), (2, [2.0], 7)], "id bigint, x array<double>, y int")
    found = trees.grow(df, "x", "y")
    assert [n.feature for n in found.nodes.values()] == [None] and {r["prediction"] for r in found.transform(df, "x").collect()} == {7.0}
    assert found.importances() == [0.0]
    with pytest.raises(ValueError):
        trees.grow(df.filter("id > 5"), "x", "y")
