"""Hand-made tables and brute-force checks for the recommender."""

import itertools
import math
import random
from datetime import datetime, timedelta
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.functions import text
from millrace.operators import intervals, pairblocks, stripes
from millrace.plans import collaborative, content, evaluation, lists, ratings
from millrace.sources.run_store import RunStore

START = datetime(2024, 1, 1)


def actions(spark, rows):
    return spark.createDataFrame(rows, "portal string, user_id bigint, item_id bigint, action string")


def rating_table(spark, rows):
    return spark.createDataFrame(rows, "portal string, user_id bigint, item_id bigint, rating double")


def random_ratings(users=23, items=17, share=0.5, portals=("P", "Q"), seed=5):
    pick = random.Random(seed)
    rows = []
    for portal in portals:
        for u in range(users):
            for i in range(items):
                if pick.random() < share:
                    rows.append((portal, u, i, float(pick.randint(1, 5))))
    return rows


def brute_force(rows, k, min_k, accept):
    """Baselines, similarities and predictions in plain Python for one portal."""
    table = {(u, i): r for u, i, r in rows}
    users, items = sorted({u for u, _ in table}), sorted({i for _, i in table})
    mu = sum(table.values()) / len(table)
    bu, bi = dict.fromkeys(users, 0.0), {}
    for _ in range(10):
        for i in items:
            rated = [(u, r) for (u, j), r in table.items() if j == i]
            bi[i] = sum(r - mu - bu[u] for u, r in rated) / (10 + len(rated))
        for u in users:
            rated = [(i, r) for (v, i), r in table.items() if v == u]
            bu[u] = sum(r - mu - bi[i] for i, r in rated) / (15 + len(rated))
    e = {(u, i): r - mu - bu[u] - bi[i] for (u, i), r in table.items()}
    sim = {}
    for u, v in itertools.permutations(users, 2):
        both = [i for i in items if (u, i) in e and (v, i) in e]
        a, b = sum(e[u, i] ** 2 for i in both), sum(e[v, i] ** 2 for i in both)
        n = len(both)
        sim[u, v] = 0.0
        if n > 1 and a * b > 0:
            sim[u, v] = sum(e[u, i] * e[v, i] for i in both) / math.sqrt(a * b) * (n - 1) / (n - 1 + 100)
    mean = {u: sum(r for (v, _), r in table.items() if v == u) / sum(v == u for v, _ in table) for u in users}
    predicted = {}
    for u in users:
        for i in items:
            if (u, i) in table:
                continue
            near = sorted(((round(sim[u, v], 10), -v) for v in users if v != u and (v, i) in table), reverse=True)[:k]
            near = [(s, -v) for s, v in near if s > 0]
            if len(near) < accept:
                continue
            value = mean[u]
            if len(near) >= min_k:
                value += sum(s * (table[v, i] - mean[v]) for s, v in near) / sum(s for s, _ in near)
            predicted[u, i] = (min(max(value, 1), 5), len(near))
    return sim, predicted


def test_action_names_follow_the_rule_order(spark):
    raw = ["DOWNLOADCAMPAIGN", "DOWNLOAD_7", "VIDEO_GETDEFAULTEMBEDCODE", "ENTERPRODUCT", "CLOSEASSETPREVIEW", "OTHER", None]
    found = ratings.normalize_actions(actions(spark, [("P", 1, n, a) for n, a in enumerate(raw)]))
    named = {r.item_id: r.action for r in found.collect()}
    assert named == {0: "ACTIVATECAMPAIGN", 1: "PULL", 2: "PULL", 3: "ENTERCAMPAIGNOVERVIEW", 5: "OTHER"}


def test_rows_without_portal_are_dropped(spark):
    assert ratings.normalize_actions(actions(spark, [(None, 1, 1, "PULL")])).count() == 0


def test_weights_count_unlisted_actions_in_the_total(spark):
    rows = [("P", 1, 1, "PULL"), ("P", 1, 2, "PULL"), ("P", 2, 1, "OTHER"), ("P", 2, 2, "OTHER")]
    weights = {r.action: r.weight for r in ratings.action_weights(ratings.count_actions(actions(spark, rows))).collect()}
    assert weights == {"PULL": 2.0, "OTHER": 0.0}


def test_equal_scores_rate_at_the_bottom(spark):
    rows = [("P", u, i, "PULL") for u in range(3) for i in range(2)]
    assert {r.rating for r in ratings.rate(actions(spark, rows)).collect()} == {1.0}


def test_ratings_span_the_scale_and_do_not_depend_on_partitions(spark):
    names = ["PULL", "SETUPASSETS", "OTHER", "CAMPAIGNSTATUS", "ENTERPRODUCT"]
    pick = random.Random(1)
    rows = [("P", pick.randrange(9), pick.randrange(7), pick.choice(names)) for _ in range(200)]
    results = []
    for parts in (1, 4, 64):
        found = ratings.rate(actions(spark, rows).repartition(parts))
        results.append(sorted((r.user_id, r.item_id, r.rating) for r in found.collect()))
    assert results[0] == results[1] == results[2]
    values = [r for *_, r in results[0]]
    assert min(values) == 1.0 and max(values) == 5.0


@pytest.mark.parametrize("users,support", [(500, 5), (501, 10), (1000, 10), (1001, 20)])
def test_trending_support_grows_with_the_portal(spark, users, support):
    rows = [("P", u, 0, 3.0) for u in range(users)]
    rows += [("P", u, 1, 5.0) for u in range(support)] + [("P", u, 2, 5.0) for u in range(support - 1)]
    found = lists.trending(rating_table(spark, rows)).collect()
    assert [r.item_id for r in sorted(found, key=lambda r: r.rank)] == [1, 0]


def test_ties_go_to_the_smaller_item(spark):
    found = lists.own_past_top(rating_table(spark, [("P", 1, i, 4.0) for i in (9, 3, 7)]), n=2).collect()
    assert [(r.item_id, r.rank) for r in sorted(found, key=lambda r: r.rank)] == [(3, 1), (7, 2)]


@pytest.mark.parametrize("rows_per_stripe,dense_gain,share", [(2048, 50, 0.5), (6, 50, 0.5), (6, 0, 0.5), (4, 50, 0.15)])
def test_neighbours_and_predictions_equal_brute_force(spark, monkeypatch, rows_per_stripe, dense_gain, share):
    monkeypatch.setattr(pairblocks, "DENSE_GAIN", dense_gain)  # 0 takes the sparse way everywhere
    rows = random_ratings(share=share)
    marked = collaborative.residuals(rating_table(spark, rows))
    near = collaborative.nearest_users(marked, k=5, rows_per_stripe=rows_per_stripe).collect()
    cells = collaborative.knn_predict(marked, k=5, min_k=3, rows_per_stripe=rows_per_stripe)
    guessed = cells.collect()
    listed = collaborative.recommend(marked, n=6, k=5, min_k=3, rows_per_stripe=rows_per_stripe).collect()
    slow = collaborative.cf_top(marked, cells, n=6).collect()
    assert {(r.portal, r.user_id, r.rank, r.item_id, round(r.rating, 9)) for r in listed} == {
        (r.portal, r.user_id, r.rank, r.item_id, round(r.rating, 9)) for r in slow
    }
    first = {}
    for r in sorted(guessed, key=lambda r: -r.item_id):
        first[r.portal, r.user_id] = r.neighbours
    by_rank = sorted(near, key=lambda r: r["rank"])
    wanted = {u: [r.neighbour_id for r in by_rank if (r.portal, r.user_id) == u][:n] for u, n in first.items()}
    found = collaborative.top_neighbours(marked, k=5, rows_per_stripe=rows_per_stripe).collect()
    assert {(r.portal, r.user_id): r.neighbours for r in found} == wanted
    for portal in ("P", "Q"):
        sim, predicted = brute_force([r[1:] for r in rows if r[0] == portal], 5, 3, 2)
        mine = {(r.user_id, r.rank): (r.neighbour_id, r.similarity) for r in near if r.portal == portal}
        for u in {u for u, _ in sim}:
            best = sorted(((-round(s, 10), v) for (a, v), s in sim.items() if a == u and round(s, 10) > 0))[:5]
            for place, (s, v) in enumerate(best, 1):
                other, value = mine[u, place]
                assert other == v and value == pytest.approx(-s, abs=1e-8)
        mine = {(r.user_id, r.item_id): (r.rating, r.neighbours) for r in guessed if r.portal == portal}
        assert set(mine) == set(predicted)
        for cell, (value, n) in predicted.items():
            assert mine[cell][1] == n and mine[cell][0] == pytest.approx(value, abs=1e-7)


def test_a_row_is_sent_once_per_stripe_and_once_as_its_own(spark):
    rows = [("p", u, i) for u in range(50) for i in range(4)] + [("q", 1, 1)]
    cells = spark.createDataFrame(rows, "portal string, user_id bigint, item_id bigint")
    counts = stripes.stripe_counts(cells, ("portal",), "user_id", F.lit(0), rows_per_stripe=10)
    g = {r.portal: r["_stripes"] for r in counts.collect()}
    assert 4 <= g["p"] <= 6 and g["q"] == 1
    sent = stripes.placed(cells, counts, ("portal",), "user_id")
    copies = sent.groupBy("portal", "user_id", "item_id").agg(F.count("*").alias("n"), F.count_if("_own").alias("own")).collect()
    assert all(r.n == g[r.portal] + 1 and r.own == 1 for r in copies) and len(copies) == len(rows)
    # the number of stripes follows what has to be remembered
    more = stripes.stripe_counts(cells, ("portal",), "user_id", F.lit(100), budget=10)
    assert {r.portal: r["_stripes"] for r in more.collect()} == {"p": 10, "q": 1}


@pytest.mark.parametrize("asked", [None, "wanted"])
def test_every_stripe_is_filled_in_one_wave(spark, asked):
    rows = [(g, u, i, (u + i) % 3 == 0) for g, users in (("p", 40), ("q", 7), ("r", 1)) for u in range(users) for i in range(3)]
    cells = spark.createDataFrame(rows, "portal string, user_id bigint, item_id bigint, wanted boolean")
    counts = stripes.stripe_counts(cells, ("portal",), "user_id", F.lit(0), rows_per_stripe=6)
    whole = sorted(map(tuple, stripes.placed(cells, counts, ("portal",), "user_id", asked).collect()))
    parts = [list(map(tuple, stripes.placed(cells, counts, ("portal",), "user_id", asked, wave=w, waves=3).collect())) for w in range(3)]
    assert sorted(sum(parts, [])) == whole and all(parts)
    owners = [{(r[0], r[4]) for r in part} for part in parts]
    assert sum(map(len, owners)) == len(set.union(*owners))


def test_stripes_that_take_turns_leave_no_shuffle_files(spark, monkeypatch):
    """The same recommendations in one wave and in many, which remove what they have sent."""
    rated = rating_table(spark, random_ratings(users=120))
    marked = collaborative.residuals(rated)
    manager = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def files() -> dict[str, int]:
        paths = [Path(p) for p in manager.getAllFiles().mkString("|").split("|")]
        return {p.name: p.stat().st_size for p in paths if p.name.startswith("shuffle_") and p.exists()}

    def sent(limit: int) -> tuple[list, int]:
        monkeypatch.setattr(stripes, "SENT", limit)
        before = files()
        found = collaborative.recommend(marked, n=5, rows_per_stripe=10)
        rows = sorted(map(tuple, found.collect()))
        return rows, sum(size for name, size in files().items() if name not in before)

    whole, left = sent(10**9)
    monkeypatch.setattr(stripes, "lean_cut", lambda df, stored=stripes.lean_cut: waves.append(df) or stored(df))
    waves: list = []
    turns, rest = sent(200_000)
    assert turns == whole and len(waves) > 4
    assert rest < left / 4


def test_only_stripes_with_asked_rows_get_cells(spark):
    rows = [("p", u, u == 3) for u in range(40)] + [("q", u, False) for u in range(40)]
    cells = spark.createDataFrame(rows, "portal string, user_id long, wanted boolean")
    counts = stripes.stripe_counts(cells, ("portal",), "user_id", F.lit(0), rows_per_stripe=8)
    sent = stripes.placed(cells, counts, ("portal",), "user_id", "wanted").collect()
    assert len(sent) == 41 and [r.user_id for r in sent if r["_own"]] == [3] and len({r["_stripe"] for r in sent}) == 1


@pytest.mark.parametrize("rows_per_block,entries_per_block", [(3, 500), (100, 7), (1, 1)])
def test_blocks_pass_by_whole_and_in_order(spark, rows_per_block, entries_per_block):
    rows = [(g, u, c) for g in ("a", "b") for u in range(37) for c in range(1 + u % 5)]
    cells = spark.createDataFrame(rows, "g string, row bigint, c int")

    class Seen:
        def start(self, own):
            self.own, self.blocks = sorted(own["row"].unique()), []

        def step(self, block):
            self.blocks.append(block["row"].tolist())

        def finish(self):
            return pd.DataFrame({"own": [self.own], "blocks": [self.blocks]})

    counts = stripes.stripe_counts(cells, ["g"], "row", F.lit(0), rows_per_stripe=10)
    found = stripes.for_each_stripe(
        cells, ["g"], "row", Seen, "own array<bigint>, blocks array<array<bigint>>", counts, None, rows_per_block, entries_per_block
    ).collect()
    for g in ("a", "b"):
        mine = [r for r in found if r.g == g]
        assert sorted(u for r in mine for u in r.own) == list(range(37)) and len(mine) > 1
        for r in mine:
            assert [u for b in r.blocks for u in b] == [u for h, u, _ in rows if h == g]
            assert all(len(set(b)) <= rows_per_block for b in r.blocks)
            assert not any(set(a) & set(b) for a, b in zip(r.blocks, r.blocks[1:]))


def neighbourhoods(cells, k, shrinkage=100.0, rows_per_block=64, own=None):
    """A stripe over long-form cells in one process, without Spark."""
    task = collaborative.Neighbourhoods(k, shrinkage)
    users = np.unique(cells["user_id"])
    task.start(cells[cells["user_id"].isin(users[:own])].reset_index(drop=True))
    for at in range(0, len(users), rows_per_block):
        task.step(cells[cells["user_id"].isin(users[at : at + rows_per_block])].reset_index(drop=True))
    return task


@pytest.mark.parametrize("table,gathered", [(10**6, 10**6), (0, 50)])
def test_raters_who_cannot_enter_a_list_are_not_looked_at(monkeypatch, table, gathered):
    monkeypatch.setattr(collaborative, "TABLE", table)
    monkeypatch.setattr(collaborative, "GATHERED", gathered)
    pick = np.random.default_rng(3)
    users, items = np.nonzero(pick.random((800, 30)) < 0.5)
    rating = pick.integers(1, 6, len(users)).astype(float)
    cells = pd.DataFrame({"user_id": users * 2, "item_id": items + 5, "rating": rating, "residual": rating - 3, "centred": rating - 2.5})
    offered, offer = [], stripes.Best.offer
    monkeypatch.setattr(stripes.Best, "offer", lambda self, lines, *more: offered.append(len(lines)) or offer(self, lines, *more))
    task = neighbourhoods(cells, 5, own=40)
    # about 400 raters for each open cell
    assert len(task.cell_user) > 500 and sum(offered) < 60 * len(task.cell_user)
    table = {(u, i): (r, c) for u, i, r, c in zip(cells["user_id"], cells["item_id"], cells["residual"], cells["centred"])}
    dense, seen = np.zeros((800, 30)), np.zeros((800, 30))
    dense[users, items], seen[users, items] = cells["residual"], 1
    common = seen[:40] @ seen.T
    scale = np.sqrt(((dense[:40] ** 2) @ seen.T) * (seen[:40] @ (dense**2).T))
    similarity = np.where((common > 1) & (scale > 0), dense[:40] @ dense.T / np.where(scale > 0, scale, 1) * (common - 1) / (common + 99), 0)
    similarity[np.arange(40), np.arange(40)] = 0
    similarity = np.round(similarity, 10)
    for cell in range(0, len(task.cell_user), 7):
        u, item = task.cell_user[cell], task.items[task.cell_item[cell]] - 5
        raters = np.flatnonzero(seen[:, item])
        best = sorted((-similarity[u, v], v) for v in raters if similarity[u, v] > 0)[:5]
        mine = sorted(zip(task.raters.scores[cell], task.raters.more[0][cell]))
        wanted = sorted((-s, table[v * 2, item + 5][1]) for s, v in best)
        assert [m[0] for m in mine] == pytest.approx([w[0] for w in wanted], abs=1e-9)
        assert sorted(m[1] for m in mine) == sorted(w[1] for w in wanted)


@pytest.mark.parametrize("share,rare", [(0.5, 0), (0.08, 0), (0.4, 6)])
def test_raters_remembered_for_each_user_give_the_same_predictions(monkeypatch, share, rare):
    """Raters are looked at for each user and not for each open cell; rare items, later items and equal raters included."""
    pick = np.random.default_rng(11)
    chance = np.where(np.arange(40) < rare, 0.01, share)
    users, items = np.nonzero(pick.random((700, 40)) < chance)
    rating = pick.integers(1, 4, len(users)).astype(float)
    cells = pd.DataFrame({"user_id": users * 3, "item_id": items + 7, "rating": rating, "residual": rating - 1.8, "centred": rating - 2.1})
    cells = pd.concat([cells, cells.assign(user_id=cells["user_id"] + 1)]).sort_values(["user_id", "item_id"], ignore_index=True)
    # an item that only a user who passes late has rated, and one that no open cell asks for
    cells = pd.concat([cells, cells.tail(1).assign(item_id=99)], ignore_index=True)
    offered, offer = [], stripes.Best.offer
    monkeypatch.setattr(stripes.Best, "offer", lambda self, lines, *more: offered.append(len(lines)) or offer(self, lines, *more))

    def found(shared, accept):
        offered.clear()
        monkeypatch.setattr(collaborative, "SHARED_CELLS", 1000 if shared else 10**9)
        task = neighbourhoods(cells, 6, own=60)
        return task.predicted(3, accept, (1.0, 5.0)).sort_values(["user_id", "item_id"], ignore_index=True)

    for accept in (0, 1, 2):
        one_by_one = found(False, accept)
        assert sum(offered)
        pd.testing.assert_frame_equal(found(True, accept), one_by_one, rtol=1e-12)
        assert not sum(offered)


def test_large_groups_get_a_stripe_for_each_core_at_most(spark):
    cells = spark.range(12_000).selectExpr("'p' AS portal", "id AS user_id", "id AS item_id")
    width = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "100")
        counts = stripes.stripe_counts(cells, ("portal",), "user_id", F.lit(0), rows_per_stripe=2048)
        assert counts.first()["_stripes"] <= max(8, spark.sparkContext.defaultParallelism)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)


def test_best_keeps_the_earlier_of_equal_partners():
    pick = random.Random(4)
    best, seen = stripes.Best(4), [[] for _ in range(9)]
    best.grow(9)
    partner = 0
    for _ in range(12):
        width = pick.randint(1, 6)
        lines = np.array(sorted(pick.sample(range(9), 5)))
        scores = np.array([[pick.choice([0, 0, 1, 2, 3, 3, 5]) for _ in range(width)] for _ in lines], float)
        ids = np.broadcast_to(np.arange(partner, partner + width, dtype=float), scores.shape)
        best.meet(lines, scores, [ids])
        for line, row in zip(lines, scores):
            seen[line] += [(-s, partner + n) for n, s in enumerate(row) if s > 0]
        partner += width
    for line, offered in enumerate(seen):
        kept = sorted((-s, int(i)) for s, i in zip(best.scores[line], best.more[0][line]) if s > 0)
        assert kept == sorted(offered)[:4]


def test_groups_swept_in_a_task_equal_those_swept_by_joins(spark):
    rated = rating_table(spark, random_ratings())
    inside = collaborative.residuals(rated)
    outside = collaborative.residuals(rated, cells_per_task=200)  # one portal is larger, or both
    values = lambda df: {(r.portal, r.user_id, r.item_id): (r.rating, r.residual, r.centred) for r in df.collect()}
    one, other = values(inside), values(outside)
    assert one.keys() == other.keys() and all(one[c] == pytest.approx(other[c], abs=1e-9) for c in one)


def test_wanted_cells_equal_brute_force(spark):
    rows = random_ratings(portals=("P",))
    _, predicted = brute_force([r[1:] for r in rows], 5, 1, 1)
    rated = {(u, i) for _, u, i, _ in rows}
    wanted = [("P", u, i) for u in range(0, 23, 3) for i in range(17) if (u, i) not in rated]
    asked = spark.createDataFrame(wanted, "portal string, user_id bigint, item_id bigint")
    found = collaborative.predict_cells(rating_table(spark, rows), asked, k=5, min_k=1, rows_per_stripe=6)
    mine = {(r.user_id, r.item_id): (r.estimate, r.neighbours) for r in found.collect()}
    assert len(mine) == len(wanted)
    for _, u, i in wanted:
        if (u, i) in predicted:
            assert mine[u, i] == (pytest.approx(predicted[u, i][0], abs=1e-7), predicted[u, i][1])
        else:
            assert mine[u, i][1] == 0


def test_cells_by_joins_equal_those_by_stripes(spark):
    rows = random_ratings(users=40, items=60, share=0.12)
    marked = collaborative.residuals(rating_table(spark, rows))
    rated = {r[:3] for r in rows}
    wanted = [(p, u, i) for p in "PQ" for u in range(0, 44, 2) for i in range(63)]
    asked = spark.createDataFrame(wanted + wanted[:5], "portal string, user_id bigint, item_id bigint")
    values = lambda df: {(r.portal, r.user_id, r.item_id): (r.rating, r.neighbours) for r in df.collect()}
    slow = values(collaborative.knn_predict(marked, k=3, min_k=2, accept=1, targets=asked))
    fast = values(collaborative.predict_by_pairs(marked, asked, k=3, min_k=2, accept=1))
    assert slow.keys() == fast.keys() and len(fast) > 100 and not rated & fast.keys()
    assert all(fast[c] == (pytest.approx(slow[c][0], abs=1e-9), slow[c][1]) for c in slow)
    # few raters of an item and small stripes: joins; one item for all: stripes
    assert collaborative._sparse(marked, ("portal",), 2)
    one = collaborative.residuals(rating_table(spark, [("P", u, 1, 1.0 + u % 5) for u in range(50)]))
    assert not collaborative._sparse(one, ("portal",), 2048)


def test_one_user_has_no_neighbours(spark):
    marked = collaborative.residuals(rating_table(spark, [("P", 1, i, float(i)) for i in range(1, 4)]))
    assert collaborative.nearest_users(marked).count() == 0
    assert collaborative.knn_predict(marked).count() == 0


def test_asked_cells_fall_back_to_means(spark):
    train = rating_table(spark, [("P", 1, 1, 4.0), ("P", 1, 2, 2.0), ("P", 2, 3, 5.0)])
    asked = spark.createDataFrame([("P", 1, 3), ("P", 9, 1), ("P", 1, 8)], "portal string, user_id bigint, item_id bigint")
    found = {(r.user_id, r.item_id): r.estimate for r in collaborative.predict_cells(train, asked).collect()}
    assert found[1, 3] == pytest.approx(3.0)
    assert found[9, 1] == found[1, 8] == pytest.approx(11 / 3)


def ranked(spark, rows):
    return spark.createDataFrame(rows, "portal string, user_id bigint, item_id bigint, rating double, rank int")


def test_hybrid_fills_in_order_without_repeats(spark):
    past = ranked(spark, [("P", 1, i, 5.0, n) for n, i in enumerate([10, 11, 12, 13], 1)])
    cf = ranked(spark, [("P", 1, 11, 5.0, 1), ("P", 1, 20, 4.0, 2), ("P", 1, 21, 1.0, 3), ("P", 1, 13, 3.0, 4)])
    trend = ranked(spark, [("P", 0, i, 4.0, n) for n, i in enumerate([20, 10, 30, 21, 31], 1)]).drop("user_id")
    found = sorted(lists.hybrid(past, cf, trend, n=7).collect(), key=lambda r: r.sort_order)
    assert [(r.item_id, r.model_type) for r in found] == [
        (10, "PAST"), (11, "PAST"), (12, "PAST"), (20, "COLREC"), (13, "COLREC"), (30, "TREND"), (21, "TREND"),
    ]
    assert [r.sort_order for r in found] == list(range(1, 8))


def test_rated_items_stay_in_the_collaborative_list(spark):
    observed = rating_table(spark, [("P", 1, 1, 5.0), ("P", 1, 2, 2.0)])
    predicted = rating_table(spark, [("P", 1, 3, 4.0)])
    found = collaborative.cf_top(observed, predicted, n=2).collect()
    assert sorted((r.rank, r.item_id) for r in found) == [(1, 1), (2, 3)]


def brute_content(bags, n):
    words = {i: set(b.lower().split()) for i, b in bags}
    found = set()
    for i in words:
        scored = sorted(
            (-round(len(words[i] & words[j]) / math.sqrt(len(words[i]) * len(words[j])), 10), j)
            for j in words if j != i and words[i] & words[j]
        )
        found |= {(i, j, place) for place, (_, j) in enumerate(scored[:n], 1)}
    return found


@pytest.mark.parametrize("rows_per_stripe", [2048, 5])
def test_similar_items_equal_brute_force_with_twins(spark, rows_per_stripe):
    pick = random.Random(3)
    vocabulary = ["RED", "BLUE", "WIDGET", "GEAR", "SMALL", "LARGE", "STEEL", "WOOD"]
    bags = [(i, " ".join(pick.sample(vocabulary, pick.choice([2, 3])))) for i in range(40)]
    bags += [(i, "RED WIDGET STEEL") for i in range(40, 70)]  # a crowd of twins
    found = content.content_similar(spark.createDataFrame(bags, "item_id bigint, bag_of_words string"), 4, rows_per_stripe=rows_per_stripe)
    assert {(r.item_id, r.recommended_item_id, r.rank) for r in found.collect()} == brute_content(bags, 4)


def test_short_lists_are_filled_with_the_smallest_ids(spark):
    bags = [(i, b) for i, b in enumerate(["RED CAR", "RED BUS", "BLUE SKY", "GREEN LEAF", "", "RED CAR"], 1)]
    items = spark.createDataFrame(bags, "item_id bigint, bag_of_words string")
    found = {}
    for r in sorted(content.content_similar(items, 4, fill=True).collect(), key=lambda r: r["rank"]):
        found.setdefault(r.item_id, []).append((r.recommended_item_id, round(r.score, 6)))
    assert found == {
        1: [(6, 1.0), (2, 0.5), (3, 0.0), (4, 0.0)],
        2: [(1, 0.5), (6, 0.5), (3, 0.0), (4, 0.0)],
        3: [(1, 0.0), (2, 0.0), (4, 0.0), (5, 0.0)],
        4: [(1, 0.0), (2, 0.0), (3, 0.0), (5, 0.0)],
        5: [(1, 0.0), (2, 0.0), (3, 0.0), (4, 0.0)],
        6: [(1, 1.0), (2, 0.5), (3, 0.0), (4, 0.0)],
    }


@pytest.mark.parametrize("spread,share", [(300, 0.35), (12, 1.0)])
def test_bounds_leave_most_pairs_unscored(spread, share):
    """Rows of rare and frequent terms of unequal weights; the lists equal those of all products."""
    pick = random.Random(spread)
    vectors = {}
    for row in range(160):
        cells = {t: pick.random() for t in [*pick.sample(range(spread), 5), *pick.sample(range(1000, 1004), 3)]}
        if row % 3 == 0 and row:
            cells = dict(vectors[row - 1])
            cells[pick.randrange(spread)] = 0.5
        norm = math.sqrt(sum(w * w for w in cells.values()))
        vectors[row] = {t: w / norm for t, w in cells.items()}
    cells = pd.DataFrame([(r, t, w) for r, v in vectors.items() for t, w in v.items()], columns=["row", "_column", "w"])
    work = content.CosineStripe("row", "w", 4, 10, own_rows=37)
    work.start(cells[cells["row"] % 2 == 0])
    for start in range(0, 160, 9):
        work.step(cells[(cells["row"] >= start) & (cells["row"] < start + 9)])
    found = {(r.row, r.rank): (r.other_id, r.score) for r in work.finish().itertuples()}
    met = 0
    for row in range(0, 160, 2):
        scored = []
        for other in range(160):
            dot = sum(w * vectors[other].get(t, 0.0) for t, w in vectors[row].items())
            if other != row and dot:
                scored.append((-round(dot, 10), other))
        met += len(scored)
        for place, (score, other) in enumerate(sorted(scored)[:4], 1):
            assert found[row, place] == (other, pytest.approx(-score, abs=1e-9))
    assert work.scored <= share * met


@pytest.mark.parametrize("rows_per_stripe,often", [(3, 0.3), (2048, 2.0)])
def test_text_vectors_lie_in_packed_blocks_that_are_compared_where_they_lie(spark, monkeypatch, rows_per_stripe, often):
    """Texts of repeated and null ids, in blocks of three and in one, with and without dense terms; brute force by n-grams."""
    monkeypatch.setattr(content, "DENSE", often)
    pick = random.Random(8)
    words = [f"w{i}" for i in range(14)]
    texts = [(i % 26, " ".join(pick.choices(words, k=pick.randint(1, 9)))) for i in range(28)]
    texts += [(26, texts[3][1]), (27, texts[3][1]), (28, "alone again"), (29, None), (30, ""), (None, "w1 w2 w3")]
    counts = {}
    for doc, body in texts:
        own = (body or "").split()
        for n in (1, 2, 3):
            for i in range(len(own) - n + 1):
                terms = counts.setdefault(doc, {})
                terms[tuple(own[i : i + n])] = terms.get(tuple(own[i : i + n]), 0) + 1
    df = {}
    for terms in counts.values():
        for t in terms:
            df[t] = df.get(t, 0) + 1
    vectors = {}
    for doc, terms in counts.items():
        w = {t: n * (math.log((1 + len(counts)) / (1 + df[t])) + 1) for t, n in terms.items()}
        norm = math.sqrt(sum(v * v for v in w.values()))
        vectors[doc] = {t: v / norm for t, v in w.items()}
    expected = {}
    for a in vectors.keys() - {None}:
        scored = []
        for b in vectors.keys() - {a, None}:
            score = round(sum(v * vectors[b].get(t, 0.0) for t, v in vectors[a].items()), 8)
            if score > 0:
                scored.append((-score, b))
        expected |= {(a, rank): (b, pytest.approx(-score, abs=2e-8)) for rank, (score, b) in enumerate(sorted(scored)[:4], 1)}
    table = spark.createDataFrame(texts, "doc bigint, body string")
    found = content.tf_idf_similar(table, "doc", "body", 4, stop=("the",), rows_per_stripe=rows_per_stripe)
    assert {(r.doc, r.rank): (r.other_id, r.score) for r in found.collect()} == expected
    pieces = text.term_counts(table, "doc", "body", (1, 2, 3), ("the",), min(rows_per_stripe, 2048)).pieces
    # a record for each block and bucket instead of one for each term of each text
    assert pieces.count() < len(texts)


# ---- evaluation


def runs_table(spark, rows):
    return spark.createDataFrame(
        [(n, START + timedelta(days=day), status) for n, day, status in rows], "run_id bigint, start_time timestamp_ntz, status string"
    )


def test_a_failed_run_closes_the_window_before_it(spark):
    found = evaluation.run_windows(runs_table(spark, [(1, 0, "Completed"), (2, 3, "Failed"), (3, 7, "Completed")]))
    spans = {r.run_id: r.next_start_time for r in found.collect()}
    assert spans == {1: START + timedelta(days=3), 3: None}


def test_the_last_run_must_be_open(spark):
    with pytest.raises(evaluation.OpenRunError):
        evaluation.run_windows(runs_table(spark, [(1, 0, "Completed"), (2, 3, "Failed")]))


def test_windows_open_after_the_start_and_include_the_next_start(spark):
    windows = evaluation.run_windows(runs_table(spark, [(1, 1, "Completed"), (2, 3, "Completed")]))
    stamps = [START + timedelta(days=d) for d in (1, 2, 3, 4)]
    activity = spark.createDataFrame([(n, s) for n, s in enumerate(stamps)], "user_id bigint, ts timestamp_ntz")
    assert sorted(r.user_id for r in evaluation.activity_in_runs(activity, windows).collect()) == [1, 2]


def test_precision_divides_by_k_and_counts_items_once(spark):
    relevant = spark.createDataFrame([(1, 1, i) for i in (1, 2, 2, 9)], "run_id bigint, user_id bigint, item_id bigint")
    served = spark.createDataFrame(
        [(1, 1, 1, 1), (1, 1, 1, 2), (1, 1, 5, 3), (1, 1, 2, 7)], "run_id bigint, user_id bigint, item_id bigint, rank int"
    )
    row = evaluation.ranking_metrics(relevant, served, ["run_id", "user_id"]).first()
    assert (row.precision_5, row.recall_5) == (pytest.approx(1 / 5), pytest.approx(1 / 3))
    assert (row.precision_10, row.recall_10) == (pytest.approx(2 / 10), pytest.approx(2 / 3))


def test_served_lists_by_kind_of_user(spark):
    users = spark.createDataFrame(
        [(1, 1, "A", 1, 0), (1, 2, "A", 1, 1), (1, 3, "A", 0, 0), (1, 4, "B", 0, 1)],
        "run_id bigint, user_id bigint, portal string, is_test_user int, is_new_user int",
    )
    hybrid = spark.createDataFrame(
        [(1, "B", 1, 50, 1), (1, "A", 1, 60, 1), (1, "A", 3, 70, 1)], "run_id bigint, portal string, user_id bigint, item_id bigint, sort_order int"
    )
    trend = spark.createDataFrame([(1, "A", 80, 1), (1, "B", 81, 1)], "run_id bigint, portal string, item_id bigint, rank int")
    found = evaluation.served_lists(users, hybrid, trend, [5, 6], "A").collect()
    shown = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        shown.setdefault(r.user_id, []).append(r.item_id)
    assert shown == {1: [60, 50], 2: [80], 3: [5, 6]}


def test_overall_averages_group_means(spark):
    rows = [("A", 1, 0, 0.2), ("A", 1, 0, 0.4), ("B", 1, 0, 0.9)]
    df = spark.createDataFrame(rows, "portal string, is_test_user int, is_new_user int, m double")
    wide = df.withColumns({m: F.col("m") for m in evaluation.METRICS} | {a: F.lit(2) for a in evaluation.REPORTED_ACTIONS})
    found = {r.measure: r.test_users for r in evaluation.overall(wide, "portal").collect()}
    assert found["precision_5"] == pytest.approx((0.3 + 0.9) / 2)
    assert found["PULL"] == 6


def test_salted_keys_give_the_same_baselines_and_leave_no_table(spark, monkeypatch):
    rated = rating_table(spark, random_ratings())
    before = {t.name for t in spark.catalog.listTables()}
    plain = [sorted(map(tuple, part.collect())) for part in collaborative.baselines(rated)]
    monkeypatch.setattr(collaborative, "CELLS_PER_SALT", 3)
    salted = [sorted(map(tuple, part.collect())) for part in collaborative.baselines(rated)]
    for one, other in zip(plain, salted):
        assert [r[:2] for r in one] == [r[:2] for r in other]
        assert all(a[2:] == pytest.approx(b[2:], abs=1e-9) for a, b in zip(one, other))
    assert {t.name for t in spark.catalog.listTables()} == before


def test_histories_hold_what_came_before_each_run(spark):
    days = ["2024-01-01 10:00", "2024-01-03 00:00", "2024-01-03 09:00", "2024-01-05 12:00", "2024-01-08 01:00"]
    rows = [(1, "p", 7, "A", d) for d in days] + [(2, "p", 8, "B", days[0])] * 3
    actions = spark.createDataFrame(rows, "user_id long, portal string, item_id long, action string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    starts = {1: "2024-01-03 00:00", 2: "2024-01-05 12:00", 3: "2024-01-05 12:00", 4: "2024-01-06 00:00", 5: "2023-01-01 00:00", 6: "2024-01-09 00:00"}
    windows = spark.createDataFrame([(k, v, None if k == 6 else "2024-02-01") for k, v in starts.items()], "run_id long, start_time string, next_start_time string")
    windows = windows.withColumns({c: F.col(c).cast("timestamp") for c in ("start_time", "next_start_time")})
    found = {(r.run_id, r.user_id, r.item_id): r.n for r in evaluation.history_counts(actions, windows).collect()}
    brute = {}
    for run, start in starts.items():
        for user, _, item, _, at in rows:
            if run != 6 and at < start:
                brute[run, user, item] = brute.get((run, user, item), 0) + 1
    assert found == brute


# ---- interval join and run store


@pytest.mark.parametrize("left_closed,right_closed", [(False, True), (True, False), (True, True), (False, False)])
@pytest.mark.parametrize("ranges", [1, 4, 30])
def test_intervals_equal_brute_force(spark, left_closed, right_closed, ranges):
    pick = random.Random(ranges)
    at = lambda h: START + timedelta(hours=h)
    events = [(n, at(pick.choice([50, 50, 50, pick.randrange(100)])), None if n % 7 else n) for n in range(200)] + [(200, None, 1)]
    spans = [(k, at(s), at(s + pick.choice([0, 1, 5, 60]))) for k, s in enumerate(pick.choices(range(100), k=25))]
    spans += [(30, at(50), at(50)), (31, at(60), at(40)), (32, None, at(40)), (33, at(3), None), (5, *spans[5][1:]), (34, at(-5), at(500))]
    e = spark.createDataFrame(events, "id int, ts timestamp_ntz, v bigint").repartition(5)
    s = spark.createDataFrame(spans, "run_id bigint, a timestamp_ntz, b timestamp_ntz")
    found = intervals.interval_join(e, s, "ts", "a", "b", "run_id", left_closed, right_closed, ranges)
    assert found.columns == ["id", "ts", "v", "run_id"]
    wanted = sorted(
        (i, k)
        for i, t, _ in events
        for k, a, b in spans
        if None not in (t, a, b) and a <= b and (a < t < b or (a == t and left_closed and (t < b or right_closed)) or (t == b and right_closed and (a < t or left_closed)))
    )
    rows = found.collect()
    assert sorted((r.id, r.run_id) for r in rows) == wanted
    values = {i: (t, v) for i, t, v in events}
    assert all((r.ts, r.v) == values[r.id] for r in rows)


def test_a_hot_time_is_spread_and_empty_sides_join_nothing(spark):
    rows = [(n, START) for n in range(400)] + [(n, START + timedelta(days=n)) for n in range(400, 440)]
    events = spark.createDataFrame(rows, "id int, ts timestamp_ntz")
    spans = spark.createDataFrame([(1, START, START + timedelta(days=1))], "run_id bigint, a timestamp_ntz, b timestamp_ntz")
    borders = intervals.range_borders(events, "ts", 8)
    assert borders.count(START) >= 6
    found = intervals.interval_join(events, spans, "ts", "a", "b", "run_id", True, True, 8).withColumn("task", F.spark_partition_id())
    per_task = [r["count"] for r in found.groupBy("task").count().collect()]
    assert sum(per_task) == 400 and len(per_task) >= 3
    assert intervals.interval_join(events.limit(0), spans, "ts", "a", "b", "run_id").count() == 0
    assert intervals.interval_join(events, spans.limit(0), "ts", "a", "b", "run_id").count() == 0


def test_a_run_is_stored_once_and_only_missing_ones_are_made(spark, tmp_path):
    store = RunStore(spark, f"{tmp_path}/store", {"lists": "item_id bigint, rank int"})
    asked = []

    def make(missing):
        asked.append(missing)
        return {"lists": spark.createDataFrame([(r, 10 * r + k, k) for r in missing for k in range(3)], "run_id bigint, item_id bigint, rank int")}

    assert store.read("lists").count() == 0
    assert store.fill([1, 2], make) == [1, 2] and store.fill([2, 1], make) == [] and store.fill([1, 2, 3], make) == [3]
    assert asked == [[1, 2], [3]]
    # a second writer of run 2 comes too late; its rows are never read
    late = store.write({"lists": spark.createDataFrame([(2, 99, 0)], "run_id bigint, item_id bigint, rank int")})
    assert not store.commit(2, late) and store.commit(4, late)
    rows = {(r.run_id, r.item_id) for r in store.read("lists").collect()}
    assert rows == {(r, 10 * r + k) for r in (1, 2, 3) for k in range(3)}
    one = store.read("lists", spark.createDataFrame([(3,)], "run_id bigint").filter("run_id > 2"))
    assert {r.run_id for r in one.collect()} == {3} and set(one.columns) == {"item_id", "rank", "run_id"}
    assert "dynamicpruning" in one._jdf.queryExecution().toString().lower()


def test_stored_lists_are_those_of_the_runs(spark, tmp_path):
    pick = random.Random(2)
    rows = [("P", pick.randrange(8), pick.randrange(9), pick.choice(ratings.WEIGHTED_ACTIONS), START + timedelta(hours=pick.randrange(400))) for _ in range(300)]
    known = spark.createDataFrame(rows, "portal string, user_id bigint, item_id bigint, action string, ts timestamp_ntz")
    windows = evaluation.run_windows(runs_table(spark, [(1, 5, "Completed"), (2, 9, "Failed"), (3, 12, "Completed"), (4, 15, "Completed")]))
    store = RunStore(spark, f"{tmp_path}/store", evaluation.LIST_SCHEMAS)
    found = [sorted(map(tuple, df.select(sorted(df.columns)).collect())) for df in evaluation.stored_lists(known, windows, store)]
    direct = evaluation.run_lists(evaluation.history_counts(known, windows))
    assert found == [sorted(map(tuple, df.select(sorted(df.columns)).collect())) for df in direct] and found[0]
    assert set(store.committed()) == {1, 3}
    again = evaluation.stored_lists(known.limit(0), windows, store)[0]
    assert sorted(map(tuple, again.select(sorted(again.columns)).collect())) == found[0]


def test_users_pass_a_stripe_in_growing_pieces(monkeypatch):
    """Lists are taken up for pieces as large as all users before them, not for every few hundred; results stay the same."""
    rng = np.random.default_rng(5)
    cells = [(u, i) for u in range(5000) for i in rng.choice(12, 5, replace=False)]
    rows = pd.DataFrame(cells, columns=["user_id", "item_id"])
    rows["rating"] = rng.integers(1, 6, len(rows)).astype(float)
    rows["residual"] = rows["rating"] - 3 + rng.normal(0, 0.01, len(rows))
    rows["centred"] = rows["rating"] - 3
    pieces, meet = [], collaborative.Neighbourhoods._meet_raters

    def counted(self, block, others, similarity):
        pieces.append(len(others))
        meet(self, block, others, similarity)

    monkeypatch.setattr(collaborative.Neighbourhoods, "_meet_raters", counted)

    def found(size):
        pieces.clear()
        task = collaborative.Neighbourhoods(4, 100.0)
        task.start(rows[rows["user_id"] % 100 == 0].reset_index(drop=True))
        for at in range(0, 5000, size):
            task.step(rows[(rows["user_id"] >= at) & (rows["user_id"] < at + size)])
        return task.predicted(1, 1, (1.0, 5.0)).sort_values(["user_id", "item_id"], ignore_index=True)

    pd.testing.assert_frame_equal(found(5000), found(100))
    found(5000)
    assert pieces == [512, 512, 1024, 2048, 904]


def test_stripes_are_dealt_into_more_pieces_than_the_session_has(spark):
    """A core that is done with its stripes finds others waiting."""
    cells = spark.createDataFrame([(0, u, i, float(u + i)) for u in range(20) for i in range(3)], "g int, user_id bigint, item_id bigint, residual double")
    near = collaborative.nearest_users(cells, ["g"], 3, rows_per_stripe=2)
    assert near.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))
