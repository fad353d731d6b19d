"""The tree engine against plain searches, its ways against each other, and models that learn."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowgauge.operators import models, perceptron, trees

NAMES = ["a", "b", "c", "d"]


def frame(spark, x, y):
    rows = [(int(c), *[float(v) for v in r]) for c, r in zip(y, x)]
    df = spark.createDataFrame(rows, "label int, " + ", ".join(f"{n} double" for n in NAMES))
    return df.select(models.assembled_vector(NAMES).alias("features"), F.col("label").cast("double").alias("label"))


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    y = np.arange(600) % 3
    x = rng.normal(size=(600, 4)) + 1.2 * np.eye(4)[y]
    return frame(spark, x, y).cache(), x, y


def test_boosting_is_the_same_in_one_task_by_levels_and_by_finished_nodes(rows):
    df, _, _ = rows
    p = trees.Boosting(rounds=12, depth=4, rate=0.3, rows=0.8, columns=0.75, seed=1)
    whole = trees.boost(df, p)
    by_levels = trees.boost(df, p, chunk=50, local_rows=0)
    finished = trees.boost(df, p, chunk=50, local_rows=10_000)
    mixed = trees.boost(df, p, chunk=50, local_rows=150)
    assert whole.n_trees == 36 and whole.history[0] == pytest.approx(np.log(3))
    for other in (by_levels, finished, mixed):
        assert np.allclose(other.history, whole.history)
        x = np.random.default_rng(0).normal(size=(200, 4))
        assert np.allclose(other.probabilities(x), whole.probabilities(x))


def test_boosting_keeps_its_rows_in_tasks_that_run_together(rows, monkeypatch):
    """A table of many chunks takes no job a level or round, and gives the trees that one task grows."""
    df, _, _ = rows
    p = trees.Boosting(rounds=12, depth=4, rate=0.3, rows=0.8, columns=0.75, seed=1)

    def refuse(*_):
        raise AssertionError("a job for a level")

    monkeypatch.setattr(trees, "spark_level", refuse)
    monkeypatch.setattr(trees, "spark_finish", refuse)
    x = np.random.default_rng(0).normal(size=(200, 4))
    for part in (df, df.coalesce(1)):
        whole, together = trees.boost(part, p), trees.boost(part, p, chunk=50)
        assert np.allclose(together.history, whole.history) and np.allclose(together.probabilities(x), whole.probabilities(x))
        assert together.history[0] == pytest.approx(np.log(3)) and together.n_trees == 36


def test_boosting_falls_back_to_jobs_when_tasks_cannot_hold_the_rows(rows, monkeypatch):
    df, _, _ = rows
    p = trees.Boosting(rounds=10, depth=3, rate=0.3, rows=0.8, columns=0.75, seed=1)
    whole = trees.boost(df, p)
    monkeypatch.setattr(trees, "HELD_BYTES", 1)
    monkeypatch.setattr(trees, "_boosted_together", None)
    assert np.allclose(trees.boost(df, p, chunk=50).history, whole.history)


def test_chunks_are_dealt_evenly_when_all_rows_are_equal(spark):
    """Chunks that a hash of their rows does not tell apart must not meet in one task."""
    df = frame(spark, np.ones((800, 4)), np.arange(800) % 2)
    data = trees.bin_rows(df, chunk=50)
    dealt = trees._dealt(data.table(spark), 4)
    counts = [sum(r.n for r in part) for part in dealt.rdd.glom().collect()]
    assert len(counts) == 4 and sum(counts) == 800 and max(counts) <= 250
    model = trees.boost(df, trees.Boosting(rounds=10, depth=3, rate=0.3, rows=1.0, columns=1.0, seed=1), chunk=50)
    assert (model.feature < 0).all() and np.allclose(model.probabilities(np.ones((1, 4))), 0.5)


def test_every_round_lowers_the_loss(rows):
    df, _, _ = rows
    history = trees.boost(df, trees.Boosting(rounds=40, depth=3, rate=0.1, rows=1.0, columns=1.0, seed=1)).history
    assert all(b < a for a, b in zip(history, history[1:]))


def test_first_boosted_split_is_the_best_there_is(rows):
    """Gradients of round one are known: the best gain over all cuts, by a plain search."""
    df, x, y = rows
    model = trees.boost(df, trees.Boosting(rounds=1, depth=1, rate=0.1, rows=1.0, columns=1.0, seed=1))
    for c in range(3):
        g, h = 1 / 3 - (y == c), np.full(len(y), 2 * (1 / 3) * (2 / 3))

        def score(mask, g=g, h=h):
            return g[mask].sum() ** 2 / (h[mask].sum() + 1)

        everything = np.ones(len(y), bool)
        best = max((score(x[:, f] <= t) + score(x[:, f] > t) - score(everything), f, t)
                   for f in range(4) for t in np.unique(model.threshold[model.feature == f]) if len(model.threshold))
        root = model.roots[c]
        below = x[:, model.feature[root]] <= model.threshold[root]
        assert model.gain[root] == pytest.approx(score(below) + score(~below) - score(everything))
        assert model.gain[root] >= best[0] - 1e-9
        left = model.value[model.left[root], 0]
        assert left == pytest.approx(-0.1 * g[below].sum() / (h[below].sum() + 1))


def gini_tree(bins, label, weight, min_split):
    """Total gain of a greedy tree over all features, by plain recursion."""
    def impurity(rows):
        sums = np.bincount(label[rows], weight[rows], 3)
        return (sums ** 2).sum() / sums.sum()

    def grow(rows):
        if len(rows) < min_split or len(set(label[rows])) < 2:
            return []
        found = [(impurity(rows[m]) + impurity(rows[~m]) - impurity(rows)) for f in range(bins.shape[1]) for b in np.unique(bins[rows, f])[:-1]
                 for m in [bins[rows, f] <= b]]
        return [max(found)] if found else []

    return grow(np.arange(len(label)))


def test_finished_subtree_against_plain_search():
    rng = np.random.default_rng(3)
    for _ in range(40):
        n = int(rng.integers(2, 60))
        bins, label = rng.integers(0, 6, (n, 3)).astype(np.uint8), rng.integers(0, 3, n)
        weight = rng.integers(1, 4, n).astype(float)
        p = trees.Forest(1, None, 2, 0, features=3)
        part = trees.finish(bins, label, weight, 3, p, 0, np.random.default_rng(1))
        want = gini_tree(bins, label, weight, 2)
        assert (part["feature"][0] >= 0) == bool(want)
        if want:
            assert part["gain"][0] == pytest.approx(want[0])
        # Every row ends in a leaf; a leaf of several classes holds rows that no feature tells apart.
        tree = trees.Growing()
        tree.graft(0, part)
        at = tree.walk(bins)
        for leaf in np.unique(at):
            mine = at == leaf
            assert np.allclose(part["value"][leaf], np.bincount(label[mine], weight[mine], 3) / weight[mine].sum())
            assert len(set(label[mine])) == 1 or len(np.unique(bins[mine], axis=0)) == 1


def test_trees_are_grown_whole_without_a_shuffle_of_rows(rows, monkeypatch):
    """A task reads the rows once and grows its trees: the same ones as from rows that were dealt for every tree."""
    df, _, _ = rows
    p = trees.Forest(7, None, 2, 7)
    dealt = trees.grow_forest(df, p, chunk=60, local_rows=10_000)
    monkeypatch.setattr(trees, "_deal", None)
    whole = trees.grow_forest(df, p, chunk=60)
    assert whole.n_trees == 7 and whole.sizes == dealt.sizes
    for name in trees.ARRAYS:
        assert np.array_equal(getattr(whole, name), getattr(dealt, name))


def test_limits_of_a_forest(rows):
    df, _, _ = rows
    free = trees.grow_forest(df, trees.Forest(10, None, 2, 7))
    wide = trees.grow_forest(df, trees.Forest(10, None, 40, 7))
    flat = trees.grow_forest(df, trees.Forest(10, 3, 2, 7))

    def depths(model):
        out = np.zeros(len(model.tree), int)
        for i in np.nonzero(model.feature >= 0)[0]:
            out[[model.left[i], model.right[i]]] = out[i] + 1
        return out

    assert depths(flat).max() == 3 < depths(free).max()
    assert len(wide.tree) < len(free.tree) and (free.value[free.feature < 0].max(1) == 1.0).all()
    assert free.first(4).n_trees == 4 and np.allclose(free.first(10).probabilities(np.zeros((1, 4))), free.probabilities(np.zeros((1, 4))))


def test_large_nodes_are_split_by_aggregates(rows):
    """With every feature tried, both ways find the same trees; with some tried, both learn."""
    df, x, y = rows
    p = trees.Forest(6, None, 2, 7, features=4)
    one = trees.grow_forest(df, p, chunk=1000)
    other = trees.grow_forest(df, p, chunk=60, local_rows=100)
    assert np.allclose(one.probabilities(x), other.probabilities(x), atol=0.35)
    assert np.array_equal(one.threshold[one.roots], other.threshold[other.roots]) and np.array_equal(one.feature[one.roots], other.feature[other.roots])
    some = trees.grow_forest(df.repartition(4), trees.Forest(30, None, 2, 7), chunk=60, local_rows=100)
    assert (some.probabilities(x).argmax(1) == y).mean() > 0.97


def test_bootstrap_and_row_keys():
    rng = np.random.default_rng(2)
    bins = rng.integers(0, 3, (5000, 2)).astype(np.uint8)
    key = trees.row_keys(bins, bins[:, 0] % 2)
    assert len(np.unique(key)) == 5000
    drawn = trees.bootstrap(key, 1, 3)
    assert drawn.mean() == pytest.approx(1, abs=0.06) and drawn.var() == pytest.approx(1, abs=0.1)
    assert np.array_equal(np.sort(trees.row_keys(bins[::-1], (bins[:, 0] % 2)[::-1])), np.sort(key))


def test_reruns_give_one_model(rows):
    df, x, _ = rows
    a = trees.grow_forest(df, trees.Forest(5, None, 2, 3), chunk=70)
    b = trees.grow_forest(df, trees.Forest(5, None, 2, 3), chunk=70)
    assert np.array_equal(a.threshold, b.threshold) and np.allclose(a.probabilities(x), b.probabilities(x))


def test_awkward_rows(spark):
    """One class only, missing values, equal rows of different classes, no rows."""
    one = frame(spark, np.zeros((5, 4)), [2] * 5)
    forest, boosted = trees.grow_forest(one, trees.Forest(3, None, 2, 1)), trees.boost(one, trees.Boosting(3, 2, 0.1, 0.8, 0.8, 1))
    assert forest.probabilities(np.ones((1, 4)))[0].argmax() == 2 == boosted.probabilities(np.ones((1, 4)))[0].argmax()
    x = np.array([[np.nan, 1, 2, 3], [0, np.nan, 2, 3], [5, 5, 5, 5], [5, 5, 5, 5]])
    odd = frame(spark, x, [0, 1, 0, 1])
    got = trees.grow_forest(odd, trees.Forest(40, None, 2, 1)).probabilities(x)
    assert np.isfinite(got).all() and np.allclose(got.sum(1), 1)
    with pytest.raises(ValueError):
        trees.grow_forest(odd.filter("label > 9"), trees.Forest(1, None, 2, 1))


def test_grid_tries_every_setting_on_every_fold(spark, rows):
    df, _, _ = rows
    best, table = models.grid_search(df, {"trees": [4, 8], "depth": [2, None], "min_split": [2, 30]}, folds=3)
    assert table.count() == 8 and best.n_trees in (4, 8)
    folds = models.with_folds(df).groupBy("fold").count().collect()
    assert len(folds) == 3 and all(r["count"] > 150 for r in folds)
    assert len(models.grid_points()) == 12


def test_perceptron_stops_early_on_noise_and_learns(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 4))
    noise = perceptron.train_perceptron(frame(spark, x, rng.integers(0, 3, 500)), passes=60, patience=4)
    assert len(noise.history) < 61
    y = (x[:, 0] > 0).astype(int) + (x[:, 1] > 0)
    x[:, :2] += np.sign(x[:, :2])
    df = frame(spark, x, y)
    model = perceptron.train_perceptron(df)
    scored = models.predictions(model, df).toPandas()
    assert (scored.y == scored.p).mean() > 0.94
    again = perceptron.train_perceptron(df)
    assert np.allclose(again.weights.flat, model.weights.flat)


def test_perceptron_over_several_tasks(spark, rows, monkeypatch):
    df, _, _ = rows
    monkeypatch.setattr(perceptron, "CHUNK", 64)
    model = perceptron.train_perceptron(df.repartition(4), passes=30)
    scored = models.predictions(model, df).toPandas()
    assert (scored.y == scored.p).mean() > 0.7


def test_gradient_of_the_perceptron():
    """The step follows the slope of the loss, by differences."""
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(7, 3)), rng.integers(0, 3, 7)
    w = perceptron.Weights.fresh([3, 5, 3], 0)

    def loss(flat):
        other = perceptron.Weights(w.shapes, flat, w.m, w.v)
        penalty = sum((a ** 2).sum() for a, _ in other.layers()) * perceptron.DECAY / (2 * len(y))
        return -np.log(other.scores(x)[np.arange(7), y]).mean() + penalty

    slope = np.array([(loss(w.flat + d) - loss(w.flat - d)) / 2e-6 for d in np.eye(len(w.flat)) * 1e-6])
    w.train(x, y)
    assert np.allclose(w.m, 0.1 * slope, atol=1e-6)


def test_rows_of_a_level_are_sorted_in_linear_time(monkeypatch):
    """Growing sorts numbers of 8 and 16 bits alone; the order is that of the stable sort by slot and bin."""
    rng = np.random.default_rng(12)
    for n_slots in (1, 7, 300, 70_000):
        slot, bins = rng.integers(0, n_slots, 4000), rng.integers(0, 256, 4000).astype(np.uint8)
        assert np.array_equal(trees._by_slot_and_bin(slot, bins, n_slots), np.argsort(slot * 256 + bins, kind="stable"))
    sizes, sort = [], np.argsort

    def noted(a, *args, **more):
        sizes.append(a.dtype.itemsize)
        return sort(a, *args, **more)

    monkeypatch.setattr(np, "argsort", noted)
    label, bins = rng.integers(0, 3, 3000), rng.integers(0, 256, (3000, 4)).astype(np.uint8)
    part = trees.finish(bins, label, np.ones(3000), 3, trees.Forest(1, None, 2, 1), 0, rng)
    assert max(sizes) <= 2 and part["cover"][0] == 3000
    assert (part["value"].max(1)[part["feature"] < 0] == 1.0).mean() > 0.99


def test_a_round_over_some_hundred_thousand_rows_is_one_job(spark, monkeypatch):
    """Rounds come one after another: what a few tasks can finish is not summed level by level before."""
    def levels(*args, **more):
        raise AssertionError("a level was summed by a job of its own")

    monkeypatch.setattr(trees, "spark_level", levels)
    finished, calls = trees.spark_finish, []
    monkeypatch.setattr(trees, "spark_finish", lambda *args, **more: calls.append(len(args[2])) or finished(*args, **more))
    mixed = [(F.xxhash64("id", F.lit(i)) % 1000 / 1000.0 + F.when(F.col("id") % 3 == i, 1.0).otherwise(0.0)).alias(c) for i, c in enumerate(NAMES)]
    rows = spark.range(300_000).select(*mixed, (F.col("id") % 3).cast("double").alias("label"))
    df = rows.select(models.assembled_vector(NAMES).alias("features"), "label")
    model = trees.boost(df, trees.Boosting(rounds=2, depth=3, rate=0.3, rows=0.8, columns=1.0, seed=1))
    assert calls == [3, 3] and model.history[1] < model.history[0]
