import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowgauge.operators import alerts, explain, isolation, models, neighbours, oversampling, scaling
from flowgauge.plans import detection, training
from flowgauge.schemas import FEATURES, LABEL

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def small(spark):
    rng = np.random.default_rng(3)
    y = np.arange(240) % 3
    x = rng.normal(size=(240, 3)) + 1.5 * np.eye(3)[y]
    rows = [(int(i), int(c), *[float(v) for v in r]) for i, (c, r) in enumerate(zip(y, x))]
    return spark.createDataFrame(rows, "id long, label int, a double, b double, c double").cache()


@pytest.fixture(scope="module")
def forest(small):
    return models.train_forest(models.assembled(small, NAMES), trees=3, depth=3)


@pytest.fixture(scope="module")
def boosted(small):
    return models.train_boosted(models.assembled(small, NAMES), rounds=2, depth=2)


def expected(nodes, x, known):
    """Tree value when only ``known`` features are used and the rest follows the cover."""
    def value(i):
        left, right, feature, threshold, leaf, cover = nodes[i]
        if left < 0:
            return leaf
        if feature in known:
            return value(left if x[feature] <= threshold else right)
        return (cover_of(left) * value(left) + cover_of(right) * value(right)) / cover_of(i)

    def cover_of(i):
        return nodes[i][5]

    return value(0)


def brute_force(trees, x):
    d = len(x)
    phi = np.zeros(d)
    for i in range(d):
        others = [j for j in range(d) if j != i]
        for k in range(d):
            for s in itertools.combinations(others, k):
                w = math.factorial(k) * math.factorial(d - k - 1) / math.factorial(d)
                phi[i] += w * sum(expected(t, x, {*s, i}) - expected(t, x, set(s)) for t in trees)
    return phi


def plain_trees(model, k):
    """Nodes of every tree as tuples, valued for class ``k``."""
    out, roots = [], [*model.roots.tolist(), len(model.tree)]
    for t, (a, b) in enumerate(zip(roots, roots[1:])):
        def worth(i):
            if model.kind == "forest":
                return model.value[i, k] / model.n_trees
            return model.value[i, 0] if model.output[t] == k else 0.0
        out.append({i - a: (model.left[i] - a if model.left[i] >= 0 else -1, model.right[i] - a, model.feature[i], model.threshold[i],
                            worth(i), model.cover[i]) for i in range(a, b)})
    return out


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_contributions_equal_brute_force(small, forest, boosted, kind):
    model = {"forest": forest, "boosted": boosted}[kind]
    leaves = explain.leaves_of(model, 0, model.n_trees)
    x = np.array([[r.a, r.b, r.c] for r in small.limit(8).collect()])
    for k in model.classes:
        got = explain.contributions(x, leaves, np.full(len(x), k))
        assert np.allclose(got, [brute_force(plain_trees(model, k), row) for row in x])


def test_contributions_in_blocks_add_up(spark, small, forest):
    """Blocks of any size give what one block gives, and contributions add up to the probability less its mean."""
    rows = small.limit(30).select(F.array("a", "b", "c").alias("z"), F.lit(1).alias("predicted"))
    whole = explain.explain(rows, forest, n=3, names=NAMES).collect()
    cut = explain.explain(rows, forest, n=3, names=NAMES, block_nodes=5).collect()
    assert [r.shap_contributions for r in whole] == [r.shap_contributions for r in cut]
    assert len(explain.tree_blocks(forest, 5)) == 3
    x = np.array([r.z for r in whole])
    rest = forest.probabilities(x)[:, 1] - [sum(c.value for c in r.shap_contributions) for r in whole]
    assert np.ptp(rest) < 3e-4


def test_long_paths_are_exact():
    """Twenty features on one path: the quadrature against the sum over subset sizes."""
    rng = np.random.default_rng(6)
    d = 20
    share = rng.uniform(0.05, 0.95, d)
    leaf = explain.Leaves(np.arange(d)[None], np.full((1, d), 0.0), np.full((1, d), np.inf), share[None], np.ones((1, 1)))
    x = rng.normal(size=(4, d))
    for row, got in zip(x, explain.contributions(x, [leaf], np.zeros(4, int))):
        met = row > 0
        for i in range(d):
            sums = np.array([1.0])
            for j in range(d):
                if j != i:
                    sums = np.append(sums * share[j], 0) + np.append(0, sums * met[j])
            weights = [math.factorial(k) * math.factorial(d - k - 1) / math.factorial(d) for k in range(d)]
            assert got[i] == pytest.approx((met[i] - share[i]) * (sums @ weights), abs=1e-12)


def test_explanations_use_all_tasks(spark, small, forest):
    """Rows of one partition, as a small file gives them, are dealt over the tasks; each gets what it got in one."""
    rows = small.limit(40).coalesce(1).select(F.array("a", "b", "c").alias("z"), F.lit(1).alias("predicted"))
    spread = explain.explain(rows, forest, n=3, names=NAMES)
    assert spread.select("z").rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    x = np.array([r.z for r in rows.collect()])
    phi = explain.contributions(x, explain.leaves_of(forest, 0, forest.n_trees), np.ones(len(x), int))
    want = {tuple(r): {name: round(float(v), 4) for name, v in zip(NAMES, line)} for r, line in zip(x, phi)}
    got = {tuple(r.z): {c.feature: c.value for c in r.shap_contributions} for r in spread.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-4) for k in want)


def test_explanations_take_no_more_tasks_than_run_at_once(spark, small, forest):
    """Every task reads the whole ensemble: a large number of shuffle partitions must not multiply that."""
    lanes = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    try:
        rows = small.limit(10).select(F.array("a", "b", "c").alias("z"), F.lit(1).alias("predicted"))
        assert explain.explain(rows, forest, n=3, names=NAMES).select("z").rdd.getNumPartitions() <= 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", lanes)


def test_sums_of_four_bytes_show_what_exact_ones_do(forest):
    """The largest features and their rounded values agree; a row that lies near to a next rounding is done in full."""
    block = explain.Block(explain.leaves_of(forest, 0, forest.n_trees))
    x = np.random.default_rng(12).normal(scale=3.0, size=(explain.EXACT_ROWS * 4, 3))
    asked = np.arange(len(x)) % forest.n_classes
    error, exact = explain.margin_of_error(forest), explain.contributions(x, block, asked)
    got = explain._shown_contributions(x, [block], asked, 2, error)
    assert np.abs(got - exact).max() < error and (got != exact).any()
    for a, b in zip(got, exact):
        first, second = (np.argsort(-np.abs(v), kind="stable")[:2] for v in (a, b))
        assert first.tolist() == second.tolist() and [round(float(a[i]), 4) for i in first] == [round(float(b[i]), 4) for i in second]
    edge = np.array([[0.30005, 0.1, 0.0], [0.30001, 0.1, 0.0], [0.30001, 0.300005, 0.0]])
    assert explain.unsure(edge, 2, 1e-5).tolist() == [True, False, True]


def test_leaves_that_add_nothing_to_a_class_are_left_out():
    """Work goes to the leaves of the asked class alone: poisoned leaves of another class do not reach the result."""
    rng = np.random.default_rng(9)
    n, d = 6, 3
    value = np.zeros((n, 2))
    value[::2, 0], value[1::2, 1] = 0.5, 0.25
    share = rng.uniform(0.2, 0.8, (n, d))
    share[1::2] = np.nan
    leaves = explain.Leaves(np.tile(np.arange(d), (n, 1)), np.full((n, d), -np.inf), rng.normal(size=(n, d)), share, value)
    assert np.isfinite(explain.contributions(rng.normal(size=(5, d)), [leaves], np.zeros(5, int))).all()


def test_explained_rows(spark, small, forest):
    rows = small.limit(20).select(F.array("a", "b", "c").alias("z"), F.lit(1).alias("predicted"))
    odd = spark.createDataFrame([([float("nan"), 1.0, 2.0], 1), ([0.0, 0.0, 0.0], 99)], "z array<double>, predicted int")
    found = explain.explain(rows.unionByName(odd), forest, n=2, names=NAMES).collect()
    assert sum(not r.shap_contributions for r in found) == 2
    for r in found:
        sizes = [abs(c.value) for c in r.shap_contributions]
        assert len(sizes) <= 2 and sizes == sorted(sizes, reverse=True)


def test_probabilities_and_reload(spark, small, forest, boosted, tmp_path):
    rows = models.assembled(small, NAMES)
    for model in (forest, boosted):
        path = models.save_model(model, str(tmp_path), spark)
        first = models.predictions(model, rows).collect()
        again = models.predictions(models.load_model(spark, path), rows).collect()
        assert all(abs(sum(r.scores) - 1) < 1e-9 for r in first)
        assert [r.p for r in first] == [r.p for r in again]
        assert np.mean([r.y == r.p for r in first]) > 0.5
    assert models.load_best_model(spark, str(tmp_path)).kind == "boosted"
    with pytest.raises(FileNotFoundError):
        models.load_best_model(spark, str(tmp_path / "none"))


def test_importance(spark, small, forest, boosted):
    for model in (forest, boosted):
        rows = models.feature_importance(model, spark, NAMES).collect()
        assert [r.importance for r in rows] == sorted((r.importance for r in rows), reverse=True)
        assert sum(r.importance for r in rows) == pytest.approx(1.0)
    with pytest.raises(AttributeError):
        models.feature_importance(object(), spark)


def test_pca(small):
    x = np.array([[r.a, r.b, r.c] for r in small.collect()])
    z = (x - x.mean(0)) / x.std(0)
    _, s, _ = np.linalg.svd(z, full_matrices=False)
    _, shares = models.pca2(small, NAMES)
    assert np.allclose(shares, (s ** 2 / (s ** 2).sum())[:2])


@pytest.fixture(scope="module")
def benign(spark):
    rng = np.random.default_rng(0)
    rows = [(int(i), *[float(v) for v in r]) for i, r in enumerate(rng.normal(size=(200, 20)))]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"x{i} double" for i in range(20))).cache()


COLUMNS = [f"x{i}" for i in range(20)]


def test_isolation(spark, benign, tmp_path):
    model = isolation.fit_isolation(benign, COLUMNS, ["id"], trees=60)
    scored = isolation.score_isolation(benign, model, COLUMNS)
    assert scored.filter("is_anomaly").count() == 10
    assert scored.filter("is_anomaly <> (anomaly_score < 0)").count() == 0
    far = benign.limit(10).select("id", *[(F.lit(20.0) + F.col(c) * 0.1).alias(c) for c in COLUMNS])
    assert isolation.score_isolation(far, model, COLUMNS).filter("is_anomaly").count() == 10
    again = isolation.fit_isolation(benign.repartition(7), COLUMNS, ["id"], trees=60)
    assert again.offset == pytest.approx(model.offset)
    model.save(spark, str(tmp_path / "iso"))
    loaded = isolation.IsolationModel.load(spark, str(tmp_path / "iso"))
    assert loaded.offset == model.offset and len(loaded.nodes) == len(model.nodes)
    with pytest.raises(RuntimeError):
        isolation.score_isolation(benign, None, COLUMNS)


def test_isolation_score_by_walking(benign):
    model = isolation.fit_isolation(benign, COLUMNS, ["id"], trees=5)
    x = np.array([list(r)[1:] for r in benign.limit(6).collect()])
    got = isolation.raw_scores(x, isolation._packed(model.nodes), model.sample)
    for row, score in zip(x, got):
        depths = []
        for _, tree in model.nodes.groupby("tree"):
            nodes = {r.node: r for r in tree.itertuples()}
            at = nodes[0]
            while at.feature >= 0:
                at = nodes[at.left if row[at.feature] <= at.threshold else at.right]
            depths.append(at.path)
        assert score == pytest.approx(-2 ** (-np.mean(depths) / float(isolation.average_path(model.sample))))


def test_isolation_draws_for_many_rows(spark):
    rows = spark.range(30_000).select(F.struct("id").alias("id"), F.array(F.rand(1), F.rand(2)).alias("x"))
    per_tree = {r.tree: r["count"] for r in isolation._drawn(rows, 30_000, 20, 64, 1).groupBy("tree").count().collect()}
    assert len(per_tree) == 20 and set(per_tree.values()) == {64}


@pytest.mark.parametrize("cell", [5000, 25])
def test_neighbours_equal_brute_force(spark, cell):
    rng = np.random.default_rng(1)
    x, c = np.unique(np.round(rng.normal(size=(300, 3)), 2), axis=0), None
    c = np.arange(len(x)) % 2
    points = spark.createDataFrame([(int(a), [float(v) for v in b], 1) for a, b in zip(c, x)], "c int, x array<double>, m long")
    for r in neighbours.nearest_points(points, 4, cell_points=cell).collect():
        d = ((x[c == r.c] - np.array(r.x)) ** 2).sum(1)
        assert np.allclose(np.sort(d[d > 0])[:4], [n.d2 for n in r.near])


def test_oversampling(spark):
    rows = [(i, 0, float(i), 0.0) for i in range(40)] + [(100 + i, 1, float(i), 5.0) for i in range(6)]
    rows += [(200 + i, 2, 1.0, 9.0) for i in range(10)] + [(300 + i, 3, float(i), 7.0) for i in range(2)]
    df = spark.createDataFrame(rows, "id long, label int, x double, y double")
    found = oversampling.smote(df, "label", ["x", "y"], ["id"], cell_points=3)
    counts = {(r.label, r.synthetic): r["count"] for r in found.groupBy("label", "synthetic").count().collect()}
    assert counts == {(0, False): 40, (1, False): 6, (1, True): 34, (2, False): 10, (2, True): 30, (3, False): 2}
    new = found.filter("synthetic").collect()
    assert all(r.y == {1: 5.0, 2: 9.0}[r.label] for r in new)
    # Three nearest neighbours on a line of unit steps are at most three steps away.
    assert all(0 <= r.x <= 5 for r in new if r.label == 1) and {r.x for r in new if r.label == 2} == {1.0}
    assert sorted(found.collect()) == sorted(oversampling.smote(df.repartition(3), "label", ["x", "y"], ["id"], cell_points=3).collect())
    assert oversampling.smote(df, "label", ["x", "y"], ["id"], strict=True).filter("synthetic").count() == 0
    aimed = oversampling.smote(df, "label", ["x", "y"], ["id"], target=20)
    assert aimed.filter("label = 1").count() == 20 and aimed.filter("label = 0").count() == 40


def scored(spark, rows):
    return spark.createDataFrame(
        [(p, c, a, "1.1.1.1", "2.2.2.2", 1, 2, 6) for p, c, a in rows],
        "predicted int, confidence double, anomaly_score double, src_ip string, dst_ip string, src_port int, dst_port int, protocol int",
    ).withColumn("last_ts", F.current_timestamp())


@pytest.mark.parametrize("row, want", [
    ((4, 0.6, None), None), ((4, 0.7, None), ("DDoS", "MEDIUM")), ((4, 0.8999999, None), ("DDoS", "MEDIUM")), ((4, 0.9, None), ("DDoS", "HIGH")),
    ((0, 0.95, None), None), ((0, 0.95, 0.0), None), ((0, 0.95, -0.01), ("Unknown / Anomaly", "LOW")), ((9, 0.95, None), ("CLS_9", "HIGH")),
])
def test_alert_rules(spark, row, want):
    found = alerts.to_alerts(scored(spark, [row])).collect()
    assert [(r.attack_type, r.severity) for r in found] == ([want] if want else [])


def test_quarantine(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 1.0), (float("inf"), 1.0), (1.0, float("nan"))], "a double, b double")
    good, bad = alerts.quarantine(df, ["a", "b"])
    assert (good.count(), bad.count()) == (1, 3)


@pytest.fixture(scope="module")
def flow_rows(spark):
    rng = np.random.default_rng(5)
    names = ["Normal Traffic", "DDoS", "DoS", "Odd"]
    rows = []
    for i in range(400):
        k = [0, 0, 0, 1, 1, 2][i % 6] if i % 50 else 3
        rows.append((i, names[k], *[float(v) for v in rng.normal(size=20) + 3 * k]))
    return spark.createDataFrame(rows, "id long, " + f"`{LABEL}` string, " + ", ".join(f"`{f}` double" for f in FEATURES)).cache()


def test_training_and_detection(spark, flow_rows, tmp_path):
    run = training.train(flow_rows, ["id"], kind="forest", chronological=False, benign_rows=100, folder=str(tmp_path),
                         model_params={"trees": 8, "depth": 4})
    assert run.metrics.first().accuracy > 0.9
    flows = flow_rows.select("id", *[F.col(f"`{f}`") for f in FEATURES]).withColumns({
        "last_ts": F.timestamp_seconds(F.col("id") + 1_700_000_000), "src_ip": F.lit("1.1.1.1"), "dst_ip": F.lit("2.2.2.2"),
        "src_port": F.lit(1), "dst_port": F.lit(2), "protocol": F.lit(6),
    })
    model = models.load_best_model(spark, str(tmp_path))
    scaler = scaling.Scaler.load(spark, str(tmp_path / "scaler"))
    anomaly = isolation.IsolationModel.load(spark, str(tmp_path / "anomaly"))
    raised, faulty = detection.detect(flows, model, scaler, anomaly)
    rows = raised.collect()
    assert faulty.count() == 0 and len(rows) > 100
    assert all(1 <= len(r.shap_contributions) <= 5 for r in rows)
    short, _ = detection.detect(flows, model, scaler, explained=False)
    assert all(len(r.top_features) == 3 for r in short.collect())


def test_grid_and_primary(small):
    rows = models.assembled(small, NAMES)
    best, table = models.grid_search(rows, {"trees": [2], "depth": [1, 3]}, folds=2)
    assert table.count() == 2 and best.n_trees == 2
    assert models.train_primary(rows, "forest", trees=2, depth=2)[0] == "forest"
    with pytest.raises(ValueError):
        models.train_primary(rows, "other")


@pytest.mark.parametrize("n", [300, 25_000])
def test_every_tree_draws_a_whole_sample_of_all_rows(spark, n):
    rows = spark.range(n).select(F.struct("id").alias("id"), F.array(F.col("id").cast("double")).alias("x"))
    drawn = isolation._drawn(rows, n, 200, 256, 42).select("tree", F.col("x")[0].alias("v")).toPandas()
    assert drawn.groupby("tree").size().tolist() == [256] * 200
    assert not drawn.duplicated().any()
    # Trees share rows, as independent draws do, and together they reach most of the table.
    assert drawn.v.duplicated().any() and drawn.v.nunique() > 0.8 * min(n, 200 * 256 * (1 - 256 / n))


def test_equal_distances_go_by_value():
    points = [[0.0, 1.0], [1.0, 0.0], [0.0, -1.0], [-1.0, 0.0], [2.0, 2.0]]
    visitors = pd.DataFrame({"c": [0], "x": [[0.0, 0.0]]})
    for order in ([0, 1, 2, 3, 4], [4, 3, 2, 1, 0], [2, 0, 4, 1, 3]):
        held = pd.DataFrame({"hx": [points[i] for i in order], "hm": [1] * 5})
        got = neighbours._nearest(visitors, held, 3)
        assert [list(v) for v in got["nx"]] == [[-1.0, 0.0], [0.0, -1.0], [0.0, 1.0]]
        assert np.allclose(got["d2"], 1.0)
