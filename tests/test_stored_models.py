"""Forests kept as files of trees, and models stored and read again."""

import pickle

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowgauge.catalog import model_queries
from flowgauge.operators import explain, models, trees

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(8)
    y = rng.integers(0, 3, 2000)
    x = rng.normal(size=(2000, 4))
    df = spark.createDataFrame([(int(c), *[float(v) for v in r]) for c, r in zip(y, x)], "label int, " + ", ".join(f"{n} double" for n in NAMES))
    return df.select(models.assembled_vector(NAMES).alias("features"), F.col("label").cast("double").alias("label")).cache(), x, y


@pytest.fixture
def without_arrow(spark):
    name = "spark.sql.execution.arrow.pyspark.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def test_the_driver_holds_no_nodes_of_a_forest(spark, rows):
    df, x, _ = rows
    small = trees.grow_forest(df, trees.Forest(8, 2, 2, 1))
    large = trees.grow_forest(df, trees.Forest(8, None, 2, 1))
    models.predictions(large, df).count()
    models.feature_importance(large, spark, NAMES).count()
    explain.stored_blocks(spark, large, 500)
    assert not set(trees.ARRAYS) & set(vars(large))
    assert sum(large.sizes) > 50 * sum(small.sizes)
    assert abs(len(pickle.dumps(large)) - len(pickle.dumps(small))) < 200
    # Names of the arrays still give them, and the plain walk over them agrees.
    plain = trees.TreeModel("forest", 4, 3, output=large.output, **{k: getattr(large, k) for k in trees.ARRAYS})
    assert np.allclose(plain.probabilities(x), large.probabilities(x))
    assert np.allclose(plain.featureImportances, large.featureImportances)


@pytest.mark.usefixtures("without_arrow")
def test_models_are_stored_without_arrow(spark, rows, tmp_path):
    """Where pandas tables go to Spark row by row, numpy values inside arrays are refused."""
    df, x, _ = rows
    for model in (trees.grow_forest(df, trees.Forest(5, None, 2, 1), chunk=300, local_rows=500), trees.boost(df, trees.Boosting(3, 3, 0.1, 0.8, 0.8, 1))):
        again = models.load_model(spark, models.save_model(model, str(tmp_path), spark))
        assert np.array_equal(again.probabilities(x), model.probabilities(x)) and np.allclose(again.history, model.history)
        for name in trees.ARRAYS:
            assert np.array_equal(getattr(again, name), getattr(model, name)), name


def test_blocks_of_a_stored_forest(spark, rows):
    df, x, _ = rows
    forest = trees.grow_forest(df, trees.Forest(6, 5, 2, 1))
    plain = trees.TreeModel("forest", 4, 3, output=forest.output, **{k: getattr(forest, k) for k in trees.ARRAYS})
    asked = np.arange(20) % 3
    for nodes in (100, 10_000):
        blocks = explain.stored_blocks(spark, forest, nodes)
        got = sum(explain.contributions(x[:20], groups, asked) for groups in blocks)
        want = explain.contributions(x[:20], explain.leaves_of(plain, 0, 6), asked)
        assert np.allclose(got, want)


def test_scoring_in_many_batches(spark, rows, monkeypatch):
    df, x, _ = rows
    monkeypatch.setattr(trees, "KEPT_NODES", 300)
    forest = trees.grow_forest(df, trees.Forest(6, None, 2, 1))
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "70")
    try:
        got = models.predictions(forest, df.coalesce(1)).toPandas()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert np.allclose(np.stack(got.scores.to_numpy()), forest.probabilities(x))


def test_a_large_input_file_is_boosted_by_several_tasks(spark, rows):
    """One partition of rows becomes chunks in several files, and the model is that of one task."""
    df, x, _ = rows
    one = df.coalesce(1)
    data = trees.bin_rows(one, chunk=100)
    assert data.chunks == 20 and len(data.table(spark).inputFiles()) > 1
    p = trees.Boosting(rounds=12, depth=3, rate=0.3, rows=0.8, columns=0.75, seed=1)
    levels, whole = trees.boost(one, p, chunk=100, local_rows=300), trees.boost(one, p)
    assert np.allclose(levels.history, whole.history) and np.allclose(levels.probabilities(x), whole.probabilities(x))


def test_kept_margins_are_those_added_up_from_the_start(monkeypatch):
    rng = np.random.default_rng(0)
    bins = [rng.integers(0, 9, (50, 2)).astype(np.uint8) for _ in range(3)]
    chunks = [trees.Chunk(b, b[:, 0].astype(np.int64) % 2, np.ones(50), trees.row_keys(b, b[:, 0] % 2), np.zeros((50, 2))) for b in bins]

    def grown(r):
        out = []
        for c in range(2):
            tree = trees.Growing()
            tree.value[0] = 0.0
            for child, value in zip(tree.split(0, c, r, 1.0), (0.1 * r, -0.3), strict=True):
                tree.value[child] = value
            out.append(tree)
        return out

    later = [grown(r) for r in range(1, 6)]
    for room in (10**6, 900):
        monkeypatch.setattr(trees, "MARGIN_BYTES", room)
        for n in (0, 1, 1, 3, 5, 2):
            for chunk in chunks:
                assert np.array_equal(trees._margin(chunk, later[:n], f"table {room}"), trees._added(chunk.margin, chunk.bins, later[:n]))


def test_equal_rows_count_once_each_when_two_models_are_compared(spark, rows):
    df, _, _ = rows
    twice = df.limit(50).union(df.limit(50)).cache()
    one, other = (trees.grow_forest(twice, trees.Forest(3, 2, 2, seed)) for seed in (1, 2))
    assert model_queries.differing(twice, one, one).first().asDict() == {"n": 100, "differ": 0}
    found = model_queries.differing(twice, one, other).first()
    assert found.n == 100 and 0 < found.differ <= 100


def test_told_queries_score_in_all_tasks(spark, rows, monkeypatch):
    """Rows of one partition, as a small file gives them, are dealt over the tasks before they are scored."""
    df, _, _ = rows
    seen = []
    monkeypatch.setattr(model_queries, "told", lambda *_: df.coalesce(1))
    predictions = models.predictions
    monkeypatch.setattr(models, "predictions", lambda model, held: seen.append(held.rdd.getNumPartitions()) or predictions(model, held))
    run = model_queries.told_apart(lambda train: trees.grow_forest(train, trees.Forest(3, 4, 2, 1)))
    assert run(spark, "").agg(F.sum("n")).first()[0] == df.count()
    assert seen == [int(spark.conf.get("spark.sql.shuffle.partitions"))]
