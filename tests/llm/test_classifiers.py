import numpy as np
import pytest
from pyspark.sql import functions as F

from flowgauge.llm import quality, toxicity
from flowgauge.llm.common import fold
from flowgauge.llm.queries import op3_quality, op8_toxicity

FOLDER = "/root/testdata/sf0.1"


def held_out_auc(rows, label):
    y, s = np.array([r[label] for r in rows]), np.array([r["score"] for r in rows])
    pairs = s[y == 1][:, None] - s[y == 0][None, :]
    return ((pairs > 0).sum() + 0.5 * (pairs == 0).sum()) / pairs.size


@pytest.mark.parametrize("query,label", [(op3_quality, "quality"), (op8_toxicity, "toxic")])
def test_held_out_accuracy(spark, query, label):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", label)
    got = query(spark, FOLDER)
    rows = got.join(labels, "doc_id").filter("held_out").collect()
    assert held_out_auc(rows, label) > 0.94
    assert np.mean([r["predicted"] == r[label] for r in rows]) > 0.96
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_fold_is_crc32(spark):
    import zlib

    rows = spark.range(50).select("id", fold("id").alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in rows)


def test_rules_as_columns_equal_numpy(spark, prose):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 3))
    y = ((x[:, 0] > 0.3) & (x[:, 1] < 0.5)).astype(int)
    model = quality.fit_rules(x, y, ["a", "b", "c"])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "_a double, _b double, _c double")
    got = np.array([r[0] for r in df.select(model.column()).collect()])
    total = np.full(len(x), model.intercept)
    for rule, weight in zip(model.rules, model.weights, strict=True):
        total += weight * np.all([(x[:, "abc".index(n)] > c) == above for n, above, c in rule], axis=0)
    assert np.allclose(got, 1 / (1 + np.exp(-total)))
    assert ((got >= 0.5) == y).mean() > 0.98 and 0 < len(model.rules) < 200
    assert len(quality.explain_rules(model)) == len(model.rules)


def test_lasso_meets_its_optimality_conditions():
    rng = np.random.default_rng(1)
    z = rng.integers(0, 2, (500, 12)).astype(float)
    y = (rng.random(500) < 1 / (1 + np.exp(-(2 * z[:, 0] - 1)))).astype(float)
    b, w = quality.lasso_logistic(z, y, 0.02, 5000)
    slope = z.T @ (1 / (1 + np.exp(-(z @ w + b))) - y) / len(y)
    assert np.allclose(slope[w != 0], -0.02 * np.sign(w[w != 0]), atol=1e-5) and (np.abs(slope[w == 0]) <= 0.02 + 1e-5).all()


@pytest.mark.parametrize("rows", [[], [(5, 1)], [(5, 0), (8, 0)], [(None, 1), (6, None)]])
def test_few_labels_and_awkward_texts(spark, awkward, nothing, rows):
    labels = spark.createDataFrame([(i, y, y) for i, y in rows], "doc_id long, quality int, toxic int")
    model = quality.fit_quality(awkward, labels)
    got = quality.score_quality(awkward, model)
    assert got.columns[:len(awkward.columns)] == awkward.columns
    assert all(0 <= r._score <= 1 for r in got.collect()) and got.count() == 10
    toxic = toxicity.fit_toxicity(awkward, labels)
    scored = toxicity.score_toxicity(awkward, toxic).collect()
    assert len(scored) == 10 and all(0 <= r.score <= 1 for r in scored)
    assert quality.score_quality(nothing, model).count() == 0 and toxicity.score_toxicity(nothing, toxic).count() == 0
    assert quality.fit_quality(nothing, labels).rules == ()


def test_statistics_are_finite(awkward):
    rows = quality.with_statistics(awkward.withColumn("text", F.coalesce("text", F.lit("")))).collect()
    names = [f"_{n}" for n in quality.statistics(F.lit(""))]
    assert all(np.isfinite([r[n] for n in names]).all() for r in rows)


def test_sample_is_bounded_and_leaves_the_fold_out(spark):
    labels = spark.range(1000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality")
    sample = quality.labelled_sample(labels, "quality", 100).withColumn("f", fold("doc_id"))
    assert sample.count() == 100 and sample.filter("f = 0").count() == 0


def test_convolution_learns_a_pair_of_words():
    """Neither word alone is toxic: only filters of width two can tell."""
    rng = np.random.default_rng(3)
    words = [f"w{i}".encode() for i in range(60)]
    documents, y = [], []
    for i in range(1500):
        d = list(rng.choice(words, 25))
        a, b = int(rng.integers(0, 10)), int(rng.integers(12, 24))
        if i % 2:
            d[a:a + 2] = [b"bad", b"thing"]
        else:
            d[a], d[b] = b"bad", b"thing"
        documents.append(d)
        y.append(i % 2)
    model = toxicity.train(documents[:1200], np.array(y[:1200]))
    found = model.scores(documents[1200:]) >= 0.5
    assert (found == np.array(y[1200:])).mean() > 0.95
