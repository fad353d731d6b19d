import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowgauge.operators import cleaning, ranks, sampling, scaling
from flowgauge.plans import eda, evaluate
from flowgauge.schemas import CLASS_IDS, FEATURES, LABEL


def test_column_names(spark):
    df = cleaning.strip_columns(spark.createDataFrame([(1, 2, 3)], [" a", "a ", "b"]))
    assert df.columns == ["a", "a.1", "b"]


def test_clean_and_report(spark):
    inf = float("inf")
    rows = [(1.0, "BENIGN"), (1.0, "BENIGN"), (inf, "Bot"), (float("nan"), "Bot"), (None, "Bot"), (-inf, "X"), (2.0, "Web Attack \x96 XSS"), (3.0, "Odd")]
    df = spark.createDataFrame(rows, " `a ` double, Label string")
    got = sorted((r.a, r[LABEL]) for r in cleaning.clean(df).collect())
    assert got == [(1.0, "Normal Traffic"), (2.0, "Web Attacks"), (3.0, "Odd")]
    report = cleaning.clean_report(cleaning.regroup_labels(cleaning.strip_columns(df))).first()
    assert (report.rows_in, report.incomplete, report.duplicates, report.rows_out) == (8, 4, 1, 3)


def test_labels(spark):
    df = spark.createDataFrame([(n,) for n in [*CLASS_IDS, "UnknownAttack"]], f"`{LABEL}` string")
    assert sorted(r[0] for r in cleaning.encode_labels(df).collect()) == list(range(7))
    assert [tuple(r) for r in cleaning.unknown_labels(df).collect()] == [("UnknownAttack", 1)]


def test_missing_feature_is_zero(spark):
    df = spark.createDataFrame([tuple([1.0] * 19)], FEATURES[1:])
    assert cleaning.missing_features(df) == ["Flow Duration"]
    row = cleaning.select_features(df).first()
    assert list(row.asDict()) == FEATURES and row["Flow Duration"] == 0.0


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), ["a", "b", "c"][min(2, int(i) % 7)], float(round(v, 3)), float(np.exp(v * 3))) for i, v in enumerate(rng.normal(size=2100))]
    return spark.createDataFrame(rows, "id long, g string, v double, w double").cache()


@pytest.mark.parametrize("candidates", [1, 5, 100_000])
def test_quantiles_equal_plain_ones(numbers, candidates):
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    frame = numbers.toPandas()
    for r in ranks.exact_quantiles(numbers, ["g"], ["v", "w"], probs, candidates=candidates).collect():
        assert np.allclose(frame[frame.g == r.g][r.feature].quantile(probs), r.q, rtol=1e-12)


@pytest.mark.parametrize("candidates", [1, 100_000])
def test_quantiles_of_awkward_values(spark, candidates):
    """Ties, both infinities, both zeros, missing values, a null group, a column without values."""
    inf, nan = float("inf"), float("nan")
    rows = [("a", 1.0, None)] * 500 + [("a", float(i), None) for i in range(400)] + [("a", nan, None), ("a", None, None)]
    rows += [(None, x, None) for x in (inf, -inf, 1.0, 2.0, 3.0, 1e300, -1e300)] + [("z", -0.0, nan), ("z", 0.0, nan), ("z", -1e-320, nan)]
    df = spark.createDataFrame(rows, "g string, v double, empty double")
    got = {(r.g, r.feature): r.q for r in ranks.exact_quantiles(df, ["g"], ["v", "empty"], [0.0, 0.5, 0.75, 1.0], candidates=candidates).collect()}
    plain = sorted([1.0] * 500 + [float(i) for i in range(400)])
    assert got["a", "v"] == pytest.approx(np.quantile(plain, [0.0, 0.5, 0.75, 1.0]).tolist())
    assert got[None, "v"][0] == -inf and got[None, "v"][1] == 2.0 and got[None, "v"][3] == inf
    assert got["z", "v"][0] == -1e-320 and got["z", "v"][3] == 0.0
    assert all(got[g, "empty"] is None for g in ("a", None, "z"))
    assert ranks.exact_quantiles(df.limit(0), [], ["v"], [0.5]).count() == 0
    whole = ranks.exact_quantiles(df.filter("g = 'a'"), [], ["v"], [0.5], candidates=candidates).first().q
    assert whole == got["a", "v"][1:2]


def test_no_task_holds_a_table(numbers):
    """Counting passes send counts, not values, however small the table is."""
    plan = numbers._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    found = ranks.mark_lowest(numbers, ["g"], ["v", "id"], numbers.groupBy("g").agg(F.lit(5).cast("long").alias("k")))
    assert "SinglePartition" not in found._jdf.queryExecution().executedPlan().toString() and found.filter("lowest").count() == 15


@pytest.mark.parametrize("order", [["h", "id"], ["coarse", "id"]])
def test_cut_by_counting_equals_sort(numbers, order):
    df = numbers.withColumn("h", sampling.scatter_key("id")).withColumn("coarse", F.col("id") % 5)
    frame = df.toPandas().sort_values(order)
    want = frame.groupby("g").head(100)["id"]
    got = sampling.sample_per_class(df, "g", 100, order).select("id").collect()
    assert sorted(r.id for r in got) == sorted(want) and len(got) == 300


def test_first_rows_by_text_and_nulls(spark):
    """Text order columns, nulls first, a null group, groups that are wanted whole or not at all."""
    rows = [(g, None if i % 10 == 0 else f"file-{i % 7}", i) for i in range(100) for g in ("a", None, "b", "c")]
    df = spark.createDataFrame(rows, "g string, f string, i long").repartition(5)
    wanted = spark.createDataFrame([("a", 33), (None, 15), ("b", 1000), ("c", 0)], "g string, k long")
    got = ranks.mark_lowest(df, ["g"], ["f", "i"], wanted).filter("lowest").collect()
    order = sorted({(f or "", i) for _, f, i in rows})
    for g, k in (("a", 33), (None, 15), ("b", 100), ("c", 0)):
        assert sorted((r.f or "", r.i) for r in got if r.g == g) == order[:k]
    train, test = sampling.split_chronological(df, ["f", "i", "g"])
    assert (train.count(), test.count()) == (320, 80)


def test_cut_needs_an_order_that_tells_rows_apart(numbers):
    with pytest.raises(ValueError):
        sampling.sample_per_class(numbers.withColumn("k", F.lit(1).cast("long")), "g", 10, ["k"])


def test_chronological_split(numbers):
    for options in ({},):
        train, test = sampling.split_chronological(numbers, ["id"], **options)
        assert (train.count(), test.agg(F.min("id")).first()[0]) == (1680, 1680)


def test_stratified_split(numbers):
    for options in ({},):
        train, test = sampling.split_stratified(numbers, "g", ["id"], **options)
        assert {r.g: r["count"] for r in train.groupBy("g").count().collect()} == {"a": 240, "b": 240, "c": 1200}
        assert test.count() == 420
    alone = numbers.withColumn("g", F.when(F.col("id") == 5, "alone").otherwise(F.col("g")))
    train, test = sampling.split_stratified(alone, "g", ["id"])
    assert (train.count(), test.count()) == (1680, 420)


def test_undersample(numbers):
    for options in ({},):
        got = {r.g: r["count"] for r in sampling.undersample(numbers, "g", "c", 77, ["id"], **options).groupBy("g").count().collect()}
        assert got == {"a": 300, "b": 300, "c": 77}
    assert sampling.undersample(numbers, "g", "c", 10_000, ["id"]).count() == 2100


def test_sample_is_repeatable(numbers):
    first = sampling.sample_fraction(numbers, 0.3, ["id"]).select("id").collect()
    again = sampling.sample_fraction(numbers.repartition(5), 0.3, ["id"]).select("id").collect()
    assert sorted(first) == sorted(again) and 500 < len(first) < 760


def test_impute_median(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,), (float("inf"),), (float("nan"),), (5.0,)], "v double")
    assert sorted(r.v for r in sampling.impute_median(df, ["v"]).collect()) == [1.0, 3.0, 3.0, 3.0, 3.0, 5.0]


def test_scaler(spark, numbers, tmp_path):
    df = numbers.withColumn("same", F.lit(2.0))
    scaler = scaling.fit_scaler(df, ["v", "w", "same"])
    frame = df.toPandas()
    assert np.allclose(scaler.means[:2], frame[["v", "w"]].mean()) and np.allclose(scaler.stds[:2], frame[["v", "w"]].std(ddof=0))
    assert scaler.stds[2] == 1.0
    limits = scaling.scale_clip(df, scaler).agg(F.max("w"), F.min("w"), F.max("same")).first()
    assert limits[0] == 5.0 and limits[1] >= -5 and limits[2] == 0.0
    scaler.save(spark, str(tmp_path / "s"))
    assert scaling.Scaler.load(spark, str(tmp_path / "s")) == scaler
    with pytest.raises(RuntimeError):
        scaling.scale_clip(df, None)
    with pytest.raises(FileNotFoundError):
        scaling.Scaler.load(spark, str(tmp_path / "none"))


def test_correlations_with_missing_cells(spark, numbers):
    holes = numbers.withColumn("v", F.when(F.col("id") % 3 > 0, F.col("v")))
    frame = holes.select("v", "w", "id").toPandas().astype(float).corr()
    for df, want in ((numbers, numbers.select("v", "w", "id").toPandas().corr()), (holes, frame)):
        for r in eda.correlations(df, ["v", "w", "id"]).collect():
            assert r.r == pytest.approx(want.loc[r.feature_a, r.feature_b])


def test_constant_histogram(spark):
    df = spark.createDataFrame([(2.0,)] * 5, "v double")
    rows = eda.clipped_histogram(df, "v", bins=4).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [0, 0, 5, 0] and rows[0].lower == 1.5


def test_roc_and_auc(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 3, 400)
    scores = np.round(rng.random((400, 3)) + 0.4 * np.eye(3)[y], 1)
    df = spark.createDataFrame([(int(a), int(s.argmax()), [float(v) for v in s]) for a, s in zip(y, scores)], "y int, p int, scores array<double>")
    got = {r["class"]: r.auc for r in evaluate.auc_per_class(df).collect()}
    for c in range(3):
        pos, neg = scores[y == c, c], scores[y != c, c]
        won = (pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean()
        assert got[c] == pytest.approx(won)
    points = evaluate.roc_points(df).filter("class = 1").orderBy("fpr", "tpr").collect()
    assert (points[0].fpr, points[0].tpr, points[0].score) == (0.0, 0.0, float("inf"))
    for r in points:
        assert r.tpr == pytest.approx((scores[y == 1, 1] >= r.score).mean())
        assert r.fpr == pytest.approx((scores[y != 1, 1] >= r.score).mean())


def test_one_sided_truth(spark):
    df = spark.createDataFrame([(1, 1, [0.1, 0.9]), (1, 0, [0.6, 0.4])], "y int, p int, scores array<double>")
    assert evaluate.auc_per_class(df).first().auc is None
    row = evaluate.metrics(df).first()
    assert (row.accuracy, row.fpr_benign) == (0.5, 0.0)
    assert row.macro_f1 == pytest.approx((2 / 3 + 0) / 2)
    assert [tuple(r) for r in evaluate.confusion(df).collect()] == [(1, "Port Scanning", 1, 1)]


def test_train_shares():
    assert sampling.train_shares({"a": 3, "b": 3, "c": 4}) == {"a": 3, "b": 2, "c": 3}
    assert sum(sampling.train_shares({"a": 101, "b": 7}).values()) == 108 - math.ceil(108 * 0.2)
