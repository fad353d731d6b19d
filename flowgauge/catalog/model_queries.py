"""Models trained on the embedding view and on a separable one, and what is computed from them."""

import itertools

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from .. import views
from ..operators import alerts, cleaning, explain, isolation, models, oversampling, scaling
from ..plans import detection, evaluate, training
from ..schemas import CLASS_IDS, FEATURES, FLOW_META, LABEL
from ..storage import written


def flows(spark, folder):
    """Embedding flows with addresses and a time, as detection needs them."""
    return views.embedding_flows(spark, folder).withColumns({
        "last_ts": F.timestamp_seconds(F.lit(1_700_000_000) + F.col("vec_id")),
        "src_ip": F.concat(F.lit("10.1.0."), (F.col("vec_id") % 20).cast("string")),
        "dst_ip": F.lit("192.168.0.10"), "src_port": (F.col("vec_id") + 1024).cast("int"), "dst_port": F.lit(443), "protocol": F.lit(6),
    })


def scaled(spark, folder):
    df = views.embedding_flows(spark, folder)
    return scaling.scale_clip(df, scaling.fit_scaler(df, FEATURES))


def table(spark, folder):
    return models.assembled(scaled(spark, folder))


def forest(spark, folder):
    rows = table(spark, folder)
    return evaluate.class_report(models.predictions(models.train_forest(rows), rows))


def boosted(spark, folder):
    rows = table(spark, folder)
    return evaluate.class_report(models.predictions(models.train_boosted(rows), rows))


def perceptron(spark, folder):
    rows = table(spark, folder)
    return evaluate.class_report(models.predictions(models.train_mlp(rows), rows))


def primary(spark, folder):
    rows = table(spark, folder)
    name, model = models.train_primary(rows)
    return evaluate.metrics(models.predictions(model, rows)).withColumn("model", F.lit(name))


def grid(spark, folder):
    _, scores = models.grid_search(table(spark, folder))
    return scores


def importance(spark, folder):
    return models.feature_importance(models.train_forest(table(spark, folder)), spark)


def stored_model(spark, folder):
    """Predictions of a stored and reloaded model, beside the fitted one's."""
    from .source_queries import _place

    rows, place = table(spark, folder), _place(spark)
    model = models.train_forest(rows)
    models.save_model(model, place, spark)
    again = models.predictions(models.load_best_model(spark, place), rows).groupBy("y", "p").agg(F.count("*").alias("reloaded"))
    first = models.predictions(model, rows).groupBy("y", "p").agg(F.count("*").alias("fitted"))
    return first.join(again, ["y", "p"], "full")


def classified(spark, folder):
    df = flows(spark, folder)
    scaler = scaling.fit_scaler(df, FEATURES)
    model = models.train_forest(table(spark, folder))
    return alerts.classify(df, model, scaler), model, scaler


def classify(spark, folder):
    return classified(spark, folder)[0].select("vec_id", "predicted", "confidence")


def isolation_scores(spark, folder):
    rows = scaled(spark, folder)
    model = isolation.fit_isolation(rows.filter("label = 0"), FEATURES, ["vec_id"])
    return isolation.score_isolation(rows, model, FEATURES).select("vec_id", "label", "anomaly_score", "is_anomaly")


def isolation_share(spark, folder):
    """Rows the model was fitted on, and how many of them it flags."""
    rows = scaled(spark, folder).filter("label = 0")
    model = isolation.fit_isolation(rows, FEATURES, ["vec_id"])
    marked = isolation.score_isolation(rows, model, FEATURES)
    return marked.agg(F.count("*").alias("fitted"), F.count_if("is_anomaly").alias("flagged"))


def explained(spark, folder):
    scored, model, _ = classified(spark, folder)
    return explain.explain(scored, model).select("vec_id", "predicted", F.to_json("shap_contributions").alias("contributions"))


def explained_first(spark, folder):
    scored, model, _ = classified(spark, folder)
    return explain.explain_first(scored, model, "vec_id").select("vec_id", "predicted", F.to_json("shap_contributions").alias("contributions"))


def detect(spark, folder):
    df = flows(spark, folder)
    scaler = scaling.fit_scaler(df, FEATURES)
    model = models.train_forest(table(spark, folder))
    anomaly = isolation.fit_isolation(scaled(spark, folder).filter("label = 0"), FEATURES, ["vec_id"])
    raised, _ = detection.detect(df, model, scaler, anomaly)
    return raised.select(F.unix_micros("timestamp").alias("us"), *FLOW_META, "attack_type", "confidence", "severity", "anomaly_score",
                         F.to_json("shap_contributions").alias("contributions"))


def stored_model_same(spark, folder):
    """Rows whose prediction differs after a model was stored and reloaded."""
    from .source_queries import _place

    rows, place = written(table(spark, folder)), _place(spark)
    model = models.train_forest(rows)
    models.save_model(model, place, spark)
    return differing(rows, model, models.load_best_model(spark, place))


def differing(rows, first, second):
    """Rows, and how many of them two models score differently; each row is scored by both where it is."""
    shown = F.struct("prediction", vector_to_array("probability").alias("p"))
    once = first.transform(rows).select("features", shown.alias("fitted"))
    both = second.transform(once).select("fitted", shown.alias("reloaded"))
    return both.agg(F.count("*").alias("n"), F.count_if(~F.col("fitted").eqNullSafe(F.col("reloaded"))).alias("differ"))


def probability_sums(spark, folder):
    """Rows whose class probabilities do not sum to one, or whose confidence is not the largest."""
    scored, _, _ = classified(spark, folder)
    total = F.aggregate("probabilities", F.lit(0.0), lambda a, b: a + b)
    wrong = (F.abs(total - 1) > 1e-9) | (F.col("confidence") != F.get("probabilities", F.col("predicted")))
    return scored.agg(F.count("*").alias("n"), F.count_if(wrong).alias("wrong"))


def scoring_rate(spark, folder):
    """Rows of a whole scoring job, and whether a row takes less than 20 ms of it."""
    scored, _, _ = classified(spark, folder)
    took = evaluate.score_throughput(scored.select("vec_id", "predicted", "confidence"))
    return took.select("rows", (F.col("ms_per_row") < 20).alias("quick"))


def explaining_rate(spark, folder):
    """Rows of a whole explaining job, and whether a row takes less than 100 ms of it."""
    scored, model, _ = classified(spark, folder)
    took = evaluate.score_throughput(explain.explain(written(scored), model).select("vec_id", "shap_contributions"))
    return took.select("rows", (F.col("ms_per_row") < 100).alias("quick"))


def explain_sums(spark, folder):
    """Contributions add up: what is left of the confidence is the same for all rows of a class."""
    scored, model, _ = classified(spark, folder)
    full = explain.explain(scored, model, n=len(FEATURES))
    rest = F.col("confidence") - F.aggregate("shap_contributions", F.lit(0.0), lambda a, c: a + c["value"])
    spread = full.withColumn("rest", rest).groupBy("predicted").agg(F.count("*").alias("n"), (F.max("rest") - F.min("rest")).alias("spread"))
    # Twenty values rounded to four places leave at most 0.002 between two rows.
    return spread.agg(F.sum("n").alias("n"), F.count_if(F.col("spread") > 0.0021).alias("uneven"))


def pca(spark, folder):
    points, shares = models.pca2(views.embedding_flows(spark, folder), keep=["vec_id", "label"])
    return points.withColumns({"share_1": F.lit(shares[0]), "share_2": F.lit(shares[1])})


def pca_spread(spark, folder):
    """Variance kept by two components, from the projected points."""
    points, shares = models.pca2(views.embedding_flows(spark, folder))
    spread = points.agg(F.var_samp("pc1").alias("a"), F.var_samp("pc2").alias("b"), F.count("*").alias("n"))
    return spread.select("n", (F.abs(F.col("a") / (20.0 * F.col("n") / (F.col("n") - 1)) - shares[0]) < 1e-9).alias("first_fits"),
                         (F.abs(F.col("b") / (20.0 * F.col("n") / (F.col("n") - 1)) - shares[1]) < 1e-9).alias("second_fits"))


def smote(spark, folder):
    rows = oversampling.smote(views.embedding_flows(spark, folder), "label", FEATURES, ["vec_id"])
    return rows.groupBy("label", "synthetic").agg(F.count("*").alias("n"))


def smote_bounds(spark, folder):
    """New points lie inside the range of their class in every feature."""
    rows = oversampling.smote(views.embedding_flows(spark, folder), "label", FEATURES, ["vec_id"])
    sides = [f(F.when(F.col("synthetic") == s, F.col(f"`{c}`"))).alias(f"{n}{int(s)}_{i}")
             for i, c in enumerate(FEATURES) for s in (False, True) for n, f in (("lo", F.min), ("hi", F.max))]
    wide = rows.groupBy("label").agg(*sides)
    inside = F.lit(True)
    for i in range(len(FEATURES)):
        inside = inside & F.coalesce((F.col(f"lo1_{i}") >= F.col(f"lo0_{i}")) & (F.col(f"hi1_{i}") <= F.col(f"hi0_{i}")), F.lit(True))
    return wide.select("label", inside.alias("inside"))


def told(spark, folder):
    """The separable view as a scaled training table."""
    rows = cleaning.encode_labels(views.separable(spark, folder))
    return models.assembled(scaling.scale_clip(rows, scaling.fit_scaler(rows, FEATURES)), label=LABEL)


def told_apart(train):
    """Rows per true and predicted class of a model trained on the separable view."""
    def run(spark, folder):
        rows = told(spark, folder)
        # A file of the input may be one task; its rows are dealt over all tasks before they are scored.
        spread = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
        return models.predictions(train(rows), spread).groupBy("y", "p").agg(F.count("*").alias("n"))

    return run


def boosted_reload(spark, folder):
    """A boosted model stored beside a forest is the one that loads; rows whose probabilities differ from the fitted model's."""
    from .source_queries import _place

    rows, place = written(told(spark, folder)), _place(spark)
    model = models.train_boosted(rows)
    models.save_model(model, place, spark)
    models.save_model(models.train_forest(rows), place, spark)
    again = models.load_best_model(spark, place)
    return differing(rows, model, again).select(F.lit(again.kind).alias("kind"), "n", "differ")


def boosted_loss(spark, folder):
    """Rounds of boosting, and how many of them did not lower the log loss."""
    history = models.train_boosted(told(spark, folder)).history
    rises = sum(b > a for a, b in itertools.pairwise(history))
    return table_of(spark, folder, "customer").agg(F.lit(len(history)).alias("rounds"), F.lit(rises).alias("rises"), F.count("*").alias("n"))


def table_of(spark, folder, name):
    return views.table(spark, folder, name)


def grid_told(spark, folder):
    _, scores = models.grid_search(told(spark, folder))
    return scores.select("trees", F.coalesce("depth", F.lit(0)).alias("depth"), "min_split", "macro_f1")


def telling_features(train):
    """The five most important features of a model trained on the separable view."""
    def run(spark, folder):
        return models.feature_importance(train(told(spark, folder)), spark).limit(5).select("feature")

    return run


def primary_told(spark, folder):
    rows = told(spark, folder)
    name, model = models.train_primary(rows)
    return evaluate.metrics(models.predictions(model, rows)).select(F.lit(name).alias("model"), "accuracy", "macro_f1")


def compared(spark, folder):
    """The published run with all three models, on the separable view: whether each tells the held-out rows apart."""
    run = training.train(views.separable(spark, folder), ["c_custkey"], compare=True)
    return run.extra["comparison"].select("model", (F.col("accuracy") > 0.98).alias("accurate"), (F.col("macro_f1") > 0.98).alias("balanced"))


def tuned(spark, folder):
    """The published run with the grid search, on the separable view."""
    run = training.train(views.separable(spark, folder), ["c_custkey"], tune=True, with_anomaly=False)
    return run.metrics.select(F.lit(run.name).alias("model"), F.lit(run.extra["grid"].count()).alias("settings"), "accuracy", "macro_f1")


def quick_importance(spark, folder):
    from .table_queries import lab

    return training.quick_importance(lab(spark, folder), views.ROW_KEYS)


def training_run(spark, folder):
    """The whole training run over the labelled view."""
    from .table_queries import lab

    return training.train(lab(spark, folder), views.ROW_KEYS).report


TOLD = f"""t AS (SELECT CAST(CASE c_mktsegment {' '.join(f"WHEN '{a}' THEN {CLASS_IDS[b]}" for a, b in views.SEGMENTS.items())} END AS INT) AS c
  FROM customer WHERE c_mktsegment IN ({', '.join(f"'{a}'" for a in views.SEGMENTS)}))"""
TOLD_APART = f"WITH {TOLD} SELECT c AS y, c AS p, count(*) AS n FROM t GROUP BY c"
TELLING = "SELECT * FROM (VALUES " + ", ".join(f"('{f}')" for f in FEATURES[:5]) + ") v(feature) WHERE EXISTS (SELECT 1 FROM customer)"
COUNTS = "c AS (SELECT CAST(label % 7 AS INT) AS label, count(*) AS n FROM embeddings GROUP BY 1)"
QUERIES = {
    "forest": (forest, None),
    "boosted": (boosted, None),
    "perceptron": (perceptron, None),
    "primary_model": (primary, None),
    "grid_search": (grid, None),
    "feature_importance": (importance, None),
    "stored_model": (stored_model, None),
    "stored_model_same": (stored_model_same, "SELECT count(*) AS n, 0 AS differ FROM embeddings"),
    "classify": (classify, None),
    "probability_sums": (probability_sums, "SELECT count(*) AS n, 0 AS wrong FROM embeddings"),
    "scoring_rate": (scoring_rate, 'SELECT count(*) AS "rows", true AS quick FROM embeddings'),
    "explaining_rate": (explaining_rate, 'SELECT count(*) AS "rows", true AS quick FROM embeddings'),
    "explain_sums": (explain_sums, "SELECT count(*) AS n, 0 AS uneven FROM embeddings"),
    "isolation_scores": (isolation_scores, None),
    "isolation_share": (isolation_share, """SELECT count(*) AS fitted, CAST(ceil((count(*) - 1) * 0.05) AS BIGINT) AS flagged FROM embeddings WHERE label % 7 = 0"""),
    "explain": (explained, None),
    "explain_first": (explained_first, None),
    "detect": (detect, None),
    "pca": (pca, None),
    "pca_spread": (pca_spread, "SELECT count(*) AS n, true AS first_fits, true AS second_fits FROM embeddings"),
    "smote": (smote, f"""WITH {COUNTS}, t AS (SELECT max(n) AS top FROM c) SELECT label, false AS synthetic, n FROM c
       UNION ALL SELECT label, true, top - n FROM c, t WHERE top > n AND n >= 4"""),
    "smote_bounds": (smote_bounds, "SELECT DISTINCT CAST(label % 7 AS INT) AS label, true AS inside FROM embeddings"),
    "quick_importance": (quick_importance, None),
    "training_run": (training_run, None),
    "forest_told": (told_apart(lambda rows: models.train_forest(rows)), TOLD_APART),
    "boosted_told": (told_apart(lambda rows: models.train_boosted(rows)), TOLD_APART),
    "perceptron_told": (told_apart(lambda rows: models.train_mlp(rows)), TOLD_APART),
    "primary_told": (primary_told, f"WITH {TOLD} SELECT 'boosted' AS model, 1.0 AS accuracy, 1.0 AS macro_f1 FROM t LIMIT 1"),
    "boosted_loss": (boosted_loss, "SELECT 300 AS rounds, 0 AS rises, count(*) AS n FROM customer"),
    "boosted_reload": (boosted_reload, f"WITH {TOLD} SELECT 'boosted' AS kind, count(*) AS n, 0 AS differ FROM t"),
    "forest_telling_features": (telling_features(lambda rows: models.train_forest(rows)), TELLING),
    "boosted_telling_features": (telling_features(lambda rows: models.train_boosted(rows)), TELLING),
    "grid_told": (grid_told, """SELECT trees, depth, min_split, 1.0 AS macro_f1 FROM (VALUES (100), (200)) a(trees), (VALUES (20), (30), (0)) b(depth),
       (VALUES (2), (5)) c(min_split) WHERE EXISTS (SELECT 1 FROM customer)"""),
    "training_compared": (compared, """SELECT model, true AS accurate, true AS balanced FROM (VALUES ('boosted'), ('forest'), ('perceptron')) v(model)
       WHERE EXISTS (SELECT 1 FROM customer)"""),
    "training_tuned": (tuned, "SELECT 'forest (tuned)' AS model, 12 AS settings, 1.0 AS accuracy, 1.0 AS macro_f1 FROM customer LIMIT 1"),
}
