"""The whole training run: from a labelled flow table to stored models and scores."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cleaning, isolation, models, oversampling, sampling, scaling
from ..schemas import BENIGN, CLASS_IDS, FEATURES, LABEL
from ..storage import written
from . import evaluate

BENIGN_ROWS = 300_000


@dataclass
class Run:
    """Results of a training run."""

    name: str
    model: object
    scaler: scaling.Scaler
    anomaly: isolation.IsolationModel | None
    metrics: DataFrame
    report: DataFrame
    auc: DataFrame
    importance: DataFrame | None
    extra: dict = field(default_factory=dict)


def train(flows: DataFrame, order: list[str], kind: str = "boosted", chronological: bool = True, sample: float | None = None,
          benign_rows: int = BENIGN_ROWS, compare: bool = False, tune: bool = False, with_anomaly: bool = True,
          folder: str | None = None, model_params: dict | None = None, grid: dict | None = None) -> Run:
    """Encode, split, scale, balance, fit, evaluate, and fit the anomaly model on benign rows.

    ``order`` (LONG columns, unique together) gives the chronological order.
    """
    spark, params = flows.sparkSession, model_params or {}
    if sample is not None and 0 < sample < 1:
        flows = sampling.sample_fraction(flows, sample, order)
    encoded = cleaning.encode_labels(flows)
    chosen = cleaning.select_features(encoded, keep=[*order, f"`{LABEL}`"])
    if chronological:
        fit_rows, test_rows = sampling.split_chronological(chosen, order)
    else:
        fit_rows, test_rows = sampling.split_stratified(chosen.withColumn("_s", sampling.scatter_key(*order)), LABEL, ["_s", *order])
    scaler = scaling.fit_scaler(fit_rows, FEATURES)
    fit_rows = written(scaling.scale_clip(fit_rows, scaler))
    test_rows = written(models.assembled(scaling.scale_clip(test_rows, scaler), label=LABEL))
    scattered = fit_rows.withColumn("_s", sampling.scatter_key(*order))
    fewer = sampling.undersample(scattered, LABEL, CLASS_IDS[BENIGN], benign_rows, ["_s", *order])
    balanced = oversampling.smote(fewer, LABEL, FEATURES, order)
    table = written(models.assembled(balanced, label=LABEL))
    fitted, extra = {}, {}
    if tune:
        model, extra["grid"] = models.grid_search(table, grid)
        name = "forest (tuned)"
    else:
        name, model = models.train_primary(table, kind, **params)
    fitted[name] = model
    if compare and not tune:
        if "boosted" not in fitted:
            fitted["boosted"] = models.train_boosted(table)
        if "forest" not in fitted:
            fitted["forest"] = models.train_forest(table)
        fitted["perceptron"] = models.train_mlp(table)
        extra["comparison"] = evaluate.compare_models({n: models.predictions(m, test_rows) for n, m in fitted.items()})
    scored = written(models.predictions(model, test_rows))
    importance = models.feature_importance(model, spark) if hasattr(model, "featureImportances") else None
    anomaly = None
    if with_anomaly:
        benign = fit_rows.filter(F.col(f"`{LABEL}`") == CLASS_IDS[BENIGN])
        anomaly = isolation.fit_isolation(benign, FEATURES, order)
    if folder:
        models.save_model(model, folder, spark, tuned=tune)
        scaler.save(spark, f"{folder}/scaler")
        if anomaly is not None:
            anomaly.save(spark, f"{folder}/anomaly")
        if importance is not None:
            from ..sources.artifacts import write_importance

            write_importance(importance, f"{folder}/feature_importance")
    return Run(name, model, scaler, anomaly, evaluate.metrics(scored), evaluate.class_report(scored),
               evaluate.auc_per_class(scored), importance, extra)


def quick_importance(flows: DataFrame, key: list[str], fraction: float = 0.10, trees: int = models.QUICK_TREES, depth: int = models.QUICK_DEPTH) -> DataFrame:
    """Feature importance from a small forest over a sample with medians filled in."""
    some = sampling.sample_fraction(flows, fraction, key)
    filled = sampling.impute_median(some, [c for c in FEATURES if c in some.columns])
    labelled = cleaning.coerce_label(filled)
    model = models.train_forest(models.assembled(labelled, label=LABEL), balanced=False, trees=trees, depth=depth)
    return models.feature_importance(model, flows.sparkSession)
