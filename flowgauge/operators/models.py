"""Classifiers: forest, boosted trees, perceptron, grid search, importance, projection."""

import itertools
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.evaluate import metrics
from ..schemas import FEATURES
from ..sources.artifacts import exists, require
from ..storage import written
from .cleaning import quoted
from .perceptron import PerceptronModel, train_perceptron
from .scaling import fit_scaler
from .trees import Boosting, Forest, TreeModel, boost, grow_forest

# ---------------------------------------------------------------------------
# Model parameters and the search grid. A depth of None has no limit.
# ---------------------------------------------------------------------------
FOREST = {"trees": 200, "depth": 30, "min_split": 2, "seed": 42}
QUICK_TREES = 50
QUICK_DEPTH = 30
BOOSTED = {"rounds": 300, "depth": 6, "rate": 0.1, "rows": 0.8, "columns": 0.8, "seed": 42}
GRID = {"trees": [100, 200], "depth": [20, 30, None], "min_split": [2, 5]}
FOLDS = 3

FOREST_DIR = "forest"
BOOSTED_DIR = "boosted"
TUNED_DIR = "forest_tuned"


def assembled_vector(columns: list[str] = FEATURES) -> Column:
    """The columns as one MLlib vector."""
    return array_to_vector(F.array(*[quoted(c).cast("double") for c in columns]))


def assembled(df: DataFrame, columns: list[str] = FEATURES, label: str = "label") -> DataFrame:
    """(features, label) as MLlib wants them."""
    numbered = [quoted(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)]
    slim = df.select(*numbered, quoted(label).cast("double").alias("label"))
    return VectorAssembler(inputCols=[f"c{i}" for i in range(len(columns))], outputCol="features").transform(slim).select("features", "label")


def train_forest(df: DataFrame, balanced: bool = True, **params) -> TreeModel:
    """A random forest over (features, label); class weights balance the classes."""
    return grow_forest(df, Forest(**{**FOREST, **params}), balanced)


def train_boosted(df: DataFrame, **params) -> TreeModel:
    """Softmax-boosted trees over (features, label)."""
    return boost(df, Boosting(**{**BOOSTED, **params}))


def train_mlp(df: DataFrame, **params) -> PerceptronModel:
    """A perceptron that stops when a held-out tenth is no longer predicted better."""
    return train_perceptron(df, **params)


def train_primary(df: DataFrame, kind: str = "boosted", **params):
    """(name, model): boosted trees, or a forest when asked for. Boosting is part of Spark, so nothing stands in for it."""
    if kind not in ("boosted", "forest"):
        raise ValueError(f"unknown model kind {kind!r}")
    return kind, (train_boosted if kind == "boosted" else train_forest)(df, **params)


def predictions(model, df: DataFrame) -> DataFrame:
    """(y, p, scores) for evaluation."""
    scored = model.transform(df)
    return scored.select(F.col("label").cast("int").alias("y"), F.col("prediction").cast("int").alias("p"),
                         vector_to_array("probability").alias("scores"))


def with_folds(df: DataFrame, folds: int = FOLDS, seed: int = 42) -> DataFrame:
    """Add ``fold`` by a hash of the row; equal rows share a fold."""
    return df.withColumn("fold", F.pmod(F.xxhash64(F.lit(seed), vector_to_array("features"), "label"), F.lit(folds)).cast("int"))


def grid_search(df: DataFrame, grid: dict | None = None, folds: int = FOLDS, parallelism: int = 4, seed: int = 42):
    """(best model, table of parameters and macro F1) by cross-validation over balanced forests.

    Trees of a forest do not depend on how many there are, so settings that differ in ``trees`` alone share their growth: the
    largest is grown and the others are its first trees. Of equal scores the first setting wins.
    """
    grid = grid or GRID
    points = grid_points(grid)
    rows = written(with_folds(df, folds, seed))
    shapes = list(dict.fromkeys(tuple((k, v) for k, v in p.items() if k != "trees") for p in points))
    most = max(p.get("trees", FOREST["trees"]) for p in points)

    def scores(shape: tuple, fold: int) -> dict[tuple, float]:
        model = train_forest(rows.filter(F.col("fold") != fold), **dict(shape), trees=most, seed=seed)
        held = rows.filter(F.col("fold") == fold)
        counts = sorted({p.get("trees", FOREST["trees"]) for p in points})
        return {(shape, n): metrics(predictions(model.first(n), held)).first()["macro_f1"] for n in counts}

    with ThreadPoolExecutor(parallelism) as pool:
        found = list(pool.map(lambda unit: scores(*unit), itertools.product(shapes, range(folds))))
    results = []
    for p in points:
        key = tuple((k, v) for k, v in p.items() if k != "trees"), p.get("trees", FOREST["trees"])
        values = [f[key] for f in found if key in f]
        results.append((*p.values(), sum(values) / len(values)))
    best = max(range(len(points)), key=lambda i: results[i][-1])
    kinds = ", ".join(f"{name} int" for name in grid) + ", macro_f1 double"
    table = df.sparkSession.createDataFrame(results, kinds)
    return train_forest(df, **points[best], seed=seed), table.orderBy(F.col("macro_f1").desc(), *grid)


def feature_importance(model, spark: SparkSession, names: list[str] = FEATURES) -> DataFrame:
    """(feature, importance), largest first."""
    found = getattr(model, "featureImportances", None)
    if found is None:
        raise AttributeError("the model has no feature importances")
    values = found if hasattr(found, "shape") else found.toArray()
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")


def save_model(model: TreeModel, folder: str, spark: SparkSession, tuned: bool = False) -> str:
    """Store a model under its kind; returns the path."""
    path = f"{folder}/{BOOSTED_DIR if model.kind == 'boosted' else TUNED_DIR if tuned else FOREST_DIR}"
    model.save(spark, path)
    return path


def load_model(spark: SparkSession, path: str) -> TreeModel:
    """A stored model by path."""
    return TreeModel.load(spark, require(spark, path, "model"))


def load_best_model(spark: SparkSession, folder: str):
    """Boosted trees when stored, else the forest, else an error."""
    for kind in (BOOSTED_DIR, FOREST_DIR):
        if exists(spark, f"{folder}/{kind}"):
            return load_model(spark, f"{folder}/{kind}")
    raise FileNotFoundError(f"no trained model in {folder}; train and save one first")


def pca2(df: DataFrame, columns: list[str] = FEATURES, keep: list[str] = ()) -> tuple[DataFrame, list[float]]:
    """(rows with pc1 and pc2, explained-variance ratios) of the standardised columns."""
    scaler = fit_scaler(df, columns)
    z = F.array(*[(quoted(c) - F.lit(scaler.means[i])) / F.lit(scaler.stds[i]) for i, c in enumerate(columns)])
    vectors = df.select(*keep, array_to_vector(z).alias("v"))
    model = PCA(k=2, inputCol="v", outputCol="pc").fit(vectors)
    both = vector_to_array("pc")
    projected = model.transform(vectors).select(*keep, both[0].alias("pc1"), both[1].alias("pc2"))
    return projected, [float(v) for v in model.explainedVariance.toArray()]


def grid_points(grid: dict | None = None) -> list[dict]:
    """All parameter combinations of a grid."""
    grid = grid or GRID
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
