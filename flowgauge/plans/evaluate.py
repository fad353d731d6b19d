"""Classifier evaluation from a prediction table (y, p, scores)."""

import time

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.columns import class_name
from ..schemas import CLASS_IDS
from ..storage import lookup, written

LEAST_RANGES = 256
RANGE_ROWS = 250_000


def confusion_counts(pred: DataFrame, by: list[str] = ()) -> DataFrame:
    """(by, y, p, n): every later figure is a roll-up of this small table."""
    return pred.groupBy(*by, "y", "p").agg(F.count("*").alias("n"))


def class_report(pred: DataFrame, by: list[str] = ()) -> DataFrame:
    """(by, class, name, precision, recall, f1, support) over classes seen in truth or prediction."""
    by = list(by)
    cells = confusion_counts(pred, by)
    sides = F.array(
        F.struct(F.col("y").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("guessed"),
                 F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hits")),
        F.struct(F.col("p").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("guessed"),
                 F.lit(0).cast("long").alias("hits")),
    )
    sums = cells.select(*by, F.explode(sides).alias("s")).groupBy(*by, "s.class").agg(
        F.sum("s.support").alias("support"), F.sum("s.guessed").alias("guessed"), F.sum("s.hits").alias("hits"))

    def share(part, whole):
        return F.when(whole > 0, part / whole).otherwise(0.0)

    precision, recall = share(F.col("hits"), F.col("guessed")), share(F.col("hits"), F.col("support"))
    f1 = share(2.0 * F.col("hits"), F.col("support") + F.col("guessed"))
    return sums.select(*by, "class", class_name(F.col("class")).alias("name"), precision.alias("precision"),
                       recall.alias("recall"), f1.alias("f1"), "support")


def report_averages(pred: DataFrame) -> DataFrame:
    """(average, precision, recall, f1, support): macro and support-weighted rows."""
    report = class_report(pred)

    def row(name, mean):
        return report.agg(F.lit(name).alias("average"), *[mean(c).alias(c) for c in ("precision", "recall", "f1")],
                          F.sum("support").alias("support"))

    weighted = row("weighted", lambda c: F.sum(F.col(c) * F.col("support")) / F.sum("support"))
    return row("macro", F.avg).unionByName(weighted)


def metrics(pred: DataFrame, by: list[str] = ()) -> DataFrame:
    """(by, accuracy, macro_f1, weighted_f1, fpr_benign)."""
    by = list(by)
    benign = CLASS_IDS["Normal Traffic"]
    cells = confusion_counts(pred, by)
    hits = F.sum(F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0))
    of_benign = F.sum(F.when(F.col("y") == benign, F.col("n")).otherwise(0))
    false_alarms = F.sum(F.when((F.col("y") == benign) & (F.col("p") != benign), F.col("n")).otherwise(0))
    simple = cells.groupBy(*by).agg(
        (hits / F.sum("n")).alias("accuracy"), F.when(of_benign > 0, false_alarms / of_benign).otherwise(0.0).alias("fpr_benign"))
    f1s = class_report(pred, by).groupBy(*by).agg(
        F.avg("f1").alias("macro_f1"), (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"))
    joined = simple.join(f1s, by) if by else simple.crossJoin(f1s)
    return joined.select(*by, "accuracy", "macro_f1", "weighted_f1", "fpr_benign")


def benign_fpr(pred: DataFrame) -> DataFrame:
    """Share of benign rows that were called an attack."""
    return metrics(pred).select("fpr_benign")


def confusion(pred: DataFrame, normalize: bool = False) -> DataFrame:
    """(y, name, p, value) for classes of the truth; rows sum to 1 when normalised."""
    cells = confusion_counts(pred)
    labels = cells.select("y").distinct()
    inside = cells.join(F.broadcast(labels.withColumnRenamed("y", "p")), "p", "left_semi")
    grid = labels.crossJoin(labels.withColumnRenamed("y", "p"))
    full = grid.join(inside, ["y", "p"], "left").select("y", class_name(F.col("y")).alias("name"), "p", F.coalesce("n", F.lit(0)).alias("n"))
    if not normalize:
        return full.withColumnRenamed("n", "value")
    total = F.greatest(F.sum("n").over(Window.partitionBy("y")), F.lit(1))
    return full.select("y", "name", "p", (F.col("n") / total).alias("value"))


def running_totals(cells: DataFrame, group: str, order: str, columns: list[str], buckets: int | None = None) -> DataFrame:
    """Add ``upto_<c>``: totals over rows of the group with a higher or equal ``order``.

    Rows are spread over value ranges of roughly equal row count, more of them
    the more rows there are; ranges are summed first and each range adds the
    totals of the ranges above it, so a group never runs through one task.
    """
    cells = written(cells)
    if buckets is None:
        buckets = max(LEAST_RANGES, -(-cells.count() // RANGE_ROWS))
    spots = cells.agg(F.percentile_approx(F.col(order), [i / buckets for i in range(1, buckets)], max(10_000, 4 * buckets)).alias("q")).first()["q"]
    splits = [-float("inf"), *sorted(set(spots or [0.0])), float("inf")]
    placed = Bucketizer(splits=splits, inputCol=order, outputCol="_range").transform(cells)
    totals = placed.groupBy(group, "_range").agg(*[F.sum(c).alias(f"_{c}") for c in columns])
    above = Window.partitionBy(group).orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(group, "_range", *[F.coalesce(F.sum(f"_{c}").over(above), F.lit(0)).alias(f"_{c}") for c in columns])
    inside = Window.partitionBy(group, "_range").orderBy(F.col(order).desc())
    joined = lookup(placed, written(offsets), [group, "_range"], "inner")
    return joined.withColumns({
        f"upto_{c}": F.col(f"_{c}") + F.sum(c).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        for c in columns
    }).drop("_range", *[f"_{c}" for c in columns])


def score_cells(pred: DataFrame) -> DataFrame:
    """(class, score, pos, neg): one row per class and distinct score, classes of the truth only."""
    labels = pred.select(F.col("y").alias("class")).distinct()
    tall = pred.select("y", F.posexplode("scores").alias("class", "score"))
    cells = tall.groupBy("class", "score").agg(
        F.count_if(F.col("y") == F.col("class")).alias("pos"), F.count_if(F.col("y") != F.col("class")).alias("neg"))
    return cells.join(F.broadcast(labels), "class", "left_semi")


def roc_points(pred: DataFrame) -> DataFrame:
    """(class, score, fpr, tpr): the one-vs-rest curve from (0, 0), at score Infinity, through every distinct score."""
    cells = score_cells(pred)
    totals = cells.groupBy("class").agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    run = running_totals(cells, "class", "score", ["pos", "neg"])
    joined = run.join(F.broadcast(totals), "class")
    points = joined.select("class", "score", F.try_divide("upto_neg", "all_neg").alias("fpr"),
                           F.try_divide("upto_pos", "all_pos").alias("tpr"))
    start = totals.select("class", F.lit(float("inf")).alias("score"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(start)


def auc_per_class(pred: DataFrame) -> DataFrame:
    """(class, name, auc): ties count half; NULL when the truth holds only one side."""
    run = running_totals(score_cells(pred), "class", "score", ["pos", "neg"])
    # Each negative counts the positives above it, and half of those at its score.
    pairs = F.col("neg") * (F.col("upto_pos") - F.col("pos") / 2.0)
    found = run.groupBy("class").agg(F.sum(pairs).alias("won"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return found.select("class", class_name(F.col("class")).alias("name"),
                        F.try_divide(F.col("won"), F.col("p").cast("double") * F.col("n")).alias("auc"))


def mean_auc(pred: DataFrame) -> DataFrame:
    return auc_per_class(pred).agg(F.avg("auc").alias("mean_auc"))


def compare_models(predictions: dict[str, DataFrame]) -> DataFrame:
    """(model, accuracy, macro_f1, weighted_f1, fpr_benign), best macro F1 first."""
    tagged = None
    for name, pred in predictions.items():
        part = pred.select(F.lit(name).alias("model"), "y", "p")
        tagged = part if tagged is None else tagged.unionByName(part)
    return metrics(tagged, ["model"]).orderBy(F.col("macro_f1").desc(), "model")


def score_throughput(scored: DataFrame) -> DataFrame:
    """rows, seconds and milliseconds per row of a whole scoring job that writes nowhere."""
    spark, seen = scored.sparkSession, Observation()
    start = time.perf_counter()
    scored.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    seconds, rows = time.perf_counter() - start, seen.get["rows"]
    return spark.createDataFrame([(rows, seconds, 1000 * seconds / rows if rows else 0.0)], "rows long, seconds double, ms_per_row double")


def summary(pred: DataFrame) -> DataFrame:
    """One line: accuracy, F1 averages, benign false-positive rate, mean AUC."""
    return metrics(pred).crossJoin(mean_auc(pred))
