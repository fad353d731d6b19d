"""Feature scaling and class weights."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import class_name
from ..schemas import CLIP
from .cleaning import quoted


@dataclass(frozen=True)
class Scaler:
    """Means and population standard deviations, in column order."""

    columns: list
    means: list
    stds: list

    def scaled(self, column: str) -> Column:
        i = self.columns.index(column)
        z = (quoted(column) - F.lit(self.means[i])) / F.lit(self.stds[i])
        return F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), z))

    def vector(self) -> Column:
        """All scaled values as one array, in column order."""
        return F.array(*[self.scaled(c) for c in self.columns])

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, c, m, s) for i, (c, m, s) in enumerate(zip(self.columns, self.means, self.stds))]
        spark.createDataFrame(rows, "position int, feature string, mean double, std double").coalesce(1).write.mode(
            "overwrite"
        ).parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Scaler":
        from ..sources.artifacts import require

        rows = spark.read.parquet(require(spark, path, "scaler")).orderBy("position").collect()
        return Scaler([r.feature for r in rows], [r["mean"] for r in rows], [r["std"] for r in rows])


def scaler_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, mean, std): one aggregate; a zero deviation counts as 1."""
    stats = [F.struct(F.lit(c).alias("feature"), F.avg(quoted(c)).alias("mean"),
                      F.stddev_pop(quoted(c)).alias("std")) for c in columns]
    row = df.agg(F.array(*stats).alias("s")).select(F.explode("s").alias("s")).select("s.*")
    return row.withColumn("std", F.when(F.col("std") > 0, F.col("std")).otherwise(1.0))


def fit_scaler(train: DataFrame, columns: list[str]) -> Scaler:
    """Fit on training rows only."""
    rows = {r.feature: r for r in scaler_stats(train, columns).collect()}
    return Scaler(list(columns), [float(rows[c]["mean"]) for c in columns], [float(rows[c]["std"]) for c in columns])


def scale_clip(df: DataFrame, scaler: Scaler | None) -> DataFrame:
    """Standardise and clip to ±5 in place."""
    if scaler is None:
        raise RuntimeError("the scaler is not fitted; call fit_scaler first")
    return df.withColumns({c: scaler.scaled(c) for c in scaler.columns})


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """(label, name, count) for integer class ids; an unknown id reads UNKNOWN(n)."""
    name = class_name(F.col("label"))
    shown = F.when(name.startswith("CLS_"), F.concat(F.lit("UNKNOWN("), F.col("label").cast("string"), F.lit(")"))).otherwise(name)
    return df.groupBy(quoted(label).alias("label")).agg(F.count("*").alias("count")).select("label", shown.alias("name"), "count")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, weight): n / (classes · rows of the class)."""
    counts = df.groupBy(quoted(label).alias("label")).agg(F.count("*").alias("n"))
    totals = counts.agg(F.sum("n").alias("rows"), F.count("*").alias("classes"))
    return counts.crossJoin(F.broadcast(totals)).select(
        "label", (F.col("rows") / (F.col("classes") * F.col("n"))).alias("weight")
    )


def with_weights(df: DataFrame, label: str, column: str = "weight") -> DataFrame:
    """Add each row's class weight. Classes are few; their table is broadcast after a check."""
    from ..storage import lookup

    table = class_weights(df, label).select(F.col("label").alias(label), F.col("weight").alias(column))
    return lookup(df, table, [label])


def oversampling_plan(df: DataFrame, label: str, k: int, target: int | None = None) -> DataFrame:
    """(label, have, want, eligible): rows each class is raised to.

    Every class other than the largest rises to the largest one's size, or to
    ``target``; a class with fewer than k + 1 rows is not eligible and stays.
    """
    counts = df.groupBy(quoted(label).alias("label")).agg(F.count("*").alias("have"))
    top = counts.agg(F.max("have").alias("_top"))
    goal = F.col("_top") if target is None else F.lit(target).cast("long")
    eligible = F.col("have") >= k + 1
    return counts.crossJoin(F.broadcast(top)).select(
        "label", "have", F.when(eligible, F.greatest("have", goal)).otherwise(F.col("have")).alias("want"),
        eligible.alias("eligible"),
    )
