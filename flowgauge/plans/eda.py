"""Profiles of a labelled flow table."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.cleaning import FLOATS, inf_to_null, quoted, traffic_kind
from ..operators.ranks import exact_quantiles, without_nan
from ..operators.sampling import sample_per_class
from ..schemas import BOX_FEATURES, FEATURES, LABEL, MEDIAN_FEATURES, VIOLIN_FEATURES

NUMERIC = ("double", "float", "int", "bigint", "smallint", "tinyint")


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in NUMERIC or t.startswith("decimal")]


def _one_row_each(df: DataFrame, columns: list[str], **makers) -> DataFrame:
    """One aggregate over ``df``, unfolded to a row per column."""
    row = df.agg(F.array(*[
        F.struct(F.lit(c).alias("feature"), *[make(quoted(c)).alias(name) for name, make in makers.items()]) for c in columns
    ]).alias("rows"))
    return row.select(F.explode("rows").alias("r")).select("r.*")


def overview(df: DataFrame, label: str = LABEL) -> DataFrame:
    """rows, columns, numeric_columns, other_columns, classes."""
    numeric = len(numeric_columns(df))
    return df.agg(F.count("*").alias("rows"), F.count_distinct(quoted(label)).alias("classes")).select(
        "rows", F.lit(len(df.columns)).alias("columns"), F.lit(numeric).alias("numeric_columns"),
        F.lit(len(df.columns) - numeric).alias("other_columns"), "classes",
    )


def type_counts(df: DataFrame) -> DataFrame:
    """(type, columns, filled): columns of each type and their cells that hold a value."""
    by_type = {t: [c for c, kind in df.dtypes if kind == t] for t in sorted({t for _, t in df.dtypes})}
    row = df.agg(F.array(*[
        F.struct(F.lit(t).alias("type"), F.lit(len(cs)).alias("columns"),
                 F.sum(sum(quoted(c).isNotNull().cast("int") for c in cs)).alias("filled"))
        for t, cs in by_type.items()
    ]).alias("rows"))
    return row.select(F.explode("rows").alias("r")).select("r.*")


def describe_features(df: DataFrame, columns: list[str] = FEATURES, places: int = 2) -> DataFrame:
    """(feature, mean, std, min, median, max); std is the sample deviation."""
    tidy = without_nan(df, columns)
    basic = _one_row_each(tidy, columns, mean=F.avg, std=F.stddev_samp, min=F.min, max=F.max)
    medians = exact_quantiles(tidy, [], columns, [0.5]).select("feature", F.col("q")[0].alias("median"))
    joined = basic.join(F.broadcast(medians), "feature")
    return joined.select("feature", *[F.round(c, places).alias(c) for c in ("mean", "std", "min", "median", "max")])


def class_share(df: DataFrame, label: str = LABEL) -> DataFrame:
    """(label, count, pct, ratio): share in percent, and ratio to the smallest class."""
    counts = df.groupBy(quoted(label).alias("label")).agg(F.count("*").alias("count"))
    totals = counts.agg(F.sum("count").alias("_all"), F.min("count").alias("_least"))
    return counts.crossJoin(F.broadcast(totals)).select(
        "label", "count", F.round(F.col("count") / F.col("_all") * 100, 2).alias("pct"),
        F.round(F.col("count") / F.col("_least"), 1).alias("ratio"),
    )


def imbalance(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Largest class over smallest class."""
    counts = df.groupBy(quoted(label)).agg(F.count("*").alias("n"))
    return counts.agg((F.max("n") / F.min("n")).alias("imbalance"))


def quality_audit(df: DataFrame) -> DataFrame:
    """missing cells, infinite cells, duplicate rows and their percentage.

    Equal rows combine before the shuffle; cell counts ride along with them.
    """
    floats = [c for c, t in df.dtypes if t in FLOATS]
    inf = float("inf")
    missing = sum(((quoted(c).isNull() | F.isnan(quoted(c))) if c in floats else quoted(c).isNull()).cast("int") for c in df.columns)
    infinite = sum((F.coalesce(quoted(c).isin(inf, -inf), F.lit(False)).cast("int") for c in floats), F.lit(0))
    grouped = df.groupBy(*[quoted(c) for c in df.columns]).agg(F.count("*").alias("_n"))
    cells = grouped.select("_n", (missing * F.col("_n")).alias("m"), (infinite * F.col("_n")).alias("i"))
    found = cells.agg(F.sum("m").alias("missing"), F.sum("i").alias("infinite"), F.sum("_n").alias("rows"), F.count("*").alias("kept"))
    dupes = F.col("rows") - F.col("kept")
    return found.select("missing", "infinite", dupes.alias("duplicates"), F.round(dupes / F.col("rows") * 100, 3).alias("duplicate_pct"))


def outlier_rates(df: DataFrame, columns: list[str] = FEATURES, sigmas: float = 5.0, n: int = 15) -> DataFrame:
    """(feature, rate): share of rows beyond ``sigmas`` sample deviations; the highest ``n`` above zero."""
    tidy = without_nan(df, columns)
    stats = {r.feature: r for r in _one_row_each(tidy, columns, mean=F.avg, std=F.stddev_samp).collect()}

    def rate(c):
        s = stats[c]
        if not s["std"]:
            return F.lit(0.0)
        beyond = F.abs((quoted(c) - F.lit(s["mean"])) / F.lit(s["std"])) > sigmas
        return F.count_if(beyond) / F.count("*")

    row = tidy.agg(F.array(*[F.struct(F.lit(c).alias("feature"), rate(c).alias("rate")) for c in columns]).alias("rows"))
    found = row.select(F.explode("rows").alias("r")).select("r.*").filter("rate > 0")
    return found.orderBy(F.col("rate").desc(), "feature").limit(n)


def clipped_histogram(df: DataFrame, column: str, bins: int = 60, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """(bin, lower, count): equal bins over the values clipped to two quantiles."""
    tidy = inf_to_null(df.select(quoted(column).alias("v")))
    values = tidy.filter(F.col("v").isNotNull() & ~F.isnan(F.col("v").cast("double")))
    found = exact_quantiles(values, [], ["v"], [low, high]).first()
    if found is None or found["q"] is None:
        return values.sparkSession.createDataFrame([], "bin int, lower double, count bigint")
    lo, hi = found["q"]
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    v = F.greatest(F.lit(lo), F.least(F.lit(hi), F.col("v")))
    spot = F.least(F.lit(bins - 1), F.floor((v - lo) / ((hi - lo) / bins))).cast("int")
    counted = values.groupBy(spot.alias("bin")).agg(F.count("*").alias("count"))
    every = values.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(F.broadcast(counted), "bin", "left").select(
        "bin", (F.lit(lo) + F.col("bin") * F.lit((hi - lo) / bins)).alias("lower"), F.coalesce("count", F.lit(0)).alias("count")
    )


def class_medians(df: DataFrame, columns: list[str] = MEDIAN_FEATURES, label: str = LABEL, places: int = 2) -> DataFrame:
    """(label, feature, median)."""
    renamed = df.select(quoted(label).alias("label"), *[quoted(c) for c in columns])
    found = exact_quantiles(renamed, ["label"], columns, [0.5])
    return found.select("label", "feature", F.round(F.col("q")[0], places).alias("median"))


def scaled_medians(df: DataFrame, columns: list[str] = MEDIAN_FEATURES, label: str = LABEL) -> DataFrame:
    """Class medians scaled to [0, 1] within each feature."""
    per = Window.partitionBy("feature")
    lo, hi = F.min("median").over(per), F.max("median").over(per)
    return class_medians(df, columns, label).withColumn("scaled", (F.col("median") - lo) / (hi - lo + F.lit(1e-9)))


def correlations(df: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    """(feature_a, feature_b, r) for every ordered pair; a pair skips rows where either is missing.

    Each task sums the products of its Arrow batches and sends on one row per
    pair. Values are taken relative to their mean, so sums keep their digits.
    """
    tidy = without_nan(df.select(*[quoted(c) for c in columns]), columns)
    means = tidy.agg(*[F.avg(quoted(c)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    moved = tidy.select(*[(quoted(c) - F.lit(means[i] or 0.0)).alias(f"c{i}") for i, c in enumerate(columns)])
    width = len(columns)
    upper = np.triu_indices(width)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, width, width))
        for batch in batches:
            x = np.column_stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in batch.columns])
            here = ~np.isnan(x)
            x, here = np.where(here, x, 0.0), here.astype(float)
            total += np.stack([here.T @ here, x.T @ here, here.T @ x, (x * x).T @ here, here.T @ (x * x), x.T @ x])
        cells = [pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32())]
        yield pa.RecordBatch.from_arrays(cells + [pa.array(t[upper]) for t in total], names=["a", "b", *parts])

    parts = ["n", "sa", "sb", "saa", "sbb", "sab"]
    summed = moved.mapInArrow(sums, "a int, b int, " + ", ".join(f"{p} double" for p in parts))
    summed = summed.groupBy("a", "b").agg(*[F.sum(p).alias(p) for p in parts])
    spread = F.sqrt((F.col("saa") - F.col("sa") * F.col("sa") / F.col("n")) * (F.col("sbb") - F.col("sb") * F.col("sb") / F.col("n")))
    r = F.when((F.col("n") > 1) & (spread > 0), (F.col("sab") - F.col("sa") * F.col("sb") / F.col("n")) / spread)
    found = summed.filter("n > 0").select("a", "b", r.alias("r"))
    names = F.array(*[F.lit(c) for c in columns])

    def row(x, y):
        return F.struct(F.element_at(names, F.col(x) + 1).alias("feature_a"), F.element_at(names, F.col(y) + 1).alias("feature_b"), "r")

    both = F.when(F.col("a") == F.col("b"), F.array(row("a", "b"))).otherwise(F.array(row("a", "b"), row("b", "a")))
    return found.select(F.explode(both).alias("p")).select("p.*")


def high_correlations(df: DataFrame, columns: list[str] = FEATURES, threshold: float = 0.90) -> DataFrame:
    """Pairs below the diagonal with an absolute correlation over the threshold, strongest first."""
    place = F.create_map(*[F.lit(x) for i, c in enumerate(columns) for x in (c, i)])
    below = F.element_at(place, F.col("feature_a")) > F.element_at(place, F.col("feature_b"))
    found = correlations(df, columns).filter(below & (F.abs("r") > threshold))
    return found.orderBy(F.abs("r").desc(), "feature_a", "feature_b")


def box_stats(df: DataFrame, columns: list[str] = BOX_FEATURES, label: str = LABEL) -> DataFrame:
    """(Traffic, feature, q1, median, q3, whisker_low, whisker_high), fliers left out."""
    kinds = traffic_kind(df, label).select("Traffic", *[quoted(c) for c in columns])
    tidy = without_nan(kinds, columns)
    quartiles = exact_quantiles(tidy, ["Traffic"], columns, [0.25, 0.5, 0.75]).select(
        "Traffic", "feature", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), quoted(c).cast("double").alias("value")) for c in columns])
    tall = tidy.select("Traffic", F.explode(pairs).alias("r")).select("Traffic", "r.feature", "r.value")
    # Two kinds times a few features: the quartile table is tiny by construction.
    placed = tall.join(F.broadcast(quartiles), ["Traffic", "feature"])
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = placed.filter((F.col("value") >= F.col("q1") - reach) & (F.col("value") <= F.col("q3") + reach))
    return inside.groupBy("Traffic", "feature", "q1", "median", "q3").agg(
        F.min("value").alias("whisker_low"), F.max("value").alias("whisker_high"))


def class_quartiles(df: DataFrame, order: list[str], columns: list[str] = VIOLIN_FEATURES, label: str = LABEL,
                    per_class: int | None = None) -> DataFrame:
    """(feature, label, q1, median, q3, position); classes ordered by median. ``per_class`` caps the rows of a class first."""
    sampled = sample_per_class(df, label, per_class, order) if per_class else df
    renamed = sampled.select(quoted(label).alias("label"), *[quoted(c) for c in columns])
    found = exact_quantiles(renamed, ["label"], columns, [0.25, 0.5, 0.75]).select(
        "feature", "label", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    rank = F.row_number().over(Window.partitionBy("feature").orderBy("median", "label"))
    return found.withColumn("position", rank)
