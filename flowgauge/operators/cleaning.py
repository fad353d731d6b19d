"""Cleaning, label handling and feature selection for flow tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import class_id
from ..schemas import BENIGN, FEATURES, LABEL, RAW_LABEL, RAW_LABEL_GROUPS
from ..storage import literal_map

FLOATS = ("double", "float")


def quoted(name: str) -> Column:
    """Column by its exact name, dots and slashes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def strip_columns(df: DataFrame) -> DataFrame:
    """Trim column names; a repeated name gets a numeric suffix."""
    seen, names = {}, []
    for name in (c.strip() for c in df.columns):
        n = seen.get(name, 0)
        seen[name] = n + 1
        names.append(f"{name}.{n}" if n else name)
    return df.toDF(*names)


def regroup_labels(df: DataFrame) -> DataFrame:
    """Replace the raw label by its class; an unlisted label passes through."""
    if RAW_LABEL not in df.columns or LABEL in df.columns:
        return df
    grouped = F.try_element_at(literal_map(RAW_LABEL_GROUPS), F.col(RAW_LABEL))
    return df.withColumn(LABEL, F.coalesce(grouped, F.col(RAW_LABEL))).drop(RAW_LABEL)


def inf_to_null(df: DataFrame) -> DataFrame:
    """±Infinity becomes NULL in every floating column."""
    inf = float("inf")
    return df.select(*[
        F.when(~quoted(c).isin(inf, -inf), quoted(c)).alias(c) if t in FLOATS else quoted(c)
        for c, t in df.dtypes
    ])


def _missing(df: DataFrame, columns=None) -> Column:
    kinds = dict(df.dtypes)
    found = F.lit(False)
    for c in columns or df.columns:
        col = quoted(c)
        found = found | (col.isNull() | F.isnan(col) if kinds[c] in FLOATS else col.isNull())
    return found


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows with any NULL or NaN."""
    return df.filter(~_missing(df))


def dedup(df: DataFrame, order: str | None = None) -> DataFrame:
    """Drop exact copies. With ``order`` the first copy's order value is kept.

    Copies combine before the shuffle, so a row repeated very often costs one
    row per task.
    """
    if order is None:
        return df.dropDuplicates()
    keys = [c for c in df.columns if c != order]
    kept = df.groupBy(*[quoted(c) for c in keys]).agg(F.min(quoted(order)).alias(order))
    return kept.select(*[quoted(c) for c in df.columns])


def clean(df: DataFrame, order: str | None = None) -> DataFrame:
    """Names trimmed, labels grouped, then incomplete rows and copies dropped."""
    return dedup(drop_incomplete(inf_to_null(regroup_labels(strip_columns(df)))), order)


def clean_report(df: DataFrame) -> DataFrame:
    """rows_in, incomplete, duplicates, rows_out in one grouping."""
    tidy = inf_to_null(df)
    grouped = tidy.groupBy(*[quoted(c) for c in tidy.columns]).agg(F.count("*").alias("_n"))
    flagged = grouped.select("_n", _missing(tidy).alias("_bad"))
    total, bad = F.sum("_n"), F.sum(F.when(F.col("_bad"), F.col("_n")).otherwise(0))
    out = F.count_if(~F.col("_bad"))
    counts = flagged.agg(
        F.coalesce(total, F.lit(0)).alias("rows_in"), F.coalesce(bad, F.lit(0)).alias("incomplete"), out.alias("rows_out"),
    )
    return counts.select(
        "rows_in", "incomplete", (F.col("rows_in") - F.col("incomplete") - F.col("rows_out")).alias("duplicates"), "rows_out",
    )


def label_counts(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows per label, most frequent first, ties by label."""
    return df.groupBy(quoted(label).alias("label")).agg(F.count("*").alias("count")).orderBy(F.col("count").desc(), "label")


def encode_labels(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Class names become ids; rows with unknown names are dropped."""
    return df.withColumn(label, class_id(quoted(label))).filter(quoted(label).isNotNull())


def unknown_labels(df: DataFrame, label: str = LABEL) -> DataFrame:
    """The labels that encoding drops, with their row counts."""
    return df.filter(class_id(quoted(label)).isNull()).groupBy(quoted(label).alias("label")).agg(F.count("*").alias("count"))


def coerce_label(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Valid integer labels from names or from values that are integers already."""
    if dict(df.dtypes)[label] == "string":
        return encode_labels(df, label)
    return df.filter(quoted(label).isNotNull()).withColumn(label, quoted(label).cast("int"))


def traffic_kind(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Add ``Traffic``: Normal or Attack."""
    return df.withColumn("Traffic", F.when(quoted(label) == BENIGN, "Normal").otherwise("Attack"))


def missing_features(df: DataFrame) -> list[str]:
    """Feature names the table lacks, sorted."""
    return sorted(set(FEATURES) - set(df.columns))


def select_features(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    """``keep`` columns and the twenty features in model order; an absent feature is 0.0."""
    have = set(df.columns)
    return df.select(*keep, *[quoted(f) if f in have else F.lit(0.0).alias(f) for f in FEATURES])
