"""Bounded samples of labelled documents for fitting classifiers."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold


def labelled_sample(labels: DataFrame, label: str, most: int, held_out: int = 0, id_col: str = "doc_id",
                    value: int | None = None) -> DataFrame:
    """At most ``most`` rows (doc_id, y) outside the held-out fold, those with the smallest hashed ids.

    Rows without a label or an id are left out. ``value`` keeps the rows of one label only.
    """
    rows = labels.select(F.col(id_col).alias("doc_id"), F.col(label).cast("int").alias("y"))
    rows = rows.filter("doc_id IS NOT NULL AND y IS NOT NULL").filter(fold("doc_id") != held_out)
    if value is not None:
        rows = rows.filter(F.col("y") == value)
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(most)


def with_texts(sample: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, y, text) of a bounded sample; the sample, not the texts, goes to every task."""
    found = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return found.join(F.broadcast(sample), "doc_id")
