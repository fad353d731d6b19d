"""Exact dedup by skew-safe combining.

Equal texts are merged three times, each time on digest *and* full content: inside every task (the partial
aggregate), inside salted digest groups, and over the winners of all salts. A text with a million copies thus
reaches the last merge as one row per salt.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import written
from .common import SPACE, quoted, texts

SALTS = 16


def normalised(text: Column) -> Column:
    """Every run of white space as one space."""
    return F.regexp_replace(text, SPACE, " ")


def sha256(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def _rows(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    rows = texts(docs, id_col, text_col).select("doc_id", normalised(F.col("text")).alias("content"))
    return rows.withColumn("digest", digest(F.col("content")))


def equal_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
                digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per distinct text: (digest, content, keep_id, group_size).

    ``keep_id`` is the smallest id; null ids count last. Null texts equal empty ones.
    """
    rows = _rows(docs, id_col, text_col, digest).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
    salted = rows.groupBy("digest", "salt", "content").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("n"))
    return salted.groupBy("digest", "content").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
                digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Each document with the one that stays: (doc_id, keep_id, group_size, kept, digest).

    Rows that repeat id and text are one document and carry the same flag. A group whose ids are all null keeps the
    null id. An empty table gives an empty one; other columns of ``docs`` are not read. Contents that share a digest
    (never seen with SHA-256) are told apart by joining on the content itself.
    """
    groups = written(equal_texts(docs, id_col, text_col, salts, digest).groupBy("digest").agg(
        F.count("*").alias("contents"), F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")))
    rows = _rows(docs, id_col, text_col, digest)
    sure = groups.filter("contents = 1").drop("contents")
    marked = rows.select("doc_id", "digest").join(sure, "digest")
    clashing = groups.filter("contents > 1").select("digest")
    if not clashing.isEmpty():
        shared = equal_texts(docs, id_col, text_col, salts, digest).join(clashing, "digest", "left_semi")
        marked = marked.unionByName(rows.join(shared, ["digest", "content"]).drop("content"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return marked.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "digest")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """``docs`` with one row per distinct text, all its columns unchanged whatever their names."""
    def named(id_: Column, digest: Column) -> Column:
        return F.concat(F.coalesce(F.concat(F.lit("="), id_.cast("string")), F.lit("")), F.lit(":"), digest)

    keep = equal_texts(docs, id_col, text_col, salts).select(named(F.col("keep_id"), F.col("digest")).alias("keep"))
    digest = sha256(normalised(F.coalesce(quoted(text_col), F.lit(""))))
    # Id and digest in one key: copies that go match nothing, whole rows move once, and the window reuses the join's order.
    rows = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("row"), named(quoted(id_col), digest).alias("keep"))
    # What is left repeats only where rows share id and text; any one of those stays.
    one = Window.partitionBy("keep").orderBy("keep")
    return rows.join(keep, "keep").withColumn("n", F.row_number().over(one)).filter("n = 1").select("row.*")
