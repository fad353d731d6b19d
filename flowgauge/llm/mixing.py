"""Mixing sources to target weights, in DataFrame functions only.

Every document gets a hash-random key. The key range of a source is cut into as many equal cells as the square root
of the row count; cell totals are summed up per source, rows are summed up inside their cell, so a prefix sum never
needs a source in one task. A source is cut at its exact word budget, after whole epochs where the budget is larger
than the source.
"""

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import written
from .common import WORD, quoted

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2
SEED = "mix-1:"


def words(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    cells = max(1, math.isqrt(docs.count()))
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    start = F.conv(F.substring("_mix_key", 1, 8), 16, 10).cast("long")
    return (docs.withColumn("_mix_size", words(F.col(text_col)))
            .withColumn("_mix_key", key)
            .withColumn("_mix_name", F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit("")))
            .withColumn("_mix_cell", F.shiftright(start * F.lit(cells), 32)))


def source_targets(sources: DataFrame, share: float = SHARE, weights: Sequence[int] = WEIGHTS,
                   most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """(name, source_size) with weights by code-point order, missing source last, and targets.

    ``share`` of all words is split by weight; what a source gets beyond ``most_epochs`` times its size is shared again by
    weight among the others, until none is above. One row per source is ranked; each round reads two sums.
    """
    order = Window.orderBy((F.col("name") == "").asc(), "name")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    ranked = written(sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(most_epochs)))
    goal = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, full = -1.0, F.lit(False)
    while True:
        held, open_weight = ranked.agg(F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("weight")))).first()
        risen = (goal - (held or 0)) / open_weight if open_weight else level
        if risen <= level:
            break
        level = risen
        full = F.col("cap") <= F.lit(level) * F.col("weight")
    target = F.least(F.col("cap").cast("double"), F.lit(max(level, 0.0)) * F.col("weight"))
    return ranked.select("name", "source_size", target.alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        share: float = SHARE, weights: Sequence[int] = WEIGHTS, most_epochs: int = MOST_EPOCHS,
        seed: str = SEED) -> DataFrame:
    """``docs`` with ``_mix_size``, ``_mix_source_size``, ``_mix_target`` and ``_mix_taken`` (words taken, repeats counted).

    Words taken of a source sum to the whole part of its target. Null texts and texts without words have size 0 and
    nothing taken; a null source is a source of its own; rows with equal ids are ordered by size and, where that ties
    too, are interchangeable. An empty table stays empty. Other columns, also those called ``size`` or ``target``, are kept.
    """
    rows = _keyed(docs, id_col, text_col, source_col, seed)
    cells = written(rows.groupBy("_mix_name", "_mix_cell").agg(F.sum("_mix_size").alias("n")))
    sources = cells.groupBy(F.col("_mix_name").alias("name")).agg(F.sum("n").alias("source_size"))
    targets = source_targets(sources, share, weights, most_epochs)
    earlier = Window.partitionBy("_mix_name").orderBy("_mix_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.withColumn("_mix_offset", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n").join(
        targets.select(F.col("name").alias("_mix_name"), F.col("source_size").alias("_mix_source_size"),
                       F.col("target").alias("_mix_target")), "_mix_name")
    inside = Window.partitionBy("_mix_name", "_mix_cell").orderBy("_mix_key", id_col, "_mix_size")
    before = F.coalesce(F.sum("_mix_size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.withColumn("_mix_before", before).join(written(offsets), ["_mix_name", "_mix_cell"])
    goal = F.floor("_mix_target")
    whole = F.expr("CASE WHEN _mix_source_size > 0 THEN floor(_mix_target) DIV _mix_source_size ELSE 0L END")
    rest = goal - whole * F.col("_mix_source_size") - F.col("_mix_offset") - F.col("_mix_before")
    part = F.greatest(F.lit(0), F.least(F.col("_mix_size"), rest))
    taken = (whole * F.col("_mix_size") + part).cast("long")
    return placed.withColumn("_mix_taken", taken).drop("_mix_name", "_mix_cell", "_mix_key", "_mix_offset", "_mix_before")


def mixed_documents(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The mix itself: every document as often as it is taken whole, and once cut to the words taken beyond that.

    A cut text keeps its first words, joined by single spaces; ``n_chars``, where there is one, is counted again.
    """
    columns = docs.columns
    size, taken = F.col("_mix_size"), F.col("_mix_taken")
    left = F.expr("CASE WHEN _mix_size > 0 THEN _mix_taken % _mix_size ELSE 0L END").cast("int")
    copies = F.expr("CASE WHEN _mix_size > 0 THEN cast(_mix_taken DIV _mix_size AS int) ELSE 0 END")
    parts = F.concat(F.array_repeat(F.lit(-1), copies), F.array_repeat(left, (left > 0).cast("int")))
    rows = mix(docs, text_col=text_col, **options).filter(taken > 0).withColumn("_mix_part", F.explode(parts))
    head = F.array_join(F.slice(F.regexp_extract_all(F.col(text_col), F.lit(f"({WORD})")), 1, F.greatest(
        F.col("_mix_part"), F.lit(0))), " ")
    cut = F.col("_mix_part") >= 0
    changed = {text_col: F.when(cut, head).otherwise(F.col(text_col))}
    if "n_chars" in columns:
        changed["n_chars"] = F.when(cut, F.length(head).cast("long")).otherwise(F.col("n_chars"))
    return rows.withColumns(changed).select(*[quoted(c) for c in columns])
