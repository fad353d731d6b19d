"""Connected components by repeated contraction, all in joins and partial aggregates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import written
from .common import mixed


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(vertex, root) for every vertex of ``edges``; vertices have equal roots exactly when they are connected.

    Each round points every vertex to the smallest scattered id among itself and its neighbours, replaces both ends of
    all edges by where they point, and drops loops and repeats. Scattered ids make the number of rounds logarithmic,
    also for long chains. The smallest neighbour is a partial aggregate, so a vertex with many edges is no hot key.
    """
    ends = edges.select(mixed(F.col(a)).alias("u"), mixed(F.col(b)).alias("v")).filter("u != v")
    both = ends.unionByName(ends.select(F.col("v").alias("u"), F.col("u").alias("v")))
    left = written(both.distinct())
    vertices = left.select("u").distinct()
    steps = []
    while not left.isEmpty():
        step = written(left.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("root")))
        steps.append(step)
        other = step.select(F.col("u").alias("v"), F.col("root").alias("other"))
        moved = left.join(step, "u").join(other, "v").filter("root != other")
        left = written(moved.select(F.col("root").alias("u"), F.col("other").alias("v")).distinct())
    known = vertices.select(F.col("u").alias("vertex"), F.col("u").alias("root"))
    for n, step in enumerate(steps, 1):
        known = _follow(known, step)
        if n % 4 == 0:  # a plan of many joins is too deep to compile
            known = written(known)
    return known


def _follow(known: DataFrame, step: DataFrame) -> DataFrame:
    onward = step.select(F.col("u").alias("root"), F.col("root").alias("next"))
    return known.join(onward, "root", "left").select("vertex", F.coalesce("next", "root").alias("root"))


def with_roots(rows: DataFrame, id_col: str, edges: DataFrame, a: str, b: str) -> DataFrame:
    """``rows`` with ``_root``: equal inside a component, and a value of its own for a row without edges."""
    found = components(edges, a, b).withColumnRenamed("vertex", "_vertex").withColumnRenamed("root", "_found")
    joined = rows.withColumn("_vertex", mixed(F.col(id_col))).join(found, "_vertex", "left")
    return joined.withColumn("_root", F.coalesce("_found", "_vertex")).drop("_vertex", "_found")
