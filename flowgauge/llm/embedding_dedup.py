"""Embedding near-dedup: cross-polytope hashing after fast Hadamard rotations, probed buckets, verified pairs.

A table rotates a vector with two times three rounds of random signs and a Hadamard transform; the nearest signed axes
of the two rotations are its bucket. A vector is filed in its ``probes`` nearest buckets, and two vectors are compared
where they share one; only pairs whose cosine reaches the threshold in double precision count. Equal vectors are merged
first. A bucket above ``tile`` vectors is cut into parts, and each pair of parts is a unit of work of its own.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import lookup, written
from .components import with_roots

THRESHOLD = 0.9
TABLES = 6
PROBES = 4
TILE = 1024
SEED = 20
NAMED_ROWS = 50_000
HOT_ROWS = 100_000
CHOICES = ((0, 0), (1, 0), (0, 1), (2, 0), (0, 2), (1, 1), (3, 0), (0, 3))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal Walsh-Hadamard transform of each row; the width is a power of two."""
    n, d = x.shape
    half = 1
    while half < d:
        x = x.reshape(n, d // (2 * half), 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        half *= 2
    return x.reshape(n, d) / np.sqrt(d)


def bucket_codes(unit: np.ndarray, tables: int = TABLES, probes: int = PROBES, seed: int = SEED) -> np.ndarray:
    """(rows, tables, probes) bucket numbers of unit vectors, nearest bucket first."""
    n, dim = unit.shape
    d = max(4, 1 << (dim - 1).bit_length())
    padded = np.zeros((n, d))
    padded[:, :dim] = unit
    signs = np.random.default_rng([seed, dim]).choice([-1.0, 1.0], size=(tables, 2, 3, d))
    codes = np.empty((n, tables, probes), np.int32)
    for t in range(tables):
        axes, losses = [], []
        for half in range(2):
            turned = padded
            for flips in signs[t, half]:
                turned = hadamard(turned * flips)
            size = np.abs(turned)
            best = np.argsort(-size, axis=1, kind="stable")[:, :4]
            far = np.take_along_axis(size, best, 1)
            axes.append(2 * best + (np.take_along_axis(turned, best, 1) > 0))
            losses.append((far[:, :1] - far) ** 2)
        cost = np.stack([losses[0][:, i] + losses[1][:, j] for i, j in CHOICES], axis=1)
        code = np.stack([axes[0][:, i] * 2 * d + axes[1][:, j] for i, j in CHOICES], axis=1)
        codes[:, t] = np.take_along_axis(code, np.argsort(cost, axis=1, kind="stable")[:, :probes], 1)
    return codes


def _matrix(column) -> np.ndarray:
    rows = column.to_pylist()
    return np.array(rows, dtype=np.float64)


def _filed(tables: int, probes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = np.array(batch.column(2).value_lengths())
            for dim in np.unique(widths):
                mine = np.nonzero(widths == dim)[0]
                for a in range(0, len(mine), 2000):
                    part = batch.take(pa.array(mine[a:a + 2000]))
                    x = _matrix(part.column(2))
                    unit = x / np.sqrt((x * x).sum(1, keepdims=True))
                    codes = bucket_codes(unit, tables, probes)
                    n = len(part)
                    load = [u.tobytes() + c.tobytes() for u, c in zip(unit, codes, strict=True)]
                    again = np.repeat(np.arange(n), tables * probes)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(again), dim, np.int32)),
                        pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int32), probes), n)),
                        pa.array(codes.reshape(-1)),
                        part.column(0).take(pa.array(again)), part.column(1).take(pa.array(again)),
                        pa.array(load, pa.binary()).take(pa.array(again))],
                        names=["dim", "t", "code", "vec", "n", "load"])

    return run


def _first_meeting(a: np.ndarray, b: np.ndarray, table: int, code: int) -> np.ndarray:
    """True where no earlier bucket (table, then smaller number) holds both of a pair."""
    first = np.ones(len(a), bool)
    for t in range(table + 1):
        shared = a[:, t, :, None] == b[:, t, None, :]
        if t == table:
            shared &= a[:, t, :, None] < code
        first &= ~shared.any((1, 2))
    return first


def _verified(threshold: float, tables: int, probes: int):
    """Per unit: how many vectors each one links with, and links enough to connect them."""
    def unit_rows(key, ids, n, part, load):
        dim, table, code, p, q = key
        vectors = np.frombuffer(b"".join(x[:8 * dim] for x in load)).reshape(len(load), dim)
        codes = np.frombuffer(b"".join(x[8 * dim:] for x in load), np.int32).reshape(len(load), tables, probes)
        found = np.zeros(len(ids), np.int64)
        near = np.arange(len(ids))
        for a in range(0, len(ids), 512):
            i, j = np.nonzero(vectors[a:a + 512] @ vectors.T >= threshold)
            i += a
            new = (i < j) if p == q else (i < j) & (part[i] != part[j])
            i, j = i[new], j[new]
            for s in range(0, len(i), 200_000):
                x, y = i[s:s + 200_000], j[s:s + 200_000]
                first = _first_meeting(codes[x], codes[y], table, code)
                x, y = x[first], y[first]
                np.add.at(found, x, n[y])
                np.add.at(found, y, n[x])
            while len(i):
                low = np.minimum(near[i], near[j])
                now = near.copy()
                np.minimum.at(now, i, low)
                np.minimum.at(now, j, low)
                np.minimum.at(now, near[i], low)
                np.minimum.at(now, near[j], low)
                now = now[now]
                if (now == near).all():
                    break
                near = now
        counted = np.nonzero(found)[0]
        moved = np.nonzero(near != np.arange(len(ids)))[0]
        return (np.concatenate([ids[counted], ids[moved]]), np.concatenate([np.full(len(counted), -1), near[moved]]),
                np.concatenate([found[counted], np.zeros(len(moved), np.int64)]), ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in (*batches, None):
            if batch is None:
                if held is None:
                    return
                rows, last = held, True
            else:
                rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
                last = False
            key = np.stack([rows.column(k).to_numpy().astype(np.int64) for k in range(5)])
            starts = np.concatenate([[0], np.nonzero((key[:, 1:] != key[:, :-1]).any(0))[0] + 1, [rows.num_rows]])
            done = len(starts) - 1 if last else len(starts) - 2
            ids, n, part = (rows.column(k).to_numpy() for k in (5, 6, 7))
            load = rows.column(8)
            us, vs, ns = [], [], []
            for a, b in zip(starts[:done], starts[1:done + 1], strict=False):
                if b - a > 1:
                    u, near, count, own = unit_rows(tuple(int(x) for x in key[:, a]), ids[a:b], n[a:b], part[a:b],
                                                    load.slice(a, b - a).to_pylist())
                    us.append(u)
                    vs.append(np.where(near >= 0, own[near], u))
                    ns.append(count)
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (us, vs, ns)], names=["u", "v", "n"])
            held = rows.slice(int(starts[done]))

    return run


def _usable(vector: str):
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
                 tables: int = TABLES, probes: int = PROBES, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    Links are pairs of vectors of one width whose cosine is at least ``threshold``. Null, zero, empty and non-finite
    vectors link with nothing and are their own component. Repeated rows are separate vectors that link with each other, and so
    are rows that share an id. A null id is never the smallest unless all of a component are null; such a component is null
    and its rows are kept. At the threshold 0.9 the default tables and probes find a pair with a probability of 0.9998
    (measured at width 64); every pair that is found is checked, so none below the threshold is returned.
    """
    spark = vectors.sparkSession
    lanes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    # A vector times zero-free scaling stays another vector: only equal ones are merged. Distinct vectors get numbers of their
    # own, stored with them; ids are no keys.
    distinct = written(rows.filter(_usable("x")).groupBy("x").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("n")))
    same = written(distinct.withColumn("vec", F.monotonically_increasing_id()))
    filed = written(same.select("vec", "n", "x").repartition(lanes).mapInArrow(
        _filed(tables, probes), "dim int, t int, code int, vec long, n long, load binary"))
    bucket = ["dim", "t", "code"]
    sizes = filed.groupBy(*bucket).agg(F.ceil(F.count("*") / tile).cast("int").alias("parts")).filter("parts > 1")
    parted = filed.join(written(sizes), bucket, "left").fillna(1, ["parts"])
    part = F.pmod(F.xxhash64("vec"), F.col("parts")).cast("int")
    spread = parted.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    units = spread.select(*bucket, F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"),
                          "vec", "n", "part", "load")
    key = [*bucket, "p", "q"]
    found = written(units.repartition(lanes, *key).sortWithinPartitions(*key).mapInArrow(
        _verified(threshold, tables, probes), "u long, v long, n long"))
    links = found.filter("n > 0").groupBy(F.col("u").alias("vec")).agg(F.sum("n").alias("found"))
    rooted = written(with_roots(same.select("vec", "first_id"), "vec", found.filter("u != v").select("u", "v"), "u", "v"))
    smallest = rooted.groupBy("_root").agg(F.min("first_id").alias("component_id"))
    classes = same.join(links, "vec", "left").join(rooted.join(smallest, "_root").select("vec", "component_id"), "vec")
    named = written(classes.select("x", (F.coalesce("found", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"))
    # A vector that very many rows share stays where its rows are.
    usable = lookup(rows.filter(_usable("x")), named, ["x"], "inner", NAMED_ROWS, HOT_ROWS).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~_usable("x")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return usable.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
