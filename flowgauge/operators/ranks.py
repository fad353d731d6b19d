"""Exact order statistics without holding a group in one task; one way for tables of any size.

Quantiles take two scans: one aggregate counts and sketches every column, which brackets each wanted rank, and one pass
counts what lies below a bracket and the distinct values inside it. Where a bracket holds too many values, or the sketch was
wrong, ranks are closed in on by counting: doubles map to whole numbers of the same order (infinities are ordinary ends), and
each pass cuts the range that still holds a rank into ``BUCKETS`` equal parts, counts them in every task, and keeps one.

First rows by an order are found by a range sort of the order columns alone: partition sizes say which partition holds
the last wanted row, and every row is compared with it. Any orderable type will do; nulls come first.
"""

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ..storage import fits, written

BUCKETS = 4096
CANDIDATES = 100_000
GROUPS = 100_000
ACCURACY = 10_000
MARGIN = 3.0 / ACCURACY


def sortable(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers in the order of the doubles; both zeros are one."""
    bits = (np.asarray(x, np.float64) + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63))


def unsortable(keys: np.ndarray) -> np.ndarray:
    keys = np.asarray(keys, np.uint64)
    return np.where(keys >> np.uint64(63), keys & np.uint64((1 << 63) - 1), ~keys).view(np.float64)


def without_nan(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    floats = {c for c, t in df.dtypes if t in ("double", "float")}
    return df.withColumns({c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in columns if c in floats})


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def _cells(batch: pa.RecordBatch, wanted: dict[tuple[int, int], list]) -> Iterator[tuple[list, np.ndarray]]:
    """What is wanted of a (group, column), with the keys of its values in this batch; groups that are not in it cost nothing."""
    group = batch.column(0).to_numpy()
    order = np.argsort(group, kind="stable")
    present, starts = np.unique(group[order], return_index=True)
    ends = np.append(starts[1:], len(group))
    columns = sorted({c for _, c in wanted})
    for c in columns:
        x = batch.column(c + 1).to_numpy(zero_copy_only=False).astype(np.float64)[order]
        keys, real = sortable(x), ~np.isnan(x)
        for g, a, b in zip(present.tolist(), starts.tolist(), ends.tolist(), strict=True):
            if (g, c) in wanted:
                yield wanted[g, c], keys[a:b][real[a:b]]


Ask = tuple[int, int, int]


def _inside_brackets(rows: DataFrame, brackets: dict[Ask, tuple[int, int]]) -> dict[Ask, float]:
    """Values at those ranks that lie in their bracket [first key, last key]; one pass, no matter how many ranks."""
    spark = rows.sparkSession
    ids = {span: i for i, span in enumerate(sorted({(t[0], t[1], *s) for t, s in brackets.items()}))}
    wanted: dict[tuple[int, int], list] = {}
    for (g, c, lo, hi), i in ids.items():
        wanted.setdefault((g, c), []).append((i, lo, hi))

    def look(batches, wanted=wanted):
        below: dict[int, int] = {}
        held: dict[int, list[np.ndarray]] = {}

        def flush(i):
            keys, n = np.unique(np.concatenate(held.pop(i)), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), i)), pa.array((keys ^ np.uint64(1 << 63)).view(np.int64)), pa.array(n)],
                                              names=["i", "key", "n"])

        for batch in batches:
            for ranges, keys in _cells(batch, wanted):
                for i, lo, hi in ranges:
                    under = keys < np.uint64(lo)
                    below[i] = below.get(i, 0) + int(under.sum())
                    inside = keys[~under & (keys <= np.uint64(hi))]
                    if len(inside):
                        held.setdefault(i, []).append(inside)
                        if sum(map(len, held[i])) > CANDIDATES:
                            yield flush(i)
        for i in list(held):
            yield flush(i)
        if below:
            yield pa.RecordBatch.from_arrays([pa.array(list(below)), pa.nulls(len(below), pa.int64()), pa.array(list(below.values()))],
                                             names=["i", "key", "n"])

    counted = rows.mapInArrow(look, "i long, key long, n long").groupBy("i", "key").agg(F.sum("n").alias("n"))
    # The row without a key, what lies below, comes first.
    run = Window.partitionBy("i").orderBy(F.col("key").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counted.withColumn("upto", F.sum("n").over(run)).filter("key IS NOT NULL")
    asked = spark.createDataFrame([(ids[(t[0], t[1], *s)], *t) for t, s in brackets.items()], "i long, g long, c long, rank long")
    hit = placed.join(F.broadcast(asked), "i").filter((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("n") <= F.col("rank")))
    return {(r.g, r.c, r.rank): float(unsortable(np.array([r.key], np.int64).view(np.uint64) ^ np.uint64(1 << 63))[0]) for r in hit.collect()}


def _select(rows: DataFrame, ranks: dict[tuple[int, int], list[int]], candidates: int) -> dict[tuple[int, int, int], float]:
    """Value at each 0-based rank; ``rows`` is (group number, columns), ``ranks`` is by (group, column)."""
    spark = rows.sparkSession
    done: dict[tuple[int, int, int], float] = {}
    # (group, column, rank): first key, last key, values inside, rank inside.
    state = {(*cell, r): (0, 2**64 - 1, None, r) for cell, rs in ranks.items() for r in rs}

    def by_cell():
        ids = {span: i for i, span in enumerate(sorted({(t[0], t[1], *s[:2]) for t, s in state.items()}))}
        wanted: dict[tuple[int, int], list] = {}
        for (g, c, lo, hi), i in ids.items():
            wanted.setdefault((g, c), []).append((i, lo, hi, (hi - lo) // BUCKETS + 1))
        return ids, wanted

    while state:
        ids, wanted = by_cell()
        held = {}
        for t, s in state.items():
            held[ids[(t[0], t[1], *s[:2])]] = s[2]
        if all(n is not None and n <= candidates for n in held.values()):
            break

        def count(batches, wanted=wanted):
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for ranges, keys in _cells(batch, wanted):
                    for i, lo, hi, width in ranges:
                        inside = keys[(keys >= np.uint64(lo)) & (keys <= np.uint64(hi))]
                        bucket = ((inside - np.uint64(lo)) // np.uint64(width)).astype(np.int64)
                        total[i] = total.get(i, 0) + np.bincount(bucket, minlength=BUCKETS)
            for i, n in total.items():
                full = np.nonzero(n)[0]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(full), i)), pa.array(full), pa.array(n[full])], names=["i", "bucket", "n"])

        counted = rows.mapInArrow(count, "i long, bucket long, n long").groupBy("i", "bucket").agg(F.sum("n").alias("n"))
        run = Window.partitionBy("i").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        placed = counted.withColumn("upto", F.sum("n").over(run))
        asked = spark.createDataFrame([(ids[(t[0], t[1], *s[:2])], *t, s[3]) for t, s in state.items()],
                                      "i long, g long, c long, rank long, left long")
        hit = placed.join(F.broadcast(asked), "i").filter((F.col("upto") > F.col("left")) & (F.col("upto") - F.col("n") <= F.col("left")))
        spans = {i: (lo, hi) for (_, _, lo, hi), i in ids.items()}
        found = {}
        for r in hit.collect():
            lo, hi = spans[r.i]
            width = (hi - lo) // BUCKETS + 1
            start = lo + r.bucket * width
            found[(r.g, r.c, r.rank)] = (start, min(hi, start + width - 1), r.n, r.left - (r.upto - r.n))
        for t, s in list(found.items()):
            if s[0] == s[1]:
                done[t] = float(unsortable(np.array([s[0]], np.uint64))[0])
                del found[t]
        state = found
    if state:
        ids, wanted = by_cell()

        def few(batches, wanted=wanted):
            for batch in batches:
                for ranges, keys in _cells(batch, wanted):
                    for i, lo, hi, _ in ranges:
                        inside = unsortable(keys[(keys >= np.uint64(lo)) & (keys <= np.uint64(hi))])
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(inside), i)), pa.array(inside)], names=["i", "v"])

        # At most ``candidates`` values per range.
        last = rows.mapInArrow(few, "i long, v double").groupBy("i").agg(F.sort_array(F.collect_list("v")).alias("vs"))
        asked = spark.createDataFrame([(ids[(t[0], t[1], *s[:2])], *t, s[3]) for t, s in state.items()],
                                      "i long, g long, c long, rank long, left long")
        picked = last.join(F.broadcast(asked), "i").select("g", "c", "rank", F.element_at("vs", (F.col("left") + 1).cast("int")).alias("v"))
        done |= {(r.g, r.c, r.rank): r.v for r in picked.collect()}
    return done


def exact_quantiles(df: DataFrame, groups: list[str], columns: Sequence[str], probs: Sequence[float],
                    candidates: int = CANDIDATES) -> DataFrame:
    """(groups, feature, q): exact quantiles with linear interpolation, missing values (null, NaN) skipped.

    A null group is a group; a column without any value in a group gives a null ``q``; infinities are ordinary values. An
    empty table gives no rows. Groups are few: their number is checked.
    """
    spark = df.sparkSession
    numbered = df.select(*groups, *[F.col(f"`{c}`").cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    real = [F.when(~F.isnan(f"_{i}"), F.col(f"_{i}")) for i in range(len(columns))]
    # Sketched ranks on both sides of every wanted one.
    around = sorted({min(1.0, max(0.0, p + side)) for p in probs for side in (-MARGIN, MARGIN)})
    filled = [x for i, v in enumerate(real) for x in (F.count(v).alias(f"_{i}"), F.percentile_approx(v, around, ACCURACY).alias(f"_{i}s"))]
    counts = numbered.groupBy(*groups).agg(F.count("*").alias("_rows"), *filled) if groups else numbered.agg(
        F.count("*").alias("_rows"), *filled).filter("_rows > 0")
    if not fits(counts, GROUPS // max(1, len(columns))):
        raise ValueError("too many groups; group more coarsely")
    found = counts.collect()
    kinds = numbered.select(*groups).schema
    names = spark.createDataFrame([(*[r[g] for g in groups], k) for k, r in enumerate(found)],
                                  kinds.add("_g", "long") if groups else "_g long")
    if groups:
        table = F.broadcast(names.select(*[F.col(g).alias(f"_n{i}") for i, g in enumerate(groups)], "_g"))
        match = reduce(lambda a, b: a & b, [same(F.col(g), F.col(f"_n{i}")) for i, g in enumerate(groups)])
        rows = numbered.join(table, match).select("_g", *[f"_{i}" for i in range(len(columns))])
    else:
        rows = numbered.select(F.lit(0).cast("long").alias("_g"), *[f"_{i}" for i in range(len(columns))])
    spots = {(g, c): [(r[f"_{c}"] - 1) * p for p in probs] for g, r in enumerate(found) for c in range(len(columns)) if r[f"_{c}"]}
    ranks = {cell: sorted({int(x) for s in at for x in (np.floor(s), np.ceil(s))}) for cell, at in spots.items()}
    brackets = {}
    for (g, c), wanted in ranks.items():
        n, sketch = found[g][f"_{c}"], sortable(np.array(found[g][f"_{c}s"], float))
        if 2 * MARGIN * n <= candidates:
            for r in wanted:
                low, high = (r / n - 0.5 * MARGIN), ((r + 1) / n + 0.5 * MARGIN)
                under = [k for p, k in zip(around, sketch.tolist(), strict=True) if p <= low]
                over = [k for p, k in zip(around, sketch.tolist(), strict=True) if p >= high]
                brackets[g, c, r] = (under[-1] if under else 0, over[0] if over else 2**64 - 1)
    value = _inside_brackets(rows, brackets) if brackets else {}
    left = {cell: rest for cell, wanted in ranks.items() if (rest := [r for r in wanted if (*cell, r) not in value])}
    value |= _select(rows, left, candidates) if left else {}

    def quantile(cell, spot):
        low, high = value[(*cell, int(np.floor(spot)))], value[(*cell, int(np.ceil(spot)))]
        return low if low == high else low + (high - low) * (spot - np.floor(spot))

    out = [(*[r[x] for x in groups], name, [float(quantile((g, c), s)) for s in spots[g, c]] if (g, c) in spots else None)
           for g, r in enumerate(found) for c, name in enumerate(columns)]
    kinds = numbered.select(*groups).schema
    return spark.createDataFrame(out, kinds.add("feature", "string").add("q", ArrayType(DoubleType())))


def scatter_key(*columns: str, seed: int = 42):
    """A repeatable pseudo-random order key in 52 bits."""
    return F.xxhash64(F.lit(seed), *columns).bitwiseAND(F.lit((1 << 52) - 1))


def mark_lowest(df: DataFrame, groups: list[str], order: list[str], wanted: DataFrame) -> DataFrame:
    """Add ``lowest``: the row is among its group's ``k`` first rows by ``order``.

    ``order`` columns of any orderable types, together unique near the cut (else an error, at any size); nulls come first.
    ``wanted`` is (groups, k), one row per group; a null group is a group. Rows themselves are neither sorted nor shuffled.
    """
    if not fits(wanted, GROUPS):
        raise ValueError("too many groups to compare with; group more coarsely")
    spark = df.sparkSession
    lanes = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    asked = wanted.select(*[F.col(f"`{g}`").alias(f"_n{i}") for i, g in enumerate(groups)], F.col("k").cast("long").alias("_k"))

    def beside(rows, table, how="inner"):
        match = reduce(lambda a, b: a & b, [same(F.col(f"`{g}`"), F.col(f"_n{i}")) for i, g in enumerate(groups)], F.lit(True))
        return rows.join(F.broadcast(table), match, how)

    keys = [f"_o{i}" for i in range(len(order))]
    slim = beside(df, asked.filter("_k > 0")).select(
        *[f"_n{i}" for i in range(len(groups))], "_k", *[F.col(f"`{c}`").alias(k) for c, k in zip(order, keys, strict=True)])
    named = [f"_n{i}" for i in range(len(groups))]
    placed = written(slim.repartitionByRange(lanes, *named, *keys).withColumn("_part", F.spark_partition_id()))
    sizes = placed.groupBy(*named, "_k", "_part").agg(F.count("*").alias("_size"))
    earlier = Window.partitionBy(*named).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spots = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
    spots = spots.filter((F.col("_before") < F.col("_k")) & (F.col("_k") <= F.col("_before") + F.col("_size")))
    chosen = spots.select(*[F.col(n).alias(f"{n}_") for n in named], F.col("_part").alias("_part_"), (F.col("_k") - F.col("_before")).alias("_left"))
    match = reduce(lambda a, b: a & b, [same(F.col(n), F.col(f"{n}_")) for n in named], F.col("_part") == F.col("_part_"))
    row = F.struct(*keys)
    near = Window.partitionBy(*named, "_part").orderBy(*keys)
    cut = placed.join(F.broadcast(chosen), match).withColumn("_place", F.row_number().over(near))
    cut = cut.withColumn("_after", F.lead(row).over(near)).filter(F.col("_place") == F.col("_left"))
    cut = written(cut.select(*named, row.alias("_cut"), same(F.col("_after"), row).alias("_tied")))
    if not cut.filter("_tied").isEmpty():
        raise ValueError(f"rows are not told apart by {order}")
    # A group without a cut is wanted whole, if it is wanted at all.
    limits = asked.join(cut.select(*[F.col(n).alias(f"{n}_") for n in named], "_cut"),
                        reduce(lambda a, b: a & b, [same(F.col(n), F.col(f"{n}_")) for n in named], F.lit(True)), "left")
    limits = limits.select(*named, "_k", "_cut")
    own = F.struct(*[F.col(f"`{c}`").alias(k) for c, k in zip(order, keys, strict=True)])
    lowest = F.when(F.col("_k") <= 0, F.lit(False)).when(F.col("_cut").isNull(), F.col("_k").isNotNull()).otherwise(own <= F.col("_cut"))
    marked = beside(df, limits, "left").withColumn("lowest", F.coalesce(lowest, F.lit(False)))
    return marked.drop("_k", "_cut", *named)
