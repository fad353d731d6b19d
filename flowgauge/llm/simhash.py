"""SimHash near-dedup: fingerprints, then exact tiled comparison with exclusive-or and bit counts.

Comparing all tiles with all tiles would grow with the square of the input. Fingerprints within 2 bits agree in at
least two of four 16-bit blocks, so tiles are laid inside the groups that share two blocks: no pair is lost. A group
above ``TILE`` fingerprints is cut into tiles by bit count; tile pairs whose bit counts differ by more than the radius
are never formed, the others are separate units of work on any task.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import written
from .common import quoted, texts
from .components import with_roots
from .exact_dedup import sha256

WORDS = 3
RADIUS = 2
TILE = 1024
BLOCK = 512
SEED = 42
BATCH_BYTES = 4_000_000


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """SimHash over word shingles, as an unsigned 64-bit number; 0 for a text without words."""
    parts = text.lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(words, len(parts))
    hashed = xxhash.xxh64_intdigest
    last = ends[width - 1:].tolist()
    codes = np.fromiter((hashed(line[s:e], SEED) for s, e in zip(starts[:len(last)].tolist(), last, strict=True)),
                        dtype="<u8", count=len(last))
    ones = np.zeros(64, np.int64)
    for a in range(0, len(codes), 1 << 16):
        piece = codes[a:a + (1 << 16)]
        ones += np.unpackbits(piece.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(codes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1).cast(pa.binary())
            values = np.fromiter((fingerprint(column[i].as_py(), words) for i in range(len(column))), "<u8", len(column))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], names=["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return texts(docs, id_col, text_col).mapInArrow(run, f"doc_id {kind}, fp long")


def _stars(fps: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links i-j as few links with the same components: every member to the smallest of its component."""
    label = np.arange(len(fps))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.nonzero(label != np.arange(len(fps)))[0]
    return fps[moved], fps[label[moved]]


def _tile_links(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among ``fps``, block by block; blocks whose bit counts differ by more than the radius are skipped."""
    fps = np.unique(fps)
    count = np.bitwise_count(fps).astype(np.int64)
    order = np.argsort(count, kind="stable")
    fps, count = fps[order], count[order]
    left, right = [], []
    for a in range(0, len(fps), BLOCK):
        one = fps[a:a + BLOCK]
        for b in range(a, len(fps), BLOCK):
            if count[b] - count[min(a + BLOCK, len(fps)) - 1] > radius:
                break
            i, j = np.nonzero(np.bitwise_count(one[:, None] ^ fps[None, b:b + BLOCK]) <= radius)
            real = i + a < j + b
            left.append(i[real] + a)
            right.append(j[real] + b)
    return _stars(fps, np.concatenate(left), np.concatenate(right))


def _compare(radius: int):
    """Compare inside each unit of rows sorted by unit; a unit may span batches."""
    def whole_units(batches):
        held = None
        for batch in batches:
            unit = np.stack([batch.column(k).to_numpy() for k in range(4)])
            fps = batch.column(4).to_numpy().view(np.uint64)
            if held is not None:
                unit, fps = np.concatenate([held[0], unit], axis=1), np.concatenate([held[1], fps])
            starts = np.nonzero((unit[:, 1:] != unit[:, :-1]).any(0))[0] + 1
            cut = int(starts[-1]) if len(starts) else 0
            yield fps[:cut], starts[:-1]
            held = unit[:, cut:], fps[cut:]
        if held is not None:
            yield held[1], np.empty(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fps, starts in whole_units(batches):
            bounds = np.concatenate([[0], starts, [len(fps)]]).astype(np.int64)
            size = np.diff(bounds)
            # Small units together: neighbours at distance 1, 2, ... of the same unit.
            of = np.repeat(np.arange(len(size)), size)
            few = size <= 32
            left, right = [], []
            for d in range(1, int(size[few].max(initial=0))):
                i = np.nonzero((of[:-d] == of[d:]) & few[of[:-d]])[0] if len(of) > d else np.empty(0, np.int64)
                x = np.bitwise_count(fps[i] ^ fps[i + d])
                i = i[(x <= radius) & (x > 0)]
                left.append(fps[i])
                right.append(fps[i + d])
            for k in np.nonzero(~few)[0]:
                u, v = _tile_links(fps[bounds[k]:bounds[k + 1]], radius)
                left.append(u)
                right.append(v)
            if left:
                u, v = (np.concatenate(x).view(np.int64) for x in (left, right))
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return run


def block_keys(fp, radius: int):
    """(combination, key) structs: values of every choice of blocks in which two close fingerprints may agree."""
    parts = radius + 2
    cuts = [64 * k // parts for k in range(parts + 1)]
    blocks = [F.shiftrightunsigned(F.shiftleft(fp, 64 - b), 64 - b + a) for a, b in zip(cuts, cuts[1:], strict=False)]
    width = [b - a for a, b in zip(cuts, cuts[1:], strict=False)]
    return F.array(*[F.struct(F.lit(n).cast("long").alias("combo"),
                              F.shiftleft(blocks[i], width[j]).bitwiseOR(blocks[j]).alias("key"))
                     for n, (i, j) in enumerate(combinations(range(parts), 2))])


def close_pairs(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (u, v) that connect exactly the fingerprints (column ``fp``, distinct) that chains of close pairs connect."""
    rows = prints.select("fp", F.explode(block_keys(F.col("fp"), radius)).alias("k")).select("k.combo", "k.key", "fp")
    hot = rows.groupBy("combo", "key").count().filter(F.col("count") > tile).select("combo", "key", F.lit(True).alias("hot"))
    marked = written(rows.join(written(hot), ["combo", "key"], "left"))
    cold = marked.filter("hot IS NULL").select("combo", "key", F.lit(0).cast("long").alias("a"),
                                               F.lit(0).cast("long").alias("b"), "fp")
    large = marked.filter("hot").withColumn("bits", F.bit_count("fp"))
    # A hot group's tiles: bit count, and as many parts of it as keep a tile near the wanted size.
    counts = large.groupBy("combo", "key", "bits").agg(F.ceil(F.count("*") / tile).cast("int").alias("parts"))
    tiles = counts.groupBy("combo", "key").agg(F.collect_list(F.struct("bits", "parts")).alias("tiles"))
    own = F.element_at(F.map_from_entries("tiles"), F.col("bits"))
    near = F.filter("tiles", lambda t: F.abs(t["bits"] - F.col("bits")) <= radius)
    other = F.flatten(F.transform(near, lambda t: F.transform(
        F.sequence(F.lit(0), t["parts"] - 1), lambda p: t["bits"].cast("long") * (1 << 32) + p)))
    spread = large.join(tiles, ["combo", "key"]).select(
        "combo", "key", "fp", F.explode(other).alias("other"),
        (F.col("bits").cast("long") * (1 << 32) + F.pmod(F.xxhash64("fp"), own)).alias("mine"))
    units = spread.select("combo", "key", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "fp")
    keys = ["combo", "key", "a", "b"]
    spark = prints.sparkSession
    lanes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    work = cold.unionByName(units).repartition(lanes, *keys).sortWithinPartitions(*keys)
    return work.mapInArrow(_compare(radius), "u long, v long").distinct()


def _rooted(prints: DataFrame, radius: int, tile: int) -> DataFrame:
    """(fp, first_id, _root): each fingerprint with its smallest ``doc_id`` and its component."""
    vertices = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    return with_roots(vertices, "fp", close_pairs(vertices.select("fp"), radius, tile), "u", "v")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every document.

    Null texts are empty; texts without words share fingerprint zero and link like any other. Equal fingerprints are one
    vertex, however many documents have them. Repeated rows appear as often as they do in ``docs``; a null id never
    becomes the smallest unless all are null. Other columns are not read.
    """
    prints = written(fingerprints(docs, id_col, text_col, words))
    rooted = written(_rooted(prints, radius, tile))
    smallest = rooted.groupBy("_root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(smallest, "_root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                     radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``docs`` with one row of each component: the smallest id, a null one only where all are null.

    Different texts of a component that share this id are told apart by their digest, the smallest stays; equal ids in
    different components are different documents. Of rows that repeat id and text one stays.
    """
    def named(id_: Column, digest: Column) -> Column:
        return F.concat(F.coalesce(F.concat(F.lit("="), id_.cast("string")), F.lit("")), F.lit(":"), digest)

    id_, text = quoted(id_col), F.coalesce(quoted(text_col), F.lit(""))
    digest = sha256(text)
    ranked = docs.select(F.struct(id_.isNull().alias("none"), id_.alias("id"), digest.alias("digest")).alias("doc_id"), text.alias("text"))
    first = _rooted(written(fingerprints(ranked, words=words)), radius, tile).groupBy("_root").agg(F.min("first_id").alias("f"))
    keep = first.select(named(F.col("f.id"), F.col("f.digest")).alias("keep"))
    # Join and window share one partitioning, so texts move once.
    rows = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("row"), named(id_, digest).alias("keep"))
    one = Window.partitionBy("keep").orderBy("keep")
    return rows.join(keep, "keep").withColumn("n", F.row_number().over(one)).filter("n = 1").select("row.*")
