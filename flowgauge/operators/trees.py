"""Tree ensembles over binned features: softmax boosting and forests, grown level by level.

Features are cut at quantiles once, into at most 256 bins, and rows are kept as chunks of bytes in a written table. A level
of all trees that grow together is one aggregate: every task sums, per tree, open node, feature and bin, what a split needs
(gradients and hessians, or class weights); the sums of a node meet in one place, and only its best split comes back. Rows
find their node by walking the trees grown so far, so nothing is kept in tasks between levels.

Boosting sums the levels of all classes' trees of a round together. Margins are written with the rows every few rounds, which
cuts the lineage; tasks add the trees since. Trees grow level by level while their nodes are large; a node of at most
``LOCAL_ROWS`` rows is finished by one task, which gets those rows. Rounds follow one another, so what counts in boosting is how
many jobs a round is made of: there the bound is ``BOOSTED_ROWS``; a task gets a byte a feature and two numbers of each row. Row weights and row samples are hashes of the rows'
bins, so tasks that run again draw the same.
"""

import hashlib
import pickle
import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import BarrierTaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..exchange import Exchange
from ..sources.artifacts import create_file, open_file
from ..storage import discard, fresh_folder, lanes_at_once, slots, stored_at

BINS = 256
CHUNK = 32_768
LOCAL_ROWS = 262_144
WHOLE_ROWS = 1_048_576
BOOSTED_ROWS = 1_048_576
BATCH_ROWS = 60_000_000
LEVEL_BYTES = 64_000_000
KEEP_ROUNDS = 10
KEPT_NODES = 1_000_000
MARGIN_BYTES = 64_000_000
HELD_BYTES = 400_000_000
READ_AT_ONCE = 16
TOGETHER_ROUNDS = 10
SCORE_ROWS = 65_536
POISSON = np.cumsum([np.exp(-1.0) / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320)])


# ---------------------------------------------------------------------------
# The fitted model
# ---------------------------------------------------------------------------

@dataclass
class TreeModel:
    """Flat node arrays of all trees; ``x[feature] <= threshold`` goes left, a leaf's feature is -1.

    A forest's leaf holds class shares and the trees are averaged; a boosted tree's leaf holds what it adds to the margin
    of the class ``output``.
    """

    kind: str
    n_features: int
    n_classes: int
    tree: np.ndarray
    output: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray
    history: list = field(default_factory=list)

    @property
    def classes(self) -> list[int]:
        return list(range(self.n_classes))

    @property
    def roots(self) -> np.ndarray:
        return np.nonzero(np.concatenate([[True], self.tree[1:] != self.tree[:-1]]))[0] if len(self.tree) else np.zeros(0, np.int64)

    @property
    def n_trees(self) -> int:
        return len(self.roots)

    def first(self, n_trees: int) -> "TreeModel":
        """The model of the first trees alone."""
        end = int(np.searchsorted(self.tree, n_trees))
        parts = {k: getattr(self, k)[:end] for k in ARRAYS}
        return TreeModel(self.kind, self.n_features, self.n_classes, output=self.output[:n_trees], **parts)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(rows, classes); equal to a walk of every row down every tree."""
        total = np.zeros((len(x), self.n_classes))
        rows = np.arange(len(x))
        for t, root in enumerate(self.roots.tolist()):
            at = np.full(len(x), root)
            while True:
                f = self.feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                below = x[rows, np.maximum(f, 0)] <= self.threshold[at]
                at = np.where(inner, np.where(below, self.left[at], self.right[at]), at)
            if self.kind == "forest":
                total += self.value[at]
            else:
                total[:, self.output[t]] += self.value[at, 0]
        return total / max(1, self.n_trees) if self.kind == "forest" else softmax(total)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``probability`` (a vector) and ``prediction`` to rows with a vector column ``features``."""
        shared = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("array<double>")
        def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for held in gathered(batches):
                full = [np.stack(rows.to_numpy()).astype(float) for rows in held if len(rows)]
                out = shared.value.probabilities(np.concatenate(full)) if full else np.zeros((0, 1))
                ends = np.cumsum([0, *map(len, held)]).tolist()
                for a, b in zip(ends, ends[1:], strict=False):
                    yield pd.Series(list(out[a:b]))

        scored = df.withColumn("_scores", scores(vector_to_array("features")))
        best = F.array_position("_scores", F.array_max("_scores")) - 1
        return scored.withColumn("probability", array_to_vector("_scores")).withColumn("prediction", best.cast("double")).drop("_scores")

    @property
    def featureImportances(self) -> np.ndarray:
        """A forest's mean share of impurity taken away; for boosted trees the mean gain of a feature's splits."""
        total = np.zeros(self.n_features)
        inner = self.feature >= 0
        if self.kind == "forest":
            gains = np.zeros((self.n_trees, self.n_features))
            np.add.at(gains, (np.searchsorted(self.roots, np.nonzero(inner)[0], side="right") - 1, self.feature[inner]), self.gain[inner])
            sums = gains.sum(1, keepdims=True)
            total = np.divide(gains, sums, out=np.zeros_like(gains), where=sums > 0).sum(0)
        else:
            np.add.at(total, self.feature[inner], self.gain[inner])
            total /= np.maximum(1, np.bincount(self.feature[inner], minlength=self.n_features))
        return total / total.sum() if total.sum() > 0 else total

    def save(self, spark: SparkSession, path: str) -> None:
        """One row per node, and one table that describes the model; an older model under the path is replaced."""
        parts = {k: getattr(self, k) for k in ARRAYS}
        spark.createDataFrame(pa.Table.from_batches([_node_batch(parts, 0)]), NODES).write.mode("overwrite").parquet(f"{path}/nodes")
        self._save_about(spark, path)

    def _save_about(self, spark: SparkSession, path: str) -> None:
        about = [(self.kind, int(self.n_features), int(self.n_classes), [int(v) for v in self.output], [float(v) for v in self.history])]
        spark.createDataFrame(about, "kind string, n_features int, n_classes int, output array<int>, history array<double>") \
            .coalesce(1).write.mode("overwrite").parquet(f"{path}/about")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TreeModel":
        about = spark.read.parquet(f"{path}/about").first()
        if about["kind"] == "forest":
            return StoredForest.of_nodes(spark.read.parquet(f"{path}/nodes"), about["n_features"], about["n_classes"], len(about["output"]))
        nodes = spark.read.parquet(f"{path}/nodes").toPandas().sort_values("place")
        parts = {k: nodes[k].to_numpy() for k in ARRAYS if k != "value"}
        value = np.stack(nodes["value"].to_numpy()) if len(nodes) else np.zeros((0, 1))
        return TreeModel(about["kind"], about["n_features"], about["n_classes"], value=value, output=np.array(about["output"], np.int64),
                         history=list(about["history"]), **parts)


ARRAYS = ("tree", "feature", "threshold", "left", "right", "value", "cover", "gain")
NODES = "tree int, feature int, threshold double, left int, right int, cover double, gain double, place int, value array<double>"


def _node_batch(parts: dict, base: int) -> pa.RecordBatch:
    """Node arrays as rows; ``base`` is the place of the first node."""
    n, width = parts["value"].shape
    kinds = {"double": pa.float64(), "int": pa.int32()}
    columns = []
    for name, kind in (c.split() for c in NODES.split(", ")):
        if name == "value":
            offsets = pa.array(np.arange(n + 1) * width, pa.int32())
            columns.append(pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(parts["value"]).reshape(-1), pa.float64())))
        else:
            columns.append(pa.array(base + np.arange(n) if name == "place" else parts[name], kinds[kind]))
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in NODES.split(", ")])


class StoredForest(TreeModel):
    """A forest whose trees are files in the shared folder; the driver holds their names, sizes and gains per feature.

    Tasks score with one tree at a time. The node arrays of a whole forest are read only when asked for by name.
    """

    def __init__(self, n_features: int, n_classes: int, files: list[str], sizes: list[int], gains: np.ndarray):
        self.kind, self.n_features, self.n_classes, self.history = "forest", n_features, n_classes, []
        self.files, self.sizes, self.gains, self.output = files, sizes, gains, np.full(len(files), -1, np.int64)

    def __getattr__(self, name):
        if name not in ARRAYS:
            raise AttributeError(name)
        self.__dict__.update(self._arrays_of(0, len(self.files)))
        return self.__dict__[name]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ARRAYS}

    def __repr__(self):
        return f"StoredForest({self.n_trees} trees, {sum(self.sizes)} nodes)"

    def _arrays_of(self, first: int, last: int) -> dict:
        parts = [read_tree(path) for path in self.files[first:last]]
        base = np.concatenate([[0], np.cumsum(self.sizes[first:last])]).astype(np.int32)
        flat = {k: np.concatenate([np.where(part[k] >= 0, part[k] + b, -1) if k in ("left", "right") else part[k]
                                   for part, b in zip(parts, base, strict=False)]) for k in ARRAYS if k != "tree"}
        return flat | {"tree": np.repeat(np.arange(last - first, dtype=np.int32), self.sizes[first:last])}

    def block(self, first: int, last: int) -> TreeModel:
        """Trees first .. last - 1 as a model of their own, in memory."""
        return TreeModel("forest", self.n_features, self.n_classes, output=self.output[first:last], **self._arrays_of(first, last))

    @property
    def n_trees(self) -> int:
        return len(self.files)

    def first(self, n_trees: int) -> "StoredForest":
        return StoredForest(self.n_features, self.n_classes, self.files[:n_trees], self.sizes[:n_trees], self.gains[:n_trees])

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros((len(x), self.n_classes))
        for path in self.files:
            tree = read_tree(path)
            at, open_ = np.zeros(len(x), np.int32), np.arange(len(x))
            while True:
                open_ = open_[tree["feature"][at[open_]] >= 0]
                if not len(open_):
                    break
                node = at[open_]
                at[open_] = np.where(x[open_, tree["feature"][node]] <= tree["threshold"][node], tree["left"][node], tree["right"][node])
            total += tree["value"][at]
        return total / max(1, self.n_trees)

    @property
    def featureImportances(self) -> np.ndarray:
        sums = self.gains.sum(1, keepdims=True)
        total = np.divide(self.gains, sums, out=np.zeros_like(self.gains), where=sums > 0).sum(0)
        return total / total.sum() if total.sum() > 0 else total

    def save(self, spark: SparkSession, path: str) -> None:
        base = np.cumsum([0, *self.sizes]).tolist()

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for t, file, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    tree = read_tree(file)
                    moved = {k: np.where(tree[k] >= 0, tree[k] + start, -1) for k in ("left", "right")}
                    flat = tree | moved | {"tree": np.full(len(tree["feature"]), t, np.int32)}
                    for a in range(0, len(flat["tree"]), NODE_ROWS):
                        yield _node_batch({k: v[a:a + NODE_ROWS] for k, v in flat.items()}, start + a)

        files = spread_rows(spark, [(t, file, base[t]) for t, file in enumerate(self.files)], "tree int, file string, start long", "tree")
        files.mapInArrow(rows, NODES).write.mode("overwrite").parquet(f"{path}/nodes")
        self._save_about(spark, path)

    @staticmethod
    def of_nodes(nodes: DataFrame, n_features: int, n_classes: int, n_trees: int) -> "StoredForest":
        """Node rows as files of trees; every tree is put together by one task."""
        spark = nodes.sparkSession
        folder = fresh_folder(spark)
        names = [c.split()[0] for c in NODES.split(", ")]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            current, held = None, []

            def close():
                whole = pa.Table.from_batches(held)
                flat = {k: whole.column(k).to_numpy() for k in names if k not in ("tree", "place", "value")}
                start = whole.column("place")[0].as_py()
                flat |= {k: np.where(flat[k] >= 0, flat[k] - start, -1).astype(np.int32) for k in ("left", "right")}
                flat["value"] = np.concatenate([c.flatten().to_numpy() for c in whole.column("value").chunks]).reshape(len(whole), -1)
                return _tree_batch([(current, *_write_tree(folder, current, flat, n_features))])

            for batch in batches:
                tree = batch.column(0).to_numpy()
                cuts = np.concatenate([[0], np.nonzero(np.diff(tree))[0] + 1, [len(tree)]])
                for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
                    if b == a:
                        continue
                    if tree[a] != current:
                        if held:
                            yield close()
                        current, held = int(tree[a]), []
                    held.append(batch.slice(a, b - a))
            if held:
                yield close()

        dealt = nodes.select(*names).repartition(min(n_trees, 200) or 1, "tree").sortWithinPartitions("tree", "place")
        return _stored(dealt.mapInArrow(run, TREES).collect(), n_features, n_classes)


TREES = "tree int, file string, nodes int, gains array<double>"
NODE_ROWS = 50_000


def _tree_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.string(), pa.int32(), pa.list_(pa.float64()))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[c.split()[0] for c in TREES.split(", ")])


def _stored(rows: list, n_features: int, n_classes: int) -> StoredForest:
    rows = sorted(rows, key=lambda r: r[0])
    gains = np.array([r[3] for r in rows], float).reshape(len(rows), n_features)
    return StoredForest(n_features, n_classes, [r[1] for r in rows], [int(r[2]) for r in rows], gains)


def spread_rows(spark: SparkSession, rows: list[tuple], kinds: str, key: str, lanes: int | None = None) -> DataFrame:
    """Few rows, each of them work for a task."""
    lanes = max(1, min(len(rows), lanes or int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return spark.createDataFrame(rows, kinds).repartitionById(lanes, F.pmod(F.col(key), F.lit(lanes)))


def _write_tree(folder: str, tree: int, flat: dict, n_features: int) -> tuple[str, int, list[float]]:
    """Store one tree; (file, nodes, gain per feature). A task that runs again writes another file."""
    path = f"{folder}/tree-{tree}-{uuid.uuid4().hex}"
    with create_file(path) as out:
        out.write(pickle.dumps({k: flat[k] for k in ARRAYS if k != "tree"}, protocol=pickle.HIGHEST_PROTOCOL))
    inner = flat["feature"] >= 0
    gains = np.bincount(flat["feature"][inner], flat["gain"][inner], n_features)
    return path, len(flat["feature"]), gains.tolist()


_KEPT: dict[str, dict] = {}


def read_tree(path: str) -> dict:
    """One stored tree. A worker keeps the first trees of the forest it reads, and leaves those of forests before."""
    if path in _KEPT:
        return _KEPT[path]
    with open_file(path) as source:
        tree = pickle.loads(source.read())
    room = KEPT_NODES - len(tree["feature"]) - sum(len(t["feature"]) for t in _KEPT.values())
    for other in [p for p in _KEPT if p.rsplit("/", 1)[0] != path.rsplit("/", 1)[0]]:
        if room >= 0:
            break
        room += len(_KEPT.pop(other)["feature"])
    if room >= 0:
        _KEPT[path] = tree
    return tree


def gathered(batches: Iterator, rows: int = SCORE_ROWS) -> Iterator[list]:
    """Batches (columns, or tuples of them) together up to a number of rows, so that a tree is read once for all of them."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch[0] if isinstance(batch, tuple) else batch)
        if n >= rows:
            yield held
            held, n = [], 0
    if held:
        yield held


def _joined(top: dict, parts: list[tuple[int, dict]], cuts: list[np.ndarray], n_classes: int) -> dict:
    """The flat arrays of a tree: its upper part, and finished subtrees in the place of leaves."""
    unknown = np.full(n_classes, 1.0 / n_classes)
    head = {k: np.array(top[k]) for k in ("feature", "bin", "left", "right", "cover", "gain")}
    head["value"] = np.array([unknown if v is None else v for v in top["value"]], float)
    out, base = {k: [v] for k, v in head.items()}, len(head["feature"])
    for node, part in sorted(parts, key=lambda p: p[0]):
        n = len(part["feature"])
        place = np.concatenate([[node], base + np.arange(n - 1)])
        for name, column in out.items():
            mine = part[name]
            if name in ("left", "right"):
                mine = np.where(mine >= 0, place[np.maximum(mine, 0)], -1)
            head[name][node] = mine[0]
            column.append(mine[1:])
        base += n - 1
    flat = {k: np.concatenate(v) for k, v in out.items()}
    start = np.cumsum([0, *(len(c) for c in cuts)])
    inner = flat["feature"] >= 0
    threshold = np.zeros(len(inner))
    threshold[inner] = np.concatenate([*cuts, [0.0]])[start[flat["feature"][inner]] + flat["bin"][inner]]
    kinds = {"feature": np.int32, "left": np.int32, "right": np.int32, "cover": float, "gain": float, "value": float}
    return {k: flat[k].astype(v) for k, v in kinds.items()} | {"threshold": threshold}


def softmax(margin: np.ndarray) -> np.ndarray:
    e = np.exp(margin - margin.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


class Growing:
    """A tree under construction, splits by bin; children are numbered in the order they are made."""

    def __init__(self):
        self.feature, self.bin, self.left, self.right, self.depth = [-1], [0], [-1], [-1], [0]
        self.value, self.cover, self.gain = [None], [0.0], [0.0]
        self._arrays = None

    def split(self, node: int, feature: int, bin_: int, gain: float) -> tuple[int, int]:
        self._arrays = None
        a = len(self.feature)
        self.feature[node], self.bin[node], self.left[node], self.right[node], self.gain[node] = feature, bin_, a, a + 1, gain
        for _ in range(2):
            for column, empty in ((self.feature, -1), (self.bin, 0), (self.left, -1), (self.right, -1), (self.value, None),
                                  (self.cover, 0.0), (self.gain, 0.0), (self.depth, self.depth[node] + 1)):
                column.append(empty)
        return a, a + 1

    def graft(self, node: int, part: dict) -> None:
        """Put a finished subtree in the place of a leaf."""
        self._arrays = None
        base, n = len(self.feature) - 1, len(part["feature"])
        place = np.concatenate([[node], base + np.arange(1, n)])
        for name in ("left", "right"):
            mine = part[name]
            moved = np.where(mine >= 0, place[np.maximum(mine, 0)], -1).tolist()
            column = getattr(self, name)
            column[node] = moved[0]
            column.extend(moved[1:])
        for name in ("feature", "bin", "cover", "gain", "value"):
            column, rows = getattr(self, name), part[name].tolist() if name != "value" else list(part[name])
            column[node] = rows[0]
            column.extend(rows[1:])
        self.depth.extend((part["depth"][1:] + self.depth[node]).tolist())

    def __getstate__(self):
        return {"feature": np.array(self.feature, np.int32), "bin": np.array(self.bin, np.int32), "left": np.array(self.left, np.int32),
                "right": np.array(self.right, np.int32), "leaf": np.array(self.value) if all(isinstance(v, float) for v in self.value) else None}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._arrays = (state["feature"], state["bin"], state["left"], state["right"])

    def arrays(self):
        if self._arrays is None:
            self._arrays = tuple(np.array(c, np.int32) for c in (self.feature, self.bin, self.left, self.right))
        return self._arrays

    def walk(self, bins: np.ndarray) -> np.ndarray:
        """The node each row ends in."""
        feature, split, left, right = self.arrays()
        at, rows = np.zeros(len(bins), np.int32), np.arange(len(bins))
        while True:
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                return at
            at = np.where(inner, np.where(bins[rows, np.maximum(f, 0)] <= split[at], left[at], right[at]), at)


def _fitted(kind: str, trees: list[Growing], output: list[int], cuts: list[np.ndarray], n_classes: int, history=()) -> TreeModel:
    base = np.concatenate([[0], np.cumsum([len(t.feature) for t in trees])]).astype(np.int64)
    flat = {k: np.concatenate([np.asarray(getattr(t, k)) for t in trees]) for k in ("feature", "bin", "left", "right", "cover", "gain")}
    tree = np.repeat(np.arange(len(trees)), np.diff(base))
    up = base[:-1][tree]
    threshold = np.array([cuts[f][b] if f >= 0 else 0.0 for f, b in zip(flat["feature"], flat["bin"], strict=True)])
    value = np.array([np.atleast_1d(v) for t in trees for v in t.value], float)
    return TreeModel(kind, len(cuts), n_classes, tree.astype(np.int32), np.array(output, np.int64), flat["feature"].astype(np.int32), threshold,
                     np.where(flat["left"] >= 0, flat["left"] + up, -1).astype(np.int32),
                     np.where(flat["right"] >= 0, flat["right"] + up, -1).astype(np.int32),
                     value, flat["cover"].astype(float), flat["gain"].astype(float), list(history))


# ---------------------------------------------------------------------------
# Binned rows
# ---------------------------------------------------------------------------

@dataclass
class Chunk:
    bins: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    key: np.ndarray
    margin: np.ndarray | None


CHUNKS = "n int, bins binary, label binary, weight binary, key binary, margin binary"
CHUNK_NAMES = [c.split()[0] for c in CHUNKS.split(", ")]


def _packed(c: Chunk) -> tuple:
    return (len(c.label), c.bins.tobytes(), c.label.astype("<i4").tobytes(), c.weight.tobytes(), c.key.tobytes(),
            b"" if c.margin is None else c.margin.tobytes())


def _unpacked(row, n_classes: int) -> Chunk:
    n, bins, label, weight, key, margin = row
    return Chunk(np.frombuffer(bins, np.uint8).reshape(n, -1), np.frombuffer(label, "<i4").astype(np.int64), np.frombuffer(weight), np.frombuffer(key, "<u8"),
                 np.frombuffer(margin).reshape(n, n_classes) if margin else np.zeros((n, n_classes)))


def _chunk_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), *[pa.binary()] * 5)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=CHUNK_NAMES)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: neighbours become far apart."""
    x = x ^ x >> np.uint64(30)
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def uniform(key: np.ndarray, *numbers: int) -> np.ndarray:
    """One number in [0, 1) per row for each choice of ``numbers``."""
    seed = np.uint64(0)
    for n in numbers:
        seed = mix(np.array([(int(seed) + n * 0x9E3779B97F4A7C15 + 1) % 2**64], np.uint64))[0]
    return (mix(key ^ seed) >> np.uint64(11)) * 2.0**-53


def row_keys(bins: np.ndarray, label: np.ndarray) -> np.ndarray:
    """A hash per row; equal rows of a chunk are told apart by how many came before."""
    odd = mix(np.arange(1, bins.shape[1] + 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    key = mix(label.astype(np.uint64) * odd[-1])
    for f in range(bins.shape[1]):
        key = mix(key + (bins[:, f].astype(np.uint64) + np.uint64(1)) * odd[f])
    order = np.argsort(key, kind="stable")
    new = np.concatenate([[True], key[order][1:] != key[order][:-1]]) if len(key) else np.zeros(0, bool)
    before = np.empty(len(key), np.uint64)
    before[order] = np.arange(len(key)) - np.nonzero(new)[0][np.cumsum(new) - 1] if len(key) else 0
    return mix(key + before * np.uint64(0xD6E8FEB86659FD93))


@dataclass
class Binned:
    """A written table of chunks, its cuts and sizes."""

    path: str
    cuts: list[np.ndarray]
    rows: int
    chunks: int
    n_classes: int

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(CHUNKS).parquet(self.path)


def bin_rows(df: DataFrame, bins: int = BINS, balanced: bool = False, chunk: int = CHUNK) -> Binned:
    """(features, label) as chunks; with ``balanced`` each class weighs the same in total.

    Cuts are data values at evenly spaced ranks; a value goes below the first cut that is not smaller. Missing and NaN values
    come last. Labels are whole numbers from 0; at most 256 bins.
    """
    spark = df.sparkSession
    rows = df.select(vector_to_array("features").alias("x"), F.col("label").cast("int").alias("label"))
    counts = {int(r.label): r["count"] for r in rows.groupBy("label").count().collect()}
    if not counts:
        raise ValueError("no rows to train on")
    n, n_classes = sum(counts.values()), max(counts) + 1
    width = len(rows.first().x)
    flat = rows.select(*[F.col("x")[i].alias(f"x{i}") for i in range(width)])
    ranks = [k / bins for k in range(1, bins)]
    found = flat.approxQuantile(flat.columns, ranks, 1 / (4 * bins))
    cuts = [np.unique(np.array([v for v in q if np.isfinite(v)], float)) for q in found]
    weight_of = np.zeros(n_classes)
    for c, k in counts.items():
        weight_of[c] = n / (len(counts) * k) if balanced else 1.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def whole(part: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
            return _chunk_batch([_packed(Chunk(part, label, weight_of[label], row_keys(part, label), None))])

        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), width)
            coded = np.stack([np.searchsorted(cuts[i], x[:, i], side="left") for i in range(width)], 1).astype(np.uint8)
            held.append((coded, batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)))
            if sum(len(h[1]) for h in held) >= chunk:
                part, label = (np.concatenate(c) for c in zip(*held, strict=True))
                for a in range(0, len(label) - chunk + 1, chunk):
                    yield whole(part[a:a + chunk], label[a:a + chunk])
                rest = len(label) // chunk * chunk
                held = [(part[rest:], label[rest:])]
        if held:
            part, label = (np.concatenate(c) for c in zip(*held, strict=True))
            if len(label):
                yield whole(part, label)

    # A small table becomes one chunk, a large one stays in its partitions.
    parts = rows if n > chunk else rows.coalesce(1)
    coded = parts.mapInArrow(run, CHUNKS)
    if n > chunk:
        # A file of the input may be one task; its chunks are read by all tasks, level after level.
        coded = coded.repartition(max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), n // chunk)))
    path = stored_at(coded)
    chunks = spark.read.schema(CHUNKS).parquet(path).count()
    return Binned(path, cuts, n, chunks, n_classes)


# ---------------------------------------------------------------------------
# One level: sums per open node, and the best split of each
# ---------------------------------------------------------------------------

@dataclass
class Unit:
    """An open node: tree, node, and the features it may split on."""

    tree: int
    node: int
    features: np.ndarray


@dataclass
class Best:
    """What a level finds out about a node; ``feature`` is -1 when nothing can be gained."""

    total: np.ndarray
    feature: int
    bin: int
    gain: float
    left: np.ndarray


def _histogram(bins: np.ndarray, slot: np.ndarray, features: np.ndarray, channels: list[np.ndarray], n_bins: int) -> np.ndarray:
    """(slots, features of a slot, bins, channels) sums over rows with a slot."""
    n_slots, m = features.shape
    out = np.empty((n_slots, m, n_bins, len(channels)))
    base, rows = slot * n_bins, np.arange(len(bins))
    for j in range(m):
        one = (features[:, j] == features[0, j]).all()
        place = base + (bins[:, features[0, j]] if one else bins[rows, features[slot, j]])
        for k, c in enumerate(channels):
            out[:, j, :, k] = np.bincount(place, c, n_slots * n_bins).reshape(n_slots, n_bins)
    return out


def newton_gain(part: np.ndarray, penalty: float) -> np.ndarray:
    return part[..., 0] ** 2 / (part[..., 1] + penalty)


def class_gain(part: np.ndarray) -> np.ndarray:
    weight = part[..., :-1].sum(-1)
    return np.divide((part[..., :-1] ** 2).sum(-1), weight, out=np.zeros_like(weight), where=weight > 0)


@dataclass
class Newton:
    """Boosting: channels gradient, hessian and number of rows."""

    penalty: float = 1.0
    least_child: float = 1.0
    least_gain: float = 1e-6

    def gains(self, left: np.ndarray, total: np.ndarray) -> np.ndarray:
        right = total - left
        gain = newton_gain(left, self.penalty) + newton_gain(right, self.penalty) - newton_gain(total, self.penalty)
        valid = (left[..., 1] >= self.least_child) & (right[..., 1] >= self.least_child) & (gain > self.least_gain)
        return np.where(valid, gain, -np.inf)


@dataclass
class Gini:
    """Forests: channels weight per class, last the number of rows."""

    def gains(self, left: np.ndarray, total: np.ndarray) -> np.ndarray:
        right = total - left
        gain = class_gain(left) + class_gain(right) - class_gain(total)
        return np.where((left[..., -1] > 0.5) & (right[..., -1] > 0.5), np.maximum(gain, 0.0), -np.inf)


def best_splits(hist: np.ndarray, features: np.ndarray, rule) -> list[Best]:
    """Best split of every slot; of equal gains the first feature in the slot's order, then the lowest bin."""
    total = hist[:, 0].sum(1)
    left = hist.cumsum(2)[:, :, :-1]
    gain = rule.gains(left, total[:, None, None, :])
    flat = gain.reshape(len(hist), -1)
    at = flat.argmax(1) if flat.shape[1] else np.zeros(len(hist), np.int64)
    out = []
    for s, k in enumerate(at.tolist()):
        f, b = divmod(k, gain.shape[2]) if gain.shape[2] else (0, 0)
        if gain.shape[2] and np.isfinite(flat[s, k]):
            out.append(Best(total[s], int(features[s, f]), b, float(flat[s, k]), left[s, f, b]))
        else:
            out.append(Best(total[s], -1, 0, 0.0, total[s]))
    return out


def _by_tree(units: list[Unit]) -> dict[int, list[int]]:
    found: dict[int, list[int]] = {}
    for i, u in enumerate(units):
        found.setdefault(u.tree, []).append(i)
    return found


def _tree_histogram(chunk: Chunk, growing: Growing, units: list[Unit], channels: Callable, n_bins: int, shape: int) -> np.ndarray:
    """The histogram of one tree's open nodes over one chunk."""
    slot_of = np.full(shape, -1)
    slot_of[[u.node for u in units]] = np.arange(len(units))
    slot = slot_of[growing.walk(chunk.bins)]
    kept, columns = channels(slot)
    return _histogram(chunk.bins[kept], slot[kept], np.stack([u.features for u in units]), columns, n_bins)


def spark_level(table: DataFrame, n_classes: int, units: list[Unit], trees: dict[int, Growing], channels: Callable, n_bins: int, rule,
                lanes: int, extra: Callable | None = None) -> tuple[dict[tuple[int, int], Best], list]:
    """One aggregate over all chunks: (best split per (tree, node), what ``extra`` returned per chunk).

    ``channels(chunk, tree, slot)`` gives the rows that count and their columns.
    """
    grouped = _by_tree(units)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        notes = []
        for row in _chunks(batches):
            chunk = _unpacked(row, n_classes)
            prepared = channels(chunk)
            if extra is not None:
                notes.append(extra(chunk, prepared))
            for t, mine in grouped.items():
                part = _tree_histogram(chunk, trees[t], [units[i] for i in mine], lambda slot, t=t: prepared(t, slot), n_bins, _size(trees[t]))
                if t in total:
                    total[t] += part
                else:
                    total[t] = part
        for t, hist in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([hist.tobytes()], pa.binary())], names=["tree", "blob"])
        if notes:
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([pickle.dumps(notes)], pa.binary())], names=["tree", "blob"])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        out = []
        for batch in batches:
            for t, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if t < 0:
                    out.append((t, blob))
                    continue
                mine = grouped[t]
                part = np.frombuffer(blob).reshape(len(mine), len(units[mine[0]].features), n_bins, -1)
                total[t] = total[t] + part if t in total else part
        for t, hist in total.items():
            out.append((t, pickle.dumps(best_splits(hist, np.stack([units[i].features for i in grouped[t]]), rule))))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in out], pa.int32()), pa.array([b for _, b in out], pa.binary())], names=["tree", "blob"])

    found, notes = {}, []
    shuffled = table.mapInArrow(sums, "tree int, blob binary").repartition(min(lanes, len(grouped)), "tree")
    for t, blob in shuffled.mapInArrow(best, "tree int, blob binary").collect():
        if t < 0:
            notes += pickle.loads(blob)
        else:
            found.update(((t, units[i].node), b) for i, b in zip(grouped[t], pickle.loads(blob), strict=True))
    return found, notes


def local_level(chunk: Chunk, units, trees, channels, n_bins, rule, extra=None):
    """The same over the one chunk of a small table, inside its task."""
    prepared = channels(chunk)
    found = {}
    for t, mine in _by_tree(units).items():
        own = [units[i] for i in mine]
        hist = _tree_histogram(chunk, trees[t], own, lambda slot, t=t: prepared(t, slot), n_bins, _size(trees[t]))
        found.update(((t, u.node), b) for u, b in zip(own, best_splits(hist, np.stack([u.features for u in own]), rule), strict=True))
    return found, [extra(chunk, prepared)] if extra is not None else []


def _size(tree: Growing) -> int:
    return len(tree.feature)


# ---------------------------------------------------------------------------
# Boosting
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Boosting:
    rounds: int
    depth: int
    rate: float
    rows: float
    columns: float
    seed: int
    penalty: float = 1.0
    least_child: float = 1.0


def _round_features(p: Boosting, r: int, c: int, n_features: int) -> np.ndarray:
    keep = max(1, round(p.columns * n_features))
    return np.sort(np.random.default_rng([p.seed, r, c]).permutation(n_features)[:keep])


def _added(margin: np.ndarray, bins: np.ndarray, later: list[list[Growing]]) -> np.ndarray:
    margin = margin.copy()
    for trees in later:
        for c, tree in enumerate(trees):
            margin[:, c] += _leaf_values(tree)[tree.walk(bins)]
    return margin


def _leaf_values(tree: Growing) -> np.ndarray:
    return tree.leaf if getattr(tree, "leaf", None) is not None else np.array(tree.value, float)


_MARGINS: "OrderedDict[tuple[str, bytes], tuple[int, np.ndarray]]" = OrderedDict()


def _margin(chunk: Chunk, later: list[list[Growing]], path: str) -> np.ndarray:
    """Margins of a chunk of the table ``path``. A worker keeps those of some chunks and adds only the rounds since."""
    place = path, hashlib.blake2b(chunk.key.tobytes(), digest_size=16).digest()
    for other in [k for k in _MARGINS if k[0] != path]:
        del _MARGINS[other]
    done, margin = _MARGINS.pop(place, (0, chunk.margin))
    if done > len(later):
        done, margin = 0, chunk.margin
    if done < len(later):
        margin = _added(margin, chunk.bins, later[done:])
    _MARGINS[place] = len(later), margin
    while sum(m.nbytes for _, m in _MARGINS.values()) > MARGIN_BYTES and len(_MARGINS) > 1:
        _MARGINS.popitem(last=False)
    return margin


def _gradients(p: Boosting, r: int, later: list[list[Growing]], path: str | None = None):
    """Softmax gradients and hessians of a chunk under the trees so far, for the rows sampled in round ``r``."""
    def prepare(chunk: Chunk):
        share = softmax(_added(chunk.margin, chunk.bins, later) if path is None else _margin(chunk, later, path))
        drawn = uniform(chunk.key, p.seed, r) < p.rows

        def of(tree: int, slot: np.ndarray):
            kept = np.nonzero((slot >= 0) & drawn)[0]
            q = share[kept, tree]
            w = chunk.weight[kept]
            return kept, [w * (q - (chunk.label[kept] == tree)), w * np.maximum(2.0 * q * (1.0 - q), 1e-16), np.ones(len(kept))]

        of.share = share
        return of

    return prepare


def _log_loss(chunk: Chunk, prepared) -> tuple[float, int]:
    right = prepared.share[np.arange(len(chunk.label)), chunk.label]
    return float(-np.log(np.maximum(right, 1e-15)).sum()), len(right)


def _grow_round(p: Boosting, r: int, n_classes: int, n_features: int, level: Callable, finish_rest: Callable | None = None,
                local_rows: int = 0, rows: int = 1) -> tuple[list[Growing], float]:
    """All classes' trees of one round, and the loss before them.

    ``level(units, trees, with_loss)`` sums one level; ``finish_rest(units, trees, with_loss)`` gives the subtrees of nodes with
    at most ``local_rows`` rows.
    """
    trees = {c: Growing() for c in range(n_classes)}
    features = [_round_features(p, r, c, n_features) for c in range(n_classes)]
    open_ = [(c, 0) for c in range(n_classes)]
    small: list[tuple[int, int]] = []
    notes: list = []

    def leaf(c: int, node: int, sums: np.ndarray) -> None:
        trees[c].value[node] = float(-p.rate * sums[0] / (sums[1] + p.penalty))
        trees[c].cover[node] = float(sums[1])

    for c in trees:
        # A tree without any sampled row adds nothing.
        leaf(c, 0, np.zeros(2))
    if rows <= local_rows:
        small, open_ = open_, []
    for depth in range(p.depth):
        if not open_:
            break
        found, told = level([Unit(c, node, features[c]) for c, node in open_], trees, depth == 0)
        notes += told
        following = []
        for c, node in open_:
            best = found.get((c, node))
            if best is not None and depth == 0:
                leaf(c, 0, best.total)
            if best is None or best.feature < 0:
                continue
            pair = trees[c].split(node, best.feature, best.bin, best.gain)
            for child, sums in zip(pair, (best.left, best.total - best.left), strict=True):
                leaf(c, child, sums)
                (small if sums[2] <= local_rows and depth + 1 < p.depth else following).append((c, child))
        open_ = following
    if small:
        parts, told = finish_rest([Unit(c, node, features[c]) for c, node in small], trees, not notes)
        notes += told
        for (c, node), part in parts.items():
            trees[c].graft(node, part)
    return [trees[c] for c in range(n_classes)], sum(s for s, _ in notes) / max(1, sum(n for _, n in notes))


def finish_boosted(bins: np.ndarray, g: np.ndarray, h: np.ndarray, features: np.ndarray, n_bins: int, p: Boosting, depth: int) -> dict:
    """A boosted subtree over the given rows; ``bins`` holds the columns ``features``, one row of bytes each.

    Of two children only the smaller one is summed, the other is what is left of their parent.
    """
    rule, tree = Newton(p.penalty, p.least_child), Growing()
    m, columns = len(features), list(bins)

    def sums(rows: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
        out = np.empty((n, m, n_bins, 2))
        at, a, b = slot * n_bins, g[rows], h[rows]
        for j, column in enumerate(columns):
            place = at + column[rows]
            out[:, j, :, 0] = np.bincount(place, a, minlength=n * n_bins).reshape(n, n_bins)
            out[:, j, :, 1] = np.bincount(place, b, minlength=n * n_bins).reshape(n, n_bins)
        return out

    def leaf(node: int, total: np.ndarray) -> None:
        tree.value[node], tree.cover[node] = float(-p.rate * total[0] / (total[1] + p.penalty)), float(total[1])

    members = [np.arange(len(g))]
    nodes, hist = [0], sums(members[0], np.zeros(len(g), np.int64), 1)
    leaf(0, hist[0, 0].sum(0))
    for _ in range(depth, p.depth):
        following, parents, small, large = [], [], [], []
        for i, best in enumerate(best_splits(hist, np.tile(features, (len(nodes), 1)), rule)):
            if best.feature < 0:
                continue
            pair = tree.split(nodes[i], best.feature, best.bin, best.gain)
            for child, total in zip(pair, (best.left, best.total - best.left), strict=True):
                leaf(child, total)
            below = columns[int(np.searchsorted(features, best.feature))][members[i]] <= best.bin
            parts = [members[i][below], members[i][~below]]
            less = int(len(parts[1]) < len(parts[0]))
            parents.append(i)
            small.append(parts[less])
            large.append(parts[1 - less])
            following += [pair[less], pair[1 - less]]
        if not following:
            break
        fresh = sums(np.concatenate(small), np.repeat(np.arange(len(small)), list(map(len, small))), len(small))
        rest = hist[parents] - fresh
        hist = np.stack([fresh, rest], 1).reshape(-1, m, n_bins, 2)
        nodes, members = following, [part for both in zip(small, large, strict=True) for part in both]
    names = ("feature", "bin", "left", "right", "gain", "depth", "value", "cover")
    return {k: np.array(getattr(tree, k)) for k in names}


def spark_finish(table: DataFrame, n_classes: int, units: list[Unit], trees: dict[int, Growing], prepare: Callable, n_bins: int, p: Boosting,
                 lanes: int, extra: Callable | None) -> tuple[dict[tuple[int, int], dict], list]:
    """Every unit's rows meet in one task, which finishes its subtree; units are dealt over the tasks."""
    grouped = _by_tree(units)
    depths = [trees[u.tree].depth[u.node] for u in units]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _chunks(batches):
            chunk = _unpacked(row, n_classes)
            prepared = prepare(chunk)
            rows = [(-1, pickle.dumps([extra(chunk, prepared)]), b"")] if extra is not None else []
            for t, mine in grouped.items():
                slot_of = np.full(_size(trees[t]), -1)
                slot_of[[units[i].node for i in mine]] = mine
                kept, (g, h, _) = prepared(t, slot_of[trees[t].walk(chunk.bins)])
                unit = slot_of[trees[t].walk(chunk.bins[kept])] if len(mine) > 1 else np.full(len(kept), mine[0])
                for i in mine:
                    own = unit == i
                    part = kept[own]
                    if len(part):
                        rows.append((i, np.ascontiguousarray(chunk.bins[part][:, units[i].features].T).tobytes(), np.stack([g[own], h[own]]).tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)],
                                                 names=["unit", "bins", "sums"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []

        def close():
            if current < 0:
                return pa.RecordBatch.from_arrays([pa.array([-1] * len(held), pa.int32()), pa.array([x for x, _ in held], pa.binary())], names=["unit", "blob"])
            features = units[current].features
            # Parts arrive in any order; sums must not depend on it.
            held.sort()
            bins = np.concatenate([np.frombuffer(x, np.uint8).reshape(len(features), -1) for x, _ in held], 1)
            g, h = np.concatenate([np.frombuffer(x).reshape(2, -1) for _, x in held], 1)
            part = finish_boosted(bins, g, h, features, n_bins, p, depths[current])
            return pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([pickle.dumps(part)], pa.binary())], names=["unit", "blob"])

        for batch in batches:
            for unit, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if unit != current:
                    if held:
                        yield close()
                    current, held = unit, []
                held.append(tuple(rest))
        if held:
            yield close()

    # One key a task where there are few: hashing a handful of keys would leave tasks idle and others with several.
    dealt = table.mapInArrow(deal, "unit int, bins binary, sums binary").repartitionById(min(lanes, len(units) + 1), F.pmod(F.col("unit"), F.lit(min(lanes, len(units) + 1))))
    parts, notes = {}, []
    for unit, blob in dealt.sortWithinPartitions("unit").mapInArrow(solve, "unit int, blob binary").collect():
        if unit < 0:
            notes += pickle.loads(blob)
        else:
            parts[units[unit].tree, units[unit].node] = pickle.loads(blob)
    return parts, notes


def _all_rounds_of_one_chunk(p: Boosting, n_classes: int, n_features: int, n_bins: int):
    rule = Newton(p.penalty, p.least_child)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _chunks(batches):
            chunk = _unpacked(row, n_classes)
            rounds, losses = [], []
            for r in range(p.rounds):
                prepared = _gradients(p, r, [])(chunk)
                trees, loss = _grow_round(p, r, n_classes, n_features, lambda units, trees, first: local_level(
                    chunk, units, trees, lambda _: prepared, n_bins, rule, _log_loss if first else None))
                chunk.margin = _added(chunk.margin, chunk.bins, [trees])
                rounds.append([t.__dict__ | {"_arrays": None} for t in trees])
                losses.append(loss)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((rounds, losses))], pa.binary())], names=["blob"])

    return run


class HeldRows:
    """Rows of one task while all rounds are boosted, a line per feature and per class, and where they are in the trees of a round."""

    def __init__(self, chunks: list[Chunk], n_features: int, n_classes: int, p: Boosting, n_bins: int):
        self.p, self.n_bins = p, n_bins
        self.bins = np.concatenate([np.zeros((n_features, 0), np.uint8), *(c.bins.T for c in chunks)], 1)
        self.label = np.concatenate([np.zeros(0, np.int64), *(c.label for c in chunks)])
        self.weight = np.concatenate([np.zeros(0), *(c.weight for c in chunks)])
        self.key = np.concatenate([np.zeros(0, np.uint64), *(c.key for c in chunks)])
        self.margin = np.zeros((n_classes, len(self.label)))

    def start(self, r: int) -> tuple[float, int]:
        """Gradients of round ``r``; returns the log loss before it."""
        e = np.exp(self.margin - self.margin.max(0))
        e /= e.sum(0)
        self.g, self.h = [], []
        for c, q in enumerate(e):
            self.g.append(self.weight * (q - (self.label == c)))
            self.h.append(self.weight * np.maximum(2.0 * q * (1.0 - q), 1e-16))
        drawn = uniform(self.key, self.p.seed, r) < self.p.rows
        # Rows of a node: those that were drawn, and the others, which only follow.
        both = np.nonzero(drawn)[0], np.nonzero(~drawn)[0]
        self.nodes = [{0: both} for _ in e]
        right = e[self.label, np.arange(len(self.label))]
        return float(-np.log(np.maximum(right, 1e-15)).sum()), len(right)

    def roots(self, features: list[np.ndarray]) -> list[np.ndarray]:
        """Sums of all classes' first nodes; the bins of the drawn rows are looked up once for all of them."""
        rows = self.nodes[0][0][0]
        out = [np.empty((1, len(f), self.n_bins, 2)) for f in features]
        weights = [(g[rows], h[rows]) for g, h in zip(self.g, self.h, strict=True)]
        for f, column in enumerate(self.bins):
            mine = [(c, int(np.searchsorted(own, f))) for c, own in enumerate(features) if f in own]
            if mine:
                place = column[rows].astype(np.int64)
                for c, j in mine:
                    for k in range(2):
                        out[c][0, j, :, k] = np.bincount(place, weights[c][k], self.n_bins)
        return out

    def sums(self, c: int, nodes: list[int], features: np.ndarray) -> np.ndarray:
        """(nodes, features, bins, 2): gradients and hessians of the drawn rows of some nodes."""
        parts = [self.nodes[c][node][0] for node in nodes] or [np.zeros(0, np.int64)]
        out = np.empty((len(nodes), len(features), self.n_bins, 2))
        if sum(map(len, parts)) > 2_048 * len(nodes):
            for i, rows in enumerate(parts):
                a, b = self.g[c][rows], self.h[c][rows]
                for j, f in enumerate(features.tolist()):
                    place = self.bins[f][rows].astype(np.int64)
                    out[i, j, :, 0], out[i, j, :, 1] = np.bincount(place, a, self.n_bins), np.bincount(place, b, self.n_bins)
            return out
        rows, at = np.concatenate(parts), np.repeat(np.arange(len(nodes)) * self.n_bins, list(map(len, parts)))
        a, b = self.g[c][rows], self.h[c][rows]
        for j, f in enumerate(features.tolist()):
            place = at + self.bins[f][rows]
            for k, channel in enumerate((a, b)):
                out[:, j, :, k] = np.bincount(place, channel, len(nodes) * self.n_bins).reshape(len(nodes), self.n_bins)
        return out

    def split(self, c: int, node: int, feature: int, bin_: int, pair: tuple[int, int]) -> None:
        """Rows of a node go to its children."""
        low, high = [], []
        for rows in self.nodes[c].pop(node):
            below = self.bins[feature][rows] <= bin_
            low.append(rows[below])
            high.append(rows[~below])
        self.nodes[c][pair[0]], self.nodes[c][pair[1]] = low, high

    def add(self, trees: list[Growing]) -> None:
        """Add the leaves of a finished round to the margins."""
        for c, tree in enumerate(trees):
            for node, both in self.nodes[c].items():
                for rows in both:
                    self.margin[c][rows] += tree.value[node]


def _best_of_class(held: HeldRows, c: int, nodes: list[int], hist: np.ndarray, features: np.ndarray, rule: Newton) -> tuple[list, np.ndarray]:
    """([(node, its sums, best split or None)], the sums of the nodes that split)."""
    out, split = [], []
    for i, (node, best) in enumerate(zip(nodes, best_splits(hist, np.tile(features, (len(nodes), 1)), rule), strict=True)):
        if best.feature < 0:
            out.append((node, best.total, None))
            continue
        # The owner's own rows, dealt like all others, tell which child is the smaller one.
        rows = held.nodes[c][node][0]
        below = int(np.count_nonzero(held.bins[best.feature][rows] <= best.bin))
        out.append((node, best.total, (best.feature, best.bin, best.gain, best.left, best.total - best.left, int(len(rows) < 2 * below))))
        split.append(i)
    return out, hist[split]


def _round_together(p: Boosting, r: int, held: HeldRows, exchange: Exchange, me: int, tasks: int, rule: Newton) -> tuple[list[Growing], float]:
    """One round in one of the tasks: all of them build the same trees. The loss is known to the first."""
    n_classes, n_bins = len(held.margin), held.n_bins
    features = [_round_features(p, r, c, len(held.bins)) for c in range(n_classes)]
    trees = [Growing() for _ in range(n_classes)]
    owners = range(min(tasks, n_classes))
    mine = [c for c in range(n_classes) if c % len(owners) == me]
    note, told = np.array(held.start(r), float), np.zeros(2)
    # Open nodes of a class as pairs: the one whose rows are summed, and the one that gets what is left of their parent's sums.
    open_: list[list[tuple[int, ...]]] = [[(0,)] for _ in range(n_classes)]
    parents: dict[int, np.ndarray] = {}

    def leaf(c: int, node: int, total: np.ndarray) -> None:
        trees[c].value[node], trees[c].cover[node] = float(-p.rate * total[0] / (total[1] + p.penalty)), float(total[1])

    for depth in range(p.depth):
        if not any(open_):
            break
        if depth == 0:
            own = held.roots(features)
        else:
            own = [held.sums(c, [pair[0] for pair in pairs], features[c]) for c, pairs in enumerate(open_)]
        shapes, starts = [a.shape for a in own], np.cumsum([note.nbytes, *(a.nbytes for a in own)]).tolist()
        sums, best = f"{r}-{depth}-sums", f"{r}-{depth}-best"
        exchange.put(f"{sums}-{me}", [note, *own])
        del own
        if mine:
            def read(source, starts=starts, shapes=shapes):
                said = np.frombuffer(source.read(starts[0]))
                parts = []
                for c in mine:
                    source.seek(starts[c])
                    parts.append(np.frombuffer(source.read(starts[c + 1] - starts[c])).reshape(shapes[c]))
                return said, parts

            total = [np.zeros(shapes[c]) for c in mine]
            # Added up in the order of tasks, whichever came first.
            for a in range(0, tasks, READ_AT_ONCE):
                for said, parts in exchange.each([f"{sums}-{t}" for t in range(a, min(a + READ_AT_ONCE, tasks))], read):
                    told = told + said if depth == 0 else told
                    for whole, part in zip(total, parts, strict=True):
                        whole += part
            exchange.drop_kept()
            answer = {}
            for c, fresh in zip(mine, total, strict=True):
                if not open_[c]:
                    continue
                hist = fresh if depth == 0 else np.stack([fresh, parents[c] - fresh], 1).reshape(-1, *fresh.shape[1:])
                answer[c], parents[c] = _best_of_class(held, c, [node for pair in open_[c] for node in pair], hist, features[c], rule)
            exchange.put(f"{best}-{me}", [pickle.dumps(answer)])
            exchange.keep(f"{best}-{me}")
        answers = exchange.each([f"{best}-{o}" for o in owners], lambda source: pickle.loads(source.read()))
        exchange.drop(f"{sums}-{me}")
        open_ = [[] for _ in range(n_classes)]
        for c, (node, sums_of_node, found) in ((c, one) for part in answers for c, ones in part.items() for one in ones):
            if depth == 0:
                leaf(c, node, sums_of_node)
            if found is not None:
                feature, bin_, gain, left, right, less = found
                pair = trees[c].split(node, feature, bin_, gain)
                leaf(c, pair[0], left)
                leaf(c, pair[1], right)
                held.split(c, node, feature, bin_, pair)
                open_[c].append((pair[less], pair[1 - less]))
    return trees, float(told[0] / max(1.0, told[1]))


def _boosted_together(p: Boosting, n_classes: int, n_features: int, n_bins: int, folder: str):
    """All rounds in tasks that run at the same time and keep their rows.

    A level is two messages. Every task writes the sums of its rows; the owner of a class adds them up in the order of tasks and
    writes the best splits, with the child whose rows are summed next. The other child's sums are what is left of the parent's.
    """
    rule = Newton(p.penalty, p.least_child)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        me, tasks = context.partitionId(), len(context.getTaskInfos())
        # A stage that starts again must not read what its first attempt left.
        exchange = Exchange(folder, context.allGather(uuid.uuid4().hex)[0])
        chunks = sorted(_chunks(batches), key=lambda row: row[4])
        held = HeldRows([_unpacked(row, n_classes) for row in chunks], n_features, n_classes, p, n_bins)
        del chunks
        rounds, losses = [], []
        for r in range(p.rounds):
            trees, loss = _round_together(p, r, held, exchange, me, tasks, rule)
            held.add(trees)
            if me == 0:
                rounds.append([t.__dict__ | {"_arrays": None} for t in trees])
                losses.append(loss)
        if me == 0:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((rounds, losses))], pa.binary())], names=["blob"])

    return run


def _tasks_together(spark: SparkSession, data: Binned) -> int | None:
    """How many tasks can hold all rows at the same time, if they can."""
    n = slots(spark)
    if not n:
        return None
    tasks = min(n, data.chunks)
    row = len(data.cuts) + 64 + 32 * data.n_classes
    return tasks if (data.rows // tasks + CHUNK) * row <= HELD_BYTES else None


def _dealt(table: DataFrame, tasks: int) -> DataFrame:
    """Chunks in ``tasks`` parts with about as many rows each; the same rows give the same parts."""
    # Chunks with the same rows are told apart by where they are.
    place = F.struct(F.xxhash64("key").alias("a"), F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("b"))
    found = sorted(((r.p.a, r.p.b), r.n) for r in table.select(place.alias("p"), "n").collect())
    ends = np.cumsum([n for _, n in found])
    part = ((ends - np.array([n for _, n in found]) / 2) * tasks / ends[-1]).astype(int)
    firsts = [found[i][0] for i in np.searchsorted(part, range(1, tasks)).tolist() if i < len(found)]
    later = [(place >= F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b"))).cast("int") for a, b in firsts]
    return table.withColumn("_part", sum(later, F.lit(0))).repartitionById(tasks, F.col("_part")).select(*CHUNK_NAMES)


def boost(df: DataFrame, p: Boosting, bins: int = BINS, chunk: int = CHUNK, local_rows: int | None = None) -> TreeModel:
    """Softmax boosting over (features, label): one tree a class and round. ``history`` of the model is the mean log loss before each round.

    A table of one chunk is boosted inside its task. All rounds of a larger one are one job, when there are more than a few of them and
    the tasks that run at once can hold its rows. Otherwise, or with ``local_rows``, each level of a round is one aggregate, and nodes of at most ``local_rows``
    rows are finished in one task each, all of a round in one job.
    """
    spark = df.sparkSession
    data = bin_rows(df, bins, chunk=chunk)
    n_features, n_bins = len(data.cuts), max(len(c) for c in data.cuts) + 1
    lanes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rule = Newton(p.penalty, p.least_child)
    # A few rounds are not worth dealing all rows and starting tasks together.
    together = _tasks_together(spark, data) if data.chunks > 1 and local_rows is None and p.rounds >= TOGETHER_ROUNDS else None
    local_rows = BOOSTED_ROWS if local_rows is None else local_rows
    if data.chunks == 1 or together:
        if together:
            folder = fresh_folder(spark)
            dealt = _dealt(data.table(spark), together)
            found = dealt.mapInArrow(_boosted_together(p, data.n_classes, n_features, n_bins, folder), "blob binary", barrier=True).collect()
            discard(spark, folder)
        else:
            found = data.table(spark).mapInArrow(_all_rounds_of_one_chunk(p, data.n_classes, n_features, n_bins), "blob binary").collect()
        kept, losses = pickle.loads(found[0][0])
        rounds = []
        for trees in kept:
            rounds.append([])
            for state in trees:
                tree = Growing()
                tree.__dict__.update(state)
                rounds[-1].append(tree)
    else:
        rounds, losses, written_rounds, table = [], [], 0, data.table(spark)
        for r in range(p.rounds):
            later = rounds[written_rounds:]
            prepare = _gradients(p, r, later, data.path)

            def level(units, trees, first, table=table, prepare=prepare):
                return spark_level(table, data.n_classes, units, trees, prepare, n_bins, rule, lanes, _log_loss if first else None)

            def finish_rest(units, trees, first, table=table, prepare=prepare):
                return spark_finish(table, data.n_classes, units, trees, prepare, n_bins, p, lanes, _log_loss if first else None)

            trees, loss = _grow_round(p, r, data.n_classes, n_features, level, finish_rest, local_rows, data.rows)
            rounds.append(trees)
            losses.append(loss)
            if len(rounds) - written_rounds == KEEP_ROUNDS and r + 1 < p.rounds:
                path = stored_at(table.mapInArrow(_with_margins(rounds[written_rounds:], data.n_classes), CHUNKS))
                discard(spark, data.path)
                data.path, written_rounds, table = path, len(rounds), spark.read.schema(CHUNKS).parquet(path)
    discard(spark, data.path)
    flat = [t for trees in rounds for t in trees]
    return _fitted("boosted", flat, [c for trees in rounds for c in range(len(trees))], data.cuts, data.n_classes, losses)


def _with_margins(later: list[list[Growing]], n_classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _chunks(batches):
            chunk = _unpacked(row, n_classes)
            chunk.margin = _added(chunk.margin, chunk.bins, later)
            yield _chunk_batch([_packed(chunk)])

    return run


# ---------------------------------------------------------------------------
# Forests
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Forest:
    trees: int
    depth: int | None
    min_split: int
    seed: int
    features: int | None = None

    def tried(self, n_features: int) -> int:
        return self.features or max(1, int(np.sqrt(n_features)))


def bootstrap(key: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often each row is drawn for a tree: Poisson with mean 1."""
    return np.searchsorted(POISSON, uniform(key, seed, tree), side="right").astype(float)


def _by_slot_and_bin(slot: np.ndarray, bin_: np.ndarray, n_slots: int) -> np.ndarray:
    """The stable order by slot, then bin; numbers of 8 and 16 bits are sorted in linear time."""
    by = np.argsort(bin_, kind="stable")
    if n_slots == 1:
        return by
    kind = np.uint8 if n_slots <= 1 << 8 else np.uint16 if n_slots <= 1 << 16 else np.int64
    return by[np.argsort(slot[by].astype(kind), kind="stable")]


def finish(bins: np.ndarray, label: np.ndarray, weight: np.ndarray, n_classes: int, p: Forest, depth: int, rng: np.random.Generator) -> dict:
    """A whole subtree over the given rows, all its nodes of a level together.

    Each node looks at ``tried`` features in an order of its own, and at more only while none of them splits its rows. Rows
    are sorted by node and bin, and class weights summed along, so the work of a level does not depend on its nodes.
    """
    n_features, tried = bins.shape[1], p.tried(bins.shape[1])
    feature, split, left, right, gain, level = ([np.array([v])] for v in (-1, 0, -1, -1, 0.0, 0))
    sums = [np.bincount(label, weight, n_classes)[None, :]]
    slot, base, made, at = np.zeros(len(label), np.int64), 0, 1, depth
    while len(label):
        total = sums[-1]
        n_nodes = len(total)
        count = np.bincount(slot, minlength=n_nodes)
        open_ = (count >= p.min_split) & ((total > 0).sum(1) > 1)
        if p.depth is not None and at >= p.depth:
            open_[:] = False
        best_gain, best_f, best_b = np.full(n_nodes, -np.inf), np.full(n_nodes, -1), np.zeros(n_nodes, np.int64)
        order_of = rng.permuted(np.tile(np.arange(n_features), (n_nodes, 1)), axis=1)
        parent = (total ** 2).sum(1) / total.sum(1)
        for k in range(n_features):
            look = open_ if k < tried else open_ & (best_f < 0)
            mine = np.nonzero(look[slot])[0]
            if not len(mine):
                break
            s = slot[mine]
            b = bins[mine, order_of[s, k]]
            by = _by_slot_and_bin(s, b, n_nodes)
            s = s[by]
            key = s * 256 + b[by]
            own, drawn = label[mine[by]], weight[mine[by]]
            run = [np.cumsum(np.where(own == c, drawn, 0.0)) for c in range(n_classes)]
            ends = np.nonzero(key[1:] != key[:-1])[0]
            ends = ends[s[ends] == s[ends + 1]]
            if not len(ends):
                continue
            first = np.searchsorted(s, s[ends])
            low = np.stack([r[ends] - np.where(first > 0, r[np.maximum(first - 1, 0)], 0.0) for r in run], 1)
            high = total[s[ends]] - low
            found = (low ** 2).sum(1) / low.sum(1) + (high ** 2).sum(1) / np.maximum(high.sum(1), 1e-300) - parent[s[ends]]
            starts = np.nonzero(np.concatenate([[True], s[ends][1:] != s[ends][:-1]]))[0]
            top = np.maximum.reduceat(found, starts)
            node = s[ends][starts]
            size = np.diff(np.append(starts, len(ends)))
            is_top = np.nonzero(found == np.repeat(top, size))[0]
            place = is_top[np.searchsorted(is_top, starts)]
            better = top > best_gain[node]
            node, place, top = node[better], place[better], top[better]
            best_gain[node], best_f[node], best_b[node] = top, order_of[node, k], key[ends[place]] % 256
        inner = best_f >= 0
        child = np.full(n_nodes, -1)
        child[inner] = 2 * np.arange(inner.sum())
        feature[-1], split[-1] = np.where(inner, best_f, -1), np.where(inner, best_b, 0)
        left[-1], right[-1] = np.where(inner, made + child, -1), np.where(inner, made + child + 1, -1)
        gain[-1] = np.where(inner, np.maximum(best_gain, 0.0), 0.0)
        n_new = 2 * int(inner.sum())
        if not n_new:
            break
        stay = np.nonzero(inner[slot])[0]
        s = slot[stay]
        slot = child[s] + (bins[stay, best_f[s]] > best_b[s])
        bins, label, weight = bins[stay], label[stay], weight[stay]
        made, at = made + n_new, at + 1
        fresh = np.bincount(slot * n_classes + label, weight, n_new * n_classes).reshape(n_new, n_classes)
        for column, empty in ((feature, -1), (split, 0), (left, -1), (right, -1), (gain, 0.0), (level, at - depth)):
            column.append(np.full(n_new, empty))
        sums.append(fresh)
    value = np.concatenate(sums)
    cover = value.sum(1)
    shares = np.divide(value, cover[:, None], out=np.full_like(value, 1.0 / n_classes), where=cover[:, None] > 0)
    flat = {"feature": feature, "bin": split, "left": left, "right": right, "gain": gain, "depth": level}
    return {k: np.concatenate(v) for k, v in flat.items()} | {"value": shares, "cover": cover}


def _deal(units: list[tuple[int, int]], trees: dict[int, Growing], seed: int, n_classes: int):
    """(tree, node, rows) of every node that a single task will finish."""
    wanted: dict[int, np.ndarray] = {}
    for t in {t for t, _ in units}:
        wanted[t] = np.zeros(_size(trees[t]), bool)
    for t, node in units:
        wanted[t][node] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _chunks(batches):
            chunk = _unpacked(row, n_classes)
            rows, held = [], 0
            for t, open_ in wanted.items():
                drawn = bootstrap(chunk.key, seed, t)
                node = trees[t].walk(chunk.bins)
                mine = np.nonzero((drawn > 0) & open_[node])[0]
                mine = mine[np.argsort(node[mine], kind="stable")]
                cuts = np.concatenate([[0], np.nonzero(np.diff(node[mine]))[0] + 1, [len(mine)]])
                for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
                    if b > a:
                        part = mine[a:b]
                        rows.append((t, int(node[part[0]]), chunk.bins[part].tobytes(), chunk.label[part].astype("<i4").tobytes(),
                                     (drawn[part] * chunk.weight[part]).tobytes(), chunk.key[part].tobytes()))
                        held += len(rows[-1][2])
                if held > 8_000_000:
                    yield _dealt_batch(rows)
                    rows, held = [], 0
            if rows:
                yield _dealt_batch(rows)

    return run


DEALT = "tree int, node int, bins binary, label binary, weight binary, key binary"


def _dealt_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), *[pa.binary()] * 4)
    names = [c.split()[0] for c in DEALT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _finish_all(depths: dict[tuple[int, int], int], n_classes: int, n_features: int, p: Forest):
    """Rows come sorted by (tree, node); one node's rows are held at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []

        def close():
            bins, label, weight, key = (b"".join(c) for c in zip(*held, strict=True))
            label, weight, key = np.frombuffer(label, "<i4").astype(np.int64), np.frombuffer(weight), np.frombuffer(key, "<u8")
            # The order in which chunks arrive must not decide between equal gains.
            by = np.argsort(key, kind="stable")
            part = finish(np.frombuffer(bins, np.uint8).reshape(-1, n_features)[by], label[by], weight[by], n_classes, p,
                          depths[current], np.random.default_rng([p.seed, *current]))
            return pa.RecordBatch.from_arrays([pa.array([current[0]], pa.int32()), pa.array([current[1]], pa.int32()),
                                               pa.array([pickle.dumps(part)], pa.binary())], names=["tree", "node", "blob"])

        for batch in batches:
            for t, node, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (t, node) != current:
                    if held:
                        yield close()
                    current, held = (t, node), []
                held.append(rest)
        if held:
            yield close()

    return run


def _class_sums(seed: int, n_classes: int):
    """Class weights and numbers of rows drawn for a tree, for rows in open nodes."""
    def prepare(chunk: Chunk):
        def of(tree: int, slot: np.ndarray):
            drawn = bootstrap(chunk.key, seed, tree)
            kept = np.nonzero((slot >= 0) & (drawn > 0))[0]
            weight = drawn[kept] * chunk.weight[kept]
            return kept, [*(np.where(chunk.label[kept] == c, weight, 0.0) for c in range(n_classes)), np.ones(len(kept))]

        return of

    return prepare


def _split_large(spark: SparkSession, table: DataFrame, data: Binned, trees: dict[int, Growing], p: Forest, local_rows: int, lanes: int) -> list[tuple[int, int]]:
    """Split nodes by aggregates until none that may split holds more than ``local_rows``; the others are returned."""
    n_features, n_bins = len(data.cuts), max(len(c) for c in data.cuts) + 1
    if data.rows <= local_rows:
        return [(t, 0) for t in trees]
    small, open_ = [], [(t, 0) for t in trees]
    tried = p.tried(n_features)
    room = max(1, LEVEL_BYTES // (tried * n_bins * (data.n_classes + 1) * 8))
    turn = {unit: 0 for unit in open_}
    while open_:
        following = []
        for a in range(0, len(open_), room):
            units = []
            for t, node in open_[a:a + room]:
                order = np.random.default_rng([p.seed, t, node, 1]).permutation(n_features)
                first = turn[t, node] * tried
                units.append(Unit(t, node, np.resize(order[first:first + tried], tried)))
            found, _ = spark_level(table, data.n_classes, units, trees, _class_sums(p.seed, data.n_classes), n_bins, Gini(), lanes)
            for u in units:
                best, tree = found.get((u.tree, u.node)), trees[u.tree]
                if best is None:
                    small.append((u.tree, u.node))
                    continue
                total = best.total[:-1]
                tree.value[u.node], tree.cover[u.node] = total / max(total.sum(), 1e-300), float(total.sum())
                if (total > 0).sum() < 2 or best.total[-1] < p.min_split or (p.depth is not None and tree.depth[u.node] >= p.depth):
                    continue
                if best.feature < 0:
                    # None of these features splits the rows: look at the next ones, as long as there are any.
                    turn[u.tree, u.node] += 1
                    if turn[u.tree, u.node] * tried < n_features:
                        following.append((u.tree, u.node))
                    continue
                pair = tree.split(u.node, best.feature, best.bin, best.gain)
                for child, sums in zip(pair, (best.left, best.total - best.left), strict=True):
                    weight = sums[:-1].sum()
                    tree.value[child], tree.cover[child] = sums[:-1] / max(weight, 1e-300), float(weight)
                    turn[u.tree, child] = 0
                    (small if sums[-1] <= local_rows else following).append((u.tree, child))
        open_ = following
    return small


def _whole_trees(folder: str, files: list[str], cuts: list[np.ndarray], n_classes: int, p: Forest):
    """Trees by number: a task reads the binned rows once, from the files of their table, and grows its trees over them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = None
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if bins is None:
                    bins, label, weight, key = _rows_by_key(files, n_classes)
                drawn = bootstrap(key, p.seed, t)
                mine = np.nonzero(drawn > 0)[0]
                parts = [(0, finish(bins[mine], label[mine], drawn[mine] * weight[mine], n_classes, p, 0,
                                    np.random.default_rng([p.seed, t, 0])))] if len(mine) else []
                yield _tree_batch([(t, *_write_tree(folder, t, _joined(vars(Growing()), parts, cuts, n_classes), len(cuts)))])

    return run


def _rows_by_key(files: list[str], n_classes: int) -> tuple[np.ndarray, ...]:
    """Bins, labels, weights and keys of a table of chunks; the order in which files lie must not decide between equal gains."""
    chunks = []
    for path in files:
        with open_file(path) as source:
            chunks += [_unpacked(row, n_classes) for row in _chunks(pq.read_table(source, columns=CHUNK_NAMES).to_batches())]
    key = np.concatenate([c.key for c in chunks])
    by = np.argsort(key, kind="stable")
    return *(np.concatenate([getattr(c, name) for c in chunks])[by] for name in ("bins", "label", "weight")), key[by]


def grow_forest(df: DataFrame, p: Forest, balanced: bool = True, bins: int = BINS, chunk: int = CHUNK, local_rows: int | None = None) -> StoredForest:
    """A forest over (features, label): Poisson bootstrap weights, class weights, no depth limit unless one is given.

    A node splits while it holds at least ``min_split`` drawn rows of several classes. Trees over at most ``WHOLE_ROWS`` rows are
    grown whole, each by one task. Over more, or with ``local_rows``, they are grown in batches whose drawn rows stay below a
    bound; the tasks that finish nodes hold at most ``local_rows`` of them at once. Trees are written by tasks, one file each,
    and never come to the driver.
    """
    spark = df.sparkSession
    data = bin_rows(df, bins, balanced, chunk)
    table = data.table(spark)
    if local_rows is None and data.rows <= WHOLE_ROWS:
        trees = spread_rows(spark, [(t,) for t in range(p.trees)], "tree int", "tree", lanes_at_once(spark))
        found = trees.mapInArrow(_whole_trees(fresh_folder(spark), table.inputFiles(), data.cuts, data.n_classes, p), TREES).collect()
        discard(spark, data.path)
        return _stored(found, len(data.cuts), data.n_classes)
    local_rows = local_rows or LOCAL_ROWS
    lanes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    batch = max(1, min(p.trees, BATCH_ROWS // max(1, data.rows)))
    folder, grown = fresh_folder(spark), []
    for a in range(0, p.trees, batch):
        trees = {t: Growing() for t in range(a, min(a + batch, p.trees))}
        small = _split_large(spark, table, data, trees, p, local_rows, lanes)
        depths = {(t, node): trees[t].depth[node] for t, node in small}
        tops = {t: {k: getattr(tree, k) for k in ("feature", "bin", "left", "right", "cover", "gain", "value")} for t, tree in trees.items()}
        dealt = table.mapInArrow(_deal(small, trees, p.seed, data.n_classes), DEALT).repartition(lanes, "tree", "node")
        done = dealt.sortWithinPartitions("tree", "node").mapInArrow(
            _finish_all(depths, data.n_classes, len(data.cuts), p), "tree int, node int, blob binary")
        if any(node for _, node in small):
            # Subtrees of one tree come from several tasks.
            done = done.repartition(lanes, "tree").sortWithinPartitions("tree", "node")
        found = done.mapInArrow(_store_trees(folder, tops, data.cuts, data.n_classes), TREES).collect() if small else []
        # A tree that was split to its end by aggregates, or got no row, has no finished part.
        rest = sorted(set(trees) - {r.tree for r in found})
        grown += [*found, *((t, *_write_tree(folder, t, _joined(tops[t], [], data.cuts, data.n_classes), len(data.cuts))) for t in rest)]
    discard(spark, data.path)
    return _stored(grown, len(data.cuts), data.n_classes)


def _store_trees(folder: str, tops: dict[int, dict], cuts: list[np.ndarray], n_classes: int):
    """Finished parts come sorted by tree; one tree is held at a time, and only where its file lies goes back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []

        def close():
            return _tree_batch([(current, *_write_tree(folder, current, _joined(tops[current], held, cuts, n_classes), len(cuts)))])

        for batch in batches:
            for t, node, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if t != current:
                    if held:
                        yield close()
                    current, held = t, []
                held.append((node, pickle.loads(blob)))
        if held:
            yield close()

    return run
