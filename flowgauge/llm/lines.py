"""Line dedup: two Bloom filters of line hashes, then an exact answer for the few lines that may repeat.

Every task reduces the lines of its texts to distinct 64-bit hashes; a hash remembers whether the task met it in one
document or in several. Hashes are dealt to segments by their value, and a segment's task streams them through two filters
of a size fixed by the number of lines: a hash whose bits are all in the once-seen filter also goes into the twice-seen
filter. Only the twice-seen filter is kept, as an array that workers map. A line that it does not know is unique; the others
are shuffled with their whole content, which decides exactly, and the document with the smallest id keeps them. Neither all
lines nor all texts meet in one place, and a line that a third of all documents hold is one row per task at every step.
"""

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import lookup, shared_folder, written
from .arrays import load, save
from .common import texts

SHORTEST = 10
SEGMENT_LINES = 4_000_000
BITS_PER_LINE = 16
FLUSH = 1_000_000
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"


def line_keys(data: bytes) -> list[bytes]:
    """Lines of a text as they are compared: bare at both ends, A-Z lower-cased."""
    return [line.strip(SPACES) for line in data.lower().split(b"\n")]


def long_enough(key: bytes, shortest: int = SHORTEST) -> bool:
    """At least ``shortest`` code points, that is bytes which do not continue one."""
    return len(key) >= shortest and (len(key) >= 4 * shortest or sum(b & 0xC0 != 0x80 for b in key) >= shortest)


def name_of(key: bytes) -> bytes:
    """A line's name on the way back to its documents; that lines are equal is decided on their content."""
    return hashlib.blake2b(key, digest_size=16).digest()


class TwoFilters:
    """Once-seen and twice-seen Bloom filters of one segment, blocked: a hash has four bits in one 64-bit word."""

    def __init__(self, lines: int):
        self.once = np.zeros(words_of(lines), np.uint64)
        self.twice = np.zeros_like(self.once)

    def add(self, hashes: np.ndarray, several: np.ndarray) -> None:
        """Each hash once per call; ``several`` marks those that their task has met in more than one document."""
        word, bits = place(hashes, len(self.once))
        again = several | ((self.once[word] & bits) == bits)
        np.bitwise_or.at(self.twice, word[again], bits[again])
        np.bitwise_or.at(self.once, word, bits)


def words_of(lines: int) -> int:
    return max(1, -(-lines * BITS_PER_LINE // 64))


def place(hashes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Word and bits of each hash: the word from the low half, four bits from the high half."""
    low, bits = hashes & np.uint64(0xFFFFFFFF), np.zeros(len(hashes), np.uint64)
    for shift in (32, 38, 44, 50):
        bits |= np.uint64(1) << (hashes >> np.uint64(shift) & np.uint64(63))
    return (low * np.uint64(words) >> np.uint64(32)).astype(np.int64), bits


def segment_of(hashes: np.ndarray, segments: int) -> np.ndarray:
    """Dealt by the top bits and others that neither word nor bits are made of alone."""
    turned = (hashes ^ hashes >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15)
    return ((turned >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)


def _document_hashes(data: bytes, shortest: int) -> set[int]:
    digest = xxhash.xxh3_64_intdigest
    return {digest(k) for k in set(line_keys(data)) if long_enough(k, shortest)}


def _task_hashes(shortest: int, segments: int):
    """(segment, h, several): the distinct hashes of a stretch of documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[int] = []

        def flush():
            values, n = np.unique(np.array(held, np.uint64), return_counts=True)
            for a in range(0, len(values), 100_000):
                part = values[a:a + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(segment_of(part, segments).astype(np.int32)), pa.array(part.view(np.int64)), pa.array(n[a:a + 100_000] > 1)],
                    names=["segment", "h", "several"])

        for batch in batches:
            for data in batch.column(0).cast(pa.binary()):
                held.extend(_document_hashes(data.as_py(), shortest))
                if len(held) > FLUSH:
                    yield from flush()
                    held.clear()
        if held:
            yield from flush()

    return run


def _segment_filters(segments: int, lines: int, folder: str):
    """One segment after the other; its hashes come in any number of batches, a batch may hold several segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, filters = -1, None

        def close():
            save(folder, f"twice-{current}", filters.twice)
            return pa.RecordBatch.from_arrays([pa.array([current], pa.int32())], names=["segment"])

        for batch in batches:
            segment = batch.column(0).to_numpy()
            hashes, several = batch.column(1).to_numpy().view(np.uint64), batch.column(2).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.nonzero(segment[1:] != segment[:-1])[0] + 1).tolist(), len(segment)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if segment[a] != current:
                    if filters is not None:
                        yield close()
                    current, filters = int(segment[a]), TwoFilters(lines)
                values, at, n = np.unique(hashes[a:b], return_index=True, return_counts=True)
                filters.add(values, several[a:b][at] | (n > 1))
        if filters is not None:
            yield close()

    return run


class TwiceSeen:
    """The stored twice-seen filters; a worker maps the segments it asks."""

    def __init__(self, folder: str, segments: int, present: list[int]):
        self.folder, self.segments, self.present = folder, segments, frozenset(present)
        self._open: dict[int, np.ndarray] = {}

    def __getstate__(self):
        return self.__dict__ | {"_open": {}}

    def suspected(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), bool)
        segment = segment_of(hashes, self.segments)
        for s in np.unique(segment).tolist():
            if s not in self.present:
                continue
            if s not in self._open:
                self._open[s] = load(self.folder, f"twice-{s}")
            mine = np.nonzero(segment == s)[0]
            word, bits = place(hashes[mine], len(self._open[s]))
            out[mine] = (self._open[s][word] & bits) == bits
        return out


def _suspects(twice: TwiceSeen, shortest: int, names: list[str]):
    """(doc_id, digest, key) of each line that may repeat, once per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, keys, hashes = [], [], []
            for i, data in enumerate(batch.column(1).cast(pa.binary())):
                mine = [k for k in set(line_keys(data.as_py())) if long_enough(k, shortest)]
                keys += mine
                at += [i] * len(mine)
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))
            found = np.nonzero(twice.suspected(hashes))[0].tolist()
            size = 0
            start = 0
            for k, f in enumerate(found):
                size += len(keys[f])
                if size > 16_000_000 or k + 1 == len(found):
                    part = found[start:k + 1]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array([at[f] for f in part], pa.int64())),
                         pa.array([name_of(keys[f]) for f in part], pa.binary()),
                         pa.array([keys[f] for f in part], pa.binary())], names=names)
                    size, start = 0, k + 1

    return run


def _without(shortest: int):
    """Texts without the lines whose digest is listed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n_lines, n_dropped = [], [], []
            for data, gone in zip(batch.column(1).cast(pa.binary()), batch.column(2).to_pylist(), strict=True):
                data = data.as_py()
                lines = data.count(b"\n") + 1
                left = lines
                if gone:
                    gone = set(gone)
                    stay = [line for line, key in zip(data.split(b"\n"), line_keys(data), strict=True)
                            if not (long_enough(key, shortest) and name_of(key) in gone)]
                    data, left = b"\n".join(stay), len(stay)
                kept.append(data)
                n_lines.append(lines)
                n_dropped.append(lines - left)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary()).view(pa.string())],
                names=["doc_id", "n_lines", "n_dropped", "kept"])

    return run


def _holder():
    """A document's place in the order of ids; a null id comes last."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST,
                        segment_lines: int = SEGMENT_LINES) -> DataFrame:
    """Every document without the lines that a document with a smaller id holds: (doc_id, n_lines, n_dropped, kept).

    Lines are compared without white space at their ends and with A-Z lower-cased; those of fewer than ``shortest`` code
    points always stay. The document with the smallest id keeps all its lines. Null texts are empty, an empty text is one
    empty line. Rows that share an id are one document: none loses a line because another of them holds it. A null id is an
    id too and comes last. Empty tables give empty results; other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    rows = texts(docs, id_col, text_col)
    lines = rows.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1)).first()[0] or 0
    lanes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    segments = max(lanes, -(-lines // segment_lines))
    folder = f"{shared_folder(spark).rstrip('/')}/lines-{uuid.uuid4().hex}"
    dealt = rows.select("text").mapInArrow(_task_hashes(shortest, segments), "segment int, h long, several boolean")
    # The segments hold unequal shares of the lines only by chance, so one and a half times the mean is room enough.
    stored = dealt.repartition(lanes, "segment").sortWithinPartitions("segment").mapInArrow(
        _segment_filters(segments, 3 * (lines // segments + 64) // 2, folder), "segment int")
    twice = TwiceSeen(folder, segments, [r[0] for r in stored.collect()])
    kind = docs.schema[id_col].dataType.simpleString()
    suspects = written(rows.mapInArrow(_suspects(twice, shortest, ["doc_id", "digest", "key"]), f"doc_id {kind}, digest binary, key binary"))
    held = suspects.groupBy("digest", "key").agg(F.min(_holder()).alias("first"), F.max(_holder()).alias("last"))
    found = written(held.filter("first != last").select("digest", "first"))
    gone = lookup(suspects.select("doc_id", "digest"), found, ["digest"], "inner").filter(F.col("first") != _holder())
    per_doc = gone.groupBy("doc_id").agg(F.collect_set("digest").alias("gone"))
    named = per_doc.select(F.col("doc_id").alias("_id"), "gone")
    return rows.join(named, rows["doc_id"].eqNullSafe(named["_id"]), "left").select("doc_id", "text", "gone").mapInArrow(
        _without(shortest), f"doc_id {kind}, n_lines long, n_dropped long, kept string")
