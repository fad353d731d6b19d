"""Removal of repeated passages: a Burrows-Wheeler transform walked breadth-first up to the wanted length.

Which 400-byte strings occur twice is decided in chunks of bounded size. A chunk's text is suffix-sorted, and common
prefixes are derived by increasing value: each boundary between rows whose suffixes differ after ``l`` bytes is extended
backward by every byte, which gives the boundaries at ``l + 1``; at 400 it stops. Rows without a boundary between them
share 400 bytes.

Chunks only hold what can repeat, and hold all equal windows together:

* Anchors are the 32-byte strings whose hash is divisible by 16 (in stretches without any, the smallest hash of a window).
  They are counted over all texts; a window with an anchor that occurs once cannot repeat.
* A window belongs to its rarest anchor. Consecutive windows of one anchor are a piece; equal pieces are merged and counted
  before any bytes are gathered, so a thousand copies are one piece.
* Pieces of one anchor meet in one chunk. An anchor with more pieces than a chunk may hold is spread over several; windows
  that are single in theirs are then compared across chunks by their hashes.
"""

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import shared_folder, written
from .arrays import ascending, from_ascending, from_planes, load, merge, planes, save
from .common import slices, texts

LENGTH = 400
GRAM = 32
EVERY = 16
CHUNK = 192 * 1024
LONGEST_PIECE = 8192
SLICE_BYTES = 256 * 1024
FLUSH_ANCHORS = 2_000_000
NONE = np.uint64(2**64 - 1)


# Anchors

def gram_hashes(data: bytes, gram: int = GRAM) -> np.ndarray:
    """A well-mixed hash of the ``gram`` bytes at each position; ``gram`` is a power of two."""
    h = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    if len(h) < gram:
        return np.zeros(0, np.uint64)
    factor, width = 0x9E3779B97F4A7C15, 1
    while width < gram:
        h = h[:-width] * np.uint64(factor) + h[width:]
        factor, width = factor * factor % 2**64, 2 * width
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def sliding_least(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least value of every ``width`` neighbours, and its first place."""
    low, at, have = values, np.arange(len(values)), 1
    while 2 * have <= width:
        later = low[have:] < low[:-have]
        at = np.where(later, at[have:], at[:-have])
        low = np.minimum(low[have:], low[:-have])
        have *= 2
    rest = width - have
    if rest:
        later = low[rest:] < low[:-rest]
        at = np.where(later, at[rest:], at[:-rest])
        low = np.minimum(low[rest:], low[:-rest])
    return low, at


def bare_ranges(places: np.ndarray, n_windows: int, reach: int) -> list[tuple[int, int]]:
    """Ranges [from, to] of windows that hold none of the anchors at ``places`` (ascending)."""
    start = np.concatenate([[0], places + 1])
    end = np.concatenate([places - reach, [n_windows - 1]])
    keep = np.nonzero(start <= np.minimum(end, n_windows - 1))[0]
    return [(int(start[k]), int(min(end[k], n_windows - 1))) for k in keep]


def bare_anchors(grams: np.ndarray, first: int, last: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """For windows first..last without a sampled anchor: their smallest hash, marked as such, and its place."""
    low, at = sliding_least(grams[first:last + reach], reach)
    low = (low ^ np.uint64(0x5DEECE66D)) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
    return low, at + first


def _sampled(grams: np.ndarray, every: int) -> np.ndarray:
    return np.nonzero(grams % np.uint64(every) == 0)[0]


def _count_anchors(length: int, every: int, shards: int):
    reach = length - GRAM + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            cuts = np.searchsorted(_shard_of(keys, shards), np.arange(shards + 1))
            yield from _blobs([(s, ascending(keys[a:b]) + planes(n[a:b].astype(np.int64)))
                               for s, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a])

        for batch in batches:
            for data in batch.column(0).cast(pa.binary()).to_pylist():
                if len(data) < length:
                    continue
                grams = gram_hashes(data)
                places = _sampled(grams, every)
                held.append(grams[places])
                for first, last in bare_ranges(places, len(data) - length + 1, reach):
                    low, at = bare_anchors(grams, first, last, reach)
                    held.append(low[np.concatenate([[True], at[1:] != at[:-1]])])
                if sum(map(len, held[-1:])) and len(held) % 512 == 0 and sum(map(len, held)) > FLUSH_ANCHORS:
                    yield from flush()
                    held = []
        if held:
            yield from flush()

    return run


def _shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _blobs(rows: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    for a, b in slices([len(r[1]) for r in rows], 32_000_000):
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[a:b]], pa.int32()),
                                          pa.array([r[1] for r in rows[a:b]], pa.binary())], names=["shard", "blob"])


def _merge_repeated(folder: str, name: str):
    """Stores the keys of a shard that were counted twice or more, with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for shard, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.setdefault(shard, []).append(blob)
        for shard, blobs in held.items():
            keys, n = merge([from_ascending(b[:len(b) // 2]) for b in blobs], [from_planes(b[len(b) // 2:], "<i8") for b in blobs])
            save(folder, f"{name}-{shard}", keys[n > 1])
            save(folder, f"{name}-n-{shard}", n[n > 1])
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([int((n > 1).sum())], pa.int64())],
                                             names=["shard", "n"])

    return run


class Repeated:
    """Counts of the keys that occur more than once, as sorted arrays that tasks map into memory."""

    def __init__(self, folder: str, name: str, sizes: list[int]):
        self.folder, self.name, self.sizes = folder, name, sizes
        self._open: dict[str, np.ndarray] = {}

    def __getstate__(self):
        return self.__dict__ | {"_open": {}}

    def array(self, name: str) -> np.ndarray:
        if name not in self._open:
            self._open[name] = load(self.folder, name)
        return self._open[name]

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Count of each key; 1 for one that is not repeated."""
        out = np.ones(len(keys), np.int64)
        order = np.argsort(keys)
        ordered = keys[order]
        cuts = np.searchsorted(_shard_of(ordered, len(self.sizes)), np.arange(len(self.sizes) + 1))
        for s in np.nonzero(np.diff(cuts))[0]:
            if self.sizes[s]:
                mine = ordered[cuts[s]:cuts[s + 1]]
                known = self.array(f"{self.name}-{s}")
                at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
                out[order[cuts[s]:cuts[s + 1]]] = np.where(known[at] == mine, self.array(f"{self.name}-n-{s}")[at], 1)
        return out


def count_repeated(rows: DataFrame, count, folder: str, name: str, shards: int) -> Repeated:
    counted = rows.mapInArrow(count, "shard int, blob binary").repartitionById(shards, F.col("shard"))
    sizes = [0] * shards
    for shard, n in counted.mapInArrow(_merge_repeated(folder, name), "shard int, n long").collect():
        sizes[shard] = n
    return Repeated(folder, name, sizes)


# Pieces

def _rarest(n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Order of anchors by count, then hash, as one number; the number is also the piece's key."""
    return np.minimum(n, (1 << 19) - 1).astype(np.uint64) << np.uint64(44) | key >> np.uint64(20)


def text_pieces(data: bytes, grams: np.ndarray, places: np.ndarray, counts: np.ndarray, repeated: Repeated,
                length: int = LENGTH) -> Iterator[tuple[int, int, int]]:
    """(key, first, last) for each run of windows of one anchor that can repeat."""
    reach, n_windows = length - GRAM + 1, len(data) - length + 1
    for first, last in bare_ranges(places[counts == 1], n_windows, reach):
        a, b = np.searchsorted(places, [first, last + reach])
        values = np.full(last - first + reach, NONE)
        values[places[a:b] - first] = _rarest(counts[a:b], grams[places[a:b]])
        keys, _ = sliding_least(values, reach)
        bare = np.concatenate([[False], keys == NONE, [False]])
        turns = np.nonzero(bare[1:] != bare[:-1])[0]
        for s, e in zip(turns[::2], turns[1::2], strict=True):
            low, at = bare_anchors(grams, first + int(s), first + int(e) - 1, reach)
            n = repeated.counts(low)
            keys[s:e] = np.where(n > 1, _rarest(n, low), NONE)
        cuts = np.concatenate([[0], np.nonzero(keys[1:] != keys[:-1])[0] + 1, [len(keys)]])
        for s, e in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
            if keys[s] != NONE:
                for c in range(s, e, LONGEST_PIECE):
                    yield int(keys[s]), first + c, first + min(e, c + LONGEST_PIECE) - 1


def _cut_pieces(length: int, every: int, repeated: Repeated):
    """Rows (anchor, piece, text, start, size, content); a task sends each piece's content once, and reads equal texts once."""
    names = ["anchor", "piece", "text", "start", "size", "content"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, sent = set(), set()
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            raw = batch.column(0).cast(pa.binary()).to_pylist()
            for a, b in slices([len(t) for t in raw], SLICE_BYTES):
                grams, places, whose, keys = [], [], [], []
                for data in raw[a:b]:
                    name = hashlib.sha256(data).digest()[:16]
                    if len(data) < length or name in done:
                        continue
                    done.add(name)
                    g = gram_hashes(data)
                    p = _sampled(g, every)
                    whose.append((data, name))
                    grams.append(g)
                    places.append(p)
                    keys.append(g[p])
                counts = repeated.counts(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
                cuts = np.cumsum([0, *map(len, keys)])
                for k, (data, name) in enumerate(whose):
                    mine = counts[cuts[k]:cuts[k + 1]]
                    for key, first, last in text_pieces(data, grams[k], places[k], mine, repeated, length):
                        content = data[first:last + length]
                        piece = xxhash.xxh3_128_digest(content)
                        fresh = piece not in sent
                        sent.add(piece)
                        held += len(content) if fresh else 0
                        rows.append((key, piece, name, first, len(content), content if fresh else None))
                if held > 8_000_000 or len(rows) > 50_000:
                    yield _piece_batch(rows, names)
                    rows, held = [], 0
        if rows:
            yield _piece_batch(rows, names)

    return run


def _piece_batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


# The transform

def packed(symbols: np.ndarray) -> np.ndarray:
    """The first eight symbols of each suffix in one number."""
    n = len(symbols)
    padded = np.concatenate([symbols.astype(np.uint64), np.zeros(8, np.uint64)])
    key = padded[:n].copy()
    for k in range(1, 8):
        key <<= np.uint64(8)
        key |= padded[k:n + k]
    return key


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by doubling, from eight symbols at once; the last symbol is smaller than all others.

    A suffix is ranked by the place where its group starts, so each round only sorts suffixes that still tie.
    """
    n = len(symbols)
    key = packed(symbols)
    order = np.argsort(key)
    ordered, place, width = key[order], np.arange(n), 8
    rank = np.empty(n, np.int64)
    while len(place):
        first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        start = place[np.nonzero(first)[0]][np.cumsum(first) - 1]
        rank[order[place]] = start
        tie = ~first
        tie[:-1] |= ~first[1:]
        place = place[tie]
        suffix = order[place]
        # Suffixes that tie do not reach the last symbol, so there is one ``width`` further.
        pair = rank[suffix] * n + rank[suffix + width]
        by = np.argsort(pair)
        order[place], ordered = suffix[by], pair[by]
        width *= 2
    return order


def long_common_prefix(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """True at row r if the suffixes of rows r - 1 and r share at least ``length`` symbols.

    Values below eight are read off the packed symbols. From there, level by level: let b be a boundary of value l, and r a row
    from b up to the next boundary, the first of its symbol there. The suffix one symbol longer, in row LF(r), then shares
    l + 1 symbols with the row before it, unless a boundary of a smaller value has said so before.
    """
    n = len(symbols)
    key = packed(symbols)[order]
    differ = np.concatenate([[NONE], key[1:] ^ key[:-1]])
    value = sum((differ < np.uint64(1 << (64 - 8 * k))).astype(np.int8) for k in range(1, 8)) + (differ == 0)
    shared = np.concatenate([value >= min(length, 8), [False]])
    last = symbols[order - 1]
    by = np.argsort(last, kind="stable")
    onward = np.empty(n, np.int64)
    onward[by] = np.arange(n)
    earlier = np.empty(n, np.int64)
    earlier[by] = np.concatenate([[-1], np.where(last[by[1:]] == last[by[:-1]], by[:-1], -1)])
    fresh = np.nonzero(value == 7)[0]
    for _ in range(8, length):
        if not len(fresh):
            break
        bounds = np.nonzero(~shared)[0]
        size = bounds[np.searchsorted(bounds, fresh, side="right")] - fresh
        upto = np.cumsum(size)
        rows = np.repeat(fresh - (upto - size), size) + np.arange(upto[-1])
        goal = onward[rows]
        goal = goal[(earlier[rows] < np.repeat(fresh, size)) & shared[goal]]
        shared[goal] = False
        fresh = np.unique(goal)
    return shared[:n]


def repeated_windows(pieces: list[bytes], counts: np.ndarray, length: int = LENGTH):
    """For each window of the pieces: (piece, offset, class, occurrences of the class in this chunk)."""
    sizes = np.array([len(p) for p in pieces])
    text = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
    symbols = text.astype(np.uint16) + np.uint16(2)
    ends = np.cumsum(sizes + 1) - 1
    symbols[ends] = 1
    symbols = np.concatenate([symbols, [np.uint16(0)]])
    # UTF-8 leaves out enough byte values for the two marks.
    used = np.zeros(258, bool)
    used[symbols] = True
    assert used.sum() <= 256
    dense = (np.cumsum(used) - 1).astype(np.uint8)[symbols]
    order = suffix_order(dense)
    shared = long_common_prefix(dense, order, length)
    group = np.cumsum(~shared) - 1
    starts = ends - sizes
    piece = np.minimum(np.searchsorted(ends, order), len(pieces) - 1)
    offset = order - starts[piece]
    window = (offset >= 0) & (offset + length <= sizes[piece]) & (order < len(text))
    piece, offset, group = piece[window], offset[window], group[window]
    total = np.bincount(group, weights=counts[piece], minlength=1).astype(np.int64)
    return piece, offset, group, total[group]


def _runs(offsets: np.ndarray) -> list[int]:
    """Ascending offsets as [first, last, first, last, ...]."""
    if not len(offsets):
        return []
    cut = np.nonzero(np.diff(offsets) > 1)[0]
    return np.stack([offsets[np.concatenate([[0], cut + 1])], offsets[np.concatenate([cut, [len(offsets) - 1]])]], 1).reshape(-1).tolist()


def _solve(length: int, chunk: int):
    """Chunks of whole (anchor, part) groups: per piece its repeated windows, and what other parts must be asked about."""
    def solved(rows: list[tuple]) -> pa.RecordBatch:
        pieces, counts = [r[3] for r in rows], np.array([r[4] for r in rows])
        spread = np.array([r[5] for r in rows])
        piece, offset, group, total = repeated_windows(pieces, counts, length)
        at = np.lexsort((offset, piece))
        piece, offset, group, total = piece[at], offset[at], group[at], total[at]
        cuts = np.searchsorted(piece, np.arange(len(pieces) + 1))
        # One window of each class speaks for it where an anchor is spread over parts.
        speaks = np.zeros(len(group), bool)
        speaks[np.unique(group, return_index=True)[1]] = True
        runs, single, hashes, known = [], [], [], []
        for k, data in enumerate(pieces):
            mine = slice(cuts[k], cuts[k + 1])
            twice = total[mine] > 1
            runs.append(_runs(offset[mine][twice]))
            asks = offset[mine][~twice] if spread[k] else offset[:0]
            tells = offset[mine][twice & speaks[mine]] if spread[k] else offset[:0]
            single.append(asks.tolist())
            hashes.append([xxhash.xxh3_64_intdigest(data[o:o + length]) - 2**63 for o in asks.tolist()])
            known.append([xxhash.xxh3_64_intdigest(data[o:o + length]) - 2**63 for o in tells.tolist()])
        return pa.RecordBatch.from_arrays(
            [pa.array([r[2] for r in rows], pa.binary()), pa.array(runs, pa.list_(pa.int64())), pa.array(single, pa.list_(pa.int64())),
             pa.array(hashes, pa.list_(pa.int64())), pa.array(known, pa.list_(pa.int64()))],
            names=["piece", "runs", "single", "hashes", "known"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size, group = 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:2] != group and size >= chunk:
                    yield solved(rows)
                    rows, size = [], 0
                group = row[:2]
                rows.append(row)
                size += len(row[3])
        if rows:
            yield solved(rows)

    return run


def _count_asked(shards: int):
    """Window hashes of spread anchors: 1 for a window that is single in its part, 2 for one that is not."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (np.array(c.flatten().to_numpy(zero_copy_only=False), np.int64) for c in batch.columns)
            if len(one) + len(two):
                keys = np.concatenate([one, two]).view(np.uint64)
                keys, n = merge([keys], [np.repeat([1, 2], [len(one), len(two)])])
                cuts = np.searchsorted(_shard_of(keys, shards), np.arange(shards + 1))
                yield from _blobs([(s, ascending(keys[a:b]) + planes(n[a:b]))
                                   for s, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a])

    return run


def _settle(repeated: Repeated):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = []
            for own, single, hashes in zip(*(c.to_pylist() for c in batch.columns[1:4]), strict=True):
                if single:
                    again = repeated.counts(np.array(hashes, np.int64).view(np.uint64)) > 1
                    own = own + _runs(np.array(single)[again])
                runs.append(own)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(runs, pa.list_(pa.int64()))], names=["piece", "runs"])

    return run


# The operator

def _removed(length: int):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"]

    def spans_of(size: int, copies: int | None, starts, runs) -> list[tuple[int, int]]:
        if size >= length and copies is not None and copies > 1:
            return [(0, size)]
        found = sorted((s + r[k], s + r[k + 1] + length) for s, r in zip(starts or (), runs or (), strict=True)
                       for k in range(0, len(r), 2))
        out: list[tuple[int, int]] = []
        for a, b in found:
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], max(b, out[-1][1]))
            else:
                out.append((a, b))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            raw = batch.column(1).cast(pa.binary()).to_pylist()
            for data, copies, starts, runs in zip(raw, *(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True):
                spans = spans_of(len(data), copies, starts, runs)
                edges = [0, *(x for s in spans for x in s), len(data)]
                kept = b"".join(data[edges[k]:edges[k + 1]] for k in range(0, len(edges), 2))
                rows.append((len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept,
                             [{"start": a, "end": b} for a, b in spans]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(),
                     pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))],
                                             names=names)

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   every: int = EVERY, chunk: int = CHUNK) -> DataFrame:
    """Every document without the bytes that any repeated ``length``-byte string covers.

    Returns (doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, spans); ``kept`` is binary, as a cut may fall inside a
    character. A string repeats if it starts anywhere else too, in the same document included; all strings are judged on
    the input. Null texts are empty; texts shorter than ``length`` stay whole; equal texts of at least that length lose all
    their bytes; repeated rows count as copies. ``length`` is at least 64. Other columns are not read.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    spark = docs.sparkSession
    shards = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    folder = f"{shared_folder(spark).rstrip('/')}/repeats-{uuid.uuid4().hex}"
    rows = texts(docs, id_col, text_col)
    anchors = count_repeated(rows.select("text"), _count_anchors(length, every, shards), folder, "anchor", shards)
    pieces = written(rows.select("text").mapInArrow(
        _cut_pieces(length, every, anchors), "anchor long, piece binary, text binary, start long, size long, content binary"))
    merged = pieces.groupBy("anchor", "piece").agg(F.max("content").alias("content"), F.count("*").alias("n"))
    weight = pieces.groupBy("anchor", "piece").agg(F.max("size").alias("size")).groupBy("anchor").agg(F.sum("size").alias("size"))
    heavy = written(weight.filter(F.col("size") > chunk).select("anchor", F.ceil(F.col("size") / chunk).cast("int").alias("parts")))
    spread = merged.join(heavy, "anchor", "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("piece"), F.col("parts")).cast("int"), F.lit(0)))
    grouped = spread.select("anchor", "part", "piece", "content", "n", F.col("parts").isNotNull().alias("spread"))
    solved = written(grouped.repartition(shards, "anchor", "part").sortWithinPartitions("anchor", "part").mapInArrow(
        _solve(length, chunk), "piece binary, runs array<long>, single array<long>, hashes array<long>, known array<long>"))
    asked = count_repeated(solved.filter("size(hashes) + size(known) > 0").select("hashes", "known"),
                           _count_asked(shards), folder, "asked", shards)
    settled = solved.mapInArrow(_settle(asked), "piece binary, runs array<long>").filter("size(runs) > 0")
    found = pieces.select("piece", "text", "start").join(settled, "piece").dropDuplicates(["text", "start"])
    per_text = found.groupBy("text").agg(F.collect_list(F.struct("start", "runs")).alias("found"))
    named = rows.withColumn("key", F.unhex(F.substring(F.sha2(F.col("text").cast("binary"), 256), 1, 32)))
    copies = named.groupBy("key").agg(F.count("*").alias("copies")).filter("copies > 1")
    known = written(per_text.withColumnRenamed("text", "key").join(copies, "key", "full")
                    .select("key", "copies", F.col("found.start").alias("starts"), F.col("found.runs").alias("runs")))
    kind = docs.schema[id_col].dataType.simpleString()
    return named.join(known, "key", "left").select("doc_id", "text", "copies", "starts", "runs").mapInArrow(
        _removed(length), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, "
                          "spans array<struct<start:long,end:long>>")
