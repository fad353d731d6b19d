"""LM scoring: an interpolated modified Kneser-Ney bigram model, counted in Spark.

Three passes over the text. (1) Words are hashed and counted; each hash range becomes a sorted array, and a word's id is its
place in the order of hashes. (2) Bigrams (ids of two words in one 64-bit key) are counted in every task, merged by key
range, and written as sorted key arrays with counts; the same tasks send on what Kneser-Ney needs per word: how often and
with how many different followers it is a context, and how many different words it follows. (3) Workers map the arrays into
memory and score whole texts. A context with a large share of all tokens is spread over all ranges by its follower.
"""

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import shared_folder
from .arrays import ascending, from_ascending, from_planes, load, merge, planes, save
from .common import slices, texts

END = b"\n"
FLUSH_TOKENS = 2_500_000
CACHED_WORDS = 300_000
BATCH_BYTES = 3_000_000
BLOBS = "shard int, kind int, blob binary"
WIDEST = 1 << 32


def word_lists(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Bounded parts of the batches with the words of each text, the end word last."""
    for batch in batches:
        column = batch.column(at).cast(pa.binary())
        sizes = column.to_pylist()
        for a, b in slices([len(t) for t in sizes], BATCH_BYTES):
            yield batch.slice(a, b - a), [[*t.lower().split(), END] for t in sizes[a:b]]


class Seen:
    """Numbers for the distinct words of a task, in order of appearance, with their hashes."""

    def __init__(self):
        self.ids: dict[bytes, int] = {}
        self.hashes = np.zeros(0, np.uint64)

    def lookup(self, documents: list[list[bytes]]) -> np.ndarray:
        ids = self.ids
        new = [w for w in {w for words in documents for w in words} if w not in ids]
        ids.update(zip(new, range(len(ids), len(ids) + len(new)), strict=True))
        fresh = np.fromiter(map(xxhash.xxh64_intdigest, new), np.uint64, len(new))
        self.hashes = np.concatenate([self.hashes, fresh])
        n = sum(map(len, documents))
        return np.fromiter((i for words in documents for i in map(ids.__getitem__, words)), np.int64, n)

    @property
    def full(self) -> bool:
        return len(self.ids) > CACHED_WORDS


def _shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _blobs(rows: list[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    for a, b in slices([len(r[2]) for r in rows], 32_000_000):
        shard, kind, blob = zip(*rows[a:b], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(kind, pa.int32()), pa.array(blob, pa.binary())],
                                         names=["shard", "kind", "blob"])


def _count_words(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, count = Seen(), np.zeros(0, np.int64)

        def flush():
            order = np.argsort(seen.hashes)
            hashes, n = seen.hashes[order], count[order]
            cuts = np.searchsorted(_shard_of(hashes, shards), np.arange(shards + 1))
            yield from _blobs([(s, 0, ascending(hashes[a:b]) + planes(n[a:b])) for s, (a, b) in
                               enumerate(zip(cuts, cuts[1:], strict=False)) if b > a])

        for _, documents in word_lists(batches, 0):
            ids = seen.lookup(documents)
            count = np.concatenate([count, np.zeros(len(seen.ids) - len(count), np.int64)])
            count += np.bincount(ids, minlength=len(count))
            if seen.full:
                yield from flush()
                seen, count = Seen(), np.zeros(0, np.int64)
        yield from flush()

    return run


def _by_shard(batches: Iterator[pa.RecordBatch]) -> dict[int, list[tuple[int, bytes]]]:
    held: dict[int, list[tuple[int, bytes]]] = {}
    for batch in batches:
        for shard, kind, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held.setdefault(shard, []).append((kind, blob))
    return held


def _halves(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    cut = len(blob) // 2
    return from_ascending(blob[:cut]), from_planes(blob[cut:], "<i8")


def _numbers(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in columns.values()], names=list(columns))


def _merge_words(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, blobs in _by_shard(batches).items():
            parts = [_halves(b) for _, b in blobs]
            hashes, n = merge([p[0] for p in parts], [p[1] for p in parts])
            save(folder, f"word-{shard}", hashes)
            save(folder, f"count-{shard}", n)
            yield _numbers(shard=[shard], words=[len(hashes)], tokens=[int(n.sum())])

    return run


class Words:
    """The word arrays of all shards; ids run through the shards in order."""

    def __init__(self, folder: str, sizes: list[int], tokens: int):
        self.folder, self.sizes, self.tokens = folder, sizes, tokens
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.total = int(self.first[-1])
        self._open: dict[str, np.ndarray] = {}

    def __getstate__(self):
        return self.__dict__ | {"_open": {}}

    def array(self, name: str) -> np.ndarray:
        if name not in self._open:
            self._open[name] = load(self.folder, name)
        return self._open[name]

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Id of each hash, -1 for unknown ones."""
        out = np.full(len(hashes), -1, np.int64)
        order = np.argsort(hashes)
        ordered = hashes[order]
        cuts = np.searchsorted(_shard_of(ordered, len(self.sizes)), np.arange(len(self.sizes) + 1))
        for s, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if b > a and self.sizes[s]:
                known = self.array(f"word-{s}")
                at = np.minimum(np.searchsorted(known, ordered[a:b]), len(known) - 1)
                out[order[a:b]] = np.where(known[at] == ordered[a:b], at + self.first[s], -1)
        return out

    def pick(self, name: str, ids: np.ndarray) -> np.ndarray:
        """Values of a per-word array; 0 for id -1. The start of a text, id ``total``, lies in the last shard."""
        out = np.zeros(len(ids), np.int64)
        shard = np.minimum(np.searchsorted(self.first, ids, side="right") - 1, len(self.sizes) - 1)
        for s in np.unique(shard[ids >= 0]):
            mine = np.nonzero((shard == s) & (ids >= 0))[0]
            out[mine] = self.array(f"{name}-{s}")[ids[mine] - self.first[s]]
        return out


class Ranges:
    """Which key range a bigram lies in: by context, and by follower too where the context is hot."""

    def __init__(self, words: Words, ranges: int, hot: int):
        self.words, self.ranges, self.hot = words, ranges, hot
        self.filled: set[int] = set()  # ranges that hold any bigram

    def of(self, u: np.ndarray, v: np.ndarray, uses: np.ndarray) -> np.ndarray:
        span = self.words.total + 1
        return np.where(uses >= self.hot, (u + v * self.ranges // span) % self.ranges, u * self.ranges // span)


def _context_ids(ids: np.ndarray, lengths: np.ndarray, start: int) -> np.ndarray:
    """The word before each word; ``start`` before the first of each text."""
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[np.cumsum(lengths) - lengths] = start
    return before


def _count_pairs(words: Words, ranges: Ranges, documents_total: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, known, uses = Seen(), np.zeros(0, np.int64), np.zeros(0, np.int64)
        held: list[np.ndarray] = []

        def flush():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            u, v = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(WIDEST - 1)).astype(np.int64)
            firsts = np.concatenate([[True], u[1:] != u[:-1]])
            use = words.pick("count", np.where(u[firsts] < words.total, u[firsts], -1))
            use[u[firsts] == words.total] = documents_total
            shard = ranges.of(u, v, use[np.cumsum(firsts) - 1])
            order = np.argsort(shard, kind="stable")
            keys, n, cuts = keys[order], n[order], np.searchsorted(shard[order], np.arange(ranges.ranges + 1))
            yield from _blobs([(s, 0, ascending(keys[a:b]) + planes(n[a:b].astype(np.int64))) for s, (a, b) in
                               enumerate(zip(cuts, cuts[1:], strict=False)) if b > a])

        for _, documents in word_lists(batches, 0):
            if seen.full:
                seen, known = Seen(), np.zeros(0, np.int64)
            local = seen.lookup(documents)
            known = np.concatenate([known, words.ids(seen.hashes[len(known):])])
            ids = known[local]
            before = _context_ids(ids, np.fromiter(map(len, documents), np.int64, len(documents)), words.total)
            held.append(before.astype(np.uint64) << np.uint64(32) | ids.astype(np.uint64))
            if sum(map(len, held)) > FLUSH_TOKENS:
                yield from flush()
                held = []
        if held:
            yield from flush()

    return run


def _merge_pairs(folder: str, words: Words):
    """Writes a range's bigrams; sends on sums per word, kind 1 as context, kind 2 as follower, kind 3 counts of counts."""
    span, shards = words.total + 1, len(words.sizes)

    def parted(kind: int, ids: np.ndarray, *columns: np.ndarray):
        shard = np.minimum(np.searchsorted(words.first, ids, side="right") - 1, shards - 1)
        cuts = np.searchsorted(shard, np.arange(shards + 1))
        for s, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if b > a:
                yield s, kind, ascending(ids[a:b].astype(np.uint64)) + b"".join(planes(c[a:b]) for c in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, blobs in _by_shard(batches).items():
            parts = [_halves(b) for _, b in blobs]
            keys, n = merge([p[0] for p in parts], [p[1] for p in parts])
            del parts
            save(folder, f"pair-{shard}", keys)
            save(folder, f"pairs-{shard}", np.minimum(n, 255).astype(np.uint8))
            many = np.nonzero(n >= 255)[0]
            save(folder, f"often-{shard}", np.stack([many, n[many]]))
            u, v = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(WIDEST - 1)).astype(np.int64)
            first = np.nonzero(np.concatenate([[True], u[1:] != u[:-1]]))[0]
            sums = [np.add.reduceat(x.astype(np.int64), first) for x in (n, n == 1, n == 2, n >= 3)]
            follower, different = np.unique(v, return_counts=True)
            rows = [*parted(1, u[first], *sums), *parted(2, follower, different.astype(np.int64))]
            rows.append((0, 3, np.append(np.bincount(np.minimum(n, 5), minlength=6)[:5], shard).astype(np.int64).tobytes()))
            yield from _blobs(rows)

    assert span < WIDEST
    return run


def _merge_contexts(folder: str, words: Words):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, blobs in _by_shard(batches).items():
            size = words.sizes[shard] + (shard == len(words.sizes) - 1)
            sums = {name: np.zeros(size, np.int64) for name in ("uses", "once", "twice", "more", "after")}
            counts, filled = np.zeros(5, np.int64), []
            for kind, blob in blobs:
                if kind == 3:
                    counts += np.frombuffer(blob, np.int64)[:5]
                    filled.append(int(np.frombuffer(blob, np.int64)[5]))
                    continue
                names = ("uses", "once", "twice", "more") if kind == 1 else ("after",)
                n = len(blob) // (8 * (1 + len(names)))
                at = (from_ascending(blob[:8 * n]).astype(np.int64) - words.first[shard])
                for k, name in enumerate(names):
                    sums[name][at] += from_planes(blob[8 * n * (k + 1):8 * n * (k + 2)], "<i8")
            for name, values in sums.items():
                save(folder, f"{name}-{shard}", values.astype(np.uint32) if values.max(initial=0) < WIDEST else values)
            after = np.bincount(np.minimum(sums["after"], 5), minlength=6)
            row = _numbers(shard=[shard], p1=[counts[1]], p2=[counts[2]], p3=[counts[3]], p4=[counts[4]],
                           w1=[after[1]], w2=[after[2]], w3=[after[3]], w4=[after[4]], kinds=[int(sums["after"].sum())])
            yield row.append_column("filled", pa.array([filled], pa.list_(pa.int64())))

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more; fixed ones where a count of counts is missing."""
    if min(n1, n2, n3, n4) <= 0:
        return np.array([0.0, 0.5, 0.75, 0.9])
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0.0, *(min(max(d, 0.05), k + 0.95) for k, d in enumerate(found))])


class BigramModel:
    """Folder of arrays and the few numbers that belong to them."""

    def __init__(self, words: Words, ranges: Ranges, documents: int, pair_counts: list[int], word_counts: list[int], kinds: int):
        self.words, self.ranges, self.documents, self.kinds = words, ranges, documents, kinds
        self.pair_discount, self.word_discount = discounts(*pair_counts), discounts(*word_counts)

    def unigrams(self, ids: np.ndarray, spread: float) -> np.ndarray:
        after = self.words.pick("after", ids)
        rest = spread / (self.words.total + 1)
        return (after - self.word_discount[np.minimum(after, 3)]) / max(1, self.kinds) + rest

    def spread(self) -> float:
        """Probability that the discounts of the word level leave for all words alike."""
        if not self.kinds:
            return 1.0
        return self._spread

    def seal(self, word_counts: list[int]) -> "BigramModel":
        d, (n1, n2, *_) = self.word_discount, word_counts
        self._spread = float((d[1] * n1 + d[2] * n2 + d[3] * (self.words.total - n1 - n2)) / max(1, self.kinds))
        return self

    def pair_counts(self, u: np.ndarray, v: np.ndarray, uses: np.ndarray) -> np.ndarray:
        """How often known word v follows u in training; ``uses``: training tokens of u."""
        out = np.zeros(len(u), np.int64)
        shard = self.ranges.of(u, v, uses)
        keys = u.astype(np.uint64) << np.uint64(32) | v.astype(np.uint64)
        order = np.lexsort((keys, shard))
        cuts = np.searchsorted(shard[order], np.arange(self.ranges.ranges + 1))
        for s, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if b == a or s not in self.ranges.filled:
                continue
            known = self.words.array(f"pair-{s}")
            mine = keys[order[a:b]]
            at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
            n = np.where(known[at] == mine, self.words.array(f"pairs-{s}")[at].astype(np.int64), 0)
            where, often = self.words.array(f"often-{s}")
            high = n == 255
            n[high] = often[np.searchsorted(where, at[high])]
            out[order[a:b]] = n
        return out


def train(docs: DataFrame, text_col: str = "text") -> BigramModel:
    """Count a bigram model over all texts of ``docs``; its arrays lie in the shared folder.

    Null texts are empty; each text ends in one end word. An empty table gives a model that knows no word.
    """
    spark = docs.sparkSession
    folder = f"{shared_folder(spark).rstrip('/')}/words-{uuid.uuid4().hex}"
    shards = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counted = rows.mapInArrow(_count_words(shards), BLOBS).repartitionById(shards, F.col("shard"))
    sizes, tokens = [0] * shards, 0
    for shard, n, held in counted.mapInArrow(_merge_words(folder), "shard long, words long, tokens long").collect():
        sizes[shard], tokens = n, tokens + held
    words = Words(folder, sizes, tokens)
    if words.total >= WIDEST - 1:
        raise ValueError("more than 2^32 different words")
    ends = int(_count_of(words, END))
    ranges = Ranges(words, shards, max(1000, tokens // (4 * shards)))
    pairs = rows.mapInArrow(_count_pairs(words, ranges, ends), BLOBS).repartitionById(shards, F.col("shard"))
    contexts = pairs.mapInArrow(_merge_pairs(folder, words), BLOBS).repartitionById(shards, F.col("shard"))
    names = ["p1", "p2", "p3", "p4", "w1", "w2", "w3", "w4", "kinds"]
    found = contexts.mapInArrow(_merge_contexts(folder, words), "shard long, " + ", ".join(f"{n} long" for n in names)
                                + ", filled array<long>").collect()
    ranges.filled = {s for r in found for s in r["filled"]}
    total = [sum(r[n] for r in found) for n in names]
    return BigramModel(words, ranges, ends, total[:4], total[4:8], total[8]).seal(total[4:8])


def _count_of(words: Words, word: bytes) -> int:
    ids = words.ids(np.array([xxhash.xxh64_intdigest(word)], np.uint64))
    return words.pick("count", ids)[0]


SCORES = "doc_id {id}, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, model: BigramModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Log10 probabilities of every whole text: the model's and that of smoothed single-word counts.

    Words the training lacks get the share that the model keeps for unseen words. A null or empty text is its end word
    alone. Repeated rows are scored each; other columns are not read. ``perplexity`` of a row is 10^(-score / n_tokens).
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, spread = model.words, model.spread()
        seen, known = Seen(), np.zeros(0, np.int64)
        held: dict[str, np.ndarray] = {}
        for part, documents in word_lists(batches, 1):
            if seen.full:
                seen, known, held = Seen(), np.zeros(0, np.int64), {}
            local = seen.lookup(documents)
            new = words.ids(seen.hashes[len(known):])
            known = np.concatenate([known, new])
            fresh = {"count": words.pick("count", new), "unigram": model.unigrams(new, spread),
                     "uses": words.pick("uses", new) if model.kinds else np.zeros(len(new), np.int64)}
            if model.kinds:
                d = model.pair_discount
                left = sum(d[k + 1] * words.pick(n, new) for k, n in enumerate(("once", "twice", "more")))
                fresh["left"] = left / np.maximum(1, fresh["uses"])
            else:
                fresh["left"] = np.ones(len(new))
            held = {k: np.concatenate([held[k], v]) if k in held else v for k, v in fresh.items()}
            lengths = np.fromiter(map(len, documents), np.int64, len(documents))
            starts = np.cumsum(lengths) - lengths
            ids = known[local]
            count = held["count"][local]
            base = np.log10((count + 0.5) / (words.tokens + 0.5 * (words.total + 1)))
            p = held["unigram"][local].copy()
            before = _context_ids(ids, lengths, words.total)
            earlier = np.concatenate([[0], local[:-1]])
            uses, left, seen_before = held["uses"][earlier], held["left"][earlier], held["count"][earlier]
            if model.kinds:
                start = np.array([words.total])
                uses[starts] = words.pick("uses", start)[0]
                d = model.pair_discount
                left[starts] = sum(d[k + 1] * words.pick(n, start)[0] for k, n in enumerate(("once", "twice", "more"))) / uses[starts]
                seen_before[starts] = model.documents
                told = np.nonzero(uses * (before >= 0) > 0)[0]
                p[told] *= left[told]
                both = told[ids[told] >= 0]
                n = model.pair_counts(before[both], ids[both], seen_before[both])
                hit = n > 0
                p[both[hit]] += (n[hit] - d[np.minimum(n[hit], 3)]) / uses[both[hit]]
            log = np.log10(p)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(lengths), pa.array(np.add.reduceat((count > 0).astype(np.int64), starts)),
                 pa.array(np.full(len(lengths), words.tokens)), pa.array(np.add.reduceat(base, starts)),
                 pa.array(np.add.reduceat(log, starts))],
                names=[f.split()[0] for f in SCORES.split(", ")])

    return texts(docs, id_col, text_col).mapInArrow(run, SCORES.format(id=kind))
