"""Cross-tokenizer alignment: which tokens of two tokenizers overlap, and how often each pair of ids does in the corpus.

A pair of ids is counted over all texts, so its records leave the tasks that found them, and come back as sums per text:

* A task turns its texts into records (pair, text, links), the pair with its B id first. A full buffer is radix-partitioned
  by B id and each part is written as a sorted run of zstd blocks: the spill, held by Spark like any other rows.
* The runs of a part meet in cells of bounded size, many cells for a hot part. A cell merges its runs with a heap over their
  blocks and sums every pair; sums of cells are added by Spark. A pair that every text has is one record per run and cell here.
* In the order of B ids, then A ids, the counts of one B id are neighbours, so its maximum is known when they have passed.
  They are stored as sorted arrays, one folder entry per part.
* Runs are read once more in the same order, beside the arrays of their part: each record gives its text what its pair
  counts, and whether that is the maximum. A run's contributions are added up per text before they leave the task.

Texts are cut into stretches that neither tokenizer's tokens cross: before spaces and marks that follow a word, and after a line
end (the tokenizers are checked for that when they are loaded; otherwise texts stay whole). Tokens, groups and links of a
stretch are found once and kept, and a text is put together from its stretches by array operations.
"""

import gc
import hashlib
import heapq
import json
import os
import re
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import shared_folder, written
from .arrays import from_planes, load, planes, save
from .common import slices, texts

PARTS = 16
BUFFER = 2_000_000
BLOCK = 1 << 16
CELL_BYTES = 32_000_000
CACHED = 600_000
CACHED_CHARS = 30_000_000
TEXT_BITS = 32
STEP_CHARS = 1_000_000
ODD_SPACE = re.compile(r"\s ")


# Tokens

def byte_level_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Tokenizer A (byte-level, ``tokenizers`` file) and B (``sentencepiece`` model) with the bytes of their ids."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_level_alphabet()
        self.size_a, self.size_b = self.a.get_vocab_size(), self.b.vocab_size()
        self.bytes_a = [b""] * self.size_a
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.size_b)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.space = self.b.piece_to_id("▁")
        self.lead = len(self.b.encode("\n"))
        self.cut = self._cut(pieces)

    def _cut(self, pieces: list[str]) -> re.Pattern | None:
        """Where texts may be cut; None where that is not known to be safe.

        A splits by its pattern before all these places. B joins pieces only into longer pieces, so a place is safe if no piece
        holds the characters on both sides of it; a line end has no piece of its own but bytes.
        """
        config = json.loads(self.a.to_str())
        first = config["pre_tokenizer"] or {}
        by_pattern = first.get("type") == "ByteLevel" and first.get("use_regex") and not first.get("add_prefix_space")
        plain = config["normalizer"] is None and all(t["special"] for t in config["added_tokens"])
        whole = "".join(self.bytes_b[i].decode("utf-8", "replace") for i in self.b.encode("a\nb")) == " a\nb"
        if not (by_pattern and plain and whole) or self.b.is_unknown(self.space) or any(re.search("[^▁]▁|\n", p) for p in pieces):
            return None
        close = sorted({(p[i], p[i + 1]) for p in pieces for i in range(len(p) - 1) if p[i].isalnum() and re.match(r"[^\w\s▁]", p[i + 1])})
        unsafe = "".join(f"(?!(?<={re.escape(x)}){re.escape(y)})" for x, y in close) if len(close) < 200 else "(?!)"
        return re.compile(rf"(?<=\S)(?= )|(?<=[^\W_])(?=[^\w\s]){unsafe}|(?<=\S\n)(?=[^\W_])")

    def encode(self, stretches: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of stretches. B puts a space before a text: that is the first one of a stretch, or a line end follows it and both go."""
        found = self.a.encode_batch_fast(stretches, add_special_tokens=False)
        other = self.b.encode([s[1:] if s[0] == " " else "\n" + s for s in stretches], num_threads=1)
        # B gives nothing for an empty text, though the space before it is a piece.
        return [(e.ids, [self.space] if s == " " else ids if s[0] == " " else ids[self.lead:]) for s, e, ids in zip(stretches, found, other, strict=True)]


def overlaps(a: list[int], b: list[int], ends_a: list[int], ends_b: list[int]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Places (i, j) of overlapping tokens, and those after which both end together; the tokens cover the same bytes."""
    links, ends, i, j = [], [], 0, 0
    n = len(a)
    while i < n:
        links.append((i, j))
        x, y = ends_a[i], ends_b[j]
        if x == y:
            ends.append((i, j))
            i += 1
            j += 1
        elif x < y:
            i += 1
        else:
            j += 1
    return links, ends


class Aligned:
    """What a list of texts has: numbers per text, the pair of each link in the order of texts, and groups as text."""

    def __init__(self, n_a, n_b, n_groups, n_links, pairs, groups):
        self.n_a, self.n_b, self.n_groups, self.n_links, self.pairs, self.groups = n_a, n_b, n_groups, n_links, pairs, groups


class Aligner:
    """Aligns texts from their stretches, each tokenized once. A full cache is emptied, which costs time only."""

    def __init__(self, path_a: str, path_b: str):
        self.tokenizers = Tokenizers(path_a, path_b)
        self.names_a, self.names_b = list(map(str, range(self.tokenizers.size_a))), list(map(str, range(self.tokenizers.size_b)))
        self.length_a, self.length_b = list(map(len, self.tokenizers.bytes_a)), list(map(len, self.tokenizers.bytes_b))
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        # Words without the space before them; one of several stretches has an entry of its own, put together from theirs.
        self.words: dict[str, int] = {}
        self.held = 0
        self.groups: list[str] = []
        # Per stretch: tokens give back its text, numbers of A and B tokens, groups and links.
        self.numbers = np.zeros((0, 5), np.int64)
        self.flat = np.zeros(0, np.uint64)

    def _learn(self, stretches: set[str]) -> None:
        fresh = [s for s in stretches if s not in self.known]
        if not fresh:
            return
        tok, size_a = self.tokenizers, self.tokenizers.size_a
        rows, flat = [], []
        for text, (a, b) in zip(fresh, tok.encode(fresh), strict=True):
            raw = text.encode("utf-8", "replace")
            right = b"".join(map(tok.bytes_a.__getitem__, a)) == raw == b"".join(map(tok.bytes_b.__getitem__, b))
            if not right:
                rows.append((0, 0, 0, 0, 0))
                self.groups.append("")
                continue
            links, ends = overlaps(a, b, list(accumulate(map(self.length_a.__getitem__, a))), list(accumulate(map(self.length_b.__getitem__, b))))
            flat += [b[j] * size_a + a[i] for i, j in links]
            parts, x, y = [], 0, 0
            for i, j in ends:
                parts.append(",".join(map(self.names_a.__getitem__, a[x:i + 1])) + "|" + ",".join(map(self.names_b.__getitem__, b[y:j + 1])))
                x, y = i + 1, j + 1
            rows.append((1, len(a), len(b), len(ends), len(links)))
            self.groups.append(";".join(parts))
        self.known.update(zip(fresh, range(len(self.numbers), len(self.numbers) + len(fresh)), strict=True))
        self.held += sum(map(len, fresh))
        self.numbers = np.concatenate([self.numbers, np.array(rows, np.int64)])
        self.flat = np.concatenate([self.flat, np.array(flat, np.uint64)])

    def _learn_words(self, words: set[str]) -> None:
        fresh = [w for w in words if w not in self.words]
        if not fresh:
            return
        cut = [self.tokenizers.cut.split(" " + w) for w in fresh]
        self._learn(set(chain.from_iterable(cut)))
        joined, rows, flat, n = [], [], [], len(self.numbers)
        first = np.cumsum(self.numbers[:, 4]) - self.numbers[:, 4]
        for word, parts in zip(fresh, cut, strict=True):
            if len(parts) == 1:
                self.words[word] = self.known[parts[0]]
                continue
            at = [self.known[p] for p in parts]
            self.words[word] = n + len(joined)
            joined.append(";".join(map(self.groups.__getitem__, at)))
            rows.append(at)
        if rows:
            index, of = np.array(list(chain.from_iterable(rows))), np.repeat(np.arange(len(rows)), list(map(len, rows)))
            links = self.numbers[index, 4]
            flat = self.flat[np.repeat(first[index] - (np.cumsum(links) - links), links) + np.arange(int(links.sum()))]
            sums = np.stack([np.bincount(of, self.numbers[index, c], minlength=len(rows)) for c in range(5)], 1).astype(np.int64)
            right = sums[:, 0] == list(map(len, rows))
            sums[:, 0] = right
            self.numbers, self.flat = np.concatenate([self.numbers, sums]), np.concatenate([self.flat, flat])
            self.groups += joined
        self.held += sum(map(len, fresh))

    def _rows(self, texts_: list[str]) -> list[list[int]]:
        """The entries that each text is made of."""
        if self.tokenizers.cut is None:
            self._learn({" " + t for t in texts_ if t})
            return [[self.known[" " + t]] if t else [] for t in texts_]
        # Single spaces between words, the usual case, need no pattern.
        plain = [bool(t) and ODD_SPACE.search(" " + t) is None for t in texts_]
        cut = [t.split(" ") if usual else self.tokenizers.cut.split(" " + t) if t else [] for t, usual in zip(texts_, plain, strict=True)]
        self._learn_words(set(chain.from_iterable(c for c, usual in zip(cut, plain, strict=True) if usual)))
        self._learn(set(chain.from_iterable(c for c, usual in zip(cut, plain, strict=True) if not usual)))
        of_word, of_stretch = self.words.__getitem__, self.known.__getitem__
        return [list(map(of_word if usual else of_stretch, c)) for c, usual in zip(cut, plain, strict=True)]

    def align(self, texts_: list[str]) -> Aligned:
        if len(self.numbers) > CACHED or self.held > CACHED_CHARS:
            self._clear()
        rows = self._rows(texts_)
        # What is kept need not be looked through again by the garbage collector.
        gc.freeze()
        index = np.fromiter(chain.from_iterable(rows), np.int64, sum(map(len, rows)))
        of = np.repeat(np.arange(len(rows)), list(map(len, rows)))
        wrong = np.unique(of[self.numbers[index, 0] == 0]).tolist()
        if wrong:
            # What one stretch cannot give back is asked of the whole text, where it may come out.
            self._learn({" " + texts_[i] for i in wrong})
            for i in wrong:
                k = self.known[" " + texts_[i]]
                rows[i] = [k] if self.numbers[k, 0] else []
            index = np.fromiter(chain.from_iterable(rows), np.int64, sum(map(len, rows)))
            of = np.repeat(np.arange(len(rows)), list(map(len, rows)))
        sums = np.stack([np.bincount(of, self.numbers[index, c], minlength=len(rows)) for c in range(1, 5)]).astype(np.int64)
        links = self.numbers[index, 4]
        first = (np.cumsum(self.numbers[:, 4]) - self.numbers[:, 4])[index]
        pairs = self.flat[np.repeat(first - (np.cumsum(links) - links), links) + np.arange(int(links.sum()))]
        group = self.groups.__getitem__
        return Aligned(*sums, pairs, [";".join(map(group, row)) for row in rows])


_BY_PATHS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker process, kept from task to task."""
    if (path_a, path_b) not in _BY_PATHS:
        _BY_PATHS[path_a, path_b] = Aligner(path_a, path_b)
    return _BY_PATHS[path_a, path_b]


# Runs: blocks of ascending keys (pair, text) with their numbers of links, each block packed for itself

def pack_run(keys: np.ndarray, n: np.ndarray, block: int = BLOCK) -> list[bytes]:
    packer = zstandard.ZstdCompressor(level=1)
    return [packer.compress(planes(np.diff(keys[a:a + block], prepend=np.uint64(0))) + planes(n[a:a + block].astype(np.uint32)))
            for a in range(0, len(keys), block)]


def unpack_block(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    cut = len(raw) // 12 * 8
    return np.cumsum(from_planes(raw[:cut], "<u8"), dtype=np.uint64), from_planes(raw[cut:], "<u4").astype(np.int64)


def merged_counts(runs: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ascending pairs with their links over all runs, in parts: a heap names the run whose open block ends first.

    Up to that end everything of all open blocks is known; the rest waits. One block per run is unpacked at a time.
    """
    def opened(run: int, at: int):
        keys, n = unpack_block(runs[run][at])
        return keys >> np.uint64(TEXT_BITS), n

    waiting = [opened(r, 0) for r in range(len(runs))]
    heap = [(int(pairs[-1]), r, 0) for r, (pairs, _) in enumerate(waiting)]
    heapq.heapify(heap)
    while heap:
        bound, run, at = heapq.heappop(heap)
        ready = []
        last = at + 1 == len(runs[run])
        for r, (pairs, n) in enumerate(waiting):
            # The bound itself may go on in this run's next block, and is left open unless nothing can follow it.
            cut = np.searchsorted(pairs, np.uint64(bound), side="right" if last and not heap else "left")
            if cut:
                ready.append((pairs[:cut], n[:cut]))
                waiting[r] = pairs[cut:], n[cut:]
        if ready:
            yield _summed(*(np.concatenate(x) for x in zip(*ready, strict=True)))
        if not last:
            pairs, n = opened(run, at + 1)
            waiting[run] = np.concatenate([waiting[run][0], pairs]), np.concatenate([waiting[run][1], n])
            # What is open of one pair is one number from here on: a run full of one pair does not pile up.
            waiting[run] = _summed(*waiting[run])
            heapq.heappush(heap, (int(waiting[run][0][-1]), run, at + 1))


def _summed(pairs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(pairs, kind="stable")
    pairs = pairs[order]
    first = np.nonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))[0]
    return pairs[first], np.add.reduceat(n[order], first)


RUNS = "text long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, part int, run long, n_records long, blocks array<binary>"


def _spill(path_a: str, path_b: str, parts: int, buffer: int, kind, with_groups: bool):
    """Rows of two kinds: a text with its own numbers (part is null), and a run of records of earlier texts."""
    fields = ["doc_id", *(f.split()[0] for f in RUNS.split(", "))] + (["groups"] if with_groups else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(path_a, path_b)
        size_a = align.tokenizers.size_a
        task = TaskContext.get().partitionId() << TEXT_BITS
        held, done, base = [], 0, 0
        count = 0

        def flush():
            nonlocal held, base, count
            if count:
                keys = np.sort(np.concatenate(held))
                first = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0]
                n, keys = np.diff(np.append(first, len(keys))), keys[first]
                part = (keys >> np.uint64(TEXT_BITS)) // np.uint64(size_a) % np.uint64(parts)
                rows = []
                for p in range(parts):
                    mine = part == p
                    if mine.any():
                        rows.append((p, task + base, int(mine.sum()), pack_run(keys[mine], n[mine])))
                none = pa.nulls(len(rows), pa.int64())
                out = [pa.nulls(len(rows), kind), *[none] * 5, pa.nulls(len(rows), pa.string()),
                       *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.binary())), strict=True))]
                yield pa.RecordBatch.from_arrays(out + ([pa.nulls(len(rows), pa.string())] if with_groups else []), names=fields)
            held, base, count = [], done, 0

        for batch in batches:
            raw = batch.column(1)
            sizes = np.diff(np.frombuffer(raw.buffers()[1], np.int32)[raw.offset:raw.offset + len(raw) + 1]) if len(raw) else []
            for at, end in slices(sizes, STEP_CHARS):
                found = align.align(raw[at:end].to_pylist())
                n = end - at
                digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found.groups]
                out = [batch.column(0).slice(at, n), pa.array(task + done + np.arange(n)), *(pa.array(c) for c in (found.n_a, found.n_b, found.n_groups, found.n_links)),
                       pa.array(digests, pa.string()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.binary()))]
                yield pa.RecordBatch.from_arrays(out + ([pa.array(found.groups, pa.string())] if with_groups else []), names=fields)
                of = np.repeat(np.arange(done - base, done - base + n, dtype=np.uint64), found.n_links)
                held.append(found.pairs << np.uint64(TEXT_BITS) | of)
                count += len(found.pairs)
                done += n
                if count >= buffer:
                    yield from flush()
        yield from flush()

    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, pair, n) of each cell; rows come sorted by part and cell."""
    cell, runs = None, []

    def close():
        for pairs, n in merged_counts(runs):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), cell[0], np.int32)), pa.array(pairs.astype(np.int64)), pa.array(n)],
                                             names=["part", "pair", "n"])

    for batch in batches:
        for part, lane, blocks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (part, lane) != cell:
                yield from close()
                cell, runs = (part, lane), []
            runs.append(blocks)
    yield from close()


def _store(folder: str, size_a: int):
    """Pairs in ascending order: stored by part with their counts and whether they are their B id's highest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = -1, []

        def close():
            pairs, n = (np.concatenate(x) for x in zip(*held, strict=True))
            b = pairs // size_a
            first = np.nonzero(np.concatenate([[True], b[1:] != b[:-1]]))[0]
            highest = np.repeat(np.maximum.reduceat(n, first), np.diff(np.append(first, len(b))))
            save(folder, f"pairs-{part}", pairs)
            save(folder, f"counts-{part}", n)
            save(folder, f"best-{part}", n == highest)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([len(pairs)], pa.int64())], names=["part", "pairs"])

        for batch in batches:
            parts, pairs, n = (batch.column(k).to_numpy() for k in range(3))
            cuts = [0, *(np.nonzero(parts[1:] != parts[:-1])[0] + 1).tolist(), len(parts)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if parts[a] != part:
                    if held:
                        yield close()
                    part, held = int(parts[a]), []
                held.append((pairs[a:b].copy(), n[a:b].copy()))
        if held:
            yield close()

    return run


def _contribute(folder: str):
    """(text, n_best, count_sum): every record of a run beside the sorted counts of its part, added up per text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, tuple] = {}
        base, sums = None, None

        def close():
            met = np.nonzero(sums[2])[0]
            return pa.RecordBatch.from_arrays([pa.array(base + met), pa.array(sums[0][met]), pa.array(sums[1][met])],
                                              names=["text", "n_best", "count_sum"])

        for batch in batches:
            for part, first, blocks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if first != base:
                    if base is not None:
                        yield close()
                    base, sums = first, np.zeros((3, 1), np.int64)
                if part not in open_:
                    open_[part] = tuple(load(folder, f"{name}-{part}") for name in ("pairs", "counts", "best"))
                known, counts, best = open_[part]
                for blob in blocks:
                    keys, n = unpack_block(blob)
                    text = (keys & np.uint64((1 << TEXT_BITS) - 1)).astype(np.int64)
                    at = np.searchsorted(known, (keys >> np.uint64(TEXT_BITS)).astype(np.int64))
                    width = int(text.max()) + 1
                    if width > sums.shape[1]:
                        sums = np.concatenate([sums, np.zeros((3, max(width, 2 * sums.shape[1]) - sums.shape[1]), np.int64)], axis=1)
                    np.add.at(sums[0], text, np.where(best[at], n, 0))
                    np.add.at(sums[1], text, n * counts[at])
                    sums[2][text] = 1
        if base is not None:
            yield close()

    return run


def align_tokens(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", parts: int = PARTS,
                 buffer: int = BUFFER, cell_bytes: int = CELL_BYTES, with_groups: bool = False) -> DataFrame:
    """Per document its tokens, groups and links under tokenizers A and B, and how common its links are in the corpus.

    Returns (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), with ``with_groups`` also ``groups``
    as ``a1,a2|b1;a3|b2,b3``. Both tokenizers read a space and the text. A group ends where tokens of both end at the same byte;
    two tokens link where their byte ranges overlap. ``n_best`` counts the links whose pair of ids has its B id's highest count in
    the corpus (ties included), ``count_sum`` adds up the counts of all links' pairs. Texts that are null or empty, or whose tokens
    do not give back the text, have no tokens: zeros and empty strings. Repeated rows are documents of their own and count
    each; an empty table gives an empty result; other columns are not read.
    """
    import pyspark.sql.pandas.types as arrow_types

    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType
    tokenizers = aligner(path_a, path_b).tokenizers
    if tokenizers.size_a * tokenizers.size_b >= 1 << (64 - TEXT_BITS):
        raise ValueError("a pair of ids and a text's place do not fit into 64 bits")
    size_a = tokenizers.size_a
    lanes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = f"{shared_folder(spark).rstrip('/')}/pairs-{hashlib.sha256(os.urandom(16)).hexdigest()[:32]}"
    schema = f"doc_id {kind.simpleString()}, {RUNS}" + (", groups string" if with_groups else "")
    spilled = written(texts(docs, id_col, text_col).mapInArrow(
        _spill(path_a, path_b, parts, buffer, arrow_types.to_arrow_type(kind), with_groups), schema))
    runs = spilled.filter("part IS NOT NULL").select("part", "run", "blocks")
    size = F.aggregate("blocks", F.lit(0).cast("long"), lambda x, y: x + F.length(y))
    room = runs.groupBy("part").agg(F.ceil(F.sum(size) / cell_bytes).cast("int").alias("lanes"))
    dealt = runs.join(F.broadcast(room), "part").select("part", F.pmod(F.xxhash64("run"), F.col("lanes")).cast("int").alias("lane"), "blocks")
    counted = dealt.repartition(lanes, "part", "lane").sortWithinPartitions("part", "lane").mapInArrow(_count, "part int, pair long, n long")
    summed = counted.groupBy("part", "pair").agg(F.sum("n").alias("n"))
    stored = summed.repartition(min(lanes, parts), "part").sortWithinPartitions("part", "pair").mapInArrow(_store(folder, size_a), "part int, pairs long")
    stored.collect()
    back = runs.mapInArrow(_contribute(folder), "text long, n_best long, count_sum long")
    sums = back.groupBy("text").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    own = spilled.filter("part IS NULL").drop("part", "run", "n_records", "blocks")
    zero = F.lit(0).cast("long")
    return own.join(sums, "text", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256", *(["groups"] if with_groups else []))
