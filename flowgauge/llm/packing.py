"""Packing by power-of-two decomposition: documents become pieces of binary lengths, equal lengths share a bucket.

A document of n tokens gives n // 4096 full pieces and one piece for each set bit of the rest. A piece is a sequence
of its own, so no sequence crosses documents and none needs padding. The work is one pass without a shuffle.
"""

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts

LONGEST = 4096
END = 2
BATCH_BYTES = 8_000_000
CACHED_WORDS = 1_000_000
MARKS = b".,;:!?"

PIECE = ("doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, bucket int")


class WordIds:
    """Token ids of white-space separated words, each distinct word tokenized once per worker.

    The tokenizer lower-cases, drops white space, never merges across it, and keeps a letter or digit apart from a mark
    after it. So a text's ids are the ids of its lower-cased words in a row, a final mark being a word of its own. Texts
    that may hold special strings are not lower-cased beforehand. A full cache is emptied; that costs time only.
    """

    def __init__(self, tokenizer_path: str, cached_words: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        self.cached_words = cached_words

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self._clear()

    def _clear(self) -> None:
        # Entry 0 has no ids, entry 1 is the end token.
        self.known: dict[bytes, int] = {b"": 0, b"\n": 1}
        self.count, self.flat = np.array([0, 1]), np.zeros(1, "<u4")

    def _learn(self, words: set[bytes]) -> None:
        fresh = [w for w in words if w not in self.known]
        if fresh:
            found = [e.ids for e in self.tokenizer.encode_batch_fast([w.decode("utf-8") for w in fresh], add_special_tokens=False)]
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh)), strict=True))
            self.count = np.concatenate([self.count, np.fromiter(map(len, found), np.int64, len(found))])
            self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(found), "<u4")])

    def encode(self, texts: list[bytes], end: int) -> list[np.ndarray]:
        """Ids of each text, the end id last."""
        if len(self.known) > self.cached_words:
            self._clear()
        documents = [(t if b"<|" in t else t.lower()).split() for t in texts]
        raw = list(set(chain.from_iterable(documents)))
        cut = [len(w) - 1 if len(w) > 1 and w[-1] in MARKS and w[-2:-1].isalnum() else len(w) for w in raw]
        cores = [w[:n] for w, n in zip(raw, cut, strict=True)]
        tails = [w[n:] for w, n in zip(raw, cut, strict=True)]
        self._learn({*cores, *tails})
        get = self.known.__getitem__
        pair = np.empty((len(raw) + 1, 2), np.int64)
        pair[:-1, 0] = np.fromiter(map(get, cores), np.int64, len(raw))
        pair[:-1, 1] = np.fromiter(map(get, tails), np.int64, len(raw))
        pair[-1] = (1, 0)
        # Ids of this part's distinct words in a row, then one lookup per word of the texts.
        self.flat[0] = end
        known_first = np.cumsum(self.count) - self.count
        own = self.flat[_spread(known_first[pair.reshape(-1)], self.count[pair.reshape(-1)])]
        size = self.count[pair].sum(1)
        local = dict(zip(raw, range(len(raw)), strict=True))
        local[b"\n"] = len(raw)
        for words in documents:
            words.append(b"\n")
        lengths = np.fromiter(map(len, documents), np.int64, len(documents))
        index = np.fromiter(map(local.__getitem__, chain.from_iterable(documents)), np.int32, int(lengths.sum()))
        n = size[index]
        ids = own[_spread((np.cumsum(size) - size)[index], n)]
        return np.split(ids, np.cumsum(n)[np.cumsum(lengths) - 1][:-1]) if len(documents) else []


def _spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... of each run of n."""
    total = int(n.sum())
    kind = np.int32 if total < 1 << 31 else np.int64
    ends = np.cumsum(n)
    places = np.repeat((first - (ends - n)).astype(kind), n)
    places += np.arange(total, dtype=kind)
    return places


_BY_PATH: dict[tuple[str, int], WordIds] = {}


def word_ids(tokenizer_path: str, cached_words: int = CACHED_WORDS) -> WordIds:
    """One cache per worker process, kept from task to task."""
    if (tokenizer_path, cached_words) not in _BY_PATH:
        _BY_PATH[tokenizer_path, cached_words] = WordIds(tokenizer_path, cached_words)
    return _BY_PATH[tokenizer_path, cached_words]


def binary_pieces(n: int, longest: int = LONGEST) -> list[int]:
    """Lengths of the pieces of ``n`` tokens, largest first."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(longest.bit_length() - 2, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST,
         end: int = END, with_ids: bool = False, cached_words: int = CACHED_WORDS, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Pieces of all documents: one row each, with ``ids`` where ``with_ids`` is set.

    ``longest`` is a power of two. A null or empty text is the single end token; repeated rows are packed each;
    special strings in a text become what the tokenizer makes of them. ``bucket`` is the piece's power of two. Sequence
    ids are unique and ascend by bucket: bucket, task and place in the task share one 64-bit number. ``cached_words`` and
    ``batch_bytes`` bound a worker's memory and change no result.
    """
    kind = docs.schema[id_col].dataType
    schema = PIECE.format(id=kind.simpleString()) + (", ids array<long>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer_path, cached_words)
        task = TaskContext.get().partitionId()
        used = [0] * longest.bit_length()
        for batch in batches:
            column = batch.column(1).cast(pa.binary())
            sizes = np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]) \
                if len(column) else []
            for a, b in slices(sizes, batch_bytes):
                coded = words.encode(column[a:b].to_pylist(), end)
                rows = []
                for i, ids in enumerate(coded):
                    at, raw = 0, ids.tobytes()
                    for length in binary_pieces(len(ids), longest):
                        bucket = length.bit_length() - 1
                        crc = zlib.crc32(raw[4 * at:4 * (at + length)])
                        rows.append((a + i, at, length, crc, len(ids), bucket << 58 | task << 33 | used[bucket], 0, bucket))
                        used[bucket] += 1
                        at += length
                table = list(zip(*rows, strict=True))
                out = [batch.column(0).take(pa.array(table[0])), *(pa.array(c, pa.int64()) for c in table[1:7]),
                       pa.array(table[7], pa.int32())]
                if with_ids:
                    out.append(pa.array([coded[r[0] - a][r[1]:r[1] + r[2]].astype(np.int64) for r in rows]))
                yield pa.RecordBatch.from_arrays(out, names=[f.split()[0] for f in schema.split(", ")])

    return texts(docs, id_col, text_col).mapInArrow(run, schema)


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Store pieces by length: a reader of one bucket gets sequences of one shape."""
    pieces.withColumn("length_bucket", F.col("bucket")).write.partitionBy("length_bucket").parquet(path)
