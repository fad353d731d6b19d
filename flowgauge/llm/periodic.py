"""Periodic runs in word sequences, by the branching-tandem test on an enhanced suffix array.

A stretch of documents is one array of word numbers in which a document's suffixes only compare with each other. Suffix array,
inverse and the ranks of all power-of-two prefixes come from doubling; common prefixes of neighbours follow from the ranks.
Every boundary between neighbours stands for one split of an LCP interval into two sides that share exactly ``depth`` words: for
each suffix i of the smaller side, a look into the inverse at i + depth and i - depth tells whether the partner lies on the other
side. If so, a square of period ``depth`` ends there that cannot move on by a word. Squares are rotated to the left as far as
their period holds; those that end up with one stretch are one run, and its smallest period stays. The tree of intervals is
never built: its sides are two searches for the next smaller value.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices, texts

SHORTEST = 12
CHUNK_BYTES = 1_000_000
VISITS = 4_000_000


def numbered(documents: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all documents in a row, each document closed by a number of its own, and the documents' starts."""
    ids: dict[bytes, int] = {}
    flat = np.fromiter((ids.setdefault(w, len(ids)) for words in documents for w in (*words, None)), np.int64,
                       sum(map(len, documents)) + len(documents))
    starts = np.concatenate([[0], np.cumsum([len(words) + 1 for words in documents])])
    # The closing mark is smaller than every word.
    flat += 1
    flat[starts[1:] - 1] = 0
    return flat, starts


def prefix_ranks(symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix order, and per k the ranks of all prefixes of 2**k symbols; a rank is the place where its group begins.

    Ranks begin with the document, so equal words of two documents differ.
    """
    n = len(symbols)
    document = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    key = document * (int(symbols.max(initial=0)) + 1) + symbols
    order = np.argsort(key, kind="stable")
    ordered, place, width = key[order], np.arange(n), 1
    rank = np.empty(n, np.int64)
    levels = []
    while len(place):
        first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        start = place[np.nonzero(first)[0]][np.cumsum(first) - 1]
        rank[order[place]] = start
        levels.append(rank.astype(np.int32 if n < 1 << 31 else np.int64))
        tie = ~first
        tie[:-1] |= ~first[1:]
        place = place[tie]
        suffix = order[place]
        # Suffixes that tie hold no closing mark among their first ``width`` symbols.
        pair = rank[suffix] * n + rank[suffix + width]
        by = np.argsort(pair, kind="stable")
        order[place], ordered = suffix[by], pair[by]
        width *= 2
    return order, levels


def shared_ahead(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Number of equal symbols from i and from j on."""
    shared = np.zeros(len(i), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        shared += (levels[k][i + shared] == levels[k][j + shared]).astype(np.int64) << k
    return shared


def shared_behind(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Number of equal symbols that end before i and before j; i is the smaller one and does not go below ``least``."""
    shared = np.zeros(len(i), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        back = shared + (1 << k)
        room = i - back >= least
        a, b = np.where(room, i - back, 0), np.where(room, j - back, 0)
        shared = np.where(room & (levels[k][a] == levels[k][b]), back, shared)
    return shared


def sides(lcp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``at``: first row of its left side (after the last value <= its own), last row of its right side."""
    n = len(lcp)
    least = [lcp]
    while 2 << (len(least) - 1) <= n:
        half, prior = 1 << (len(least) - 1), least[-1]
        least.append(np.minimum(prior[:-half], prior[half:]))
    own = lcp[at]
    left, right = at - 1, at + 1
    for k in range(len(least) - 1, -1, -1):
        size = 1 << k
        # Rows left - size + 1 .. left all above: step over them.
        can = left - size + 1 >= 0
        low = least[k][np.where(can, left - size + 1, 0)]
        left = np.where(can & (low > own), left - size, left)
        can = right + size <= n
        low = least[k][np.where(can, right, 0)]
        right = np.where(can & (low >= own), right + size, right)
    return left, right - 1


def squares(order: np.ndarray, inverse: np.ndarray, lcp: np.ndarray, visits: int = VISITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start, period) of every square that the next word does not continue.

    ``lcp[r]`` belongs to rows r - 1 and r. Only the suffixes of each boundary's smaller side are visited.
    """
    n = len(order)
    at = np.nonzero(lcp > 0)[0]
    if not len(at):
        return
    low, high = sides(lcp, at)
    depth = lcp[at]
    small_left = at - low <= high - at + 1
    first = np.where(small_left, low, at)
    size = np.where(small_left, at - low, high - at + 1)
    other_low, other_high = np.where(small_left, at, low), np.where(small_left, high, at - 1)
    for a, b in slices(size.tolist(), visits):
        # A side above ``visits`` stands alone and is cut.
        for c in range(0, int(size[a:b].sum()), visits) if b - a == 1 else (0,):
            n_rows = np.minimum(size[a:b] - c, visits) if b - a == 1 else size[a:b]
            of = np.repeat(np.arange(a, b), n_rows)
            suffix = order[np.repeat(first[a:b] + c - (np.cumsum(n_rows) - n_rows), n_rows) + np.arange(len(of))]
            for step in (1, -1):
                partner = suffix + step * depth[of]
                inside = (partner >= 0) & (partner < n)
                row = inverse[np.where(inside, partner, 0)]
                hit = np.nonzero(inside & (row >= other_low[of]) & (row <= other_high[of]))[0]
                if len(hit):
                    yield np.minimum(suffix[hit], partner[hit]), depth[of[hit]]


def runs(symbols: np.ndarray, starts: np.ndarray, shortest: int = SHORTEST) -> np.ndarray:
    """Rows (document, start, length, period) of all runs, by document, start and period."""
    n = len(symbols)
    order, levels = prefix_ranks(symbols, starts)
    inverse = np.empty(n, np.int64)
    inverse[order] = np.arange(n)
    lcp = np.concatenate([[0], shared_ahead(levels, order[:-1], order[1:])])
    found = list(squares(order, inverse, lcp))
    if not found:
        return np.zeros((0, 4), np.int64)
    start, period = (np.concatenate(x) for x in zip(*found, strict=True))
    document = np.searchsorted(starts, start, side="right") - 1
    begin = start - shared_behind(levels, start, start + period, starts[document])
    length = start + 2 * period - begin
    long_enough = length >= shortest
    table = np.stack([document, begin - starts[document], length, period], 1)[long_enough]
    # Squares of one run share its stretch; multiples of the period have the same stretch and come after it.
    table = table[np.lexsort((table[:, 3], table[:, 2], table[:, 1], table[:, 0]))]
    new = np.concatenate([[True], (table[1:, :3] != table[:-1, :3]).any(1)])[:len(table)]
    table = table[new]
    return table[np.lexsort((table[:, 3], table[:, 1], table[:, 0]))]


def collapsed(words: list[bytes], table: np.ndarray) -> list[bytes]:
    """Words without those that any run (start, length, period) holds after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, table[:, 0] + table[:, 2], 1)
    np.add.at(change, table[:, 0] + table[:, 1], -1)
    gone = np.cumsum(change[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g] if gone.any() else words


SCHEMA = "doc_id {id}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST,
              prepare: Callable[[str, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """Per document its runs and the text without repetitions: (doc_id, n_words, runs, collapsed).

    A run is a stretch of at least ``shortest`` words and two of its smallest period which no neighbouring word continues.
    ``runs`` is ordered by start, then period; ``collapsed`` joins the words that no run holds after its first period by
    single spaces. ``prepare`` may change a document's words beforehand, given its id as text (a null id: empty).
    Null and empty texts have no words, no runs and an empty collapsed text. Repeated rows are documents of their own; other
    columns are not read. A text is never cut: memory grows with the longest one, by about 300 bytes a word.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def solved(ids: list[str], raw: list[bytes]):
        documents = [data.split() for data in raw]
        if prepare is not None:
            documents = [prepare(i, words) for i, words in zip(ids, documents, strict=True)]
        symbols, starts = numbered(documents)
        table = runs(symbols, starts, shortest)
        cuts = np.searchsorted(table[:, 0], np.arange(len(documents) + 1))
        for words, a, b in zip(documents, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            mine = table[a:b, 1:]
            yield len(words), [{"start": s, "length": n, "period": p} for s, n, p in mine.tolist()], b" ".join(collapsed(words, mine))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(2).to_pylist()
            raw = batch.column(1).cast(pa.binary())
            sizes = [len(x) for x in raw.to_pylist()]
            for a, b in slices(sizes, CHUNK_BYTES):
                rows = list(solved(ids[a:b], raw[a:b].to_pylist()))
                n_words, found, kept = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n_words, pa.int64()), pa.array(found, RUN),
                     pa.array(kept, pa.binary()).view(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    rows = texts(docs, id_col, text_col).selectExpr("doc_id", "text", "coalesce(cast(doc_id AS string), '') AS name")
    return rows.mapInArrow(run, SCHEMA.format(id=kind))


