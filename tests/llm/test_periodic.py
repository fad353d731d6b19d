import hashlib
import zlib

import numpy as np
import pytest

from flowgauge.llm import periodic
from flowgauge.llm.queries import op13_periodic_runs


def brute(words, shortest=12):
    """(start, length, period): stretches that keep a period, for each period on its own, the smallest period first."""
    n, found = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            if i + p - start >= max(shortest, 2 * p):
                found.setdefault((start, i + p - start), p)
    return sorted((s, n, p) for (s, n), p in found.items())


def left(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def random_words(rng):
    n, v = int(rng.integers(0, 70)), int(rng.integers(1, 5))
    words = [b"%d" % x for x in rng.integers(0, v, n)]
    for _ in range(int(rng.integers(0, 3)) if n else 0):
        a, p = int(rng.integers(0, n)), int(rng.integers(1, 12))
        end = int(rng.integers(a, n + 1))
        words = [words[a + (i - a) % p] if a <= i < end and a + (i - a) % p < n else w for i, w in enumerate(words)]
    return words


@pytest.mark.parametrize("shortest", [2, 12])
def test_runs_against_brute_force(shortest):
    rng = np.random.default_rng(8)
    total = 0
    for _ in range(300):
        documents = [random_words(rng) for _ in range(int(rng.integers(1, 5)))]
        table = periodic.runs(*periodic.numbered(documents), shortest)
        for d, words in enumerate(documents):
            mine = table[table[:, 0] == d, 1:]
            want = brute(words, shortest)
            total += len(want)
            assert [tuple(r) for r in mine.tolist()] == want
            assert periodic.collapsed(words, mine) == left(words, want)
    assert total > 300


@pytest.mark.parametrize("visits", [1, 7, 1000])
def test_visits_in_parts_are_the_same(visits):
    words = [b"a", b"b"] * 40 + [b"a"] * 30
    symbols, starts = periodic.numbered([words])
    order, levels = periodic.prefix_ranks(symbols, starts)
    inverse = np.argsort(order)
    lcp = np.concatenate([[0], periodic.shared_ahead(levels, order[:-1], order[1:])])
    got = {p for part in periodic.squares(order, inverse, lcp, visits) for p in zip(*map(np.ndarray.tolist, part), strict=True)}
    n = len(words)
    want = {(i, p) for p in range(1, n // 2 + 1) for i in range(n - 2 * p + 1)
            if words[i:i + p] == words[i + p:i + 2 * p] and (i + 2 * p == n or words[i + p] != words[i + 2 * p])}
    assert got == want


def test_one_word_many_times_and_long_texts():
    """The deepest boundaries there are, and a period of thousands."""
    words = [b"x"] * 20_000
    assert periodic.runs(*periodic.numbered([words, words])).tolist() == [[0, 0, 20_000, 1], [1, 0, 20_000, 1]]
    unique = [b"%d" % i for i in range(7000)]
    assert periodic.runs(*periodic.numbered([unique * 3 + unique[:5]])).tolist() == [[0, 0, 21_005, 7000]]


def test_awkward_and_empty(awkward, nothing, frame):
    rows = {(r.doc_id, r.n_words): r for r in periodic.find_runs(awkward).collect()}
    assert len(rows) == 9 and rows[1, 0].runs == [] and rows[2, 0].collapsed == "" and rows[4, 40_000].collapsed
    loud = [r for (i, _), r in rows.items() if i == 7][0]
    assert [(r.start, r.length, r.period) for r in loud.runs] and len(loud.collapsed.split()) < 10
    assert periodic.find_runs(nothing).count() == 0
    got = periodic.find_runs(frame([(1, "a  b\n" * 6 + "end"), (1, "a b " * 6), (2, "A b a b " * 3)])).orderBy("doc_id", "collapsed").collect()
    assert [r.collapsed for r in got] == ["a b", "a b end", "A b a b"]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query(spark, folder):
    def expected(doc_id, text):
        words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = brute(words)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        tail = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join("%d,%d,%d\n" % r for r in found), " ".join(left(words, found)))]
        return (doc_id, len(found), *tail, *digest)

    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").filter("length(text) < 20000").collect()
    got = {r[0]: tuple(r) for r in op13_periodic_runs(spark, folder).collect()}
    want = [expected(*r) for r in rows]
    assert [got[w[0]] for w in want] == want and sum(w[1] for w in want) > 10
