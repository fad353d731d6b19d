import hashlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowgauge.llm import lines
from flowgauge.llm.queries import op11_line_dedup


def brute(rows, shortest=10):
    """rows of (id, text): (id, n_lines, n_dropped, kept) by plain dictionaries."""
    def key(line):
        bare = line.strip("\x20\x09\x0a\x0b\x0c\x0d")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in bare)

    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= shortest:
                holders[key(line)].add((i is None, i or 0))
    out = []
    for i, text in rows:
        every = (text or "").split("\n")
        stay = [x for x in every if len(holders[key(x)]) < 2 or min(holders[key(x)]) == (i is None, i or 0)]
        out.append((i, len(every), len(every) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def test_against_brute_force(spark, frame):
    rng = np.random.default_rng(5)
    pool = ["This line is shared", "  this LINE is shared\t", "été à la plage", "çà et là", "short", "", "\r", "ÀÉ is not lower-cased",
            "àé is not lower-cased", "a line of its own", "nine char", "ten chars!", "ten çhars!", "x" * 3000]
    rows = [(int(i), "\n".join(rng.choice(pool, rng.integers(0, 9)))) for i in rng.permutation(60)]
    rows += [(7, "again\nThis line is shared"), (7, "This line is shared"), (None, "this line is shared\nten chars!"), (None, None), (99, "")]
    rows += [(200 + i, "hot line for a third of all\nown line of number " + str(i)) for i in range(40)]
    got = sorted(map(tuple, lines.drop_repeated_lines(frame(rows), segment_lines=8).collect()), key=str)
    assert got == brute(rows)


def test_awkward_and_empty(spark, awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert sorted(map(tuple, lines.drop_repeated_lines(awkward).collect()), key=str) == brute(rows)
    assert lines.drop_repeated_lines(nothing).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**64 - 1), max_size=40), min_size=1, max_size=6), st.integers(1, 50))
def test_filters_miss_no_repeat(tasks, room):
    """Any hash of two tasks, or of two documents in one, is in the twice-seen filter, whatever the filter's size."""
    filters, seen, twice = lines.TwoFilters(room), set(), set()
    for task in tasks:
        values, n = np.unique(np.array(task, np.uint64), return_counts=True)
        filters.add(values, n > 1)
        twice |= {v for v, k in zip(values.tolist(), n.tolist()) if k > 1 or v in seen}
        seen |= set(values.tolist())
    known = np.array(sorted(twice), np.uint64)
    word, bits = lines.place(known, len(filters.twice))
    assert ((filters.twice[word] & bits) == bits).all()


def test_few_single_lines_are_suspected():
    rng = np.random.default_rng(1)
    hashes = np.unique(rng.integers(0, 2**63, 100_000, dtype=np.uint64))
    filters = lines.TwoFilters(len(hashes))
    for part in np.array_split(rng.permutation(hashes), 20):
        filters.add(np.sort(part), np.zeros(len(part), bool))
    word, bits = lines.place(hashes, len(filters.twice))
    assert ((filters.twice[word] & bits) == bits).mean() < 0.02


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, op11_line_dedup(spark, folder).collect()), key=str)
    want = [(i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in brute([tuple(r) for r in rows])]
    assert got == sorted(want, key=str) and any(r[2] for r in got)
