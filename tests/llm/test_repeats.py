import hashlib
from collections import Counter

import numpy as np
import pytest

from flowgauge.llm import repeats


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("chunk", [1500, 200_000])
@pytest.mark.parametrize("length", [64, 100])
def test_brute_force(awkward, frame, prose, length, chunk):
    """A passage in many texts, periodic texts, copies, near copies, zero bytes; small chunks spread common anchors."""
    passage, line = prose(40, 77), prose(12, 78)
    texts = [prose(30, 100 + i) + (" " + passage if i % 2 else "") + " " + prose(30, 200 + i) + (line if i % 3 else "") for i in range(40)]
    texts += ["ab " * 100, "ab " * 60 + "c", "Ering, " * 90, "x" * 500, prose(60, 5), prose(60, 5), prose(60, 5) + "!", "\u0000" * 200, "é" * 90]
    docs = awkward.filter("doc_id IS NULL OR doc_id != 4").unionByName(frame([(1000 + i, t) for i, t in enumerate(texts)]))
    docs = docs.repartition(3)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = repeats.remove_repeats(docs, length=length, chunk=chunk).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    want = [(i, *w) for (i, _), w in zip(rows, brute([t for _, t in rows], length), strict=True)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_transform_against_sorted_suffixes():
    rng = np.random.default_rng(0)
    for size in (1, 2, 50, 400):
        symbols = np.concatenate([rng.integers(1, 4, size).astype(np.uint8), [np.uint8(0)]])
        order = repeats.suffix_order(symbols)
        suffixes = sorted(range(size + 1), key=lambda i: symbols[i:].tobytes())
        assert order.tolist() == suffixes
        for length in (1, 3, 8):
            shared = repeats.long_common_prefix(symbols, order, length)
            for r in range(1, size + 1):
                a, b = symbols[order[r - 1]:].tobytes(), symbols[order[r]:].tobytes()
                assert shared[r] == (len(a) >= length and a[:length] == b[:length])


def test_long_text_and_empty_table(frame, nothing, prose):
    long = prose(40_000, 9, words=5000)
    got = repeats.remove_repeats(frame([(1, long), (2, long[1000:3000] + "tail"), (3, "short")])).collect()
    by = {r.doc_id: r for r in got}
    assert [(s.start, s.end) for s in by[1].spans] == [(len(long[:1000].encode()), len(long[:3000].encode()))]
    assert bytes(by[2].kept) == b"tail" and by[3].n_removed == 0
    assert repeats.remove_repeats(nothing).count() == 0
    with pytest.raises(ValueError):
        repeats.remove_repeats(nothing, length=10)
