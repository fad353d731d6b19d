import hashlib
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from flowgauge.llm import mixing


def brute(rows, share=1.5, weights=(5, 2, 1), most=2):
    """Targets by sharing the excess again and again, in exact fractions; then the cut in key order."""
    size = lambda t: len((t or "").encode().split())
    of = defaultdict(list)
    for i, text, source in rows:
        of[source].append((hashlib.md5(f"mix-1:{'' if i is None else i}".encode()).hexdigest(), -1 if i is None else i, size(text)))
    names = sorted((s for s in of if s is not None), key=lambda s: s.encode()) + ([None] if None in of else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total = {s: sum(x[2] for x in of[s]) for s in names}
    goal, full = Fraction(share) * sum(total.values()), set()
    while True:
        free = [s for s in names if s not in full]
        left = goal - sum(most * total[s] for s in full)
        target = {s: Fraction(most * total[s]) for s in full} | {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if target[s] > most * total[s]]
        if not above:
            break
        full |= set(above)
    out = []
    for s in names:
        budget = int(target[s])
        epochs, rest = divmod(budget, total[s]) if total[s] else (0, 0)
        for _, i, n in sorted(of[s]):
            part = max(0, min(n, rest))
            rest -= n
            out.append((None if i == -1 else i, n, total[s], float(target[s]), epochs * n + part))
    return out


def rounded(rows):
    return sorted([(a, b, c, round(d, 6), e) for a, b, c, d, e in rows], key=repr)


@pytest.mark.parametrize("hot", [0, 400])
def test_brute_force(spark, frame, prose, awkward, hot):
    rows = [(1000 + i, prose(5 + i % 40, i), f"s{i % 7}") for i in range(200)] + [(5000 + i, prose(9, i), "hot") for i in range(hot)]
    docs = awkward.unionByName(frame(rows))
    got = mixing.mix(docs).select("doc_id", "_mix_size", "_mix_source_size", "_mix_target", "_mix_taken").collect()
    plain = [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]
    assert rounded(map(tuple, got)) == rounded(brute(plain))
    assert all(r._mix_taken <= 2 * r._mix_size for r in got)


def test_reruns_and_partitions_agree(frame, prose):
    docs = frame([(i, prose(1 + i % 30, i), f"s{i % 3}") for i in range(300)])
    pick = lambda d: sorted(map(tuple, mixing.mix(d).select("doc_id", "_mix_taken").collect()))
    assert pick(docs) == pick(docs.repartition(13).orderBy(F.col("doc_id").desc()))


def test_documents_hold_the_words_taken(frame, prose):
    docs = frame([(i, prose(1 + i % 30, i), f"s{i % 4}") for i in range(120)])
    taken = {r.doc_id: r._mix_taken for r in mixing.mix(docs).collect()}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got = defaultdict(int)
    for r in out.collect():
        got[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
    assert dict(got) == {i: n for i, n in taken.items() if n}


def test_empty(nothing, frame):
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0
    blank = mixing.mix(frame([(1, "", "a"), (2, None, None)])).collect()
    assert [(r._mix_size, r._mix_target, r._mix_taken) for r in blank] == [(0, 0.0, 0)] * 2
