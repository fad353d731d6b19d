import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from flowgauge.llm import simhash


def slow_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    codes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(c >> b & 1 for c in codes) > len(codes))


def groups(values, radius=2):
    """Component number of each value, all pairs compared."""
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= radius:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(values))]


def test_documents(awkward, frame, prose):
    docs = awkward.unionByName(frame([(200 + i, prose(2 + i % 60, i // 2) + ("x" if i % 3 else "")) for i in range(80)]))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    prints = [slow_print(t) for _, t in rows]
    of = groups(prints)
    first = {g: min((r[0] for r, h in zip(rows, of, strict=True) if h == g and r[0] is not None), default=None) for g in of}
    want = sorted([(r[0], f"{p:016x}", first[g]) for r, p, g in zip(rows, prints, of, strict=True)], key=repr)
    assert sorted(map(tuple, simhash.near_copies(docs).collect()), key=repr) == want


@pytest.mark.parametrize("tile", [3, 40, 1024])
@pytest.mark.parametrize("radius", [1, 2, 3])
def test_planted_fingerprints(spark, tile, radius):
    """Clusters, chains and a hot block: components equal those of all pairs, whatever the tile size."""
    rng = np.random.default_rng(radius)
    values = [int(x) for x in rng.integers(0, 2**64, 60, dtype=np.uint64)]
    for base in values[:6]:
        x = base
        for _ in range(25):
            for b in rng.choice(64, rng.integers(1, radius + 2), replace=False):
                x ^= 1 << int(b)
            values.append(x)
    values += [(values[0] & ~0xFFFF) | int(v) for v in rng.integers(0, 65536, 80)]
    values = sorted(set(values))
    frame = spark.createDataFrame([(i, int(np.uint64(v).view(np.int64))) for i, v in enumerate(values)], "first_id long, fp long")
    from flowgauge.llm.components import with_roots

    rooted = with_roots(frame, "fp", simhash.close_pairs(frame.select("fp"), radius, tile), "u", "v")
    smallest = {r._root: r.m for r in rooted.groupBy("_root").agg(F.min("first_id").alias("m")).collect()}
    got = {r.first_id: smallest[r._root] for r in rooted.collect()}
    assert [got[i] for i in range(len(values))] == groups(values, radius)


def test_drop(awkward, nothing):
    left = simhash.drop_near_copies(awkward)
    assert left.columns == awkward.columns
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted([1, 4, 5, 6, 7, None], key=repr)
    assert simhash.near_copies(nothing).count() == 0 and simhash.drop_near_copies(nothing).count() == 0


def test_drop_keeps_one_row_of_each_component(frame, prose):
    """Null and shared ids name no component: whole components must not go, nor near copies stay."""
    texts = [prose(60, s) for s in range(9)]
    near = [t.replace(" ", "\t", 1).upper() for t in texts]
    rows = [(None, texts[0]), (None, texts[1]), (None, near[1]), (None, texts[2]), (3, near[2]), (None, texts[3]), (None, texts[3]),
            (7, texts[4]), (7, texts[5]), (7, near[5]), (7, texts[6]), (2, near[6]), (8, texts[7]), (8, texts[7]), (None, None), (9, "")]
    of = groups([slow_print(t) for _, t in rows])
    first = {g: min((i for (i, _), h in zip(rows, of, strict=True) if h == g and i is not None), default=None) for g in of}
    left = [(r.doc_id, r.text) for r in simhash.drop_near_copies(frame(rows)).collect()]
    kept = [of[rows.index(r)] for r in left]
    assert sorted(kept) == sorted(first)
    assert [i for i, _ in left] == [first[g] for g in kept]
