import numpy as np
import pytest

from flowgauge.llm import embedding_dedup


def brute(vectors, threshold=0.9):
    n = len(vectors)
    links, parent = [0] * n, list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    good = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    for i in range(n):
        for j in range(i):
            if good[i] and good[j] and len(vectors[i]) == len(vectors[j]):
                a, b = np.array(vectors[i], float), np.array(vectors[j], float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    parent[max(find(i), find(j))] = min(find(i), find(j))
    return [(i, links[i], find(i), find(i) == i) for i in range(n)]


@pytest.mark.parametrize("tile", [4, 1024])
def test_brute_force(spark, tile):
    """Clusters around the threshold, many equal vectors, scaled copies, unusable ones, several widths."""
    rng = np.random.default_rng(2)
    base = rng.normal(size=(12, 64))
    near = [b + rng.normal(size=64) * s for b in base for s in (0.1, 0.2, 0.3, 0.4)]
    vectors = [v.astype(np.float32).tolist() for v in [*base, *near]]
    vectors += [vectors[0]] * 30 + [[2 * x for x in vectors[1]]] + [None, [], [0.0] * 64, [float("nan")] * 64, [float("inf")] + [1.0] * 63]
    vectors += [[1.0, None] * 32, [1.0, 2.0, 3.0], [1.0, 2.0, 3.1], [1.0], [-1.0], [3.0]]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, n int, x string")
    got = sorted(map(tuple, embedding_dedup.near_vectors(df, tile=tile).collect()))
    assert got == brute(vectors)


def test_null_and_shared_ids(spark):
    """No row is lost or multiplied: null ids, two vectors with one id, copies with null ids."""
    a, b, c = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 1.0, 0.1]
    rows = [(None, a), (None, a), (7, b), (7, c), (9, b), (None, c), (None, [0.0, 0.0, 0.0]), (7, [0.0, 0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(map(tuple, embedding_dedup.near_vectors(df).collect()), key=str)
    want = [(None, 1, None, True)] * 2 + [(7, 3, 7, True)] * 2 + [(9, 3, 7, False), (None, 3, 7, False), (None, 0, None, True), (7, 0, 7, True)]
    assert got == sorted(want, key=str)


def test_recall_at_the_threshold():
    """Pairs at a cosine of exactly 0.9 share a bucket nearly always."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(1)[:, None] * x
    z /= np.linalg.norm(z, axis=1)[:, None]
    y = 0.9 * x + np.sqrt(1 - 0.81) * z
    a, b = embedding_dedup.bucket_codes(x), embedding_dedup.bucket_codes(y)
    met = (a[:, :, :, None] == b[:, :, None, :]).any((1, 2, 3)).mean()
    assert met > 0.995


def test_rotation_keeps_lengths_and_empty_table(spark):
    x = np.random.default_rng(1).normal(size=(5, 64))
    assert np.allclose(np.linalg.norm(embedding_dedup.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert embedding_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
