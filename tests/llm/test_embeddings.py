"""Near vectors against brute force, and the error bounds."""

import random

import numpy as np
import pytest

from chemlake.llm import embeddings


def brute(rows, threshold):
    good = {k: np.array(v, np.float64) for k, (_, v) in enumerate(rows) if v is not None and v and None not in v and np.isfinite(np.array(v, np.float64)).all() and np.any(v)}
    root, links = {rows[k][0]: rows[k][0] for k in range(len(rows))}, [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    keys = [*good]
    for x, a in enumerate(keys):
        for b in keys[x + 1 :]:
            u, v = good[a], good[b]
            if len(u) == len(v) and (u @ v) / np.sqrt((u @ u) * (v @ v)) >= threshold:
                links[a] += 1
                links[b] += 1
                low, high = sorted((find(rows[a][0]), find(rows[b][0])))
                root[high] = low
    return sorted((rows[k][0], links[k], find(rows[k][0]), find(rows[k][0]) == rows[k][0]) for k in range(len(rows)))


@pytest.mark.parametrize("tile,pivots", [(1024, 48), (16, 7), (64, 0)])
def test_equals_brute_force(spark, tile, pivots):
    r = np.random.default_rng(tile)
    centres = r.normal(size=(6, 16))
    rows = []
    for i in range(300):
        kind = r.random()
        if kind < 0.4:
            v = centres[0] + r.normal(size=16) * r.choice([0.05, 0.3, 0.5])
        elif kind < 0.6:
            v = centres[r.integers(6)] * r.random() + r.normal(size=16) * 0.2
        elif kind < 0.7 and rows:
            v = np.array(rows[r.integers(len(rows))][1])
        else:
            v = r.normal(size=16)
        rows.append((int(i * 2 + 1), [float(x) for x in v]))
    rows += [(1001, None), (1002, [0.0] * 16), (1003, [None] + [1.0] * 15), (1004, [float("nan")] * 16), (1005, []), (1006, [1.0, 2.0]), (1007, [2.0, 4.0]), (1008, [float("inf")] * 16), (1009, [1e-300, 2e-300]), (1010, [1e300, 2e300])]
    got = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), tile=tile, pivots=pivots)
    want = brute([(i, v) for i, v in rows if i < 1009] + [(1009, [1.0, 2.0]), (1010, [1.0, 2.0])], 0.9)
    assert sorted(map(tuple, got.collect())) == want


def test_edge_cases(spark):
    v = [1.0, 0.0]
    docs = spark.createDataFrame([(1, v, 3), (1, v, 3), (None, v, 3), (None, None, 3), (2, [0.9, 0.01], 3)], "vec_id long, embedding array<float>, n_links int")
    got = sorted((tuple(x) for x in embeddings.near_vectors(docs).collect()), key=str)
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (None, 0, None, True), (None, 0, None, True)]
    assert embeddings.near_vectors(docs.limit(0)).collect() == []


def test_bounds_miss_no_pair():
    r, random_ = np.random.default_rng(1), random.Random(1)
    for _ in range(20):
        n = random_.choice([2, 8, 64])
        a, b = embeddings.unit(r.normal(size=(60, n))), embeddings.unit(r.normal(size=(60, n)))
        for t in (-0.5, 0.1, 0.9):
            may = set(zip(*map(list, embeddings.possible_pairs(a, b, t)), strict=True))
            assert {(i, j) for i in range(60) for j in range(60) if a[i] @ b[j] >= t} <= may


def test_long_vectors_and_one_large_group(spark):
    r = np.random.default_rng(3)
    centre = r.normal(size=1_500)
    rows = [(i, [float(x) for x in np.float32(centre + r.normal(size=1_500) * (0.1 if i % 3 else 2.0))]) for i in range(90)]
    got = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), tile=32)
    assert sorted(map(tuple, got.collect())) == brute(rows, 0.9)


def test_pivots_follow_the_visits():
    r = np.random.default_rng(4)
    scattered = embeddings.unit(r.normal(size=(2_048, 64)))
    centres = embeddings.unit(r.normal(size=(256, 64)))
    clustered = embeddings.unit(centres[r.integers(256, size=2_048)] + r.normal(size=(2_048, 64)) * 0.01)
    few, many = (len(embeddings._pivots(x, 1e6, 0.4473, 8_192)) for x in (scattered, clustered))
    assert few < many and many >= 128


def test_packed_vectors_are_whole():
    for x in ([0.5, -1.25], [0.1, 1e300], [1e-300, 3.0]):
        assert embeddings._unpacked([embeddings._packed(np.array(x)), embeddings._packed(np.array([1.0, 2.0]))], 2).tolist() == [x, [1.0, 2.0]]


def test_merged_labels_equal_components():
    r = random.Random(5)
    for _ in range(50):
        n = r.randint(1, 30)
        label, root = np.arange(n), list(range(n))
        for _ in range(3):
            pairs = [(r.randrange(n), r.randrange(n)) for _ in range(r.randint(0, 12))]
            label = embeddings._merged(label, np.array([a for a, _ in pairs], np.int64), np.array([b for _, b in pairs], np.int64))
            for a, b in pairs:
                low, high = sorted((root[a], root[b]))
                root = [low if x == high else x for x in root]
        assert all((label[a] == label[b]) == (root[a] == root[b]) for a in range(n) for b in range(n))
