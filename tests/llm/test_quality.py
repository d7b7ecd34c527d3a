"""Held-out accuracy, and the edge cases."""

import random

import numpy as np
import pyarrow as pa

from chemlake.llm import quality


def rows(n, seed):
    r = random.Random(seed)
    good = lambda: " ".join(r.choice(["the", "cat", "sat", "over", "there", "while", "rain"]) for _ in range(r.randint(5, 60)))
    bad = lambda: r.choice([" | ".join("xyz%d" % r.randint(0, 99) for _ in range(20)), "WIN NOW!! " * 9, "same " * 30, "a###" * 20])
    made = [(i, int(r.random() < 0.8)) for i in range(n)]
    return [(i, good() if y else bad()) for i, y in made], made


def test_held_out_accuracy(spark):
    docs, labels = rows(600, 1)
    d, l = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")  # noqa: E741
    out, truth = quality.score_quality(d, l).collect(), dict(labels)
    aside = [x for x in out if x.held_out]
    assert len(aside) > 60 and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3) for x in out)
    assert sum(x.predicted == truth[x.doc_id] for x in aside) / len(aside) > 0.97


def test_held_out_labels_are_not_learnt(spark):
    docs, labels = rows(300, 2)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    aside = {x.doc_id for x in d.where(quality.held_out(d.doc_id)).collect()}
    turned = [(i, 1 - y if i in aside else y) for i, y in labels]
    one, two = (quality.score_quality(d, spark.createDataFrame(x, "doc_id long, quality int")).select("doc_id", "score").collect() for x in (labels, turned))
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 5), (None, "a b", 5), (2, "", 5), (3, "x" * 200_000, 5)], "doc_id long, text string, score int")
    some = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1)], "doc_id long, quality int")
    for labels in (some, some.limit(0)):
        assert {x.score for x in quality.score_quality(docs, labels).collect()} == {0.5}
    assert quality.score_quality(docs.limit(0), some).collect() == []


def test_descent_comes_near_the_least_hinge_loss():
    r = np.random.default_rng(2)
    for _ in range(5):
        rows = [np.sort(r.choice(12, r.integers(1, 6), replace=False)) for _ in range(40)]
        values = [quality._unit(r.normal(size=12), x) for x in rows]
        signs = np.where(r.random(40) < 0.5, 1.0, -1.0)
        x = np.zeros((40, 13))
        for i, (row, value) in enumerate(zip(rows, values, strict=True)):
            x[i, row], x[i, 12] = value, 1.0
        loss = lambda w: w @ w / 2 + quality.COST * np.maximum(0, 1 - signs * (x @ w)).sum()  # noqa: B023, E731
        weights, bias = quality.descend(rows, values, signs)
        found = loss(np.append(weights[:12], bias))
        # the dual, by plain projected gradient steps
        q, dual = (x * signs[:, None]) @ (x * signs[:, None]).T, np.zeros(40)
        for _ in range(20_000):
            dual = np.clip(dual - 0.01 * (q @ dual - 1), 0, quality.COST)
        best = loss(x.T @ (dual * signs))
        assert best - 1e-6 <= found <= 1.03 * best


def test_counts_equal_plain_counts():
    texts, labels = ["a b a b", "a b c", "", None, "x y z a b"], [1, 0, 1, 0, 1]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(labels, pa.int32())], ["t", "l"])
    got = next(quality._counts(iter([batch]))).to_pylist()
    each = [set(f.tolist()) for f in quality.features(pa.array(texts, pa.string()))]
    want = {f: tuple(sum(f in e for e, y in zip(each, labels, strict=True) if y == c) for c in (0, 1)) for f in set().union(*each)}
    assert {g["feature"]: (g["n0"], g["n1"]) for g in got} == want | {-1: (2, 3)}


def test_empty_tables_and_repeated_rows(spark):
    docs, labels = rows(60, 5)
    d, l = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")  # noqa: E741
    assert quality.score_quality(d.limit(0), l).collect() == [] and {x.score for x in quality.score_quality(d, l.limit(0)).collect()} == {0.5}
    twice = quality.score_quality(d.union(d), l).groupBy("doc_id").agg({"score": "min", "*": "count"}).collect()
    assert len(twice) == 60
