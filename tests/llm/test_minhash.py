"""Near duplicates against brute force."""

import random
import re

import pytest

from chemlake.llm import minhash


def brute(rows, size, percent):
    sets, fold = {}, str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for i, text in rows:
        found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(fold))
        sets[i] = {tuple(found[k : k + size]) for k in range(max(1, len(found) - size + 1))} if found else set()
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(root)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            shared, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if union and 100 * shared >= percent * union:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, n):
    r = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)]
    passage = [r.choice(vocabulary) for _ in range(60)]
    base = [r.choice(vocabulary) for _ in range(120)]
    rows = []
    for i in range(n):
        kind = r.random()
        if kind < 0.3:  # near copies of one text, more or less changed
            own = [r.choice(vocabulary) if r.random() < r.choice([0.005, 0.02, 0.04]) else w for w in base]
        elif kind < 0.5:  # one passage shared by many texts
            own = passage + [r.choice(vocabulary) for _ in range(r.randint(3, 60))]
        elif kind < 0.6 and rows:
            own = (r.choice(rows)[1] or "").upper().split()
        elif kind < 0.7:
            own = [r.choice(vocabulary[:3]) for _ in range(r.randint(0, 4))]
        else:
            own = [r.choice(vocabulary) for _ in range(r.randint(1, 150))]
        rows.append((i * 3 + 1, r.choice([" ", "\n", "\t "]).join(own)))
    return [*rows, (100_001, None), (100_002, ""), (100_003, " \n")]


@pytest.mark.parametrize("size,percent,short", [(3, 85, 32), (5, 80, 4)])
def test_equals_brute_force(spark, monkeypatch, size, percent, short):
    monkeypatch.setattr(minhash, "SHORT_LIST", short)
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rows = corpus(size, 260)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumnsRenamed({})
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, shingle=size, percent=percent).collect()}
    assert found == brute(rows, size, percent)


def test_clashing_columns_null_ids_and_repeated_rows(spark):
    rows = [(1, "a b c d", 9, 9), (2, "A b c d", 9, 9), (None, "a b c d", 9, 9), (2, "A b c d", 9, 9), (4, "x", 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_shingles int, component_id int")
    found = sorted((tuple(r) for r in minhash.near_duplicates(docs, shingle=3, percent=85).collect()), key=str)
    assert found == [(1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), (4, 1, 4, True), (None, 2, None, True)]


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
