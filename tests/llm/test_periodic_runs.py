"""Runs of words against brute force."""

import hashlib
import random
import zlib

import duckdb

from chemlake.llm import oracles, periodic_runs, queries


def brute_force(words, least):
    """Every maximal stretch of each smallest period, by comparing words at each distance."""
    found = []
    for q in range(1, len(words) // 2 + 1):
        k = 0
        while k + q < len(words):
            start = k
            while k + q < len(words) and words[k] == words[k + q]:
                k += 1
            length = k + q - start
            smaller = any(all(words[start + t] == words[start + t + p] for t in range(length - p)) for p in range(1, q))
            if length >= max(least, 2 * q) and not smaller:
                found.append((start, length, q))
            k += 1
    return sorted(found)


def made(r, most=40):
    n, letters = r.randint(0, most), r.randint(1, 4)
    words = [r.choice("abcd"[:letters]) for _ in range(n)]
    if n and r.random() < 0.5:
        a = r.randrange(n)
        p = 1 + r.randrange((n - a) // 2 + 1)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_runs_equal_brute_force():
    r = random.Random(5)
    for _ in range(1_500):
        words, least = made(r), r.choice([2, 5, 12])
        assert periodic_runs.find_runs_of(words, least) == brute_force(words, least), words


def test_the_lyndon_array_is_that_of_the_definition():
    r = random.Random(6)
    for _ in range(500):
        ranks = [r.randrange(3) for _ in range(r.randint(0, 20))]
        following, common, _ = periodic_runs.lyndon_array(ranks)
        for i in range(len(ranks)):
            j = next(j for j in range(i + 1, len(ranks) + 1) if ranks[j:] < ranks[i:])
            a = next(k for k in range(len(ranks)) if j + k == len(ranks) or ranks[i + k] != ranks[j + k])
            assert (following[i], common[i]) == (j, a)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def row_of(doc_id, text):
    """The query's row by its definition, word by word."""
    words = (text or "").encode().split()
    words, n = [w.decode() for w in words], len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_force(words, 12)
    best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
    kept = " ".join(w for i, w in enumerate(words) if not any(s + q <= i < s + length for s, length, q in runs))
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *four, digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)), digest(kept))


def test_the_query_equals_its_definition(spark, tmp_path):
    r = random.Random(7)
    docs = [(i, r.choice([" ", "\n", "\x0b "]).join(made(r, 90)), "x") for i in range(300)]
    docs += [(i, " ".join(f"w{r.randrange(400)}" for _ in range(r.randint(1, 200))), "x") for i in range(300, 420)]
    docs += [(1_000, None, "x"), (1_001, "", "x"), (1_002, " \n", "x"), (None, "a b " * 9, "x"), (1_003, "a b " * 12, "x"), (5, "a a a", "x"), (5, "a a a", "x"), (-7, "é É " * 7, "x")]
    spark.createDataFrame(docs, "doc_id long, text string, runs string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op13_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found), key=str) == sorted((row_of(i, t) for i, t, _ in docs), key=str)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet' WHERE doc_id IS NOT NULL")
    columns = ", ".join(found[0].__fields__)
    assert sorted(db.sql(f"SELECT {columns} FROM ({oracles.OP13})").fetchall(), key=str) == sorted((tuple(r) for r in found if r.doc_id is not None), key=str)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(420)) > 20


def test_very_long_and_empty_tables(spark):
    long = "x y z " * 200_000
    docs = spark.createDataFrame([(1, long, 3), (2, "a " * 300_000, 3)], "doc_id long, text string, _found int")
    rows = {x.doc_id: x for x in periodic_runs.find_runs(docs).collect()}
    assert [tuple(x) for x in rows[1].runs.runs] == [(0, 600_000, 3)] and rows[1].runs.collapsed == "x y z" and rows[1]._found == 3
    assert [tuple(x) for x in rows[2].runs.runs] == [(0, 300_000, 1)]
    assert periodic_runs.find_runs(docs.limit(0)).collect() == []
