"""Divergence of sources against a plain version and the SQL."""

import random
import re

import duckdb
from pyspark.sql import functions as F

from chemlake.llm import divergence, oracles, queries
from chemlake.llm.workspace import Workspace


def plain(rows):
    """The result by its definition, term by term."""
    words = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for text, lang, source in rows]
    out = []
    for lang in {w[0] for w in words}:
        sources = sorted({w[1] for w in words if w[0] == lang})
        mine = [w for w in words if w[0] == lang]
        terms = sorted(t for t in {t for w in mine for t in w[2]} if sum(t in w[2] for w in mine) >= 10)
        n = {s: {t: sum(w[2].count(t) for w in mine if w[1] == s) for t in terms} for s in sources}
        n[None] = {t: sum(n[s][t] for s in sources) for t in terms}
        p = {s: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(terms)) for t in terms} for s, c in n.items()}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in terms), o) for o in sources if o != s]
            found = [(f(p[s][t], p[None][t]), t) for t in terms if n[s][t] and p[s][t] > p[None][t]]
            for part, values, most in (("pair", pairs, 10**9), ("term", found, 10)):
                ordered = sorted(values, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(ordered, 1) if k <= most]
    return sorted(out)


def corpus(seed, n):
    r = random.Random(seed)
    known = ["a", "B", "c", "É", "é", "日本", "x1y", "it's", "Zz", "\x00q", "[w]", *[f"t{chr(97 + i)}" for i in range(14)]]
    rows = [(" ".join(r.choice(known) for _ in range(r.randint(0, 12))), r.choice(["en", "fr", None]), r.choice(["s1", "s2", "s2", "é", None, ""])) for _ in range(n)]
    return [*rows, (None, "en", "only null"), ("", "de", "empty"), ("word", "de", "one"), ("\x7f1 2", None, "s3"), ("mega " * 20_000, "en", "s1")]


def test_equals_the_definition_and_the_sql(spark, tmp_path):
    rows = corpus(3, 300)
    table = [(i, *row, 0) for i, row in enumerate(rows)]
    spark.createDataFrame(table, "doc_id long, text string, lang string, source string, term int").write.parquet(f"{tmp_path}/documents.parquet")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    found = sorted(map(tuple, queries.op12_source_divergence(spark, str(tmp_path)).select(columns).collect()))
    assert found == plain(rows) and {x[2] for x in found} == {"pair", "term"}
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(db.sql(f"SELECT {', '.join(columns)} FROM ({oracles.OP12})").fetchall()) == found


def test_radix_selection_with_many_equal_values(spark):
    r = random.Random(4)
    rows = [(g, v, f"{p}{r.choice(['', 'é', 'b', 'bb' * 30])}{i}") for g in ("hot", "b") for i in range(900 if g == "hot" else 30) for v, p in [(r.choice([0, 7, 7, 7, 5000, 1 << 40]), r.choice(["", "same long beginning "]))]]
    rows += [("few", 3, "x"), ("few", 3, ""), ("nulls", None, "x"), ("nulls", 4, None)]
    table = spark.createDataFrame(rows, "g string, v long, item string")
    for k in (1, 10, 400):
        found = sorted(map(tuple, divergence.radix_top(table, ["g"], "v", "item", k, Workspace(spark)).collect()))
        want = []
        for g in {x[0] for x in rows}:
            mine = sorted((x for x in rows if x[0] == g and None not in x), key=lambda x: (-x[1], x[2].encode()))
            want += [(*x, i) for i, x in enumerate(mine[:k], 1)]
        assert found == sorted(want)
    equal = spark.range(3_000).select(F.lit("g").alias("g"), F.lit(9).cast("long").alias("v"), F.concat(F.lit("prefix"), F.col("id").cast("string")).alias("item"))
    assert [x.item for x in divergence.radix_top(equal, ["g"], "v", "item", 3, Workspace(spark)).orderBy("rank").collect()] == ["prefix0", "prefix1", "prefix10"]


def test_empty_table_and_one_source(spark):
    docs = spark.createDataFrame([("a " * 3, "en", "s", 1)] * 12, "text string, lang string, source string, value int")
    assert divergence.audit_sources(docs.limit(0)).collect() == []
    assert divergence.audit_sources(docs).collect() == []
