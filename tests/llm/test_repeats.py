"""Repeated units against brute force."""

import random
import re

import pytest

from chemlake.llm import queries, repeats


def brute_force(docs, split=r"\n", least=1):
    """(doc_id, begin, end, keep_doc_id, keep_begin) of each unit that one before it equals."""
    seen, want = {}, set()
    for i, text in sorted(d for d in docs if d[1]):
        cuts = [0, *[m.start() for m in re.finditer(split, text)], len(text)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            part = text[a:b]
            key = tuple(part.lower().split())
            begin = a + len(part) - len(part.lstrip())
            if key and len(key) >= least and seen.setdefault(key, (i, begin)) != (i, begin):
                want.add((i, begin, a + len(part.rstrip()), *seen[key]))
    return want


@pytest.mark.parametrize(("unit", "split", "least"), [("line", r"\n", 1), ("line", r"\n", 4), ("sentence", r"(?<=[.!?])(?=\s)|\n", 1), ("paragraph", r"\n\s*\n", 2)])
def test_equals_brute_force(spark, unit, split, least):
    r = random.Random(3)
    known = [" ".join(r.choice("abcdef") * r.randint(1, 3) for _ in range(r.randint(1, 9))) + r.choice(".!?") for _ in range(25)]
    docs = [(i, "".join(r.choice(known).swapcase() + r.choice([" ", "\n", "\n\n", "  "]) for _ in range(r.randint(0, 12)))) for i in range(40)]
    found = {(x.doc_id, x.begin, x.end, x.keep_doc_id, x.keep_begin) for x in repeats.repeated_units(spark.createDataFrame(docs, "doc_id long, text string"), unit=unit, least_words=least).collect()}
    want = brute_force(docs, split, least)
    assert found == want and want


def test_the_query_takes_every_line_of_any_length(spark, tmp_path):
    r = random.Random(4)
    lines = ["a", "É b", "é  B ", " x y", "x y", "", "  ", "one two three", *[" ".join(f"w{k}x{i}" for i in range(60)) for k in range(3)]]
    docs = [(i, "\n".join(r.choice(lines) for _ in range(r.randint(0, 6)))) for i in range(60)] + [(60, None), (61, ""), (62, "long " * 200_000 + "\na")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {(x.doc_id, x.begin, x.end, x.keep_doc_id, x.keep_begin) for x in queries.op4_repeats(spark, str(tmp_path)).collect()}
    assert found == brute_force(docs) and (62, 1_000_001, 1_000_002) in {x[:3] for x in found}


def test_common_lines_equal_brute_force(spark):
    docs = [(i, f"very common line\nnumber {i // 2}\nvery  COMMON line") for i in range(1_500)]
    found = {(x.doc_id, x.begin, x.end, x.keep_doc_id, x.keep_begin) for x in repeats.repeated_units(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert found == brute_force(docs) and len(found) == 2 * 1_500 - 1 + 750


def test_cut_and_edge_cases(spark):
    line = "a line of eight words that will repeat"
    rows = [(1, f"{line}\nown words", 0), (2, f"Start here\n{line.upper()}\n{line} end", 0), (3, None, 0), (4, "", 0), (None, line, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_spans int")
    got = {x.doc_id: (x.text, [tuple(s) for s in x.kept_spans or []]) for x in repeats.without_repeats(docs).collect()}
    n = len(line)
    assert got == {1: (rows[0][1], [(0, len(rows[0][1]))]), 2: (f"Start here\n\n{line} end", [(0, 11), (11 + n, 16 + 2 * n)]), 3: (None, []), 4: ("", []), None: (line, [(0, n)])}
    assert {(x.doc_id, x.keep_doc_id) for x in repeats.repeated_units(docs).collect()} == {(2, 1), (None, 1)}
    assert repeats.repeated_units(docs.limit(0)).collect() == []


def test_rows_that_share_an_id_are_one_document(spark):
    docs = spark.createDataFrame([(1, "x y\nx y", 1), (1, "x y\nz", 2), (1, "x y\nz", 2), (2, "z", 3)], "doc_id long, text string, begin int")
    assert sorted(tuple(x)[:2] + (x.keep_doc_id,) for x in repeats.repeated_units(docs).collect()) == [(1, 4, 1), (2, 0, 1)]
