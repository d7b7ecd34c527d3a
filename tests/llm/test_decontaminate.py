"""Tiling against a plain version, and the operator's edge cases."""

import random
import re

from chemlake.llm import decontaminate


def plain_tiles(item, text, least):
    """Greedy string tiling word by word: lengths of the tiles."""
    used_i, used_t, out = set(), set(), []
    while True:
        best, where = least - 1, []
        for i in range(len(item)):
            for t in range(len(text)):
                k = 0
                while i + k < len(item) and t + k < len(text) and item[i + k] == text[t + k] and i + k not in used_i and t + k not in used_t:
                    k += 1
                if k > best:
                    best, where = k, []
                if k == best and k >= least:
                    where.append((t - i, i, t))
        if not where:
            return out
        for _, i, t in sorted(where):
            if not any(x in used_i for x in range(i, i + best)) and not any(x in used_t for x in range(t, t + best)):
                used_i |= set(range(i, i + best))
                used_t |= set(range(t, t + best))
                out.append(best)


def test_equals_plain_tiling(spark):
    r = random.Random(5)
    items = [(i, " ".join(r.choice("abcdefgh") + str(r.randint(0, 3)) for _ in range(r.randint(3, 40)))) for i in range(12)]
    docs = []
    for d in range(60):
        own = ["x%d" % r.randint(0, 99) for _ in range(r.randint(0, 40))]
        for _ in range(r.randint(0, 3)):
            item = r.choice(items)[1].split()
            a = r.randint(0, len(item) - 1)
            at = r.randint(0, len(own))
            own[at:at] = [w.upper() + r.choice(["", ",", "."]) for w in item[a : a + r.randint(3, 30)]]
        docs.append((d, " ".join(own)))
    found = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), coverage=0.3)
    got = {(x.doc_id, y.item_id): (y.n_words, y.n_matched) for x in found.collect() for y in x.leaks}
    want = {}
    for d, text in docs:
        own = re.findall(r"\w+", text.lower())
        for i, item in items:
            w = item.split()
            matched = sum(plain_tiles(w, own, 5))
            if len(w) >= 5 and matched >= 0.3 * len(w) and matched:
                want[d, i] = (len(w), matched)
    assert got == want and want


def test_reordered_passages_parts_and_edge_cases(spark):
    first, second = "one two three four five six seven", "red green blue cyan pink grey brown"
    items = spark.createDataFrame([(1, f"{first} {second}"), (2, "too short item"), (3, None), (None, first), (4, "")], "item_id long, text string")
    rows = [(1, f"{second}! And then: {first}", 0), (2, "nothing here at all to see", 0), (3, None, 0), (4, "", 0), (1, f"{first} {second}", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, leaks int")
    for part in (1 << 20, 8):
        found = decontaminate.find_leaks(docs, items, part_bytes=part).collect()
        assert [[(y.item_id, y.n_matched, y.n_tiles) for y in x.leaks] for x in found] == [[(1, 14, 2)], [], [], [], [(1, 14, 1)]]
    assert all(x.leaks == [] for x in decontaminate.find_leaks(docs, items.limit(0)).collect())
    assert decontaminate.find_leaks(docs.limit(0), items).collect() == []


def test_repeated_words_and_benchmarks_of_many_parts(spark):
    r = random.Random(9)
    items = [(i, " ".join(r.choice("ab") for _ in range(r.randint(5, 30)))) for i in range(40)] + [(100, " ".join(["same"] * 300)), (100, " ".join(["same"] * 300))]
    docs = [(d, " ".join(r.choice("ab") for _ in range(r.randint(0, 40)))) for d in range(12)] + [(50, " ".join(["same"] * 6_000)), (50, " ".join(["same"] * 6_000)), (51, "long " * 200_000 + "same " * 151), (52, None)]
    want = {}
    for d, text in docs[:12]:
        for i, item in items[:40]:
            w = item.split()
            matched = sum(plain_tiles(w, text.split(), 5))
            if matched and matched >= 0.5 * len(w):
                want[d, i] = matched
    want |= {(50, 100): 300, (51, 100): 151}
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for part in (1 << 20, 400):
        out = decontaminate.find_leaks(*frames, part_bytes=part).collect()
        assert len(out) == len(docs) and {(x.doc_id, y.item_id): y.n_matched for x in out for y in x.leaks} == want
