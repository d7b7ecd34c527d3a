"""Base spans against Python's patterns, added ones against a plain version of the method."""

import random
import re
import time
from math import exp, log, prod

from pyspark.sql import functions as F

from chemlake.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else 0, "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_equal_plain_patterns(spark):
    r = random.Random(8)
    bits = ["a", "b.c", "@", ".", "-", "1", "25", "255", "256", "+1", "(974)", " ", "555-3436", "é", "😀", "_", "4111111111111111", "4111 1111-1111 1111", "1.2.3.4", "x@y.z", "\n", "%", "00012"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 40))) for _ in range(1500)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    model = pii.Model({}, {})
    found = pii.find_personal_data(docs, model).collect()
    assert [[(s.kind, s.begin, s.end) for s in x.personal if s.base] for x in sorted(found)] == [plain_spans(t) for t in texts]


def test_long_texts(spark):
    texts = ["a" * 300_000, "1" * 300_000, "a@b" + ".c" * 100_000, "1.2.3.4 " * 3_000, "+1" * 50_000, "+1" + " 2" * 100_000, "1 " * 100_000]
    found = pii.find_personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), pii.Model({}, {})).collect()
    assert [len([s for s in x.personal if s.base]) for x in sorted(found)] == [0, 0, 1, 3000, 0, 0, 0]


def test_expectation_maximisation_finds_reliabilities():
    r = random.Random(1)
    real, counts = [(0.95, 0.05), (0.9, 0.3), (0.7, 0.1), (0.6, 0.4), (0.8, 0.5)], {}
    for _ in range(20_000):
        true = r.random() < 0.3
        v = tuple(int(r.random() < rate[0 if true else 1]) for rate in real)
        counts[v] = counts.get(v, 0) + 1
    prior, rates = pii.expectation_maximisation(list(counts.items()))
    assert abs(prior - 0.3) < 0.05 and all(abs(a - c) < 0.08 and abs(b - d) < 0.08 for (a, b), (c, d) in zip(rates, real, strict=True))


def test_added_spans_masking_and_edge_cases(spark):
    rows = [(i, f'words token = "{i:040x}" end', 1) for i in range(30)] + [(100, "mail x@y.org, card 4111 1111 1111 1111", 1), (101, None, 1), (102, "", 1), (102, "", 1), (103, "é+49 (30) 1234-5678é", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, personal int")
    out = {x.doc_id: x.personal for x in pii.find_personal_data(docs).collect()}
    assert all([(s.kind, s.base) for s in out[i]] == [("secret", False)] for i in range(30))
    assert [s.kind for s in out[100]] == ["email", "card"] and out[101] == out[102] == []
    texts = {x.doc_id: x.text for x in pii.mask_personal_data(docs).collect()}
    assert texts[100] == "mail [EMAIL], card [CARD]" and texts[101] is None and texts[103] == "é[PHONE]é" and "[SECRET]" in texts[3]
    assert pii.find_personal_data(docs.limit(0)).collect() == [] and pii.mask_personal_data(docs).columns == docs.columns


def test_masking_of_overlaps(spark):
    spans = F.expr("array(named_struct('kind','a','begin',4,'end',6), named_struct('kind','b','begin',1,'end',3), named_struct('kind','c','begin',2,'end',4), named_struct('kind','d','begin',1,'end',2))")
    assert spark.range(1).select(pii.masked(F.lit("0123456789"), spans)).first()[0] == "0[B][A]6789"


def test_long_secrets_are_masked_whole(spark):
    token = "eyJ" + "aB3.-_" * 170
    docs = spark.createDataFrame([(i, f"say token = {token[i:]} end") for i in range(30)], "doc_id long, text string")
    found = sorted(pii.find_personal_data(docs).collect())
    assert [[(s.kind, s.begin, s.end) for s in x.personal] for x in found] == [[("secret", 4, len(x.text) - 4)] for x in found] and len(token) > 1000
    assert {x.text for x in pii.mask_personal_data(docs).collect()} == {"say [SECRET] end"}


def made_text(r):
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    hexa = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    kinds = [
        lambda: f"mail {digits(2)}a@host{digits(1)}.example.com", lambda: f"write to joe{digits(1)} at example dot org", lambda: f"joe{digits(1)}@host", lambda: f"git{digits(1)}@box now",
        lambda: ".".join(str(r.randint(0, 255)) for _ in range(4)), lambda: ".".join(str(r.randint(0, 999)) for _ in range(4)), lambda: f"version {digits(1)}.{digits(1)}.{digits(1)}",
        lambda: f"card {digits(16)}", lambda: digits(15), lambda: f"+1 ({digits(3)}) 555-{digits(4)}", lambda: f"call {digits(3)} 555-{digits(4)}", lambda: f"{digits(3)}.{digits(3)}.{digits(4)} {digits(3)}",
        lambda: f"ssn {digits(3)}-{digits(2)}-{digits(4)}", lambda: f"{digits(3)} {digits(2)} {digits(4)} {digits(2)}", lambda: f"token = {hexa(40)}", lambda: f"commit {hexa(40)}", lambda: "password: " + "x" * 14, lambda: "a" * 33,
    ]
    words = lambda: " ".join(r.choice(["and", "so", "it", "goes", "é"]) for _ in range(r.randint(2, 6)))
    return "".join(f"{words()} {r.choice(kinds)()} " for _ in range(r.randint(0, 4))) + words()


def plain_decisions(spans):
    """For each candidate of one kind (votes, looks): whether the classifier takes it; the method span by span, without counts."""
    n, prior, rates = len(spans), 0.5, [(0.8, 0.2)] * 5

    def chance(v):
        yes, no = (prior * prod(h if x else 1 - h for x, (h, _) in zip(v, rates, strict=True)), (1 - prior) * prod(f if x else 1 - f for x, (_, f) in zip(v, rates, strict=True)))
        return yes / (yes + no)

    for _ in range(50):
        p = [chance(v) for v, _ in spans]
        prior, rates = (sum(p) + 2) / (n + 4), [
            ((sum(q for q, (v, _) in zip(p, spans, strict=True) if v[i]) + 8) / (sum(p) + 10), (sum(1 - q for q, (v, _) in zip(p, spans, strict=True) if v[i]) + 2) / (n - sum(p) + 10)) for i in range(5)
        ]
    p = [min(max(chance(v), 1 / (1 + exp(30))), 1 / (1 + exp(-30))) for v, _ in spans]
    true, false = sum(p), n - sum(p)

    def score(looks):
        out = log((true + 1) / (false + 1))
        for look in looks:
            held = [q for q, (_, own) in zip(p, spans, strict=True) if look in own]
            out += log((sum(held) + 0.5) / (true + 4)) - log((len(held) - sum(held) + 0.5) / (false + 4))
        return out

    return [score(looks) > 0 for _, looks in spans]


def test_added_spans_equal_a_plain_version(spark):
    r = random.Random(21)
    docs = spark.createDataFrame([(i, made_text(r)) for i in range(400)], "doc_id long, text string")
    by_kind = {}
    for x in docs.select("doc_id", pii.candidates(F.col("text")).alias("c")).collect():
        for c in x.c:
            by_kind.setdefault(c.kind, []).append((x.doc_id, c.begin, c.end, c.base, tuple(map(int, c.votes)), tuple(c.looks)))
    base = {(i, a, b) for spans in by_kind.values() for i, a, b, is_base, _, _ in spans if is_base}
    want = set()
    for kind, spans in by_kind.items():
        for (i, a, b, is_base, votes, _), taken in zip(spans, plain_decisions([(v, looks) for *_, v, looks in spans]), strict=True):
            if is_base or (taken and (votes[1] or kind not in pii.DIGITS) and not any(i == j and x < b and a < y for j, x, y in base)):
                want.add((i, kind, a, b, is_base))
    found = {(x.doc_id, s.kind, s.begin, s.end, s.base) for x in pii.find_personal_data(docs).collect() for s in x.personal}
    assert found == want
    added = [x for x in found if not x[4]]
    assert {k for _, k, *_ in added} >= {"email", "phone", "secret", "ssn"} and all(len({v for *_, v, _ in spans}) > 1 for spans in by_kind.values())


def test_repeated_rows_empty_tables_and_carried_columns(spark):
    docs = spark.createDataFrame([(1, "a x@y.org", 5), (1, "a x@y.org", 5), (2, None, 6)], "doc_id long, text string, votes int")
    out = pii.find_personal_data(docs, carry=["doc_id"])
    assert out.columns == ["doc_id", "personal"] and sorted(len(x.personal) for x in out.collect()) == [0, 1, 1]
    assert pii.find_personal_data(docs.limit(0), carry=["doc_id"]).collect() == []


def test_many_spans_in_one_text_take_time_in_proportion(spark):
    """A contact list of 21,000 addresses, numbers and secrets: found, told apart and masked in seconds, all of them."""
    took = {}
    for n in (700, 7_000):
        text = "\n".join(f"név {i}: user{i}@site{i % 97}.example.org, +49 30 {1_000_000 + i}, token= Ab1{i:09d}Zz9" for i in range(n))
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        began = time.time()
        out = pii.mask_personal_data(docs).first().text
        took[n] = time.time() - began
        assert out == "\n".join(f"név {i}: [EMAIL], [PHONE], [SECRET]" for i in range(n))
    assert took[7_000] < 40, took
