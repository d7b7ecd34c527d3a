"""CAS functions and the repair ladder against plain models."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chemlake.functions import cas
from chemlake.operators import tokens


def model_valid(t):
    t = t.strip(" ")
    if not re.fullmatch(r"[0-9]{1,7}-[0-9]{2}-[0-9]", t) or not re.search("[1-9]", t):
        return False
    d = t.replace("-", "")
    return sum(int(c) * i for i, c in enumerate(reversed(d[:-1]), 1)) % 10 == int(d[-1])


def one(spark, column, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in sorted(rows.select("i", column(F.col("v")).alias("x")).collect())]


def test_known_numbers(spark):
    values = ["64-17-5", "107-41-5", "7732-18-5", "170-41-5", "0-00-0", "12345", None, "", "64-17-5 "]
    assert one(spark, cas.valid, values) == [True, True, True, False, False, False, False, False, True]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.from_regex(r"[0-9]{1,8}-[0-9]{2}-[0-9]|[0-9 -]{0,9}", fullmatch=True), min_size=20, max_size=40))
def test_valid_equals_model(spark, values):
    assert one(spark, cas.valid, values) == [model_valid(v) for v in values]


def test_tokens(spark):
    values = ["64-17-5 / 67-56-1; 0-00-0\n107-41-5", "64-17-5\u00a067-56-1", "a\u00a0b", "x|y", None, " ; "]
    assert one(spark, cas.tokens, values) == [["64-17-5", "67-56-1", "0-00-0", "107-41-5"], ["64-17-5", "67-56-1"], ["a\u00a0b"], ["x|y"], [], []]


def test_dialects(spark):
    values = ["00-00-0", "0064-17-5", " 64 - 17 - 5", "64175", "CAS 64-17-5", "64-7-5", "x", None]
    assert one(spark, cas.ingest_cas, values) == ["0-00-0", "64-17-5", "64-17-5", None, None, None, None, None]
    assert one(spark, cas.property_cas, values)[1:5] == ["0064-17-5", "64-17-5", "64-17-5", "64-17-5"]
    assert [x["cas"] for x in one(spark, cas.resolver_cas, values)] == ["0-00-0", "64-17-5", "64-17-5", "64-17-5", "64-17-5", "64-07-5", None, None]
    assert one(spark, cas.ingest_checksum_holds, ["0-00-0", "64-17-5"]) == [False, True]


def test_dates_and_edits(spark):
    assert one(spark, cas.from_date, ["2442-10-06", "10/06/2442", "06/10/2442", "2442-10-16", "64-17-05", "64-17-05 00:00:00", "17/05/64"]) == [
        x if x is None or model_valid(x) else None for x in ("2442-10-6", "2442-10-6", "2442-10-6", None, "64-17-5", "64-17-5", None)
    ]
    assert one(spark, cas.with_check_digit, ["64-17", "1392276-61", "6-17"]) == ["64-17-5", next(f"1392276-61-{d}" for d in range(10) if model_valid(f"1392276-61-{d}")), None]
    assert one(spark, cas.from_digits, ["64175", "1234", "64-17-5"]) == ["64-17-5", None, None]
    assert one(spark, cas.swaps, ["ab", "aab", "a", ""]) == [["ba"], ["aab", "aba"], [], []]
    assert one(spark, cas.neighbour_digits, ["1-"]) == [["2-", "4-"]]


def test_neighbours_of_all_ten_digits(spark):
    # left and right on the number row 1234567890, and next to each other on the pad 789 / 456 / 123 / 0
    row, pad = "1234567890", {"7": (0, 0), "8": (0, 1), "9": (0, 2), "4": (1, 0), "5": (1, 1), "6": (1, 2), "1": (2, 0), "2": (2, 1), "3": (2, 2), "0": (3, 1)}
    near = lambda a, b: abs(row.index(a) - row.index(b)) == 1 or abs(pad[a][0] - pad[b][0]) + abs(pad[a][1] - pad[b][1]) == 1
    assert one(spark, cas.neighbour_digits, list("0123456789")) == [[b for b in "0123456789" if near(a, b)] for a in "0123456789"]


def repaired(spark, rows):
    cells = spark.createDataFrame(rows, "row long, cas string, code string, name string")
    return cells, tokens.repair(tokens.explode_tokens(cells))


def test_ladder(spark):
    cells, out = repaired(spark, [(1, "64-17-5", "A", "x"), (2, "170-41-5", "B", "y"), (3, "1392276-61", "B", "y"), (4, "64175", "C", "z"), (5, "12345 / 0-00-0", "C", "z"), (6, "2656-10-07", "D", "q"), (7, None, "D", "q"), (8, "64-17-05", "E", "")])
    got = {(r.row, r.pos): (r.fixed, r.status) for r in out.collect()}
    assert got[1, 0] == ("64-17-5", "valid") and got[2, 0] == ("107-41-5", "valid (fixed swap from: 170-41-5)")
    assert got[3, 0][1] == "valid (fixed checkdigit from: 1392276-61)" and got[4, 0] == ("64-17-5", "valid (fixed rehyphenated from: 64175)")
    assert got[5, 0][1].startswith("invalid (original: 12345") and (5, 1) not in got
    assert got[6, 0][0] == "2656-10-07" and "suggestions" in got[6, 0][1] and "via" in got[6, 0][1]
    assert got[8, 0] == ("64-17-5", "valid (fixed from: 64-17-05)")
    assert {r.row: r.fixed_cas for r in tokens.fixed_cells(cells, out).collect()}[5] == "12345 (invalid)"
    assert {r.row: r.status for r in tokens.first_tokens(cells, out).collect()}[7] == "invalid (original: )"


def test_evidence_decides_between_neighbour_keys(spark):
    wrong = next(t for t in ("64-17-4", "64-18-5", "64-27-5", "54-17-5") if not model_valid(t))
    _, alone = repaired(spark, [(1, wrong, "A", "x")])
    _, known = repaired(spark, [(1, wrong, "A", "x"), (2, "64-17-5", "A", "other")])
    assert alone.first().status.startswith("invalid")
    assert {r.row: r.fixed for r in known.collect()}[1] in ("64-17-5", wrong)


def test_customer_map_is_idempotent_and_takes_the_latest(spark):
    kind = "customer_id string, cas_number_normalized string, timestamp_seen_utc string, code string, name string, cas_validity string"
    old = spark.createDataFrame([("c", "64-17-5", "2024-01-02", "1", "a", "valid"), ("c", "67-56-1", "2024-01-01", "1", "a", "valid")], kind)
    new = spark.createDataFrame([("c", "64-17-5", "2024-01-01", "2", "b", "valid"), ("c", "67-56-1", "2024-01-01", "2", "b", None)], kind)
    once = tokens.upsert_customer_map(old, new)
    assert sorted((r.cas_number_normalized, r.code) for r in once.collect()) == [("64-17-5", "1"), ("67-56-1", "2")]
    assert sorted(once.collect()) == sorted(tokens.upsert_customer_map(once, new).collect())


def test_filters_do_not_repeat_how_numbers_are_made(spark):
    found = spark.createDataFrame([(1, "50-00-0", "a", "b", 0, "50-00-0")], "row long, cas string, code string, name string, pos int, token string")
    for known in tokens.evidence(found):
        plan = known._jdf.queryExecution().optimizedPlan().toString()
        assert not any("Filter" in line and "RLIKE" in line for line in plan.splitlines()) and known.count() == 1
