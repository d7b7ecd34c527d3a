"""Identifiers, dumps, discovery windows, and a customer's run from end to end."""

from pyspark.sql import functions as F

from chemlake.operators import identifiers, ingest
from chemlake.plans import customer_run
from chemlake.sources import dumps

KEY = "ABCDEFGHIJKLMN-OPQRSTUVWX-Y"


def test_identifiers(spark):
    df = spark.createDataFrame([("64-17-5", KEY, "ethanol", "C1CC1"), (None, "", "x y", "C=C"), ("nan", "bad", None, None)], "CAS string, k string, Name string, what string")
    columns = identifiers.candidate_columns(df)
    assert columns["cas"] == ["CAS"] and columns["name"] == ["Name"] and columns["smiles"] == ["what"]
    out = [(r.identifier, r.identifier_type) for r in identifiers.best_identifier(df, columns).collect()]
    assert out == [("C1CC1", "smiles"), ("C=C", "smiles"), (None, None)]
    assert [r.identifier_type for r in identifiers.best_identifier(df, {"cas": ["CAS"], "name": ["Name"]}).collect()] == ["cas", "name", None]
    assert identifiers.ordered_columns(["b", "a"], ["source_x", "computed_z", "experimental_y", "q", "a"]) == ["b", "a", "experimental_y", "computed_z", "source_x", "q"]


def test_once_per_identifier(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "id string, x int")
    out = identifiers.once_per_identifier(df, ["id"], lambda keys: keys.withColumn("found", F.upper("id")))
    assert sorted((r.x, r.found) for r in out.collect()) == [(1, "A"), (2, "A"), (3, None)]


def test_dump(spark):
    lines = ["CREATE TABLE x (id SERIAL);", "INSERT INTO henry (id, h, s) VALUES (1, '1.1&times;10<sup>&#8722;6</sup>', 7), (2, 'it''s (odd), yes', NULL);", "DROP TABLE henry CASCADE;", "insert into public.henry values (3,'',9);", "INSERT INTO henry_notes VALUES (1, 2, 3);"]
    out = dumps.insert_rows(spark.createDataFrame([(x,) for x in lines], "value string"), "henry", ["id", "h", "s"])
    assert sorted(map(tuple, out.collect()), key=str) == [("1", "1.1&times;10<sup>&#8722;6</sup>", "7"), ("2", "it's (odd), yes", None), ("3", "", "9")]
    assert dumps.table_with_key({"a": spark.range(1), "b": spark.createDataFrame([(1, 2)], "InChI_Key int, Hominus int")}) == ("b", "InChI_Key", "Hominus")


def test_discovery_stops_after_empty_windows(spark):
    pages = spark.createDataFrame([(i, 200, f"<title>T</title> 64-17-5 {i}" if i in (3, 40) else "<title>T</title>") for i in range(60)], "page_id int, status int, html string")
    none = spark.createDataFrame([], "cas string")
    found, at = ingest.discover_until_empty(pages, none, 0, 5)
    assert at == 15 and [r.page_id for r in found.where("route = 'candidate'").collect()] == [3]


def test_missing_requests(spark):
    r = spark.createDataFrame([("get", "u", {"a": "1", "b": "2"}), ("GET", "u", {"b": "2", "a": "1"}), ("get", "v", {})], "method string, url string, params map<string,string>")
    first = ingest.missing_requests(r, spark.createDataFrame([], "cache_key string"))
    assert sorted(x.url for x in first.collect()) == ["u", "v"]
    assert [x.url for x in ingest.missing_requests(r, first.where("url = 'u'")).collect()] == ["v"]


def test_customer_run(spark, tmp_path):
    cells = spark.createDataFrame([(1, "64-17-5 / 170-41-5", "A", "Ethanol"), (2, "67-56-1", "B", "Methanol"), (3, "junk", "C", "?")], "row long, cas string, code string, name string")
    provider = spark.createDataFrame([("64-17-5", "CCO", "", KEY), ("67-56-1", "CO", "", "M" + KEY[1:])], "cas string, smiles string, inchi string, inchi_key string")
    registry = spark.createDataFrame([], ", ".join(f"{c} string" for c in ("cas_input", "cas_number_normalized", "cas_status", "inchi_key", "inchi", "smiles")))
    mapped = spark.createDataFrame([], "customer_id string, timestamp_seen_utc string, code string, name string, cas_number_normalized string, cas_validity string")
    table = spark.createDataFrame([], "inchi_key string, smiles string")
    out = customer_run.run(cells, "c1", "2024-01-01", registry, mapped, table, f"{tmp_path}/run", [("pubchem", provider)])
    assert {(r.cas_number_normalized, r.cas_status) for r in out.registry.registry.collect()} == {("64-17-5", "valid"), ("67-56-1", "valid")}
    view = {r.cas_number_normalized: r for r in out.view.collect()}
    assert view["64-17-5"].TotalAlcoholCount == 1 and view["64-17-5"].customer_id == "c1" and view["67-56-1"].code == "B"
    assert {r.cas for r in out.exploded.where("cas_validity LIKE '%swap%'").collect()} == {"107-41-5"}
