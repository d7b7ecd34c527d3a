"""Merges, properties, pages, sources and the stream."""

import json

import pytest
from pyspark.sql import functions as F

from chemlake.functions import mixtures, text, units
from chemlake.operators import canonical, governance, identifiers, ingest, molecules, properties, provider, registry, resolver
from chemlake.plans import inputs
from chemlake.sources import dumps, tables, xlsx
from chemlake.streaming import customer_stream

KEY, OTHER = "ABCDEFGHIJKLMN-OPQRSTUVWX-Y", "BBCDEFGHIJKLMN-OPQRSTUVWX-Y"
NOW = "2024-01-09"


def rows_of(spark, rows):
    kind = "_row long, cas_number_normalized string, inchi_key string, cas_status string, resolver_source string, resolver_confidence double, evidence string, resolution_timestamp_utc string"
    return spark.createDataFrame(rows, kind)


def test_registry_merge(spark):
    empty = rows_of(spark, []).drop("_row")
    first = rows_of(spark, [(1, "64-17-5", "K1", "valid", "a", 0.5, "e1", ""), (2, "64-17-5", "k1", "valid", "b", 0.9, "e2", "2024-02-01"), (3, "", "K2", "valid", "a", None, "", ""), (4, "67-56-1", "", "invalid", "a", None, "", ""), (5, "9-99-9", "", "mixture", "a", None, "", "")])
    out = registry.upsert(empty, first, NOW)
    got = {(r.cas_number_normalized, r.inchi_key): r for r in out.registry.collect()}
    assert set(got) == {("64-17-5", "K1"), ("9-99-9", "")}
    row = got["64-17-5", "K1"]
    assert (row.resolver_source, row.resolver_confidence, row.evidence, row.resolution_timestamp_utc) == ("b", 0.9, "e1 | e2", "2024-02-01")
    assert sorted(r.rejected_reason for r in out.rejected.collect()) == ["cas_status=invalid", "missing cas_number_normalized"]
    second = registry.upsert(out.registry, rows_of(spark, [(1, "64-17-5", "K2", "valid", "a", 0.1, "", "")]), NOW)
    assert {(r.inchi_key, r.cas_status) for r in second.registry.where("cas_number_normalized = '64-17-5'").collect()} == {("K1", "ambiguous"), ("K2", "ambiguous")}
    assert {r.event for r in second.audit.collect()} == {"insert_new_mapping", "cas_conflict_mark_ambiguous"}
    again = registry.upsert(second.registry, rows_of(spark, [(1, "64-17-5", "K2", "valid", "a", 0.1, "", "")]), NOW)
    assert sorted(again.registry.collect()) == sorted(second.registry.collect())


def test_adapters(spark):
    rows = [("1-11-1", "K", "valid", ""), ("90000-00-0", "", "valid", "natural product / UVCB"), ("3", "", "valid", "fragrance mixture"), ("4", "", "valid", "polymer / complex mixture")]
    out = registry.from_resolver(spark.createDataFrame(rows, "cas string, inchikey string, cas_validity string, mixture_type string"))
    assert [r.cas_status for r in out.collect()] == ["valid", "uvcb", "mixture", "mixture"]


def test_canonical_merge(spark):
    kind = "inchi_key string, inchi string, experimental_x int, alcohol_count int"
    old = spark.createDataFrame([(KEY, None, 5, 1), ("bad", None, 1, 1)], kind)
    new = spark.createDataFrame([(KEY, "InChI=1", 0, 9), (OTHER, None, None, 7)], kind)
    columns = ["inchi_key", "inchi", "experimental_x", "alcohol_count", "extra"]
    out = {r.inchi_key: tuple(r)[1:] for r in canonical.upsert(old, new, "properties", columns).collect()}
    assert out == {KEY: ("InChI=1", 0, 1, None), OTHER: (None, None, 7, None)}
    assert {r.inchi_key: r.alcohol_count for r in canonical.upsert(old, new, "features", columns).collect()}[KEY] == 9
    assert {r.inchi_key: r.experimental_x for r in canonical.upsert(old, new, "stranger", columns).collect()} == {KEY: 5, OTHER: None}


def test_duplicate_columns_and_names(spark):
    df = spark.createDataFrame([(KEY, None, 2), (OTHER, 1, 3)], "a string, b int, c int").toDF("inchi_key", "dup", "dup")
    assert sorted(map(tuple, canonical.collapse_duplicates(df).collect())) == sorted([(KEY, 2), (OTHER, 1)])
    assert canonical.unique_names([" a", "a", "", "b"]) == ["a", "b"]


def test_field_merge_keeps_time_where_nothing_changed(spark):
    kind = "inchi_key string, f string, timestamp_updated string"
    old = spark.createDataFrame([(KEY, "x", "t0"), (OTHER, "y", "t0")], kind)
    new = spark.createDataFrame([(KEY, " ", "t1"), (OTHER, "z", "t1")], kind)
    assert sorted(map(tuple, canonical.merge_fields(old, new).collect())) == sorted([(KEY, "x", "t0"), (OTHER, "z", "t1")])


def test_resolver(spark):
    known = spark.createDataFrame([("64-17-5", KEY, "", "CCO")], "cas string, inchi_key string, inchi string, smiles string")
    provider = spark.createDataFrame([("67-56-1", "CO", "", OTHER), ("64-17-5", "X", "", OTHER)], "cas string, smiles string, inchi string, inchi_key string")
    rows = spark.createDataFrame([(1, "n", "67-56-1 / 64-17-5"), (2, "n", "67-56-1"), (3, "rose oil", "x")], "row long, name string, cas string")
    out = {r.row: (r.source, r.inchi_key, r.alternates, r.mixture_type) for r in resolver.resolve(rows, known, [("pubchem", provider)]).collect()}
    assert out[1] == ("db2_cache", KEY, "67-56-1", "single substance") and out[2][:2] == ("pubchem", OTHER) and out[3] == ("unresolved", None, "", "unknown")


def test_mixtures(spark):
    rows = [("x", "90000-12-3", "C"), ("x", "80001-12-3", "C"), ("x", "61000-12-3", "C"), ("x", "71000-12-3", "C.C"), ("Phenol", "64-17-5", "C"), ("x", "64-17-5", "C")]
    df = spark.createDataFrame(rows, "n string, c string, s string")
    assert [r[0] for r in df.select(mixtures.mixture_class(F.col("n"), F.col("c"), F.col("s"))).collect()] == [mixtures.NATURAL, mixtures.FRAGRANCE, mixtures.POLYMER, mixtures.MANY, mixtures.NATURAL, mixtures.SINGLE]


def test_units(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(units.to_pascal(F.lit(2.0), F.lit("kPa")))["value"] == 2000.0 and "furlong" in one(units.to_pascal(F.lit(2.0), F.lit("furlong")))["warning"]
    assert one(units.to_celsius(F.lit(212.0), F.lit("°F")))["value"] == pytest.approx(100.0) and one(units.to_mg_l(F.lit(2.0), F.lit("mM"), F.lit(100.0)))["value"] == pytest.approx(200.0)
    split = units.split_units(spark.createDataFrame([(x,) for x in ("212 °F", "2", "1e3 kPa", "a 2", None, "1-2 g")], "t string"), "t")
    assert [(r.t_number, r.t_unit) for r in split.collect()] == [(212.0, "°F"), (2.0, None), (1000.0, "kPa"), (None, None), (None, None), (1.0, "-2 g")]
    assert one(units.power_notation(F.lit("1.1&times;10<sup>&#8722;6</sup>"))) == pytest.approx(1.1e-6) and one(units.quantity_mpa05(F.lit('Quantity[18.8, Sqrt["Megapascals"]]'))) == 18.8
    assert one(units.as_number(F.lit("1d"))) is None and one(units.safe_log10(F.lit(0))) is None and one(units.refractive_index(F.lit("1.4-1.6"))) == pytest.approx(1.5)
    assert one(units.temperature_in(F.lit("at 298.15 K"))) == pytest.approx(25.0) and one(units.strict_mg_l(F.lit("1-2"), F.lit("g/L")))["value"] is None


def test_incomplete_triplets_are_reviewed(spark):
    wide = spark.createDataFrame([(1, KEY, "1", None, "3"), (2, OTHER, "1", "2", "3")], "_row long, final_inchikey string, experimental_hsp_delta_d_mpa05 string, experimental_hsp_delta_p_mpa05 string, experimental_hsp_delta_h_mpa05 string")
    out = {r.inchi_key: (r.experimental_hsp_delta_d_mpa05, r.needs_review) for r in properties.canonical_rows(wide).collect()}
    assert out == {KEY: (None, True), OTHER: (1.0, False)}


def test_names_and_identifiers(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(text.resolver_name(F.lit(" Géraniol   ALPHA, "))) == "geraniol alpha" and one(text.property_name(F.lit("É β"))) == "e β"
    assert [one(text.identifier_type(F.lit(x))) for x in ("64-17-5", KEY, "InChI=1S/x", "C1CC1", "64175", "ethanol", "")] == ["cas", "inchikey", "inchi", "smiles", "smiles", "name", "name"]
    assert one(text.first_inchikey(F.lit("x"), F.lit(KEY.lower()))) == KEY


def test_pages(spark):
    html = "<title>Rose oil - x</title><b>Synonyms</b>: b, a , b<table><tr><th>CAS</th><th>Principal name</th><th>k</th></tr><tr><td>64-17-5</td><td>E &amp; F</td></tr></table>Page 1 of 7"
    page = spark.createDataFrame([("u", "t", html), ("v", "t", None)], "url string, retrieved_at string, html string")
    h = F.col("html")
    row = page.select(ingest.page_name(h), ingest.page_class(h), ingest.synonyms(h), ingest.last_page(h)).first()
    assert tuple(row) == ("Rose oil", "MATERIAL", ["a", "b"], 7)
    assert [(r.cas, r.cas_ok, r.principal_name, r.category) for r in ingest.listed_substances(page).collect()] == [("64-17-5", True, "E & F", "")]


def test_workbooks(spark, tmp_path):
    xlsx.register(spark)
    df = spark.createDataFrame([("a<", None), ("b", "é\n")], "x string, y string").coalesce(1)
    df.write.format("xlsx").mode("append").save(f"{tmp_path}/book")
    assert sorted(map(tuple, spark.read.format("xlsx").load(f"{tmp_path}/book").collect())) == [("a<", None), ("b", "é\n")]
    assert spark.read.format("xlsx").option("sheet", "no such").load(f"{tmp_path}/book").count() == 2


def test_runs_feeds_and_texts(spark, tmp_path):
    df = spark.createDataFrame([(KEY.lower(), "CCO"), (KEY, "C"), (OTHER, "")], "InChI_Key string, smiles string")
    tables.write_run(df, f"{tmp_path}/t", "1")
    tables.write_run(df.limit(1), f"{tmp_path}/t", "2")
    assert tables.read_run(spark, f"{tmp_path}/t").count() == 1 and tables.read_run(spark, f"{tmp_path}/t", "1").count() == 3
    assert [tuple(r) for r in tables.feed(df, {"inchi_key": ["inchi_key"], "smiles": ["smiles"]}, "inchi_key").collect()] == [(KEY, "C")]
    (tmp_path / "a.csv").write_text("x,y\n1,\nNA,b\n")
    assert sorted(map(tuple, tables.read_texts(spark, f"{tmp_path}/a.csv", ["x", "y"]).collect())) == [("1", ""), ("NA", "b")]
    with pytest.raises(KeyError):
        tables.pick_column(df, ["nothing"])
    with pytest.raises(ValueError, match="missing"):
        tables.clean_header(df, ["CAS"])


def test_stream_equals_batch(spark, tmp_path):
    kind = "customer_id string, cas_number_normalized string, timestamp_seen_utc string, code string, name string, cas_validity string"
    rows = [("c%d" % (i % 3), "%d" % (i % 5), "2024-01-%02d" % (i * 7 % 28 + 1), str(i), "n", "valid") for i in range(40)]
    for part in (0, 1):
        spark.createDataFrame(rows[part::2], kind).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    customer_stream.keep_customer_map(stream, f"{tmp_path}/map", f"{tmp_path}/check").awaitTermination()
    best = {}
    for r in rows:
        best[r[:2]] = max(best.get(r[:2], ""), r[2])
    assert {(r.customer_id, r.cas_number_normalized): r.timestamp_seen_utc for r in tables.read_run(spark, f"{tmp_path}/map").collect()} == best


def test_a_new_checkpoint_goes_on_from_the_map(spark, tmp_path):
    kind = "customer_id string, cas_number_normalized string, timestamp_seen_utc string, code string, name string, cas_validity string"
    for k in range(3):
        spark.createDataFrame([("c", str(k), "2024-01-01", "x", "n", "valid")], kind).write.parquet(f"{tmp_path}/in{k}")
        stream = spark.readStream.schema(kind).parquet(f"{tmp_path}/in{k}")
        customer_stream.keep_customer_map(stream, f"{tmp_path}/map", f"{tmp_path}/check{k}", kept_runs=2).awaitTermination()
    assert sorted(r.cas_number_normalized for r in tables.read_run(spark, f"{tmp_path}/map").collect()) == ["0", "1", "2"]
    assert len(tables.run_names(spark, f"{tmp_path}/map")) == 2 and tables.run_names(spark, f"{tmp_path}/none") == []


def test_workbooks_are_replaced_when_the_new_ones_are_whole(spark, tmp_path, monkeypatch):
    xlsx.register(spark)
    folder = f"{tmp_path}/book"
    spark.createDataFrame([("1",), ("2",)], "a string").coalesce(1).write.format("xlsx").mode("append").save(folder)
    bad = spark.createDataFrame([("3",)], "a string").selectExpr("raise_error('no') AS a")
    with pytest.raises(Exception, match="no"):
        bad.write.format("xlsx").mode("overwrite").save(folder)
    read = lambda: sorted(r.a for r in spark.read.format("xlsx").load(folder).collect())
    assert read() == ["1", "2"]
    spark.createDataFrame([("4",)], "a string").coalesce(1).write.format("xlsx").mode("overwrite").save(folder)
    assert read() == ["4"]
    monkeypatch.setattr(xlsx, "MOST_ROWS", 2)
    with pytest.raises(ValueError):
        xlsx.write_rows(f"{folder}/x.xlsx", "s", ["a"], [("1",), ("2",)])


def test_provider_answers(spark):
    answer = '{"Record":{"Section":[{"Information":[{"Name":"Density","Value":{"Number":[0.9,1],"Unit":"g/mL"}}],"Section":[{"Section":[{"Information":[{"Name":"Melting Point","Value":{"StringWithMarkup":[{"String":"77 F"}]}}]}]}]}]}}'
    rows = spark.createDataFrame([(1, answer), (2, "no json"), (3, None), (4, '{"Record":{}}')], "i int, answer string")
    out = {r.i: r for r in provider.properties(rows).collect()}
    assert out[1].experimental_density_g_ml == 0.9 and out[1].experimental_melting_point_c == pytest.approx(25.0) and out[1].source_logp is None and out[1].warnings == ""
    assert all(out[i].warnings == "no usable entries in the answer" and out[i].experimental_density_g_ml is None for i in (2, 3, 4))


def test_statements_span_lines(spark, tmp_path):
    (tmp_path / "dump.sql").write_text("CREATE TABLE t (a SERIAL)\nCASCADE;\nINSERT INTO t VALUES\n(1, 'a;b'),\n(2, NULL);\n")
    rows = dumps.insert_rows(dumps.read_statements(spark, f"{tmp_path}/dump.sql"), "t", ["a", "b"])
    assert sorted((r.a, r.b) for r in rows.collect()) == [("1", "a;b"), ("2", None)]


def test_provider_answers_of_any_depth_and_shape(spark):
    """Thirty levels, each with an entry of its own before those below it; lists; the second shape; what is no answer."""
    number = lambda name, value, unit=None: {"Name": name, "Value": {"Number": value} | ({"Unit": unit} if unit else {})}
    deep = {"Information": [number("Deepest", 30)]}
    for k in range(29, 0, -1):
        deep = {"Section": [deep, {"Information": [number(f"After {k}", k)]}, {"odd": 1}, "text"], "Information": [number(f"Level {k}", k)]}
    entries = [number("List", [None, "x", True, 2.5, 3]), {"Name": "Text", "Value": {"String": "as is"}}, {"Name": "Marked", "Value": {"StringWithMarkup": [{"String": "m"}, {"String": "n"}]}}, {"Name": "Odd", "Value": 7}, "entry", {"Value": {"Number": 4}}]
    answers = [
        (1, json.dumps({"Record": {"Section": [deep]}})),
        (2, json.dumps({"Record": {"Section": [{"Information": entries}]}})),
        (3, json.dumps({"PC_Compounds": [{"Section": [{"Section": [{"Information": [number("Flash Point", 9, "C")]}]}]}, {"Section": [{"Information": [number("Other", 1)]}]}]})),
        (4, json.dumps({"Record": {"Section": []}, "PC_Compounds": [{"Section": [{"Information": [number("Used", 1)]}]}]})),
        (5, '{"Record": {"Section": [{"Information": '), (6, None), (7, "[]"), (8, '"Section"'), (9, '{"Record": {"Section": {"Information": []}}}'),
    ]
    rows = {r.i: [(e.name, e.value, e.unit) for e in r.found] for r in provider.information(spark.createDataFrame(answers, "i int, answer string"), "answer", "found").collect()}
    assert [n for n, _, _ in rows[1]] == [f"level {k}" for k in range(1, 30)] + ["deepest"] + [f"after {k}" for k in range(29, 0, -1)]
    assert rows[2] == [("list", "2.5", None), ("text", "as is", None), ("marked", "m", None), (None, "4.0", None)]
    assert rows[3] == [("flash point", "9.0", "C")] and rows[4] == [("used", "1.0", None)]
    assert all(rows[i] == [] for i in range(5, 10))
    out = provider.properties(spark.createDataFrame(answers, "i int, answer string")).where("i = 3").first()
    assert (out.experimental_flash_point_c, out.source_flash_point_c) == (9.0, "pubchem")


def test_a_name_with_most_rows_is_ranked_in_parts(spark):
    """Ranks and the upper median of a name that holds nearly all rows, against sorting."""
    rows = [("hot" if i % 10 else f"n{i % 7}", "ethanol" if i % 3 else "x", None if i % 41 == 0 else i * 7 % 5_000, ["", "C" * (i % 9 + 1), "C.C", None][i % 4], None, ["Ethanol"] if i % 2 else []) for i in range(3_000)]
    table = spark.createDataFrame(rows, "name string, normal string, cid long, smiles string, inchi_key string, synonyms array<string>")
    out = resolver.rank_names(table).collect()
    for name in {r.name for r in out}:
        mine = sorted((r for r in out if r.name == name and r.cid is not None), key=lambda r: (-r.score, r.cid))
        assert [r.score for r in sorted(mine, key=lambda r: r["rank"])] == [r.score for r in mine]
        assert sorted(r["rank"] for r in out if r.name == name) == list(range(1, sum(r.name == name for r in out) + 1))
        sizes = sorted(len(s.replace(".", "")) for n, _, _, s, _, _ in rows if n == name and s)
        assert {r.median for r in out if r.name == name} == {sizes[len(sizes) // 2]}
    plan = resolver.rank_names(table)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan


def test_groups_are_filled_from_the_latest_row_on(spark):
    rows = [(1, "K", None, "b", "2024-01-01"), (2, "K", 2.0, "c", "2024-02-01"), (3, "K", 3.0, None, "2024-02-01"), (4, "K", None, None, "no time"), (5, "K", 9.0, "z", None), (6, None, 1.0, None, None), (7, "L", None, None, None)]
    df = spark.createDataFrame(rows, "_row long, inchi_key string, mw double, name string, timestamp_updated string")
    out = {r.inchi_key: tuple(r)[1:] for r in canonical.merge_groups(df).collect()}
    assert out == {"K": (2.0, "c", "2024-02-01"), None: (1.0, None, None), "L": (None, None, None)}
    assert canonical.merge_groups(df.drop("timestamp_updated")).where("inchi_key = 'K'").first().mw == 2.0
    assert canonical.merge_groups(df.limit(0)).collect() == []


def test_versions_sort_as_numbers(spark):
    rows = spark.createDataFrame([(t,) for t in ("1.2.10", "1.2.9", " 1.10.0 ", "v1.0.0", "1.0", None, "", "1.2.3.4", "99999999999.1.1")], "t string")
    got = {r.t: tuple(r.v) if r.v else None for r in rows.withColumn("v", tables.version_order(F.col("t"))).collect()}
    assert got == {"1.2.10": (1, 2, 10), "1.2.9": (1, 2, 9), " 1.10.0 ": (1, 10, 0), **dict.fromkeys(("v1.0.0", "1.0", None, "", "1.2.3.4", "99999999999.1.1"))}


def test_kinds_of_columns_are_told_by_all_rows(spark):
    """The first hundred values of a column look like something else than the thousand after them."""
    rows = spark.range(1_100).selectExpr("IF(id < 100, 'some words here', '64-17-5') AS a", "IF(id < 100, '64-17-5', 'some words here') AS b")
    found = identifiers.candidate_columns(rows.coalesce(1))
    assert found["cas"] == ["a"] and "b" not in found["cas"]


def test_rejected_structures(spark):
    rows = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "CCO", "x"), (4, "C(", "x"), (4, "C(", "x"), (5, " \t", "x")], "i int, smiles string, _other string")
    assert sorted((r.i, r.reason, r._other) for r in molecules.rejected(rows).collect()) == [(1, "empty", "x"), (2, "empty", "x"), (4, "invalid", "x"), (4, "invalid", "x"), (5, "empty", "x")]


def test_heavy_rows_of_one_file_are_dealt_to_all_cores(spark, tmp_path):
    spark.range(1_000).selectExpr("id AS p_partkey").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    dealt = inputs.derive(spark, str(tmp_path), "SELECT p_partkey FROM {part}", heavy=True)
    tasks = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 4 and sum(r["count"] for r in tasks) == 1_000


def test_a_key_is_made_once_before_it_is_filtered(spark):
    rows = spark.range(10).selectExpr("id AS _row", "upper(md5(CAST(id AS STRING))) AS computed_inchikey", "'C' AS smiles")
    for made in governance.sanitize(rows, ["inchi_key", "smiles"], NOW):
        assert made._jdf.queryExecution().optimizedPlan().toString().count("md5") == 1
