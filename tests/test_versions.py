"""Versions of several tables, the growing customer map, databases."""

import os
import random

import pytest
from pyspark.sql import functions as F

from chemlake.operators import governance
from chemlake.sources import databases, versions, xlsx
from chemlake.streaming import customer_stream

SEEN = "customer_id string, cas_number_normalized string, timestamp_seen_utc string, code string, name string, cas_validity string"


def shown(tables):
    return {n: sorted(tuple(r) for r in df.collect()) for n, df in tables.items()}


def test_all_tables_or_none(spark, tmp_path):
    path = f"{tmp_path}/db"
    assert versions.tables(spark, path) == {} and versions.versions(spark, path) == []
    one, two = spark.createDataFrame([(1, "a")], "i int, t string"), spark.createDataFrame([("x",)], "e string")
    assert versions.write(spark, path, {"registry": one, "audit": two}) == 1
    # the second of two tables fails: readers go on with the first version of both
    broken = two.selectExpr("raise_error('no') AS e")
    with pytest.raises(Exception, match="no"):
        versions.write(spark, path, {"registry": one.selectExpr("i + 1 AS i", "t"), "audit": broken})
    assert shown(versions.tables(spark, path)) == {"registry": [(1, "a")], "audit": [("x",)]} and versions.versions(spark, path) == [1]

    def refuse(written):
        raise ValueError(f"{written['registry'].count()} rows")

    with pytest.raises(ValueError, match="1 rows"):
        versions.write(spark, path, {"registry": one}, check=refuse)
    assert versions.write(spark, path, {"registry": one.selectExpr("i + 1 AS i", "t")}) == 2
    assert shown(versions.tables(spark, path)) == {"registry": [(2, "a")], "audit": [("x",)]}
    assert shown(versions.tables(spark, path, 1))["registry"] == [(1, "a")]
    with pytest.raises(KeyError):
        versions.tables(spark, path, 9)


def test_of_two_writers_one_starts_anew(spark, tmp_path):
    path = f"{tmp_path}/db"
    df = spark.createDataFrame([(1,)], "i int")

    def overtaken(written):
        versions.write(spark, path, {"a": df.selectExpr("i * 10 AS i")})

    with pytest.raises(versions.Conflict):
        versions.write(spark, path, {"a": df}, check=overtaken)
    assert shown(versions.tables(spark, path)) == {"a": [(10,)]}
    assert versions.write(spark, path, {"b": df}) == 2
    versions.forget(spark, path, 1)
    assert versions.versions(spark, path) == [2] and shown(versions.tables(spark, path)) == {"a": [(10,)], "b": [(1,)]}
    assert len(os.listdir(f"{path}/data")) == 2


def bytes_at(path):
    return sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_the_map_grows_by_what_a_batch_holds(spark, tmp_path):
    r, path = random.Random(2), f"{tmp_path}/map"
    best, sizes = {}, []
    for batch in range(9):
        n = 3_000 if batch == 0 else 5
        rows = [(f"c{r.randrange(3)}", str(r.randrange(2_000)), f"2024-01-{r.randrange(1, 29):02d}", f"k{batch}", "n", "valid") for _ in range(n)]
        for row in rows:
            if row[2] >= best.get(row[:2], ("", ""))[0]:
                best[row[:2]] = (row[2], row[3]) if row[2] > best.get(row[:2], ("", ""))[0] or row[3] >= best[row[:2]][1] else best[row[:2]]
        spark.createDataFrame(rows, SEEN).coalesce(1).write.parquet(f"{tmp_path}/in/{batch}")
        before = bytes_at(path)
        stream = spark.readStream.schema(SEEN).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        customer_stream.grow_customer_map(stream, path, f"{tmp_path}/check", fan_in=4).awaitTermination()
        sizes.append(bytes_at(path) - before)
    got = {(x.customer_id, x.cas_number_normalized): (x.timestamp_seen_utc, x.code) for x in customer_stream.read_customer_map(spark, path).collect()}
    assert got == best
    # parts of five rows, but for the batch that merges the first part
    assert sizes[1] * 5 < sizes[0] and sizes[2] * 5 < sizes[0] and sizes[5] * 5 < sizes[0]
    number, content = versions.record(spark, path)
    assert number == 9 and [p["level"] for p in content["parts"]] == [1, 1, 0]
    with pytest.raises(FileNotFoundError):
        customer_stream.read_customer_map(spark, f"{tmp_path}/none")


def test_a_batch_that_is_run_again_changes_nothing(spark, tmp_path):
    path = f"{tmp_path}/map"
    spark.createDataFrame([("c", "1", "2024-01-01", "x", "n", "valid")] * 2, SEEN).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(SEEN).parquet(f"{tmp_path}/in")
    customer_stream.grow_customer_map(stream, path, f"{tmp_path}/check").awaitTermination()
    os.remove(f"{tmp_path}/check/commits/0")
    if os.path.exists(f"{tmp_path}/check/commits/.0.crc"):
        os.remove(f"{tmp_path}/check/commits/.0.crc")
    customer_stream.grow_customer_map(stream, path, f"{tmp_path}/check").awaitTermination()
    assert versions.versions(spark, path) == [1] and customer_stream.read_customer_map(spark, path).count() == 1


def test_registry_in_a_database(spark):
    url = "jdbc:derby:memory:registry;create=true"
    rows = [("64-17-5", "K1", 0.5, "valid"), ("67-56-1", "K2", None, "it's"), (None, "", 1.0, "é")]
    df = spark.createDataFrame(rows, "cas_number_normalized string, inchi_key string, resolver_confidence double, cas_status string")
    for k in range(2):
        databases.export_table(df.limit(3 - k), url)
        assert databases.read_table(spark, url).count() == 3 - k
    assert sorted(map(tuple, databases.read_table(spark, url).collect()), key=str) == sorted(rows[:2], key=str)
    databases.export_table(df, url, "other")
    assert sorted(map(tuple, databases.read_table(spark, url, "other").collect()), key=str) == sorted([*rows[:2], ("", "", 1.0, "é")], key=str)
    with pytest.raises(Exception, match="no"):
        databases.export_table(df.withColumn("cas_status", F.expr("CAST(raise_error('no') AS STRING)")), url)
    assert databases.read_table(spark, url).count() == 2
    for bad in ({"table": "a; DROP TABLE registry"}, {"indexes": ["nothing"]}):
        with pytest.raises(ValueError):
            databases.export_table(df, url, **bad)
    connection = spark._jvm.java.sql.DriverManager.getConnection(url)
    found, names = connection.getMetaData().getIndexInfo(None, None, "REGISTRY", False, False), []
    while found.next():
        names.append(found.getString("COLUMN_NAME"))
    tables = connection.getMetaData().getTables(None, None, "REGISTRY_STAGE%", None)
    assert sorted(names) == ["cas_number_normalized", "inchi_key"] and not tables.next()
    connection.close()


def test_a_workbook_of_several_tables(spark, tmp_path, monkeypatch):
    """What a version holds as one workbook: a sheet for each table, in order, also for one without rows; none at all where a sheet fails."""
    path, book = f"{tmp_path}/db", f"{tmp_path}/book"
    registry = spark.range(2_500).selectExpr("CAST(id AS STRING) AS number", "IF(id % 2 = 0, NULL, '<&>') AS note", "id * 1.5 AS `a b`").repartition(3).orderBy("number")
    versions.write(spark, path, {"registry": registry, "audit": spark.createDataFrame([("x", 1)], "event string, n int"), "rejected": spark.createDataFrame([], "reason string")})
    kept = versions.tables(spark, path)
    xlsx.write_workbook({n: kept[n].orderBy("number") if n == "registry" else kept[n] for n in ("registry", "audit", "rejected")}, book)
    read = lambda sheet: spark.read.format("xlsx").option("sheet", sheet).option("fallback", "false").load(book)
    assert read("registry").columns == ["number", "note", "a b"] and read("registry").count() == 2_500
    assert tuple(read("registry").where("number = '7'").first()) == ("7", "<&>", "10.5") and read("registry").where("note IS NULL").count() == 1_250
    assert [tuple(r) for r in read("audit").collect()] == [("x", "1")] and read("rejected").columns == ["reason"] and read("rejected").count() == 0
    assert [r.number for r in read("registry").collect()] == sorted(map(str, range(2_500)))
    with pytest.raises(Exception, match="no"):
        xlsx.write_workbook({"a": kept["audit"], "b": kept["audit"].selectExpr("CAST(raise_error('no') AS STRING) AS e")}, f"{tmp_path}/none")
    assert not [f for _, _, names in os.walk(f"{tmp_path}/none") for f in names if f.endswith(".xlsx")]


def test_governed_columns(spark, tmp_path):
    path = f"{tmp_path}/db"
    with pytest.raises(ValueError):
        governance.open_context(spark, path)
    first = governance.open_context(spark, path, [" InChIKey ", "SMILES", "", "smiles", "CAS_ID", "mw"])
    assert (first.version, first.allowlist, first.tables) == (1, ["inchi_key", "smiles", "cas_number", "mw"], {})
    versions.write(spark, path, {"properties": spark.createDataFrame([("K",)], "inchi_key string")})
    assert governance.change_allowlist(spark, path, drop=["mw", "none"], add=["logp", "InChI"]) == ["inchi_key", "smiles", "cas_number", "logp", "inchi"]
    assert governance.change_allowlist(spark, path, drop=["none"]) == governance.open_context(spark, path, ["ignored"]).allowlist
    last = governance.open_context(spark, path)
    assert last.version == 3 and last.tables["properties"].count() == 1


def test_rows_made_fit_for_an_allowlist(spark):
    key, other = "ABCDEFGHIJKLMN-OPQRSTUVWX-Y", "BBCDEFGHIJKLMN-OPQRSTUVWX-Y"
    rows = [(2, key.lower(), None, "C", None, "v"), (1, key, 1.0, None, "2024-01-01", "v"), (3, "no key", 5.0, "O", None, "v"), (4, None, 6.0, None, None, "v"), (5, other, None, None, None, "v")]
    df = spark.createDataFrame(rows, "_row long, final_inchikey string, mw double, smiles string, timestamp_updated string, my_inchi string")
    clean, rejected = governance.sanitize(df, ["inchi_key", "mw", "smiles", "timestamp_updated", "my_inchi"], "2024-06-01")
    assert {tuple(r) for r in clean.collect()} == {(key, 1.0, "C", "2024-01-01", None), (other, None, None, "2024-06-01", None)}
    assert sorted(r._row for r in rejected.collect()) == [3, 4] and "my_inchi" not in rejected.columns
    with pytest.raises(ValueError):
        governance.sanitize(df, ["mw"], "2024-06-01")
    assert governance.sanitize(df.limit(0), ["inchi_key"], "x")[0].collect() == []
    wide = governance.export_wide(df)
    assert wide.columns == governance.EXPORTED and len(wide.columns) == 49 and governance.export_wide(spark.range(1)).columns == governance.EXPORTED
