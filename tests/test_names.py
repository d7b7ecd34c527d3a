"""Names of whole texts."""

from chemlake.plans import queries


def test_ascii_names_reads_every_line(spark, tmp_path):
    spark.createDataFrame([(1, "First\nSecond Éa;\n3rd ω, x.")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    row = queries.ascii_names(spark, str(tmp_path)).first()
    assert (row.resolver_name, row.n, row.entity_name) == ("first second ea; 3rd , x", 26, "first\nsecond a\n3rd  x")
