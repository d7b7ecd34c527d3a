"""Tables out of a database dump: the rows of its INSERT statements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_statements(spark: SparkSession, path: str) -> DataFrame:
    """The statements of a dump (value), which end with a semicolon at the end of a line and may span lines."""
    return spark.read.option("lineSep", ";\n").text(path)


def insert_rows(dump: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Rows of the `INSERT INTO table VALUES (...), (...)` statements of dump (value, one statement each), all texts.

    Quotes are single and doubled inside a text; NULL is null.  Every other statement is left out, so what a dialect adds
    (CASCADE, SERIAL and the like) needs no attention.
    """
    line = F.col("value")
    wanted = dump.where(F.rlike(line, F.lit(rf'(?i)^\s*INSERT\s+INTO\s+["`]?(?:\w+\.)?{table}["`]?[\s(]')))
    after = F.regexp_replace(line, r"(?is)^.*?\bVALUES\s*", "")
    groups = F.regexp_extract_all(after, F.lit(r"\(((?:[^()']|'(?:[^']|'')*+')*+)\)"), F.lit(1))
    cells = F.regexp_extract_all(F.col("row"), F.lit(r"\s*('(?:[^']|'')*+'|[^,']+)\s*(?:,|$)"), F.lit(1))
    rows = wanted.select(F.explode(groups).alias("row")).select(cells.alias("cells"))

    def cell(i: int):
        x = F.trim(F.get("cells", F.lit(i)))
        return F.when(F.upper(x) == "NULL", F.lit(None).cast("string")).when(x.startswith("'"), F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit("''"), F.lit("'"))).otherwise(x)

    return rows.select(*[cell(i).alias(c) for i, c in enumerate(columns)])


def table_with_key(tables: dict[str, DataFrame], key: str = "inchikey", wanted: Sequence[str] = ("henry", "hominus", "kh")) -> tuple[str, str, str] | None:
    """(table, key column, value column) of the table that has a key and a value column; the one of most columns wins."""
    found = []
    for name, df in tables.items():
        keys = [c for c in df.columns if key in c.lower().replace("_", "")]
        values = [c for w in wanted for c in df.columns if w in c.lower()]
        if keys and values:
            found.append((len(df.columns), name, keys[0], values[0]))
    return max(found, key=lambda f: f[0])[1:] if found else None
