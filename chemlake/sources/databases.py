"""Tables to a database through JDBC: staged, indexed, then put in place of the old one in one transaction."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

_NAME = re.compile(r"[A-Za-z][A-Za-z0-9_]*")


def export_table(df: DataFrame, url: str, table: str = "registry", indexes: Sequence[str] = ("cas_number_normalized", "inchi_key"), properties: Mapping[str, str] | None = None, key_type: str = "VARCHAR(255)") -> None:
    """Replace a database's table by df, with an index on each of `indexes`.

    Tasks write their rows to a staging table of its own name.  Then one connection makes the indexes, drops the old
    table and renames the new one in a transaction, so that readers see the old rows or the new ones; where anything
    fails, the staging table goes and the old one stays.  Indexed texts are of a type that can be indexed, null ones ''.
    """
    for name in (table, *df.columns, *indexes):
        if not _NAME.fullmatch(name):
            raise ValueError(f"not a plain name: {name!r}")
    if missing := [c for c in indexes if c not in df.columns]:
        raise ValueError(f"no such columns: {', '.join(missing)}")
    spark, properties = df.sparkSession, dict(properties or {})
    mark = uuid.uuid4().hex[:12]
    staged = f"{table}_stage_{mark}"
    keys = [c for c, t in df.dtypes if t == "string" and c in indexes]
    options = properties | ({"createTableColumnTypes": ", ".join(f"{c} {key_type}" for c in keys)} if keys else {})
    # an attempt that fails leaves rows in its staging table alone; names are folded as the database folds them
    try:
        df.fillna("", keys).write.options(**options).jdbc(url, staged, mode="errorifexists", properties=properties)
        statements = [f"CREATE INDEX idx_{table}_{k}_{mark} ON {staged} ({_column(spark, url, properties, staged, c)})" for k, c in enumerate(indexes)]
        if _exists(spark, url, properties, table):
            statements.append(f"DROP TABLE {table}")
        _run(spark, url, properties, [*statements, f"RENAME TABLE {staged} TO {table}" if ":derby:" in url or ":mysql:" in url else f"ALTER TABLE {staged} RENAME TO {table}"])
    except Exception:
        if _exists(spark, url, properties, staged):
            _run(spark, url, properties, [f"DROP TABLE {staged}"])
        raise


def read_table(spark: SparkSession, url: str, table: str = "registry", properties: Mapping[str, str] | None = None) -> DataFrame:
    return spark.read.jdbc(url, table, properties=dict(properties or {}))


def _connected(spark: SparkSession, url: str, properties: Mapping[str, str]):
    given = spark._jvm.java.util.Properties()
    for k, v in properties.items():
        given.setProperty(k, v)
    if "driver" in properties:
        spark._jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(properties["driver"])
    return spark._jvm.java.sql.DriverManager.getConnection(url, given)


def _run(spark: SparkSession, url: str, properties: Mapping[str, str], statements: Sequence[str]) -> None:
    connection = _connected(spark, url, properties)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for text in statements:
            statement.execute(text)
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def _named(spark: SparkSession, url: str, properties: Mapping[str, str], method: str, table: str) -> list[str]:
    """Names of a table's columns, or of the table, as the database has them, in any case."""
    connection = _connected(spark, url, properties)
    try:
        found, data = [], connection.getMetaData()
        for name in (table, table.upper(), table.lower()):
            rows = data.getColumns(None, None, name, None) if method == "columns" else data.getTables(None, None, name, None)
            while rows.next():
                found.append(rows.getString("COLUMN_NAME" if method == "columns" else "TABLE_NAME"))
        return found
    finally:
        connection.close()


def _exists(spark: SparkSession, url: str, properties: Mapping[str, str], table: str) -> bool:
    return bool(_named(spark, url, properties, "tables", table))


def _column(spark: SparkSession, url: str, properties: Mapping[str, str], table: str, column: str) -> str:
    """A column as it must be quoted: Spark creates columns under quoted names."""
    return next((f'"{c}"' for c in _named(spark, url, properties, "columns", table) if c == column), column)
