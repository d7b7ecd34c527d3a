"""Several tables committed as one: data in folders of their own, then one small file that names them all.

    write(spark, path, {"registry": a, "audit": b})     a new version: these tables, and all others as they were
    tables(spark, path)                                  the tables of the latest version, or of one that is named

Readers see all tables of a version or none.  A version is one file whose name is its number; making it fails where
another writer made that number first, so of two writers one starts anew.  Data of a write that failed stay unnamed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from typing import Any

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

COMMITS = "_versions"


class Conflict(RuntimeError):
    """Another writer made the version first."""


class _Folder:
    """Small files and names under a path, through Hadoop's file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path.rstrip("/")
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.files = self._place("").getFileSystem(self.conf)

    def _place(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        place = self._place(name)
        return sorted(f.getPath().getName() for f in self.files.listStatus(place)) if self.files.exists(place) else []

    def read(self, name: str) -> str:
        stream = self.files.open(self._place(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Make a whole file under a name that is free; False if it is not."""
        draft, place = self._place(f"{COMMITS}/.{uuid.uuid4().hex}"), self._place(name)
        stream = self.files.create(draft)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri() if place.toUri().getScheme() else self.files.getUri(), self.conf)
        no_options = SparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self.files.makeQualified(draft), self.files.makeQualified(place), no_options)
        except Exception as e:  # py4j wraps what Java throws
            if "FileAlreadyExists" not in str(e):
                raise
            self.files.delete(draft, False)
            return False
        return True

    def delete(self, name: str) -> None:
        self.files.delete(self._place(name), True)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions at a path."""
    return [int(n.removesuffix(".json")) for n in _Folder(spark, path).names(COMMITS) if n.endswith(".json") and not n.startswith(".")]


def record(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, dict[str, Any]]:
    """(number, content) of the latest version or of the one named; (0, {}) where there is none."""
    known = versions(spark, path)
    if version is None:
        version = max(known, default=0)
    if version and version not in known:
        raise KeyError(f"no version {version}")
    return version, json.loads(_Folder(spark, path).read(f"{COMMITS}/{version:020d}.json")) if version else {}


def commit(spark: SparkSession, path: str, number: int, content: Mapping[str, Any]) -> int:
    """Make version `number`; Conflict if it is there."""
    if not _Folder(spark, path).create(f"{COMMITS}/{number:020d}.json", json.dumps(content)):
        raise Conflict(f"version {number} is there")
    return number


def save(df: DataFrame, path: str, name: str) -> dict[str, str]:
    """Write data under a new folder; what a version says of it."""
    place = f"data/{name}-{uuid.uuid4().hex}"
    df.write.parquet(f"{path.rstrip('/')}/{place}")
    return {"place": place, "schema": df.schema.json()}


def load(spark: SparkSession, path: str, said: Mapping[str, str]) -> DataFrame:
    return spark.read.schema(StructType.fromJson(json.loads(said["schema"]))).parquet(f"{path.rstrip('/')}/{said['place']}")


def write(spark: SparkSession, path: str, tables: Mapping[str, DataFrame], check: Callable[[dict[str, DataFrame]], None] | None = None) -> int:
    """A new version of these tables, after that which is the latest now; its number.

    check gets the written tables and may raise before anything is seen.  Tables of the version before that are not
    written stay part of it.  A Conflict leaves the other writer's version as it is.
    """
    before, content = record(spark, path)
    written = {name: save(df, path, name) for name, df in tables.items()}
    if check:
        check({name: load(spark, path, said) for name, said in written.items()})
    return commit(spark, path, before + 1, content | {"tables": content.get("tables", {}) | written})


def tables(spark: SparkSession, path: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of a version, all as of the same commit."""
    _, content = record(spark, path, version)
    return {name: load(spark, path, said) for name, said in content.get("tables", {}).items()}


def forget(spark: SparkSession, path: str, kept: int) -> None:
    """Drop all versions but the last `kept`, and the data that none of these names; not while a writer is at work."""
    folder, known = _Folder(spark, path), versions(spark, path)
    named = set()
    for version in known[-kept:]:
        named |= {said["place"].partition("/")[2] for said in _places(record(spark, path, version)[1])}
    for version in known[:-kept]:
        folder.delete(f"{COMMITS}/{version:020d}.json")
    for name in folder.names("data"):
        if name not in named:
            folder.delete(f"data/{name}")


def _places(content: Any) -> list[dict]:
    """Everything in a version that names data."""
    if isinstance(content, dict):
        return [content] if "place" in content else [p for v in content.values() for p in _places(v)]
    return [p for v in content for p in _places(v)] if isinstance(content, list) else []
