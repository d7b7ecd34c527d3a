"""Intermediate tables in the folder that the cluster shares, which cut lineage and survive lost executors."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OPEN: list[Workspace] = []

#: Bytes of rows that go to Python at once; Spark's own limit would let a batch of long texts take sixteen times this.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Lower the session's limit on the bytes of an Arrow batch to BATCH_BYTES, if it is higher."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.conf.get(name).rstrip("b").isdigit() or int(spark.conf.get(name).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def checkpoint_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset and Spark runs in one process (as in tests), a folder under the system's temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir is unset: name a folder that all executors share")
    return f"{tempfile.gettempdir()}/chemlake-checkpoints"


class Workspace:
    """Written tables under one new folder; drop() deletes a table that is no longer needed, exit deletes the rest.

    Results are read from these tables when they are used: a long session writes a result, then drops the workspaces that
    were opened for it (opened() before, drop_since() after).
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{checkpoint_dir(spark).rstrip('/')}/tables-{uuid.uuid4().hex}"
        _OPEN.append(self)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write df and read it back."""
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        path, files = self._path(name)
        files.delete(path, True)

    def keep_only(self, *starts: str) -> None:
        """Drop the tables whose names begin with none of `starts`."""
        path, files = self._path("")
        for found in files.listStatus(path):
            if not found.getPath().getName().startswith(starts):
                files.delete(found.getPath(), True)

    def _path(self, name: str):
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        return path, path.getFileSystem(context._jsc.hadoopConfiguration())


def opened() -> int:
    """How many workspaces there are by now."""
    return len(_OPEN)


def drop_since(mark: int, but: Workspace | None = None) -> None:
    """Drop the workspaces opened since opened() gave `mark`, but for one."""
    for workspace in _OPEN[mark:]:
        if workspace is not but:
            workspace.drop()
    _OPEN[mark:] = [w for w in _OPEN[mark:] if w is but]


@atexit.register
def _drop_all() -> None:
    for workspace in _OPEN:
        try:
            workspace.drop()
        except Exception:  # noqa: BLE001  the session may have ended before; the folder is then the cluster's to clean
            return
