"""The customer map kept up to date from a stream of what customers have seen."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chemlake.operators.tokens import upsert_customer_map
from chemlake.sources import versions
from chemlake.sources.tables import drop_run, read_run, run_names, write_run

#: Runs of the map that are kept as its history.
KEPT_RUNS = 20
#: What a row of the map is told by.
MAP_KEY = ("customer_id", "cas_number_normalized")


def run_name(start: int, checkpoint: str, batch: int) -> str:
    """The run of a batch: runs of later checkpoints follow those of earlier ones."""
    return f"{start:06d}-{hashlib.sha256(checkpoint.encode()).hexdigest()[:8]}-{batch:012d}"


def keep_customer_map(seen: DataFrame, path: str, checkpoint: str, available_now: bool = True, kept_runs: int = KEPT_RUNS) -> StreamingQuery:
    """Merge each micro-batch into the map at path, as one run per batch; older runs than the last kept_runs go.

    The latest row wins by its own time, so late and repeated rows change nothing.  A batch is merged into the latest
    run before its own, so one that is run again writes the same run again, and the first batch of a new checkpoint
    goes on from what is there.
    """

    def merge(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        names = run_names(spark, path)
        mine = run_name(0, checkpoint, 0)[6:16]
        starts = [int(n[:6]) for n in names if n[6:16] == mine]
        own = run_name(starts[0] if starts else max((int(n[:6]) for n in names), default=0) + 1, checkpoint, batch)
        before = [n for n in names if n < own]
        known = read_run(spark, path, before[-1]) if before else rows.limit(0)
        write_run(upsert_customer_map(known, rows), path, own)
        for name in before[: max(0, len(before) + 1 - kept_runs)]:
            drop_run(spark, path, name)

    writer = seen.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


#: Parts of one level that are merged into one of the next level.
FAN_IN = 8


def grow_customer_map(seen: DataFrame, path: str, checkpoint: str, available_now: bool = True, fan_in: int = FAN_IN) -> StreamingQuery:
    """Add each micro-batch to the map at path as a part of its own: bytes written go with the batch, not with the map.

    A part holds the latest row of each key of its batch.  When a level has `fan_in` parts, they are merged into one of
    the next level, so a row is written once for each level, and there are as many levels as the logarithm of the
    batches.  Each batch is one version (see sources.versions), with the parts before and its own; a batch that is run
    again finds itself in the version and changes nothing.  Read it by `read_customer_map`.
    """
    mine = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def add(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        number, content = versions.record(spark, path)
        done, parts = dict(content.get("batches", {})), list(content.get("parts", []))
        if done.get(mine, -1) >= batch:
            return
        parts.append(versions.save(upsert_customer_map(rows.limit(0), rows), path, "part") | {"level": 0})
        while len(full := [p for p in parts if p["level"] == parts[-1]["level"]]) >= fan_in:
            merged = versions.save(_latest(spark, path, full), path, "part") | {"level": parts[-1]["level"] + 1}
            parts = [p for p in parts if p not in full] + [merged]
        versions.commit(spark, path, number + 1, {"parts": parts, "batches": done | {mine: batch}})

    writer = seen.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _latest(spark: SparkSession, path: str, parts: list[dict]) -> DataFrame:
    """The latest row of each key of several parts; of equal times that of the later part."""
    rows = [versions.load(spark, path, p).withColumn("_part", F.lit(k)) for k, p in enumerate(parts)]
    both = rows[0]
    for df in rows[1:]:
        both = both.unionByName(df, allowMissingColumns=True)
    texts = [c for c, t in both.dtypes if t == "string" and c != "timestamp_seen_utc"]
    order = F.struct("timestamp_seen_utc", "_part", *sorted(texts))
    kept = [c for c in both.columns if c not in (*MAP_KEY, "_part")]
    return both.groupBy(*MAP_KEY).agg(F.max_by(F.struct(*kept), order).alias("_r")).select(*MAP_KEY, "_r.*")


def read_customer_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The map of the latest version, or of one that is named; parts are put together when they are read."""
    _, content = versions.record(spark, path, version)
    if not content.get("parts"):
        raise FileNotFoundError(path)
    return _latest(spark, path, content["parts"])


def windowed_counts(seen: DataFrame, time: str = "ts", late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Rows per customer and window of event time; rows later than `late` are left out."""
    return seen.withWatermark(time, late).groupBy(F.window(time, width), "customer_id").agg(F.count("*").alias("n"))
