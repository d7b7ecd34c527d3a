"""Substring dedup by hashing lines, paragraphs or sentences (operator 4).

Units are normalised and hashed to 128 bits; digests are grouped over all documents; the occurrence that
comes first by (doc_id, place) stays, the others go, with their places in the original text.
"""

from __future__ import annotations

import hashlib
import re
import struct

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chemlake.llm.workspace import Workspace, small_batches

#: Ends of a unit's pattern: the line, the blank line, or a mark that white space or the end follows.
UNITS = {
    "line": re.compile(r"[^\n]+"),
    "paragraph": re.compile(r"(?:[^\n]|\n(?![^\S\n]*\n))+"),
    "sentence": re.compile(r"(?:[^\n.!?]+|[.!?]+(?![.!?\s]|\Z))+[.!?]*|[.!?]+"),
}
#: At most so many digests are held to be common ones: those that make up one unit in so many, or more.
COMMON = 10_000

_COLUMNS = "doc long, begin int, end int, n_words int, h1 long, h2 long, first int"


def _units(pattern: re.Pattern, least: int):
    kinds = [pa.int64(), *[pa.int32()] * 3, pa.int64(), pa.int64(), pa.int32()]

    def run(batches):
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                seen: dict[tuple[int, int], int] = {}
                for m in pattern.finditer(text.as_py() or ""):
                    unit = m.group()
                    normal = unit.lower().split()
                    if not normal or len(normal) < least:
                        continue
                    digest = struct.unpack("<qq", hashlib.blake2b(" ".join(normal).encode("utf-8", "replace"), digest_size=16).digest())
                    begin = m.start() + len(unit) - len(unit.lstrip())
                    rows.append((doc, begin, m.start() + len(unit.rstrip()), len(normal), *digest, seen.setdefault(digest, begin)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc", "begin", "end", "n_words", "h1", "h2", "first"])

    return run


def repeated_units(docs: DataFrame, *, unit: str = "line", least_words: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per unit to remove: doc_id, begin, end (code points, end exclusive), n_words, keep_doc_id, keep_begin.

    Units are compared in lower case with white space run together, whatever their length (least_words asks for
    more); blank ones are none.  The kept occurrence is the first by (doc_id, begin): of equal units in one document
    the first place, of equal ones in two the smaller doc_id.  Rows that share a doc_id are one document, whose units
    of equal rank all stay.  Rows without doc_id rank last, and among themselves none goes for another.  Null and
    empty texts have no units, and an empty table no rows; very long texts are read whole, a unit at a time.  Other
    columns of docs are ignored, whatever they are called.
    """
    small_batches(docs.sparkSession)
    work = Workspace(docs.sparkSession)
    source = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    units = work.save(source.mapInArrow(_units(UNITS[unit], least_words), _COLUMNS), "units")
    # aggregated before the shuffle, so a unit that very many documents hold is no heavier than another
    counted = units.groupBy("h1", "h2").agg(F.min("doc").alias("keep"), F.min_by("first", "doc").alias("keep_begin"), F.count("*").alias("n"))
    kept = work.save(counted.where("n > 1"), "kept")
    least = max(1_000, -(-units.count() // COMMON))
    # a common digest's units stay where they are; there are COMMON of these digests at most
    common = F.broadcast(kept.where(F.col("n") >= least))
    rest = units.join(F.broadcast(common.select("h1", "h2")), ["h1", "h2"], "left_anti").join(kept.where(F.col("n") < least), ["h1", "h2"])
    joined = units.join(common, ["h1", "h2"]).unionByName(rest)
    again = F.col("begin") > F.col("first")
    gone = joined.where(again | F.coalesce(F.col("doc") > F.col("keep"), F.col("doc").isNull() & F.col("keep").isNotNull()))
    return gone.select(
        F.col("doc").alias("doc_id"), "begin", "end", "n_words",
        F.coalesce("keep", "doc").alias("keep_doc_id"), F.when(F.col("keep").isNotNull(), F.col("keep_begin")).otherwise(F.col("first")).alias("keep_begin"),
    )


def without_repeats(docs: DataFrame, *, unit: str = "line", least_words: int = 1) -> DataFrame:
    """docs with the repeated units cut out of text; kept_spans: the code points of the original that stay.

    Rows without doc_id are left as they are, and null texts stay null.  A column called kept_spans is replaced.
    """
    gone = repeated_units(docs, unit=unit, least_words=least_words).where("doc_id IS NOT NULL")
    spans = gone.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("begin", "end"))).alias("_gone"))
    whole = F.struct(F.lit(0).alias("begin"), F.lit(0).alias("end"))
    ends = F.concat(F.array(whole), F.coalesce("_gone", F.array().cast("array<struct<begin:int,end:int>>")))
    begins = F.concat(F.slice(ends, 2, F.greatest(F.size(ends) - 1, F.lit(0))), F.array(F.struct(F.length("text").alias("begin"), F.length("text").alias("end"))))
    kept = F.filter(F.zip_with(ends, begins, lambda a, b: F.struct(a["end"].alias("begin"), b["begin"].alias("end"))), lambda s: s["begin"] < s["end"])
    joined = docs.drop("kept_spans").join(spans, "doc_id", "left").withColumn("kept_spans", F.when(F.col("text").isNotNull(), kept))
    cut = F.array_join(F.transform("kept_spans", lambda s: F.substring(F.col("text"), s["begin"] + 1, s["end"] - s["begin"])), "")
    return joined.withColumn("text", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(cut)).select(*[c for c in docs.columns if c != "kept_spans"], "kept_spans")
