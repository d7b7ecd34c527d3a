"""The CAS registry: clean rows, rejects, the merge by (number, key), ambiguity and audit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chemlake.functions.mixtures import registry_status
from chemlake.functions.text import text_or_empty

# The registry's columns and statuses.
COLUMNS = (
    "cas_input", "cas_number_normalized", "cas_status", "inchi_key", "inchi", "smiles", "resolver_source",
    "resolver_confidence", "resolution_timestamp_utc", "evidence", "notes", "mixture_type",
)
STATUSES = ("valid", "invalid", "repaired", "ambiguous", "mixture", "uvcb", "unresolved")
KEY = ["cas_number_normalized", "inchi_key"]
FILLED = [c for c in COLUMNS if c not in (*KEY, "resolver_confidence", "resolver_source", "resolution_timestamp_utc", "evidence", "notes")]


@dataclass
class Merged:
    registry: DataFrame
    audit: DataFrame
    rejected: DataFrame


def clean(rows: DataFrame, as_of: str) -> DataFrame:
    """Rows in the registry's columns: trimmed, known statuses, a time where there is a key, a numeric confidence."""
    have = set(rows.columns)
    column = lambda c: text_or_empty(F.col(c).cast("string")) if c in have else F.lit("")
    shown: dict[str, Column] = {c: column(c) for c in COLUMNS}
    shown["inchi_key"] = F.upper(shown["inchi_key"])
    shown["resolver_confidence"] = F.col("resolver_confidence").cast("string").try_cast("double") if "resolver_confidence" in have else F.lit(None).cast("double")
    status = F.lower(shown["cas_status"])
    shown["cas_status"] = F.when(status.isin(*STATUSES), status).otherwise("unresolved")
    any_key = (shown["cas_number_normalized"] != "") | (shown["inchi_key"] != "")
    shown["resolution_timestamp_utc"] = F.when((shown["resolution_timestamp_utc"] == "") & any_key, as_of).otherwise(shown["resolution_timestamp_utc"])
    extra = [c for c in rows.columns if c == "_row"]
    return rows.select(*[shown[c].alias(c) for c in COLUMNS], *extra)


def joinable() -> Column:
    """Has a key and is no mixture: may be matched with the property table when merging."""
    return (F.col("inchi_key") != "") & ~F.col("cas_status").isin("mixture", "uvcb")


def from_cleaner(exploded: DataFrame) -> DataFrame:
    """Rows of the cleaner's table as registry rows without structure."""
    status = F.when(F.lower("cas_validity").contains("invalid"), "invalid").when(F.col("cas_validity").contains("fixed"), "repaired").otherwise("valid")
    return exploded.select(F.col("cas").alias("cas_input"), F.col("cas").alias("cas_number_normalized"), status.alias("cas_status"), F.lit("").alias("inchi_key"), F.lit("cleaner").alias("resolver_source"), F.col("cas_validity").alias("evidence"))


def from_resolver(resolved: DataFrame) -> DataFrame:
    """Rows of the resolver's table; the first of several names that a column goes by."""
    pick = lambda *names: next((F.col(n) for n in names if n in resolved.columns), F.lit(""))
    kind = pick("mixture_type")
    return resolved.select(
        pick("cas_input", "input", "cas").alias("cas_input"), pick("cas", "cas_used", "cas_number_normalized").alias("cas_number_normalized"),
        registry_status(kind, pick("cas_validity", "cas_status")).alias("cas_status"), pick("inchikey", "inchi_key", "final_inchikey").alias("inchi_key"),
        pick("inchi").alias("inchi"), pick("smiles").alias("smiles"), pick("source", "resolver_source").alias("resolver_source"), kind.alias("mixture_type"),
        *[F.col(c) for c in ("_row",) if c in resolved.columns],
    )


def _appended(values: Column) -> Column:
    """Texts in order, each added after ' | ' unless what is there already holds it."""
    return F.aggregate(values, F.lit(""), lambda acc, x: F.when(F.contains(acc, x), acc).when(acc == "", x).otherwise(F.concat(acc, F.lit(" | "), x)))


#: Parts that rows of one key are dealt to before they are folded.
PARTS = 16


def _texts_in_order(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(key, columns): distinct texts of each column by first appearance, appended; equal texts meet before the shuffle to a key."""
    named = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("text")) for c in columns]))
    each = rows.select(*KEY, "_order", named.alias("x")).where("x.text <> ''").groupBy(*KEY, "x.column", "x.text").agg(F.min("_order").alias("_at"))
    listed = each.groupBy(*KEY).agg(*[F.array_sort(F.collect_list(F.when(F.col("column") == c, F.struct("_at", "text")))).alias(c) for c in columns])
    return listed.select(*KEY, *[_appended(F.transform(c, lambda x: x["text"])).alias(c) for c in columns])


def upsert(known: DataFrame, incoming: DataFrame, as_of: str) -> Merged:
    """Merge incoming rows (with their order in _row) into known ones by (cas_number_normalized, inchi_key).

    Rows without number and invalid ones are rejected.  Of a key, blanks are filled by the first text that
    comes, the highest confidence stays with its source, the latest time stays, evidence and notes are
    appended.  A number with two keys or more that may be joined becomes ambiguous.
    """
    old = clean(known, as_of).withColumn("_order", F.lit(-1).cast("long"))
    new = clean(incoming, as_of)
    new = new.withColumn("_order", F.col("_row").cast("long") if "_row" in new.columns else F.lit(0).cast("long")).drop("_row")
    reason = F.when(F.col("cas_number_normalized") == "", "missing cas_number_normalized").when(F.col("cas_status") == "invalid", "cas_status=invalid")
    judged = new.withColumn("rejected_reason", reason)
    rejected = judged.where("rejected_reason IS NOT NULL").drop("_order").withColumn("rejected_timestamp_utc", F.lit(as_of))
    good = judged.where("rejected_reason IS NULL").drop("rejected_reason")
    # cleaned once: both folds below read the same exchange, and a key with very many rows is in several parts
    rows = old.unionByName(good).repartition(*KEY, F.pmod("_order", F.lit(PARTS)))

    source_of_best = F.max_by(F.when(F.col("resolver_confidence").isNotNull(), F.col("resolver_source")), F.when(F.col("resolver_confidence").isNotNull(), F.struct("resolver_confidence", -F.col("_order"))))
    folded = rows.groupBy(*KEY).agg(
        *[F.min_by(F.when(F.col(c) != "", F.col(c)), F.when(F.col(c) != "", F.col("_order"))).alias(c) for c in (*FILLED, "resolver_source")],
        F.max("resolver_confidence").alias("resolver_confidence"), source_of_best.alias("_best"), F.max("resolution_timestamp_utc").alias("resolution_timestamp_utc"),
        F.min("_order").alias("_first"), F.count_if(F.col("_order") >= 0).alias("_new"),
    )
    merged = folded.join(_texts_in_order(rows, ["evidence", "notes"]), KEY, "left")
    merged = merged.withColumn("resolver_source", F.coalesce(F.when(F.col("_best") != "", F.col("_best")), "resolver_source"))
    whole = merged.select(*[F.coalesce(c, F.lit("")).alias(c) if c != "resolver_confidence" else F.col(c) for c in COLUMNS], "_first", "_new")

    keys = whole.where(joinable()).groupBy("cas_number_normalized").agg(F.array_sort(F.collect_set("inchi_key")).alias("_keys")).where(F.size("_keys") >= 2)
    marked = whole.join(keys, "cas_number_normalized", "left").withColumn("cas_status", F.when(F.col("_keys").isNotNull() & joinable(), "ambiguous").otherwise(F.col("cas_status")))
    stamp = F.lit(as_of).alias("timestamp_utc")
    inserts = whole.where("_first >= 0").select(F.lit("insert_new_mapping").alias("event"), stamp, *KEY, F.lit("Inserted new mapping row.").alias("details"))
    updates = whole.where("_first < 0 AND _new > 0").select(F.lit("update_existing_mapping").alias("event"), stamp, *KEY, F.lit("Filled blanks, kept the best confidence and the latest time.").alias("details"))
    conflicts = keys.select(F.lit("cas_conflict_mark_ambiguous").alias("event"), stamp, "cas_number_normalized", F.lit("").alias("inchi_key"), F.concat(F.lit("Number maps to several keys: "), F.array_join("_keys", ", ")).alias("details"))
    return Merged(marked.select(*COLUMNS), inserts.union(updates).union(conflicts), rejected)


def in_export_order(registry: DataFrame) -> DataFrame:
    return registry.orderBy(*[F.asc_nulls_last(c) for c in ("cas_number_normalized", "cas_status", "inchi_key", "resolution_timestamp_utc")])


def summary(registry: DataFrame) -> DataFrame:
    """One row of counts: all, joinable to properties (valid with a key), ambiguous, mixtures."""
    return registry.agg(
        F.count("*").alias("total"), F.count_if((F.col("cas_status") == "valid") & (F.col("inchi_key") != "")).alias("joinable"),
        F.count_if(F.col("cas_status") == "ambiguous").alias("ambiguous"), F.count_if(F.col("cas_status").isin("mixture", "uvcb")).alias("mixtures"),
    )
