"""The canonical property table, one row per InChIKey: governance, dedup, merge, and views of it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chemlake.functions.text import first_inchikey, is_inchikey, normal_inchikey, text_or_null

KEY = "inchi_key"
# Names that a key goes by, in the order in which they are believed.
KEY_NAMES = ("inchi_key", "final_inchikey", "computed_inchikey", "source_inchikey")
INCHI_NAMES = ("inchi", "final_inchi", "computed_inchi", "source_inchi")
# Names of identifiers that may stay as they are.
KEPT_IDENTIFIERS = ("inchi_key", "inchi", "computed_inchi", "final_inchi", "source_inchi", "computed_inchikey", "final_inchikey", "source_inchikey")
SMILES_NAMES = ("smiles", "final_smiles", "computed_smiles", "source_smiles")
#: Columns that a tool may overwrite: a prefix list, or everything but the key.
PROPERTY_PREFIXES = ("experimental_", "computed_", "final_", "source_", "log_", "henry_")
FILL_ONLY = ("inchi",)


def unique_names(names: Sequence[str]) -> list[str]:
    """Trimmed names without blanks, each once, in order."""
    return list(dict.fromkeys(n for n in (str(x).strip() for x in names) if n))


def collapse_duplicates(df: DataFrame) -> DataFrame:
    """Columns of one name become one: of each row the first value from the left that is not null."""
    places = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    names = [c.strip() for c in df.columns]
    return places.select(*[F.coalesce(*[F.col(f"c{i}") for i, m in enumerate(names) if m == n]).alias(n) for n in unique_names(names)])


def to_allowlist(df: DataFrame, allowlist: Sequence[str]) -> DataFrame:
    """The allowlist's columns in its order; missing ones are null."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in allowlist])


def owned_columns(tool: str, allowlist: Sequence[str]) -> list[str]:
    """What a tool may overwrite; an unknown tool nothing."""
    if tool == "features":
        return [c for c in allowlist if c != KEY]
    if tool == "properties":
        return [c for c in allowlist if c != KEY and c.startswith(PROPERTY_PREFIXES)]
    return []


def promote_identifiers(df: DataFrame) -> DataFrame:
    """df with inchi_key, inchi and smiles from the first of their names that holds one."""
    have = lambda names: [F.col(n) for n in names if n in df.columns]
    filled = lambda names: F.coalesce(*[text_or_null(c.cast("string")) for c in have(names)], F.lit(None).cast("string"))
    smiles = filled(SMILES_NAMES)
    if {"identifier_type", "normalized_input"} <= set(df.columns):
        smiles = F.coalesce(smiles, F.when(F.lower(F.trim("identifier_type")).isin("smiles", "smile"), text_or_null(F.col("normalized_input"))))
    keys = have(KEY_NAMES)
    key = first_inchikey(*keys) if keys else F.lit(None).cast("string")
    found = df.withColumns({"_promoted_key": key, "inchi": filled(INCHI_NAMES), "smiles": smiles})
    # a filter on a column that is generated stays above it; on one that is computed it would hold the whole of its making several times
    made = found.withColumn("_promoted_key", F.explode_outer(F.array("_promoted_key")))
    return made.withColumn(KEY, F.col("_promoted_key")).drop("_promoted_key")


def split_by_key(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a valid key in normal form, the others)."""
    ok = is_inchikey(F.col(KEY))
    return df.where(ok).withColumn(KEY, normal_inchikey(F.col(KEY))), df.where(~ok)


def dedupe(df: DataFrame, order: str = "_row") -> DataFrame:
    """One row per valid key: of each column the first value by `order` that is not null."""
    good, _ = split_by_key(df)
    rest = [c for c in df.columns if c not in (KEY, order)]
    first = lambda c: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c)
    return good.groupBy(KEY).agg(*[first(c) for c in rest]).select(*[c for c in df.columns if c != order])


def merge_groups(df: DataFrame, order: str = "_row", times: Sequence[str] = ("timestamp_updated", "timestamp")) -> DataFrame:
    """One row per key: of each column the first value that is not null, from the latest row to the earliest.

    Of equal times the row of more values comes first, then the smaller `order`; rows without a time that can be read
    come last.  One aggregate, so that each task sends a row per key.  Null keys are a group of their own.
    """
    stamp = next((c for c in times if c in df.columns), None)
    time = F.col(stamp).try_cast("timestamp") if stamp else F.lit(None).cast("timestamp")
    rest = [c for c in df.columns if c not in (KEY, order)]
    values = sum((F.col(c).isNotNull().cast("int") for c in rest), F.lit(0))
    placed = df.withColumn("_place", F.struct(time.isNull().alias("late"), (-F.unix_micros(time)).alias("time"), (-values).alias("values"), F.col(order).alias("order")))
    first = lambda c: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_place"))).alias(c)
    return placed.groupBy(KEY).agg(*[first(c) for c in rest]).select(*[c for c in df.columns if c != order])


def drop_variant_identifiers(df: DataFrame) -> DataFrame:
    """df without columns of InChIs and their keys under other names than those of KEPT_IDENTIFIERS."""
    return df.drop(*[c for c in df.columns if "inchi" in c.lower() and c not in KEPT_IDENTIFIERS])


def upsert(known: DataFrame, incoming: DataFrame, tool: str, allowlist: Sequence[str], order: str = "_row") -> DataFrame:
    """Both sides, one row per key: new keys come whole, owned columns take what is not null (also 0 and ''), inchi is filled only."""
    old, new = (to_allowlist(dedupe(x if order in x.columns else x.withColumn(order, F.lit(0)), order), allowlist) for x in (known, incoming))
    owned = set(owned_columns(tool, allowlist))
    left, right = old.select(F.col(KEY).alias("k"), *[F.col(c).alias(f"o_{c}") for c in allowlist if c != KEY]), new.select(F.col(KEY).alias("j"), *[F.col(c).alias(f"n_{c}") for c in allowlist if c != KEY])
    both = left.join(right, F.col("k") == F.col("j"), "full_outer")

    def value(c: str) -> Column:
        o, n = F.col(f"o_{c}"), F.col(f"n_{c}")
        if c in FILL_ONLY:
            merged = F.when(text_or_null(o.cast("string")).isNull(), n).otherwise(o)
        else:
            merged = F.coalesce(n, o) if c in owned else o
        return F.when(F.col("k").isNull(), n).otherwise(merged).alias(c)

    return both.select(*[F.coalesce("k", "j").alias(KEY) if c == KEY else value(c) for c in allowlist])


def merge_fields(known: DataFrame, incoming: DataFrame, stamp: str = "timestamp_updated") -> DataFrame:
    """New over old, field by field; blanks never overwrite; the old time stays where nothing changed."""
    fields = [c for c in known.columns if c not in (KEY, stamp)]
    new = incoming.select(F.col(KEY).alias("j"), *[F.when(F.trim(F.col(c).cast("string")) != "", F.col(c)).alias(f"n_{c}") if c in incoming.columns else F.lit(None).alias(f"n_{c}") for c in [*fields, stamp]])
    both = known.join(new, F.col(KEY) == F.col("j"), "full_outer")
    changed = reduce(or_, [F.col(f"n_{c}").isNotNull() & ~F.col(f"n_{c}").cast("string").eqNullSafe(F.col(c).cast("string")) for c in fields], F.lit(False))
    fresh = F.when(F.col(KEY).isNull() | changed, F.coalesce(f"n_{stamp}", stamp)).otherwise(F.col(stamp))
    return both.select(F.coalesce(KEY, "j").alias(KEY), *[F.coalesce(f"n_{c}", c).alias(c) for c in fields], fresh.alias(stamp))


def cas_view(registry: DataFrame, properties: DataFrame) -> DataFrame:
    """Registry rows with the properties of their key; registry columns that clash end in _registry."""
    clash = [c for c in registry.columns if c in properties.columns and c != KEY]
    renamed = registry.withColumnsRenamed({c: f"{c}_registry" for c in clash})
    # the registry's blank keys match nothing, so they need not meet in one task
    keyed = renamed.withColumn("_k", F.when(F.col(KEY) != "", F.col(KEY)))
    return keyed.join(properties.withColumnRenamed(KEY, "_p"), F.col("_k") == F.col("_p"), "left").drop("_k", "_p")


def exportable(view: DataFrame) -> DataFrame:
    """Rows with a key and status valid."""
    return view.where((F.coalesce(F.trim(KEY), F.lit("")) != "") & (F.col("cas_status") == "valid"))


def overlay(view: DataFrame, customer_map: DataFrame, customer_id: str) -> DataFrame:
    """The view with one customer's columns; the customer is filtered before the join."""
    own = customer_map.where(F.col("customer_id") == customer_id)
    clash = {c: f"{c}_customer" for c in own.columns if c in view.columns and c != "cas_number_normalized"}
    return view.join(own.withColumnsRenamed(clash), "cas_number_normalized", "left")
