"""Which column of a table identifies its substances, and what is done once per identifier."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chemlake.functions.cas import property_cas
from chemlake.functions.text import identifier_type, is_inchikey, looks_like_smiles, normal_identifier, text_or_null

# Kinds of identifiers in the order in which they are believed, and parts of names of columns that hold them.
KINDS = ("smiles", "inchi", "inchikey", "cas", "name")
NAME_PARTS = {"smiles": ("smiles",), "inchi": ("inchi",), "inchikey": ("inchikey", "inchi_key"), "cas": ("cas",), "name": ("name", "substance", "compound")}
GROUPS = ("experimental", "computed", "final", "source")


def ordered_columns(original: Sequence[str], new: Sequence[str]) -> list[str]:
    """The original columns, then new ones by group (experimental, computed, final, source, other) and name."""
    rank = lambda c: next((i for i, g in enumerate(GROUPS) if c.startswith(g)), len(GROUPS))
    return [*original, *sorted((c for c in dict.fromkeys(new) if c not in set(original)), key=lambda c: (rank(c), c))]


def kind_by_name(column: str) -> str | None:
    low = column.lower()
    if any(p in low for p in NAME_PARTS["inchikey"]):
        return "inchikey"
    return next((k for k in KINDS if k != "inchikey" and any(p in low for p in NAME_PARTS[k])), None)


def candidate_columns(df: DataFrame) -> dict[str, list[str]]:
    """Columns by kind of identifier: by name, else by what more than half of all their values look like."""
    found: dict[str, list[str]] = {k: [] for k in KINDS}
    open_ = []
    for c, kind in df.dtypes:
        if k := kind_by_name(c):
            found[k].append(c)
        elif kind == "string":
            open_.append(c)
    if open_:
        # one aggregate over all rows and columns
        counts = df.select(*open_).agg(*[F.count_if((identifier_type(F.col(c)) == k) & F.col(c).isNotNull()).alias(f"{c}|{k}") for c in open_ for k in KINDS[:-1]], *[F.count(c).alias(f"{c}|n") for c in open_]).first()
        for c in open_:
            best = max(KINDS[:-1], key=lambda k: counts[f"{c}|{k}"])
            if counts[f"{c}|{best}"] * 2 > counts[f"{c}|n"]:
                found[best].append(c)
    return found


def _fits(kind: str, c: Column) -> Column:
    t = text_or_null(c)
    return {
        "smiles": F.when(looks_like_smiles(t) & ~F.rlike(t, F.lit(r"^\d+$")) & property_cas(t).isNull() & ~is_inchikey(t), t),
        "inchi": F.when(F.lower(t).startswith("inchi=") | F.rlike(t, F.lit("^1S?/")), t),
        "inchikey": F.when(is_inchikey(t), F.upper(t)),
        "cas": property_cas(t),
        "name": t,
    }[kind]


def best_identifier(df: DataFrame, columns: dict[str, list[str]]) -> DataFrame:
    """df with identifier, identifier_type and normalized_input: the first valid one by kind, then by column."""
    choices = [F.when(_fits(k, F.col(c).cast("string")).isNotNull(), F.struct(F.lit(k).alias("kind"), _fits(k, F.col(c).cast("string")).alias("id"))) for k in KINDS for c in columns.get(k, [])]
    none = F.lit(None).cast("struct<kind:string,id:string>")
    chosen = df.withColumn("_best", F.coalesce(*choices, none))
    return chosen.withColumns({"identifier": F.col("_best.id"), "identifier_type": F.col("_best.kind"), "normalized_input": normal_identifier(F.col("_best.id"), F.col("_best.kind"))}).drop("_best")


def once_per_identifier(df: DataFrame, keys: Sequence[str], resolve: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """df joined with what `resolve` gives for its distinct keys; rows without key stay, with nulls."""
    asked = df.select(*keys).where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)).distinct()
    answers = resolve(asked)
    new = [c for c in answers.columns if c not in keys]
    return df.drop(*[c for c in new if c in df.columns]).join(answers, list(keys), "left").select(*[c for c in df.columns if c not in new], *new)
