"""What kind of substance a number or a name stands for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels, and parts of names that give a kind away (also within other words).
NATURAL, FRAGRANCE, POLYMER = "natural product / UVCB", "fragrance mixture", "polymer / complex mixture"
MANY, SINGLE = "mixture (multi-component structure)", "single substance"
NAME_PARTS = {
    NATURAL: ("ess", "essential oil", "eo", "abs", "absolute", "extract", "ext", "he", "huile", "resinoid", "oleoresin", "infusion", "balsam", "tincture"),
    FRAGRANCE: ("mix", "compound", "accord", "blend", "fragrance", "perfume", "aroma"),
    POLYMER: ("poly", "polymer", "copolymer", "oligomer", "resin"),
}
BLOCKS = ((90_000, None, NATURAL), (80_000, 89_999, FRAGRANCE), (60_000, 69_999, POLYMER))


def head_block(cas: Column) -> Column:
    """The first block of a number as a whole number; null if there are not three blocks."""
    return F.when(F.rlike(cas, F.lit(r"^\s*\d+\s*-[^-]*-[^-]*$")), F.regexp_extract(cas, r"^\s*(\d+)", 1).try_cast("long"))


def class_of_cas(cas: Column) -> Column:
    """The kind by the number's first block; null where that says nothing."""
    block, out = head_block(cas), F.lit(None).cast("string")
    for low, high, label in reversed(BLOCKS):
        out = F.when((block >= low) & (F.lit(True) if high is None else block <= high), label).otherwise(out)
    return out


def class_of_block(cas: Column) -> Column:
    """The kind by block alone: single substance where the block says nothing, unknown where there is none."""
    return F.when(head_block(cas).isNull(), "unknown").otherwise(F.coalesce(class_of_cas(cas), F.lit(SINGLE)))


def class_of_name(name: Column) -> Column:
    out = F.lit(None).cast("string")
    for label, parts in reversed(NAME_PARTS.items()):
        out = F.when(F.rlike(F.lower(name), F.lit("|".join(parts))), label).otherwise(out)
    return out


def mixture_class(name: Column, cas: Column, smiles: Column) -> Column:
    """By number, else by name, else by parts of the structure, else a single substance."""
    return F.coalesce(class_of_cas(cas), class_of_name(name), F.when(smiles.contains("."), MANY), F.lit(SINGLE))


def registry_status(kind: Column, status: Column) -> Column:
    """The registry's status for a kind: natural products are uvcb, other mixtures mixture, else the status stays."""
    k = F.lower(F.trim(kind))
    return F.when(k == NATURAL.lower(), "uvcb").when(k.isin(FRAGRANCE, POLYMER, MANY, "mixture"), "mixture").otherwise(status)
