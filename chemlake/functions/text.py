"""Text, identifier and date functions on columns."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from chemlake.functions.sql_text import api

# Texts that stand for a missing value.
MISSING = ("", "na", "n/a", "none", "null", "nan")
INCHIKEY = "^[A-Z]{14}-[A-Z]{10}-[A-Z]$"


def squeeze(c: Column) -> Column:
    """White space (Unicode) run together to one space, and trimmed; null is ''."""
    x = api(c)
    return x.trim(x.regexp_replace(x.coalesce(c, x.lit("")), x.lit(r"(?U)\s+"), x.lit(" ")))


def text_or_null(c: Column) -> Column:
    """Trimmed text; the texts that stand for a missing value become null."""
    t = F.trim(c)
    return F.when(~F.lower(t).isin(*MISSING), t)


def text_or_empty(c: Column) -> Column:
    """Trimmed text; null and the texts nan, none and null become ''."""
    t = F.coalesce(F.trim(c), F.lit(""))
    return F.when(F.lower(t).isin("nan", "none", "null"), "").otherwise(t)


def normal_inchikey(c: Column) -> Column:
    return F.upper(F.replace(text_or_null(c), F.lit(" "), F.lit("")))


def is_inchikey(c: Column) -> Column:
    return F.coalesce(F.rlike(normal_inchikey(c), F.lit(INCHIKEY)), F.lit(False))


def first_inchikey(*columns: Column) -> Column:
    """The first valid InChIKey of several columns."""
    return F.coalesce(*[F.when(is_inchikey(c), normal_inchikey(c)) for c in columns])


def _folded(ascii_only: bool):
    @F.arrow_udf("string")
    def fold(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            if t is not None and not t.isascii():
                t = unicodedata.normalize("NFD", t)
                t = t.encode("ascii", "ignore").decode() if ascii_only else "".join(c for c in t if unicodedata.category(c) != "Mn")
            out.append(t)
        return pa.array(out, pa.string())

    return fold


def without_accents(c: Column) -> Column:
    """Decomposed text without combining marks; other letters stay. ASCII texts go to Python as nulls."""
    beyond = F.rlike(c, F.lit(r"[^\x00-\x7F]"))
    return F.when(beyond, _folded(False)(F.when(beyond, c))).otherwise(c)


def to_ascii(c: Column) -> Column:
    """Decomposed text without anything beyond ASCII."""
    beyond = F.rlike(c, F.lit(r"[^\x00-\x7F]"))
    return F.when(beyond, _folded(True)(F.when(beyond, c))).otherwise(c)


def property_name(c: Column) -> Column:
    """A chemical name for property lookup: no accents, one space, lower case."""
    return F.lower(squeeze(without_accents(c)))


def resolver_name(c: Column) -> Column:
    """A chemical name for the resolver: one space, lower case, ASCII, no closing punctuation."""
    return F.regexp_replace(to_ascii(F.lower(squeeze(c))), "[,.;:]+$", "")


def entity_name(c: Column) -> Column:
    """A name for comparing entities: lower case, letters a-z, digits and spaces only."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^a-z0-9\s]", ""))


def normal_smiles(c: Column) -> Column:
    return F.trim(c)


def cut_smiles(c: Column) -> Column:
    """A SMILES up to the first pipe."""
    return F.substring_index(c, "|", 1)


def normal_inchi(c: Column) -> Column:
    """A trimmed InChI with its prefix."""
    t = F.trim(c)
    return F.when(t.startswith("1S/") | t.startswith("1/"), F.concat(F.lit("InChI="), t)).otherwise(t)


def heavy_atoms_guess(c: Column) -> Column:
    """Upper-case letters of a SMILES (an aromatic c counts 0, Cl 1)."""
    return F.length(F.regexp_replace(c, "[^A-Z]", ""))


def looks_like_smiles(c: Column) -> Column:
    """No space, only SMILES characters, and a bond mark or a digit."""
    return F.rlike(c, F.lit(r"^[A-Za-z0-9@+\-\[\]\(\)=#$\\/%.:*]+$")) & F.rlike(c, F.lit("[=#@0-9]"))


def identifier_type(c: Column) -> Column:
    """cas, inchikey, inchi, smiles or name; null for null."""
    from chemlake.functions.cas import property_cas

    t = F.trim(c)
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(t == "", "name")
        .when(F.rlike(t, F.lit(r"^\d{2,7}-\d{2}-\d$")) & property_cas(t).isNotNull(), "cas")
        .when(F.rlike(t, F.lit(r"(?i)^[A-Z]{14}-[A-Z]{10}-[A-Z]$")), "inchikey")
        .when(F.lower(t).startswith("inchi=") | F.rlike(t, F.lit("^1S?/")), "inchi")
        .when(looks_like_smiles(t), "smiles")
        .otherwise("name")
    )


def normal_identifier(c: Column, kind: Column) -> Column:
    """An identifier in the normal form of its kind."""
    from chemlake.functions.cas import property_cas

    return (
        F.when(kind == "cas", property_cas(c))
        .when(kind == "inchikey", F.upper(F.trim(c)))
        .when(kind == "inchi", normal_inchi(c))
        .when(kind == "smiles", normal_smiles(c))
        .when(kind == "name", property_name(c))
        .otherwise(F.trim(c))
    )
