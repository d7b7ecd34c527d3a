"""Completing structures: canonical SMILES, InChIKey and weight out of whatever a row has; counts of patterns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chemlake.functions.canonical_smiles import canonical_smiles
from chemlake.functions.inchi import molecule_of_inchi
from chemlake.functions.inchikey import inchikey
from chemlake.functions.patterns import pattern_count
from chemlake.functions.smiles import molecule
from chemlake.functions.text import cut_smiles
from chemlake.operators.descriptors import weight
from chemlake.operators.spread import distinct_rows

# Named patterns of functional groups and motifs.
PATTERNS = {
    "Aldehyde": "[CX3H1](=O)[#6]",
    "Ketone": "[#6][CX3](=O)[#6]",
    "Ester": "[#6][CX3](=O)[OX2H0][#6]",
    "CarboxylicAcid": "[CX3](=O)[OX2H1]",
    "AcrylateEster": "[CH2]=[CH]C(=O)O[#6]",
    "MethacrylateEster": "C=C(C)C(=O)O[#6]",
    "Ether": "[O;D2]([#6;!$(C=O)])([#6;!$(C=O)])",
    "Ether_Aliphatic": "[O;D2;!R]([CX4;!R])[CX4;!R]",
    "Ether_Aromatic": "[O;D2]([c])[c]",
    "Ether_Mixed": "[O;D2]([c])[CX4;!R]",
    "Ether_Ring": "[O;D2;R]",
    "Nitrile": "[CX2]#N",
    "Pyridine": "n1ccccc1",
    "Thiazole": "c1nccs1",
    "Indole": "c1ccc2[nH,n]ccc2c1",
    "Furan": "o1cccc1",
    "Thiophene": "s1cccc1",
    "ArylOAlkylEther": "[O;D2]([c])([CX4;!a])",
    "DiarylEther": "[O;D2]([c])([c])",
    "Isoprenyl": "C=C(C)C",
    "OH": "[OX2H]-[C,c;!$(C=O)]",
}


def complete_structures(df: DataFrame, smiles: str = "smiles", inchi: str = "inchi") -> DataFrame:
    """df with smiles in canonical form, inchi, inchi_key, mw and structure_error.

    The molecule is that of the SMILES, or where this cannot be read that of the InChI; the error says what failed on the
    way, even where the second one helps.  The InChI stays where it is of this molecule, and gives the key; another one
    becomes ''.  Without a molecule both texts stay as they are, the key is '' and the weight null.  Null counts as ''.
    Each distinct pair of texts is read once.
    """
    kept = [F.col(c) for c in df.columns if c not in (smiles, inchi, "inchi_key", "mw", "structure_error")]
    text, spelled = F.coalesce(cut_smiles(F.col(smiles)), F.lit("")), F.coalesce(F.trim(F.translate(F.col(inchi), "\u00a0\ufeff", " ")), F.lit(""))
    rows = df.select(F.struct(*kept).alias("_row"), F.coalesce(smiles, F.lit("")).alias("_smiles"), F.coalesce(inchi, F.lit("")).alias("_inchi"), text.alias("_text"), spelled.alias("_spelled"))
    named = F.startswith("_spelled", F.lit("InChI="))
    each = distinct_rows(rows, "_text", "_spelled")
    read = each.withColumns({"_of_smiles": molecule(F.when(F.col("_text") != "", F.col("_text"))), "_of_inchi": molecule_of_inchi(F.when(named, F.col("_spelled")))})
    found = read.withColumn("molecule", F.coalesce("_of_smiles", "_of_inchi"))
    spelt = found.withColumns({"_canonical": canonical_smiles(F.col("molecule")), "_same": F.when(F.col("_of_smiles").isNotNull(), canonical_smiles(F.col("_of_inchi")))})
    error = (
        F.when((F.col("_text") != "") & F.col("_of_smiles").isNull(), "smiles_parse_failed")
        .when(F.col("_of_smiles").isNotNull(), "")
        .when(~named, "inchi_not_attempted_not_inchi")
        .when(F.col("_of_inchi").isNull(), "inchi_parse_failed")
        .otherwise("")
    )
    known = F.col("molecule").isNotNull()
    mine = F.col("_of_smiles").isNull() | F.col("_same").eqNullSafe(F.col("_canonical"))
    ours = F.when(known, F.when(mine, F.col("_spelled")).otherwise(""))
    completed = spelt.select("_text", "_spelled", "_canonical", ours.alias("_ours"), F.coalesce(inchikey(ours), F.lit("")).alias("_key"), weight().alias("_weight"), error.alias("_error"))
    return rows.join(completed, ["_text", "_spelled"]).select(
        "_row.*", F.coalesce("_canonical", "_smiles").alias(smiles), F.coalesce("_ours", "_inchi").alias(inchi), F.col("_key").alias("inchi_key"), F.col("_weight").alias("mw"), F.col("_error").alias("structure_error"),
    )


def count_patterns(df: DataFrame, patterns: Mapping[str, str] = PATTERNS, smiles: str = "smiles") -> DataFrame:
    """df once for each pattern that its molecule holds: pattern, n (different sets of atoms). Cells that are no molecule give no row."""
    # each distinct text is read and counted once; a filter on what is counted would be moved before that, onto every row
    read = distinct_rows(df.select(F.col(smiles).alias("_s")).where("_s IS NOT NULL"), "_s").withColumn("molecule", molecule(F.col("_s")))
    counts = F.array(*[F.struct(F.lit(name).alias("pattern"), pattern_count(text).cast("int").alias("n")) for name, text in patterns.items()])
    held = read.select("_s", F.filter(counts, lambda c: c["n"] > 0).alias("_counts"))
    spread = df.join(held, F.col(smiles) == F.col("_s")).select(*df.columns, F.explode_outer("_counts").alias("_c"))
    return spread.where("_c IS NOT NULL").select(*df.columns, "_c.pattern", "_c.n")
