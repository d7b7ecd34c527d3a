"""Which columns tables may have: allowlists kept with the tables' versions, rows made fit for them, the fixed export."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chemlake.functions.text import normal_inchikey, text_or_null
from chemlake.operators import canonical
from chemlake.sources import versions

# Names that columns go by, and the governed ones.
SYNONYMS = {
    "CAS_ID": "cas_number", "cas": "cas_number", "SMILES": "smiles", "InChIKey": "inchi_key", "INCHIKEY": "inchi_key", "INCHI_KEY": "inchi_key", "inchikey": "inchi_key", "InChI": "inchi", "INCHI": "inchi",
    "experimental_henry_constant_mol_m3_pa": "henry_constant_mol_m3_Pa_25C",
}
KEY_SYNONYMS = ("InChIKey", "inchikey", "INCHIKEY", "inchiKey")
# Columns of the property export, in order.
EXPORTED = (
    "CAS_ID inchi_key final_inchikey final_inchi final_smiles normalized_input "
    "computed_mw computed_exact_mass computed_clogp computed_tpsa computed_hbd computed_hba computed_rot_bonds computed_ring_count computed_fraction_csp3 computed_molar_refractivity "
    "experimental_logp source_logp computed_boiling_point_c computed_vapor_pressure_pa computed_density_g_ml computed_water_solubility_mg_l "
    "final_boiling_point_c final_vapor_pressure_pa final_water_solubility_mg_l final_density_g_ml "
    "final_mw final_exact_mass final_clogp final_tpsa final_hbd final_hba final_rot_bonds final_ring_count final_fraction_csp3 final_molar_refractivity "
    "experimental_henry_constant_mol_m3_pa source_henry_constant henry_constant_mol_m3_Pa_25C log_henry_constant_mol_m3_Pa_25C "
    "experimental_hsp_delta_d_mpa05 experimental_hsp_delta_p_mpa05 experimental_hsp_delta_h_mpa05 source_hsp "
    "computed_hsp_delta_d_mpa05 computed_hsp_delta_p_mpa05 computed_hsp_delta_h_mpa05 source_hsp_computed timestamp"
).split()


def normal_names(names: Sequence[str]) -> list[str]:
    """Trimmed names without blanks, synonyms as the governed name, each once, in order."""
    return canonical.unique_names([SYNONYMS.get(str(n).strip(), str(n).strip()) for n in names])


@dataclass
class Context:
    """What is governed at a path, all as of one version: the allowlist and the tables."""

    version: int
    allowlist: list[str]
    tables: dict[str, DataFrame]


def open_context(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> Context:
    """The latest version at a path. Where it has no allowlist yet, one of `columns` is committed."""
    number, content = versions.record(spark, path)
    if not content.get("allowlist"):
        if not columns:
            raise ValueError(f"no allowlist at {path}, and no columns to begin with")
        content = content | {"allowlist": normal_names(columns)}
        number = versions.commit(spark, path, number + 1, content)
    return Context(number, content["allowlist"], versions.tables(spark, path, number))


def change_allowlist(spark: SparkSession, path: str, *, add: Sequence[str] = (), drop: Sequence[str] = ()) -> list[str]:
    """The allowlist without some columns and with others at its end, as a new version; nothing new where it stays the same."""
    number, content = versions.record(spark, path)
    before = content.get("allowlist", [])
    gone = {d.strip() for d in drop}
    after = canonical.unique_names([c for c in before if c not in gone] + normal_names(add))
    if after != before:
        versions.commit(spark, path, number + 1, content | {"allowlist": after})
    return after


def sanitize(df: DataFrame, allowlist: Sequence[str], as_of: str, order: str = "_row") -> tuple[DataFrame, DataFrame]:
    """(rows fit for the allowlist, rows without a valid key): a tool's results on their way into the canonical table.

    Columns of one name become one, identifiers are filled from all their names, variants of them go, a missing time is
    `as_of`, and of a key's rows each column's first value by `order` stays.  An allowlist without the key is an error.
    """
    if canonical.KEY not in allowlist:
        raise ValueError(f"the allowlist lacks {canonical.KEY}")
    whole = canonical.collapse_duplicates(df)
    found = canonical.drop_variant_identifiers(canonical.promote_identifiers(whole))
    good, rejected = canonical.split_by_key(found)
    time = F.coalesce("timestamp_updated", F.lit(as_of)) if "timestamp_updated" in good.columns else F.lit(as_of)
    stamped = good.withColumn("timestamp_updated", time)
    placed = stamped if order in stamped.columns else stamped.withColumn(order, F.lit(0))
    return canonical.to_allowlist(canonical.dedupe(placed, order), allowlist), rejected


def export_wide(df: DataFrame) -> DataFrame:
    """The columns of EXPORTED in their order, whatever df has; the key under any of its names, in normal form."""
    key = next((c for c in ("inchi_key", *KEY_SYNONYMS, "final_inchikey") if c in df.columns), None)
    text = F.col(key).cast("string") if key else F.lit(None).cast("string")
    alias = {} if "final_inchikey" in df.columns else {"final_inchikey": text}
    return canonical.to_allowlist(df.withColumns(alias | {"inchi_key": normal_inchikey(text_or_null(text))}), EXPORTED)
