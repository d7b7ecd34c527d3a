"""Physical properties: estimates, final values, the canonical row, winners, and lookups of measured values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from chemlake.functions import units
from chemlake.functions.text import normal_inchikey

# Properties that have an experimental and a computed value.
PROPERTIES = (
    "boiling_point_c", "melting_point_c", "flash_point_c", "autoignition_temp_c", "vapor_pressure_pa", "water_solubility_mg_l",
    "refractive_index", "density_g_ml", "logp", "heat_of_vaporization_kj_mol", "critical_temp_c", "critical_pressure_bar", "mw",
    "exact_mass", "clogp", "tpsa", "hbd", "hba", "rot_bonds", "ring_count", "fraction_csp3", "molar_refractivity", "smiles", "inchi", "inchikey",
)
# What a source counts for, and the sources that count.
WEIGHTS = {"pubchem": 3, "fallback": 2, "computed": 1}
COUNTED = ("source_mw", "source_tpsa", "source_boiling_point_c", "source_vapor_pressure_pa", "source_density_g_ml", "source_water_solubility_mg_l")
# Canonical names of the temperature-bound properties and the columns that hold their temperature.
AT_25 = (
    ("vapor_pressure_Pa_25C", "experimental_vapor_pressure_pa_temperature_c"),
    ("density_g_mL_25C", "experimental_density_g_ml_temperature_c"),
    ("water_solubility_mg_L_25C", "experimental_water_solubility_mg_l_temperature_c"),
)


def _get(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def apply_fallbacks(df: DataFrame) -> DataFrame:
    """Computed values that are null become estimates with source fallback; estimates adds an array of what was estimated."""
    number = lambda n: _get(df, n, "double").cast("double")
    weight, logp = F.coalesce(number("computed_mw"), number("experimental_mw")), F.coalesce(number("computed_clogp"), number("experimental_logp"))
    boiling = units.guess_boiling_point(weight, number("computed_ring_count"))
    boiled = F.coalesce(number("experimental_boiling_point_c"), number("computed_boiling_point_c"), boiling)
    guesses = {"boiling_point_c": boiling, "vapor_pressure_pa": units.guess_vapour_pressure(boiled), "density_g_ml": units.guess_density(weight, logp), "water_solubility_mg_l": units.guess_solubility(logp)}
    out, said = {}, []
    for name, guess in guesses.items():
        used = number(f"computed_{name}").isNull() & guess.isNotNull()
        out[f"computed_{name}"] = F.coalesce(number(f"computed_{name}"), guess)
        out[f"source_{name}"] = F.when(used, "fallback").otherwise(_get(df, f"source_{name}"))
        said.append(F.when(used, name))
    return df.withColumns(out | {"estimates": F.array_compact(F.array(*said))})


def final_fields(df: DataFrame, properties: tuple[str, ...] = PROPERTIES) -> DataFrame:
    """final_* is the experimental value, else the computed one; source_* says which (pubchem, its own, or computed)."""
    out = {}
    for p in properties:
        measured, computed, source = _get(df, f"experimental_{p}"), _get(df, f"computed_{p}"), _get(df, f"source_{p}")
        out[f"final_{p}"] = F.coalesce(measured, computed)
        out[f"source_{p}"] = F.when(measured.isNotNull(), "pubchem").when(computed.isNotNull(), F.coalesce(source, F.lit("computed")))
    return df.withColumns(out)


def temperature_state(df: DataFrame, column: str) -> Column:
    """missing (no such column), blank, 25, not_25 or invalid."""
    if column not in df.columns:
        return F.lit("missing")
    v = units.as_number(F.col(column))
    return F.when(units.is_missing(F.col(column)), "blank").when(v.isNull(), "invalid").when(F.abs(v - 25.0) <= 1.0, "25").otherwise("not_25")


def _all_or_none(df: DataFrame, prefix: str) -> tuple[list[Column], Column, Column]:
    parts = [units.as_number(_get(df, f"{prefix}_hsp_delta_{x}_mpa05")) for x in "dph"]
    whole = parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull()
    some = parts[0].isNotNull() | parts[1].isNotNull() | parts[2].isNotNull()
    return [F.when(whole, p) for p in parts], whole, ~whole & some


_WITH_UNITS = ("final_boiling_point_c", "final_melting_point_c", "final_vapor_pressure_pa", "final_density_g_ml", "final_water_solubility_mg_l")


def canonical_rows(df: DataFrame) -> DataFrame:
    """Rows with a key in canonical units, with logarithms, warnings, review flag, sources and the ranks that pick winners.

    Values stay where a warning is due: for a strange unit, a temperature other than 25 C, or an incomplete
    triplet of solubility parameters, of which none is kept.
    """
    g = lambda n: _get(df, n)
    weight = units.as_number(g("final_mw"))
    logp, clogp = units.as_number(g("final_logp")), units.as_number(g("final_clogp"))
    df = units.split_units(df, *[c for c in _WITH_UNITS if c in df.columns])
    parts = lambda n: (_get(df, f"{n}_number").cast("double"), _get(df, f"{n}_unit"))
    boiling, melting = units.to_celsius(*parts("final_boiling_point_c")), units.to_celsius(*parts("final_melting_point_c"))
    pressure, density = units.to_pascal(*parts("final_vapor_pressure_pa")), units.to_g_ml(*parts("final_density_g_ml"))
    solubility = units.to_mg_l(*parts("final_water_solubility_mg_l"), weight)
    values = {"vapor_pressure_Pa_25C": pressure["value"], "density_g_mL_25C": density["value"], "water_solubility_mg_L_25C": solubility["value"]}
    flags = F.array_compact(F.array(*[F.when(values[n].isNotNull() & temperature_state(df, c).isin("missing", "not_25", "invalid"), F.concat(F.lit(f"{n}:"), temperature_state(df, c))) for n, c in AT_25]))
    henry = F.coalesce(units.as_number(g("experimental_henry_constant_mol_m3_pa")), units.as_number(g("henry_constant_mol_m3_pa")))
    measured, has_measured, measured_bad = _all_or_none(df, "experimental")
    computed, has_computed, computed_bad = _all_or_none(df, "computed")
    own = F.when(~units.is_missing(g("warnings")), F.trim("warnings")) if "warnings" in df.columns else F.lit(None).cast("string")
    warnings = F.array_compact(
        F.array(
            own, boiling["warning"], melting["warning"], pressure["warning"], density["warning"], solubility["warning"],
            F.when(F.size(flags) > 0, F.concat(F.lit("25C-check: "), F.array_join(flags, " | "))),
            F.when(measured_bad, "HSP measured incomplete (all-or-none enforced)"), F.when(computed_bad, "HSP computed incomplete (all-or-none enforced)"),
        )
    )
    logp_source = F.when(logp.isNotNull(), g("source_logp")).when(clogp.isNotNull(), g("source_clogp"))
    sources = [g(c) for c in COUNTED] + [logp_source]
    distinct = F.array_distinct(F.filter(F.transform(F.array(*sources), lambda s: F.trim(s)), lambda s: s.isNotNull() & (s != "")))
    low = [F.lower(F.trim(s)) for s in sources]
    count = sum((F.when(s == "pubchem", 1).otherwise(0) for s in low), F.lit(0))
    score = sum((F.coalesce(*[F.when(s == name, w) for name, w in WEIGHTS.items()], F.lit(0)) for s in low), F.lit(0))
    named = F.when(F.lower(F.trim(g("identifier_type"))) == "name", g("normalized_input"))
    triplet = lambda p, cs: [c.alias(f"{p}_hsp_delta_{x}_mpa05") for x, c in zip("dph", cs, strict=True)]
    return df.where(~units.is_missing(F.col("final_inchikey"))).select(
        F.col("final_inchikey").alias("inchi_key"), g("CAS_ID").alias("cas_number"), g("final_smiles").alias("smiles"), named.alias("name_preferred"),
        weight.alias("molecular_weight_g_mol"), F.coalesce(logp, clogp).alias("logP_octanol_water"), units.as_number(g("final_tpsa")).alias("topological_polar_surface_area_A2"),
        F.lit(None).cast("int").alias("num_heavy_atoms"), pressure["value"].alias("vapor_pressure_Pa_25C"), units.log10_positive(pressure["value"]).alias("log_vapor_pressure_Pa_25C"),
        henry.alias("henry_constant_mol_m3_Pa_25C"), units.log10_positive(henry).alias("log_henry_constant_mol_m3_Pa_25C"), g("source_henry_constant").alias("source_henry_constant"),
        boiling["value"].alias("boiling_point_C"), melting["value"].alias("melting_point_C"), solubility["value"].alias("water_solubility_mg_L_25C"),
        units.log10_positive(solubility["value"]).alias("log_water_solubility_mg_L_25C"), density["value"].alias("density_g_mL_25C"),
        *triplet("experimental", measured), F.when(has_measured, g("source_hsp")).alias("source_hsp"), *triplet("computed", computed), F.when(has_computed, g("source_hsp_computed")).alias("source_hsp_computed"),
        F.lit(None).cast("string").alias("physical_state_25C"), F.lit(None).cast("boolean").alias("is_volatile"), (F.size(warnings) > 0).alias("needs_review"),
        F.get(distinct, F.lit(0)).alias("source_primary"), F.get(distinct, F.lit(1)).alias("source_secondary"), F.lit(None).cast("double").alias("confidence_score"),
        F.when(F.size(warnings) > 0, F.array_join(warnings, " ; ")).alias("warnings"), g("timestamp").alias("timestamp_updated"),
        F.col("_row"), count.alias("rank_pubchem_count"), score.alias("rank_score_sum"),
    )


def judge(canonical: DataFrame) -> DataFrame:
    """canonical rows with `selected`: of a key the most pubchem values win, then score, latest time, lowest row."""
    time = F.col("timestamp_updated").try_cast("timestamp")
    window = Window.partitionBy("inchi_key").orderBy(F.desc("rank_pubchem_count"), F.desc("rank_score_sum"), F.desc_nulls_last(time), F.asc("_row"))
    return canonical.withColumn("selected", F.row_number().over(window) == 1)


def winners(canonical: DataFrame) -> DataFrame:
    """One canonical row per key; the losers need no window: only the best of each partition is shuffled."""
    return judge(canonical).where("selected").drop("selected", "_row", "rank_pubchem_count", "rank_score_sum")


def audit(df: DataFrame, canonical: DataFrame) -> DataFrame:
    """Every input row with why it was taken or not: winner, loser, missing_inchi_key."""
    judged = judge(canonical).select("inchi_key", "_row", "selected", "rank_pubchem_count", "rank_score_sum", F.when(F.col("selected"), "winner").otherwise("loser").alias("reason"))
    lost = df.where(units.is_missing(F.col("final_inchikey"))).select(F.lit(None).cast("string").alias("inchi_key"), "_row", F.lit(False).alias("selected"), F.lit(None).cast("int").alias("rank_pubchem_count"), F.lit(None).cast("int").alias("rank_score_sum"), F.lit("missing_inchi_key").alias("reason"))
    return judged.unionByName(lost)


def henry_constants(rows: DataFrame, species: DataFrame, henry: DataFrame) -> DataFrame:
    """rows with henry_constant, its logarithm and source, of the lowest henry id of their key."""
    first = henry.join(species.select(F.col("id").alias("species_id"), normal_inchikey(F.col("inchikey")).alias("_k")), "species_id").where("_k IS NOT NULL").groupBy("_k").agg(F.min_by("hominus", "id").alias("_h"))
    value = units.power_notation(F.col("_h").cast("string"))
    joined = rows.withColumn("_q", normal_inchikey(F.col("inchi_key"))).join(first, F.col("_q") == F.col("_k"), "left")
    return joined.withColumns({"henry_constant_mol_m3_pa": value, "log_henry_constant": F.when(value > 0, F.log10(value)), "source_henry_constant": F.when(value.isNotNull(), "henry table")}).drop("_q", "_k", "_h")


def solubility_parameters(rows: DataFrame, measured: DataFrame) -> DataFrame:
    """rows with the first complete measured triplet of their key."""
    parts = {x: units.quantity_mpa05(F.col(f"d{x}")) for x in "dph"}
    table = measured.select(normal_inchikey(F.col("inchi_key")).alias("_k"), "_row", *[v.alias(f"_{x}") for x, v in parts.items()]).where("_k IS NOT NULL AND _d IS NOT NULL AND _p IS NOT NULL AND _h IS NOT NULL")
    first = table.groupBy("_k").agg(*[F.min_by(f"_{x}", "_row").alias(f"experimental_hsp_delta_{x}_mpa05") for x in "dph"])
    return rows.withColumn("_q", normal_inchikey(F.col("inchi_key"))).join(first, F.col("_q") == F.col("_k"), "left").withColumn("source_hsp", F.when(F.col("_k").isNotNull(), "measured table")).drop("_q", "_k")


def computed_solubility_parameters(methods: DataFrame) -> DataFrame:
    """(cas, d, p, h) in MPa^0.5 of the first method, by rank, that has all three (given in Pa^0.5)."""
    whole = methods.where("d IS NOT NULL AND p IS NOT NULL AND h IS NOT NULL")
    return whole.groupBy("cas").agg(*[(F.min_by(x, "method_rank") / 1000.0).alias(f"computed_hsp_delta_{x}_mpa05") for x in "dph"])
