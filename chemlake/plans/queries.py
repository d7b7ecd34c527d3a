"""Registered queries: every operator over a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chemlake.functions import cas, mixtures, smiles, text, units
from chemlake.operators import identifiers as identifiers_of
from chemlake.operators import canonical, descriptors, governance, ingest, molecules, properties, provider, registry, resolver, structures, tokens
from chemlake.plans import inputs, known_molecules, known_structures
from chemlake.plans.inputs import derive
from chemlake.sources import dumps, tables

AS_OF = "2024-06-01T00:00:00Z"
#: Molecules that keys are mapped to.
MOLECULES = [*known_molecules.KNOWN, "not a smiles"]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cas_tokens(spark, d):
    """One row per token of every cell."""
    return tokens.explode_tokens(derive(spark, d, inputs.CELLS, heavy=True)).select("row", "pos", "token")


def cas_validity(spark, d):
    """What each dialect makes of every raw number."""
    r = F.col("raw")
    return derive(spark, d, inputs.RAW).select(
        "key", cas.valid(r).alias("cleaner_valid"), cas.resolver_cas(r)["cas"].alias("resolver_cas"), cas.resolver_valid(r).alias("resolver_valid"),
        cas.property_cas(r).alias("property_cas"), cas.ingest_cas(r).alias("ingest_cas"), cas.ingest_checksum_holds(cas.ingest_cas(r)).alias("ingest_ok"), cas.all_zero(r).alias("all_zero"),
    )


def cas_recovered(spark, d):
    """Numbers recovered from dates, bare digits and missing check digits."""
    r = F.trim("raw")
    return derive(spark, d, inputs.RAW).select("key", cas.from_date(r).alias("from_date"), cas.from_digits(F.regexp_replace(r, "[^0-9]", "")).alias("from_digits"), cas.with_check_digit(r).alias("with_check_digit"), cas.date_like(r).alias("date_like"))


def cas_swaps(spark, d):
    """Valid numbers that one swap of neighbours gives."""
    return derive(spark, d, inputs.RAW).select("key", F.array_join(F.array_sort(F.filter(cas.swaps(F.col("raw")), cas.valid)), ",").alias("swapped"))


def cas_evidence(spark, d):
    """Numbers known of each code."""
    by_code, _ = tokens.evidence(tokens.explode_tokens(derive(spark, d, inputs.CELLS, heavy=True)))
    return by_code


def cas_repair(spark, d):
    """Every token with its repair and status."""
    return tokens.repair(tokens.explode_tokens(derive(spark, d, inputs.CELLS, heavy=True)))


def cas_fixed_cells(spark, d):
    """Every cell with its tokens repaired."""
    cells = derive(spark, d, inputs.CELLS, heavy=True)
    return tokens.fixed_cells(cells, tokens.repair(tokens.explode_tokens(cells)))


def cas_first_tokens(spark, d):
    """The first token of every cell."""
    cells = derive(spark, d, inputs.CELLS, heavy=True)
    return tokens.first_tokens(cells, tokens.repair(tokens.explode_tokens(cells)))


def cas_exploded_table(spark, d):
    """The customer's table of repaired numbers."""
    cells = derive(spark, d, inputs.CELLS, heavy=True)
    return tokens.exploded_table(tokens.repair(tokens.explode_tokens(cells)), "c1", AS_OF)


def mixture_class(spark, d):
    """The kind of every part by number, name and structure."""
    p = _t(spark, d, "part").select("p_partkey", F.concat((F.col("p_partkey") * 97 % 99000 + 100).cast("string"), F.lit("-00-1")).alias("cas"), F.col("p_name").alias("name"), F.when(F.col("p_partkey") % 5 == 0, "C.C").otherwise("CC").alias("smiles"))
    kind = mixtures.mixture_class(F.col("name"), F.col("cas"), F.col("smiles"))
    return p.select("p_partkey", kind.alias("kind"), mixtures.class_of_block(F.col("cas")).alias("block_kind"), mixtures.registry_status(kind, F.lit("valid")).alias("status"))


def identifiers(spark, d):
    """Type and normal form of identifiers of several kinds."""
    i = derive(spark, d, f"""SELECT c_custkey AS key, CASE c_custkey % 6 WHEN 0 THEN {inputs.number("c_custkey")} WHEN 1 THEN lower({inputs.inchikey("c_custkey")}) WHEN 2 THEN '1S/CH4/h1H4' WHEN 3 THEN 'C1CC1'
        WHEN 4 THEN ' ' || c_name || ' ' ELSE 'CCO' END AS id FROM {{customer}}""")
    kind = text.identifier_type(F.col("id"))
    return i.select("key", kind.alias("kind"), text.normal_identifier(F.col("id"), kind).alias("normal"))


def ascii_names(spark, d):
    """Normal names of the whole text of every document."""
    whole = F.col("text")
    return _t(spark, d, "documents").select("doc_id", text.resolver_name(whole).alias("resolver_name"), F.length(text.without_accents(whole)).cast("long").alias("n"), text.entity_name(whole).alias("entity_name"))


def _known(spark, d):
    return derive(spark, d, inputs.KNOWN)


def _merged(spark, d):
    return registry.upsert(_known(spark, d), derive(spark, d, inputs.INCOMING), AS_OF)


def db2_upsert(spark, d):
    """The registry after a merge."""
    return _merged(spark, d).registry


def db2_audit(spark, d):
    """Events of the merge."""
    return _merged(spark, d).audit.drop("timestamp_utc")


def db2_rejected(spark, d):
    """Rows that the merge rejects."""
    return _merged(spark, d).rejected.select("cas_input", "rejected_reason")


def db2_summary(spark, d):
    """Counts of the merged registry."""
    return registry.summary(_merged(spark, d).registry)


def db1_dedupe(spark, d):
    """One row per key, first values first."""
    return canonical.dedupe(derive(spark, d, inputs.PROPERTIES))


def db1_rejects(spark, d):
    """Rows whose key is none."""
    return canonical.split_by_key(derive(spark, d, inputs.PROPERTIES))[1].select("_row", "inchi_key")


_ALLOWED = ["inchi_key", "inchi", "smiles", "computed_mw", "experimental_logp", "alcohol_count"]


def db1_upsert(spark, d):
    """Rows of even numbers merged over those of odd ones by the property tool."""
    rows = derive(spark, d, inputs.PROPERTIES)
    return canonical.upsert(rows.where("_row % 2 = 1"), rows.where("_row % 2 = 0"), "properties", _ALLOWED)


def db1_merge_fields(spark, d):
    """Field-wise merge of two one-row-per-key tables."""
    rows = derive(spark, d, inputs.PROPERTIES)
    old, new = (canonical.dedupe(rows.where(f"_row % 2 = {k}")).withColumn("timestamp_updated", F.lit(t)) for k, t in ((1, "old"), (0, "new")))
    return canonical.merge_fields(old, new)


def promoted_keys(spark, d):
    """Keys promoted from several columns."""
    rows = derive(spark, d, inputs.PROPERTIES).withColumn("final_inchikey", F.when(F.col("_row") % 34 == 0, F.lit("ABCDEFGHIJKLMN-OPQRSTUVWX-Y")))
    return canonical.promote_identifiers(rows).select("_row", "inchi_key", "inchi", "smiles")


def customer_feed(spark, d):
    """The latest usable row of each customer and number."""
    return tokens.customer_feed(derive(spark, d, inputs.SEEN).withColumnRenamed("cas_number_normalized", "cas"))


def customer_map(spark, d):
    """The customer map after its feed is merged in."""
    seen = derive(spark, d, inputs.SEEN)
    return tokens.upsert_customer_map(seen.where("code % 2 = 1"), seen.where("code % 2 = 0"))


def _view(spark, d):
    return canonical.cas_view(_known(spark, d), canonical.dedupe(derive(spark, d, inputs.PROPERTIES)))


def cas_view(spark, d):
    """Registry with properties."""
    return _view(spark, d).withColumn("alcohol_count", F.col("alcohol_count").cast("double"))


def cas_view_exportable(spark, d):
    """The rows of the view that may be joined."""
    return canonical.exportable(_view(spark, d)).select("cas_number_normalized", "inchi_key", "computed_mw")


def cas_view_overlay(spark, d):
    """The view with one customer's columns."""
    return canonical.overlay(_view(spark, d), tokens.upsert_customer_map(derive(spark, d, inputs.SEEN).limit(0), derive(spark, d, inputs.SEEN)), "c3").select("cas_number_normalized", "inchi_key", "customer_id", "timestamp_seen_utc", "name")


def resolver_cache(spark, d):
    """The registry as a cache: the last eligible row of a number."""
    return resolver.registry_cache(derive(spark, d, inputs.INCOMING))


def resolver_winner(spark, d):
    """The best hit of every cell, from cache and two providers."""
    cells = derive(spark, d, inputs.CELLS, heavy=True)
    provider = lambda m, k: derive(spark, d, f"SELECT {inputs.number('p_partkey')} AS cas, 'C{m}' AS smiles, '' AS inchi, {inputs.inchikey('p_partkey')} AS inchi_key FROM {{part}} WHERE p_partkey % {m} = {k}")
    return resolver.resolve(cells, resolver.registry_cache(_known(spark, d).withColumn("_row", F.lit(0))), [("pubchem", provider(2, 0)), ("cactus", provider(3, 0))])


def name_rank(spark, d):
    """Candidates of names by score."""
    c = derive(spark, d, """SELECT 'né' || CAST(p_partkey % 50 AS STRING) AS name, 'né' || CAST(p_partkey % 50 AS STRING) AS normal, p_partkey AS cid, CASE p_partkey % 4 WHEN 0 THEN 'CCO' WHEN 1 THEN 'CC.Cl' WHEN 2 THEN '[Na]O' ELSE 'CCCCCCO' END AS smiles,
        repeat('A-', CAST(p_partkey % 5 AS INT)) || 'B' || repeat('+', CAST(p_partkey % 3 AS INT)) AS inchi_key, CASE WHEN p_partkey % 3 = 0 THEN 'NÉ' WHEN p_partkey % 3 = 1 THEN 'ne' ELSE 'n' END || CAST(p_partkey % 70 AS STRING) AS one, 'other' AS two FROM {part}""").withColumn("synonyms", F.array("one", "two"))
    return resolver.rank_names(c).select("name", "cid", F.round("score", 6).alias("score"), "rank")


def cache_ttl(spark, d):
    """Cached answers that still hold."""
    c = derive(spark, d, "SELECT event_id, ts AS updated_utc, CASE event_id % 3 WHEN 0 THEN 'success' WHEN 1 THEN 'negative' ELSE 'temporary' END AS status FROM {events}")
    return resolver.live_answers(c, F.lit("2024-01-20 00:00:00").cast("timestamp")).select("event_id", "status")


def unit_conversion(spark, d):
    """Values in canonical units with warnings."""
    m = units.split_units(derive(spark, d, inputs.MEASURED), "pressure", "temperature", "density", "solubility")
    parts = lambda n: (F.col(f"{n}_number"), F.col(f"{n}_unit"))
    p, t, g, s = units.to_pascal(*parts("pressure")), units.to_celsius(*parts("temperature")), units.to_g_ml(*parts("density")), units.to_mg_l(*parts("solubility"), F.col("weight"))
    return m.select("key", p["value"].alias("pa"), p["warning"].alias("pa_warning"), F.round(t["value"], 6).alias("celsius"), g["value"].alias("g_ml"), F.round(s["value"], 6).alias("mg_l"), s["warning"].alias("mg_l_warning"), F.round(units.log10_positive(p["value"]), 9).alias("log_pa"))


def fallback_estimates(spark, d):
    """Estimates where nothing was computed."""
    p = _t(spark, d, "part").select("p_partkey", F.col("p_retailprice").alias("computed_mw"), (F.col("p_size") / 8.0).alias("computed_clogp"), F.when(F.col("p_partkey") % 3 == 0, F.lit(80.0)).alias("experimental_boiling_point_c"), (F.col("p_partkey") % 4).cast("int").alias("computed_ring_count"))
    out = properties.apply_fallbacks(p)
    return out.select("p_partkey", "computed_density_g_ml", "computed_boiling_point_c", F.round("computed_vapor_pressure_pa", 1).alias("vapour"), "computed_water_solubility_mg_l", "source_density_g_ml", F.array_join("estimates", ",").alias("estimates"))


def final_fields(spark, d):
    """Experimental before computed values, with their source."""
    p = derive(spark, d, """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS STRING) END AS experimental_mw, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size + 1 AS STRING) END AS computed_mw,
        CASE WHEN p_partkey % 5 = 0 THEN 'fallback' END AS source_mw FROM {part}""")
    return properties.final_fields(p, ("mw",)).select("p_partkey", "final_mw", "source_mw")


def canonical_rows(spark, d):
    """Canonical property rows."""
    c = properties.canonical_rows(derive(spark, d, inputs.WIDE))
    return c.select("_row", "inchi_key", "cas_number", "name_preferred", F.col("logP_octanol_water").alias("logp"), F.col("vapor_pressure_Pa_25C").alias("pa"), F.round("boiling_point_C", 6).alias("boiling"), "needs_review", "source_primary", "source_secondary", "warnings", "rank_pubchem_count", "rank_score_sum")


def canonical_winners(spark, d):
    """One canonical row per key."""
    return properties.winners(properties.canonical_rows(derive(spark, d, inputs.WIDE))).select("inchi_key", "cas_number", "timestamp_updated")


def canonical_audit(spark, d):
    """Why each wide row was taken or not."""
    wide = derive(spark, d, inputs.WIDE)
    return properties.audit(wide, properties.canonical_rows(wide)).select("_row", "selected", "reason")


def henry_lookup(spark, d):
    """Henry constants of property keys, the lowest id of a key first."""
    species = derive(spark, d, f"SELECT s_suppkey AS id, lower({inputs.inchikey('s_suppkey')}) AS inchikey FROM {{supplier}}")
    constants = derive(spark, d, "SELECT p_partkey AS id, p_partkey % 120 AS species_id, CAST(p_size AS STRING) || '.5&times;10<sup>&#8722;' || CAST(p_partkey % 6 AS STRING) || '</sup>' AS hominus FROM {part}")
    rows = derive(spark, d, f"SELECT c_custkey, {inputs.inchikey('c_custkey')} AS inchi_key FROM {{customer}}")
    return properties.henry_constants(rows, species, constants).select("c_custkey", "henry_constant_mol_m3_pa", F.round("log_henry_constant", 9).alias("log_henry"), "source_henry_constant")


def solubility_parameters(spark, d):
    """Measured triplets of property keys, the first complete one of a key."""
    table = derive(spark, d, f"""SELECT p_partkey AS _row, {inputs.inchikey("(p_partkey % 90)")} AS inchi_key, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'Quantity[' || CAST(p_size AS STRING) || '.5, Sqrt["Megapascals"]]' END AS dd,
        CAST(p_size AS STRING) AS dp, '3.25' AS dh FROM {{part}}""")
    rows = derive(spark, d, f"SELECT c_custkey, {inputs.inchikey('c_custkey')} AS inchi_key FROM {{customer}}")
    return properties.solubility_parameters(rows, table).drop("inchi_key")


def computed_parameters(spark, d):
    """The first method that has a whole triplet."""
    m = derive(spark, d, f"SELECT {inputs.number('(l_partkey % 500)')} AS cas, l_orderkey * 8 + l_linenumber AS method_rank, CASE WHEN l_linenumber % 2 = 0 THEN l_quantity * 1000 END AS d, l_quantity * 100 AS p, 7000.0 AS h FROM {{lineitem}}")
    return properties.computed_solubility_parameters(m)


def page_facts(spark, d):
    """Title, class, name and numbers of every page."""
    h = F.col("html")
    return derive(spark, d, inputs.PAGES).select("page_id", ingest.title(h).alias("title"), ingest.page_class(h).alias("kind"), ingest.page_name(h).alias("name"), F.array_join(cas.numbers_in(h), ",").alias("numbers"), ingest.last_page(h).alias("last_page"))


def page_discovery(spark, d):
    """Where every page and number goes."""
    pages = derive(spark, d, f"""SELECT page_id, CAST(CASE WHEN page_id % 10 = 0 THEN 404 ELSE 200 END AS INT) AS status, CASE WHEN page_id % 10 = 1 THEN 'x' ELSE '<title>Rose - oil</title> ' ||
        CASE WHEN page_id % 10 = 2 THEN '' ELSE {inputs.number("(page_id % 60)")} || ', ' || {inputs.number("(page_id % 60 + 1)")} END END AS html FROM {{pages}}""")
    reference = derive(spark, d, f"SELECT {inputs.number('s_suppkey')} AS cas FROM {{supplier}} WHERE s_suppkey % 2 = 0")
    return ingest.discover(pages, reference)


def _entities(spark, d):
    rows = derive(spark, d, f"""SELECT l_orderkey % 1000 AS rw_id, l_orderkey * 8 + l_linenumber AS _row, {inputs.number("(l_partkey % 200)")} AS cas,
        CASE l_linenumber WHEN 1 THEN 'alpha' WHEN 2 THEN '12-3' WHEN 3 THEN 'Rose oil' WHEN 4 THEN 'Ethyl name, 7' ELSE 'Methyl  name' END AS name, CAST(l_shipdate AS STRING) AS discovered_at FROM {{lineitem}}""")
    return ingest.entities(rows)


def entities(spark, d):
    """Entities of page ids."""
    return _entities(spark, d).select("rw_id", F.array_join("cas_list", ",").alias("cas_list"), "name", "discovered_at", "entity_class")


def entity_shadows(spark, d):
    """Entities that a reference list has already."""
    reference = derive(spark, d, f"SELECT {inputs.number('(s_suppkey % 20)')} AS cas, CASE WHEN s_suppkey = 1 THEN 'ROSE-OIL!' ELSE 'zzz' END AS name FROM {{supplier}}")
    return ingest.shadows(_entities(spark, d), reference).select("rw_id", F.array_join("shared", ",").alias("shared"), "shadowed")


def json_values(spark, d):
    """The first value of a name among nested entries."""
    e = derive(spark, d, "SELECT event_id, event_type, value FROM {events}")
    infos = F.array(F.struct(F.concat(F.lit("Type of "), "event_type").alias("name"), F.lit(None).cast("double").alias("number"), F.when(F.col("event_id") % 2 == 0, F.lit("text")).alias("text")), F.struct(F.lit("Type value").alias("name"), F.lit(7.0).alias("number"), F.lit(None).cast("string").alias("text")))
    return e.select("event_id", ingest.json_value(infos, ["type of c", "type v", "type of p"]).alias("found"))


def cache_keys(spark, d):
    """Digests of requests."""
    e = derive(spark, d, "SELECT event_id, event_type FROM {events}")
    return e.select("event_id", ingest.cache_key(F.lit("get"), F.concat(F.lit("http://x/"), "event_type"), F.create_map(F.lit("b"), F.lit("2"), F.lit("a"), F.col("event_id").cast("string"))).alias("cache_key"))


def listed_substances(spark, d):
    """Rows of list tables, one per number."""
    pages = derive(spark, d, f"""SELECT page_id, url, '2024-01-01' AS retrieved_at, '<table><tr><th>CAS</th><th>Principal name</th><th>Category</th></tr><tr><td>' || {inputs.number("(page_id % 60)")} || '</td><td>Name&amp; ' || CAST(page_id % 7 AS STRING)
        || '</td><td>k</td></tr><tr><td>none</td><td>x</td></tr></table>' AS html FROM {{pages}}""")
    out = ingest.by_number(ingest.listed_substances(pages))
    return out.select("cas", F.array_join("names", ",").alias("names"), F.size("urls").cast("long").alias("n_urls"), "cas_ok")


def _molecules(spark, d):
    table = F.array(*[F.lit(m) for m in MOLECULES])
    return _t(spark, d, "part").select("p_partkey", F.get(table, (F.col("p_partkey") % len(MOLECULES)).cast("int")).alias("smiles"))


def mol_features(spark, d):
    """Features of the molecule of every part."""
    return molecules.annotate(_molecules(spark, d)).withColumns({"MolecularWeight": F.round("MolecularWeight", 3), "FractionCSP3": F.round("FractionCSP3", 6)})


def _picked(spark, d, columns: dict[str, list[str]]) -> DataFrame:
    """Every part with the values of columns at its key's place."""
    return _t(spark, d, "part").select("p_partkey", *[F.get(F.array(*[F.lit(v) for v in values]), (F.col("p_partkey") % len(values)).cast("int")).alias(name) for name, values in columns.items()])


def _spellings(spark, d) -> DataFrame:
    """Every part's molecule as SMILES, as InChI or as both; some texts cannot be read."""
    smiles_of, inchi_of = zip(*known_structures.SPELLINGS, strict=True)
    k = F.col("p_partkey") % 7
    return _picked(spark, d, {"smiles": list(smiles_of), "inchi": list(inchi_of)}).select(
        "p_partkey", F.when(k.isin(1, 2), F.lit(None)).when(k == 3, "C(C").when(k == 4, "bad").otherwise(F.concat("smiles", F.lit("|x|"))).alias("smiles"), F.when(k == 5, F.lit(None)).when(k == 2, "no text").when(k == 4, "InChI=1S/x").otherwise(F.col("inchi")).alias("inchi"),
    )


def merged_groups(spark, d):
    """Rows of one key filled from the latest on."""
    return canonical.merge_groups(canonical.drop_variant_identifiers(derive(spark, d, inputs.REPEATED)))


def reindexed(spark, d):
    """Rows without variant identifiers, with the columns of an allowlist in its order."""
    allowed = ["inchi_key", "cas_number", "smiles", "final_inchi", "my_inchi", "computed_mw"]
    return canonical.to_allowlist(canonical.drop_variant_identifiers(derive(spark, d, inputs.REPEATED)).withColumn("key", F.col("_row")), ["key", *allowed])


def sanitized_rows(spark, d):
    """A tool's rows on their way into the canonical table: keys, times and columns as the allowlist has them."""
    rows = derive(spark, d, inputs.PROPERTIES, heavy=True).withColumnRenamed("inchi_key", "computed_inchikey")
    return governance.sanitize(rows, ["inchi_key", "smiles", "computed_mw", "not_there", "timestamp_updated"], AS_OF)[0]


def sanitized_rejects(spark, d):
    """The rows that have no valid key."""
    rows = derive(spark, d, inputs.PROPERTIES, heavy=True).withColumnRenamed("inchi_key", "computed_inchikey")
    return governance.sanitize(rows, ["inchi_key"], AS_OF)[1].select("_row", "inchi_key", "smiles")


def wide_export(spark, d):
    """Properties in the fixed columns of the export."""
    rows = derive(spark, d, inputs.PROPERTIES).select(F.lower("inchi_key").alias("InChIKey"), "computed_mw", "experimental_logp", "alcohol_count")
    return governance.export_wide(rows)


def rejected_structures(spark, d):
    """Cells without a molecule, and why."""
    return molecules.rejected(_picked(spark, d, {"smiles": ["CCO", "", " ", "nbsp", "C(", "not a smiles", "C1CC1.[Na]", "Zz.Yy"]}))


def newest_versions(spark, d):
    """The newest version of every size, in the order of its numbers; texts that are no versions do not count."""
    version = F.when(F.col("p_partkey") % 11 == 0, "v1.0").otherwise(F.concat_ws(".", (F.col("p_partkey") % 3).cast("string"), (F.col("p_partkey") % 13).cast("string"), (F.col("p_partkey") % 101).cast("string")))
    rows = _t(spark, d, "part").select("p_size", version.alias("version")).withColumn("at", tables.version_order(F.col("version")))
    return rows.groupBy("p_size").agg(F.max_by("version", "at").alias("newest"), F.count("at").alias("n_versions"))


def completed_structures(spark, d):
    """Canonical SMILES, InChIKey and weight out of SMILES or InChI, and what failed."""
    return structures.complete_structures(_spellings(spark, d))


def computed_descriptors(spark, d):
    """Masses, logP, refractivity, polar surface and counts of every part's molecule, read from SMILES or InChI."""
    out = descriptors.describe(_spellings(spark, d), inchi="inchi")
    return out.select("p_partkey", *[f"computed_{x}" for x in descriptors.DESCRIPTORS], "source_tpsa")


def pattern_counts(spark, d):
    """The patterns that every part's molecule holds, and how often."""
    return structures.count_patterns(_picked(spark, d, {"smiles": known_structures.MOTIF_MOLECULES}))


def smiles_clean(spark, d):
    """Cleaned SMILES cells."""
    return derive(spark, d, inputs.SMILES).select("p_partkey", smiles.clean_smiles(F.col("raw")).alias("clean"), text.cut_smiles(F.concat("raw", F.lit("|x|y"))).alias("cut"))


def provider_properties(spark, d):
    """Properties out of a provider's nested answers."""
    out = provider.properties(derive(spark, d, inputs.ANSWERS, heavy=True))
    shown = ("boiling_point_c", "vapor_pressure_pa", "density_g_ml", "refractive_index", "logp", "melting_point_c", "water_solubility_mg_l", "heat_of_vaporization_kj_mol")
    return out.select("p_partkey", *[F.round(f"experimental_{p}", 6).alias(p) for p in shown], "source_density_g_ml", "source_melting_point_c", "experimental_refractive_index_temperature_c", "warnings")


def provider_units(spark, d):
    """Values by the provider's units, temperatures in texts, and values whose unit must be known."""
    m = units.split_units(derive(spark, d, inputs.MEASURED), "pressure", "temperature")
    p, t, s = units.provider_unit(F.col("pressure_number"), F.col("pressure_unit")), units.provider_unit(F.col("temperature_number"), F.col("temperature_unit")), units.strict_pascal(F.col("pressure_number"), F.col("pressure_unit"))
    return m.select(
        "key", F.round(p["value"], 6).alias("pa"), p["warning"].alias("pa_warning"), F.round(t["value"], 6).alias("celsius"), t["warning"].alias("celsius_warning"),
        F.round(units.first_celsius(F.col("temperature")), 6).alias("first_celsius"), F.round(units.temperature_in(F.col("temperature")), 6).alias("named_celsius"), F.round(s["value"], 6).alias("strict_pa"), s["warning"].alias("strict_warning"),
    )


def cas_first_valid(spark, d):
    """The customer's first tokens, one row per code, name and number."""
    cells = derive(spark, d, inputs.CELLS, heavy=True)
    return tokens.first_valid(tokens.first_tokens(cells, tokens.repair(tokens.explode_tokens(cells))), "c1").select("customer_id", "code", "name", "cas")


def cas_run_counts(spark, d):
    """Counts of a run of the cleaner."""
    cells = derive(spark, d, inputs.CELLS, heavy=True)
    repaired = tokens.repair(tokens.explode_tokens(cells))
    return tokens.run_counts(cells, tokens.exploded_table(repaired, "c1", AS_OF), tokens.first_valid(tokens.first_tokens(cells, repaired), "c1"))


def resolver_merge(spark, d):
    """Cached and new results, the first of each number or input."""
    rows = lambda m, k: derive(spark, d, f"SELECT p_partkey AS _row, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE {inputs.number('(p_partkey % 300)')} END AS cas, p_brand AS input, p_partkey AS found FROM {{part}} WHERE p_partkey % {m} = {k}")
    return resolver.keep_first(rows(3, 0), rows(3, 1)).drop("_row")


def best_identifiers(spark, d):
    """The identifier that each row goes by."""
    rows = derive(spark, d, f"SELECT c_custkey AS key, CASE WHEN c_custkey % 2 = 0 THEN {inputs.number('c_custkey')} END AS cas, CASE WHEN c_custkey % 3 = 0 THEN {inputs.inchikey('c_custkey')} ELSE 'bad' END AS ik, c_name AS nm FROM {{customer}}")
    return identifiers_of.best_identifier(rows, {"inchikey": ["ik"], "cas": ["cas"], "name": ["nm"]}).select("key", "identifier", "identifier_type", "normalized_input")


def dump_rows(spark, d):
    """Rows of the INSERT statements of a dump, some of which span lines."""
    dump = derive(spark, d, """SELECT CASE WHEN p_partkey % 10 = 0 THEN 'CREATE TABLE t (a SERIAL)' ELSE CASE WHEN p_partkey % 3 = 0 THEN chr(10) || 'insert into public.t' || chr(10) ELSE 'INSERT INTO t ' END || '(a, b, c) VALUES (' || CAST(p_partkey AS STRING) || ', ' || chr(39) || 'it' || chr(39) || chr(39) || 's (' || p_brand || ')' || chr(39) || ', NULL),'
        || CASE WHEN p_partkey % 2 = 0 THEN chr(10) ELSE ' ' END || '(' || CAST(p_size AS STRING) || ', ' || chr(39) || chr(39) || ', 7)' END AS value FROM {part}""")
    return dumps.insert_rows(dump, "t", ["a", "b", "c"])


def missing_requests(spark, d):
    """Requests that a cache does not hold."""
    requests = derive(spark, d, "SELECT 'get' AS method, 'http://x/' || event_type AS url FROM {events}").withColumn("params", F.create_map(F.lit("a"), F.lit("1")))
    held = requests.where("url LIKE 'http://x/c%'").select(ingest.cache_key(F.col("method"), F.col("url"), F.col("params")).alias("cache_key"))
    return ingest.missing_requests(requests, held).select("cache_key", "url")


QUERIES = (
    db2_upsert, best_identifiers, dump_rows, missing_requests, cas_tokens, cas_validity, cas_recovered, cas_swaps, cas_evidence, cas_repair, cas_fixed_cells, cas_first_tokens, cas_exploded_table, cas_first_valid, cas_run_counts, mixture_class, identifiers, ascii_names,
    db2_audit, db2_rejected, db2_summary, db1_dedupe, db1_rejects, db1_upsert, db1_merge_fields, promoted_keys, customer_feed, customer_map, cas_view, cas_view_exportable, cas_view_overlay,
    resolver_cache, resolver_winner, resolver_merge, name_rank, cache_ttl, unit_conversion, provider_units, provider_properties, fallback_estimates, final_fields, canonical_rows, canonical_winners, canonical_audit, henry_lookup,
    solubility_parameters, computed_parameters, page_facts, page_discovery, entities, entity_shadows, json_values, cache_keys, listed_substances, mol_features, merged_groups, reindexed, sanitized_rows, sanitized_rejects, wide_export, rejected_structures, newest_versions, completed_structures, computed_descriptors, pattern_counts, smiles_clean,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in QUERIES}
