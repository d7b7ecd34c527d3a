"""A customer's list from cells to the view: clean, resolve, merge, map, view, annotate, properties."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chemlake.operators import canonical, molecules, properties, registry, resolver, tokens

#: Columns of the property table that a run fills.
COLUMNS = ("inchi_key", "inchi", "smiles", "computed_mw", "computed_ring_count", "computed_boiling_point_c", "computed_vapor_pressure_pa", "TotalAlcoholCount", "AldehydeCount", "KetoneCount", "EsterCount_Total", "HighImpactSummary")


@dataclass
class Run:
    exploded: DataFrame
    resolved: DataFrame
    registry: registry.Merged
    customer_map: DataFrame
    properties: DataFrame
    view: DataFrame


def run(cells: DataFrame, customer_id: str, seen: str, known_registry: DataFrame, known_map: DataFrame, known_properties: DataFrame, folder: str, providers: Sequence[tuple[str, DataFrame]] = (), annotate: bool = True) -> Run:
    """All steps; each step's table is written under folder, so that the next reads it and a failed run shows where it stopped."""

    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")

    repaired = keep(tokens.repair(tokens.explode_tokens(cells)), "repaired")
    exploded = tokens.exploded_table(repaired, customer_id, seen)
    asked = repaired.where("status LIKE 'valid%'").groupBy(F.col("fixed").alias("cas")).agg(F.min("row").alias("row"), F.min_by("name", "row").alias("name"))
    resolved = keep(resolver.resolve(asked, resolver.registry_cache(known_registry.withColumn("_row", F.lit(0))), providers), "resolved")
    incoming = registry.from_resolver(resolved.where("cas IS NOT NULL").withColumn("cas_validity", F.lit("valid")).withColumn("_row", F.col("row")))
    merged = registry.upsert(known_registry, incoming, seen)
    merged = registry.Merged(*[keep(df, name) for df, name in ((merged.registry, "registry"), (merged.audit, "audit"), (merged.rejected, "rejected"))])
    mapped = keep(tokens.upsert_customer_map(known_map, tokens.customer_feed(exploded)), "customer_map")
    table = known_properties
    if annotate:
        found = resolved.where("inchi_key IS NOT NULL").groupBy("inchi_key").agg(F.min_by("smiles", "row").alias("smiles"), F.min("row").alias("_row"))
        counted = molecules.annotate(found.withColumn("inchi", F.lit(None).cast("string")))
        estimated = keep(properties.apply_fallbacks(counted.withColumnsRenamed({"MolecularWeight": "computed_mw", "NumRingsTotal": "computed_ring_count"})), "features")
        table = keep(canonical.upsert(known_properties, estimated, "features", COLUMNS), "properties")
    view = canonical.overlay(canonical.cas_view(merged.registry, table), mapped, customer_id)
    return Run(exploded, resolved, merged, mapped, table, view)
