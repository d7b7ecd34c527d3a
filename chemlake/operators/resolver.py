"""Resolving numbers and names to structures from tables: cache, providers in order, ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from chemlake.functions import cas
from chemlake.functions.mixtures import mixture_class
from chemlake.functions.text import heavy_atoms_guess, to_ascii

# Which source wins when several numbers of a cell are found, and how long an answer holds.
SOURCE_RANK = {"db2_cache": 0, "cas": 1, "pubchem": 3, "cactus": 4, "opsin": 5, "rdkit": 6}
NEGATIVE_DAYS, TEMPORARY_HOURS = 30, 1


def registry_cache(registry: DataFrame, order: str = "_row") -> DataFrame:
    """The last eligible registry row of each number: number and key not blank, status valid."""
    good = registry.where((F.trim("cas_number_normalized") != "") & (F.trim("inchi_key") != "") & (F.lower("cas_status") == "valid"))
    return good.groupBy(F.col("cas_number_normalized").alias("cas")).agg(*[F.max_by(c, order).alias(c) for c in ("inchi_key", "inchi", "smiles")])


def live_answers(cache: DataFrame, as_of: Column) -> DataFrame:
    """Cached answers that still hold: successes for ever, refusals 30 days, temporary errors an hour."""
    age = as_of.cast("long") - F.col("updated_utc").cast("timestamp").cast("long")
    limit = F.when(F.col("status") == "success", F.lit(None).cast("long")).when(F.col("status") == "negative", NEGATIVE_DAYS * 86_400).otherwise(TEMPORARY_HOURS * 3_600)
    return cache.where(limit.isNull() | (age < limit))


def from_providers(numbers: DataFrame, providers: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """The first provider's answer to each distinct number (cas): source, smiles, inchi, inchi_key."""
    answers = None
    for priority, (name, table) in enumerate(providers):
        own = table.select("cas", F.lit(priority).alias("priority"), F.lit(name).alias("source"), "smiles", "inchi", "inchi_key")
        answers = own if answers is None else answers.unionByName(own)
    asked = answers.join(numbers.select("cas").distinct(), "cas", "left_semi")
    return asked.groupBy("cas").agg(F.min_by(F.struct("source", "smiles", "inchi", "inchi_key"), "priority").alias("a")).select("cas", "a.*")


def source_rank(source: Column) -> Column:
    rank = F.lit(7)
    for name, value in SOURCE_RANK.items():
        rank = F.when(source == name, value).otherwise(rank)
    return rank


def resolve(rows: DataFrame, cache: DataFrame, providers: Sequence[tuple[str, DataFrame]] = ()) -> DataFrame:
    """One row per input row (row, name, cas): the best hit of its numbers, the other hits, and the mixture class.

    The cache's answer to a number comes before those of the providers, in their order.  A row without hit has source
    unresolved.  Row numbers differ.
    """
    parts = rows.select("row", "name", F.col("cas").alias("cas_input"), F.posexplode_outer(cas.slash_tokens(F.col("cas"))).alias("pos", "raw"))
    # of each number the cache's answer, else that of the first provider; one aggregate and one join by number
    fields = ("smiles", "inchi", "inchi_key")
    answers = cache.select("cas", F.lit(-1).alias("priority"), F.lit("db2_cache").alias("source"), *fields)
    for priority, (name, table) in enumerate(providers):
        answers = answers.unionByName(table.select("cas", F.lit(priority).alias("priority"), F.lit(name).alias("source"), *fields))
    first = answers.where("cas IS NOT NULL").groupBy(F.col("cas").alias("_k")).agg(F.min_by(F.struct("source", *fields), "priority").alias("a"))
    number = F.when(cas.resolver_valid(F.col("raw")), cas.resolver_cas(F.col("raw"))["cas"])
    # what is no number is dealt by its row, so that it does not meet in one task; it finds nothing
    asked = parts.withColumn("cas", number).withColumn("_k", F.coalesce("cas", F.concat(F.lit("row "), F.col("row").cast("string"))))
    hit = F.when(F.col("a").isNotNull(), F.struct(source_rank(F.col("a.source")).alias("rank"), "pos", "cas", *[F.col(f"a.{c}").alias(c) for c in ("source", *fields)]))
    out = asked.join(first, "_k", "left").groupBy("row", "name", "cas_input").agg(F.array_sort(F.collect_list(hit)).alias("hits"))
    best = F.get("hits", F.lit(0))
    others = F.array_join(F.transform(F.slice("hits", 2, F.greatest(F.size("hits") - 1, F.lit(0))), lambda h: h["cas"]), " | ")
    return out.select(
        "row", "name", "cas_input", best["cas"].alias("cas"), F.coalesce(best["source"], F.lit("unresolved")).alias("source"), best["smiles"].alias("smiles"),
        best["inchi"].alias("inchi"), best["inchi_key"].alias("inchi_key"), F.coalesce(others, F.lit("")).alias("alternates"),
        F.when(F.size("hits") > 0, mixture_class(F.col("name"), best["cas"], best["smiles"])).otherwise("unknown").alias("mixture_type"),
    )


def rank_names(candidates: DataFrame) -> DataFrame:
    """Candidates (name, normal, cid, smiles, inchi_key, synonyms) with score and rank within their name.

    1000 for a synonym equal to the normal name, 500 for one equal without accents, 50 for carbon, 25 for
    one component; less the charge marks of the key and the distance to the (upper) median size; plus
    1 / (1 + cid).
    """
    low = F.transform("synonyms", lambda s: F.lower(s))
    plain = F.transform("synonyms", lambda s: F.lower(F.regexp_replace(s, r"[^\x00-\x7F]", "")))
    size = heavy_atoms_guess(F.col("smiles"))
    scored = candidates.join(_upper_medians(candidates.where("smiles IS NOT NULL AND smiles <> ''").select("name", size.alias("size"))), "name", "left").withColumn(
        "score",
        F.when(F.array_contains(low, F.col("normal")) | F.array_contains(plain, F.col("normal")), 1000.0).otherwise(0.0)
        + F.when(F.array_contains(plain, to_ascii(F.col("normal"))) | F.array_contains(plain, to_ascii(F.lower("name"))), 500.0).otherwise(0.0)
        + F.when(F.lower("smiles").contains("c"), 50.0).otherwise(0.0)
        + F.when(F.coalesce(F.col("smiles").contains("."), F.lit(False)), 0.0).otherwise(25.0)
        - F.length(F.regexp_replace(F.coalesce("inchi_key", F.lit("")), "[^+-]", ""))
        - F.when(F.coalesce("smiles", F.lit("")) != "", F.abs(size - F.col("median"))).otherwise(0)
        + 1.0 / (1.0 + F.col("cid")),
    )
    return _ranked(scored)


def _upper_medians(sizes: DataFrame) -> DataFrame:
    """(name, median): the upper median of each name's sizes, from counts of equal ones; a name has few different sizes, however many rows."""
    counted = sizes.groupBy("name", "size").agg(F.count("*").alias("n"))
    running = F.sum("n").over(Window.partitionBy("name").orderBy("size").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("n").over(Window.partitionBy("name"))
    beyond = counted.withColumns({"_upto": running, "_all": total}).where(F.col("_upto") > F.floor(F.col("_all") / 2))
    return beyond.groupBy("name").agg(F.min("size").alias("median"))


def _ranked(scored: DataFrame) -> DataFrame:
    """scored with rank by score, then cid, within its name.

    A name's rows are dealt to blocks of scores, in order, of which it has some thousands at most: rows are numbered
    within their block, and blocks are moved by the counts of those before.  So a very common name is in many tasks.
    """
    whole = F.floor("score")
    part = F.col("score") - whole
    # parts of one are those of 1 / (1 + cid): by their logarithm, 64 blocks each time that the cid doubles
    block = F.when(part > 0, F.floor(-F.log2(part) * 64)).otherwise(F.lit(1 << 20))
    blocks = ["name", "_whole", "_block"]
    rows = scored.withColumns({"_whole": F.coalesce(whole.cast("long"), F.lit(-(1 << 40))), "_block": F.coalesce(block, F.lit(1 << 21)).cast("long")})
    before = F.sum("_n").over(Window.partitionBy("name").orderBy(F.desc("_whole"), F.asc("_block")).rowsBetween(Window.unboundedPreceding, -1))
    moved = rows.groupBy(*blocks).agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(before, F.lit(0)))
    number = F.row_number().over(Window.partitionBy(*blocks).orderBy(F.desc("score"), F.asc("cid")))
    return rows.join(moved, blocks).withColumn("rank", (F.col("_before") + number).cast("int")).drop("_whole", "_block", "_n", "_before")


def keep_first(known: DataFrame, new: DataFrame) -> DataFrame:
    """Cached and new results; of each number (or input, where there is none) the first, cached ones before new ones."""
    both = known.withColumn("_at", F.lit(0)).unionByName(new.withColumn("_at", F.lit(1)), allowMissingColumns=True)
    key = F.coalesce(F.when(F.trim("cas") != "", F.col("cas")), F.col("input"))
    return both.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy("_at", "_row"))).where("_n = 1").drop("_n", "_at")
