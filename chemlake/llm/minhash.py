"""Near-duplicate documents by bottom-k sketches of one hash function (operator 8).

1. Each text gives the set of its word shingles (64-bit hashes), of which the k smallest are its sketch.
   Texts of one word sequence are one group of copies from here on.
2. Inverted lists of retained values: two sets of similarity t share at least `need` of k
   retained values, but for a chance (binomial) of 3.5e-6 at t = 0.85 (need 17 of 32) and 1.2e-6 at 0.80 (14), so they meet in a list of one of the k - need + 1 rarest retained values
   of each.  Values are ranked by how many sketches hold them; only these rarest ones enter lists.
3. The first document of a list is tried with all others; pairs pass by size and by the similarity that the
   union's sketch estimates, and each document's most similar one is confirmed on full sets.
4. Lists that still hold several components are searched on: every pair across components in short
   lists, by estimate and then full sets; blocks against blocks on full sets in long ones. So no pair that
   could join two components is left out, and no group gives rise to all of its pairs.
"""

from __future__ import annotations

from math import sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chemlake.llm import words
from chemlake.llm.components import connected_components
from chemlake.llm.workspace import Workspace, small_batches

#: Retained values of each sketch.
SKETCH = 32
#: Standard deviations below the threshold at which an estimate still passes.
MARGIN = 5.5
#: Lists of up to so many documents are paired by a self-join, longer ones by blocks of about BLOCK.
SHORT_LIST = 32
BLOCK = 256
#: Ids (8 bytes each) of documents to read again that may be broadcast; beyond that they are joined by shuffle.
BROADCAST_IDS = 200_000


def near_duplicates(docs: DataFrame, *, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text", sketch: int = SKETCH) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept.

    Documents with 100 * |intersection| >= percent * |union| of their shingle sets are linked;
    component_id is the smallest doc_id that links reach.  A text of fewer words than a shingle is one
    shingle; null texts and texts without words have no shingle and are linked with nothing.  Rows that
    share a doc_id are one document, linked by any of its texts.  A row without doc_id is linked with
    nothing: its component_id is null and it is kept.  Other columns of docs are ignored.
    """
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    work = Workspace(spark)
    source = docs.select(F.col(doc_id).cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sketches = work.save(source.mapInArrow(_sketcher(shingle, sketch), "doc long, h1 long, h2 long, n long, sketch array<long>"), "sketches")
    groups = sketches.where("n > 0 AND doc IS NOT NULL").groupBy("h1", "h2").agg(F.min("doc").alias("doc"))
    unique = work.save(_representatives(sketches, groups), "unique")
    components = connected_components(_links(unique, source, work, shingle, percent, sketch), work, "final")
    work.keep_only("sketches", "final")  # all that the result is read from
    keyed = groups.withColumnRenamed("doc", "first").join(components, F.col("first") == F.col("node"), "left").select("h1", "h2", F.coalesce("component", "first").alias("component"))
    whole = sketches.select("doc", "h1", "h2", "n").join(keyed, ["h1", "h2"], "left")
    component = F.when(F.col("doc").isNotNull(), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc")))
    return whole.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc") == component, F.lit(True)).alias("kept"))


def _representatives(sketches: DataFrame, groups: DataFrame) -> DataFrame:
    """(doc, n, sketch) of the first document of each group of copies."""
    return sketches.select("doc", "h1", "h2", "n", "sketch").join(groups, ["doc", "h1", "h2"], "left_semi").dropDuplicates(["doc", "h1", "h2"]).select("doc", "n", "sketch")


def _sketcher(shingle: int, k: int):
    def run(batches):
        for batch in batches:
            docs, h1, h2, n, flat, sizes = batch.column(0), [], [], [], [], []
            for first, end, data, offsets in words.text_slices(batch.column(1)):
                hashes, _, heads = words.word_hashes(data, offsets)
                runs = words.shingles(hashes, shingle)
                for i in range(end - first):
                    own = hashes[heads[i] : heads[i + 1]]
                    found = words.shingle_set(own, runs[heads[i] : heads[i + 1]], shingle)
                    n.append(len(found))
                    h1.append(words.sequence_hash(own, 1) if len(own) else 0)
                    h2.append(words.sequence_hash(own, 3) if len(own) else 0)
                    flat.append(found[:k])
                    sizes.append(min(k, len(found)))
            values = np.concatenate(flat) if flat else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(values, pa.int64()))
            as_long = lambda x: pa.array(words.signed(np.array(x, np.uint64)), pa.int64())
            yield pa.RecordBatch.from_arrays([docs, as_long(h1), as_long(h2), pa.array(n, pa.int64()), lists], ["doc", "h1", "h2", "n", "sketch"])

    return run


def _set_maker(shingle: int):
    def run(batches):
        for batch in batches:
            # a slice of documents at a time, as sets take more room than texts
            for first, end, data, offsets in words.text_slices(batch.column(1)):
                hashes, _, heads = words.word_hashes(data, offsets)
                runs = words.shingles(hashes, shingle)
                sets = [words.shingle_set(hashes[heads[i] : heads[i + 1]], runs[heads[i] : heads[i + 1]], shingle) for i in range(end - first)]
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]), pa.int32()), pa.array(np.concatenate(sets), pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), lists], ["doc", "shingles"])

    return run


def least_estimate(percent: int, k: int) -> float:
    """The share of k retained values that two sets of that similarity have in common but for MARGIN deviations."""
    t = percent / 100
    return max(1 / k, t - MARGIN * sqrt(t * (1 - t) / k))


def estimate(left: Column, right: Column, k: int) -> Column:
    """Similarity of two sets from their sketches: shared values among the k smallest of the union."""
    union = F.slice(F.array_sort(F.array_union(left, right)), 1, k)
    return F.size(F.array_intersect(union, F.array_intersect(left, right))) / F.size(union)


def _lists(unique: DataFrame, percent: int, k: int) -> DataFrame:
    """(value, doc, n): the inverted lists, each document under its rarest retained values only."""
    entries = unique.select("doc", "n", F.size("sketch").alias("kept"), F.explode("sketch").alias("value"))
    shared = entries.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    met = entries.join(shared, "value").groupBy("doc", "n", "kept").agg(F.collect_list(F.struct("df", "value")).alias("values"))
    need = F.greatest(F.lit(1), F.ceil(F.col("kept") * F.lit(least_estimate(percent, k)) - F.lit(1e-9)))
    # values that no other sketch holds come first in the order of rarity
    take = F.col("kept") - need + 1 - (F.col("kept") - F.size("values"))
    rare = met.where(take > 0).select("doc", "n", F.explode(F.slice(F.array_sort("values"), 1, take.cast("int"))).alias("x"))
    return rare.select(F.col("x.value").alias("value"), "doc", "n")


def _alike_in_size(a: str, b: str, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _links(unique: DataFrame, source: DataFrame, work: Workspace, shingle: int, percent: int, k: int) -> DataFrame:
    """(a, b): links enough to join what belongs together."""
    lists = work.save(_lists(unique, percent, k), "lists")
    lead = lists.groupBy("value").agg(F.min("doc").alias("a"), F.min_by("n", "doc").alias("na"), F.count("*").alias("size")).where("size > 1")
    tried = lists.join(lead, "value").where((F.col("a") < F.col("doc")) & _alike_in_size("na", "n", percent)).select("a", F.col("doc").alias("b")).distinct()
    scored = _scored(tried, unique, percent, k)
    best = work.save(scored.groupBy("b").agg(F.max_by("a", "score").alias("a")).select("a", "b"), "best")
    links = work.save(_confirmed(best, _sets(best.select(F.col("a").alias("doc")).union(best.select("b")), source, work, shingle, "first"), percent), "links")

    known = connected_components(links, work, "met")
    placed = lists.join(known, F.col("doc") == F.col("node"), "left").select("value", "doc", "n", F.coalesce("component", "doc").alias("c"))
    mixed = placed.groupBy("value").agg(F.count("*").alias("size"), F.min("c").alias("low"), F.max("c").alias("high"), F.min("doc").alias("lead")).where("low < high")
    left = work.save(placed.join(mixed.select("value", "size", "lead"), "value"), "left")
    pairs = work.save(_scored(_pairs_of_short(left.where(F.col("size") <= SHORT_LIST), percent), unique, percent, k).select("a", "b"), "pairs")
    long = work.save(left.where(F.col("size") > SHORT_LIST).select("lead", "doc", "c").distinct(), "long")
    sets = _sets(pairs.select(F.col("a").alias("doc")).union(pairs.select("b")).union(long.select("doc")), source, work, shingle, "second")
    return links.union(_confirmed(pairs, sets, percent)).union(_links_of_long(long, sets, percent))


def _pairs_of_short(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs of documents of different components that share a short list: at most SHORT_LIST for an entry."""
    l, r = (lists.select("value", F.col("doc").alias(x), F.col("n").alias(f"n{x}"), F.col("c").alias(f"c{x}")) for x in "ab")  # noqa: E741
    met = l.join(r, "value").where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & _alike_in_size("na", "nb", percent))
    return met.select("a", "b").distinct()


def _scored(pairs: DataFrame, unique: DataFrame, percent: int, k: int) -> DataFrame:
    """Pairs (a, b) whose estimate may belong to similar sets, with it as score."""
    one, two = (unique.select(F.col("doc").alias(x), F.col("sketch").alias(f"s{x}")) for x in "ab")
    scored = pairs.join(two, "b").join(one, "a").withColumn("score", estimate(F.col("sa"), F.col("sb"), k))
    return scored.where(F.col("score") >= least_estimate(percent, k) - 1e-9).select("a", "b", "score")


def _sets(ids: DataFrame, source: DataFrame, work: Workspace, shingle: int, name: str) -> DataFrame:
    """(doc, shingles): the full sets of the documents named, from a second look at their texts."""
    ids = work.save(ids.distinct(), f"{name}-ids")
    wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return work.save(source.join(wanted, "doc", "left_semi").mapInArrow(_set_maker(shingle), "doc long, shingles array<long>"), f"{name}-sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar."""
    one, two = (sets.select(F.col("doc").alias(x), F.col("shingles").alias(f"s{x}")) for x in "ab")
    both = pairs.select("a", "b").join(two, "b").join(one, "a").withColumn("shared", F.size(F.array_intersect("sa", "sb")))
    return both.where(F.col("shared") * 100 >= (F.size("sa") + F.size("sb") - F.col("shared")) * percent).select("a", "b")


def _links_of_long(entries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links across components among documents that share a long list.

    Long lists of one first document go together, as they hold much the same documents.  The largest
    component of such a group needs no look within, only against the rest; the rest and it are cut into
    blocks, and a task compares the full sets of two blocks exactly, by products of their incidence matrices.  A task
    gives no more links than it joins components, so what comes out is bounded by what goes in.
    """
    counts = entries.groupBy("lead", "c").agg(F.count("*").alias("n")).groupBy("lead").agg(F.max_by("c", "n").alias("largest"), F.max("n").alias("n"), F.sum("n").alias("all"))
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(n / BLOCK)).cast("int")
    sized = entries.join(counts, "lead").select("lead", "doc", "c", (F.col("c") == F.col("largest")).alias("inner"), blocks(F.col("all") - F.col("n")).alias("rest"), blocks(F.col("n")).alias("core"))
    placed = sized.withColumn("at", F.pmod(F.xxhash64("doc"), F.when(F.col("inner"), F.col("core")).otherwise(F.col("rest"))).cast("int"))
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    tile = lambda inner, i, j: F.struct(F.lit(inner).alias("inner"), i.alias("i"), j.alias("j"))
    within = F.transform(upto(F.col("rest")), lambda j: tile(False, F.least(F.col("at"), j), F.greatest(F.col("at"), j)))
    against = F.transform(upto(F.col("core")), lambda j: tile(True, F.col("at"), j))
    core = F.transform(upto(F.col("rest")), lambda i: tile(True, i, F.col("at")))
    tiles = placed.withColumn("tile", F.explode(F.when(F.col("inner"), core).otherwise(F.concat(within, against))))
    rows = tiles.select("lead", "tile", "doc", "c", F.when(F.col("tile.inner"), ~F.col("inner")).otherwise(F.col("at") == F.col("tile.i")).alias("first"), F.when(F.col("tile.inner"), F.col("inner")).otherwise(F.col("at") == F.col("tile.j")).alias("second"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        links = similar_across(group.doc.to_numpy(), group.c.to_numpy(), [*group.shingles], group["first"].to_numpy(), group.second.to_numpy(), percent)
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    return rows.join(sets, "doc").groupBy("lead", "tile").applyInPandas(compare, "a long, b long")


def similar_across(docs: np.ndarray, components: np.ndarray, sets: list[np.ndarray], first: np.ndarray, second: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Similar pairs of one document of the first block and one of the second, as far as they join components."""
    one, two = np.flatnonzero(first), np.flatnonzero(second)
    if not len(one) or not len(two):
        return []
    flat = lambda rows: (np.concatenate([sets[i] for i in rows]), np.repeat(np.arange(len(rows)), [len(sets[i]) for i in rows]))
    (values1, rows1), (values2, rows2) = flat(one), flat(two)
    common = np.intersect1d(values1, values2)
    shared = np.zeros((len(one), len(two)), np.float32)

    def columns(values: np.ndarray, rows: np.ndarray, part: np.ndarray, n: int) -> np.ndarray:
        at = np.minimum(np.searchsorted(part, values), len(part) - 1)
        hit = part[at] == values
        matrix = np.zeros((n, len(part)), np.float32)
        matrix[rows[hit], at[hit]] = 1
        return matrix

    for start in range(0, len(common), 2048):
        part = common[start : start + 2048]
        shared += columns(values1, rows1, part, len(one)) @ columns(values2, rows2, part, len(two)).T
    sizes = np.array([len(s) for s in sets], np.float64)
    alike = 100 * shared.astype(np.float64) >= percent * (sizes[one][:, None] + sizes[two][None, :] - shared)
    alike &= components[one][:, None] != components[two][None, :]
    root: dict[int, int] = {}

    def find(c: int) -> int:
        while (up := root.get(c, c)) != c:
            root[c] = root.get(up, up)
            c = up
        return c

    links = []
    for i, j in np.argwhere(alike):
        a, b = find(int(components[one[i]])), find(int(components[two[j]]))
        if a != b:
            root[max(a, b)] = min(a, b)
            links.append((int(docs[one[i]]), int(docs[two[j]])))
    return links
