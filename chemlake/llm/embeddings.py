"""Near-duplicate vectors by int8 tile products with proven error bounds (operator 1).

Vectors are scaled to length one and dealt to cells of the nearest of a bounded set of pivots; a vector also visits
every cell that could hold a partner, by the distance of the bisecting planes, so no pair is missed.
Within a cell, tiles of int8 codes are multiplied; each vector's exact quantisation error bounds by how much a product
can be off, and only pairs that may pass are computed again in double precision.
"""

from __future__ import annotations

import hashlib
from math import ceil, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chemlake.llm.components import connected_components
from chemlake.llm.workspace import Workspace, small_batches

#: Vectors of the bounded sample that pivots are taken from (some kB each), and pivots at most.
SAMPLE, MOST_PIVOTS = 2_048, 1_024
#: Vectors of a tile's side at most, components of one at most, and the side of the products that are looked at at once.
TILE, TILE_NUMBERS, PRODUCTS = 8_192, 1 << 22, 1_024
#: What a copy of a vector and a product cost, in microseconds; they weigh cells against each other and change no result.
COPY_COST, PRODUCT_COST = 20.0, 0.01
#: Slack of double-precision rounding in the bounds.
ROUNDING = 1e-9

def _double(column: pa.Array) -> list[np.ndarray | None]:
    """Each vector in double precision; None if it is null, zero, or holds null or non-finite components."""
    out = []
    for v in column:
        if not v.is_valid:
            out.append(None)
            continue
        values = v.values
        x = np.asarray(values.to_numpy(zero_copy_only=False), np.float64) if values.null_count == 0 else None
        out.append(x if x is not None and len(x) and np.isfinite(x).all() and x.any() else None)
    return out


def _packed(x: np.ndarray) -> bytes:
    """A vector's bytes: single precision where that holds it exactly, else double."""
    with np.errstate(over="ignore"):
        short = x.astype(np.float32)
    return (short if (short == x).all() else x).tobytes()


def _unpacked(column, size: int) -> np.ndarray:
    """Rows of packed vectors of one size, in double precision."""
    if all(len(v) == 4 * size for v in column):
        return np.frombuffer(b"".join(column), np.float32).reshape(-1, size).astype(np.float64)
    return np.array([np.frombuffer(v, np.float32 if len(v) == 4 * size else np.float64) for v in column], np.float64).reshape(-1, size)


_KEYED = "id long, size int, h1 long, h2 long, vector binary"


def _keyed(batches):
    """(id, size, 128-bit digest, vector) of the vectors that can be compared."""
    for batch in batches:
        rows = []
        for i, x in zip(batch.column(0).to_pylist(), _double(batch.column(1)), strict=True):
            if x is not None and i is not None:
                x = x + 0.0  # no negative zeros
                rows.append((i, len(x), *np.frombuffer(hashlib.blake2b(x.tobytes(), digest_size=16).digest(), np.int64).tolist(), _packed(x)))
        columns = list(zip(*rows, strict=True)) if rows else [()] * 5
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["id", "size", "h1", "h2", "vector"])


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by the largest component first, so that nothing overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def quantise(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 codes, scale of each, length of each one's error): unit = scale * code + error."""
    scale = np.abs(units).max(axis=1) / 127
    codes = np.rint(units / scale[:, None]).astype(np.int8)
    return codes, scale, np.sqrt(((units - codes * scale[:, None]) ** 2).sum(axis=1)) + ROUNDING


def possible_pairs(left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of left and right units whose cosine may reach the threshold, by int8 products and error bounds.

    With a = p + e and b = q + f, |a.b - p.q| <= |e||b| + |p||f| <= |e| + (1 + |e|)|f|.  The products of codes are
    whole numbers below 2**24 for up to 1,040 dimensions, so single precision holds them exactly; beyond, double does.
    """
    kind = np.float32 if left.shape[1] <= 1040 else np.float64
    (c1, s1, e1), (c2, s2, e2) = quantise(left), quantise(right)
    products = (c1.astype(kind) @ c2.astype(kind).T).astype(np.float64) * s1[:, None] * s2[None, :]
    bound = e1[:, None] + (1 + e1)[:, None] * e2[None, :] + ROUNDING
    return np.nonzero(products + bound >= threshold)


def cosines(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Cosine of rows in double precision."""
    return (left * right).sum(axis=1) / np.sqrt((left * left).sum(axis=1) * (right * right).sum(axis=1))


def near_vectors(vectors: DataFrame, *, threshold: float = 0.9, vec_id: str = "vec_id", embedding: str = "embedding", pivots: int = 0, tile: int = TILE) -> DataFrame:
    """One row per row of vectors: vec_id, n_links, component_id, kept.

    Vectors of cosine >= threshold are linked; n_links counts the other vectors linked directly;
    component_id is the smallest vec_id that links reach.  Vectors that are null or zero, or hold null or
    non-finite components, and vectors of another number of dimensions are linked with nothing.  Rows that
    share a vec_id are vectors of their own and count each other if they are alike.  A row without vec_id
    is linked with nothing: n_links 0, component_id null, kept.  An empty table gives no rows; very long vectors
    are compared in smaller tiles.  Ties (a cosine of the threshold) are links.  Other columns are ignored.  The number
    of pivots is chosen by the visits of a sample where none is given; the result does not depend on it.
    """
    small_batches(vectors.sparkSession)
    work = Workspace(vectors.sparkSession)
    source = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("embedding"))
    keyed = work.save(source.mapInArrow(_keyed, _KEYED), "keyed")
    # equal vectors are one from here on; the copies' number is their weight
    key = ["size", "h1", "h2"]
    groups = work.save(keyed.groupBy(*key).agg(F.min("id").alias("rep"), F.count("*").alias("n")), "groups")
    unique = work.save(keyed.withColumnRenamed("id", "rep").join(groups, [*key, "rep"]).dropDuplicates(key), "unique")
    tiles = _tiles(unique, work, pivots, threshold, tile)
    found = work.save(tiles.groupBy("tile").applyInPandas(_comparer(threshold), "rep long, size int, h1 long, h2 long, links long, parent long"), "found")
    links = found.groupBy(*key).agg(F.sum("links").alias("links"))
    components = connected_components(found.where("rep <> parent").select(F.col("rep").alias("a"), F.col("parent").alias("b")), work)
    work.keep_only("keyed", "groups", "found", "components")  # all that the result is read from
    known = groups.join(links, key, "left").join(components, F.col("rep") == F.col("node"), "left")
    known = known.select(*key, (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("component", "rep").alias("component"))
    mine = keyed.select("id", *key).join(known, key).select("id", "links", "component")
    # rows that cannot be compared are not in `mine`; a vec_id may stand for several rows
    whole = source.select("id", (F.size("embedding") > 0).alias("any"), "embedding")
    bad = whole.where(F.col("id").isNull() | ~_comparable()).select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component"))
    every = mine.union(bad)
    return every.select(F.col("id").alias("vec_id"), F.col("links").alias("n_links"), F.col("component").alias("component_id"), F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))


def _comparable():
    x = F.col("embedding")
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return F.coalesce((F.size(x) > 0) & sound & F.exists(x, lambda v: v != 0), F.lit(False))


def _visits(units: np.ndarray, pivots: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each vector, and which cells of higher number it visits.

    A partner at home in q is no farther than `reach`, so the vector is at most that far beyond the bisecting plane.
    """
    near = units @ pivots.T
    home = near.argmax(axis=1)
    gap = near.max(axis=1)[:, None] - near
    far = np.sqrt(np.maximum(2 - 2 * (pivots[home] @ pivots.T), 0))
    return home, (gap <= reach * far + 1e-9) & (np.arange(len(pivots))[None, :] > home[:, None])


def _pivots(sample: np.ndarray, n: float, reach: float, tile: int) -> np.ndarray:
    """As many of the sample's first vectors as make comparing n vectors cheapest, by the sample's homes and visits.

    Vectors in clusters visit few cells, and more cells leave fewer products; vectors without clusters visit all cells, and
    fewer cells leave fewer copies.
    """
    best, cost, count = 1, float("inf"), 1
    while count <= min(len(sample), MOST_PIVOTS):
        home, visit = _visits(sample, sample[:count], reach)
        homes = np.bincount(home, minlength=count) / len(sample) * n
        met = homes + visit.sum(axis=0) / len(sample) * n
        copies = (met * np.ceil(homes / tile) + homes * np.ceil(met / tile)).sum()
        now = copies * COPY_COST + (homes * met).sum() * PRODUCT_COST
        if now < cost:
            best, cost = count, now
        count *= 2
    return sample[:best]


def _tiles(unique: DataFrame, work: Workspace, pivots: int, threshold: float, tile: int) -> DataFrame:
    """Rows of `unique` with the tile that they are compared in, and whether they are at home and a visitor there.

    Of a pair the vector of the lower cell visits the cell of the higher one.  Homes and what meets them
    (homes and visitors) are cut into blocks; a tile holds one of each, so no task grows with a cell.
    """
    spark = unique.sparkSession
    reach, total = sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6, unique.count()
    sample = unique.orderBy(F.xxhash64("h1", "h2"), "h1", "h2").limit(SAMPLE).select("size", "vector").collect()
    # pivots are compared with vectors of their own number of dimensions only; others meet in cell 0 of theirs
    points: dict[int, np.ndarray] = {}
    for size in {r["size"] for r in sample}:
        own = unit(_unpacked([r["vector"] for r in sample if r["size"] == size], size))
        points[size] = own[:pivots] if pivots else _pivots(own, total * len(own) / len(sample), reach, min(tile, max(PRODUCTS, TILE_NUMBERS // size)))
    shared = spark.sparkContext.broadcast(points)

    def deal(batches):
        for batch in batches:
            sizes, vectors = batch.column(batch.schema.get_field_index("size")).to_numpy(), batch.column(batch.schema.get_field_index("vector")).to_pylist()
            homes, visits = np.zeros(len(sizes), np.int64), [[] for _ in vectors]
            for size in np.unique(sizes).tolist():
                p = shared.value.get(size)
                if p is None:
                    continue
                own = np.flatnonzero(sizes == size).tolist()
                home, visit = _visits(unit(_unpacked([vectors[i] for i in own], size)), p, reach)
                for k, i in enumerate(own):
                    homes[i], visits[i] = home[k], np.flatnonzero(visit[k]).tolist()
            out = {n: batch.column(n) for n in batch.schema.names} | {"home": pa.array(homes), "visits": pa.array(visits, pa.list_(pa.int64()))}
            yield pa.RecordBatch.from_arrays([*out.values()], names=[*out])

    columns = unique.select("size", "h1", "h2", "rep", "vector", "n")
    dealt = work.save(columns.mapInArrow(deal, "size int, h1 long, h2 long, rep long, vector binary, n long, home long, visits array<long>"), "dealt")
    cells = dealt.select("size", F.explode(F.concat(F.array("home"), "visits")).alias("cell"), (F.col("home")).alias("home"))
    counts = cells.groupBy("size", "cell").agg(F.count_if(F.col("home") == F.col("cell")).alias("homes"), F.count("*").alias("all"))
    side = F.least(F.lit(tile), F.greatest(F.lit(PRODUCTS), F.floor(F.lit(TILE_NUMBERS) / F.col("size"))))
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(n / side)).cast("int")
    sized = counts.select("size", "cell", blocks(F.col("homes")).alias("h"), blocks(F.col("all")).alias("v"))
    met = dealt.withColumn("cell", F.explode(F.concat(F.array("home"), "visits"))).drop("visits").join(sized, ["size", "cell"])
    at = lambda n, salt: F.pmod(F.xxhash64(F.lit(salt), "h1", "h2"), n).cast("int")
    place = lambda h, v, home, visitor: F.struct(h.alias("h"), v.alias("v"), home.alias("home"), visitor.alias("visitor"))
    yes, no = F.lit(True), F.lit(False)
    at_home = F.transform(F.sequence(F.lit(0), F.col("v") - 1), lambda v: place(at(F.col("h"), "h"), v, yes, v == at(F.col("v"), "v")))
    others = F.filter(F.transform(F.sequence(F.lit(0), F.col("h") - 1), lambda h: place(h, at(F.col("v"), "v"), no, yes)), lambda p: (F.col("home") != F.col("cell")) | (p["h"] != at(F.col("h"), "h")))
    spread = met.withColumn("at", F.explode(F.when(F.col("home") == F.col("cell"), F.concat(at_home, others)).otherwise(others)))
    return spread.select(F.struct("size", "cell", "at.h", "at.v").alias("tile"), "rep", "size", "h1", "h2", "n", "vector", (F.col("home") == F.col("cell")).alias("inner"), "at.home", "at.visitor")


def _comparer(threshold: float):
    def compare(group: pd.DataFrame) -> pd.DataFrame:
        one, two = np.flatnonzero(group["home"].to_numpy()), np.flatnonzero(group.visitor.to_numpy())
        reps, weight, inner = group.rep.to_numpy(), group.n.to_numpy(), group.inner.to_numpy()
        links, label = np.zeros(len(group)), np.arange(len(group))
        order = np.empty(len(group), np.int64)
        order[np.lexsort((group.h2.to_numpy(), group.h1.to_numpy()))] = np.arange(len(group))
        raw = _unpacked(group.vector.tolist(), int(group["size"].iloc[0]))
        raw = raw / np.abs(raw).max(axis=1, keepdims=True)
        units = unit(raw)
        for a in range(0, len(one), PRODUCTS):
            for b in range(0, len(two), PRODUCTS):
                i, j = possible_pairs(units[one[a : a + PRODUCTS]], units[two[b : b + PRODUCTS]], threshold)
                i, j = one[a + i], two[b + j]
                # two vectors at home here meet in both orders of their blocks: each pair counts where its digests are in order
                wanted = (i != j) & (~inner[j] | (order[i] < order[j]))
                i, j = i[wanted], j[wanted]
                good = np.zeros(len(i), bool)
                for s in range(0, len(i), 1 << 16):
                    part = slice(s, s + (1 << 16))
                    good[part] = cosines(raw[i[part]], raw[j[part]]) >= threshold
                i, j = i[good], j[good]
                links += np.bincount(i, weight[j], len(group)) + np.bincount(j, weight[i], len(group))
                label = _merged(label, i, j)
        # each vector points at the smallest of those that links reach within the tile
        least = reps.copy()
        np.minimum.at(least, label, reps)
        parent = least[label]
        linked = np.flatnonzero(links > 0)
        shown = group.iloc[linked]
        return pd.DataFrame({"rep": reps[linked], "size": shown["size"].to_numpy(), "h1": shown.h1.to_numpy(), "h2": shown.h2.to_numpy(), "links": links[linked].astype("int64"), "parent": parent[linked]})

    return compare


def _merged(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after the groups of i[k] and j[k] are made one, for every k; only distinct pairs of labels are kept for it."""
    n = len(label)
    a, b = label[i], label[j]
    codes = np.unique((np.minimum(a, b) * n + np.maximum(a, b))[a != b])
    if not len(codes):
        return label
    a, b, root = codes // n, codes % n, np.arange(n)
    while (root[a] != root[b]).any():
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
    return root[label]
