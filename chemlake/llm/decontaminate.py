"""Benchmark decontamination by greedy string tiling (operator 3).

Running Karp-Rabin fingerprints of all windows of `least` words are looked up among those of the benchmark
items; each document and item that share such a seed are tiled: the longest common run of words that touches
no marked word is marked, again and again.  Marked words over all words of the item are its coverage, which
passages in another order keep.
"""

from __future__ import annotations

import heapq
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chemlake.llm import words
from chemlake.llm.arrays import unused_name
from chemlake.llm.workspace import Workspace, small_batches

#: Words of the shortest run that counts as a match, and the share of an item that must be matched.
LEAST = 5
COVERAGE = 0.5
#: Bytes of benchmark text that are sent to the executors at once; a larger benchmark goes in several parts.
PART_BYTES = 32 << 20

LEAK = "array<struct<item_id:long,n_words:int,n_matched:int,n_tiles:int>>"

#: Odd base of the running fingerprints modulo 2**64, and its inverse.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _hashed(texts: pa.Array):
    """Word hashes of each text and the texts' first words, by slices: words of letters and digits, lower case."""
    lower = pc.utf8_lower(texts.fill_null(""))
    for first, end, data, offsets in words.text_slices(lower):
        hashes, _, heads = words.word_hashes(data, offsets, words.ALNUM_WORDS)
        yield first, end, hashes, heads


class Items:
    """A part of the benchmark: word hashes of each item, and the items of each seed, each once."""

    def __init__(self, rows: list[tuple[int, str]], least: int):
        self.ids, self.least = [i for i, _ in rows], least
        self.words: list[np.ndarray] = []
        for first, end, hashes, heads in _hashed(pa.array([t for _, t in rows], pa.string())):
            self.words += [hashes[heads[i] : heads[i + 1]] for i in range(end - first)]
        own = [np.unique(words.shingles(w, least)) for w in self.words]
        seeds = np.concatenate(own) if own else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(own)), [len(s) for s in own])
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.item = seeds[order], item[order]

    def leaks(self, hashes: np.ndarray, heads: np.ndarray, count: int, coverage: float) -> list[list[tuple]]:
        """For each of `count` documents the items of which at least `coverage` is matched."""
        found: list[list[tuple]] = [[] for _ in range(count)]
        runs = words.shingles(hashes, self.least)
        if not len(self.seeds) or not len(runs):
            return found
        at = np.searchsorted(self.seeds, runs)
        hit = np.flatnonzero(self.seeds[np.minimum(at, len(self.seeds) - 1)] == runs)
        owner = np.searchsorted(heads, hit, side="right") - 1
        inside = hit + self.least <= heads[owner + 1]
        hit, owner = hit[inside], owner[inside]
        for doc in np.unique(owner):
            places = hit[owner == doc]
            low, high = np.searchsorted(self.seeds, runs[places]), np.searchsorted(self.seeds, runs[places], side="right")
            # every place of a seed with every item that holds it
            n = high - low
            item = self.item[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())]
            there = np.repeat(places, n) - heads[doc]
            own = hashes[heads[doc] : heads[doc + 1]]
            order = np.argsort(item, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(item[order])) + 1):
                i = int(item[part[0]])
                tiles = greedy_tiles(self.words[i], own, there[part], self.least, coverage * len(self.words[i]))
                matched = sum(t[2] for t in tiles)
                if matched and matched >= coverage * len(self.words[i]):
                    found[doc].append((self.ids[i], len(self.words[i]), matched, len(tiles)))
        return found


class _Side:
    """Words of one text, some of them marked, with fingerprints of all windows of any length."""

    def __init__(self, own: np.ndarray, at: np.ndarray):
        self.words, self.at = own, at
        self.free = np.ones(len(own), bool)
        powers = np.ones(len(own) + 1, np.uint64)
        back = powers.copy()
        powers[1:], back[1:] = np.uint64(_BASE), np.uint64(_INVERSE)
        powers, self.back = np.cumprod(powers, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own * powers[:-1], dtype=np.uint64)])
        self.measure()

    def measure(self) -> None:
        """How many unmarked words that follow one another there are from each word on."""
        stop = np.append(np.flatnonzero(~self.free[:-1] | ~self.free[1:] | (np.diff(self.at) != 1)) if len(self.at) > 1 else np.zeros(0, np.int64), len(self.at) - 1)
        ends = stop[np.searchsorted(stop, np.arange(len(self.at)))]
        self.room = np.where(self.free, ends - np.arange(len(self.at)) + 1, 0)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(first words, fingerprints) of the unmarked windows of a size."""
        first = np.flatnonzero(self.room >= size)
        return first, (self.sums[first + size] - self.sums[first]) * self.back[first]


def greedy_tiles(item: np.ndarray, text: np.ndarray, there: np.ndarray, least: int, wanted: float = 0) -> list[tuple[int, int, int]]:
    """(place in item, place in text, words) of the tiles, the longest first; there: where text may match a window of item.

    The longest common run is found by bisection over running fingerprints, so memory is linear in both texts
    however often words repeat.  Runs of one length are marked by diagonal, then place.  Texts that cannot
    have `wanted` words in tiles have none.
    """
    at = np.unique((there[:, None] + np.arange(least)[None, :]).ravel())
    if min(len(at), len(item)) < wanted or not len(at):
        return []
    one, two, tiles, longest = _Side(item, np.arange(len(item))), _Side(text[at], at), [], len(item)
    while True:
        common = lambda size: bool(np.isin(one.windows(size)[1], two.windows(size)[1]).any())  # noqa: B023, E731
        low, high = least - 1, min(longest, int(one.room.max()), int(two.room.max()))
        while low < high:  # the largest size with a common window
            middle = (low + high + 1) // 2
            low, high = (middle, high) if common(middle) else (low, middle - 1)
        if low < least:
            return tiles
        longest = low
        for i, t in _in_order(one, two, low):
            one.free[i : i + low] = two.free[t : t + low] = False
            tiles.append((i, int(two.at[t]), low))
        one.measure()
        two.measure()


def _in_order(one: _Side, two: _Side, size: int):
    """Pairs of equal windows that touch none taken before, by diagonal, then place; lists of places are merged, not crossed."""
    (i_first, i_print), (t_first, t_print) = one.windows(size), two.windows(size)
    order = np.lexsort((t_first, t_print))
    t_first, t_print = t_first[order], t_print[order]
    low, high = np.searchsorted(t_print, i_print), np.searchsorted(t_print, i_print, side="right")
    heap = [(int(two.at[t_first[a]]) - int(i), int(i), int(a), int(b)) for i, a, b in zip(i_first, low, high, strict=True) if a < b]
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        if not one.free[i : i + size].all():
            continue
        t = int(t_first[a])
        if two.free[t : t + size].all() and (one.words[i : i + size] == two.words[t : t + size]).all():
            yield i, t
        elif a + 1 < b:
            heapq.heappush(heap, (int(two.at[t_first[a + 1]]) - i, i, a + 1, b))


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, least: int = LEAST, coverage: float = COVERAGE, text: str = "text", out: str = "leaks", part_bytes: int = PART_BYTES) -> DataFrame:
    """docs with the array `out` of the benchmark items that they leak: item_id, n_words, n_matched, n_tiles.

    The benchmark goes to the executors in parts of about part_bytes, one after another: no more than one part is in
    memory at once, and a benchmark of one part needs no shuffle.  Of more parts, what each finds is written by the
    digest of the text, and joined to docs at the end.  Items of fewer than `least` words, null texts and items
    without id match nothing; an empty benchmark gives empty arrays, and an empty table stays empty.  Equal rows of
    the benchmark are one item; items that share an id with different texts may both be listed.  Texts are looked at
    whole and one by one, so repeated rows have equal leaks; a column called `out` is replaced, others are kept.
    """
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("item_text")).distinct()
    total = items.agg(F.sum(F.octet_length("item_text"))).first()[0] or 0
    parts = max(1, ceil(total / part_bytes))

    def shared(part: int):
        return spark.sparkContext.broadcast([(r.item_id, r.item_text) for r in items.where(F.pmod(F.xxhash64("item_id", "item_text"), F.lit(parts)) == part).collect()])

    if parts == 1:
        return docs.withColumn(out, F.array_sort(_finder(shared(0), least, coverage)(F.col(text))))
    work, digest, found = Workspace(spark), unused_name(docs, "_digest"), None
    for part in range(parts):
        sent = shared(part)
        hits = docs.select(F.sha2(F.col(text), 256).alias(digest), _finder(sent, least, coverage)(F.col(text)).alias("found"))
        own = work.save(hits.where(F.size("found") > 0).groupBy(digest).agg(F.any_value("found").alias("found")), f"part{part}")
        found = own if found is None else found.union(own)
        sent.destroy()
    by_text = found.groupBy(digest).agg(F.array_sort(F.flatten(F.collect_list("found"))).alias("_found"))
    kept = [F.col(c) for c in docs.columns if c != out]
    joined = docs.withColumn(digest, F.sha2(F.col(text), 256)).join(by_text, digest, "left")
    return joined.select(*kept, F.coalesce("_found", F.array().cast(LEAK)).alias(out))


def _finder(shared, least: int, coverage: float):
    built: dict[str, Items] = {}

    @F.arrow_udf(LEAK)
    def find(texts: pa.Array) -> pa.Array:
        if "items" not in built:
            built["items"] = Items(shared.value, least)
        out = []
        for first, end, hashes, heads in _hashed(texts):
            out += built["items"].leaks(hashes, heads, end - first, coverage)
        kind = pa.struct([("item_id", pa.int64()), ("n_words", pa.int32()), ("n_matched", pa.int32()), ("n_tiles", pa.int32())])
        return pa.array([[dict(zip(("item_id", "n_words", "n_matched", "n_tiles"), x, strict=True)) for x in row] for row in out], pa.list_(kind))

    return find
