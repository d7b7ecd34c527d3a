"""Periodic runs of words (operator 13).

A run is a stretch of consecutive words with smallest period q, at least two periods long, that no neighbouring word
extends.  Every run starts a period with a word sequence that is Lyndon under the order of the words or under its
reverse, and there that sequence is the longest Lyndon one.  So the Lyndon array of each order is computed from the
words' ranks alone: from right to left, each position's next smaller suffix is found along the chain of those of the
position after it.  Common extensions are taken over from that chain wherever they differ from the chain's own, and what
has been matched at one distance is never matched again.  No suffix array or tree is built, and no stretch of words is hashed.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chemlake.llm.arrays import unused_name
from chemlake.llm.workspace import small_batches

RUN = "struct<start:bigint,length:bigint,period:bigint>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def lyndon_array(ranks: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(next smaller suffix of each position, length of its common extension with that one, positions where this is not 0, from right to left).

    The end is a suffix, smaller than all.  The longest Lyndon sequence at i ends before the next smaller suffix.
    """
    n = len(ranks)
    x = [*ranks, -1]
    following, common, repeated = [n] * (n + 1), [0] * (n + 1), []
    # of each distance, the place and the end of what was matched last; all later places are further left
    seen, ends = [n] * (n + 1), [n] * (n + 1)
    for i in range(n - 1, -1, -1):
        c, j = x[i], i + 1
        while x[j] > c:
            j = following[j]
        if x[j] < c:
            following[i] = j
            continue
        a = 1
        while True:
            d, k = j - i, i + a
            stop = seen[d]
            while k < stop and x[k] == x[k + d]:
                k += 1
            if k >= stop and stop < n:
                k = ends[d]
            seen[d], ends[d] = i, k
            a = k - i
            if x[j + a] < x[k]:
                break
            # j's suffix is the larger one: on along the chain, with comparisons only where both extensions are equal
            b, j = common[j], following[j]
            while b > a:
                b, j = common[j], following[j]
            if b < a:
                a = b
                break
        following[i] = j
        if a:
            common[i] = a
            repeated.append(i)
    return following, common, repeated


def _runs_of_order(ranks: list[int], least: int, found: dict[tuple[int, int], int]) -> None:
    following, common, repeated = lyndon_array(ranks)
    last: dict[int, tuple[int, int]] = {}  # of each period, begin and end of the last stretch
    for i in reversed(repeated):
        j, right = following[i], common[i]
        p = j - i
        begin, end = last.get(p, (0, -1))
        if i > end:
            begin, floor = i, max(end, 0)
            while begin > floor and ranks[begin - 1] == ranks[begin - 1 + p]:
                begin -= 1
            last[p] = begin, i + right
        if i - begin < p and (length := j + right - begin) >= 2 * p and length >= least:
            found[begin, p] = length


def find_runs_of(words: list, least: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of each run of at least `least` words, by start and period."""
    if len(words) < max(least, 2):
        return []
    rank = {w: k for k, w in enumerate(sorted(set(words)))}
    if len(rank) == len(words):
        return []
    ranks = [rank[w] for w in words]
    found: dict[tuple[int, int], int] = {}
    _runs_of_order(ranks, least, found)
    top = len(rank)
    _runs_of_order([top - r for r in ranks], least, found)
    return sorted((start, length, p) for (start, p), length in found.items())


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """words without those that some run holds after its first period."""
    kept, at = [], 0
    for begin, end in sorted((start + p, start + length) for start, length, p in runs):
        kept += words[at:begin] if at < begin else []
        at = max(at, end)
    return kept + words[at:]


def find_runs(docs: DataFrame, *, least: int = 12, text: str = "text", out: str = "runs") -> DataFrame:
    """docs with a column `out`: n_words, runs (start, length, period in words, by start and period), collapsed (text).

    Words are whatever white space of ASCII parts.  Runs are of `least` words and two periods at least; collapsed is the
    words that no run holds after its first period, joined by one space.  Null and empty texts have no words, no runs
    and collapse to an empty text.  Very long texts are searched whole, in time that grows with their words whatever
    repeats in them.  Runs of one start are in order of their periods.  Repeated rows get their result again, and an
    empty table stays empty.  A column called like `out` is replaced, all others are kept.
    """
    small_batches(docs.sparkSession)
    kind = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])

    @F.arrow_udf(f"struct<n_words:bigint,runs:array<{RUN}>,collapsed:string>")
    def search(texts: pa.Array) -> pa.Array:
        rows = []
        for value in texts.cast(pa.large_binary()):
            words = (value.as_py() or b"").split()
            runs = find_runs_of(words, least)
            rows.append({"n_words": len(words), "runs": [{"start": s, "length": n, "period": p} for s, n, p in runs], "collapsed": b" ".join(collapse(words, runs)).decode("utf-8", "replace")})
        return pa.array(rows, kind)

    found = unused_name(docs, "_found")
    return docs.withColumn(found, search(F.coalesce(F.col(text), F.lit("")))).drop(out).withColumnRenamed(found, out)
