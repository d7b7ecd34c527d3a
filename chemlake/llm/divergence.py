"""Audit of how the sources of each language diverge in their words (operator 12).

Words are counted where the texts are; counts of a language, source and term meet in one aggregation.  A pair of sources
is summed over the terms that either holds, as differences from what two absent terms give, and the terms that neither
holds are that baseline times their number.  The terms that stand out most in a source are found by radix selection:
counts by digits of the values give each group's threshold from the highest digit down, then counts by bytes of the terms
part those that are equal at it, so that no group is sorted as a whole.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chemlake.llm.workspace import Workspace, small_batches

#: Terms counted in a task before they are handed on.
HELD = 300_000
#: Shares are in parts of this.
SCALE = 1_000_000_000
#: Bits of a value, and bytes of a term, that one pass over the candidates tells apart.
DIGIT_BITS, DIGIT_BYTES = 12, 2
#: What is equal at the threshold is parted further only in groups where so many or more are left; fewer are ranked at once.
FEW = 256

_COLUMNS = "lang string, source string, term string, n long, docs long"
_LETTERS = bytes(range(0x41, 0x5B))
#: A-Z to a-z, whatever is no letter of ASCII and in ASCII to a space.
_FOLD = bytes(b + 32 if b in _LETTERS else b if b >= 0x80 or 0x61 <= b <= 0x7A else 32 for b in range(256))


def _count(batches):
    """Occurrences and documents of each (lang, source, term); a null term says that the group occurs."""
    words: dict[tuple[str, str], Counter] = {}
    holders: dict[tuple[str, str], Counter] = {}

    def handed_on():
        for group, counted in words.items():
            docs = holders[group]
            terms = list(counted)
            n = len(terms) + 1
            columns = [pa.array([group[0]] * n), pa.array([group[1]] * n), pa.array([None, *[t.decode("utf-8", "replace") for t in terms]], pa.string())]
            numbers = [pa.array([0, *map(c.__getitem__, terms)], pa.int64()) for c in (counted, docs)]
            yield pa.RecordBatch.from_arrays([*columns, *numbers], ["lang", "source", "term", "n", "docs"])
        words.clear()
        holders.clear()

    held = 0
    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.large_binary()), strict=True):
            found = (text.as_py() or b"").translate(_FOLD).split()
            group = lang or "", source or ""
            if group not in words:
                words[group], holders[group] = Counter(), Counter()
            held -= len(words[group])
            words[group].update(found)
            holders[group].update(set(found))
            held += len(words[group])
            if held >= HELD:
                yield from handed_on()
                held = 0
    yield from handed_on()


def count_terms(docs: DataFrame, *, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents; the row of a null term stands for the group itself.

    A term is a run of ASCII letters, of which A-Z count as a-z, and of characters outside ASCII.  Null texts, languages
    and sources are empty ones.  Each row is a document.
    """
    small_batches(docs.sparkSession)
    counted = docs.select(F.col(lang).cast("string"), F.col(source).cast("string"), F.col(text).cast("string")).mapInArrow(_count, _COLUMNS)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: str, total: str, terms: str) -> Column:
    """One and the billionths that n of total occurrences make up, with two more for each of the terms; exact at any size."""
    return F.expr(f"1 + (cast({n} + 2 as decimal(22,0)) * cast({SCALE} as decimal(10,0))) div cast({total} + 2 * {terms} as decimal(22,0))")


def divergence(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _cut(rows: DataFrame, group: list[str], digit: Column, descending: bool, columns: list[str], work: Workspace, name: str) -> DataFrame:
    """`columns` of the rows up to each group's digit of the threshold; those before it are `sure`, and `want` says how many more are looked for.

    Counts of a group's digits are few, whatever the group holds, so the running sums are over small tables.
    """
    marked = rows.withColumn("_digit", digit)
    counts = marked.where("NOT sure").groupBy(*group, "_digit").agg(F.count("*").alias("_m"), F.first("want").alias("_want"))
    order = F.col("_digit").desc() if descending else F.col("_digit").asc()
    before = F.coalesce(F.sum("_m").over(Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = counts.withColumn("_before", before).where("_before < _want AND _before + _m >= _want")
    cut = at.select(*group, F.col("_digit").alias("_at"), (F.col("_want") - F.col("_before")).alias("_left"))
    joined = marked.join(cut, group, "left")
    past = (F.col("_digit") > F.col("_at")) if descending else (F.col("_digit") < F.col("_at"))
    # a group without such a digit has no more rows than are looked for
    sure = F.col("sure") | F.col("_at").isNull() | past
    kept = joined.where(sure | (F.col("_digit") == F.col("_at")))
    return work.save(kept.select(*columns, sure.alias("sure"), F.coalesce("_left", "want").alias("want")), name)


def radix_top(rows: DataFrame, group: list[str], value: str, item: str, k: int, work: Workspace) -> DataFrame:
    """rows of the k largest values of each group with their rank; of equal values the item of smaller UTF-8 bytes is first.

    Values are longs of 0 or more, the items of one group and value differ, and groups hold no nulls.  Null values and
    items are no candidates.  Each pass reads the candidates and keeps those that may still be among the k.
    """
    columns = rows.columns
    state = rows.where(F.col(value).isNotNull() & F.col(item).isNotNull()).withColumns({"sure": F.lit(False), "want": F.lit(k).cast("long")})
    most = rows.agg(F.max(value)).first()[0] or 0
    last = ""
    for step in range(max(0, int(most).bit_length() - 1) // DIGIT_BITS, -1, -1):
        digit = F.shiftright(F.col(value), step * DIGIT_BITS).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))
        state = _cut(state, group, digit, True, columns, work, f"value{step}")
        if last:
            work.drop(last)
        last = f"value{step}"
    step = 0
    while True:
        # rows that are not sure are equal in value; what their items begin with in common is passed over
        equal = state.where("NOT sure").groupBy(*group).agg(F.count("*").alias("_n"), F.min(item).alias("_low"), F.max(item).alias("_high")).where(F.col("_n") >= FEW)
        if equal.isEmpty():
            break
        skip = equal.select(*group, _common_bytes(F.encode("_low", "utf-8"), F.encode("_high", "utf-8")).alias("_skip"))
        # groups of few stay as they are: none of their rows is cut, as they all have one digit
        part = F.rpad(F.hex(F.substring(F.encode(F.col(item), "utf-8"), F.col("_skip") + 1, F.lit(DIGIT_BYTES))), 2 * DIGIT_BYTES, " ")
        state = _cut(state.join(skip, group, "left"), group, F.coalesce(part, F.lit("")), False, columns, work, f"bytes{step}")
        work.drop(last)
        last, step = f"bytes{step}", step + 1
    window = Window.partitionBy(*group).orderBy(F.col(value).desc(), F.col(item).asc())
    return state.drop("sure", "want").withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def _common_bytes(low: Column, high: Column) -> Column:
    """Bytes that two binaries share at their beginnings."""
    a, b = F.hex(low), F.hex(high)
    differs = F.array_position(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.octet_length(low), F.octet_length(high)))), lambda i: F.substring(a, 2 * i - 1, F.lit(2)) == F.substring(b, 2 * i - 1, F.lit(2))), F.lit(False))
    return F.when(differs > 0, differs - 1).otherwise(F.least(F.octet_length(low), F.octet_length(high))).cast("int")


def audit_sources(docs: DataFrame, *, least_docs: int = 10, top: int = 10, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): pairs of sources by divergence, and each source's terms that stand out.

    Part `pair` has each other source of the language, part `term` the terms that are more frequent in the source than in
    its language, `top` of them.  Terms are kept by language, if `least_docs` of its documents hold them.  Null texts,
    languages and sources are empty ones; a source without kept terms is compared as one that holds each of them no
    time.  Very long texts are counted whole.  Of equal values the item of smaller UTF-8 bytes comes first.  Each row is a
    document, so a repeated row counts again.  An empty table gives no rows, a language of one source no pairs.  Other columns of
    docs are ignored, whatever they are called.
    """
    work = Workspace(docs.sparkSession)
    counts = work.save(count_terms(docs, lang=lang, source=source, text=text), "counts")
    whole = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs).drop("docs")
    whole = work.save(whole, "whole")
    kept = work.save(counts.where("term IS NOT NULL").select("lang", "source", "term", "n").join(whole, ["lang", "term"]), "kept")
    langs = whole.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    named = counts.where("term IS NULL").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = named.select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "terms", "lang_total")])
    groups = work.save(groups.withColumn("absent", F.when(F.col("terms") > 0, share("0", "total", "terms"))), "groups")
    shares = kept.join(groups, ["lang", "source"]).select("lang", "source", "term", "lang_n", "lang_total", "terms", "absent", share("n", "total", "terms").alias("p"))
    shares = work.save(shares, "shares")
    return _pairs(shares, groups, work).unionByName(_terms(shares, top, work))


def _pairs(shares: DataFrame, groups: DataFrame, work: Workspace) -> DataFrame:
    """Each pair of sources once, in both of its directions."""
    a = groups.select("lang", F.col("source").alias("a"), F.col("absent").alias("a0"), "terms")
    b = groups.select("lang", F.col("source").alias("b"), F.col("absent").alias("b0"))
    pairs = a.join(b, "lang")
    nothing = divergence("a0", "b0")
    # terms of a: what they add where b lacks them, by the few different shares that a source has
    alone = shares.groupBy("lang", F.col("source").alias("a"), "p").agg(F.count("*").alias("m"))
    added = pairs.where("a <> b").join(alone, ["lang", "a"]).groupBy("lang", "a", "b").agg(F.sum(F.col("m") * (divergence("p", "b0") - nothing)).alias("s"))
    both_ways = added.select("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "s")
    # terms of both: the true value in place of the two that were added
    one = shares.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("pa"), F.col("absent").alias("a0"))
    two = shares.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("pb"), F.col("absent").alias("b0"))
    mend = divergence("pa", "pb") - divergence("pa", "b0") - divergence("pb", "a0") + nothing
    mended = one.join(two, ["lang", "term"]).where("a < b").groupBy("lang", "a", "b").agg(F.sum(mend).alias("s"))
    base = pairs.where("a < b").select("lang", "a", "b", F.coalesce(F.col("terms") * nothing, F.lit(0)).alias("s"))
    value = base.unionByName(both_ways).unionByName(mended).groupBy("lang", "a", "b").agg(F.sum("s").alias("value"))
    value = work.save(value, "pairs")
    turned = value.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value")
    all_pairs = value.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(turned)
    window = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    return all_pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.col("value").cast("long").alias("value"), F.row_number().over(window).alias("rank"))


def _terms(shares: DataFrame, top: int, work: Workspace) -> DataFrame:
    compared = shares.withColumn("q", share("lang_n", "lang_total", "terms")).where("p > q")
    valued = work.save(compared.select("lang", "source", F.col("term").alias("item"), divergence("p", "q").alias("value")), "valued")
    ranked = radix_top(valued, ["lang", "source"], "value", "item", top, work)
    return ranked.select("lang", "source", F.lit("term").alias("part"), "item", F.col("value").cast("long").alias("value"), "rank")
