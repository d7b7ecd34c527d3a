"""Customer cells of CAS numbers: one row per token, evidence, repair, and the tables made of them.

Rows need a number of their own (`row`), given when they are read: what comes first is decided by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from chemlake.functions import cas
from chemlake.functions import sql_text as S
from chemlake.functions.sql_text import Text
from chemlake.functions.text import squeeze
from chemlake.operators.spread import made_once


#: Kinds of edits, in the order in which they count: of a date, a swap of neighbours, a neighbouring key.
DATE, SWAP, NEAR = 1, 2, 3


def _column(text: Text) -> Column:
    return F.expr(str(text))


def designation_key(c: Text) -> Column:
    return _column(S.upper(squeeze(c)))


def explode_tokens(cells: DataFrame) -> DataFrame:
    """(row, code, name, pos, token) of cells (row, cas, code, name); all-zero tokens and blanks are left out."""
    shown = cells.select("row", "code", "name", F.posexplode(_column(S.transform(cas.tokens(S.col("cas")), squeeze))).alias("pos", "token"))
    return shown.where(_column((S.col("token") != "") & ~cas.all_zero(S.col("token"))))


def evidence(tokens: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbers known of each code and of each designation: valid ones, and those that a date hides."""
    t = S.col("token")
    number = _column(S.when(cas.valid(t), t).otherwise(cas.from_date(t)))
    named = tokens.select(F.trim("code").alias("code"), designation_key(S.col("name")).alias("designation"), "token")
    known = made_once(named, "cas", number).where("cas IS NOT NULL")
    return known.where("code <> ''").select("code", "cas").distinct(), known.where("designation <> ''").select("designation", "cas").distinct()


def _edits(lost: DataFrame) -> DataFrame:
    """lost (token and so on) with one row per edit that gives a valid number, or one without number if none does: kind
    (DATE, SWAP or NEAR), place, cas, and via, the edited text."""
    t, none = S.col("token"), S.array().cast("array<string>")
    dated, shaped = cas.date_like(t), S.rlike(t, cas.SHAPE)
    texts = S.concat(S.when(S.rlike(t, "[0-9][-/]"), cas.swaps(t)).otherwise(none), S.array(""), S.when(dated | shaped, cas.neighbour_digits(t)).otherwise(none))
    # the empty text parts swaps from neighbouring keys, and leaves a row where there is no edit
    spread = lost.selectExpr("*", f"{texts} AS _texts", f"{dated} AS _dated", f"{shaped} AS _shaped").selectExpr("*", "array_position(_texts, '') - 1 AS _parted")
    spread = spread.selectExpr(*lost.columns, "_dated", "_shaped", "_parted", "posexplode(_texts) AS (place, via)")
    v = S.col("via")
    hidden = S.when(S.col("_dated"), cas.from_date(v))
    judged = spread.selectExpr(*lost.columns, "place", "via", f"{hidden} AS _hidden", f"{cas.valid(v)} AS _good", "place < _parted AS _swap", "_shaped", "place = _parted AS _last")
    kind = f"CASE WHEN _hidden IS NOT NULL THEN {DATE} WHEN _good AND _swap THEN {SWAP} WHEN _good AND _shaped THEN {NEAR} END"
    found = judged.selectExpr("*", f"{kind} AS kind").where("kind IS NOT NULL OR _last")
    return found.selectExpr(*lost.columns, "kind", "place", f"CASE WHEN kind = {DATE} THEN _hidden WHEN kind IS NOT NULL THEN via END AS cas", "via")


def repair(tokens: DataFrame) -> DataFrame:
    """tokens with fixed and status.

    Each distinct token of a code and designation is looked at once.  In this order: it is valid; a date
    hides it; an edit of a date, a swap of neighbours or a neighbouring key gives valid numbers, of which evidence
    (2 for the code, 1 for the designation) picks one, or a swap is the only one; dashes or the check
    digit are missing; else it is invalid, with up to five suggestions.
    """
    by_code, by_name = evidence(tokens)
    t = S.col("token")
    keyed = tokens.withColumns({"code_key": F.expr("coalesce(trim(code), '')"), "name_key": designation_key(S.col("name"))})
    sure = made_once(keyed.select("token", "code_key", "name_key").distinct(), "fixed", _column(S.when(cas.valid(t), t).otherwise(cas.from_date(t))))
    known = sure.where("fixed IS NOT NULL").selectExpr("token", "code_key", "name_key", "fixed", "IF(fixed = token, 'valid', format_string('valid (fixed from: %s)', token)) AS status")
    open_ = sure.where("fixed IS NULL")

    spread = _edits(open_.select("token", "code_key", "name_key"))
    code_hit = by_code.select(F.col("code").alias("code_key"), "cas", F.lit(2).alias("two"))
    name_hit = by_name.select(F.col("designation").alias("name_key"), "cas", F.lit(1).alias("one"))
    scored = spread.join(code_hit, ["code_key", "cas"], "left").join(name_hit, ["name_key", "cas"], "left")
    # edits of one token, a few dozen at most, in order of place; of a number that several give, the first
    each = F.expr("CASE WHEN cas IS NOT NULL THEN struct(place, kind, cas, via, - (coalesce(two, 0) + coalesce(one, 0)) AS rank) END")
    listed = scored.groupBy("token", "code_key", "name_key").agg(F.array_sort(F.collect_list(each)).alias("all")).selectExpr("*", "array_min(transform(all, x -> x.kind)) AS kind")
    listed = listed.selectExpr("*", "filter(all, x -> x.kind = kind) AS same").selectExpr("*", "transform(same, x -> x.cas) AS numbers")
    listed = listed.selectExpr("*", "filter(same, (x, i) -> array_position(numbers, x.cas) = i + 1) AS in_order")
    ranked = listed.selectExpr("*", "array_sort(transform(in_order, x -> struct(x.rank AS rank, x.place AS place, x.cas AS cas, x.via AS via))) AS r")
    dashed, checked = cas.from_digits(S.regexp_replace(t, "[^0-9]", "")), cas.with_check_digit(t)
    told = ranked.selectExpr(
        "token", "code_key", "name_key", "kind", "get(r, 0) AS first", f"CASE WHEN kind IS NULL THEN {dashed} END AS dashed", f"CASE WHEN kind IS NULL THEN {checked} END AS checked",
        f"get(r, 0).rank < 0 AND (get(r, 1).rank IS NULL OR get(r, 1).rank > get(r, 0).rank) OR kind = {SWAP} AND size(r) = 1 AS clear",
        f"array_join(IF(kind = {DATE}, transform(slice(in_order, 1, 5), x -> format_string('%s (via %s)', x.cas, x.via)), transform(slice(r, 1, 5), x -> x.cas)), ' | ') AS said",
    )
    label = f"CASE kind WHEN {DATE} THEN format_string('valid (fixed via date-edit from: %s; via: %s)', token, first.via) WHEN {SWAP} THEN format_string('valid (fixed swap from: %s)', token) ELSE format_string('valid (fixed adjacent-key from: %s)', token) END"
    chosen = told.selectExpr(
        "token", "code_key", "name_key", "CASE WHEN kind IS NULL THEN coalesce(dashed, checked, token) WHEN clear THEN first.cas ELSE token END AS fixed",
        f"""CASE WHEN dashed IS NOT NULL THEN format_string('valid (fixed rehyphenated from: %s)', token) WHEN checked IS NOT NULL THEN format_string('valid (fixed checkdigit from: %s)', token)
            WHEN kind IS NULL THEN format_string('invalid (original: %s)', token) WHEN clear THEN {label} ELSE format_string('invalid (original: %s; suggestions: %s)', token, said) END AS status""",
    )
    decided = known.union(chosen)
    return keyed.join(decided, ["token", "code_key", "name_key"]).select("row", "code", "name", "pos", "token", "fixed", "status")


def first_of(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; null keys are equal."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def exploded_table(repaired: DataFrame, customer_id: str, seen: str) -> DataFrame:
    """The customer's table, one row per (code, name, number, status): the first wins."""
    shown = repaired.select("row", "pos", F.lit(customer_id).alias("customer_id"), F.lit(seen).alias("timestamp_seen_utc"), "code", "name", F.col("fixed").alias("cas"), F.col("status").alias("cas_validity"))
    return first_of(shown, ["code", "name", "cas", "cas_validity"], [F.col("row"), F.col("pos")]).drop("row", "pos")


def fixed_cells(cells: DataFrame, repaired: DataFrame) -> DataFrame:
    """(row, fixed_cas): each cell with its tokens repaired, or marked '(invalid)', joined by ' / '."""
    shown = F.when(cas.valid(F.col("fixed")), F.col("fixed")).otherwise(F.concat(F.col("token"), F.lit(" (invalid)")))
    joined = repaired.select("row", F.struct("pos", shown.alias("shown")).alias("x")).groupBy("row").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    return cells.select("row").join(joined, "row", "left").select("row", F.coalesce(F.array_join(F.transform("xs", lambda x: x["shown"]), " / "), F.lit("")).alias("fixed_cas"))


def first_tokens(cells: DataFrame, repaired: DataFrame) -> DataFrame:
    """(row, code, name, cas, status) of each cell's first token; cells without one are invalid."""
    first = repaired.groupBy("row").agg(F.min_by("fixed", "pos").alias("fixed"), F.min_by("status", "pos").alias("status"))
    return cells.select("row", "code", "name").join(first, "row", "left").select("row", "code", "name", F.coalesce("fixed", F.lit("")).alias("cas"), F.coalesce("status", F.lit("invalid (original: )")).alias("status"))


def first_valid(firsts: DataFrame, customer_id: str) -> DataFrame:
    """Rows of first_tokens for a customer, one per (code, name, cas): the first wins."""
    shown = firsts.withColumn("customer_id", F.lit(customer_id))
    return first_of(shown, ["customer_id", "code", "name", "cas"], [F.col("row")]).drop("row")


def run_counts(cells: DataFrame, exploded: DataFrame, firsts: DataFrame) -> DataFrame:
    """One row of counts for a run's manifest: rows read, rows of both tables, and distinct numbers of each."""
    one = cells.agg(F.count("*").alias("rows_input"))
    for name, table in (("exploded", exploded), ("first_valid", firsts)):
        one = one.join(F.broadcast(table.agg(F.count("*").alias(f"rows_{name}"), F.count_distinct("cas").alias(f"unique_cas_{name}"))), how="outer", on=F.lit(True))
    return one


def customer_feed(exploded: DataFrame) -> DataFrame:
    """The latest row of each (customer_id, cas) that is not blank or invalid, named as the customer map has it."""
    good = exploded.where((F.trim("cas") != "") & (F.trim("customer_id") != "") & ~F.lower("cas_validity").contains("invalid"))
    latest = first_of(good, ["customer_id", "cas"], [F.desc("timestamp_seen_utc"), F.asc("code"), F.asc("name")])
    return latest.withColumnRenamed("cas", "cas_number_normalized")


def upsert_customer_map(known: DataFrame, feed: DataFrame) -> DataFrame:
    """Known and new rows together; the latest of each (customer_id, cas_number_normalized), a new one on a tie."""
    both = known.withColumn("_src", F.lit(0)).unionByName(feed.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    texts = [c for c, t in both.dtypes if t == "string"]
    order = [F.desc("timestamp_seen_utc"), F.desc("_src"), *[F.desc(c) for c in sorted(texts) if c != "timestamp_seen_utc"]]
    return first_of(both.fillna("", texts), ["customer_id", "cas_number_normalized"], order).drop("_src")
