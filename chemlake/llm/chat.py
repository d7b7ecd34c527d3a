"""Preference formatting of conversations, with DataFrame functions only (operator 7).

The longest common turn prefix of a chosen and a rejected conversation is rendered once as the prompt; what
follows in each is its completion, with the places that training is to look at (the assistant's turns).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chemlake.llm.arrays import prefix_fold

# What opens and closes a rendered turn, and how a mark inside a turn is written instead.
START, MIDDLE, END = "<|im_start|>", "\n", "<|im_end|>\n"
MARK, ESCAPED = "<|", "< |"
LEARNT = "assistant"


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation by turn number; equal numbers by role, then text.

    Null roles and texts are empty; rows without conv_id are left out; a null turn number comes first.  A
    repeated row is a turn of its own.
    """
    turn = F.struct(F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    listed = conversations.where("conv_id IS NOT NULL").groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return listed.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def natural_pairs(conversations: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id): conversations 2k and 2k + 1, and the first conversation of each first turn with the others of it.

    One pair at most for each conversation of either sort, however many share a first turn.
    """
    known = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    number = F.coalesce(F.col("turn").cast("long"), F.lit(-(1 << 63)))
    # the first turn by number, role and text, told by two hashes of it
    least = known.groupBy("conv_id").agg(F.min(number).alias("least"))
    heads = known.withColumn("number", number).join(least, "conv_id").where("number = least").groupBy("conv_id").agg(F.min(F.concat("role", F.lit("\0"), "text")).alias("head"))
    ids = heads.select("conv_id", F.xxhash64("head").alias("h1"), F.xxhash64(F.lit(1), "head").alias("h2"))
    even = F.when(F.pmod("conv_id", F.lit(2)) == 0, F.col("conv_id")).otherwise(F.col("conv_id") - 1)
    next_to = ids.groupBy(even.alias("chosen_id")).agg(F.count("*").alias("n"), F.max("conv_id").alias("rejected_id")).where("n = 2").select("chosen_id", "rejected_id")
    first = ids.groupBy("h1", "h2").agg(F.min("conv_id").alias("chosen_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    same = ids.join(first, ["h1", "h2"]).where("conv_id > chosen_id").select("chosen_id", F.col("conv_id").alias("rejected_id"))
    return next_to.union(same).distinct()


def _rendered(turns: Column) -> Column:
    """Each turn as text; marks inside a turn cannot open or close one."""
    clean = lambda x: F.replace(x, F.lit(MARK), F.lit(ESCAPED))
    return F.transform(turns, lambda t: F.struct(F.concat(F.lit(START), clean(t["role"]), F.lit(MIDDLE)).alias("open"), F.concat(clean(t["text"]), F.lit(END)).alias("body"), (t["role"] == LEARNT).alias("learnt")))


def _text(rendered: Column) -> Column:
    return F.array_join(F.transform(rendered, lambda t: F.concat(t["open"], t["body"])), "")


def _mask(rendered: Column) -> Column:
    """begin:end (code points, end exclusive) of what is learnt: the assistant's texts and their end marks."""
    ends = prefix_fold(F.transform(rendered, lambda t: F.length(t["open"]) + F.length(t["body"])), lambda a, b: a + b)
    spans = F.zip_with(rendered, ends, lambda t, e: F.when(t["learnt"], F.concat((e - F.length(t["body"])).cast("string"), F.lit(":"), e.cast("string"))))
    return F.array_join(spans, ",")


def format_preferences(conversations: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per pair (chosen_id, rejected_id): n_prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask.

    Turns are equal if role and text are.  Conversations without a common turn have an empty prompt, equal
    ones empty completions.  Pairs of which a conversation is missing or null give no row; a repeated pair
    gives its row again.  Other columns of both tables are ignored.
    """
    convs = turns_of(conversations)
    one, two = convs.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("a")), convs.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("b"))
    both = pairs.select("chosen_id", "rejected_id").join(two, "rejected_id").join(one, "chosen_id")
    differs = F.array_position(F.zip_with("a", "b", lambda x, y: x.eqNullSafe(y)), F.lit(False))
    n = F.when(differs == 0, F.least(F.size("a"), F.size("b"))).otherwise(differs - 1).cast("int")
    rest = lambda x: F.slice(x, F.col("n_prompt_turns") + 1, F.greatest(F.size(x) - F.col("n_prompt_turns"), F.lit(0)))
    cut = both.withColumn("n_prompt_turns", n).select("chosen_id", "rejected_id", "n_prompt_turns", F.slice("a", 1, F.col("n_prompt_turns")).alias("p"), rest("a").alias("a"), rest("b").alias("b"))
    shown = cut.select("chosen_id", "rejected_id", "n_prompt_turns", *[_rendered(F.col(x)).alias(x) for x in "pab"])
    return shown.select("chosen_id", "rejected_id", "n_prompt_turns", _text(F.col("p")).alias("prompt"), _text(F.col("a")).alias("chosen"), _text(F.col("b")).alias("rejected"), _mask(F.col("a")).alias("chosen_mask"), _mask(F.col("b")).alias("rejected_mask"))
