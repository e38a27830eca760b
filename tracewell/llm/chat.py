"""Preference data from pairs of conversations.

The longest common prefix of turns of the chosen and the rejected conversation is rendered once, as the prompt; the
turns behind it are the two completions, each with a mask of the characters to train on: what the assistant says and
the mark that ends its turn. Everything is DataFrame expressions on one row per pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def turns_of(table: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``(id, turns)``: each conversation's turns in order, as role and text; one conversation is one record."""
    turn = F.struct(F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    listed = table.groupBy(F.col(id_col).alias("id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return listed.select("id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(turn["role"], F.lit("")), F.lit("\n"))


def rendered(turn: Column) -> Column:
    return F.concat(head(turn), F.coalesce(turn["text"], F.lit("")), F.lit(CLOSE))


def joined(turns: Column) -> Column:
    return F.array_join(F.transform(turns, rendered), "")


def mask(turns: Column) -> Column:
    """``[begin, end)`` in characters of the rendered turns, for each turn of the trained role, without its header."""
    start = F.struct(F.lit(0).cast("int").alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        end = state["at"] + F.length(rendered(turn))
        span = F.array(F.struct((state["at"] + F.length(head(turn))).alias("begin"), end.alias("end")))
        spans = F.when(turn["role"] == TRAINED_ROLE, F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.cast("int").alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda s: s["spans"])


def format_pairs(pairs: DataFrame) -> DataFrame:
    """``pairs`` (any columns, with ``chosen`` and ``rejected``, arrays of role and text) with six columns more:
    ``prefix_turns, prompt, chosen_text, chosen_mask, rejected_text, rejected_mask``.

    Turns are common if role and text are, nulls being equal to nulls. A null conversation is empty. Equal
    conversations are all prompt, with empty completions and masks.
    """
    empty = F.array().cast("array<struct<role:string,text:string>>")
    both = pairs.withColumns({c: F.coalesce(F.col(c), empty) for c in ("chosen", "rejected")})
    same = F.zip_with("chosen", "rejected", lambda a, b: a.eqNullSafe(b) & a.isNotNull())
    first = F.array_position(same, F.lit(False)).cast("int")
    prefix = F.when(first > 0, first - 1).otherwise(F.size("chosen"))
    both = both.withColumn("prefix_turns", prefix)
    out = {"prompt": joined(F.slice("chosen", F.lit(1), F.col("prefix_turns")))}
    for c in ("chosen", "rejected"):
        rest = F.slice(c, F.col("prefix_turns") + 1, F.greatest(F.size(c) - F.col("prefix_turns"), F.lit(0)))
        out |= {f"{c}_text": joined(rest), f"{c}_mask": mask(rest)}
    return both.withColumns(out)


def derived_pairs(conversations: DataFrame) -> DataFrame:
    """Preference pairs from single conversations ``(id, turns)``.

    Chosen is the conversation up to its last assistant turn; rejected answers the same turns with the conversation's
    first assistant turn, which belongs to another question, or, where that is the last one too, with nothing.
    A conversation without an assistant turn is chosen and rejected alike.
    """
    answers = F.filter("turns", lambda t: t["role"] == TRAINED_ROLE)
    last = F.size("turns") - F.array_position(F.transform(F.reverse("turns"), lambda t: F.coalesce(t["role"] == TRAINED_ROLE, F.lit(False))), F.lit(True)).cast("int") + 1
    df = conversations.withColumns({"answers": answers, "last": last})
    chosen = F.when(F.size("answers") > 0, F.slice("turns", F.lit(1), F.col("last"))).otherwise(F.col("turns"))
    text = F.when(F.size("answers") > 1, F.col("answers")[0]["text"]).otherwise(F.lit(""))
    other = F.array(F.struct(F.lit(TRAINED_ROLE).alias("role"), text.alias("text")))
    before = F.slice("turns", F.lit(1), F.greatest(F.col("last") - 1, F.lit(0)))
    rejected = F.when(F.size("answers") > 0, F.concat(before, other)).otherwise(F.col("turns"))
    return df.select("id", chosen.alias("chosen"), rejected.alias("rejected"))
