"""Preference pairs: a shared prompt and two masked completions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.operators.keys import dense_key

#: A turn is rendered as its role, its text and an end mark.
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
#: Roles whose words a model learns to produce.
LEARNT_ROLES = ("assistant",)


def _turns(turns: DataFrame, pair_col: str, turn_col: str, role_col: str, text_col: str, side: str) -> DataFrame:
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    whole = turns.filter(F.col(pair_col).isNotNull()).groupBy(F.col(pair_col).alias("pair"))
    return whole.agg(F.sort_array(F.collect_list(turn)).alias(side))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(CLOSE))


def _body(turn: Column) -> Column:
    return F.concat(turn["text"], F.lit(END))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def _mask(turns: Column, roles: Sequence[str]) -> Column:
    """Places (start, end), in characters of the rendered turns, of what is to be learnt."""
    spans = F.array().cast("array<struct<start:int,end:int>>")

    def step(done: Column, t: Column) -> Column:
        begin = done["at"] + F.length(_head(t))
        end = begin + F.length(_body(t))
        span = F.struct(begin.alias("start"), end.alias("end"))
        learnt = F.when(t["role"].isin(*roles), F.array(span)).otherwise(spans)
        return F.struct(end.alias("at"), F.concat(done["spans"], learnt).alias("spans"))

    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), spans.alias("spans")), step)["spans"]


def preference_pairs(
    chosen: DataFrame,
    rejected: DataFrame,
    pair_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    *,
    learnt_roles: Sequence[str] = LEARNT_ROLES,
) -> DataFrame:
    """pair, prompt_turns, prompt, chosen, rejected, chosen_mask and rejected_mask of every pair.

    The longest run of first turns that both conversations share is rendered
    once, as the prompt. What follows is rendered for each side; its mask holds
    the places (start, end) in characters that a model is to learn: text and end
    mark of the turns of ``learnt_roles``.

    - Turns without a pair take no part; pairs with one side only are left out.
    - NULL roles and texts are like empty ones. Turns are put in the order of
      their numbers, then of role and text; a NULL number comes first.
    - Repeated rows are repeated turns.
    - If one side is the beginning of the other, its completion is empty; equal
      sides have two empty completions.
    - Empty tables give an empty result; further columns are ignored.
    """
    sides = _turns(chosen, pair_col, turn_col, role_col, text_col, "c").join(
        _turns(rejected, pair_col, turn_col, role_col, text_col, "r"), "pair"
    )
    differs = F.zip_with(
        "c",
        "r",
        lambda a, b: a.isNull() | b.isNull() | (a["role"] != b["role"]) | (a["text"] != b["text"]),
    )
    first = F.array_position(differs, True)
    shared = F.when(first > 0, first - 1).otherwise(F.size("c")).cast("int")
    rest = [
        F.slice(side, F.col("prompt_turns") + 1, F.greatest(F.size(side), F.lit(1))).alias(side) for side in ("c", "r")
    ]
    parted = sides.withColumn("prompt_turns", shared).select(
        "pair",
        "prompt_turns",
        _rendered(F.slice("c", F.lit(1), F.col("prompt_turns"))).alias("prompt"),
        *rest,
    )
    return parted.select(
        "pair",
        "prompt_turns",
        "prompt",
        _rendered(F.col("c")).alias("chosen"),
        _rendered(F.col("r")).alias("rejected"),
        _mask(F.col("c"), learnt_roles).alias("chosen_mask"),
        _mask(F.col("r"), learnt_roles).alias("rejected_mask"),
    )


def with_other_tail(turns: DataFrame) -> DataFrame:
    """Each conversation up to some turn, and from there on the turns of the next one.

    Columns are conv_id, turn (counted anew from 0), role and text. Conversations
    follow each other by id, the first one follows the last. The n-th of them
    keeps n modulo its length turns, so cuts lie at all depths; if the next one
    is shorter, nothing follows.

    Turns without a conversation are left out. NULL numbers, roles and texts, and
    repeated turns, are taken as by ``preference_pairs``.
    """
    given = _turns(turns, "conv_id", "turn", "role", "text", "own")
    numbered = dense_key(given, ["pair"], "number", key_type="bigint")
    n = F.lit(numbered.count())
    following = numbered.select((F.pmod(F.col("number") - 2, n) + 1).alias("number"), F.col("own").alias("next"))
    cut = F.pmod("number", F.size("own")).cast("int")
    beyond = F.greatest(F.size("next"), F.lit(1))
    joined = numbered.join(following, "number").select(
        "pair", F.concat(F.slice("own", F.lit(1), cut), F.slice("next", cut + 1, beyond)).alias("turns")
    )
    return joined.select(F.col("pair").alias("conv_id"), F.posexplode("turns").alias("turn", "t")).select(
        "conv_id", "turn", "t.role", "t.text"
    )
