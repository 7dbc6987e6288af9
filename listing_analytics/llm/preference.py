"""Preference pairs in a chat format: the common turns once as the prompt, the rest as two masked completions.

A pair is two conversations under one id. Turns are common while role and text agree from the start; they are rendered once.
What follows in each conversation is a completion with its mask, a list of runs `n_chars, trained`: only the text and the
end mark of assistant turns are trained on. DataFrame functions only.

Defined cases: turns are in order of `turn`, ties in order of role and text, a null turn first. A null role is rendered as
an empty name and a null text as no text, but a null agrees with a null only. A pair with one side only has an empty other
one. Equal conversations are all prompt. Repeated turns are turns. A null id is an id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

HEAD, SEPARATOR, TAIL = "<|", "|>\n", "<|end|>\n"
TRAINED_ROLE = "assistant"


def _head(turn: Column) -> Column:
    return F.concat(F.lit(HEAD), F.coalesce(turn["role"], F.lit("")), F.lit(SEPARATOR))


def _body(turn: Column) -> Column:
    return F.concat(F.coalesce(turn["text"], F.lit("")), F.lit(TAIL))


def rendered(turns: Column) -> Column:
    """Turns as one text."""
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t))), "")


def mask(turns: Column, trained_role: str = TRAINED_ROLE) -> Column:
    """Runs of characters of the rendered turns, and whether they are trained on; two runs for each turn."""
    return F.flatten(F.transform(turns, lambda t: F.array(
        F.struct(F.length(_head(t)).alias("n_chars"), F.lit(False).alias("trained")),
        F.struct(F.length(_body(t)).alias("n_chars"), F.coalesce(t["role"] == trained_role, F.lit(False)).alias("trained")),
    )))


def preference_pairs(chosen: DataFrame, rejected: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """`pair_id, n_common, prompt, chosen, chosen_mask, rejected, rejected_mask` of two tables `pair_id, turn, role, text`."""
    turn = F.struct("turn", "role", "text")
    both = (
        chosen.select("pair_id", turn.alias("c"), F.lit(None).cast("struct<turn:bigint,role:string,text:string>").alias("r"))
        .unionAll(rejected.select("pair_id", F.lit(None), turn))
        .groupBy("pair_id").agg(F.array_sort(F.collect_list("c")).alias("c"), F.array_sort(F.collect_list("r")).alias("r"))
    )
    both = both.withColumn("shorter", F.least(F.size("c"), F.size("r")))
    same = F.zip_with(
        F.slice("c", 1, F.col("shorter")), F.slice("r", 1, F.col("shorter")),
        lambda a, b: a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"]),
    )
    both = both.withColumn("odd", F.array_position(same, F.lit(False)))
    both = both.withColumn("n_common", F.when(F.col("odd") > 0, F.col("odd") - 1).otherwise(F.col("shorter")).cast("int"))
    rest = {s: F.slice(s, F.col("n_common") + 1, F.size(s)) for s in ("c", "r")}
    return both.select(
        "pair_id", F.col("n_common").cast("long").alias("n_common"), rendered(F.slice("c", 1, F.col("n_common"))).alias("prompt"),
        rendered(rest["c"]).alias("chosen"), mask(rest["c"], trained_role).alias("chosen_mask"),
        rendered(rest["r"]).alias("rejected"), mask(rest["r"], trained_role).alias("rejected_mask"),
    )


def swapped_replies(
    turns: DataFrame, partner: Column, role: str = TRAINED_ROLE, unpaired: str = "keep",
) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected sides of `turns (conv_id, turn, role, text)`, for a table that has no judged pairs.

    Rejected is the conversation itself with the text of its last `role` turns (all with the highest number) replaced by
    that of the last one of conversation `partner`, a column of conv_id. Conversations without such a turn on both
    sides, and those with a null id, have no rejected side; `unpaired="skip"` leaves them out.
    """
    if unpaired not in ("keep", "skip"):
        raise ValueError(f"unpaired is keep or skip, not {unpaired}")
    turns = turns.select("conv_id", "turn", "role", "text")  # other columns could have the names used below
    last = turns.where((F.col("role") == role) & F.col("turn").isNotNull()).groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    own = last.select("conv_id", F.col("last.turn").alias("last_turn"), partner.alias("partner"))
    reply = last.select(F.col("conv_id").alias("partner"), F.col("last.text").alias("reply"), F.lit(True).alias("paired"))
    sides = turns.join(own.join(reply, "partner"), "conv_id", "left" if unpaired == "keep" else "inner")
    is_last = F.coalesce((F.col("turn") == F.col("last_turn")) & (F.col("role") == role), F.lit(False))
    text = F.when(is_last, F.col("reply")).otherwise(F.col("text"))
    return (
        sides.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text"),
        sides.where("paired").select(F.col("conv_id").alias("pair_id"), "turn", "role", text.alias("text")),
    )
