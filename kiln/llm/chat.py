"""Preference formatting of chosen and rejected conversations.

The longest common prefix of turns is found once per pair and rendered once,
as the prompt; what follows is rendered as two completions with masks.  Turns
are compared by role and text.  A mask lists the ranges of a completion to
train on, the assistants' texts with their end mark, as ``start:end`` code
points.

A rendered conversation is one value of one row, so the turns of a pair meet
in one task; pairs are spread by their key.  A common first turn or a much
repeated conversation makes no group.

Defined results: null role or text counts as empty; turns are in order of
``turn`` (null first), then role and text; a pair whose sides are equal has
empty completions; a side without turns has an empty completion, and the
prompt is empty; repeated turns stay repeated; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN, MIDDLE, END = "<|im_start|>", "\n", "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def preference_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                     text_col: str = "text") -> DataFrame:
    """(pair_id, side, turn, role, text): a pair for every conversation.  Its
    turns are the chosen side; the rejected side ends on the last turn of
    the conversation of the next id in its pair of ids (2k, 2k + 1) instead
    of its own, if there is one.

    Turns are numbered in order of turn (null first), role and text (null as
    empty), so that a shared turn number is no tie and exactly one turn is the
    last.  Rows without a conversation id belong to no pair and are left out."""
    empty = F.lit("")
    role, text = F.coalesce(F.col(role_col), empty), F.coalesce(F.col(text_col), empty)
    pair = Window.partitionBy("pair_id")
    c = (conversations.select(F.col(id_col).cast("bigint").alias("pair_id"), F.col(turn_col).cast("bigint").alias("n"),
                              role.alias("role"), text.alias("text")).where("pair_id is not null")
         .withColumn("turn", F.row_number().over(pair.orderBy(F.asc_nulls_first("n"), "role", "text")).cast("bigint"))
         .withColumn("last", F.count("*").over(pair)))
    columns = ["pair_id", "turn", "role", "text"]
    other = c.where("turn = last").select(F.expr("pair_id ^ 1").alias("pair_id"), "role", "text")
    ending = c.where("turn = last").select("pair_id", "turn").join(other, "pair_id")
    return (c.select(*columns, F.lit("chosen").alias("side"))
            .unionByName(c.where("turn < last").select(*columns).unionByName(ending.select(*columns)).withColumn("side", F.lit("rejected"))))


def format_preferences(turns: DataFrame) -> DataFrame:
    """(pair_id, n_prompt_turns, prompt, chosen, rejected, chosen_mask,
    rejected_mask) from (pair_id, side, turn, role, text)."""
    empty = F.lit("")
    turn = F.struct("turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))

    def side(name: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("side") == name, turn))).alias(name)

    def same(a: Column, b: Column) -> Column:
        return (a["role"] == b["role"]) & (a["text"] == b["text"])

    both = turns.groupBy("pair_id").agg(side("chosen"), side("rejected"))
    # the first place where the sides differ, or the end of the shorter
    shorter = F.least(F.size("chosen"), F.size("rejected"))
    differs = F.filter(F.sequence(F.lit(1), shorter),
                       lambda i: (i <= shorter) & ~same(F.get(F.col("chosen"), i - 1), F.get(F.col("rejected"), i - 1)))
    common = F.when(shorter == 0, 0).otherwise(F.coalesce(F.get(differs, F.lit(0)) - 1, shorter))

    def head(t: Column) -> Column:
        return F.concat(F.lit(BEGIN), t["role"], F.lit(MIDDLE))

    def render(list_: Column) -> Column:
        return F.array_join(F.transform(list_, lambda t: F.concat(head(t), t["text"], F.lit(END))), "")

    def mask(list_: Column) -> Column:
        """Running offset over the turns; a trained turn adds its range."""
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("ranges"))

        def step(s: Column, t: Column) -> Column:
            begin = s["at"] + F.length(head(t))
            end = begin + F.length(t["text"]) + len(END)
            own = F.when(t["role"] == TRAINED_ROLE, F.array(F.concat_ws(":", begin, end))).otherwise(F.array().cast("array<string>"))
            return F.struct(end.alias("at"), F.concat(s["ranges"], own).alias("ranges"))

        return F.aggregate(list_, start, step, lambda s: F.array_join(s["ranges"], ","))

    def rest(name: str) -> Column:
        return F.slice(F.col(name), F.col("n_prompt_turns") + 1, F.greatest(F.size(name) - F.col("n_prompt_turns"), F.lit(0)))

    return (both.withColumn("n_prompt_turns", common)
            .select("pair_id", "n_prompt_turns", render(F.slice("chosen", F.lit(1), F.col("n_prompt_turns"))).alias("prompt"),
                    rest("chosen").alias("c"), rest("rejected").alias("r"))
            .select("pair_id", F.col("n_prompt_turns").cast("bigint").alias("n_prompt_turns"), "prompt",
                    render(F.col("c")).alias("chosen"), render(F.col("r")).alias("rejected"),
                    mask(F.col("c")).alias("chosen_mask"), mask(F.col("r")).alias("rejected_mask")))
