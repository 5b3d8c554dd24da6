"""Preference pairs for training: one prompt and two masked completions.

The longest common prefix of turns of the chosen and the rejected conversation is rendered once,
as the prompt; what follows in each is its completion. Only the words of the assistant, with the
mark that ends its turn, are trained on: their places in the completion are given as spans, and
everything else is masked.

All of it is column expressions on two arrays of turns. Defined results: a null role or text is
empty; a null or empty conversation has no turns; where one conversation is a prefix of the
other, its completion is empty. Equal conversations have nothing but a prompt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TRAINED_ROLE = "assistant"
END = "<|end|>\n"


def conversations(
    turns: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(id, turns): every conversation's turns as array<struct<role, text>> in order.

    Repeated rows count once; turns of one number go by role and text, a null number first.
    """
    row = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    ordered = F.sort_array(F.collect_set(row))
    bare = F.transform(ordered, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return turns.groupBy(id).agg(bare.alias("turns"))


def header(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(header(t), t["text"], F.lit(END))), "")


def trained_spans(turns: Column, role: str = TRAINED_ROLE) -> Column:
    """`begin:end` of what is trained on in rendered(turns), in code points, comma-joined."""

    def step(state: Column, t: Column) -> Column:
        begin = state["at"] + F.char_length(header(t))
        end = begin + F.char_length(t["text"]) + len(END)
        span = F.concat_ws(":", begin.cast("string"), end.cast("string"))
        found = F.when(t["role"] == role, F.concat(state["found"], F.array(span))).otherwise(state["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("found"))
    return F.aggregate(turns, begin, step, lambda state: F.array_join(state["found"], ","))


def common_turns(a: Column, b: Column) -> Column:
    """The number of turns that two conversations begin with alike."""
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    first_other = F.array_position(same, F.lit(False))
    return F.when(first_other > 0, first_other - 1).otherwise(F.size(same)).cast("int")


def formatted(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """The other columns of pairs, and prompt_turns, prompt, chosen and rejected as texts,
    chosen_spans and rejected_spans."""
    none = F.array().cast("array<struct<role:string,text:string>>")
    both = pairs.withColumn(chosen, F.coalesce(F.col(chosen), none)).withColumn(
        rejected, F.coalesce(F.col(rejected), none)
    )
    both = both.withColumn("prompt_turns", common_turns(F.col(chosen), F.col(rejected)))
    n = F.col("prompt_turns")

    def rest(c: str) -> Column:
        return F.slice(F.col(c), n + 1, F.size(c))

    others = [c for c in pairs.columns if c not in (chosen, rejected)]
    return both.select(
        *others,
        "prompt_turns",
        rendered(F.slice(F.col(chosen), F.lit(1), n)).alias("prompt"),
        rendered(rest(chosen)).alias(chosen),
        rendered(rest(rejected)).alias(rejected),
        trained_spans(rest(chosen)).alias(f"{chosen}_spans"),
        trained_spans(rest(rejected)).alias(f"{rejected}_spans"),
    )


def swapped_replies(found: DataFrame, id: str = "conv_id", role: str = TRAINED_ROLE) -> DataFrame:
    """Pairs for a table without preferences: (id, chosen, rejected).

    Chosen is the conversation itself; rejected is the same with its last reply replaced by that
    of the conversation with the neighbouring id (2k and 2k + 1), or by nothing where that one
    has no reply. A conversation without a reply is paired with itself.
    """
    places = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: F.get(F.col("turns"), i - 1)["role"] == role)
    last = F.when(F.size("turns") > 0, F.array_max(places))
    own = found.select(F.col(id), "turns", last.alias("_last"))
    other = own.select(
        F.col(id).bitwiseXOR(F.lit(1)).alias("_other"), F.get(F.col("turns"), F.col("_last") - 1)["text"].alias("_reply")
    )
    paired = own.join(other, F.col(id) == F.col("_other"), "left")
    rejected = F.transform(
        "turns",
        lambda t, i: F.struct(
            t["role"].alias("role"),
            F.when(i + 1 == F.col("_last"), F.coalesce("_reply", F.lit(""))).otherwise(t["text"]).alias("text"),
        ),
    )
    return paired.select(F.col(id), F.col("turns").alias("chosen"), rejected.alias("rejected"))
