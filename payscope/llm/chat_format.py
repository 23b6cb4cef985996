"""Chat formatting in budgeted windows.

A turn is written ``<|im_start|>role\\ntext<|im_end|>\\n``.  Control strings
inside roles and texts are escaped reversibly: every ``<``, backslashes, ``|``
gets one more backslash, so that ``<|`` never occurs inside a turn; a role's
line breaks are written ``\\n`` with its backslashes doubled.

Prefix sums of turn tokens cut a conversation at turn boundaries.  A turn counts as
many tokens as its written form has bytes: no byte-level vocabulary makes more, in any
script, so a window within the budget stays within it; ``tokens`` takes another
measure, say counts joined from a tokenizer.  With a
stride of half of what system turn and history leave of the budget, a turn
belongs to the window in whose stride it starts, and a turn longer than the
stride has a window of its own.  So a window is within the budget unless one
turn alone, with its system turn and history, is longer.  Each window repeats
the conversation's opening system turn and the turns that start within
``history`` tokens before it.  The loss mask has the texts of assistant turns
that are new in their window, so each is a target exactly once.

Only DataFrame functions.  Prefix sums have two levels (within blocks of
``BLOCK`` turn numbers, and over block totals), so that one long conversation
is spread over tasks; windows are grouped by (conversation, window), which the
budget bounds.  Rows of one conversation and turn number are ordered by role and
text.

Defined results: null text and role are empty.  A null turn number sorts
first.  A null conv_id is a conversation like any other.  Repeated rows are
turns each.  Very long turns are kept whole.  An empty table gives no rows.
Further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
BLOCK = 256


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    # a doubled backslash is put aside while \n is read
    aside = F.lit("\x00\x00")
    inner = F.replace(F.replace(unescape(role), F.lit("\x00"), F.lit("\x00\x01")), F.lit("\\\\"), aside)
    inner = F.replace(inner, F.lit("\\n"), F.lit("\n"))
    return F.replace(F.replace(inner, aside, F.lit("\\")), F.lit("\x00\x01"), F.lit("\x00"))


def written(head: Column, body: Column) -> Column:
    """A turn as it is written, from its escaped parts."""
    return F.concat(head, body, F.lit(END + "\n"))


def head_of(role: Column) -> Column:
    return F.concat(F.lit(START), escape_role(role), F.lit("\n"))


def most_tokens(role: Column, text: Column) -> Column:
    """The bytes of the written turn, which its tokens cannot exceed."""
    return F.octet_length(written(head_of(role), escape(text))).cast("long")


def _placed(conversations: DataFrame, tokens) -> DataFrame:
    """Turns with number (from 0), size and start (tokens before them)."""
    t = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    t = t.withColumn("size", tokens(F.col("role"), F.col("text"))).withColumn("block", F.floor(F.col("turn") / BLOCK))
    totals = t.groupBy("conv_id", "block").agg(F.sum("size").alias("sizes"), F.count("*").alias("rows"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("conv_id").alias("_conv"), F.col("block").alias("_block"),
                           F.coalesce(F.sum("sizes").over(before), F.lit(0)).alias("sizes"),
                           F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows"))
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("number", F.row_number().over(inside) - 1).withColumn("start", F.coalesce(F.sum("size").over(upto), F.lit(0)))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("block").eqNullSafe(F.col("_block"))
    return t.join(totals, same).select("conv_id", "role", "text", "size", (F.col("number") + F.col("rows")).alias("number"),
                                       (F.col("start") + F.col("sizes")).alias("start"))


def windows(conversations: DataFrame, budget: int = 2048, history: int = 256, system: int = 256, tokens=most_tokens) -> DataFrame:
    """One row per window of conversations (conv_id, turn, role, text):
    conv_id, window (from 0, in order), formatted, loss_spans (array of start
    from 0 and length, in characters of ``formatted``), is_new (per turn of
    ``formatted``, whether it appears for the first time), n_tokens.

    ``system`` is the room set aside for a system turn; ``history`` at most a
    stride is repeated."""
    stride = (budget - history - system) // 2
    if stride < max(1, history):
        raise ValueError("the budget leaves no stride of at least the history")
    t = _placed(conversations, tokens)
    step = F.floor(F.col("start") / stride)
    t = t.withColumn("step", step).withColumn("part", (F.col("size") > stride).cast("int"))
    t = t.withColumn("is_system", (F.col("number") == 0) & (F.col("role") == "system"))
    own = t.select("conv_id", "step", "part", "number", "role", "text", "size", F.lit(True).alias("is_new"))
    heads = t.groupBy(F.col("conv_id").alias("w_conv"), F.col("step").alias("w_step"), F.col("part").alias("w_part")).agg(
        F.min("start").alias("w_start"), F.min("number").alias("w_number"))
    # history: a turn may be repeated in windows of its own and the next step
    reach = t.where(~F.col("is_system")).withColumn("to", F.explode(F.array(F.col("step"), F.col("step") + 1)))
    repeated = reach.join(heads, F.col("conv_id").eqNullSafe(F.col("w_conv")) & (F.col("to") == F.col("w_step"))
                          & (F.col("number") < F.col("w_number")) & (F.col("start") >= F.col("w_start") - history)
                          & ((F.col("step") != F.col("w_step")) | (F.col("part") != F.col("w_part"))))
    repeated = repeated.select("conv_id", F.col("w_step").alias("step"), F.col("w_part").alias("part"), "number", "role", "text", "size", F.lit(False).alias("is_new"))
    opening = t.where("is_system").select("conv_id", "number", "role", "text", "size")
    kept = opening.join(heads, F.col("conv_id").eqNullSafe(F.col("w_conv")) & (F.col("w_number") > 0)).select(
        "conv_id", F.col("w_step").alias("step"), F.col("w_part").alias("part"), "number", "role", "text", "size", F.lit(False).alias("is_new"))
    every = own.union(repeated).union(kept)
    head, body = head_of(F.col("role")), escape(F.col("text"))
    every = every.select("conv_id", "step", "part", "size", F.struct(
        "number", "is_new", head.alias("head"), body.alias("body"), (F.col("is_new") & (F.col("role") == "assistant")).alias("target")).alias("t"))
    grouped = every.groupBy("conv_id", "step", "part").agg(F.sort_array(F.collect_list("t")).alias("turns"), F.sum("size").alias("n_tokens"))
    whole = lambda x: written(x["head"], x["body"])
    empty = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,length:int>>)").alias("spans"))

    def advance(s: Column, x: Column) -> Column:
        span = F.struct((s["at"] + F.length(x["head"])).alias("start"), F.length(x["body"]).alias("length"))
        return F.struct((s["at"] + F.length(whole(x))).alias("at"),
                        F.when(x["target"], F.concat(s["spans"], F.array(span))).otherwise(s["spans"]).alias("spans"))

    # windows are numbered by their place in the conversation
    place = (F.col("step") * 2 + F.col("part")).alias("window")
    return grouped.select("conv_id", place, F.array_join(F.transform("turns", whole), "").alias("formatted"),
                          F.aggregate("turns", empty, advance)["spans"].alias("loss_spans"),
                          F.transform("turns", lambda x: x["is_new"]).alias("is_new"), "n_tokens")


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and loss text of each conversation, from ``windows`` alone:
    conv_id, n_turns, turns (role, \\n, text, \\n per turn), loss, formatted_chars."""
    blocks = F.filter(F.split("formatted", r"<\|im_end\|>\n"), lambda b: b != "")
    new = F.filter(F.transform(blocks, lambda b, i: F.when(F.element_at("is_new", i + 1), F.substr(b, F.lit(len(START) + 1)))), lambda b: b.isNotNull())

    def turn(b: Column) -> Column:
        role = F.substring_index(b, "\n", 1)
        return F.concat(unescape_role(role), F.lit("\n"), unescape(F.substr(b, F.length(role) + 2)), F.lit("\n"))

    loss = F.transform("loss_spans", lambda s: unescape(F.substr("formatted", s["start"] + 1, s["length"])))
    rows = formatted.select("conv_id", "window", F.size(new).alias("n"), F.array_join(F.transform(new, turn), "").alias("turns"),
                            F.array_join(loss, "").alias("loss"), F.length("formatted").cast("long").alias("chars"))
    parts = F.sort_array(F.collect_list(F.struct("window", "turns", "loss")))
    both = rows.groupBy("conv_id").agg(parts.alias("p"), F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"))
    return both.select("conv_id", "n_turns", F.array_join(F.transform("p", lambda x: x["turns"]), "").alias("turns"),
                       F.array_join(F.transform("p", lambda x: x["loss"]), "").alias("loss"), "formatted_chars")
