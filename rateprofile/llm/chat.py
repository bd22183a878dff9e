"""Preference formatting of paired conversations.

The longest common turn prefix of a chosen and a rejected conversation is the
prompt and is rendered once; what follows in either is its completion, with a
mask of what the loss covers: the text and end mark of assistant turns.

Everything is kept at the level of turns: positions and character offsets are running sums in
stretches of turns, the common prefix is a join by position and a grouped minimum.
No task holds a conversation, however long; ``examples`` assembles rows per pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STRETCH_TURNS = 1000
#: Fixed values of the rendered format.
START, END, TRAINED = "<|im_start|>", "<|im_end|>", "assistant"


def running(df: DataFrame, keys: list[str], stretch: str, order: list[str], value: Column, name: str) -> DataFrame:
    """``name``: the sum of ``value`` over the rows of the same keys before this one, in
    order of (stretch, order): sums per stretch, then within each."""
    df = df.withColumn("_value", value.cast("long"))
    sums = df.groupBy(*keys, stretch).agg(F.sum("_value").alias("_sum"))
    ahead = Window.partitionBy(*keys).orderBy(stretch).rowsBetween(Window.unboundedPreceding, -1)
    base = sums.withColumn("_base", F.coalesce(F.sum("_sum").over(ahead), F.lit(0))).drop("_sum")
    within = Window.partitionBy(*keys, stretch).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn(name, F.coalesce(F.sum("_value").over(within), F.lit(0))).drop("_value")
    return df.join(base, [*keys, stretch]).withColumn(name, F.col(name) + F.col("_base")).drop("_base")


def id_pairs(conversations: DataFrame, id_col: str = "conv_id") -> tuple[Column, Column]:
    """(pair, chosen) for a table without preferences: conversations 2k and 2k + 1 are
    a pair, the even one is chosen."""
    c = F.col(id_col)
    return F.floor(c / 2).cast("long"), F.pmod(c, F.lit(2)) == 0


def placed_turns(conversations: DataFrame, keys: dict[str, Column], turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Turns with the columns of ``keys`` and their ``position`` in the conversation that these name."""
    turns = conversations.select(
        *[c.alias(k) for k, c in keys.items()],
        F.coalesce(F.floor(F.col(turn_col) / STRETCH_TURNS), F.lit((1 << 62))).cast("long").alias("stretch"),
        F.coalesce(F.col(turn_col).cast("long"), F.lit((1 << 62))).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    return running(turns, list(keys), "stretch", ["turn", "role", "text"], F.lit(1), "position")


def answered_by_others(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Pairs (``pair_id``, ``chosen``, ``turn``, ``role``, ``text``) for a table without preferences. Conversation 2k is
    chosen. Rejected is its beginning, followed by what conversation 2k + 1 has from there on: an answer to
    something else. The beginning has 1 + k mod (n - 1) of its n turns; a conversation of one turn or none has no beginning to
    share. Turns are in order of number, role and text, nulls as in ``format_pairs``; turns without id are left out."""
    c = F.col(id_col)
    side = {"pair_id": F.floor(c / 2).cast("long"), "chosen": F.pmod(c, F.lit(2)) == 0}
    placed = placed_turns(conversations.filter(c.isNotNull()), side, turn_col, role_col, text_col)
    turns = placed.groupBy("pair_id").agg(F.count_if("chosen").alias("n"))
    shared = F.when(F.col("n") > 1, 1 + F.pmod("pair_id", F.greatest(F.col("n") - 1, F.lit(1)))).otherwise(0)
    both = placed.join(turns.select("pair_id", shared.alias("shared")), "pair_id")
    # a turn of the beginning belongs to both sides, a later one to its own, an early one of the other to none
    begins = F.col("position") < F.col("shared")
    sides = F.when(F.col("chosen") & begins, F.array(F.lit(True), F.lit(False))).when(F.col("chosen") | ~begins, F.array("chosen")).otherwise(F.array().cast("array<boolean>"))
    return both.select("pair_id", F.explode(sides).alias("chosen"), F.col("position").alias("turn"), "role", "text")


def format_pairs(conversations: DataFrame, pair: Column, chosen: Column, turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per rendered turn: ``pair_id``, ``part`` ('prompt', 'chosen' or 'rejected'), ``position``
    (of the turn in its conversation), ``role``, ``rendered``, ``start`` and ``end`` (characters
    from the start of prompt plus completion), ``loss_start`` and ``loss_end`` (what the loss
    covers; null in the prompt and in turns of others).

    A pair with one side only has it all as that side's completion. Equal
    conversations are all prompt. Null texts and roles render as empty, and null equals null; turns of equal number
    are ordered by role and text, null first, then null turns; repeated rows are
    turns of their own; turns without pair are left out. An empty table has no rows.
    """
    given = conversations.filter(pair.isNotNull() & chosen.isNotNull())
    placed = placed_turns(given, {"pair_id": pair, "chosen": chosen}, turn_col, role_col, text_col)
    # the first position at which the two sides differ, by hashes of the turns; a side that ends differs
    seen = placed.select("pair_id", "chosen", "position", F.sha2(F.concat_ws("\x00", F.length("role"), "role", "text"), 256).alias("h"))
    sides = seen.groupBy("pair_id", "position").agg(F.count("*").alias("n"), F.min("h").alias("a"), F.max("h").alias("b"))
    split = sides.filter((F.col("n") < 2) | (F.col("a") != F.col("b"))).groupBy("pair_id").agg(F.min("position").alias("split"))
    head = F.concat(F.lit(START), "role", F.lit("\n"))
    rendered = F.concat(head, "text", F.lit(END + "\n"))
    joined = placed.join(split, "pair_id", "left")
    in_prompt = F.coalesce(F.col("position") < F.col("split"), F.lit(True))
    joined = joined.withColumn("in_prompt", in_prompt).withColumn("rendered", rendered).withColumn("head", F.length(head))
    offsets = running(joined, ["pair_id", "chosen"], "stretch", ["position"], F.length("rendered"), "start")
    part = F.when(F.col("in_prompt"), "prompt").when(F.col("chosen"), "chosen").otherwise("rejected")
    trained = ~F.col("in_prompt") & (F.col("role") == TRAINED)
    end = F.col("start") + F.length("rendered")
    # the prompt is rendered from the chosen side only
    return offsets.filter(F.col("chosen") | ~F.col("in_prompt")).select(
        "pair_id",
        part.alias("part"),
        "position",
        "role",
        "rendered",
        "start",
        end.alias("end"),
        F.when(trained, F.col("start") + F.col("head")).alias("loss_start"),
        F.when(trained, end - 1).alias("loss_end"),
    )


def examples(segments: DataFrame) -> DataFrame:
    """One row per pair: ``prompt``, ``chosen``, ``rejected``, ``chosen_mask``, ``rejected_mask`` (runs of
    characters of prompt plus completion that the loss covers). A pair must fit a row."""
    out = []
    for p in ("prompt", "chosen", "rejected"):
        own = F.when(F.col("part") == p, F.struct("position", "rendered", "loss_start", "loss_end"))
        out.append(F.array_sort(F.collect_list(own)).alias(f"_{p}"))
    got = segments.groupBy("pair_id").agg(*out)
    text = lambda p: F.array_join(F.transform(f"_{p}", lambda x: x["rendered"]), "").alias(p)
    mask = lambda p: F.transform(F.filter(f"_{p}", lambda x: x["loss_start"].isNotNull()), lambda x: F.struct(x["loss_start"].alias("start"), x["loss_end"].alias("end"))).alias(f"{p}_mask")
    return got.select("pair_id", text("prompt"), text("chosen"), text("rejected"), mask("chosen"), mask("rejected"))
