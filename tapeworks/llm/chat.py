"""Preference formatting of paired conversations: one shared prompt, two completions with loss masks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.scratch import stored

TEMPLATE = ("<|im_start|>", "\n", "<|im_end|>\n")


def adjacent_pairs(conversations: DataFrame) -> DataFrame:
    """(pair_id, conv_id, side): conversations 2k and 2k + 1 are the chosen and the rejected one of pair k."""
    ids = conversations.select("conv_id").where("conv_id is not null").distinct()
    return ids.select(
        F.floor(F.col("conv_id") / 2).cast("long").alias("pair_id"), "conv_id",
        F.when(F.pmod("conv_id", F.lit(2)) == 0, "chosen").otherwise("rejected").alias("side"),
    )


def answer_swaps(conversations: DataFrame) -> DataFrame:
    """Turns of preference pairs made of conversations: conv_id 2c is conversation c up to its last assistant turn,
    and 2c + 1 the same with that turn's text taken from the last answer of the adjacent conversation (c xor 1).

    A conversation without an assistant turn makes no pair; where the adjacent one has none, 2c + 1 ends before
    its answer. Rows with a null conv_id or turn are left out, and other columns are not read. Repeated rows stay as often
    as they come, a text of any length is a value as any other, and an empty table gives no turns.
    """
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    turns = turns.where("conv_id is not null and turn is not null")
    last = turns.where("role = 'assistant'").groupBy("conv_id").agg(F.max("turn").alias("last"))
    ended = turns.join(last, "conv_id").where("turn <= last")
    final = ended.where("turn = last and role = 'assistant'").select(F.col("conv_id").bitwiseXOR(F.lit(1).cast("long")).alias("conv_id"), "role", "text")
    swapped = ended.where("turn < last").select("conv_id", "turn", "role", "text")
    swapped = swapped.unionByName(final.join(last, "conv_id").select("conv_id", F.col("last").alias("turn"), "role", "text"))
    sides = ((ended, 0), (swapped, 1))
    first, second = (t.select((2 * F.col("conv_id") + k).alias("conv_id"), "turn", "role", "text") for t, k in sides)
    # stored, as what formats pairs reads the turns more than once
    return stored(first.unionByName(second), "turns")


def _split(turns: DataFrame, pairs: DataFrame, together: bool = False) -> DataFrame:
    """pair_id, part, turn, role, text, trained: the rows of a pair's prompt, taken from the chosen one, and of its two completions.

    together: for a caller that gathers pairs anyway, rows are dealt by pair at once and not again for each step.
    """
    turns = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = turns.where("conv_id is not null and turn is not null").join(pairs.select("pair_id", "conv_id", "side"), "conv_id")
    turns = turns.repartition("pair_id") if together else turns
    own = F.struct("role", "text")
    digest = F.sha2(F.to_json(own), 256)
    parts = [F.sum(F.conv(F.substring(digest, k, 12), 16, 10).cast("decimal(38,0)")) for k in (1, 13, 25)]
    signs = turns.groupBy("pair_id", "turn", "side").agg(F.struct(F.count("*").alias("n"), *[p.alias(f"s{k}") for k, p in enumerate(parts)]).alias("sign"))
    sides = signs.groupBy("pair_id", "turn").agg(*[F.max(F.when(F.col("side") == s, F.col("sign"))).alias(s) for s in ("chosen", "rejected")])
    differ = ~F.col("chosen").eqNullSafe(F.col("rejected"))
    first = sides.groupBy("pair_id").agg(F.min(F.when(differ, F.col("turn"))).alias("first"))
    split = turns.join(first, "pair_id").withColumn("shared", F.coalesce(F.col("turn") < F.col("first"), F.lit(True)))
    return split.where("not shared or side = 'chosen'").select(
        "pair_id", F.when(F.col("shared"), "prompt").otherwise(F.col("side")).alias("part"), "turn", "role", "text",
        (~F.col("shared") & (F.col("role") == "assistant")).alias("trained"),
    )


def preference_segments(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """pair_id, part, turn, role, segment, trained: a row for each rendered turn.

    The longest prefix of turns that both conversations of a pair have in common is its prompt, rendered
    once and never trained on; the turns from the first difference on are the two completions, of which
    assistant turns are trained on. A turn is compared by all its rows (role, text), whatever their order, so
    repeated rows of a turn must be repeated in both. Null roles and texts equal each other and render as
    empty. A conversation whose partner is missing has no prompt. Rows with a null conv_id or turn, which
    have no place in a conversation, are left out. Columns of ``turns`` other than conv_id, turn, role and
    text are not read.

    No conversation is gathered in one task: a turn is hashed, pairs of turns are compared in a join, and the
    first difference is a minimum, which combines before the shuffle.
    """
    begin, middle, end = TEMPLATE
    segment = F.concat(F.lit(begin), "role", F.lit(middle), "text", F.lit(end)).alias("segment")
    return _split(turns, pairs).select("pair_id", "part", "turn", "role", segment, "trained")


def preference_rows(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """pair_id, prompt, chosen, rejected, chosen_mask, rejected_mask: a row for each pair, as preference_segments() splits them.

    The texts are rendered turns in the order of turn, role and text; a part without turns is empty. A mask lists
    the spans of a completion that are trained on, as ``from-to`` in characters, a space between them: the text of
    assistant turns and the mark that ends them, and not the header of the role. A row holds its pair whole, as
    what is trained on at once; only the turns of one pair meet in a task.
    """
    begin, middle, end = TEMPLATE
    rows = _split(turns, pairs, together=True)
    turn = F.struct("part", "turn", "role", "text", "trained")
    every = rows.groupBy("pair_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def own(part: str):
        return F.filter("turns", lambda x: x["part"] == part)

    def text(part: str):
        return F.array_join(F.transform(own(part), lambda x: F.concat(F.lit(begin), x["role"], F.lit(middle), x["text"], F.lit(end))), "").alias(part)

    def mask(part: str):
        none = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

        def add(done, x):
            start = done["at"] + len(begin) + F.length(x["role"]) + len(middle)
            stop = start + F.length(x["text"]) + len(end.rstrip("\n"))
            spans = F.when(x["trained"], F.concat(done["spans"], F.array(F.concat(start.cast("string"), F.lit("-"), stop.cast("string"))))).otherwise(done["spans"])
            return F.struct((stop + 1).alias("at"), spans.alias("spans"))

        return F.aggregate(own(part), none, add, lambda x: F.array_join(x["spans"], " ")).alias(f"{part}_mask")

    return every.select("pair_id", text("prompt"), text("chosen"), text("rejected"), mask("chosen"), mask("rejected"))
