"""Preference examples from pairs of conversations, with DataFrame functions only.

The two conversations of a pair are compared turn by turn from the start. The turns they share are rendered once, as the
prompt; what follows in each is rendered as its completion, with the spans of the completion that are trained on.

Scale: turns are gathered per conversation, which becomes one row of the output anyway; the number of conversations is
spread over the tasks by pair, and no pair meets another one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolemart.llm.native import let, running

_OPEN, _ROLE_END, _CLOSE = "<|", "|>\n", "\n<|end|>\n"
EMPTY = "array<struct<turn:bigint,role:string,text:string>>"


def _rendered(turns: Column) -> Column:
    """array<string>: each turn in the chat template."""
    return F.transform(turns, lambda t: F.concat(F.lit(_OPEN), t["role"], F.lit(_ROLE_END), t["text"], F.lit(_CLOSE)))


def _trained(turns: Column, role: str) -> Column:
    """Spans (code points, end exclusive) of the role's texts with their closing mark in the rendered turns."""

    def spans(parts: Column) -> Column:
        starts = running(F.transform(parts, F.length))
        placed = F.zip_with(turns, starts, lambda t, s: F.struct(
            t["role"].alias("role"), (s + F.length(t["role"]) + len(_OPEN) + len(_ROLE_END)).alias("start"),
            (s + F.length(t["role"]) + len(_OPEN) + len(_ROLE_END) + F.length(t["text"]) + len(_CLOSE) - 1).alias("end")))
        own = F.filter(placed, lambda p: p["role"] == role)
        return F.transform(own, lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end")))

    return let(_rendered(turns), spans)


def _common(chosen: Column, rejected: Column) -> Column:
    """Number of turns from the start with equal role and text."""

    def first_difference(same: Column) -> Column:
        at = F.array_position(same, F.lit(False))
        return F.when(at > 0, at - 1).otherwise(F.size(same)).cast("long")

    shorter = F.least(F.size(chosen), F.size(rejected))
    both = F.zip_with(F.slice(chosen, 1, shorter), F.slice(rejected, 1, shorter), lambda a, b: (a["role"] == b["role"]) & (a["text"] == b["text"]))
    return let(both, first_difference)


def preference_examples(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row per pair from rows (pair_id, chosen boolean, turn, role, text).

    Columns: pair_id, n_prompt_turns, n_chosen_turns, n_rejected_turns, prompt, chosen, chosen_spans, rejected, rejected_spans.
    Spans are array<struct<start,end>> in the completion; everything else of it is masked.

    Turns are ordered by turn, then role, then text; NULL turns come first, and a NULL role or text is empty. A repeated row is
    a repeated turn. A pair with one side only has an empty other side. Pairs that are equal throughout have two empty
    completions. Rows with a NULL pair_id form one pair; a NULL side counts as rejected. An empty table gives no rows.
    Further columns are ignored.
    """
    part = F.struct(
        turns["turn"].cast("long").alias("turn"), F.coalesce(turns["role"].cast("string"), F.lit("")).alias("role"),
        F.coalesce(turns["text"].cast("string"), F.lit("")).alias("text"))
    side = turns.select(turns["pair_id"].alias("pair_id"), F.coalesce(turns["chosen"], F.lit(False)).alias("side"), part.alias("part"))

    def of(chosen: bool) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("side") == chosen, F.col("part"))))

    pairs = side.groupBy("pair_id").agg(of(True).alias("a"), of(False).alias("b"))
    split = pairs.withColumn("n", _common(F.col("a"), F.col("b")))
    rest = {c: F.slice(c, F.col("n").cast("int") + 1, F.size(c)) for c in ("a", "b")}
    parted = split.select("pair_id", "n", F.slice("a", 1, F.col("n").cast("int")).alias("p"), rest["a"].alias("a"), rest["b"].alias("b"))
    return parted.select(
        "pair_id", F.col("n").alias("n_prompt_turns"), F.size("a").cast("long").alias("n_chosen_turns"), F.size("b").cast("long").alias("n_rejected_turns"),
        F.array_join(_rendered(F.col("p")), "").alias("prompt"),
        F.array_join(_rendered(F.col("a")), "").alias("chosen"), _trained(F.col("a"), trained_role).alias("chosen_spans"),
        F.array_join(_rendered(F.col("b")), "").alias("rejected"), _trained(F.col("b"), trained_role).alias("rejected_spans"),
    )


def swapped_replies(conversations: DataFrame) -> DataFrame:
    """Preference pairs of a table (conv_id, turn, role, text): rows for ``preference_examples``, pair_id being the conv_id.

    Chosen is the conversation itself. Rejected is the same with its last assistant turn replaced by that of its neighbour,
    the conversation whose id differs in the last bit; without a neighbour's reply, that turn is missing. A conversation
    without an assistant turn is its own rejected side. Rows without conv_id belong to no conversation and make no pair.
    """
    turns = conversations.where(conversations["conv_id"].isNotNull()).select(
        conversations["conv_id"].cast("long").alias("pair_id"), conversations["turn"].cast("long").alias("turn"),
        conversations["role"].cast("string").alias("role"), conversations["text"].cast("string").alias("text"))
    last = turns.where("role = 'assistant'").groupBy("pair_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    reply = last.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.col("last.text").alias("other"), F.lit(True).alias("there"))
    known = turns.join(last.join(reply, "pair_id", "left"), "pair_id", "left")
    # a repeated last turn is replaced wherever it stands
    is_last = F.coalesce((F.col("role") == "assistant") & F.col("turn").eqNullSafe(F.col("last.turn")) & F.col("text").eqNullSafe(F.col("last.text")) & F.col("last").isNotNull(), F.lit(False))
    rejected = known.where(~is_last | F.col("there")).select(
        "pair_id", F.lit(False).alias("chosen"), "turn", "role", F.when(is_last, F.col("other")).otherwise(F.col("text")).alias("text"))
    return turns.select("pair_id", F.lit(True).alias("chosen"), "turn", "role", "text").unionByName(rejected)
