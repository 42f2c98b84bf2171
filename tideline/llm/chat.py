"""Multi-party chat formatting by rotation of perspective (operator 4).

For every participant of a dialogue the whole dialogue is rendered once with that speaker as
the assistant, all others as named users, and the speaker's own words as the only targets.
Speakers of ``CONTEXT`` (system prompts) are kept as they are and are nobody's perspective.

The result has a row for each turn of each rendering: its text, its place in the rendered
dialogue, and the range that is a target. Joined in the order of ``position`` the segments
are the rendered dialogue. A dialogue may be of any length: places are running sums over
pieces of it, not a window over the whole.

Turns are ordered by turn, speaker and text (nulls first); repeated rows stay, one after the
other. A null speaker is called ``UNNAMED``; a null text is empty; rows without a dialogue
id form one dialogue. A dialogue of context alone has no participant and no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tideline.llm.ranks import running

CONTEXT = ("system",)
UNNAMED = "unknown"


def rotate(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", speaker: str = "role",
           text: str = "text") -> DataFrame:
    """(conversation, perspective, position, turn, speaker, role, segment, begin, end, target_begin, target_end).

    Offsets count characters; a turn that is no target has an empty range at its end.
    """
    lines = turns.select(
        F.col(conversation).alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(F.col(speaker), F.lit(UNNAMED)).alias("speaker"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Repeated rows travel as one, with their number.
    lines = lines.groupBy("conv", "turn", "speaker", "text").agg(F.count(F.lit(1)).alias("times"))
    speakers = (lines.where(~F.col("speaker").isin(*CONTEXT)).groupBy("conv", "speaker").agg(F.count(F.lit(1)))
                .select(F.col("conv").alias("c"), F.col("speaker").alias("perspective")))
    role = (F.when(F.col("speaker") == F.col("perspective"), "assistant")
            .when(F.col("speaker").isin(*CONTEXT), "system").otherwise("user"))
    header = F.when(F.col("role") == "user", F.concat(F.lit("<|user|>"), F.col("speaker"), F.lit("\n"))).otherwise(
        F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n")))
    rendered = (
        lines.join(speakers, F.col("conv").eqNullSafe(F.col("c"))).drop("c").withColumn("role", role)
        .withColumn("head", F.length(header)).withColumn("segment", F.concat(header, "text", F.lit("\n<|end|>\n")))
        .withColumn("words", F.length("text")).drop("text"))
    placed = running(rendered, ["conv", "perspective"], ["turn", "speaker", "segment"], {
        "position": F.col("times"), "begin": F.col("times") * F.length("segment")})
    each = placed.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
    begin = F.col("begin") + F.col("copy") * F.length("segment")
    out = each.select(
        F.col("conv").alias(conversation), "perspective", (F.col("position") + F.col("copy")).alias("position"),
        F.col("turn"), "speaker", "role", "segment", begin.alias("begin"),
        (begin + F.length("segment")).alias("end"), "head", "words")
    target = F.col("role") == "assistant"
    return out.select(
        *out.columns[:-2],
        F.when(target, F.col("begin") + F.col("head")).otherwise(F.col("end")).alias("target_begin"),
        F.when(target, F.col("begin") + F.col("head") + F.col("words")).otherwise(F.col("end")).alias("target_end"))
