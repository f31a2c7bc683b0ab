"""Chat formatting: every dialogue from the point of view of each of its participants.

Method: multi-party perspective rotation. For every participant the dialogue is rendered with that
speaker as the assistant and all others as named users; the loss mask covers what the assistant
says, its end tag included. System turns are context in every rendering and take no perspective.

A dialogue is rendered in parts of ``PART_TURNS`` turn numbers, cut again after each ``PART_TURNS``
turns where numbers repeat or are missing, so that a dialogue of any length is never gathered into
one row or task. Positions come from one range-partitioned sort of all turns, written once; a part
spanning two of its partitions is counted through their sizes. Parts are grouped and rendered on
their own, and only their lengths are summed along the dialogue. A turn that belongs to no dialogue
is rendered where it is read, without a shuffle. Only DataFrame functions run here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from credere.functions.ranking import _tag_partitions
from credere.llm.common import stage

PART_TURNS = 64
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
SYSTEM, UNKNOWN = "system", "unknown"
UNTIMED = 1 << 60  # the block of turns without a number: after all others


def _segments(turns: Column, speaker: Column) -> Column:
    """(head, body) of each rendered turn."""
    def one(t: Column) -> Column:
        tag = (F.when(t["role"] == SYSTEM, F.lit(SYSTEM)).when(t["role"] == speaker, F.lit("assistant"))
               .otherwise(F.concat(F.lit("user name="), t["role"])))
        own = t["role"] == speaker
        return F.struct(F.concat(F.lit(OPEN), tag, F.lit("\n")).alias("head"), F.concat(t["text"], F.lit(CLOSE)).alias("body"), own.alias("own"))
    return F.transform(turns, one)


def _placed(said: DataFrame) -> DataFrame:
    """Turns by ``conv``, ``block`` (of turn numbers) and ``cut`` (of positions in the block), with the text's length."""
    block = F.coalesce(F.floor(F.col("turn") / PART_TURNS), F.lit(UNTIMED))
    order = [F.col("conv"), F.col("turn").asc_nulls_last(), F.col("role"), F.col("text")]
    at = stage(_tag_partitions(said.select(F.col("conv_id").alias("conv"), block.alias("block"), "turn", "role", "text", F.length("text").alias("chars")).orderBy(*order)), "turns")
    here = at.groupBy("conv", "block", "_pid").agg(F.count("*").alias("n"), F.min("_mid").alias("first"))  # a block is one run of each partition
    before = Window.partitionBy("conv", "block").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition at most
    here = here.select("conv", "block", "_pid", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    cut = F.floor((F.col("skip") + F.col("_mid") - F.col("first")) / PART_TURNS)
    return at.join(here, ["conv", "block", "_pid"]).select("conv", "block", cut.alias("cut"), "turn", "role", "text", "chars")


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """(conv_id, speaker, part, n_turns, start, text, mask): a row for each participant and part of a dialogue.

    ``start`` is where the part's text begins in the whole rendering; ``mask`` lists the trained
    ranges as ``start:end`` in code points of the whole rendering, comma-joined, end exclusive.
    Turns go by number, then role, then text; rows repeated in all four columns are one turn. Turns
    without a number come last and are never merged: what is said twice is there twice. A null
    text is empty, a null or empty role is ``unknown``. Rows without a conv_id have nothing to do with
    each other: each is a dialogue of its own, of one turn. A dialogue of system turns alone has
    no participants and so no row; an empty table gives an empty result. Very long dialogues come in parts, a very long text in one. Other columns are ignored.
    """
    named = F.when(F.coalesce(F.col(role_col), F.lit("")) == "", F.lit(UNKNOWN)).otherwise(F.col(role_col))
    every = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), named.alias("role"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    said = every.where(F.col("conv_id").isNotNull())
    placed = _placed(said.where(F.col("turn").isNotNull()).distinct().unionByName(said.where(F.col("turn").isNull())))
    speakers = said.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("conv"), F.col("role").alias("speaker")).distinct()
    # a turn in another's view; in the speaker's own its tag is "assistant"
    other = F.when(F.col("role") == SYSTEM, F.lit(len(SYSTEM))).otherwise(F.length("role") + len("user name="))
    sizes = placed.groupBy("conv", "block", "cut").agg(
        F.count("*").alias("n_turns"), F.sum(other + F.col("chars") + len(OPEN) + 1 + len(CLOSE)).alias("size"), F.collect_list("role").alias("roles"))
    own = F.size(F.filter("roles", lambda r: r == F.col("speaker")))
    views = sizes.join(speakers, "conv").select(
        "conv", "speaker", "block", "cut", "n_turns",
        (F.col("size") + own * (len("assistant") - len("user name=") - F.length("speaker"))).alias("size"))
    along = Window.partitionBy("conv", "speaker").orderBy("block", "cut")
    before = F.coalesce(F.sum("size").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    views = views.withColumn("start", before).withColumn("part", F.row_number().over(along).cast("long") - 1)
    parts = placed.groupBy("conv", "block", "cut").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    rendered = (parts.join(views, ["conv", "block", "cut"])
                .select(F.col("conv").alias("conv_id"), "speaker", "part", "n_turns", "start", _segments(F.col("turns"), F.col("speaker")).alias("seg"))
                .select("conv_id", "speaker", "part", "n_turns", "start",
                        F.array_join(F.transform("seg", lambda s: F.concat(s["head"], s["body"])), "").alias("text"),
                        F.transform("seg", lambda s: F.struct(F.length(s["head"]).alias("head"), F.length(s["body"]).alias("body"), s["own"].alias("own"))).alias("lens")))
    state = F.struct(F.col("start").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        a = s["at"] + x["head"]
        b = a + x["body"]
        out = F.when(x["own"], F.array_append(s["out"], F.concat_ws(":", a.cast("string"), (b - 1).cast("string")))).otherwise(s["out"])
        return F.struct(b.alias("at"), out.alias("out"))

    # the newline after the end tag is layout, not speech: hence b - 1
    mask = F.aggregate("lens", state, step, lambda s: F.array_join(s["out"], ","))
    told = rendered.select("conv_id", "speaker", "part", "n_turns", "start", "text", mask.alias("mask"))
    return told.unionByName(_alone(every.where(F.col("conv_id").isNull() & (F.col("role") != SYSTEM))))


def _alone(turns: DataFrame) -> DataFrame:
    """Turns that are dialogues of their own, each as its speaker sees it."""
    head = f"{OPEN}assistant\n"
    end = F.length("text") + len(head) + len(CLOSE) - 1
    return turns.select("conv_id", F.col("role").alias("speaker"), F.lit(0).cast("long").alias("part"), F.lit(1).cast("long").alias("n_turns"),
                        F.lit(0).cast("long").alias("start"), F.concat(F.lit(head), "text", F.lit(CLOSE)).alias("text"),
                        F.concat_ws(":", F.lit(str(len(head))), end.cast("string")).alias("mask"))
