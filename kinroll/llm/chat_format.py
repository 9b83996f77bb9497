"""Preference formatting of paired conversations, in DataFrame operations.

A pair is a chosen and a rejected conversation. Their turns are aligned by
position; the turns before the first difference are the **prompt**, rendered
once, and what follows are the two **completions**. Only the assistant's words
in a completion are trained on: ``mask_start`` and ``mask_end`` delimit them in
the rendered segment (end marker included), both 0 where nothing is.

The result has one row per segment and is aligned, compared and ordered by
``(pair, turn)``, so a conversation that holds a third of all turns is spread
like any other. ``records`` puts a pair's segments into one row, which a
consumer of single examples needs; that row is as long as the conversation.

Defined cases: rows with a null pair or turn take no part; a null role is
``unknown``, a null text the empty text; of rows that repeat a turn the smallest
(role, text) counts; a pair that never differs is all prompt; a pair with one
side only has an empty prompt and that side's completion; an empty table gives
an empty result; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinroll.llm.common import narrow

ASSISTANT = "assistant"


def _turns(turns: DataFrame) -> DataFrame:
    """``pair, turn, said`` with ``said = (role, text)``, one row per turn."""
    return (
        turns.filter("pair is not null and turn is not null")
        .groupBy("pair", "turn")
        .agg(F.min(F.struct(F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))).alias("said"))
    )


def header(role: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"))


def rendered(role: Column, text: Column) -> Column:
    return F.concat(header(role), text, F.lit("<|end|>\n"))


def aligned(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """``pair, turn, chosen, rejected`` from two tables of ``pair, turn, role,
    text``; a side without that turn is null."""
    ours, theirs = (_turns(side).withColumnRenamed("said", name) for side, name in ((chosen, "chosen"), (rejected, "rejected")))
    return ours.join(theirs, ["pair", "turn"], "full")


def preference_segments(turns: DataFrame) -> DataFrame:
    """``aligned`` turns to ``pair, side`` (prompt, chosen, rejected)``, turn,
    role, content, loss, mask_start, mask_end``."""
    differs = ~F.coalesce(F.col("chosen") == F.col("rejected"), F.lit(False))
    first = turns.filter(differs).groupBy("pair").agg(F.min("turn").alias("first"))
    split = turns.join(first, "pair", "left").withColumn("common", F.coalesce(F.col("turn") < F.col("first"), F.lit(True)))
    sides = F.when(F.col("common"), F.array(F.struct(F.lit("prompt").alias("side"), F.col("chosen").alias("said")))).otherwise(
        F.array(F.struct(F.lit("chosen").alias("side"), F.col("chosen").alias("said")),
                F.struct(F.lit("rejected").alias("side"), F.col("rejected").alias("said"))))
    rows = split.select("pair", "turn", F.explode(sides).alias("s")).filter("s.said is not null").select(
        "pair", F.col("s.side").alias("side"), "turn", F.col("s.said.role").alias("role"), F.col("s.said.text").alias("text"))
    loss = (F.col("side") != "prompt") & (F.col("role") == ASSISTANT)
    return rows.select(
        "pair", "side", "turn", "role", rendered(F.col("role"), F.col("text")).alias("content"), loss.alias("loss"),
        F.when(loss, F.length(header(F.col("role")))).otherwise(0).cast("long").alias("mask_start"),
        F.when(loss, F.length(rendered(F.col("role"), F.col("text"))) - 1).otherwise(0).cast("long").alias("mask_end"),
    )


def records(segments: DataFrame) -> DataFrame:
    """One row per pair: ``prompt``, ``chosen`` and ``rejected`` texts, and the
    trained spans ``[start, end)`` of both completions in characters."""
    part = lambda side: F.sort_array(F.collect_list(F.when(
        F.col("side") == side, F.struct("turn", "content", "mask_start", "mask_end"))))
    grouped = segments.groupBy("pair").agg(*[part(s).alias(s) for s in ("prompt", "chosen", "rejected")])
    text = lambda side: F.array_join(F.col(side)["content"], "")

    def spans(side: str) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,end:long>>").alias("spans"))
        return F.aggregate(F.col(side), start, lambda acc, s: F.struct(
            (acc["at"] + F.length(s["content"])).alias("at"),
            F.when(s["mask_end"] > 0, F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + s["mask_start"]).alias("start"), (acc["at"] + s["mask_end"]).alias("end"))))).otherwise(acc["spans"]).alias("spans"),
        ), lambda acc: acc["spans"])

    return grouped.select("pair", text("prompt").alias("prompt"), text("chosen").alias("chosen"), text("rejected").alias("rejected"),
                          spans("chosen").alias("chosen_spans"), spans("rejected").alias("rejected_spans"))


def derived_pairs(conversations: DataFrame, id_col: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected tables ``pair, turn, role, text`` from a table of
    single conversations. Chosen is the whole conversation, turns after the last
    reply included. What its rejected side is follows from the first hex digit of
    the MD5 of its id:

    * 0-5: the last reply is a stale one, the first reply's text (the opening
      turn's, where the last reply is also the first);
    * 6-8: the first reply repeats the opening turn, so the pair parts early;
    * 9-b: it breaks off before the last reply;
    * c-e: it goes on with a turn that repeats the last reply;
    * f: there is no rejected side.

    A conversation without replies is the same on both sides (but for f)."""
    turns = _turns(narrow(conversations, pair=id_col, turn="turn", role="role", text="text"))
    is_reply = F.col("said.role") == ASSISTANT
    said = F.struct("turn", F.col("said.text").alias("text"))
    ends = turns.groupBy("pair").agg(
        F.max(F.when(is_reply, said)).alias("last"), F.min(F.when(is_reply, said)).alias("reply"),
        F.min(said).alias("opening"), F.max("turn").alias("end"))
    digit = F.conv(F.substring(F.md5(F.col("pair").cast("string").cast("binary")), 1, 1), 16, 10).cast("int")
    stale = F.when(F.col("reply.turn") < F.col("last.turn"), F.col("reply.text")).otherwise(F.col("opening.text"))
    text = (
        F.when((F.col("digit") < 6) & (F.col("turn") == F.col("last.turn")), stale)
        .when(F.col("digit").between(6, 8) & (F.col("turn") == F.col("reply.turn")), F.col("opening.text"))
        .otherwise(F.col("said.text"))
    )
    own = F.struct(F.col("turn"), F.col("said.role").alias("role"), text.alias("text"))
    more = F.struct((F.col("end") + 1).cast(turns.schema["turn"].dataType).alias("turn"), F.lit(ASSISTANT).alias("role"),
                    F.col("last.text").alias("text"))
    none = F.lit(None).cast(T.StructType([turns.schema["turn"], T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
    broken = F.col("digit").between(9, 11) & (F.col("turn") >= F.col("last.turn"))
    goes_on = F.col("digit").between(12, 14) & (F.col("turn") == F.col("end")) & F.col("last").isNotNull()
    rows = F.array(F.when(~F.coalesce(broken, F.lit(False)), own).otherwise(none), F.when(goes_on, more).otherwise(none))
    rejected = turns.join(ends.withColumn("digit", digit).filter("digit < 15"), "pair").select(
        "pair", F.explode(F.array_compact(rows)).alias("r")).select("pair", "r.turn", "r.role", "r.text")
    return turns.select("pair", "turn", "said.role", "said.text"), rejected


def derived_segments(conversations: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """The pairs of ``derived_pairs``, aligned and cut into segments."""
    return preference_segments(aligned(*derived_pairs(conversations, id_col)))
