"""Dialogues from every participant's side: that speaker as assistant, the others as named users, with loss masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstream.llm.common import partitions, stored

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
#: Roles that speak for no one: their messages are system messages from every side.
NARRATORS = ("system",)
#: Copies of one message that are placed as one row, and characters of a text that say in which stretch it is.
COPIES, BEGINNING = 1 << 16, 256


def unforged(said: Column) -> Column:
    """A text whose marks are marks no more: a backslash is put before their first bar, after those that are there.

    So no text opens or closes a turn, and taking one backslash out of every `<\\|im_start|>` gives the text back.
    """
    return F.when(said.contains("|im_"), F.regexp_replace(said, r"<(\\*)\|im_(start|end)\|>", r"<$1\\|im_$2|>")).otherwise(said)


def on_one_line(name: Column) -> Column:
    """A name for a header: backslashes doubled, line ends as \\n and \\r, marks as in texts."""
    for found, put in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        name = F.replace(name, F.lit(found), F.lit(put))
    return unforged(name)


def perspectives(
    messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    narrators: tuple[str, ...] = NARRATORS,
) -> DataFrame:
    """One row for each conversation, participant and message: the dialogue's segments as rendered from that side.

    Columns: the conversation, speaker (whose side it is), n (from 0), the turn, role (assistant, user or system), name (of other
    speakers), segment, train (the speaker's own messages), start and end (character offsets of the segment in the
    dialogue, which is its segments in order of n), mask_start and mask_end (what the loss covers: the speaker's words and the
    closing mark; empty elsewhere).

    Participants are the distinct roles of a conversation that aren't narrators. Order is by turn, then role, then text, nulls first. A null
    text is empty; a null role is a user without a name and no participant; rows without a conversation are one conversation. Repeated
    rows are messages of their own. Conversations without participants give no rows, nor does an empty table. Other columns are left out.
    Marks inside texts and names are made harmless by `unforged`, and names are put on one line by `on_one_line`, in segments alone.

    A dialogue stays spread over rows: messages are dealt by range of conversation, turn, role and beginning of text into stretches, and sums run
    within stretches, then over the totals of stretches. Copies of a message are counted before they move and are placed COPIES at
    a time, so neither a long dialogue, nor one turn (or a missing one) with many messages, nor a message said very often is gathered
    anywhere. Only different texts of one turn and role that share their first BEGINNING characters stay together. Adaptive
    execution splits the joins where a conversation is hot. The stretches are written to the shared folder, since they are read twice.
    """
    spark = messages.sparkSession
    said = messages.select(
        F.col(conversation).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("said_by"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    counted = said.groupBy("conv", "turn", "said_by", "text").agg(F.count("*").alias("all"))
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(all - 1) div {COPIES}"))).alias("block")
    blocks = counted.select("*", block).withColumn("copies", F.least(F.lit(COPIES), F.col("all") - F.col("block") * COPIES).cast("long")).drop("all")
    order = ["turn", "said_by", "text", "block"]
    # Ranges must follow the order: blocks may tell texts apart where the beginning is all of the text, and longer ones come after it.
    short = F.when(F.char_length("text") <= BEGINNING, F.col("block")).otherwise(F.lit(2**63 - 1))
    dealt = blocks.repartitionByRange(partitions(spark), "conv", "turn", "said_by", F.substring("text", 1, BEGINNING), short)
    said = stored(dealt.withColumn("stretch", F.spark_partition_id()))

    narrates = F.coalesce(F.col("said_by").isin(*narrators), F.lit(False))
    sides = said.where(F.col("said_by").isNotNull() & ~narrates).select(F.col("conv").alias("side"), F.col("said_by").alias("speaker")).distinct()
    own = F.col("said_by").eqNullSafe(F.col("speaker"))
    name = F.coalesce(F.concat(F.lit(" name="), on_one_line(F.col("said_by"))), F.lit(""))
    header = F.when(own, "assistant").when(narrates, "system").otherwise(F.concat(F.lit("user"), name))
    before_text = F.concat(F.lit(OPEN), header, F.lit("\n"))
    rows = said.join(sides, F.col("conv").eqNullSafe(F.col("side"))).select(
        "conv", "speaker", *order, "copies", "stretch",
        F.when(own, "assistant").when(narrates, "system").otherwise("user").alias("role"),
        F.when(~own & ~narrates, F.col("said_by")).alias("name"), own.alias("train"),
        F.concat(before_text, unforged(F.col("text")), F.lit(CLOSE)).alias("segment"), F.char_length(before_text).alias("head"),
    )
    key = ["conv", "speaker", "stretch"]
    before = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    size = F.char_length("segment").cast("long")
    chars = size * F.col("copies")
    within = rows.withColumns({
        "place": F.coalesce(F.sum("copies").over(before), F.lit(0)), "offset": F.coalesce(F.sum(chars).over(before), F.lit(0)),
    })
    stretches = Window.partitionBy("conv", "speaker").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    bases = rows.groupBy(*key).agg(F.sum("copies").alias("rows"), F.sum(chars).alias("chars")).select(
        *(F.col(k).alias(f"base_{k}") for k in key),
        F.coalesce(F.sum("rows").over(stretches), F.lit(0)).alias("rows_before"), F.coalesce(F.sum("chars").over(stretches), F.lit(0)).alias("chars_before"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"base_{k}")) for k in key]
    placed = within.join(bases, same[0] & same[1] & same[2]).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    start = F.col("chars_before") + F.col("offset") + F.col("copy") * size
    end = start + size
    return placed.select(
        F.col("conv").alias(conversation), "speaker", (F.col("rows_before") + F.col("place") + F.col("copy")).alias("n"), F.col("turn").alias(turn),
        "role", "name", "segment", "train", start.alias("start"), end.alias("end"),
        F.when(F.col("train"), start + F.col("head")).otherwise(end).alias("mask_start"), end.alias("mask_end"),
    )


def training_rows(segments: DataFrame, span: int = 1 << 20, conversation: str = "conv_id") -> DataFrame:
    """The segments of `perspectives` joined into rows to train on: the conversation, speaker, part, start, text and masks.

    A row holds the segments that begin within one span of `span` characters of the dialogue, so a long dialogue becomes several rows (part
    from 0, rising; start is the text's offset in the dialogue) and no row gathers without bound. No segment is cut: a row is longer than
    `span` by less than its last segment. masks are (start, end) within the text, the stretches that the loss covers.
    """
    parts = segments.groupBy(conversation, "speaker", F.expr(f"start div {span}").alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("n", "start", "mask_start", "mask_end", "segment"))).alias("said")
    )
    own = F.filter("said", lambda s: s["mask_start"] < s["mask_end"])
    first = F.col("said")[0]["start"]
    return parts.select(
        conversation, "speaker", "part", first.alias("start"), F.concat_ws("", F.col("said.segment")).alias("text"),
        F.transform(own, lambda s: F.struct((s["mask_start"] - first).alias("start"), (s["mask_end"] - first).alias("end"))).alias("masks"),
    )


def op2_chat(spark, sf_dir: str) -> DataFrame:
    return perspectives(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP2_SQL = r"""
WITH said AS (SELECT conv_id, turn, role AS said_by, coalesce(text, '') AS text FROM conversations),
sides AS (SELECT DISTINCT conv_id, said_by AS speaker FROM said WHERE said_by IS NOT NULL AND said_by <> 'system'),
r AS (
    SELECT s.*, p.speaker, coalesce(said_by = p.speaker, false) AS train,
           CASE WHEN said_by = p.speaker THEN 'assistant' WHEN said_by = 'system' THEN 'system' ELSE 'user' END AS role,
           CASE WHEN said_by IS DISTINCT FROM p.speaker AND said_by IS DISTINCT FROM 'system' THEN said_by END AS name
    FROM said s JOIN sides p ON s.conv_id IS NOT DISTINCT FROM p.conv_id),
h AS (SELECT *, '<|im_start|>' || role || coalesce(' name=' || regexp_replace(
          replace(replace(replace(name, chr(92), chr(92) || chr(92)), chr(10), chr(92) || 'n'), chr(13), chr(92) || 'r'),
          '<(\\*)\|im_(start|end)\|>', '<\1\\|im_\2|>', 'g'), '') || chr(10) AS head FROM r),
g AS (SELECT *, head || regexp_replace(text, '<(\\*)\|im_(start|end)\|>', '<\1\\|im_\2|>', 'g') || '<|im_end|>' || chr(10) AS segment FROM h),
o AS (SELECT *, row_number() OVER w - 1 AS n, sum(length(segment)) OVER w AS "end" FROM g
      WINDOW w AS (PARTITION BY conv_id, speaker ORDER BY turn NULLS FIRST, said_by NULLS FIRST, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, speaker, n, turn, role, name, segment, train, CAST("end" - length(segment) AS BIGINT) AS start, CAST("end" AS BIGINT) AS "end",
       CAST(CASE WHEN train THEN "end" - length(segment) + length(head) ELSE "end" END AS BIGINT) AS mask_start, CAST("end" AS BIGINT) AS mask_end
FROM o
"""
