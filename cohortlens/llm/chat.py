"""Chat formatting by perspective rotation: every speaker of a dialogue in turn is the assistant.

For each participant the dialogue is rendered with that speaker's turns as the assistant's, the others'
as turns of named users, and narrators (the system) as they are. Masks mark what the assistant says and
its end marker. A rendered dialogue is cut into parts of a bounded number of characters at turns, found
from running sums over ranges of the table: no dialogue, however long, is gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table
from .prefix import sums_before

NARRATORS = ("system",)
NAMELESS = "unknown"
#: A part takes the turns that start within this many characters.
PART_CHARS = 8192
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def escaped(text: Column) -> Column:
    """A text that cannot open or close a turn."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("<\\|"))


def messages(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, speaker, text, tie, times``: equal rows as one row with their number."""
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.when(F.trim("role") != "", F.col("role")), F.lit(NAMELESS)).alias("speaker"), escaped(F.col("text")).alias("text"),
    )
    return rows.groupBy("conv_id", "turn", "speaker", "text").agg(F.count(F.lit(1)).alias("times")).withColumn(
        "tie", F.md5(F.concat_ws(":", "speaker", "text"))
    )


def rotate(conversations: DataFrame, narrators=NARRATORS, part_chars: int = PART_CHARS) -> DataFrame:
    """``conv_id, perspective, part, start_char, n_turns, rendered, masks, trained_chars``.

    One row for each part of each dialogue as each of its participants sees it; parts in order give the
    whole dialogue without a gap. Turns are in the order of ``turn``, NULL first, ties by a hash of
    speaker and text; repeated rows are said as often as they occur. A missing speaker is a participant
    named "unknown", a missing text is empty, rows without ``conv_id`` are one dialogue. Dialogues of
    narrators alone have no participant and give no row. ``masks`` are (start, end) in code points of
    ``rendered``.
    """
    said = messages(conversations)
    narrated = F.col("speaker").isin(*narrators)
    participants = said.filter(~narrated).select(F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective")).distinct()
    seen = said.join(participants, said["conv_id"].eqNullSafe(participants["_conv"])).drop("_conv")
    own = F.col("speaker") == F.col("perspective")
    head = F.concat(
        F.lit(OPEN),
        F.when(own, "assistant").when(narrated, F.col("speaker")).otherwise(F.concat(F.lit("user name="), F.translate("speaker", "\n<|", "   "))),
        F.lit("\n"),
    )
    turns = seen.withColumns({"head": head, "own": own}).withColumn("segment", F.concat("head", "text", F.lit(CLOSE + "\n")))
    turns = turns.select(
        "conv_id", "perspective", "turn", "tie", "segment", "own", F.length("head").cast("long").alias("head"),
        F.length("segment").cast("long").alias("size"), "times", (F.length("segment") * F.col("times")).cast("long").alias("total"),
    )
    placed = sums_before(turns, ["conv_id", "perspective"], ["turn", "tie"], "total", "before")
    each = placed.withColumn("nth", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1))).withColumn("start", F.col("before") + F.col("nth") * F.col("size"))
    # a part holds at most part_chars characters and one more turn
    parts = each.groupBy("conv_id", "perspective", F.floor(F.col("start") / part_chars).alias("_window")).agg(
        F.array_sort(F.collect_list(F.struct("start", "segment", "own", "head", "size"))).alias("s"), F.min("start").alias("start_char"), F.count(F.lit(1)).alias("n_turns")
    )
    masks = F.transform(
        F.filter("s", lambda x: x["own"]),
        lambda x: F.struct((x["start"] - F.col("start_char") + x["head"]).alias("start"), (x["start"] - F.col("start_char") + x["size"] - 1).alias("end")),
    )
    rendered = parts.select("conv_id", "perspective", "start_char", "n_turns", F.array_join(F.transform("s", lambda x: x["segment"]), "").alias("rendered"), masks.alias("masks"), "_window")
    return rendered.select(
        "conv_id", "perspective", F.col("_window").cast("long").alias("part"), "start_char", "n_turns", "rendered", "masks",
        F.aggregate("masks", F.lit(0).cast("long"), lambda n, m: n + m["end"] - m["start"]).alias("trained_chars"),
    )


def op6_rotate_perspectives(spark, sf_dir):
    found = rotate(table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("masks", lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string"))), ",")
    return found.withColumn("masks", spans)


ORACLE = rf"""
WITH said AS (SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(CASE WHEN trim(role) <> '' THEN role END, '{NAMELESS}') AS speaker,
                     replace(coalesce(text, ''), '<|', '<\|') AS text FROM conversations),
participants AS (SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker NOT IN ('system')),
turns AS (SELECT s.conv_id, p.perspective, s.turn, md5(s.speaker || ':' || s.text) AS tie, s.speaker = p.perspective AS own, s.text,
                 '{OPEN}' || CASE WHEN s.speaker = p.perspective THEN 'assistant' WHEN s.speaker IN ('system') THEN s.speaker
                 ELSE 'user name=' || translate(s.speaker, chr(10) || '<|', '   ') END || chr(10) AS head
          FROM said s JOIN participants p ON s.conv_id IS NOT DISTINCT FROM p.conv_id),
segments AS (SELECT *, head || text || '{CLOSE}' || chr(10) AS segment FROM turns),
placed AS (SELECT *, row_number() OVER w AS nth, CAST(coalesce(sum(length(segment)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
           FROM segments WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, tie)),
windows AS (SELECT *, start // {PART_CHARS} AS part, min(start) OVER (PARTITION BY conv_id, perspective, start // {PART_CHARS}) AS start_char FROM placed)
SELECT conv_id, perspective, part, start_char, count(*) AS n_turns, string_agg(segment, '' ORDER BY start) AS rendered,
       coalesce(string_agg((start - start_char + length(head)) || ':' || (start - start_char + length(segment) - 1), ',' ORDER BY start) FILTER (own), '') AS masks,
       CAST(coalesce(sum(length(segment) - length(head) - 1) FILTER (own), 0) AS BIGINT) AS trained_chars
FROM windows GROUP BY conv_id, perspective, part, start_char
"""
