"""Filter interaction audit: what each filter removes, in every order in which the filters can run.

One pass over the texts gives each document a mask of the filters that it fails. Masks are counted per
part, which leaves at most 2**filters rows a part, and a count-weighted decision diagram of each part
is led through all orders by adjacent level swaps (see ``diagrams``). Whether a text stands under a
smaller id is decided on digests: copies are counted together before the digests meet, so a hot text
is one row per task, label and part. No text is shuffled.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced, table, whole_text, written
from .diagrams import Diagram

#: The filters in their natural order: few words, few distinct words, capitals, marks, copies.
LETTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_CAPITALS_PERCENT = 10
_MARKS = re.compile(rb"[#$%&*|]")
_CAPITALS = bytes(range(0x41, 0x5B))
_CONTINUATION = bytes(range(0x80, 0xC0))
SCHEMA = (
    "part string, filter_order string, step int, filter string, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def text_failures(text: bytes) -> int:
    """Bits 0 to 3: which of the filters A to D the UTF-8 text fails."""
    words = text.split()  # bytes: exactly the white space x20, x09-x0D
    points = len(text.translate(None, _CONTINUATION))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)) << 1
        | (100 * capitals > MAX_CAPITALS_PERCENT * points) << 2
        | (_MARKS.search(text) is not None) << 3
    )


def _profiles(docs: DataFrame, part: str) -> DataFrame:
    """doc_id, part, mask of A to D, and the SHA-256 of the text."""
    spark = docs.sparkSession
    schema = spark.createDataFrame([], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, part string, mask int, digest binary").schema

    def run(batches):
        for batch in sliced(batches):
            texts = [t.as_py() for t in batch.column(0).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array([text_failures(t) for t in texts], pa.int32()), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())],
                ["doc_id", "part", "mask", "digest"],
            )

    own = docs.select(whole_text().alias("text"), "doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"))
    return own.mapInArrow(run, schema)


def mask_counts(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """``part, mask, n, good, toxic``: documents per mask of failed filters, and how many of them are labelled so.

    Bit i of ``mask`` is filter i of ``LETTERS``. A text fails E if an identical text has a smaller ``doc_id``;
    rows without an id neither fail E nor make others fail. A NULL text is empty, a NULL part is the empty
    string. A document is good (toxic) if any of its label rows has quality 1 (toxic 1).
    """
    marks = labels.groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    ).filter("doc_id is not null and good + toxic > 0")
    rows = written(_profiles(docs, part), "audit-profiles")
    marked = rows.join(marks, "doc_id", "left").na.fill(0, ["good", "toxic"])
    same = ["digest", "mask", "part", "good", "toxic"]  # the digest determines the mask of A to D
    copies = marked.groupBy(*same, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    # per group of copies: rows, rows without an id, and the rows that share the group's smallest id
    groups = copies.groupBy(*same).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("no_id"),
        F.min("doc_id").alias("first_id"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"),
    )
    groups = written(groups, "audit-groups")
    least = groups.groupBy("digest").agg(F.min("first_id").alias("least"))
    passing = F.col("no_id") + F.when(F.col("first_id") == F.col("least"), F.col("first.n")).otherwise(0)
    settled = groups.join(least, "digest").withColumn("passing", passing)
    failing = 1 << LETTERS.index("E")
    either = F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), F.col("passing").alias("n")),
        F.struct(F.col("mask").bitwiseOR(F.lit(failing)).alias("mask"), (F.col("n") - F.col("passing")).alias("n")),
    )).alias("side")
    sides = settled.select("part", "good", "toxic", either).filter("side.n > 0")
    return sides.groupBy("part", F.col("side.mask").alias("mask")).agg(
        F.sum("side.n").alias("n"), F.sum(F.col("side.n") * F.col("good")).alias("good"), F.sum(F.col("side.n") * F.col("toxic")).alias("toxic")
    )


def audit_rows(part: str, masks: dict[int, tuple[int, int, int]]) -> list[tuple]:
    """The rows of one part: every order and step, read off the all-pass paths of its diagram."""
    paths = [path for path in Diagram(masks, len(LETTERS)).all_orders()]
    fails, unique, total = {}, {}, dict.fromkeys(range(len(LETTERS)), 0)
    for path in paths:
        fails[path[0][0]] = path[0][1][0]     # run first, a filter removes all that fail it
        unique[path[-1][0]] = path[-1][1][0]  # run last, it removes what fails nothing else
        for variable, removed, _ in path:
            total[variable] += removed[0]
    return [
        (part, "".join(LETTERS[v] for v, _, _ in path), step, LETTERS[v], kept[0], removed[0], fails[v] - removed[0], unique[v], removed[1], removed[2], total[v])
        for path in paths for step, (v, removed, kept) in enumerate(path, 1)
    ]


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """Every part, order and step of the five filters, with what is kept, removed, redundant and lost there.

    Columns as in ``SCHEMA``: ``removed`` falls to the step's filter and nothing before it, ``redundant``
    fails the filter but was removed earlier, ``unique_fails`` fails this filter alone, ``shapley`` is the
    filter's removals summed over all orders. Every part that occurs has all its rows, zeros included.

    NULL texts are empty (they fail A and, beyond the first, E); very long texts are read whole, one row
    at a time. Repeated rows are documents of their own; equal ids do not make each other fail E. An empty
    table gives no rows, without labels nothing is good or toxic. Other columns are ignored, whatever their names.
    """
    def run(frame: pd.DataFrame) -> pd.DataFrame:  # at most 32 rows: the masks of one part
        masks = {int(r.mask): (int(r.n), int(r.good), int(r.toxic)) for r in frame.itertuples()}
        return pd.DataFrame(audit_rows(frame["part"].iloc[0], masks), columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return mask_counts(docs, labels, part).groupBy("part").applyInPandas(run, SCHEMA)


def op11_filter_audit(spark, sf_dir):
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT d.doc_id, coalesce(d.text, '') AS text, coalesce(d.lang, '') AS part,
         coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic
  FROM documents d LEFT JOIN (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id) l USING (doc_id)),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM d),
m AS (SELECT part, good, toxic,
        (CASE WHEN len(words) < 100 THEN 1 ELSE 0 END)
      + (CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END)
      + (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 4 ELSE 0 END)
      + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END)
      + (CASE WHEN doc_id > least THEN 16 ELSE 0 END) AS mask FROM w),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT letter AS filter_order, bit AS seen FROM f
      UNION ALL SELECT filter_order || letter, seen + bit FROM o, f WHERE seen & bit = 0),
s AS (SELECT o.filter_order, k.step, f.letter, f.bit,
             (SELECT coalesce(sum(b.bit), 0) FROM f b WHERE strpos(substr(o.filter_order, 1, k.step - 1), b.letter) > 0) AS before
      FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step) k, f
      WHERE length(o.filter_order) = 5 AND substr(o.filter_order, k.step, 1) = f.letter),
r AS (SELECT c.part, s.filter_order, s.step, s.letter AS filter,
        sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM c, s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, filter,
       CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM r
"""
