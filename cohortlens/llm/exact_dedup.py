"""Exact de-duplication by progressive refinement: length, then prefix hash, then full hash.

Rows whose length is shared by no other row are settled after the first step, rows whose (length,
prefix hash) is unique after the second. Only the rest have their full content hashed and grouped.
The sets of shared lengths and shared (length, prefix) pairs travel as bitmaps of fixed size, so no
text is shuffled and a hot length or a hot group of copies is only ever counted with map-side
combining. A bit that is set by accident costs one more full hash, never a wrong group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import may_contain, membership_bitmap, sheltered, table, whole_text, written

WHITE = r"[\x20\x09-\x0D]+"
PREFIX_CHARS = 64


def normalised(text: Column) -> Column:
    """Every run of ASCII white space as one space."""
    return F.regexp_replace(text, WHITE, " ")


def progressive_dedup(docs: DataFrame, prefix_chars: int = PREFIX_CHARS, digest_all: bool = False) -> DataFrame:
    """Groups of equal normalised texts: one row per input row.

    Columns: ``doc_id, keep_id, group_size, kept, text_sha256`` and ``refined`` (whether the full
    content was needed to settle the row). Of a group the row with the smallest ``doc_id`` stays;
    rows without an id come last. Exactly one row of a group is kept, also if a ``doc_id`` is
    repeated. A NULL text counts as empty, so NULL, empty texts are one group (white space alone
    normalises to one space and is another). ``text_sha256`` is NULL for rows settled without their
    full content unless ``digest_all``. Other columns are ignored; an empty table gives no rows.
    """
    texts = docs.select("doc_id", normalised(whole_text()).alias("_text"))
    keyed = texts.select(
        "doc_id", "_text",
        F.octet_length("_text").alias("_length"),
        F.xxhash64(F.substring("_text", 1, prefix_chars)).alias("_prefix"),
    )
    # Step 1 and 2 need two numbers a row; written once, so that the texts are not normalised for each.
    narrow = written(keyed.select("_length", "_prefix"), "dedup-keys")
    lengths = narrow.groupBy("_length").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(F.xxhash64("_length").alias("_h1"))
    by_length = may_contain(narrow.withColumn("_h1", F.xxhash64("_length")), "_h1", membership_bitmap(lengths, "_h1"), "_same").filter("_same")
    prefixes = by_length.groupBy("_length", "_prefix").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    pairs = membership_bitmap(prefixes.select(F.xxhash64("_length", "_prefix").alias("_h2")), "_h2")

    # Step 3: the full content, of survivors only (of all rows where the caller wants every digest).
    marked = may_contain(keyed.withColumn("_h2", F.xxhash64("_length", "_prefix")), "_h2", pairs, "refined")
    digest = F.sha2(F.col("_text"), 256)
    rows = written(
        marked.select(
            "doc_id", "_length", "_prefix", "refined",
            (digest if digest_all else F.when(F.col("refined"), digest)).alias("text_sha256"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "dedup-rows",
    )
    key = ["_length", "_prefix", "text_sha256"]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row"))
    groups = rows.filter("refined").groupBy(*key).agg(first.alias("_first"), F.count(F.lit(1)).alias("_size")).filter("_size > 1")
    # Written, so that the join deals both sides anew: a hot group is then one row on the right and many
    # on the left, which adaptive skew handling splits (not so if the join took over the partitions of the count).
    groups = written(groups, "dedup-groups")
    out = rows.filter("refined").join(groups, key, "left").unionByName(
        rows.filter("not refined").withColumns({"_first": F.lit(None).cast(groups.schema["_first"].dataType), "_size": F.lit(None).cast("long")})
    )
    alone = F.col("_size").isNull()
    return out.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("_first.doc_id")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("_row") == F.col("_first._row"))).alias("kept"),
        "text_sha256",
        "refined",
    )


def kept_documents(docs: DataFrame, verdict: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever they are called.

    Only rows that may belong to a group of copies (bitmap over their ids) are joined; the others
    pass without a shuffle of their texts. A repeated row stays once.
    """
    verdict = written(progressive_dedup(docs) if verdict is None else verdict, "dedup-verdict")
    grouped = verdict.filter("group_size > 1")
    docs, back = sheltered(docs, "doc_id", "text")
    columns = docs.columns
    ids = membership_bitmap(grouped.select(F.xxhash64("doc_id").alias("_id_hash")), "_id_hash")
    marked = may_contain(docs.withColumn("_id_hash", F.xxhash64("doc_id")), "_id_hash", ids, "_maybe")
    alone = marked.filter(~F.col("_maybe")).select(*columns)
    maybe = marked.filter("_maybe").withColumn("_sha", F.sha2(normalised(whole_text()), 256))
    lost = grouped.groupBy(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_digest")).agg(
        F.max("kept").alias("_stays"), F.count(F.lit(1)).alias("_rows")
    )
    joined = maybe.join(lost, maybe["doc_id"].eqNullSafe(lost["_id"]) & (maybe["_sha"] == lost["_digest"]), "left")
    # rows outside every group and the one keeper of a group, unless its row is repeated
    plain = joined.filter(F.col("_stays").isNull() | (F.col("_stays") & (F.col("_rows") == 1))).select(*columns)
    repeated = joined.filter(F.col("_stays") & (F.col("_rows") > 1)).dropDuplicates(["doc_id", "_sha"]).select(*columns)
    return alone.unionByName(plain).unionByName(repeated).select(*back)


def op2_exact_dedup(spark, sf_dir):
    return progressive_dedup(table(spark, sf_dir, "documents"), digest_all=True).drop("refined")


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM d
"""
