"""SimHash near-duplicates: Golay-code fuzzy keys, pigeonholed segments, join and verify.

The 64 bits of a fingerprint are cut into segments of 22, 21 and 21 bits. Two fingerprints that
differ in at most two bits have a cyclic pair of segments (0,1), (1,2) or (2,0) whose first one is
equal and whose second one differs in at most one bit: with an error in two segments the third is
equal and the next has one; with both errors in one segment the other two are equal. So a key is
(pair, exact segment, index of a Golay codeword near the other segment): 3 to 18 keys of 33 bits.

Work is done on distinct fingerprints, so copies cost nothing. Keys are counted with map-side
combining. A key of two fingerprints is a candidate pair, verified by its bit distance. Fingerprints
in a larger key (families of near copies) are linked exactly without pairs: each visits itself and
its 64 one-bit neighbours, and two fingerprints are within two bits if and only if they visit a
common value. At most 65 fingerprints meet at a value, so no group grows with the data.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import sheltered, sliced, table, whole_text, without_ids, written
from .components import connected_components
from .golay import codeword_indices

SEED = 42
SHINGLE_WORDS = 3
MAX_DISTANCE = 2
SEGMENTS = (22, 21, 21)
_ROWS = 1 << 14
#: Column that numbers the rows of ``representatives``.
ROW = "_simhash_row"


def fingerprint(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a UTF-8 text; zero if it has no words."""
    words = text.lower().split()  # bytes: A-Z only, and exactly the white space x20, x09-x0D
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= width:
        return xxh64_intdigest(line, SEED)
    ends = [e + i for i, e in enumerate(accumulate(map(len, words)))]
    starts = [0, *(e + 1 for e in ends)]
    hashes = np.fromiter((xxh64_intdigest(line[s:e], SEED) for s, e in zip(starts, ends[width - 1:])), dtype="<u8", count=len(words) - width + 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _ROWS):
        part = hashes[at:at + _ROWS]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep`` and fp: fingerprints as signed longs, one row per input row. NULL texts count as empty."""
    spark = docs.sparkSession
    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        for batch in sliced(batches):
            texts = batch.column(0).cast(pa.binary())
            found = np.fromiter((fingerprint(t.as_py(), width) for t in texts), dtype=np.uint64, count=len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found.view(np.int64))], [*keep, "fp"])

    schema = spark.createDataFrame([], f"{kinds}, fp long").schema
    return docs.select(whole_text().alias("text"), *keep).mapInArrow(run, schema)


def segment_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of fingerprints (uint64), and the position of each key's fingerprint."""
    keys, owners = [], []
    shifts = np.cumsum((0, *SEGMENTS[:-1]))
    parts = [((fps >> np.uint64(s)) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in zip(shifts, SEGMENTS)]
    for pair in range(3):
        exact, fuzzy = parts[pair], parts[(pair + 1) % 3]
        indices, distinct = codeword_indices(fuzzy)
        key = (np.int64(pair) << 34) | (exact[:, None] << 12) | indices
        keys.append(key[distinct])
        owners.append(np.nonzero(distinct)[0])
    return np.concatenate(keys), np.concatenate(owners)


def _keys(distinct: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            keys, owners = segment_keys(fps.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps[owners])], ["key", "fp"])

    return distinct.select("fp").mapInArrow(run, "key long, fp long")


def links(distinct: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints within ``max_distance`` (0 to 2) bits of a chain.

    ``distinct`` has one column ``fp`` without repeats. In a crowded neighbourhood the links are a
    star per visited value, not all pairs; the components are the same.
    """
    if not 0 <= max_distance <= 2:
        raise ValueError(f"max_distance is {max_distance}; segments and code are laid out for 0, 1 or 2 bits")
    keys = _keys(distinct)
    met = written(
        keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).filter("n > 1"),
        "simhash-keys",
    )
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    pairs = met.filter("n = 2").filter(near).select("a", "b").distinct()
    crowded = keys.join(met.filter("n > 2").select("key"), "key", "left_semi").select("fp").distinct()
    flips = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), b)))
    around = F.concat(F.array("fp"), flips)
    visits = crowded.select("fp", F.explode(around).alias("at"))
    meets = visits.groupBy("at").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)  # at most 65 each
    if max_distance == 2:
        stars = meets.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
    else:  # only a value that is itself a fingerprint of the group has its visitors within one bit
        stars = meets.filter(F.array_contains("fps", F.col("at")) & F.lit(max_distance == 1)).select(F.col("at").alias("a"), F.explode("fps").alias("b"))
    return pairs.unionByName(stars.filter("a <> b").filter(near).distinct())


def _first_of_components(rows: DataFrame, first: Column, max_distance: int) -> DataFrame:
    """(fp, first): for each fingerprint of ``rows`` the minimum ``first`` over all rows of its component."""
    distinct = written(rows.groupBy("fp").agg(first.alias("rep")), "simhash-distinct")
    groups = connected_components(links(distinct, max_distance))
    named = distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = named.groupBy("component").agg(F.min("rep").alias("first"))
    return written(named.join(smallest, "component").select("fp", "first"), "simhash-components")


def near_duplicates(docs: DataFrame, width: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """``doc_id, fp, fingerprint, component_id`` of every row.

    ``component_id`` is the smallest ``doc_id`` that is reachable over links. Texts without words
    (NULL, empty, white space) have fingerprint zero and are linked like any other. Rows that repeat
    a ``doc_id`` are rows of their own; NULL ids are ignored by the minimum. Other columns are ignored.
    """
    rows = written(fingerprints(docs, width), "simhash-rows")
    by_fp = _first_of_components(rows, F.min("doc_id"), max_distance).withColumnRenamed("first", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, width: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Exactly one row of each component, with all columns of ``docs`` as they are: the one with the smallest ``doc_id``.

    Rows without an id come last; of rows with the same id the smallest fingerprint stays, then the
    first row. Rows are told apart by a number of their own, written with them, so neither NULL nor
    shared ids touch rows of other components.
    """
    docs, back = sheltered(docs, "doc_id", "text")
    own = written(docs.withColumn(ROW, F.monotonically_increasing_id()), "simhash-docs")
    rows = written(fingerprints(own, width, ("doc_id", ROW)), "simhash-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", ROW))
    by_fp = _first_of_components(rows, first, max_distance).select("fp", F.col(f"first.{ROW}").alias("_kept"))
    losers = written(rows.join(by_fp, "fp").filter(F.col(ROW) != F.col("_kept")).select(ROW), "simhash-losers")
    return without_ids(own, losers, ROW).select(*back)


def op7_simhash_golay(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).drop("fp")
