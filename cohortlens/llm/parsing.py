"""Document fingerprints by locally consistent parsing.

A text is parsed level by level. Runs of one symbol become a symbol. Deterministic coin tossing gives
each symbol a small label from itself and its left neighbour (the lowest bit in which they differ, and
its value); four rounds leave six labels, neighbours differing. Symbols whose label is a local minimum
start a phrase, so phrases are 2 to about 11 symbols long and depend on nothing but a few neighbours.
A phrase's name, hashed from its symbols, is a symbol of the next level. So two equal substrings are
parsed alike but for some phrases at their ends, wherever they stand.

The fingerprint is a sketch of the phrase names of two levels (about 9 and 27 bytes long): one 16-bit
minimum for each of 128 classes of names. The likeness of two fingerprints estimates the share of
phrases in common (Dice).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced, table, whole_text

LANES = 128
SKETCHED = (2, 3)
ROUNDS = 4
CHUNK_BYTES = 1 << 18
EMPTY = "0" * (4 * LANES)

_BYTES = np.random.default_rng(2024).integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACES = np.random.default_rng(2025).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def coin_labels(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels 0 to 5 of symbols whose left neighbours differ; ``first`` marks the first symbol of a text."""
    x = symbols
    for _ in range(ROUNDS):
        left = np.empty_like(x)
        left[1:] = x[:-1]
        left[first] = x[first] ^ x.dtype.type(1)
        apart = x ^ left
        lowest = apart & (~apart + x.dtype.type(1))
        bit = np.bitwise_count(lowest - x.dtype.type(1))
        # neighbours that are equal after an edge's label (apart 0) count as differing in bit 0
        bit[apart == 0] = 0
        x = (2 * bit + ((x >> bit.astype(x.dtype)) & x.dtype.type(1)).astype(np.uint8)).astype(np.uint8)
    return x


def parse(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level: names of the phrases, and which of them are the first of their text."""
    # runs of equal symbols
    begins = np.ones(len(symbols), dtype=bool)
    begins[1:] = (symbols[1:] != symbols[:-1]) | first[1:]
    at = np.flatnonzero(begins)
    length = np.diff(np.append(at, len(symbols))).astype(np.uint64)
    symbols, first = symbols[at], first[at]
    many = length > 1
    symbols[many] = mix(symbols[many] + mix(length[many]))
    # phrases start at local minima of the labels
    label = coin_labels(symbols, first)
    starts = first.copy()
    starts[1:-1] |= (label[1:-1] < label[:-2]) & (label[1:-1] < label[2:]) & ~first[2:]
    at = np.flatnonzero(starts)
    length = np.diff(np.append(at, len(symbols)))
    place = np.arange(len(symbols)) - np.repeat(at, length)
    names = np.add.reduceat(mix(symbols) * _PLACES[place & 63] + mix(place.astype(np.uint64) >> np.uint64(6)), at)
    return mix(names + length.astype(np.uint64)), first[at]


def phrase_names(texts: list[bytes], levels: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each level (names, number of the text each belongs to) of all texts, parsed together but apart."""
    filled = [i for i, t in enumerate(texts) if t]
    if not filled:
        return [(np.zeros(0, np.uint64), np.zeros(0, np.int64))] * levels
    symbols = _BYTES[np.frombuffer(b"".join(texts[i] for i in filled), dtype=np.uint8)]
    first = np.zeros(len(symbols), dtype=bool)
    first[np.cumsum([0, *(len(texts[i]) for i in filled[:-1])])] = True
    out, owners = [], np.array(filled)
    for _ in range(levels):
        symbols, first = parse(symbols, first)
        out.append((symbols, owners[np.cumsum(first) - 1]))
    return out


def sketches(texts: list[bytes]) -> np.ndarray:
    """(texts, lanes) of 16-bit minima; 0 where no name falls into a lane."""
    out = np.zeros((len(texts), LANES), dtype=np.uint16)
    levels = phrase_names(texts, max(SKETCHED))
    names = np.concatenate([levels[k - 1][0] for k in SKETCHED])
    if not len(names):
        return out
    owner = np.concatenate([levels[k - 1][1] for k in SKETCHED])
    names = mix(names ^ np.uint64(0x9E3779B97F4A7C15))
    lane = (names >> np.uint64(57)).astype(np.int64)
    value = (names & np.uint64(0x00FFFFFFFFFFFFFF)) >> np.uint64(16)  # 40 bits decide, 16 are kept
    cell = owner * LANES + lane
    order = np.lexsort((value, cell))
    cell, value = cell[order], value[order]
    lead = np.ones(len(cell), dtype=bool)
    lead[1:] = cell[1:] != cell[:-1]
    out.reshape(-1)[cell[lead]] = np.maximum(value[lead] & np.uint64(0xFFFF), 1).astype(np.uint16)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated share of phrases in common, row by row: 1 for equal sketches, also of empty texts."""
    either = ((a != 0) | (b != 0)).sum(axis=1)
    same = ((a == b) & (a != 0)).sum(axis=1)
    jaccard = np.where(either > 0, same / np.maximum(either, 1), 1.0)
    return 2 * jaccard / (1 + jaccard)


def as_text(sketch: np.ndarray) -> str:
    return sketch.astype(">u2").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), dtype=">u2").astype(np.uint16)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of every row; NULL counts as empty, whose fingerprint is all zeros."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in sliced(batches):
            found = []
            for chunk in _chunks(batch.column(1).cast(pa.binary()).to_pylist()):
                found += [as_text(s) for s in sketches(chunk)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["doc_id", "fingerprint"])

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(run, f"doc_id {kind}, fingerprint string")


def _chunks(texts: list[bytes]):
    chunk, size = [], 0
    for t in texts:
        if chunk and size + len(t) > CHUNK_BYTES:
            yield chunk
            chunk, size = [], 0
        chunk.append(t)
        size += len(t)
    if chunk:
        yield chunk


def edited(text: str, following: str) -> str:
    """The last half (rounded down) of the code points replaced by as many of the following text's first."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def with_next(docs: DataFrame) -> DataFrame:
    """``_bucket, _ghost, doc_id, text`` so dealt that each row's successor by descending id is in its partition.

    Ranges of ids are the partitions. The first row of a range is also sent, as a ghost, to the range
    before it, and the very first to the last: one extra row a partition, and no text is shuffled twice.
    Rows that repeat an id follow each other in the order of a hash of their texts; NULL ids come last.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    bounds = np.unique(rows.select("doc_id").approxQuantile("doc_id", [i / n for i in range(1, n)], 0.1 / n)) if n > 1 else np.zeros(0)

    @F.arrow_udf("int")
    def bucket(ids: pa.Array) -> pa.Array:  # 0 holds the largest ids, the last one the smallest and NULL
        found = np.searchsorted(bounds, ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False), side="left")
        return pa.array(len(bounds) - found, pa.int32())

    placed = rows.withColumn("_bucket", bucket("doc_id"))
    firsts = placed.select("doc_id", "_bucket").groupBy("_bucket").agg(F.max("doc_id").alias("first")).orderBy("_bucket").collect()  # one row a partition
    sent: dict = {}
    for before, here in zip([firsts[-1:][0] if firsts else None, *firsts], firsts):
        sent.setdefault(here["first"], []).append(before["_bucket"])

    @F.arrow_udf("array<int>")
    def ghosts(ids: pa.Array) -> pa.Array:
        return pa.array([sent.get(i, []) for i in ids.to_pylist()], pa.list_(pa.int32()))

    copies = F.concat(
        F.array(F.struct(F.col("_bucket").alias("_bucket"), F.lit(False).alias("_ghost"))),
        F.transform("_to", lambda b: F.struct(b.alias("_bucket"), F.lit(True).alias("_ghost"))),
    )
    dealt = placed.withColumn("_to", ghosts("doc_id")).withColumn("_copy", F.explode(copies)).select("_copy.*", "doc_id", "text")
    return dealt.repartitionById(max(1, len(bounds) + 1), F.col("_bucket")).sortWithinPartitions(
        "_ghost", F.col("doc_id").desc_nulls_last(), F.xxhash64("text")
    )


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text and of the next document, and their likenesses."""

    def run(batches):
        pending: list[tuple] = []  # rows whose successor is not known yet, and before them rows of this chunk

        def flush(rows):
            own = [r for r in rows[:-1] if not r[0]]
            texts = [r[2] for r in rows]
            changed = [edited(a, b) for a, b in zip(texts, texts[1:])][:len(own)]
            sketch = np.concatenate([sketches(c) for c in _chunks([t.encode("utf-8") for t in [*texts, *changed]])])
            here, after, other = sketch[:len(own)], sketch[1:len(own) + 1], sketch[len(texts):]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r[1] for r in own], pa.int64()),
                    pa.array([len(r[2]) for r in own], pa.int64()),
                    pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in changed], pa.string()),
                    pa.array([as_text(s) for s in here], pa.string()),
                    pa.array([as_text(s) for s in other], pa.string()),
                    pa.array(likeness(here, other), pa.float64()),
                    pa.array(likeness(here, after), pa.float64()),
                ],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

        size, done = 0, False
        for batch in sliced(batches):
            if done:
                continue
            for ghost, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                pending.append((ghost, doc_id, text))
                size += len(text)
                if ghost:  # only the first ghost follows a row
                    done = True
                    break
                if size > CHUNK_BYTES and len(pending) > 1:
                    yield flush(pending)
                    pending, size = pending[-1:], len(text)
        if len(pending) > 1:
            yield flush(pending)

    return with_next(docs).select("_ghost", "doc_id", "text").mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )


def op10_parse_fingerprints(spark, sf_dir):
    return compare_with_edits(table(spark, sf_dir, "documents"))
