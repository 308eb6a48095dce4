"""Concatenate and cut: documents as one run of ids, cut into windows of a fixed length.

Two passes. The first encodes each document, ends it with the separator and writes the ids with their
start inside the partition; the totals of the partitions, summed in order, give every document its
place in the whole run. The second cuts the run at multiples of the window: a document that crosses
a boundary leaves a piece on either side. Only the totals (one row a partition) are ever gathered.
All sequences but the very last are full, so there is no padding but there.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import sliced, table, whole_text, written
from .wordbpe import WordBPE

WINDOW = 4096
SEPARATOR = 2
VOCABULARY = "word_bpe_49k.json"


@lru_cache(maxsize=2)
def _encoder(vocabulary: str) -> WordBPE:
    """One encoder a Python worker, kept from task to task."""
    import public_tokenizers

    return WordBPE(public_tokenizers.path(vocabulary))


def tokens(docs: DataFrame, vocabulary: str = VOCABULARY, separator: int = SEPARATOR) -> DataFrame:
    """Pass one: ``doc_id, ids, n, part, start``; ids as little-endian 16-bit numbers, ``start`` within ``part``.

    A NULL or empty text is the separator alone.
    """
    end = np.array([separator], dtype="<u2").tobytes()

    def run(batches):
        encoder, part, start = _encoder(vocabulary), TaskContext.get().partitionId(), 0
        for batch in sliced(batches):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            ids = [x.astype("<u2", copy=False).tobytes() + end for x in encoder.encode(texts)]
            n = np.array([len(x) // 2 for x in ids], dtype=np.int64)
            starts = start + np.cumsum(n) - n
            start += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary()), pa.array(n), pa.array(np.full(len(n), part)), pa.array(starts)],
                ["doc_id", "ids", "n", "part", "start"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(run, f"doc_id {kind}, ids binary, n long, part long, start long")


def pieces(docs: DataFrame, window: int = WINDOW, vocabulary: str = VOCABULARY, separator: int = SEPARATOR) -> DataFrame:
    """Pass two: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``, one row a piece.

    ``ids`` are little-endian 32-bit numbers. Pieces of a sequence lie one after the other from offset
    0; ``start`` counts from the beginning of the document. Rows that repeat a document are packed as
    often as they occur; an empty table gives no pieces; other columns are ignored.
    """
    if window < 1:
        raise ValueError(f"window is {window}; it must be at least 1")
    first = written(tokens(docs, vocabulary, separator), "packing-tokens")
    totals = first.groupBy("part").agg(F.sum("n").alias("total"))  # one row a partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    places = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    placed = first.join(F.broadcast(places), "part").select("doc_id", "ids", (F.col("base") + F.col("start")).alias("at"))

    def run(batches):
        for batch in sliced(batches):
            rows, cut = [], []
            for row, (ids, at) in enumerate(zip(batch.column(1), batch.column(2).to_pylist())):
                ids = np.frombuffer(ids.as_buffer(), dtype="<u2").astype("<u4")
                start = 0
                while start < len(ids):
                    length = min(len(ids) - start, window - (at + start) % window)
                    piece = ids[start:start + length].tobytes()
                    rows.append(row)
                    cut.append((start, length, piece, len(ids), (at + start) // window, (at + start) % window))
                    start += length
            names = ["start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*cut), kinds)] if cut else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *columns], ["doc_id", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return placed.mapInArrow(run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, length, ids, doc_ids, lengths``: the pieces of each sequence joined (at most a window of ids)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id",
        F.aggregate("p", F.lit(0).cast("long"), lambda n, x: n + x["length"]).alias("length"),
        F.aggregate("p", F.lit(b""), lambda all, x: F.concat(all, x["ids"])).alias("ids"),
        F.col("p.doc_id").alias("doc_ids"),
        F.col("p.length").alias("lengths"),
    )


def with_crc(packed: DataFrame) -> DataFrame:
    """``ids`` replaced by ``ids_crc32``, the unsigned CRC-32 of the bytes."""
    return packed.withColumn("ids_crc32", F.crc32("ids")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op8_pack_documents(spark, sf_dir):
    return with_crc(pieces(table(spark, sf_dir, "documents")))
