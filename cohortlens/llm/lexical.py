"""Ranked lexical search over a length-stratified index.

A document's normaliser m depends on its length alone, so documents of equal m form a stratum in which
the impact of a term depends on its tf alone: postings are kept by (term, tf) and an impact is computed
once per tf. The largest tf of a term bounds its impact in the stratum, and the sum of an item's bounds
orders the visits: the strata with the highest bounds are scored first, their 20th best score is the
floor of the item, and of all other strata only those whose bound reaches the floor are scored.

Items are taken in blocks of bounded text. Documents are read once a block of items and reduced to bags
of the block's terms; bags are dealt by ranges of (m, row), so a hot stratum spans several tasks, and a
stratum is stored in chunks of bounded postings. A task answers with at most ``k`` rows an item.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import sliced, table, whole_text, written

K = 20
#: Text bytes of the items that are answered together, and so the bound of all that is sent to tasks.
BLOCK_BYTES = 4 << 20
#: Postings of one chunk of a stratum.
CHUNK_POSTINGS = 1 << 13
#: Postings that a partition of the index holds.
PART_POSTINGS = 1 << 22
#: Chunks per item that are visited first, to learn its floor.
SEEDS = 4
#: Chunks whose bounds are ordered together.
CHUNKS_AT_ONCE = 256
#: Items that are scored together in a chunk.
ITEMS_AT_ONCE = 512

#: Bytes to terms: separators become spaces, A-Z become a-z, all else stays.
_TERMS = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order."""
    return text.translate(_TERMS).split()


class Items:
    """A block of items as flat arrays: the distinct terms of each with their number of occurrences."""

    def __init__(self, texts: list[bytes]):
        self.vocabulary: dict[bytes, int] = {}
        bags = [Counter(self.vocabulary.setdefault(t, len(self.vocabulary)) for t in terms(text)) for text in texts]
        self.numbers = np.array([i for i, bag in enumerate(bags) if bag], dtype=np.int64)  # items without terms find nothing
        self.starts = np.cumsum([0] + [len(bag) for bag in bags if bag])
        self.terms = np.fromiter((t for bag in bags for t in bag), dtype=np.int64)
        self.repeats = np.fromiter((n for bag in bags for n in bag.values()), dtype=np.int64)

    def weigh(self, documents: int, frequencies: dict[int, int]) -> None:
        """Fixes what an occurrence of each term in an item is worth; terms that no document has are worth nothing."""
        weight = np.zeros(len(self.vocabulary), dtype=np.int64)
        for t, df in frequencies.items():
            weight[t] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
        self.worth = self.repeats * weight[self.terms]


def impacts(tf: np.ndarray, m: int) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def bags(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tfs`` of every row: its number of terms, and the vocabulary's terms in it with their tf."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in sliced(batches):
            lengths, found, counts = [], [], []
            for text in batch.column(0).cast(pa.binary()):
                own = terms(text.as_py())
                bag = Counter(own)
                known = [(vocabulary[t], tf) for t, tf in bag.items() if t in vocabulary]
                lengths.append(len(own))
                found.append([t for t, _ in known])
                counts.append([tf for _, tf in known])
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(lengths, pa.int64()), pa.array(found, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
                ["doc_id", "n", "terms", "tfs"],
            )

    schema = spark.createDataFrame([], f"doc_id {kind}, n long, terms array<int>, tfs array<int>").schema
    return docs.select(whole_text().alias("text"), "doc_id").mapInArrow(run, schema)


def _chunks(batches) -> Iterator[tuple[int, pa.Array, list, list]]:
    """Runs of documents of equal m with at most ``CHUNK_POSTINGS`` postings (or one document): (m, ids, terms, tfs)."""
    m, ids, found, counts, size = None, [], [], [], 0
    for batch in batches:
        for i, (stratum, t, c) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3))):
            t, c = t.values.to_numpy(), c.values.to_numpy()
            if ids and (stratum != m or size + len(t) > CHUNK_POSTINGS):
                yield m, pa.concat_arrays(ids), found, counts
                ids, found, counts, size = [], [], [], 0
            m = stratum
            ids.append(batch.column(1).slice(i, 1))
            found.append(t)
            counts.append(c)
            size += len(t)
    if ids:
        yield m, pa.concat_arrays(ids), found, counts


def stratified_index(bags_: DataFrame, documents: int, length: int, postings: int) -> DataFrame:
    """The index as a table, one row a chunk of a stratum.

    ``chunk`` is its number, ``docs`` are its documents by ascending id. Group g of its postings belongs to
    term ``terms[g]`` and to ``tfs[g]``, and ``places[starts[g]:starts[g+1]]`` are its documents' places.
    Groups are in order of term, then falling tf.
    """
    spark = bags_.sparkSession
    kind = bags_.schema["doc_id"].dataType.simpleString()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-postings // PART_POSTINGS))
    normaliser = F.expr(f"75 + (25 * n * {documents}L) div {length}L")
    dealt = (
        bags_.filter(F.size("terms") > 0)
        .select(normaliser.alias("m"), "doc_id", "terms", "tfs", F.monotonically_increasing_id().alias("row"))
        .repartitionByRange(parts, "m", "row")
        .sortWithinPartitions("m", F.col("doc_id").asc_nulls_last())
        .drop("row")
    )

    def run(batches):
        number = TaskContext.get().partitionId() << 33
        for m, ids, found, counts in _chunks(batches):
            place = np.repeat(np.arange(len(found)), [len(t) for t in found])
            term, tf = np.concatenate(found).astype(np.int64), np.concatenate(counts).astype(np.int64)
            order = np.lexsort((place, -tf, term))
            term, tf, place = term[order], tf[order], place[order]
            first = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])])
            rows = [[int(m)], None, term[first], tf[first], np.r_[first, len(term)], place]
            lists = [pa.array([r], pa.list_(pa.int32())) for r in rows[2:]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([int(m)], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), *lists],
                ["chunk", "m", "docs", "terms", "tfs", "starts", "places"],
            )
            number += 1

    schema = spark.createDataFrame([], f"chunk long, m long, docs array<{kind}>, terms array<int>, tfs array<int>, starts array<int>, places array<int>").schema
    return dealt.mapInArrow(run, schema)


class _Chunk:
    """One row of the index, with the impact of each group of postings."""

    def __init__(self, m: int, terms_: np.ndarray, tfs: np.ndarray, starts: np.ndarray | None = None, places: np.ndarray | None = None):
        distinct, which = np.unique(tfs, return_inverse=True)
        self.impact = impacts(distinct.astype(np.int64), m)[which]  # once per tf of the stratum
        self.first = np.flatnonzero(np.r_[True, terms_[1:] != terms_[:-1]])
        self.terms, self.starts, self.places = terms_, starts, places
        self.each = None if starts is None else np.repeat(self.impact, np.diff(starts))

    def bounds(self, items: Items) -> np.ndarray:
        """Per item, what no document of the chunk can exceed: every term at its largest tf."""
        most = np.zeros(len(items.vocabulary), dtype=np.int64)
        most[self.terms[self.first]] = self.impact[self.first]
        return np.add.reduceat(items.worth * most[items.terms], items.starts[:-1])

    def scores(self, items: Items, asked: np.ndarray, documents: int) -> np.ndarray:
        """Scores of the asked items (their places in the block), a row per item and a column per document."""
        edges = self.starts[np.r_[self.first, len(self.terms)]].astype(np.int64)
        span = np.full(len(items.vocabulary), -1, dtype=np.int64)
        span[self.terms[self.first]] = np.arange(len(self.first))
        sizes = items.starts[asked + 1] - items.starts[asked]
        entry = _runs(items.starts[asked], sizes)
        row, at, worth = np.repeat(np.arange(len(asked)), sizes), span[items.terms[entry]], items.worth[entry]
        known = (at >= 0) & (worth > 0)
        row, at, worth = row[known], at[known], worth[known]
        lengths = edges[at + 1] - edges[at]
        posting = _runs(edges[at], lengths)
        out = np.zeros(len(asked) * documents, dtype=np.int64)
        np.add.at(out, np.repeat(row * documents, lengths) + self.places[posting], np.repeat(worth, lengths) * self.each[posting])
        return out.reshape(len(asked), documents)


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers ``starts[i], starts[i] + 1, ...``, ``lengths[i]`` of them, one run after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def _numpy(lists: pa.ListArray, i: int) -> np.ndarray:
    return lists[i].values.to_numpy()


def best_chunks(index: DataFrame, items: Items, seeds: int = SEEDS) -> DataFrame:
    """``item, bound, chunk``: per item the chunks with the highest bounds."""
    def run(batches):
        best: list[list[tuple[int, int]]] = [[] for _ in items.numbers]
        for batch in batches:
            chunks, strata = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, (chunk, m) in enumerate(zip(chunks, strata)):
                bounds = _Chunk(m, _numpy(batch.column(2), i), _numpy(batch.column(3), i)).bounds(items)
                for q in np.flatnonzero(bounds):
                    own = best[q]
                    if len(own) < seeds or bounds[q] > own[-1][0]:
                        own.append((int(bounds[q]), chunk))
                        own.sort(reverse=True)
                        del own[seeds:]
        rows = [(q, bound, chunk) for q, own in enumerate(best) for bound, chunk in own]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], ["item", "bound", "chunk"])

    local = index.select("chunk", "m", "terms", "tfs").mapInArrow(run, "item long, bound long, chunk long")
    order = Window.partitionBy("item").orderBy(F.col("bound").desc(), "chunk")
    return local.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= seeds).drop("place")


def visit(index: DataFrame, items: Items, floors: np.ndarray, k: int = K, only: str | None = None) -> DataFrame:
    """``item, score, doc_id``: per task and item the ``k`` best documents among those that reach the item's floor.

    ``floors`` has a score that the item's answers reach; chunks whose bound is below it, or below the
    task's own k-th best, are not opened. ``only`` is a column with the items to visit in each chunk.
    """
    spark = index.sparkSession
    id_type = index.schema["docs"].dataType.elementType
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("score", T.LongType()), T.StructField("doc_id", id_type)])
    arrow_id = pa.int64() if id_type == T.LongType() else spark.createDataFrame([], T.StructType([T.StructField("d", id_type)])).toArrow().schema.field(0).type

    def better(row):
        return -row[0], row[1] is None, row[1] if row[1] is not None else 0

    def run(batches):
        best: list[list[tuple]] = [[] for _ in items.numbers]
        floor = np.maximum(floors, 1)

        def merge(q: int, scores: np.ndarray, docs: pa.Array) -> None:
            hits = np.flatnonzero(scores >= floor[q])
            top = hits[np.argsort(-scores[hits], kind="stable")[:k]]  # places follow the ids, so ties fall to the smaller one
            own = best[q] + list(zip(scores[top].tolist(), docs.take(pa.array(top)).to_pylist()))
            best[q] = sorted(own, key=better)[:k]
            if len(best[q]) == k:
                floor[q] = max(floor[q], best[q][-1][0])

        for batch in batches:
            for start in range(0, batch.num_rows, CHUNKS_AT_ONCE):
                part = batch.slice(start, CHUNKS_AT_ONCE)
                strata, docs = part.column(0).to_pylist(), part.column(1)
                chunks = [_Chunk(m, *(_numpy(part.column(c), i) for c in range(2, 6))) for i, m in enumerate(strata)]
                bounds = np.array([c.bounds(items) for c in chunks])
                if only:
                    asked = np.zeros(bounds.shape, dtype=bool)
                    for i, own in enumerate(part.column(6).to_pylist()):
                        asked[i, own] = True
                    bounds = np.where(asked, bounds, 0)
                for i in np.argsort(-bounds.sum(axis=1), kind="stable"):  # highest bounds first, floors rise early
                    reach = np.flatnonzero(bounds[i] >= floor)
                    for some in np.array_split(reach, -(-len(reach) // ITEMS_AT_ONCE)) if len(reach) else ():
                        found = chunks[i].scores(items, some, len(docs[i]))
                        for row in np.flatnonzero((found >= floor[some, None]).any(axis=1)):
                            merge(some[row], found[row], docs[i].values)
        rows = [(q, score, doc) for q, own in enumerate(best) for score, doc in own]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], arrow_id)], ["item", "score", "doc_id"]
        )

    return index.select("m", "docs", "terms", "tfs", "starts", "places", *([only] if only else [])).mapInArrow(run, schema)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search_block(docs: DataFrame, items: Items, k: int = K) -> DataFrame:
    """``item, rank, doc_id, score`` for one block of items; ``item`` counts the block's items with terms from 0."""
    spark = docs.sparkSession
    nothing = spark.createDataFrame([], f"item long, score long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, rank int")
    if not len(items.numbers):
        return nothing
    own = written(bags(docs, items.vocabulary), "lexical-bags")
    documents, length = own.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # one row a term of the block, whatever the documents
    frequencies = {r["term"]: r["count"] for r in own.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}
    if not frequencies:
        return nothing
    items.weigh(documents, frequencies)
    index = written(stratified_index(own, documents, length, sum(frequencies.values())), "lexical-index")
    # at most SEEDS chunks an item: their k-th best score is one that the answers reach
    seeds = best_chunks(index, items).groupBy("chunk").agg(F.collect_list("item").alias("asked"))
    first = visit(index.join(F.broadcast(seeds), "chunk"), items, np.zeros(len(items.numbers), dtype=np.int64), k, "asked")
    floors = np.zeros(len(items.numbers), dtype=np.int64)
    for r in _ranked(first, k).filter(F.col("rank") == k).collect():  # a row an item
        floors[r["item"]] = r["score"]
    return _ranked(visit(index, items, floors, k), k)


def _blocks(queries: DataFrame, most: int) -> Iterator[list]:
    """Rows in blocks of at most ``most`` bytes of text (or one row), one block at a time on the driver."""
    block, size = [], 0
    for row in queries.toLocalIterator():
        if block and size + len(row["text"]) > most:
            yield block
            block, size = [], 0
        block.append(row)
        size += len(row["text"])
    if block:
        yield block


def search(docs: DataFrame, queries: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: of every row of ``queries`` (item_id, text) the ``k`` best documents.

    Exact: the bounds leave out only chunks that cannot hold an answer. Equal scores go to the smaller
    ``doc_id``, NULL ids last. NULL and empty texts have no terms: such documents count nowhere and such
    items find nothing. Repeated rows are documents, or items, of their own. Very long texts are read
    whole. An empty table on either side gives no rows. Other columns are ignored, whatever their names.
    """
    spark: SparkSession = docs.sparkSession
    item_type, id_type = (f.schema[c].dataType.simpleString() for f, c in ((queries, "item_id"), (docs, "doc_id")))
    results = [spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id {id_type}, score long")]
    for block in _blocks(queries.select("item_id", F.encode(whole_text(), "UTF-8").alias("text")), block_bytes):
        items = Items([bytes(r["text"]) for r in block])
        ids = [(i, block[n]["item_id"]) for i, n in enumerate(items.numbers.tolist())]
        names = spark.createDataFrame(ids, f"item long, item_id {item_type}")
        found = written(search_block(docs, items, k), "lexical-found")
        results.append(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))  # names: a block of items
    return reduce(DataFrame.unionByName, results)


def op12_stratified_search(spark, sf_dir):
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH word AS (SELECT '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+' AS pattern),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), pattern) AS terms
      FROM documents, word),
s AS (SELECT count(*) AS docs, sum(len(terms))::BIGINT AS total FROM d WHERE len(terms) > 0),
p AS (SELECT doc_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM d),
tf AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM p GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(s.docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM tf, s GROUP BY term),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), pattern)) AS term
      FROM benchmark, word),
b AS (SELECT item_id, term, count(*)::BIGINT AS repeats FROM q GROUP BY ALL),
r AS (SELECT item_id, doc_id,
             sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * s.docs) // s.total))))::BIGINT AS score
      FROM b JOIN w USING (term) JOIN tf USING (term), s GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 20
"""
