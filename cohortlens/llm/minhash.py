"""MinHash near-duplicates: universal hash minima, banding, signature and full-set verification, stars.

A document is its set of distinct word shingles. Equal sets are one node, so copies cost nothing. Nodes
that agree in all minima of a band share a key. A key of two nodes is a candidate pair. In a larger key
all nodes are compared with the smallest one. If its nodes are then still in several components, those
that have too much text of their own to be linked with anything leave, and the others are compared with
the node nearest to what they share. If several components are left after that, the nodes outside the
key's largest component meet all its nodes in blocks of bounded size, where products of the sets' incidence
matrices count what each two have in common: all links count, and no group is turned into a table of pairs.
Candidate pairs are checked by their signatures and then by their full sets, blocks by the full sets alone, so
every link is exact; what banding can miss is bounded by ``miss_bound``, the signature check allows for SLACK deviations.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_intdigest, xxh64_intdigest

from .common import may_contain, membership_bitmap, sliced, table, whole_text, written
from .stars import components

WIDTH = 5
PERCENT = 85
BANDS = 28
ROWS = 5
SEED = 13
#: Standard deviations by which the share of equal minima may stay below the threshold.
SLACK = 6
#: Nodes, and shingles of all of them, that a side of a block may be expected to hold.
BLOCK_NODES = 1024
BLOCK_SHINGLES = 1 << 19
#: Shingles that are columns of the incidence matrices at the same time.
_COLUMNS = 2048
_WORDS = 1 << 19
_SHINGLES = 512


class _WordHashes(dict):
    """Hashes of words, remembered up to a fixed number."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS:
            self.clear()
        value = self[word] = xxh64_intdigest(word, SEED)
        return value


def _multipliers(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, n, dtype=np.uint64) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes, width: int, hashes: dict) -> np.ndarray:
    """The distinct shingles of a UTF-8 text as ascending 64-bit hashes."""
    words = text.lower().split()  # bytes: A-Z only, and exactly the white space x20, x09-x0D
    if not words:
        return np.zeros(0, dtype=np.uint64)
    each = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    take = min(width, len(words))  # a short text is one shingle of fewer words
    places = _multipliers(width, SEED)
    total = np.full(len(words) - take + 1, np.uint64(take), dtype=np.uint64)
    for j in range(take):
        total += each[j:j + len(total)] * places[j]
    return np.unique(_mixed(total))


def signature(own: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The minima of a*x + b (mod 2**64) over a set, as their upper 32 bits."""
    least = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(own), _SHINGLES):
        values = a[:, None] * own[None, at:at + _SHINGLES]
        values += b[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def miss_bound(percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> float:
    """Probability that a pair at the threshold meets in no band."""
    return (1 - (percent / 100) ** rows) ** bands


def least_equal(percent: int, minima: int) -> int:
    """Equal minima that a candidate must have to be read in full."""
    t = percent / 100
    return max(0, math.floor(minima * t - SLACK * math.sqrt(minima * t * (1 - t))))


def signatures(docs: DataFrame, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``row, doc_id, n, hi, lo, sig, text`` of every row: its number, set size, 128-bit digest of the set, minima, text."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    a, b = _multipliers(bands * rows, SEED + 1), _multipliers(bands * rows, SEED + 2)

    def run(batches):
        number, hashes = TaskContext.get().partitionId() << 33, _WordHashes()
        for batch in sliced(batches):
            sizes, digests, minima = [], [], []
            for text in batch.column(0).cast(pa.binary()):
                own = shingle_set(text.as_py(), width, hashes)
                sizes.append(len(own))
                digests.append(xxh3_128_intdigest(own.tobytes(), SEED))
                minima.append(signature(own, a, b).tobytes() if len(own) else None)
            halves = [np.array([d >> s & (1 << 64) - 1 for d in digests], dtype=np.uint64).view(np.int64) for s in (64, 0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(number, number + len(sizes)), pa.int64()), batch.column(1), pa.array(sizes, pa.int64()),
                 *map(pa.array, halves), pa.array(minima, pa.binary()), batch.column(0)],
                ["row", "doc_id", "n", "hi", "lo", "sig", "text"],
            )
            number += len(sizes)

    schema = spark.createDataFrame([], f"row long, doc_id {kind}, n long, hi long, lo long, sig binary, text string").schema
    return docs.select(whole_text().alias("text"), "doc_id").mapInArrow(run, schema)


def band_keys(nodes: DataFrame, bands: int, rows: int) -> DataFrame:
    """``key, node``: one key per band, equal where all minima of the band are."""
    places, number = _multipliers(rows, SEED + 3), _multipliers(bands, SEED + 4)

    def run(batches):
        for batch in batches:
            minima = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint32).reshape(-1, bands, rows)
            keys = _mixed((minima.astype(np.uint64) * places).sum(axis=2, dtype=np.uint64) + number)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(batch.column(0).to_numpy(), bands))], ["key", "node"])

    return nodes.select("node", "sig").mapInArrow(run, "key long, node long")


def ends(pairs: DataFrame) -> DataFrame:
    """``node``: the nodes of the pairs (a, b), once each."""
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def alike(pairs: DataFrame, nodes: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) of nodes with at least ``least`` equal minima."""
    def run(batches):
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint32).reshape(batch.num_rows, -1) for c in (2, 3))
            yield batch.select(["a", "b"]).filter(pa.array((left == right).sum(axis=1) >= least))

    # signatures of nodes without a pair are not shuffled
    hashes = pairs.select(F.xxhash64("a").alias("_h")).unionByName(pairs.select(F.xxhash64("b").alias("_h")))
    maybe = may_contain(nodes.withColumn("_h", F.xxhash64("node")), "_h", membership_bitmap(hashes, "_h"), "_maybe").filter("_maybe")
    with_sigs = pairs.join(maybe.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b").join(
        maybe.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a"
    )
    return with_sigs.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def shingle_sets(rows: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``node, own``: the full sets of the rows whose number is a ``node`` of ``wanted``."""
    def run(batches):
        hashes = _WordHashes()
        for batch in sliced(batches):
            own = [shingle_set(t.as_py(), width, hashes).view(np.int64) for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.list_(pa.int64()))], ["node", "own"])

    texts = rows.select(F.col("row").alias("node"), "text").withColumn("_h", F.xxhash64("node"))
    # texts of other rows are not shuffled
    maybe = may_contain(texts, "_h", membership_bitmap(wanted.select(F.xxhash64("node").alias("_h")), "_h"), "_maybe").filter("_maybe")
    return maybe.select("node", "text").join(wanted.select("node"), "node", "left_semi").mapInArrow(run, "node long, own array<bigint>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets, all in ``sets``, are at least ``percent`` alike."""
    both = pairs.join(sets.select(F.col("node").alias("b"), F.col("own").alias("own_b")), "b").join(
        sets.select(F.col("node").alias("a"), F.col("own").alias("own_a")), "a"
    )
    shared = both.select("a", "b", F.size(F.array_intersect("own_a", "own_b")).cast("long").alias("shared"), (F.size("own_a") + F.size("own_b")).cast("long").alias("sizes"))
    return shared.filter(F.col("shared") * 100 >= percent * (F.col("sizes") - F.col("shared"))).select("a", "b")


def shared_sizes(sets: DataFrame) -> DataFrame:
    """``node, n, shared``: set sizes, and how many of a node's shingles another node of ``sets`` has too."""
    alone = sets.select("node", F.explode("own").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("times"), F.min("node").alias("node")).filter("times = 1")
    own = alone.groupBy("node").agg(F.count(F.lit(1)).alias("alone"))
    sized = sets.select("node", F.size("own").cast("long").alias("n")).join(own, "node", "left")
    return sized.select("node", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("shared"))


def common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of ``left`` has in common with each of ``right``."""
    counts = np.zeros((len(left), len(right)), dtype=np.int64)
    values = [np.concatenate(side) for side in (left, right)]
    places = [np.repeat(np.arange(len(side)), [len(own) for own in side]) for side in (left, right)]
    both = np.intersect1d(*values)
    kept = [np.isin(v, both) for v in values]
    columns = [np.searchsorted(both, v[k]) for v, k in zip(values, kept)]
    places = [p[k] for p, k in zip(places, kept)]
    for at in range(0, len(both), _COLUMNS):
        ones = []
        for side, column, place in zip((left, right), columns, places):
            here = (column >= at) & (column < at + _COLUMNS)
            ones.append(np.zeros((len(side), min(_COLUMNS, len(both) - at)), dtype=np.float32))
            ones[-1][place[here], column[here] - at] = 1
        counts += (ones[0] @ ones[1].T).astype(np.int64)
    return counts


def block_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join the components of each key; ``members`` has ``key, node, component, n``.

    In each key the nodes outside its largest component (the left side) are compared with all its nodes (the right
    side). Both sides are dealt into blocks by a hash, and each left block meets each right one in a task, so no task
    holds a key whole. Of the links of a node with a component one is returned.
    """
    sizes = members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("total"))
    blocks = lambda size, total: F.ceil(F.greatest(size / BLOCK_NODES, total / BLOCK_SHINGLES, F.lit(1)))
    keys = sizes.groupBy("key").agg(F.max(F.struct("size", "component", "total")).alias("main"), F.sum("size").alias("size"), F.sum("total").alias("total"))
    keys = keys.select(
        "key", F.col("main.component").alias("main"), blocks(F.col("size"), F.col("total")).alias("n_right"),
        blocks(F.col("size") - F.col("main.size"), F.col("total") - F.col("main.total")).alias("n_left"),
    )
    unit = F.pmod(F.xxhash64("node"), F.lit(1 << 31)) / float(1 << 31)
    dealt = members.join(keys, "key").select(
        "key", "node", "component", (F.col("component") != F.col("main")).alias("asked"), "n_left", "n_right",
        F.floor(F.col("n_left") * unit).alias("in_left"), F.floor(F.col("n_right") * unit).alias("in_right"),
    ).join(sets.select("node", "own"), "node")
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = dealt.filter("asked").select("key", "node", "component", "own", F.lit(True).alias("left"), F.col("in_left").alias("i"), each("n_right").alias("j"))
    right = dealt.select("key", "node", "component", "own", F.lit(False).alias("left"), each("n_left").alias("i"), F.col("in_right").alias("j"))

    def run(block: pa.Table) -> pa.Table:
        is_left = block.column("left").to_numpy()
        node, component = block.column("node").to_numpy(), block.column("component").to_numpy()
        own = block.column("own").combine_chunks()
        values, at = own.values.to_numpy(), own.offsets.to_numpy()
        a, b = np.flatnonzero(is_left), np.flatnonzero(~is_left)
        n, found = np.diff(at), ([], [])
        if len(a) and len(b):
            shared = common([values[at[x]:at[x + 1]] for x in a], [values[at[x]:at[x + 1]] for x in b])
            linked = (shared * 100 >= percent * (n[a][:, None] + n[b] - shared)) & (component[a][:, None] != component[b])
            x, y = np.nonzero(linked)
            _, once = np.unique(np.stack([x, component[b][y]]), axis=1, return_index=True)
            found = (node[a][x[once]], node[b][y[once]])
        return pa.table({"a": pa.array(found[0], pa.int64()), "b": pa.array(found[1], pa.int64())})

    return left.unionByName(right).groupBy("key", "i", "j").applyInArrow(run, "a long, b long")


def node_components(rows: DataFrame, nodes: DataFrame, percent: int, width: int, bands: int, rows_: int) -> DataFrame:
    """``node, component`` of every node that has a link."""
    least = least_equal(percent, bands * rows_)

    def candidates(pairs: DataFrame) -> DataFrame:
        ordered = pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        return written(alike(written(ordered, "minhash-pairs"), nodes, least), "minhash-alike")

    def sets_of(wanted: DataFrame) -> DataFrame:
        return written(shingle_sets(rows, wanted, width), "minhash-sets")

    def joined(found: DataFrame, links: DataFrame) -> DataFrame:
        links = written(links, "minhash-links")
        return found if links.isEmpty() else components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links))

    def unsettled(members: DataFrame) -> DataFrame:
        """The members of keys whose nodes are in several components."""
        named = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        split = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("key")
        return written(named.join(split, "key"), "minhash-open")

    keys = band_keys(nodes, bands, rows_)
    met = written(keys.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("a"), F.max("node").alias("b")).filter("size > 1"), "minhash-keys")
    crowded = written(keys.join(met.filter("size > 2").select("key", F.col("a").alias("first")), "key"), "minhash-crowded")
    near = candidates(met.filter("size = 2").select("a", "b").unionByName(crowded.select(F.col("first").alias("a"), F.col("node").alias("b"))))
    found = components(written(confirmed(near, sets_of(ends(near)), percent), "minhash-links"))
    members = unsettled(crowded).drop("component")
    if members.isEmpty():
        return found
    # Two sets have at most the smaller of their ``shared`` shingles in common. That settles most nodes of a family
    # that are linked with nothing: too much of their text is theirs alone.
    in_reach = lambda shared, sizes: shared * 100 >= percent * (sizes - shared)
    sets = sets_of(members.select("node").distinct())
    members = written(members.join(shared_sizes(sets), "node"), "minhash-open")
    smallest = members.groupBy("key").agg(F.min("n").alias("n_least"))
    members = members.join(smallest, "key").filter(in_reach(F.col("shared"), F.col("n") + F.col("n_least")))
    members = written(members.filter("node <> first").select("key", "node", "n", "shared"), "minhash-open")
    # The node with the largest shared part is near the text that a family has in common: it is compared with all.
    open_ = unsettled(members)
    share = F.struct((F.col("shared") / F.col("n")).alias("share"), *[F.col(c) for c in ("node", "component", "n", "shared")])
    heads = open_.groupBy("key").agg(F.max(share).alias("head"))
    possible = (F.col("component") != F.col("head.component")) & in_reach(F.least("shared", "head.shared"), F.col("n") + F.col("head.n"))
    near = candidates(open_.join(heads, "key").filter(possible).select(F.col("head.node").alias("a"), F.col("node").alias("b")))
    found = joined(found, confirmed(near, sets, percent))
    return joined(found, block_links(unsettled(members).select("key", "node", "component", "n"), sets, percent))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row.

    Two documents are linked if their sets of ``width``-word shingles (ASCII lower case) have a Jaccard
    share of at least ``percent``; ``component_id`` is the smallest ``doc_id`` reachable over links. A text
    with fewer words is one shingle. NULL texts and texts without words have the empty set, are linked with
    nothing and are components of their own. Rows that repeat a ``doc_id`` are rows of their own. NULL ids
    are ignored by the minimum; a component of such rows alone has a NULL id and all its rows are kept.
    Very long texts are read whole. An empty table gives no rows. Other columns are ignored, whatever their names.
    """
    own = written(signatures(docs, width, bands, rows), "minhash-rows")
    # Written, so that later joins deal them anew and adaptive execution can split hot sets.
    groups = written(own.filter("n > 0").groupBy("hi", "lo").agg(F.min("row").alias("node"), F.min("doc_id").alias("first_id")), "minhash-groups")
    nodes = written(own.select(F.col("row").alias("node"), "sig").join(groups.select("node"), "node", "left_semi"), "minhash-nodes")
    found = node_components(own, nodes, percent, width, bands, rows)
    named = written(groups.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")), "minhash-named")
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_set = written(named.join(smallest, "component").select("hi", "lo", "component_id"), "minhash-components")
    narrow = own.select("doc_id", "n", "hi", "lo")
    out = narrow.filter("n > 0").join(by_set, ["hi", "lo"]).unionByName(narrow.filter("n = 0").withColumn("component_id", F.col("doc_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op13_minhash_stars(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
