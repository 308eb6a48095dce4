"""Mixing sources to target weights by Poisson replication.

Each source gets a repetition rate: its target share of the mixture over its share of the rows. Each
document draws how often it occurs from a Poisson distribution of that mean, by inverting the
distribution at a number hashed from seed and id. So a draw needs no state, is the same after a retry
and for a document alone, and no source is cut: a rate of 0.3 keeps each document with probability
0.26, a rate of 7 repeats it about seven times. Copies are dealt to partitions and ordered by a hash,
which is the global shuffle; its keys are uniform whatever the sources are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sheltered, table, written

SEED = 20240607
#: Without targets a source weighs its rows to this power: 1 keeps the shares, 0 makes all sources equal.
SIZE_POWER = 0.5
#: A larger rate is drawn as a sum of parts of at most this mean, so that exp(-rate) never underflows.
PART_MEAN = 32.0
#: Entries of an inverted distribution; the tail beyond them at mean 32 is below 1e-26.
DISTRIBUTION = 128
#: Column of ``draws`` with what a row is hashed by.
NAME = "_mixing_name"
#: Columns that a mixture has besides those of its documents.
ADDED = ("rate", "copies", "copy", "shuffle_key")
#: Rate tables up to this many sources (1 KB each, so 8 MB) are broadcast, larger ones are joined by a shuffle.
BROADCAST_SOURCES = 8000


def source_rates(docs: DataFrame, targets: DataFrame | None = None, size_power: float = SIZE_POWER, epochs: float = 1.0) -> DataFrame:
    """``source, n, rate, parts, cdf``: one row a source, NULL being a source of its own.

    ``targets`` has (source, weight) with weights of 0 or more; sources that it lacks get weight 0.
    ``epochs`` is the expected size of the mixture in multiples of the rows of ``docs``.
    """
    sizes = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    if targets is None:
        weighed = sizes.withColumn("weight", F.pow("n", F.lit(float(size_power))))
    else:
        named = targets.groupBy(F.col("source").alias("_s")).agg(F.sum("weight").cast("double").alias("weight"))
        weighed = sizes.join(named, sizes["source"].eqNullSafe(named["_s"]), "left").select("source", "n", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    weighed = written(weighed, "mixing-weights")
    total = weighed.agg(F.sum("n").alias("rows"), F.sum("weight").alias("weights"))
    rate = F.when(F.col("weights") > 0, F.col("weight") / F.col("weights") * F.col("rows") * float(epochs) / F.col("n")).otherwise(0.0)
    parts = F.ceil(F.col("rate") / PART_MEAN).cast("int")
    rates = weighed.crossJoin(F.broadcast(total)).select("source", "n", rate.alias("rate"))  # total: one row
    mean = F.col("rate") / F.greatest("parts", F.lit(1))
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(DISTRIBUTION - 1)),
        F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("cdf")),
        lambda acc, k: F.struct(
            (acc["p"] * mean / k).alias("p"),
            F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + acc["p"] * mean / k)).alias("cdf"),
        ),
        lambda acc: acc["cdf"],
    )
    return rates.withColumn("parts", parts).withColumn("cdf", terms)


def uniform(*key: Column) -> Column:
    """A number in [0, 1) of 52 bits, hashed from ``key``."""
    digest = F.md5(F.concat_ws(":", *key))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def row_name() -> Column:
    """What a row is hashed by: its id, or its place in the table if it has none."""
    return F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("row "), F.monotonically_increasing_id().cast("string")))


def draws(docs: DataFrame, rates: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` with ``rate`` and ``copies``, the Poisson draw of each row.

    Rows that repeat an id draw the same number. Rows without an id draw each for itself, by their place
    in ``docs`` (which must then be read from files, so that a retried task finds the same places).
    """
    docs = docs.withColumn(NAME, row_name())
    rates = written(rates.select(F.col("source").alias("_source"), F.col("rate").alias("_rate"), F.col("parts").alias("_parts"), F.col("cdf").alias("_cdf")), "mixing-rates")
    small = rates.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    joined = docs.join(F.broadcast(rates) if small else rates, docs["source"].eqNullSafe(F.col("_source")))
    one_part = lambda i: F.size(F.filter("_cdf", lambda c: c <= uniform(F.lit(str(seed)), F.col(NAME), i.cast("string"))))
    copies = F.when(F.col("_parts") > 0, F.aggregate(F.sequence(F.lit(1), F.greatest("_parts", F.lit(1))), F.lit(0), lambda n, i: n + one_part(i))).otherwise(0)
    return joined.select(*[docs[c] for c in docs.columns], F.col("_rate").alias("rate"), copies.alias("copies"))


def mixture(docs: DataFrame, targets: DataFrame | None = None, size_power: float = SIZE_POWER, epochs: float = 1.0, seed: int = SEED) -> DataFrame:
    """Every copy as a row: the columns of ``docs`` and ``rate, copies, copy, shuffle_key``.

    Partition by partition, rows are in the order of ``shuffle_key`` (hex of a hash of seed, id and
    copy), which is a random order of the whole mixture. Documents that draw 0 are absent; an empty
    table gives an empty mixture. The four columns replace columns of ``docs`` of these names;
    ``replicated`` gives the documents as they are.
    """
    rows, back = _copies(docs, targets, size_power, epochs, seed)
    return rows.select(*[b for c, b in zip(docs.columns, back) if c not in ADDED], *ADDED)


def replicated(docs: DataFrame, targets: DataFrame | None = None, size_power: float = SIZE_POWER, epochs: float = 1.0, seed: int = SEED) -> DataFrame:
    """The rows of ``mixture`` in its order, with the columns of ``docs`` alone, whatever they are called."""
    rows, back = _copies(docs, targets, size_power, epochs, seed)
    return rows.select(*back)


def _copies(docs, targets, size_power, epochs, seed):
    docs, back = sheltered(docs, "doc_id", "source")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    drawn = draws(docs, source_rates(docs, targets, size_power, epochs), seed).filter("copies > 0")
    rows = drawn.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    key = F.md5(F.concat_ws(":", F.lit(f"{seed}:shuffle"), F.col(NAME), F.col("copy").cast("string")))
    place = (F.conv(F.substring("shuffle_key", 1, 8), 16, 10).cast("long") * n / float(1 << 32)).cast("int")
    return rows.withColumn("shuffle_key", key).repartitionById(n, place).sortWithinPartitions("shuffle_key"), back


def op3_mix_poisson(spark, sf_dir):
    return mixture(table(spark, sf_dir, "documents")).withColumn("rate", F.round("rate", 9))


ORACLE = f"""
WITH sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (SELECT source, n, pow(n, {SIZE_POWER}) / (SELECT sum(pow(n, {SIZE_POWER})) FROM sizes) * (SELECT sum(n) FROM sizes) / n AS rate FROM sizes),
parted AS (SELECT source, rate, CAST(ceil(rate / {PART_MEAN}) AS INT) AS parts FROM rates),
terms AS (SELECT source, k, sum(exp(-rate / parts + k * ln(rate / parts) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS cdf
          FROM parted, range(0, {DISTRIBUTION}) AS r(k)),
distributions AS (SELECT source, list(cdf ORDER BY k) AS cdf FROM terms GROUP BY source),
numbers AS (SELECT d.*, p.rate, c.cdf, CAST('0x' || substr(md5('{SEED}:' || d.doc_id || ':' || i), 1, 13) AS BIGINT) / 4503599627370496.0 AS u
            FROM documents d JOIN parted p ON d.source IS NOT DISTINCT FROM p.source
            JOIN distributions c ON d.source IS NOT DISTINCT FROM c.source, range(1, p.parts + 1) AS t(i)),
drawn AS (SELECT doc_id, text, lang, source, n_chars, rate, CAST(sum(len(list_filter(cdf, lambda c: c <= u))) AS INT) AS copies
          FROM numbers GROUP BY ALL),
copied AS (SELECT *, unnest(range(1, copies + 1)) AS copy FROM drawn WHERE copies > 0)
SELECT doc_id, text, lang, source, n_chars, round(rate, 9) AS rate, copies, CAST(copy AS INT) AS copy,
       md5('{SEED}:shuffle:' || doc_id || ':' || copy) AS shuffle_key
FROM copied
"""
