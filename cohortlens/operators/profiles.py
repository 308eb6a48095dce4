"""Tables behind the reference's figures (X1-X18); drawing itself is not built."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import resolved
from .classify import score_groups, uniform_edges, bin_index, valid_pairs
from .quantile import grouped_quantiles
from .rank import rank_within, with_running_sums
from .segment import allocation_table, cluster_lift_table, segmentation_table

CHANNELS = ["NumWebPurchases", "NumCatalogPurchases", "NumStorePurchases"]


def cluster_centers(df: DataFrame, features, cluster: str = "cluster") -> DataFrame:
    """Mean of every feature per cluster (long: cluster, feature, mean)."""
    agg = df.groupBy(cluster).agg(*[F.avg(F.col(f"`{f}`")).alias(f"m{i}") for i, f in enumerate(features)])
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"m{i}").alias("mean")) for i, f in enumerate(features)])
    return agg.select(cluster, F.explode(pairs).alias("p")).select(cluster, "p.feature", "p.mean")


def curve_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Per distinct threshold (high to low) TPR, FPR, precision, recall."""
    g = with_running_sums(score_groups(df, label, score, eps=0.0), [("s", False)], ["pos", "neg"])
    tot = g.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    j = g.crossJoin(F.broadcast(tot))  # one-row total
    return j.select(
        F.col("s").alias("threshold"),
        F.when(F.col("P") > 0, F.col("cum_pos") / F.col("P")).alias("tpr"),
        F.when(F.col("N") > 0, F.col("cum_neg") / F.col("N")).alias("fpr"),
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        F.when(F.col("P") > 0, F.col("cum_pos") / F.col("P")).alias("recall"),
    )


def reliability_table(df: DataFrame, label: str = "label", score: str = "score", n_bins: int = 10) -> DataFrame:
    """Right-closed uniform bins: fraction positive and mean score per non-empty bin."""
    v = valid_pairs(df, label, score)
    edges = uniform_edges(n_bins)[1:-1]
    b = v.select(bin_index(F.col("p"), edges, right_closed=True).alias("bin"), "p", (F.col("y") > 0).cast("double").alias("y"))
    return b.groupBy("bin").agg(F.count(F.lit(1)).alias("count"), F.avg("y").alias("frac_pos"), F.avg("p").alias("mean_score"))


def histogram(df: DataFrame, col: str, n_bins: int = 30, lo=None, hi=None) -> DataFrame:
    """Equal-width bins over [lo, hi] (data min/max when not given), last bin closed."""
    c = F.col(col)
    rng = df.agg(F.min(c).alias("lo"), F.max(c).alias("hi"), F.avg(c).alias("mean"))
    if lo is not None:
        rng = rng.withColumn("lo", F.lit(float(lo)))
    if hi is not None:
        rng = rng.withColumn("hi", F.lit(float(hi)))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(n_bins))
    raw = F.when(width > 0, F.floor((c - F.col("lo")) / width)).otherwise(0)
    b = F.least(F.greatest(raw, F.lit(0)), F.lit(n_bins - 1)).cast("int")
    return (
        df.select(c).crossJoin(F.broadcast(rng))  # one-row range
        .select(b.alias("bin"), "lo", "hi", "mean")
        .groupBy("bin", "lo", "hi", "mean")
        .agg(F.count(F.lit(1)).alias("count"))
        .select("bin", (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / n_bins).alias("left"), "count", "mean")
    )


def rfm_boxstats(df: DataFrame, features, cluster: str = "cluster", aliases: dict | None = None) -> DataFrame:
    """Quartiles and 1.5 IQR whiskers per cluster and feature (outliers hidden); ``aliases`` as in :func:`channel_mix`."""
    df = resolved(df, features, aliases)
    found = grouped_quantiles(df.filter(F.col(cluster).isNotNull()), [cluster], {f: F.col(f) for f in features}, (0.25, 0.5, 0.75))
    rows = [(key[0], f, q) for key, of in found.items() for f, q in of.items() if q]
    long = df.select(cluster, F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in features])).alias("p")).select(
        cluster, "p.feature", "p.v"
    ).filter(F.col("v").isNotNull())
    q = df.sparkSession.createDataFrame(rows, f"{cluster} {dict(long.dtypes)[cluster]}, feature string, q array<double>")
    j = long.join(F.broadcast(q), [cluster, "feature"])  # one row a segment and feature
    iqr = F.col("q")[2] - F.col("q")[0]
    lo_b, hi_b = F.col("q")[0] - 1.5 * iqr, F.col("q")[2] + 1.5 * iqr
    return j.groupBy(cluster, "feature", "q").agg(
        F.min(F.when(F.col("v") >= lo_b, F.col("v"))).alias("whisker_lo"),
        F.max(F.when(F.col("v") <= hi_b, F.col("v"))).alias("whisker_hi"),
    ).select(cluster, "feature", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"), "whisker_lo", "whisker_hi")


def channel_mix(df: DataFrame, cluster: str = "cluster", channels=CHANNELS, aliases: dict | None = None) -> DataFrame:
    """Mean purchases per channel, normalised to shares per cluster (missing -> 0).

    Channels may have other letter cases or the names that ``aliases`` lists for them.
    """
    df = resolved(df, channels, aliases)
    means = df.groupBy(cluster).agg(*[F.avg(F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(c) for c in channels])
    tot = sum((F.col(c) for c in channels[1:]), F.col(channels[0]))
    return means.select(cluster, *[F.coalesce(F.try_divide(F.col(c), F.nullif(tot, F.lit(0.0))), F.lit(0.0)).alias(c) for c in channels])


def size_and_response(clusters: DataFrame, labelled: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    """Full outer join of sizes and response rates; missing size -> 0."""
    sizes = clusters.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"))
    rates = labelled.filter(F.col(label).isNotNull()).groupBy(cluster).agg(F.avg(F.col(label).cast("double")).alias("response_rate"))
    return sizes.join(rates, cluster, "full_outer").select(cluster, F.coalesce("size", F.lit(0)).alias("size"), "response_rate")


def density_grid(df: DataFrame, x: str, y: str, cluster: str = "cluster", grid: int = 35, min_count: int = 1) -> DataFrame:
    """X15 (re-aimed from hexagons): square grid counts per cluster over the data range."""
    v = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    rng = v.agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"))

    def cell(c, lo, hi):
        w = (F.col(hi) - F.col(lo)) / F.lit(float(grid))
        return F.least(F.greatest(F.when(w > 0, F.floor((F.col(c) - F.col(lo)) / w)).otherwise(0), F.lit(0)), F.lit(grid - 1)).cast("int")

    return (
        v.crossJoin(F.broadcast(rng))  # one-row range
        .select(cluster, cell(x, "x0", "x1").alias("gx"), cell(y, "y0", "y1").alias("gy"))
        .groupBy(cluster, "gx", "gy")
        .agg(F.count(F.lit(1)).alias("count"))
        .filter(F.col("count") >= min_count)
    )


def cluster_lift_bars(df: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    """B6 on the binarised label."""
    return cluster_lift_table(df.withColumn("_yb", (F.col(label) > 0).cast("int")), cluster, "_yb")


def budget_allocation_curve(df: DataFrame, fractions, cluster: str = "cluster", label: str = "label") -> DataFrame:
    """B7 at several budgets (clamped to [1, n]); expected precision and lift."""
    t = segmentation_table(df, cluster, label)
    spark = df.sparkSession
    fr = spark.createDataFrame([(float(f),) for f in fractions], "budget_frac double")
    tot = t.agg(F.sum("size").alias("n"), F.sum("positives").alias("p"))
    base = fr.crossJoin(F.broadcast(tot)).withColumn(
        "n_selected", F.least(F.greatest(F.ceil(F.col("budget_frac") * F.col("n")), F.lit(1)), F.col("n")).cast("bigint")
    )
    grid = base.crossJoin(F.broadcast(t))  # fractions x K clusters: both bounded by their definition
    w = Window.partitionBy("budget_frac").orderBy(F.col("response_rate").desc(), F.col(cluster).asc()).rowsBetween(Window.unboundedPreceding, -1)
    prev = F.coalesce(F.sum("size").over(w), F.lit(0))
    alloc = grid.withColumn("take", F.least(F.col("size"), F.greatest(F.lit(0), F.col("n_selected") - prev)))
    g = F.col("p") / F.col("n")
    return alloc.groupBy("budget_frac", "n", "p", "n_selected").agg(F.sum(F.col("take") * F.col("response_rate")).alias("expected")).select(
        "budget_frac", "n_selected", (F.col("expected") / F.col("n_selected")).alias("expected_precision"),
        F.when(g > 0, F.col("expected") / F.col("n_selected") / g).alias("lift"),
    )


def md5_sample_per_cluster(df: DataFrame, m: int, cluster: str = "cluster", key: str = "customer_id", seed: int = 42) -> DataFrame:
    """X11: at most ``m`` rows per cluster, chosen by md5 order (two-level rank, no hot task)."""
    h = F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))
    r = rank_within(df.withColumn("_h", h), cluster, [("_h", True), (key, True)], "rn")
    return r.filter(F.col("rn") <= m).drop("_h")


def pca_scatter(df: DataFrame, x: str = "xb", k: int = 2) -> tuple:
    """Centred 2-component PCA (MLlib), signs fixed by the largest loading; (points, explained variance)."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array
    import numpy as np

    d = df.select(F.size(x)).first()[0]
    means = df.agg(*[F.avg(F.col(x)[j]).alias(f"m{j}") for j in range(d)]).first()
    mu = F.array(*[F.lit(float(means[f"m{j}"])) for j in range(d)])
    centred = df.withColumn("_c", array_to_vector(F.zip_with(F.col(x), mu, lambda a, b: a - b)))
    model = PCA(k=k, inputCol="_c", outputCol="_p").fit(centred)
    pc = model.pc.toArray()
    signs = np.sign(pc[np.abs(pc).argmax(0), range(k)])
    signs[signs == 0] = 1
    pts = model.transform(centred).withColumn("_a", vector_to_array("_p"))
    pts = pts.select("*", *[(F.col("_a")[i] * F.lit(float(signs[i]))).alias(f"pc{i + 1}") for i in range(k)]).drop("_c", "_p", "_a")
    return pts, [float(v) for v in model.explainedVariance.toArray()]
