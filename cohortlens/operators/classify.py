"""Classification, calibration and threshold metrics (K1-K8).

Label/score pairs with a NULL, NaN or infinite member are dropped first. All
metrics are aggregates; the curve-type ones (AUC, AP) collapse rows to one row
per distinct score (partial aggregation) and take running sums along the score
order with :mod:`rank` (no single-task window).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import finite
from .quantile import exact_quantiles
from .rank import rank_within, with_running_sums
from .soft import bound

PROB_EPS = 1e-15
ECE_EPS = 1e-12


def valid_pairs(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    y = F.col(label).cast("double")
    s = F.col(score).cast("double")
    return df.filter(finite(y) & finite(s)).select(
        *[c for c in df.columns if c not in (label, score)], y.alias("y"), s.alias("p")
    )


def confusion_counts(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    y = F.col(label).cast("int")
    p = F.col(pred).cast("int")
    return df.agg(
        F.count(F.when((y == 1) & (p == 1), 1)).alias("tp"),
        F.count(F.when((y == 0) & (p == 1), 1)).alias("fp"),
        F.count(F.when((y == 0) & (p == 0), 1)).alias("tn"),
        F.count(F.when((y == 1) & (p == 0), 1)).alias("fn"),
    )


def _rates_from_counts(tp, fp, tn, fn):
    n = tp + fp + tn + fn
    precision = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
    recall = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
    f1 = F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(0.0)
    spec = F.when(tn + fp > 0, tn / (tn + fp)).otherwise(0.0)
    return {
        "accuracy": F.when(n > 0, (tp + tn) / n),
        "precision": precision,
        "recall": recall,
        "f1": f1,
        "specificity": spec,
        "balanced_accuracy": F.lit(0.5) * (recall + spec),
        "support_pos": (tp + fn).cast("double"),
        "support_neg": (tn + fp).cast("double"),
    }


def classification_metrics(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """K1: accuracy, precision, recall, F1, specificity, balanced accuracy, supports."""
    c = confusion_counts(df, label, pred)
    cols = _rates_from_counts(F.col("tp"), F.col("fp"), F.col("tn"), F.col("fn"))
    return c.select(*[v.alias(k) for k, v in cols.items()])


def score_groups(df: DataFrame, label: str = "label", score: str = "score", eps: float = PROB_EPS) -> DataFrame:
    """One row per distinct (clipped) score with positive and negative counts."""
    v = valid_pairs(df, label, score)
    p = F.least(F.greatest(F.col("p"), F.lit(eps)), F.lit(1.0 - eps))
    return v.groupBy(p.alias("s")).agg(
        F.count(F.when(F.col("y") > 0, 1)).alias("pos"), F.count(F.when(F.col("y") <= 0, 1)).alias("neg")
    )


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """K2: pairwise (Mann-Whitney) AUC with half credit for ties; NULL for one class."""
    g = with_running_sums(score_groups(df, label, score), [("s", True)], ["neg"])
    return g.agg(
        F.sum("pos").alias("P"),
        F.sum("neg").alias("N"),
        F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.lit(0.5) * F.col("neg"))).alias("_u"),
    ).select(F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("_u") / (F.col("P") * F.col("N"))).alias("auc"))


def average_precision(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """K3: step-wise ``sum((R_i - R_{i-1}) * P_i)`` over distinct thresholds, high to low."""
    g = with_running_sums(score_groups(df, label, score), [("s", False)], ["pos", "neg"])
    totals = g.agg(F.sum("pos").alias("P"))
    return (
        g.crossJoin(F.broadcast(totals))  # one-row total
        .agg(
            F.first("P").alias("P"),
            F.sum(F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("_ap"),
        )
        .select(F.when(F.col("P") > 0, F.col("_ap") / F.col("P")).alias("average_precision"))
    )


def curve_metrics(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """K2 + K3 from one running-sum pass over the distinct scores (ascending).

    Descending cumulative counts follow from the totals: ``desc = total - asc + own``.
    """
    g = with_running_sums(score_groups(df, label, score), [("s", True)], ["pos", "neg"])
    tot = g.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    j = g.crossJoin(F.broadcast(tot))  # one-row total
    dpos = F.col("P") - F.col("cum_pos") + F.col("pos")
    dneg = F.col("N") - F.col("cum_neg") + F.col("neg")
    return j.agg(
        F.first("P").alias("P"),
        F.first("N").alias("N"),
        F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.lit(0.5) * F.col("neg"))).alias("_u"),
        F.sum(F.col("pos") * dpos / (dpos + dneg)).alias("_ap"),
    ).select(
        F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("_u") / (F.col("P") * F.col("N"))).alias("auc"),
        F.when(F.col("P") > 0, F.col("_ap") / F.col("P")).alias("average_precision"),
    )


def log_loss_brier(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """K4: mean log loss and Brier score on probabilities clipped to [1e-15, 1-1e-15]."""
    v = valid_pairs(df, label, score)
    p = F.least(F.greatest(F.col("p"), F.lit(PROB_EPS)), F.lit(1.0 - PROB_EPS))
    y = F.col("y")
    return v.agg(
        F.avg(-(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))).alias("log_loss"),
        F.avg(F.pow(p - y, 2)).alias("brier"),
    )


def uniform_edges(n_bins: int = 10) -> list[float]:
    return [float(x) for x in np.linspace(0.0, 1.0, int(max(2, n_bins)) + 1)]


def bin_index(p, inner_edges, right_closed: bool = False):
    """Number of inner edges <= p (left-closed bins) or < p (right-closed bins)."""
    if not inner_edges:
        return F.lit(0)
    edges = F.array(*[F.lit(float(e)) for e in inner_edges])
    # bound: Spark puts the expression behind ``p`` into the lambda, where it would be computed once an edge
    return bound(p, lambda v: F.size(F.filter(edges, lambda e: (v > e) if right_closed else (v >= e))))


def quantile_edges(df: DataFrame, n_bins: int, label: str = "label", score: str = "score") -> list[float]:
    """Quantile bin edges of the clipped scores; falls back to uniform on duplicates."""
    n_bins = int(max(2, n_bins))
    qs = [float(x) for x in np.linspace(0.0, 1.0, n_bins + 1)]
    v = valid_pairs(df, label, score)
    p = F.least(F.greatest(F.col("p"), F.lit(ECE_EPS)), F.lit(1.0 - ECE_EPS))
    edges = exact_quantiles(v, {"p": p}, qs)["p"]
    if edges is None:
        return uniform_edges(n_bins)
    edges[0], edges[-1] = 0.0, 1.0
    if len(set(edges)) < len(edges):
        return uniform_edges(n_bins)
    return edges


def calibration_bins(
    df: DataFrame, label: str = "label", score: str = "score", n_bins: int = 10, strategy: str = "uniform"
) -> DataFrame:
    """K5 details: bin, count, weight, conf, acc, gap per non-empty bin."""
    if strategy == "uniform":
        edges = uniform_edges(n_bins)
    elif strategy == "quantile":
        edges = quantile_edges(df, n_bins, label, score)
    else:
        raise ValueError(f"strategy is {strategy!r}; use 'uniform' or 'quantile'")
    v = valid_pairs(df, label, score)
    p = F.least(F.greatest(F.col("p"), F.lit(ECE_EPS)), F.lit(1.0 - ECE_EPS))
    y = (F.col("y") > 0).cast("double")
    b = v.select(bin_index(p, edges[1:-1]).alias("bin"), p.alias("p"), y.alias("y"))
    n = b.agg(F.count(F.lit(1)).alias("_n"))
    return (
        b.groupBy("bin")
        .agg(F.count(F.lit(1)).alias("count"), F.avg("p").alias("conf"), F.avg("y").alias("acc"))
        .crossJoin(F.broadcast(n))  # one-row total
        .select(
            "bin",
            "count",
            (F.col("count") / F.col("_n")).alias("weight"),
            "conf",
            "acc",
            F.abs(F.col("acc") - F.col("conf")).alias("gap"),
        )
    )


def expected_calibration_error(
    df: DataFrame, label: str = "label", score: str = "score", n_bins: int = 10, strategy: str = "uniform"
) -> DataFrame:
    """K5: ECE (weighted mean gap) and MCE (largest gap) in one row."""
    bins = calibration_bins(df, label, score, n_bins, strategy)
    return bins.agg(F.sum(F.col("weight") * F.col("gap")).alias("ece"), F.max("gap").alias("mce"))


def threshold_grid(grid=None, grid_size: int = 101) -> list[float]:
    if grid is None:
        return [float(x) for x in np.linspace(0.0, 1.0, int(grid_size))]
    return [float(x) for x in grid]


def threshold_sweep(df: DataFrame, label: str = "label", score: str = "score", grid=None, grid_size: int = 101) -> DataFrame:
    """Confusion counts and F1 / balanced accuracy / Youden J for every grid threshold.

    Rows are bucketed once against the grid (at most ``len(grid)+1`` groups);
    predictions at threshold ``t`` are ``score >= t``, so the counts for each
    threshold are suffix sums over the small bucket table.
    """
    thresholds = threshold_grid(grid, grid_size)
    order = sorted(range(len(thresholds)), key=lambda i: thresholds[i])
    sorted_t = [thresholds[i] for i in order]
    v = valid_pairs(df, label, score)
    y = F.col("y").cast("int")
    buckets = (
        v.select(bin_index(F.col("p"), sorted_t).alias("b"), y.alias("y"))
        .groupBy("b")
        .agg(F.count(F.when(F.col("y") == 1, 1)).alias("pos"), F.count(F.when(F.col("y") != 1, 1)).alias("neg"))
    )
    spark = df.sparkSession
    grid_df = spark.createDataFrame(
        [(pos, i + 1, float(t)) for i, (pos, t) in enumerate(zip(order, sorted_t))],
        "grid_pos int, b_min int, threshold double",
    )
    # a row with score s is predicted 1 at threshold t  <=>  its bucket >= rank of t
    joined = F.broadcast(grid_df).crossJoin(F.broadcast(buckets))  # grid x buckets: both bounded by grid size
    tot = buckets.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    counts = (
        joined.groupBy("grid_pos", "threshold")
        .agg(
            F.sum(F.when(F.col("b") >= F.col("b_min"), F.col("pos")).otherwise(0)).alias("tp"),
            F.sum(F.when(F.col("b") >= F.col("b_min"), F.col("neg")).otherwise(0)).alias("fp"),
        )
        .crossJoin(F.broadcast(tot))
        .withColumns({"fn": F.col("P") - F.col("tp"), "tn": F.col("N") - F.col("fp")})
    )
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    rates = _rates_from_counts(tp, fp, tn, fn)
    tpr = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
    fpr = F.when(fp + tn > 0, fp / (fp + tn)).otherwise(0.0)
    return counts.select(
        "grid_pos",
        "threshold",
        F.col("tp").cast("bigint").alias("tp"),
        F.col("fp").cast("bigint").alias("fp"),
        F.col("tn").cast("bigint").alias("tn"),
        F.col("fn").cast("bigint").alias("fn"),
        rates["f1"].alias("f1"),
        rates["balanced_accuracy"].alias("balanced_accuracy"),
        (tpr - fpr).alias("youden_j"),
    )


_METRIC_COL = {"f1": "f1", "balanced_accuracy": "balanced_accuracy", "youden_j": "youden_j"}


def choose_threshold(
    df: DataFrame, label: str = "label", score: str = "score", metric: str = "f1", grid=None, grid_size: int = 101
) -> DataFrame:
    """K6: first grid threshold (grid order) with the best metric; 0.5 when there is no row."""
    if metric not in _METRIC_COL:
        raise ValueError(f"metric is {metric!r}; use one of {sorted(_METRIC_COL)}")
    sweep = threshold_sweep(df, label, score, grid, grid_size)
    m = F.col(_METRIC_COL[metric])
    # the smallest (-metric, grid_pos) wins: ties go to the earliest grid position
    best = sweep.agg(F.min(F.struct((-m).alias("k"), F.col("grid_pos").alias("g"), F.col("threshold").alias("t"))).alias("b"))
    return best.select(F.coalesce(F.col("b.t"), F.lit(0.5)).alias("threshold"), (-F.col("b.k")).alias("best_score"))


def choose_threshold_value(df: DataFrame, label: str = "label", score: str = "score", metric: str = "f1", grid=None) -> float:
    row = choose_threshold(df, label, score, metric, grid).first()
    return 0.5 if row is None or row["threshold"] is None else float(row["threshold"])


RECORD = (
    "auc", "average_precision", "f1", "log_loss", "brier", "ece", "accuracy", "precision", "recall",
    "balanced_accuracy", "specificity", "support_pos", "support_neg",
)


def _clipped(p, eps: float):
    return F.least(F.greatest(p, F.lit(eps)), F.lit(1.0 - eps))


def score_table(df: DataFrame, label: str, score: str, threshold: float, by: str | None = None) -> DataFrame:
    """One row per group and distinct clipped score ``s``, with every sum the metric record needs.

    Running sums go along (group, score). The table is written, so all metrics are read off it and the
    rows themselves are scanned once.
    """
    v = _by_group(valid_pairs(df, label, score), by)
    y, p, s = F.col("y"), F.col("p"), _clipped(F.col("p"), PROB_EPS)
    one, zero, said = y.cast("int") == 1, y.cast("int") == 0, p >= F.lit(float(threshold))
    counts = {"n": F.lit(True), "pos": y > 0, "neg": y <= 0, "tp": one & said, "fp": zero & said, "tn": zero & ~said, "fn": one & ~said}
    table = v.groupBy("_by", s.alias("s")).agg(
        *[F.count(F.when(c, 1)).alias(name) for name, c in counts.items()],
        F.sum("y").alias("ys"),
        F.sum(-(y * F.log(s) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - s))).alias("ll"),
        F.sum(F.pow(s - y, 2)).alias("sq"),
    )
    return with_running_sums(table, [("_by", True), ("s", True)], ["n", "pos", "neg"])


def _by_group(v: DataFrame, by: str | None) -> DataFrame:
    return v.withColumn("_by", F.col(by) if by else F.lit(0))


def metric_records(
    df: DataFrame, label: str = "label", score: str = "score", threshold: float = 0.5, by: str | None = None,
    top_frac: float | None = None, key: str = "customer_id", n_bins: int = 10,
) -> DataFrame:
    """K7: the 13-field record with ``pred = score >= threshold``, one row or one row per value of ``by``.

    With ``top_frac`` also ``lift_at_frac`` (K8): rows above the cut score count by their sums, and only
    where equal scores straddle the cut are those rows read again and ordered by ``key``. Without ``by``
    an empty frame gives one row: supports of 0, NULL where a metric has no rows.
    """
    groups = ["_by"] if by else []
    table = score_table(df, label, score, threshold, by)
    totals = table.groupBy(*groups).agg(
        *[F.sum(c).alias(f"all_{c}") for c in ("n", "pos", "neg")],
        *[F.min(F.col(f"cum_{c}") - F.col(c)).alias(f"off_{c}") for c in ("n", "pos", "neg")],
    )
    if by:
        t = totals.withColumnRenamed("_by", "_of")
        j = table.join(F.broadcast(t), F.col("_by").eqNullSafe(F.col("_of")))  # one row a group
    else:
        j = table.crossJoin(F.broadcast(totals))  # one-row total
    upto = {c: F.col(f"cum_{c}") - F.col(f"off_{c}") for c in ("n", "pos", "neg")}
    down = {c: F.col(f"all_{c}") - upto[c] + F.col(c) for c in upto}
    top = F.ceil(F.col("all_n") * F.lit(float(top_frac or 1.0)))
    whole = down["n"] <= top
    cut = ~whole & (down["n"] - F.col("n") < top)
    edges = uniform_edges(n_bins)[1:-1]
    e, b = _clipped(F.col("s"), ECE_EPS), bin_index(_clipped(F.col("s"), ECE_EPS), edges)
    aggs = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "pos", "neg", "tp", "fp", "tn", "fn")]
    aggs += [F.sum(c).alias(c) for c in ("ll", "sq")]
    aggs += [
        F.sum(F.col("pos") * (upto["neg"] - F.col("neg") + F.lit(0.5) * F.col("neg"))).alias("u"),
        F.sum(F.col("pos") * down["pos"] / (down["pos"] + down["neg"])).alias("ap"),
        F.coalesce(F.sum(F.when(whole, F.col("ys"))), F.lit(0.0)).alias("top_y"),
        F.max(F.when(cut, F.struct("s", (top - (down["n"] - F.col("n"))).cast("long").alias("take")))).alias("cut"),
        F.max(top).cast("long").alias("k"),
    ]
    for i in range(len(edges) + 1):
        inside = b == i
        aggs += [F.sum(F.when(inside, F.col("n"))).alias(f"bn{i}"), F.sum(F.when(inside, F.col("pos"))).alias(f"bp{i}"),
                 F.sum(F.when(inside, F.col("n") * e)).alias(f"bs{i}")]
    a = j.groupBy(*groups).agg(*aggs)
    gaps = [F.coalesce(F.abs(F.col(f"bp{i}") - F.col(f"bs{i}")), F.lit(0.0)) for i in range(len(edges) + 1)]
    rates = _rates_from_counts(*[F.col(c) for c in ("tp", "fp", "tn", "fn")])
    some = F.col("n") > 0
    fields = dict(
        rates,
        auc=F.when((F.col("pos") > 0) & (F.col("neg") > 0), F.col("u") / (F.col("pos") * F.col("neg"))),
        average_precision=F.when(F.col("pos") > 0, F.col("ap") / F.col("pos")),
        log_loss=F.when(some, F.col("ll") / F.col("n")),
        brier=F.when(some, F.col("sq") / F.col("n")),
        ece=F.when(some, sum(gaps[1:], gaps[0]) / F.col("n")),
    )
    names = [F.col("_by").alias(by)] if by else []
    if top_frac is None:
        return a.select(*names, *[fields[c].alias(c) for c in RECORD])
    rows = [(r["_by"] if by else 0, r["cut"]["s"], r["cut"]["take"]) for r in a.collect() if r["cut"]]  # one row a group
    tied = _tied_positives(_by_group(valid_pairs(df, label, score), by), rows, key) if rows else {}
    extra = F.lit(0.0)
    for value, y in tied.items():
        extra = F.when(F.col("_by").eqNullSafe(F.lit(value)), F.lit(y)).otherwise(extra) if by else F.lit(y)
    base = F.col("pos") / F.col("n")
    lift = F.when(some & (F.col("pos") > 0), (F.col("top_y") + extra) / F.col("k") / base)
    return a.select(*names, *[fields[c].alias(c) for c in RECORD], lift.alias("lift_at_frac"))


def _tied_positives(v: DataFrame, cuts, key: str) -> dict:
    """Sum of labels over the first ``take`` rows, by ``key``, of those with the cut score of their group."""
    few = v.sparkSession.createDataFrame(cuts, f"_of {dict(v.dtypes)['_by']}, _cut double, _take long")
    at_cut = F.col("_by").eqNullSafe(F.col("_of")) & (_clipped(F.col("p"), PROB_EPS) == F.col("_cut"))
    ties = v.join(F.broadcast(few), at_cut).select("_by", "_take", "y", "p", F.col(key).alias("_key"))  # one row a group
    ranked = rank_within(ties, "_by", [("p", False), ("_key", True)], "_rank")
    sums = ranked.filter(F.col("_rank") <= F.col("_take")).groupBy("_by").agg(F.sum("y").alias("y"))
    return {r["_by"]: float(r["y"]) for r in sums.collect()}


def prediction_report(df: DataFrame, label: str = "label", score: str = "score", threshold: float = 0.5) -> DataFrame:
    """K7: the 13-field metric record (one row) with ``pred = score >= threshold``."""
    return metric_records(df, label, score, threshold)
