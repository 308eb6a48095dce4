"""Registered queries on the deterministic ``scored`` frame: B, K, R and A rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import classify, ranking, segment, soft
from .catalog import register, sa, sd, si, tidy
from .frames import scored
from .sql_base import with_base

PRED_THRESHOLD = 0.15
FRACTIONS = ranking.DEFAULT_FRACTIONS


def dbl(x: float) -> str:
    """A double literal that both engines read as the same IEEE value."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


VALID = "FROM scored WHERE label IS NOT NULL AND score IS NOT NULL"

# ---------------------------------------------------------------- B rows
_SEG = "seg AS (SELECT cluster, count(*) AS size, sum(label) AS positives FROM scored WHERE label IS NOT NULL GROUP BY cluster)"


@register(
    "segmentation_table",
    with_base(
        "SELECT " + ", ".join([si("cluster", "cluster"), si("size", "size"), sd("positives", "positives"),
                               sd("size - positives", "negatives"), sd("positives / size", "response_rate")])
        + " FROM seg", _SEG),
)
def q_segmentation_table(spark, sf_dir):
    return tidy(segment.segmentation_table(scored(spark, sf_dir)))


@register(
    "cluster_response_summary",
    with_base(
        "SELECT " + ", ".join([si("cluster", "cluster"), si("size", "size"), sd("positives", "positives"),
                               sd("size - positives", "negatives"), sd("positives / size", "response_rate")])
        + " FROM seg", _SEG),
)
def q_cluster_response_summary(spark, sf_dir):
    return tidy(segment.cluster_response_summary(scored(spark, sf_dir)))


@register(
    "cluster_response_rates",
    with_base(f"SELECT {si('cluster', 'cluster')}, {sd('avg(label)', 'response_rate')} FROM scored "
              "WHERE label IS NOT NULL GROUP BY cluster"),
)
def q_cluster_response_rates(spark, sf_dir):
    return tidy(segment.cluster_response_rates(scored(spark, sf_dir)))


@register(
    "cluster_sizes",
    with_base(f"SELECT {si('cluster', 'cluster')}, {si('count(*)', 'cluster_size')} FROM scored GROUP BY cluster"),
)
def q_cluster_sizes(spark, sf_dir):
    return tidy(segment.cluster_sizes(scored(spark, sf_dir)))


@register(
    "response_rate_dispersion",
    with_base(
        "SELECT " + ", ".join([sd("var_pop(r)", "response_rate_variance"), sd("stddev_pop(r)", "response_rate_std"),
                               sd("max(r) - min(r)", "response_rate_range")])
        + " FROM (SELECT avg(label) AS r FROM scored WHERE label IS NOT NULL GROUP BY cluster) t"),
)
def q_response_rate_dispersion(spark, sf_dir):
    return tidy(segment.response_rate_dispersion(segment.cluster_response_rates(scored(spark, sf_dir))))


@register(
    "weighted_rate_variance",
    with_base(
        "SELECT " + sd("sum(size / n * pow(positives / size - p / n, 2))", "weighted_rate_variance")
        + " FROM seg, (SELECT sum(size) AS n, sum(positives) AS p FROM seg) t", _SEG),
)
def q_weighted_rate_variance(spark, sf_dir):
    return tidy(segment.weighted_rate_variance(scored(spark, sf_dir)))


_LIFT_SQL = (
    "SELECT " + ", ".join([si("cluster", "cluster"), si("size", "size"), sd("size / n", "share"),
                           sd("positives / size", "response_rate"),
                           sd("CASE WHEN p / n > 0 THEN (positives / size) / (p / n) END", "lift_vs_global")])
    + " FROM seg, (SELECT sum(size) AS n, sum(positives) AS p FROM seg) t"
)


@register("cluster_lift_table", with_base(_LIFT_SQL, _SEG))
def q_cluster_lift_table(spark, sf_dir):
    return tidy(segment.cluster_lift_table(scored(spark, sf_dir)))


_ALLOC = (
    _SEG + ", tot AS (SELECT sum(size) AS n, sum(positives) AS p FROM seg), "
    f"alloc AS (SELECT cluster, size, positives / size AS rate, n, p, CAST(ceil(n * {dbl(0.2)}) AS BIGINT) AS n_sel, "
    "coalesce(sum(size) OVER (ORDER BY positives / size DESC, cluster ASC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev "
    "FROM seg, tot), "
    "takes AS (SELECT *, least(size, greatest(0, n_sel - prev)) AS take FROM alloc)"
)


@register(
    "campaign_allocation",
    with_base(
        "SELECT " + ", ".join([
            sd(dbl(0.2), "budget_frac"), si("max(n)", "n_total"), si("max(n_sel)", "n_selected"),
            sd("max(p) / max(n)", "global_response_rate"), sd("sum(take * rate)", "expected_responders_targeted"),
            sd("max(p) / max(n) * max(n_sel)", "expected_responders_random"),
            sd("CASE WHEN max(p) / max(n) * max(n_sel) > 0 THEN sum(take * rate) / (max(p) / max(n) * max(n_sel)) END", "lift"),
        ]) + " FROM takes", _ALLOC),
)
def q_campaign_allocation(spark, sf_dir):
    return tidy(segment.campaign_allocation(scored(spark, sf_dir), 0.2).drop("selected_from_clusters"))


@register(
    "campaign_allocation_detail",
    with_base(f"SELECT {si('cluster', 'cluster')}, {si('take', 'take')} FROM takes WHERE take > 0", _ALLOC),
)
def q_campaign_allocation_detail(spark, sf_dir):
    a = segment.campaign_allocation(scored(spark, sf_dir), 0.2)
    return tidy(a.select(F.explode("selected_from_clusters").alias("cluster", "take")))


# ---------------------------------------------------------------- K rows
def _confusion_sql(pred: str) -> str:
    return (
        f"cm AS (SELECT count(*) FILTER (WHERE label = 1 AND {pred}) AS tp, count(*) FILTER (WHERE label = 0 AND {pred}) AS fp, "
        f"count(*) FILTER (WHERE label = 0 AND NOT ({pred})) AS tn, count(*) FILTER (WHERE label = 1 AND NOT ({pred})) AS fn "
        f"{VALID})"
    )


_K1_COLS = [
    sd("CASE WHEN tp + fp + tn + fn > 0 THEN (tp + tn) / (tp + fp + tn + fn) END", "accuracy"),
    sd("CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END", "precision"),
    sd("CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END", "recall"),
    sd("CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END", "f1"),
    sd("CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END", "specificity"),
    sd("0.5 * ((CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END) + (CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END))",
       "balanced_accuracy"),
    sd("tp + fn", "support_pos"),
    sd("tn + fp", "support_neg"),
]


@register(
    "classification_metrics",
    with_base("SELECT " + ", ".join(_K1_COLS) + " FROM cm", _confusion_sql(f"score >= {dbl(PRED_THRESHOLD)}")),
)
def q_classification_metrics(spark, sf_dir):
    s = scored(spark, sf_dir).withColumn("pred", (F.col("score") >= F.lit(PRED_THRESHOLD)).cast("int"))
    return tidy(classify.classification_metrics(s))


_CLIP15 = f"greatest(least(score, {dbl(1.0 - 1e-15)}), {dbl(1e-15)})"
_GROUPS_ASC = (
    f"g AS (SELECT {_CLIP15} AS s, count(*) FILTER (WHERE label > 0) AS pos, count(*) FILTER (WHERE label <= 0) AS neg "
    f"{VALID} GROUP BY 1), "
    "ga AS (SELECT *, sum(neg) OVER (ORDER BY s ASC ROWS UNBOUNDED PRECEDING) AS cum_neg FROM g), "
    "gd AS (SELECT *, sum(pos) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS cum_pos, "
    "sum(neg) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS cum_negd FROM g)"
)
_AUC_EXPR = (
    "(SELECT CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (cum_neg - neg + 0.5 * neg)) / (sum(pos) * sum(neg)) END FROM ga)"
)
_AP_EXPR = (
    "(SELECT CASE WHEN max(P) > 0 THEN sum(pos / P * cum_pos / (cum_pos + cum_negd)) END "
    "FROM gd, (SELECT sum(pos) AS P FROM g) t)"
)


@register("roc_auc", with_base(f"SELECT {sd(_AUC_EXPR, 'auc')}", _GROUPS_ASC))
def q_roc_auc(spark, sf_dir):
    return tidy(classify.roc_auc(scored(spark, sf_dir)))


@register("average_precision", with_base(f"SELECT {sd(_AP_EXPR, 'average_precision')}", _GROUPS_ASC))
def q_average_precision(spark, sf_dir):
    return tidy(classify.average_precision(scored(spark, sf_dir)))


_LL = f"avg(-(label * ln({_CLIP15}) + (1 - label) * ln(1 - {_CLIP15})))"
_BRIER = f"avg(pow({_CLIP15} - label, 2))"


@register("log_loss_brier", with_base(f"SELECT {sd(_LL, 'log_loss')}, {sd(_BRIER, 'brier')} {VALID}"))
def q_log_loss_brier(spark, sf_dir):
    return tidy(classify.log_loss_brier(scored(spark, sf_dir)))


def _bin_sql(p: str, inner, right_closed=False) -> str:
    op = ">" if right_closed else ">="
    return " + ".join(f"CAST({p} {op} {dbl(e)} AS INTEGER)" for e in inner)


_CLIP12 = f"greatest(least(score, {dbl(1.0 - 1e-12)}), {dbl(1e-12)})"


def _calib_cte(inner, pexpr=_CLIP12) -> str:
    return (
        f"b AS (SELECT {_bin_sql(pexpr, inner)} AS bin, {pexpr} AS p, CAST(label > 0 AS DOUBLE) AS y {VALID}), "
        "bins AS (SELECT bin, count(*) AS cnt, avg(p) AS conf, avg(y) AS acc FROM b GROUP BY bin), "
        "bw AS (SELECT bin, cnt, cnt / (SELECT count(*) FROM b) AS weight, conf, acc, abs(acc - conf) AS gap FROM bins)"
    )


_UNIFORM_INNER = classify.uniform_edges(10)[1:-1]


@register(
    "calibration_bins",
    with_base(
        "SELECT " + ", ".join([si("bin", "bin"), si("cnt", "count"), sd("weight", "weight"), sd("conf", "conf"),
                               sd("acc", "acc"), sd("gap", "gap")]) + " FROM bw",
        _calib_cte(_UNIFORM_INNER)),
)
def q_calibration_bins(spark, sf_dir):
    return tidy(classify.calibration_bins(scored(spark, sf_dir)))


@register(
    "ece_uniform",
    with_base(f"SELECT {sd('sum(weight * gap)', 'ece')}, {sd('max(gap)', 'mce')} FROM bw", _calib_cte(_UNIFORM_INNER)),
)
def q_ece_uniform(spark, sf_dir):
    return tidy(classify.expected_calibration_error(scored(spark, sf_dir)))


_QEDGES = ", ".join(dbl(q) for q in classify.uniform_edges(10))
_ECE_Q = (
    f"qe AS (SELECT quantile_cont({_CLIP12}, [{_QEDGES}]) AS e {VALID}), "
    f"qe2 AS (SELECT CASE WHEN len(list_distinct(list_concat(list_concat([{dbl(0.0)}], e[2:10]), [{dbl(1.0)}]))) = 11 "
    f"THEN e ELSE [{_QEDGES}] END AS e FROM qe), "
    f"b AS (SELECT (SELECT " + " + ".join(f"CAST({_CLIP12} >= e[{i}] AS INTEGER)" for i in range(2, 11))
    + f" FROM qe2) AS bin, {_CLIP12} AS p, CAST(label > 0 AS DOUBLE) AS y {VALID}), "
    "bins AS (SELECT bin, count(*) AS cnt, avg(p) AS conf, avg(y) AS acc FROM b GROUP BY bin), "
    "bw AS (SELECT bin, cnt, cnt / (SELECT count(*) FROM b) AS weight, conf, acc, abs(acc - conf) AS gap FROM bins)"
)


@register("ece_quantile", with_base(f"SELECT {sd('sum(weight * gap)', 'ece')}, {sd('max(gap)', 'mce')} FROM bw", _ECE_Q))
def q_ece_quantile(spark, sf_dir):
    return tidy(classify.expected_calibration_error(scored(spark, sf_dir), strategy="quantile"))


_GRID = classify.threshold_grid()
_GRID_VALUES = ", ".join(f"({i}, {dbl(t)})" for i, t in enumerate(_GRID))
_SWEEP = (
    f"grid AS (SELECT * FROM (VALUES {_GRID_VALUES}) t(grid_pos, threshold)), "
    "cnt AS (SELECT grid_pos, threshold, "
    "count(*) FILTER (WHERE label = 1 AND score >= threshold) AS tp, count(*) FILTER (WHERE label = 0 AND score >= threshold) AS fp, "
    "count(*) FILTER (WHERE label = 0 AND score < threshold) AS tn, count(*) FILTER (WHERE label = 1 AND score < threshold) AS fn "
    "FROM grid, (SELECT * " + VALID + ") v GROUP BY grid_pos, threshold), "
    "sweep AS (SELECT grid_pos, threshold, tp, fp, tn, fn, "
    "CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1, "
    "0.5 * ((CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END) + (CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END)) "
    "AS balanced_accuracy, "
    "(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END) - (CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0.0 END) AS youden_j "
    "FROM cnt)"
)


@register(
    "threshold_sweep",
    with_base(
        "SELECT " + ", ".join([si("grid_pos", "grid_pos"), sd("threshold", "threshold"), si("tp", "tp"), si("fp", "fp"),
                               si("tn", "tn"), si("fn", "fn"), sd("f1", "f1"), sd("balanced_accuracy", "balanced_accuracy"),
                               sd("youden_j", "youden_j")]) + " FROM sweep", _SWEEP),
)
def q_threshold_sweep(spark, sf_dir):
    return tidy(classify.threshold_sweep(scored(spark, sf_dir)))


def _choose(metric: str):
    sql = with_base(
        f"SELECT {sd('threshold', 'threshold')}, {sd(metric, 'best_score')} FROM sweep "
        f"ORDER BY {metric} DESC, grid_pos ASC LIMIT 1",
        _SWEEP,
    )

    @register(f"choose_threshold_{metric if metric != 'balanced_accuracy' else 'balanced'}", sql)
    def q(spark, sf_dir):
        return tidy(classify.choose_threshold(scored(spark, sf_dir), metric=metric))

    return q


_choose("f1")
_choose("balanced_accuracy")
_choose("youden_j")

_REPORT_CTE = (
    _GROUPS_ASC + ", " + _confusion_sql(f"score >= {dbl(PRED_THRESHOLD)}") + ", "
    + _calib_cte(_UNIFORM_INNER, f"greatest(least({_CLIP15}, {dbl(1.0 - 1e-12)}), {dbl(1e-12)})")
)
_REPORT_COLS = [
    sd(_AUC_EXPR, "auc"), sd(_AP_EXPR, "average_precision"), _K1_COLS[3],
    sd(f"(SELECT {_LL} {VALID})", "log_loss"), sd(f"(SELECT {_BRIER} {VALID})", "brier"),
    sd("(SELECT sum(weight * gap) FROM bw)", "ece"),
] + [c for i, c in enumerate(_K1_COLS) if i != 3]


@register("prediction_report", with_base("SELECT " + ", ".join(_REPORT_COLS) + " FROM cm", _REPORT_CTE))
def q_prediction_report(spark, sf_dir):
    return tidy(classify.prediction_report(scored(spark, sf_dir), threshold=PRED_THRESHOLD))


# ---------------------------------------------------------------- R rows
_FR_VALUES = ", ".join(f"({dbl(f)})" for f in FRACTIONS)
_RANKED = (
    "rk AS (SELECT customer_id, score AS s, CAST(label AS DOUBLE) AS y, "
    "row_number() OVER (ORDER BY score DESC, customer_id ASC) AS r, count(*) OVER () AS n " + VALID + "), "
    f"fr AS (SELECT * FROM (VALUES {_FR_VALUES}) t(frac)), "
    "summ AS (SELECT frac, max(n) AS n, CAST(ceil(max(n) * frac) AS BIGINT) AS k, "
    "sum(CAST(y > 0 AS INTEGER)) AS P, "
    "sum(CASE WHEN r <= ceil(n * frac) THEN y END) AS ys, "
    "sum(CASE WHEN r <= ceil(n * frac) THEN CAST(y > 0 AS INTEGER) END) AS pos, "
    "sum(CASE WHEN r <= ceil(n * frac) THEN s END) AS ss FROM rk, fr GROUP BY frac)"
)
_R_COLS = {
    "frac": sd("frac", "frac"),
    "k": si("k", "k"),
    "base_rate": sd("P / n", "base_rate"),
    "precision": sd("CASE WHEN k > 0 THEN ys / k END", "precision"),
    "recall": sd("CASE WHEN P > 0 THEN pos / P END", "recall"),
    "lift": sd("CASE WHEN P / n > 0 THEN (ys / k) / (P / n) END", "lift"),
    "positives_in_top": sd("pos", "positives_in_top"),
    "expected_score_sum_in_top": sd("ss", "expected_score_sum_in_top"),
}


@register("ranking_summary", with_base("SELECT " + ", ".join(_R_COLS.values()) + " FROM summ", _RANKED))
def q_ranking_summary(spark, sf_dir):
    return tidy(ranking.ranking_summary(scored(spark, sf_dir)))


def _r_single(name: str, col: str, alias: str, fn):
    expr = _R_COLS[col].rsplit(" AS ", 1)[0]
    sql = with_base(f"SELECT {expr} AS {alias} FROM summ WHERE frac = {dbl(0.2)}", _RANKED)

    @register(name, sql)
    def q(spark, sf_dir):
        return tidy(fn(scored(spark, sf_dir)))

    return q


_r_single("precision_at_frac", "precision", "precision_at_frac", lambda d: ranking.precision_at_frac(d))
_r_single("recall_at_frac", "recall", "recall_at_frac", lambda d: ranking.recall_at_frac(d))
_r_single("positives_in_top", "positives_in_top", "positives_in_top", lambda d: ranking.positives_in_top(d))
_r_single("lift_at_frac", "lift", "lift_at_frac", lambda d: ranking.lift_at_frac(d))


@register(
    "expected_score_sum",
    with_base(
        "SELECT " + sd("sum(CASE WHEN r <= ceil(n * " + dbl(0.2) + ") THEN score END)", "expected_score_sum")
        + " FROM (SELECT score, row_number() OVER (ORDER BY score DESC, customer_id ASC) AS r, count(*) OVER () AS n "
        "FROM scored WHERE score IS NOT NULL) t"
    ),
)
def q_expected_score_sum(spark, sf_dir):
    return tidy(ranking.expected_score_sum(scored(spark, sf_dir)))


@register("lift_curve", with_base(f"SELECT {_R_COLS['frac']}, {_R_COLS['lift']} FROM summ", _RANKED))
def q_lift_curve(spark, sf_dir):
    return tidy(ranking.lift_curve(scored(spark, sf_dir)))


@register(
    "ranking_metrics",
    with_base(
        "SELECT " + ", ".join([
            _R_COLS["base_rate"], _R_COLS["precision"].replace(" AS precision", " AS precision_top"),
            _R_COLS["recall"].replace(" AS recall", " AS recall_top"), _R_COLS["lift"].replace(" AS lift", " AS lift_top"),
            _R_COLS["positives_in_top"], _R_COLS["expected_score_sum_in_top"],
        ]) + f" FROM summ WHERE frac = {dbl(0.2)}", _RANKED),
)
def q_ranking_metrics(spark, sf_dir):
    return tidy(ranking.ranking_metrics(scored(spark, sf_dir)))


@register(
    "evaluate_scored",
    with_base(
        "SELECT " + ", ".join(_REPORT_COLS)
        + ", " + sd(f"(SELECT CASE WHEN P / n > 0 THEN (ys / k) / (P / n) END FROM summ WHERE frac = {dbl(0.2)})", "lift_top20") + ", "
        + sd(str(PRED_THRESHOLD), "threshold") + " FROM cm",
        _REPORT_CTE + ", " + _RANKED),
)
def q_evaluate_scored(spark, sf_dir):
    s = scored(spark, sf_dir)
    rep = classify.metric_records(s, threshold=PRED_THRESHOLD, top_frac=0.2).withColumnRenamed("lift_at_frac", "lift_top20")
    return tidy(rep.withColumn("threshold", F.lit(PRED_THRESHOLD)))


# ---------------------------------------------------------------- A rows
_QN = "list_transform(qe, lambda x: x / list_sum(qe))"
_QC = f"list_transform({_QN}, lambda x: greatest(x, {dbl(1e-12)}))"
_NORM = f"list_transform({_QC}, lambda x: x / greatest(list_sum({_QC}), {dbl(1e-12)}))"


@register("normalize_soft", with_base(f"SELECT {si('customer_id', 'customer_id')}, {sa(_NORM, 'q_norm')} FROM scored"))
def q_normalize_soft(spark, sf_dir):
    s = scored(spark, sf_dir)
    return tidy(s.select("customer_id", soft.normalize_soft(F.col("q")).alias("q_norm")))


_ENT = f"-list_sum(list_transform({_NORM}, lambda x: x * ln(least(greatest(x, {dbl(1e-12)}), 1.0))))"


@register("assignment_entropy", with_base(f"SELECT {si('customer_id', 'customer_id')}, {sd(_ENT, 'entropy')} FROM scored"))
def q_assignment_entropy(spark, sf_dir):
    s = scored(spark, sf_dir)
    return tidy(s.select("customer_id", soft.assignment_entropy(F.col("q")).alias("entropy")))


@register(
    "assignment_maxprob", with_base(f"SELECT {si('customer_id', 'customer_id')}, {sd(f'list_max({_NORM})', 'maxprob')} FROM scored")
)
def q_assignment_maxprob(spark, sf_dir):
    s = scored(spark, sf_dir)
    return tidy(s.select("customer_id", soft.assignment_maxprob(F.col("q")).alias("maxprob")))
