"""Registered queries: figure tables (X rows), assignment sink/source."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import classify, profiles, segment, soft
from ..operators.experts import class_weight_balanced
from ..operators.features import BEHAVIOR_NUMERIC_FEATURES, log_amounts
from ..operators.transform import apply_transform, feature_table
from ..shared import written
from ..sources.sinks import align_assignments
from .catalog import register, sd, si, ss, tidy
from .catalog_metrics import VALID, dbl
from .catalog_transform import _TF
from .frames import campaign_features, scored, split_features, with_segment
from .jobs import onehot_ids
from .sql_base import with_base

BEH = [c.lower() for c in BEHAVIOR_NUMERIC_FEATURES]
FRACS = (0.05, 0.1, 0.2, 0.3, 0.5)


@register(
    "cluster_centers",
    with_base(
        " UNION ALL ".join(
            f"SELECT {si('s.cluster', 'cluster')}, '{c.lower()}' AS feature, {sd(f'avg(tf.{c})', 'mean')} "
            "FROM tf JOIN scored s USING (customer_id) GROUP BY s.cluster"
            for c in BEHAVIOR_NUMERIC_FEATURES
        ),
        _TF,
    ),
)
def q_cluster_centers(spark, sf_dir):
    rows = written(with_segment(split_features(spark, sf_dir)), "segmented")
    _, fitted = feature_table(rows, F.col("split") == "train")
    return tidy(profiles.cluster_centers(apply_transform(log_amounts(rows), fitted, keep=("customer_id", "cluster")), BEH))


_CURVE = (
    f"g AS (SELECT greatest(least(score, {dbl(1.0)}), {dbl(0.0)}) AS s, count(*) FILTER (WHERE label > 0) AS pos, "
    f"count(*) FILTER (WHERE label <= 0) AS neg {VALID} GROUP BY 1), "
    "c AS (SELECT s, sum(pos) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS cp, "
    "sum(neg) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS cn FROM g), t AS (SELECT sum(pos) AS P, sum(neg) AS N FROM g)"
)


@register(
    "roc_points",
    with_base(f"SELECT {sd('s', 'threshold')}, {sd('cp / P', 'tpr')}, {sd('cn / N', 'fpr')} FROM c, t", _CURVE),
)
def q_roc_points(spark, sf_dir):
    return tidy(profiles.curve_points(scored(spark, sf_dir)).select("threshold", "tpr", "fpr"))


@register(
    "pr_points",
    with_base(f"SELECT {sd('s', 'threshold')}, {sd('cp / (cp + cn)', 'precision')}, {sd('cp / P', 'recall')} FROM c, t", _CURVE),
)
def q_pr_points(spark, sf_dir):
    return tidy(profiles.curve_points(scored(spark, sf_dir)).select("threshold", "precision", "recall"))


_REL_BIN = " + ".join(f"CAST(score > {dbl(e)} AS INTEGER)" for e in classify.uniform_edges(10)[1:-1])


@register(
    "reliability_table",
    with_base(
        f"SELECT {si('bin', 'bin')}, {si('count(*)', 'count')}, {sd('avg(CAST(label > 0 AS DOUBLE))', 'frac_pos')}, "
        f"{sd('avg(score)', 'mean_score')} FROM (SELECT {_REL_BIN} AS bin, score, label {VALID}) b GROUP BY bin"
    ),
)
def q_reliability_table(spark, sf_dir):
    return tidy(profiles.reliability_table(scored(spark, sf_dir)))


_QN = "list_transform(qe, lambda x: x / list_sum(qe))"
_QC = f"list_transform({_QN}, lambda x: greatest(x, {dbl(1e-12)}))"
_NORM = f"list_transform({_QC}, lambda x: x / greatest(list_sum({_QC}), {dbl(1e-12)}))"
_ENT = f"-list_sum(list_transform({_NORM}, lambda x: x * ln(least(greatest(x, {dbl(1e-12)}), 1.0))))"


def _hist_sql(expr: str, lo: str | None, hi: str | None) -> str:
    lo_e = lo or "min(v)"
    hi_e = hi or "max(v)"
    return (
        f"WITH {{base}}, hv AS (SELECT {expr} AS v FROM scored), "
        f"rg AS (SELECT {lo_e} AS lo, {hi_e} AS hi, avg(v) AS mean FROM hv), "
        "hb AS (SELECT CAST(least(greatest(CASE WHEN (hi - lo) / CAST(30.0 AS DOUBLE) > 0 "
        "THEN floor((v - lo) / ((hi - lo) / CAST(30.0 AS DOUBLE))) ELSE 0 END, 0), 29) AS INTEGER) AS bin, lo, hi, mean FROM hv, rg) "
        f"SELECT {si('bin', 'bin')}, {sd('lo + bin * (hi - lo) / 30', 'left')}, {si('count(*)', 'count')}, {sd('mean', 'mean')} "
        "FROM hb GROUP BY bin, lo, hi, mean"
    )


def _hist_query(name, expr_sql, col_fn, lo, hi):
    from .sql_base import BASE_CTES

    sql = _hist_sql(expr_sql, None if lo is None else dbl(lo), None if hi is None else dbl(hi)).replace("{base}", BASE_CTES)

    @register(name, sql)
    def q(spark, sf_dir):
        s = scored(spark, sf_dir).select(col_fn(F.col("q")).alias("v"))
        return tidy(profiles.histogram(s, "v", 30, lo, hi))

    return q


_hist_query("entropy_histogram", _ENT, soft.assignment_entropy, None, None)
_hist_query("maxprob_histogram", f"list_max({_NORM})", soft.assignment_maxprob, 0.0, 1.0)

_RFM_RAW = [("recency", "Recency"), ("frequency", "Frequency"), ("monetary", "Monetary")]


@register(
    "rfm_boxstats",
    with_base(
        "SELECT " + ", ".join([si("cluster", "cluster"), "feature", sd("q[1]", "q1"), sd("q[2]", "median"), sd("q[3]", "q3"),
                               sd("wl", "whisker_lo"), sd("wh", "whisker_hi")])
        + " FROM (SELECT l.cluster, l.feature, q.q, min(CASE WHEN v >= q.q[1] - 1.5 * (q.q[3] - q.q[1]) THEN v END) AS wl, "
        "max(CASE WHEN v <= q.q[3] + 1.5 * (q.q[3] - q.q[1]) THEN v END) AS wh FROM lv l JOIN "
        f"(SELECT cluster, feature, quantile_cont(v, [{dbl(0.25)}, {dbl(0.5)}, {dbl(0.75)}]) AS q FROM lv GROUP BY cluster, feature) q "
        "USING (cluster, feature) GROUP BY l.cluster, l.feature, q.q) t",
        "lv AS (" + " UNION ALL ".join(
            f"SELECT s.cluster, '{n}' AS feature, CAST(f.{c} AS DOUBLE) AS v FROM feat f JOIN scored s USING (customer_id) WHERE f.{c} IS NOT NULL"
            for n, c in _RFM_RAW) + ")",
    ),
)
def q_rfm_boxstats(spark, sf_dir):
    j = with_segment(campaign_features(spark, sf_dir)).select("cluster", *[F.col(c).alias(n) for n, c in _RFM_RAW])
    return tidy(profiles.rfm_boxstats(j, [n for n, _ in _RFM_RAW]))


_CH = profiles.CHANNELS


@register(
    "channel_mix",
    with_base(
        f"SELECT {si('cluster', 'cluster')}, "
        + ", ".join(sd(f"CASE WHEN ({' + '.join(_CH)}) = 0 THEN 0.0 ELSE {c} / ({' + '.join(_CH)}) END", c) for c in _CH)
        + " FROM (SELECT s.cluster, " + ", ".join(f"avg(coalesce(CAST(f.{c} AS DOUBLE), 0.0)) AS {c}" for c in _CH)
        + " FROM feat f JOIN scored s USING (customer_id) GROUP BY s.cluster) t"
    ),
)
def q_channel_mix(spark, sf_dir):
    j = with_segment(campaign_features(spark, sf_dir)).select("cluster", *_CH)
    return tidy(profiles.channel_mix(j))


@register(
    "size_and_response",
    with_base(
        f"SELECT {si('coalesce(a.cluster, b.cluster)', 'cluster')}, {si('coalesce(a.size, 0)', 'size')}, {sd('b.r', 'response_rate')} "
        "FROM (SELECT cluster, count(*) AS size FROM scored GROUP BY cluster) a FULL OUTER JOIN "
        "(SELECT cluster, avg(label) AS r FROM scored WHERE label IS NOT NULL GROUP BY cluster) b ON a.cluster = b.cluster"
    ),
)
def q_size_and_response(spark, sf_dir):
    s = scored(spark, sf_dir)
    return tidy(profiles.size_and_response(s, s))


def _cell(c, lo, hi):
    w = f"(({hi} - {lo}) / CAST(35.0 AS DOUBLE))"
    return f"CAST(least(greatest(CASE WHEN {w} > 0 THEN floor(({c} - {lo}) / {w}) ELSE 0 END, 0), 34) AS INTEGER)"


@register(
    "age_income_density",
    with_base(
        f"SELECT {si('cluster', 'cluster')}, {si('gx', 'gx')}, {si('gy', 'gy')}, {si('count(*)', 'count')} FROM ("
        f"SELECT s.cluster, {_cell('f.Age', 'x0', 'x1')} AS gx, {_cell('f.Income', 'y0', 'y1')} AS gy "
        "FROM feat f JOIN scored s USING (customer_id), (SELECT min(Age) AS x0, max(Age) AS x1, min(Income) AS y0, max(Income) AS y1 "
        "FROM feat WHERE Age IS NOT NULL AND Income IS NOT NULL) r WHERE f.Age IS NOT NULL AND f.Income IS NOT NULL) t "
        "GROUP BY cluster, gx, gy"
    ),
)
def q_age_income_density(spark, sf_dir):
    j = with_segment(campaign_features(spark, sf_dir)).select("cluster", "Age", "Income")
    return tidy(profiles.density_grid(j, "Age", "Income"))


@register(
    "cluster_lift_bars",
    with_base(
        "SELECT " + ", ".join([si("cluster", "cluster"), si("size", "size"), sd("size / n", "share"), sd("positives / size", "response_rate"),
                               sd("CASE WHEN p / n > 0 THEN (positives / size) / (p / n) END", "lift_vs_global")])
        + " FROM seg, (SELECT sum(size) AS n, sum(positives) AS p FROM seg) t",
        "seg AS (SELECT cluster, count(*) AS size, sum(CAST(label > 0 AS INTEGER)) AS positives FROM scored WHERE label IS NOT NULL GROUP BY cluster)",
    ),
)
def q_cluster_lift_bars(spark, sf_dir):
    return tidy(profiles.cluster_lift_bars(scored(spark, sf_dir)))


_FR = ", ".join(f"({dbl(f)})" for f in FRACS)


@register(
    "budget_allocation_curve",
    with_base(
        "SELECT " + ", ".join([sd("budget_frac", "budget_frac"), si("n_sel", "n_selected"), sd("e / n_sel", "expected_precision"),
                               sd("CASE WHEN p / n > 0 THEN e / n_sel / (p / n) END", "lift")])
        + " FROM (SELECT budget_frac, n, p, n_sel, sum(take * rate) AS e FROM ("
        "SELECT *, least(size, greatest(0, n_sel - coalesce(sum(size) OVER (PARTITION BY budget_frac ORDER BY rate DESC, cluster ASC "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS take FROM ("
        "SELECT fr.budget_frac, n, p, CAST(least(greatest(ceil(fr.budget_frac * n), 1), n) AS BIGINT) AS n_sel, seg.cluster, seg.size, "
        f"seg.positives / seg.size AS rate FROM (SELECT * FROM (VALUES {_FR}) v(budget_frac)) fr, "
        "(SELECT sum(size) AS n, sum(positives) AS p FROM seg) t, seg) a) b GROUP BY budget_frac, n, p, n_sel) c",
        "seg AS (SELECT cluster, count(*) AS size, sum(label) AS positives FROM scored WHERE label IS NOT NULL GROUP BY cluster)",
    ),
)
def q_budget_allocation_curve(spark, sf_dir):
    return tidy(profiles.budget_allocation_curve(scored(spark, sf_dir), FRACS))


@register(
    "income_spend",
    with_base(
        f"SELECT {si('f.customer_id', 'customer_id')}, {si('s.cluster', 'cluster')}, {sd('f.Income', 'income')}, {sd('f.Monetary', 'spent')} "
        "FROM feat f JOIN scored s USING (customer_id)"
    ),
)
def q_income_spend(spark, sf_dir):
    rows = with_segment(campaign_features(spark, sf_dir))
    return tidy(rows.select("customer_id", "cluster", F.col("Income").alias("income"), F.col("Monetary").alias("spent")))


# ---------------------------------------------------------------- S4 / S5
@register(
    "assignments",
    with_base(f"SELECT {si('customer_id', 'customer_id')}, split, {si('s.cluster', 'cluster')} FROM sp JOIN scored s USING (customer_id)", _TF),
)
def q_assignments(spark, sf_dir):
    return tidy(with_segment(split_features(spark, sf_dir)).select("customer_id", "split", "cluster"))


@register(
    "align_assignments",
    with_base(
        f"SELECT {si('f.customer_id', 'customer_id')}, {si('a.cluster', 'cluster')}, {si('a.cluster IS NOT NULL', 'has_assignment')} "
        "FROM feat f LEFT JOIN (SELECT customer_id, s.cluster FROM sp JOIN scored s USING (customer_id) WHERE split <> 'test') a "
        "ON f.customer_id = a.customer_id",
        _TF,
    ),
)
def q_align_assignments(spark, sf_dir):
    rows = with_segment(split_features(spark, sf_dir)).select("customer_id", "split", "cluster")
    assign, feats = rows.filter(F.col("split") != "test"), rows.select("customer_id")
    return tidy(align_assignments(feats, assign).select("customer_id", "cluster", "has_assignment"))


# ---------------------------------------------------------------- G15, G30
@register(
    "cluster_onehot",
    with_base(
        "SELECT " + si("customer_id", "customer_id") + ", " + ", ".join(sd(f"CASE WHEN cluster = {k} THEN 1.0 ELSE 0.0 END", f"seg_{k}") for k in range(4)) + " FROM scored"
    ),
)
def q_cluster_onehot(spark, sf_dir):
    rows = onehot_ids(scored(spark, sf_dir).select("customer_id", "cluster"), 4, "seg")
    return tidy(rows.drop("cluster"))


@register(
    "balanced_weights",
    with_base(
        f"SELECT {si('customer_id', 'customer_id')}, {sd('t.n / (2.0 * c.n)', 'w')} FROM scored s "
        "JOIN (SELECT label, count(*) AS n FROM scored WHERE label IS NOT NULL GROUP BY label) c ON c.label = s.label, "
        "(SELECT count(*) AS n FROM scored WHERE label IS NOT NULL) t"
    ),
)
def q_balanced_weights(spark, sf_dir):
    rows = scored(spark, sf_dir).filter(F.col("label").isNotNull()).select("customer_id", "label")
    return tidy(class_weight_balanced(rows).select("customer_id", "w"))
