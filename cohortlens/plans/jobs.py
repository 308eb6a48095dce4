"""Experiment jobs (M1-M9) as compositions over one cached model frame.

The feature frame (train-fitted transform applied to every row, with ``xb`` /
``xf`` / ``xrfm`` arrays and the ``split`` column) is computed once and
persisted; every job fits on ``split = 'train'`` rows, picks thresholds on
``val`` and reports on ``test``. Only parameters and one-row metric records
reach the driver.
"""

from __future__ import annotations

from dataclasses import asdict
from itertools import product

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import classify, cluster as clu, ctp, experts, grid, joint, mixture, quality, ranking, segment, soft
from ..shared import dealt, written
from .frames import model_frame

TOP_FRAC = 0.2


class JobContext:
    """Shared cached inputs of all jobs."""

    def __init__(self, spark: SparkSession, sf_dir: str, exact: bool = True, two_way: bool = False):
        self.spark = spark
        self.frame, self.fitted = model_frame(spark, sf_dir, exact=exact, two_way=two_way)
        self.train = self.frame.filter(F.col("split") == "train").persist()
        self.fits: dict = {}  # fitted joint models by configuration (the downstream job re-uses them)

    def split(self, name: str) -> DataFrame:
        return self.frame.filter(F.col("split") == name)


def evaluate(scored: DataFrame, threshold: float, score: str = "score") -> dict:
    """K8: 13-field record + lift@20% + threshold (one row)."""
    return _evaluated(classify.metric_records(scored, "label", score, threshold, top_frac=TOP_FRAC).first(), threshold)


def evaluate_splits(scored: DataFrame, threshold: float, splits, score: str = "score") -> dict[str, dict]:
    """K8 of several splits from one scan of their rows."""
    rows = classify.metric_records(
        scored.filter(F.col("split").isin(*splits)), "label", score, threshold, by="split", top_frac=TOP_FRAC
    ).collect()  # one row a split
    return {r["split"]: _evaluated(r, threshold) for r in rows}


def _evaluated(row, threshold: float) -> dict:
    rep = {f: row[f] for f in classify.RECORD}
    return dict(rep, lift_top20=row["lift_at_frac"], threshold=float(threshold))


def cluster_report(df: DataFrame, x: str, cluster: str = "cluster") -> dict:
    """V4 + B1 + B4 on one split."""
    scores = quality.cluster_scores(df.select("customer_id", x, cluster), x, cluster, key="customer_id")
    rates = segment.cluster_response_rates(df, cluster, "label")
    disp = segment.response_rate_dispersion(rates).first()
    scores["response_rate_variance"] = disp["response_rate_variance"] if disp else None
    scores["response_rates"] = {int(r["cluster"]): float(r["response_rate"]) for r in rates.orderBy("cluster").collect()}  # K rows
    return scores


def _assign(df: DataFrame, centers, x: str) -> DataFrame:
    return df.withColumn("cluster", clu.assign_nearest(F.col(x), centers))


# Fixed values of the baseline job's configuration.
BASELINE_PRESET = {"n_init": 30, "max_iter": 500, "gmm_iter": 400}


def baseline_table(ctx: JobContext, k: int = 4, n_init: int = BASELINE_PRESET["n_init"], seed: int = 42,
                   max_iter: int = BASELINE_PRESET["max_iter"], gmm_iter: int = BASELINE_PRESET["gmm_iter"]) -> list[dict]:
    """M1-M4: RFM K-Means, behaviour K-Means, mixture, cluster-then-predict (test split)."""
    rows = []
    test = ctx.split("test")
    for name, x in (("rfm_kmeans", "xrfm"), ("behavior_kmeans", "xb")):
        centers, _ = clu.kmeans_fit(ctx.train, x, k, seed, n_init, max_iter)
        rep = cluster_report(_assign(test, centers, x), x)
        rep["inertia"] = clu.inertia(ctx.train, centers, x).first()[0]
        rep.update(model=name, n_clusters=float(k))
        rows.append(rep)
    gmm = mixture.gmm_fit(ctx.train, "xb", k, seed, gmm_iter)
    post = mixture.gmm_posteriors(gmm, test, "xb", keep=("customer_id", "label", "xb"))
    rep = cluster_report(post, "xb")
    rep.update(model="gmm", n_clusters=float(k))
    rows.append(rep)
    centers, models = ctp.fit_cluster_then_predict(ctx.train, k, seed, n_init)
    scored = ctp.score_with_clusters(ctp.predict_segments(ctx.frame, centers), models).withColumnRenamed("p", "score")
    thr = classify.choose_threshold_value(scored.filter(F.col("split") == "val"), metric="f1")
    rep = cluster_report(scored.filter(F.col("split") == "test"), "xb")
    rep.update(evaluate(scored.filter(F.col("split") == "test"), thr))
    rep.update(model="cluster_then_predict", n_clusters=float(k))
    rows.append(rep)
    return rows


def fit_main(ctx: JobContext, cfg: joint.JointConfig):
    key = repr(asdict(cfg))
    if key not in ctx.fits:
        ctx.fits[key] = joint.fit_joint(ctx.train, cfg)
    prm, trace = ctx.fits[key]
    scored = ctx.frame.withColumns(
        {
            "score": joint.predict_response(F.col("xb"), F.col("xf"), prm, cfg),
            "cluster": joint.predict_clusters(F.col("xb"), prm, cfg),
        }
    )
    return prm, trace, scored


def main_report(ctx: JobContext, cfg: joint.JointConfig | None = None) -> tuple[list[dict], DataFrame]:
    """M5: fit on train, threshold (F1) on val, report val and test; assignments frame."""
    cfg = cfg or joint.JointConfig.preset("yaml")
    prm, trace, scored = fit_main(ctx, cfg)
    thr = classify.choose_threshold_value(scored.filter(F.col("split") == "val"), metric="f1")
    out = []
    metrics = evaluate_splits(scored, thr, ("val", "test"))
    for split in ("val", "test"):
        rep = cluster_report(scored.filter(F.col("split") == split), "xb")
        rep.update(metrics[split])
        rep.update(split=split, model=cfg.model_type, n_iter=len(trace["change_ratio"]), **{f"cfg_{k}": v for k, v in asdict(cfg).items()})
        out.append(rep)
    train_assign = joint.train_assignments(ctx.train, prm, cfg).select("customer_id", "split", "cluster")
    assignments = scored.filter(F.col("split") != "train").select("customer_id", "split", "cluster").unionByName(train_assign)
    return out, assignments


def onehot_ids(df: DataFrame, k: int, prefix: str) -> DataFrame:
    """Cluster ids as one-hot columns (ids 0..k-1 known from the fit; unseen -> all 0)."""
    return df.withColumns({f"{prefix}_{j}": (F.col("cluster") == j).cast("double") for j in range(k)})


def _logistic_variant(frame: DataFrame, extra: list[str]) -> dict:
    """Balanced L2 logistic (C = 1, sklearn ``class_weight='balanced'``) on the full features plus
    ``extra`` columns; F1 threshold on val, test report. Fitted with the fused Newton solver
    (a handful of scans instead of hundreds of L-BFGS jobs)."""
    scored = _newton_scores(frame, extra)
    thr = classify.choose_threshold_value(scored.filter(F.col("split") == "val"), metric="f1")
    return evaluate(scored.filter(F.col("split") == "test"), thr)


def downstream_table(ctx: JobContext, k: int = 4, seed: int = 42, cfg: joint.JointConfig | None = None) -> list[dict]:
    """M6: balanced logistic on base features, + K-Means ids, + mixture ids, + response-aware ids; direct probability."""
    rows = []
    base = ctx.frame
    rows.append(dict(_logistic_variant(base, []), model="base_logistic"))
    centers, _ = clu.kmeans_fit(ctx.train, "xb", k, seed, 10)
    km = onehot_ids(_assign(base, centers, "xb"), k, "km")
    rows.append(dict(_logistic_variant(km, [f"km_{j}" for j in range(k)]), model="base_plus_kmeans"))
    gmm = mixture.gmm_fit(ctx.train, "xb", k, seed)
    post = mixture.gmm_posteriors(gmm, base, "xb", keep=tuple(base.columns))
    gm = onehot_ids(post, k, "gm")
    rows.append(dict(_logistic_variant(gm, [f"gm_{j}" for j in range(k)]), model="base_plus_gmm"))
    cfg = cfg or joint.JointConfig.preset("yaml")
    prm, _, scored = fit_main(ctx, cfg)
    ra = onehot_ids(scored.drop("score"), k, "ra")
    rows.append(dict(_logistic_variant(ra, [f"ra_{j}" for j in range(k)]), model="base_plus_response_aware"))
    thr = classify.choose_threshold_value(scored.filter(F.col("split") == "val"), metric="f1")
    rows.append(dict(evaluate(scored.filter(F.col("split") == "test"), thr), model="response_aware_direct"))
    return rows


def ablation_table(ctx: JobContext, ks=(3, 4, 5, 6), lambdas=(0.0, 0.1, 0.3, 1.0, 3.0), temps=(0.5, 1.0, 2.0), **cfg_kw) -> list[dict]:
    """M7: grid of joint-model settings evaluated on val at threshold 0.5, in grid order.

    All settings are fitted side by side and evaluated together (:mod:`grid`): the number of passes over
    the rows is that of the slowest setting, not their sum.
    """
    cfgs = [joint.JointConfig(n_clusters=k, lambda_=lam, temperature=t, **cfg_kw) for k, lam, t in product(ks, lambdas, temps)]
    fits = grid.fit_grid(ctx.train, cfgs)
    records = grid.evaluate_grid(ctx.split("val"), fits, cfgs, 0.5, TOP_FRAC)
    return [
        dict(rec, n_clusters_cfg=c.n_clusters, lambda_=c.lambda_, temperature=c.temperature, n_iter=len(trace["change_ratio"]))
        for rec, c, (_, trace) in zip(records, cfgs, fits)
    ]


def elbow_table(spark: SparkSession, sf_dir: str, ks=range(2, 11), n_init: int = 10, seed: int = 42) -> DataFrame:
    """Inertia for K = 2..10 on raw recency / frequency / monetary (missing -> 0)."""
    from .frames import campaign_features

    f = campaign_features(spark, sf_dir).select(
        F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in ("Recency", "Frequency", "Monetary")]).alias("x")
    )
    f = dealt(written(f, "elbow")).persist()
    ks = [int(k) for k in ks]
    rows = [(k, cost) for k, (_, cost) in zip(ks, clu.kmeans_fits(f, "x", ks, seed, n_init))]
    f.unpersist()
    return spark.createDataFrame(rows, "k int, inertia double")


def records_frame(spark: SparkSession, records: list[dict]) -> DataFrame:
    """Metric rows as a DataFrame; map cells become JSON text (S3)."""
    import json

    keys = sorted({k for r in records for k in r})
    def norm(v):
        if isinstance(v, dict):
            return json.dumps({str(a): b for a, b in v.items()})
        if isinstance(v, (np.floating, np.integer)):
            return v.item()
        return v
    data = [{k: norm(r.get(k)) for k in keys} for r in records]
    types = {}
    for k in keys:
        vals = [d[k] for d in data if d[k] is not None]
        if all(isinstance(v, bool) for v in vals) and vals:
            types[k] = "boolean"
        elif all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in vals):
            types[k] = "double"
        else:
            types[k] = "string"
    schema = ", ".join(f"`{k}` {types[k]}" for k in keys)
    rows = [tuple(float(d[k]) if types[k] == "double" and d[k] is not None else (str(d[k]) if types[k] == "string" and d[k] is not None else d[k]) for k in keys) for d in data]
    return spark.createDataFrame(rows, schema)


def _newton_scores(frame: DataFrame, extra: list[str]) -> DataFrame:
    """Balanced logistic fitted on train rows; ``score`` for every row."""
    cols = F.concat(F.col("xf"), F.array(*[F.col(c) for c in extra])) if extra else F.col("xf")
    f = frame.withColumn("xf", cols)
    train = f.filter(F.col("split") == "train").select("label", "xf")
    D = train.select(F.size("xf")).first()[0]
    model = experts.fit_experts(train, lambda pdf: np.ones((len(pdf), 1)), 1, D, 1.0, "class_weight", 0.5)[0]
    return f.withColumn("score", joint._expert_col(model, F.col("xf")))


def curve_tables(ctx: JobContext, k: int = 4, seed: int = 42, cfg: joint.JointConfig | None = None) -> DataFrame:
    """M8: four predictors scored on the held-out rows; ROC, PR, reliability, lift and threshold points per
    model, and histograms of the entropy and the largest value of the train responsibilities.

    ``ctx`` should hold a two-way split (``JobContext(..., two_way=True)``): fit on train, curves on val.
    Returns one long frame (model, curve, x, y); each curve is computed by the distributed operators
    and the four models are unioned (their number is fixed).
    """
    from ..operators import profiles

    cfg = cfg or joint.JointConfig.preset("yaml")
    base = ctx.frame
    centers, _ = clu.kmeans_fit(ctx.train, "xb", k, seed, 10)
    km = onehot_ids(_assign(base, centers, "xb"), k, "km")
    prm, _, moe = fit_main(ctx, cfg)
    ra = onehot_ids(moe.drop("score"), k, "ra")
    scored = {
        "base_logistic": _newton_scores(base, []),
        "base_plus_kmeans": _newton_scores(km, [f"km_{j}" for j in range(k)]),
        "base_plus_response_aware": _newton_scores(ra, [f"ra_{j}" for j in range(k)]),
        "response_aware_direct": moe,
    }
    parts = []
    for name, s in scored.items():
        hold = s.filter(F.col("split") == "val").select("customer_id", "label", "score")
        pts = profiles.curve_points(hold)
        parts.append(pts.select(F.lit(name).alias("model"), F.lit("roc").alias("curve"), F.col("fpr").alias("x"), F.col("tpr").alias("y")))
        parts.append(pts.select(F.lit(name).alias("model"), F.lit("pr").alias("curve"), F.col("recall").alias("x"), F.col("precision").alias("y")))
        rel = profiles.reliability_table(hold)
        parts.append(rel.select(F.lit(name).alias("model"), F.lit("reliability").alias("curve"), F.col("mean_score").alias("x"), F.col("frac_pos").alias("y")))
        lift = ranking.lift_curve(hold)
        parts.append(lift.select(F.lit(name).alias("model"), F.lit("lift").alias("curve"), F.col("frac").alias("x"), F.col("lift").alias("y")))
        sweep = classify.threshold_sweep(hold)
        for metric in ("f1", "balanced_accuracy", "youden_j"):
            parts.append(sweep.select(F.lit(name).alias("model"), F.lit(f"threshold_{metric}").alias("curve"), F.col("threshold").alias("x"), F.col(metric).alias("y")))
    q = joint.estep_frame(ctx.train, prm, cfg).select("q")
    for curve, value, lo, hi in (("entropy", soft.assignment_entropy, None, None), ("maxprob", soft.assignment_maxprob, 0.0, 1.0)):
        bars = profiles.histogram(q.select(value(F.col("q")).alias("v")), "v", 30, lo, hi)
        parts.append(bars.select(F.lit("responsibilities").alias("model"), F.lit(curve).alias("curve"), F.col("left").alias("x"), F.col("count").cast("double").alias("y")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
