"""Registered model fits and experiment jobs (rows-only checks: no SQL equivalent).

Their correctness is held by unit tests (NumPy re-computation on small frames)
and by the exact fixed-parameter queries of :mod:`catalog_models`.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ..operators import cluster as clu, ctp, joint, mixture, profiles, segment
from ..operators.experts import class_weight_balanced, fit_boosted, fit_logistic_mllib
from . import jobs
from .catalog import register, tidy
from .frames import model_frame


def _ctx(spark, sf_dir):
    return jobs.JobContext(spark, sf_dir)


@register("kmeans_segments")
def q_kmeans_segments(spark, sf_dir):
    ctx = _ctx(spark, sf_dir)
    centers, _ = clu.kmeans_fit(ctx.train, "xb", 4, 42, 10)
    test = ctx.split("test").withColumn("cluster", clu.assign_nearest(F.col("xb"), centers))
    return tidy(segment.segmentation_table(test))


@register("gmm_segments")
def q_gmm_segments(spark, sf_dir):
    ctx = _ctx(spark, sf_dir)
    model = mixture.gmm_fit(ctx.train, "xb", 4, 42)
    post = mixture.gmm_posteriors(model, ctx.split("test"), "xb", keep=("customer_id", "label"))
    return tidy(segment.segmentation_table(post))


@register("gmm_posteriors")
def q_gmm_posteriors(spark, sf_dir):
    ctx = _ctx(spark, sf_dir)
    model = mixture.gmm_fit(ctx.train, "xb", 4, 42)
    return tidy(mixture.gmm_posteriors(model, ctx.split("test"), "xb"))


@register("cluster_then_predict_fit")
def q_cluster_then_predict_fit(spark, sf_dir):
    ctx = _ctx(spark, sf_dir)
    centers, models = ctp.fit_cluster_then_predict(ctx.train, 4, 42, 10)
    s = ctp.score_with_clusters(ctp.predict_segments(ctx.split("test"), centers), models)
    return tidy(s.select("customer_id", "cluster", "p", "pred"))


@register("weighted_logistic")
def q_weighted_logistic(spark, sf_dir):
    mf, _ = model_frame(spark, sf_dir)
    train = mf.filter(F.col("split") == "train").withColumns({"features": array_to_vector("xf"), "w": F.lit(1.0)})
    model = fit_logistic_mllib(train, "features", "label", "w", C=1.0)
    coef = [float(model.intercept)] + [float(v) for v in model.coefficients]
    out = mf.filter(F.col("split") == "test").withColumn("features", array_to_vector("xf"))
    return tidy(model.transform(out).select("customer_id", vector_to_array("probability")[1].alias("p")).withColumn("n_coef", F.lit(len(coef))))


@register("boosted_expert")
def q_boosted_expert(spark, sf_dir):
    mf, _ = model_frame(spark, sf_dir)
    train = class_weight_balanced(mf.filter(F.col("split") == "train")).withColumn("features", array_to_vector("xf"))
    model = fit_boosted(train, "features", "label", "w")
    test = mf.filter(F.col("split") == "test").withColumn("features", array_to_vector("xf"))
    return tidy(model.transform(test).select("customer_id", vector_to_array("probability")[1].alias("p")))


def _joint_query(name, **kw):
    @register(name)
    def q(spark, sf_dir):
        ctx = _ctx(spark, sf_dir)
        cfg = joint.JointConfig.preset("yaml", **kw)
        prm, trace, scored = jobs.fit_main(ctx, cfg)
        return tidy(scored.filter(F.col("split") == "test").select("customer_id", "cluster", "score"))

    return q


_joint_query("moe_fit", model_type="ramoe")
_joint_query("joint_constant_fit", model_type="constant_prob")
_joint_query("joint_logistic_fit", model_type="logreg")


@register("elbow_table")
def q_elbow_table(spark, sf_dir):
    return tidy(jobs.elbow_table(spark, sf_dir))


@register("pca_scatter")
def q_pca_scatter(spark, sf_dir):
    mf, _ = model_frame(spark, sf_dir)
    pts, shares = profiles.pca_scatter(mf, "xb")
    explained = [F.lit(v).alias(f"explained{i + 1}") for i, v in enumerate(shares)]
    return tidy(pts.select("customer_id", "pc1", "pc2", *explained))


@register("baseline_table")
def q_baseline_table(spark, sf_dir):
    return jobs.records_frame(spark, jobs.baseline_table(_ctx(spark, sf_dir)))


@register("main_report")
def q_main_report(spark, sf_dir):
    rows, _ = jobs.main_report(_ctx(spark, sf_dir))
    return jobs.records_frame(spark, rows)


@register("downstream_table")
def q_downstream_table(spark, sf_dir):
    return jobs.records_frame(spark, jobs.downstream_table(_ctx(spark, sf_dir)))


@register("ablation_table")
def q_ablation_table(spark, sf_dir):
    return jobs.records_frame(spark, jobs.ablation_table(_ctx(spark, sf_dir)))


@register("curve_tables")
def q_curve_tables(spark, sf_dir):
    return tidy(jobs.curve_tables(jobs.JobContext(spark, sf_dir, two_way=True)))
