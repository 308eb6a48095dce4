"""Model operators against NumPy re-computations on small frames."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from cohortlens.operators import cluster as clu, experts, joint, quality


def _blobs(spark, n=240, seed=0):
    rng = np.random.default_rng(seed)
    centers = np.array([[0, 0, 0], [4, 4, 0], [0, 4, 4]], float)
    lab = np.arange(n) % 3
    X = centers[lab] + rng.normal(size=(n, 3))
    y = (rng.random(n) < 1 / (1 + np.exp(-(X[:, 0] - X[:, 2])))).astype(int)
    rows = [(i, int(lab[i]), int(y[i]), [float(v) for v in X[i]]) for i in range(n)]
    return spark.createDataFrame(rows, "customer_id long, cluster int, label int, x array<double>"), X, lab, y


def test_fused_logistic_matches_mllib(spark):
    df, X, lab, y = _blobs(spark)
    df = df.withColumn("xf", F.col("x")).persist()
    fitted = experts.fit_experts(df, lambda pdf: np.ones((len(pdf), 1)), 1, 3, C=1.0, balance=None)[0]
    m = experts.fit_logistic_mllib(df.withColumns({"features": array_to_vector("x"), "w": F.lit(1.0)}), "features", "label", "w")
    ml = np.r_[m.intercept, m.coefficients.toArray()]
    assert np.allclose(fitted.coef, ml, atol=1e-4)
    # closed-form check of the optimality condition: C * X1'(p - y) + [0, beta] = 0
    X1 = np.hstack([np.ones((len(X), 1)), X])
    p = 1 / (1 + np.exp(-X1 @ fitted.coef))
    g = X1.T @ (p - y) + np.r_[0.0, fitted.coef[1:]]
    assert np.abs(g).max() < 1e-5


def test_expert_guards(spark):
    df, X, lab, y = _blobs(spark, 60)
    df = df.withColumn("xf", F.col("x"))
    zero = experts.fit_experts(df, lambda pdf: np.zeros((len(pdf), 1)), 1, 3, fallback_p=0.3)[0]
    assert zero.coef is None and zero.const == 0.3
    only_neg = experts.fit_experts(df, lambda pdf: (pdf["label"].to_numpy() == 0).astype(float)[:, None], 1, 3)[0]
    assert only_neg.coef is None and only_neg.const == 0.0
    f_neg, f_pos = experts.balance_factors(np.array([2.0]), np.array([6.0]), "mass")
    assert f_pos[0] == 3.0 and f_neg[0] == 1.0


def test_silhouettes_and_indices(spark):
    df, X, lab, y = _blobs(spark, 90)
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(2))
    D2 = D ** 2

    def sil(M):
        s = []
        for i in range(len(X)):
            own = lab == lab[i]
            a = M[i, own].sum() / (own.sum() - 1)
            b = min(M[i, lab == k].mean() for k in set(lab) if k != lab[i])
            s.append((b - a) / max(a, b))
        return float(np.mean(s))

    got = quality.silhouette_euclidean_rows(df.withColumnRenamed("customer_id", "id"), block_rows=40).agg(F.avg("silhouette")).first()[0]
    assert got == pytest.approx(sil(D), abs=1e-9)
    got2 = quality.silhouette_squared(df.withColumnRenamed("customer_id", "id")).first()[0]
    assert got2 == pytest.approx(sil(D2), abs=1e-9)
    C = np.array([X[lab == k].mean(0) for k in range(3)])
    g = X.mean(0)
    trB = sum((lab == k).sum() * ((C[k] - g) ** 2).sum() for k in range(3))
    trW = sum(((X[lab == k] - C[k]) ** 2).sum() for k in range(3))
    ch = (trB / 2) / (trW / (len(X) - 3))
    assert quality.calinski_harabasz(df).first()[0] == pytest.approx(ch, rel=1e-9)
    s = np.array([np.sqrt(((X[lab == k] - C[k]) ** 2).sum(1)).mean() for k in range(3)])
    cd = np.sqrt(((C[:, None] - C[None]) ** 2).sum(2))
    db = np.mean([max((s[i] + s[j]) / cd[i, j] for j in range(3) if j != i) for i in range(3)])
    assert quality.davies_bouldin(df).first()[0] == pytest.approx(db, rel=1e-9)


def test_kmeans_and_lloyd(spark):
    df, X, lab, y = _blobs(spark)
    centers, cost = clu.kmeans_fit(df, "x", 3, 42, 3)
    assert cost == pytest.approx(clu.inertia(df, centers, "x").first()[0], rel=1e-6)
    start = clu.md5_start(df, 3, "x")
    c1 = clu.lloyd_step(df, start, "x")
    z = np.argmin(((X[:, None] - start[None]) ** 2).sum(2), 1)
    want = np.array([X[z == k].mean(0) if (z == k).any() else start[k] for k in range(3)])
    assert np.allclose(c1, want)
    i0 = clu.inertia(df, start, "x").first()[0]
    i1 = clu.inertia(df, c1, "x").first()[0]
    assert i1 <= i0 + 1e-9


def test_joint_models_fit(spark):
    df, X, lab, y = _blobs(spark, 300)
    train = df.select("customer_id", "label", F.col("x").alias("xb"), F.col("x").alias("xf")).persist()
    for mt in ("constant_prob", "logreg", "ramoe"):
        cfg = joint.JointConfig(n_clusters=3, model_type=mt, kmeans_n_init=2, max_iter=4)
        prm, trace = joint.fit_joint(train, cfg)
        sc = train.select(joint.predict_response(F.col("xb"), F.col("xf"), prm, cfg).alias("p"),
                          joint.predict_clusters(F.col("xb"), prm, cfg).alias("k")).collect()
        p = np.array([r["p"] for r in sc])
        assert np.all((p >= 1e-7) & (p <= 1 - 1e-7))
        assert {r["k"] for r in sc} <= {0, 1, 2}
        if mt != "constant_prob":
            order = np.argsort(p)
            ranks = np.empty(len(p)); ranks[order] = np.arange(1, len(p) + 1)
            P = y.sum(); N = len(y) - P
            assert (ranks[y == 1].sum() - P * (P + 1) / 2) / (P * N) > 0.7


def test_exact_quantiles_match_numpy(spark):
    from cohortlens.operators.quantile import exact_quantiles, grouped_quantiles

    rng = np.random.default_rng(5)
    rows = [(int(i), float(v), None if i % 7 == 0 else float(w)) for i, (v, w) in enumerate(zip(rng.choice([0.0, 1.0, 2.5], 500, p=[0.6, 0.3, 0.1]), rng.normal(size=500)))]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    qs = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    got = exact_quantiles(df, {"a": F.col("a"), "b": F.col("b"), "none": F.lit(None)}, qs)
    assert np.allclose(got["a"], np.quantile([r[1] for r in rows], qs)) and got["none"] is None
    assert np.allclose(got["b"], np.quantile([r[2] for r in rows if r[2] is not None], qs))
    by = grouped_quantiles(df.withColumn("g", F.col("id") % 3), ["g"], {"b": F.col("b"), "a": F.col("a")}, [0.5])
    for g in range(3):
        assert np.isclose(by[(g,)]["b"][0], np.median([r[2] for r in rows if r[2] is not None and r[0] % 3 == g]))
        assert np.isclose(by[(g,)]["a"][0], np.median([r[1] for r in rows if r[0] % 3 == g]))


def test_quantiles_of_wide_bands_and_sketches_beyond_their_error(spark, monkeypatch):
    """Bands too large to gather are searched as a table; bands that miss their place are widened."""
    from cohortlens.operators import quantile

    rng = np.random.default_rng(5)
    v = np.where(rng.random(30000) < 0.4, 7.0, np.round(rng.normal(7.0, 3.0, 30000), 3))
    df = spark.createDataFrame([(i % 2, float(x)) for i, x in enumerate(v)], "g int, v double").repartition(5)
    df = df.unionAll(spark.createDataFrame([(None, 1.5), (None, 2.5), (0, None), (1, float("nan"))], "g int, v double"))
    qs = [0.0, 0.01, 0.35, 0.5, 0.9137, 1.0]

    def same():
        got = quantile.grouped_quantiles(df, ["g"], {"v": F.col("v")}, qs)
        for g in range(2):
            assert got[(g,)]["v"] == pytest.approx(np.quantile(v[g::2], qs).tolist(), rel=1e-12)
        assert got[(None,)]["v"] == pytest.approx(np.quantile([1.5, 2.5], qs).tolist())

    same()
    monkeypatch.setattr(quantile, "GATHERED", 300)
    same()
    monkeypatch.setattr(quantile, "GATHERED", 100_000)
    monkeypatch.setattr(quantile, "ACCURACY", 20)
    select = quantile._select
    monkeypatch.setattr(quantile, "_select", lambda rows, k, c, near, asked, margin=0.0005: select(rows, k, c, near, asked, margin))
    same()


def test_quantile_plan_has_no_sort_and_no_nested_loop(spark):
    from cohortlens.operators import quantile

    rows = spark.range(1000).select(*quantile._values([F.col("id"), F.col("id") * 2]))
    numbered = quantile._numbered(rows, [], [()])
    bands = [(0, 0, 0, 10.0, 20.0, (15,), 1000), (0, 1, 0, 10.0, 20.0, (7,), 1000)]
    scan = quantile._scan(numbered, bands, [True, False])
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "rangepartitioning" not in plan and plan.count("MapInArrow") == 1
    got = {r["band"]: r for r in scan.collect()}
    assert (got[0]["below"], got[0]["at_lo"], got[0]["at_hi"], sorted(got[0]["inside"])) == (10, 1, 1, [float(x) for x in range(11, 20)])
    assert (got[1]["below"], got[1]["size"], got[1]["inside"], got[1]["prev"], got[1]["next"]) == (5, 4, [], 8.0, 22.0)



def test_kmeans_restarts_find_planted_centers(spark):
    from cohortlens.operators import cluster as clu

    rng = np.random.default_rng(6)
    true = np.array([[0.0, 0.0], [10.0, 0.0], [0.0, 10.0], [10.0, 10.0]])
    X = np.concatenate([c + rng.normal(0, 0.5, (200, 2)) for c in true])
    df = spark.createDataFrame([(x.tolist(),) for x in X], "x array<double>").repartition(5)
    centers, cost = clu.kmeans_fit(df, "x", 4, 1, 8)
    assert np.allclose(centers, true[clu.renumber(true)], atol=0.2)
    z = ((X[:, None, :] - centers[None]) ** 2).sum(2)
    assert np.isclose(cost, z.min(1).sum())


def test_silhouette_of_every_row_in_blocks(spark):
    from cohortlens.operators import quality

    rng = np.random.default_rng(7)
    X = rng.normal(size=(700, 3)) + np.repeat(np.arange(7), 100)[:, None]
    c = np.repeat(np.arange(7), 100)
    c[0] = 9  # alone
    df = spark.createDataFrame([(int(i), int(k), x.tolist()) for i, (k, x) in enumerate(zip(c, X))], "id long, cluster long, x array<double>")
    got = {r["id"]: r["silhouette"] for r in quality.silhouette_euclidean_rows(df, block_rows=90).collect()}
    D = np.sqrt(((X[:, None, :] - X[None]) ** 2).sum(2))
    for i in range(700):
        own = c == c[i]
        if own.sum() == 1:
            want = 0.0
        else:
            a = D[i, own].sum() / (own.sum() - 1)
            b = min(D[i, c == k].mean() for k in set(c) - {c[i]})
            want = (b - a) / max(a, b)
        assert abs(got[i] - want) < 1e-9
    assert quality.silhouette_sampled(df, 100).columns == ["silhouette_of_sample"]


def test_joint_options_that_are_not_supported_raise():
    from cohortlens.operators.joint import JointConfig

    for bad in ({"expert_type": "boosted"}, {"temperature": 0.0}, {"budget_reweight_alpha": -1.0}, {"budget_top_frac": 0.0}):
        with pytest.raises(ValueError):
            JointConfig(**bad)


def test_boosted_expert_stops_on_the_rows_kept_out(spark):
    df, X, lab, y = _blobs(spark, 400)
    df = experts.class_weight_balanced(df).withColumn("features", array_to_vector("x"))
    model = experts.fit_boosted(df, "features", weight_col="w", rounds=60)
    assert 1 <= model.getNumTrees <= 60
    p = np.array([r[0] for r in model.transform(df).orderBy("customer_id").select(vector_to_array("probability")[1]).collect()])
    pos, neg = p[y == 1], p[y == 0]
    assert ((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :])).mean() > 0.75
    assert experts.fit_boosted(df, "features", rounds=3, key=None).getNumTrees == 3


def test_kmeans_starts_see_every_row(spark):
    """Twelve far rows of 60,000 get a center of their own; a hot third of equal rows and two orders of rows change nothing."""
    rng = np.random.default_rng(9)
    X = np.concatenate([np.zeros((20000, 2)), rng.normal(6.0, 1.0, (20000, 2)), rng.normal(-6.0, 1.0, (19988, 2)), rng.normal(900.0, 0.5, (12, 2))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(X)], "customer_id long, x array<double>")
    for parts, n_init in ((3, 1), (11, 4)):
        centers, cost = clu.kmeans_fit(df.repartition(parts), "x", 4, 7, n_init)
        assert np.allclose(centers[-1], X[-12:].mean(0))
        labels = ((X[:, None, :] - centers[None]) ** 2).sum(2)
        assert cost == pytest.approx(labels.min(1).sum(), rel=1e-6)
    assert np.allclose(centers[[0, 1, 2]], [X[40000:59988].mean(0), [0, 0], X[20000:40000].mean(0)], atol=0.05)
    a, b = (clu._starts(df.repartition(p).select("x", F.xxhash64("customer_id", "x").alias("h")), 4, 7, 3) for p in (2, 9))
    assert np.allclose(a, b)


def test_kmeans_draw_is_in_proportion_to_squared_distance(spark):
    df = spark.range(40000).select(F.array((F.col("id") % 2 + 1).cast("double")).alias("x"), F.xxhash64("id").alias("h"))
    got = clu._draw(df, [np.zeros((1, 1))], 2000, 1)[0][:, 0]
    assert len(got) == 2000 and abs((got == 2.0).mean() - 0.8) < 0.04  # 4 : 1
    none = clu._draw(df, [np.array([[1.0], [2.0]])], 5, 1)[0]
    assert len(none) == 0


def test_kmeans_of_few_and_no_rows(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(6)], "customer_id long, x array<double>")
    centers, cost = clu.kmeans_fit(same, "x", 3, 1, 2)
    assert centers.tolist() == [[1.0, 2.0]] * 3 and cost == 0.0
    with pytest.raises(ValueError):
        clu.kmeans_fit(same.limit(0), "x", 3, 1, 2)
