"""The ablation grid: settings fitted and evaluated side by side give what each gives alone."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import experts, grid, joint, quality
from cohortlens.plans import jobs


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(3)
    n = 260
    centers = np.array([[0, 0, 0], [4, 4, 0], [0, 4, 4]], float)
    X = centers[np.arange(n) % 3] + rng.normal(size=(n, 3))
    Z = np.hstack([X, rng.normal(size=(n, 1))])
    y = (rng.random(n) < 1 / (1 + np.exp(-(X[:, 0] - X[:, 2])))).astype(int)
    rows = [(i, "train" if i % 4 else "val", int(y[i]), X[i].round(2).tolist(), Z[i].round(2).tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "customer_id long, split string, label int, xb array<double>, xf array<double>").repartition(4).persist()


class Context:
    def __init__(self, frame):
        self.frame, self.train = frame, frame.filter("split = 'train'")

    def split(self, name):
        return self.frame.filter(F.col("split") == name)


def test_grid_equals_single_fits(frame):
    ctx = Context(frame)
    kw = {"max_iter": 3, "kmeans_n_init": 2}
    rows = jobs.ablation_table(ctx, ks=(2, 3), lambdas=(0.0, 1.0), temps=(0.5, 2.0), **kw)
    assert [(r["n_clusters_cfg"], r["lambda_"], r["temperature"]) for r in rows] == [(k, lam, t) for k in (2, 3) for lam in (0.0, 1.0) for t in (0.5, 2.0)]
    for at in (1, 6):
        row = rows[at]
        cfg = joint.JointConfig(n_clusters=row["n_clusters_cfg"], lambda_=row["lambda_"], temperature=row["temperature"], **kw)
        prm, trace = joint.fit_joint(ctx.train, cfg)
        part = ctx.split("val").withColumns({"score": joint.predict_response(F.col("xb"), F.col("xf"), prm, cfg), "cluster": joint.predict_clusters(F.col("xb"), prm, cfg)})
        want = jobs.cluster_report(part, "xb")
        want.update(jobs.evaluate(part, 0.5), n_iter=len(trace["change_ratio"]))
        for name, value in want.items():
            if isinstance(value, dict):
                assert row[name] == pytest.approx(value, rel=1e-6)
            else:
                assert row[name] == pytest.approx(value, rel=1e-5, abs=1e-8), name


def test_settings_that_cannot_share_are_refused(frame):
    for cfgs in ([], [joint.JointConfig(model_type="logreg")], [joint.JointConfig(logreg_C=1.0), joint.JointConfig(logreg_C=2.0)]):
        with pytest.raises(ValueError):
            grid.fit_grid(frame, cfgs)


def test_lift_cuts_through_ties_by_id(spark):
    rows = [(i, float(i % 3 == 0), [0.5 if i < 15 else 0.25, 0.75]) for i in range(20)]
    scored = spark.createDataFrame(rows, "customer_id long, label double, scores array<double>").repartition(3)
    got = grid._order_metrics(scored, 2, 0.2, "customer_id")
    base = 7 / 20
    assert [r["lift_top20"] for r in got] == pytest.approx([2 / 4 / base, 2 / 4 / base])  # ids 0 to 3: two positives
    assert got[1]["auc"] == 0.5 and got[1]["average_precision"] == pytest.approx(base)


def test_vectors_add_up_in_parts(spark, monkeypatch):
    df = spark.range(1000).repartition(7).select(F.col("id").cast("double").alias("v"))
    length = 3 * experts.VECTOR_PART + 5
    got = experts.sum_vectors(df, lambda rows: np.full(length, rows["v"].sum()), length)
    assert got.shape == (length,) and np.all(got == 999 * 500)
    assert not experts.sum_vectors(df.limit(0), lambda rows: np.ones(length), length).any()


def _chunk(n=700, seed=2):
    g = np.random.default_rng(seed)
    return g.normal(size=(n, 3)) + 5.0, g.normal(size=(n, 4)), (g.random(n) < 0.3).astype(float)


def _settings():
    g, out = np.random.default_rng(4), []
    for k, kw in ((2, {"lambda_": 0.0}), (3, {"temperature": 0.5}), (2, {"covariance_type": "spherical"}), (3, {"gating_type": "soft_kmeans", "lambda_": 3.0})):
        own = [experts.Expert(coef=g.normal(size=5)) for _ in range(k - 1)] + [experts.Expert(const=0.2)]
        prm = joint.JointParams(pi=np.full(k, 1 / k), mu=g.normal(size=(k, 3)) + 5.0, var=g.random((k, 3)) + 0.5, experts=own)
        out.append((prm, joint.JointConfig(n_clusters=k, **kw)))
    return out


def test_components_side_by_side_give_each_setting_its_own_responsibilities():
    X, Z, y = _chunk()
    prms, cfgs = zip(*_settings())
    rows = grid._Sorted({"x": X, "z": Z, "y": pd.Series(y)}, "x", "z", "y", np.full(3, 5.0))
    side = grid._Beside(list(prms), list(cfgs), np.full(3, 5.0))
    eta = side.eta(rows)
    Q = side.logits(rows, eta, grid._softplus(eta)[1])
    order, loglik = np.argsort(y, kind="stable"), None
    first = [grid._largest(Q[a:b]) for a, b in side.segments()]
    loglik = grid._to_shares(Q, side)
    for i, ((a, b), prm, cfg) in enumerate(zip(side.segments(), prms, cfgs)):
        q, lse = joint.estep_np(X[order], Z[order], y[order], prm, cfg)
        np.testing.assert_allclose(Q[a:b].T, q, atol=1e-9)
        assert loglik[i] == pytest.approx(lse.sum()) and np.array_equal(first[i], q.argmax(1))


def test_sums_of_many_experts_are_those_of_each(monkeypatch):
    X, Z, y = _chunk()
    g = np.random.default_rng(6)
    W, B = g.random((5, len(y))), g.normal(size=(5, 5))
    monkeypatch.setattr(grid, "PRODUCT_ROWS", 100)
    rows = grid._Sorted({"x": X, "z": Z, "y": pd.Series(y)}, "x", "z", "y", np.zeros(3))
    eta = B @ rows.Z1.T
    small, soft = grid._softplus(eta)
    order = np.argsort(y, kind="stable")
    got = grid._expert_sums(rows, W[:, order], eta, grid._sigmoid(eta, small), soft)
    np.testing.assert_allclose(got, experts.expert_stats_np(Z, y, W.T, B), rtol=1e-9, atol=1e-9)


def test_silhouettes_of_settings_send_a_row_to_a_bounded_number_of_blocks(spark, monkeypatch):
    g = np.random.default_rng(8)
    X, Z = g.normal(size=(150, 3)), np.column_stack([g.integers(0, 2, 150), g.integers(0, 3, 150)])
    df = spark.createDataFrame([(i, X[i].tolist(), Z[i].tolist()) for i in range(150)], "customer_id long, x array<double>, clusters array<int>").repartition(3)
    sizes, sent = [np.bincount(Z[:, s], minlength=k).astype(float) for s, k in enumerate((2, 3))], []
    sequence = F.sequence
    monkeypatch.setattr(F, "sequence", lambda a, b, *c: sent.append(b) or sequence(a, b, *c))
    got = grid.silhouettes(df, [2, 3], sizes, "customer_id", block_rows=2)
    assert "23" in str(sent[0])  # 24 blocks, not one for each two rows
    for s in range(2):
        one = df.select("customer_id", "x", F.col("clusters")[s].alias("cluster"))
        want = quality.silhouette_euclidean_rows(one, "x", "cluster", "customer_id").agg(F.avg("silhouette")).first()[0]
        assert got[s] == pytest.approx(want, abs=1e-12)
