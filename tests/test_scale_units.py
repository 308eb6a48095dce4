"""Steps that many passes share: dealing of rows, fits side by side, kernels, blocks of the silhouette."""

import re
from types import SimpleNamespace

import numpy as np
from pyspark.sql import functions as F

from cohortlens import shared
from cohortlens.operators import classify, cluster, experts, joint, quality, split
from cohortlens.plans import frames


def test_dealt_uses_every_core_and_bounds_a_part(spark, monkeypatch):
    one = spark.range(0, 20_000, 1, 1)
    sizes = [r["n"] for r in shared.dealt(one).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and sum(sizes) == 20_000 and max(sizes) - min(sizes) <= 8
    monkeypatch.setattr(shared, "PART_ROWS", (100, 500))
    assert shared.dealt(one).rdd.getNumPartitions() == 40
    assert shared.dealt(one.limit(50)).rdd.getNumPartitions() == 1


def test_no_part_of_a_model_frame_grows_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(shared, "PART_ROWS", (100, 500))
    number = F.col("id").cast("double")
    columns = [number.alias(n) for n in ("recency", "frequency", "monetary")]
    one = spark.range(0, 20_000, 1, 1).select(F.col("id").alias("customer_id"), F.lit("train").alias("split"), F.lit(0).alias("label"), *columns)
    names = SimpleNamespace(behavior_feature_names=["recency"], all_feature_names=["recency", "frequency"])
    monkeypatch.setattr(frames, "transformed", lambda *a, **k: (one, names))
    frame, _ = frames.model_frame(spark, "")
    try:
        parts = frame.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.sum("customer_id").alias("ids")).collect()
    finally:
        frame.unpersist()
    assert len(parts) == 40 and max(r["n"] for r in parts) <= 540
    assert sum(r["n"] for r in parts) == 20_000 and sum(r["ids"] for r in parts) == 20_000 * 19_999 // 2


def _points(spark, n=240):
    g = np.random.default_rng(3)
    X = g.normal(size=(n, 3)) + 4.0 * g.integers(0, 4, size=(n, 1))
    y = g.integers(0, 2, size=n)
    return X, y, spark.createDataFrame([(i, int(a), x.tolist()) for i, (a, x) in enumerate(zip(y, X))], "customer_id long, label int, xb array<double>")


def test_kmeans_side_by_side_gives_the_single_fits_in_fewer_passes(spark, monkeypatch):
    _, _, df = _points(spark)
    alone = [cluster.kmeans_fit(df, "xb", k, 7, 3) for k in (2, 3, 5)]
    passes, add = [], cluster.sum_vectors
    monkeypatch.setattr(cluster, "sum_vectors", lambda *a: passes.append(1) or add(*a))
    together = cluster.kmeans_fits(df, "xb", (2, 3, 5), 7, 3)
    side_by_side = len(passes)
    for (c, cost), (c1, cost1) in zip(together, alone):
        np.testing.assert_allclose(c, c1, atol=1e-9)
        assert abs(cost - cost1) <= 1e-9 * cost1
    passes.clear()
    most = 0
    for k in (2, 3, 5):
        before = len(passes)
        cluster.kmeans_fit(df, "xb", k, 7, 3)
        most = max(most, len(passes) - before)
    assert side_by_side == most


def test_constant_fit_takes_one_pass_of_sums_an_iteration(spark, monkeypatch):
    X, y, df = _points(spark)
    cfg = joint.JointConfig(model_type="constant_prob", n_clusters=3, gamma=0.3, max_iter=4, tol=0.0)
    start = cluster.kmeans_fit(df, "xb", 3, cfg.random_state, cfg.kmeans_n_init)[0]
    z = ((X[:, None] - start[None]) ** 2).sum(2).argmin(1)
    p = np.array([(y[z == k].sum() + 1) / ((z == k).sum() + 2) for k in range(3)])
    c, changes = start, []
    for _ in range(4):
        new = joint.constant_cost_np(X, y.astype(float), c, p, cfg).argmin(1)
        changes.append((new != z).mean())
        c, z = np.array([X[new == k].mean(0) for k in range(3)]), new
        p = np.array([(y[z == k].sum() + 1) / ((z == k).sum() + 2) for k in range(3)])
    calls, add = [], joint.sum_vectors
    monkeypatch.setattr(joint, "sum_vectors", lambda *a: calls.append(1) or add(*a))
    prm = joint._fit_constant(df, cfg, start, float(y.mean()), "xb", "label", {"change_ratio": []})
    np.testing.assert_allclose(prm.mu, c, atol=1e-9)
    np.testing.assert_allclose(prm.cluster_probs, p, atol=1e-12)
    assert len(calls) == 4
    costs = df.select(joint.response_aware_cost(F.col("xb"), F.col("label"), c, p, cfg.lambda_, cfg.gamma).alias("c")).collect()
    np.testing.assert_allclose([r["c"] for r in costs], joint.constant_cost_np(X, y.astype(float), c, p, cfg), atol=1e-9)


def test_many_experts_share_their_products():
    g = np.random.default_rng(5)
    X, y, W, B = g.normal(size=(5000, 4)), g.integers(0, 2, 5000).astype(float), g.random((5000, 20)), g.normal(size=(20, 5))
    assert len(B) >= experts.MANY_EXPERTS
    single = np.concatenate([experts.expert_stats_np(X, y, W[:, i:i + 1], B[i:i + 1]) for i in range(20)])
    np.testing.assert_allclose(experts.expert_stats_np(X, y, W, B), single, rtol=1e-9, atol=1e-9)


def test_silhouette_sends_a_row_to_a_bounded_number_of_blocks(spark):
    X, y, df = _points(spark, 120)
    out = quality.silhouette_euclidean_rows(df, "xb", "label", "customer_id", block_rows=2)
    last = max(int(n) for n in re.findall(r"sequence\(0, (\d+)", out._jdf.queryExecution().analyzed().toString()))
    assert last == quality.MEETINGS - 1
    d = np.sqrt(((X[:, None] - X[None]) ** 2).sum(2))
    n = np.bincount(y)
    a = np.array([d[i, y == y[i]].sum() / (n[y[i]] - 1) for i in range(120)])
    b = np.array([d[i, y != y[i]].mean() for i in range(120)])
    got = {r["customer_id"]: r["silhouette"] for r in out.collect()}
    np.testing.assert_allclose([got[i] for i in range(120)], (b - a) / np.maximum(a, b), atol=1e-9)


def test_splits_send_no_class_to_one_task(spark):
    rows = spark.range(0, 4000).select(F.col("id").alias("customer_id"), (F.col("id") % 10 == 0).cast("int").alias("label"))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        out = split.assign_splits(rows)
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        table = {(r["split"], r["label"]): r["n"] for r in out.groupBy("split", "label").agg(F.count("*").alias("n")).collect()}
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert max(sizes) < 2000  # 3,600 rows are of one class
    assert table == {("test", 0): 720, ("test", 1): 80, ("val", 0): 360, ("val", 1): 40, ("train", 0): 2520, ("train", 1): 280}


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_score_is_binned_from_one_computation_a_row(spark):
    scored = spark.createDataFrame([(0.09,), (0.25,), (0.3,), (None,)], "z double").select(F.sqrt("z").alias("p"))
    for closed, bins in ((False, [1, 2, 2, 0]), (True, [0, 1, 2, 0])):
        out = scored.select(classify.bin_index(F.col("p"), [0.3, 0.5, 0.9], closed).alias("b"))
        assert re.search(r"array\(SQRT\(", _optimized(out))  # the element of an array of one, not an operand beside each edge
        assert [r["b"] for r in out.collect()] == bins


def test_a_predicted_response_is_computed_once_a_row(spark):
    _, _, df = _points(spark, 20)
    model = lambda w: experts.Expert(coef=np.array([w, 0.5, 0.5, 0.5]))
    prm = joint.JointParams(pi=np.array([0.5, 0.5]), mu=np.zeros((2, 3)), var=np.ones((2, 3)), experts=[model(0.1234567), model(-1.0)],
                            global_expert=model(0.0), global_rate=0.25)
    out = df.select(joint.predict_response(F.col("xb"), F.col("xb"), prm, joint.JointConfig(n_clusters=2)).alias("p"))
    assert _optimized(out).count("0.1234567") == 1
    odd = spark.createDataFrame([([float("nan")] * 3,)], "xb array<double>")
    assert odd.select(joint.predict_response(F.col("xb"), F.col("xb"), prm, joint.JointConfig(n_clusters=2))).first()[0] == 0.25


def test_passes_of_a_fit_share_one_conversion_of_the_rows(spark, monkeypatch):
    X, _, df = _points(spark)
    made, arrow = [], type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, *a, **k: made.append(1) or arrow(self, *a, **k))
    passes, add = [], cluster.sum_vectors
    monkeypatch.setattr(cluster, "sum_vectors", lambda *a: passes.append(1) or add(*a))
    few = cluster.kmeans_fit(df, "xb", 4, 7, 3, max_iter=1)
    short = (len(made), len(passes))
    made.clear(), passes.clear()
    cluster.kmeans_fit(df, "xb", 4, 7, 3, tol=0.0)
    assert len(passes) > short[1] and len(made) == short[0] and few[0].shape == (4, 3)


def test_sums_over_kept_chunks(spark, monkeypatch):
    df = spark.range(5000).repartition(3).select(F.col("id").cast("double").alias("v"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("x"))
    length = experts.VECTOR_PART + 3

    def kernel(rows):
        assert len(rows) <= experts.CHUNK_ROWS
        return np.r_[rows["v"].sum(), rows["x"].sum(0), np.ones(length - 3)]

    for direct in (experts.DIRECT, 0):
        monkeypatch.setattr(experts, "DIRECT", direct)
        with experts.kept(df) as rows:
            got = experts.sum_vectors(rows, kernel, length)
        assert got[:3].tolist() == [4999 * 2500, 4999 * 2500, 5000] and got.shape == (length,) and len(set(got[3:])) == 1
    with experts.kept(df.limit(0)) as rows:
        assert not experts.sum_vectors(rows, kernel, length).any()


def test_distance_to_the_nearest_center_is_exact_near_it():
    g = np.random.default_rng(1)
    X = g.normal(size=(500, 4)) + 1e4
    C = np.concatenate([X[:3], X[3:5] + 1e-7])
    near = cluster._to_nearest(X, C)
    want = ((X[:, None] - C[None]) ** 2).sum(2).min(1)
    assert np.all(near[:3] == 0) and np.all(near[3:] > 0)
    np.testing.assert_allclose(near, want, rtol=1e-6)


def test_newton_stops_where_the_next_step_is_below_the_tolerance(spark):
    X, y, df = _points(spark)
    df, steps = df.withColumn("xf", F.col("xb")), []

    def stats(rows, cols, B):
        steps.append(B[0].copy())
        return experts._stats_pass(rows, lambda r: np.ones((len(r), 1)), cols, B, "xf", "label")

    fitted = experts.fit_experts(df, None, 1, 3, balance=None, stats=stats)[0].coef
    X1 = np.hstack([np.ones((len(X), 1)), X])
    g = X1.T @ (1 / (1 + np.exp(-X1 @ fitted)) - y) + np.r_[0.0, fitted[1:]]
    assert np.abs(g).max() < 1e-6
    assert np.abs(fitted - steps[-1]).max() > 1e-9  # the last step was taken without a pass after it
