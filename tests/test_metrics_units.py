"""Hand-made frames checked against brute-force NumPy definitions."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import classify, rank, ranking, segment, soft


def _frame(spark, rows, schema="customer_id long, label int, score double"):
    return spark.createDataFrame(rows, schema)


TINY = [(1, 1, 0.9), (2, 0, 0.8), (3, 1, 0.8), (4, 0, 0.7), (5, 1, 0.5), (6, 0, 0.5),
        (7, 0, 0.5), (8, 0, 0.1), (9, 1, None), (10, None, 0.3)]


def test_auc_matches_pairwise(spark):
    df = _frame(spark, TINY)
    valid = [(y, s) for _, y, s in TINY if y is not None and s is not None]
    pos = [s for y, s in valid if y == 1]
    neg = [s for y, s in valid if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p, n in itertools.product(pos, neg)) / (len(pos) * len(neg))
    got = classify.roc_auc(df).first()["auc"]
    assert got == pytest.approx(want)
    both = classify.curve_metrics(df).first()
    assert both["auc"] == pytest.approx(want)


def test_average_precision_stepwise(spark):
    df = _frame(spark, TINY)
    valid = sorted([(s, y) for _, y, s in TINY if y is not None and s is not None], key=lambda t: -t[0])
    P = sum(y for _, y in valid)
    ap, prev_r = 0.0, 0.0
    for thr in sorted({s for s, _ in valid}, reverse=True):
        sel = [y for s, y in valid if s >= thr]
        r = sum(sel) / P
        ap += (r - prev_r) * (sum(sel) / len(sel))
        prev_r = r
    assert classify.average_precision(df).first()["average_precision"] == pytest.approx(ap)
    assert classify.curve_metrics(df).first()["average_precision"] == pytest.approx(ap)


def test_one_class_auc_null(spark):
    df = _frame(spark, [(i, 0, i / 10) for i in range(1, 6)])
    assert classify.roc_auc(df).first()["auc"] is None
    assert classify.average_precision(df).first()["average_precision"] is None
    assert classify.curve_metrics(df).first()["average_precision"] is None
    r = ranking.ranking_summary(df, fractions=[0.2]).first()
    assert r["recall"] is None and r["lift"] is None


def test_ranking_ties_broken_by_key(spark):
    df = _frame(spark, TINY)
    valid = [(c, y, s) for c, y, s in TINY if y is not None and s is not None]
    order = sorted(valid, key=lambda t: (-t[2], t[0]))
    n = len(order)
    for f in (0.2, 0.5, 1.0):
        k = math.ceil(n * f)
        top = order[:k]
        r = ranking.ranking_summary(df, fractions=[f]).first()
        assert r["k"] == k
        assert r["precision"] == pytest.approx(sum(y for _, y, _ in top) / k)
        assert r["positives_in_top"] == sum(y for _, y, _ in top)
        assert r["expected_score_sum_in_top"] == pytest.approx(sum(s for *_, s in top))
    assert ranking.ranking_summary(df, fractions=[1.0]).first()["lift"] == pytest.approx(1.0)


def test_top_frac_validation(spark):
    with pytest.raises(ValueError):
        ranking.ranking_summary(_frame(spark, TINY), fractions=[0.0])
    assert segment.budget_to_k(0, 0.2) == 0
    assert segment.budget_to_k(448, 0.2) == 90


def test_global_rank_with_hot_tie(spark):
    # one score value holds a third of the rows: ties must still be ranked by key across partitions
    rows = [(i, 0, 0.5 if i % 3 == 0 else i / 1000.0) for i in range(1, 601)]
    df = _frame(spark, rows).repartition(7)
    r = rank.with_global_rank(df, [("score", False), ("customer_id", True)], n_parts=8)
    got = {x["customer_id"]: x["rank"] for x in r.collect()}
    want = {c: i + 1 for i, (c, _, _) in enumerate(sorted(rows, key=lambda t: (-t[2], t[0])))}
    assert got == want


def test_running_sums(spark):
    rows = [(i, i % 2, float(i % 17)) for i in range(200)]
    df = _frame(spark, rows)
    out = rank.with_running_sums(df.withColumn("one", F.lit(1)), [("score", True), ("customer_id", True)], ["one", "label"])
    got = sorted((x["score"], x["customer_id"], x["cum_one"], x["cum_label"]) for x in out.collect())
    acc_one = acc_lab = 0
    want = []
    for c, y, s in sorted(rows, key=lambda t: (t[2], t[0])):
        acc_one += 1
        acc_lab += y
        want.append((s, c, acc_one, acc_lab))
    assert got == sorted(want)


def test_threshold_choice_first_best(spark):
    df = _frame(spark, [(1, 1, 0.9), (2, 1, 0.8), (3, 0, 0.3), (4, 0, 0.2)])
    t = classify.choose_threshold_value(df, metric="f1")
    # every threshold in (0.3, 0.8] separates perfectly; the first grid point that does is 0.31
    assert t == pytest.approx(0.31)


def test_ece_bins_left_closed(spark):
    df = _frame(spark, [(1, 1, 0.1), (2, 0, 0.1), (3, 1, 1.0), (4, 0, 0.35)])
    bins = {r["bin"]: r for r in classify.calibration_bins(df).collect()}
    assert set(bins) == {1, 3, 9}  # 0.1 -> bin 1 (left closed), 1.0 -> last bin
    rel = {r["bin"]: r for r in __import__("cohortlens.operators.profiles", fromlist=["x"]).reliability_table(df).collect()}
    assert set(rel) == {0, 3, 9}  # right-closed bins: 0.1 -> bin 0


def test_segment_tables(spark):
    rows = [(i, i % 3, 1 if i % 5 == 0 else 0) for i in range(1, 31)]
    df = spark.createDataFrame(rows, "customer_id long, cluster int, label int")
    t = {r["cluster"]: r for r in segment.segmentation_table(df).collect()}
    for k in range(3):
        members = [y for i, c, y in rows if c == k]
        assert t[k]["size"] == len(members)
        assert t[k]["response_rate"] == pytest.approx(sum(members) / len(members))
    a = segment.campaign_allocation(df, 1.0).first()
    assert a["lift"] == pytest.approx(1.0)
    a2 = segment.campaign_allocation(df, 0.2).first()
    assert a2["n_selected"] == 6 and a2["lift"] >= 1.0


def test_soft_diagnostics(spark):
    df = spark.createDataFrame([([0.7, 0.2, 0.1],), ([0.0, 1.0, 0.0],)], "q array<double>")
    r = df.select(soft.assignment_entropy(F.col("q")).alias("h"), soft.assignment_maxprob(F.col("q")).alias("m")).collect()
    q = np.array([0.7, 0.2, 0.1])
    assert r[0]["h"] == pytest.approx(-(q * np.log(q)).sum())
    assert r[1]["m"] == pytest.approx(1.0, abs=1e-9)


def test_rank_with_many_parts_ties_and_nulls(spark):
    rows = [(i, 0, None if i % 5 == 0 else 0.5) for i in range(1, 901)]  # one value and NULL
    df = spark.createDataFrame(rows, "customer_id long, label int, score double").repartition(3)
    want = {c: i + 1 for i, (c, _, _) in enumerate(sorted(rows, key=lambda t: (t[2] is None, t[0])))}
    for parts in (None, 1, 600):
        r = rank.with_global_rank(df, [("score", False), ("customer_id", True)], n_parts=parts)
        assert {x["customer_id"]: x["rank"] for x in r.collect()} == want
    assert rank.with_global_rank(df.limit(0), ["customer_id"]).count() == 0


def test_rank_within_keeps_rows_without_group(spark):
    rows = [(1, "a", 3.0), (2, None, 1.0), (3, None, 2.0), (4, "a", None), (5, "b", 1.0)]
    df = spark.createDataFrame(rows, "customer_id long, g string, s double")
    out = rank.rank_within(df, "g", [("s", False), ("customer_id", True)])
    assert {(x["customer_id"], x["rank_in_group"]) for x in out.collect()} == {(1, 1), (4, 2), (2, 2), (3, 1), (5, 1)}


def test_softmax_is_computed_once_a_row(spark):
    logits = F.array(*[F.col("id") * k / 10.0 for k in range(4)])
    r = spark.range(1, 4).select(soft.softmax(logits).alias("p"), soft.argmax(logits).alias("a"), soft.logsumexp(logits).alias("l")).collect()
    import numpy as np

    for i, x in enumerate(r, 1):
        z = np.arange(4) * i / 10
        assert np.allclose(x["p"], np.exp(z) / np.exp(z).sum()) and x["a"] == 3 and np.isclose(x["l"], np.log(np.exp(z).sum()))


def _record(pairs, threshold, frac):
    """Metric record of (id, label, score) rows by the definitions, row by row."""
    rows = sorted([(i, y, s) for i, y, s in pairs if y is not None and s is not None and math.isfinite(s)], key=lambda t: (-t[2], t[0]))
    y, p = np.array([r[1] for r in rows], float), np.array([r[2] for r in rows], float)
    s = np.clip(p, 1e-15, 1 - 1e-15)
    pred, n = p >= threshold, len(rows)
    tp, fp, tn, fn = ((pred & (y == 1)).sum(), (pred & (y == 0)).sum(), (~pred & (y == 0)).sum(), (~pred & (y == 1)).sum())
    out = {"support_pos": tp + fn, "support_neg": tn + fp, "accuracy": (tp + tn) / n, "recall": tp / (tp + fn),
           "precision": tp / (tp + fp), "specificity": tn / (tn + fp), "f1": 2 * tp / (2 * tp + fp + fn)}
    out["balanced_accuracy"] = (out["recall"] + out["specificity"]) / 2
    out["auc"] = np.mean([(a > b) + 0.5 * (a == b) for a in s[y == 1] for b in s[y == 0]])
    out["average_precision"] = sum(((s == t) & (y == 1)).sum() / y.sum() * y[s >= t].mean() for t in set(s))
    out["log_loss"] = float(np.mean(-(y * np.log(s) + (1 - y) * np.log(1 - s))))
    out["brier"] = float(np.mean((s - y) ** 2))
    bins = np.minimum((np.clip(p, 1e-12, 1 - 1e-12)[:, None] >= np.linspace(0, 1, 11)[None, 1:-1]).sum(1), 9)
    out["ece"] = sum((bins == b).mean() * abs(y[bins == b].mean() - p[bins == b].mean()) for b in set(bins))
    k = math.ceil(n * frac)
    out["lift_at_frac"] = y[:k].mean() / y.mean()
    return out


@pytest.mark.parametrize("digits", [1, 6])
def test_metric_records_by_group_match_definitions(spark, digits):
    """One decimal: equal scores straddle the cut, and only the smaller ids of them count for the lift."""
    rng = np.random.default_rng(digits)
    rows = [(int(i), ("val", "test", None)[i % 3], int(rng.random() < 0.4), round(float(rng.random()), digits)) for i in rng.permutation(400)]
    rows += [(1000, "val", 1, None), (1001, "test", None, 0.3), (1002, "test", 0, float("nan")), (1003, "test", 1, 0.0), (1004, "test", 0, 1.0)]
    df = spark.createDataFrame(rows, "customer_id long, split string, label int, score double").repartition(7)
    got = {r["split"]: r for r in classify.metric_records(df, threshold=0.5, by="split", top_frac=0.2).collect()}
    assert set(got) == {"val", "test", None}
    for split, r in got.items():
        for name, value in _record([(i, y, s) for i, g, y, s in rows if g == split], 0.5, 0.2).items():
            assert r[name] == pytest.approx(value, rel=1e-9), (split, name)
    whole = classify.metric_records(df, threshold=0.5, top_frac=0.2).first()
    for name, value in _record([(i, y, s) for i, _, y, s in rows], 0.5, 0.2).items():
        assert whole[name] == pytest.approx(value, rel=1e-9), name
    assert whole["lift_at_frac"] == pytest.approx(ranking.lift_at_frac(df).first()["lift_at_frac"])


def test_metric_records_of_no_rows_and_one_class(spark):
    none = classify.metric_records(_frame(spark, []), top_frac=0.2).collect()
    assert len(none) == 1 and none[0]["auc"] is None and none[0]["support_pos"] == 0 and none[0]["lift_at_frac"] is None
    assert classify.metric_records(_frame(spark, []), by="customer_id").collect() == []
    r = classify.metric_records(_frame(spark, [(i, 0, 0.1) for i in range(5)]), top_frac=0.2).first()
    assert r["auc"] is None and r["average_precision"] is None and r["lift_at_frac"] is None and r["specificity"] == 1.0


def test_metric_record_scans_the_rows_once(spark, monkeypatch):
    """The table of scores is the only thing made from the rows; the record is read off it."""
    seen = []
    build = classify.with_running_sums
    monkeypatch.setattr(classify, "with_running_sums", lambda t, *a, **k: seen.append(t) or build(t, *a, **k))
    rec = classify.metric_records(_frame(spark, TINY))
    assert len(seen) == 1
    plan = rec._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and "LocalRelation" not in plan  # nothing but the written table
