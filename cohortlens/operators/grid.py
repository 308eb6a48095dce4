"""Many settings of the mixture of experts at once: one axis of settings through the fit and its evaluation.

``fit_grid`` runs the EM of :mod:`joint` for all settings side by side. Settings of one K share the K-Means
start and its experts; the global expert does not depend on the setting and is fitted once. A pass over
the rows carries the parameters of every live setting and returns their statistics as one vector, and the
Newton passes fit the experts of all live settings together. A setting leaves when it has converged. Inside
a pass the components of all settings lie side by side, so densities, moments and Hessians are matrix products.

``evaluate_grid`` scores all settings in one pass, writes the scores, and reads every metric of the record
off a fixed number of passes, whatever the number of settings. The distances of the Euclidean silhouette
do not depend on the setting, so one pass over pairs of blocks serves all of them.
"""

from __future__ import annotations

import math
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import written
from . import joint
from .classify import ECE_EPS, PROB_EPS, uniform_edges
from .cluster import kmeans_fits
from .experts import fit_experts, kept, stats_length, sum_vectors
from .quality import BLOCK_ROWS, MEETINGS, MOST_ROWS, distances_from, distances_to, tiles, valid_rows
from .rank import with_global_rank, with_running_sums

ECE_BINS = 10
PRODUCT_ROWS = 512  # rows whose products of two features are formed at once
#: What all settings of a grid have in common, since their fits share starts and passes.
SHARED = ("random_state", "kmeans_n_init", "expert_class_weight", "logreg_C", "use_global_expert", "max_iter", "covariance_reg")


def _checked(cfgs: list[joint.JointConfig]) -> joint.JointConfig:
    if not cfgs:
        raise ValueError("the grid has no settings")
    if any(c.model_type != "ramoe" or c.budget_reweight_alpha > 0 for c in cfgs):
        raise ValueError("a grid holds mixtures of experts ('ramoe') without budget weights; fit others one by one")
    differ = [f for f in SHARED if len({getattr(c, f) for c in cfgs}) > 1]
    if differ:
        raise ValueError(f"settings of a grid share {differ}")
    return cfgs[0]


def _coefs(experts, D: int) -> np.ndarray:
    return np.stack([e.coef if e.coef is not None else np.zeros(D + 1) for e in experts])


class _Beside:
    """The components of several settings, one after the other, as matrices for products with the rows.

    Rows and means are taken from ``origin``, a point among the means, so that products lose no digits far from zero.
    """

    def __init__(self, prms: list, cfgs: list, origin: np.ndarray):
        self.starts, self.origin = np.cumsum([0, *(len(p.pi) for p in prms)]), origin
        scale, add = [], []
        for p, c in zip(prms, cfgs):
            d, log_pi = p.mu.shape[1], np.log(np.clip(p.pi, joint.LOG_EPS, 1.0))
            if c.gating_type == "soft_kmeans":
                scale.append(np.ones_like(p.mu))
                add.append(log_pi)
            elif c.covariance_type == "diag":
                scale.append(0.5 / p.var)
                add.append(log_pi - 0.5 * (d * math.log(2 * math.pi) + np.log(p.var).sum(1)))
            else:
                v = p.var.mean(1)
                scale.append(np.repeat(0.5 / v[:, None], d, 1))
                add.append(log_pi - 0.5 * d * (math.log(2 * math.pi) + np.log(v)))
        s, self.mu = np.concatenate(scale), np.concatenate([p.mu for p in prms]) - origin
        self.gating, self.add = np.hstack([2 * s * self.mu, -s]), np.concatenate(add) - (s * self.mu ** 2).sum(1)
        experts = [e for p in prms for e in p.experts]
        width = next((len(e.coef) for e in experts if e.coef is not None), 1)
        self.constant = np.array([e.coef is None for e in experts])
        self.coefs = np.zeros((len(experts), width))
        for row, e in zip(self.coefs, experts):
            row[:] = e.coef if e.coef is not None else 0.0
            if e.coef is None:
                p = float(np.clip(e.const, joint.P_CLIP, 1 - joint.P_CLIP))
                row[0] = math.log(p / (1 - p))
        own = [c for p, c in zip(prms, cfgs) for _ in p.experts]
        self.lam, self.temperature = (np.array([[getattr(c, f)] for c in own], dtype=float) for f in ("lambda_", "temperature"))

    def logits(self, rows: "_Sorted", eta: np.ndarray, soft: np.ndarray) -> np.ndarray:
        """(components, rows) tempered logits of the E-step."""
        out = rows.y * eta
        out -= soft
        np.clip(out, math.log(joint.P_CLIP), math.log1p(-joint.P_CLIP), out=out)
        odd = np.flatnonzero((rows.y != 0) & (rows.y != 1))
        if len(odd):
            e = np.clip(eta[:, odd], -math.log(1 / joint.P_CLIP - 1), math.log(1 / joint.P_CLIP - 1))
            out[:, odd] = rows.y[odd] * e - np.logaddexp(0.0, e)
        out *= self.lam
        out += self.gating @ rows.squares
        out += self.add[:, None]
        out /= self.temperature
        return out

    def eta(self, rows: "_Sorted") -> np.ndarray:
        return self.coefs[:, :1] + self.coefs[:, 1:] @ rows.Z1[:, 1:self.coefs.shape[1]].T

    def segments(self):
        return zip(self.starts[:-1], self.starts[1:])


class _Sorted:
    """The rows of a chunk in the order of their labels, so that a class is a slice."""

    def __init__(self, batch, x: str, xf: str, label: str, origin: np.ndarray):
        y = batch[label].to_numpy(float)
        order = np.argsort(y, kind="stable")
        X, Z = batch[x][order] - origin, batch[xf][order]
        self.X, self.y, self.Z1 = X, y[order], np.hstack([np.ones((len(y), 1)), Z])
        self.squares = np.vstack([X.T, np.square(X.T)])

    def classes(self):
        for c in (0, 1):
            a, b = np.searchsorted(self.y, [c, c], "left")[0], np.searchsorted(self.y, c, "right")
            if b > a:
                yield c, slice(a, b)


def _softplus(eta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``exp(-|eta|)`` and, with it, ``ln(1 + exp(eta))``."""
    small = np.exp(-np.abs(eta))
    return small, np.maximum(eta, 0.0) + np.log1p(small)


def _sigmoid(eta: np.ndarray, small: np.ndarray) -> np.ndarray:
    return np.where(eta >= 0, 1.0, small) / (1.0 + small)


def _largest(logits: np.ndarray) -> np.ndarray:
    """Number of the first largest of each column."""
    best, at = logits[0].copy(), np.zeros(logits.shape[1], np.int32)
    for k in range(1, len(logits)):
        at[logits[k] > best] = k
        np.maximum(best, logits[k], out=best)
    return at


def _to_shares(logits: np.ndarray, side: _Beside) -> np.ndarray:
    """Softmax of the components of each setting, in place; the sum of the log-sum-exps of each."""
    out = []
    for a, b in side.segments():
        part = logits[a:b]
        top = part.max(0)
        part -= top
        np.exp(part, out=part)
        total = part.sum(0)
        out.append((top + np.log(total)).sum())
        part /= np.maximum(total, joint.LOG_EPS)
    return np.array(out)


def _expert_sums(rows: _Sorted, W: np.ndarray, eta: np.ndarray, p: np.ndarray, soft: np.ndarray) -> np.ndarray:
    """(experts, 2, L) as :func:`experts.expert_stats_np`, for weights (experts, rows): products of features serve all experts."""
    D1 = rows.Z1.shape[1]
    out = np.zeros((len(W), 2, stats_length(D1 - 1)))
    products = np.empty((D1 * (D1 + 1) // 2, PRODUCT_ROWS))
    for c, at in rows.classes():
        Z, w, prob = rows.Z1[at], W[:, at], p[:, at]
        out[:, c, :D1] = (w * (prob - c)) @ Z
        curve = w * prob
        curve *= 1.0 - prob
        H = np.zeros((len(W), len(products)))
        for i in range(0, len(Z), PRODUCT_ROWS):
            part = np.ascontiguousarray(Z[i:i + PRODUCT_ROWS].T)
            first, n = 0, part.shape[1]
            for f in range(D1):  # rows of the upper triangle
                np.multiply(part[f], part[f:], out=products[first:first + D1 - f, :n])
                first += D1 - f
            H += curve[:, i:i + n] @ products[:, :n].T
        out[:, c, D1:-2] = H
        out[:, c, -2] = (w * (soft[:, at] - c * eta[:, at])).sum(1)
        out[:, c, -1] = w.sum(1)
    return out


def fit_grid(train: DataFrame, cfgs: list[joint.JointConfig], x: str = "xb", xf: str = "xf", label: str = "label") -> list[tuple[joint.JointParams, dict]]:
    """``(params, trace)`` of every setting, as ``joint.fit_joint`` gives them one by one (up to rounding).

    Per iteration one pass for the E-steps of all live settings and a few for their experts. Only vectors
    of the size of the parameters reach the driver.
    """
    common = _checked(cfgs)
    train = train.select(*[c for c in ("customer_id", label, x, xf) if c in train.columns])
    first = train.select(F.size(x).alias("d"), F.size(xf).alias("D")).first()
    d, D = first["d"], first["D"]
    n, positives = train.agg(F.count(F.lit(1)), F.sum(F.col(label).cast("double"))).first()
    rate = float(positives) / float(n)
    balance = "mass" if common.expert_class_weight == "balanced" else None
    ks = sorted({int(c.n_clusters) for c in cfgs})
    centers = {k: c for k, (c, _) in zip(ks, kmeans_fits(train, x, ks, common.random_state, common.kmeans_n_init))}

    def hard(batch):
        X = batch[x]
        near = [np.eye(k)[np.argmin(((X[:, None, :] - centers[k][None, :, :]) ** 2).sum(2), 1)] for k in ks]
        return np.hstack([*near, np.ones((len(X), 1))])

    origin = np.concatenate([centers[k] for k in ks]).mean(0)
    with kept(train.select(label, x, xf)) as rows:
        current, previous, traces = _fitted(train, rows, cfgs, common, centers, hard, ks, n, d, D, rate, balance, origin, x, xf, label)
    for prm, old in zip(current, previous):
        prm.global_rate, prm.last_estep = rate, old
    return list(zip(current, traces))


def _fitted(train, rows, cfgs, common, centers, hard, ks, n, d, D, rate, balance, origin, x, xf, label):
    """Parameters after the last iteration, those of its E-step, and the trace of every setting."""
    fitted = fit_experts(rows, hard, sum(ks) + 1, D, common.logreg_C, balance, rate, xf=xf, label=label)
    glob, starts, at = (fitted[-1] if common.use_global_expert else None), {}, 0
    for k in ks:
        sizes, gvar = joint._init_stats(train, centers[k], x)
        pi = np.clip(np.array([sizes[j]["n"] if j in sizes else 0 for j in range(k)], dtype=float) / n, 1e-12, 1.0)
        reg = float(common.covariance_reg)
        var = np.array([[sizes[j][f"v{i}"] for i in range(d)] if j in sizes else gvar for j in range(k)], dtype=float) + reg
        starts[k] = joint.JointParams(pi=pi / pi.sum(), mu=centers[k].copy(), var=np.clip(var, reg, None), experts=fitted[at:at + k], global_expert=glob)
        at += k
    current = [replace(starts[int(c.n_clusters)]) for c in cfgs]
    previous: list = [None] * len(cfgs)
    traces = [{"loglik": [], "change_ratio": []} for _ in cfgs]
    live = list(range(len(cfgs)))
    for it in range(int(common.max_iter)):
        if not live:
            break
        now, before, own = [current[s] for s in live], [previous[s] for s in live], [cfgs[s] for s in live]
        init = [e for prm in now for e in prm.experts]
        B0, L = _coefs(init, D), stats_length(D)
        side = _Beside(now, own, origin)
        past = None if before[0] is None else _Beside(before, own, origin)  # all live settings have had the same number of iterations
        A, S = len(init), len(live)

        def kernel(batch):
            r = _Sorted(batch, x, xf, label, origin)
            eta = side.eta(r)
            small, soft = _softplus(eta)
            p, Q = _sigmoid(eta, small), side.logits(r, eta, soft)
            if past is not None:
                e = past.eta(r)
                was = past.logits(r, e, _softplus(e)[1])
            moved = np.zeros(S)
            for i, (a, b) in enumerate(side.segments()):
                z = _largest(was[a:b]) if past is not None else joint._prev_assign(r.X + origin, None, None, None, centers[b - a], None, hard=False)
                moved[i] = (_largest(Q[a:b]) != z).sum()
            loglik = _to_shares(Q, side)
            moments = Q @ np.hstack([np.ones((len(r.y), 1)), r.y[:, None], r.X, r.X * r.X])
            eta[side.constant], p[side.constant], soft[side.constant] = 0.0, 0.5, math.log(2.0)  # as fit_experts starts from there
            return np.concatenate([moments.ravel(), loglik, moved, _expert_sums(r, Q, eta, p, soft).ravel()])

        v = sum_vectors(rows, kernel, A * (2 + 2 * d) + 2 * S + A * 2 * L)
        moments, ends = v[:A * (2 + 2 * d)].reshape(A, -1), v[A * (2 + 2 * d):A * (2 + 2 * d) + 2 * S].reshape(2, S)
        N, mu = moments[:, :1], side.mu
        S1 = moments[:, 2:2 + d] - N * mu
        S2 = moments[:, 2 + d:] - 2 * mu * moments[:, 2:2 + d] + N * mu * mu
        gating = []
        for i, (s, prm, cfg, (a, b)) in enumerate(zip(live, now, own, side.segments())):
            stats = {"N": moments[a:b, 0], "S1": S1[a:b], "S2": S2[a:b]}
            traces[s]["loglik"].append(ends[0, i])
            traces[s]["change_ratio"].append(ends[1, i] / float(n))
            gating.append((joint._mstep_gating(train, cfg, prm, stats, n, d, int(cfg.n_clusters), it, x, xf, label), stats["N"], moments[a:b, 1]))
        owner = np.repeat(np.arange(S), np.diff(side.starts))

        def newton(rows, cols, B):
            """Only the settings of the experts that still move take part."""
            some = np.unique(owner[cols])
            part = _Beside([now[i] for i in some], [own[i] for i in some], origin)
            place = {e: j for j, e in enumerate(np.flatnonzero(np.isin(owner, some)))}
            at = np.array([place[e] for e in cols])

            def sums(batch):
                r = _Sorted(batch, x, xf, label, origin)
                eta = part.eta(r)
                Q = part.logits(r, eta, _softplus(eta)[1])
                _to_shares(Q, part)
                eta = B @ r.Z1.T
                small, soft = _softplus(eta)
                return _expert_sums(r, Q[at], eta, _sigmoid(eta, small), soft).ravel()

            return sum_vectors(rows, sums, len(cols) * 2 * L).reshape(len(cols), 2, L)

        # the first Newton statistics of all live experts came out of the pass above
        experts = fit_experts(rows, None, A, D, common.logreg_C, balance, rate, xf=xf, label=label, init=init, first=v[-A * 2 * L:].reshape(A, 2, L), stats=newton)
        at, still = 0, []
        for s, prm, cfg, ((pi, mu, var), N, pos) in zip(live, now, own, gating):
            K = int(cfg.n_clusters)
            new = joint.JointParams(pi=pi, mu=mu, var=var, experts=experts[at:at + K], global_expert=glob)
            new.cluster_probs = np.clip(np.where(N > 1e-12, pos / np.maximum(N, 1e-12), rate), joint.P_CLIP, 1 - joint.P_CLIP)
            current[s], previous[s] = new, prm
            at += K
            if traces[s]["change_ratio"][-1] >= cfg.tol:
                still.append(s)
        live = still
    return current, previous, traces


def score_grid(df: DataFrame, fits: list, cfgs: list[joint.JointConfig], key: str = "customer_id", x: str = "xb", xf: str = "xf", label: str = "label") -> DataFrame:
    """``key, label, x, scores, clusters``: of every row its score and segment under each setting."""
    spark = df.sparkSession
    own = df.select(key, label, x, xf)
    schema = spark.createDataFrame([], f"{key} {dict(own.dtypes)[key]}, label double, x array<double>, scores array<double>, clusters array<int>").schema

    def run(batches):
        for batch in batches:
            y = batch.column(1).cast(pa.float64())
            if not batch.num_rows:
                continue
            X, Z = (batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(batch.num_rows, -1) for c in (2, 3))
            scores = np.column_stack([joint.response_np(X, Z, prm, cfg) for (prm, _), cfg in zip(fits, cfgs)])
            clusters = np.column_stack([np.argmax(joint.log_gating_np(X, prm, cfg), 1) for (prm, _), cfg in zip(fits, cfgs)])
            ends = pa.array(np.arange(batch.num_rows + 1) * len(cfgs), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), y, batch.column(2).cast(pa.list_(pa.float64())), pa.ListArray.from_arrays(ends, pa.array(scores.ravel())),
                 pa.ListArray.from_arrays(ends, pa.array(clusters.ravel().astype(np.int32)))],
                [key, "label", "x", "scores", "clusters"],
            )

    return own.mapInArrow(run, schema)


def _score_metrics(scored: DataFrame, settings: int, threshold: float) -> list[dict]:
    """Confusion rates, log loss, Brier score and calibration error of every setting: one pass of sums."""
    inner = np.array(uniform_edges(ECE_BINS)[1:-1])
    width = 6 + 3 * ECE_BINS

    def kernel(rows):
        y, P = rows["label"].to_numpy(float), rows["scores"]
        out = np.zeros((settings, width))
        for s in range(settings):
            p = P[:, s]
            said, c = p >= threshold, np.clip(p, PROB_EPS, 1 - PROB_EPS)
            out[s, :4] = (said & (y == 1)).sum(), (said & (y == 0)).sum(), (~said & (y == 0)).sum(), (~said & (y == 1)).sum()
            out[s, 4:6] = -(y * np.log(c) + (1 - y) * np.log(1 - c)).sum(), ((c - y) ** 2).sum()
            e = np.clip(p, ECE_EPS, 1 - ECE_EPS)
            b = np.searchsorted(inner, e, side="right")
            for i, w in enumerate((None, e, y)):
                out[s, 6 + i * ECE_BINS:6 + (i + 1) * ECE_BINS] = np.bincount(b, weights=w, minlength=ECE_BINS)
        return out.ravel()

    out = []
    share = lambda a, b: a / b if b > 0 else 0.0
    for v in sum_vectors(scored.select("label", "scores"), kernel, settings * width).reshape(settings, width):
        tp, fp, tn, fn = v[:4]
        n, (count, conf, acc) = v[:4].sum(), v[6:].reshape(3, ECE_BINS)
        recall, specificity = share(tp, tp + fn), share(tn, tn + fp)
        out.append({
            "f1": share(2 * tp, 2 * tp + fp + fn), "log_loss": v[4] / n, "brier": v[5] / n, "ece": float(np.abs(acc - conf).sum() / n),
            "accuracy": (tp + tn) / n, "precision": share(tp, tp + fp), "recall": recall, "balanced_accuracy": 0.5 * (recall + specificity),
            "specificity": specificity, "support_pos": tp + fn, "support_neg": tn + fp,
        })
    return out


def _order_metrics(scored: DataFrame, settings: int, top_frac: float, key: str) -> list[dict]:
    """AUC, average precision and lift of every setting from one table of score counts in (setting, score) order."""
    pairs = scored.select(key, "label", F.posexplode("scores").alias("setting", "s"))
    counted = pairs.groupBy("setting", "s").agg(F.count(F.when(F.col("label") > 0, 1)).alias("pos"), F.count(F.when(F.col("label") <= 0, 1)).alias("neg"))
    ordered = written(with_running_sums(counted, [("setting", True), ("s", True)], ["pos", "neg"]), "grid-scores")
    # every setting has the same rows, so what lies before a setting is a multiple of one setting's counts
    P, N = ordered.filter("setting = 0").agg(F.sum("pos"), F.sum("neg")).first()
    k = math.ceil((P + N) * top_frac)
    down_pos = F.lit(P) - (F.col("cum_pos") - F.col("setting") * P) + F.col("pos")
    down_neg = F.lit(N) - (F.col("cum_neg") - F.col("setting") * N) + F.col("neg")
    below = F.col("cum_neg") - F.col("setting") * N - F.col("neg")
    size = F.col("pos") + F.col("neg")
    cut = (down_pos + down_neg >= k) & (down_pos + down_neg - size < k)
    rows = {r["setting"]: r for r in ordered.groupBy("setting").agg(
        F.sum(F.col("pos") * (below + 0.5 * F.col("neg"))).alias("u"), F.sum(F.col("pos") * down_pos / (down_pos + down_neg)).alias("ap"),
        F.max(F.when(cut, F.struct(F.col("s"), (down_pos - F.col("pos")).alias("pos_above"), (down_pos + down_neg - size).alias("above"), "pos", size.alias("size")))).alias("cut"),
    ).collect()}  # a row a setting
    # only where the cut runs through rows of one score do their ids matter
    through = [(s, r["cut"]["s"], k - r["cut"]["above"]) for s, r in rows.items() if k - r["cut"]["above"] < r["cut"]["size"]]
    taken = {s: rows[s]["cut"]["pos"] for s in rows}
    if through:
        wanted = scored.sparkSession.createDataFrame(through, "setting int, at double, need long")
        tied = pairs.join(F.broadcast(wanted), "setting").filter(F.col("s") == F.col("at"))  # wanted: a row a setting
        ranked = written(with_global_rank(tied.select("setting", key, "label", "need"), [("setting", True), (key, True)]), "grid-ties")
        start = ranked.groupBy("setting").agg(F.min("rank").alias("first"))
        inside = ranked.join(F.broadcast(start), "setting").filter(F.col("rank") - F.col("first") < F.col("need"))
        taken |= {r["setting"]: r["pos"] for r in inside.groupBy("setting").agg(F.sum((F.col("label") > 0).cast("long")).alias("pos")).collect()}
    out = []
    for s in range(settings):
        r, base = rows[s], P / (P + N)
        hits = r["cut"]["pos_above"] + taken[s]
        out.append({"auc": r["u"] / (P * N) if P and N else None, "average_precision": r["ap"] / P if P else None, "lift_top20": hits / k / base if base > 0 else None})
    return out


def silhouettes(df: DataFrame, ks: list[int], sizes: list[np.ndarray], key: str = "customer_id", block_rows: int = BLOCK_ROWS) -> np.ndarray:
    """The exact Euclidean silhouette of every setting, for rows ``key, x, clusters`` (a segment per setting).

    Rows fall into hash blocks as in :func:`quality.silhouette_euclidean_rows` and are sent to every block. A
    task keeps, for the rows of its block, the distance sums to the segments of all settings, while the other
    rows stream past; it returns one vector of sums.
    """
    n = int(sizes[0].sum())
    n_blocks = max(1, min(-(-n // int(block_rows)), MEETINGS), -(-n // MOST_ROWS))
    rows = df.select(F.pmod(F.xxhash64(key), F.lit(n_blocks)).cast("int").alias("block"), F.transform("x", lambda v: v.cast("double")).alias("x"), "clusters")
    sent = rows.withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).select("to", (F.col("to") != F.col("block")).alias("away"), "x", "clusters")
    dealt = sent.repartition(4 * n_blocks, "to").sortWithinPartitions("to", "away")  # a block's own rows come first
    settings, starts = len(ks), np.cumsum([0, *ks])

    def sum_of(total: np.ndarray, labels: np.ndarray) -> np.ndarray:
        out, rows = np.zeros(settings), np.arange(len(total))
        for s, K in enumerate(ks):
            part, own, size = total[:, starts[s]:starts[s + 1]], labels[:, s], sizes[s]
            a = part[rows, own] / np.maximum(size[own] - 1, 1)
            mean = np.where(size > 0, part / np.maximum(size, 1), np.inf)
            mean[rows, own] = np.inf
            b = mean.min(1)
            most = np.maximum(a, b)
            ok = (size[own] > 1) & (most > 0) & np.isfinite(b)
            out[s] = np.where(ok, (b - a) / np.where(ok, most, 1.0), 0.0).sum()
        return out

    def meet(sides: np.ndarray, total: np.ndarray, X: np.ndarray, labels: np.ndarray, same: bool) -> None:
        right = distances_to(X)
        for j, b in tiles(len(X)):
            member = np.zeros((b - j, starts[-1]))
            member[np.arange(b - j)[:, None], starts[:-1][None, :] + labels[j:b]] = 1.0
            for i, a in tiles(len(sides)):
                total[i:a] += distances_from(sides[i:a], right[j:b], i == j if same else False) @ member

    def run(batches):
        done, at, own, open_ = np.zeros(settings), None, [], None

        def opened():
            X, labels = (np.concatenate(c) for c in zip(*own))
            sides, total = distances_to(X, True), np.zeros((len(X), starts[-1]))
            meet(sides, total, X, labels, True)
            return sides, total, labels

        for batch in batches:
            if not batch.num_rows:
                continue
            to, away = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            X, Z = (batch.column(c).flatten().to_numpy().reshape(len(to), -1) for c in (2, 3))
            cuts = [0, *(np.flatnonzero(np.diff(to)) + 1), len(to)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if to[a] != at:
                    if own:
                        open_ = open_ or opened()
                        done += sum_of(open_[1], open_[2])
                    at, own, open_ = to[a], [], None
                mid = a + int((~away[a:b]).sum())
                if mid > a:
                    own.append((X[a:mid], Z[a:mid]))
                if b > mid and own:
                    open_ = open_ or opened()
                    meet(open_[0], open_[1], X[mid:b], Z[mid:b], False)
        if own:
            open_ = open_ or opened()
            done += sum_of(open_[1], open_[2])
        yield pa.RecordBatch.from_arrays([pa.array(range(settings), pa.int32()), pa.array(done)], ["setting", "s"])

    sums = dealt.mapInArrow(run, "setting int, s double").groupBy("setting").agg(F.sum("s").alias("s")).collect()  # a row a setting
    return np.array([s for _, s in sorted((r["setting"], r["s"]) for r in sums)]) / sizes[0].sum()


def _segment_metrics(scored: DataFrame, ks: list[int], key: str) -> list[dict]:
    """Quality indices and response rates of the segments of every setting: two passes of sums and the silhouettes."""
    rows = valid_rows(scored.withColumn("one", F.lit(0)), "x", "one").select(key, "label", "x", "clusters")
    d = rows.select(F.size("x")).first()[0]
    starts = np.cumsum([0, *ks])

    def stats(batch):
        X, y, Z = batch["x"], batch["label"].to_numpy(float), batch["clusters"].astype(int)
        columns = np.column_stack([np.ones(len(y)), y, (X * X).sum(1), X])
        return np.concatenate([(np.eye(K)[Z[:, s]].T @ columns).ravel() for s, K in enumerate(ks)])

    v = sum_vectors(rows.select("label", "x", "clusters"), stats, starts[-1] * (3 + d)).reshape(-1, 3 + d)
    per = [v[starts[s]:starts[s + 1]] for s in range(len(ks))]
    means = [p[:, 3:] / np.maximum(p[:, :1], 1.0) for p in per]

    def spread(batch):
        X, Z, own = batch["x"], batch["clusters"].astype(int), (batch["x"] ** 2).sum(1)
        out = []
        for s, K in enumerate(ks):
            n, at, i = per[s][:, 0], Z[:, s], np.arange(len(own))
            far = np.sqrt(((X - means[s][at]) ** 2).sum(1))
            sq = own[:, None] - 2 * X @ means[s].T + (per[s][:, 2] / np.maximum(n, 1.0))[None, :]  # mean squared distance to each segment
            a = sq[i, at] * n[at] / np.maximum(n[at] - 1, 1)
            sq = np.where(n > 0, sq, np.inf)
            sq[i, at] = np.inf
            b, ok = sq.min(1), n[at] > 1
            most = np.maximum(a, b)
            ok &= np.isfinite(b) & (most > 0)
            out += [np.bincount(at, weights=far, minlength=K), [np.where(ok, (b - a) / np.where(ok, most, 1.0), 0.0).sum()]]
        return np.concatenate(out)

    w = sum_vectors(rows.select("x", "clusters"), spread, starts[-1] + len(ks))
    silhouette = silhouettes(rows, ks, [p[:, 0] for p in per], key)
    out, at = [], 0
    for s, K in enumerate(ks):
        far, squared = w[at:at + K], w[at + K]
        at += K + 1
        there = per[s][:, 0] > 0
        p, C, n = per[s][there], means[s][there], per[s][there][:, 0]
        total, k = n.sum(), int(there.sum())
        rates = p[:, 1] / n
        row = {"n_samples": float(total), "n_clusters": float(k), "silhouette": None, "silhouette_squared": None, "calinski_harabasz": None, "davies_bouldin": None,
               "response_rate_variance": float(np.var(rates)), "response_rates": {int(j): float(r) for j, r in zip(np.flatnonzero(there), rates)}}
        if 1 < k < total:
            g = (C * n[:, None]).sum(0) / total
            between, within = float((n * ((C - g) ** 2).sum(1)).sum()), float((p[:, 2] - n * (C ** 2).sum(1)).sum())
            apart = np.sqrt(((C[:, None, :] - C[None, :, :]) ** 2).sum(2))
            apart[apart == 0] = np.inf
            spreads = far[there] / n
            worst = (spreads[:, None] + spreads[None, :]) / apart
            np.fill_diagonal(worst, -np.inf)
            row.update(silhouette=float(silhouette[s]), silhouette_squared=float(squared / total), davies_bouldin=float(worst.max(1).mean()),
                       calinski_harabasz=1.0 if within == 0 else (between / (k - 1)) / (within / (total - k)))
        out.append(row)
    return out


def evaluate_grid(df: DataFrame, fits: list, cfgs: list[joint.JointConfig], threshold: float = 0.5, top_frac: float = 0.2, key: str = "customer_id") -> list[dict]:
    """The metric record of every setting over the rows of ``df`` (labels not NULL): segments, scores and ranking."""
    scored = written(score_grid(df, fits, cfgs, key), "grid-scored")
    segments = _segment_metrics(scored, [int(c.n_clusters) for c in cfgs], key)
    scores, orders = _score_metrics(scored, len(cfgs), threshold), _order_metrics(scored, len(cfgs), top_frac, key)
    return [{**a, **b, **c, "threshold": float(threshold)} for a, b, c in zip(segments, scores, orders)]
