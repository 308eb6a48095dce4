"""Response-aware joint segmentation.

Three model types share one driver loop over small broadcast parameters and
one cached training frame (``customer_id``, ``label``, ``xb`` behaviour array,
``xf`` full array):

* ``constant_prob`` - K-Means-like clustering whose cost adds ``lambda`` times
  the cross-entropy of the label under the cluster's smoothed rate (G9-G12);
  every iteration is one DataFrame aggregate (JVM only).
* ``logreg`` - hard assignments whose cost uses per-cluster logistic experts (G13).
* ``ramoe`` - mixture of experts with Gaussian (diag / spherical) or soft-K-Means
  gating, tempered E-step, gating M-step and weighted experts (G16-G25).

For the expert models each EM iteration is one fused ``mapInArrow`` pass that
emits per-partition sufficient statistics (component masses, shifted first and
second moments, class masses, log-likelihood, changed-assignment count),
followed by the fused Newton passes of :mod:`experts`. No per-row state is kept
between iterations: responsibilities are recomputed inside each pass from the
broadcast parameters of the iteration, and lineage never grows.
Scoring (G26, G27) is a pure column expression over the fitted parameters.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import soft
from .cluster import distances, kmeans_fit
from .experts import Expert, _to_arrays, balance_factors, expert_kind, expert_stats_np, fit_experts, kept, stats_length, sum_vectors
from .quantile import exact_quantiles

P_CLIP = 1e-7
LOG_EPS = 1e-12


@dataclass
class JointConfig:
    """Defaults of the reference class (``preset('yaml')`` gives the job file values)."""

    n_clusters: int = 4
    model_type: str = "ramoe"  # ramoe | logreg | constant_prob
    lambda_: float = 1.0
    max_iter: int = 50
    tol: float = 1e-3
    random_state: int = 42
    kmeans_n_init: int = 10
    gamma: float = 0.0
    smoothing: float = 1.0
    gating_type: str = "gmm"  # gmm | soft_kmeans
    covariance_type: str = "diag"  # diag | spherical
    covariance_reg: float = 1e-6
    temperature: float = 1.0
    gating_temperature: float = 1.0
    min_component_weight: float = 1e-6
    expert_type: str = "logreg"
    expert_class_weight: str | None = "balanced"
    logreg_C: float = 1.0
    use_global_expert: bool = True
    hybrid_alpha: float = 0.2
    budget_top_frac: float = 0.2
    budget_reweight_alpha: float = 0.0

    def __post_init__(self):
        if self.expert_type != "logreg":
            raise ValueError(f"expert_type is {self.expert_type!r}; the joint models have logistic experts ('logreg') only")
        if not self.temperature > 0:
            raise ValueError(f"temperature is {self.temperature}; it must be positive")
        if self.budget_reweight_alpha < 0 or not 0 < self.budget_top_frac <= 1:
            raise ValueError(f"budget_reweight_alpha is {self.budget_reweight_alpha}, budget_top_frac {self.budget_top_frac}; they must be at least 0, and above 0 and at most 1")

    @classmethod
    def preset(cls, name: str = "default", **kw) -> "JointConfig":
        base = {"default": {}, "yaml": {"temperature": 0.8, "kmeans_n_init": 20}}[name]
        base.update(kw)
        return cls(**base)


@dataclass
class JointParams:
    pi: np.ndarray
    mu: np.ndarray
    var: np.ndarray | None
    experts: list = field(default_factory=list)
    global_expert: Expert | None = None
    cluster_probs: np.ndarray | None = None
    global_rate: float = 0.5


# ------------------------------------------------------------------ numpy kernels (inside tasks)
def log_gating_np(X: np.ndarray, prm: JointParams, cfg: JointConfig) -> np.ndarray:
    log_pi = np.log(np.clip(prm.pi.reshape(1, -1), LOG_EPS, 1.0))
    d = X.shape[1]
    diag = cfg.gating_type != "soft_kmeans" and cfg.covariance_type == "diag"
    scale = 1.0 / prm.var if diag else np.ones_like(prm.mu)
    # component by component: no array of rows x components x features
    sq = np.column_stack([np.square(X - m) @ w for m, w in zip(prm.mu, scale)])
    if cfg.gating_type == "soft_kmeans":
        return log_pi - sq
    const = d * math.log(2 * math.pi)
    if diag:
        return log_pi - 0.5 * (const + np.log(prm.var).sum(1)[None, :] + sq)
    v = prm.var.mean(1)[None, :]
    return log_pi - 0.5 * (const + d * np.log(v) + sq / v)


def expert_matrix_np(Xf: np.ndarray, experts) -> np.ndarray:
    return np.clip(np.column_stack([e.predict(Xf) for e in experts]), P_CLIP, 1 - P_CLIP)


def softmax_np(a: np.ndarray) -> np.ndarray:
    m = a.max(1, keepdims=True)
    e = np.exp(a - m)
    return e / np.clip(e.sum(1, keepdims=True), LOG_EPS, None)


def estep_np(Xb, Xf, y, prm: JointParams, cfg: JointConfig):
    """Tempered E-step: (q, row log-sum-exp of the tempered logits)."""
    log_g = log_gating_np(Xb, prm, cfg)
    P = expert_matrix_np(Xf, prm.experts)
    yc = y[:, None]
    log_py = yc * np.log(np.clip(P, LOG_EPS, 1)) + (1 - yc) * np.log(np.clip(1 - P, LOG_EPS, 1))
    logits = (log_g + cfg.lambda_ * log_py) / cfg.temperature
    m = logits.max(1, keepdims=True)
    lse = (m + np.log(np.exp(logits - m).sum(1, keepdims=True)))[:, 0]
    return softmax_np(logits), lse


def constant_cost_np(Xb, y, centers, probs, cfg: JointConfig) -> np.ndarray:
    """G10 as :func:`response_aware_cost`; the squared distances alone without ``probs``."""
    sq = np.column_stack([((Xb - c) ** 2).sum(1) for c in centers])
    if probs is None:
        return sq
    p = np.clip(np.asarray(probs, float), LOG_EPS, None)
    ce = -(np.outer(y, np.log(p)) + np.outer(1 - y, np.log(np.clip(1 - np.asarray(probs, float), LOG_EPS, None))))
    return sq + cfg.lambda_ * ce + cfg.gamma * (np.asarray(probs) * (1 - np.asarray(probs)))[None, :]


def hard_cost_np(Xb, Xf, y, prm: JointParams, cfg: JointConfig) -> np.ndarray:
    sq = ((Xb[:, None, :] - prm.mu[None, :, :]) ** 2).sum(2)
    P = expert_matrix_np(Xf, prm.experts)
    yc = y[:, None]
    ce = -(yc * np.log(np.clip(P, LOG_EPS, 1)) + (1 - yc) * np.log(np.clip(1 - P, LOG_EPS, 1)))
    return sq + cfg.lambda_ * ce


# ------------------------------------------------------------------ column expressions (JVM side)
def _arr(v) -> Column:
    return F.array(*[F.lit(float(x)) for x in v])


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def gating_logits(xb: Column, prm: JointParams, cfg: JointConfig) -> Column:
    """``log pi_k + log N(x; mu_k, var_k)`` (or ``log pi_k - ||x-mu_k||^2``) per k."""
    K, d = prm.mu.shape
    out = []
    for k in range(K):
        log_pi = math.log(min(max(float(prm.pi[k]), LOG_EPS), 1.0))
        mu = _arr(prm.mu[k])
        if cfg.gating_type == "soft_kmeans":
            sq = F.aggregate(F.zip_with(xb, mu, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
            out.append(F.lit(log_pi) - sq)
            continue
        const = d * math.log(2 * math.pi)
        if cfg.covariance_type == "diag":
            inv = _arr(1.0 / prm.var[k])
            quad = _dot(F.zip_with(xb, mu, lambda a, b: (a - b) * (a - b)), inv)
            logdet = float(np.log(prm.var[k]).sum())
            out.append(F.lit(log_pi) - F.lit(0.5) * (F.lit(const + logdet) + quad))
        else:
            v = float(prm.var[k].mean())
            sq = F.aggregate(F.zip_with(xb, mu, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v2: s + v2)
            out.append(F.lit(log_pi) - F.lit(0.5) * (F.lit(const + d * math.log(v)) + sq / F.lit(v)))
    return F.array(*out)


def gating_probs(xb: Column, prm: JointParams, cfg: JointConfig) -> Column:
    """Softmax of the gating logits over the gating temperature."""
    if cfg.gating_temperature <= 0:
        raise ValueError(f"gating_temperature is {cfg.gating_temperature}; it must be positive")
    return soft.softmax(gating_logits(xb, prm, cfg), cfg.gating_temperature)


def expert_probs(xf: Column, experts) -> Column:
    clip = lambda c: F.least(F.greatest(c, F.lit(P_CLIP)), F.lit(1 - P_CLIP))
    return F.array(*[clip(e.column("xf") if isinstance(xf, str) else _expert_col(e, xf)) for e in experts])


def _expert_col(e: Expert, xf: Column) -> Column:
    if e.coef is None:
        return F.lit(float(np.clip(e.const, P_CLIP, 1 - P_CLIP)))
    eta = F.lit(float(e.coef[0])) + _dot(xf, _arr(e.coef[1:]))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))


def predict_clusters(xb: Column, prm: JointParams, cfg: JointConfig) -> Column:
    """Mixture -> argmax gating (label free); other modes -> nearest center."""
    if cfg.model_type == "ramoe":
        return soft.argmax(gating_logits(xb, prm, cfg))
    return soft.argmin(distances(xb, prm.mu))


def predict_response(xb: Column, xf: Column, prm: JointParams, cfg: JointConfig) -> Column:
    """Probability of response; non-finite -> global rate; clipped."""
    clip = lambda c: F.least(F.greatest(c, F.lit(P_CLIP)), F.lit(1 - P_CLIP))
    if cfg.model_type == "constant_prob":
        z = predict_clusters(xb, prm, cfg)
        out = F.element_at(_arr(prm.cluster_probs), z + 1)
    elif cfg.model_type == "logreg":
        z = predict_clusters(xb, prm, cfg)
        out = F.element_at(F.array(*[_expert_col(e, xf) for e in prm.experts]), z + 1)
    else:
        g = gating_probs(xb, prm, cfg)
        P = F.array(*[clip(_expert_col(e, xf)) for e in prm.experts])
        out = _dot(g, P)
        if cfg.use_global_expert and prm.global_expert is not None:
            a = float(min(max(cfg.hybrid_alpha, 0.0), 1.0))
            out = F.lit(1 - a) * out + F.lit(a) * clip(_expert_col(prm.global_expert, xf))
    odd = lambda v: F.isnan(v) | v.isNull() | (F.abs(v) == F.lit(float("inf")))
    return clip(soft.bound(out, lambda v: F.when(odd(v), F.lit(float(prm.global_rate))).otherwise(v)))


def response_aware_cost(xb: Column, label: Column, centers, probs, lam: float, gamma: float) -> Column:
    """``||x-mu_k||^2 + lambda * CE(y; p_k) + gamma * p_k (1-p_k)`` per k (array)."""
    y = label.cast("double")
    out = []
    for mu, p in zip(centers, probs):
        ce = -(y * F.lit(math.log(max(p, LOG_EPS))) + (F.lit(1.0) - y) * F.lit(math.log(max(1 - p, LOG_EPS))))
        sq = F.aggregate(F.zip_with(xb, _arr(mu), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
        out.append(sq + F.lit(float(lam)) * ce + F.lit(float(gamma) * p * (1 - p)))
    return F.array(*out)


def smoothed_cluster_rates(df: DataFrame, K: int, cluster: str = "cluster", label: str = "label", smoothing: float = 1.0) -> DataFrame:
    """``(pos + a) / (n + 2a)`` per cluster id 0..K-1; empty -> global rate; clipped."""
    spark = df.sparkSession
    ids = spark.range(K).select(F.col("id").cast("int").alias(cluster))
    agg = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("double")).alias("pos"))
    g = df.agg(F.avg(F.col(label).cast("double")).alias("g"))
    a = float(smoothing)
    rate = F.when(F.col("n") > 0, (F.col("pos") + F.lit(a)) / (F.col("n") + F.lit(2 * a))).otherwise(F.col("g"))
    return (
        ids.join(agg, cluster, "left")
        .crossJoin(F.broadcast(g))  # one-row total
        .select(cluster, F.least(F.greatest(rate, F.lit(P_CLIP)), F.lit(1 - P_CLIP)).alias("p"))
    )


# ------------------------------------------------------------------ fitting
def _md5_row(df: DataFrame, tag: str, x: str = "xb", key: str = "customer_id") -> np.ndarray:
    """Deterministic replacement row (smallest md5 of tag|key)."""
    r = df.select(F.md5(F.concat(F.lit(tag + "|"), F.col(key).cast("string"))).alias("h"), F.col(x)).orderBy("h").limit(1).collect()
    return np.array(r[0][x], dtype=float)


def _init_stats(df: DataFrame, centers: np.ndarray, x: str = "xb"):
    """Sizes and population variances per nearest-center cluster (one aggregate)."""
    d = centers.shape[1]
    a = df.select(soft.argmin(distances(F.col(x), centers)).alias("k"), F.col(x).alias("x"))
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.var_pop(F.col("x")[j]).alias(f"v{j}") for j in range(d)]
    rows = {r["k"]: r for r in a.groupBy("k").agg(*aggs).collect()}  # K rows
    glob = df.select(F.col(x).alias("x")).agg(*[F.var_pop(F.col("x")[j]).alias(f"v{j}") for j in range(d)]).first()
    gvar = np.array([glob[f"v{j}"] for j in range(d)], dtype=float)
    return rows, gvar


def fit_joint(train: DataFrame, cfg: JointConfig, x: str = "xb", xf: str = "xf", label: str = "label", log=None):
    """Fit one of the three joint models on a cached training frame. Returns (params, trace)."""
    K = int(cfg.n_clusters)
    train = train.select(*[c for c in ("customer_id", label, x, xf) if c in train.columns])
    first = train.select(F.size(x).alias("d"), F.size(xf).alias("D")).first()
    d, D = first["d"], first["D"]
    n, pos_total = train.agg(F.count(F.lit(1)), F.sum(F.col(label).cast("double"))).first()
    global_rate = float(pos_total) / float(n)
    centers, _ = kmeans_fit(train, x, K, cfg.random_state, cfg.kmeans_n_init)
    trace = {"loglik": [], "change_ratio": []}
    if cfg.model_type == "constant_prob":
        prm = _fit_constant(train, cfg, centers, global_rate, x, label, trace)
    elif cfg.model_type in ("logreg", "ramoe"):
        with kept(train.select(label, x, xf)) as rows:
            prm = _fit_experts_model(train, rows, cfg, centers, n, d, D, global_rate, x, xf, label, trace)
    else:
        raise ValueError(f"model_type is {cfg.model_type!r}; use 'ramoe', 'logreg' or 'constant_prob'")
    prm.global_rate = global_rate
    return prm, trace


def _fit_constant(train, cfg, centers, global_rate, x, label, trace) -> JointParams:
    K, d = centers.shape
    z_prev = soft.argmin(distances(F.col(x), centers))
    rates = smoothed_cluster_rates(train.select(z_prev.alias("cluster"), F.col(label).alias("label")), K, smoothing=cfg.smoothing)
    probs = np.array([r["p"] for r in rates.orderBy("cluster").collect()])
    with kept(train.select(label, x)) as rows:
        before = (centers, None)  # nearest centers, then the assignments of the iteration before
        for it in range(int(cfg.max_iter)):

            def kernel(batch, now=(centers, probs), before=before):
                X, y = _to_arrays(batch, x), batch[label].to_numpy(float)
                k, k0 = (np.argmin(constant_cost_np(X, y, c, p, cfg), 1) for c, p in (now, before))
                Z = np.eye(K)[k]
                return np.concatenate([Z.sum(0), Z.T @ y, (Z.T @ X).ravel(), [float((k != k0).sum())]])

            s = sum_vectors(rows, kernel, 2 * K + K * d + 1)
            sizes, positives, sums = s[:K], s[K:2 * K], s[2 * K:-1].reshape(K, d)
            last = JointParams(pi=np.full(K, 1.0 / K), mu=centers, var=None, cluster_probs=probs)  # behind this iteration's assignments
            change = s[-1] / float(sizes.sum())
            before = (centers, probs)  # this iteration's assignment is the next one's reference
            new_c = np.array(centers, dtype=float).copy()
            probs = np.full(K, global_rate)
            for k in range(K):
                if sizes[k] > 0:
                    new_c[k] = sums[k] / sizes[k]
                    probs[k] = (positives[k] + cfg.smoothing) / (sizes[k] + 2 * cfg.smoothing)
                else:
                    new_c[k] = _md5_row(train, f"{cfg.random_state}|{it}|{k}", x)
            probs = np.clip(probs, P_CLIP, 1 - P_CLIP)
            centers = new_c
            trace["change_ratio"].append(change)
            if change < cfg.tol:
                break
    prm = JointParams(pi=np.full(K, 1.0 / K), mu=centers, var=None, cluster_probs=probs, global_rate=global_rate)
    prm.last_estep = last if int(cfg.max_iter) > 0 else prm
    return prm


def _fit_experts_model(train, chunks, cfg, centers, n, d, D, global_rate, x, xf, label, trace) -> JointParams:
    K = centers.shape[0]
    reg = float(cfg.covariance_reg)
    balance = "mass" if cfg.expert_class_weight == "balanced" else None
    rows, gvar = _init_stats(train, centers, x)
    sizes = np.array([rows[k]["n"] if k in rows else 0 for k in range(K)], dtype=float)
    pi = np.clip(sizes / n, 1e-12, 1.0)
    pi = pi / pi.sum()
    var = np.zeros((K, d))
    for k in range(K):
        var[k] = np.array([rows[k][f"v{j}"] for j in range(d)]) + reg if k in rows else gvar + reg
    var = np.clip(var, reg, None)
    mu0 = centers.copy()

    def hard_w(c):
        def fn(pdf):
            Xb = _to_arrays(pdf, x)
            z = np.argmin(((Xb[:, None, :] - c[None, :, :]) ** 2).sum(2), 1)
            return np.eye(K)[z]

        return fn

    use_glob = cfg.model_type == "ramoe" and cfg.use_global_expert
    fitted = fit_experts(chunks, _with_global(hard_w(mu0), use_glob), K + use_glob, D, cfg.logreg_C, balance, global_rate,
                         xf=xf, label=label)
    experts, glob = fitted[:K], (fitted[K] if use_glob else None)
    prm = JointParams(pi=pi, mu=centers.copy(), var=var, experts=experts, global_expert=glob)
    prev = None  # parameters of the previous E-step (None -> K-Means start)
    for it in range(int(cfg.max_iter)):
        cur = prm
        # experts are warm-started from the current coefficients; their first Newton
        # statistics come out of the same scan as the E-step
        init = list(cur.experts) + ([cur.global_expert] if use_glob else [])
        B0 = np.stack([e.coef if (e is not None and e.coef is not None) else np.zeros(D + 1) for e in init])
        if cfg.model_type == "ramoe":
            stats = _ramoe_pass(chunks, cfg, cur, prev, mu0, K, d, x, xf, label, B0, use_glob)
        else:
            stats = _hard_pass(chunks, cfg, cur, prev, mu0, K, d, x, xf, label, B0)
        change = stats["chg"] / float(n)
        trace["change_ratio"].append(change)
        if cfg.model_type == "ramoe":
            trace["loglik"].append(stats["ll"])
            new = _mstep_gating(train, cfg, cur, stats, n, d, K, it, x, xf, label)
            # K segment experts and the global expert in the same fused Newton passes
            w_fn = _with_global(_q_weights(cfg, cur, K, x, xf, label), use_glob)
            first = stats["expert"]
            if cfg.budget_reweight_alpha > 0:  # rows in the budget's reach weigh more; the pass above did not know them
                reach = _budget_threshold(train, cfg, replace(prm, pi=new[0], mu=new[1], var=new[2], global_rate=global_rate), x, xf)
                w_fn, first = _budget_weighted(w_fn, cfg, replace(prm, pi=new[0], mu=new[1], var=new[2], global_rate=global_rate), reach, x, xf), None
            fitted = fit_experts(chunks, w_fn, K + use_glob, D, cfg.logreg_C, balance, global_rate, xf=xf, label=label,
                                 init=init, first=first)
            experts, glob = fitted[:K], (fitted[K] if use_glob else None)
            prm = JointParams(pi=new[0], mu=new[1], var=new[2], experts=experts, global_expert=glob)
        else:
            mu = cur.mu.copy()
            for k in range(K):
                if stats["N"][k] > 0:
                    mu[k] = stats["S1"][k] / stats["N"][k]
                else:
                    mu[k] = _md5_row(train, f"{cfg.random_state}|{it}|{k}", x)
            w_fn = _hard_weights(cfg, cur, K, x, xf, label)
            experts = fit_experts(chunks, w_fn, K, D, cfg.logreg_C, balance, global_rate, xf=xf, label=label,
                                  init=init, first=stats["expert"])
            prm = JointParams(pi=stats["N"] / float(n), mu=mu, var=None, experts=experts)
        # response rate of each component under the assignments of this iteration (soft or hard)
        prm.cluster_probs = np.clip(np.where(stats["N"] > 1e-12, stats["pos"] / np.maximum(stats["N"], 1e-12), global_rate), P_CLIP, 1 - P_CLIP)
        prev = cur
        if change < cfg.tol:
            break
    prm.last_estep = prev  # parameters behind the stored train assignments
    return prm


def _with_global(fn, use_glob: bool):
    if not use_glob:
        return fn
    return lambda pdf: np.hstack([fn(pdf), np.ones((len(pdf), 1))])


def response_np(Xb, Xf, prm: JointParams, cfg: JointConfig) -> np.ndarray:
    """Blended score of the mixture (G27), as :func:`predict_response` gives it."""
    g = softmax_np(log_gating_np(Xb, prm, cfg) / cfg.gating_temperature)
    out = (g * expert_matrix_np(Xf, prm.experts)).sum(1)
    if cfg.use_global_expert and prm.global_expert is not None:
        a = float(min(max(cfg.hybrid_alpha, 0.0), 1.0))
        out = (1 - a) * out + a * expert_matrix_np(Xf, [prm.global_expert])[:, 0]
    return np.clip(np.where(np.isfinite(out), out, prm.global_rate), P_CLIP, 1 - P_CLIP)


def _budget_threshold(train, cfg, prm, x, xf) -> float:
    """The score that the best ``budget_top_frac`` of the train rows reach."""
    p = predict_response(F.col(x), F.col(xf), prm, cfg)
    return exact_quantiles(train, {"p": p}, [1.0 - float(min(max(cfg.budget_top_frac, 1e-3), 1.0))])["p"][0]


def _budget_weighted(fn, cfg, prm, reach, x, xf):
    def weighted(pdf):
        p = response_np(_to_arrays(pdf, x), _to_arrays(pdf, xf), prm, cfg)
        return fn(pdf) * (1.0 + cfg.budget_reweight_alpha * (p >= reach - 1e-12))[:, None]

    return weighted


def estep_frame(df: DataFrame, prm: JointParams, cfg: JointConfig, key: str = "customer_id", x: str = "xb", xf: str = "xf", label: str = "label") -> DataFrame:
    """``key, q, loglik`` of every row, from the kernel that the fit runs."""

    def run(it):
        for pdf in it:
            if len(pdf):
                q, lse = estep_np(_to_arrays(pdf, x), _to_arrays(pdf, xf), pdf[label].to_numpy(float), prm, cfg)
                yield pd.DataFrame({key: pdf[key], "q": list(q), "loglik": lse})

    kind = dict(df.dtypes)[key]
    return df.select(*dict.fromkeys((key, x, xf, label))).mapInPandas(run, f"{key} {kind}, q array<double>, loglik double")


def _q_weights(cfg, prm, K, x, xf, label):
    def fn(pdf):
        q, _ = estep_np(_to_arrays(pdf, x), _to_arrays(pdf, xf), pdf[label].to_numpy(float), prm, cfg)
        return q

    return fn


def _hard_weights(cfg, prm, K, x, xf, label):
    def fn(pdf):
        cost = hard_cost_np(_to_arrays(pdf, x), _to_arrays(pdf, xf), pdf[label].to_numpy(float), prm, cfg)
        return np.eye(K)[np.argmin(cost, 1)]

    return fn


def _prev_assign(Xb, Xf, y, prev, mu0, cfg, hard: bool):
    if prev is None:
        return np.argmin(((Xb[:, None, :] - mu0[None, :, :]) ** 2).sum(2), 1)
    if hard:
        return np.argmin(hard_cost_np(Xb, Xf, y, prev, cfg), 1)
    q, _ = estep_np(Xb, Xf, y, prev, cfg)
    return np.argmax(q, 1)


def _ramoe_pass(train, cfg, cur, prev, mu0, K, d, x, xf, label, B0, use_glob) -> dict:
    """E-step + sufficient statistics for the gating M-step and the experts (one pass)."""
    mu_old = cur.mu
    n_exp, L = B0.shape[0], stats_length(B0.shape[1] - 1)

    def kernel(rows):
        Xb, Xf, y = _to_arrays(rows, x), _to_arrays(rows, xf), rows[label].to_numpy(float)
        q, lse = estep_np(Xb, Xf, y, cur, cfg)
        z = np.argmax(q, 1)
        zp = _prev_assign(Xb, Xf, y, prev, mu0, cfg, hard=False)
        diff = Xb[:, None, :] - mu_old[None, :, :]  # (n, K, d)
        W = np.hstack([q, np.ones((len(y), 1))]) if use_glob else q
        return np.concatenate([
            q.sum(0), np.einsum("nk,nkd->kd", q, diff).ravel(), np.einsum("nk,nkd->kd", q, diff * diff).ravel(),
            (q * y[:, None]).sum(0), (q * (1 - y)[:, None]).sum(0), [lse.sum(), float((z != zp).sum()), y.sum()],
            expert_stats_np(Xf, y, W, B0).ravel(),
        ])

    v = sum_vectors(train.select(label, x, xf), kernel, K + 2 * K * d + 2 * K + 3 + n_exp * 2 * L)
    o = 0
    N = v[o : o + K]; o += K
    S1 = v[o : o + K * d].reshape(K, d); o += K * d
    S2 = v[o : o + K * d].reshape(K, d); o += K * d
    pos = v[o : o + K]; o += K
    neg = v[o : o + K]; o += K
    ll, chg, ypos = v[o], v[o + 1], v[o + 2]
    o += 3
    ex = v[o : o + n_exp * 2 * L].reshape(n_exp, 2, L)
    return {"N": N, "S1": S1, "S2": S2, "pos": pos, "neg": neg, "ll": ll, "chg": chg, "ypos": ypos, "expert": ex}


def _hard_pass(train, cfg, cur, prev, mu0, K, d, x, xf, label, B0) -> dict:
    n_exp, L = B0.shape[0], stats_length(B0.shape[1] - 1)

    def kernel(rows):
        Xb, Xf, y = _to_arrays(rows, x), _to_arrays(rows, xf), rows[label].to_numpy(float)
        z = np.argmin(hard_cost_np(Xb, Xf, y, cur, cfg), 1)
        zp = _prev_assign(Xb, Xf, y, prev, mu0, cfg, hard=True)
        Z = np.eye(K)[z]
        return np.concatenate([Z.sum(0), (Z.T @ Xb).ravel(), (Z * y[:, None]).sum(0), (Z * (1 - y)[:, None]).sum(0),
                               [float((z != zp).sum())], expert_stats_np(Xf, y, Z, B0).ravel()])

    base = K + K * d + 2 * K + 1
    v = sum_vectors(train.select(label, x, xf), kernel, base + n_exp * 2 * L)
    return {"N": v[:K], "S1": v[K : K + K * d].reshape(K, d), "pos": v[K + K * d : 2 * K + K * d],
            "neg": v[2 * K + K * d : 3 * K + K * d], "chg": v[base - 1], "expert": v[base:].reshape(n_exp, 2, L)}


def _mstep_gating(train, cfg, cur, st, n, d, K, it, x, xf, label):
    """Shares, means and variances from the shifted sums; tiny components rescued."""
    N, S1, S2 = st["N"].copy(), st["S1"].copy(), st["S2"].copy()
    mu_old = cur.mu
    min_mass = float(cfg.min_component_weight) * float(n)
    for k in range(K):
        if N[k] <= min_mass:
            # one deterministic row becomes one-hot for k (only in the gating copy of q)
            h = F.md5(F.concat(F.lit(f"{cfg.random_state}|{it}|{k}|"), F.col("customer_id").cast("string")))
            r = train.select(h.alias("h"), F.col(x), F.col(xf), F.col(label)).orderBy("h").limit(1).collect()[0]
            xb = np.array(r[x], float)[None, :]
            q, _ = estep_np(xb, np.array(r[xf], float)[None, :], np.array([float(r[label])]), cur, cfg)
            diff = xb[0][None, :] - mu_old
            N -= q[0]
            S1 -= q[0][:, None] * diff
            S2 -= q[0][:, None] * diff * diff
            N[k] += 1.0
            S1[k] += diff[k]
            S2[k] += diff[k] ** 2
    pi = np.clip(N / float(n), 1e-12, 1.0)
    pi = pi / pi.sum()
    denom = np.maximum(N, 1e-12)[:, None]
    shift = S1 / denom
    mu = mu_old + shift
    reg = float(cfg.covariance_reg)
    if cfg.gating_type == "soft_kmeans":
        g = train.select(F.col(x).alias("x")).agg(*[F.var_pop(F.col("x")[j]).alias(f"v{j}") for j in range(d)]).first()
        var = np.tile(np.array([g[f"v{j}"] for j in range(d)]) + reg, (K, 1))
    elif cfg.covariance_type == "diag":
        var = np.clip(S2 / denom - shift**2 + reg, reg, None)
    else:
        tot = (S2 / denom - shift**2).sum(1) * N / np.maximum(N * d, 1e-12)
        var = np.tile(np.maximum(tot, reg)[:, None], (1, d))
    return pi, mu, var


def m_step(df: DataFrame, prm: JointParams, cfg: JointConfig, x: str = "xb", xf: str = "xf", label: str = "label") -> DataFrame:
    """G14, G15, G22 at given parameters, one row a component, from the pass that the fit runs.

    ``mass, pi, mu, var`` are the gating after the step; ``pos_mass, neg_mass`` the class masses of the
    component's expert, ``pos_weight`` the factor of its positive rows and ``expert`` what is fitted to it.
    """
    K, d = prm.mu.shape
    D = df.select(F.size(xf)).first()[0]
    n = df.count()
    st = _ramoe_pass(df, cfg, prm, None, prm.mu, K, d, x, xf, label, np.zeros((K, D + 1)), False)
    pi, mu, var = _mstep_gating(df, cfg, prm, st, n, d, K, 0, x, xf, label)
    pos_weight = balance_factors(st["pos"], st["neg"], "mass" if cfg.expert_class_weight == "balanced" else None)[1]
    rows = [
        (k, float(st["N"][k]), float(pi[k]), mu[k].tolist(), var[k].tolist(), float(st["pos"][k]), float(st["neg"][k]), float(pos_weight[k]),
         expert_kind(st["pos"][k], st["neg"][k]))
        for k in range(K)
    ]
    kinds = "cluster int, mass double, pi double, mu array<double>, var array<double>, pos_mass double, neg_mass double, pos_weight double, expert string"
    return df.sparkSession.createDataFrame(rows, kinds)


# ------------------------------------------------------------------ outputs of a fitted model
def train_assignments(df: DataFrame, prm: JointParams, cfg: JointConfig, x="xb", xf="xf", label="label") -> DataFrame:
    """Stored train assignments: of the last iteration's parameters and with the labels (mixture: argmax of
    its E-step; other modes: smallest response-aware cost)."""
    e = getattr(prm, "last_estep", None) or prm
    if cfg.model_type == "ramoe":
        log_g = gating_logits(F.col(x), e, cfg)
        y = F.col(label).cast("double")
        P = F.array(*[F.least(F.greatest(_expert_col(ex, F.col(xf)), F.lit(P_CLIP)), F.lit(1 - P_CLIP)) for ex in e.experts])
        log_py = F.transform(P, lambda p: y * F.log(F.greatest(p, F.lit(LOG_EPS))) + (F.lit(1.0) - y) * F.log(F.greatest(F.lit(1.0) - p, F.lit(LOG_EPS))))
        logits = F.zip_with(log_g, log_py, lambda a, b: (a + F.lit(cfg.lambda_) * b) / F.lit(cfg.temperature))
        return df.withColumn("cluster", soft.argmax(logits))
    if cfg.model_type == "constant_prob":
        return df.withColumn("cluster", soft.argmin(response_aware_cost(F.col(x), F.col(label), e.mu, e.cluster_probs, cfg.lambda_, cfg.gamma)))
    y = F.col(label).cast("double")
    entropy = lambda p: -(y * F.log(F.greatest(p, F.lit(LOG_EPS))) + (F.lit(1.0) - y) * F.log(F.greatest(F.lit(1.0) - p, F.lit(LOG_EPS))))
    cost = F.zip_with(distances(F.col(x), e.mu), expert_probs(F.col(xf), e.experts), lambda d, p: d + F.lit(float(cfg.lambda_)) * entropy(p))
    return df.withColumn("cluster", soft.argmin(cost))


def soft_cluster_rates(df: DataFrame, q: str = "q", label: str = "label") -> DataFrame:
    """``sum(q_k * y) / sum(q_k)`` per component, clipped."""
    e = df.select(F.posexplode(q).alias("k", "qk"), F.col(label).cast("double").alias("y"))
    r = F.col("num") / F.greatest(F.col("den"), F.lit(LOG_EPS))
    return e.groupBy("k").agg(F.sum(F.col("qk") * F.col("y")).alias("num"), F.sum("qk").alias("den")).select(
        F.col("k").cast("int").alias("cluster"), F.least(F.greatest(r, F.lit(P_CLIP)), F.lit(1 - P_CLIP)).alias("rate")
    )


def cluster_stats(df: DataFrame, K: int, cluster: str = "cluster", label: str = "label") -> DataFrame:
    """Size and response rate per cluster id (NULL rate when empty)."""
    ids = df.sparkSession.range(K).select(F.col("id").cast("int").alias(cluster))
    agg = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"), F.avg(F.col(label).cast("double")).alias("rate"))
    return ids.join(agg, cluster, "left").select(cluster, F.coalesce("size", F.lit(0)).alias("size"), "rate")


def budget_weights(df: DataFrame, p_hat: str, alpha: float, top_frac: float = 0.2) -> DataFrame:
    """``1 + alpha`` for rows whose blended score reaches the (1-f) quantile."""
    f = float(min(max(top_frac, 1e-3), 1.0))
    t = exact_quantiles(df, {"p": F.col(p_hat)}, [1.0 - f])["p"]
    reached = (F.col(p_hat) >= F.lit(t[0])).cast("double") if t else F.lit(None).cast("double")
    return df.withColumn("w_budget", F.lit(1.0) + F.lit(float(alpha)) * reached)
