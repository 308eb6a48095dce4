"""Registered queries: model steps with fixed parameters (exact oracles), unrolled
iterations (U oracles), quality indices on ``embeddings`` and model fits (rows only).

Fixed-parameter queries run on the standardised RFM features of every customer
(the train-fitted transform of :mod:`catalog_transform`), so their work grows
with the tables; the parameters below are fixed values of the checks.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from ..operators import cluster as clu
from ..operators import joint, mixture, quality, soft
from ..operators.experts import Expert
from .catalog import register, sa, sd, si, tidy
from .catalog_transform import CATS, NUMERIC, _TF
from .frames import model_frame, scored
from .sql_base import dbl, with_base

# Fixed values of the parameter checks (K = 4 components over d = 3 RFM features).
MU = np.array([[-1.0, -1.0, -1.0], [0.0, 0.0, 0.0], [1.0, 1.0, 1.0], [1.0, -1.0, 0.0]])
VAR = np.array([[1.0, 1.0, 1.0], [0.5, 0.5, 0.5], [2.0, 2.0, 2.0], [1.0, 2.0, 0.5]])
PI = np.array([0.4, 0.3, 0.2, 0.1])
W = np.array([[-2.0, 0.5, 0.0, 0.0], [-1.5, 0.0, 0.5, 0.0], [-1.0, 0.0, 0.0, 0.5], [-2.5, 0.2, 0.2, 0.2]])
W_GLOBAL = np.array([-2.0, 0.1, 0.1, 0.1])
CONST_P = [0.1, 0.2, 0.3, 0.4]
LAMBDA, TEMP, GATE_TEMP, ALPHA, GAMMA = 1.0, 0.8, 1.0, 0.2, 0.5
XS = ["recency", "frequency", "monetary"]


def _cfg(**kw):
    base = dict(n_clusters=4, lambda_=LAMBDA, temperature=TEMP, gating_temperature=GATE_TEMP, hybrid_alpha=ALPHA, gamma=GAMMA)
    base.update(kw)
    return joint.JointConfig(**base)


def _params():
    return joint.JointParams(pi=PI, mu=MU, var=VAR, experts=[Expert(coef=w) for w in W], global_expert=Expert(coef=W_GLOBAL), global_rate=0.5)


def _frame(spark, sf_dir):
    mf, _ = model_frame(spark, sf_dir)
    return mf


# ---------------------------------------------------------------- SQL mirrors of the column expressions
_Z = "CAST(0.0 AS DOUBLE)"


def _acc(terms):
    out = _Z
    for t in terms:
        out = f"({out} + {t})"
    return out


def _sq(j, m):
    return f"(({XS[j]} - {dbl(m)}) * ({XS[j]} - {dbl(m)}))"


def _sql_logits(kind: str):
    d = 3
    out = []
    for k in range(4):
        log_pi = math.log(min(max(float(PI[k]), 1e-12), 1.0))
        if kind == "soft_kmeans":
            out.append(f"({dbl(log_pi)} - {_acc([_sq(j, MU[k][j]) for j in range(d)])})")
        elif kind == "diag":
            inv = 1.0 / VAR[k]
            quad = _acc([f"({_sq(j, MU[k][j])} * {dbl(inv[j])})" for j in range(d)])
            c = d * math.log(2 * math.pi) + float(np.log(VAR[k]).sum())
            out.append(f"({dbl(log_pi)} - {dbl(0.5)} * ({dbl(c)} + {quad}))")
        else:
            v = float(VAR[k].mean())
            c = d * math.log(2 * math.pi) + d * math.log(v)
            out.append(f"({dbl(log_pi)} - {dbl(0.5)} * ({dbl(c)} + {_acc([_sq(j, MU[k][j]) for j in range(d)])} / {dbl(v)}))")
    return out


def _sql_softmax(logits, temp):
    sc = [f"({l} / {dbl(temp)})" for l in logits]
    m = f"greatest({', '.join(sc)})"
    e = [f"exp({s} - {m})" for s in sc]
    s = _acc(e)
    return [f"({x} / {s})" for x in e]


def _clip(e):
    return f"least(greatest({e}, {dbl(1e-7)}), {dbl(1 - 1e-7)})"


def _sql_expert(w):
    eta = f"({dbl(w[0])} + {_acc([f'({XS[j]} * {dbl(w[j + 1])})' for j in range(3)])})"
    return f"({dbl(1.0)} / ({dbl(1.0)} + exp(-{eta})))"


def _sql_argmax(vals):
    arr = "[" + ", ".join(vals) + "]"
    return f"(list_position({arr}, list_max({arr})) - 1)"


def _sql_argmin(vals):
    arr = "[" + ", ".join(vals) + "]"
    return f"(list_position({arr}, list_min({arr})) - 1)"


_RF = "rf AS (SELECT customer_id, split, label, " + ", ".join(XS) + " FROM tf)"
_BASE = _TF + ", " + _RF


def _arr_sql(vals):
    return "[" + ", ".join(vals) + "]"


def _xrfm(mf):
    return mf.select("customer_id", "split", "label", F.col("xrfm").alias("x"))


for _kind, _name in (("diag", "gating_diag"), ("spherical", "gating_spherical"), ("soft_kmeans", "gating_soft_kmeans")):

    def _mk(kind=_kind, name=_name):
        sql = with_base(f"SELECT {si('customer_id', 'customer_id')}, {sa(_arr_sql(_sql_logits(kind)), 'logits')} FROM rf", _BASE)

        @register(name, sql)
        def q(spark, sf_dir):
            cfg = _cfg(gating_type="soft_kmeans" if kind == "soft_kmeans" else "gmm", covariance_type="spherical" if kind == "spherical" else "diag")
            mf = _xrfm(_frame(spark, sf_dir))
            return tidy(mf.select("customer_id", joint.gating_logits(F.col("x"), _params(), cfg).alias("logits")))

    _mk()


@register(
    "gating_probs",
    with_base(f"SELECT {si('customer_id', 'customer_id')}, {sa(_arr_sql(_sql_softmax(_sql_logits('diag'), GATE_TEMP)), 'g')} FROM rf", _BASE),
)
def q_gating_probs(spark, sf_dir):
    mf = _xrfm(_frame(spark, sf_dir))
    return tidy(mf.select("customer_id", joint.gating_probs(F.col("x"), _params(), _cfg()).alias("g")))


def _sql_tempered():
    logits = _sql_logits("diag")
    out = []
    for k in range(4):
        p = _clip(_sql_expert(W[k]))
        lpy = (f"(CAST(label AS DOUBLE) * ln(greatest({p}, {dbl(1e-12)})) + ({dbl(1.0)} - CAST(label AS DOUBLE)) "
               f"* ln(greatest({dbl(1.0)} - {p}, {dbl(1e-12)})))")
        out.append(f"(({logits[k]} + {dbl(LAMBDA)} * {lpy}) / {dbl(TEMP)})")
    return out


def _estep(mf):
    """The fit's own E-step kernel at the fixed parameters."""
    return joint.estep_frame(mf, _params(), _cfg(), x="x", xf="x")


@register(
    "e_step",
    with_base(f"SELECT {si('customer_id', 'customer_id')}, {sa(_arr_sql(_sql_softmax(_sql_tempered(), 1.0)), 'q')} FROM rf", _BASE),
)
def q_e_step(spark, sf_dir):
    mf = _xrfm(_frame(spark, sf_dir))
    return tidy(_estep(mf).select("customer_id", "q"))


def _sql_lse(vals):
    m = f"greatest({', '.join(vals)})"
    return f"({m} + ln({_acc([f'exp({v} - {m})' for v in vals])}))"


@register("em_loglik", with_base(f"SELECT {sd('sum(' + _sql_lse(_sql_tempered()) + ')', 'loglik')} FROM rf WHERE split = 'train'", _BASE))
def q_em_loglik(spark, sf_dir):
    mf = _xrfm(_frame(spark, sf_dir)).filter(F.col("split") == "train")
    return tidy(_estep(mf).agg(F.sum("loglik").alias("loglik")))


def _soft_train_sql():
    """One row a train row and component, with the component's share of the row."""
    shares = _arr_sql(_sql_softmax(_sql_tempered(), 1.0))
    return f"{_BASE}, soft AS (SELECT {', '.join(XS)}, CAST(label AS DOUBLE) AS y, unnest({shares}) AS q, unnest(range(4)) AS k FROM rf WHERE split = 'train')"


def _m_step(spark, sf_dir):
    mf = _xrfm(_frame(spark, sf_dir)).filter(F.col("split") == "train")
    return joint.m_step(mf.withColumn("xf", F.col("x")), _params(), _cfg(), x="x")


_MEANS = [f"sum(q * {c}) / sum(q)" for c in XS]
_VARS = [f"greatest(sum(q * {c} * {c}) / sum(q) - ({m}) * ({m}) + {dbl(1e-6)}, {dbl(1e-6)})" for c, m in zip(XS, _MEANS)]


@register(
    "m_step_gating",
    with_base(
        f"SELECT {si('k', 'cluster')}, {sd('sum(q)', 'mass')}, {sd('sum(q) / sum(sum(q)) OVER ()', 'pi')}, {sa(_arr_sql(_MEANS), 'mu')}, {sa(_arr_sql(_VARS), 'var')} "
        "FROM soft GROUP BY k",
        _soft_train_sql(),
    ),
)
def q_m_step_gating(spark, sf_dir):
    return tidy(_m_step(spark, sf_dir).select("cluster", "mass", "pi", "mu", "var"))


@register(
    "expert_guard_masses",
    with_base(
        f"SELECT {si('k', 'cluster')}, {sd('pos', 'pos_mass')}, {sd('neg', 'neg_mass')}, {sd('CASE WHEN least(pos, neg) > 1e-12 THEN neg / pos ELSE 1 END', 'pos_weight')}, "
        "CASE WHEN pos + neg <= 1e-12 THEN 'fallback' WHEN least(pos, neg) <= 1e-12 THEN 'constant' ELSE 'fitted' END AS expert "
        "FROM (SELECT k, sum(q * y) AS pos, sum(q * (1 - y)) AS neg FROM soft GROUP BY k) t",
        _soft_train_sql(),
    ),
)
def q_expert_guard_masses(spark, sf_dir):
    return tidy(_m_step(spark, sf_dir).select("cluster", "pos_mass", "neg_mass", "pos_weight", "expert"))


@register("moe_clusters", with_base(f"SELECT {si('customer_id', 'customer_id')}, {si(_sql_argmax(_sql_logits('diag')), 'cluster')} FROM rf", _BASE))
def q_moe_clusters(spark, sf_dir):
    mf = _xrfm(_frame(spark, sf_dir))
    return tidy(mf.select("customer_id", joint.predict_clusters(F.col("x"), _params(), _cfg()).alias("cluster")))


def _sql_moe():
    g = _sql_softmax(_sql_logits("diag"), GATE_TEMP)
    P = [_clip(_sql_expert(w)) for w in W]
    moe = _acc([f"({a} * {b})" for a, b in zip(g, P)])
    out = f"({dbl(1 - ALPHA)} * {moe} + {dbl(ALPHA)} * {_clip(_sql_expert(W_GLOBAL))})"
    return _clip(f"CASE WHEN isnan({out}) OR isinf({out}) THEN {dbl(0.5)} ELSE {out} END")


@register("moe_response", with_base(f"SELECT {si('customer_id', 'customer_id')}, {sd(_sql_moe(), 'p')} FROM rf", _BASE))
def q_moe_response(spark, sf_dir):
    mf = _xrfm(_frame(spark, sf_dir))
    return tidy(mf.select("customer_id", joint.predict_response(F.col("x"), F.col("x"), _params(), _cfg()).alias("p")))


@register(
    "budget_weights",
    with_base(
        f"SELECT {si('customer_id', 'customer_id')}, {sd(f'{dbl(1.0)} + {dbl(1.0)} * CAST(p >= t AS DOUBLE)', 'w_budget')} "
        f"FROM (SELECT customer_id, {_sql_moe()} AS p FROM rf WHERE split = 'train') a, "
        f"(SELECT quantile_cont({_sql_moe()}, {dbl(0.8)}) AS t FROM rf WHERE split = 'train') b",
        _BASE,
    ),
)
def q_budget_weights(spark, sf_dir):
    mf = _xrfm(_frame(spark, sf_dir)).filter(F.col("split") == "train")
    s = mf.select("customer_id", joint.predict_response(F.col("x"), F.col("x"), _params(), _cfg()).alias("p"))
    return tidy(joint.budget_weights(s, "p", 1.0, 0.2).select("customer_id", "w_budget"))


def _sql_cost():
    out = []
    for k in range(4):
        p = CONST_P[k]
        ce = f"(-(CAST(label AS DOUBLE) * {dbl(math.log(p))} + ({dbl(1.0)} - CAST(label AS DOUBLE)) * {dbl(math.log(1 - p))}))"
        out.append(f"(({_acc([_sq(j, MU[k][j]) for j in range(3)])} + {dbl(LAMBDA)} * {ce}) + {dbl(GAMMA * p * (1 - p))})")
    return out


@register(
    "response_aware_assignment",
    with_base(f"SELECT {si('customer_id', 'customer_id')}, {si(_sql_argmin(_sql_cost()), 'cluster')}, {sa(_arr_sql(_sql_cost()), 'cost')} FROM rf", _BASE),
)
def q_response_aware_assignment(spark, sf_dir):
    mf = _xrfm(_frame(spark, sf_dir))
    cost = joint.response_aware_cost(F.col("x"), F.col("label"), MU, CONST_P, LAMBDA, GAMMA)
    return tidy(mf.select("customer_id", soft.argmin(cost).alias("cluster"), cost.alias("cost")))


# ---------------------------------------------------------------- scored-frame model tables
@register(
    "smoothed_cluster_rates",
    with_base(
        f"SELECT {si('k.cluster', 'cluster')}, {sd(f'least(greatest(CASE WHEN n > 0 THEN (CAST(pos AS DOUBLE) + {dbl(1.0)}) / (CAST(n AS DOUBLE) + {dbl(2.0)}) ELSE g END, {dbl(1e-7)}), {dbl(1 - 1e-7)})', 'p')} "
        "FROM (SELECT unnest(range(5)) AS cluster) k LEFT JOIN (SELECT cluster, count(*) AS n, sum(label) AS pos FROM scored GROUP BY cluster) s "
        "ON k.cluster = s.cluster, (SELECT avg(label) AS g FROM scored) t"
    ),
)
def q_smoothed_cluster_rates(spark, sf_dir):
    return tidy(joint.smoothed_cluster_rates(scored(spark, sf_dir), 5))


_Q = "list_transform(qe, lambda x: x / list_sum(qe))"


@register(
    "soft_cluster_rates",
    with_base(
        f"SELECT {si('k - 1', 'cluster')}, {sd(f'least(greatest(sum(qk * label) / greatest(sum(qk), {dbl(1e-12)}), {dbl(1e-7)}), {dbl(1 - 1e-7)})', 'rate')} "
        f"FROM (SELECT label, unnest({_Q}) AS qk, unnest(range(1, 5)) AS k FROM scored) t GROUP BY k"
    ),
)
def q_soft_cluster_rates(spark, sf_dir):
    return tidy(joint.soft_cluster_rates(scored(spark, sf_dir)))


@register(
    "cluster_stats",
    with_base(
        f"SELECT {si('k.cluster', 'cluster')}, {si('coalesce(n, 0)', 'size')}, {sd('rate', 'rate')} "
        "FROM (SELECT unnest(range(5)) AS cluster) k LEFT JOIN (SELECT cluster, count(*) AS n, avg(label) AS rate FROM scored GROUP BY cluster) s "
        "ON k.cluster = s.cluster"
    ),
)
def q_cluster_stats(spark, sf_dir):
    return tidy(joint.cluster_stats(scored(spark, sf_dir), 5))


# ---------------------------------------------------------------- cluster-then-predict scoring with fixed coefficients
def _sql_ctp():
    z = _sql_argmin([_acc([_sq(j, MU[k][j]) for j in range(3)]) for k in range(4)])
    p = "CASE " + " ".join(f"WHEN {z} = {k} THEN {_sql_expert(W[k])}" for k in range(3)) + f" ELSE {dbl(0.5)} END"
    return z, p


@register(
    "cluster_then_predict_score",
    with_base(
        f"SELECT {si('customer_id', 'customer_id')}, {si(_sql_ctp()[0], 'cluster')}, {sd(_sql_ctp()[1], 'p')}, "
        f"{si(f'{_sql_ctp()[1]} >= {dbl(0.5)}', 'pred')} FROM rf",
        _BASE,
    ),
)
def q_cluster_then_predict_score(spark, sf_dir):
    from ..operators.ctp import score_with_clusters

    mf = _xrfm(_frame(spark, sf_dir))
    models = {k: Expert(coef=W[k]) for k in range(3)}  # cluster 3 has no model -> 0.5
    out = score_with_clusters(mf.withColumn("cluster", clu.assign_nearest(F.col("x"), MU)), models, "x")
    return tidy(out.select("customer_id", "cluster", "p", "pred"))


# ---------------------------------------------------------------- unrolled Lloyd iterations (U)
def _sql_lloyd(steps: int = 3):
    ctes = [
        "tr AS (SELECT customer_id, " + ", ".join(XS) + " FROM rf WHERE split = 'train')",
        "c0 AS (SELECT row_number() OVER (ORDER BY md5('init|' || CAST(customer_id AS VARCHAR)), customer_id) - 1 AS k, "
        + ", ".join(XS) + " FROM tr QUALIFY k < 4)",
    ]
    for s in range(steps):
        dist = [
            _acc([f"((tr.{XS[j]} - c.m{k}_{j}) * (tr.{XS[j]} - c.m{k}_{j}))" for j in range(3)]) for k in range(4)
        ]
        cols = ", ".join(f"max(CASE WHEN k = {k} THEN {XS[j]} END) AS m{k}_{j}" for k in range(4) for j in range(3))
        ctes.append(f"w{s} AS (SELECT {cols} FROM c{s})")
        ctes.append(f"a{s} AS (SELECT tr.*, {_sql_argmin(dist)} AS k FROM tr, w{s} c)")
        ctes.append(
            f"c{s + 1} AS (SELECT c.k, " + ", ".join(f"coalesce(n.{x}, c.{x}) AS {x}" for x in XS)
            + f" FROM c{s} c LEFT JOIN (SELECT k, " + ", ".join(f"avg({x}) AS {x}" for x in XS) + f" FROM a{s} GROUP BY k) n ON c.k = n.k)"
        )
    return ", ".join(ctes)


@register(
    "kmeans_lloyd_3steps",
    with_base(f"SELECT {si('k', 'cluster')}, " + ", ".join(sd(x, x) for x in XS) + " FROM c3", _BASE + ", " + _sql_lloyd(3)),
)
def q_kmeans_lloyd_3steps(spark, sf_dir):
    mf = _xrfm(_frame(spark, sf_dir)).filter(F.col("split") == "train")
    c = clu.md5_start(mf, 4, "x")
    for _ in range(3):
        c = clu.lloyd_step(mf, c, "x")
    spark_rows = [(k, *map(float, c[k])) for k in range(4)]
    # centers are K x d numbers computed by Spark aggregates; expose them as a small frame
    return tidy(spark.createDataFrame(spark_rows, "cluster int, recency double, frequency double, monetary double"))


@register(
    "kmeans_inertia",
    with_base(
        "SELECT " + sd(
            "sum(list_min([" + ", ".join(
                _acc([f"((tr.{XS[j]} - c.m{k}_{j}) * (tr.{XS[j]} - c.m{k}_{j}))" for j in range(3)]) for k in range(4)
            ) + "]))", "inertia") + " FROM tr, w3 c",
        _BASE + ", " + _sql_lloyd(3) + ", w3 AS (SELECT " + ", ".join(
            f"max(CASE WHEN k = {k} THEN {XS[j]} END) AS m{k}_{j}" for k in range(4) for j in range(3)) + " FROM c3)",
    ),
)
def q_kmeans_inertia(spark, sf_dir):
    mf = _xrfm(_frame(spark, sf_dir)).filter(F.col("split") == "train")
    c = clu.md5_start(mf, 4, "x")
    for _ in range(3):
        c = clu.lloyd_step(mf, c, "x")
    return tidy(clu.inertia(mf, c, "x"))


# ---------------------------------------------------------------- unrolled iterations of the full-covariance mixture (U)
_TRI = [(a, b) for a in range(3) for b in range(a, 3)]


def _sql_mixture(steps: int = 2):
    """Two components: starts by md5 order, equal weights, identity covariances; closed-form 3 x 3 inverses."""
    start = ", ".join(
        [f"{dbl(0.5)} AS w{k}" for k in range(2)]
        + [f"max(CASE WHEN k = {k} THEN {x} END) AS m{k}_{j}" for k in range(2) for j, x in enumerate(XS)]
        + [f"CAST({int(a == b)} AS DOUBLE) AS s{k}_{a}{b}" for k in range(2) for a, b in _TRI]
    )
    ctes = [f"g0 AS (SELECT {start} FROM c0)"]
    for s in range(steps + 1):
        dens = []
        for k in range(2):
            e = {(a, b): f"p.s{k}_{min(a, b)}{max(a, b)}" for a in range(3) for b in range(3)}

            def minor(a, b, e=e):
                r, c = [i for i in range(3) if i != a], [j for j in range(3) if j != b]
                return f"({(-1) ** (a + b)} * ({e[r[0], c[0]]} * {e[r[1], c[1]]} - {e[r[0], c[1]]} * {e[r[1], c[0]]}))"

            det = "(" + " + ".join(f"{e[0, b]} * {minor(0, b)}" for b in range(3)) + ")"
            d = [f"(t.{x} - p.m{k}_{j})" for j, x in enumerate(XS)]
            quad = "(" + " + ".join(f"{d[a]} * {d[b]} * {minor(a, b)}" for a in range(3) for b in range(3)) + f") / {det}"
            dens.append(f"ln(p.w{k}) - 0.5 * (3 * ln(2 * pi()) + ln({det}) + {quad})")
        source = "rf" if s == steps else "(SELECT * FROM rf WHERE split = 'train')"
        ctes.append(f"l{s} AS (SELECT t.customer_id, {', '.join('t.' + x for x in XS)}, {dens[0]} AS l0, {dens[1]} AS l1 FROM {source} t, g{s} p)")
        ctes.append(f"r{s} AS (SELECT *, 1 / (1 + exp(least(l1 - l0, 700))) AS r0, 1 / (1 + exp(least(l0 - l1, 700))) AS r1 FROM l{s})")
        if s < steps:
            means = ", ".join([f"avg(r{k}) AS w{k}, sum(r{k}) AS n{k}" for k in range(2)] + [f"sum(r{k} * {x}) / sum(r{k}) AS m{k}_{j}" for k in range(2) for j, x in enumerate(XS)])
            ctes.append(f"h{s} AS (SELECT {means} FROM r{s})")
            second = ", ".join(
                f"sum(r{k} * ({XS[a]} - m{k}_{a}) * ({XS[b]} - m{k}_{b})) / max(n{k}) + {dbl(1e-6) if a == b else 0} AS s{k}_{a}{b}"
                for k in range(2) for a, b in _TRI
            )
            kept = ", ".join(f"max({c}) AS {c}" for k in range(2) for c in [f"w{k}", *[f"m{k}_{j}" for j in range(3)]])
            ctes.append(f"g{s + 1} AS (SELECT {kept}, {second} FROM r{s}, h{s})")
    return ", ".join(ctes)


@register(
    "gmm_em_2steps",
    with_base(
        f"SELECT {si('customer_id', 'customer_id')}, {si('CASE WHEN r0 >= r1 THEN 0 ELSE 1 END', 'cluster')}, {sd('r0', 'q0')}, {sd('r1', 'q1')} FROM r2",
        _BASE + ", " + _sql_lloyd(0) + ", " + _sql_mixture(2),
    ),
)
def q_gmm_em_2steps(spark, sf_dir):
    mf = _xrfm(_frame(spark, sf_dir))
    train = mf.filter(F.col("split") == "train")
    means = clu.md5_start(train, 2, "x")
    state = mixture.Mixture(np.full(2, 0.5), means, np.stack([np.eye(3)] * 2))
    for _ in range(2):
        state = mixture.em_steps(train.select("x"), [state])[0][0]
    post = mixture.gmm_posteriors(state, mf, "x")
    return tidy(post.select("customer_id", "cluster", F.col("q")[0].alias("q0"), F.col("q")[1].alias("q1")))


# ---------------------------------------------------------------- quality indices on embeddings (V rows)
def _emb(spark, sf_dir):
    from ..session import table

    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.col("label").alias("cluster"), F.transform("embedding", lambda v: v.cast("double")).alias("x"))


_EMB = (
    "e AS (SELECT vec_id, label AS cluster, CAST(embedding AS DOUBLE[]) AS x FROM embeddings), "
    "el AS (SELECT vec_id, cluster, unnest(x) AS v, unnest(range(1, len(x) + 1)) AS j FROM e), "
    "cen AS (SELECT cluster, j, avg(v) AS c FROM el GROUP BY cluster, j), "
    "cs AS (SELECT cluster, count(*) AS n FROM e GROUP BY cluster)"
)
_SIL_SQ = (
    _EMB + ", pr AS (SELECT a.vec_id, a.cluster AS ca, b.cluster AS cb, "
    "list_sum(list_transform(range(1, len(a.x) + 1), lambda j: (a.x[j] - b.x[j]) * (a.x[j] - b.x[j]))) AS d2 "
    "FROM e a JOIN e b ON a.vec_id <> b.vec_id), "
    "pm AS (SELECT vec_id, ca, cb, sum(d2) AS s FROM pr GROUP BY vec_id, ca, cb), "
    "ab AS (SELECT vec_id, ca, max(CASE WHEN ca = cb THEN s / (cs.n - 1) END) AS a, "
    "min(CASE WHEN ca <> cb THEN s / n2.n END) AS b, max(cs.n) AS n_own "
    "FROM pm JOIN cs ON cs.cluster = pm.ca JOIN cs n2 ON n2.cluster = pm.cb GROUP BY vec_id, ca), "
    "sil AS (SELECT vec_id, ca AS cluster, CASE WHEN n_own <= 1 THEN 0.0 ELSE (b - a) / greatest(a, b) END AS s FROM ab)"
)


@register("silhouette_squared", with_base(f"SELECT {sd('avg(s)', 'silhouette')} FROM sil", _SIL_SQ))
def q_silhouette_squared(spark, sf_dir):
    return tidy(quality.silhouette_squared(_emb(spark, sf_dir)))


@register(
    "silhouette_rows_squared",
    with_base(f"SELECT {si('vec_id', 'id')}, {si('cluster', 'cluster')}, {sd('s', 'silhouette')} FROM sil", _SIL_SQ),
)
def q_silhouette_rows_squared(spark, sf_dir):
    return tidy(quality.silhouette_squared_rows(_emb(spark, sf_dir)))


_SIL_EU = (
    "e AS (SELECT vec_id, label AS cluster, CAST(embedding AS DOUBLE[]) AS x FROM embeddings), "
    "cs AS (SELECT cluster, count(*) AS n FROM e GROUP BY cluster), "
    "pr AS (SELECT a.vec_id, a.cluster AS ca, b.cluster AS cb, "
    "sqrt(list_sum(list_transform(range(1, len(a.x) + 1), lambda j: (a.x[j] - b.x[j]) * (a.x[j] - b.x[j])))) AS d "
    "FROM e a JOIN e b ON a.vec_id <> b.vec_id), "
    "pm AS (SELECT vec_id, ca, cb, sum(d) AS s FROM pr GROUP BY vec_id, ca, cb), "
    "ab AS (SELECT vec_id, ca, max(CASE WHEN ca = cb THEN s / (cs.n - 1) END) AS a, "
    "min(CASE WHEN ca <> cb THEN s / n2.n END) AS b, max(cs.n) AS n_own "
    "FROM pm JOIN cs ON cs.cluster = pm.ca JOIN cs n2 ON n2.cluster = pm.cb GROUP BY vec_id, ca), "
    "sil AS (SELECT vec_id, ca AS cluster, CASE WHEN n_own <= 1 THEN 0.0 ELSE (b - a) / greatest(a, b) END AS s FROM ab)"
)


_INDICES = (
    _EMB + _SIL_EU[_SIL_EU.index(", pr AS"):].replace("sil AS", "sil_eu AS")
    + ", " + _SIL_SQ[len(_EMB) + 2:].replace("pr AS", "pr2 AS").replace("FROM pr ", "FROM pr2 ").replace("pm AS", "pm2 AS").replace("FROM pm ", "FROM pm2 ")
    .replace("pm.", "pm2.").replace("ab AS", "ab2 AS").replace("FROM ab)", "FROM ab2)").replace("sil AS", "sil_sq AS")
)


@register(
    "cluster_scores",
    with_base(
        "SELECT " + ", ".join([
            sd("(SELECT count(*) FROM e)", "n_samples"), sd("(SELECT count(DISTINCT cluster) FROM e)", "n_clusters"),
            sd("(SELECT avg(s) FROM sil_eu)", "silhouette"), sd("(SELECT avg(s) FROM sil_sq)", "silhouette_squared"),
            sd("(SELECT (b / (k - 1)) / (w / (n - k)) FROM "
               "(SELECT sum((v - c) * (v - c)) AS w FROM el JOIN cen USING (cluster, j)) t1, "
               "(SELECT sum(cs.n * (c - gc) * (c - gc)) AS b FROM cen JOIN (SELECT j, avg(v) AS gc FROM el GROUP BY j) g USING (j) "
               "JOIN cs USING (cluster)) t2, (SELECT count(*) AS n, count(DISTINCT cluster) AS k FROM e) t3)", "calinski_harabasz"),
        ]),
        _INDICES,
    ),
)
def q_cluster_scores(spark, sf_dir):
    r = quality.cluster_scores(_emb(spark, sf_dir))
    names = ("n_samples", "n_clusters", "silhouette", "silhouette_squared", "calinski_harabasz")
    return tidy(spark.createDataFrame([tuple(r[n] for n in names)], ", ".join(f"{n} double" for n in names)))


@register("silhouette_exact", with_base(f"SELECT {sd('avg(s)', 'silhouette')} FROM sil", _SIL_EU))
def q_silhouette_exact(spark, sf_dir):
    return tidy(quality.silhouette_euclidean_rows(_emb(spark, sf_dir)).agg(F.avg("silhouette").alias("silhouette")))


@register(
    "silhouette_rows",
    with_base(f"SELECT {si('vec_id', 'id')}, {si('cluster', 'cluster')}, {sd('s', 'silhouette')} FROM sil", _SIL_EU),
)
def q_silhouette_rows(spark, sf_dir):
    return tidy(quality.silhouette_euclidean_rows(_emb(spark, sf_dir)))


@register(
    "calinski_harabasz",
    with_base(
        "SELECT " + sd("(b / (k - 1)) / (w / (n - k))", "calinski_harabasz") + " FROM "
        "(SELECT sum((v - c) * (v - c)) AS w FROM el JOIN cen USING (cluster, j)) t1, "
        "(SELECT sum(cs.n * (c - gc) * (c - gc)) AS b FROM cen JOIN (SELECT j, avg(v) AS gc FROM el GROUP BY j) g USING (j) "
        "JOIN cs USING (cluster)) t2, (SELECT count(*) AS n, count(DISTINCT cluster) AS k FROM e) t3",
        _EMB,
    ),
)
def q_calinski_harabasz(spark, sf_dir):
    return tidy(quality.calinski_harabasz(_emb(spark, sf_dir)))


@register(
    "davies_bouldin",
    with_base(
        "SELECT " + sd("avg(r)", "davies_bouldin") + " FROM (SELECT a.cluster, max((sa.s + sb.s) / cd.d) AS r FROM "
        "(SELECT a.cluster AS ca, b.cluster AS cb, sqrt(sum((a.c - b.c) * (a.c - b.c))) AS d FROM cen a JOIN cen b ON a.j = b.j "
        "AND a.cluster <> b.cluster GROUP BY a.cluster, b.cluster) cd "
        "JOIN (SELECT cluster, avg(dd) AS s FROM (SELECT vec_id, cluster, sqrt(sum((v - c) * (v - c))) AS dd FROM el JOIN cen USING (cluster, j) "
        "GROUP BY vec_id, cluster) x GROUP BY cluster) sa ON sa.cluster = cd.ca "
        "JOIN (SELECT cluster, avg(dd) AS s FROM (SELECT vec_id, cluster, sqrt(sum((v - c) * (v - c))) AS dd FROM el JOIN cen USING (cluster, j) "
        "GROUP BY vec_id, cluster) y GROUP BY cluster) sb ON sb.cluster = cd.cb "
        "JOIN (SELECT DISTINCT cluster FROM e) a ON a.cluster = cd.ca GROUP BY a.cluster) t",
        _EMB,
    ),
)
def q_davies_bouldin(spark, sf_dir):
    return tidy(quality.davies_bouldin(_emb(spark, sf_dir)))
