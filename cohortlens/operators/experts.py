"""Response experts.

* Single weighted logistic fits use MLlib ``LogisticRegression`` with
  ``regParam = 1 / (C * sum(w))`` and ``standardization=False``, which is the
  ``C``-form objective ``C * sum(w * loss) + ||beta||^2 / 2``.
* Many experts at once (one per segment plus a global one, refitted every EM
  iteration) use a fused Newton solver: every pass is one ``mapInArrow`` over
  the cached rows that emits, per partition and expert, the weighted gradient
  and Hessian sums; Spark adds them up with a grouped sum and the driver solves
  the small ``(D+1) x (D+1)`` systems. Per-row weights are computed inside the
  pass from broadcast parameters, so no weight column is ever materialised.
"""

from __future__ import annotations

import pickle
from contextlib import nullcontext
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import md5_unit

P_CLIP = 1e-7


@dataclass
class Expert:
    """Logistic expert ``sigmoid(b + w.x)`` or a constant probability."""

    coef: np.ndarray | None = None  # (D+1,) intercept first
    const: float | None = None

    def predict(self, X: np.ndarray) -> np.ndarray:
        if self.coef is None:
            return np.full(X.shape[0], float(np.clip(self.const, P_CLIP, 1 - P_CLIP)))
        eta = self.coef[0] + X @ self.coef[1:]
        return 1.0 / (1.0 + np.exp(-eta))

    def column(self, xf: str = "xf"):
        """Same probability as a JVM column expression over an array column."""
        if self.coef is None:
            return F.lit(float(np.clip(self.const, P_CLIP, 1 - P_CLIP)))
        w = F.array(*[F.lit(float(v)) for v in self.coef[1:]])
        eta = F.lit(float(self.coef[0])) + F.aggregate(F.zip_with(F.col(xf), w, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))


def balance_factors(pos_mass: np.ndarray, neg_mass: np.ndarray, rule: str | None):
    """Multipliers for (negative, positive) rows per expert.

    ``mass``  (G15): positives times neg/pos, negatives unchanged.
    ``class_weight``: sklearn's ``balanced``: total / (2 * class mass).
    """
    pos_mass = np.asarray(pos_mass, float)
    neg_mass = np.asarray(neg_mass, float)
    ones = np.ones_like(pos_mass)
    ok = (pos_mass > 1e-12) & (neg_mass > 1e-12)
    if rule == "mass":
        return ones, np.where(ok, neg_mass / np.where(ok, pos_mass, 1.0), 1.0)
    if rule == "class_weight":
        tot = pos_mass + neg_mass
        return (
            np.where(ok, tot / (2 * np.where(ok, neg_mass, 1.0)), 1.0),
            np.where(ok, tot / (2 * np.where(ok, pos_mass, 1.0)), 1.0),
        )
    return ones, ones


def expert_kind(pos_mass: float, neg_mass: float) -> str:
    """``fallback`` (no mass), ``constant`` (one class alone) or ``fitted``."""
    total = pos_mass + neg_mass
    if not np.isfinite(total) or total <= 1e-12:
        return "fallback"
    return "constant" if min(pos_mass, neg_mass) <= 1e-12 else "fitted"


class Rows:
    """Columns of an Arrow batch: arrays as (n, d) matrices without copies, numbers as series."""

    def __init__(self, batch=None):
        self.n, self.columns = batch.num_rows if batch is not None else 0, {}
        for name, c in zip(batch.schema.names, batch.columns) if batch is not None else ():
            if pa.types.is_list(c.type):
                self.columns[name] = c.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(self.n, -1)
            else:
                self.columns[name] = pd.Series(c.to_numpy(zero_copy_only=False))

    @classmethod
    def unpacked(cls, data: bytes) -> "Rows":
        """Rows as :class:`Chunks` holds them."""
        rows = cls()
        rows.n, columns = pickle.loads(data)
        rows.columns = {name: c if c.ndim > 1 else pd.Series(c) for name, c in columns.items()}
        return rows

    def packed(self) -> bytes:
        return pickle.dumps((self.n, {name: np.ascontiguousarray(c) if isinstance(c, np.ndarray) else c.to_numpy() for name, c in self.columns.items()}), 5)

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, name: str):
        return self.columns[name]


#: Numbers of a vector that are added up together.
VECTOR_PART = 8192
#: Rows of a chunk: a kernel's matrices of these rows stay small.
CHUNK_ROWS = 2048
#: Numbers that the parts of a table together may send straight to the driver for one sum.
DIRECT = 1_000_000


class Chunks:
    """The rows of a frame as NumPy matrices of ``CHUNK_ROWS`` rows, kept for the passes of a fit (``with kept(df) as rows``).

    A pass over a cached frame turns every number into an Arrow value again; a chunk is handed to the
    kernel as the bytes that it is. Chunks that do not fit in memory go to disk, lost ones are made anew.
    """

    def __init__(self, df: DataFrame):
        def pack(batches):
            for batch in batches:
                for at in range(0, batch.num_rows, CHUNK_ROWS):
                    yield pa.RecordBatch.from_arrays([pa.array([Rows(batch.slice(at, CHUNK_ROWS)).packed()], pa.binary())], ["rows"])

        self.sparkSession = df.sparkSession
        self.rdd = df.mapInArrow(pack, "rows binary").rdd.persist(StorageLevel.MEMORY_AND_DISK)
        self.parts = self.rdd.getNumPartitions()

    def __enter__(self) -> "Chunks":
        return self

    def __exit__(self, *_):
        self.rdd.unpersist()

    def select(self, *_) -> "Chunks":
        """All columns: a kernel takes what it needs."""
        return self

    def sum(self, kernel, length: int) -> np.ndarray:
        """:func:`sum_vectors` over the chunks; up to ``DIRECT`` numbers go straight to the driver."""
        pieces = -(-length // VECTOR_PART)
        straight = self.parts * length <= DIRECT
        width = 64 if not straight and self.sparkSession.sparkContext.defaultParallelism > 256 else 1

        def run(chunks):
            total = None
            for chunk in chunks:
                v = kernel(Rows.unpacked(chunk[0]))
                total = np.array(v, dtype=float) if total is None else np.add(total, v, out=total)
            if total is None:
                return
            group = TaskContext.get().partitionId() % width
            yield from [(0, total)] if straight else ((i * width + group, total[i * VECTOR_PART:(i + 1) * VECTOR_PART]) for i in range(pieces))

        found = self.rdd.mapPartitions(run)
        if not straight:
            found = found.reduceByKey(lambda a, b: a + b, min(pieces * width, 256))
            if width > 1:
                found = found.map(lambda p: (p[0] // width, p[1])).reduceByKey(lambda a, b: a + b, min(pieces, 256))
        out = np.zeros(length)
        for i, v in found.collect():
            out[i * VECTOR_PART:i * VECTOR_PART + len(v)] += v
        return out


def kept(df):
    """``df`` as :class:`Chunks`; chunks stay as they are and belong to who made them."""
    return nullcontext(df) if isinstance(df, Chunks) else Chunks(df)


def _added(batches):
    """Rows (i, v): the sum of the arrays ``v`` of each ``i``, one array at a time."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
            v = v.values.to_numpy()
            sums[i] = sums[i] + v if i in sums else v.copy()
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(list(sums.values()), pa.list_(pa.float64()))], ["i", "v"])


def sum_vectors(df: DataFrame | Chunks, kernel, length: int) -> np.ndarray:
    """The sum of the vectors of ``length`` numbers that ``kernel(rows)`` gives, over all batches of ``df``.

    A partition adds its batches up and returns one vector in parts. Equal parts meet in Arrow tasks that
    add them one by one, in two levels where the session is wide, so neither a task nor the driver holds
    a vector of every partition; the driver gets the sum.
    """
    if isinstance(df, Chunks):
        return df.sum(kernel, int(length))
    spark = df.sparkSession
    length = int(length)
    parts = -(-length // VECTOR_PART)
    levels = [64, 1] if spark.sparkContext.defaultParallelism > 256 else [1]
    width = levels[0]

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                v = kernel(Rows(batch))
                total = v if total is None else total + v
        if total is not None:
            group = TaskContext.get().partitionId() % width
            cut = [total[i * VECTOR_PART:(i + 1) * VECTOR_PART] for i in range(parts)]
            yield pa.RecordBatch.from_arrays([pa.array([i * width + group for i in range(parts)], pa.int64()), pa.array(cut, pa.list_(pa.float64()))], ["i", "v"])

    found = df.mapInArrow(run, "i long, v array<double>")
    for level, groups in enumerate(levels):
        if level:
            found = found.withColumn("i", F.floor(F.col("i") / width))
        found = found.repartition(min(parts * groups, 256), "i").mapInArrow(_added, "i long, v array<double>")
    table, out = found.toArrow(), np.zeros(length)
    for i, v in zip(table.column("i").to_pylist(), table.column("v")):
        out[i * VECTOR_PART:i * VECTOR_PART + len(v)] = v.values.to_numpy()
    return out


def _to_arrays(rows, col: str) -> np.ndarray:
    if isinstance(rows, Rows):
        return rows[col]
    return np.stack(rows[col].to_numpy()) if len(rows) else np.zeros((0, 0))


def stats_length(dim: int) -> int:
    """Per expert and class: gradient (D+1), Hessian upper triangle, loss, weight mass."""
    D1 = dim + 1
    return D1 + D1 * (D1 + 1) // 2 + 2


#: From this number of experts the products of two features are formed once and serve all Hessians.
MANY_EXPERTS = 16
PRODUCT_ROWS = 2048  # rows whose products are formed at once


def expert_stats_np(X: np.ndarray, y: np.ndarray, W: np.ndarray, B: np.ndarray) -> np.ndarray:
    """(A, 2, L) sums per expert and class (0 = negative, 1 = positive rows) at coefficients B (A, D+1).

    Keeping the classes apart lets the driver apply any balancing factor after
    the pass, so the masses and the first Newton step come out of one scan.
    """
    n, d = X.shape
    D1 = d + 1
    tri = np.triu_indices(D1)
    X1 = np.hstack([np.ones((n, 1)), X])
    eta = X1 @ B.T
    p = 1.0 / (1.0 + np.exp(-eta))
    out = np.zeros((B.shape[0], 2, stats_length(d)))
    for c in (0, 1):
        m = y == c
        if not m.any():
            continue
        Xc, yc = X1[m], y[m]
        if B.shape[0] >= MANY_EXPERTS:
            Wc, pc, ec = W[m], p[m], eta[m]
            out[:, c, :D1] = (Wc * (pc - yc[:, None])).T @ Xc
            H, curve = np.zeros((B.shape[0], len(tri[0]))), Wc * pc * (1 - pc)
            for at in range(0, len(Xc), PRODUCT_ROWS):
                part = Xc[at:at + PRODUCT_ROWS]
                H += curve[at:at + PRODUCT_ROWS].T @ (part[:, tri[0]] * part[:, tri[1]])
            out[:, c, D1:-2] = H
            out[:, c, -2] = (Wc * (np.logaddexp(0.0, ec) - yc[:, None] * ec)).sum(0)
            out[:, c, -1] = Wc.sum(0)
            continue
        for j in range(B.shape[0]):
            w = W[m, j]
            pj = p[m, j]
            g = Xc.T @ (w * (pj - yc))
            h = (Xc * (w * pj * (1 - pj))[:, None]).T @ Xc
            loss = np.sum(w * (np.logaddexp(0.0, eta[m, j]) - yc * eta[m, j]))
            out[j, c] = np.r_[g, h[tri], loss, w.sum()]
    return out


def _stats_pass(df: DataFrame, weight_fn, cols: np.ndarray, B: np.ndarray, xf: str, label: str) -> np.ndarray:
    L = stats_length(B.shape[1] - 1)

    def kernel(rows):
        return expert_stats_np(_to_arrays(rows, xf), rows[label].to_numpy(float), weight_fn(rows)[:, cols], B).ravel()

    return sum_vectors(df, kernel, len(cols) * 2 * L).reshape(len(cols), 2, L)


def fit_experts(
    df: DataFrame,
    weight_fn,
    n_experts: int,
    dim: int,
    C: float = 1.0,
    balance: str | None = "mass",
    fallback_p: float = 0.5,
    max_newton: int = 30,
    tol: float = 1e-7,
    xf: str = "xf",
    label: str = "label",
    init: list | None = None,
    first: np.ndarray | None = None,
    masses: tuple | None = None,
    stats=None,
) -> list:
    """Fit ``n_experts`` weighted L2 logistic experts at once (fused Newton, G14 guards).

    Minimises ``C * sum(w * loss) + ||beta||^2 / 2`` (intercept not penalised).
    ``init`` warm-starts from previous coefficients; ``first`` are the statistics
    at those coefficients when a caller already computed them in its own pass
    (the EM step does, inside the E-step scan). Steps that raise the objective
    are halved, so Newton stays monotone from any start. ``stats(rows, experts, B)`` gives the statistics
    of some experts at coefficients ``B``; without it they come from ``weight_fn``.
    """
    with kept(df) as rows:
        stats = stats or (lambda rows, cols, B: _stats_pass(rows, weight_fn, cols, B, xf, label))
        return _fit_experts(rows, stats, n_experts, dim, C, balance, fallback_p, max_newton, tol, init, first, masses)


def _fit_experts(df, stats, n_experts, dim, C, balance, fallback_p, max_newton, tol, init, first, masses) -> list:
    D1 = dim + 1
    tri = np.triu_indices(D1)
    n_tri = len(tri[0])

    def start(e):
        if init is not None and e < len(init) and init[e] is not None and init[e].coef is not None:
            return np.array(init[e].coef, float)
        return np.zeros(D1)

    all_cols = np.arange(n_experts)
    beta = {e: start(e) for e in range(n_experts)}
    st = first if first is not None else stats(df, all_cols, np.stack([beta[e] for e in all_cols]))
    neg, pos = st[:, 0, -1], st[:, 1, -1]
    if masses is not None:
        pos, neg = np.asarray(masses[0], float), np.asarray(masses[1], float)
    experts: list = [None] * n_experts
    active = []
    for e in range(n_experts):
        kind = expert_kind(pos[e], neg[e])
        if kind == "fallback":
            experts[e] = Expert(const=fallback_p)
        elif kind == "constant":
            experts[e] = Expert(const=pos[e] / max(pos[e] + neg[e], 1e-12))
        else:
            active.append(e)
    if not active:
        return experts
    f_neg, f_pos = balance_factors(pos, neg, balance)
    reg = np.ones(D1)
    reg[0] = 0.0  # intercept not penalised
    cur = {e: st[e] for e in active}
    prev_obj = {e: None for e in active}
    prev_beta = {e: None for e in active}
    prev_step = {e: None for e in active}
    done = {e: False for e in active}

    def combine(e, s):
        v = f_neg[e] * s[0] + f_pos[e] * s[1]
        g = C * v[:D1] + reg * beta[e]
        H = np.zeros((D1, D1))
        H[tri] = C * v[D1 : D1 + n_tri]
        H = H + H.T - np.diag(np.diag(H)) + np.diag(reg)
        obj = C * v[D1 + n_tri] + 0.5 * float(reg @ (beta[e] ** 2))
        return g, H, obj

    for _ in range(max_newton):
        moving = []
        for e in active:
            if done[e]:
                continue
            g, H, obj = combine(e, cur[e])
            if prev_obj[e] is not None and obj > prev_obj[e] + 1e-12 * max(1.0, abs(prev_obj[e])):
                # the last step overshot: go back half way and re-evaluate
                prev_step[e] = prev_step[e] / 2.0
                beta[e] = prev_beta[e] - prev_step[e]
                if np.max(np.abs(prev_step[e])) <= tol:
                    beta[e] = prev_beta[e]
                    done[e] = True
                else:
                    moving.append(e)
                continue
            step = np.linalg.solve(H + 1e-12 * np.eye(D1), g)
            size, last = np.max(np.abs(step)), np.inf if prev_step[e] is None else np.max(np.abs(prev_step[e]))
            prev_obj[e], prev_beta[e], prev_step[e] = obj, beta[e].copy(), step
            beta[e] = beta[e] - step
            # steps shrink as their squares: where the next one is far below tol, no pass is needed to see it
            if size <= tol or (last < 0.1 and size < 0.1 * last and size * (size / last) ** 2 <= 0.01 * tol):
                done[e] = True
            else:
                moving.append(e)
        if not moving:
            break
        cols = np.array(moving)
        new = stats(df, cols, np.stack([beta[e] for e in moving]))
        for j, e in enumerate(moving):
            cur[e] = new[j]
    for e in active:
        experts[e] = Expert(coef=beta[e])
    return experts


def fit_logistic_mllib(df: DataFrame, features_col: str, label: str = "label", weight_col: str | None = None, C: float = 1.0, max_iter: int = 400):
    """L1 for a single model with MLlib (built-in, distributed L-BFGS)."""
    total = df.agg(F.sum(F.col(weight_col)) if weight_col else F.count(F.lit(1))).first()[0]
    lr = LogisticRegression(
        featuresCol=features_col,
        labelCol=label,
        maxIter=max_iter,
        regParam=1.0 / (C * float(total)),
        elasticNetParam=0.0,
        standardization=False,
        tol=1e-7,
    )
    if weight_col:
        lr = lr.setWeightCol(weight_col)
    return lr.fit(df)


def class_weight_balanced(df: DataFrame, label: str = "label", out: str = "w") -> DataFrame:
    """sklearn ``class_weight='balanced'``: n / (2 * n_class) as a weight column."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    total = df.agg(F.count(F.lit(1)).alias("_n"))
    w = counts.crossJoin(F.broadcast(total)).select(label, (F.col("_n") / (2.0 * F.col("_nc"))).alias(out))
    return df.join(F.broadcast(w), label)  # one row per class


# Fixed values of the boosted expert.
BOOSTING = {"rounds": 200, "depth": 3, "rate": 0.05, "least_rows": 20, "validation_share": 0.1}


def fit_boosted(df: DataFrame, features_col: str, label: str = "label", weight_col: str | None = None, rounds: int = BOOSTING["rounds"], seed: int = 42,
                key: str | None = "customer_id"):
    """L2: boosted trees (depth 3, rate 0.05, min leaf 20, up to 200 rounds) with MLlib ``GBTClassifier``.

    A share of the rows, chosen by the md5 of ``key``, is kept out of the fit; it ends when their loss
    rises. Without ``key``, or if that share is empty, all rows are fitted for all rounds.
    """
    gbt = GBTClassifier(
        featuresCol=features_col, labelCol=label, maxDepth=BOOSTING["depth"], stepSize=BOOSTING["rate"], maxIter=rounds,
        minInstancesPerNode=BOOSTING["least_rows"], maxBins=255, seed=seed,
    )
    if weight_col:
        gbt = gbt.setWeightCol(weight_col)
    if key:
        marked = df.withColumn("held_out", md5_unit(F.lit(f"boosting|{seed}"), F.col(key)) < BOOSTING["validation_share"])
        if not marked.filter("held_out").isEmpty():
            df, gbt = marked, gbt.setValidationIndicatorCol("held_out").setParams(validationTol=0.0)
    return gbt.fit(df)
