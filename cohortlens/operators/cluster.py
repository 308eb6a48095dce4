"""Segmentation baselines (G1-G3): K-Means with all restarts in one pass, the Lloyd step.

Centers are tiny (K x d doubles) and travel as literals inside column
expressions; assignments are JVM-side array expressions (no UDF).
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .experts import Rows, kept, sum_vectors
from .soft import argmin

#: Passes that draw start candidates from all rows, and candidates of a pass per cluster.
ROUNDS = 2
OVERSAMPLING = 4


def _lit_array(v) -> Column:
    return F.array(*[F.lit(float(x)) for x in v])


def sq_dist(x: Column, center) -> Column:
    c = _lit_array(center)
    return F.aggregate(F.zip_with(x, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)


def distances(x: Column, centers) -> Column:
    """Array of squared distances to each center."""
    return F.array(*[sq_dist(x, c) for c in centers])


def assign_nearest(x: Column, centers) -> Column:
    """Index of the nearest center (first on ties)."""
    return argmin(distances(x, centers))


def renumber(centers: np.ndarray) -> np.ndarray:
    """Order of centers by ascending coordinates (first, then next on ties)."""
    return np.lexsort(centers.T[::-1])


def _uniform(h: np.ndarray, *salt: int) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit hashes, other ones for each salt."""
    z = h.astype(np.uint64)
    for n in salt:
        z = z + np.uint64((n + 1) * 0x9E3779B97F4A7C15 % 2**64)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
        z = z ^ (z >> np.uint64(31))
    return ((z >> np.uint64(11)).astype(float) + 0.5) / 2.0**53


def _smallest(e: np.ndarray, X: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``size`` points with the smallest keys, in their order; equal keys by coordinates."""
    if len(e) > 4 * size:
        few = e <= np.partition(e, size - 1)[size - 1]
        e, X = e[few], X[few]
    first = np.lexsort([*X.T[::-1], e])[:size]
    return e[first], X[first]


def _draw(rows: DataFrame, candidates, size, turn: int, salts: list[int] | None = None) -> list[np.ndarray]:
    """For each restart ``size`` rows of all (one number, or one a restart), drawn in proportion to the squared distance to its candidates.

    A row's key is an exponential draw over that distance; the rows with the smallest keys are drawn, so a
    partition returns at most that many of them and Arrow tasks merge them in up to two levels. Rows on a
    candidate are not drawn; without candidates all rows weigh the same. Equal ``salts`` draw the same numbers.
    """
    R, spark = len(candidates), rows.sparkSession
    sizes, salts = [int(n) for n in np.broadcast_to(size, R)], salts or list(range(R))
    width = 64 if spark.sparkContext.defaultParallelism > 256 else 1

    def emit(found):
        for i, (e, X) in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(e), i, np.int64)), pa.array(e), pa.array(X.tolist(), pa.list_(pa.float64()))], names=["i", "e", "x"]
            )

    def drawn(batches):
        found, own = {}, TaskContext.get().partitionId() % width
        for batch in batches:
            if not batch.num_rows:
                continue
            X = Rows(batch)["x"]
            h = batch.column(batch.schema.get_field_index("h")).to_numpy(zero_copy_only=False).view(np.uint64)
            draws = {salt: -np.log(_uniform(h, salt, turn)) for salt in set(salts)}
            for r, c in enumerate(candidates):
                e, Y = draws[salts[r]], X
                if len(c):
                    near = _to_nearest(X, c)
                    at = np.flatnonzero(near > 0)
                    e = e[at] / near[at]
                    if len(e) > 4 * sizes[r]:
                        few = e <= np.partition(e, sizes[r] - 1)[sizes[r] - 1]
                        e, at = e[few], at[few]
                    Y = X[at]
                old = found.get(r * width + own)
                if old:
                    e, Y = np.concatenate([old[0], e]), np.concatenate([old[1], Y])
                found[r * width + own] = _smallest(e, Y, sizes[r])
        yield from emit(found)

    def merged(batches, groups):
        found = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers, e, X = batch.column(0).to_numpy(), batch.column(1).to_numpy(), Rows(batch)["x"]
            for i in np.unique(numbers):
                at = numbers == i
                old = found.get(int(i), (np.zeros(0), np.zeros((0, X.shape[1]))))
                found[int(i)] = _smallest(np.concatenate([old[0], e[at]]), np.concatenate([old[1], X[at]]), sizes[int(i) // groups])
        yield from emit(found)

    schema = "i long, e double, x array<double>"
    found = rows.mapInArrow(drawn, schema)
    for groups in [width, 1] if width > 1 else [1]:
        if groups == 1 and width > 1:
            found = found.withColumn("i", F.floor(F.col("i") / width))
        merge = partial(merged, groups=groups)
        found = found.repartition(min(R * groups, spark.sparkContext.defaultParallelism, 256), "i").mapInArrow(merge, schema)
    out = [[] for _ in range(R)]
    for r in found.orderBy("i", "e").collect():  # at most `sizes` rows a restart
        out[r["i"]].append(r["x"])
    return [np.array(o, dtype=float) for o in out]


def _starts(rows: DataFrame, k: int, seed: int, n_init: int) -> np.ndarray:
    """(n_init, k, d) starts of :func:`_starts_of` for one number of clusters."""
    return np.array(_starts_of(rows, [k], seed, n_init))


def _starts_of(rows: DataFrame, ks: list[int], seed: int, n_init: int) -> list[np.ndarray]:
    """For each number of clusters ``n_init`` starts (k, d) from all rows: a few rounds of oversampling by distance,
    then a weighted reduction.

    Each restart begins with one row and draws ``OVERSAMPLING`` x k rows in each of ``ROUNDS`` passes, all
    restarts in the same pass. One more pass counts the rows nearest to each candidate; with these weights
    k-means++ and Lloyd steps over the candidates give the starts.
    """
    own = [(k, r) for k in ks for r in range(n_init)]
    salts = [r for _, r in own]
    first = _draw(rows, [np.zeros((0, 0))] * n_init, 1, 0)
    if not len(first[0]):
        raise ValueError("K-Means needs at least one row")
    candidates = [first[r] for r in salts]
    for turn in range(ROUNDS):
        drawn = _draw(rows, candidates, [OVERSAMPLING * k for k, _ in own], turn + 1, salts)
        candidates = [np.concatenate([c, new]) if len(new) else c for c, new in zip(candidates, drawn)]
    ends = np.cumsum([len(c) for c in candidates])

    def nearest(batch):
        X = batch["x"]
        return np.concatenate([np.bincount(_to_centers(X, c).argmin(1), minlength=len(c)).astype(float) for c in candidates])

    weights = np.split(sum_vectors(rows, nearest, int(ends[-1])), ends[:-1])
    return [_reduced(c, w, k, np.random.default_rng([int(seed), r])) for (k, r), c, w in zip(own, candidates, weights)]


def _to_centers(X: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return (X * X).sum(1)[:, None] - 2.0 * X @ centers.T + (centers * centers).sum(1)[None, :]


def _to_nearest(X: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distance of each row to the nearest center; exactly 0 on one."""
    own, size = (X * X).sum(1), (centers * centers).sum(1)
    near = (own[:, None] - 2.0 * X @ centers.T + size[None, :]).min(1)
    # the product loses digits where a row lies close to a center
    close = np.flatnonzero(near <= 1e-6 * (own + size.max()))
    for at in range(0, len(close), 256):
        some = close[at:at + 256]
        near[some] = ((X[some][:, None, :] - centers[None, :, :]) ** 2).sum(2).min(1)
    return near


def _reduced(points: np.ndarray, weights: np.ndarray, k: int, rng) -> np.ndarray:
    """k centers of weighted points: k-means++, then Lloyd steps until nothing moves."""
    chosen = [points[rng.choice(len(points), p=weights / weights.sum())]]
    near = ((points - chosen[0]) ** 2).sum(1)
    while len(chosen) < k:
        mass = weights * near
        chosen.append(points[rng.choice(len(points), p=mass / mass.sum()) if mass.sum() > 0 else rng.integers(len(points))])
        near = np.minimum(near, ((points - chosen[-1]) ** 2).sum(1))
    centers = np.array(chosen)
    for _ in range(30):
        Z = np.eye(k)[_to_centers(points, centers).argmin(1)] * weights[:, None]
        size = Z.sum(0)[:, None]
        new = np.where(size > 0, Z.T @ points / np.maximum(size, 1e-300), centers)
        if np.array_equal(new, centers):
            break
        centers = new
    return centers


def kmeans_fit(
    df: DataFrame,
    x: str = "xb",
    k: int = 4,
    seed: int = 42,
    n_init: int = 10,
    max_iter: int = 300,
    tol: float = 1e-4,
    key: str = "customer_id",
) -> tuple[np.ndarray, float]:
    """G1: K-Means with ``n_init`` restarts, lowest cost kept (:func:`kmeans_fits` with one number of clusters)."""
    return kmeans_fits(df, x, [k], seed, n_init, max_iter, tol, key)[0]


def kmeans_fits(
    df: DataFrame,
    x: str,
    ks,
    seed: int = 42,
    n_init: int = 10,
    max_iter: int = 300,
    tol: float = 1e-4,
    key: str = "customer_id",
) -> list[tuple[np.ndarray, float]]:
    """G1 for several numbers of clusters, fitted side by side: (centers, cost) of each, as alone.

    All restarts of all ``ks`` move together: one pass over the rows per iteration adds up, for every
    restart that still moves, the sums and sizes of its clusters and its cost, so 30 restarts cost as many
    jobs as one. Only R x K x d numbers reach the driver. A restart stops when its centers move by less than
    ``tol`` times the mean variance; an empty cluster keeps its center. Starts are drawn from all rows
    (:func:`_starts_of`) by hashes of ``key`` and coordinates; in a frame without ``key`` equal rows draw
    the same number. Centers are renumbered by :func:`renumber`; the cost is that of the training rows.
    """
    ks, n_init = [int(k) for k in ks], max(1, int(n_init))
    own = [F.col(key).cast("string")] if key in df.columns else []
    rows = df.select(
        F.transform(F.col(x), lambda v: v.cast("double")).alias("x"), F.xxhash64(F.lit(int(seed)), *own, F.col(x)).alias("h")
    )
    centers = _starts_of(rows, ks, seed, n_init)
    with kept(rows.select("x")) as values:
        cost = _moved(values, centers, int(max_iter), tol)
    out = []
    for j in range(len(ks)):
        best = min(range(j * n_init, (j + 1) * n_init), key=lambda i: cost[i])
        out.append((centers[best][renumber(centers[best])], float(cost[best])))
    return out


def _nearest_sums(X: np.ndarray, at: list) -> list[np.ndarray]:
    """For each of the centers ``at`` (k, d) sums of the nearest rows, k sizes and the cost, neighbours with equal k together."""
    own, out, i = (X * X).sum(1), [], 0
    while i < len(at):
        k = len(at[i])
        j = next((j for j in range(i, len(at)) if len(at[j]) != k), len(at))
        C = np.concatenate(at[i:j])
        near = C @ X.T
        near *= -2.0
        near += own
        near += (C * C).sum(1)[:, None]
        near = near.reshape(j - i, k, -1)
        best, first = near[:, 0].copy(), np.zeros((j - i, len(X)), np.int32)
        for c in range(1, k):
            first[near[:, c] < best] = c
            np.minimum(best, near[:, c], out=best)
        Z = (first[:, None, :] == np.arange(k, dtype=np.int32)[None, :, None]).astype(float).reshape(-1, len(X))
        sums, sizes, cost = (Z @ X).reshape(j - i, -1), Z.sum(1).reshape(j - i, k), np.clip(best, 0.0, None).sum(1)
        out.append(np.column_stack([sums, sizes, cost]).ravel())
        i = j
    return out


def _moved(rows, centers: list, max_iter: int, tol: float) -> np.ndarray:
    """Lloyd steps of all restarts in the same passes: ``centers`` are moved in place; their costs."""
    d = centers[0].shape[1]

    def step(at: list) -> np.ndarray:
        """For each of the centers ``at`` (k, d) sums, k sizes and the cost; then the sums of x and x*x."""

        def kernel(batch):
            X = batch["x"]
            return np.concatenate([*_nearest_sums(X, at), X.sum(0), (X * X).sum(0)])

        return sum_vectors(rows, kernel, sum(len(c) * (d + 1) + 1 for c in at) + 2 * d)

    moving, cost = list(range(len(centers))), np.full(len(centers), np.inf)
    for it in range(max_iter + 1):
        s = step([centers[i] for i in moving])
        moments, at, still = s[-2 * d:], 0, []
        for i in moving:
            k = len(centers[i])
            sums, sizes = s[at:at + k * d].reshape(k, d), s[at + k * d:at + k * (d + 1)]
            cost[i] = s[at + k * (d + 1)]
            at += k * (d + 1) + 1
            n = max(sizes.sum(), 1.0)
            variance = float(np.mean(moments[d:] / n - (moments[:d] / n) ** 2))
            new = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1.0)[:, None], centers[i])
            if it < max_iter and ((new - centers[i]) ** 2).sum() > tol * variance:
                centers[i] = new  # a restart at rest keeps the centers that its cost belongs to
                still.append(i)
        moving = still
        if not moving:
            break
    return cost


def inertia(df: DataFrame, centers, x: str = "xb") -> DataFrame:
    """Sum of squared distances to the nearest center."""
    return df.agg(F.sum(F.array_min(distances(F.col(x), centers))).alias("inertia"))


def lloyd_step(df: DataFrame, centers, x: str = "xb") -> np.ndarray:
    """Assign to the nearest center and recompute means; empty clusters keep their center."""
    d = len(centers[0])
    a = df.select(assign_nearest(F.col(x), centers).alias("k"), F.col(x).alias("x"))
    rows = a.groupBy("k").agg(*[F.avg(F.col("x")[j]).alias(f"m{j}") for j in range(d)]).collect()  # K rows
    new = np.array(centers, dtype=float).copy()
    for r in rows:
        new[r["k"]] = [r[f"m{j}"] for j in range(d)]
    return new


def md5_start(df: DataFrame, k: int, x: str = "xb", key: str = "customer_id", tag: str = "init") -> np.ndarray:
    """Deterministic start: the K rows with the smallest ``md5(tag|key)`` (U-query starts)."""
    h = F.md5(F.concat(F.lit(f"{tag}|"), F.col(key).cast("string")))
    rows = df.select(h.alias("h"), F.col(key), F.col(x)).orderBy("h", key).limit(k).collect()  # top-k by design
    return np.array([r[x] for r in rows], dtype=float)
