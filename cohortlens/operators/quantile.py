"""Exact quantiles of many columns, in all or by group, by selection inside bands.

A first scan counts the values of each column and takes a mergeable sketch, which gives two bounds
around every wanted quantile. A second scan counts what lies below a band and keeps the values inside
it, a few in ten thousand; the wanted places are read off those. Nothing is sorted, and a value that
fills most of a column is a bound with a count. A band with more than ``GATHERED`` values inside is
written to the shared folder and searched in the same way. Counts are exact, so a sketch beyond its
error shows: the band is then widened. Interpolation is linear between neighbours, as in
``percentile``; NULL and NaN are left out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import written

ACCURACY = 10_000  # of the sketch: its ranks are off by at most one in this many
MARGIN = 3.0 / ACCURACY
GATHERED = 100_000  # values of one band that may come to the driver

_FOUND = "band int, below long, at_lo long, at_hi long, prev double, next double, inside array<double>"


def exact_quantiles(df: DataFrame, columns: dict[str, Column], fractions) -> dict[str, list[float] | None]:
    """For each named expression its quantiles at ``fractions``; None for a column without values."""
    return grouped_quantiles(df, [], columns, fractions)[()]


def grouped_quantiles(df: DataFrame, groups: list[str], columns: dict[str, Column], fractions) -> dict[tuple, dict]:
    """Quantiles of each named expression in each group, by group key: ``{key: {name: [..] or None}}``.

    The groups are few, since the result is a dict. Rows without a group are a group of their own.
    """
    fractions = [float(f) for f in fractions]
    rows = df.select(*[F.col(g).alias(f"g{i}") for i, g in enumerate(groups)], *_values(columns.values()))
    asked = [(f, lambda n, f=f: (math.floor(f * (n - 1)), math.ceil(f * (n - 1)))) for f in fractions]
    picked = _select(rows, len(groups), len(columns), fractions, lambda key: asked)
    out = {}
    for key, sizes, found in picked:
        out[key] = {}
        for c, name in enumerate(columns):
            n = sizes[c]
            out[key][name] = [_between(f * (n - 1), *found[c, i]) for i, f in enumerate(fractions)] if n else None
    return out


def _values(columns) -> list[Column]:
    doubles = [c.cast("double") for c in columns]
    return [F.when(~F.isnan(c), c).alias(f"v{i}") for i, c in enumerate(doubles)]


def _between(place: float, a: float, b: float) -> float:
    lo, hi = math.floor(place), math.ceil(place)
    return a if lo == hi else (hi - place) * a + (place - lo) * b


def _select(rows: DataFrame, n_keys: int, n_cols: int, near, asked, margin: float = MARGIN) -> list[tuple]:
    """Values at places of the sorted columns ``v0..`` of each group of ``g0..``.

    ``asked(key)`` lists for a group (fraction near the places, function from the number of values to
    the places); ``near`` holds all these fractions. Returns (key, sizes, {(column, ask): values}).
    """
    keys = [f"g{i}" for i in range(n_keys)]
    cuts = sorted({min(max(f + s * margin, 0.0), 1.0) for f in near for s in (-1, 1)})
    sketch = F.array(*[F.lit(c) for c in cuts])
    aggs = [F.count(f"v{c}").alias(f"n{c}") for c in range(n_cols)]
    aggs += [F.percentile_approx(f"v{c}", sketch, ACCURACY).alias(f"q{c}") for c in range(n_cols)]
    table = rows.groupBy(*keys).agg(*aggs).collect()  # one row a group

    bands = []  # (group, column, ask, lo, hi, places)
    for g, r in enumerate(table):
        for c in range(n_cols):
            n = r[f"n{c}"]
            for i, (f, places) in enumerate(asked(tuple(r[k] for k in keys)) if n else []):
                lo, hi = (r[f"q{c}"][cuts.index(min(max(f + s * margin, 0.0), 1.0))] for s in (-1, 1))
                bands.append((g, c, i, lo, hi, places(n), n))
    numbered = _numbered(rows, keys, table)
    few = [(2 * margin + 2.0 / ACCURACY) * b[6] <= GATHERED for b in bands]
    found = {r["band"]: r for r in _scan(numbered, bands, few).collect()}  # one row a band

    values, beyond, uncovered = {}, {}, False
    for b, (g, c, i, lo, hi, places, _) in enumerate(bands):
        r = found[b]
        first_in, size_in = r["below"] + r["at_lo"], r["size"]
        end = first_in + size_in + r["at_hi"]
        inside = np.sort(np.asarray(r["inside"], float)) if few[b] else None
        got = []
        for p in places:
            if r["below"] <= p < first_in:
                got.append(lo)
            elif first_in <= p < first_in + size_in:
                if inside is None:
                    beyond.setdefault(b, []).append(p - first_in)
                got.append(None if inside is None else float(inside[p - first_in]))
            elif first_in + size_in <= p < end:
                got.append(hi)
            elif p == r["below"] - 1:
                got.append(r["prev"])
            elif p == end:
                got.append(r["next"])
            else:
                uncovered = True
        values[b] = got
    if uncovered:
        return _select(rows, n_keys, n_cols, near, asked, margin * 8)
    if beyond:
        _fill(numbered, bands, found, beyond, values)

    out = [(tuple(r[k] for k in keys), [r[f"n{c}"] for c in range(n_cols)], {}) for r in table]
    for b, (g, c, i, *_) in enumerate(bands):
        out[g][2][c, i] = values[b]
    return out


def _numbered(rows: DataFrame, keys, table) -> DataFrame:
    """``rows`` with the number of their group instead of its key."""
    columns = [c for c in rows.columns if c not in keys]
    if not keys:
        return rows.select(F.lit(0).alias("g"), *columns)
    types = dict(rows.dtypes)
    few = rows.sparkSession.createDataFrame(
        [(g, *[r[k] for k in keys]) for g, r in enumerate(table)], ", ".join(["g int"] + [f"k_{k} {types[k]}" for k in keys])
    )
    same = [rows[k].eqNullSafe(few[f"k_{k}"]) for k in keys]
    return rows.join(F.broadcast(few), same).select("g", *columns)  # one row a group


def _parts(batch: pa.RecordBatch, bands):
    """(band number, its values of the batch) for every band."""
    group = batch.column(0).to_numpy(zero_copy_only=False)
    at, last = None, None
    for b, (g, c, _, lo, hi, *_) in enumerate(bands):
        if (g, c) != last:
            v = batch.column(c + 1).to_numpy(zero_copy_only=False)[group == g]
            at, last = v[~np.isnan(v)], (g, c)
        yield b, lo, hi, at


def _scan(numbered: DataFrame, bands, few) -> DataFrame:
    """Counts below, at and inside each band, its neighbours, and the values inside where they are few."""

    def counted(batches):
        below, at_lo, at_hi, size = (np.zeros(len(bands), np.int64) for _ in range(4))
        prev, following = np.full(len(bands), -np.inf), np.full(len(bands), np.inf)
        kept = [[] for _ in bands]
        for batch in batches:
            for b, lo, hi, v in _parts(batch, bands):
                under, over = v[v < lo], v[v > hi]
                inner = v[(v > lo) & (v < hi)]
                below[b] += len(under)
                at_lo[b] += int((v == lo).sum())
                at_hi[b] += int((v == hi).sum()) if hi > lo else 0
                size[b] += len(inner)
                if len(under):
                    prev[b] = max(prev[b], under.max())
                if len(over):
                    following[b] = min(following[b], over.min())
                if few[b] and len(inner):
                    kept[b].append(inner)
        lists = [np.concatenate(k).tolist() if k else [] for k in kept]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(bands), dtype=np.int32)), pa.array(below), pa.array(at_lo), pa.array(at_hi),
             pa.array(prev), pa.array(following), pa.array(lists, pa.list_(pa.float64())), pa.array(size)],
            names=["band", "below", "at_lo", "at_hi", "prev", "next", "inside", "size"],
        )

    parts = numbered.mapInArrow(counted, _FOUND + ", size long")
    return parts.groupBy("band").agg(
        *[F.sum(c).alias(c) for c in ("below", "at_lo", "at_hi", "size")],
        F.max("prev").alias("prev"), F.min("next").alias("next"), F.flatten(F.collect_list("inside")).alias("inside"),
    )


def _fill(numbered: DataFrame, bands, found, beyond, values) -> None:
    """Places inside bands with many values: those values are a table of their own, grouped by band."""
    wide = {b: bands[b] for b in beyond}

    def inner(batches):
        for batch in batches:
            for b, lo, hi, v in _parts(batch, bands):
                if b in wide:
                    v = v[(v > lo) & (v < hi)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), b, np.int32)), pa.array(v)], names=["g0", "v0"])

    table = written(numbered.mapInArrow(inner, "g0 int, v0 double"), "bands")
    asks = {b: [(p / max(found[b]["size"] - 1, 1), lambda n, p=p: (p,)) for p in ps] for b, ps in beyond.items()}
    near = sorted({f for a in asks.values() for f, _ in a})
    for (b,), _, got in _select(table, 1, 1, near, lambda key: asks[key[0]]):
        answers = iter([got[0, i][0] for i in range(len(asks[b]))])
        values[b] = [next(answers) if v is None else v for v in values[b]]
