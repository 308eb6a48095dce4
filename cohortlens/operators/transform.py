"""Train-fitted transforms (T1-T8): fit = aggregates on train rows, transform = projection.

Fitting runs three aggregate jobs over the train rows only (medians / modes /
categories, then winsorizing quantiles of the imputed columns, then mean and
population std of the clipped columns). Only these per-column numbers (and the
category lists) reach the driver. ``transform`` is one projection over any
frame, so train parameters are applied to val, test or all rows in one pass.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.ml.feature import VectorAssembler

from .features import FeatureConfig, derive_features, log_amounts
from .clean import add_label
from .quantile import exact_quantiles


@dataclass
class FittedTransform:
    numeric: list
    behavior_numeric: list
    categorical: list
    medians: dict = field(default_factory=dict)
    modes: dict = field(default_factory=dict)
    categories: dict = field(default_factory=dict)
    lower: dict = field(default_factory=dict)
    upper: dict = field(default_factory=dict)
    means: dict = field(default_factory=dict)
    stds: dict = field(default_factory=dict)
    winsorize: bool = True
    clip_quantiles: tuple = (0.01, 0.99)

    # names ----------------------------------------------------------------
    def onehot_names(self) -> list:
        return [f"{c}_{v}".lower() for c in self.categorical for v in self.categories[c]]

    @property
    def all_feature_names(self) -> list:
        return [c.lower() for c in self.numeric] + self.onehot_names()

    @property
    def behavior_feature_names(self) -> list:
        return [c.lower() for c in self.behavior_numeric] + self.onehot_names()

    @property
    def response_feature_names(self) -> list:
        return [c.lower() for c in self.numeric if c not in self.behavior_numeric]

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> "FittedTransform":
        return cls(**json.loads(text))


def _check_q(lo: float, hi: float) -> None:
    if not (0.0 <= lo < hi <= 1.0):
        raise ValueError(f"quantiles are {lo} and {hi}; the lower must be below the upper and both within [0, 1]")


def _quantiles(df: DataFrame, columns: dict, qs, exact: bool) -> dict:
    """Quantiles of each named expression (None without values): exact from ranks, or approximate."""
    if exact:
        return exact_quantiles(df, columns, qs)
    arr = F.array(*[F.lit(float(q)) for q in qs])
    row = df.agg(*[F.percentile_approx(c, arr, 10000).alias(f"q{i}") for i, c in enumerate(columns.values())]).first()
    return {n: row[f"q{i}"] for i, n in enumerate(columns)}


def fit_transform_params(
    train: DataFrame,
    config: FeatureConfig,
    clip_quantiles=(0.01, 0.99),
    winsorize: bool = True,
    exact: bool = True,
) -> FittedTransform:
    """T1-T5 fit on the given (train) rows."""
    lo_q, hi_q = clip_quantiles
    _check_q(lo_q, hi_q)
    numeric = list(config.behavior_numeric) + list(config.response_numeric)
    cat = list(config.categorical)
    ft = FittedTransform(numeric, list(config.behavior_numeric), cat, winsorize=winsorize, clip_quantiles=tuple(clip_quantiles))
    # pass 1: medians and modes
    medians = _quantiles(train, {c: F.col(c).cast("double") for c in numeric}, [0.5], exact)
    ft.medians = {c: q[0] if q else None for c, q in medians.items()}
    # categories with their counts, sorted: each becomes a column, so their number is a schema's, not the data's
    for c in cat:
        counts = {r[c]: r["n"] for r in train.groupBy(c).agg(F.count(F.lit(1)).alias("n")).collect() if r[c] is not None}
        ft.categories[c] = sorted(counts)
        ft.modes[c] = min(counts, key=lambda v: (-counts[v], v)) if counts else None
    imputed = {c: _impute(c, ft) for c in numeric}
    # pass 2: winsorizing bounds of the imputed columns
    if winsorize:
        bounds = _quantiles(train, imputed, [lo_q, hi_q], exact)
        ft.lower = {c: q[0] if q else None for c, q in bounds.items()}
        ft.upper = {c: q[1] if q else None for c, q in bounds.items()}
    # pass 3: mean and population std after clipping
    clipped = {c: _clip(imputed[c], c, ft) for c in numeric}
    aggs = []
    for i, c in enumerate(numeric):
        aggs += [F.avg(clipped[c]).alias(f"a{i}"), F.stddev_pop(clipped[c]).alias(f"s{i}")]
    row = train.agg(*aggs).first()
    ft.means = {c: row[f"a{i}"] for i, c in enumerate(numeric)}
    ft.stds = {c: row[f"s{i}"] for i, c in enumerate(numeric)}
    return ft


def _impute(c: str, ft: FittedTransform):
    m = ft.medians.get(c)
    return F.coalesce(F.col(c).cast("double"), F.lit(m).cast("double"))


def _clip(expr, c: str, ft: FittedTransform):
    if not ft.winsorize or ft.lower.get(c) is None:
        return expr
    return F.least(F.greatest(expr, F.lit(float(ft.lower[c]))), F.lit(float(ft.upper[c])))


def transform_columns(ft: FittedTransform) -> dict:
    """Column expressions of the transformed features, keyed by output name."""
    out = {}
    for c in ft.numeric:
        x = _clip(_impute(c, ft), c, ft)
        sd = ft.stds.get(c)
        scale = 1.0 if (sd is None or sd == 0.0) else float(sd)
        out[c.lower()] = (x - F.lit(float(ft.means[c] or 0.0))) / F.lit(scale)
    for c in ft.categorical:
        v = F.coalesce(F.col(c), F.lit(ft.modes[c]))
        for cat in ft.categories[c]:
            out[f"{c}_{cat}".lower()] = F.when(v == F.lit(cat), F.lit(1.0)).otherwise(F.lit(0.0))
    return out


def apply_transform(df: DataFrame, ft: FittedTransform, keep=("customer_id", "split", "label")) -> DataFrame:
    """One projection; ``keep`` columns pass through."""
    cols = [F.col(k) for k in keep if k in df.columns]
    return df.select(*cols, *[e.alias(n) for n, e in transform_columns(ft).items()])


def with_vectors(df: DataFrame, ft: FittedTransform) -> DataFrame:
    """``features_full`` and ``features_beh`` vector columns for MLlib."""
    full = VectorAssembler(inputCols=ft.all_feature_names, outputCol="features_full", handleInvalid="keep")
    beh = VectorAssembler(inputCols=ft.behavior_feature_names, outputCol="features_beh", handleInvalid="keep")
    return beh.transform(full.transform(df))


def prepare_for_fit(df: DataFrame, label_mode: str = "recent", reference_date=None, reference_year=None) -> DataFrame:
    """T6 steps 0-2: derive missing features, label, log amounts."""
    out = derive_features(df, reference_date=reference_date, reference_year=reference_year)
    if "label" not in out.columns:
        out = add_label(out, label_mode)
    return log_amounts(out)


def feature_table(
    df: DataFrame,
    train_filter=None,
    config: FeatureConfig | None = None,
    clip_quantiles=(0.01, 0.99),
    winsorize: bool = True,
    exact: bool = True,
    fitted: FittedTransform | None = None,
):
    """Fit on ``df.filter(train_filter)`` (or reuse ``fitted``) and transform every row.

    Returns ``(table, fitted)``; the table keeps ``customer_id``, ``split``, ``label``.
    """
    prepared = log_amounts(df) if "Spent" in df.columns else prepare_for_fit(df)
    cfg = config or FeatureConfig.default_for(prepared)
    if fitted is None:
        train = prepared.filter(train_filter) if train_filter is not None else prepared
        fitted = fit_transform_params(train, cfg, clip_quantiles, winsorize, exact)
    return apply_transform(prepared, fitted), fitted
