"""Column-expression helpers (all JVM-side, codegen friendly)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_sum_skip_null(cols) -> Column:
    """Row sum that treats NULL as 0 (pandas ``sum(axis=1)`` semantics)."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0)) for c in cols])


def count_positive(cols) -> Column:
    """Number of columns whose value is > 0; NULL counts as not positive."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c) > 0, F.lit(False)).cast("int") for c in cols])


def ratio_or_zero(num: Column, den: Column) -> Column:
    """``num / den`` with zero denominators and any NULL mapped to 0.0."""
    return F.coalesce(F.try_divide(num.cast("double"), F.nullif(den.cast("double"), F.lit(0.0))), F.lit(0.0))


def log1p_nonneg(c: Column) -> Column:
    """``log1p(max(x, 0))`` keeping NULL (``greatest`` would skip the NULL)."""
    return F.when(c.isNotNull(), F.log1p(F.greatest(c.cast("double"), F.lit(0.0))))


def clip(c: Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def finite(c: Column) -> Column:
    """True when the value is neither NULL, NaN nor infinite."""
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def r6(c: Column, digits: int = 6) -> Column:
    """Rounded double without negative zero (used in oracle-compared outputs)."""
    return F.round(c.cast("double"), digits) + F.lit(0.0)


def md5_unit(*parts) -> Column:
    """Deterministic number in [0, 1) from the first 8 hex digits of an md5 digest."""
    text = F.concat_ws("|", *[F.lit(p) if not isinstance(p, Column) else p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def column_name(df, name: str, aliases=()) -> str:
    """The column of ``df`` called ``name`` or, failing that, an alias.

    Exact spellings win over other letter cases, the name over its aliases, an earlier alias over a later
    one; of columns that differ in case alone the first. KeyError names what was tried.
    """
    wanted = [name, *aliases]
    for w in wanted:
        if w in df.columns:
            return w
    first = {}
    for c in df.columns:
        first.setdefault(c.lower(), c)
    for w in wanted:
        if w.lower() in first:
            return first[w.lower()]
    raise KeyError(f"no column {name!r}; tried {wanted}, the frame has {df.columns[:20]}")


def resolved(df, names, aliases: dict | None = None):
    """``df`` with each of ``names`` present under that name, found by :func:`column_name`."""
    found = {n: column_name(df, n, (aliases or {}).get(n, ())) for n in names}
    others = [c for c in df.columns if c not in found.values() and c.lower() not in {n.lower() for n in names}]
    return df.select(*[F.col(f"`{c}`") for c in others], *[F.col(f"`{c}`").alias(n) for n, c in found.items()])
