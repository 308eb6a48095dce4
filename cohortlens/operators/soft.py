"""Soft-assignment diagnostics (A1-A3): higher-order array functions, row-local."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-12


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once a row, however often ``use`` names it.

    An expression inside a lambda is computed for every element; as the element of an array of one
    it is computed once.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def _sum(q: Column) -> Column:
    return F.aggregate(q, F.lit(0.0), lambda a, x: a + x)


def normalize_soft(q: Column, eps: float = EPS) -> Column:
    """A1: clip each entry at ``eps`` and divide by the (clipped) row sum."""
    clipped = F.transform(q, lambda x: F.greatest(x, F.lit(eps)))
    scaled = lambda c: bound(F.greatest(_sum(c), F.lit(eps)), lambda total: F.transform(c, lambda x: x / total))
    return bound(clipped, scaled)


def assignment_entropy(q: Column, eps: float = EPS) -> Column:
    """A2: ``-sum q log q`` of the normalised row."""
    n = normalize_soft(q, eps)
    return -F.aggregate(n, F.lit(0.0), lambda a, x: a + x * F.log(F.least(F.greatest(x, F.lit(eps)), F.lit(1.0))))


def assignment_maxprob(q: Column, eps: float = EPS) -> Column:
    """A3: largest normalised entry."""
    return F.array_max(normalize_soft(q, eps))


def softmax(logits: Column, temperature: float = 1.0) -> Column:
    """Max-shifted softmax of an array column (temperature > 0)."""
    if not temperature > 0:
        raise ValueError(f"temperature is {temperature}; it must be positive")
    scaled = F.transform(logits, lambda x: x / F.lit(float(temperature)))
    shifted = lambda v: bound(F.array_max(v), lambda m: F.transform(v, lambda x: F.exp(x - m)))
    shares = lambda e: bound(_sum(e), lambda total: F.transform(e, lambda x: x / total))
    return bound(bound(scaled, shifted), shares)


def logsumexp(logits: Column) -> Column:
    over = lambda v, m: m + F.log(F.aggregate(v, F.lit(0.0), lambda a, x: a + F.exp(x - m)))
    return bound(logits, lambda v: bound(F.array_max(v), lambda m: over(v, m)))


def argmax(arr: Column) -> Column:
    """0-based index of the first maximum."""
    return bound(arr, lambda v: (F.array_position(v, F.array_max(v)) - 1).cast("int"))


def argmin(arr: Column) -> Column:
    """0-based index of the first minimum."""
    return bound(arr, lambda v: (F.array_position(v, F.array_min(v)) - 1).cast("int"))
