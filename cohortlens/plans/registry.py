"""Collects every registered query (importing the catalog modules registers them)."""

from __future__ import annotations

from . import catalog
from . import catalog_fits, catalog_metrics, catalog_models, catalog_prep, catalog_profiles, catalog_transform  # noqa: F401  (registration side effects)


def queries():
    return dict(catalog.QUERIES)


def oracle_sql():
    return dict(catalog.ORACLES)
