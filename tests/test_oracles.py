"""Registered queries against their DuckDB oracles on the smallest scale factor.

The full set runs with ``python tests/oracle_compare.py /root/testdata/sf0.01``;
this test covers one query per operator family so the suite stays quick.
"""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest import SMALL
from oracle_compare import compare, duck

NAMES = [
    "load_campaign", "clean_campaign", "rfm", "income_ratios", "log_amounts", "data_check",
    "split_three_way", "feature_table", "winsorize",
    "cluster_lift_table", "campaign_allocation", "prediction_report", "ranking_summary", "threshold_sweep",
    "assignment_entropy", "e_step", "moe_response", "response_aware_assignment", "kmeans_lloyd_3steps",
    "silhouette_squared", "calinski_harabasz", "roc_points", "budget_allocation_curve", "income_spend", "silhouette_rows",
]


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_oracle(spark, con, name):
    from cohortlens.plans import registry

    status, msg = compare(spark, con, name, registry.queries()[name], registry.oracle_sql()[name], SMALL)
    assert status == "OK", msg


def test_every_query_has_a_callable_and_entry(spark):
    import __spark_entry__ as entry

    qs, orc = entry.queries(), entry.oracle_sql()
    assert set(orc) <= set(qs)
    df = entry.entry(spark)
    assert df.count() > 0
