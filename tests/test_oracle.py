"""Every registered query against its DuckDB oracle (the driver's correctness gate),
plus the values recorded for the mapped data at sf0.01."""

import pytest

from conftest import SF_MID, SF_SMALL
from oracle_harness import check

import __spark_entry__ as entry_mod

KEYS = sorted(set(entry_mod.queries()) - set(entry_mod.LLM_QUERIES))


def test_contract_shape():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert len([k for k in q if k not in entry_mod.LLM_QUERIES]) == 79
    assert set(o) <= set(q)
    assert all(isinstance(v, str) and v.strip() for v in o.values())


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["segment_name", "product_name", "rev_pct"]


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle_small(spark, duck_small, key):
    ok, msg = check(spark, SF_SMALL, [key], con=duck_small, verbose=False)[key]
    assert ok, msg


@pytest.mark.parametrize("key", ["txn_revenue_percentiles", "payments_all", "payments_required", "basket_top_triples",
                                 "campaign_performance", "product_funnel", "checkout_without_purchase"])
def test_key_matches_oracle_mid(spark, duck_mid, key):
    ok, msg = check(spark, SF_MID, [key], con=duck_mid, verbose=False)[key]
    assert ok, msg


def _q(spark, key):
    return entry_mod.queries()[key](spark, SF_MID)


def test_known_values_sf001(spark):
    r = _q(spark, "txn_revenue_percentiles").first()
    assert (r[0], r[1], r[2]) == (126904.5, 200370.24, 289009.86)
    assert _q(spark, "downgrades_in_year").first()[0] == 245
    c = _q(spark, "checkout_without_purchase").first()
    assert (c.checkout_visits, c.purchase_visits) == (804, 845)
    p1 = _q(spark, "product_funnel").where("product_id = 1").first()
    assert (p1.views, p1.cart_adds, p1.abandoned, p1.purchases) == (153, 150, 12, 138)
    assert _q(spark, "campaign_performance").count() == 900
    split = _q(spark, "txn_member_split").first()
    assert (split.member_transac, split.nonmember_transac) == (4859, 9884)
    py = _q(spark, "payments_year")
    assert py.count() == 4464
    assert py.where("plan_name = 'pro annual' AND amount <> 199.0").count() == 86
    pa = _q(spark, "payments_all")
    assert pa.count() == 57762
    assert pa.where("plan_name = 'pro annual' AND amount <> 199.0").count() == 1678
    assert _q(spark, "cart_contents").count() == 809


def test_entry_module_imports_without_spark():
    """The driver may import the contract before it starts Spark."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import __spark_entry__ as e; own = set(e.LLM_QUERIES); q = set(e.queries()) - own; o = set(e.oracle_sql()) - own; "
            "from pyspark import SparkContext; assert SparkContext._active_spark_context is None; "
            "print(len(q), len(o))")
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.split()[-2:] == ["79", "79"]
