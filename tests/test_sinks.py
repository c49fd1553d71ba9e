import tempfile

import pytest

from pyspark.sql import functions as F

from conftest import SF_SMALL

from bramble.plans.clicks import product_funnel
from bramble.sources.sinks import register_views, save_table, temp_view
from bramble.sources.tables import Tables

import __spark_entry__ as entry_mod


def test_save_table_round_trip_and_sql_views(spark):
    fx = Tables(spark, SF_SMALL).fixtures
    out = tempfile.mkdtemp(prefix="bramble-sink-") + "/product_sales"
    pf = product_funnel(fx.clicks, fx.page_hierarchy)
    back = save_table(pf, out, partition_by=["product_id"])
    assert sorted(back.select(*pf.columns).collect()) == sorted(pf.collect())
    register_views(spark, SF_SMALL, ["sales", "subscriptions"])
    n = spark.sql("SELECT COUNT(DISTINCT txn_id) AS n FROM sales").first().n
    assert n == fx.sales.select("txn_id").distinct().count()
    v = temp_view(fx.plans.where(F.col("price").isNotNull()), "paid_plans")
    assert spark.sql("SELECT COUNT(*) AS n FROM paid_plans").first().n == v.count() == 4


@pytest.mark.parametrize("saved", [False, True])
def test_derived_views_equal_the_keys(spark, tmp_path, saved):
    from bramble.plans import clicks as C
    from bramble.sources.sinks import register_derived
    keys = {"product_sales": "product_funnel", "category_sales": "category_funnel",
            "campaign_performance": "campaign_performance", "payments": "payments_all"}
    names = register_derived(spark, SF_SMALL, str(tmp_path) if saved else None)
    assert sorted(names) == sorted(keys)
    for name, key in keys.items():
        want = entry_mod.queries()[key](spark, SF_SMALL)
        got = spark.sql(f"select * from {name}").select(want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name
    if saved:  # what depends on a table reads the saved one
        plan = C.funnel_leaders(spark.table("product_sales"))._jdf.queryExecution().executedPlan().toString()
        assert "events.parquet" not in plan and plan.count("FileScan parquet") == 2
