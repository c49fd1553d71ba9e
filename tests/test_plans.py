"""Physical-plan properties the scale design relies on (read from the executed plan)."""

import re

from pyspark.sql import functions as F

from conftest import SF_SMALL

import __spark_entry__ as entry_mod
from bramble.plans import sales as S
from bramble.sources.tables import Tables


def _plan(df) -> str:
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # untruncated scan details
    try:
        df.write.format("noop").mode("overwrite").save()
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)


def test_month_year_filter_reaches_parquet_scan(spark):
    fx = Tables(spark, SF_SMALL).fixtures
    p = _plan(S.report_scalars(S.month_sales(fx.sales, 3, year=1998)))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate,1998-03-01", p)
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(o_orderdate,1998-04-01", p)


def test_scans_read_only_needed_columns(spark):
    p = _plan(entry_mod.queries()["sales_total_qty"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", p)
    assert schemas and all("l_tax" not in s and "l_shipdate" not in s and "o_totalprice" not in s
                           for s in schemas)
    assert schemas == ["struct<l_quantity:double>"]  # neither the order key nor the orders


def test_top_n_is_take_ordered(spark):
    p = _plan(entry_mod.queries()["top_products_by_revenue"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


def test_constant_lookups_are_broadcast(spark):
    p = _plan(entry_mod.queries()["product_funnel"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p
    assert "BroadcastNestedLoopJoin" not in p


def test_payment_windows_partition_by_customer(spark):
    p = _plan(entry_mod.queries()["payments_all"](spark, SF_SMALL))
    specs = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[", p)
    assert specs and all("customer_id" in s for s in specs)
    assert p.count("FileScan parquet") <= 8  # no splitting where no customer is hot (tests/test_hot_keys.py has the other case)


def test_basket_plan_stays_small(spark):
    p = _plan(entry_mod.queries()["basket_top_triples"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p
    assert p.count("FileScan parquet") <= 40


def test_month_filter_stands_on_the_scan_of_the_lines(spark):
    """Other months' lines go no further than their scan: by a broadcast, or by a Bloom filter
    below the first exchange where the month's transactions are too many for one."""
    fx = Tables(spark, SF_SMALL).fixtures
    p = S.report_totals(S.month_lines(fx.sales_lines, fx.transactions, 3))._jdf.queryExecution().optimizedPlan().toString()
    assert p.index("Aggregate") < p.index("Join") < p.index("l_orderkey")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
            "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = S.report_totals(S.month_lines(fx.sales_lines, fx.transactions, 3, 1998))
        plan = df._jdf.queryExecution().executedPlan().toString()
        below = plan[plan.index("SortMergeJoin"):]
        assert "might_contain" in below.split("FileScan")[0]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_stored_report_reads_the_lines_once(spark):
    """The 21 results read the written facts; only those with product attributes read the
    product tables besides."""
    fx = Tables(spark, SF_SMALL).fixtures
    results = S.stored_report(fx.sales_lines, fx.transactions, fx.product_details, 3, top=3)
    direct = S.monthly_report(fx.sales_lines, fx.product_details, 3, top=3, txns=fx.transactions)
    assert set(results) == set(direct) and len(set(results) - {"scalars"}) == 21
    for name, df in results.items():
        files = set(re.findall(r"(\w+)\.parquet", " ".join(df.inputFiles())))
        assert "lineitem" not in files and "orders" not in files, name
        assert sorted(map(str, df.collect())) == sorted(map(str, direct[name].collect())), name


def test_report_facts_combine_below_the_exchange(spark):
    fx = Tables(spark, SF_SMALL).fixtures
    p = S.report_facts(fx.sales_lines, fx.transactions, 3)._jdf.queryExecution().sparkPlan().toString()
    assert p.count("HashAggregate") == 2 and "partial_sum" in p
    assert p.count("FileScan parquet") == 2
