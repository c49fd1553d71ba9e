"""The report's SQL functions against the registered keys (themselves checked by an oracle)."""

import pytest

from conftest import SF_SMALL

import __spark_entry__ as entry_mod
from bramble.sources.report_functions import _SCALARS, _TABLES, register_report_functions
from bramble.sources.fixtures import REPORT_MONTH


@pytest.fixture(scope="module")
def functions(spark):
    return register_report_functions(spark, SF_SMALL)


def key(spark, name):
    return entry_mod.queries()[name](spark, SF_SMALL)


def test_scalar_functions_equal_the_keys(spark, functions):
    assert len(functions) == len(_SCALARS) + 1 + len(_TABLES) == 18
    got = spark.sql("SELECT " + ", ".join(f"{f}({REPORT_MONTH})" for f in _SCALARS)).first()
    assert list(got) == [key(spark, f).first()[0] for f in _SCALARS]


def test_percentile_function_equals_the_key(spark, functions):
    got = spark.sql("SELECT " + ", ".join(f"report_revenue_percentile({REPORT_MONTH}, {p})" for p in (25, 50, 75))).first()
    assert tuple(got) == tuple(key(spark, "report_revenue_percentile").first())


@pytest.mark.parametrize("name", sorted(_TABLES))
def test_table_functions_equal_the_keys(spark, functions, name):
    want = key(spark, name)
    got = spark.sql(f"SELECT * FROM {name}({REPORT_MONTH}{', 3' if name == 'report_top_products' else ''})")
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_arguments_and_months(spark, functions):
    assert spark.sql("SELECT * FROM report_top_products(3, 5)").count() == 5
    assert spark.sql("SELECT * FROM report_top_products(3)").count() == 3
    by_month = [spark.sql(f"SELECT report_unique_txn({m})").first()[0] for m in (1, 7)]
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").selectExpr("l_orderkey as o_orderkey").distinct()
    assert by_month == [orders.where(f"month(o_orderdate) = {m}").join(lines, "o_orderkey").count() for m in (1, 7)]
    # no transaction: sums and means are NULL, counts 0
    assert tuple(spark.sql("SELECT report_total_qty(13), report_unique_txn(13), report_avg_discount(13), "
                           "report_revenue_percentile(13, 50)").first()) == (None, 0, None, None)


def test_the_month_stands_on_the_scan_of_the_lines(spark, functions):
    p = spark.sql("SELECT report_total_qty(3)")._jdf.queryExecution().optimizedPlan().toString()
    below = p[p.index("Aggregate"):]
    assert 0 < below.index("Join") < below.index("l_orderkey")
