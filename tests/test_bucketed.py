"""Bucketed tables: what groups by their keys reads them without an exchange of the rows, and
the keys come out the same."""

import re

import pytest

from conftest import SF_SMALL

import __spark_entry__ as entry_mod
from bramble.plans import clicks as C
from bramble.plans import subscriptions as U
from bramble.sources.sinks import save_bucketed, save_bucketed_tables
from bramble.sources.tables import Tables

BUCKETS = 4


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    made = save_bucketed_tables(spark, SF_SMALL, str(tmp_path_factory.mktemp("buckets")), BUCKETS)
    yield made
    for name in made:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.fixture(autouse=True)
def as_for_large_tables(spark):
    """Tables of this size are above the threshold, the lookups below it, as on a cluster."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4096")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def dealt_by(df) -> list[str]:
    """The keys of all exchanges in the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", k) for k in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)]


def same(got, want):
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def key(spark, name):
    return entry_mod.queries()[name](spark, SF_SMALL)


def test_every_bucket_is_one_file(spark, tables):
    for name, df in tables.items():
        files = df.inputFiles()
        ids = [re.search(r"_(\d{5})\.c", f).group(1) for f in files]
        assert len(files) == len(set(ids)) <= BUCKETS, name


def test_funnels_read_the_clicks_without_an_exchange(spark, tables):
    fx = Tables(spark, SF_SMALL).fixtures
    funnel = C.product_funnel(tables["clicks_by_visit"], fx.page_hierarchy)
    assert not any("visit_id" in k for k in dealt_by(funnel))  # only counts per product are dealt out
    assert any("visit_id" in k for k in dealt_by(C.product_funnel(fx.clicks, fx.page_hierarchy)))
    same(funnel, key(spark, "product_funnel"))
    same(C.funnel_leaders(funnel), key(spark, "funnel_leaders"))


@pytest.mark.parametrize("name, by", [("campaign_by_impressions", ["impressions"]), ("campaign_by_name", ["campaign_name"]),
                                      ("campaign_by_impressions_clicks", ["impressions", "clicks"])])
def test_campaigns_read_the_visits_without_an_exchange(spark, tables, name, by):
    visits = tables["visits_by_visit"]
    got = C.campaign_metrics(visits.where("campaign_name is not null") if name == "campaign_by_name" else visits, by, apart=True)
    assert not any("visit_id" in k for k in dealt_by(got))
    same(got, key(spark, name))


def test_metrics_apart_with_nulls(spark):
    rows = [(None, 1, "a", 2, 0, 0), (None, 2, None, 1, 1, 0), ("x", 1, "b", None, 0, 1), ("x", None, "b", 3, 1, 0), ("x", 1, None, 0, 0, 0)]
    df = spark.createDataFrame(rows, "g string, user_id int, visit_id string, view_product int, add_cart int, purchases int")
    same(C.campaign_metrics(df, ["g"], apart=True), C.campaign_metrics(df, ["g"]))


def test_revenue_reads_the_payments_without_an_exchange(spark, tables):
    got = U.revenue_by_month(tables["payments_by_month"])
    assert dealt_by(got) == ["year, month"]
    same(got, key(spark, "revenue_by_month"))


def test_payment_windows_read_the_subscriptions_without_an_exchange(spark, tables):
    fx = Tables(spark, SF_SMALL).fixtures
    got = U.payments_all(tables["subscriptions_by_customer"], fx.plans)
    assert not any("customer_id" in k for k in dealt_by(got))
    assert not any("plan_id" in k for k in dealt_by(U.payments_all(fx.subscriptions, fx.plans)))  # nor ever by the few plans
    same(U.present(got), key(spark, "payments_all"))


def test_saving_again_replaces_the_table(spark, tmp_path):
    for n in (10, 3):
        df = save_bucketed(spark.range(n).selectExpr("id", "id % 2 AS k"), "bucketed_again", ["k"], 2, str(tmp_path / "again"))
        assert df.count() == n
    spark.sql("DROP TABLE bucketed_again")
