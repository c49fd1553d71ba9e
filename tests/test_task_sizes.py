"""What a task makes stays bounded where rows multiply after an exchange."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bramble.operators import basket as B
from bramble.operators.payment_rules import required_payments
from bramble.operators.payments import payment_schedule
from bramble.plans.subscriptions import revenue_by_month

HORIZON = dt.date(2024, 12, 31)


def _most_in_a_task(df) -> int:
    return df.select(F.spark_partition_id().alias("p")).groupBy("p").count().agg(F.max("count")).first()[0]


def _baskets(spark):
    # 400 baskets of 12 items: 26,400 pairs and 88,000 triples
    return spark.range(4800).select((F.col("id") % 400).alias("_b"), F.floor(F.col("id") / 400).alias("item_1"))


def test_sets_are_dealt_by_what_they_make(spark):
    items = _baskets(spark)
    made = B._enumerate(items, 3, B._tasks(items, 3, 5000))
    assert made.count() == 88_000
    assert _most_in_a_task(made) <= 7500


def test_the_plan_of_the_top_sets_follows_their_number(spark):
    top = B.top_basket_combinations(_baskets(spark), "_b", "item_1", 5, sets_per_task=5000)
    assert "REPARTITION_BY_NUM" in top._jdf.queryExecution().executedPlan().toString()
    assert [(r.item_1, r.item_2, r.item_3, r.baskets) for r in top.collect()] == [(0, 1, j, 400) for j in range(2, 7)]


def test_sets_of_nulls_and_of_nothing(spark):
    rows = [(None, 1), (None, 2), (None, 3), (1, None), (1, 1), (1, 2), (1, 3), (1, 3), (2, 1), (2, 2), (2, 3)]
    df = spark.createDataFrame(rows, "b long, i long")
    for per_task in (1, 1000):
        assert [tuple(r) for r in B.top_basket_combinations(df, "b", "i", 3, sets_per_task=per_task).collect()] == [(1, 2, 3, 2)]
    assert B.top_basket_combinations(df.where("i > 9"), "b", "i", 3).count() == 0
    assert [tuple(r) for r in B.basket_combinations(df, "b", "i").collect()] == [(1, 2, 3, 2)]


def _log(spark):
    plans = spark.createDataFrame([(0, "trial", Decimal("0.00")), (1, "basic monthly", Decimal("9.90")), (2, "pro monthly", Decimal("19.90")),
                                   (3, "pro annual", Decimal("199.00")), (4, "churn", None)], "plan_id int, plan_name string, price decimal(18,2)")
    rows = [(c if c else None, (c + 3 * i) % 5, dt.date(2022, 1, 1) + dt.timedelta(days=(37 * c + 191 * i) % 1000), 100 * c + i)
            for c in range(300) for i in range(4)]
    return spark.createDataFrame(rows, "customer_id long, plan_id int, start_date date, sub_id long"), plans


@pytest.mark.parametrize("make", [payment_schedule, required_payments])
@pytest.mark.parametrize("split", [{}, dict(min_hot_rows=3, rows_per_bucket=2, fanout=3)])
def test_payments_are_made_in_tasks_of_some_plan_rows(spark, make, split):
    subs, plans = _log(spark)
    few = make(subs, plans, F.lit(HORIZON), rows_per_task=40, **split).localCheckpoint()  # 30 tasks
    if not split:  # the rows of hot keys meet their summary after another exchange
        assert _most_in_a_task(few) <= few.count() / 10
    want = make(subs, plans, F.lit(HORIZON))
    assert sorted(map(str, few.collect())) == sorted(map(str, want.collect()))
    assert sorted(map(str, revenue_by_month(few).collect())) == sorted(map(str, revenue_by_month(want).collect()))
