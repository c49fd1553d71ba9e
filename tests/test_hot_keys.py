"""The splitter tree of hot keys: plans without hot keys, and keys beyond one level."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from bramble.operators.skew import add_buckets, hot_splits, later_sums, sequence_columns
from conftest import SF_SMALL
from bramble.plans import subscriptions as U
from bramble.sources.tables import Tables

SMALL = dict(min_hot_rows=20, rows_per_bucket=7, fanout=3)


def _rows(n=900, seed=5):
    rnd = random.Random(seed)
    return [(0 if rnd.random() < 0.8 else rnd.choice([None, 1, 2, 3]), 7 if rnd.random() < 0.4 else rnd.randint(0, 300), i) for i in range(n)]


def test_buckets_far_above_the_bound_are_split_again(spark):
    """Three splitters a level: the first leaves buckets of five times the bound and more."""
    df = spark.createDataFrame(_rows(), "k long, t long, id long")
    ranks = [F.col("t"), F.col("id")]
    splits = hot_splits(df, "k", ranks, **SMALL)
    assert len(splits) >= 3
    first = add_buckets(df, "k", ranks, splits[:1]).groupBy("k", "_b").count().agg(F.max("count")).first()[0]
    assert first > 5 * SMALL["min_hot_rows"]
    split = add_buckets(df, "k", ranks, splits)
    assert split.groupBy("k", "_b").count().agg(F.max("count")).first()[0] <= SMALL["min_hot_rows"]
    edges = split.where("k = 0").groupBy("_b").agg(F.min(F.struct("t", "id")).alias("lo"), F.max(F.struct("t", "id")).alias("hi")).orderBy("_b").collect()
    assert all(a.hi < b.lo for a, b in zip(edges, edges[1:]))


def test_windows_over_several_levels(spark):
    df = spark.createDataFrame(_rows(seed=6), "k long, t long, id long")
    w = Window.partitionBy("k").orderBy("t", "id")
    want = df.select("k", "t", "id", F.row_number().over(w).cast("long").alias("rn"), F.lag("id").over(w).alias("p"), F.lead("t").over(w).alias("n"))
    got = sequence_columns(df, "k", ["t", "id"], [F.col("t"), F.col("id")], row_number="rn", lag={"p": "id"}, lead={"n": "t"}, **SMALL)
    order = lambda rows: sorted(rows, key=str)
    assert order(got.select(want.columns).collect()) == order(want.collect())
    part = Window.partitionBy("k")
    seen = part.orderBy("t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.select("k", "t", "id", (F.sum("id").over(part) - F.sum("id").over(seen)).alias("later"))
    got = later_sums(df, "k", "t", F.col("t"), {"later": "id"}, **SMALL)
    assert order(got.select(want.columns).collect()) == order(want.collect())


def test_rows_that_tie_in_all_values_stay_together(spark):
    df = spark.createDataFrame([(0, 1, i) for i in range(100)], "k long, t long, id long")
    splits = hot_splits(df, "k", [F.col("t")], **SMALL)
    assert len(splits) == 1 and add_buckets(df, "k", [F.col("t")], splits).select("_b").distinct().count() == 1


def test_no_hot_key_no_split(spark):
    fx = Tables(spark, SF_SMALL).fixtures
    for df in (U.payments_all(fx.subscriptions, fx.plans), U.customer_journey(fx.subscriptions, fx.plans)):
        p = df._jdf.queryExecution().optimizedPlan().toString()
        assert "_b#" not in p and "percentile" not in p
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_payment_windows_partition_by_customer_and_bucket_when_hot(spark):
    fx = Tables(spark, SF_SMALL).fixtures
    from bramble.operators.payments import payment_schedule
    hot = payment_schedule(fx.subscriptions, fx.plans, F.lit("2000-12-31").cast("date"), min_hot_rows=2, rows_per_bucket=1)
    plain = payment_schedule(fx.subscriptions, fx.plans, F.lit("2000-12-31").cast("date"))
    assert "_b#" in hot._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(hot.collect(), key=str) == sorted(plain.collect(), key=str)
