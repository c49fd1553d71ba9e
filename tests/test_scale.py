"""Skewed inputs at the default settings: what one task gets stays bounded."""

import datetime as dt
import itertools

from pyspark.sql import functions as F

from bramble.operators.basket import top_basket_combinations
from bramble.operators.ranking import nearest_rank
from bramble.operators.skew import ROWS_PER_BUCKET, add_buckets, sequence_columns
from bramble.plans import sales as S
from bramble.sources.tables import Tables
from conftest import SF_SMALL


def test_one_huge_basket(spark):
    rows = [(1, i) for i in range(320)] + [(2, i) for i in (5, 6, 7)] + [(3, i) for i in (5, 6, 8)]
    got = top_basket_combinations(spark.createDataFrame(rows, "txn long, item long"), "txn", "item", 10).collect()
    counts = {}
    for basket in ([i for t, i in rows if t == b] for b in (1, 2, 3)):
        for c in itertools.combinations(basket, 3):
            if c[0] <= 5:  # all ten winners start with 0 or 5
                counts[c] = counts.get(c, 0) + 1
    want = sorted((-n, c) for c, n in counts.items())[:10]
    assert [(-r.baskets, (r.item_1, r.item_2, r.item_3)) for r in got] == want


def test_key_with_a_cluster_of_ties_is_split(spark):
    # two million rows of one key, nine tenths of them on one date
    df = spark.range(2_000_000).select(F.lit(1).alias("k"), "id", F.when(F.col("id") % 10 == 0, F.col("id") % 3000)
                                       .otherwise(F.lit(1500)).alias("day"))
    df = df.union(spark.range(1000).select((F.col("id") + 2).cast("int"), "id", F.lit(0).cast("long")))
    split = add_buckets(df, "k", [F.col("day"), F.col("id")])
    per = split.groupBy("k", "_b").count()
    assert per.agg(F.max("count")).first()[0] <= 1.5 * ROWS_PER_BUCKET
    # buckets follow the order
    edges = split.groupBy("k", "_b").agg(F.min(F.struct("day", "id")).alias("lo"), F.max(F.struct("day", "id")).alias("hi")).where("k = 1").orderBy("_b").collect()
    assert len(edges) > 5 and all(a.hi < b.lo for a, b in zip(edges, edges[1:]))
    numbered = sequence_columns(df, "k", ["day", "id"], [F.col("day"), F.col("id")], row_number="rn")
    one = numbered.where("k = 1").agg(F.max("rn"), F.count_distinct("rn"), F.count("*")).first()
    assert tuple(one) == (2_000_000,) * 3


def test_percentiles_with_far_outliers(spark):
    df = spark.range(200_000).select((F.col("id") % 60_000).cast("double").alias("v")).union(
        spark.createDataFrame([(1e10,), (1e15,)], "v double"))
    values = sorted([float(i % 60_000) for i in range(200_000)] + [1e10, 1e15])
    got = {r.percentile: r.value for r in nearest_rank(df, "v", (0, 25, 50, 75, 100)).collect()}
    n = len(values)
    assert got == {p: (values[(n * p + 50) // 100 - 1] if (n * p + 50) // 100 else None) for p in (0, 25, 50, 75, 100)}


def test_percentiles_at_many_sizes(spark):
    """Positions between two ranks, below and above the sketch's accuracy."""
    for n in (1, 2, 7, 124, 1003, 9999, 10_000, 10_007, 25_003):
        ps = (1, 10, 33, 50, 90, 99)
        got = {r.percentile: r.value for r in nearest_rank(spark.range(n).select((F.col("id") * 3).alias("v")), "v", ps).collect()}
        assert got == {p: (3 * ((n * p + 50) // 100 - 1) if (n * p + 50) // 100 else None) for p in ps}, n


def _before_first_exchange(df) -> str:
    """The plan below the lowest exchange that reads lineitem."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    scan = next(i for i, x in enumerate(lines) if "l_orderkey" in x and "FileScan" in x)
    above = next(i for i in range(scan, -1, -1) if "Exchange" in lines[i])
    return "\n".join(lines[above:scan])


def test_lines_are_combined_before_they_are_dealt_out(spark):
    fx = Tables(spark, SF_SMALL).fixtures
    for df in (S.txn_avg_discount(fx.sales_lines), S.txn_member_split(fx.sales_lines, fx.transactions),
               S.product_penetration(fx.sales_lines, fx.product_details, fx.transactions)):
        assert "HashAggregate" in _before_first_exchange(df)


def test_every_line_has_its_transaction(spark):
    """Precondition of the results that read lines alone."""
    fx = Tables(spark, SF_SMALL).fixtures
    assert fx.sales_lines.join(fx.transactions, "txn_id", "left_anti").count() == 0
    assert fx.transactions.groupBy("txn_id").count().where("count > 1").count() == 0


def test_nth_row_keeps_n_rows_a_task(spark):
    from bramble.operators.sequences import nth_in_order
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    out = nth_in_order(df, "k", ["id"], 2)
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.k, r.id) for r in out.collect()) == [(0, 3), (1, 4), (2, 5)]


def test_long_text_group_is_sliced(spark):
    from bramble.operators.funnel import ordered_concat
    rows = [("hot", i, f"p{i}") for i in range(500)] + [("w", 1, None), ("x", 2, "a")]
    df = spark.createDataFrame(rows, "visit string, seq int, name string")
    out = {r.visit: r.t for r in ordered_concat(df, "visit", {"t": F.col("name")}, ["seq"], [F.col("seq")], ",",
                                                 min_hot_rows=100, rows_per_bucket=20).collect()}
    assert out == {"hot": ",".join(f"p{i}" for i in range(500)), "w": None, "x": "a"}


def test_months_do_not_share_visits(spark, tmp_path):
    rows = [(1, dt.datetime(2024, m, 3), 7, "view", 1.0, '{"k": 1}') for m in (1, 2)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
                          ).write.parquet(f"{tmp_path}/events.parquet")
    assert Tables(spark, str(tmp_path)).fixtures.clicks.select("visit_id").distinct().count() == 2
