"""Edge cases on hand-made mini tables (FIXTURES.md section 4) and brute-force checks of
the rewritten operators (nearest rank, basket sets, later pairs, n-th row, drift dates)."""

import datetime as dt
import itertools
import random
from decimal import Decimal

import pytest
from pyspark.sql import Row, Window
from pyspark.sql import functions as F

from bramble.operators.basket import basket_combinations
from bramble.operators.funnel import ordered_concat
from bramble.operators.intervals import attribute_interval
from bramble.operators.payments import drift_month_dates, payment_schedule
from bramble.operators.ranking import nearest_rank, top_per_group
from bramble.operators.sequences import later_pairs, nth_in_order
from bramble.plans import clicks as C
from bramble.plans import sales as S
from bramble.plans import subscriptions as SUB

D = dt.date
T = dt.datetime


def _sales(spark, rows):
    schema = "txn_id long, prod_id long, qty int, gross decimal(18,2), discount int, member string, start_txn_time timestamp_ntz"
    return spark.createDataFrame(rows, schema)


def _products(spark, rows):
    return spark.createDataFrame(rows, "product_id long, product_name string, segment_name string, category_name string")


def _nearest_rank_brute(vals, p):
    s = sorted(vals)
    k = (len(s) * p + 50) // 100
    return s[k - 1] if k >= 1 else None


# -- sales ------------------------------------------------------------------
def test_top_seller_tie_goes_to_smallest_name(spark):
    df = spark.createDataFrame([("s", "b", 5), ("s", "a", 5), ("s", "c", 4), ("t", "z", 1)],
                               "seg string, name string, qty long")
    out = {r.seg: (r.name, r.qty) for r in top_per_group(df, "seg", "name", "qty").collect()}
    assert out == {"s": ("a", 5), "t": ("z", 1)}


def test_percentile_rank_zero_is_null(spark):
    s = _sales(spark, [(1, 1, 1, Decimal("10.00"), 0, "t", T(2020, 1, 1))])
    r = S.txn_revenue_percentiles(s).first()
    assert r.revenue_at_percentile_25 is None  # round(0.25 * 1) = 0
    assert r.revenue_at_percentile_50 == 10.0 and r.revenue_at_percentile_75 == 10.0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_nearest_rank_matches_sort(spark, seed):
    rnd = random.Random(seed)
    vals = [Decimal(rnd.randint(0, 5000)) / 100 for _ in range(3000)]
    vals += [Decimal("1e9")]                      # outlier squeezes the first histogram
    vals += [Decimal("12.34")] * 700              # heavy duplicate
    df = spark.createDataFrame([(v,) for v in vals], "v decimal(18,2)")
    ps = [1, 10, 25, 33, 50, 67, 75, 99, 100]
    got = {r.percentile: r.value for r in nearest_rank(df, "v", ps, accuracy=20, splitters=4).collect()}
    assert got == {p: _nearest_rank_brute(vals, p) for p in ps}


def test_empty_month_report(spark):
    s = _sales(spark, [(1, 1, 2, Decimal("10.00"), 5, "t", T(2020, 1, 5))])
    r = S.report_scalars(S.month_sales(s, 2)).first()
    assert r.total_qty is None and r.rev_before_discount is None
    assert r.total_unique_transac == 0 and r.revenue_at_percentile_50 is None


def test_report_rounding_and_year_range(spark):
    rows = [(1, 1, 1, Decimal("10.50"), 10, "t", T(2020, 3, 1)),
            (1, 2, 1, Decimal("0.01"), 50, "t", T(2020, 3, 1)),
            (2, 1, 3, Decimal("5.00"), 0, "f", T(2021, 3, 9))]
    s = _sales(spark, rows)
    r = S.report_scalars(S.month_sales(s, 3)).first()
    assert r.total_qty == 5 and r.rev_before_discount == 16          # 15.51 -> 16
    assert r.total_discount == 1                                       # 1.055 -> 1
    assert r.avg_unique_product == 2                                   # 1.5 -> 2 (half up)
    r2 = S.report_scalars(S.month_sales(s, 3, year=2021)).first()
    assert r2.total_qty == 3 and r2.total_unique_transac == 1


def test_basket_sets_match_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for t in range(200):
        for _ in range(rnd.randint(1, 7)):
            rows.append((t, rnd.randint(1, 12)))          # duplicates inside a basket on purpose
    df = spark.createDataFrame(rows, "txn long, item long")
    got = {(r.item_1, r.item_2, r.item_3): r.baskets for r in basket_combinations(df, "txn", "item").collect()}
    baskets = {}
    for t, i in rows:
        baskets.setdefault(t, set()).add(i)
    want = {}
    for items in baskets.values():
        for c in itertools.combinations(sorted(items), 3):
            want[c] = want.get(c, 0) + 1
    assert got == want


def test_share_of_parent_sums_to_one(spark):
    s = _sales(spark, [(1, 1, 1, Decimal("3.00"), 0, "t", T(2020, 1, 1)),
                       (2, 2, 1, Decimal("1.00"), 0, "t", T(2020, 1, 1)),
                       (3, 3, 1, Decimal("5.00"), 0, "t", T(2020, 1, 1))])
    p = _products(spark, [(1, "a", "x", "k"), (2, "b", "x", "k"), (3, "c", "y", "k")])
    out = S.product_share_in_segment(s, p).groupBy("segment_name").agg(F.sum("rev_pct").alias("t"))
    assert {r.segment_name: round(r.t, 12) for r in out.collect()} == {"x": 1.0, "y": 1.0}


# -- clicks -------------------------------------------------------------------
def test_later_pairs_ignore_equal_times(spark):
    rows = [("v", T(2024, 1, 1, 10), 2), ("v", T(2024, 1, 1, 10), 3),   # same time: not later
            ("v", T(2024, 1, 1, 11), 3), ("w", T(2024, 1, 1, 9), 2)]
    df = spark.createDataFrame(rows, "visit string, t timestamp_ntz, e int")
    r = later_pairs(df, "visit", "t", F.col("e") == 2, F.col("e") == 3).first()
    assert (r.a_rows, r.pairs) == (2, 1)


def test_later_pairs_match_self_join(spark):
    rnd = random.Random(3)
    rows = [(f"v{rnd.randint(0, 20)}", T(2024, 1, 1, rnd.randint(0, 5)), rnd.randint(1, 3)) for _ in range(600)]
    df = spark.createDataFrame(rows, "visit string, t timestamp_ntz, e int")
    r = later_pairs(df, "visit", "t", F.col("e") == 2, F.col("e") == 3).first()
    a = [x for x in rows if x[2] == 2]
    b = [x for x in rows if x[2] == 3]
    pairs = sum(1 for x in a for y in b if x[0] == y[0] and y[1] > x[1])
    assert (r.a_rows, r.pairs) == (len(a), pairs)


def test_zero_denominator_rate_is_null(spark):
    pf = spark.createDataFrame([(1, "p", 5, 0, 0, 0)],
                               "product_id long, product string, views long, cart_adds long, abandoned long, purchases long")
    assert C.abandon_rate(pf).first().abandoned_pct is None
    assert C.view_to_purchase_rate(pf).first().view_to_purchase_pct == 0.0


def test_overlapping_campaigns_pick_earliest_start(spark):
    camps = spark.createDataFrame([("B", T(2024, 1, 2), T(2024, 1, 9)), ("A", T(2024, 1, 1), T(2024, 1, 5)),
                                   ("C", T(2024, 1, 1), T(2024, 1, 3))],
                                  "campaign_name string, start_date timestamp_ntz, end_date timestamp_ntz")
    visits = spark.createDataFrame([(1, T(2024, 1, 2)), (2, T(2024, 1, 4)), (3, T(2024, 1, 7)), (4, T(2024, 2, 1))],
                                   "v int, at timestamp_ntz")
    out = {r.v: r.campaign_name for r in
           attribute_interval(visits, "at", camps, "campaign_name", "start_date", "end_date").collect()}
    assert out == {1: "A", 2: "A", 3: "B", 4: None}


def test_cart_order_follows_event_order(spark):
    df = spark.createDataFrame([("v", 3, "Apple"), ("v", 1, "Pear"), ("v", 2, None), ("w", 1, None)],
                               "visit string, seq int, name string")
    out = {r.visit: r.cart for r in ordered_concat(df, "visit", {"cart": F.col("name")}, ["seq"], [F.col("seq")], ", ").collect()}
    assert out == {"v": "Pear, Apple", "w": None}


# -- subscriptions --------------------------------------------------------------
def _plans(spark):
    from bramble.sources.fixtures import PLANS
    return spark.createDataFrame([(i, n, None if p is None else Decimal(p)) for i, n, p in PLANS],
                                 "plan_id int, plan_name string, price decimal(18,2)")


def _subs(spark, rows):
    return spark.createDataFrame([(c, p, d, i) for i, (c, p, d) in enumerate(rows)],
                                 "customer_id long, plan_id int, start_date date, sub_id long")


def _drift_brute(d0, i):
    d = d0
    for _ in range(i):
        y, m = (d.year + (d.month == 12), d.month % 12 + 1)
        last = (D(y + (m == 12), m % 12 + 1, 1) - dt.timedelta(days=1)).day
        d = D(y, m, min(d.day, last))
    return d


def test_drift_closed_form_matches_iteration(spark):
    starts = [D(2019, 1, 1) + dt.timedelta(days=k) for k in range(0, 2200, 3)]
    rows = [(s, i) for s in starts for i in (0, 1, 2, 5, 11, 12, 13, 25, 40)]
    df = spark.createDataFrame(rows, "d date, i int").withColumn("p", drift_month_dates(F.col("d"), F.col("i")))
    bad = [(r.d, r.i, r.p) for r in df.collect() if r.p != _drift_brute(r.d, r.i)]
    assert not bad, bad[:5]


def test_day31_drift_vs_start_anchor(spark):
    subs = _subs(spark, [(1, 1, D(2020, 1, 31))])
    horizon = F.lit(D(2020, 4, 30))
    drift = [r.payment_date for r in payment_schedule(subs, _plans(spark), horizon).orderBy("payment_order").collect()]
    start = [r.payment_date for r in payment_schedule(subs, _plans(spark), horizon, anchor="start")
             .orderBy("payment_order").collect()]
    assert drift == [D(2020, 1, 31), D(2020, 2, 29), D(2020, 3, 29), D(2020, 4, 29)]
    assert start == [D(2020, 1, 31), D(2020, 2, 29), D(2020, 3, 31), D(2020, 4, 30)]


def test_churn_on_payment_date_and_credit(spark):
    subs = _subs(spark, [(1, 1, D(2020, 1, 15)), (1, 4, D(2020, 3, 15)),
                         (2, 1, D(2020, 1, 10)), (2, 3, D(2020, 2, 20))])
    incl = payment_schedule(subs, _plans(spark), F.lit(D(2020, 12, 31)))
    excl = payment_schedule(subs, _plans(spark), F.lit(D(2020, 12, 31)), inclusive_end=False)
    c1 = [r.payment_date for r in incl.where("customer_id = 1").orderBy("payment_order").collect()]
    assert c1 == [D(2020, 1, 15), D(2020, 2, 15), D(2020, 3, 15)]
    assert excl.where("customer_id = 1").count() == 2
    c2 = [(r.plan_name, r.amount) for r in incl.where("customer_id = 2").orderBy("payment_order").collect()]
    assert c2 == [("basic monthly", Decimal("9.90")), ("basic monthly", Decimal("9.90")),
                  ("pro annual", Decimal("189.10"))]


def test_payment_order_dense_per_customer(spark):
    subs = _subs(spark, [(1, 2, D(2020, 5, 1)), (1, 2, D(2020, 5, 1)), (1, 3, D(2020, 9, 1))])
    p = payment_schedule(subs, _plans(spark), F.lit(D(2020, 12, 31)))
    orders = sorted(r.payment_order for r in p.collect())
    assert orders == list(range(1, len(orders) + 1))


def test_nth_in_order_matches_row_number(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(1, 30), rnd.randint(0, 4), D(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 40)))
            for _ in range(300)]
    subs = _subs(spark, rows)
    w = Window.partitionBy("customer_id").orderBy("start_date", "plan_id", "sub_id")
    want = {(r.customer_id, r.plan_id, r.start_date, r.sub_id) for r in
            subs.withColumn("rn", F.row_number().over(w)).where("rn = 2").collect()}
    got = {(r.customer_id, r.plan_id, r.start_date, r.sub_id) for r in
           nth_in_order(subs, "customer_id", ["start_date", "plan_id", "sub_id"], 2).collect()}
    assert got == want


def test_plan_without_rows_kept(spark):
    subs = _subs(spark, [(1, 0, D(2020, 1, 1)), (1, 1, D(2021, 2, 1))])
    out = {r.plan_id: (r.event_2020, r.event_2021) for r in SUB.plan_events_by_year(subs, _plans(spark), "2021-01-01").collect()}
    assert out == {0: (1, 0), 1: (1, 1), 2: (0, 0), 3: (0, 0), 4: (0, 0)}


def test_pct1_half_up(spark):
    from bramble.functions.columns import pct1
    df = spark.createDataFrame([(1, 8), (307, 1000), (1, 3), (0, 5), (1, 0)], "a long, b long")
    got = [r.p for r in df.select(pct1("a", "b").alias("p")).collect()]
    assert got == [12.5, 30.7, 33.3, 0.0, None]


# -- hot-key split (thresholds forced low so the split path runs) -----------------
HOT = dict(min_hot_rows=20, rows_per_bucket=7)


def test_sequence_columns_hot_split_matches_window(spark):
    from bramble.operators.skew import sequence_columns
    rnd = random.Random(11)
    rows = [(0 if rnd.random() < 0.6 else rnd.randint(1, 15), rnd.randint(0, 50), rnd.randint(0, 3), i, rnd.random())
            for i in range(400)]
    df = spark.createDataFrame(rows, "k long, t long, p int, id long, x double")
    order = ["t", "p", "id"]
    got = sequence_columns(df, "k", order, [F.col(c) for c in order], row_number="rn", lag={"px": "x"},
                           lead={"nt": "t", "nx": "x"}, **HOT)
    w = Window.partitionBy("k").orderBy(*order)
    want = (df.withColumn("rn", F.row_number().over(w)).withColumn("px", F.lag("x").over(w))
            .withColumn("nt", F.lead("t").over(w)).withColumn("nx", F.lead("x").over(w)))
    cols = ["k", "t", "p", "id", "x", "rn", "px", "nt", "nx"]
    assert sorted(got.select(cols).collect()) == sorted(want.select(cols).collect())


def test_later_pairs_hot_split_matches_brute_force(spark):
    rnd = random.Random(12)
    rows = [("hot" if rnd.random() < 0.7 else f"v{rnd.randint(0, 5)}", T(2024, 1, 1, rnd.randint(0, 23)),
             rnd.randint(1, 3)) for _ in range(500)]
    df = spark.createDataFrame(rows, "visit string, t timestamp_ntz, e int")
    r = later_pairs(df, "visit", "t", F.col("e") == 2, F.col("e") == 3, **HOT).first()
    a = [x for x in rows if x[2] == 2]
    b = [x for x in rows if x[2] == 3]
    pairs = sum(1 for x in a for y in b if x[0] == y[0] and y[1] > x[1])
    assert (r.a_rows, r.pairs) == (len(a), pairs)


def test_payment_schedule_hot_split_matches_default(spark):
    rnd = random.Random(13)
    rows = [(0 if rnd.random() < 0.5 else rnd.randint(1, 20), rnd.randint(0, 4),
             D(2019, 1, 1) + dt.timedelta(days=rnd.randint(0, 700))) for _ in range(300)]
    subs = _subs(spark, rows)
    h = F.lit(D(2021, 6, 30))
    a = payment_schedule(subs, _plans(spark), h).collect()
    b = payment_schedule(subs, _plans(spark), h, **HOT).collect()
    assert len(a) > 100 and sorted(a) == sorted(b)


def _brute_top_sets(rows, n, k=3):
    baskets = {}
    for t, i in rows:
        baskets.setdefault(t, set()).add(i)
    cnt = {}
    for items in baskets.values():
        for c in itertools.combinations(sorted(items), k):
            cnt[c] = cnt.get(c, 0) + 1
    return sorted(((-v, c) for c, v in cnt.items()))[:n]


@pytest.mark.parametrize("seed,hot_items,n", [(21, 40, 10), (22, 25, 3), (23, 60, 1)])
def test_top_sets_with_big_baskets_match_brute_force(spark, seed, hot_items, n):
    from bramble.operators.basket import top_basket_combinations
    rnd = random.Random(seed)
    rows = [(t, rnd.randint(1, 15)) for t in range(150) for _ in range(rnd.randint(1, 6))]
    rows += [(1000, i) for i in range(1, hot_items)]            # one huge basket
    rows += [(1001 + j, i) for j in range(3) for i in rnd.sample(range(1, 30), 12)]  # a few more big ones
    df = spark.createDataFrame(rows, "txn long, item long")
    got = [(-r.baskets, (r.item_1, r.item_2, r.item_3))
           for r in top_basket_combinations(df, "txn", "item", n).collect()]
    assert got == _brute_top_sets(rows, n)


def test_top_sets_only_in_big_baskets(spark):
    from bramble.operators.basket import top_basket_combinations
    # the winning set {1,2,3} appears only in big baskets; small baskets have weak sets
    rows = [(b, i) for b in range(5) for i in [1, 2, 3] + list(range(10 + 20 * b, 30 + 20 * b))]
    rows += [(100 + t, i) for t in range(4) for i in (200 + t, 300 + t, 400 + t)]
    df = spark.createDataFrame(rows, "txn long, item long")
    got = [(-r.baskets, (r.item_1, r.item_2, r.item_3))
           for r in top_basket_combinations(df, "txn", "item", 2).collect()]
    assert got == _brute_top_sets(rows, 2)


def test_clicks_sequence_number_matches_sql_view(spark, duck_small):
    from bramble.sources.fixtures import with_views
    from bramble.sources.tables import Tables
    from conftest import SF_SMALL
    got = {(r.event_id, r.sequence_number) for r in
           Tables(spark, SF_SMALL).fixtures.clicks_sequenced.select("event_id", "sequence_number").collect()}
    want = set(duck_small.execute(with_views("SELECT event_id, sequence_number FROM clicks")).fetchall())
    assert got == want


def test_share_of_parent_null_parent_grouped(spark):
    from bramble.operators.shares import share_of_parent
    df = spark.createDataFrame([(None, "a", 1.0), (None, "b", 3.0), ("x", "c", 2.0)], "p string, c string, m double")
    got = {r.c: r.share for r in share_of_parent(df, "p", "m").collect()}
    assert got == {"a": 0.25, "b": 0.75, "c": 1.0}


def test_checkout_unit_visits_and_event_share_unit_visit(spark):
    pages = spark.createDataFrame([(2, "Checkout", None, None), (4, "Item 1", "A", 1)],
                                  "page_id int, page_name string, product_category string, product_id int")
    names = spark.createDataFrame([(1, "Page View"), (3, "Purchase")], "event_type int, event_name string")
    rows = [(1, "v1", 2, 1, T(2024, 1, 1, 1)), (2, "v1", 2, 1, T(2024, 1, 1, 2)), (3, "v1", 4, 3, T(2024, 1, 1, 3)),
            (4, "v1", 4, 3, T(2024, 1, 1, 4)), (5, "v2", 2, 1, T(2024, 1, 1, 5)), (6, "v3", 4, 1, T(2024, 1, 1, 1))]
    clicks = spark.createDataFrame(rows, "event_id long, visit_id string, page_id int, event_type int, event_time timestamp_ntz")
    pairs = C.checkout_without_purchase(clicks, pages).first()
    assert (pairs.checkout_visits, pairs.purchase_visits) == (3, 4)       # 2 checkouts x 2 later purchases
    visits = C.checkout_without_purchase(clicks, pages, unit="visits").first()
    assert (visits.checkout_visits, visits.purchase_visits, visits.nonpurchase_visits) == (2, 1, 1)
    share = {r.event_name: (r.visits, r.visit_pct) for r in C.event_type_share(clicks, names, unit="visit").collect()}
    assert share == {"Page View": (3, 1.0), "Purchase": (1, 1 / 3)}


def test_report_unrounded(spark):
    rows = [(1, 1, 1, Decimal("10.50"), 10, "t", T(2020, 3, 1)),
            (1, 2, 1, Decimal("0.01"), 50, "t", T(2020, 3, 1))]
    r = S.report_scalars(S.month_sales(_sales(spark, rows), 3), rounded=False).first()
    assert (r.rev_before_discount, r.total_discount, r.avg_unique_product) == (10.51, 1.055, 2.0)


def test_generic_counts(spark):
    from bramble.operators.aggregates import (bucketize, conditional_counts, count_by_lookup,
                                              distinct_by_period, distinct_share)
    df = spark.createDataFrame([(1, "a", T(2020, 1, 5), 1), (1, "a", T(2021, 1, 9), 2), (2, "b", T(2020, 2, 1), 2),
                                (3, None, T(2020, 2, 3), 9)], "k int, e string, t timestamp_ntz, c int")
    assert {(r.month, r.n) for r in distinct_by_period(df, "t", "e").collect()} == {(1, 1), (2, 1)}
    assert {(r.year, r.n) for r in distinct_by_period(df, "t", "e", "year").collect()} == {(2020, 2), (2021, 1)}
    look = spark.createDataFrame([(1, "one"), (2, "two")], "c int, name string")
    assert {(r.name, r.n) for r in count_by_lookup(df, "c", look, "name", "e", "n").collect()} == \
        {("one", 1), ("two", 2), (None, 0)}
    cc = {r.k: (r.x, r.y) for r in conditional_counts(df, "k", {"x": F.col("c") == 2, "y": F.col("c") > 0},
                                                       value="e").collect()}
    assert cc == {1: (1, 2), 2: (1, 1), 3: (0, 0)}
    ds = distinct_share(df, "e", F.col("c") == 2, "n", "pct").first()
    assert (ds.n, ds.pct) == (2, 100.0)
    days = spark.createDataFrame([(1, 0), (2, 29), (3, 30), (3, 61)], "e int, d int")
    assert {(r.lbl, r.n) for r in bucketize(days, "d", 30, "e", "lbl", "n").collect()} == \
        {("0-29 days", 2), ("30-59 days", 1), ("60-89 days", 1)}


def test_time_rank_orders_microseconds(spark):
    from bramble.operators.sequences import time_rank
    ts = [T(2024, 1, 1, 0, 0, 1, 5), T(2024, 1, 1, 0, 0, 1, 6), T(2024, 1, 1, 0, 0, 2), T(1999, 12, 31, 23, 59, 59, 999999)]
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz").withColumn("r", time_rank("t"))
    got = [r.t for r in df.orderBy("r").collect()]
    assert got == sorted(ts) and df.select("r").distinct().count() == 4


def test_conversion_metrics_distinct_visits_and_null_visit(spark):
    from bramble.operators.funnel import conversion_metrics
    rows = [("g", 1, "v1", 2, 1), ("g", 2, "v1", 0, 0),   # one visit seen under two users
            ("g", 1, "v2", 0, 3), ("g", 3, None, 4, 0),   # a row without a visit
            ("h", 5, "v9", 0, 0)]
    df = spark.createDataFrame(rows, "grp string, user long, visit string, views long, adds long")
    out = {r.grp: r for r in conversion_metrics(df, ["grp"], "user", "visit", {"vc": "views", "ac": "adds"},
                                                 {"mv": "views"}, {"rate": ("ac", "vc")}).collect()}
    g, h = out["g"], out["h"]
    assert (g.user_count, g.vc, g.ac, g.mv, g.rate) == (3, 1, 2, 1.5, 2.0)
    assert (h.user_count, h.vc, h.ac, h.mv, h.rate) == (1, 0, 0, 0.0, None)
