
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL

import __spark_entry__ as entry_mod
from bramble.operators.basket import basket_combinations
from bramble.plans import sales as S
from bramble.sources.fixtures import REPORT_MONTH
from bramble.sources.tables import Tables


def _q(spark, key):
    return entry_mod.queries()[key](spark, SF_SMALL)


def test_shares_in_parent_sum_to_one(spark):
    for key, parent in (("product_share_in_segment", "segment_name"), ("segment_share_in_category", "category_name")):
        sums = _q(spark, key).groupBy(parent).agg(F.sum("rev_pct").alias("s")).collect()
        assert sums and all(abs(r.s - 1.0) < 1e-9 for r in sums)
    total = _q(spark, "category_share_of_total").agg(F.sum("rev_pct")).first()[0]
    assert abs(total - 1.0) < 1e-9


def test_funnel_purchases_plus_abandoned_equal_adds(spark):
    bad = _q(spark, "product_funnel").where(F.col("purchases") + F.col("abandoned") != F.col("cart_adds")).count()
    assert bad == 0


def test_payment_order_dense_from_one(spark):
    p = _q(spark, "payments_all")
    per = p.groupBy("customer_id").agg(F.min("payment_order").alias("lo"), F.max("payment_order").alias("hi"),
                                      F.count(F.lit(1)).alias("n"), F.countDistinct("payment_order").alias("d"))
    assert per.where((F.col("lo") != 1) | (F.col("hi") != F.col("n")) | (F.col("d") != F.col("n"))).count() == 0
    # order follows payment dates
    w = Window.partitionBy("customer_id").orderBy("payment_order")
    assert p.withColumn("prev", F.lag("payment_date").over(w)).where("prev > payment_date").count() == 0


def test_triple_count_bounded_by_pair_counts(spark):
    sales = Tables(spark, SF_SMALL).fixtures.sales
    pairs = basket_combinations(sales, "txn_id", "prod_id", k=2)
    triples = basket_combinations(sales, "txn_id", "prod_id", k=3)
    assert triples.count() > 0
    for a, b in (("item_1", "item_2"), ("item_1", "item_3"), ("item_2", "item_3")):
        p = pairs.select(F.col("item_1").alias(a), F.col("item_2").alias(b), F.col("baskets").alias("pc"))
        j = triples.join(p, [a, b], "left")
        assert j.where(F.col("pc").isNull() | (F.col("baskets") > F.col("pc"))).count() == 0


REPORT_KEYS = {
    "total_qty": "report_total_qty", "rev_before_discount": "report_gross_revenue", "total_discount": "report_total_discount",
    "total_unique_transac": "report_unique_txn", "avg_unique_product": "report_avg_unique_products",
    "avg_discount": "report_avg_discount", "member_split": "report_member_split",
    "member_avg_revenue": "report_member_avg_revenue", "top_products": "report_top_products",
    "segment_totals": "report_segment_totals", "segment_top_seller": "report_segment_top_seller",
    "category_totals": "report_category_totals", "category_top_seller": "report_category_top_seller",
    "product_share": "report_product_share", "segment_share": "report_segment_share", "category_share": "report_category_share",
    "penetration": "report_penetration", "top_triples": "report_top_triples", "scalars": "monthly_report"}


def test_monthly_report_dict_matches_keys(spark):
    fx = Tables(spark, SF_SMALL).fixtures
    rep = S.monthly_report(fx.sales_lines, fx.product_details, REPORT_MONTH, txns=fx.transactions)
    assert len(rep) == 22  # 9 scalars + 12 result tables + the one-row scalar frame
    q = entry_mod.queries()
    for name, key in REPORT_KEYS.items():
        assert sorted(map(tuple, rep[name].collect())) == sorted(map(tuple, q[key](spark, SF_SMALL).collect())), name
    percentiles = q["report_revenue_percentile"](spark, SF_SMALL).first()
    assert tuple(rep[f"revenue_at_percentile_{p}"].first()[0] for p in (25, 50, 75)) == tuple(percentiles)


def test_report_of_other_months_percentiles_and_n(spark, duck_small):
    """Both forms of the input, and plain SQL, at parameters other than the registered ones."""
    from bramble.sources.fixtures import with_views
    fx = Tables(spark, SF_SMALL).fixtures
    month, top, ps = 7, 5, (10, 90)
    a = S.monthly_report(fx.sales_lines, fx.product_details, month, top=top, txns=fx.transactions, percentiles=ps)
    b = S.monthly_report(fx.sales, fx.product_details, month, top=top, percentiles=ps)
    assert set(a) == set(b)
    for name in ("scalars", "member_split", "top_products", "penetration", "category_share"):
        assert sorted(map(tuple, a[name].collect())) == sorted(map(tuple, b[name].collect())), name
    want = duck_small.execute(with_views(f"""
        SELECT p.product_name, CAST(SUM(s.gross) AS DOUBLE) AS rev FROM sales s JOIN product_details p ON p.product_id = s.prod_id
        WHERE MONTH(s.start_txn_time) = {month} GROUP BY 1 ORDER BY SUM(s.gross) DESC, 1 LIMIT {top}""")).fetchall()
    assert [tuple(r) for r in a["top_products"].collect()] == want
    revs = [r[0] for r in duck_small.execute(with_views(f"""
        SELECT CAST(SUM(gross) AS DOUBLE) FROM sales WHERE MONTH(start_txn_time) = {month} GROUP BY txn_id ORDER BY 1""")).fetchall()]
    scalars = a["scalars"].first()
    for p in ps:
        assert scalars[f"revenue_at_percentile_{p}"] == revs[(len(revs) * p + 50) // 100 - 1]
