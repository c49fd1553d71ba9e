"""Named queries: key -> callable(spark, sf_dir) -> DataFrame, and key -> oracle SQL.

Each entry binds an operator of ``bramble.plans.*`` to the mapped views of the driver
tables at ``sf_dir``. The oracle SQL is prefixed with the same views in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bramble.operators.hierarchy import paths
from bramble.plans import sales as S
from bramble.plans.clicks import QUERIES as CLICK_QUERIES
from bramble.plans.subscriptions import QUERIES as SUB_QUERIES
from bramble.sources.fixtures import REPORT_MONTH, with_views
from bramble.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]


def _fx(spark: SparkSession, sf_dir: str):
    return Tables(spark, sf_dir).fixtures


def _lines(fn, *args, **kw) -> Query:
    """Lines only: nothing of the transaction is read."""
    return lambda spark, sf_dir: fn(_fx(spark, sf_dir).sales_lines, *args, **kw)


def _lines_prod(fn, *args, **kw) -> Query:
    def q(spark, sf_dir):
        fx = _fx(spark, sf_dir)
        return fn(fx.sales_lines, fx.product_details, *args, **kw)
    return q


def _txn(fn, *args, **kw) -> Query:
    def q(spark, sf_dir):
        fx = _fx(spark, sf_dir)
        return fn(fx.sales_lines, *args, txns=fx.transactions, **kw)
    return q


def _month_txn(fn, *args, **kw) -> Query:
    """Lines of the month only: they meet the month's transactions before anything is combined
    or dealt out."""
    def q(spark, sf_dir):
        fx = _fx(spark, sf_dir)
        return fn(S.month_lines(fx.sales_lines, fx.transactions, REPORT_MONTH), *args, **kw)
    return q


def _month_txn_prod(fn, *args, **kw) -> Query:
    def q(spark, sf_dir):
        fx = _fx(spark, sf_dir)
        return fn(S.month_lines(fx.sales_lines, fx.transactions, REPORT_MONTH), fx.product_details, *args, **kw)
    return q


def _month_sales_prod(fn, *args, **kw) -> Query:
    def q(spark, sf_dir):
        fx = _fx(spark, sf_dir)
        month = S.month_sales(fx.transactions, REPORT_MONTH).select("txn_id")
        return fn(fx.sales_lines.join(month, "txn_id", "left_semi"), fx.product_details, *args, **kw)
    return q


def _select(q: Query, *cols: str) -> Query:
    return lambda spark, sf_dir: q(spark, sf_dir).select(*cols)


def _hierarchy(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return S.hierarchy_flatten(fx.product_hierarchy, fx.product_prices)


def _hierarchy_paths(spark, sf_dir):
    return paths(_fx(spark, sf_dir).product_hierarchy)


def _report_rows(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return S.report_rows(S.stored_report(fx.sales_lines, fx.transactions, fx.product_details, REPORT_MONTH, top=3))


_scalars = _month_txn(S.report_scalars)
_totals = _month_txn(S.report_totals)

QUERIES: dict[str, Query] = {
    # sales: high level and transactions
    "sales_total_qty": _select(_lines(S.totals), "total_quantity"),
    "sales_gross_revenue": _select(_lines(S.totals), "total_rev_before_discount"),
    "sales_total_discount": _select(_lines(S.totals), "total_discount"),
    "txn_unique": _lines(S.txn_unique),
    "txn_avg_unique_products": _lines(S.txn_avg_unique_products),
    "txn_revenue_percentiles": _lines(S.txn_revenue_percentiles),
    "txn_avg_discount": _lines(S.txn_avg_discount),
    "txn_member_split": _txn(S.txn_member_split),
    "txn_member_avg_revenue": _txn(S.txn_member_avg_revenue),
    # sales: products
    "top_products_by_revenue": _lines_prod(S.top_products_by_revenue, 3),
    "segment_totals": _lines_prod(S.level_totals, "segment_name"),
    "segment_top_seller": _lines_prod(S.level_top_seller, "segment_name"),
    "category_totals": _lines_prod(S.level_totals, "category_name"),
    "category_top_seller": _lines_prod(S.level_top_seller, "category_name"),
    "product_share_in_segment": _lines_prod(S.product_share_in_segment),
    "segment_share_in_category": _lines_prod(S.segment_share_in_category),
    "category_share_of_total": _lines_prod(S.category_share_of_total),
    "product_penetration": _lines_prod(S.product_penetration),
    "basket_top_triples": _lines_prod(S.basket_top_triples, 10),
    "hierarchy_flatten": _hierarchy,
    "hierarchy_paths": _hierarchy_paths,
    # sales: monthly report
    "report_total_qty": _select(_totals, "total_qty"),
    "report_gross_revenue": _select(_totals, "rev_before_discount"),
    "report_total_discount": _select(_totals, "total_discount"),
    "report_unique_txn": _select(_totals, "total_unique_transac"),
    "report_avg_unique_products": _select(_totals, "avg_unique_product"),
    "report_revenue_percentile": _month_txn(S.txn_revenue_percentiles),
    "report_avg_discount": _select(_totals, "avg_discount"),
    "report_member_split": _month_txn(S.txn_member_split),
    "report_member_avg_revenue": _month_txn(S.txn_member_avg_revenue),
    "report_top_products": _month_sales_prod(S.top_products_by_revenue, 3),
    "report_segment_totals": _month_sales_prod(S.level_totals, "segment_name"),
    "report_segment_top_seller": _month_sales_prod(S.level_top_seller, "segment_name"),
    "report_category_totals": _month_sales_prod(S.level_totals, "category_name"),
    "report_category_top_seller": _month_sales_prod(S.level_top_seller, "category_name"),
    "report_product_share": _month_sales_prod(S.product_share_in_segment),
    "report_segment_share": _month_sales_prod(S.segment_share_in_category),
    "report_category_share": _month_sales_prod(S.category_share_of_total),
    "report_penetration": _month_txn_prod(S.product_penetration),
    "report_top_triples": _month_txn_prod(S.basket_top_triples, 1),
    "monthly_report": _scalars,
    "monthly_report_results": _report_rows,
}


def _oracles() -> dict[str, str]:
    from bramble.plans.oracle_clicks import CLICKS_SQL
    from bramble.plans.oracle_sales import SALES_SQL
    from bramble.plans.oracle_subs import SUBS_SQL
    raw = {**SALES_SQL, **CLICKS_SQL, **SUBS_SQL}
    return {k: with_views(v) for k, v in raw.items()}


QUERIES.update(CLICK_QUERIES)
QUERIES.update(SUB_QUERIES)
ORACLE_SQL: dict[str, str] = _oracles()
