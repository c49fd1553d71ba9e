"""Clickstream case: digital analysis, product funnel, campaigns.

Inputs: ``clicks`` (event_id, visit_id, cookie_id, page_id, event_type, event_time,
sequence_number), ``users`` (user_id, cookie_id), and the small lookups
``event_identifier``, ``page_hierarchy`` and ``campaign_identifier``. The lookups describe
the site (event kinds, pages, campaign calendar); the planner broadcasts them by its own
size check. Event codes: 1 page view, 2 cart add, 3 purchase, 4 impression,
5 click.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bramble.functions.columns import ratio
from bramble.operators.aggregates import conditional_counts, count_by_lookup, count_distinct, distinct_by_period
from bramble.operators.funnel import conversion_metrics, funnel, ordered_concat
from bramble.operators.intervals import attribute_interval
from bramble.operators.ranking import leaders, top_n
from bramble.operators.sequences import later_pairs, time_rank
from bramble.operators.shares import share_of_total
from bramble.sources.tables import Tables

VIEW, ADD, PURCHASE, IMPRESSION, CLICK = 1, 2, 3, 4, 5


def _with_page(clicks: DataFrame, pages: DataFrame, cols=("page_name",)) -> DataFrame:
    return clicks.join(pages.select("page_id", *cols), "page_id", "left")


# -- part 2: digital analysis -------------------------------------------------
def users_count(users: DataFrame) -> DataFrame:
    return count_distinct(users, "user_id", alias="users")


def cookies_per_user(users: DataFrame) -> DataFrame:
    # one pass: cookies per user id, then total cookies and non-null user ids
    per_user = users.groupBy("user_id").agg(F.count("cookie_id").alias("_c"))
    return per_user.agg(ratio(F.sum("_c"), F.count("user_id")).alias("avg_cookies"))


def visits_by_month(clicks: DataFrame) -> DataFrame:
    return distinct_by_period(clicks, "event_time", "visit_id", "month", alias="visits")


def _events_per_name(clicks: DataFrame, names: DataFrame, alias: str) -> DataFrame:
    return count_by_lookup(clicks, "event_type", names, "event_name", "visit_id", alias)


def events_by_type(clicks: DataFrame, names: DataFrame) -> DataFrame:
    return _events_per_name(clicks, names, "counts").orderBy(F.col("counts").desc(), "event_name")


def event_type_share(clicks: DataFrame, names: DataFrame, unit: str = "event") -> DataFrame:
    """Per event name: count and share of all. ``unit='event'`` counts events (what the
    case study's query does); ``unit='visit'`` counts distinct visits with that event
    (what its question asks), as a share of all distinct visits."""
    if unit == "visit":
        named = clicks.join(names, "event_type", "left")
        per = count_distinct(named, "visit_id", by="event_name", alias="visits")
        total = count_distinct(clicks, "visit_id", alias="_t")
        return (share_of_total(per, "visits", alias="visit_pct", total=total)
                .orderBy(F.col("visits").desc(), "event_name"))
    per = _events_per_name(clicks, names, "visits")
    return (share_of_total(per, "visits", alias="visit_pct")  # every event is in one of the rows
            .orderBy(F.col("visits").desc(), "event_name"))


def checkout_without_purchase(clicks: DataFrame, pages: DataFrame, unit: str = "pairs") -> DataFrame:
    """Checkout-page events and purchases after them in the same visit. ``unit='pairs'``
    (as the case study's self-join counts): checkout events and (checkout, later purchase)
    pairs, so shares may leave 0..1. ``unit='visits'``: visits with a checkout view, and
    those with a purchase after one."""
    ev = _with_page(clicks, pages)
    p = later_pairs(ev.where(F.col("visit_id").isNotNull()), "visit_id", "event_time",
                    first=F.col("page_name") == "Checkout", then=F.col("event_type") == PURCHASE,
                    per_partition=(unit == "visits"))
    return p.select(F.col("a_rows").alias("checkout_visits"), F.col("pairs").alias("purchase_visits"),
                    ratio("pairs", "a_rows").alias("purchase_pct"),
                    (F.col("a_rows") - F.col("pairs")).alias("nonpurchase_visits"),
                    (F.lit(1.0) - ratio("pairs", "a_rows")).alias("nonpurchase_pct"))


def top_pages_by_views(clicks: DataFrame, pages: DataFrame, n: int = 3) -> DataFrame:
    per_page = (clicks.where(F.col("event_type") == VIEW).groupBy("page_id")
                .agg(F.count("visit_id").alias("_n")))
    per = (per_page.join(pages.select("page_id", "page_name"), "page_id", "left")
           .groupBy("page_name").agg(F.sum("_n").cast("bigint").alias("views")))
    return top_n(per, [F.col("views").desc(), F.col("page_name").asc_nulls_first()], n)


def category_views_and_adds(clicks: DataFrame, pages: DataFrame) -> DataFrame:
    per_page = conditional_counts(clicks, "page_id", {"_v": F.col("event_type") == VIEW,
                                                      "_a": F.col("event_type") == ADD}, value="visit_id")
    cats = pages.where(F.col("product_category").isNotNull()).select("page_id", "product_category")
    return (per_page.join(cats, "page_id").groupBy("product_category")
            .agg(F.sum("_v").cast("bigint").alias("views"), F.sum("_a").cast("bigint").alias("cart_adds")))


def top_products_by_purchase(clicks: DataFrame, pages: DataFrame, n: int = 3) -> DataFrame:
    ev = _with_page(clicks, pages).withColumnRenamed("page_name", "product")
    p = later_pairs(ev.where(F.col("visit_id").isNotNull()), "visit_id", "event_time",
                    first=F.col("event_type") == ADD, then=F.col("event_type") == PURCHASE,
                    group=["product"])
    p = p.where(F.col("pairs") > 0).select("product", F.col("pairs").alias("purchase_visits"))
    return top_n(p, [F.col("purchase_visits").desc(), F.col("product").asc_nulls_first()], n)


# -- part 3: product funnel -----------------------------------------------------
def product_funnel(clicks: DataFrame, pages: DataFrame) -> DataFrame:
    prod_pages = (pages.where(F.col("product_id").isNotNull())
                  .select("page_id", "product_id", F.col("page_name").alias("product")))
    ev = clicks.join(prod_pages, "page_id")
    pf = funnel(ev, ["product_id", "product"], "visit_id",
                view=F.col("event_type") == VIEW, add=F.col("event_type") == ADD,
                purchase_event=F.col("event_type") == PURCHASE, all_events=clicks)
    return pf.select("product_id", "product", "views", "cart_adds", "abandoned", "purchases").orderBy("product_id")


def category_funnel(product_sales: DataFrame, pages: DataFrame) -> DataFrame:
    cat = pages.where(F.col("product_id").isNotNull()).select("product_id", "product_category")
    return (product_sales.join(cat, "product_id", "left").groupBy("product_category")
            .agg(F.sum("views").cast("bigint").alias("views"),
                 F.sum("cart_adds").cast("bigint").alias("cart_adds"),
                 F.sum("purchases").cast("bigint").alias("purchases")))


def funnel_leaders(product_sales: DataFrame) -> DataFrame:
    return leaders(product_sales, [("Most views", "views"), ("Most cart adds", "cart_adds"),
                                   ("Most purchases", "purchases")],
                   label="top", keep=["product", "views", "cart_adds", "purchases"])


def abandon_rate(product_sales: DataFrame) -> DataFrame:
    return (product_sales.select("product_id", "product", "abandoned",
                                 ratio("abandoned", "cart_adds").alias("abandoned_pct"))
            .orderBy(F.col("abandoned_pct").desc_nulls_last(), "product_id"))


def view_to_purchase_rate(product_sales: DataFrame) -> DataFrame:
    return (product_sales.select("product_id", "product",
                                 ratio("purchases", "views").alias("view_to_purchase_pct"))
            .orderBy(F.col("view_to_purchase_pct").desc_nulls_last(), "product_id"))


def avg_conversion_rates(product_sales: DataFrame) -> DataFrame:
    # A mean of DOUBLE ratios depends on the summation order, which differs between
    # partitions and engines; it is reported to 10 decimal places.
    return product_sales.agg(F.round(F.avg(ratio("cart_adds", "views")), 10).alias("view_to_add_cvr"),
                             F.round(F.avg(ratio("purchases", "cart_adds")), 10).alias("add_to_purchase_cvr"))


# -- part 4: campaigns ---------------------------------------------------------
def cart_contents(clicks: DataFrame, pages: DataFrame) -> DataFrame:
    ev = _with_page(clicks.where(F.col("event_type") == ADD), pages)
    return ordered_concat(ev, "visit_id", {"cart_products": F.col("page_name")}, ["event_time", "event_id"],
                          [time_rank("event_time"), F.col("event_id")], ", ")


def campaign_visits(clicks: DataFrame, users: DataFrame, campaigns: DataFrame) -> DataFrame:
    """One row per (user, visit): start time, campaign running at the visit start and event
    counts by type. Events are aggregated to the visit once, users are joined to the
    per-visit rows, and the campaign calendar is matched by an interval lookup of the visit
    start. Precondition (true for cookie-based visits): a visit belongs to one cookie."""
    counts = {"view_product": VIEW, "add_cart": ADD, "purchases": PURCHASE,
              "impressions": IMPRESSION, "clicks": CLICK}
    visits = clicks.groupBy("visit_id", "cookie_id").agg(
        F.min("event_time").alias("visit_start_time"),
        *[F.sum(F.when(F.col("event_type") == c, 1).otherwise(0)).cast("bigint").alias(k)
          for k, c in counts.items()])
    with_user = visits.join(users.select("cookie_id", "user_id"), "cookie_id", "left")
    attributed = attribute_interval(with_user, "visit_start_time", campaigns, "campaign_name",
                                    "start_date", "end_date")
    return attributed.select("user_id", "visit_id", "campaign_name", "visit_start_time", *counts)


def campaign_performance(clicks: DataFrame, users: DataFrame, campaigns: DataFrame,
                         pages: DataFrame) -> DataFrame:
    """:func:`campaign_visits` and the ordered cart text of each visit."""
    visits = campaign_visits(clicks, users, campaigns)
    carts = cart_contents(clicks, pages).withColumnRenamed("visit_id", "_cart_visit")
    return visits.join(carts, F.col("visit_id").eqNullSafe(F.col("_cart_visit")), "left").drop("_cart_visit")


_STEPS = {"view_count": "view_product", "addcart_count": "add_cart", "purchase_count": "purchases"}
_MEANS = {"product_view_avg": "view_product", "cart_add_avg": "add_cart"}
_RATES = {"view_to_add_cvr": ("addcart_count", "view_count"),
          "add_to_purchase_cvr": ("purchase_count", "addcart_count"),
          "conv_rate": ("purchase_count", "view_count")}


def campaign_metrics(perf: DataFrame, by: list[str], apart: bool = False) -> DataFrame:
    return conversion_metrics(perf, by, "user_id", "visit_id", _STEPS, _MEANS, _RATES, apart)


# -- registry bindings ---------------------------------------------------------
def _fx(spark, sf_dir):
    return Tables(spark, sf_dir).fixtures


def _q(fn, *names):
    def run(spark, sf_dir):
        fx = _fx(spark, sf_dir)
        return fn(*[getattr(fx, n) for n in names])
    return run


def _pf(fn):
    def run(spark, sf_dir):
        fx = _fx(spark, sf_dir)
        return fn(product_funnel(fx.clicks, fx.page_hierarchy))
    return run


def _perf(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return campaign_performance(fx.clicks, fx.users, fx.campaign_identifier, fx.page_hierarchy)


def _by(*by, not_null=False):
    def run(spark, sf_dir):
        fx = _fx(spark, sf_dir)
        perf = campaign_visits(fx.clicks, fx.users, fx.campaign_identifier)
        if not_null:
            perf = perf.where(F.col(by[0]).isNotNull())
        return campaign_metrics(perf, list(by))
    return run


def _category_funnel(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return category_funnel(product_funnel(fx.clicks, fx.page_hierarchy), fx.page_hierarchy)


QUERIES = {
    "users_count": _q(users_count, "users"),
    "cookies_per_user": _q(cookies_per_user, "users"),
    "visits_by_month": _q(visits_by_month, "clicks"),
    "events_by_type": _q(events_by_type, "clicks", "event_identifier"),
    "event_type_share": _q(event_type_share, "clicks", "event_identifier"),
    "checkout_without_purchase": _q(checkout_without_purchase, "clicks", "page_hierarchy"),
    "top_pages_by_views": _q(top_pages_by_views, "clicks", "page_hierarchy"),
    "category_views_and_adds": _q(category_views_and_adds, "clicks", "page_hierarchy"),
    "top_products_by_purchase": _q(top_products_by_purchase, "clicks", "page_hierarchy"),
    "product_funnel": _q(product_funnel, "clicks", "page_hierarchy"),
    "category_funnel": _category_funnel,
    "funnel_leaders": _pf(funnel_leaders),
    "abandon_rate": _pf(abandon_rate),
    "view_to_purchase_rate": _pf(view_to_purchase_rate),
    "avg_conversion_rates": _pf(avg_conversion_rates),
    "cart_contents": _q(cart_contents, "clicks", "page_hierarchy"),
    "campaign_performance": _perf,
    "campaign_by_impressions": _by("impressions"),
    "campaign_by_impressions_clicks": _by("impressions", "clicks"),
    "campaign_by_name": _by("campaign_name", not_null=True),
}
