"""Sales case: high-level totals, transaction metrics, product analysis, monthly report.

Inputs: ``sales`` (txn_id, prod_id, qty, gross, discount, member, start_txn_time) where
``gross`` is the line revenue qty * price as DECIMAL, and ``products`` (product_id,
product_name, segment_name, category_name, ...). Money stays DECIMAL through every sum
and is converted to DOUBLE once at the end; the discount amount is
SUM(gross * discount) / 100.

The functions also take the two halves of ``sales``: the lines alone (no member, no time) and
``txns`` (txn_id, member, start_txn_time; one row per transaction). Lines are then combined
per transaction first (partial aggregation on the mappers), and one row per transaction meets
``txns``, so a transaction with very many lines never crosses a join unsplit. Results that read
neither member nor time need no ``txns`` at all, given that every line has its transaction.

Fact rows are always aggregated to the product (or transaction) before the product
dimension is joined, so the join sees one row per product instead of one per sale.
The product dimension grows with the data (it is the supplier table), so it gets no
broadcast hint: AQE broadcasts it only when its measured size is under the threshold
and otherwise keeps a shuffle join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bramble.functions.columns import money, month_filter, ratio, round_int
from bramble.operators.aggregates import avg_of_group, count_distinct
from bramble.operators.basket import top_basket_combinations
from bramble.operators.hierarchy import flatten_hierarchy
from bramble.operators.ranking import nearest_rank, pivot_percentiles, top_n, top_per_group
from bramble.operators.shares import share_of_parent, share_of_total
from bramble.sources.shared import stored

PERCENTILES = (25, 50, 75)


def _disc(sales: DataFrame):
    """Discount amount in 1/100 units (exact DECIMAL): gross * discount percent, or its sum
    where the lines are combined already (:func:`report_facts`)."""
    return F.col("disc_c") if "disc_c" in sales.columns else F.col("gross") * F.col("discount")


def _disc_total(c: str = "disc_c"):
    return F.sum(c).cast("double") / F.lit(100.0)


# -- part 1: high level -----------------------------------------------------
def totals(sales: DataFrame) -> DataFrame:
    return sales.agg(F.sum("qty").cast("bigint").alias("total_quantity"),
                     money(F.sum("gross")).alias("total_rev_before_discount"),
                     (F.sum(_disc(sales)).cast("double") / F.lit(100.0)).alias("total_discount"))


# -- part 2: transactions ---------------------------------------------------
def per_transaction(sales: DataFrame, aggs: Sequence, txns: DataFrame | None = None) -> DataFrame:
    """One row per transaction: ``aggs``, and member where it is known. With ``txns`` only its
    transactions stay."""
    if txns is not None:
        return sales.groupBy("txn_id").agg(*aggs).join(txns, "txn_id")
    member = [F.max("member").alias("member")] if "member" in sales.columns else []
    return sales.groupBy("txn_id").agg(*member, *aggs)


def txn_unique(sales: DataFrame) -> DataFrame:
    return count_distinct(sales, "txn_id", alias="total_unique_transac")


def txn_avg_unique_products(sales: DataFrame) -> DataFrame:
    per_txn = sales.select("txn_id", "prod_id").where(F.col("prod_id").isNotNull()).distinct()
    return avg_of_group(per_txn, "txn_id", F.count(F.lit(1)), alias="avg_unique_prod")


def txn_revenue(sales: DataFrame, txns: DataFrame | None = None) -> DataFrame:
    return per_transaction(sales, [F.sum("gross").alias("rev")], txns)


def txn_revenue_percentiles(sales: DataFrame, percentiles: Sequence[int] = PERCENTILES,
                            txns: DataFrame | None = None) -> DataFrame:
    long = nearest_rank(txn_revenue(sales, txns), "rev", percentiles)
    wide = pivot_percentiles(long, percentiles, "revenue_at_percentile_")
    return wide.select(*[money(f"revenue_at_percentile_{p}").alias(f"revenue_at_percentile_{p}")
                         for p in percentiles])


def txn_avg_discount(sales: DataFrame) -> DataFrame:
    return avg_of_group(sales, "txn_id", F.sum(_disc(sales)), alias="discount_per_transac", scale=100)


def txn_member_split(sales: DataFrame, txns: DataFrame | None = None) -> DataFrame:
    per_txn = per_transaction(sales.where(F.col("txn_id").isNotNull()), [F.lit(1).alias("_one")], txns)
    c = per_txn.agg(F.count(F.lit(1)).alias("total"),
                    F.coalesce(F.count_if(F.col("member") == "t"), F.lit(0)).alias("member_transac"),
                    F.coalesce(F.count_if(F.col("member") == "f"), F.lit(0)).alias("nonmember_transac"))
    return c.select("total", "member_transac",
                    ratio("member_transac", "total").alias("member_transac_pct"),
                    "nonmember_transac",
                    ratio("nonmember_transac", "total").alias("nonmember_transac_pct"))


def txn_member_avg_revenue(sales: DataFrame, txns: DataFrame | None = None) -> DataFrame:
    per_txn = txn_revenue(sales, txns)
    mean = F.when(F.count("rev") > 0, F.sum("rev").cast("double") / F.count("rev").cast("double"))
    return per_txn.groupBy("member").agg(mean.alias("avg_rev"))


# -- part 3: products -------------------------------------------------------
def _by_product(sales: DataFrame, products: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """Sales aggregated to prod_id, then the product attributes joined (left)."""
    agg = sales.groupBy("prod_id").agg(F.sum("qty").alias("qty"), F.sum("gross").alias("rev"),
                                       F.sum(_disc(sales)).alias("disc_c"))
    dim = products.select(F.col("product_id"), *attrs)
    return agg.join(dim, agg["prod_id"] == dim["product_id"], "left").drop("product_id")


def top_products_by_revenue(sales: DataFrame, products: DataFrame, n: int = 3) -> DataFrame:
    per = (_by_product(sales, products, ["product_name"])
           .groupBy("product_name").agg(F.sum("rev").alias("rev")))
    top = top_n(per, [F.col("rev").desc(), F.col("product_name").asc_nulls_first()], n)
    return top.select("product_name", money("rev").alias("rev"))


def level_totals(sales: DataFrame, products: DataFrame, level: str) -> DataFrame:
    per = _by_product(sales, products, [level])
    return (per.groupBy(level).agg(F.sum("qty").cast("bigint").alias("qty"),
                                   money(F.sum("rev")).alias("rev"),
                                   _disc_total().alias("discount")))


def level_top_seller(sales: DataFrame, products: DataFrame, level: str) -> DataFrame:
    per = (_by_product(sales, products, [level, "product_name"])
           .groupBy(level, "product_name").agg(F.sum("qty").alias("qty")))
    return top_per_group(per, level, "product_name", "qty", item_alias="top_selling",
                         measure_alias="max_qty")


def share_in_parent(sales: DataFrame, products: DataFrame, parent: str, child: str) -> DataFrame:
    per = (_by_product(sales, products, [parent, child])
           .groupBy(parent, child).agg(F.sum("rev").alias("rev")))
    return (share_of_parent(per, parent, "rev", alias="rev_pct")
            .select(parent, child, "rev_pct").orderBy(F.col(parent), F.col("rev_pct").desc()))


def product_share_in_segment(sales: DataFrame, products: DataFrame) -> DataFrame:
    return share_in_parent(sales, products, "segment_name", "product_name")


def segment_share_in_category(sales: DataFrame, products: DataFrame) -> DataFrame:
    return share_in_parent(sales, products, "category_name", "segment_name")


def category_share_of_total(sales: DataFrame, products: DataFrame) -> DataFrame:
    per = (_by_product(sales, products, ["category_name"])
           .groupBy("category_name").agg(F.sum("rev").alias("rev")))
    return share_of_total(per, "rev", alias="rev_pct").select("category_name", "rev_pct")


def product_penetration(sales: DataFrame, products: DataFrame, txns: DataFrame | None = None) -> DataFrame:
    pairs = sales.where(F.col("txn_id").isNotNull()).select("txn_id", "prod_id").distinct()
    if txns is not None:
        pairs = pairs.join(txns.select("txn_id"), "txn_id", "left_semi")
    per = pairs.groupBy("prod_id").agg(F.count(F.lit(1)).alias("transac"))
    total = count_distinct(pairs, "txn_id", alias="_all")
    dim = products.select("product_id", "product_name")
    out = (per.join(dim, per["prod_id"] == dim["product_id"], "left")
           .crossJoin(F.broadcast(total))
           .select("prod_id", "product_name", "transac",
                   ratio("transac", "_all").alias("penetration")))
    return out.orderBy(F.col("penetration").desc(), "prod_id")


def basket_top_triples(sales: DataFrame, products: DataFrame, n: int = 10, txns: DataFrame | None = None) -> DataFrame:
    pairs = sales.select("txn_id", "prod_id").distinct()
    if txns is not None:
        pairs = pairs.join(txns.select("txn_id"), "txn_id", "left_semi")
    top = top_basket_combinations(pairs, "txn_id", "prod_id", n, k=3)
    names = products.select("product_id", "product_name")
    out = top
    for j in (1, 2, 3):
        nj = names.select(F.col("product_id").alias(f"_id{j}"), F.col("product_name").alias(f"p{j}"))
        out = out.join(nj, out[f"item_{j}"] == nj[f"_id{j}"], "left").drop(f"_id{j}")
    return (out.orderBy(F.col("baskets").desc(), "item_1", "item_2", "item_3")
            .select("p1", "p2", "p3", F.col("baskets").alias("time")))


def hierarchy_flatten(hierarchy: DataFrame, prices: DataFrame) -> DataFrame:
    flat = flatten_hierarchy(hierarchy, prices)
    return flat.withColumn("price", money("price"))


# -- monthly report -----------------------------------------------------------
def month_sales(sales: DataFrame, month: int, year: int | None = None) -> DataFrame:
    """Rows of a month, of joined sales or of ``txns``."""
    return sales.where(month_filter("start_txn_time", month, year))


def report_totals(ms: DataFrame, txns: DataFrame | None = None, rounded: bool = True) -> DataFrame:
    """The scalars of the report but for the percentiles, in one row: one aggregate per
    transaction, one global aggregate."""
    per_txn = per_transaction(ms, [F.count_distinct("prod_id").alias("uniq"), F.sum("qty").alias("qty"),
                                   F.sum("gross").alias("rev"), F.sum(_disc(ms)).alias("disc_c")], txns)
    n = F.count(F.lit(1))
    # the report routines return INT (rounded half up); rounded=False keeps exact values
    as_int = round_int if rounded else (lambda c: c.cast("double"))
    return per_txn.agg(
        F.sum("qty").cast("bigint").alias("total_qty"),
        as_int(F.sum("rev")).alias("rev_before_discount"),
        as_int(F.sum("disc_c") / F.lit(100)).alias("total_discount"),
        n.alias("total_unique_transac"),
        as_int(F.when(n > 0, F.sum("uniq").cast("double") / n)).alias("avg_unique_product"),
        as_int(F.when(n > 0, F.sum("disc_c").cast("double") / 100.0 / n)).alias("avg_discount"))


def report_scalars(ms: DataFrame, percentiles: Sequence[int] = PERCENTILES, rounded: bool = True,
                   txns: DataFrame | None = None) -> DataFrame:
    """All nine scalar results of the monthly report in one row."""
    pct = txn_revenue_percentiles(ms, percentiles, txns)
    out = report_totals(ms, txns, rounded).crossJoin(F.broadcast(pct))  # one row each
    return out.select("total_qty", "rev_before_discount", "total_discount", "total_unique_transac",
                      "avg_unique_product", *[f"revenue_at_percentile_{p}" for p in percentiles],
                      "avg_discount")


def month_lines(lines: DataFrame, txns: DataFrame, month: int, year: int | None = None) -> DataFrame:
    """Lines of the month's transactions, with member. The join stands directly on the scan of
    the lines: a month that fits is broadcast, so other months' lines go no further than their
    scan; above that, Spark puts a Bloom filter of the month's transactions below the lines'
    exchange (spark.sql.optimizer.runtime.bloomFilter, thresholds in bramble.session)."""
    return lines.join(month_sales(txns, month, year).select("txn_id", "member"), "txn_id")


def monthly_report(sales: DataFrame, products: DataFrame, month: int, year: int | None = None,
                   top: int = 3, rounded: bool = True, txns: DataFrame | None = None,
                   percentiles: Sequence[int] = PERCENTILES) -> dict[str, DataFrame]:
    """All 21 results of the monthly report as lazy DataFrames, from joined sales or from
    lines and ``txns``."""
    if txns is None:
        ms, mt = month_sales(sales, month, year), None
        lines = ms
    else:
        ms, mt = month_lines(sales, txns, month, year), None
        lines = ms
    return report_results(ms, lines, products, top, rounded, mt, percentiles)


def report_results(ms: DataFrame, lines: DataFrame, products: DataFrame, top: int, rounded: bool,
                   mt: DataFrame | None, percentiles: Sequence[int]) -> dict[str, DataFrame]:
    """The results of the report from the month's sales ``ms`` (and, for results of products
    alone, its ``lines``)."""
    scal = report_scalars(ms, percentiles, rounded, mt)
    totals_only = report_totals(ms, mt, rounded)
    out = {c: (totals_only if c in totals_only.columns else scal).select(c) for c in scal.columns}
    out.update({
        "member_split": txn_member_split(ms, mt),
        "member_avg_revenue": txn_member_avg_revenue(ms, mt),
        "top_products": top_products_by_revenue(lines, products, top),
        "segment_totals": level_totals(lines, products, "segment_name"),
        "segment_top_seller": level_top_seller(lines, products, "segment_name"),
        "category_totals": level_totals(lines, products, "category_name"),
        "category_top_seller": level_top_seller(lines, products, "category_name"),
        "product_share": product_share_in_segment(lines, products),
        "segment_share": segment_share_in_category(lines, products),
        "category_share": category_share_of_total(lines, products),
        "penetration": product_penetration(ms, products, mt),
        "top_triples": basket_top_triples(ms, products, 1, mt),
        "scalars": scal,
    })
    return out


# -- the whole report from one written table -----------------------------------
# which columns of a result name its rows; the others are its measures
REPORT_LABELS: dict[str, tuple[str, ...]] = {
    "scalars": (),
    "member_split": (),
    "member_avg_revenue": ("member",),
    "top_products": ("product_name",),
    "segment_totals": ("segment_name",),
    "segment_top_seller": ("segment_name", "top_selling"),
    "category_totals": ("category_name",),
    "category_top_seller": ("category_name", "top_selling"),
    "product_share": ("segment_name", "product_name"),
    "segment_share": ("category_name", "segment_name"),
    "category_share": ("category_name",),
    "penetration": ("prod_id", "product_name"),
    "top_triples": ("p1", "p2", "p3"),
}


def report_facts(lines: DataFrame, txns: DataFrame, month: int, year: int | None = None) -> DataFrame:
    """One row per (transaction, product) of the month, with sums of quantity, revenue and
    discount and the member flag: all that any result of the report reads. The lines combine on
    the mappers; a transaction with very many lines is spread by its products."""
    ms = month_lines(lines, txns, month, year)
    # the member flag hangs on the transaction; as a key it keeps the aggregate a hash aggregate
    return ms.groupBy("txn_id", "prod_id", "member").agg(F.sum("qty").alias("qty"), F.sum("gross").alias("gross"),
                                                         F.sum(_disc(ms)).alias("disc_c"))


def stored_report(lines: DataFrame, txns: DataFrame, products: DataFrame, month: int, year: int | None = None,
                  top: int = 3, rounded: bool = True, percentiles: Sequence[int] = PERCENTILES) -> dict[str, DataFrame]:
    """:func:`monthly_report` with the month's facts written once to the shared folder: the
    lines are read once, for all 21 results, which then read the written rows. Writing is a
    Spark action at the call."""
    facts = stored(report_facts(lines, txns, month, year), "report-facts")
    return report_results(facts, facts, products, top, rounded, None, percentiles)


def report_rows(results: dict[str, DataFrame]) -> DataFrame:
    """All results of a report as one table: result, label_1 to label_3 (what names the row),
    measure, value (DOUBLE)."""
    out = None
    for name, labels in REPORT_LABELS.items():
        df = results[name]
        named = [F.col(c).cast("string") for c in labels] + [F.lit(None).cast("string")] * (3 - len(labels))
        measures = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value"))
                             for c in df.columns if c not in labels])
        rows = (df.select(F.lit(name).alias("result"), *[c.alias(f"label_{i}") for i, c in enumerate(named, 1)],
                          F.explode(measures).alias("_m"))
                .select("result", "label_1", "label_2", "label_3", "_m.measure", "_m.value"))
        out = rows if out is None else out.unionAll(rows)
    return out
