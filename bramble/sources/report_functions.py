"""The monthly report as SQL functions with a month argument: nine scalar functions and
table functions for the row results, over the mapped tables.

    register_report_functions(spark, sf_dir)
    spark.sql("SELECT report_total_qty(3)")
    spark.sql("SELECT * FROM report_top_products(3, 3)")

They are temporary SQL functions: Spark inlines their text into the calling query, so a call
is planned like the query itself (the month's transactions meet the lines on their scan, lines
combine before the product table is joined). Results equal the ``report_*`` keys. The most
frequent triple needs the pruned growth of ``operators.basket`` and stays a DataFrame function.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

PREFIX = "report_src_"  # the views that the functions read

_LINES = f"""(SELECT l.txn_id, l.prod_id, l.qty, l.gross, l.gross * l.discount AS disc_c, t.member
  FROM {PREFIX}lines l JOIN (SELECT txn_id, member FROM {PREFIX}transactions WHERE month(start_txn_time) = in_month) t
  ON l.txn_id = t.txn_id)"""
_PER_TXN = f"(SELECT txn_id, member, sum(gross) AS rev, sum(disc_c) AS disc_c, count(DISTINCT prod_id) AS uniq FROM {_LINES} GROUP BY txn_id, member)"
_PER_PRODUCT = f"(SELECT prod_id, sum(qty) AS qty, sum(gross) AS rev, sum(disc_c) AS disc_c FROM {_LINES} GROUP BY prod_id)"
_PRODUCTS = f"(SELECT p.qty, p.rev, p.disc_c, d.* FROM {_PER_PRODUCT} p LEFT JOIN {PREFIX}products d ON p.prod_id = d.product_id)"

_SCALARS: dict[str, str] = {
    "report_total_qty": f"SELECT CAST(sum(qty) AS BIGINT) FROM {_LINES}",
    "report_gross_revenue": f"SELECT CAST(round(sum(gross), 0) AS BIGINT) FROM {_LINES}",
    "report_total_discount": f"SELECT CAST(round(sum(disc_c) / 100, 0) AS BIGINT) FROM {_LINES}",
    "report_unique_txn": f"SELECT count(*) FROM {_PER_TXN}",
    "report_avg_unique_products": f"SELECT CAST(round(avg(uniq), 0) AS BIGINT) FROM {_PER_TXN}",
    "report_avg_discount": f"SELECT CAST(round(CAST(sum(disc_c) AS DOUBLE) / 100.0 / nullif(count(*), 0), 0) AS BIGINT) FROM {_PER_TXN}",
}


def _percentile() -> str:
    """Nearest rank: sketched quantiles cut the transactions into slices of a thousandth, the
    slice that holds the rank is found by counts, and only its rows are numbered. A slice may
    hold more than a thousandth where values tie, so equal revenues count as one row."""
    cuts = ", ".join(f"{k / 1000}D" for k in range(1, 1000))
    return f"""
WITH per_txn AS (SELECT rev FROM {_PER_TXN}),
cuts AS (SELECT array_distinct(approx_percentile(rev, array({cuts}), 10000)) AS q FROM per_txn),
sliced AS (SELECT rev, slice, count(*) AS n FROM (SELECT rev, size(filter(q, c -> c < rev)) AS slice FROM per_txn CROSS JOIN cuts)
           GROUP BY rev, slice),
sizes AS (SELECT slice, sum(n) AS n FROM sliced GROUP BY slice),
upto AS (SELECT slice, n, sum(n) OVER (ORDER BY slice) AS upto, sum(n) OVER () AS total FROM sizes),
wanted AS (SELECT slice, upto - n AS below, floor(total * percent / 100.0 + 0.5) AS k FROM upto),
held AS (SELECT slice, below, k FROM (SELECT w.*, u.upto FROM wanted w JOIN upto u USING (slice)) WHERE k > below AND k <= upto),
ranked AS (SELECT s.rev, h.k, h.below + sum(s.n) OVER (PARTITION BY s.slice ORDER BY s.rev) AS reach
           FROM sliced s JOIN held h ON s.slice = h.slice)
SELECT CAST(min(rev) AS DOUBLE) FROM ranked WHERE reach >= k"""


def _level_totals(level: str) -> str:
    return (f"SELECT {level}, CAST(sum(qty) AS BIGINT) AS qty, CAST(sum(rev) AS DOUBLE) AS rev, "
            f"CAST(sum(disc_c) AS DOUBLE) / 100.0D AS discount FROM {_PRODUCTS} GROUP BY {level}")


def _top_seller(level: str) -> str:
    """The largest quantity, then the smallest name: one aggregate, no window over the level."""
    return f"""
SELECT {level}, best.name AS top_selling, CAST(-best.q AS BIGINT) AS max_qty FROM (
  SELECT {level}, min(struct(-q AS q, product_name AS name)) AS best FROM (
    SELECT {level}, product_name, sum(qty) AS q FROM {_PRODUCTS} GROUP BY {level}, product_name) GROUP BY {level})"""


def _share(parent: str, child: str) -> str:
    per = f"SELECT {parent}, {child}, sum(rev) AS v FROM {_PRODUCTS} GROUP BY {parent}, {child}"
    return f"""
WITH per AS ({per}), whole AS (SELECT {parent} AS p, sum(v) AS w FROM per GROUP BY {parent})
SELECT {parent}, {child}, CAST(v AS DOUBLE) / nullif(CAST(w AS DOUBLE), 0) AS rev_pct
FROM per JOIN whole ON {parent} <=> p"""


_TABLES: dict[str, tuple[str, str, str]] = {  # name: (arguments, columns, text)
    "report_member_split": (
        "", "total BIGINT, member_transac BIGINT, member_transac_pct DOUBLE, nonmember_transac BIGINT, nonmember_transac_pct DOUBLE",
        f"""SELECT n, t, CAST(t AS DOUBLE) / nullif(CAST(n AS DOUBLE), 0), f, CAST(f AS DOUBLE) / nullif(CAST(n AS DOUBLE), 0)
FROM (SELECT count(*) AS n, count_if(member = 't') AS t, count_if(member = 'f') AS f FROM {_PER_TXN})"""),
    "report_member_avg_revenue": (
        "", "member STRING, avg_rev DOUBLE",
        f"SELECT member, CAST(sum(rev) AS DOUBLE) / nullif(CAST(count(rev) AS DOUBLE), 0) FROM {_PER_TXN} GROUP BY member"),
    "report_top_products": (
        ", n INT DEFAULT 3", "product_name STRING, rev DOUBLE",
        f"""SELECT product_name, CAST(v AS DOUBLE) FROM (
  SELECT product_name, v, row_number() OVER (ORDER BY v DESC, product_name ASC NULLS FIRST) AS pos FROM (
    SELECT product_name, sum(rev) AS v FROM {_PRODUCTS} GROUP BY product_name)) WHERE pos <= n"""),
    "report_segment_totals": ("", "segment_name STRING, qty BIGINT, rev DOUBLE, discount DOUBLE", _level_totals("segment_name")),
    "report_category_totals": ("", "category_name STRING, qty BIGINT, rev DOUBLE, discount DOUBLE", _level_totals("category_name")),
    "report_segment_top_seller": ("", "segment_name STRING, top_selling STRING, max_qty BIGINT", _top_seller("segment_name")),
    "report_category_top_seller": ("", "category_name STRING, top_selling STRING, max_qty BIGINT", _top_seller("category_name")),
    "report_product_share": ("", "segment_name STRING, product_name STRING, rev_pct DOUBLE", _share("segment_name", "product_name")),
    "report_segment_share": ("", "category_name STRING, segment_name STRING, rev_pct DOUBLE", _share("category_name", "segment_name")),
    "report_category_share": (
        "", "category_name STRING, rev_pct DOUBLE",
        f"""WITH per AS (SELECT category_name, sum(rev) AS v FROM {_PRODUCTS} GROUP BY category_name), whole AS (SELECT sum(v) AS w FROM per)
SELECT category_name, CAST(v AS DOUBLE) / nullif(CAST(w AS DOUBLE), 0) FROM per CROSS JOIN whole"""),
    "report_penetration": (
        "", "prod_id BIGINT, product_name STRING, transac BIGINT, penetration DOUBLE",
        f"""WITH pairs AS (SELECT DISTINCT txn_id, prod_id FROM {_LINES}),
per AS (SELECT prod_id, count(*) AS c FROM pairs GROUP BY prod_id), whole AS (SELECT count(*) AS w FROM {_PER_TXN})
SELECT prod_id, d.product_name, c, CAST(c AS DOUBLE) / nullif(CAST(w AS DOUBLE), 0)
FROM per LEFT JOIN {PREFIX}products d ON prod_id = d.product_id CROSS JOIN whole"""),
}


def register_report_functions(spark: SparkSession, sf_dir: str) -> list[str]:
    """Creates the functions in the session, over the tables at ``sf_dir``; returns their names."""
    from bramble.sources.tables import Tables
    fx = Tables(spark, sf_dir).fixtures
    views = {"lines": fx.sales_lines, "transactions": fx.transactions,
             "products": fx.product_details.select("product_id", "product_name", "segment_name", "category_name")}
    for name, df in views.items():
        df.createOrReplaceTempView(f"{PREFIX}{name}")
    for name, text in _SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(in_month INT) RETURNS BIGINT RETURN {text}")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION report_revenue_percentile(in_month INT, percent INT) RETURNS DOUBLE "
              f"RETURN {_percentile()}")
    for name, (arguments, columns, text) in _TABLES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(in_month INT{arguments}) RETURNS TABLE ({columns}) RETURN {text}")
    return [*_SCALARS, "report_revenue_percentile", *_TABLES]
