"""Independent SQL (DuckDB) for the sales keys on the mapped views: plain aggregates and
brute-force forms (whole-set ROW_NUMBER for percentiles, full triple enumeration). Tie-breaks
the case study leaves open are stated the same way as in the Spark operators."""

from __future__ import annotations

from bramble.sources.fixtures import REPORT_MONTH

P = (25, 50, 75)


def _pct_sql(src: str) -> str:
    """Literal nearest rank: ROW_NUMBER over the whole ordered set."""
    cols = ",\n".join(
        f"(SELECT CAST(rev AS DOUBLE) FROM r, n WHERE num = (n.n * {p} + 50) // 100) AS revenue_at_percentile_{p}"
        for p in P)
    return f"""
WITH t AS (SELECT txn_id, SUM(gross) AS rev FROM {src} GROUP BY txn_id),
r AS (SELECT rev, ROW_NUMBER() OVER (ORDER BY rev) AS num FROM t),
n AS (SELECT COUNT(*) AS n FROM t)
SELECT {cols}"""


def _top_products(src: str, n: int) -> str:
    return f"""
SELECT d.product_name, CAST(SUM(x.gross) AS DOUBLE) AS rev
FROM {src} x LEFT JOIN product_details d ON d.product_id = x.prod_id
GROUP BY d.product_name
ORDER BY SUM(x.gross) DESC, d.product_name NULLS FIRST LIMIT {n}"""


def _level_totals(src: str, level: str) -> str:
    return f"""
SELECT d.{level}, CAST(SUM(x.qty) AS BIGINT) AS qty, CAST(SUM(x.gross) AS DOUBLE) AS rev,
       CAST(SUM(x.gross * x.discount) AS DOUBLE) / 100.0 AS discount
FROM {src} x LEFT JOIN product_details d ON d.product_id = x.prod_id
GROUP BY d.{level}"""


def _top_seller(src: str, level: str) -> str:
    return f"""
WITH q AS (
  SELECT d.{level} AS grp, d.product_name AS item, SUM(x.qty) AS q
  FROM {src} x LEFT JOIN product_details d ON d.product_id = x.prod_id
  GROUP BY 1, 2),
best AS (
  SELECT grp, item, q, ROW_NUMBER() OVER (PARTITION BY grp ORDER BY q DESC, item NULLS FIRST) AS pos FROM q)
SELECT grp AS {level}, item AS top_selling, CAST(q AS BIGINT) AS max_qty FROM best WHERE pos = 1"""


def _share(src: str, parent: str, child: str) -> str:
    # child totals over all rows of the child, parent totals over all rows of the parent
    return f"""
WITH r AS (
  SELECT d.{parent} AS p, d.{child} AS c, x.gross
  FROM {src} x LEFT JOIN product_details d ON d.product_id = x.prod_id),
by_child AS (SELECT c, SUM(gross) AS v FROM r GROUP BY c),
by_parent AS (SELECT p, SUM(gross) AS v FROM r GROUP BY p),
pairs AS (SELECT DISTINCT p, c FROM r)
SELECT pairs.p AS {parent}, pairs.c AS {child},
       CAST(bc.v AS DOUBLE) / NULLIF(CAST(bp.v AS DOUBLE), 0) AS rev_pct
FROM pairs
JOIN by_child bc ON bc.c IS NOT DISTINCT FROM pairs.c
JOIN by_parent bp ON bp.p IS NOT DISTINCT FROM pairs.p"""


def _category_share(src: str) -> str:
    return f"""
WITH g AS (SELECT SUM(gross) AS v FROM {src})
SELECT d.category_name, CAST(SUM(x.gross) AS DOUBLE) / NULLIF(CAST(MAX(g.v) AS DOUBLE), 0) AS rev_pct
FROM {src} x LEFT JOIN product_details d ON d.product_id = x.prod_id CROSS JOIN g
GROUP BY d.category_name"""


def _penetration(src: str) -> str:
    return f"""
WITH n AS (SELECT COUNT(DISTINCT txn_id) AS all_txn FROM {src}),
per AS (SELECT prod_id, COUNT(DISTINCT txn_id) AS transac FROM {src} GROUP BY prod_id)
SELECT per.prod_id, d.product_name, per.transac,
       CAST(per.transac AS DOUBLE) / NULLIF(CAST(n.all_txn AS DOUBLE), 0) AS penetration
FROM per LEFT JOIN product_details d ON d.product_id = per.prod_id CROSS JOIN n"""


def _triples(src: str, n: int) -> str:
    # brute force: every ascending product triple inside each transaction
    return f"""
WITH bi AS (SELECT DISTINCT txn_id, prod_id FROM {src}),
sets AS (
  SELECT a.prod_id AS i1, b.prod_id AS i2, c.prod_id AS i3, COUNT(*) AS k
  FROM bi a JOIN bi b ON b.txn_id = a.txn_id AND b.prod_id > a.prod_id
            JOIN bi c ON c.txn_id = a.txn_id AND c.prod_id > b.prod_id
  GROUP BY 1, 2, 3),
top AS (SELECT * FROM sets ORDER BY k DESC, i1, i2, i3 LIMIT {n})
SELECT n1.product_name AS p1, n2.product_name AS p2, n3.product_name AS p3, top.k AS time
FROM top
LEFT JOIN product_details n1 ON n1.product_id = top.i1
LEFT JOIN product_details n2 ON n2.product_id = top.i2
LEFT JOIN product_details n3 ON n3.product_id = top.i3"""


def _member_split(src: str) -> str:
    return f"""
WITH c AS (
  SELECT COUNT(DISTINCT txn_id) AS total,
         COUNT(DISTINCT txn_id) FILTER (WHERE member = 't') AS m,
         COUNT(DISTINCT txn_id) FILTER (WHERE member = 'f') AS nm
  FROM {src})
SELECT total, m AS member_transac, m / NULLIF(total, 0) AS member_transac_pct,
       nm AS nonmember_transac, nm / NULLIF(total, 0) AS nonmember_transac_pct
FROM c"""


def _member_avg(src: str) -> str:
    return f"""
SELECT member, CAST(SUM(rev) AS DOUBLE) / COUNT(rev) AS avg_rev
FROM (SELECT member, txn_id, SUM(gross) AS rev FROM {src} GROUP BY member, txn_id) g
GROUP BY member"""


MS = "ms"  # month-filtered sales
MONTH_CTE = f"ms AS (SELECT * FROM sales WHERE month(start_txn_time) = {REPORT_MONTH})"


def _month(body: str) -> str:
    head = body.lstrip()
    if head[:5].upper() == "WITH ":
        return f"WITH {MONTH_CTE},\n" + head[5:]
    return f"WITH {MONTH_CTE}\n" + body


def _report_scalars() -> str:
    pct = ",\n".join(
        f"(SELECT CAST(rev AS DOUBLE) FROM r, n WHERE num = (n.n * {p} + 50) // 100) AS revenue_at_percentile_{p}"
        for p in P)
    return _month(f"""
WITH t AS (SELECT txn_id, COUNT(DISTINCT prod_id) AS uniq, SUM(gross) AS rev,
                  SUM(gross * discount) AS disc_c FROM ms GROUP BY txn_id),
r AS (SELECT rev, ROW_NUMBER() OVER (ORDER BY rev) AS num FROM t),
n AS (SELECT COUNT(*) AS n FROM t)
SELECT (SELECT CAST(SUM(qty) AS BIGINT) FROM ms) AS total_qty,
       (SELECT CAST(ROUND(SUM(gross)) AS BIGINT) FROM ms) AS rev_before_discount,
       (SELECT CAST(ROUND(CAST(SUM(gross * discount) AS DOUBLE) / 100.0) AS BIGINT) FROM ms) AS total_discount,
       (SELECT COUNT(*) FROM t) AS total_unique_transac,
       (SELECT CAST(ROUND(AVG(uniq)) AS BIGINT) FROM t) AS avg_unique_product,
       {pct},
       (SELECT CAST(ROUND(CAST(SUM(disc_c) AS DOUBLE) / 100.0 / COUNT(*)) AS BIGINT) FROM t) AS avg_discount""")


_SCALARS = _report_scalars()


def _scalar(col: str) -> str:
    return f"SELECT {col} FROM ({_SCALARS}) x"


SALES_SQL: dict[str, str] = {
    "sales_total_qty": "SELECT CAST(SUM(qty) AS BIGINT) AS total_quantity FROM sales",
    "sales_gross_revenue": "SELECT CAST(SUM(gross) AS DOUBLE) AS total_rev_before_discount FROM sales",
    "sales_total_discount": "SELECT CAST(SUM(gross * discount) AS DOUBLE) / 100.0 AS total_discount FROM sales",
    "txn_unique": "SELECT COUNT(DISTINCT txn_id) AS total_unique_transac FROM sales",
    "txn_avg_unique_products": """
SELECT CAST(SUM(unique_prod) AS DOUBLE) / COUNT(unique_prod) AS avg_unique_prod
FROM (SELECT txn_id, COUNT(DISTINCT prod_id) AS unique_prod FROM sales GROUP BY txn_id) c""",
    "txn_revenue_percentiles": _pct_sql("sales"),
    "txn_avg_discount": """
SELECT CAST(SUM(d) AS DOUBLE) / 100.0 / COUNT(d) AS discount_per_transac
FROM (SELECT txn_id, SUM(gross * discount) AS d FROM sales GROUP BY txn_id) x""",
    "txn_member_split": _member_split("sales"),
    "txn_member_avg_revenue": _member_avg("sales"),
    "top_products_by_revenue": _top_products("sales", 3),
    "segment_totals": _level_totals("sales", "segment_name"),
    "segment_top_seller": _top_seller("sales", "segment_name"),
    "category_totals": _level_totals("sales", "category_name"),
    "category_top_seller": _top_seller("sales", "category_name"),
    "product_share_in_segment": _share("sales", "segment_name", "product_name"),
    "segment_share_in_category": _share("sales", "category_name", "segment_name"),
    "category_share_of_total": _category_share("sales"),
    "product_penetration": _penetration("sales"),
    "basket_top_triples": _triples("sales", 10),
    "hierarchy_flatten": """
WITH wide AS (
  SELECT sty.level_text || ' ' || seg.level_text || ' ' || cat.level_text AS product_name,
         cat.id AS category_id, seg.id AS segment_id, sty.id AS style_id,
         cat.level_text AS category_name, seg.level_text AS segment_name, sty.level_text AS style_name
  FROM product_hierarchy cat
  JOIN product_hierarchy seg ON seg.parent_id = cat.id
  JOIN product_hierarchy sty ON sty.parent_id = seg.id)
SELECT pr.product_id, CAST(pr.price AS DOUBLE) AS price, w.product_name, w.category_id, w.segment_id,
       w.style_id, w.category_name, w.segment_name, w.style_name
FROM wide w LEFT JOIN product_prices pr ON pr.id = w.style_id""",
    "hierarchy_paths": """
WITH RECURSIVE walk AS (
  SELECT id, id AS root_id, CAST(0 AS BIGINT) AS depth, level_text AS path FROM product_hierarchy WHERE parent_id IS NULL
  UNION ALL
  SELECT h.id, w.root_id, w.depth + 1, w.path || ' > ' || h.level_text
  FROM walk w JOIN product_hierarchy h ON h.parent_id = w.id)
SELECT id, root_id, depth, path FROM walk""",
    # monthly report (month only, all years, as the routines filter)
    "report_total_qty": _scalar("total_qty"),
    "report_gross_revenue": _scalar("rev_before_discount"),
    "report_total_discount": _scalar("total_discount"),
    "report_unique_txn": _scalar("total_unique_transac"),
    "report_avg_unique_products": _scalar("avg_unique_product"),
    "report_revenue_percentile": _scalar(", ".join(f"revenue_at_percentile_{p}" for p in P)),
    "report_avg_discount": _scalar("avg_discount"),
    "report_member_split": _month(_member_split(MS)),
    "report_member_avg_revenue": _month(_member_avg(MS)),
    "report_top_products": _month(_top_products(MS, 3)),
    "report_segment_totals": _month(_level_totals(MS, "segment_name")),
    "report_segment_top_seller": _month(_top_seller(MS, "segment_name")),
    "report_category_totals": _month(_level_totals(MS, "category_name")),
    "report_category_top_seller": _month(_top_seller(MS, "category_name")),
    "report_product_share": _month(_share(MS, "segment_name", "product_name")),
    "report_segment_share": _month(_share(MS, "category_name", "segment_name")),
    "report_category_share": _month(_category_share(MS)),
    "report_penetration": _month(_penetration(MS)),
    "report_top_triples": _month(_triples(MS, 1)),
    "monthly_report": _SCALARS,
}


# all results of the report in one table: result -> (key, columns that name a row, measures)
_RESULTS = {
    "scalars": ("monthly_report", "", "total_qty rev_before_discount total_discount total_unique_transac avg_unique_product "
                "revenue_at_percentile_25 revenue_at_percentile_50 revenue_at_percentile_75 avg_discount"),
    "member_split": ("report_member_split", "", "total member_transac member_transac_pct nonmember_transac nonmember_transac_pct"),
    "member_avg_revenue": ("report_member_avg_revenue", "member", "avg_rev"),
    "top_products": ("report_top_products", "product_name", "rev"),
    "segment_totals": ("report_segment_totals", "segment_name", "qty rev discount"),
    "segment_top_seller": ("report_segment_top_seller", "segment_name top_selling", "max_qty"),
    "category_totals": ("report_category_totals", "category_name", "qty rev discount"),
    "category_top_seller": ("report_category_top_seller", "category_name top_selling", "max_qty"),
    "product_share": ("report_product_share", "segment_name product_name", "rev_pct"),
    "segment_share": ("report_segment_share", "category_name segment_name", "rev_pct"),
    "category_share": ("report_category_share", "category_name", "rev_pct"),
    "penetration": ("report_penetration", "prod_id product_name", "transac penetration"),
    "top_triples": ("report_top_triples", "p1 p2 p3", "time"),
}


def _all_results() -> str:
    ctes, rows = [], []
    for name, (key, labels, measures) in _RESULTS.items():
        ctes.append(f"res_{name} AS ({SALES_SQL[key]})")
        cols = [f"CAST({c} AS VARCHAR)" for c in labels.split()]
        cols += ["CAST(NULL AS VARCHAR)"] * (3 - len(cols))
        named = ", ".join(f"{c} AS label_{i}" for i, c in enumerate(cols, 1))
        rows += [f"SELECT '{name}' AS result, {named}, '{m}' AS measure, CAST({m} AS DOUBLE) AS value FROM res_{name}"
                 for m in measures.split()]
    return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL ".join(rows)


SALES_SQL["monthly_report_results"] = _all_results()
