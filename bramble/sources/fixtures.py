"""The three table families (sales, clickstream, subscriptions) as views over the driver
tables. Every view exists twice: as a lazy Spark DataFrame (``Fixtures``) and as a
DuckDB/ANSI SQL common table expression (``SQL_CTES``) used by the oracle queries.
Both must stay in step; ``tests/test_fixtures.py`` compares them.

Mapping (see FIXTURES.md):
  sales               lineitem x orders: txn = order, product = supplier
  product_details     supplier -> nation (segment) -> region (category)
  product_hierarchy   region / nation / supplier stacked as an adjacency list
  product_prices      supplier account balance as price
  clicks              events: visit = user, month and 5-day block, page = props.k mod 13
  users               distinct event users, 50 user ids over 150 cookies
  subscriptions       orders: customer, plan = order priority digit - 1, order date
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the small dimension tables (constant lookups, not data-scaled).
# ---------------------------------------------------------------------------
EVENT_NAMES = [
    (1, "Page View"),
    (2, "Add to Cart"),
    (3, "Purchase"),
    (4, "Ad Impression"),
    (5, "Ad Click"),
]
# events.event_type text -> code
EVENT_CODES = {"view": 1, "click": 2, "purchase": 3, "signup": 4, "error": 5}

PAGES = [
    (0, "Home", None, None),
    (1, "All Products", None, None),
    (2, "Checkout", None, None),
    (3, "Confirmation", None, None),
    (4, "Item 1", "Category A", 1),
    (5, "Item 2", "Category A", 2),
    (6, "Item 3", "Category A", 3),
    (7, "Item 4", "Category B", 4),
    (8, "Item 5", "Category B", 5),
    (9, "Item 6", "Category B", 6),
    (10, "Item 7", "Category C", 7),
    (11, "Item 8", "Category C", 8),
    (12, "Item 9", "Category C", 9),
]
N_PAGES = 13

CAMPAIGNS = [
    ("C1", "2024-01-01 00:00:00", "2024-01-08 23:59:59"),
    ("C2", "2024-01-10 00:00:00", "2024-01-20 23:59:59"),
    ("C3", "2024-01-22 00:00:00", "2024-01-26 23:59:59"),
]

PLANS = [
    (0, "trial", "0.00"),
    (1, "basic monthly", "9.90"),
    (2, "pro monthly", "19.90"),
    (3, "pro annual", "199.00"),
    (4, "churn", None),
]
TRIAL, BASIC_MONTHLY, PRO_MONTHLY, PRO_ANNUAL, CHURN = 0, 1, 2, 3, 4

# Reference calendar mapped onto the driver data: year 2020 -> 1998, 2021-01-01 -> 1999-01-01.
REPORT_YEAR = 1998
SINCE_DATE = "1999-01-01"
REPORT_MONTH = 3
HIERARCHY_OFFSETS = {"category": 1, "segment": 100, "style": 1000}


class Fixtures:
    """Lazy DataFrames of the mapped tables for one ``Tables`` instance."""

    def __init__(self, tables):
        self.t = tables
        self.spark = tables.spark

    # -- sales family -------------------------------------------------------
    @property
    def sales_lines(self) -> DataFrame:
        """The part of ``sales`` that lineitem alone has; every line has its order."""
        return self.t.lineitem.select(
            F.col("l_orderkey").alias("txn_id"),
            F.col("l_suppkey").alias("prod_id"),
            F.col("l_quantity").cast("int").alias("qty"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("gross"),
            F.round(F.col("l_discount") * 100).cast("int").alias("discount"))

    @property
    def transactions(self) -> DataFrame:
        """The part of ``sales`` that orders have, one row per transaction."""
        return self.t.orders.select(
            F.col("o_orderkey").alias("txn_id"),
            F.when(F.col("o_orderstatus") == "F", "t").otherwise("f").alias("member"),
            F.col("o_orderdate").alias("start_txn_time"))

    @property
    def sales(self) -> DataFrame:
        return self.sales_lines.join(self.transactions, "txn_id")

    @property
    def product_details(self) -> DataFrame:
        s, n, r = self.t.supplier, self.t.nation, self.t.region
        return (s.join(n, s.s_nationkey == n.n_nationkey)
                .join(r, n.n_regionkey == r.r_regionkey)
                .select(F.col("s_suppkey").alias("product_id"),
                        F.col("s_acctbal").cast("decimal(18,2)").alias("price"),
                        F.col("s_name").alias("product_name"),
                        F.col("r_regionkey").alias("category_id"),
                        F.col("n_nationkey").alias("segment_id"),
                        F.col("s_suppkey").alias("style_id"),
                        F.col("r_name").alias("category_name"),
                        F.col("n_name").alias("segment_name"),
                        F.col("s_name").alias("style_name")))

    @property
    def product_hierarchy(self) -> DataFrame:
        off = HIERARCHY_OFFSETS
        reg = self.t.region.select((F.col("r_regionkey") + off["category"]).cast("bigint").alias("id"),
                                   F.lit(None).cast("bigint").alias("parent_id"),
                                   F.col("r_name").alias("level_text"))
        nat = self.t.nation.select((F.col("n_nationkey") + off["segment"]).cast("bigint").alias("id"),
                                   (F.col("n_regionkey") + off["category"]).cast("bigint").alias("parent_id"),
                                   F.col("n_name").alias("level_text"))
        sup = self.t.supplier.select((F.col("s_suppkey") + off["style"]).cast("bigint").alias("id"),
                                     (F.col("s_nationkey") + off["segment"]).cast("bigint").alias("parent_id"),
                                     F.col("s_name").alias("level_text"))
        return reg.unionByName(nat).unionByName(sup)

    @property
    def product_prices(self) -> DataFrame:
        return self.t.supplier.select(
            (F.col("s_suppkey") + HIERARCHY_OFFSETS["style"]).cast("bigint").alias("id"),
            F.col("s_suppkey").alias("product_id"),
            F.col("s_acctbal").cast("decimal(18,2)").alias("price"))

    # -- clickstream family -------------------------------------------------
    @property
    def clicks(self) -> DataFrame:
        e = self.t.events
        code = F.lit(None).cast("int")
        for name, c in reversed(list(EVENT_CODES.items())):
            code = F.when(F.col("event_type") == name, F.lit(c)).otherwise(code)
        visit_block = ((F.dayofmonth("ts") - 1) / 5).cast("bigint")
        df = e.select(
            F.col("event_id"),
            F.concat(F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyyMM"), F.lit("-"),
                     visit_block.cast("string")).alias("visit_id"),
            F.col("user_id").cast("string").alias("cookie_id"),
            F.pmod(F.get_json_object("props", "$.k").try_cast("int"), F.lit(N_PAGES)).alias("page_id"),
            code.alias("event_type"),
            F.col("ts").alias("event_time"),
        )
        return df

    @property
    def clicks_sequenced(self) -> DataFrame:
        """``clicks`` plus sequence_number: position of the event in its visit by
        (event_time, event_id). Numbered with the hot-key split of
        :mod:`bramble.operators.skew`, so a very long visit is not sorted in one task.
        Queries that only need visit order sort by (event_time, event_id) directly."""
        from bramble.operators.skew import sequence_columns
        from bramble.operators.sequences import time_rank
        return sequence_columns(self.clicks, "visit_id", ["event_time", "event_id"],
                                [time_rank("event_time"), F.col("event_id")],
                                row_number="sequence_number")

    @property
    def users(self) -> DataFrame:
        return (self.t.events.select("user_id").distinct()
                .select((F.col("user_id") % 50).alias("user_id"),
                        F.col("user_id").cast("string").alias("cookie_id")))

    def _lookup(self, rows: list[tuple], **types: str) -> DataFrame:
        """Fixed rows as a local relation: the planner knows their size, so its own check
        broadcasts them, and any larger table put in their place is joined as it needs."""
        given = self.spark.sql(_values(rows, list(types)))
        return given.select(*[F.col(c).cast(t).alias(c) for c, t in types.items()])

    @property
    def event_identifier(self) -> DataFrame:
        return self._lookup(EVENT_NAMES, event_type="int", event_name="string")

    @property
    def page_hierarchy(self) -> DataFrame:
        return self._lookup(PAGES, page_id="int", page_name="string", product_category="string", product_id="int")

    @property
    def campaign_identifier(self) -> DataFrame:
        return self._lookup(CAMPAIGNS, campaign_name="string", start_date="timestamp_ntz", end_date="timestamp_ntz")

    # -- subscriptions family -----------------------------------------------
    @property
    def plans(self) -> DataFrame:
        return self._lookup(PLANS, plan_id="int", plan_name="string", price="decimal(18,2)")

    @property
    def subscriptions(self) -> DataFrame:
        return self.t.orders.select(
            F.col("o_custkey").alias("customer_id"),
            (F.substring("o_orderpriority", 1, 1).try_cast("int") - 1).alias("plan_id"),
            F.col("o_orderdate").cast("date").alias("start_date"),
            F.col("o_orderkey").alias("sub_id"),
        )


# ---------------------------------------------------------------------------
# The same views in SQL (DuckDB dialect, ANSI where possible) for the oracle.
# ---------------------------------------------------------------------------
def _values(rows, cols) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({', '.join(cols)})"


def _event_code_sql() -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in EVENT_CODES.items())
    return f"CASE event_type {whens} END"


SQL_CTES: dict[str, str] = {
    "sales": """
        SELECT l.l_orderkey AS txn_id, l.l_suppkey AS prod_id,
               CAST(l.l_quantity AS INTEGER) AS qty,
               CAST(l.l_extendedprice AS DECIMAL(18,2)) AS gross,
               CAST(ROUND(l.l_discount * 100) AS INTEGER) AS discount,
               CASE WHEN o.o_orderstatus = 'F' THEN 't' ELSE 'f' END AS member,
               o.o_orderdate AS start_txn_time
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "product_details": """
        SELECT s.s_suppkey AS product_id, CAST(s.s_acctbal AS DECIMAL(18,2)) AS price,
               s.s_name AS product_name, r.r_regionkey AS category_id,
               n.n_nationkey AS segment_id, s.s_suppkey AS style_id,
               r.r_name AS category_name, n.n_name AS segment_name, s.s_name AS style_name
        FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "product_hierarchy": f"""
        SELECT CAST(r_regionkey + {HIERARCHY_OFFSETS['category']} AS BIGINT) AS id,
               CAST(NULL AS BIGINT) AS parent_id, r_name AS level_text FROM region
        UNION ALL
        SELECT CAST(n_nationkey + {HIERARCHY_OFFSETS['segment']} AS BIGINT),
               CAST(n_regionkey + {HIERARCHY_OFFSETS['category']} AS BIGINT), n_name FROM nation
        UNION ALL
        SELECT CAST(s_suppkey + {HIERARCHY_OFFSETS['style']} AS BIGINT),
               CAST(s_nationkey + {HIERARCHY_OFFSETS['segment']} AS BIGINT), s_name FROM supplier""",
    "product_prices": f"""
        SELECT CAST(s_suppkey + {HIERARCHY_OFFSETS['style']} AS BIGINT) AS id,
               s_suppkey AS product_id, CAST(s_acctbal AS DECIMAL(18,2)) AS price
        FROM supplier""",
    "clicks_base": f"""
        SELECT event_id,
               CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m') || '-' || CAST((day(ts) - 1) // 5 AS VARCHAR) AS visit_id,
               CAST(user_id AS VARCHAR) AS cookie_id,
               CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % {N_PAGES} AS INTEGER) AS page_id,
               {_event_code_sql()} AS event_type,
               ts AS event_time
        FROM events""",
    "clicks": """
        SELECT *, ROW_NUMBER() OVER (PARTITION BY visit_id ORDER BY event_time, event_id)
                  AS sequence_number
        FROM clicks_base""",
    "users": """
        SELECT user_id % 50 AS user_id, CAST(user_id AS VARCHAR) AS cookie_id
        FROM (SELECT DISTINCT user_id FROM events) d""",
    "event_identifier": _values(EVENT_NAMES, ["event_type", "event_name"]),
    "page_hierarchy": _values(PAGES, ["page_id", "page_name", "product_category", "product_id"]),
    "campaign_identifier": f"""
        SELECT campaign_name, CAST(start_date AS TIMESTAMP) AS start_date,
               CAST(end_date AS TIMESTAMP) AS end_date
        FROM ({_values(CAMPAIGNS, ['campaign_name', 'start_date', 'end_date'])}) c""",
    "plans": f"""
        SELECT plan_id, plan_name, CAST(price AS DECIMAL(18,2)) AS price
        FROM ({_values([(i, n, p) for i, n, p in PLANS], ['plan_id', 'plan_name', 'price'])}) p""",
    "subscriptions": """
        SELECT o_custkey AS customer_id,
               TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 AS plan_id,
               CAST(o_orderdate AS DATE) AS start_date, o_orderkey AS sub_id
        FROM orders""",
}


def with_views(body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the mapped views it mentions (plus extra named CTEs)."""
    import re
    needed: list[str] = []

    def want(name: str):
        if name in needed:
            return
        sql = SQL_CTES[name]
        for dep in SQL_CTES:
            if dep != name and re.search(rf"\b{dep}\b", sql):
                want(dep)
        needed.append(name)

    text = body + " ".join(s for _, s in (extra or []))
    for name in SQL_CTES:
        if re.search(rf"\b{name}\b", text):
            want(name)
    parts = [f"{n} AS ({SQL_CTES[n]})" for n in needed]
    parts += [f"{n} AS ({s})" for n, s in (extra or [])]
    if not parts:
        return body
    head = body.lstrip()
    if head[:15].upper() == "WITH RECURSIVE ":
        return "WITH RECURSIVE " + ",\n".join(parts) + ",\n" + head[15:]
    if head[:5].upper() == "WITH ":
        # merge the body's own CTE list into ours
        return "WITH " + ",\n".join(parts) + ",\n" + head[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body
