"""Sinks: the case studies materialise derived tables with CREATE TABLE AS SELECT (funnel
tables, campaign table) and a session temp table (payments). Here a derived table is a
DataFrame written once and read back, or a temp view for SQL users."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def save_table(df: DataFrame, path: str, *, partition_by: Sequence[str] = (), mode: str = "overwrite",
               fmt: str = "parquet") -> DataFrame:
    """DROP + CREATE TABLE AS SELECT as a file table: writes ``df`` (optionally
    partitioned, so later filters on those columns prune whole folders) and returns a
    DataFrame reading the written files, which also cuts the lineage (a lost executor
    re-reads files instead of recomputing the plan)."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return df.sparkSession.read.format(fmt).load(path)


def save_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str, *,
                  sort: Sequence[str] | None = None) -> DataFrame:
    """CREATE TABLE ... CLUSTERED BY: ``df`` as a catalog table of ``buckets`` files by the hash
    of ``keys``, sorted inside by ``sort`` (the keys unless given). Grouping, windows and joins on
    the keys (or on more columns) then read it without an exchange. Rows are dealt out once, by
    the hash that names the bucket, so every bucket is one file. Equal keys share a file: choose
    keys under which no value holds much of the table, or add columns that every reader groups
    by."""
    keys, sort = list(keys), list(sort or keys)
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*sort).saveAsTable(name))
    return spark.table(name)


def temp_view(df: DataFrame, name: str, *, persist: bool = False) -> DataFrame:
    """CREATE TEMPORARY TABLE AS SELECT: a session view, cached when read repeatedly."""
    if persist:
        df = df.persist()
    df.createOrReplaceTempView(name)
    return df


def register_views(spark: SparkSession, sf_dir: str, names: Sequence[str] | None = None) -> list[str]:
    """Register the mapped tables (sales, product_details, clicks, users, plans,
    subscriptions, ...) as temp views so Spark SQL can query them by name."""
    from bramble.sources.tables import Tables
    fx = Tables(spark, sf_dir).fixtures
    names = list(names or ["sales", "product_details", "product_hierarchy", "product_prices", "clicks",
                           "users", "event_identifier", "page_hierarchy", "campaign_identifier",
                           "plans", "subscriptions"])
    for n in names:
        getattr(fx, n).createOrReplaceTempView(n)
    return names


def register_derived(spark: SparkSession, sf_dir: str, folder: str | None = None) -> list[str]:
    """Register the tables that the case studies build once and read often (product_sales,
    category_sales, campaign_performance, payments) as temp views. With ``folder`` each is
    written there first, so that what reads it does not build it again; the functions of
    ``bramble.plans`` that depend on one take the saved frame as well."""
    from bramble.plans import clicks as C
    from bramble.plans import subscriptions as U
    from bramble.sources.tables import Tables
    fx = Tables(spark, sf_dir).fixtures

    def keep(name: str, df: DataFrame) -> DataFrame:
        df = save_table(df, f"{folder.rstrip('/')}/{name}") if folder else df
        df.createOrReplaceTempView(name)
        return df

    product_sales = keep("product_sales", C.product_funnel(fx.clicks, fx.page_hierarchy))
    keep("category_sales", C.category_funnel(product_sales, fx.page_hierarchy))
    keep("campaign_performance", C.campaign_performance(fx.clicks, fx.users, fx.campaign_identifier, fx.page_hierarchy))
    keep("payments", U.present(U.payments_all(fx.subscriptions, fx.plans)))
    return ["product_sales", "category_sales", "campaign_performance", "payments"]


def save_bucketed_tables(spark: SparkSession, sf_dir: str, folder: str, buckets: int) -> dict[str, DataFrame]:
    """The tables that many keys group by visit or customer, bucketed so that those need no
    exchange of the rows: clicks_by_visit (funnels, cart texts, visit aggregates), visits_by_visit
    (``campaign_by_*``, with ``conversion_metrics(..., apart=True)``), subscriptions_by_customer
    (payment windows) and payments_by_month (``revenue_by_month``; the month is a bucket column
    besides the customer, so a customer with very many payments spreads)."""
    from bramble.plans import clicks as C
    from bramble.plans import subscriptions as U
    from bramble.sources.tables import Tables
    fx = Tables(spark, sf_dir).fixtures
    at = folder.rstrip("/")

    def keep(name: str, df: DataFrame, *keys: str) -> DataFrame:
        return save_bucketed(df, name, keys, buckets, f"{at}/{name}")

    clicks = keep("clicks_by_visit", fx.clicks, "visit_id")
    subs = keep("subscriptions_by_customer", fx.subscriptions, "customer_id")
    payments = U.payments_all(subs, fx.plans)
    return {
        "clicks_by_visit": clicks,
        "visits_by_visit": keep("visits_by_visit", C.campaign_visits(clicks, fx.users, fx.campaign_identifier), "visit_id"),
        "subscriptions_by_customer": subs,
        "payments_by_month": keep("payments_by_month", U.with_month(payments), "customer_id", "year", "month"),
    }
