"""Subscription case: customer journey, plan counts, churn, upgrades, payments.

Inputs: ``subs`` (customer_id, plan_id, start_date, sub_id) and the plan lookup ``plans``
(plan_id, plan_name, price; a handful of rows, broadcast). Order inside a customer is
(start_date, plan_id, sub_id): the case study orders by start date only, the other two
make the order total. Percentages are ROUND(100 * part / whole, 1), half up.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bramble.functions.columns import in_year, money, pct1
from bramble.operators.aggregates import (bucketize, count_distinct, counts_with_totals, distinct_by_period,
                                          distinct_flags, distinct_share)
from bramble.operators.funnel import ordered_concat
from bramble.operators.payment_rules import required_payments
from bramble.operators.payments import churn_over, payment_schedule
from bramble.operators.sequences import last_as_of, mean_time_since_first, nth_in_order, time_since_first
from bramble.sources.fixtures import CHURN, PRO_ANNUAL, REPORT_YEAR, SINCE_DATE, TRIAL, BASIC_MONTHLY, PRO_MONTHLY
from bramble.sources.tables import Tables

ORDER = ["start_date", "plan_id", "sub_id"]


def _named(subs: DataFrame, plans: DataFrame) -> DataFrame:
    return subs.join(plans.select("plan_id", "plan_name"), "plan_id", "left")


def _customers(subs: DataFrame) -> DataFrame:
    return count_distinct(subs, "customer_id", alias="_customers")


# -- A: journey ------------------------------------------------------------------
def customer_journey(subs: DataFrame, plans: DataFrame) -> DataFrame:
    return ordered_concat(_named(subs, plans), "customer_id",
                          {"journey": F.col("plan_name"), "time_line": F.col("start_date").cast("string")}, ORDER,
                          [F.unix_date("start_date"), F.col("plan_id") * float(1 << 44) + F.col("sub_id")], " -> ")


# -- B: questions ----------------------------------------------------------------
def customers_by_plan_with_totals(subs: DataFrame, plans: DataFrame) -> DataFrame:
    return counts_with_totals(_named(subs, plans), "plan_id", "plan_name", "customer_id", "num_customer")


def trials_by_month(subs: DataFrame) -> DataFrame:
    return distinct_by_period(subs.where(F.col("plan_id") == TRIAL), "start_date", "customer_id",
                              "month", alias="num_customer")


def plan_events_by_year(subs: DataFrame, plans: DataFrame, since: str = SINCE_DATE) -> DataFrame:
    c = distinct_flags(subs, "customer_id", {"event_2021": F.col("start_date") >= F.lit(since).cast("date")},
                       by="plan_id", total="event_2020")
    return (plans.select("plan_id", "plan_name").join(c, "plan_id", "left")
            .select("plan_id", "plan_name", F.coalesce("event_2020", F.lit(0)).alias("event_2020"),
                    F.coalesce("event_2021", F.lit(0)).alias("event_2021")))


def churn_rate(subs: DataFrame) -> DataFrame:
    return distinct_share(subs, "customer_id", F.col("plan_id") == CHURN, "churn_count", "churn_pct")


def second_plans(subs: DataFrame) -> DataFrame:
    return nth_in_order(subs, "customer_id", ORDER, 2)


def churn_after_trial(subs: DataFrame) -> DataFrame:
    n = second_plans(subs).agg(F.count(F.when(F.col("plan_id") == CHURN, 1)).alias("churn_after_trial_count"))
    return (n.crossJoin(F.broadcast(_customers(subs)))
            .select("churn_after_trial_count",
                    pct1("churn_after_trial_count", "_customers").alias("churn_after_trial_pct")))


def plans_after_trial(subs: DataFrame, plans: DataFrame) -> DataFrame:
    sec = _named(second_plans(subs).where(F.col("plan_id") != CHURN), plans)
    per = sec.groupBy("plan_name").agg(F.count(F.lit(1)).alias("plan_after_trial_count"))
    return (per.crossJoin(F.broadcast(_customers(subs)))
            .select("plan_name", "plan_after_trial_count",
                    pct1("plan_after_trial_count", "_customers").alias("plan_after_trial_pct"))
            .orderBy(F.col("plan_after_trial_count").desc(), "plan_name"))


def plan_snapshot_at(subs: DataFrame, plans: DataFrame, at: str = f"{REPORT_YEAR}-12-31") -> DataFrame:
    """Plan of every customer as of ``at`` (latest row starting on or before it) and the
    share of customers on each plan; all plans listed."""
    cur = last_as_of(subs, "customer_id", ORDER, "start_date", F.lit(at).cast("date"))
    per = cur.groupBy("plan_id").agg(F.count(F.lit(1)).alias("customer_count"))
    total = cur.agg(F.count(F.lit(1)).alias("_customers"))
    return (plans.select("plan_id", "plan_name").join(per, "plan_id", "left")
            .crossJoin(F.broadcast(total))
            .select("plan_id", "plan_name", F.coalesce("customer_count", F.lit(0)).alias("customer_count"),
                    pct1(F.coalesce("customer_count", F.lit(0)), "_customers").alias("customer_pct")))


def annual_upgrades_in_year(subs: DataFrame, plans: DataFrame, year: int = REPORT_YEAR) -> DataFrame:
    s = _named(subs.where(in_year("start_date", year)), plans).where(F.col("plan_name") == "pro annual")
    n = count_distinct(s, "customer_id", alias="num_customer")
    name = s.agg(F.max("plan_name").alias("plan_name"))
    return name.crossJoin(F.broadcast(n))


def days_to_upgrade(subs: DataFrame) -> DataFrame:
    """Customers on pro annual and the rounded mean of days from their first start to each
    pro annual start."""
    return mean_time_since_first(subs, "customer_id", "start_date", F.col("plan_id") == PRO_ANNUAL,
                                 "pro_annual_customer", "avg_days_to_upgrade")


def days_to_upgrade_buckets(subs: DataFrame, width: int = 30) -> DataFrame:
    d = time_since_first(subs, "customer_id", "start_date", F.col("plan_id") == PRO_ANNUAL, alias="_days")
    return bucketize(d, "_days", width, "customer_id", "days_to_upgrade_range", "num_customer")


def downgrades_in_year(subs: DataFrame, year: int = REPORT_YEAR) -> DataFrame:
    """Customers with a basic-monthly row in ``year`` that starts after one of their
    pro-monthly rows: latest such basic start > earliest pro start, per customer."""
    per = subs.groupBy("customer_id").agg(
        F.min(F.when(F.col("plan_id") == PRO_MONTHLY, F.col("start_date"))).alias("_pro"),
        F.max(F.when((F.col("plan_id") == BASIC_MONTHLY) & in_year("start_date", year),
                     F.col("start_date"))).alias("_basic"))
    return per.agg(F.count(F.when(F.col("_basic") > F.col("_pro"), 1)).alias("downgraded_customer"))


# -- C / D: payments -----------------------------------------------------------
def payments_year(subs: DataFrame, plans: DataFrame, year: int = REPORT_YEAR) -> DataFrame:
    return payment_schedule(subs, plans, F.lit(dt.date(year, 12, 31)), year=year)


def payments_all(subs: DataFrame, plans: DataFrame) -> DataFrame:
    return payment_schedule(subs, plans, subs.agg(F.max("start_date")))


def payments_required(subs: DataFrame, plans: DataFrame) -> DataFrame:
    """Payments by the stated billing rules, up to the last start date of the log."""
    return required_payments(subs, plans, subs.agg(F.max("start_date")))


def present(p: DataFrame) -> DataFrame:
    """Payments with the amount as DOUBLE."""
    return p.withColumn("amount", money("amount"))


def with_month(payments: DataFrame) -> DataFrame:
    """Payments with the year and month of the payment date."""
    return payments.withColumns({"year": F.year("payment_date"), "month": F.month("payment_date")})


def revenue_by_month(payments: DataFrame) -> DataFrame:
    """Per (year, month): distinct paying customers and total amount, plan <> trial. One
    pass: amount per (month, customer) then counts and sums per month (both aggregates
    combine on the mappers)."""
    dated = payments if {"year", "month"} <= set(payments.columns) else with_month(payments)
    p = dated.where(F.col("plan_id") != TRIAL).select("year", "month", "customer_id", "amount")
    # NULL customers form one group: COUNT(customer_id) skips it, SUM still adds its amount
    per = p.groupBy("year", "month", "customer_id").agg(F.sum("amount").alias("_a"))
    return per.groupBy("year", "month").agg(F.count("customer_id").alias("num_pay"),
                                            money(F.sum("_a")).alias("total_amount"))


def monthly_churn(payments: DataFrame, subs: DataFrame) -> DataFrame:
    return churn_over(payments, subs, CHURN, [TRIAL, CHURN])


# -- registry bindings ---------------------------------------------------------
def _fx(spark, sf_dir):
    return Tables(spark, sf_dir).fixtures


def _s(fn):
    return lambda spark, sf_dir: fn(_fx(spark, sf_dir).subscriptions)


def _sp(fn):
    def run(spark, sf_dir):
        fx = _fx(spark, sf_dir)
        return fn(fx.subscriptions, fx.plans)
    return run


def _rev(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return revenue_by_month(payments_all(fx.subscriptions, fx.plans))


def _churn(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return monthly_churn(payments_all(fx.subscriptions, fx.plans), fx.subscriptions)


QUERIES = {
    "customer_journey": _sp(customer_journey),
    "customers_by_plan_with_totals": _sp(customers_by_plan_with_totals),
    "trials_by_month": _s(trials_by_month),
    "plan_events_by_year": _sp(plan_events_by_year),
    "churn_rate": _s(churn_rate),
    "churn_after_trial": _s(churn_after_trial),
    "plans_after_trial": _sp(plans_after_trial),
    "plan_snapshot_at": _sp(plan_snapshot_at),
    "annual_upgrades_in_year": _sp(annual_upgrades_in_year),
    "days_to_upgrade": _s(days_to_upgrade),
    "days_to_upgrade_buckets": _s(days_to_upgrade_buckets),
    "downgrades_in_year": _s(downgrades_in_year),
    "payments_year": _sp(lambda s, p: present(payments_year(s, p))),
    "payments_all": _sp(lambda s, p: present(payments_all(s, p))),
    "payments_required": _sp(lambda s, p: present(payments_required(s, p))),
    "revenue_by_month": _rev,
    "monthly_churn": _churn,
}
