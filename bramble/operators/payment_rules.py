"""Payments by the stated billing rules, from a subscription change log.

The rules (``payments.payment_schedule`` follows the original query instead, which misses
three of them):

* of several rows of one customer and day only the last one takes effect;
* a monthly plan pays on its start day and on the same day of every later month (cut to the
  month's length), before the day on which another plan takes over;
* an upgrade from ``basic`` to ``monthly`` or ``annual`` starts at once and is reduced by what
  was paid for the current month;
* an upgrade from ``monthly`` to ``annual`` starts, and is paid in full, at the end of the
  billing period; a further ``annual`` row until then changes nothing, any other row that
  starts by then cancels it;
* an ``annual`` plan pays once; a plan without a price (churn) ends the one before, and
  nothing is paid from that day on.

What a row does depends on the rows before it only through the last row of another plan, so
no state has to be carried from row to row: a *head* is a row that does not repeat ``annual``,
and one look back (LAG) and one look ahead among the heads (LEAD) tell when an upgrade takes
effect, if it does. All windows go through :mod:`bramble.operators.skew`, so a hot customer's
rows are split; the repeats under a pending upgrade are removed by an equi-join on (customer,
day), at most 31 days an upgrade.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bramble.operators.payments import PLAN_ROWS_PER_TASK
from bramble.operators.skew import hot_splits, sequence_columns, task_count


def _months(later: Column, earlier: Column) -> Column:
    return F.months_between(F.trunc(later, "month"), F.trunc(earlier, "month")).cast("int")


def period_end(start: Column, day: Column) -> Column:
    """The first billing day of a plan that began at ``start`` on or after ``day``."""
    k = _months(day, start)
    here = F.add_months(start, k)
    return F.when(here >= day, here).otherwise(F.add_months(start, k + 1))


def effective_plans(subs: DataFrame, plans: DataFrame, *, customer: str = "customer_id", basic: str = "basic monthly",
                    monthly: str = "pro monthly", annual: str = "pro annual", skip: str = "trial",
                    splits: list[DataFrame] | None = None, **split_kw) -> DataFrame:
    """The plan changes that take effect: ``customer``, plan_id, plan_name, price, ``since``
    (the day from which the plan counts) and ``credit`` (taken off the first payment; NULL for
    none). Rows of ``skip`` and of unknown plans take no part."""
    rows = subs.join(plans.select("plan_id", "plan_name", "price"), "plan_id", "left").where(F.col("plan_name") != skip)
    day = rows.groupBy(customer, "start_date").agg(F.max(F.struct("plan_id", "sub_id", "plan_name", "price")).alias("_last"))
    day = day.select(customer, "start_date", "_last.plan_id", "_last.plan_name", "_last.price")
    rank = [F.unix_date("start_date")]
    splits = hot_splits(day, customer, rank, **split_kw) if splits is None else splits
    seen = sequence_columns(day, customer, ["start_date"], rank, splits=splits,
                            lag={"_before": "plan_name", "_before_start": "start_date", "_before_price": "price"})
    is_annual = F.col("plan_name") == annual
    again = is_annual & F.coalesce(F.col("_before") == annual, F.lit(False))
    waits = is_annual & F.coalesce(F.col("_before") == monthly, F.lit(False))
    since = F.when(waits, period_end(F.col("_before_start"), F.col("start_date"))).otherwise(F.col("start_date"))
    credit = F.when((F.col("_before") == basic) & F.col("plan_name").isin(monthly, annual), F.col("_before_price"))
    seen = seen.select(customer, "start_date", "plan_id", "plan_name", "price", again.alias("_again"), waits.alias("_waits"),
                       since.alias("since"), credit.alias("credit"))
    heads = sequence_columns(seen.where(~F.col("_again")), customer, ["start_date"], rank, splits=splits,
                             lead={"_next_head": "start_date"})
    # the days after an upgrade on which it is still pending
    last = F.least("since", F.date_sub("_next_head", 1))  # least() skips NULL
    pending = (heads.where(F.col("_waits") & (last > F.col("start_date")))
               .select(F.col(customer).alias("_pk"), F.explode(F.sequence(F.date_add("start_date", 1), last)).alias("_pd")))
    out = [customer, "plan_id", "plan_name", "price", "since", "credit"]
    repeats = seen.where("_again").join(
        pending, F.col(customer).eqNullSafe(F.col("_pk")) & (F.col("start_date") == F.col("_pd")), "left_anti")
    stands = ~F.col("_waits") | F.col("_next_head").isNull() | (F.col("_next_head") > F.col("since"))
    return heads.where(stands).select(*out).unionByName(repeats.select(*out))


def required_payments(subs: DataFrame, plans: DataFrame, horizon: Column | DataFrame, *, customer: str = "customer_id",
                      basic: str = "basic monthly", monthly: str = "pro monthly", annual: str = "pro annual",
                      skip: str = "trial", rows_per_task: int = PLAN_ROWS_PER_TASK, **split_kw) -> DataFrame:
    """Every payment up to ``horizon`` (a date, or a one-row frame of one): ``customer``,
    plan_id, plan_name, payment_date, amount (DECIMAL) and payment_order. A customer pays at
    most once a day. An empty log gives no payment. Payments are made and numbered in tasks of
    about ``rows_per_task`` plan rows."""
    tasks = task_count(subs, subs.count(), rows_per_task)
    splits = hot_splits(subs.select(customer, "start_date"), customer, [F.unix_date("start_date")], **split_kw)
    took = effective_plans(subs, plans, customer=customer, basic=basic, monthly=monthly, annual=annual, skip=skip, splits=splits)
    took = sequence_columns(took, customer, ["since"], [F.unix_date("since")], splits=splits, lead={"_until": "since"}, tasks=tasks)
    if isinstance(horizon, DataFrame):
        took = took.crossJoin(F.broadcast(horizon.toDF("_horizon")))
        horizon = F.col("_horizon")
    took = took.withColumn("_horizon", horizon).where(F.col("price").isNotNull() & (F.col("since") <= F.col("_horizon")))
    n = F.when(F.col("plan_name") == annual, F.lit(0)).otherwise(_months(F.least("_until", "_horizon"), F.col("since")))
    paid = took.withColumn("_i", F.explode(F.sequence(F.lit(0), F.greatest(n, F.lit(0)))))
    paid = paid.withColumn("payment_date", F.add_months("since", F.col("_i")))
    paid = paid.where((F.col("payment_date") <= F.col("_horizon"))
                      & (F.col("_until").isNull() | (F.col("payment_date") < F.col("_until"))))
    amount = F.when(F.col("_i") == 0, F.col("price") - F.coalesce("credit", F.lit(0))).otherwise(F.col("price"))
    paid = paid.select(customer, "plan_id", "plan_name", "payment_date", amount.alias("amount"))
    return sequence_columns(paid, customer, ["payment_date"], [F.unix_date("payment_date")], splits=splits,
                            row_number="payment_order", tasks=tasks, dealt=True)
