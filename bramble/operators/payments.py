"""Payment schedule from a subscription change log, and churn over payment activity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bramble.functions.columns import ratio
from bramble.operators.skew import hot_splits, sequence_columns, task_count

# a plan row makes a payment a month, all held by the windows and counts of its task
PLAN_ROWS_PER_TASK = 100_000


def drift_anchor(d0: Column) -> Column:
    """Per-start calendar facts for :func:`drift_month_dates`, computed once per plan row
    (before the month expansion): months until the first 30-day month and the first
    February after ``d0``'s month, and that February's length."""
    m0 = F.trunc(d0, "month")
    # lengths of the 12 months after d0's month
    dims = F.transform(F.sequence(F.lit(1), F.lit(12)), lambda j: F.dayofmonth(F.last_day(F.add_months(m0, j))))
    j_feb = F.array_position(F.transform(dims, lambda x: x < 30), True).cast("int")
    return F.struct(F.array_position(dims, 30).cast("int").alias("j30"), j_feb.alias("jfeb"),
                    F.element_at(dims, j_feb).alias("feb"))


def drift_month_dates(d0: Column, i: Column, anchor: str = "drift", facts: Column | None = None) -> Column:
    """Date of the i-th monthly payment after ``d0``.

    ``anchor='start'``: ADD_MONTHS(d0, i) (same day of month as the start, clamped).
    ``anchor='drift'``: add one month to the *previous* payment i times, clamping each
    time, so a 31st start drifts to 30/29/28 for good (what a recursive
    ``DATE_ADD(prev, INTERVAL 1 MONTH)`` gives). Closed form: the day is
    min(day(d0), shortest month length among the months 1..i after d0's month), and that
    minimum only changes at the first 30-day month and at the first (and second) February.
    ``facts`` is :func:`drift_anchor` of ``d0`` (pass it precomputed to share it).
    """
    if anchor == "start":
        return F.add_months(d0, i)
    f = facts if facts is not None else drift_anchor(d0)
    shortest = (F.when(i >= f["jfeb"] + 12, F.lit(28)).when(i >= f["jfeb"], f["feb"])
                .when(i >= f["j30"], F.lit(30)).otherwise(F.lit(31)))
    mi = F.add_months(F.trunc(d0, "month"), i)
    day = F.least(F.dayofmonth(d0), shortest)
    return F.when(i == 0, d0).otherwise(F.make_date(F.year(mi), F.month(mi), day))


def payment_schedule(subs: DataFrame, plans: DataFrame, horizon: Column | DataFrame, *, customer: str = "customer_id",
                     order: Sequence[str] = ("start_date", "plan_id", "sub_id"),
                     year: int | None = None, once_plans: Sequence[str] = ("pro annual",),
                     skip_plans: Sequence[str] = ("trial",),
                     credit_from: Sequence[str] = ("pro monthly", "basic monthly"),
                     credit_to: Sequence[str] = ("pro annual",),
                     anchor: str = "drift", inclusive_end: bool = True, tie_rank: Column | None = None,
                     rows_per_task: int = PLAN_ROWS_PER_TASK, **split_kw) -> DataFrame:
    """Payments implied by plan changes.

    Each non-skipped plan row (optionally only rows starting in ``year``) runs until the
    customer's next such row (LEAD) or ``horizon``. Monthly plans pay on the start date
    and every month after it while the date is <= the end (``inclusive_end``); plans in
    ``once_plans`` pay once; plans without a price (churn) pay nothing but still end the
    previous plan. Payments are numbered per customer; a payment of a ``credit_to`` plan
    right after a ``credit_from`` payment is reduced by that previous amount.

    Plan: join to the plan lookup (broadcast where Spark finds it small); the LEAD window over plan rows, a narrow
    ``explode(sequence)`` of the month indexes, then the numbering / previous-payment
    window. Both windows run per (customer, bucket) via
    :func:`bramble.operators.skew.sequence_columns`; the buckets of both come from the plan
    rows, since a customer pays at most once a plan row and month. Both windows and the explode
    between them run in tasks of about ``rows_per_task`` plan rows, so that what a task holds
    does not grow with the log. Inside one date, rows are split by ``tie_rank``: the other order columns as one number (default: plan id * 2^44 +
    row id, exact for plan ids under 512 and row ids under 2^44).
    """
    order = list(order)
    tasks = task_count(subs, subs.count(), rows_per_task)
    base = subs.join(plans.select("plan_id", "plan_name", F.col("price").alias("amount")), "plan_id", "left")
    base = base.where(~F.col("plan_name").isin(*skip_plans))
    if year is not None:
        base = base.where(F.col("start_date").between(F.lit(f"{year}-01-01").cast("date"),
                                                      F.lit(f"{year}-12-31").cast("date")))
    if isinstance(horizon, DataFrame):  # one-row frame, e.g. MAX(start_date) of all rows
        base = base.crossJoin(F.broadcast(horizon.toDF("_horizon")))
        horizon = F.col("_horizon")
    base = base.withColumn("_hz", horizon)

    tie = tie_rank if tie_rank is not None else F.col(order[1]) * float(1 << 44) + F.col(order[2])
    splits = hot_splits(base, customer, [F.unix_date("start_date"), tie], **split_kw)
    nxt = sequence_columns(base, customer, order, [F.unix_date("start_date"), tie],
                           lead={"_next_start": "start_date"}, splits=splits, tasks=tasks)
    end = F.coalesce(F.col("_next_start"), F.col("_hz"))
    paying = nxt.where(F.col("amount").isNotNull()).select(
        customer, *order[1:], "plan_name", "amount", "start_date", end.alias("_end"),
        *([drift_anchor(F.col("start_date")).alias("_cal")] if anchor == "drift" else []))

    # one row per payment: narrow explode of the month indexes, closed-form dates
    n = F.when(F.col("plan_name").isin(*once_plans), F.lit(0)).otherwise(
        F.months_between(F.trunc("_end", "month"), F.trunc("start_date", "month")).cast("int"))
    exp = paying.withColumn("_i", F.explode(F.sequence(F.lit(0), F.greatest(n, F.lit(0)))))
    facts = F.col("_cal") if anchor == "drift" else None
    exp = exp.withColumn("payment_date", drift_month_dates(F.col("start_date"), F.col("_i"), anchor, facts))
    in_range = (F.col("payment_date") <= F.col("_end")) if inclusive_end else (F.col("payment_date") < F.col("_end"))
    # only what numbering and output need crosses the next shuffle
    exp = exp.where((F.col("_i") == 0) | in_range).select(customer, *order[1:], "plan_name", "payment_date", "amount")
    exp = sequence_columns(exp, customer, ["payment_date", *order[1:]], [F.unix_date("payment_date"), tie],
                           row_number="payment_order",
                           lag={"_prev_plan": "plan_name", "_prev_amount": "amount"}, splits=splits,
                           tasks=tasks, dealt=True)
    credit = F.col("_prev_plan").isin(*credit_from) & F.col("plan_name").isin(*credit_to)
    amount = F.when(credit, F.col("amount") - F.col("_prev_amount")).otherwise(F.col("amount"))
    # amount stays DECIMAL so sums over payments are exact; present it with money()
    return exp.select(customer, "plan_id", "plan_name", "payment_date",
                      amount.alias("amount"), "payment_order")


def churn_over(payments: DataFrame, subs: DataFrame, churn_plan: int, extra_plans: Sequence[int],
               customer: str = "customer_id") -> DataFrame:
    """Per calendar month: customers who churned, customers active (paid, or had a row of
    ``extra_plans``), and the ratio. Two hash aggregates: (month, customer) flags, then
    counts per month."""
    acts = (payments.select(F.col("payment_date").alias("d"), "plan_id", customer)
            .unionByName(subs.where(F.col("plan_id").isin(*extra_plans))
                         .select(F.col("start_date").alias("d"), "plan_id", customer)))
    acts = acts.select(F.year("d").alias("year"), F.month("d").alias("month"), "plan_id", customer)
    per = (acts.where(F.col(customer).isNotNull()).groupBy("year", "month", customer)
           .agg(F.max((F.col("plan_id") == churn_plan).cast("int")).alias("_churn")))
    out = per.groupBy("year", "month").agg(F.sum("_churn").cast("bigint").alias("num_churn"),
                                           F.count(F.lit(1)).alias("num_total"))
    return out.select("year", "month", "num_churn", "num_total",
                      ratio("num_churn", "num_total").alias("churn_pct"))
