"""Payments by the stated billing rules, against a row-by-row state machine."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from bramble.operators.payment_rules import effective_plans, required_payments

D = dt.date
PRICE = {1: Decimal("9.90"), 2: Decimal("19.90"), 3: Decimal("199.00"), 4: None}
NAME = {0: "trial", 1: "basic monthly", 2: "pro monthly", 3: "pro annual", 4: "churn"}
SMALL = dict(min_hot_rows=8, rows_per_bucket=4, fanout=3)


def _frames(spark, rows):
    subs = spark.createDataFrame([(c, p, s, i) for i, (c, p, s) in enumerate(rows)],
                                 "customer_id long, plan_id int, start_date date, sub_id long")
    plans = spark.createDataFrame([(p, NAME[p], PRICE.get(p)) for p in NAME], "plan_id int, plan_name string, price decimal(18,2)")
    return subs, plans


def _plus(d, months):
    y, m = divmod(d.year * 12 + d.month - 1 + months, 12)
    last = (D(y + (m == 11), (m + 1) % 12 + 1, 1) - dt.timedelta(days=1)).day
    return D(y, m + 1, min(d.day, last))


def _brute(rows, horizon):
    """Day by day per customer: what starts today, then what is due today."""
    out = []
    for c in {r[0] for r in rows}:
        today = {}
        for i, (cc, p, s) in enumerate(rows):
            if cc == c and p:
                today[s] = max(today.get(s, (0, 0)), (p, i))
        if not today:
            continue
        plan = anchor = pending = None
        months, n, day = 0, 0, min(today)
        while day <= horizon:
            first, credit = False, Decimal(0)
            new = today.get(day, (None,))[0]
            if new == 3 and plan == 2:
                if pending is None:
                    k = 0
                    while _plus(anchor, k) < day:
                        k += 1
                    pending = _plus(anchor, k)
            elif new:
                credit = PRICE[1] if plan == 1 and new in (2, 3) else Decimal(0)
                plan, anchor, pending, first, months = new, day, None, True, 0
            if pending == day:
                plan, anchor, pending, first, months = 3, day, None, True, 0
            due = first or (plan in (1, 2) and day == _plus(anchor, months + 1))
            if due and not first:
                months += 1
            if due and PRICE[plan] is not None:
                n += 1
                out.append((c, plan, NAME[plan], day, PRICE[plan] - (credit if first else 0), n))
            day += dt.timedelta(days=1)
    return out


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=str)


def _paid(spark, rows, horizon=D(2020, 12, 31), **kw):
    subs, plans = _frames(spark, rows)
    return _sorted(required_payments(subs, plans, F.lit(horizon), **kw).collect())


def test_each_rule(spark):
    one = lambda *rows: [(r[2], r[3], r[4]) for r in _paid(spark, [(1, *r) for r in rows], D(2020, 4, 30))]
    # the same day of the month as the start
    assert [str(d) for _, d, _ in one((1, D(2020, 1, 31)))] == ["2020-01-31", "2020-02-29", "2020-03-31", "2020-04-30"]
    # basic to pro: at once, reduced, then the full price
    assert one((1, D(2020, 1, 10)), (2, D(2020, 2, 20))) == [
        ("basic monthly", D(2020, 1, 10), PRICE[1]), ("basic monthly", D(2020, 2, 10), PRICE[1]),
        ("pro monthly", D(2020, 2, 20), Decimal("10.00")), ("pro monthly", D(2020, 3, 20), PRICE[2]), ("pro monthly", D(2020, 4, 20), PRICE[2])]
    # pro monthly to annual: at the period's end, in full
    assert one((2, D(2020, 1, 10)), (3, D(2020, 1, 20))) == [("pro monthly", D(2020, 1, 10), PRICE[2]), ("pro annual", D(2020, 2, 10), PRICE[3])]
    # nothing is paid on the day of the churn
    assert one((1, D(2020, 1, 15)), (4, D(2020, 3, 15))) == [("basic monthly", D(2020, 1, 15), PRICE[1]), ("basic monthly", D(2020, 2, 15), PRICE[1])]
    # a churn cancels the pending upgrade, a repeated upgrade does not pay twice
    assert one((2, D(2020, 1, 10)), (3, D(2020, 1, 20)), (4, D(2020, 2, 1))) == [("pro monthly", D(2020, 1, 10), PRICE[2])]
    assert len(one((2, D(2020, 1, 10)), (3, D(2020, 1, 20)), (3, D(2020, 1, 25)), (3, D(2020, 2, 10)))) == 2


def test_random_logs(spark):
    """Dense logs, with rows on one day and customers without a number; hot keys split and not."""
    rnd = random.Random(8)
    rows = [(rnd.choice([0, 0, 0, None, *range(1, 12)]), rnd.choice([0, 1, 2, 2, 3, 3, 4]), D(2019, 1, 1) + dt.timedelta(days=rnd.randint(0, 600)))
            for _ in range(500)]
    want = _sorted(_brute(rows, D(2020, 12, 31)))
    assert len(want) > 300
    assert _paid(spark, rows) == want
    assert _paid(spark, rows, **SMALL) == want


def test_no_rows(spark):
    subs, plans = _frames(spark, [(1, 0, D(2020, 1, 1))])
    assert required_payments(subs, plans, F.lit(D(2020, 12, 31))).count() == 0
    empty = subs.limit(0)
    assert required_payments(empty, plans, empty.agg(F.max("start_date"))).count() == 0
    assert effective_plans(empty, plans).columns == ["customer_id", "plan_id", "plan_name", "price", "since", "credit"]
