"""Interval lookup against a scan of the calendar, at several tree heights and at a million intervals."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bramble.operators.intervals import attribute_interval


def first(intervals, x):
    found = [(s, n is not None, n or "", n) for n, s, e in intervals if x is not None and s is not None and e is not None and s <= x <= e]
    return min(found)[3] if found else None


@pytest.mark.parametrize("n", [0, 1, 3, 8, 9, 60, 400])
def test_equals_scan_at_every_height(spark, n):
    rnd = random.Random(n)
    calendar = []
    for i in range(n):
        s = rnd.randrange(0, 3 * n + 3)
        calendar.append((rnd.choice([None, f"c{i % 7}", f"c{i}"]), rnd.choice([s, s, s, None]) if i % 11 == 0 else s, s + rnd.choice([0, 1, 2, 5, n, -2])))
    facts = [(i, rnd.choice([None, -1, *range(0, 4 * n + 4)])) for i in range(300)]
    iv = spark.createDataFrame(calendar, "name string, a long, b int")
    df = spark.createDataFrame(facts, "id long, at int")
    got = attribute_interval(df, "at", iv, "name", "a", "b", fanout=8)
    assert got.columns == ["id", "at", "name"]
    assert {(r.id, r.at, r.name) for r in got.collect()} == {(i, x, first(calendar, x)) for i, x in facts}


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_time_types(spark, kind):
    day = dt.datetime(1969, 12, 30)
    calendar = [(f"c{i}", day + dt.timedelta(hours=7 * i), day + dt.timedelta(hours=7 * i + i % 13, microseconds=i)) for i in range(40)]
    facts = [(i, day + dt.timedelta(minutes=37 * i, microseconds=i % 3 - 1)) for i in range(500)]
    if kind == "date":
        calendar = [(n, s.date(), e.date()) for n, s, e in calendar]
        facts = [(i, x.date()) for i, x in facts]
    iv = spark.createDataFrame(calendar, f"name string, a {kind}, b {kind}")
    got = attribute_interval(spark.createDataFrame(facts, f"id long, at {kind}"), "at", iv, "name", "a", "b", fanout=8)
    assert {(r.id, r.name) for r in got.collect()} == {(i, first(calendar, x)) for i, x in facts}


def test_other_types_are_refused(spark):
    iv = spark.createDataFrame([("a", 1.5, 2.5)], "name string, a double, b double")
    with pytest.raises(TypeError, match="double"):
        attribute_interval(iv, "a", iv, "name", "a", "b")


def test_a_million_intervals(spark):
    n, m = 1_000_000, 100_000
    iv = spark.range(n).select(F.col("id").cast("string").alias("name"), (F.col("id") * 10).alias("a"), (F.col("id") * 10 + F.col("id") % 37).alias("b"))
    df = spark.range(m).select("id", (F.col("id") * 7919 % (10 * n + 1000)).alias("at"))
    got = {r.id: r.name for r in attribute_interval(df, "at", iv, "name", "a", "b").collect()}
    assert len(got) == m
    starts = np.arange(n) * 10
    ends = starts + np.arange(n) % 37
    for i in range(0, m, 7):
        x = i * 7919 % (10 * n + 1000)
        near = [k for k in range(max(0, x // 10 - 4), min(n, x // 10 + 1)) if starts[k] <= x <= ends[k]]
        assert got[i] == (str(near[0]) if near else None), (i, x)


def test_small_calendars_leave_the_facts_where_they_are(spark):
    iv = spark.createDataFrame([("a", 1, 5), ("b", 3, 9)], "name string, a long, b long")
    df = spark.range(100).select("id", (F.col("id") % 12).alias("at"))
    p = attribute_interval(df, "at", iv, "name", "a", "b")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in p and p.count("Join") == 1
