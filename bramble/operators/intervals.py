"""Range join of facts with a calendar of intervals of any size: the first interval that
contains a point.

"First" is the earliest start, then the least name (NULL before others). In that order an
interval is first exactly where no earlier one reaches: from its start, or from behind the
largest end of all intervals before it, to its own end. A running maximum of the ends thus
turns the calendar into disjoint steps, at most one per interval, whatever they overlap.
Facts then look up the last step that starts at or before their point in a search tree: its
nodes are rows of at most ``fanout`` starts, so a level is one equi-join on the node and a
binary search in its array. No fact meets more than one candidate, so nothing is aggregated or
deduplicated behind the join.

Cost. A calendar of up to ``fanout`` intervals is one row, which is broadcast (its size is
bounded by ``fanout``): facts are not shuffled. A larger one is sorted by range once and
written; its root node is broadcast (one row again), and the nodes below meet the facts by an
equi-join, which Spark broadcasts where the table's size allows it and else shuffles by node,
with AQE splitting nodes that many facts fall into. The running maximum and the numbering go
over the sort's partitions with one small carry per partition.

Counting the calendar is a Spark action taken while the query is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bramble.operators.skew import bind
from bramble.sources.shared import stored

FANOUT = 1024
_DAY = 86_400_000_000


def point(column: str, schema: T.StructType) -> Column:
    """Whole number that orders like the column: microseconds of dates and timestamps, the
    value of integers."""
    kind, c = schema[column].dataType, F.col(column)
    if isinstance(kind, T.IntegralType):
        return c.cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long") * _DAY
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        seconds = F.unix_date(c.cast("date")).cast("long") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60
        return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")
    raise TypeError(f"{column}: intervals need dates, timestamps or integers, not {kind.simpleString()}")


def _steps(ranked: DataFrame, part: list[str], carry: Column) -> DataFrame:
    """(_lo, _e, _name) where each interval is first, from intervals in their order."""
    before = F.max("_e").over(Window.partitionBy(*part).orderBy("_s", F.col("_name").asc_nulls_first())
                              .rowsBetween(Window.unboundedPreceding, -1))
    reach = F.greatest(before, carry)
    return (ranked.withColumn("_reach", reach).where(F.col("_reach").isNull() | (F.col("_e") > F.col("_reach")))
            .withColumn("_lo", F.greatest("_s", F.col("_reach") + 1)))


def _numbered(steps: DataFrame) -> DataFrame:
    """``steps`` with ``_r`` = 0, 1, 2 .. in order, by counts per sort partition."""
    offset = (steps.groupBy("_p").agg(F.count(F.lit(1)).alias("_c"))
              .select("_p", (F.sum("_c").over(Window.orderBy("_p")) - F.col("_c")).alias("_off")))
    local = F.row_number().over(Window.partitionBy("_p").orderBy("_m"))
    return steps.join(offset, "_p").withColumn("_r", F.col("_off") + local - 1)


def _at_or_before(starts: Column, x: Column, fanout: int, field: str | None = None) -> Column:
    """Number of sorted ``starts`` that are <= x, by binary search; 0 where either is NULL."""
    size = F.size(starts)

    def start(i: Column) -> Column:
        item = F.get(starts, i)
        return item[field] if field else item

    jumps = F.array(*[F.lit(1 << j) for j in range(fanout.bit_length(), -1, -1)])
    return bind(x, lambda v: F.aggregate(
        jumps, F.lit(0), lambda n, jump: F.when((n + jump <= size) & (start(n + jump - 1) <= v), n + jump).otherwise(n)))


def attribute_interval(df: DataFrame, at: str, intervals: DataFrame, name: str, start: str, end: str,
                       fanout: int = FANOUT) -> DataFrame:
    """``df`` and the ``name`` of the first interval whose [start, end] (inclusive) contains
    ``at``, NULL where none does. Intervals with a NULL bound or an end before their start
    contain nothing; an empty calendar gives NULL everywhere."""
    x = point(at, df.schema)
    own = intervals.select(point(start, intervals.schema).alias("_s"), point(end, intervals.schema).alias("_e"), F.col(name).alias("_name"))
    own = own.where("_s <= _e").groupBy("_s", "_name").agg(F.max("_e").alias("_e"))
    entry = F.struct(F.col("_lo").alias("lo"), F.col("_e").alias("e"), F.col("_name").alias("name"))
    if own.limit(fanout + 1).count() <= fanout:
        levels = [_steps(own, [], F.lit(None).cast("long")).agg(F.array_sort(F.collect_list(entry)).alias("_entries"))]
    else:
        ranked = stored(own.orderBy("_s", F.col("_name").asc_nulls_first()).withColumn("_m", F.monotonically_increasing_id()), "intervals")
        ranked = ranked.withColumn("_p", F.shiftright("_m", 33))  # the partition of the sort
        carry = ranked.groupBy("_p").agg(F.max("_e").alias("_top")).select(
            "_p", F.max("_top").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
        steps = stored(_steps(ranked.join(carry, "_p"), ["_p"], F.col("_carry")).select("_lo", "_e", "_name", "_p", "_m"), "interval-steps")
        numbered = _numbered(steps)
        leaf = numbered.groupBy(F.floor(F.col("_r") / fanout).cast("long").alias("_node")).agg(F.array_sort(F.collect_list(entry)).alias("_entries"))
        levels, nodes = [stored(leaf, "interval-leaves")], -(-steps.count() // fanout)
        while nodes > 1:  # one row per node of the level above, up to a single root
            below = levels[-1]
            first = F.col("_entries")[0]["lo"] if len(levels) == 1 else F.col("_starts")[0]
            above = below.groupBy(F.floor(F.col("_node") / fanout).cast("long").alias("_up")).agg(F.array_sort(F.collect_list(first)).alias("_starts"))
            levels.append(stored(above.withColumnRenamed("_up", "_node"), "interval-nodes"))
            nodes = -(-nodes // fanout)
        levels[-1] = levels[-1].drop("_node")
    d = df.withColumn("_at", x)
    for k, level in enumerate(reversed(levels)):
        if k == 0:
            d = d.crossJoin(F.broadcast(level))  # the root: one row
        else:
            d = d.join(level.withColumnRenamed("_node", "_child"), F.col("_go") == F.col("_child"), "left").drop("_child")
        if "_starts" in level.columns:
            found = _at_or_before(F.col("_starts"), F.col("_at"), fanout) - 1
            parent = F.col("_go") * fanout if k else F.lit(0).cast("long")
            d = d.withColumn("_next", F.when(found >= 0, parent + found)).drop("_starts", "_go").withColumnRenamed("_next", "_go")
    hit = F.get(F.col("_entries"), _at_or_before(F.col("_entries"), F.col("_at"), fanout, "lo") - 1)
    return (d.withColumn("_hit", hit).select(*df.columns, F.when(F.col("_at") <= F.col("_hit")["e"], F.col("_hit")["name"]).alias(name)))
