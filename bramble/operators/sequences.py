"""Order-within-entity operators: strictly-later pair counts, n-th event, as-of state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def time_rank(ts) -> Column:
    """Seconds since 1970-01-01 of a timestamp (NTZ or not), non-decreasing in ``ts`` and
    independent of the session time zone; used to bucket hot keys by time."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    # seconds with their microsecond fraction (EXTRACT SECOND is DECIMAL(8,6)); about
    # 1.7e15 microseconds since 1970, exact in a DOUBLE
    return (F.unix_date(ts.cast("date")).cast("double") * 86400.0
            + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts).cast("double"))


def later_pairs(df: DataFrame, partition: str, time: str, first: Column, then: Column,
                group: Sequence[str] = (), per_partition: bool = False, **split_kw) -> DataFrame:
    """Count (A, B) pairs with A matching ``first``, B matching ``then``, same
    ``partition`` and B strictly later than A. Per ``group`` (columns of the A rows):
    ``a_rows`` (number of A rows) and ``pairs``.

    Same result as the self-join A JOIN B ON partition AND b.time > a.time, without the
    join: A and B rows are first aggregated to (partition, time[, group]) with map-side
    combine; then, for each time, B strictly later = B total - B at or before it (RANGE
    frame, equal times are not later). A partition holding a large share of the rows is
    split into time buckets (:func:`bramble.operators.skew.later_sums`).

    With ``per_partition`` the counts are distinct partitions instead: ``a_rows`` =
    partitions with an A row, ``pairs`` = partitions with an A row followed by a B row.
    """
    from bramble.operators.skew import later_sums
    group = list(group)
    a = (df.where(first).groupBy(partition, time, *group)
         .agg(F.count(F.lit(1)).alias("_ac")).withColumn("_bc", F.lit(0).cast("bigint")))
    b = (df.where(then).groupBy(partition, time)
         .agg(F.count(F.lit(1)).alias("_bc")).withColumn("_ac", F.lit(0).cast("bigint")))
    for g in group:
        b = b.withColumn(g, F.lit(None).cast(df.schema[g].dataType))
    u = later_sums(a.unionByName(b), partition, time, time_rank(time), {"_later": "_bc"}, **split_kw)
    res = u.where(F.col("_ac") > 0)
    if per_partition:
        # distinct partitions with an A row, and with an A row followed by a later B row
        flags = res.groupBy(*group, partition).agg(F.max((F.col("_later") > 0).cast("int")).alias("_f"))
        aggs = [F.count(F.lit(1)).alias("a_rows"), F.coalesce(F.sum("_f"), F.lit(0)).cast("bigint").alias("pairs")]
        return flags.groupBy(*group).agg(*aggs) if group else flags.agg(*aggs)
    aggs = [F.sum("_ac").cast("bigint").alias("a_rows"),
            F.coalesce(F.sum(F.col("_ac") * F.col("_later")), F.lit(0)).cast("bigint").alias("pairs")]
    return res.groupBy(*group).agg(*aggs) if group else res.agg(*aggs)


def nth_in_order(df: DataFrame, key: str, order: Sequence[str], n: int,
                 carry: Sequence[str] = ()) -> DataFrame:
    """The n-th row per ``key`` in ascending ``order`` (order columns must make rows
    unique, e.g. end with a row id): ROW_NUMBER() ... = n.

    ``row_number() == n``: Spark keeps at most n rows per key and input task before the
    shuffle (partial WindowGroupLimit), so a key holding a large share of the rows brings
    n rows a task to its window, and the input is read once.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    order, carry = list(order), list(carry)
    w = Window.partitionBy(key).orderBy(*order)
    return (df.select(key, *order, *carry).withColumn("_rn", F.row_number().over(w))
            .where((F.col("_rn") <= n) & (F.col("_rn") == n)).drop("_rn"))


def last_as_of(df: DataFrame, key: str, order: Sequence[str], as_of_col: str, as_of,
               carry: Sequence[str] = ()) -> DataFrame:
    """Latest row per key with ``as_of_col <= as_of`` (MAX of a struct; one aggregate)."""
    order, carry = list(order), list(carry)
    st = F.struct(*[F.col(c) for c in order + carry])
    return (df.where(F.col(as_of_col) <= F.lit(as_of)).groupBy(key).agg(F.max(st).alias("_m"))
            .select(key, *[F.col(f"_m.{c}").alias(c) for c in order + carry]))


def time_since_first(df: DataFrame, key: str, date: str, pred: Column, alias: str = "days") -> DataFrame:
    """Rows matching ``pred`` with the days since their key's first ``date`` (over all
    rows of the key), one per key and date. Both sides of the join are combined first:
    one first date per key, and distinct (key, date) pairs, at most one a day."""
    first = df.groupBy(key).agg(F.min(date).alias("_first"))
    return (df.where(pred).select(key, date).distinct().join(first, key)
            .withColumn(alias, F.datediff(F.col(date), F.col("_first"))).drop("_first"))


def mean_time_since_first(df: DataFrame, key: str, date: str, pred: Column,
                          count_alias: str, mean_alias: str) -> DataFrame:
    """Distinct keys with a row matching ``pred`` and ROUND(AVG(days since the key's first
    date)) over those rows, from one aggregate per key (first date, number and date sum
    of matching rows) and one global aggregate: no join back."""
    per = df.groupBy(key).agg(
        F.unix_date(F.min(date)).alias("_first"),
        F.count(F.when(pred, 1)).alias("_n"),
        F.sum(F.when(pred, F.unix_date(date))).alias("_sum")).where(F.col("_n") > 0)
    days = F.sum(F.col("_sum") - F.col("_n") * F.col("_first"))
    return per.agg(F.count(F.lit(1)).alias(count_alias),
                   F.round(days.cast("double") / F.sum("_n").cast("double")).alias(mean_alias))
