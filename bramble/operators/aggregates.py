"""Grouped and global aggregates.

Pattern used throughout: when a metric is "distinct entities satisfying a condition",
aggregate to (group, entity) first and then count / sum flags per group. Both steps are
plain hash aggregates with map-side partial aggregation, so a hot group (one key
holding a third of all rows) is pre-combined on every mapper before it is shuffled
(given that no join on that key has dealt its raw rows out before), and no Expand of
several COUNT(DISTINCT ...) is needed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(xs) -> list[str]:
    if xs is None:
        return []
    return [xs] if isinstance(xs, str) else list(xs)


def distinct_flags(df: DataFrame, entity: str, flags: Mapping[str, Column],
                   by: Sequence[str] | str | None = None, total: str | None = "total") -> DataFrame:
    """Per group ``by``: number of distinct ``entity`` values (as ``total``) and, for each
    flag, the number of distinct entities having at least one row where the flag holds.

    Equal to COUNT(DISTINCT entity) and COUNT(DISTINCT CASE WHEN cond THEN entity END).
    """
    by = _cols(by)
    per_entity = (df.where(F.col(entity).isNotNull())
                  .groupBy(*by, entity)
                  .agg(*[F.max(F.coalesce(c, F.lit(False)).cast("int")).alias(n)
                         for n, c in flags.items()]))
    aggs = [F.count(F.lit(1)).alias(total)] if total else []
    aggs += [F.sum(n).cast("bigint").alias(n) for n in flags]
    if by:
        return per_entity.groupBy(*by).agg(*aggs)
    return per_entity.agg(*aggs)


def count_distinct(df: DataFrame, entity: str, by: Sequence[str] | str | None = None,
                   alias: str = "n") -> DataFrame:
    """COUNT(DISTINCT entity) per group, as dedup (group, entity) then count."""
    by = _cols(by)
    dedup = df.where(F.col(entity).isNotNull()).select(*by, entity).distinct()
    if by:
        return dedup.groupBy(*by).agg(F.count(F.lit(1)).alias(alias))
    return dedup.agg(F.count(F.lit(1)).alias(alias))


def avg_of_group(df: DataFrame, group: str, value: Column, by: Sequence[str] | str | None = None,
                 alias: str = "avg", scale: float | None = None) -> DataFrame:
    """Two-level average: aggregate ``value`` per (by, group), then average over groups.

    ``value`` is an aggregate expression (e.g. ``F.sum('gross')``); the mean is computed as
    CAST(SUM(v) AS DOUBLE) [/ scale] / COUNT(v), so decimal inputs stay exact until the one
    final division.
    """
    by = _cols(by)
    inner = df.groupBy(*by, group).agg(value.alias("_v"))
    total = F.sum("_v").cast("double")
    if scale:
        total = total / F.lit(float(scale))
    mean = F.when(F.count("_v") > 0, total / F.count("_v").cast("double"))
    if by:
        return inner.groupBy(*by).agg(mean.alias(alias))
    return inner.agg(mean.alias(alias))


def counts_with_totals(df: DataFrame, key: str, label: str, entity: str,
                       count_alias: str, total_label: str = "TOTAL",
                       distinct_label: str = "TOTAL DISTINCT") -> DataFrame:
    """Distinct entities per key (with a label column), followed by two total rows: all
    rows (COUNT(entity)) and all distinct entities. Totals come from one aggregate."""
    per_key = (df.where(F.col(entity).isNotNull()).select(key, label, entity).distinct()
               .groupBy(key).agg(F.max(label).alias(label), F.count(F.lit(1)).alias(count_alias))
               .select(label, count_alias))
    rows = df.agg(F.count(entity).alias("_rows"))
    dist = count_distinct(df, entity, alias="_dist")
    totals = rows.crossJoin(F.broadcast(dist)).select(
        F.explode(F.array(
            F.struct(F.lit(total_label).alias(label), F.col("_rows").alias(count_alias)),
            F.struct(F.lit(distinct_label).alias(label), F.col("_dist").alias(count_alias)),
        )).alias("t")).select("t.*")
    return per_key.unionByName(totals)


_PERIODS = {"month": F.month, "year": F.year, "day": F.dayofmonth, "quarter": F.quarter}


def distinct_by_period(df: DataFrame, ts: str, entity: str, period: str = "month",
                       alias: str = "n") -> DataFrame:
    """COUNT(DISTINCT entity) per calendar part of ``ts`` (MONTH(ts) etc., all years
    together, like GROUP BY MONTH(ts)); the period column is named after ``period``."""
    return count_distinct(df.withColumn(period, _PERIODS[period](ts)), entity, by=period, alias=alias)


def count_by_lookup(df: DataFrame, key: str, lookup: DataFrame, name: str, counted: str,
                    alias: str) -> DataFrame:
    """COUNT(counted) per ``lookup.name`` after a left join on ``key``. Counted per key
    first, so the lookup joins one row per key (broadcast where Spark finds it small), then
    summed per name."""
    per_key = df.groupBy(key).agg(F.count(counted).alias("_n"))
    return (per_key.join(lookup.select(key, name), key, "left")
            .groupBy(name).agg(F.sum("_n").cast("bigint").alias(alias)))


def conditional_counts(df: DataFrame, by: Sequence[str] | str, counts: Mapping[str, Column],
                       value: str | None = None) -> DataFrame:
    """COUNT(CASE WHEN cond THEN value END) per group for each named condition."""
    v = F.col(value) if value else F.lit(1)
    return df.groupBy(*_cols(by)).agg(*[F.count(F.when(c, v)).alias(n) for n, c in counts.items()])


def distinct_share(df: DataFrame, entity: str, pred: Column, count_alias: str, pct_alias: str) -> DataFrame:
    """Distinct entities with a row matching ``pred`` and their share of all distinct
    entities, as ROUND(100 * part / whole, 1) half up."""
    from bramble.functions.columns import pct1
    flags = distinct_flags(df, entity, {count_alias: pred}, total="_all")
    return flags.select(count_alias, pct1(count_alias, "_all").alias(pct_alias))


def bucketize(df: DataFrame, value: str, width: int, entity: str, label_alias: str,
              count_alias: str) -> DataFrame:
    """Histogram of ``value`` in bins of ``width`` (bin b covers b*width .. b*width+width-1,
    labelled 'lo-hi days'), counting distinct ``entity`` per bin."""
    binned = df.withColumn("_bin", F.floor(F.col(value) / F.lit(width)).cast("bigint"))
    per = count_distinct(binned, entity, by="_bin", alias=count_alias)
    label = F.concat((F.col("_bin") * width).cast("string"), F.lit("-"),
                     (F.col("_bin") * width + width - 1).cast("string"), F.lit(" days"))
    return per.select(label.alias(label_alias), count_alias)
