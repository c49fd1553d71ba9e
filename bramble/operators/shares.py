"""Shares of a parent total and of the grand total, and basket penetration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bramble.functions.columns import ratio


def _cols(xs) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


def share_of_parent(df: DataFrame, parent: Sequence[str] | str, measure: str,
                    alias: str = "share") -> DataFrame:
    """``df`` holds one row per (parent, child) with an additive ``measure``; adds
    measure / SUM(measure) over the parent.

    The parent totals come from a separate hash aggregate joined back on the parent key
    (no window over the parent): a parent holding most children is pre-aggregated on the
    mappers, and the join either broadcasts the totals (AQE sees their real size) or is
    split by AQE's skew-join handling. No window gathers a whole parent into one task.
    """
    parent = _cols(parent)
    totals = df.groupBy(*parent).agg(F.sum(measure).alias("_parent_total"))
    if not parent:
        joined = df.crossJoin(F.broadcast(totals))
    else:  # null-safe: rows without a parent share one NULL parent, as a window would
        tot = totals.select(*[F.col(p).alias(f"_p_{p}") for p in parent], "_parent_total")
        cond = [df[p].eqNullSafe(tot[f"_p_{p}"]) for p in parent]
        joined = df.join(tot, cond, "left").drop(*[f"_p_{p}" for p in parent])
    return joined.withColumn(alias, ratio(F.col(measure), F.col("_parent_total"))).drop("_parent_total")


def share_of_total(df: DataFrame, measure: str, alias: str = "share",
                   total: DataFrame | None = None) -> DataFrame:
    """measure / grand total. The total is a one-row aggregate (of ``df`` unless another
    one-row frame is given) attached by a broadcast cross join: its size is one row."""
    if total is None:
        total = df.agg(F.sum(measure).alias("_grand_total"))
    else:
        total = total.toDF("_grand_total")
    return (df.crossJoin(F.broadcast(total))
            .withColumn(alias, ratio(F.col(measure), F.col("_grand_total"))).drop("_grand_total"))
