"""Clickstream operators: product funnel, ordered concatenation, conversion metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bramble.functions.columns import ratio
from bramble.operators.skew import add_buckets, hot_splits


def funnel(events: DataFrame, item: Sequence[str], visit: str, view: Column, add: Column,
           purchase_event: Column, all_events: DataFrame) -> DataFrame:
    """Per item: visits that viewed it, added it, added it without buying, bought it.

    "Bought" means: added in a visit that has any purchase event (the visit-level
    purchase flag, no time order). ``events`` are the item-page events, ``all_events``
    every event (for the purchase flag). Steps, all hash aggregates with map-side
    combine: flags per (item, visit); purchase flag per visit; one join on visit; counts
    per item.
    """
    item = list(item)
    per_iv = events.groupBy(*item, visit).agg(F.max(view.cast("int")).alias("_view"),
                                              F.max(add.cast("int")).alias("_add"))
    bought = (all_events.groupBy(visit).agg(F.max(purchase_event.cast("int")).alias("_paid"))
              .where(F.col("_paid") == 1))
    flagged = (per_iv.join(bought, visit, "left")
               .withColumn("_purchase", (F.col("_add") == 1) & F.col("_paid").eqNullSafe(1)))
    # counted by all item columns first: a hash aggregate, which MAX of a text is not
    counts = flagged.groupBy(*item).agg(
        F.count(F.when(F.col("_view") == 1, F.lit(1))).alias("views"),
        F.count(F.when(F.col("_add") == 1, F.lit(1))).alias("cart_adds"),
        F.count(F.when((F.col("_add") == 1) & ~F.col("_purchase"), F.lit(1))).alias("abandoned"),
        F.count(F.when(F.col("_purchase"), F.lit(1))).alias("purchases"))
    key, rest = item[0], item[1:]
    return counts.groupBy(key).agg(*[F.max(c).alias(c) for c in rest],
                                   *[F.sum(c).alias(c) for c in ("views", "cart_adds", "abandoned", "purchases")])


def ordered_concat(df: DataFrame, by: Sequence[str] | str, values: dict[str, Column], order: Sequence[str],
                   ranks: Sequence[Column], sep: str, **split_kw) -> DataFrame:
    """GROUP_CONCAT(value ORDER BY order SEPARATOR sep) per group, for each of ``values``; NULL
    values are left out, and a group without any has NULL.

    A group with very many rows is cut into slices along the order (``ranks``: the leading
    order columns as numbers, see :mod:`bramble.operators.skew`); each slice is sorted and
    joined to text by itself, then the slices' texts are joined in order."""
    by = [by] if isinstance(by, str) else list(by)
    keyed = df.withColumn("_key", F.struct(*by))
    splits = hot_splits(keyed, "_key", ranks, **split_kw)

    def text(sorted_rows: str, field: str) -> Column:
        some = F.filter(F.transform(F.col(sorted_rows), lambda x: x[field]), lambda v: v.isNotNull())
        return F.when(F.size(some) > 0, F.array_join(some, sep))

    one = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                   *[v.cast("string").alias(f"_v_{a}") for a, v in values.items()])
    if not splits:
        return (df.groupBy(*by).agg(F.array_sort(F.collect_list(one)).alias("_rows"))
                .select(*by, *[text("_rows", f"_v_{a}").alias(a) for a in values]))
    rows = add_buckets(keyed, "_key", ranks, splits)
    slices = (rows.groupBy("_key", "_b").agg(F.array_sort(F.collect_list(one)).alias("_rows"))
              .select("_key", F.struct("_b", *[text("_rows", f"_v_{a}").alias(f"_v_{a}") for a in values]).alias("_slice")))
    whole = slices.groupBy("_key").agg(F.array_sort(F.collect_list("_slice")).alias("_slices"))
    return whole.select("_key.*", *[text("_slices", f"_v_{a}").alias(a) for a in values])


def conversion_metrics(df: DataFrame, by: Sequence[str], user: str, visit: str,
                       steps: dict[str, str], means: dict[str, str],
                       rates: dict[str, tuple[str, str]], apart: bool = False) -> DataFrame:
    """Per group: distinct users, distinct visits reaching each step (step column != 0),
    means of count columns, and ratios between step counts.

    Each row counts twice, for its user and for its visit, so one read and one aggregate per
    (group, user or visit) give both the distinct counts and the partial sums of the means (a
    NULL visit forms its own row: it counts for the means, not for the distinct visits).

    ``apart`` groups visits and users apart and joins the groups, for a table bucketed by the
    visit: the visits then need no exchange, and of the users only distinct ones are shuffled.
    """
    if apart:
        return _metrics_apart(df, list(by), user, visit, steps, means, rates)
    by = list(by)
    none = {f"_f_{k}": F.lit(None).cast("int") for k in steps} | {f"_m_{k}": F.lit(None).cast("double") for k in means}
    seen = {f"_f_{k}": F.coalesce(F.col(c) != 0, F.lit(False)).cast("int") for k, c in steps.items()}
    seen |= {f"_m_{k}": F.col(c).cast("double") for k, c in means.items()}

    def row(kind: str, entity: str, values: dict[str, Column]) -> Column:
        return F.struct(F.lit(kind).alias("_kind"), F.col(entity).cast("string").alias("_id"), *[v.alias(n) for n, v in values.items()])

    rows = df.select(*by, F.explode(F.array(row("user", user, none), row("visit", visit, seen))).alias("_r")).select(*by, "_r.*")
    per = rows.groupBy(*by, "_kind", "_id").agg(
        *[F.max(f"_f_{k}").alias(f"_f_{k}") for k in steps],
        *[F.sum(f"_m_{k}").alias(f"_s_{k}") for k in means], *[F.count(f"_m_{k}").alias(f"_n_{k}") for k in means])
    known = F.col("_id").isNotNull()
    out = per.groupBy(*by).agg(
        F.count_if(known & (F.col("_kind") == "user")).alias("user_count"),
        *[F.count_if(known & (F.col(f"_f_{k}") == 1)).alias(k) for k in steps],
        *[(F.sum(f"_s_{k}") / F.when(F.sum(f"_n_{k}") > 0, F.sum(f"_n_{k}")).cast("double")).alias(k) for k in means])
    return out.select(*by, "user_count", *steps, *means,
                      *[ratio(n, d).alias(k) for k, (n, d) in rates.items()])


def _metrics_apart(df: DataFrame, by: list[str], user: str, visit: str, steps: dict[str, str], means: dict[str, str],
                   rates: dict[str, tuple[str, str]]) -> DataFrame:
    per_visit = df.groupBy(*by, visit).agg(
        *[F.max(F.coalesce(F.col(c) != 0, F.lit(False)).cast("int")).alias(f"_f_{k}") for k, c in steps.items()],
        *[F.sum(F.col(c).cast("double")).alias(f"_s_{k}") for k, c in means.items()],
        *[F.count(c).alias(f"_n_{k}") for k, c in means.items()])
    known = F.col(visit).isNotNull()
    visits = per_visit.groupBy(*by).agg(
        *[F.count_if(known & (F.col(f"_f_{k}") == 1)).alias(k) for k in steps],
        *[(F.sum(f"_s_{k}") / F.when(F.sum(f"_n_{k}") > 0, F.sum(f"_n_{k}")).cast("double")).alias(k) for k in means])
    users = df.select(*by, user).distinct().groupBy(*[F.col(c).alias(f"_by_{c}") for c in by]).agg(F.count(user).alias("user_count"))
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return visits.join(users, same).select(*by, "user_count", *steps, *means, *[ratio(n, d).alias(k) for k, (n, d) in rates.items()])
