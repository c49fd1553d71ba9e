"""Frequent item combinations inside baskets (market-basket co-occurrence counts)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bramble.operators.skew import task_count

CORE_ITEMS = 30
SETS_PER_TASK = 1_000_000


def _items(df: DataFrame, basket: str, item: str) -> DataFrame:
    return df.where(F.col(item).isNotNull()).select(F.col(basket).alias("_b"), F.col(item).alias("item_1")).distinct()


def _cols(k: int) -> list[str]:
    return [f"item_{j}" for j in range(1, k + 1)]


def _grow(sets: DataFrame, size: int, tasks: dict[int, int] | None = None) -> DataFrame:
    """Sets one item larger: two sets of a basket that agree on all items but the last. The
    join key is (basket, all items but the last), so a basket's work spreads over tasks as
    soon as sets have two items. ``tasks`` (:func:`_tasks`) deals the sets by the number of
    larger ones that come of them."""
    same = _cols(size - 1)
    if tasks:
        sets = sets.repartition(tasks[size], "_b", *same)
    nxt = sets.select("_b", *same, F.col(f"item_{size}").alias(f"item_{size + 1}"))
    return sets.join(nxt, ["_b", *same]).where(F.col(f"item_{size}") < F.col(f"item_{size + 1}")).select("_b", *_cols(size + 1))


def _tasks(items: DataFrame, k: int, per_task: int) -> dict[int, int]:
    """Per size, the tasks in which sets of that size grow: about ``per_task`` sets come out of
    each. A task's join and its counts hold what it makes, and the bytes that it reads do not
    tell how much that is. The number of sets follows from the basket sizes; the larger ones of
    a basket with very many items mostly fail on their parts, so at most 16 a set are counted."""
    n = F.col("_n").cast("double")
    sets, made = n, [F.sum(n)]
    for size in range(2, k + 1):
        sets = sets * F.greatest(n - (size - 1), F.lit(0.0)) / size
        made.append(F.sum(sets))
    made = [x or 0 for x in items.groupBy("_b").agg(F.count(F.lit(1)).alias("_n")).agg(*made).first()]
    return {size: task_count(items, min(made[size], 16 * made[size - 1]), per_task) for size in range(1, k)}


def _enumerate(items: DataFrame, k: int, tasks: dict[int, int] | None = None) -> DataFrame:
    sets = items
    for size in range(1, k):
        sets = _grow(sets, size, tasks)
    return sets


def basket_combinations(df: DataFrame, basket: str, item: str, k: int = 3) -> DataFrame:
    """Number of distinct baskets containing each set of ``k`` distinct items.

    Output ``item_1 .. item_k`` (ascending, so each set appears once) and ``baskets``.
    Counting unordered sets instead of the k! orderings of a literal self-join gives the
    same counts with k! times fewer rows. Every set of every basket is produced, so use
    :func:`top_basket_combinations` when only the most frequent sets are wanted.
    """
    items = _items(df, basket, item)
    return _enumerate(items, k, _tasks(items, k, SETS_PER_TASK)).groupBy(*_cols(k)).agg(F.count(F.lit(1)).alias("baskets"))


def top_basket_combinations(df: DataFrame, basket: str, item: str, n: int, k: int = 3,
                            core_items: int = CORE_ITEMS, sets_per_task: int = SETS_PER_TASK) -> DataFrame:
    """The ``n`` most frequent k-item sets (count desc, then item ids asc), exact; one plan
    for baskets of any size.

    * The sets among the ``core_items`` most frequent items are counted exactly (a basket
      has at most that many of them). The n-th largest of these counts, ``least``, is a lower
      bound of the true n-th largest; 1 if there are fewer than n sets.
    * With t = max(least, 2): items in fewer than t baskets are dropped everywhere, then
      sets grow by one item at a time, and at each size those in fewer than t baskets are
      dropped before the next (a set is never more frequent than its parts).
    * Sets of one basket only can rank when ``least`` is 1. Of those, only the first n of a
      basket in id order can, and they lie among its n + k - 1 smallest items.

    So a basket with very many items adds only sets that other baskets share, and its sets
    are spread over tasks by (basket, leading items), about ``sets_per_task`` to a task.
    """
    cols = _cols(k)
    rank = [F.col("baskets").desc(), *cols]
    items = _items(df, basket, item)
    support = items.groupBy("item_1").agg(F.count(F.lit(1)).alias("_s"))
    core = support.orderBy(F.col("_s").desc(), "item_1").limit(core_items).select("item_1")
    counted = (_enumerate(items.join(F.broadcast(core), "item_1", "left_semi"), k)  # core_items rows
               .groupBy(*cols).agg(F.count(F.lit(1)).alias("baskets")))
    # one number, taken when the query is built, so that the plan below stays small
    least = counted.orderBy(*rank).limit(n).agg(F.when(F.count(F.lit(1)) >= n, F.min("baskets"))).first()[0] or 1
    t = max(least, 2)

    def frequent(sets: DataFrame, size: int) -> DataFrame:
        counts = sets.groupBy(*_cols(size)).agg(F.count(F.lit(1)).alias("baskets"))
        return counts.where(F.col("baskets") >= t)

    tasks = _tasks(items, k, sets_per_task)
    sets = items
    for size in range(1, k):
        sets = _grow(sets.join(frequent(sets, size).drop("baskets"), _cols(size), "left_semi"), size, tasks)
    best = frequent(sets, k).orderBy(*rank).limit(n)
    if least == 1:  # sets of one basket can rank
        by_id = Window.partitionBy("_b").orderBy("item_1")
        smallest = items.withColumn("_r", F.row_number().over(by_id)).where(F.col("_r") <= n + k - 1).drop("_r")
        single = _enumerate(smallest, k, tasks).select(*cols).distinct().orderBy(*cols).limit(n)
        # a set of both kinds keeps its full count
        best = (best.unionByName(single.withColumn("baskets", F.lit(1).cast("bigint")))
                .groupBy(*cols).agg(F.max("baskets").alias("baskets")).orderBy(*rank).limit(n))
    return best
