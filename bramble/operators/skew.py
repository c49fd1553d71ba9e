"""Ordered per-key computations (row number, previous / next row, sums over later rows)
that stay parallel when one key holds a large share of all rows.

A plain ``Window.partitionBy(key)`` sorts every key inside one task; a key with a third of
the data would then run on one core. So the rows per key are counted once (one hash aggregate
that reads the key only, a Spark action taken while the query is built). Where no key is above
``min_hot_rows`` the plain window is the plan. Else rows get a bucket ``_b`` that follows the
window order, and windows run on ``(key, _b)``:

* the splitters of a hot key are quantiles of its ordering value, about one per
  ``rows_per_bucket`` rows and ``fanout`` at most;
* rows strictly between two splitters share an even bucket, rows equal to a splitter an odd
  one. Buckets that are still hot are split again, level by level, until none is: an even one
  by the same value, an odd one, which holds one value only (a cluster of ties), by the next
  ordering value, e.g. the row id. So no key is too large, and only rows that tie in all
  ordering values stay together;
* splitters are written to the shared folder, N / ``rows_per_bucket`` numbers in all; Spark
  broadcasts them where their size allows it and else joins on (key, bucket);
* a summary per (key, bucket) (count, first row, last row, sums) with a small window per key
  repairs what crosses bucket edges: row-number offsets, previous row of a bucket's first
  row, next row of its last row, sums of later buckets. Both the windows and the summary
  read the same exchange on (key, bucket), so the input plan runs once for both.

Ordinary keys have the one bucket 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bramble.sources.shared import stored

MIN_HOT_ROWS = 1_000_000
ROWS_PER_BUCKET = 200_000
FANOUT = 1023
_GRID = 1024
_RADIX = 2 * _GRID
_LEVELS = 5  # of 11 bits each in a bucket number; five levels hold 10^15 buckets a key


def task_count(df: DataFrame, rows: float, per_task: int) -> int:
    """Tasks for an exchange after which ``rows`` rows are made, about ``per_task`` in each.
    Spark sizes tasks by the bytes they read, which do not tell what a task makes of them."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-int(rows) // per_task))


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _part(splits: str, rank: Column) -> Column:
    """Bucket of ``rank`` among sorted splitters: 2 * (splitters below) + (is one itself), by
    binary search."""
    size, at = F.size(splits), lambda i: F.get(splits, i)
    jumps = F.array(*[F.lit(1 << j) for j in range(9, -1, -1)])

    def search(x: Column) -> Column:
        below = F.aggregate(jumps, F.lit(0), lambda p, step: F.when((p + step <= size) & (at(p + step - 1) < x), p + step).otherwise(p))
        return bind(below, lambda b: 2 * b + F.coalesce((at(b) == x).cast("int"), F.lit(0)))

    return F.coalesce(bind(rank, search), F.lit(0)).cast("long")


def _start(df: DataFrame) -> DataFrame:
    return df.withColumns({"_b": F.lit(0).cast("long"), "_j": F.lit(0), "_hot": F.lit(False)})


def _into(df: DataFrame, key: str, level: DataFrame, ranks: Sequence[Column]) -> DataFrame:
    """``df`` (with _b, _j, _hot) one level deeper; rows of buckets without splitters get part
    0. ``_j`` numbers the ordering value that would split the bucket next."""
    lv = level.select(F.col(key).alias("_hk"), F.col("_b").alias("_hb"), "_s")
    d = df.join(lv, F.col(key).eqNullSafe(F.col("_hk")) & (F.col("_b") == F.col("_hb")), "left")
    rank = F.get(F.array(*[r.cast("double") for r in ranks]), F.col("_j"))
    d = d.withColumn("_part", F.when(F.col("_s").isNotNull(), _part("_s", rank)).otherwise(F.lit(0).cast("long")))
    keep = [c for c in df.columns if c not in ("_b", "_j", "_hot")]
    return d.select(*keep, (F.col("_b") * _RADIX + F.col("_part")).alias("_b"), (F.col("_j") + (F.col("_part") % 2).cast("int")).alias("_j"),
                    (F.col("_hot") | F.col("_s").isNotNull()).alias("_hot"))


def hot_splits(df: DataFrame, key: str, ranks: Sequence[Column], min_hot_rows: int = MIN_HOT_ROWS,
               rows_per_bucket: int = ROWS_PER_BUCKET, fanout: int = FANOUT) -> list[DataFrame]:
    """Splitters (key, _b, _s) of the hot keys, one frame per level of the tree; none where no
    key is hot. ``ranks`` is the window order, outermost first, all numeric."""
    names = [f"_r{j}" for j in range(len(ranks))]
    d = _start(df.select(key, *[r.cast("double").alias(n) for r, n in zip(ranks, names)]))
    levels: list[DataFrame] = []
    while len(levels) < _LEVELS:
        open_ = d.where(F.col("_j") < len(names))
        hot = open_.groupBy(key, "_b").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > min_hot_rows)
        hot = stored(hot.select(F.col(key).alias("_hk"), F.col("_b").alias("_hb"), "_n"), "hot-keys")
        if hot.isEmpty():
            break
        rows = open_.join(hot, F.col(key).eqNullSafe(F.col("_hk")) & (F.col("_b") == F.col("_hb")))
        value = F.get(F.array(*names), F.col("_j"))
        grid = rows.groupBy(key, "_b").agg(
            F.max("_n").alias("_n"), F.percentile_approx(value, [i / _GRID for i in range(1, _GRID)], 10_000).alias("_q"))
        wanted = F.least(F.lit(fanout), F.ceil(F.col("_n") / rows_per_bucket)).cast("int")
        picked = F.transform(F.sequence(F.lit(1), wanted), lambda i: F.get(
            "_q", F.floor(i * F.lit(_GRID) / (wanted + 1)).cast("int") - 1))
        levels.append(stored(grid.select(key, "_b", F.array_distinct(picked).alias("_s")), "splitters"))
        # only rows of split buckets can be hot again; their numbers are written, so that the
        # next count and quantiles need not find the buckets anew
        d = stored(_into(rows.select(key, *names, "_b", "_j", "_hot"), key, levels[-1], [F.col(n) for n in names]), "hot-rows")
    return levels


def add_buckets(df: DataFrame, key: str, ranks: Sequence[Column], splits: list[DataFrame] | None = None,
                **split_kw) -> DataFrame:
    """``df`` plus ``_b`` (bucket inside the key, non-decreasing along ``ranks``) and ``_hot``
    (the key was split). ``splits`` may come from a cheaper frame with the same keys."""
    splits = hot_splits(df, key, ranks, **split_kw) if splits is None else splits
    d = _start(df)
    for level in splits:
        d = _into(d, key, level, ranks)
    return d.drop("_j")


def sequence_columns(df: DataFrame, key: str, order: Sequence[str], ranks: Sequence[Column], *,
                     row_number: str | None = None, lag: dict[str, str] | None = None,
                     lead: dict[str, str] | None = None, splits: list[DataFrame] | None = None,
                     tasks: int | None = None, dealt: bool = False, **split_kw) -> DataFrame:
    """ROW_NUMBER / LAG(col) / LEAD(col) over (PARTITION BY key ORDER BY order), hot keys
    split into buckets. ``order`` must be a total order inside a key (end it with a row
    id); ``ranks`` are the leading order columns as numbers. ``lag`` / ``lead`` map output
    column -> source column. ``tasks`` sets the number of tasks that the windows run in, where
    the rows multiply after them (:func:`task_count`); ``dealt``: where no key is hot, ``df``
    comes by key in such tasks already."""
    order, lag, lead = list(order), dict(lag or {}), dict(lead or {})
    splits = hot_splits(df, key, ranks, **split_kw) if splits is None else splits
    if not splits:
        df = df.repartition(tasks, key) if tasks and not dealt else df
        w = Window.partitionBy(key).orderBy(*order)
        made = {row_number: F.row_number().over(w).cast("bigint")} if row_number else {}
        made.update({out: F.lag(c).over(w) for out, c in lag.items()})
        made.update({out: F.lead(c).over(w) for out, c in lead.items()})
        return df.select(*[c for c in df.columns if c not in made], *[v.alias(k) for k, v in made.items()])
    # one exchange for the windows and the summary: both read all of its columns, and the
    # summary is cut to hot keys only after its aggregate
    split = add_buckets(df, key, ranks, splits).repartition(*([tasks] if tasks else []), key, "_b")
    whole = F.struct(*[F.col(c) for c in order + [c for c in split.columns if c not in order]])
    summ = (split.groupBy(key, "_b").agg(F.count(F.lit(1)).alias("_cnt"), F.min(whole).alias("_first"),
                                         F.max(whole).alias("_last"), F.max("_hot").alias("_split")).where("_split"))
    ws = Window.partitionBy(key).orderBy("_b")
    summ = summ.select(F.col(key).alias("_hk"), F.col("_b").alias("_hb"),
                       F.coalesce(F.sum("_cnt").over(ws.rowsBetween(Window.unboundedPreceding, -1)),
                                  F.lit(0)).alias("_off"),
                       F.lag("_last").over(ws).alias("_prev_last"),
                       F.lead("_first").over(ws).alias("_next_first"))
    w = Window.partitionBy(key, "_b").orderBy(*order)
    local = {"_rn": F.row_number().over(w), "_more": F.lead(F.lit(1)).over(w).isNotNull()}
    local.update({out: F.lag(src_col).over(w) for out, src_col in lag.items()})
    local.update({out: F.lead(src_col).over(w) for out, src_col in lead.items()})
    d = split.withColumns(local).join(summ, F.col(key).eqNullSafe(F.col("_hk")) & (F.col("_b") == F.col("_hb")), "left")
    fixed = {}
    if row_number:
        fixed[row_number] = (F.col("_rn") + F.coalesce(F.col("_off"), F.lit(0))).cast("bigint")
    fixed.update({out: F.when(F.col("_rn") == 1, F.col("_prev_last")[c]).otherwise(F.col(out))
                  for out, c in lag.items()})
    fixed.update({out: F.when(~F.col("_more"), F.col("_next_first")[c]).otherwise(F.col(out))
                  for out, c in lead.items()})
    keep = [c for c in df.columns if c not in fixed]
    return d.select(*keep, *[v.alias(k) for k, v in fixed.items()])


def later_sums(df: DataFrame, key: str, order: str, rank: Column, sums: dict[str, str],
               **split_kw) -> DataFrame:
    """For every row: SUM(col) over the rows of the same key whose ``order`` value is
    strictly greater (equal values are peers, not later). Hot keys are split by the order
    value only, so peers always share a bucket."""
    splits = hot_splits(df, key, [rank], **split_kw)
    if not splits:
        whole = Window.partitionBy(key)
        seen = whole.orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
        return df.select(*[c for c in df.columns if c not in sums],
                         *[F.coalesce(F.sum(src).over(whole) - F.sum(src).over(seen), F.lit(0)).alias(out) for out, src in sums.items()])
    split = add_buckets(df, key, [rank], splits).repartition(key, "_b")
    part = Window.partitionBy(key, "_b")
    upto = part.orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    d = split.withColumns({out: F.coalesce(F.sum(src).over(part) - F.sum(src).over(upto), F.lit(0))
                           for out, src in sums.items()})
    summ = (split.groupBy(key, "_b").agg(F.max("_hot").alias("_split"), *[F.sum(src).alias(f"_bs_{out}") for out, src in sums.items()])
            .where("_split"))
    after = Window.partitionBy(key).orderBy("_b").rowsBetween(1, Window.unboundedFollowing)
    summ = summ.select(F.col(key).alias("_hk"), F.col("_b").alias("_hb"),
                       *[F.coalesce(F.sum(f"_bs_{out}").over(after), F.lit(0)).alias(f"_after_{out}") for out in sums])
    d = d.join(summ, F.col(key).eqNullSafe(F.col("_hk")) & (F.col("_b") == F.col("_hb")), "left")
    keep = [c for c in df.columns if c not in sums]
    return d.select(*keep, *[(F.col(out) + F.coalesce(F.col(f"_after_{out}"), F.lit(0))).alias(out)
                             for out in sums])
