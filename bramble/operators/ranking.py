"""Ranking operators: top-n, arg-max per group, leaders with ties, nearest-rank percentile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """ORDER BY ... LIMIT n. Spark plans TakeOrderedAndProject: each partition keeps its
    own n best rows, only those reach the final merge. Callers add the key column as a
    last sort key so ties are deterministic."""
    return df.orderBy(*order).limit(n)


def top_per_group(df: DataFrame, group: str, item: str, measure: str,
                  item_alias: str | None = None, measure_alias: str | None = None) -> DataFrame:
    """Arg-max per group: the item with the largest measure (ties: smallest item).

    One hash aggregate of MIN(struct(-measure, item)); partial aggregation keeps one
    candidate per group and partition, so a hot group never gathers in one task.
    """
    best = F.min(F.struct((-F.col(measure)).alias("neg"), F.col(item).alias("item")))
    return (df.groupBy(group).agg(best.alias("_b"))
            .select(group,
                    F.col("_b.item").alias(item_alias or item),
                    (-F.col("_b.neg")).alias(measure_alias or measure)))


def leaders(df: DataFrame, measures: Sequence[tuple[str, str]], label: str = "top",
            keep: Sequence[str] = ()) -> DataFrame:
    """Rows holding the maximum of each measure (ties kept), labelled; one aggregate for
    all maxima, one broadcast one-row cross join, one pass over ``df``."""
    maxima = df.agg(*[F.max(m).alias(f"_max_{m}") for _, m in measures])
    tagged = df.crossJoin(F.broadcast(maxima)).select(
        *keep,
        F.explode(F.array_compact(F.array(*[
            F.when(F.col(m) == F.col(f"_max_{m}"), F.lit(text)) for text, m in measures
        ]))).alias(label))
    return tagged.select(label, *keep)


def nearest_rank(values: DataFrame, value: str, percentiles: Sequence[int],
                 accuracy: int = 10_000, splitters: int = 64) -> DataFrame:
    """Nearest-rank percentile without a global sort.

    For each p the answer is the value at position ROUND(p/100 * N) (1-based, ascending),
    or NULL when that position is 0. Exact, deterministic and lazy:

    1. one aggregate sketches the quantiles just below and above each p (``accuracy`` bounds
       the rank error by N / accuracy, so the answer lies between them);
    2. one aggregate counts the values below the lower one; what lies between is a slice of
       about 4 N / accuracy rows, and the position inside it is known;
    3. the slice's own quantiles, ``splitters`` of them, cut it into parts whose counts tell
       which one holds the position;
    4. in that part the distinct values are counted and ranked.

    All cuts follow the data, so outliers and clusters don't matter. Windows run over at
    most ``splitters`` + 1 counts per percentile, and over the distinct values of one part:
    a millionth of the data or so. Returns rows (percentile INT, value) for every p.
    """
    v = values.where(F.col(value).isNotNull()).select(
        F.col(value).alias("_val"), F.col(value).cast("double").alias("_d"))
    ps = sorted({int(p) for p in percentiles})
    pct = values.sparkSession.createDataFrame(
        [(p,) for p in ps], T.StructType([T.StructField("percentile", T.IntegerType())]))
    # below and above by three times the sketch's error: two ranks at least are left when N is
    # ``accuracy`` or more, while rounding moves the position by half a rank
    slack = 3.0 / accuracy

    def sketch(at: Sequence[float]) -> Column:
        return F.percentile_approx("_d", [float(x) for x in at], accuracy)

    def edge(q: str, i: int, inside: bool, outside: float) -> Column:
        wide = F.lit(outside)  # fewer rows than that: the slice is all of them
        return F.when(F.col("_n") >= accuracy, F.get(q, F.lit(i))).otherwise(wide) if inside else wide

    # rank = ROUND(p * N / 100) half up, in exact integer arithmetic; rank 0 has no row
    stats = v.agg(F.count(F.lit(1)).alias("_n"), sketch([max(0.0, p / 100 - slack) for p in ps]).alias("_ql"),
                  sketch([min(1.0, p / 100 + slack) for p in ps]).alias("_qh"))
    bounds = stats.select(F.array(*[F.struct(
        F.lit(p).alias("percentile"),
        F.floor((F.col("_n") * p + 50) / F.lit(100)).cast("bigint").alias("k"),
        edge("_ql", i, p / 100 - slack > 0, float("-inf")).alias("lo"),
        edge("_qh", i, p / 100 + slack < 1, float("inf")).alias("hi")) for i, p in enumerate(ps)]).alias("_t"))
    one_row = F.broadcast(bounds)
    near = v.crossJoin(one_row)
    below = near.agg(F.array(*[F.count_if(F.col("_d") < F.col("_t")[i]["lo"]) for i in range(len(ps))]).alias("_below"))
    targets = (bounds.crossJoin(F.broadcast(below))
               .select(F.explode(F.zip_with("_t", "_below", lambda t, b: F.struct(
                   t["percentile"].alias("percentile"), (t["k"] - b).alias("_k"), t["k"].alias("_all")))).alias("x"))
               .select("x.percentile", "x._k").where("x._all >= 1"))
    cut = (near.select("_val", "_d", F.explode(F.filter("_t", lambda t: F.col("_d").between(t["lo"], t["hi"]))).alias("t"))
           .select("_val", "_d", F.col("t.percentile").alias("percentile")))

    splits = cut.groupBy("percentile").agg(sketch([j / (splitters + 1) for j in range(1, splitters + 1)]).alias("_s"))
    parts = cut.join(F.broadcast(splits), "percentile").select(  # one row per percentile
        "percentile", "_val", F.size(F.filter("_s", lambda s: s < F.col("_d"))).alias("_part"))
    w = Window.partitionBy("percentile").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    held = (parts.groupBy("percentile", "_part").agg(F.count(F.lit(1)).alias("_cnt")).withColumn("_end", F.sum("_cnt").over(w))
            .join(F.broadcast(targets), "percentile")
            .where((F.col("_end") - F.col("_cnt") < F.col("_k")) & (F.col("_k") <= F.col("_end")))
            .select("percentile", "_part", (F.col("_k") - F.col("_end") + F.col("_cnt")).alias("_k")))
    # distinct values of the part with multiplicity, ranked
    dv = (parts.join(F.broadcast(held), ["percentile", "_part"])
          .groupBy("percentile", "_val").agg(F.count(F.lit(1)).alias("_cnt"), F.max("_k").alias("_k")))
    w = Window.partitionBy("percentile").orderBy("_val").rowsBetween(Window.unboundedPreceding, 0)
    picked = (dv.withColumn("_end", F.sum("_cnt").over(w))
              .where((F.col("_end") - F.col("_cnt") < F.col("_k")) & (F.col("_k") <= F.col("_end")))
              .select("percentile", F.col("_val").alias("value")))
    return pct.join(picked, "percentile", "left")


def pivot_percentiles(long: DataFrame, percentiles: Sequence[int], prefix: str) -> DataFrame:
    """(percentile, value) rows -> one row with a column per percentile."""
    return long.agg(*[F.max(F.when(F.col("percentile") == p, F.col("value"))).alias(f"{prefix}{p}")
                      for p in percentiles])
