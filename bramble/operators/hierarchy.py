"""Adjacency-list hierarchies: three levels to a wide table, any depth to paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bramble.sources.shared import stored


def flatten_hierarchy(h: DataFrame, prices: DataFrame | None = None, id_col: str = "id",
                      parent_col: str = "parent_id", text_col: str = "level_text") -> DataFrame:
    """Three-level adjacency list (category > segment > style) to one row per leaf path.

    Two inner self equi-joins (node -> child -> grandchild); ``product_name`` is
    "style segment category". With ``prices`` (id, product_id, price) the style id is
    looked up with a left join. Joins are on unique ids of the upper level, so the
    planner may broadcast the upper levels or shuffle-join them; a parent with very many
    children is a skewed key on one side only, which AQE splits.
    """
    h1 = h.select(F.col(id_col).alias("category_id"), F.col(text_col).alias("category_name"))
    h2 = h.select(F.col(id_col).alias("segment_id"), F.col(parent_col).alias("_p2"),
                  F.col(text_col).alias("segment_name"))
    h3 = h.select(F.col(id_col).alias("style_id"), F.col(parent_col).alias("_p3"),
                  F.col(text_col).alias("style_name"))
    flat = (h1.join(h2, h1["category_id"] == h2["_p2"])
            .join(h3, h2["segment_id"] == h3["_p3"])
            .select(F.concat(F.col("style_name"), F.lit(" "), F.col("segment_name"), F.lit(" "),
                             F.col("category_name")).alias("product_name"),
                    "category_id", "segment_id", "style_id", "category_name", "segment_name",
                    "style_name"))
    if prices is None:
        return flat
    pp = prices.select(F.col("id").alias("_pid"), "product_id", "price")
    return (flat.join(pp, flat["style_id"] == pp["_pid"], "left")
            .select("product_id", "price", "product_name", "category_id", "segment_id",
                    "style_id", "category_name", "segment_name", "style_name"))


def ancestors(h: DataFrame, id_col: str = "id", parent_col: str = "parent_id") -> DataFrame:
    """(node, ancestor, distance) for every node and each of its ancestors, by path doubling.

    Round k joins the pairs at distance 2^k with all pairs found so far, so a hierarchy of
    depth d takes log2(d) rounds of equi-joins; each round is written to the shared folder. A
    parent with very many children is a skewed key on one side of a join, which AQE splits.
    NULL ids or parents have no ancestors, a parent that is no node counts as absent, repeated
    rows count once. A cycle shows as a node that is its own ancestor, found within log2 of
    its length rounds, and raises ValueError (a Spark action decides it, as it decides the
    number of rounds)."""
    nodes = h.select(F.col(id_col).alias("_id")).distinct()
    step = (h.select(F.col(id_col).alias("node"), F.col(parent_col).alias("ancestor")).dropna().distinct()
            .join(nodes, F.col("ancestor") == F.col("_id"), "left_semi"))
    step = stored(step.withColumn("distance", F.lit(1).cast("long")), "ancestors")
    found, reach = step, 1
    while not step.isEmpty():
        loops = [r.node for r in found.where("node = ancestor").select("node").limit(3).collect()]
        if loops:
            raise ValueError(f"the hierarchy has a cycle through {loops}")
        half = step.select("node", F.col("ancestor").alias("_mid"))
        farther = (half.join(found.select(F.col("node").alias("_mid"), "ancestor", "distance"), "_mid")
                   .select("node", "ancestor", (F.col("distance") + reach).alias("distance")).distinct())
        farther = stored(farther, "ancestors")
        found = found.unionByName(farther)
        reach *= 2
        step = farther.where(F.col("distance") == reach)
    return found


def paths(h: DataFrame, id_col: str = "id", parent_col: str = "parent_id", text_col: str = "level_text",
          sep: str = " > ") -> DataFrame:
    """One row per node of a hierarchy of any depth: id, root_id, depth (0 for a root) and the
    texts from the root down to the node (NULL texts are left out)."""
    text = h.select(F.col(id_col).alias("_tid"), F.col(text_col).alias("_text")).distinct()
    own = h.select(F.col(id_col).alias("node")).dropna().distinct()
    chain = (own.select("node", F.col("node").alias("ancestor"), F.lit(0).cast("long").alias("distance"))
             .unionByName(ancestors(h, id_col, parent_col)))
    part = F.struct((-F.col("distance")).alias("_at"), F.col("ancestor").alias("_id"), "_text")  # a row per level
    rows = (chain.join(text, F.col("ancestor") == F.col("_tid"), "left").groupBy("node")
            .agg(F.array_sort(F.collect_list(part)).alias("_path")))
    return rows.select(F.col("node").alias(id_col), F.col("_path")[0]["_id"].alias("root_id"), (F.size("_path") - 1).cast("long").alias("depth"),
                       F.array_join(F.transform("_path", lambda p: p["_text"].cast("string")), sep).alias("path"))
