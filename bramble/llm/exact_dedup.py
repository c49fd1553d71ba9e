"""Exact deduplication with an extendible-hash index on shared files (DataFrame only).

1. One pass writes a narrow entry per row: (doc_id, code points, key, sha256), where the
   key is the XXH64 of the normalised text.
2. ``directory`` grows by doubling: a bucket is a key prefix, and only prefixes that hold
   more than ``bucket_capacity`` distinct keys are split into two one bit longer. The
   directory maps every slot (prefix of the deepest length) to its bucket; it has one row
   per ``bucket_capacity`` keys or so.
3. Texts are grouped by (key, normalised text): Spark compares the bytes, and the map-side
   combine turns a hot text into one row per task before the shuffle. What is left is one
   chain entry per different text; entries with the same key form a collision chain.
4. Owner tasks take contiguous key ranges, number the chains and write the index files,
   one folder per bucket.
5. ``lookup``: an entry finds its bucket through its slot of the directory, and there the
   chain of its key. In a chain of one entry all texts with this key are that text, by the
   comparison of step 3. Longer chains are walked: their rows' normalised texts are read
   again and compared byte by byte with each text of the chain.
6. Of rows that tie in doc_id, length and text exactly one is kept.

Null text counts as empty; an empty table gives an empty result; rows with a null doc_id
take part and lose ties against rows with one; repeated rows stay separate rows of the
result, one of them kept. The id may be of any type that has an order (whole numbers of 64
bits are compared in a hash aggregate, others in a sorted one). Other columns are not read,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegralType

from bramble.llm.shared import whole_text, write_shared

MAX_DEPTH = 40


def normalised(text: str = "text") -> Column:
    """The text without the characters of [\\x20\\x09-\\x0D]."""
    return F.regexp_replace(whole_text(text), r"[\x20\x09-\x0D]+", "")


def slot(key: Column, depth: int) -> Column:
    """The first ``depth`` bits of a 64-bit key."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, bucket_capacity: int) -> tuple[DataFrame, int]:
    """(slot, bucket, local_depth) for every slot of the doubled directory, and its depth.

    ``keys`` has one column ``key``, distinct. The counts per slot are taken once at a
    depth that the number of keys suggests, and again deeper only while some bucket is
    still overfull there."""
    n = keys.count()
    deepest = max(1, (max(1, n) // bucket_capacity).bit_length() + 2)
    while True:
        counts = keys.groupBy(slot(F.col("key"), deepest).alias("slot")).agg(F.count("*").alias("n"))
        counts = write_shared(counts, "directory-counts")
        if deepest >= MAX_DEPTH or counts.where(F.col("n") > bucket_capacity).isEmpty():
            break
        deepest += 1  # directory doubling
    bucket = counts.select("slot", F.lit(0).alias("local_depth"), F.lit(0).cast("long").alias("prefix"))
    for depth in range(deepest):
        # split the buckets of this depth that are overfull, leave the others as they are
        size = (counts.groupBy(F.shiftrightunsigned("slot", deepest - depth).alias("prefix"))
                .agg(F.sum("n").alias("size")).where(F.col("size") > bucket_capacity)
                .select("prefix", F.lit(depth).alias("local_depth"), F.lit(True).alias("overfull")))
        bucket = (bucket.join(size, ["prefix", "local_depth"], "left")
                  .select("slot",
                          F.when(F.col("overfull"), F.lit(depth + 1)).otherwise(F.col("local_depth")).alias("local_depth"),
                          F.when(F.col("overfull"), F.shiftrightunsigned("slot", deepest - depth - 1))
                          .otherwise(F.col("prefix")).alias("prefix")))
    named = bucket.select("slot", "local_depth",
                          F.concat_ws("-", F.col("local_depth").cast("string"), F.col("prefix").cast("string")).alias("bucket"))
    return write_shared(named, "directory"), deepest


# The row that stays has the greatest rank: most code points, then the smallest doc_id, null
# doc_ids last. One decimal instead of a struct keeps the text grouping a hash aggregate.
_STEP = "100000000000000000000"
_LAST = "9223372036854775807"


def _rank() -> Column:
    by_id = f"coalesce({_LAST} - cast(doc_id as decimal(20,0)) + 1, cast(0 as decimal(20,0)))"
    return F.expr(f"cast(cast(n_code_points as decimal(12,0)) * {_STEP} as decimal(38,0)) + {by_id}").cast("decimal(38,0)")


def _unrank() -> list[Column]:
    by_id = f"cast(rank % {_STEP} as decimal(20,0))"
    return [F.expr(f"if({by_id} = 0, null, cast({_LAST} - ({by_id} - 1) as bigint))").alias("keep_id"),
            F.expr(f"rank div {_STEP}").alias("keep_code_points")]


def _chains(norm: DataFrame) -> DataFrame:
    """One row per different text: key, norm, group_size, keep_id, keep_code_points."""
    groups = norm.groupBy("key", "norm")
    if isinstance(norm.schema["doc_id"].dataType, IntegralType):
        return (groups.agg(F.count("*").alias("group_size"), F.max(_rank()).alias("rank"))
                .select("key", "norm", "group_size", *_unrank()))
    first = F.min(F.struct((-F.col("n_code_points")).alias("less"), F.col("doc_id").isNull().alias("none"), "doc_id"))
    return (groups.agg(F.count("*").alias("group_size"), first.alias("first"))
            .select("key", "norm", "group_size", F.col("first.doc_id").alias("keep_id"), (-F.col("first.less")).alias("keep_code_points")))


def _in_bucket(df: DataFrame, slots: DataFrame, depth: int) -> DataFrame:
    """``df`` with the bucket that the directory names for its keys."""
    return df.withColumn("slot", slot(F.col("key"), depth)).join(slots.select("slot", "bucket"), "slot").drop("slot")


def build_index(norm: DataFrame, slots: DataFrame, depth: int) -> DataFrame:
    """The index files: bucket, key, chain (place in the key's chain), chain_length,
    group_size, keep_id, keep_code_points."""
    of_key = Window.partitionBy("key")
    entries = _chains(norm).withColumn("sha", F.sha2("norm", 256)).drop("norm")
    entries = (_in_bucket(entries, slots, depth).repartitionByRange("key")
               .withColumns({"chain": F.row_number().over(of_key.orderBy("sha")), "chain_length": F.count("*").over(of_key)}))
    return write_shared(entries.select("key", "chain", "chain_length", "group_size", "keep_id", "keep_code_points", "bucket"),
                        "exact-index", partition_by=("bucket",))


def lookup(entries: DataFrame, norm: DataFrame, index: DataFrame, slots: DataFrame, depth: int) -> DataFrame:
    """doc_id, n_code_points, sha, text_id, keep_id, keep_code_points, group_size per entry;
    ``text_id`` (key, chain) names the text."""
    told = ["doc_id", "n_code_points", "sha", "text_id", "keep_id", "keep_code_points", "group_size"]
    alone = index.where("chain_length = 1").drop("chain_length")
    found = (_in_bucket(entries, slots, depth).join(alone, ["bucket", "key"])
             .withColumn("text_id", F.struct("key", "chain")).select(*told))
    clash = index.where("chain_length > 1").select("key").distinct()
    if clash.isEmpty():
        return found
    rows = norm.join(clash, "key")
    number = F.row_number().over(Window.partitionBy("key").orderBy("norm"))
    chain = _chains(rows).withColumn("chain", number).withColumnsRenamed({"key": "chain_key", "norm": "chain_norm"})
    walked = (rows.join(chain, (F.col("key") == F.col("chain_key")) & (F.col("norm") == F.col("chain_norm")))
              .withColumn("sha", F.unhex(F.sha2("norm", 256))).withColumn("text_id", F.struct("key", "chain")))
    return found.unionByName(walked.select(*told))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bucket_capacity: int = 1 << 20, hash_key: Callable[[str], Column] = F.xxhash64) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256. ``hash_key``
    makes the 64-bit key of the normalised text."""
    whole = whole_text(text_col)
    norm = docs.select(F.col(id_col).alias("doc_id"), F.char_length(whole).cast("long").alias("n_code_points"),
                       normalised(text_col).alias("norm"))
    norm = norm.withColumn("key", hash_key("norm").cast("long"))
    entries = write_shared(norm.select("doc_id", "n_code_points", "key", F.unhex(F.sha2("norm", 256)).alias("sha")),
                           "exact-entries")
    slots, depth = directory(entries.select("key").distinct(), bucket_capacity)
    index = build_index(norm, slots, depth)
    found = lookup(entries, norm, index, slots, depth).withColumn("row", F.monotonically_increasing_id())
    found = write_shared(found, "exact-found")  # the row numbers hold from here on
    best = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_code_points") == F.col("keep_code_points"))
    stays = found.where(best).groupBy("text_id").agg(F.min("row").alias("row")).select("row", F.lit(True).alias("stays"))
    return found.join(stays, "row", "left").select(
        "doc_id", "keep_id", "group_size", F.coalesce("stays", F.lit(False)).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


ORACLE = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), g AS (
  SELECT norm, count(*) AS group_size, first(doc_id ORDER BY n DESC, doc_id) AS keep_id
  FROM t GROUP BY norm
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g USING (norm)
"""
