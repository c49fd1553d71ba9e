"""Reading tables, the cluster's shared folder, and Arrow batch helpers."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# the white space of the word definition [^\x20\x09-\x0D]+
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``. A scratch folder is
    set only where the session has none (tests in local mode)."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="bramble-shared-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def write_shared(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), **options) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the lineage,
    survives lost executors, and later reads can prune columns. ``options`` go to the writer."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/bramble-{name}-{uuid.uuid4().hex[:12]}"
    writer = df.write.options(**options)
    writer.partitionBy(*partition_by).parquet(path) if partition_by else writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpoint(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def whole_text(text: str = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def batches(it, max_bytes: int = 2 << 20):
    """Slices of the incoming record batches whose Arrow data stay near ``max_bytes`` (a
    single longer row comes alone)."""
    for b in it:
        n = b.num_rows
        if n == 0:
            continue
        per_row = max(1, b.nbytes // n)
        step = max(1, min(n, max_bytes // per_row))
        for i in range(0, n, step):
            yield b.slice(i, step)


def record_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def utf8(value: str | None) -> bytes:
    return b"" if value is None else value.encode("utf-8", "surrogatepass")
