"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def shared_folder(spark) -> str:
    """``spark.checkpoint.dir`` of the session. Only local mode may go without: it gets a
    scratch folder of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    made = tempfile.mkdtemp(prefix="bramble-tables-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back. The files survive lost executors, give every reader
    the same rows, and tell the planner their size, so small ones are broadcast by its own
    check."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
