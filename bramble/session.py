"""A SparkSession with the settings that the operators expect."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every run wants. Shuffle partitions are sized per run (cluster: thousands,
# AQE coalesces the small ones; tests: a handful).
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a month's transactions may be large and still prune the lines; the filter itself is bounded
    # (8 MB, good for some ten million transactions) and never drops a match
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "64g",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "bramble", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
