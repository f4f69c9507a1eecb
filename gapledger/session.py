"""Session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution picks broadcast joins by measured size, splits skewed join
# partitions and merges small ones. These are Spark's defaults, pinned so that a
# differing cluster default does not change the plans. The method limit is the
# size above which HotSpot leaves a method interpreted; a stage beyond it runs
# faster as separate operators.
SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Adaptive execution only merges shuffle partitions, so this is the ceiling, for range
# sorts too. At 100 TB it means some 5 GB of input a partition before pruning.
CLUSTER_SETTINGS = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
}


def build_session(
    app_name: str = "gapledger", master: str | None = None, extra: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings above, on a cluster with the shuffle width as well;
    ``extra`` adds or overrides some."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    width = {} if (master or "").startswith("local") else CLUSTER_SETTINGS
    for key, value in (SETTINGS | width | (extra or {})).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
