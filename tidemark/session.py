"""A Spark session with the settings this library is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: partition coalescing; skewed joins are split by size,
    # also where the next step then needs a shuffle of its own.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Only a side Spark itself has sized below this is broadcast (products);
    # larger ones go through a shuffled join.
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    # Files are sized compressed; in memory their rows take several times as much.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # Shuffles begin with many partitions, which AQE merges to advisory size: about one for each 64 MB of
    # the largest shuffle is enough, so this serves some 500 GB; set more beyond (30 TB: 500,000).
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    # Sets of days: keys that a task holds before it sorts all its rows (some 7 kB each).
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "8192",
    # A shuffled join whose build partitions all measure below this needs no sort.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(64 * 1024 * 1024),
    # The matrix has more generated stages than the default code cache holds.
    "spark.sql.codegen.cache.maxEntries": "2000",
}


def build_session(
    app_name: str = "tidemark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Start (or get) a session; on a cluster leave ``master`` to spark-submit.

    ``shuffle_partitions`` replaces the number that shuffles begin with.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
        del settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
