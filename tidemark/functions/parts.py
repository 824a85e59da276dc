"""How many partitions rows are dealt to.

AQE merges the partitions of a shuffle up to a size in bytes as shuffled, which says little about the memory
of a task that sorts and sums narrow, well-compressed rows. Where a step holds all of its rows, it is
dealt to a number of partitions that grows with the files that the rows are read from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Bytes of input files for each partition; as rows in memory they take some thirty times as much in a task that sorts and sums them.
PART_BYTES = 8 * 1024 * 1024


def file_bytes(df: DataFrame) -> int:
    """Size of the files that ``df`` is read from, from one listing of each folder; 0 if there are none."""
    context = df.sparkSession.sparkContext
    wanted = set(df.inputFiles())  # as encoded URIs
    total = 0
    for folder in {name.rpartition("/")[0] for name in wanted}:
        place = context._jvm.org.apache.hadoop.fs.Path(context._jvm.java.net.URI(folder))
        listed = place.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(place)
        total += sum(status.getLen() for status in listed if status.getPath().toUri().toString() in wanted)
    return total


def parts_for(df: DataFrame) -> int | None:
    """One partition for each PART_BYTES of the files of ``df``; None, which leaves the number to
    Spark, where that is no more than the tasks that run at once."""
    parts = -(-file_bytes(df) // PART_BYTES)
    return parts if parts > df.sparkSession.sparkContext.defaultParallelism else None


def dealt(df: DataFrame, key: str, parts: int | None) -> DataFrame:
    """Rows dealt by ``key`` to so many partitions, which AQE doesn't merge; by None to those of the session."""
    return df.repartition(parts, key) if parts else df.repartition(key)
