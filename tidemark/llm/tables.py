"""The driver's tables, and tables written on the way."""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import tempfile
import uuid
import weakref
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spark's own setting to remove a query's shuffle files when it ends.
_CLEARING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: A key is hot that more than one in ``HOT`` of all rows have, so fewer than ``HOT`` keys are; their rows are dealt to ``PARTS`` tasks.
HOT, PARTS = 1000, 64
#: Folders of the applications this process has had, by their roots.
_folders: dict[tuple[str, str], str] = {}
#: Folders of the tables written, as long as these are in use.
_places: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
#: The tables written since ``passing`` began.
_passing: contextvars.ContextVar[list[DataFrame] | None] = contextvars.ContextVar("passing", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _own_root(spark: SparkSession) -> str:
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
    return tempfile.mkdtemp(prefix="tidemark-llm-")


def folder(spark: SparkSession) -> str:
    """A new folder below the cluster's ``spark.checkpoint.dir``.

    All folders of an application lie in one, which goes when the process ends.
    Only on one machine, as in tests, may the setting be missing.
    """
    application = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None) or ""
    if (root, application) not in _folders:
        path = f"{(root or _own_root(spark)).rstrip('/')}/tidemark-{application}"
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

        def remove() -> None:
            with contextlib.suppress(Exception):  # the gateway may have ended before
                files.delete(place, True)

        atexit.register(remove)
        _folders[root, application] = path
    return f"{_folders[root, application]}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The rows written as a table in the shared folder and read back.

    Cuts the lineage: executors that are lost later don't cause the work before
    to be done again.
    """
    spark = df.sparkSession
    path = folder(spark)
    df.write.parquet(path)
    rows = spark.read.schema(df.schema).parquet(path)
    _places[rows] = path
    if (made := _passing.get()) is not None:
        made.append(rows)
    return rows


def written_and_cleared(df: DataFrame) -> DataFrame:
    """As ``written``; the shuffle files of the way there go at once, not when the driver next collects garbage."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEARING, None)
    conf.set(_CLEARING, "true")
    try:
        return written(df)
    finally:
        conf.unset(_CLEARING) if before is None else conf.set(_CLEARING, before)


def dropped(*rows: DataFrame) -> None:
    """Removes the files of tables from ``written`` that nothing will read again."""
    for df in rows:
        place = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(_places.pop(df))
        place.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextlib.contextmanager
def passing() -> Iterator[list[DataFrame]]:
    """Tables that are written inside go at its end, except those put into the list it gives."""
    made, kept, outer = [], [], _passing.get()
    _passing.set(made)
    try:
        yield kept
    finally:
        _passing.set(outer)
    dropped(*[x for x in made if x in _places and not any(x is y for y in kept)])
    if outer is not None:
        outer.extend(kept)


def hot_keys(counts: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """The hot ones of the keys in ``counts``, which has a row for each key with its number of rows ``n``: fewer than ``HOT``."""
    total = counts.agg(F.sum(n)).first()[0] or 0
    return counts.where(F.col(n) * HOT > total).select(*keys)


def spread_join(rows: DataFrame, table: DataFrame, keys: list[str], by: list[str], hot: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` joined by ``keys`` with ``table``, which has a row for each key.

    Rows of the keys in ``hot`` (see ``hot_keys``) are dealt by the columns ``by``, and copies of
    the table's row meet them, so no task takes all rows of such a key.
    """
    often = F.broadcast(hot.withColumn("often", F.lit(True)))
    part = F.when(F.col("often"), F.pmod(F.xxhash64(*by), F.lit(PARTS)).cast("int")).otherwise(0)
    parts = F.when(F.col("often"), F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))
    dealt = rows.join(often, keys, "left").withColumn("part", part).drop("often")
    copies = table.join(often, keys, "left").withColumn("part", F.explode(parts)).drop("often")
    return dealt.join(copies, [*keys, "part"], how).drop("part")
