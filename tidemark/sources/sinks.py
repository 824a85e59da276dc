"""Writing results, and the shared folder for what is written on the way."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql.types import StructType

from tidemark.sources.files import CSV_DIALECT, lowercase_columns, mismatch, read_csv


@dataclass(frozen=True)
class Outcome:
    """Whether an append succeeded, and the error's text if not."""

    ok: bool
    message: str


def _failed(target: str, error: Exception) -> Outcome:
    return Outcome(False, f"Error at {target}: {str(error) or type(error).__name__}")


def stored_schema(spark: SparkSession, path: str) -> StructType | None:
    """The schema of the Parquet table at ``path``; None if there is none yet."""
    try:
        return spark.read.parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def append_table(df: DataFrame, path: str, schema: StructType | None = None) -> Outcome:
    """Append to the Parquet table at ``path``; errors are reported, not raised.

    The columns must be those of the table (or, for a new one, of ``schema`` if
    given) by name and type; otherwise nothing is written.
    """
    try:
        wanted = stored_schema(df.sparkSession, path) or schema
        if wanted is not None:
            wrong = mismatch(df.schema, wanted)
            if wrong:
                return Outcome(False, f"Error at {path}: {wrong}")
            df = df.select(*wanted.names)
        df.write.mode("append").parquet(path)
    except Exception as error:  # whatever the storage or the query raises
        return _failed(path, error)
    return Outcome(True, f"Appended to {path}")


def load_table(spark: SparkSession, name: str, csv_path: str, schema: StructType | None = None, multi_line: bool = False) -> Outcome:
    """Append a CSV file or folder to a named table of the catalog, which is made if it doesn't exist.

    Column names become lower-case. With a table or a ``schema`` columns are
    matched by name, whatever its case, and read by its types. Errors are reported, not raised.
    """
    try:
        exists = spark.catalog.tableExists(name)
        wanted = spark.table(name).schema if exists else schema
        if wanted is None:
            rows = read_csv(spark, csv_path, None, multi_line)
        else:
            text = lowercase_columns(spark.read.options(**CSV_DIALECT, multiLine=multi_line).csv(csv_path))
            lower = lowercase_columns(spark.createDataFrame([], wanted)).schema
            unknown = sorted(set(text.columns) - set(lower.names))
            if unknown:
                return Outcome(False, f"Error at {name}: unknown columns {unknown}")
            rows = read_csv(spark, csv_path, lower, multi_line).toDF(*wanted.names)
        rows.write.mode("append").format("parquet").saveAsTable(name)
    except Exception as error:  # whatever the storage, the catalog or a value raises
        return _failed(name, error)
    return Outcome(True, f"Loaded {csv_path} into {name}")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV files with a header, written in parallel by the executors, in place of what is there.

    Values are kept as they are; only an empty text reads back as NULL.
    """
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    _publish(df, path, lambda writer, place: writer.options(**CSV_DIALECT, **spaces).csv(place))


def write_parquet(df: DataFrame, path: str) -> None:
    """Parquet files, in place of what is there."""
    _publish(df, path, lambda writer, place: writer.parquet(place))


def _publish(df: DataFrame, path: str, write: Callable[[DataFrameWriter, str], None]) -> None:
    """Write beside ``path`` and put the whole result in its place.

    A query that fails leaves what was there, also when it reads from ``path`` itself. Putting
    in place is two renames: a file system renames at once, an object store copies.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    name = uuid.uuid4().hex
    fresh, old = f"{path}.new-{name}", f"{path}.old-{name}"
    try:
        write(df.write.mode("error"), fresh)
        there = _renamed(spark, path, old)
        if not _renamed(spark, fresh, path):
            if there:
                _renamed(spark, old, path)
            raise OSError(f"{path}: the result could not be put in its place")
        spark.catalog.refreshByPath(path)
        if there:
            remove_folder(spark, old)
    finally:
        remove_folder(spark, fresh)


def _place(spark: SparkSession, path: str):
    """A path and its file system, as Spark sees them."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _renamed(spark: SparkSession, path: str, target: str) -> bool:
    """Whether there was something at ``path``, which now is at ``target``."""
    place, files = _place(spark, path)
    return files.exists(place) and files.rename(place, _place(spark, target)[0])


def shared_folder(spark: SparkSession, root: str | None = None) -> str:
    """The name of a new folder below ``root``, or below the cluster's ``spark.checkpoint.dir``."""
    root = root or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("name a folder that the whole cluster shares, or set spark.checkpoint.dir")
    return f"{root.rstrip('/')}/tidemark-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder by Spark's own file systems."""
    place, files = _place(spark, path)
    files.delete(place, True)
