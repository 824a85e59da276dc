"""Table scans and CSV input."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.schema import TABLES
from tidemark.shop import Shop

#: Quotes inside a value are doubled, as most CSV readers and writers do.
CSV_DIALECT = {"header": True, "quote": '"', "escape": '"'}


def lowercase_columns(df: DataFrame) -> DataFrame:
    names = [name.lower() for name in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"columns that differ by case only: {sorted(df.columns)}")
    return df.toDF(*names)


def mismatch(found: StructType, wanted: StructType) -> str | None:
    """How the columns differ by name or type; None if they are the same in any order."""
    have = {f.name: f.dataType.simpleString() for f in found.fields}
    want = {f.name: f.dataType.simpleString() for f in wanted.fields}
    wrong = [f"missing column {name}" for name in want if name not in have]
    wrong += [f"unknown column {name}" for name in have if name not in want]
    wrong += [f"{name} is {have[name]}, not {want[name]}" for name in want if name in have and have[name] != want[name]]
    return "; ".join(wrong) or None


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None, multi_line: bool = False) -> DataFrame:
    """CSV with a header row; column names become lower-case.

    With a schema, columns are matched by name and cast; a missing column or an
    unreadable value is an error. Without, types are inferred, which reads the
    data twice. The columns may stand in any order, but all files of a folder
    must have the same header; another one is an error. ``multi_line`` reads
    values with line breaks; files can't be split then, so each is one task.
    """
    reader = spark.read.options(**CSV_DIALECT, enforceSchema=False, multiLine=multi_line)
    if schema is None:
        return lowercase_columns(reader.option("inferSchema", True).csv(path))
    text = lowercase_columns(reader.csv(path))
    return text.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet table whose own columns are checked: one that is missing or of another type is an error."""
    df = spark.read.parquet(path)
    wrong = mismatch(df.select(*[c for c in df.columns if c in schema.names]).schema, schema)
    if wrong:
        raise ValueError(f"{path}: {wrong}")
    return df.select(*schema.names)


def read_shop(spark: SparkSession, root: str) -> Shop:
    """The five tables as Parquet below ``root``, one file or folder each."""
    return Shop(**{name: read_table(spark, f"{root}/{name}.parquet", schema) for name, schema in TABLES.items()})


def read_shop_csv(spark: SparkSession, root: str) -> Shop:
    """The five tables as CSV below ``root``."""
    tables = {
        name: read_csv(spark, f"{root}/{name}.csv", schema) for name, schema in TABLES.items()
    }
    return Shop(**tables)


def run_sql(spark: SparkSession, shop: Shop, text: str, **parameters) -> DataFrame:
    """Run a SQL query over the shop tables, with ``:name`` parameters (dates as ``datetime.date``).

    Each call binds the tables' names inside its own query, to views with names of
    their own, which go once the names are resolved. The session's views are neither
    changed nor hidden from others, so that queries of several threads, over several shops, don't meet.
    """
    own = f"shop_{uuid.uuid4().hex}"
    tables = shop.tables()
    bound = ", ".join(f"{name} AS (SELECT * FROM {own}_{name})" for name in tables)
    try:
        for name, df in tables.items():
            df.createTempView(f"{own}_{name}")
        return spark.sql(f"WITH {bound} SELECT * FROM (\n{text.strip().rstrip(';')}\n)", args=parameters)
    finally:
        for name in tables:
            spark.catalog.dropTempView(f"{own}_{name}")
