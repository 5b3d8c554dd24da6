"""Smallest and largest values from the footers of Parquet files, and the rows that hold them."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

# The file sources of the second API answer MIN, MAX and COUNT from footers.
_PUSHDOWN = "spark.sql.parquet.aggregatePushdown"
_FIRST_API = "spark.sql.sources.useV1SourceList"


@contextmanager
def _from_footers(spark: SparkSession) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in (_PUSHDOWN, _FIRST_API)}
    first = [s for s in before[_FIRST_API].split(",") if s and s != "parquet"]
    spark.conf.set(_PUSHDOWN, "true")
    spark.conf.set(_FIRST_API, ",".join(first))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def bounds(spark: SparkSession, path: str, column: str, schema=None) -> tuple:
    """(smallest, largest, rows) of a column of whole numbers, without reading a data page.

    (None, None, 0) where there are no rows. `schema` spares the look at a file for it. Where a
    footer holds no bounds, as of a column with nulls alone, the column is read after all.
    """
    try:
        with _from_footers(spark):
            low, high, rows = bounds_plan(spark, path, column, schema).first()
    except (Py4JJavaError, PySparkException) as e:
        if _PUSHDOWN not in str(e):
            raise
        low, high, rows = bounds_plan(spark, path, column, schema).first()
    return low, high, rows or 0  # a file without row groups has no count in its footer


def bounds_plan(spark: SparkSession, path: str, column: str, schema=None) -> DataFrame:
    """The query of `bounds`; it is answered from footers only while that asks for it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).agg(F.min(column), F.max(column), F.count(F.lit(1)))


def newest_rows(spark: SparkSession, path: str, column: str, schema=None) -> DataFrame:
    """The rows with the largest value of a column of whole numbers.

    The value comes from footers; the filter on it then skips the files and row groups without it.
    """
    _, largest, _ = bounds(spark, path, column, schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).where(F.col(column) == F.lit(largest))
