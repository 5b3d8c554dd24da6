"""What several operators need: tables between stages, joins on hot keys, byte views of texts."""

from __future__ import annotations

import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..streaming.storage import fresh_dir, temporary_dir

# Bytes that Unicode-free word patterns treat as white space: \x20 and \x09-\x0D.
# bytes.split() without arguments splits on exactly these.
ASCII_SPACE = b" \t\n\r\x0b\x0c"


def text_bytes(text: str = "text") -> Column:
    """A text column as bytes; null becomes empty. Malformed UTF-8 passes through untouched."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


# Most bytes of a batch of rows that a Python worker gets.
BATCH_BYTES = 8 << 20

# Applications that have this package.
_SENT: set[str] = set()


def prepared(spark: SparkSession) -> None:
    """Get a session ready for Python tasks of this package.

    What a worker holds at once is bounded by bytes, not only by rows. The package is sent to
    the workers once per application, so that they need not have it installed.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId not in _SENT:
        _SENT.add(context.applicationId)
        package = Path(__file__).resolve().parents[1]
        sent = Path(temporary_dir()) / f"{package.name}-{context.applicationId}.zip"
        with zipfile.ZipFile(sent, "w") as out:
            for file in package.rglob("*.py"):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(sent))


def once(function, returns: str):
    """An Arrow UDF that is computed once per row, also below a filter on its result.

    It is declared not deterministic for that: otherwise the optimizer moves such a filter
    below the projection and computes the function in both.
    """
    prepared(SparkSession.active())
    return F.arrow_udf(function, returns).asNondeterministic()


def unused(df: DataFrame, name: str) -> str:
    """A column name like `name` that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder among the shared ones, removed when the session's file systems close."""
    path = fresh_dir(spark, f"llm-{name}")
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(at)  # only what exists can be registered
    fs.deleteOnExit(at)
    return path


# Rows of a few bytes that are put into one file.
ROWS_PER_FILE = 250_000


def kept(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """df written as a Parquet table in the shared folder and read back: cuts the lineage.

    With `rows`, an upper bound of the rows of a slim table, it is written as few files.
    """
    path = scratch_dir(df.sparkSession, name)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_PER_FILE)))
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hot_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join of a left side with hot keys to a right side with few rows per key.

    Both sides are dealt out by a hash of the keys made here, so that even a right side that
    comes out of a grouping by the same keys goes through a plain exchange. Only then can
    adaptive execution split a partition of the left side that one key fills.
    """
    dealt = F.xxhash64(*keys)
    joined = left.withColumn("_dealt", dealt).join(
        right.withColumn("_dealt", dealt), ["_dealt", *keys], how
    )
    return joined.drop("_dealt")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
