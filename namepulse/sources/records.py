"""Batch scans of record and sensor files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import schemas
from ..functions import text, times

# An empty quote: a field may begin with an unclosed `"`.
RECORD_CSV = {"sep": "\t", "quote": "", "timestampFormat": times.RECORD_TIME}


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def read_records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Typed scan of tab-separated record files; `paths` may hold globs."""
    return (
        spark.read.schema(schemas.RECORD)
        .options(**RECORD_CSV)
        .csv(paths if isinstance(paths, str) else list(paths))
    )


def parse_records(lines: DataFrame, value: str = "value") -> DataFrame:
    """The typed columns of record lines that are already in a column."""
    parsed = F.from_csv(F.col(value), _ddl(schemas.RECORD), RECORD_CSV)
    return lines.select(parsed.alias("r")).select("r.*")


def record_view(records: DataFrame) -> DataFrame:
    """The three columns the daily queries need."""
    return records.select(
        F.col("GKGRECORDID").alias("record_id"),
        F.col("DATE").alias("date"),
        F.col("AllNames").alias("all_names"),
    )


def read_lines(
    spark: SparkSession, paths: str | Sequence[str], clean: bool = True
) -> DataFrame:
    """All lines of all files (duplicates kept).

    Malformed UTF-8 is dropped; with clean=False that is left to `positional_records` and
    `line_view`, which then repair only the fields they take.
    """
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths))
    return lines.select(text.drop_malformed_utf8("value").alias("value")) if clean else lines


def read_positioned_lines(
    spark: SparkSession, paths: str | Sequence[str]
) -> DataFrame:
    """Lines with what orders them inside a file: (file_name, file_block, line_id)."""
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths))
    return with_line_order(lines)


def with_line_order(lines: DataFrame) -> DataFrame:
    """Add the file, the block of the file and an id that grows inside a block.

    A block is one input split, so it never holds more than one task's share of a file.
    """
    return lines.select(
        text.drop_malformed_utf8("value").alias("value"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("file_block"),
        F.monotonically_increasing_id().alias("line_id"),
    )


def positional_records(
    lines: DataFrame, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Lines with more than 23 fields as (date_digits, all_names), by position."""
    picked = text.pick_fields(
        value,
        lambda field: F.struct(
            field(schemas.DATE_FIELD).alias("date_digits"),
            field(schemas.NAMES_FIELD).alias("all_names"),
        ),
        more_than=schemas.NAMES_FIELD,
    )
    return lines.select(*keep, F.inline(picked))


def line_view(lines: DataFrame, value: str = "value") -> DataFrame:
    """The columns of `record_view`, cut out of plain lines without parsing the others."""
    picked = text.pick_fields(
        value,
        lambda field: F.struct(
            field(0).alias("record_id"),
            field(schemas.DATE_FIELD).alias("_date"),
            field(schemas.NAMES_FIELD).alias("_names"),
        ),
    )
    return lines.select(F.inline(picked)).select(
        "record_id",
        times.parse_record_time("_date").alias("date"),
        F.nullif("_names", F.lit("")).alias("all_names"),
    )


def with_min_fields(
    df: DataFrame, value: str, sep: str, more_than: int
) -> DataFrame:
    """Rows whose text splits into more than `more_than` items."""
    return df.where(F.size(text.split_trimmed(value, sep)) > more_than)


def _sensor_csv(hours_24: bool) -> dict[str, str]:
    return {
        "timestampFormat": times.SENSOR_TIME_24H if hours_24 else times.SENSOR_TIME
    }


def read_sensors(
    spark: SparkSession, paths: str | Sequence[str], hours_24: bool = False
) -> DataFrame:
    """Typed scan of sensor files; rows with a missing value are dropped."""
    rows = (
        spark.read.schema(schemas.SENSOR)
        .options(**_sensor_csv(hours_24))
        .csv(paths if isinstance(paths, str) else list(paths))
    )
    return rows.dropna()


def parse_sensors(
    lines: DataFrame, value: str = "value", hours_24: bool = False
) -> DataFrame:
    parsed = F.from_csv(F.col(value), _ddl(schemas.SENSOR), _sensor_csv(hours_24))
    return lines.select(parsed.alias("r")).select("r.*").dropna()


def at_timestamp(df: DataFrame, ts: str, column: str = "timestamp") -> DataFrame:
    """Rows at exactly one time."""
    return df.where(F.col(column) == F.lit(ts).cast("timestamp"))
