"""Record- and stream-shaped views of the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions import times

# Declared so that times are read as instants and filters on them reach the files.
EVENTS = (
    "event_id long, ts timestamp, user_id long, event_type string, "
    "value double, props string"
)
ORDERS = (
    "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority string"
)

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

FIRST_DAY = "2024-01-01"
DAYS = 30
# A capital letter and the small letters after it, of any language; accents may be marks.
NAME_PATTERN = r"\p{Lu}[\p{Ll}\p{M}]+"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(ORDERS).parquet(f"{sf_dir}/orders.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_mentions(events: DataFrame, name: str = "event_type") -> DataFrame:
    """Events as mentions: (event_id, name, timestamp)."""
    return events.select(
        "event_id", F.col(name).cast("string").alias("name"), F.col("ts").alias("timestamp")
    )


def event_lines(events: DataFrame) -> DataFrame:
    """Events as keyed lines of quarter-hour segments: (event_id, segment, key)."""
    start = times.floor_to("ts")
    return events.select(
        "event_id",
        "ts",
        times.segment_name(start).alias("segment"),
        F.concat(
            times.segment_name(start), F.lit("-"), F.col("event_id").cast("string")
        ).alias("key"),
    )


def document_names(text: str = "text") -> Column:
    """Capitalised words of a text as `word,position;word,position;...`."""
    words = F.regexp_extract_all(F.col(text), F.lit(NAME_PATTERN), F.lit(0))
    entries = F.transform(
        words, lambda w, i: F.concat(w, F.lit(","), i.cast("string"))
    )
    return F.array_join(entries, ";")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def document_records(documents: DataFrame) -> DataFrame:
    """Documents as records: (record_id, date, all_names), names NULL where there are none."""
    day = F.date_add(
        F.lit(FIRST_DAY).cast("date"), (F.col("doc_id") % DAYS).cast("int")
    )
    # The one-item explode keeps filters on the names from being pushed below, where
    # they would extract the words a second time.
    named = documents.select(
        "doc_id",
        day.cast("timestamp").alias("date"),
        F.explode(F.array(document_names())).alias("_names"),
    )
    return named.select(
        F.concat_ws("-", F.date_format("date", times.RECORD_TIME), F.col("doc_id")).alias(
            "record_id"
        ),
        "date",
        F.nullif(F.col("_names"), F.lit("")).alias("all_names"),
    )


def document_lines(documents: DataFrame) -> DataFrame:
    """Documents as keyed, tab-separated record lines of 27 fields: (key, value, timestamp)."""
    fields = {
        "GKGRECORDID": F.col("record_id"),
        "DATE": F.date_format("date", times.RECORD_TIME),
        "SourceCollectionIdentifier": F.lit("1"),
        "AllNames": F.coalesce("all_names", F.lit("")),
    }
    line = F.concat_ws("\t", *[fields.get(c, F.lit("")) for c in schemas.RECORD_COLUMNS])
    return document_records(documents).select(
        F.col("record_id").alias("key"), line.alias("value"), F.col("date").alias("timestamp")
    )
