"""Schemas of the inputs and outputs."""

from __future__ import annotations

from pyspark.sql import types as T

# The 27 columns of a news record line, in file order.
RECORD_COLUMNS = (
    "GKGRECORDID",
    "DATE",
    "SourceCollectionIdentifier",
    "SourceCommonName",
    "DocumentIdentifier",
    "Counts",
    "V2Counts",
    "Themes",
    "V2Themes",
    "Locations",
    "V2Locations",
    "Persons",
    "V2Persons",
    "Organizations",
    "V2Organizations",
    "V2Tone",
    "Dates",
    "GCAM",
    "SharingImage",
    "RelatedImages",
    "SocialImageEmbeds",
    "SocialVideoEmbeds",
    "Quotations",
    "AllNames",
    "Amounts",
    "TranslationInfo",
    "Extras",
)

# Positions used when a line is read without a schema.
DATE_FIELD = 1
NAMES_FIELD = 23

_RECORD_TYPES = {"DATE": T.TimestampType(), "SourceCollectionIdentifier": T.LongType()}

RECORD = T.StructType(
    [T.StructField(c, _RECORD_TYPES.get(c, T.StringType())) for c in RECORD_COLUMNS]
)

# The sensor columns.
SENSOR = T.StructType(
    [
        T.StructField("sensorname", T.StringType(), False),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("numA", T.DoubleType(), False),
        T.StructField("numB", T.DoubleType(), False),
        T.StructField("numC", T.LongType(), False),
        T.StructField("numD", T.DoubleType(), False),
        T.StructField("numE", T.LongType(), False),
        T.StructField("numF", T.DoubleType(), False),
    ]
)

# A keyed log of record lines; `offset` orders it.
RECORD_STREAM = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("offset", T.LongType()),
    ]
)

# One row per change of a rolling count. `prev_count` lets `expand_changes` restore one row per
# mention. `seq` grows with every change of a name: the newest count is that of the largest seq,
# also where a late mention changes the count at an earlier second.
COUNT_CHANGES = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("event_sec", T.LongType()),
        T.StructField("op", T.StringType()),
        T.StructField("prev_count", T.LongType()),
        T.StructField("count", T.LongType()),
        T.StructField("seq", T.LongType()),
    ]
)

UPDATE_MESSAGE = T.ArrayType(
    T.StructType(
        [T.StructField("name", T.StringType()), T.StructField("count", T.LongType())]
    )
)

INCREMENT_MESSAGE = T.ArrayType(
    T.StructType(
        [
            T.StructField("name", T.StringType()),
            T.StructField("increment", T.LongType()),
        ]
    )
)

DAILY_RESULT = T.StructType(
    [
        T.StructField("data", T.StringType()),
        T.StructField(
            "result",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("topic", T.StringType()),
                        T.StructField("count", T.LongType()),
                    ]
                )
            ),
        ),
    ]
)
