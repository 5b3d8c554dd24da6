"""Batch reads of a keyed record log."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Fixed value: the key assumed for an empty log.
FIRST_KEY = "20150218230000-0"


def last_key(log: DataFrame, key: str = "key", offset: str = "offset") -> DataFrame:
    """The key of the last record; a fixed first key when the log is empty."""
    newest = F.max_by(key, offset)
    return log.agg(F.coalesce(newest, F.lit(FIRST_KEY)).alias("last_key"))
