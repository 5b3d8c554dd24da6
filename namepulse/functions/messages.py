"""JSON update messages and text renderings of a day's result."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import schemas
from .text import as_column


def update_message(updates: Column | str) -> Column:
    """Array of struct(name, count) as a JSON array ordered by name."""
    return F.to_json(F.array_sort(as_column(updates)))


def parse_updates(message: Column | str) -> Column:
    """JSON array of updates, or a single update object, as an array of structs."""
    return F.from_json(as_column(message), schemas.UPDATE_MESSAGE)


def parse_increments(message: Column | str) -> Column:
    return F.from_json(as_column(message), schemas.INCREMENT_MESSAGE)


def day_result_line(day: Column | str, pairs: Column | str) -> Column:
    """`DateResult(day,List((name,count),...))`."""
    items = F.transform(
        as_column(pairs),
        lambda p: F.concat(
            F.lit("("), p["name"], F.lit(","), p["count"].cast("string"), F.lit(")")
        ),
    )
    return F.concat(
        F.lit("DateResult("),
        as_column(day),
        F.lit(",List("),
        F.array_join(items, ","),
        F.lit("))"),
    )


def day_display_line(day: Column | str, pairs: Column | str) -> Column:
    """`day : ([name,count], ...)`."""
    items = F.transform(
        as_column(pairs),
        lambda p: F.concat(
            F.lit("["), p["name"], F.lit(","), p["count"].cast("string"), F.lit("]")
        ),
    )
    return F.format_string("%s : (%s)", as_column(day), F.array_join(items, ", "))
