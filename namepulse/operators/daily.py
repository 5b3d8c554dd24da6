"""Mentions per day: one row per name, counts, top names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import text
from .ranking import top_in_group

# What the typed scan and the line-based paths leave out.
PARENT_CATEGORY = ("ParentCategory",)
CATEGORY = ("Category",)

TOP_NAMES = 10


def mentions(
    df: DataFrame,
    names: str = "all_names",
    keep: Sequence[str] = (),
    exclude: Sequence[str] = CATEGORY,
    drop_empty: bool = False,
    keep_rows_without: bool = False,
) -> DataFrame:
    """One row per mention: the `keep` columns and `name`.

    With `keep_rows_without`, what is left out stays as a row with a NULL name, so the
    `keep` columns of a row without names are not lost.
    """
    entries = text.split_trimmed(names, ";")
    generate = F.explode_outer if keep_rows_without else F.explode
    rows = df.select(*keep, generate(entries).alias("_entry")).select(
        *keep, text.before_first("_entry", ",").alias("name")
    )
    counted = text.keep_name("name", exclude, drop_empty)
    if keep_rows_without:
        return rows.withColumn("name", F.when(counted, F.col("name")))
    return rows.where(counted)


def daily_counts(mentions: DataFrame) -> DataFrame:
    """(day, name, count). A NULL name counts 0 and only says that the day exists."""
    return mentions.groupBy("day", "name").agg(F.count("name").alias("count"))


def record_counts(mentions: DataFrame, *record: str) -> DataFrame:
    """(record, name, count): how often each record mentions a name."""
    return mentions.groupBy(*record, "name").agg(F.count(F.lit(1)).alias("count"))


def one_name_per_count(counts: DataFrame) -> DataFrame:
    """Of the names with equal counts on a day, keep the first in name order."""
    return counts.groupBy("day", "count").agg(F.min("name").alias("name"))


def top_names(counts: DataFrame, n: int = TOP_NAMES, ties: str = "all") -> DataFrame:
    """The `n` names mentioned most on each day, with `rank`.

    ties='all' ranks equal counts by name; ties='one_per_count' keeps one name for each
    distinct count. The row that marks a day without names is kept, with rank NULL.
    """
    if ties not in ("all", "one_per_count"):
        raise ValueError("ties must be 'all' or 'one_per_count'")
    if ties == "one_per_count":
        counts = one_name_per_count(counts)
    order = [F.col("count").desc(), F.col("name").asc_nulls_last()]
    top = top_in_group(counts, ["day"], order, n)
    return top.select(
        "day", F.when(F.col("name").isNotNull(), F.col("rank")).alias("rank"), "name", "count"
    )


def sorted_by_count(counts: DataFrame) -> DataFrame:
    """All counts, largest first, over all days."""
    return counts.orderBy(F.col("count").desc(), "name", "day")


def day_pairs(top: DataFrame) -> DataFrame:
    """(day, pairs): each day's ranked names as an array of struct(name, count).

    Meant for ranked rows only, so that an array never holds more than the ranks asked for.
    """
    pair = F.when(
        F.col("rank").isNotNull(), F.struct("rank", "name", F.col("count").alias("count"))
    )
    ranked = F.array_sort(F.collect_list(pair))
    return (
        top.groupBy("day")
        .agg(ranked.alias("_ranked"))
        .select(
            "day",
            F.transform(
                "_ranked",
                lambda r: F.struct(r["name"].alias("name"), r["count"].alias("count")),
            ).alias("pairs"),
        )
    )


def daily_documents(pairs: DataFrame) -> DataFrame:
    """(data, result[topic, count]): one document per day."""
    result = F.transform(
        "pairs",
        lambda p: F.struct(p["name"].alias("topic"), p["count"].alias("count")),
    )
    return pairs.select(F.col("day").alias("data"), result.alias("result"))


def ranked_cells(documents: DataFrame, ranks: int = TOP_NAMES) -> DataFrame:
    """(date, rank, topic): one cell per date and rank from 0, none where a rank is missing."""
    return documents.select(
        F.to_date("data", "yyyy-MM-dd").alias("date"),
        F.posexplode(F.slice("result", 1, ranks)).alias("rank", "_item"),
    ).select("date", F.col("rank").cast("bigint").alias("rank"), "_item.topic")


def result_bounds(counts: DataFrame, day: str = "day") -> DataFrame:
    """First and last day, and the largest count."""
    return counts.agg(
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
        F.max("count").alias("max_count"),
    )
