"""What the physical plans must and must not hold."""

import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"

BATCH = [q.__name__ for q in entry.QUERIES if not q.__name__.startswith("stream_")]


def plan_of(spark, name):
    df = entry.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_cross_join(spark, name):
    plan = plan_of(spark, name)
    for node in ("Python", "Arrow", "CartesianProduct", "NestedLoopJoin"):
        assert node not in plan, node


@pytest.mark.parametrize("name", ["daily_top_names", "line_top_names", "topk_by_tick"])
def test_top_rows_are_cut_before_the_shuffle(spark, name):
    plan = plan_of(spark, name)
    partial = plan.index("Partial", plan.index("WindowGroupLimit"))
    assert "Final" in plan[:partial]


@pytest.mark.parametrize("name", ["topk_snapshot", "segment_index"])
def test_limits_are_taken_per_task_first(spark, name):
    assert "TakeOrderedAndProject" in plan_of(spark, name)


@pytest.mark.parametrize("name", [n for n in BATCH if n != "sorted_name_counts"])
def test_no_window_or_sort_over_all_rows(spark, name):
    plan = plan_of(spark, name)
    if name != "materialised_changelog":  # at most K rows are ordered
        assert "rangepartitioning" not in plan
    if "SinglePartition" in plan:  # only behind a partial aggregate
        assert name in ("result_bounds", "last_key")


def test_filters_reach_the_files(spark):
    assert "GreaterThanOrEqual(ts,2024-01-15 11:00:01.0)" in plan_of(spark, "histogram_as_of")
    assert "EqualTo(o_orderdate,1998-10-03 00:00:00.0)" in plan_of(spark, "exact_timestamp")


def test_only_used_columns_are_read(spark):
    assert "ReadSchema: struct<ts:timestamp,event_type:string>" in plan_of(
        spark, "rolling_hour_changelog"
    )
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan_of(spark, "daily_top_names")


@pytest.mark.parametrize("name", ["daily_top_names", "line_top_names"])
def test_words_are_extracted_once(spark, name):
    assert plan_of(spark, name).count("regexp_extract_all") == 1


def test_daily_counts_shuffle_once(spark):
    assert plan_of(spark, "daily_name_counts").count("Exchange") == 1


def test_more_than_a_thousand_top_rows_are_cut_early(spark):
    from namepulse.operators import ranking
    from pyspark.sql import functions as F

    df = spark.range(100_000).select((F.col("id") % 3).alias("g"), "id")
    top = ranking.top_in_group(df, ["g"], [F.col("id")], 5_000)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_mentions_are_added_up_before_they_are_spread(spark):
    plan = plan_of(spark, "topk_by_tick")
    assert "HashAggregate" in plan[plan.index("Generate") :]


def test_shuffles_begin_with_partitions_for_the_input(spark):
    from namepulse.plans import session

    before = spark.conf.get(session.STREAM_PARTITIONS)
    assert session.shuffle_partitions(spark, 0) == int(before)
    assert 35_000 < session.shuffle_partitions(spark, 100 * 10**12) < 45_000
    session.configure(spark, input_bytes=10**12)
    assert int(spark.conf.get(session.INITIAL_PARTITIONS)) == 373
    assert spark.conf.get(session.STREAM_PARTITIONS) == before
    spark.conf.unset(session.INITIAL_PARTITIONS)
    assert session.bytes_below(spark, SF) > 0 == session.bytes_below(spark, SF + "/none")
