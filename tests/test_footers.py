"""Bounds and newest rows from Parquet footers."""

from namepulse.sources import footers


def test_bounds_read_no_data_page(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 1000, 1, 4).selectExpr("id * 3 AS k", "id AS v").write.parquet(path)
    settings = [spark.conf.get(k) for k in (footers._PUSHDOWN, footers._FIRST_API)]
    with footers._from_footers(spark):
        plan = footers.bounds_plan(spark, path, "k")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MIN(k), MAX(k), COUNT(*)]" in plan and "ReadSchema: struct<min(k):bigint,max(k):bigint,count(*):bigint>" in plan
    assert footers.bounds(spark, path, "k") == (0, 2997, 1000)
    assert [spark.conf.get(k) for k in (footers._PUSHDOWN, footers._FIRST_API)] == settings


def test_newest_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(50).selectExpr("id % 10 AS k", "id AS v").write.parquet(path)
    newest = footers.newest_rows(spark, path, "k")
    assert sorted(r["v"] for r in newest.collect()) == [9, 19, 29, 39, 49]
    assert "PushedFilters: [IsNotNull(k), EqualTo(k,9)]" in newest._jdf.queryExecution().executedPlan().toString()


def test_bounds_of_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0).selectExpr("id AS k").write.parquet(path)
    assert footers.bounds(spark, path, "k", "k long") == (None, None, 0)
    assert footers.newest_rows(spark, path, "k", "k long").count() == 0
    nulls = str(tmp_path / "n")
    spark.range(5).selectExpr("CAST(NULL AS BIGINT) AS k").write.parquet(nulls)
    assert footers.bounds(spark, nulls, "k") == (None, None, 5)
    assert footers.newest_rows(spark, nulls, "k").count() == 0
