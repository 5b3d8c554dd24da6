import random
from datetime import datetime, timedelta

import golden
import pytest
from pyspark.sql import Window, functions as F

from namepulse.operators import changelog, ranking, rolling

EPOCH = datetime(1970, 1, 1)


def mentions(spark, rows):
    data = [(i, n, EPOCH + timedelta(seconds=s)) for i, (n, s) in enumerate(rows)]
    return spark.createDataFrame(data, "id long, name string, timestamp timestamp")


def changes(df):
    return sorted((r.event_sec, r["name"], r["count"], r.op) for r in df.collect())


def random_mentions(seed, n=400, span=20_000):
    """A third of all rows under one name, many of them in one second."""
    r = random.Random(seed)
    rows = [("hot", r.choice([5000, r.randrange(span)])) for _ in range(n // 3)]
    rows += [(f"n{r.randrange(6)}", r.randrange(span)) for _ in range(n - n // 3)]
    r.shuffle(rows)
    return rows


def test_golden_changes(spark):
    got = rolling.rolling_changelog(mentions(spark, golden.ROLLING_INPUT))
    assert changes(got) == sorted(golden.ROLLING_CHANGES)


def test_edges(spark):
    rows = [("d", 0), ("d", 3599), ("e", 0), ("e", 3600), ("Dan-Dee Doe", 10)]
    got = changes(rolling.rolling_changelog(mentions(spark, rows)))
    assert [(s, c, o) for s, n, c, o in got if n == "d"][:2] == [(0, 1, "add"), (3599, 2, "add")]
    assert [(s, c, o) for s, n, c, o in got if n == "e"] == [
        (0, 1, "add"),
        (3600, 0, "expire"),
        (3600, 1, "add"),
        (7200, 0, "expire"),
    ]
    assert (3610, "Dan-Dee Doe", 0, "expire") in got


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("block", [3600, 5000, 86_400])
def test_equals_brute_force(spark, seed, block):
    rows = random_mentions(seed)
    want = golden.brute_force_changes(rows)
    df = mentions(spark, rows)
    assert changes(rolling.rolling_changelog(df, block=block)) == want
    adds = rolling.rolling_adds(df, "id", block=block).collect()
    assert sorted((r.event_sec, r["name"], r["count"], "add") for r in adds) == [
        w for w in want if w[3] == "add"
    ]
    assert len({r.id for r in adds}) == len(rows)


def test_busy_second_is_cut_into_parts(spark, monkeypatch):
    rows = random_mentions(7)
    monkeypatch.setattr(rolling, "PART_ROWS", 5)
    assert changes(rolling.rolling_changelog(mentions(spark, rows))) == golden.brute_force_changes(
        rows
    )


def test_small_chunks_give_the_same_counts(spark, monkeypatch):
    rows = random_mentions(8)
    df = mentions(spark, rows)
    want = {tuple(r) for r in rolling.rolling_adds(df, "id").collect()}
    monkeypatch.setattr(ranking, "RUN_ROWS", 9)
    assert {tuple(r) for r in rolling.rolling_adds(df, "id").collect()} == want


def test_block_shorter_than_window_is_refused(spark):
    with pytest.raises(ValueError):
        rolling.rolling_changelog(mentions(spark, [("a", 1)]), block=100)


def test_histograms(spark):
    rows = random_mentions(4)
    df = mentions(spark, rows)
    for tick in (4500, 9000):
        want = {}
        for n, s in rows:
            if tick - 3600 < s <= tick:
                want[n] = want.get(n, 0) + 1
        at = (EPOCH + timedelta(seconds=tick)).strftime("%Y-%m-%d %H:%M:%S")
        assert {r["name"]: r["count"] for r in rolling.histogram_as_of(df, at).collect()} == want
        by_tick = rolling.histogram_by_tick(df).where(F.col("tick") == tick).collect()
        assert {r["name"]: r["count"] for r in by_tick} == want
    with pytest.raises(ValueError):
        rolling.histogram_by_tick(df, step=1000)


def test_deltas_replay_to_every_snapshot(spark):
    df = mentions(spark, random_mentions(5))
    snapshots = changelog.top_k_by_tick(rolling.histogram_by_tick(df), 3)
    deltas = changelog.tick_deltas(snapshots, 900)
    held = {}
    by_tick = {}
    for r in snapshots.collect():
        by_tick.setdefault(r.tick, {})[r["name"]] = r["count"]
    rows = sorted(deltas.collect(), key=lambda r: r.tick)
    for tick in sorted({r.tick for r in rows}):
        for r in rows:
            if r.tick == tick:
                held[r["name"]] = r["count"]
                if r["count"] == 0:
                    del held[r["name"]]
        assert held == by_tick.get(tick, {})
        replayed = changelog.materialise(deltas.where(F.col("tick") <= tick), "tick")
        if tick % 3600 == 0:
            assert {r["name"]: r["count"] for r in replayed.collect()} == held
    assert held == {}


@pytest.mark.parametrize("scale, run_rows", [(1, 40), (1 << 20, 40), (1 << 20, 4), (1, 1 << 18)])
def test_position_in_group_of_any_size(spark, scale, run_rows):
    r = random.Random(3)
    rows = [("hot" if r.random() < 0.4 else f"g{r.randrange(5)}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, id long").repartition(7)
    df = df.withColumn("id", F.col("id") * scale)
    runs = ranking.order_runs(df, "id", run_rows=run_rows)
    got = ranking.position_in_group(df, ["g"], runs, ["id"], first=F.col("id"))
    w = Window.partitionBy("g")
    want = df.select(
        "g",
        "id",
        F.count(F.lit(1)).over(w).alias("total"),
        F.min("id").over(w).alias("first"),
        (F.row_number().over(w.orderBy("id")) - 1).cast("long").alias("position"),
    )
    columns = want.columns
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(
        map(tuple, want.collect())
    )


@pytest.mark.parametrize("ids", ["id", "id * 1048576", "xxhash64(id)"])
def test_runs_are_few_and_small_whatever_the_ids(spark, ids):
    """One hot group of sparse ids: a run is not a row, and no run is a group."""
    df = spark.range(20_000).selectExpr("if(id % 3 = 0, 'hot', concat('g', id % 5)) AS g", f"{ids} AS id")
    for run_rows in (500, 20):  # with fewer and with more runs than quantiles
        runs = df.withColumn("run", ranking.order_runs(df, "id", run_rows))
        sizes = runs.groupBy("run").agg(F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("b"))
        rows = sizes.orderBy("run").collect()
        assert len(rows) <= 2 * 20_000 / run_rows
        assert max(r["n"] for r in rows) <= 3 * max(run_rows, 20_000 / ranking.QUANTILES)
        assert all(x["b"] < y["a"] for x, y in zip(rows, rows[1:]))


def test_coalesced_updates_and_latest(spark):
    df = rolling.rolling_changes(mentions(spark, golden.ROLLING_INPUT))
    latest = {r["name"]: r["count"] for r in changelog.latest_counts(df).collect()}
    assert latest == {"a": 0, "b": 0, "c": 0}
    got = changelog.coalesced_updates(df, 3600).collect()
    assert sorted((r.flush_sec, r["name"], r["count"]) for r in got) == [
        (0, "a", 2),
        (0, "b", 1),
        (3600, "a", 0),
        (3600, "b", 1),
        (3600, "c", 1),
        (7200, "b", 0),
        (7200, "c", 0),
    ]


def test_ordered_snapshot(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5)], "name string, count long")
    order = lambda **o: [r["name"] for r in changelog.ordered_snapshot(df, **o).collect()]
    assert order() == ["c", "a", "b"]
    assert order(order="asc") == ["a", "b", "c"]
    assert order(by="name", order="desc") == ["c", "b", "a"]
    with pytest.raises(ValueError):
        order(by="size")


def test_snapshot_bounds(spark):
    df = spark.createDataFrame(
        [(1, "b", 2), (1, "a", 2), (1, "c", 5), (2, "z", 1)], "tick long, name string, count long"
    )
    got = {tuple(r) for r in changelog.snapshot_bounds(df, "tick").collect()}
    assert got == {(1, 3, "a", 2), (2, 1, "z", 1)}


def test_increments(spark):
    df = spark.createDataFrame([("a", 2), ("a", 3), ("b", 1)], "name string, increment long")
    got = {r["name"]: r["count"] for r in changelog.increment_totals(df).collect()}
    assert got == {"a": 5, "b": 1}


def test_rows_without_name_or_time_are_no_mentions(spark):
    rows = [(1, None, EPOCH), (2, "a", None), (3, "a", EPOCH + timedelta(seconds=5))]
    df = spark.createDataFrame(rows, "id long, name string, timestamp timestamp")
    assert [tuple(r) for r in rolling.rolling_adds(df, "id").collect()] == [(3, "a", 5, 1)]
    assert changes(rolling.rolling_changelog(df)) == [(5, "a", 1, "add"), (3605, "a", 0, "expire")]
    assert [tuple(r) for r in rolling.histogram_as_of(df, "1970-01-01 00:00:05").collect()] == [
        ("a", 1)
    ]
    assert {r.tick for r in rolling.histogram_by_tick(df).collect()} == {900, 1800, 2700, 3600}


@pytest.mark.parametrize("run_rows", [None, 300, 7])
def test_placed_in_order(spark, run_rows):
    """One group holds two thirds of the rows; ids are sparse; some keys are null."""
    r = random.Random(8)
    ids = r.sample(range(-(10**12), 10**12), 1000)
    rows = [(r.choice(["hot", "hot", "hot", "hot", "a", "b", None]), i) for i in ids]
    df = spark.createDataFrame(rows, "g string, id long").repartition(5)
    got = ranking.placed_in_order(df, ["g"], "id", F.col("id") * 2, run_rows)
    found = sorted((x["g"], x["id"], x["position"], x["total"], x["first"]) for x in got.collect())
    groups = {}
    for g, i in rows:
        groups.setdefault(g, []).append(i)
    groups.pop(None)
    want = [
        (g, i, k, len(own), min(own) * 2) for g, own in groups.items() for k, i in enumerate(sorted(own))
    ]
    assert found == sorted(want)
    assert ranking.placed_in_order(df.limit(0), ["g"], "id").count() == 0
