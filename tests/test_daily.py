import json
import random

import golden
import pytest
from pyspark.sql import functions as F

from namepulse.functions import text
from namepulse.operators import daily
from namepulse.plans import daily as plans
from namepulse.sinks import daily as sinks
from namepulse.sources import records


@pytest.fixture(scope="module")
def record_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("segment")
    half = len(golden.RECORDS) // 2
    for i, lines in enumerate((golden.RECORDS[:half], golden.RECORDS[half:])):
        (folder / f"2015021823{i:02}00.gkg.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


def ranked(df):
    return [tuple(r) for r in df.orderBy("day", "rank").collect()]


TYPED = [
    ("2015-02-18", 1, "Alice Ames", 2),
    ("2015-02-18", 2, "Bob Bell", 2),
    ("2015-02-18", 3, "Cara Cole", 1),
    ("2015-02-18", 4, "SubCategory Art", 1),
    ("2015-02-19", 1, "", 1),
    ("2015-02-19", 2, "Cara Cole", 1),
    ("2015-02-19", 3, "Dan-Dee Doe", 1),
    ("2015-02-20", 1, "SubCategory Art", 1),
]


def test_typed_scan(spark, record_dir):
    scanned = records.read_records(spark, f"{record_dir}/*.gkg.csv")
    assert scanned.columns[0] == "GKGRECORDID" and len(scanned.columns) == 27
    view = records.record_view(scanned)
    assert ranked(plans.top_names_of_records(view)) == TYPED


def test_typed_scan_reads_only_the_columns_used(spark, record_dir):
    top = plans.top_names_of_records(
        records.record_view(records.read_records(spark, record_dir))
    )
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<DATE:timestamp,AllNames:string>" in plan
    assert "IsNotNull(AllNames)" in plan


def test_typed_lines_equal_typed_scan(spark):
    lines = spark.createDataFrame([(r,) for r in golden.RECORDS], "value string")
    view = records.record_view(records.parse_records(lines))
    assert ranked(plans.top_names_of_records(view)) == TYPED


def test_plain_lines(spark, record_dir):
    lines = records.read_lines(spark, record_dir)
    pairs = daily.day_pairs(plans.top_names_of_lines(lines))
    assert sorted(r.value for r in sinks.result_lines(pairs).collect()) == [
        "DateResult(18-02-2015,List((Alice Ames,2),(Cara Cole,1)))",
        "DateResult(19-02-2015,List((,2),(Cara Cole,1)))",
        "DateResult(20-02-2015,List())",
    ]


def test_entry_of_commas_is_an_empty_name(spark):
    lines = spark.createDataFrame(
        [(golden.record_line("k-1", "20150218230000", ",;Bob,1"),)], "value string"
    )
    kept = plans.line_mentions(lines).collect()
    assert sorted(r.name for r in kept) == ["", "Bob"]
    dropped = plans.line_mentions(lines, drop_empty=True, keep_empty_days=False).collect()
    assert [r.name for r in dropped] == ["Bob"]


def test_unclosed_quote_does_not_swallow_a_tab(spark, tmp_path):
    line = golden.record_line("k-1", "20150218230000", "Bob,1").split("\t")
    line[3] = '"open'
    (tmp_path / "a.gkg.csv").write_text("\t".join(line) + "\n")
    row = records.read_records(spark, str(tmp_path)).first()
    assert (row.SourceCommonName, row.AllNames) == ('"open', "Bob,1")


def test_arity_ignores_trailing_empty_fields(spark):
    full = "\t".join(["f"] * 24)
    last_empty = "\t".join(["f"] * 23 + [""])
    lines = spark.createDataFrame([(full,), (last_empty,)], "value string")
    assert records.positional_records(lines).count() == 1


def test_rows_without_a_date_are_dropped(spark):
    rows = spark.createDataFrame(
        [(None, "Bob,1"), (None, None)], "date timestamp, all_names string"
    )
    assert plans.record_mentions(rows).count() == 0


def test_one_name_per_count_cuts_after_collapsing(spark):
    counts = spark.createDataFrame(
        [("d", f"n{i:02}", 1 + i // 2) for i in range(40)], "day string, name string, count long"
    )
    got = ranked(daily.top_names(counts, 10, "one_per_count"))
    assert got == [("d", r, f"n{2 * (20 - r):02}", 21 - r) for r in range(1, 11)]


def test_day_with_only_left_out_names_keeps_its_empty_list(spark):
    lines = spark.createDataFrame(
        [
            (golden.record_line("a-0", "20150101000000", "Category A,1"),),
            (golden.record_line("a-1", "20150102000000", ";", "x"),),
            (golden.record_line("a-2", "20150103000000", "Bob,1;Category A,2"),),
        ],
        "value string",
    )
    pairs = daily.day_pairs(plans.top_names_of_lines(lines)).orderBy("day").collect()
    assert [(r.day, [tuple(p) for p in r.pairs]) for r in pairs] == [
        ("01-01-2015", []),
        ("02-01-2015", []),
        ("03-01-2015", [("Bob", 1)]),
    ]


def test_counts_add_up_to_the_names_kept(spark):
    lines = spark.createDataFrame([(r,) for r in golden.RECORDS], "value string")
    found = plans.line_mentions(lines)
    total = daily.daily_counts(found).agg(F.sum("count")).first()[0]
    assert total == found.where("name is not null").count()


def test_sinks(spark, record_dir, tmp_path):
    view = records.record_view(records.read_records(spark, record_dir))
    pairs = daily.day_pairs(plans.top_names_of_records(view))
    sinks.write_daily_documents(pairs, str(tmp_path / "json"))
    sinks.write_result_lines(pairs, str(tmp_path / "text"))

    documents = {}
    for part in (tmp_path / "json").glob("part-*.json"):
        for line in part.read_text().splitlines():
            d = json.loads(line)
            documents[d["data"]] = d["result"]
    assert documents["2015-02-20"] == [{"topic": "SubCategory Art", "count": 1}]

    texts = [p.read_text() for p in (tmp_path / "text").glob("part-*")]
    assert "DateResult(2015-02-20,List((SubCategory Art,1)))" in "".join(texts)

    from namepulse.schemas import DAILY_RESULT

    back = spark.read.schema(DAILY_RESULT).json(str(tmp_path / "json"))
    cells = daily.ranked_cells(back).where("date = '2015-02-19'").orderBy("rank")
    assert [(r["rank"], r.topic) for r in cells.collect()] == [
        (0, ""),
        (1, "Cara Cole"),
        (2, "Dan-Dee Doe"),
    ]
    shown = [r.value for r in sinks.display_lines(pairs).collect()]
    assert "2015-02-20 : ([SubCategory Art,1])" in shown


def test_sensors(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        "s1,03/10/14:01:01,1,2,3,4,5,6\ns2,03/10/14:01:02,1,2,3,4,5,6\ns3,bad,1,2,3,4,5,6\n"
    )
    rows = records.at_timestamp(
        records.read_sensors(spark, str(tmp_path)), "2014-03-10 01:01:00"
    ).collect()
    assert [tuple(r)[0] for r in rows] == ["s1"] and rows[0].numC == 3


def test_job_of_plain_lines(spark, record_dir, tmp_path, monkeypatch):
    monkeypatch.setenv("DATA_PATH", record_dir)
    monkeypatch.setenv("OUT_PATH", str(tmp_path / "out"))
    plans.write_top_names_of_lines(spark)
    lines = spark.read.text(str(tmp_path / "out"))
    assert "DateResult(20-02-2015,List())" in {r.value for r in lines.collect()}


def test_record_counts_and_merged_maps(spark):
    lines = spark.createDataFrame([(r,) for r in golden.RECORDS[:2]], "value string")
    rows = records.positional_records(lines.selectExpr("value", "left(value, 16) AS k"), keep=["k"])
    counts = daily.record_counts(daily.mentions(rows, keep=["k"]), "k")
    got = {(r.k[-1], r["name"]): r["count"] for r in counts.collect()}
    assert got == {
        ("0", "Alice Ames"): 2,
        ("0", "Bob Bell"): 1,
        ("1", "Bob Bell"): 1,
        ("1", "Cara Cole"): 1,
    }
    maps = spark.createDataFrame(
        [({"a": 1, "b": 2}, {"b": 3, "c": 4})], "l map<string,long>, r map<string,long>"
    )
    merged = maps.select(text.merge_count_maps("l", "r").alias("m")).first()["m"]
    assert merged == {"a": 1, "b": 5, "c": 4}


def test_result_bounds(spark):
    counts = spark.createDataFrame(
        [("2015-01-02", "a", 3), ("2015-01-01", "b", 7)], "day string, name string, count long"
    )
    assert tuple(daily.result_bounds(counts).first()) == ("2015-01-01", "2015-01-02", 7)


def test_fields_are_the_same_with_lines_repaired_before_or_after(spark, tmp_path):
    lines = [
        golden.record_line("k-0", "20150218230000", "B@b,1;Al@").encode(),
        golden.record_line("k-1", "20150218230000", "", "@").encode(),
        golden.record_line("k-2", "2015@0218230000", "Bob,1").encode(),
    ]
    raw = b"\n".join(line.replace(b"@", b"\xff") for line in lines) + b"\n"
    (tmp_path / "a.txt").write_bytes(raw)
    for shape in (records.positional_records, records.line_view):
        clean, late = (
            sorted(map(str, shape(records.read_lines(spark, str(tmp_path), clean=c)).collect()))
            for c in (True, False)
        )
        assert clean == late
    names = records.positional_records(records.read_lines(spark, str(tmp_path), clean=False))
    assert sorted(r.all_names for r in names.collect()) == ["Bb,1;Al", "Bob,1"]


def test_arity_of_random_lines(spark):
    r = random.Random(1)
    lines = ["\t".join(r.choice(["", "x"]) for _ in range(r.randrange(20, 29))) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(lines)), "i long, value string")
    kept = {row.i for row in records.positional_records(df, keep=["i"]).collect()}
    want = {i for i, line in enumerate(lines) if len(line.rstrip("\t").split("\t")) > 23}
    assert kept == want and 0 < len(kept) < 500


def test_line_view_equals_typed_scan(spark, record_dir):
    typed = records.record_view(records.read_records(spark, record_dir))
    view = records.line_view(records.read_lines(spark, record_dir, clean=False))
    assert sorted(map(str, view.collect())) == sorted(map(str, typed.collect()))
    short = spark.createDataFrame([("k\t20150218230000",), ("",)], "value string")
    got = {(r.record_id, str(r.date), r.all_names) for r in records.line_view(short).collect()}
    assert got == {("k", "2015-02-18 23:00:00", None), ("", "None", None)}
