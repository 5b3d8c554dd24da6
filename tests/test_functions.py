from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from namepulse.functions import messages, text, times


def one(spark, column, value, type_="string"):
    df = spark.createDataFrame([(value,)], f"v {type_}")
    return df.select(column.alias("r")).first()["r"]


def java_split(s, sep):
    if s == "":
        return [""]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@pytest.mark.parametrize("value", ["", ";", ";;", "a", "a;b", "a;;b;;", ";a", None])
def test_split_trimmed(spark, value):
    got = one(spark, text.split_trimmed("v", ";"), value)
    assert got == (None if value is None else java_split(value, ";"))


@pytest.mark.parametrize("sep", [";", "|", "\t", ".", "-", "\\", "^", "a"])
@settings(
    max_examples=1,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(rows=st.lists(st.text(alphabet=";|\t.-\\^ab", max_size=12), min_size=200, max_size=200))
def test_split_trimmed_any_separator(spark, sep, rows):
    df = spark.createDataFrame([(r,) for r in rows], "v string")
    for r in df.select("v", text.split_trimmed("v", sep).alias("p")).collect():
        assert r.p == java_split(r.v, sep)


def test_separator_must_be_one_character():
    with pytest.raises(ValueError):
        text.split_trimmed("v", "ab")


@pytest.mark.parametrize(
    "entry, name", [("a,1", "a"), ("a", "a"), (",5", ""), (",", ""), ("", ""), ("a,b,c", "a")]
)
def test_before_first(spark, entry, name):
    assert one(spark, text.before_first("v", ","), entry) == name


def test_name_list(spark):
    names = "Alice,1;,;SubCategory Art,3;;Bob,2;"
    assert one(spark, text.name_list("v"), names) == ["Alice", "Bob"]
    kept = one(spark, text.name_list("v", exclude=("ParentCategory",), drop_empty=False), names)
    assert kept == ["Alice", "", "SubCategory Art", "", "Bob"]


def test_first_field_keeps_trailing_empties(spark):
    assert one(spark, text.first_field("v"), "k\t\t") == "k"
    assert one(spark, text.first_field("v"), "\t\t") == ""


@pytest.mark.parametrize(
    "key, want",
    [
        ("20150218230000-0", (20150218230000, 0)),
        ("abc", (0, 0)),
        ("1-2-3", (0, 0)),
        ("1-", (0, 0)),
        ("-1", (0, 0)),
        ("1-2-", (1, 2)),
        (" 1-2", (0, 0)),
        ("1-99999999999999999999", (0, 0)),
        ("", (0, 0)),
    ],
)
def test_record_key(spark, key, want):
    assert tuple(one(spark, text.record_key("v"), key)) == want


@pytest.mark.parametrize(
    "raw, want",
    [(b"a\xffb", "ab"), (b"a\xe2\x82b", "ab"), ("é€".encode(), "é€"), (b"\xff", "")],
)
def test_drop_malformed_utf8(spark, raw, want):
    column = text.drop_malformed_utf8(F.col("v").cast("string"))
    assert one(spark, column, bytearray(raw), "binary") == want


def at(s):
    return datetime.fromisoformat(f"2015-02-18 {s}")


@pytest.mark.parametrize(
    "now, floor, following",
    [
        ("22:00:00", "22:00:00", "22:15:00"),
        ("22:14:59", "22:00:00", "22:15:00"),
        ("22:15:00", "22:15:00", "22:30:00"),
        ("22:59:30", "22:45:00", "23:00:00"),
    ],
)
def test_boundaries(spark, now, floor, following):
    assert one(spark, times.floor_to("v"), at(now), "timestamp") == at(floor)
    assert one(spark, times.next_boundary("v"), at(now), "timestamp") == at(following)


def test_interval_must_divide_an_hour():
    with pytest.raises(ValueError):
        times.floor_to("v", 25)


def test_segment_names(spark):
    names = times.segment_names("v", 60, extension=".csv")
    assert one(spark, names, at("23:37:12"), "timestamp") == [
        "20150218223000.csv",
        "20150218224500.csv",
        "20150218230000.csv",
        "20150218231500.csv",
    ]
    single = times.segment_names("v", 15)
    assert one(spark, single, at("23:37:12"), "timestamp") == ["20150218231500"]


def test_segment_start_of_key(spark):
    key = times.segment_start_of_key("v")
    assert one(spark, key, "20150218231542-7") == at("23:15:00")
    assert one(spark, key, "nothing") is None


def test_days(spark):
    assert one(spark, times.day_of_digits("v"), "20150218230000") == "18-02-2015"
    assert one(spark, times.day_of_digits("v", times.DAY), "20150218") == "2015-02-18"
    assert one(spark, times.day_of_digits("v"), "2015") is None
    assert one(spark, times.day_text("v"), at("23:00:00"), "timestamp") == "2015-02-18"
    assert str(one(spark, times.parse_day("v"), "2015-02-18")) == "2015-02-18"


def test_sensor_time_is_on_the_12_hour_clock(spark):
    assert one(spark, times.parse_sensor_time("v"), "03/10/14:01:01") == datetime(
        2014, 3, 10, 1, 1
    )
    assert one(spark, times.parse_sensor_time("v"), "03/10/14:13:01") is None
    assert one(spark, times.parse_sensor_time("v", hours_24=True), "03/10/14:13:01") == datetime(
        2014, 3, 10, 13, 1
    )


@pytest.mark.parametrize(
    "p, total, passed",
    [(1, 4, 225_000), (1, 7, 128_571), (3, 7, 385_714), (1, 900_001, 0), (900_000, 900_001, 899_999)],
)
def test_spread_step(spark, p, total, passed):
    df = spark.createDataFrame([(at("23:00:00"), p, total)], "s timestamp, p long, t long")
    start = df.select(F.unix_millis("s")).first()[0]
    assert df.select(times.spread_millis("s", "p", "t")).first()[0] - start == passed


def test_lines_of_a_large_segment_are_spread(spark):
    """Two million lines: times do not fall, fill the interval and stay inside it."""
    n = 2_000_000
    start = F.lit("2015-02-18 23:00:00").cast("timestamp")
    ms = spark.range(n).select("id", times.spread_millis(start, "id", F.lit(n)).alias("ms"))
    first = ms.select(F.unix_millis(start)).first()[0]
    low, high, different = ms.agg(F.min("ms"), F.max("ms"), F.count_distinct("ms")).first()
    assert (low - first, high - first, different) == (0, 899_999, 900_000)
    assert ms.where(F.col("ms") != first + F.expr("id * 900000 div 2000000")).count() == 0


def test_messages(spark):
    df = spark.createDataFrame([([("z", 4), ("x", 0)],)], "u array<struct<name:string,count:long>>")
    text_ = df.select(messages.update_message("u")).first()[0]
    assert text_ == '[{"name":"x","count":0},{"name":"z","count":4}]'
    quoted = spark.createDataFrame([([('a"b\\', 1)],)], df.schema)
    message = quoted.select(messages.update_message("u").alias("v"))
    back = message.select(messages.parse_updates("v").alias("r")).first()["r"]
    assert [tuple(u) for u in back] == [('a"b\\', 1)]


def test_parse_single_update(spark):
    got = one(spark, messages.parse_updates("v"), '{"name": "x", "count": 3}')
    assert [tuple(u) for u in got] == [("x", 3)]
    got = one(spark, messages.parse_increments("v"), '{"name": "x", "increment": 3}')
    assert [tuple(u) for u in got] == [("x", 3)]


def test_names_of_all_languages(spark):
    from namepulse.sources import tables

    df = spark.createDataFrame([("F\u00fcr \u00c9lan, Asunci\u00f3n e\u0301 E\u0301lan x USA \u00df",)], "text string")
    assert df.select(tables.document_names()).first()[0] == "F\u00fcr,0;\u00c9lan,1;Asunci\u00f3n,2;E\u0301lan,3"


def test_malformed_text_gives_the_same_names_everywhere(spark, tmp_path):
    """A genuine replacement character stays in valid lines; in broken ones both go."""
    from namepulse.sources import records
    from namepulse.streaming import rolling

    def line(key, names):
        return b"\t".join([key, b"20150218230000", *[b""] * 21, names, b"", b"", b"x"])

    sign = "\ufffd".encode()
    data = [line(b"k1", b"A" + sign + b"B,1"), line(b"k2", b"C" + sign + b"D\xff,1;E\xc3,2")]
    (tmp_path / "lines.txt").write_bytes(b"\n".join(data))
    want = {"A\ufffdB,1", "CD,1;E,2"}
    whole = records.read_lines(spark, str(tmp_path))
    raw = records.read_lines(spark, str(tmp_path), clean=False)
    for lines in (whole, raw):
        assert {r.all_names for r in records.positional_records(lines).collect()} == want
        assert {r.all_names for r in records.line_view(lines).collect()} == want
    stream = raw.selectExpr("'k' AS key", "value", "timestamp'2015-02-18 23:00:00' AS timestamp", "0L AS offset")
    got = {r["name"] for r in rolling.record_mentions(stream).collect()}
    assert got == {"A\ufffdB", "CD", "E"}
