"""Archives by other hands, predicates with nulls, and payloads that are not inflated."""

import gzip
import io
import itertools
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import InputPartition

from namepulse.llm import warc
from test_llm_tables import pages_of


def by_hand(kind, block, *fields, name="warcinfo"):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{name}>", "WARC-Date: 2015-02-18T23:00:00Z"]
    lines += [*fields, f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


PAGE = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>h\xc3\xa9</p>"
CHUNKED = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n4;x=y\r\n<p>a\r\n5\r\nb</p>\r\n0\r\n\r\n"
RECORDS = [
    by_hand("warcinfo", b"software: by hand\r\n", "Content-Type: application/warc-fields"),
    by_hand("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", "content-type:application/http;msgtype=request", "WARC-Target-URI: <http://a/>"),
    by_hand("response", PAGE, "Content-Type: application/http; msgtype=response", "WARC-Target-URI: http://a/",
            "WARC-Payload-Digest: sha1:ABC", "X-Folded: one", " two"),
    by_hand("response", CHUNKED, "Content-Type: application/http; msgtype=response"),
    by_hand("resource", b"\r\n\r\nraw", "Content-Type: text/plain"),
    by_hand("metadata", b"", "Content-Type: text/plain"),
]
PAYLOADS = [b"software: by hand\r\n", b"", "<p>h\u00e9</p>".encode(), b"<p>ab</p>", b"\r\n\r\nraw", b""]


@pytest.mark.parametrize("form", ["plain", "members", "whole", "halves"])
def test_archives_by_other_hands(spark, tmp_path, form):
    data = b"".join(RECORDS)
    files = {
        "plain": ("x.warc", data),
        "members": ("x.warc.gz", b"".join(map(gzip.compress, RECORDS))),
        "whole": ("x.warc.gz", gzip.compress(data)),
        "halves": ("x.warc.gz", gzip.compress(data[:333]) + gzip.compress(data[333:])),
    }
    name, content = files[form]
    (tmp_path / name).write_bytes(content)
    (tmp_path / "notes.txt").write_bytes(b"no archive")
    for path in (tmp_path, tmp_path / name):
        rows = warc.read_files(spark, str(path)).collect()
        assert [bytes(r["payload"]) for r in rows] == PAYLOADS
        assert [r["record_type"] for r in rows] == ["warcinfo", "request", "response", "response", "resource", "metadata"]
        assert [r["payload_bytes"] for r in rows] == list(map(len, PAYLOADS))
        assert (rows[2]["url"], rows[2]["payload_digest"], rows[2]["page_id"]) == ("http://a/", "sha1:ABC", None)
        assert rows[1]["url"] == "http://a/" and rows[0]["warc_date"] == "2015-02-18T23:00:00Z"
    assert warc.read_files(spark, str(tmp_path)).where("record_type = 'response'").count() == 2
    none = warc.read_files(spark, str(tmp_path), payload=False).collect()
    assert [r["payload"] for r in none] == [None] * 6


@pytest.mark.parametrize(
    "content",
    [
        b"no archive at all",
        b"WARC/1.1\r\nWARC-Type: response\r\n",
        b"WARC/1.1\r\nWARC-Type: response\r\n\r\n",
        b"WARC/1.1\r\nno field\r\nContent-Length: 0\r\n\r\n\r\n\r\n",
        RECORDS[2][:-30],
        gzip.compress(b"x" * 3_000_000),
        gzip.compress(RECORDS[2])[:-20],
        gzip.compress(RECORDS[2][:60]),
        warc.member(RECORDS[2], 1)[:60],
    ],
)
def test_broken_files_are_errors(tmp_path, content):
    (tmp_path / "x.warc.gz").write_bytes(content)
    for payload in (True, False):
        with pytest.raises((ValueError, EOFError)):
            list(warc.WarcReader(str(tmp_path), payload, False).read(InputPartition("x.warc.gz")))


def test_an_empty_file_has_no_records(tmp_path):
    (tmp_path / "x.warc").write_bytes(b"")
    assert list(warc.WarcReader(str(tmp_path), True, False).read(InputPartition("x.warc"))) == []


def test_files_hold_what_the_format_asks_for(spark, tmp_path):
    body = "<p>" + "x" * 200
    out = str(tmp_path / "archive")
    warc.write(pages_of(spark, [(1, "http://a/?q=%41", body), (2, "http://b/", body), (None, "u", "short"), (3, "a\r\n%0Ab", "é")]), out)
    found = {}
    for name in os.listdir(out):
        if name.endswith(".gz"):
            with gzip.open(f"{out}/{name}") as file:  # also by a reader that knows no lengths
                data = file.read()
            records = warc._Records(io.BytesIO(data))
            while (head := records._head()) is not None:
                fields = warc._fields(head)
                found[fields.get("page-id")] = fields, records._take(int(fields["content-length"]))
                assert records._take(4) == b"\r\n\r\n"
    assert len(found) == 4
    for fields, block in found.values():
        assert {"warc-type", "warc-record-id", "warc-date", "content-length"} <= set(fields)
        assert fields["warc-record-id"].startswith("<urn:uuid:") and block.startswith(b"HTTP/1.1 200 OK\r\n")
    assert found["2"][0]["warc-profile"] == warc.PROFILE
    assert found["2"][0]["warc-refers-to"] == found["1"][0]["warc-record-id"]
    assert found["1"][0]["warc-target-uri"] == "http://a/?q=%41"
    assert {r["page_id"]: r["url"] for r in warc.read(spark, out).collect()}[3] == "a\r\n%0Ab"


CONDITIONS = ["= {0}", "IN ({0}, NULL)", "NOT IN ({0}, {1})", "NOT IN ({0}, NULL)", "<> {0}", "IS NULL", "IS NOT NULL",
              "> {0}", "<= {0}", "<=> NULL", "<=> {0}"]


def test_predicates_are_sparks_own(spark, tmp_path):
    """Every condition on every header field gives what Spark gives on the rows themselves."""
    body = "x" * 150
    out = str(tmp_path / "archive")
    rows = [(1, "u1", body), (2, "u2", body), (3, None, body), (None, "u1", "a"), (5, "", "b"), (6, "NULL", None)]
    warc.write(pages_of(spark, rows), out)
    archive = warc.read(spark, out)
    plain = spark.createDataFrame(archive.collect(), archive.schema)
    digest = plain.first()["payload_digest"]
    for field, one, two in (("page_id", "1", "2"), ("refers_to", "1", "2"), ("url", "'u1'", "'u2'"),
                            ("record_type", "'revisit'", "'x'"), ("payload_digest", f"'{digest}'", "'x'")):
        conditions = [c.format(one, two) for c in CONDITIONS]
        conditions += [f"LIKE {one[:-1]}%'"] if one[0] == "'" else []
        whole = " AND ".join([f"{field} IN ({one}, NULL)", "record_type = 'revisit'"])
        for condition in [f"{field} {c}" for c in conditions] + [whole]:
            want, got = (sorted(map(str, df.where(condition).drop("payload").collect())) for df in (plain, archive))
            assert got == want, condition


COMPARISONS = {"=": "{f} = {v}", "not =": "NOT {f} = {v}", "in": "{f} IN {v}", "not in": "{f} NOT IN {v}",
               "starts with": "startswith({f}, {v})", "not starts with": "NOT startswith({f}, {v})"}


def sql(value):
    if isinstance(value, list):
        return f"({', '.join(map(sql, value))})"
    return "NULL" if value is None else repr(value)


def test_predicates_of_a_load_are_sparks_own(spark, tmp_path):
    """Every comparison on every header field, nulls included, and several at once."""
    body = "x" * 150
    out = str(tmp_path / "archive")
    rows = [(1, "u1", body), (2, "u2", body), (3, None, body), (None, "u1", "a"), (5, "", "b"), (6, "NULL", None)]
    warc.write(pages_of(spark, rows), out)
    plain = spark.createDataFrame(warc.read(spark, out).collect(), warc.SCHEMA)
    cases = []
    for field, one, two in (("page_id", 1, 2), ("refers_to", 1, 2), ("url", "u1", "u"), ("record_type", "revisit", "x")):
        for how in COMPARISONS:
            if how.endswith("in"):
                values = [one, two], [one, None], [None]
            elif how.endswith("with"):
                values = (one[:1], "") if isinstance(one, str) else ()
            else:
                values = one, two, None
            cases += [[(field, how, v)] for v in values]
    cases.append([("url", "starts with", "u"), ("page_id", "not in", [2, 9]), ("record_type", "=", "response")])
    fields = warc.FIELDS[:-1]
    for where in cases:
        condition = " AND ".join(COMPARISONS[how].format(f=f, v=sql(v)) for f, how, v in where)
        want, got = (sorted(map(str, df.select(fields).collect()))
                     for df in (plain.where(condition), warc.read(spark, out, where=where)))
        assert got == want, where
    for where in ([("payload", "=", "x")], [("payload_bytes", "=", 1)], [("no", "=", 1)], [("url", ">", "u")]):
        with pytest.raises(ValueError):
            warc.read(spark, out, where=where)


def test_an_archive_may_be_filtered_in_several_ways(spark, tmp_path):
    """Spark shares what it pushed between the scans of one relation; nothing may get lost by it."""
    out = str(tmp_path / "archive")
    body = "x" * 150
    warc.write(pages_of(spark, [(i, f"u{i % 2}", body if i < 4 else str(i)) for i in range(10)]), out)
    key = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(key)
    try:
        for on in ("true", "false"):
            spark.conf.set(key, on)
            archive = warc.read(spark, out)
            revisits, third = archive.where("record_type = 'revisit'"), archive.where("page_id = 3")
            assert (revisits.count(), third.count(), archive.count()) == (3, 1, 10)
            assert revisits.union(third).count() == 4 and third.union(archive).count() == 11
            firsts = archive.alias("a").join(archive.alias("b"), F.col("a.refers_to") == F.col("b.page_id"))
            assert firsts.where("a.record_type = 'revisit' AND b.record_type = 'response'").count() == 3
            loaded = warc.read(spark, out, where=[("record_type", "=", "revisit")])
            assert loaded.where("page_id = 3").count() == 1 and loaded.count() == 3
    finally:
        spark.conf.set(key, before)


def test_declined_payloads_are_not_inflated(tmp_path):
    rows = [{"page_id": i, "url": "u", "record_type": "response" if i else "revisit", "refers_to": None,
             "payload_bytes": 300_000, "payload_digest": "", "payload": os.urandom(300_000)} for i in range(20)]
    data = b"".join(warc.member(warc.record(r), 1) for r in rows)
    records = warc._Records(io.BytesIO(data))
    headers = [h for h, p in records.records(lambda h: False)]
    assert [h["page_id"] for h in headers] == list(range(20))
    assert records.inflated <= 20 * warc._HEAD_AT_ONCE
    records = warc._Records(io.BytesIO(data))
    found = {h["page_id"]: p for h, p in records.records(lambda h: h["page_id"] in (3, 19))}
    assert found[3] == rows[3]["payload"] and found[19] == rows[19]["payload"] and found[4] is None
    assert records.inflated < 3 * 310_000


def test_records_with_any_sizes(tmp_path):
    """Headers and payloads that end at every place of a read."""
    for head, size in itertools.product((0, 3800, 4096, 9000), (0, 1, 4095, 4096, 70_000)):
        row = {"page_id": 1, "url": "u" * head, "record_type": "response", "refers_to": None, "payload_bytes": size,
               "payload_digest": "", "payload": b"z" * size}
        data = warc.member(warc.record(row), 1) * 2 + gzip.compress(warc.record(row))
        for keep in (True, False):
            found = [p for _, p in warc._Records(io.BytesIO(data)).records(lambda h: keep)]
            assert found == [row["payload"] if keep else None] * 3
