"""WARC archives as a Spark data source, written and read in Python.

`df.write.format("warc")` makes one file of records per task, each record a gzip member of its
own, and names the files in a manifest once all tasks have ended. `spark.read.format("warc")`
plans a partition for every file, takes predicates on record type and other header fields, parses
a record's header first and decodes and checks the payload only of records that pass. With the
option `payload` = false no payload is decoded at all.

Predicates are given when an archive is loaded (`where` of `read`), and each load has its own.
Spark 4.1 keeps the filters that it pushed last with the loaded relation, for all scans of it: an
archive filtered in two ways, or filtered and then read whole, would lose rows. So the source
takes none from Spark's plans; `DataFrame.where` is right on any archive, but reads all headers
and payloads.

Records are response or revisit, by WARC 1.1: ids are URNs of UUIDs, a response's block is an
HTTP response, a revisit names its profile and refers to the response with an equal payload and
carries none itself. Fields of our own keep the page's id, and the payload's length. A member's
gzip header says how long it is, so that a payload that nobody wants is neither inflated nor read.

With the option `manifest` = false all `.warc` and `.warc.gz` files of a folder are read, or one
file, by whoever they were written: plain, a member for each record, or gzipped as a whole, with
records of any type. What is no WARC record, or ends in the middle of one, is an error.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, Not, StringStartsWith,
    WriterCommitMessage,
)

from .shared import hot_join, kept, prepared

SCHEMA = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
    "payload_digest string, record_id string, refers_to_record string, warc_date string, payload binary"
)
FIELDS = [c.split()[0] for c in SCHEMA.split(", ")]
ARROW = pa.schema(
    [(c, {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t])
     for c, t in (x.split() for x in SCHEMA.split(", "))]
)
# What a record's header alone decides.
HEADER_FIELDS = [c for c in FIELDS if c not in ("payload", "payload_bytes")]
MANIFEST = "_manifest.json"

# Payloads below this many bytes are stored every time.
LEAST_BYTES = 100

# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http; msgtype=response"

# The name space of the ids of pages' records.
PAGES = uuid.uuid5(uuid.NAMESPACE_URL, "urn:page")

_READ_AT_ONCE = 1 << 20
_HEAD_AT_ONCE = 4096
MAX_HEADER = 1 << 20


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)


def _one_line(value: str) -> str:
    """A header value may not hold a line end."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def _escaped(value: str) -> str:
    return _one_line(value.replace("%", "%25"))


def _as_given(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record_id(page_id: int | None, *other) -> str:
    """The URN of a page's record; of a page without an id by what else is known of it."""
    name = f"id {page_id}" if page_id is not None else repr(other)
    return f"<{uuid.uuid5(PAGES, name).urn}>"


def http_head(length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


def record(row: dict, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One record: header, empty line, HTTP response, two line ends."""
    payload, page = row["payload"] or b"", row["page_id"]
    block = http_head(row["payload_bytes"]) + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: {record_id(page, row['url'], row['payload_digest'])}",
        f"WARC-Date: {date}",
    ]
    if page is not None:
        lines.append(f"Page-ID: {page}")
    if row["url"] is not None:
        lines.append(f"WARC-Target-URI: {_one_line(row['url'])}")
        if _one_line(row["url"]) != row["url"]:
            lines.append(f"Page-URL: {_escaped(row['url'])}")
    if row["refers_to"] is not None:
        lines += [
            f"WARC-Profile: {PROFILE}",
            f"WARC-Refers-To: {record_id(row['refers_to'])}",
            f"Refers-To-Page-ID: {row['refers_to']}",
        ]
    lines += [
        f"WARC-Payload-Digest: sha256:{row['payload_digest']}",
        f"Payload-Length: {row['payload_bytes']}",
        f"Content-Type: {HTTP}",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


# A gzip header with one extra field, WL: the member's whole length.
_GZIP = struct.Struct("<2sBBIBBH2sHQ")


def member(data: bytes, level: int) -> bytes:
    """Data as a gzip member that says how long it is."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    length = _GZIP.size + len(body) + 8
    head = _GZIP.pack(b"\x1f\x8b", 8, 4, 0, 0, 255, 12, b"WL", 8, length)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def _fields(block: bytes) -> dict[str, str]:
    """The named fields of a header, names in lower case; of a repeated one the first."""
    lines = block.decode("utf-8", "surrogateescape").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    found: dict[str, str] = {}
    name = ""
    for line in lines[1:]:
        if line[:1] in (" ", "\t"):  # goes on from the line before
            found[name] = f"{found.get(name, '')} {line.strip()}"
            continue
        name, colon, value = line.partition(":")
        name = name.strip().lower()
        if not colon:
            raise ValueError(f"no header field: {line[:40]!r}")
        found.setdefault(name, value.strip())
    return found


def _whole(value: str | None) -> int | None:
    return int(value) if value else None


def _header(block: bytes) -> dict:
    fields = _fields(block)
    url = fields.get("warc-target-uri")
    if "page-url" in fields:
        url = _as_given(fields["page-url"])
    elif url is not None and url[:1] == "<" and url[-1:] == ">":
        url = url[1:-1]
    digest = fields.get("warc-payload-digest")
    if "warc-type" not in fields or not fields.get("content-length", "").isdigit():
        raise ValueError("a WARC record without type or length")
    return {
        "page_id": _whole(fields.get("page-id")),
        "url": url,
        "record_type": fields["warc-type"],
        "refers_to": _whole(fields.get("refers-to-page-id")),
        "payload_bytes": _whole(fields.get("payload-length")),
        "payload_digest": None if digest is None else digest.removeprefix("sha256:"),
        "record_id": fields.get("warc-record-id"),
        "refers_to_record": fields.get("warc-refers-to"),
        "warc_date": fields.get("warc-date"),
        "length": int(fields["content-length"]),
        "http": fields.get("content-type", "").lower().replace(" ", "").startswith("application/http"),
    }


def _unchunked(body: bytes) -> bytes:
    """An HTTP body without the marks of its chunks."""
    parts, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        size = int(body[at:end].split(b";")[0] or b"0", 16)
        if not size:
            break
        parts.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size + 2
    return b"".join(parts)


def _payload(header: dict, block: bytes) -> bytes:
    """What a block carries: the body of an HTTP message, else all of it."""
    if not header["http"]:
        return block
    head, _, body = block.partition(b"\r\n\r\n")
    chunked = any(
        line.lower().replace(b" ", b"").startswith(b"transfer-encoding:chunked") for line in head.split(b"\r\n")
    )
    return _unchunked(body) if chunked else body


class _Records:
    """The records of a file, whether plain or gzipped, in members of one record each or not.

    `inflated` counts the bytes that came out of compressed members.
    """

    def __init__(self, file):
        self.file, self.inflated = file, 0
        self.raw, self.ready = b"", b""  # read but not inflated; inflated but not taken
        self.inflate = None
        self.ends_at: int | None = None  # where the member ends, if it says so
        self.taken = 0  # bytes of records taken since the member began
        self.gzipped = self._more(2) and self.raw[:2] == b"\x1f\x8b"

    def _more(self, n: int) -> bool:
        """Have n raw bytes, unless the file ends."""
        while len(self.raw) < n and (data := self.file.read(max(n, _READ_AT_ONCE))):
            self.raw += data
        return len(self.raw) >= n

    def _begin_member(self) -> bool:
        if not self._more(1):
            return False
        at = self.file.tell() - len(self.raw)
        self.inflate, self.ends_at, self.taken = zlib.decompressobj(31), None, 0
        if self._more(_GZIP.size):
            *_, flags, _, _, _, extra, name, _, length = _GZIP.unpack(self.raw[: _GZIP.size])
            if flags == 4 and extra == 12 and name == b"WL":
                self.ends_at = at + length
        return True

    def _fill(self, most: int) -> bool:
        """Make more bytes ready, if there are any."""
        if not self.gzipped:
            if not self._more(1):
                return False
            self.ready, self.raw = self.ready + self.raw, b""
            return True
        while True:
            if self.inflate is None and not self._begin_member():
                return False
            if not self._more(1) and not self.inflate.eof:
                raise EOFError("a gzip member ends too early")
            out = self.inflate.decompress(self.raw, most)
            self.inflated += len(out)
            self.raw = self.inflate.unconsumed_tail or (self.inflate.unused_data if self.inflate.eof else b"")
            if self.inflate.eof:
                self.inflate = None
            if out:
                self.ready += out
                return True

    def _take(self, n: int, keep: bool = True) -> bytes:
        parts, left = [], n
        while left:
            if not self.ready and not self._fill(min(left, _READ_AT_ONCE)):
                raise EOFError("a record ends too early")
            part, self.ready = self.ready[:left], self.ready[left:]
            left -= len(part)
            if keep:
                parts.append(part)
        self.taken += n
        return b"".join(parts)

    def _head(self) -> bytes | None:
        """A record's header without the empty line; none at the end of the file."""
        searched = 0
        while (end := self.ready.find(b"\r\n\r\n", max(0, searched - 3))) < 0:
            searched = len(self.ready)
            if searched > MAX_HEADER:
                raise ValueError("no end of a WARC header")
            if not self._fill(_HEAD_AT_ONCE):
                if self.ready.strip(b"\r\n"):
                    raise EOFError("a record ends within its header")
                return None
        return self._take(end + 4)[:end]

    def _skip(self, n: int) -> None:
        """Pass over the rest of a record; to the next member, if this one says where it ends."""
        if self.ends_at is None or self.inflate is None:
            self._take(n, keep=False)
            return
        self.file.seek(self.ends_at)
        self.raw, self.ready, self.inflate = b"", b"", None

    def records(self, wanted: Callable[[dict], bool]) -> Iterator[tuple[dict, bytes | None]]:
        """(header, payload) of each record; None for a payload that `wanted(header)` declines."""
        while (head := self._head()) is not None:
            head = head.lstrip(b"\r\n")  # some writers leave more line ends than two
            header = _header(head)
            if wanted(header):
                payload = _payload(header, self._take(header["length"]))
                self._take(4)
                yield header, payload
            else:
                self._skip(header["length"] + 4)
                yield header, None


@dataclass
class _Written(WriterCommitMessage):
    file: str
    records: int


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, level: int):
        self.path, self.level = path.rstrip("/"), level

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        """A file of a name of its own, so that a second attempt cannot harm the first."""
        system, root = _file_system(self.path)
        system.create_dir(root, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        n = 0
        with system.open_output_stream(f"{root}/{name}", compression=None) as out:
            for batch in iterator:
                for row in batch.to_pylist():
                    out.write(member(record(row, date), self.level))
                    n += 1
        return _Written(name, n)

    def commit(self, messages: list[_Written | None]) -> None:
        system, root = _file_system(self.path)
        system.create_dir(root, recursive=True)
        files = sorted((m.file, m.records) for m in messages if m is not None)
        with system.open_output_stream(f"{root}/{MANIFEST}") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list[_Written | None]) -> None:
        system, root = _file_system(self.path)
        for m in messages:
            if m is not None:
                system.delete_file(f"{root}/{m.file}")


COMPARE: dict[type, Callable] = {
    EqualTo: lambda own, value: own == value,
    In: lambda own, values: own in values,
    StringStartsWith: lambda own, value: own.startswith(value),
}


def _test(f) -> tuple[str, type, object, bool] | None:
    """(field, comparison, value, whether it is to hold) of a filter on a header field."""
    if isinstance(f, Not):
        inner = _test(f.child)
        return inner and inner[3] and (*inner[:3], False) or None
    if type(f) not in COMPARE or len(f.attribute) != 1 or f.attribute[0] not in HEADER_FIELDS:
        return None
    # A null in a list matches nothing, and leaves the negated list undecided: also no match.
    value = tuple(f.value) if isinstance(f, In) else f.value
    return f.attribute[0], type(f), value, True


# The comparisons of `read`'s predicates.
KINDS = {"=": EqualTo, "in": In, "starts with": StringStartsWith}


def _filter(field: str, how: str, value):
    """One predicate of `read` as a filter of the data source."""
    kind = KINDS.get(how.removeprefix("not "))
    if kind is None:
        raise ValueError(f"no comparison {how!r}")
    found = kind((field,), tuple(value) if kind is In else value)
    return Not(found) if how.startswith("not ") else found


def _holds(header: dict, test: tuple) -> bool:
    """SQL's answer: a null on either side is no match, negated or not."""
    field, kind, value, positive = test
    own = header[field]
    if own is None or value is None:
        return False
    if kind is In:
        found = own in [v for v in value if v is not None]
        return found if positive else not found and None not in value
    return COMPARE[kind](own, value) is positive


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool, manifest: bool = True):
        self.path, self.payload, self.manifest = path.rstrip("/"), payload, manifest
        self.tests: list[tuple] = []

    def pushFilters(self, filters):
        """Equality and IN on header fields are answered from headers; Spark need not look again.

        Prefixes and negations spare payloads as well, but Spark looks again; ranges are Spark's.
        """
        for f in filters:
            test = _test(f)
            if test:
                self.tests.append(test)
            if not (test and isinstance(f, (EqualTo, In))):
                yield f

    @classmethod
    def of(cls, path: str, payload: bool, manifest: bool, where: list[list]) -> WarcReader:
        """A reader of the records that pass `where`, as `read` takes it."""
        reader = cls(path, payload, manifest)
        left = list(WarcReader.pushFilters(reader, [_filter(*test) for test in where]))
        if any(_test(f) is None for f in left):
            raise ValueError(f"predicates are on {', '.join(HEADER_FIELDS)}")
        return reader

    def partitions(self) -> list[InputPartition]:
        system, root = _file_system(self.path)
        if not self.manifest:
            info = system.get_file_info(root)
            if info.type == fs.FileType.File:
                return [InputPartition("")]
            files = system.get_file_info(fs.FileSelector(root, recursive=True))
            names = [i.path.removeprefix(root).lstrip("/") for i in files if i.type == fs.FileType.File and i.size]
            return [InputPartition(n) for n in sorted(names) if n.endswith((".warc", ".warc.gz"))]
        with system.open_input_stream(f"{root}/{MANIFEST}") as file:
            files = json.loads(file.read())
        return [InputPartition(name) for name, records in files if records]

    def _passes(self, header: dict) -> bool:
        return all(_holds(header, test) for test in self.tests)

    def read(self, partition: InputPartition | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # Spark reads one partition also where none is planned
            return
        system, root = _file_system(self.path)
        rows, size = [], 0
        wanted = self._passes if self.payload else lambda header: False
        with system.open_input_file(f"{root}/{partition.value}".rstrip("/")) as file:
            for header, payload in _Records(file).records(wanted):
                if not self._passes(header):
                    continue
                digest = header["payload_digest"] or ""
                whole = payload is not None and header["record_type"] == "response" and ":" not in digest and digest
                if whole and hashlib.sha256(payload).hexdigest() != digest.lower():
                    raise ValueError(f"the payload of {header['page_id'] or header['record_id']} is not what was written")
                if header["payload_bytes"] is None and payload is not None:
                    header["payload_bytes"] = len(payload)
                rows.append({**{c: header[c] for c in FIELDS[:-1]}, "payload": payload})
                size += len(payload or b"")
                if len(rows) >= 1_000 or size >= 16 << 20:
                    yield pa.RecordBatch.from_pylist(rows, ARROW)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, ARROW)


class LoadedReader(WarcReader):
    """Keeps to the predicates that it was loaded with; see the module."""

    pushFilters = DataSourceReader.pushFilters


class Warc(DataSource):
    """Options: path; level, of compression (1); payload, false to leave payloads out; manifest,
    false for files of any origin; where, JSON of the predicates that `read` takes."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        payload, manifest = (self.options.get(o, "true").lower() == "true" for o in ("payload", "manifest"))
        return LoadedReader.of(self.options["path"], payload, manifest, json.loads(self.options.get("where", "[]")))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], int(self.options.get("level", "1")))


def register(spark: SparkSession) -> None:
    """Make the format known to the session."""
    prepared(spark)
    spark.dataSource.register(Warc)


def records(
    pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = LEAST_BYTES
) -> DataFrame:
    """Pages as records. Of equal payloads of least_bytes or more the smallest id's is the response.

    A null html is an empty payload. Rows without an id are responses; so are repeated rows of
    the response's own id. A hot payload is split over tasks: only (digest, smallest id) of the
    payloads that occur more than once are joined to the pages.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload")
    )
    rows = rows.withColumn("payload_digest", F.sha2("payload", 256)).withColumn(
        "payload_bytes", F.octet_length("payload").cast("bigint")
    )
    copies = kept(
        rows.where(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 AND first IS NOT NULL")
        .drop("n"),
        "copies",
    )
    joined = hot_join(rows, copies, ["payload_digest", "payload_bytes"], "left")
    revisit = F.col("page_id") > F.col("first")
    return joined.select(
        "page_id",
        "url",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"),
        "payload_bytes",
        "payload_digest",
        F.when(revisit, F.lit(b"")).otherwise(F.col("payload")).alias("payload"),
    )


def write(pages: DataFrame, path: str, **options) -> None:
    """Archive the pages below path."""
    register(pages.sparkSession)
    records(pages, **options).write.format("warc").mode("append").save(path)


def read(spark: SparkSession, path: str, payload: bool = True, where: Sequence[tuple] = ()) -> DataFrame:
    """The records of an archive that pass all of `where`: (header field, comparison, value).

    Comparisons are `=`, `in` (a list) and `starts with`, or these after `not `, with SQL's
    answer for nulls on either side. They are decided by headers: a record that fails costs
    neither its payload nor a row.
    """
    return _load(spark, path, payload, where, manifest=True)


def read_files(spark: SparkSession, path: str, payload: bool = True, where: Sequence[tuple] = ()) -> DataFrame:
    """The records of a `.warc` or `.warc.gz` file, or of all below a folder, whoever wrote them.

    `payload_bytes` is null where the header does not say it and the payload is not read; a
    digest by another function than SHA-256 keeps its name, and is not checked. `where` is as
    for `read`.
    """
    return _load(spark, path, payload, where, manifest=False)


def _load(spark: SparkSession, path: str, payload: bool, where: Sequence[tuple], manifest: bool) -> DataFrame:
    register(spark)
    given = [(field, how, list(value) if how.endswith("in") else value) for field, how, value in where]
    for test in given:
        if test[0] not in HEADER_FIELDS:
            raise ValueError(f"predicates are on {', '.join(HEADER_FIELDS)}")
        _filter(*test)
    options = {"payload": str(payload).lower(), "manifest": str(manifest).lower(), "where": json.dumps(given)}
    return spark.read.format("warc").options(**options).load(path)


def digests(archive: DataFrame) -> DataFrame:
    """Per page what the archive says of it; a response's length and digest come from its payload."""
    response = F.col("record_type") == "response"
    return archive.select(
        "page_id",
        F.when(response, F.octet_length("payload").cast("bigint")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )
