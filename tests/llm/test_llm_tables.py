"""Operators that group, join, write or read tables, against plain Python."""

import gzip
import hashlib
import os
import re
import zlib
from itertools import combinations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql.datasource import EqualTo, GreaterThan, InputPartition
from tokenizers import Tokenizer

from namepulse.llm import components, html_text, packing, simhash, token_files, warc
from namepulse.llm.tokens import public_path

SCHEMA = "doc_id long, text string, first string, rows string"
EDGE = [None, "", " \n", "word", "a b c d e", "é ü " * 2000]


def docs_of(spark, texts, parts=3):
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


# --- components and simhash --------------------------------------------------------


def brute_components(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    edges = [tuple(map(int, e)) for e in rng.integers(0, 120, (70, 2))]
    edges += [(i, i + 1) for i in range(1000, 1060)] + [(2000, 2000 + i) for i in range(1, 40)] + [(5, 5)]
    found = components.components(spark.createDataFrame(edges, "a long, b long"))
    want = brute_components([e for e in edges if e[0] != e[1]])
    assert {r["node"]: r["root"] for r in found.collect()} == want
    assert found.count() == len(want)


def test_components_of_nothing(spark):
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@given(st.lists(st.sampled_from(["A", "b", "é", "c\n", "\t", " "]), max_size=40).map(" ".join))
@settings(max_examples=200, deadline=None)
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


def test_tree_finds_all_within_the_radius():
    rng = np.random.default_rng(4)
    base = [int(x) for x in rng.integers(0, 2**63, 40)]
    values = sorted({b ^ (1 << int(i)) ^ (1 << int(j)) for b in base for i, j in rng.integers(0, 64, (6, 2))})
    tree = simhash.BKTree()
    for i, v in enumerate(values):
        tree.add(v, i)
    for v in values[::7]:
        assert set(tree.within(v, 4)) == {i for i, w in enumerate(values) if (v ^ w).bit_count() <= 4}


@pytest.mark.parametrize("max_tree", [2048, 5])
def test_links_connect_what_is_linked(spark, max_tree):
    """Also with shards far beyond one tree, and values that are near each other in masses."""
    rng = np.random.default_rng(6)
    center = int(rng.integers(0, 2**62))
    values = {center ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 63, (60, 2))}
    at = center ^ (2**40 - 1)
    for _ in range(30):
        bits = rng.choice(63, 4, replace=False)
        at ^= sum(1 << int(b) for b in bits)
        values.add(at)
    values |= {int(x) for x in rng.integers(0, 2**62, 50)}
    values |= {0, 15, 15 << 20, -1, -16}
    table = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    found = [(r["a"], r["b"]) for r in simhash.links(table, 4, max_tree).collect()]
    mask = 2**64 - 1
    true = [(a, b) for a, b in combinations(sorted(values), 2) if ((a ^ b) & mask).bit_count() <= 4]
    assert {tuple(sorted(x)) for x in found} <= set(true)
    assert brute_components(found) == brute_components(true)


def test_near_duplicates(spark):
    long_ = [f"w{i}" for i in range(400)]
    texts = [*EDGE, " ".join(long_), " ".join(long_[:-1] + ["other"]), " ".join(long_), "B a", "b A", None]
    docs = docs_of(spark, texts)
    got = {r["doc_id"]: (r["fingerprint"] & 2**64 - 1, r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    prints = [brute_fingerprint(t or "") for t in texts]
    edges = [(i, i) for i in range(len(texts))] + [
        (i, j) for i, j in combinations(range(len(texts)), 2) if (prints[i] ^ prints[j]).bit_count() <= 4
    ]
    root = brute_components(edges)
    assert got == {i: (p, root[i]) for i, p in enumerate(prints)}
    firsts = simhash.first_of_each(docs)
    assert firsts.columns == docs.columns
    assert sorted(r["doc_id"] for r in firsts.collect()) == sorted(set(root.values()))
    # Repeated rows stay once, rows without an id stay, an empty table stays empty.
    more = docs.union(docs).union(spark.createDataFrame([(None, "no id here", "x", "y")], SCHEMA))
    again = [r["doc_id"] for r in simhash.first_of_each(more).collect()]
    assert sorted(x for x in again if x is not None) == sorted(set(root.values())) and None in again
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.first_of_each(docs.limit(0)).count() == 0


# --- token files -------------------------------------------------------------------


def library_ids(file, texts, end):
    t = Tokenizer.from_file(public_path(file))
    t.encode_special_tokens = True
    return [e.ids + [end] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_round_trip(spark, tmp_path):
    rng = np.random.default_rng(9)
    texts = [*EDGE, *[" ".join(f"w{i % 97}," for i in range(n)) for n in rng.integers(0, 300, 60)]]
    out = str(tmp_path / "files")
    token_files.write(docs_of(spark, texts), out, public_path("byte_bpe_50k.json"))
    ids = library_ids("byte_bpe_50k.json", texts, 2)
    starts = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    files = token_files.read(spark, out)
    assert {r["doc_id"]: r["ids"] for r in files.collect()} == dict(enumerate(ids))
    got = {tuple(r) for r in token_files.digests(files).collect()}
    assert got == {(i, int(starts[i]), len(x), crc(x)) for i, x in enumerate(ids)}
    some = token_files.read(spark, out, [3, 10_000])
    assert [r["doc_id"] for r in some.collect()] == [3]
    assert "doc_id" in some._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]


def test_token_files_hold_indexes_filters_and_runs(spark, tmp_path):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'a b c' AS text")
    token_files.write(docs, str(tmp_path / "files"), public_path("byte_bpe_50k.json"))
    orc, hadoop = spark._jvm.org.apache.orc, spark._jvm.org.apache.hadoop.fs
    file = next(f for f in (tmp_path / "files").iterdir() if f.suffix == ".orc")
    options = orc.OrcFile.readerOptions(spark._jsc.hadoopConfiguration())
    reader = orc.OrcFile.createReader(hadoop.Path(str(file)), options)
    assert reader.getRowIndexStride() == token_files.ROW_INDEX_ROWS
    footer = reader.rows().readStripeFooter(reader.getStripes().get(0))
    kinds = {(s.getColumn(), s.getKind().toString()) for s in footer.getStreamsList()}
    assert {(1, "BLOOM_FILTER_UTF8"), (1, "ROW_INDEX"), (6, "DATA")} <= kinds
    # Integers are run-length encoded by the second version of the format.
    assert footer.getColumnsList()[6].getKind().toString() == "DIRECT_V2"


def test_token_files_edges(spark, tmp_path):
    docs = docs_of(spark, ["a"])
    token_files.write(docs.limit(0), str(tmp_path / "none"), public_path("byte_bpe_50k.json"))
    assert token_files.digests(token_files.read(spark, str(tmp_path / "none"))).count() == 0
    more = docs.union(docs).union(spark.createDataFrame([(None, "b", "", "")], SCHEMA))
    token_files.write(more, str(tmp_path / "more"), public_path("byte_bpe_50k.json"))
    got = token_files.digests(token_files.read(spark, str(tmp_path / "more"))).orderBy("start").collect()
    assert [(r["doc_id"], r["start"], r["n_tokens"]) for r in got] == [(None, 0, 2), (0, 2, 2), (0, 4, 2)]


# --- packing -----------------------------------------------------------------------


def check_plan(counts, capacity):
    runs = packing.plan(counts, capacity)
    placed, bins = {}, {}
    ends = {}
    for r in sorted(runs):
        ends.setdefault(r.length, []).append(r.rank)
    for r in runs:
        later = [x for x in ends[r.length] if x > r.rank]
        n = (later[0] if later else counts[r.length]) - r.rank
        for k in range(n):
            placed[r.length] = placed.get(r.length, 0) + 1
            bins.setdefault(r.first_bin + k // r.per_bin, []).append((r.offset + k % r.per_bin * r.length, r.length))
    assert placed == {n: c for n, c in counts.items() if c}
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
        assert sum(3 * length > capacity for _, length in items) <= 2
    assert sorted(bins) == list(range(len(bins)))
    return len(bins)


@given(st.dictionaries(st.integers(1, 30), st.integers(0, 25), max_size=20))
@settings(max_examples=300, deadline=None)
def test_plan_is_gapless_and_tight(counts):
    n = check_plan(counts, 30)
    rooms = []  # first fit, longest first
    for length in sorted((k for k, c in counts.items() for _ in range(c)), reverse=True):
        k = next((k for k, room in enumerate(rooms) if room >= length), None)
        if k is None:
            rooms.append(30 - length)
        else:
            rooms[k] -= length
    assert -(-sum(k * c for k, c in counts.items()) // 30) <= n <= 1.1 * len(rooms) + 1


def test_large_items_are_matched_optimally():
    assert check_plan({20: 2, 11: 1, 10: 0, 19: 1}, 30) == 3
    assert check_plan({16: 4, 14: 4}, 30) == 4
    assert check_plan({15: 5}, 30) == 3


def test_packing(spark):
    rng = np.random.default_rng(11)
    texts = [*EDGE, *[" ".join(["word"] * int(n)) for n in rng.integers(0, 60, 80)], "word " * 30]
    docs = docs_of(spark, texts)
    got = packing.pack(docs, public_path("word_bpe_49k.json"), capacity=32).collect()
    ids = library_ids("word_bpe_49k.json", texts, 0)
    want = {(i, k // 32, k, len(x[k : k + 32]), crc(x[k : k + 32])) for i, x in enumerate(ids) for k in range(0, len(x), 32)}
    assert {tuple(r)[:5] for r in got} == want and len(got) == len(want)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 32
    assert len(bins) <= 1.05 * sum(len(x) for x in ids) / 32 + 1
    empty = packing.pack(docs.limit(0), public_path("word_bpe_49k.json"))
    assert empty.count() == 0 and "sequence_id" in empty.columns
    assert packing.pack(docs.union(docs), public_path("word_bpe_49k.json")).count() >= 2 * len(texts)


# --- pages -------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, host string, templates string, part string"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], PAGES)


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""),
        ("plain  words &amp; more", "plain words & more"),
        ("<article><h1>T&eacute;<br>x</h1><p>a<p>b <b>c</article><footer>f</footer>", "Té x\n\na\n\nb c"),
        ("<body><nav>n</nav><p>a</p><div class='ad'>x</div><ul><li>1<li>2</ul></body>", "a\n\n1\n\n2"),
        ("<header>h</header><main><p>m</p></main><p>out</p>", "m"),
        ("<article><header><h1>T</h1></header>x<script>var a='</p>'</script>y</article>", "T\n\nxy"),
        ("<p>a<!-- <p>no</p> --> b</p><style>p{}</style><p title='>'>c", "a b\n\nc"),
        ("<article>a<section id=comments>c</section><form>f</form></article>", "a"),
        ("<table><tr><td>1<td>2<tr><td>3</table></div></p>", "1\n\n2\n\n3"),
        ("<div hidden>h</div><div role=navigation>n</div>t", "t"),
        ("a < b & c &lt; d<br/>e", "a < b & c < d e"),
        ("<p>" * 3000 + "deep" + "<div>" * 3000 + "er", "deep\n\ner"),
    ],
)
def test_main_text(html, text):
    assert html_text.extract(html) == text


def test_site_templates_are_removed(spark):
    def page(i, host, extra=""):
        return (i, f"https://u@{host}:80/p{i}", f"<body><div><p>Subscribe to us</p></div>{extra}<p>Text {i}.</p></body>")

    rows = [page(i, "A.example") for i in range(8)] + [page(100 + i, "b.example") for i in range(3)]
    # A page that is copied a lot is no template; nor is an article's own paragraph.
    rows += [(200 + i, "http://c.example/", "<p>copied text</p><p>more of it</p>") for i in range(9)]
    rows += [(300 + i, "http://d.example/", f"<article><p>same</p><p>{i}</p></article>") for i in range(9)]
    rows += [(400, None, "<p>x</p>"), (401, "no url", None), (402, "http://a.example/q", "<div><p>Subscribe to us</p></div>")]
    pages = pages_of(spark, rows)
    want = {i: f"Text {i}." for i in range(8)}
    want |= {100 + i: f"Subscribe to us\n\nText {100 + i}." for i in range(3)}
    want |= {200 + i: "copied text\n\nmore of it" for i in range(9)}
    want |= {300 + i: f"same\n\n{i}" for i in range(9)}
    want |= {400: "x", 401: "", 402: ""}
    for most_sent in (10, 0):  # broadcast, and dealt by host
        found = html_text.with_text(pages, most_sent=most_sent)
        assert found.columns == [*pages.columns, "main_text"]
        assert {r["page_id"]: r["main_text"] for r in found.collect()} == want
    assert html_text.with_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    "html, text",
    [
        ("<div style='overflow:hidden'><article><p>a</p></article></div>", "a"),
        ("<p>a <a href='/docs/hidden/x'>b</a> <span aria-hidden=false>c</span></p>", "a b c"),
        ("<p>a <a href='/q?id=search'>b</a> <a href=/q?id=search>c</a> <i title='class=ad'>d</i></p>", "a b c d"),
        ("<article><h2 id='social-history'>a</h2><section id=related-work>b</section></article>", "a\n\nb"),
        ("<article>a<div id=related-posts>b</div><p ID=comments>c</p></article>", "a\n\nc"),
        ("<div data-x='y' HIDDEN>a</div><div id='site-footer'>b</div><div data-id=ad>c</div>", "c"),
    ],
)
def test_attributes_are_read_one_by_one(html, text):
    assert html_text.extract(html) == text


def test_pages_that_differ_in_prose_only_are_different(spark):
    block = "<div class=cta>Follow us for more</div>"
    rows = [(i, "http://a.example/", f"<article><h1>Own {i}</h1><p>own</p>{block}</article>") for i in range(20)]
    # One text in many frames is a copy each time.
    rows += [(100 + i, "http://b.example/", f"<main><div>b</div></main><i>{i}</i>") for i in range(20)]
    want = {i: f"Own {i}\n\nown" for i in range(20)} | {100 + i: "b" for i in range(20)}
    assert {r["page_id"]: r["main_text"] for r in html_text.with_text(pages_of(spark, rows)).collect()} == want


def test_what_names_drop_is_counted_too(spark):
    def page(i):
        frame = "<nav><ul><li><a>Home</a></ul></nav>", "<div class=ad>Buy</div>", "<footer>f</footer>"
        return f"<body>{frame[0]}{frame[1]}<p>Text <a>Home</a> {i}</p>{frame[2]}<footer>{i}</footer></body>"

    pages = pages_of(spark, [(i, "http://a.example/", page(i)) for i in range(8)])
    (row,) = html_text.templates(pages).collect()
    root = html_text.parsed(page(0))
    html_text.hashed(root, set())
    body = root.children[0]
    dropped = {e.hash for e in body.children if e.name in ("nav", "div", "footer")}
    assert len(dropped & set(row["templates"])) == 3
    only_by_count = html_text.parsed(page(0))
    html_text.hashed(only_by_count, set())
    for e in only_by_count.children[0].children:
        e.dropped = False
    known = set(row["templates"])
    assert "Buy" not in html_text.text_of(only_by_count, lambda h: h in known)


def test_archive_round_trip(spark, tmp_path):
    body = "<p>" + "é" * 100
    rows = [(5, "http://a/\r\nx%0A", body), (3, None, body), (4, "u", body), (1, "u", None), (2, "u", ""), (6, "u", "short"),
            (7, "u", "short"), (8, "u", "\r\n\r\n" * 50_000), (None, "u", body)]
    pages = pages_of(spark, rows).repartition(3)
    out = str(tmp_path / "archive")
    warc.write(pages, out)
    assert all(f.endswith(".warc.gz") or "manifest" in f or f.startswith(".") for f in os.listdir(out))
    back = {r["page_id"]: r for r in warc.read(spark, out).collect()}
    kinds = {i: (r["record_type"], r["refers_to"]) for i, r in back.items()}
    assert kinds == {3: ("response", None), 4: ("revisit", 3), 5: ("revisit", 3), None: ("response", None)} | {
        i: ("response", None) for i in (1, 2, 6, 7, 8)
    }
    for i, url, html in rows:
        assert back[i]["url"] == url
        whole = (html or "").encode()
        assert back[i]["payload_bytes"] == len(whole)
        assert bytes(back[i]["payload"]) == (b"" if back[i]["record_type"] == "revisit" else whole)
    digests = warc.digests(warc.read(spark, out)).collect()
    assert {r["page_id"]: r["payload_digest"] for r in digests} == {i: r["payload_digest"] for i, r in back.items()}


def test_archive_predicates_and_skipped_payloads(spark, tmp_path):
    body = "x" * 200
    out = str(tmp_path / "archive")
    warc.write(pages_of(spark, [(i, f"u{i % 2}", body if i < 3 else str(i)) for i in range(6)]), out)
    revisits = warc.read(spark, out).where("record_type = 'revisit' AND page_id IN (1, 2, 4)")
    assert sorted(r["page_id"] for r in revisits.collect()) == [1, 2]
    assert [r["page_id"] for r in warc.read(spark, out).where("page_id = 3 AND length(url) > 1").collect()] == [3]
    assert warc.read(spark, out, payload=False).where("payload IS NOT NULL").count() == 0
    reader = warc.WarcReader(out, True)
    other = GreaterThan(("page_id",), 3)
    assert list(reader.pushFilters([EqualTo(("record_type",), "revisit"), other])) == [other]
    asked = []
    for part in reader.partitions():
        for batch in reader.read(part):
            asked += batch["record_type"].to_pylist()
    assert asked == ["revisit", "revisit"]


def test_archive_that_was_changed_is_refused(tmp_path):
    row = {"page_id": 1, "url": "u", "record_type": "response", "refers_to": None, "payload_bytes": 3,
           "payload_digest": hashlib.sha256(b"abc").hexdigest(), "payload": b"abd"}
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress(warc.record(row)))
    part = InputPartition("x.warc.gz")
    with pytest.raises(ValueError):
        list(warc.WarcReader(str(tmp_path), True).read(part))
    (batch,) = warc.WarcReader(str(tmp_path), False).read(part)  # the payload is not looked at
    assert batch["page_id"].to_pylist() == [1]


def test_archive_of_nothing_and_unfinished(spark, tmp_path):
    out = str(tmp_path / "none")
    warc.write(pages_of(spark, []), out)
    assert warc.read(spark, out).count() == 0
    os.makedirs(tmp_path / "half")
    (tmp_path / "half" / "part-00000-x.warc.gz").write_bytes(b"")
    with pytest.raises(Exception):
        warc.read(spark, str(tmp_path / "half")).count()
