"""URL lists and WARC derivatives against brute force, and WARC files read back."""
import datetime as dt
import hashlib
import re
from pathlib import Path
from urllib.parse import urlsplit

import pytest
from pyspark.sql import functions as F

from ledgerwise.llm import url_lists as UL
from ledgerwise.llm import warc as WA

D = dt.date
EVENTS = [
    ("bad", "block", "domain", "spam.test", D(2024, 1, 10), "add"),
    ("bad", "block", "domain", "spam.test", D(2024, 3, 1), "remove"),
    ("bad", "block", "domain", "spam.test", D(2024, 5, 1), "add"),
    ("bad", "block", "domain", "spam.test", D(2024, 5, 1), "add"),
    ("bad", "block", "domain", "spam.test", D(2024, 6, 1), "add"),
    ("ads", "block", "domain", "x.spam.test", D(2024, 2, 1), "add"),
    ("ok", "allow", "prefix", "x.spam.test/good", D(2024, 2, 10), "add"),
    ("ok", "allow", "domain", "x.spam.test", D(2024, 7, 1), "add"),
    ("day", "block", "domain", "day.test", D(2024, 2, 1), "add"),
    ("day", "block", "domain", "day.test", D(2024, 2, 1), "remove"),
    ("gone", "block", "domain", "gone.test", D(2024, 2, 1), "remove"),
    ("bad", "block", "prefix", "p.test/a/b", D(2023, 1, 1), "add"),
    (None, "block", "domain", "null.test", D(2023, 1, 1), "add"),
    ("bad", "block", "domain", None, D(2023, 1, 1), "add"),
]
URLS = ["http://spam.test/", "https://WWW.Spam.Test:8080/q?x#y", "http://notspam.test/", "http://x.spam.test/good/1", "http://u:p@x.spam.test/goodish",
        "http://a.x.spam.test./", "http://day.test", "http://gone.test/", "http://p.test/a/b", "http://p.test/a//b/c?d", "http://p.test/a/bc",
        "http://null.test/", "no url", "", None, "http:///path", "ftp://p.test/a/b/"]


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(EVENTS, "list string, verb string, kind string, pattern string, dated date, action string")


def brute(url, day):
    if url is None or day is None:
        return (False, None, None, 0)
    try:
        parts = urlsplit(url)
    except ValueError:
        return (False, None, None, 0)
    host = (parts.hostname or "").rstrip(".").removeprefix("www.")
    if not host or not parts.scheme:
        return (False, None, None, 0)
    path = host + "/" + "/".join(p for p in parts.path.split("/") if p) + "/"
    hits = []
    for entry in {e[:4] for e in EVENTS if None not in e}:
        state = ""
        for d in sorted({e[4] for e in EVENTS if e[:4] == entry and e[4] <= day}):
            state = max(e[5] for e in EVENTS if e[:4] == entry and e[4] == d)
        ok = host == entry[3] or host.endswith("." + entry[3]) if entry[2] == "domain" else path.startswith(entry[3] + "/")
        if state == "add" and ok:
            hits.append(entry)
    if not hits:
        return (False, None, None, 0)
    best = min(hits, key=lambda e: (-len(e[3]), e[1], e[0], e[3]))
    return (best[1] == "block", best[0], best[3], len(hits))


def test_url_lists_match_brute_force(spark, events):
    days = [D(2023, 12, 1), D(2024, 1, 9), D(2024, 1, 10), D(2024, 2, 9), D(2024, 2, 29), D(2024, 3, 1), D(2024, 5, 2), D(2024, 8, 1), None]
    rows = [(i, u, d, "clash", 7) for i, (u, d) in enumerate((u, d) for u in URLS for d in days)]
    rows += [rows[0], rows[5], (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, fetched_on date, pattern string, day int").repartition(3)
    out = UL.judge(df, events)
    assert out.columns == ["page_id", "url", "fetched_on", "day", "blocked", "list", "pattern", "n_active"]
    got = sorted(((r.page_id, r.blocked, r.list, r.pattern, r.n_active) for r in out.collect()), key=repr)
    want = sorted(((r[0], *brute(r[1], r[2])) for r in rows), key=repr)
    assert got == want
    assert {x[2] for x in got} >= {"bad", "ads", "ok"}
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop",
                         UL.judge(df, events)._jdf.queryExecution().executedPlan().toString())


def test_url_lists_empty(spark, events):
    df = spark.createDataFrame([(1, "http://spam.test/", D(2024, 2, 1))], "page_id long, url string, fetched_on date")
    assert UL.judge(df.limit(0), events).count() == 0
    assert [(r.blocked, r.n_active) for r in UL.judge(df, events.limit(0)).collect()] == [(False, 0)]


RESPONSES = [
    ("<urn:uuid:1>", "http://a.test/", "2024-01-01T00:00:00Z", "HTTP/1.1 200 OK\r\nServer: x\r\n",
     "<html><title> T &amp; </title><script>var a='<p>';</script><body><!-- c --><p>One <b>two</b>&nbsp;&lt;3&gt; "
     "<a class=x href=\"/l1\">x</a><br>né</p><style>p{}</style><A HREF=\"l2\">y</A></body>"),
    ("<urn:uuid:2>", None, "2024-01-01T00:00:00Z", None, None),
    ("<urn:uuid:3>", "http://b.test/", None, "", ""),
    (None, "http://c.test/", "d", "h: 1\n", "plain < text\n\n\n  two " + "z" * 200_000),
    ("<urn:uuid:1>", "http://a.test/", "2024-01-01T00:00:00Z", "HTTP/1.1 200 OK\r\nServer: x\r\n", "<p>again"),
]
SCHEMA = "record_id string, target_uri string, warc_date string, http_headers string, payload string"


@pytest.fixture(scope="module")
def responses(spark):
    return spark.createDataFrame(RESPONSES, SCHEMA).withColumns({c: F.lit(c) for c in ("text", "fields", "r", "html", "block")})


def test_derivatives(responses):
    got = [r.asDict() for r in WA.derivatives(responses).collect()]
    assert len(got) == 2 * len(RESPONSES)
    by = {(r["record_type"], r["refers_to"], r["source_digest"]): r for r in got}
    for rid, uri, date, headers, payload in RESPONSES:
        source = "sha256:" + hashlib.sha256((payload or "").encode()).hexdigest()
        text, meta = by["conversion", rid or "", source], by["metadata", rid or "", source]
        for r in (text, meta):
            assert (r["target_uri"], r["warc_date"]) == (uri, date)
            assert r["content_length"] == len(r["block"].encode())
            assert r["block_digest"] == "sha256:" + hashlib.sha256(r["block"].encode()).hexdigest()
        assert meta["concurrent_to"] == text["record_id"] != meta["record_id"]
    first = by["conversion", "<urn:uuid:1>", "sha256:" + hashlib.sha256(RESPONSES[0][4].encode()).hexdigest()]
    assert first["block"] == "T &\nOne two <3> x\nné\ny"
    meta = by["metadata", "<urn:uuid:1>", first["source_digest"]]["block"]
    assert meta.split("\r\n") == ["title: T &amp;", "outlink: /l1", "outlink: l2", "source-header: HTTP/1.1 200 OK", "source-header: Server: x", ""]
    assert by["conversion", "<urn:uuid:2>", "sha256:" + hashlib.sha256(b"").hexdigest()]["block"] == ""
    assert WA.derivatives(responses.limit(0)).count() == 0


def read_warc(data: bytes):
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        head = dict(x.split(": ", 1) for x in lines[1:])
        n = int(head["Content-Length"])
        block = data[end + 4:end + 4 + n]
        assert data[end + 4 + n:end + 8 + n] == b"\r\n\r\n"
        at = end + 8 + n
        yield head, block


def test_warc_files_read_back(responses, tmp_path):
    records = WA.derivatives(responses)
    WA.write_warc(records, str(tmp_path / "out"))
    found = [x for f in sorted(Path(tmp_path / "out").glob("part-*")) for x in read_warc(f.read_bytes())]
    want = sorted((r.record_type, r.record_id, r.refers_to, r.source_digest, r.block) for r in records.collect())
    assert sorted((h["WARC-Type"], h["WARC-Record-ID"], h["WARC-Refers-To"], h["WARC-Source-Payload-Digest"], b.decode()) for h, b in found) == want
    for h, b in found:
        assert h["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(b).hexdigest()


ODD_PAGE = """<html><title> one\r\nWARC-Type: fake\ttwo </title>
<a href='single'>1</a><a href = "sp aced">2</a><a class=x href=bare>3</a><A\nHREF
=\n'up "q"'>4</A><a data-href="no" href="a\nb">5</a><a name="x">6</a><a href="">7</a><abbr href="no">8</abbr>
It&#8217;s &#x1F600; &#65; &amp;#65; &#38;lt; &amp;amp; &#0; &#xD800; &#99999999; &lt;b&gt; &quot;q&quot; &#39;s&#39;</html>"""


def test_odd_titles_links_and_entities(spark):
    from html import unescape
    from html.parser import HTMLParser

    class Links(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=False)
            self.found = []

        def handle_starttag(self, tag, attrs):
            if tag == "a":
                self.found += [v for k, v in attrs if k == "href"]

    parser = Links()
    parser.feed(ODD_PAGE)
    rows = [("<urn:uuid:9>", "http://a.test/\r\nX: y", "d", "HTTP/1.1 200 OK\r\n", ODD_PAGE)]
    got = {r.record_type: r for r in WA.derivatives(spark.createDataFrame(rows, SCHEMA)).collect()}
    lines = got["metadata"].block.split("\r\n")
    assert lines[0] == "title: one WARC-Type: fake two" and all("\n" not in x and "\r" not in x for x in lines)
    links = [x[len("outlink: "):] for x in lines if x.startswith("outlink: ")]
    assert links == [v.replace("\n", "").replace(" ", "%20") for v in parser.found] == ["single", "sp%20aced", "bare", "up%20\"q\"", "ab", ""]
    last = got["conversion"].block.split("\n")[-1]
    want = unescape("It&#8217;s &#x1F600; &#65; &amp;#65; &#38;lt; &amp;amp; &#0; &#xD800; &#99999999; &lt;b&gt; &quot;q&quot; &#39;s&#39;")
    assert last.endswith(want), (last, want)
    head = WA.serialized(WA.derivatives(spark.createDataFrame(rows, SCHEMA))).first().record.split("\r\n\r\n")[0]
    assert "WARC-Target-URI: http://a.test/ X: y" in head.split("\r\n")
