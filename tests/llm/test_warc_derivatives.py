import glob
import gzip
import hashlib
import json
import uuid
from collections import Counter
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.llm import warc_derivatives as wd
from quarry.llm.common import scratch_dir

PAGE = """<!DOCTYPE html><html><head><title>A &amp;
 B</title><style>p{x:1}</style><script src=/s.js>var t="</p><b>no</b>";</script></head><body><!-- <p>hidden</p> -->
<h1>Top</h1><p>one <b>two</b>&nbsp;three<br/>four <a href='/x?a=1&amp;b=2' title="a > b">link</a></p><img src=i.png><p>1 < 2 &lt;tag&gt; é東🙂
WARC/1.1</p></body></html>"""


def test_page_parts():
    title, text, links = wd.page_parts(PAGE)
    assert title == "A & B"
    assert text == "Top\none two three\nfour link\n1 < 2 <tag> é東🙂\nWARC/1.1".replace("two three", "two\xa0three")
    assert links == [("script", "/s.js"), ("a", "/x?a=1&b=2"), ("img", "i.png")]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>/!-abp \"'=&;\n", max_size=80))
def test_any_page_ends(page):
    title, text, links = wd.page_parts(page)
    assert isinstance(text, str) and "\n\n" not in text


def test_tags_end_where_they_end():
    """Against the standard library's parser: quoted values of any length, with any number of > in them."""
    class Links(HTMLParser):
        def __init__(self):
            super().__init__()
            self.found, self.text = [], ""

        def handle_starttag(self, tag, attrs):
            self.found += [(tag, v) for k, v in attrs if wd.LINKS.get(tag) == k]

        def handle_data(self, data):
            self.text += data

    for many in (1, 9, 5000):
        page = f"<p>a <a title='{'x > y ' * many}' href=\"/{'>q' * many}\">link</a> b<a data-x=\"it's\" href='/2'>two</a></p>"
        p = Links()
        p.feed(page)
        title, text, links = wd.page_parts(page)
        assert links == p.found and text == " ".join(p.text.split()) == "a link btwo"


def test_records_are_those_of_a_plain_reader(spark):
    """The files' records, read by hand: headers to the empty line, then as many bytes as they say."""
    path, out = scratch_dir(spark, "warc-plain"), scratch_dir(spark, "warc-plain")
    wd.write_warc(wd.page_responses(spark.createDataFrame(odd_pages(), SCHEMA)), path, records_per_file=3)
    wd.build_derivatives(spark, path, out).count()
    seen = []
    for folder in (path, out):
        for f in sorted(glob.glob(f"{folder.removeprefix('file:')}/**/part-*.gz", recursive=True)):
            data = gzip.open(f).read()
            while data:
                head, _, rest = data.partition(b"\r\n\r\n")
                fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
                size = int(fields[b"Content-Length"])
                assert head.startswith(b"WARC/1.") and rest[size:size + 4] == b"\r\n\r\n"
                seen.append((fields[b"WARC-Type"].decode(), fields.get(b"WARC-Refers-To"), fields[b"WARC-Record-ID"], rest[:size]))
                data = rest[size + 4:]
    kinds = Counter(t for t, *_ in seen)
    n = len(odd_pages())
    assert kinds["response"] == kinds["metadata"] == kinds["conversion"] == n
    ids = {i for t, _, i, _ in seen if t == "response"}
    assert {r for t, r, *_ in seen if t in ("metadata", "conversion")} == ids and len({i for _, _, i, _ in seen}) == len(seen)


def test_unclosed_things_are_linear():
    for page in ("<a \"" * 20000, "<!--" * 20000, "<script>" * 20000, "<p" * 20000, "<title>" * 3000, "<" * 50000, "<a '>'" * 20000, "<a x='>" * 20001, "<a \"'>" * 20000):
        wd.page_parts(page)


def odd_pages():
    long_page = "<p>" + "word é " * 20000 + "</p>"
    return [(1, "http://a.example/1", PAGE, "x"), (1, "http://a.example/1", PAGE, "x"), (2, None, None, None), (None, "http://a b\r\nX: y", "", "x"), (3, "http://a.example/3", long_page, "x"),
            (4, "http://a.example/4", "WARC/1.1\r\nWARC-Type: response\r\n\r\n", "x"), (5, "http://a.example/5", "plain\r\n\r\n\r\n", "x"), (6, "http://a.example/6", "<script>never closed", "x")]


SCHEMA = "page_id long, url string, html string, type string"


def test_files(spark):
    pages = spark.createDataFrame(odd_pages(), SCHEMA)
    path, out = scratch_dir(spark, "warc-test"), scratch_dir(spark, "warc-test")
    made = wd.page_responses(pages)
    wd.write_warc(made, path, records_per_file=3)
    back = wd.read_warc(spark, path).collect()
    assert len(back) == len(odd_pages()) and all(r.digest_ok for r in back) and len({r.record_id for r in back}) == len(back)
    assert all(uuid.UUID(r.record_id.removeprefix("urn:uuid:")) for r in back)
    payloads = sorted(wd.split_http(bytes(r.block))[2].decode() for r in back)
    assert payloads == sorted(p[2] or "" for p in odd_pages())
    got = wd.build_derivatives(spark, path, out).withColumn("page", wd.header("X-Page-Id")).withColumn("digest", wd.header("x-source-payload-digest")).collect()
    assert len(got) == 2 * len(back) and all(r.digest_ok for r in got) and len({r.record_id for r in got}) == len(got)
    source = {r.record_id: r for r in back}
    for r in got:
        s = source[r.refers_to]
        status, headers, payload = wd.split_http(bytes(s.block))
        assert r.target_uri == s.target_uri and r.date == s.date and r.digest == "sha256:" + hashlib.sha256(payload).hexdigest()
        assert f"X-Page-Id: {r.page}".strip() in [x.strip() for x in s.extra]
        title, text, links = wd.page_parts(payload.decode())
        if r.type == "conversion":
            assert bytes(r.block).decode() == text
        else:
            about = json.loads(bytes(r.block))
            assert about["headers"] == headers and about["title"] == title and about["status"] == status
            assert [(x["element"], x["target"]) for x in about["links"]] == links and about["payload_length"] == len(payload)
    # every file is a run of whole records and nothing else
    for f in spark.read.format("binaryFile").load(out).select("content").collect():
        raw = gzip.decompress(bytes(f.content))
        again = b"".join(b"WARC/1.1\r\n" + "".join(x + "\r\n" for x in lines).encode() + b"\r\n" + block + b"\r\n\r\n" for _, lines, block in wd.parse_records(bytes(f.content)))
        assert raw == again


def test_other_writers(tmp_path, spark):
    """A record a gzip member, folded headers, bare line feeds, other types, binary and foreign-charset payloads."""
    def rec(kind, body, more=b""):
        return b"WARC/1.0\r\nWARC-Type: " + kind + b"\r\nWARC-Record-ID: <urn:uuid:" + hashlib.md5(kind + body).hexdigest().encode() + b">\r\nX-Long: a\r\n b\r\n" + more + b"Content-Length: %d\r\n\r\n" % len(body) + body + b"\r\n\r\n"

    latin = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=iso-8859-1\r\n\r\n<p>\xe9t\xe9</p>"
    picture = b"HTTP/1.1 200 OK\nContent-Type: image/png\n\n\x89PNG\xff\xfe"
    unknown = b"HTTP/1.1 404 No\r\nContent-Type: text/html; charset=x-none\r\n\r\n<p>gone"
    folder = tmp_path / "w"
    folder.mkdir()
    (folder / "a.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in (rec(b"warcinfo", b"software: x"), rec(b"response", latin), rec(b"request", b"GET /"))))
    (folder / "b.warc").write_bytes(rec(b"response", picture) + rec(b"response", unknown))
    got = wd.derive(wd.read_warc(spark, str(folder))).withColumn("t", F.col("block").cast("string")).collect()
    assert sorted(r.type for r in got) == ["conversion", "conversion", "metadata", "metadata", "metadata"]
    assert sorted(r.t for r in got if r.type == "conversion") == ["gone", "été"]
    assert all("X-Long: a b" in r.extra for r in got)
    (folder / "c.warc").write_bytes(rec(b"response", latin)[:-30])
    with pytest.raises(Exception, match="ends early"):
        wd.read_warc(spark, str(folder)).collect()


def test_empty_table(spark):
    path, out = scratch_dir(spark, "warc-none"), scratch_dir(spark, "warc-none")
    wd.write_warc(wd.page_responses(spark.createDataFrame([], SCHEMA)), path)
    assert wd.build_derivatives(spark, path, out).count() == 0
