"""WARC files and their derivatives: metadata and plain-text conversion records linked to the responses they come from.

Records are rows: type, record_id, refers_to, target_uri, date, content_type, extra (header lines of one's own) and
block.  ``write_warc`` writes WARC/1.1 files by Spark's text writer, one record after the other (a record's last line
feed is the writer's line end), gzip-compressed; ``read_warc`` reads files of any writer, plain or in gzip members, one
file a row, record by record as their Content-Length says.  ``derive`` makes of each response

* a ``metadata`` record (JSON): status, source headers, digest and length of the payload, title and links;
* a ``conversion`` record: the page's text.

Both carry the response's record id in WARC-Refers-To, its URI and date, and the digest of the source payload.  Ids of
derived records follow from the response's id, so a repeated run gives the same files.
"""
from __future__ import annotations

import gzip
import hashlib
import html
import io
import json
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import FILE, POS, text_column, with_row_key

RECORD = "type string, record_id string, refers_to string, target_uri string, date string, content_type string, extra array<string>, block binary"
#: Elements that end a line of text.
BREAKS = frozenset("address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol "
                   "option p pre section table tbody td tfoot th thead title tr ul".split())
#: Elements whose content isn't text.
SILENT = frozenset("script style noscript template iframe object svg textarea".split())
#: Attributes that link, by element.
LINKS = {"a": "href", "area": "href", "link": "href", "img": "src", "script": "src", "iframe": "src", "source": "src", "form": "action"}
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
#: A tag without < or > in its values, closed quotes: all but odd tags.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)(?:[^<>"']|"[^"<>]*"|'[^'<>]*')*+>""")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_SPACES = re.compile(r"[ \t\r\f\v]+")


#: The rest of a tag with its quoted values, whatever these hold.
_REST = re.compile(r"""(?:[^>"']|"[^"]*"|'[^']*')*+>""")


class _Ends:
    """Ends of tags.  A quote that is never closed makes the first ``>`` end a tag, there and in the rest of the page, so
    that no text is searched for a closing quote twice."""

    def __init__(self, page: str):
        self.page, self.quotes = page, True

    def after(self, at: int) -> int:
        """Place after the ``>`` that ends the tag; one inside a quoted value doesn't."""
        if self.quotes:
            rest = _REST.match(self.page, at)
            if rest:
                return rest.end()
            self.quotes = False
        return self.page.find(">", at) + 1 or len(self.page)


def page_parts(page: str) -> tuple[str, str, list[tuple[str, str]]]:
    """Title, text and links (element, target) of an HTML page, in one pass over its tags."""
    out: list[str] = []
    title, links, at, n, ends = "", [], 0, len(page), _Ends(page)
    while at < n:
        begin = page.find("<", at)
        if begin < 0:
            out.append(page[at:])
            break
        out.append(page[at:begin])
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = n if end < 0 else end + 3
            continue
        name = _TAG.match(page, begin)
        whole = name is not None
        if not whole:
            name = _NAME.match(page, begin)
        if not name:
            if page.startswith(("<!", "<?"), begin):
                at = page.find(">", begin) + 1 or n
            else:
                out.append("<")
                at = begin + 1
            continue
        opens = not name[1]
        tag = name[2].lower()
        at = name.end() if whole else ends.after(name.end(2))
        if opens and tag in LINKS:
            for m in _ATTRIBUTE.finditer(page, name.end(2), at):
                if m[1].lower() == LINKS[tag]:
                    links.append((tag, html.unescape(next(g for g in m.groups()[1:] if g is not None))))
        if opens and (tag in SILENT or tag == "title"):
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at) if not page.endswith("/>", begin, at) else None
            if close:
                if tag == "title" and not title:
                    title = " ".join(html.unescape(page[at:close.start()]).split())
                at = close.end()
            elif tag in SILENT and not page.endswith("/>", begin, at):
                break  # never closed: the rest isn't text
        if tag in BREAKS:
            out.append("\n")
    lines = (_SPACES.sub(" ", x).strip() for x in html.unescape("".join(out)).split("\n"))
    return title, "\n".join(x for x in lines if x), links


def record_text(block: Column | None = None) -> Column:
    """A record as it stands in a file, without the two line ends after it."""
    block = F.col("block") if block is None else block

    def line(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")

    id_ = F.concat(F.lit("<"), F.col("record_id"), F.lit(">"))
    refers = F.concat(F.lit("<"), F.col("refers_to"), F.lit(">"))
    extra = F.array_join(F.transform(F.coalesce("extra", F.array().cast("array<string>")), lambda x: F.concat(x, F.lit("\r\n"))), "")
    return F.concat(F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("type")), line("WARC-Record-ID", id_), line("WARC-Date", F.col("date")), line("WARC-Target-URI", F.col("target_uri")),
                    line("WARC-Refers-To", refers), line("Content-Type", F.col("content_type")), line("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2(block, 256))), extra,
                    line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block.cast("string"))


def write_warc(records: DataFrame, path: str, records_per_file: int = 50_000) -> None:
    """Writes records whose blocks are UTF-8 text."""
    value = records.select(F.concat(record_text(), F.lit("\r\n\r")).alias("value"))  # the last line feed is the line's end
    value.write.option("lineSep", "\n").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", records_per_file).text(path)


def parse_records(content: bytes) -> Iterator[tuple[dict[str, str], list[str], bytes]]:
    """Headers by lower-case name, header lines, and block of each record of a file, plain or gzip."""
    f = gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    f = io.BufferedReader(f)
    while True:
        line = f.readline()
        while line in (b"\r\n", b"\n"):
            line = f.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        lines: list[str] = []
        for raw in iter(f.readline, b""):
            if raw in (b"\r\n", b"\n"):
                break
            text = raw.decode("utf-8", "replace").rstrip("\r\n")
            if lines and text[:1] in " \t":
                lines[-1] += " " + text.strip()
            else:
                lines.append(text)
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = int(headers["content-length"])
        block = f.read(size)
        if len(block) != size:
            raise ValueError(f"record {headers.get('warc-record-id')} ends early")
        yield headers, lines, block


_OWN = frozenset("warc-type warc-record-id warc-date warc-target-uri warc-refers-to content-type content-length warc-block-digest".split())


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Rows of records, with ``block_digest`` and ``digest_ok`` (null where the record has no sha256 block digest)."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                part, size = [], 0
                for h, lines, block in parse_records(content):
                    said = h.get("warc-block-digest")
                    ok = said.lower() == "sha256:" + hashlib.sha256(block).hexdigest() if said and said.lower().startswith("sha256:") else None
                    strip = lambda x: None if x is None else x.strip("<>")
                    part.append((h.get("warc-type"), strip(h.get("warc-record-id")), strip(h.get("warc-refers-to")), h.get("warc-target-uri"), h.get("warc-date"), h.get("content-type"),
                                 [x for x in lines if x.partition(":")[0].strip().lower() not in _OWN], block, said, ok))
                    size += len(block)
                    if size > 1 << 24:
                        yield pd.DataFrame(part, columns=names)
                        part, size = [], 0
                yield pd.DataFrame(part, columns=names)

    schema = RECORD + ", block_digest string, digest_ok boolean"
    names = [x.split()[0] for x in schema.split(", ")]
    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(rows, schema)


def page_responses(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html", date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records of a table of pages.  A null page is an empty payload, a null URL gives no WARC-Target-URI; the
    record id follows from the row's content and place, so rows that repeat are records of their own."""
    keyed = with_row_key(pages)
    body, address = text_column(keyed, page), F.regexp_replace(F.col(url).cast("string"), r"\s", "%20")
    seed = F.md5(F.concat_ws("\n", F.col(page_id).cast("string"), address, F.sha2(body, 256), F.element_at(F.split(FILE, "/"), -1), F.col(POS).cast("string")))
    name = F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *[F.substring(seed, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body)
    extra = F.array(F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.sha2(body, 256)), F.concat(F.lit("X-Page-Id: "), F.coalesce(F.col(page_id).cast("string"), F.lit(""))))
    return keyed.select(F.lit("response").alias("type"), name.alias("record_id"), F.lit(None).cast("string").alias("refers_to"), address.alias("target_uri"), F.lit(date).alias("date"),
                        F.lit("application/http; msgtype=response").alias("content_type"), extra.alias("extra"), F.encode(http, "UTF-8").alias("block"))


def split_http(block: bytes) -> tuple[str, list[list[str]], bytes]:
    """Status line, headers in order, and payload of an HTTP response."""
    head, sep, payload = block.partition(b"\r\n\r\n")
    if not sep:
        head, _, payload = block.partition(b"\n\n")
    status, *lines = head.decode("utf-8", "replace").splitlines() or [""]
    return status, [[k.strip(), v.strip()] for k, s, v in (x.partition(":") for x in lines) if s], payload


def derived(kind: str, source: tuple, block: bytes, content_type: str, extra: list[str]) -> tuple:
    record_id, uri, date = source
    return kind, uuid.uuid5(uuid.NAMESPACE_URL, f"{record_id}#{kind}").urn, record_id, uri, date, content_type, extra, block


def derive(records: DataFrame) -> DataFrame:
    """The metadata and conversion record of each response record; other records give none.  A payload that isn't text
    has no conversion record.  Header lines ``X-...`` of the response are carried over."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for record_id, uri, date, extra, block in batch.itertuples(index=False):
                status, headers, payload = split_http(block)
                kind = next((v for k, v in headers if k.lower() == "content-type"), "text/html")
                charset = re.search(r"charset=[\"']?([\w.-]+)", kind, re.I)
                digest = "sha256:" + hashlib.sha256(payload).hexdigest()
                lines = [f"WARC-Refers-To-Date: {date}", f"X-Source-Payload-Digest: {digest}", *(x for x in extra if x.lower().startswith("x-"))]
                source, about = (record_id, uri, date), {"status": status, "headers": headers, "payload_digest": digest, "payload_length": len(payload)}
                if kind.lower().startswith("text/") or "html" in kind.lower():
                    try:
                        page = payload.decode(charset[1] if charset else "utf-8", "replace")
                    except LookupError:  # a charset nobody knows
                        page = payload.decode("utf-8", "replace")
                    title, text, links = page_parts(page) if "html" in kind.lower() else ("", page, [])
                    about |= {"title": title, "links": [{"element": a, "target": b} for a, b in links]}
                    text = text.encode("utf-8", "replace")
                    out.append(derived("conversion", source, text, "text/plain; charset=utf-8", lines))
                out.append(derived("metadata", source, json.dumps(about, ensure_ascii=False).encode("utf-8", "replace"), "application/json", lines))
            yield pd.DataFrame(out, columns=names)

    names = [x.split()[0] for x in RECORD.split(", ")]
    return records.filter("type = 'response'").select("record_id", "target_uri", "date", "extra", "block").mapInPandas(rows, RECORD)


def build_derivatives(spark: SparkSession, responses: str, path: str) -> DataFrame:
    """Reads response files, writes the derived records to ``path`` and returns them as read back."""
    write_warc(derive(read_warc(spark, responses)), path)
    return read_warc(spark, path)


def header(name: str) -> Column:
    """Value of one of a record's extra header lines."""
    line = F.get(F.filter("extra", lambda x: F.startswith(F.lower(x), F.lit(f"{name.lower()}:"))), 0)
    return F.trim(F.regexp_replace(line, r"^[^:]*:", ""))
