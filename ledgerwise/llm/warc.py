"""WARC derivatives: response records become linked metadata and plain-text conversion records.

For every response two records are built, as DataFrame expressions row by row:

* ``conversion`` (text/plain): the page's text, without scripts, styles, comments
  and tags, block elements as line ends, the common and all numeric entities decoded;
* ``metadata`` (application/warc-fields): title, out-links in their order, and
  the response's own HTTP headers. Title and links are those of the page's source (entities
  stay); as a field is one line, white space and control characters in a title become
  one space, in a link control characters go and spaces become %20. Links may be
  quoted either way or not at all.

Both keep the response's target URI, date and payload digest, refer to it
(``WARC-Refers-To``) and have an id derived from its id, so a rerun or a
recomputed task yields the same records; the metadata record names the
conversion record as concurrent. Block digests are sha256 of the UTF-8 block.

``write_warc`` stores records as WARC/1.1 files, one for each task.

Results in odd cases: a null payload gives an empty conversion and a metadata
record without title and links; null headers give no header lines; a null
target URI leaves its line out; a null record id is treated as ''; repeated rows
give repeated records; an empty table gives an empty result; further columns of
the responses are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BLOCK_TAGS = "p|div|br|li|ul|ol|dl|dt|dd|h[1-6]|tr|td|th|table|article|section|header|footer|nav|aside|main|title|blockquote|pre|hr|form"
#: (pattern, replacement) in this order; all of them linear-time in both regex dialects used
TEXT_STEPS = [
    (r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>", ""),
    (rf"(?i)</?(?:{_BLOCK_TAGS})\b[^>]*>", "\n"),
    (r"<[^>]*>|\x01", ""),
]
#: an ampersand stands as MARK until all other entities are decoded, so that none is decoded twice
MARK = "\x01"
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", MARK)]
NUMERIC = r"&#(?:[0-9]{1,8}|[xX][0-9A-Fa-f]{1,7});"
TITLE = r"(?is)<title[^>]*>([^<]*)</title"
TITLE_FOLD = r"[\x00-\x20\x7F]+"
LINK = r"""(?i)<a\s(?:[^>]*?\s)??href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
LINK_DROP, LINK_ODD = r"[\x00-\x1F\x7F]+", r"[\x00-\x20\x7F]"
SPACE_STEPS = [(r"[ \t\r\x0b\f]+", " "), (r" ?\n[ \n]*", "\n")]


def _stripped(html: F.Column) -> F.Column:
    """Without scripts, styles, comments and tags; only an ampersand's entity is decoded, to MARK."""
    out = html
    for pattern, to in TEXT_STEPS:
        out = F.regexp_replace(out, pattern, to)
    for entity, char in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def _decoded(text: F.Column) -> F.Column:
    """Numeric entities decoded, where there are any."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(NUMERIC), 0))
    each = F.aggregate(found, text, lambda t, e: F.replace(t, e, _character(e)))
    return F.when(F.contains(text, F.lit("&#")), each).otherwise(text)


def _spaced(text: F.Column) -> F.Column:
    out = F.replace(text, F.lit(MARK), F.lit("&"))
    for pattern, to in SPACE_STEPS:
        out = F.regexp_replace(out, pattern, to)
    return F.btrim(out, F.lit(" \n"))


def plain_text(html: F.Column) -> F.Column:
    return _spaced(_decoded(_stripped(html)))


def _character(entity: F.Column) -> F.Column:
    """The character of a numeric entity; U+FFFD for numbers that are none."""
    digits = F.regexp_replace(entity, "[&#xX;]", "")
    number = F.when(F.lower(F.substring(entity, 3, 1)) == "x", F.conv(digits, 16, 10)).otherwise(digits).cast("long")
    valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, number).otherwise(F.lit(0xFFFD))), 8, "0")), "UTF-32")
    return F.when(number == 38, F.lit(MARK)).otherwise(char)


def urn(*parts: F.Column) -> F.Column:
    """A urn:uuid from the md5 of the parts."""
    h = F.md5(F.concat_ws("|", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in
                                                            ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _link(value: F.Column) -> F.Column:
    """An attribute's value as one line."""
    quoted = F.substring(value, 1, 1).isin('"', "'")
    plain = F.when(quoted, F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)
    cleaned = F.replace(F.btrim(F.regexp_replace(plain, LINK_DROP, "")), F.lit(" "), F.lit("%20"))
    return F.when(F.rlike(plain, F.lit(LINK_ODD)), cleaned).otherwise(plain)


def _digest(block: F.Column) -> F.Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def derivatives(responses: DataFrame) -> DataFrame:
    """``responses(record_id, target_uri, warc_date, http_headers, payload)`` ->
    (record_type, record_id, refers_to, concurrent_to, target_uri, warc_date,
    content_type, content_length, block_digest, source_digest, block); source_digest
    is the response's payload digest."""
    src = responses.select(
        F.coalesce("record_id", F.lit("")).alias("source_id"), "target_uri", "warc_date", "http_headers",
        F.coalesce("payload", F.lit("")).alias("html"))
    title = F.btrim(F.regexp_replace(F.regexp_extract("html", TITLE, 1), TITLE_FOLD, " "))
    links = F.transform(F.regexp_extract_all("html", F.lit(LINK), 1), _link)
    # a column of its own, as the next step names it several times
    src = src.withColumn("stripped", _stripped(F.col("html")))
    read = src.select(
        "source_id", "target_uri", "warc_date", _digest(F.col("html")).alias("source_digest"),
        urn(F.col("source_id"), F.lit("conversion")).alias("text_id"), urn(F.col("source_id"), F.lit("metadata")).alias("meta_id"),
        _spaced(_decoded(F.col("stripped"))).alias("text"),
        F.concat(F.when(title != "", F.concat(F.lit("title: "), title, F.lit("\r\n"))).otherwise(""),
                 F.array_join(F.transform(links, lambda x: F.concat(F.lit("outlink: "), x, F.lit("\r\n"))), ""),
                 F.array_join(F.transform(F.filter(F.split(F.coalesce("http_headers", F.lit("")), "\r?\n"), lambda x: x != ""),
                                          lambda x: F.concat(F.lit("source-header: "), x, F.lit("\r\n"))), "")).alias("fields"))

    def record(kind, own, other, content_type, block):
        return F.struct(F.lit(kind).alias("record_type"), F.col(own).alias("record_id"), F.col("source_id").alias("refers_to"),
                        (F.col(other) if other else F.lit(None).cast("string")).alias("concurrent_to"),
                        F.lit(content_type).alias("content_type"), F.octet_length(block).cast("long").alias("content_length"),
                        _digest(F.col(block)).alias("block_digest"), F.col(block).alias("block"))

    both = F.array(record("conversion", "text_id", None, "text/plain", "text"),
                   record("metadata", "meta_id", "text_id", "application/warc-fields", "fields"))
    return (read.select("target_uri", "warc_date", "source_digest", F.explode(both).alias("r"))
            .select("r.record_type", "r.record_id", "r.refers_to", "r.concurrent_to", "target_uri", "warc_date",
                    "r.content_type", "r.content_length", "r.block_digest", "source_digest", "r.block"))


def serialized(records: DataFrame) -> DataFrame:
    """(record): header and block of each WARC/1.1 record, without the closing line ends."""
    def line(name, col):
        value = F.regexp_replace(F.col(col).cast("string"), r"[\r\n]+", " ")
        return F.when(F.col(col).isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")

    head = [("WARC-Type", "record_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"),
            ("WARC-Concurrent-To", "concurrent_to"), ("WARC-Target-URI", "target_uri"), ("WARC-Date", "warc_date"),
            ("Content-Type", "content_type"), ("WARC-Block-Digest", "block_digest"),
            ("WARC-Source-Payload-Digest", "source_digest"), ("Content-Length", "content_length")]
    return records.select(F.concat(F.lit("WARC/1.1\r\n"), *[line(n, c) for n, c in head], F.lit("\r\n"), F.col("block")).alias("record"))


def write_warc(records: DataFrame, path: str) -> None:
    """One WARC file for each task under ``path``."""
    serialized(records).write.mode("overwrite").option("lineSep", "\r\n\r\n").text(path)


# --- the query's responses ---------------------------------------------------

def page_responses(pages: DataFrame) -> DataFrame:
    """The pages as the response records of a crawl: id by page_id and URL, a
    date in 2024 and 2025 by page_id, HTTP headers by the page's size."""
    size = F.octet_length(F.coalesce("html", F.lit("")))
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 37, F.lit(731)).cast("int"))
    return pages.select(
        urn(F.col("page_id").cast("string"), F.col("url"), F.lit("response")).alias("record_id"), F.col("url").alias("target_uri"),
        F.concat(day.cast("string"), F.lit("T00:00:00Z")).alias("warc_date"),
        F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size.cast("string"),
                 F.lit("\r\n")).alias("http_headers"), F.col("html").alias("payload"))
