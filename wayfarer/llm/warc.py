"""WARC derivatives: metadata and plain-text conversion records of response records.

``responses`` makes response records of raw pages (or take them from
``read_warc``); ``derive`` turns each into two linked records: ``metadata``
(application/warc-fields: title, language, links, lengths, and the source's
HTTP headers and digests) and ``conversion`` (text/plain).  Both keep the
response's target URI and date, name it in WARC-Refers-To, and the conversion is
named in the metadata.  Record ids are UUIDs of the SHA-1 of what they identify,
so a rerun or a re-executed task yields the same ids; digests are the usual
``sha1:`` plus base 32.  ``write_warc`` writes records as WARC/1.1 text files,
``read_warc`` reads such files (also gzipped) record by record.

Defined cases: a null html is an empty payload (empty conversion); a null url
leaves the target URI out; repeated rows are one capture, so both yield the
same ids; empty tables give empty results.  Other columns are not read.
Nothing is gathered across rows; memory per row is proportional to its page.
"""

from __future__ import annotations

import base64
import hashlib
import html as html_module
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfarer.llm.common import small_batches

VERSION = "WARC/1.1"
#: Date of captures whose table has none (fixed, so that results repeat).
NO_DATE = "1970-01-01T00:00:00Z"

_DROP = re.compile(r"<!--.*?-->|<(script|style|template|noscript)\b.*?(?:</\1\s*>|$)|<head\b.*?(?:</head\s*>|(?=<body\b)|$)",
                   re.S | re.I)
_BREAK = re.compile(r"</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|section|article|header|footer|nav|blockquote|pre|hr|dd|dt|dl|"
                    r"form|figure|main|aside|option|body)\b[^>]*>", re.I)
_TAG = re.compile(r"<[^>]*>")
_BLANKS = re.compile(r"[^\S\n]+")
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
_LANG = re.compile(r"<html\b[^>]*\blang\s*=\s*[\"']?([\w-]+)", re.I)
_LINK = re.compile(r"<a\b[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)", re.I)


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: object) -> str:
    raw = hashlib.sha1("\0".join("" if p is None else str(p) for p in parts).encode()).digest()[:16]
    return f"<urn:uuid:{uuid.UUID(bytes=raw, version=5)}>"


def html_text(page: str) -> str:
    """The readable text: no scripts, styles, comments or head; one line per block."""
    t = html_module.unescape(_TAG.sub("", _BREAK.sub("\n", _DROP.sub(" ", page))))
    return "\n".join(x for x in (_BLANKS.sub(" ", line).strip() for line in t.split("\n")) if x)


def _one_line(s: str) -> str:
    return " ".join(s.split())


def headers(record_type: str, rid: str, date: str, uri: str | None, content_type: str, block: bytes, **more: str) -> str:
    h = {"WARC-Type": record_type, "WARC-Record-ID": rid, "WARC-Date": date}
    if uri:
        h["WARC-Target-URI"] = _one_line(uri)
    h |= {k.replace("_", "-"): v for k, v in more.items()}
    h |= {"WARC-Block-Digest": digest(block), "Content-Type": content_type, "Content-Length": str(len(block))}
    return VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in h.items())


_RESPONSE = ("page_id string, record_id string, target_uri string, warc_date string, http_headers string, payload string, "
             "payload_digest string, block_digest string")


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              date_col: str | None = None) -> DataFrame:
    """Response records of raw pages: id, record_id, target_uri, warc_date, http_headers, payload and digests."""
    small_batches(pages.sparkSession)
    date = F.coalesce(F.col(date_col).cast("string"), F.lit(NO_DATE)) if date_col else F.lit(NO_DATE)
    kind = dict(pages.dtypes)[id_col]
    # ids cross Python as text: a null among numbers would turn them into floats
    rows = pages.select(F.col(id_col).cast("string").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), date.alias("date"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for pid, url, page, when in zip(pdf["page_id"], pdf["url"], pdf["html"], pdf["date"]):
                body = (page or "").encode()
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n"
                payload = digest(body)
                out.append((pid, record_id("response", pid, url, when, payload), url, when, http, page or "", payload,
                            digest(http.encode() + b"\r\n" + body)))
            yield pd.DataFrame(out, columns=["page_id", "record_id", "target_uri", "warc_date", "http_headers", "payload",
                                             "payload_digest", "block_digest"])

    return rows.mapInPandas(run, _RESPONSE).withColumn("page_id", F.col("page_id").cast(kind))


_RECORD = ("page_id string, record_type string, record_id string, refers_to string, target_uri string, warc_date string, "
           "source_payload_digest string, block_digest string, content_length long, headers string, content string")


def derive(response_rows: DataFrame) -> DataFrame:
    """Two records per response: ``metadata`` and ``conversion``, linked to it and to each other."""
    needed = ["page_id", "record_id", "target_uri", "warc_date", "http_headers", "payload", "payload_digest"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in _RECORD.split(", ")]
        for pdf in batches:
            out = []
            for pid, source, uri, when, http, page, source_digest in zip(*(pdf[c] for c in needed)):
                text = html_text(page)
                block = text.encode()
                conversion, meta = record_id("conversion", source), record_id("metadata", source)
                title, lang = _TITLE.search(page), _LANG.search(page)
                links = list(dict.fromkeys(_LINK.findall(page)))
                fields = [("source-record", source), ("conversion-record", conversion), ("source-payload-digest", source_digest),
                          ("title", _one_line(html_module.unescape(title[1])) if title else ""),
                          ("language", lang[1] if lang else ""), ("text-length", str(len(text))),
                          *(("source-header", x) for x in http.split("\r\n") if x),
                          *(("outlink", _one_line(x)) for x in links)]
                info = "".join(f"{k}: {v}\r\n" for k, v in fields)
                for kind, rid, kind_of, content, more in (
                        ("metadata", meta, "application/warc-fields", info.encode(), {"WARC_Concurrent_To": conversion}),
                        ("conversion", conversion, "text/plain; charset=utf-8", block, {})):
                    head = headers(kind, rid, when, uri, kind_of, content, WARC_Refers_To=source, **more)
                    out.append((pid, kind, rid, source, uri, when, source_digest, digest(content), len(content), head,
                                info if kind == "metadata" else text))
            yield pd.DataFrame(out, columns=columns)

    return (response_rows.select(*needed).withColumn("page_id", F.col("page_id").cast("string")).mapInPandas(run, _RECORD)
            .withColumn("page_id", F.col("page_id").cast(dict(response_rows.dtypes)["page_id"])))


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write rows (headers, content) as WARC files, one per task, to any file system that Spark writes."""
    text = F.concat("headers", F.lit("\r\n"), F.coalesce("content", F.lit("")))
    records.select(text.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", compression).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(headers map, content) of each record below ``path``, streamed record by record.

    Records are told apart by their version line, so a content must not hold that line itself.
    """
    parts = spark.read.option("lineSep", f"{VERSION}\r\n").text(path)
    value = F.col("value")
    head = F.split(F.substring_index(value, "\r\n\r\n", 1), "\r\n")
    named = F.map_from_entries(F.transform(F.filter(head, lambda x: F.contains(x, F.lit(": "))), lambda x: F.struct(
        F.substring_index(x, ": ", 1).alias("k"), F.regexp_replace(x, "^[^:]*: ", "").alias("v"))))
    content = F.regexp_replace(F.regexp_replace(value, r"(?s)^.*?\r\n\r\n", ""), r"\r\n\r\n$", "")
    return parts.where(F.length(value) > 0).select(named.alias("headers"), content.alias("content"))
