import base64
import hashlib

from wayfarer.llm import warc as W

HTML = ("<!DOCTYPE html><html lang='fr'><head><title>A &amp; B\n c</title><style>p{}</style><script>var t='</p>';</script></head>"
        "<body><nav><a href='/x'>X</a><a href=\"/y\">Y</a></nav><!-- hidden --><p>One&nbsp;two<br>three</p><div>é <b>f</b>our</div></body></html>")


def pages(spark):
    rows = [(1, "http://a.org/1", HTML, "r"), (2, None, None, "r"), (3, "http://a.org/ü", "", None), (4, "u", "plain < text", "q"),
            (None, "http://n/", "<p>" * 3000, "q"), (1, "http://a.org/1", HTML, "r")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, record_id string")


def test_links_headers_and_digests(spark):
    responses = {r.record_id: r for r in W.responses(pages(spark)).collect()}
    out = W.derive(W.responses(pages(spark))).collect()
    assert len(out) == 12
    for r in out:
        source = responses[r.refers_to]
        block = r.content.encode()
        want = "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
        assert r.block_digest == want and f"WARC-Block-Digest: {want}\r\n" in r.headers
        assert f"WARC-Refers-To: {source.record_id}\r\n" in r.headers and f"Content-Length: {len(block)}\r\n" in r.headers
        assert r.target_uri == source.target_uri and ("WARC-Target-URI" in r.headers) == (source.target_uri is not None)
        assert r.source_payload_digest == source.payload_digest == "sha1:" + base64.b32encode(
            hashlib.sha1(source.payload.encode()).digest()).decode()
    meta = next(r for r in out if r.page_id == 1 and r.record_type == "metadata")
    text = next(r for r in out if r.page_id == 1 and r.record_type == "conversion")
    assert text.content == "XY\nOne two\nthree\né four"
    for line in (f"conversion-record: {text.record_id}", "title: A & B c", "language: fr", "outlink: /x", "outlink: /y",
                 "source-header: Content-Type: text/html; charset=utf-8"):
        assert line + "\r\n" in meta.content
    assert {r.content for r in out if r.page_id == 2 and r.record_type == "conversion"} == {""}


def test_ids_repeat_between_runs(spark):
    a, b = (sorted(r.record_id for r in W.derive(W.responses(pages(spark).repartition(n))).collect()) for n in (1, 4))
    assert a == b and len(set(a)) == 10
    big = spark.createDataFrame([(2**62 + 1, "u", "h"), (None, "u", "h")], "page_id long, url string, html string")
    assert {r.page_id for r in W.derive(W.responses(big)).collect()} == {2**62 + 1, None}


def test_round_trip_through_files(spark, tmp_dir):
    records = W.derive(W.responses(pages(spark)))
    for codec in ("gzip", "none"):
        W.write_warc(records, f"{tmp_dir}/{codec}", codec)
        back = [(r.headers["WARC-Record-ID"], r.headers["WARC-Block-Digest"], r.content)
                for r in W.read_warc(spark, f"{tmp_dir}/{codec}").collect()]
        assert sorted(back) == sorted((r.record_id, r.block_digest, r.content) for r in records.collect())


def test_empty_table(spark):
    assert W.derive(W.responses(pages(spark).limit(0))).count() == 0
