import html
import re
from collections import Counter

import pytest

from strata.llm import queries, warc

PAGES = [
    (1, "http://a.example/x", "<html><head><title> A &amp; B\n</title><style>p{}</style></head><body><!-- no --><p>One<br>two "
     "<b>three</b>&nbsp;&lt;4</p><script>var t='</p>';</script><a class=x href=\"/next\">go</a></body></html>"),
    (2, None, None),
    (3, "", ""),
    (4, "http://b.example/y z", "plain\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\ntext"),
    (4, "http://b.example/y z", "plain\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\ntext"),
    (5, "http://c.example", "<p>" + "é ß 日本 word " * 20_000 + "\r\n\r\n"),
    (None, "http://d.example", "<TITLE>t</TITLE >\r\n<P>a<P>b"),
]


def pages(spark, rows=PAGES):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.selectExpr("*", "'x' AS payload", "'y' AS record_id", "1 AS date", "2 AS links", "3 AS block")


def brute_text(page):
    page = re.sub(r"(?s)<!--.*?-->|(?i:<script\b[^>]*>.*?</script\s*>)|(?i:<style\b[^>]*>.*?</style\s*>)", " ", page)
    page = re.sub(r"(?i)</?(p|br|html|head|title|body)\b[^>]*>", "\n", page)
    page = html.unescape(re.sub(r"</?[A-Za-z!?][^>]*>", "", page)).replace("\xa0", " ")
    page = re.sub(r" ?\n[ \n]*", "\n", re.sub(r"[ \t\f\r]+", " ", page))
    return page.strip(" \n")


@pytest.mark.parametrize("options", [{}, {"compression": "gzip"}])
def test_records_come_back_from_files(spark, tmp_path, options):
    records = warc.responses(pages(spark))
    both = records.unionByName(warc.derivatives(records))
    warc.write_warc(both.repartition(3), str(tmp_path / "w"), **options)
    back = warc.read_warc(spark, str(tmp_path / "w"))
    assert back.columns == both.columns
    assert Counter(map(tuple, back.collect())) == Counter(map(tuple, both.collect()))


def test_files_are_plain_warc(spark, tmp_path):
    warc.write_warc(warc.responses(pages(spark)).coalesce(1), str(tmp_path / "w"))
    data = next((tmp_path / "w").glob("part-*")).read_bytes()
    n = 0
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:")
        length = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
        assert rest[length:length + 4] == b"\r\n\r\n"
        data = rest[length + 4:]
        n += 1
    assert n == len(PAGES)


def test_derivatives_are_linked(spark):
    records = warc.responses(pages(spark))
    sources = {x.record_id: x for x in records.collect()}
    derived = warc.derivatives(records).collect()
    assert len(derived) == 2 * len(PAGES) and len(sources) == len(set(PAGES))
    by_id = {x.record_id: x for x in derived}
    for x in derived:
        source, other = sources[x.refers_to], by_id[x.concurrent_to]
        assert other.concurrent_to == x.record_id and other.warc_type != x.warc_type
        assert (x.target_uri, x.date, x.source_key) == (source.target_uri, source.date, source.source_key)
        if x.warc_type == "conversion":
            assert x.payload == brute_text(source.payload)
        else:
            assert f"source-payload-digest: {source.payload_digest}\r\n" in x.payload + "\r\n"
            assert f"source-content-length: {len(source.payload.encode())}" in x.payload
    first = next(x for x in derived if x.source_key == "1" and x.warc_type == "metadata")
    assert "outlink: /next" in first.payload and "title:  A &amp; B " in first.payload


def test_no_pages(spark, tmp_path):
    assert warc.derivatives(warc.responses(pages(spark, []))).count() == 0
    warc.write_warc(warc.responses(pages(spark, [])), str(tmp_path / "w"))
    assert warc.read_warc(spark, str(tmp_path / "w")).count() == 0


def test_query_reads_response_files(spark, tmp_path, monkeypatch):
    pages(spark).write.parquet(str(tmp_path / "sf" / "pages.parquet"))
    written = []
    write = warc.write_warc
    monkeypatch.setattr(warc, "write_warc", lambda rows, path, **o: (written.append(path), write(rows, path, **o)))
    found = queries.op10_warc_derivatives(spark, str(tmp_path / "sf")).collect()
    ids = {x.record_id for path in written for x in warc.read_warc(spark, path).collect() if x.warc_type == "response"}
    assert len(found) == 2 * len(PAGES) and {x.refers_to for x in found} == ids


def test_bodies_like_record_edges(spark, tmp_path):
    edges = ["WARC/1.1", "WARC/1.1\r\nx", "x\r\n\r\nWARC/1.1", "x\r\n\r\n", "\r\n\r\n"]
    records = warc.responses(pages(spark, [(i, None, x) for i, x in enumerate(edges)]))
    warc.write_warc(records.coalesce(1), str(tmp_path / "w"))
    back = warc.read_warc(spark, str(tmp_path / "w")).collect()
    assert [x.payload for x in sorted(back, key=lambda x: x.source_key)] == edges


HEAD = (
    "HTTP/1.1 404 Not Found\r\nserver: x/1\r\ncontent-type: text/html\r\nLast-Modified: Mon, 01 Jan 2024 00:00:00 GMT\r\n"
    "Content-Language: fr\r\nLocation: /else\r\nContent-Transfer-Encoding: base64"
)
MORE = "WARC-IP-Address: 192.0.2.1\r\nWARC-Block-Digest: sha1:ABC\r\nWARC-Concurrent-To: <urn:x:2>"
BODY = "<a href=/plain>a</a><a class=b href='say\"so\"'>b</a><a href=\"it's\" id=c>c</a><a href=x/y id=d>d</a>"


def test_source_headers_are_kept(spark, tmp_path):
    block = f"{HEAD}\r\n\r\n{BODY}".encode()
    head = (
        "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x:1>\r\nwarc-target-uri: http://a.example/\r\n"
        "WARC-Concurrent-To: <urn:x:0>\r\nWARC-Date: 2024-01-01T00:00:00Z\r\n" + MORE +
        f"\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}\r\n\r\n"
    )
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.warc").write_bytes(2 * (head.encode() + block + b"\r\n\r\n"))
    records = warc.read_warc(spark, str(tmp_path / "w"))
    warc.write_warc(records, str(tmp_path / "again"))
    again = warc.read_warc(spark, str(tmp_path / "again"))
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, records.collect()))
    first, _ = again.collect()
    assert (first.http_head, first.more_headers, first.payload) == (HEAD, MORE, BODY)
    assert (first.content_type, first.target_uri, first.concurrent_to) == ("text/html", "http://a.example/", "urn:x:0")
    fields = next(x.payload for x in warc.derivatives(again).collect() if x.warc_type == "metadata").split("\r\n")
    for name, value in (("http", HEAD), ("warc", MORE)):
        assert [x.partition(": ")[2] for x in fields if x.startswith(f"source-{name}: ")] == value.split("\r\n")
    assert [x[9:] for x in fields if x.startswith("outlink: ")] == ["/plain", 'say"so"', "it's", "x/y"]


def file_of(tmp_path, bodies, version="1.1", name="a.warc", gap=b""):
    data = b""
    for i, (kind, body) in enumerate(bodies):
        block = f"HTTP/1.1 200 OK\r\nContent-Type: {kind}\r\n\r\n".encode() + body
        data += (
            f"WARC/{version}\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x:{i}>\r\nWARC-Target-URI: http://a/{i}\r\n"
            f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}\r\n\r\n"
        ).encode() + block + b"\r\n\r\n" + gap
    (tmp_path / "w").mkdir(exist_ok=True)
    (tmp_path / "w" / name).write_bytes(data)
    return str(tmp_path / "w")


def bodies_of(spark, path, **options):
    found = warc.read_warc(spark, path, **options).collect()
    return {x.record_id: x.payload.encode() if x.payload is not None else bytes(x.payload_bytes) for x in found}


@pytest.mark.parametrize("gap", [b"", b"\r\n\r\n\r\n"])
@pytest.mark.parametrize("version", ["1.0", "1.1"])
@pytest.mark.parametrize("by_length", [False, True])
def test_versions_and_blank_lines(spark, tmp_path, version, gap, by_length):
    bodies = [("text/html", f"<p>{i}</p>".encode()) for i in range(3)]
    path = file_of(tmp_path, bodies, version, gap=gap)
    assert bodies_of(spark, path, by_length=by_length) == {f"urn:x:{i}": b for i, (_, b) in enumerate(bodies)}


def test_bytes_that_are_no_text_are_kept(spark, tmp_path):
    image = bytes(range(128, 256)) + b"\r\n\r\n\x00WARC" + bytes(range(256))
    path = file_of(tmp_path, [("image/png", image), ("text/html", "<p>é".encode()), ("image/gif", b"")])
    want = {"urn:x:0": image, "urn:x:1": "<p>é".encode(), "urn:x:2": b""}
    assert bodies_of(spark, path) == bodies_of(spark, path, by_length=True) == want
    records = warc.read_warc(spark, path)
    warc.write_warc(records, str(tmp_path / "again"))
    assert bodies_of(spark, str(tmp_path / "again")) == want
    derived = warc.derivatives(records).collect()
    assert sorted(x.payload for x in derived if x.warc_type == "conversion") == ["", "", "é"]
    assert f"source-content-length: {len(image)}" in next(
        x.payload for x in derived if x.refers_to == "urn:x:0" and x.warc_type == "metadata"
    )


FAKE = (
    b"x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:fake>\r\nContent-Length: %d\r\n\r\n"
    b"HTTP/1.1 200 OK\r\n\r\nfake\r\n\r\nWARC/1.0\r\nmore\r\n\r\nWARC/1.1 and so on"
)


@pytest.mark.parametrize("compressed", [False, True])
@pytest.mark.parametrize("claims", [3, 10_000])
def test_a_body_that_holds_a_record(spark, tmp_path, claims, compressed):
    bodies = [("text/html", b"one"), ("text/html", FAKE % claims), ("text/html", b"three"), ("text/plain", FAKE % 0), ("text/html", b"")]
    path = file_of(tmp_path, bodies)
    file_of(tmp_path, bodies[:1], name="b.warc")
    if compressed:
        import gzip

        (tmp_path / "w" / "a.warc.gz").write_bytes(gzip.compress((tmp_path / "w" / "a.warc").read_bytes()))
        (tmp_path / "w" / "a.warc").unlink()
    with pytest.raises(Exception, match="by_length"):
        warc.read_warc(spark, path).collect()
    want = {f"urn:x:{i}": b for i, (_, b) in enumerate(bodies)}
    assert bodies_of(spark, path, by_length=True) == want
    assert warc.read_warc(spark, path, by_length=True).count() == len(bodies) + 1
    warc.write_warc(warc.read_warc(spark, path, by_length=True), str(tmp_path / "again"))
    assert bodies_of(spark, str(tmp_path / "again")) == want


def test_torn_records_across_splits(spark, tmp_path):
    bodies = [("text/html", b"%d " % i * 300 + (FAKE % 50 if i % 7 == 0 else b"")) for i in range(60)]
    path = file_of(tmp_path, bodies)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        assert bodies_of(spark, path, by_length=True) == {f"urn:x:{i}": b for i, (_, b) in enumerate(bodies)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
