r"""WARC derivatives: responses become linked metadata and plain-text conversion records.

Each response yields one ``metadata`` record (title, links, and the headers and digests of the
response it came from) and one ``conversion`` record (the text of the page). Both refer to the
response by ``WARC-Refers-To`` and keep its target URI and date; ``WARC-Concurrent-To`` links the
two. Record ids are made from the record's kind and its source, so reruns give the same ids.

``http_head`` is a response's status line and HTTP headers as they were read. It is null for a head
that says ``200 OK`` and the content type and no more, which is what a null one is written as.
``more_headers`` are the lines of a record's WARC header that have no column, null if there are none.
Both go through reading and writing unchanged; the metadata record lists them line by line as
``source-http`` and ``source-warc``.

A WARC file is a text file whose records end with two line ends, so Spark's text source writes and
reads it, in splits; compressed files are read whole, one for each task that wrote. A body that would
show a record's end and start between its neighbours is written in base64, which a WARC header says.
Files of other writers may be of any version 1.x. Their records are framed by ``Content-Length``: a
record that is shorter than it says, as its body holds what looks like the start of another, fails the
read, unless ``by_length`` asks for the way that puts such records together again. Bodies that are no
UTF-8 keep their bytes in ``payload_bytes``, and have no ``payload``.

Defined cases: a null page is an empty one, a null address is empty; a page without text, or of bytes
that are none, gives an empty conversion record; very long pages are taken whole; equal rows give equal
records; an empty table gives none; other columns of the pages are not read. Text extraction works on
tags as far as the next ``>``; comments, scripts and styles are left out, block tags end a line, the
common named entities are resolved.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import importable, let, written

VERSION = "WARC/1.1"
END = "\r\n\r\n"
ANY_VERSION = "WARC/1."
BETWEEN = f"{END}{ANY_VERSION}"
NO_DATE = "1970-01-01T00:00:00Z"
FAST_GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
_ALL = (1 << 31) - 1  # characters: as far as the end

HIDDEN = "(?is)<(?:!--.*?-->|" + "|".join(
    rf"{name}\b[^>]*>.*?</{name}\s*>" for name in ("script", "style", "noscript")
) + ")"
BLOCK_TAG = (
    r"(?i)</?(?:address|article|aside|blockquote|body|br|caption|dd|div|dl|dt|fieldset|figcaption|"
    r"figure|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|option|p|pre|section|table|tbody|"
    r"td|tfoot|th|thead|title|tr|ul)\b[^>]*>"
)
TAG = r"</?[A-Za-z!?][^>]*>"
ENTITIES = [
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
    ("&amp;", "&"),
]
BLANKS = "\t\f\r"  # become spaces
LINE_ENDS = r"\n[ \n]+"
TITLE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"
# With its quotes, or as far as the next blank where it has none.
LINK = r"""(?is)<a\s[^>]*?\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""
# The SQL takes quoted values only, without quotes in them.
SQL_LINK = r"""(?is)<a\s[^>]*?\bhref\s*=\s*["']([^"'>]*)["']"""
ENCODED = "X-Payload-Encoding: base64"
CONCURRENT = r"(?i)^WARC-Concurrent-To:"
# WARC headers that have a column or are made by the writer.
KNOWN = (
    r"(?i)^(?:WARC-(?:Type|Record-ID|Refers-To|Concurrent-To|Target-URI|Date|Payload-Digest)|"
    r"X-Source-Key|X-Payload-Encoding|Content-Type|Content-Length):"
)


def _record_id(*of: Column) -> Column:
    digest = F.md5(F.concat_ws("\n", *of).cast("binary"))
    form = "^(.{8})(.{4}).(.{3}).(.{3})(.{12})$"
    return F.regexp_replace(digest, form, "urn:uuid:$1-$2-4$3-8$4-$5")


def _sha256(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def plain_text(html: Column) -> Column:
    def resolved(text: Column) -> Column:
        found = text
        for entity, sign in ENTITIES:
            found = F.replace(found, F.lit(entity), F.lit(sign))
        return F.when(F.contains(text, F.lit("&")), found).otherwise(text)

    text = F.regexp_replace(html, HIDDEN, " ")
    text = F.regexp_replace(F.regexp_replace(text, BLOCK_TAG, "\n"), TAG, "")
    text = let(text, resolved)
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(" "))
    text = F.regexp_replace(text, "  +", " ")
    text = F.replace(text, F.lit(" \n"), F.lit("\n"))
    return F.trim(F.regexp_replace(text, LINE_ENDS, "\n"), F.lit(" \n"))


def responses(
    pages: DataFrame, *, key_column: str = "page_id", url_column: str = "url", html_column: str = "html",
    date: str = NO_DATE,
) -> DataFrame:
    """Response records of crawled pages. The key goes along as a header of its own."""
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    rows = pages.select(
        blank(key_column).alias("source_key"), F.regexp_replace(blank(url_column), r"\s", "").alias("target_uri"),
        blank(html_column).alias("payload"),
    )
    digest = _sha256(F.col("payload"))
    return rows.select(
        _record_id(F.lit("response"), F.col("source_key"), F.col("target_uri"), digest).alias("record_id"),
        F.lit("response").alias("warc_type"), F.lit(None).cast("string").alias("refers_to"),
        F.lit(None).cast("string").alias("concurrent_to"), "target_uri", F.lit(date).alias("date"),
        F.lit("text/html; charset=UTF-8").alias("content_type"), digest.alias("payload_digest"),
        "source_key", "payload", F.lit(None).cast("string").alias("http_head"),
        F.lit(None).cast("string").alias("more_headers"), F.lit(None).cast("binary").alias("payload_bytes"),
    )


def derivatives(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of the responses among the records."""
    source = records.filter("warc_type = 'response'").withColumns({
        "length": F.octet_length(F.coalesce("payload_bytes", F.col("payload").cast("binary"))).cast("string"),
        "payload": F.coalesce("payload", F.lit("")),
    })
    title = F.regexp_replace(F.regexp_extract("payload", TITLE, 1), r"\s+", " ")
    links = F.regexp_extract_all("payload", F.lit(LINK), F.lit(1))
    quoted = lambda x: F.substring(x, 1, 1).isin('"', "'")
    unquoted = lambda x: F.when(quoted(x), F.substring(x, F.lit(2), F.length(x) - 2)).otherwise(x)
    links = F.transform(links, lambda x: F.regexp_replace(unquoted(x), r"\s", ""))
    source = source.select(
        "record_id", "target_uri", "date", "content_type", "payload_digest", "source_key",
        "length", title.alias("title"), links.alias("links"),
        plain_text(F.col("payload")).alias("text"), "http_head", "more_headers",
    )
    meta_id = _record_id(F.lit("metadata"), F.col("record_id"))
    text_id = _record_id(F.lit("conversion"), F.col("record_id"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    lines = lambda name, of: F.transform(F.split(of, "\r\n"), lambda x: line(name, x))
    fields = F.concat_ws(
        "\r\n", line("title", F.col("title")), line("source-content-type", F.col("content_type")),
        line("source-content-length", F.col("length")), line("source-payload-digest", F.col("payload_digest")),
        lines("source-http", F.col("http_head")), lines("source-warc", F.col("more_headers")),
        F.transform("links", lambda x: F.concat(F.lit("outlink: "), x)),
    )
    derived = lambda kind, own, other, content, payload: F.struct(
        own.alias("record_id"), F.lit(kind).alias("warc_type"), F.col("record_id").alias("refers_to"),
        other.alias("concurrent_to"), F.col("target_uri").alias("target_uri"), F.col("date").alias("date"),
        F.lit(content).alias("content_type"), _sha256(payload).alias("payload_digest"),
        F.col("source_key").alias("source_key"), payload.alias("payload"),
        F.lit(None).cast("string").alias("http_head"), F.lit(None).cast("string").alias("more_headers"),
        F.lit(None).cast("binary").alias("payload_bytes"),
    )
    both = source.withColumn("fields", fields).select(F.explode(F.array(
        derived("metadata", meta_id, text_id, "application/warc-fields", F.col("fields")),
        derived("conversion", text_id, meta_id, "text/plain; charset=UTF-8", F.col("text")),
    )).alias("r"))
    return both.select("r.*")


def _plain_head(content_type: Column) -> Column:
    """The HTTP head that a null one stands for."""
    return F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: "), content_type)


def write_warc(records: DataFrame, path: str, **options) -> None:
    """One WARC file per task. ``options`` go to Spark's text writer, such as ``compression``."""
    body = F.coalesce("payload", F.col("payload_bytes").cast("string"), F.lit(""))
    # Also at its edges, where the ends of the head and of the record meet it.
    framed = F.concat(F.lit(END), body, F.lit(END))
    encoded = F.contains(body, F.lit(ANY_VERSION)) & F.contains(framed, F.lit(BETWEEN))
    body = F.when(encoded, F.base64(body.cast("binary"))).otherwise(body)
    http = F.coalesce(F.col("http_head"), _plain_head(F.col("content_type")))
    is_response = F.col("warc_type") == "response"
    block = F.when(is_response, F.concat(http, F.lit(END), body)).otherwise(body)
    rows = records.withColumn("block", block)
    header = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    head = F.concat_ws(
        "\r\n", F.lit(VERSION), header("WARC-Type", F.col("warc_type")),
        F.concat(F.lit("WARC-Record-ID: <"), F.col("record_id"), F.lit(">")),
        F.concat(F.lit("WARC-Refers-To: <"), F.col("refers_to"), F.lit(">")),
        F.concat(F.lit("WARC-Concurrent-To: <"), F.col("concurrent_to"), F.lit(">")),
        header("WARC-Target-URI", F.col("target_uri")), header("WARC-Date", F.col("date")),
        header("WARC-Payload-Digest", F.col("payload_digest")),
        header("X-Source-Key", F.col("source_key")), F.col("more_headers"),
        F.when(encoded, F.lit(ENCODED)),
        F.when(is_response, F.lit("Content-Type: application/http; msgtype=response"))
        .otherwise(header("Content-Type", F.col("content_type"))),
        header("Content-Length", F.octet_length("block").cast("string")),
    )
    rows.select(F.concat(head, F.lit(END), F.col("block")).alias("value")).write.options(
        **{"lineSep": END, **options}
    ).text(path)


def read_warc(spark: SparkSession, path: str, *, by_length: bool = False) -> DataFrame:
    """The records of WARC files that :func:`write_warc` or another writer made.

    ``by_length`` also reads records whose body holds what looks like the start of a record. Without it
    any column of such a record fails; a mere count of rows looks at none.
    """
    rows = spark.read.option("lineSep", BETWEEN).text(path)
    rows = _joined(rows) if by_length else rows.select(_piece(F.col("value")).alias("value"))
    rows = _split(rows.filter("value <> ''"))
    named = lambda name: F.regexp_extract("head", rf"(?mi)^{name}:[ \t]*([^\r\n]*)", 1)
    linked = lambda name: F.regexp_extract("head", rf"(?mi)^{name}:[ \t]*<([^>\r\n]*)>", 1)
    given = lambda value: F.when(value != "", value)
    # What is left behind a record is its end, and blank lines of other writers.
    said = "a WARC record is shorter than its Content-Length; by_length reads bodies that hold the start of a record"
    torn = F.raise_error(F.lit(said)).cast("string")
    whole = F.substring(F.col("block").cast("binary"), F.lit(1), F.col("length")).cast("string")
    rows = rows.select(
        F.when(F.col("extra") < 0, torn).otherwise(F.col("head")).alias("head"),
        F.when(F.col("extra") > 0, whole).otherwise(F.col("block")).alias("block"),
    )
    is_response = named("WARC-Type") == "response"
    at = F.instr("block", END)
    # A block without an empty line is all head.
    http = F.when(at > 0, F.substring("block", F.lit(1), at - 1)).otherwise(F.col("block"))
    body = F.when(at > 0, F.col("block").substr(at + len(END), F.lit(_ALL))).otherwise(F.lit(""))
    body = F.when(is_response, body).otherwise(F.col("block"))
    body = F.when(F.contains("head", F.lit(f"\r\n{ENCODED}")), F.unbase64(body).cast("string")).otherwise(body)
    kind = F.regexp_extract(http, r"(?mi)^Content-Type:[ \t]*([^\r\n]*)", 1)
    http_head = F.when(is_response & (http != _plain_head(kind)), http)
    # A header goes on in lines that start with a blank. Only the first concurrent record has a column.
    lines = F.split("head", "\r\n(?![ \t])")
    lines = F.slice(lines, F.lit(2), F.size(lines))  # behind the rest of the version
    concurrent = F.filter(lines, lambda x: x.rlike(CONCURRENT))
    more = F.concat(F.filter(lines, lambda x: ~x.rlike(KNOWN)), F.slice(concurrent, F.lit(2), F.size(lines)))
    more_headers = given(F.array_join(more, "\r\n"))
    return rows.select(
        linked("WARC-Record-ID").alias("record_id"), named("WARC-Type").alias("warc_type"),
        given(linked("WARC-Refers-To")).alias("refers_to"),
        given(linked("WARC-Concurrent-To")).alias("concurrent_to"),
        named("WARC-Target-URI").alias("target_uri"), named("WARC-Date").alias("date"),
        F.when(is_response, kind).otherwise(named("Content-Type")).alias("content_type"),
        named("WARC-Payload-Digest").alias("payload_digest"), named("X-Source-Key").alias("source_key"),
        body.alias("body"), http_head.alias("http_head"), more_headers.alias("more_headers"),
    ).select(
        "record_id", "warc_type", "refers_to", "concurrent_to", "target_uri", "date", "content_type", "payload_digest",
        "source_key", F.when(F.is_valid_utf8("body"), F.col("body")).alias("payload"), "http_head", "more_headers",
        F.when(~F.is_valid_utf8("body"), F.col("body").cast("binary")).alias("payload_bytes"),
    )


def _piece(value: Column) -> Column:
    """What stands between two starts; the first piece of a file still has its own start."""
    first = F.startswith(value, F.lit(ANY_VERSION))
    return F.when(first, value.substr(F.lit(len(ANY_VERSION) + 1), F.lit(_ALL))).otherwise(value)


def _split(rows: DataFrame) -> DataFrame:
    """``head`` and ``block`` of each piece, the ``length`` its head says, and the bytes ``extra`` to it."""
    cut = F.instr("value", END)
    rows = rows.withColumns({
        "head": F.substring("value", F.lit(1), cut - 1),
        "block": F.col("value").substr(cut + len(END), F.lit(_ALL)),
    })
    length = F.regexp_extract("head", r"(?mi)^Content-Length:[ \t]*([0-9]+)", 1)
    rows = rows.withColumn("length", F.when(length != "", length.cast("long")))
    return rows.withColumn("extra", F.coalesce(F.octet_length("block") - F.col("length"), F.lit(0)))


def _joined(rows: DataFrame) -> DataFrame:
    """The records, ``value``, put together from pieces as their lengths tell.

    The pieces of a file claim stretches of it. Where a claim reaches beyond the next piece, pieces
    whose claims overlap form an island, whose first piece starts a record; only within islands is
    each next start looked up. Windows see the pieces' numbers, and no text.
    """
    importable(rows.sparkSession)
    place = ["file", "block", "n"]
    rows = written(rows.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"), _piece(F.col("value")).cast("binary").alias("bytes"),
        F.octet_length("value").cast("long").alias("size"),
    ))
    numbers = rows.select("*", F.col("bytes").cast("string").alias("value")).drop("bytes").withColumnRenamed("block", "of")
    numbers = _split(numbers).withColumnRenamed("block", "text").withColumnRenamed("of", "block")
    claimed = F.col("size") - F.octet_length("text") + F.coalesce("length", F.octet_length("text").cast("long"))
    in_file = Window.partitionBy("file").orderBy("block", "n")
    start = F.sum(F.col("size") + len(BETWEEN)).over(in_file) - F.col("size") - len(BETWEEN)
    numbers = numbers.select(*place, start.alias("start"), claimed.alias("claimed"))
    numbers = numbers.withColumn("end", F.col("start") + F.greatest("claimed", F.lit(0)))
    reached = F.max("end").over(in_file.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("start") - len(BETWEEN) >= reached, F.lit(True))
    numbers = numbers.withColumn("begins", begins.cast("long"))
    numbers = written(numbers.withColumn("island", F.sum("begins").over(in_file)).drop("begins", "claimed"))
    several = numbers.groupBy("file", "island").count().filter("count > 1").select("file", "island")
    torn = numbers.join(several, ["file", "island"], "left_semi")
    found = written(torn.groupBy("file", "island").applyInArrow(
        _records, "file string, block long, n long, start long, record long"
    ))
    alone = rows.join(found.select(*place), place, "left_anti").select(F.col("bytes").cast("string").alias("value"))
    parts = rows.join(found, place).groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("start", "bytes"))).alias("parts")
    )
    joined = F.aggregate(
        F.slice("parts", F.lit(2), F.size("parts")), F.col("parts")[0]["bytes"],
        lambda found, x: F.concat(found, F.lit(BETWEEN).cast("binary"), x["bytes"]),
    )
    # Written, so that what is checked of records is not checked of their pieces.
    return written(alone.unionByName(parts.select(joined.cast("string").alias("value"))))


def _records(rows: pa.Table) -> pa.Table:
    """Which record each piece of an island belongs to: that of the last true start."""
    rows = rows.sort_by("start")
    record, end, found = None, -1, []
    for start, own_end in zip(rows.column("start").to_pylist(), rows.column("end").to_pylist()):
        if record is None or start - len(BETWEEN) >= end:
            record, end = start, own_end
        found.append(record)
    kept = rows.select(["file", "block", "n", "start"])
    return kept.append_column("record", pa.array(found, pa.int64()))


def oracle_sql() -> str:
    """The derivatives of ``pages`` in DuckDB's SQL."""
    text = f"regexp_replace(payload, '{HIDDEN}', ' ', 'g')"
    text = f"regexp_replace(regexp_replace({text}, '{BLOCK_TAG}', chr(10), 'g'), '{TAG}', '', 'g')"
    for entity, sign in ENTITIES:
        text = "replace({}, '{}', '{}')".format(text, entity, sign.replace("'", "''"))
    text = rf"regexp_replace({text}, '[ \t\f\r]+', ' ', 'g')"
    text = rf"regexp_replace({text}, ' ?\n[ \n]*', chr(10), 'g')"
    text = f"trim({text}, ' ' || chr(10))"
    link = SQL_LINK.replace("'", "''")
    uuid = lambda of: (
        "(SELECT 'urn:uuid:' || h[1:8] || '-' || h[9:12] || '-4' || h[14:16] || '-8' || h[18:20] || '-' || "
        f"h[21:32] FROM (SELECT md5({of}) AS h))"
    )
    return rf"""
WITH source AS (
  SELECT page_id, regexp_replace(coalesce(url, ''), '\s', '', 'g') AS uri, coalesce(html, '') AS payload
  FROM pages),
digests AS (SELECT *, 'sha256:' || sha256(payload) AS digest FROM source),
responses AS (
  SELECT *, {uuid("'response' || chr(10) || page_id || chr(10) || uri || chr(10) || digest")} AS id FROM digests),
parsed AS (
  SELECT *, {uuid("'metadata' || chr(10) || id")} AS meta_id, {uuid("'conversion' || chr(10) || id")} AS text_id,
    regexp_replace(regexp_extract(payload, '{TITLE}', 1), '\s+', ' ', 'g') AS title,
    list_transform(regexp_extract_all(payload, '{link}', 1), lambda x: regexp_replace(x, '\s', '', 'g')) AS links,
    {text} AS text FROM responses),
blocks AS (
  SELECT *, array_to_string(list_concat(['title: ' || title, 'source-content-type: text/html; charset=UTF-8',
    'source-content-length: ' || strlen(payload), 'source-payload-digest: ' || digest],
    list_transform(links, lambda x: 'outlink: ' || x)), chr(13) || chr(10)) AS fields FROM parsed)
SELECT page_id, 'metadata' AS warc_type, meta_id AS record_id, id AS refers_to, text_id AS concurrent_to,
  uri AS target_uri, 'application/warc-fields' AS content_type, 'sha256:' || sha256(fields) AS payload_digest,
  strlen(fields)::BIGINT AS n_bytes FROM blocks
UNION ALL
SELECT page_id, 'conversion', text_id, id, meta_id, uri, 'text/plain; charset=UTF-8', 'sha256:' || sha256(text),
  strlen(text)::BIGINT FROM blocks"""
