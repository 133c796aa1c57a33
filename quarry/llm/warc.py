"""WARC derivatives: each response record becomes a metadata and a plain-text conversion
record.  Both name the response in WARC-Refers-To and carry its target, date, HTTP headers
and payload digest on; each has an identifier and a block digest of its own.

Column functions only: a page is converted where it is read, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Elements that end a line of text, and the entities that are resolved.
BLOCK_TAGS = "address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|head|header|hr|li|main|nav|ol|option|p|pre|section|table|td|th|title|tr|ul"
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")]
#: What is dropped with its content, in this order.
HIDDEN = [r"(?s)<!--.*?-->", r"(?is)<script[ \t\r\n/>].*?</script[ \t\r\n]*>", r"(?is)<script>.*?</script[ \t\r\n]*>",
          r"(?is)<style[ \t\r\n/>].*?</style[ \t\r\n]*>", r"(?is)<style>.*?</style[ \t\r\n]*>"]
BREAK = rf"(?i)</?({BLOCK_TAGS})([ \t\r\n/][^>]*)?>"
TITLE = r"(?is)<title[^>]*>(.*?)</title"
LINK = r"(?i)<a[ \t\r\n][^>]*href"
STATUS = r"^HTTP/[0-9.]+ ([0-9]+)"
DATE = "1970-01-01T00:00:00Z"  # of pages that don't say when they were fetched


def record_id(*parts: Column) -> Column:
    """A UUID made from the parts, so that a rerun names the same record alike."""
    h = F.md5(F.concat_ws("\n", *parts).cast("binary"))
    groups = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *groups), F.lit(">"))


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha1:"), F.sha1(block.cast("binary")))


def plain_text(html: Column) -> Column:
    """Text of a page: hidden parts dropped, block elements on lines of their own, entities
    resolved, blanks collapsed."""
    t = html
    for pattern in HIDDEN:
        t = F.regexp_replace(t, pattern, " ")
    t = F.regexp_replace(F.regexp_replace(t, BREAK, "\n"), r"<[^>]*>", "")
    for name, char in ENTITIES:
        t = F.replace(t, F.lit(name), F.lit(char))
    t = F.regexp_replace(F.regexp_replace(t, r"[ \t\r\x0B\x0C]+", " "), r" ?\n[ \n]*", "\n")
    return F.btrim(t, F.lit(" \n"))


def responses(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Response records of fetched pages: ``page``, record_id, target_uri, date, block (HTTP
    headers and payload).  A null page is empty, a null address an empty target."""
    body = F.coalesce(F.col(html).cast("string"), F.lit(""))
    target = F.coalesce(F.col(url).cast("string"), F.lit(""))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    name = F.coalesce(F.col(page).cast("string"), F.lit(""))
    return pages.select(F.col(page).alias("page"), record_id(F.lit("response"), name, target, F.sha1(body.cast("binary"))).alias("record_id"),
                        target.alias("target_uri"), F.lit(DATE).alias("date"), F.concat(head, body).alias("block")).withColumnRenamed("page", page)


def derive(records: DataFrame, keep: str = "page_id") -> DataFrame:
    """Two rows per response: ``keep``, warc_type (metadata, conversion), record_id, refers_to,
    target_uri, date, content_type, content_length, block_digest, payload_digest and
    source_headers (of the response), block.

    A response without a blank line has headers only and an empty payload.  Repeated
    responses give repeated records, an empty table none; other columns are not read.
    """
    split = F.instr("block", "\r\n\r\n")
    parts = records.select(F.col(keep).alias("k"), F.col("record_id").alias("refers_to"), "target_uri", "date",
                           F.when(split > 0, F.substring("block", F.lit(1), split + 1)).otherwise(F.col("block")).alias("source_headers"),
                           F.when(split > 0, F.substring("block", split + 4, F.length("block"))).otherwise(F.lit("")).alias("payload"))
    parts = parts.withColumns({
        "payload_digest": digest(F.col("payload")), "text": plain_text(F.col("payload")),
        "title": F.btrim(F.regexp_replace(F.regexp_extract("payload", TITLE, 1), r"[ \t\r\n\x0B\x0C]+", " "), F.lit(" ")),
        "links": F.regexp_count("payload", F.lit(LINK)), "status": F.regexp_extract("source_headers", STATUS, 1)})
    fields = F.concat(F.lit("source-record-id: "), F.col("refers_to"), F.lit("\r\nhttp-status: "), F.col("status"), F.lit("\r\ntitle: "), F.col("title"),
                      F.lit("\r\nlinks: "), F.col("links").cast("string"), F.lit("\r\npayload-digest: "), F.col("payload_digest"),
                      F.lit("\r\ntext-digest: "), digest(F.col("text")), F.lit("\r\nsource-headers: "),
                      F.replace(F.rtrim(F.regexp_replace("source_headers", r"[\r\n]+$", "")), F.lit("\r\n"), F.lit("\r\n ")), F.lit("\r\n"))
    both = F.array(F.struct(F.lit("metadata").alias("warc_type"), F.lit("application/warc-fields").alias("content_type"), fields.alias("block")),
                   F.struct(F.lit("conversion").alias("warc_type"), F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("text").alias("block")))
    out = parts.select("k", "refers_to", "target_uri", "date", "payload_digest", "source_headers", F.explode(both).alias("r")).select("*", "r.*")
    return out.select(F.col("k").alias(keep), "warc_type", record_id(F.col("warc_type"), F.col("refers_to")).alias("record_id"), "refers_to", "target_uri", "date",
                      "content_type", F.octet_length("block").cast("long").alias("content_length"), digest(F.col("block")).alias("block_digest"),
                      "payload_digest", "source_headers", "block")


def write(records: DataFrame, path: str, compression: str = "gzip") -> str:
    """Write derived records as WARC files, one per partition."""
    named = [("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"), ("WARC-Target-URI", "target_uri"),
             ("WARC-Date", "date"), ("WARC-Block-Digest", "block_digest"), ("WARC-Payload-Digest", "payload_digest"), ("Content-Type", "content_type"),
             ("Content-Length", "content_length")]
    head = F.concat(F.lit("WARC/1.1\r\n"), *[F.concat(F.lit(f"{n}: "), F.col(c).cast("string"), F.lit("\r\n")) for n, c in named], F.lit("\r\n"))
    (records.select(F.concat(head, F.col("block"), F.lit("\r\n\r")).alias("value"))  # the writer ends each with a line feed
     .write.mode("overwrite").option("compression", compression).option("lineSep", "\n").text(path))
    return path


def oracle_sql() -> str:
    """The query in DuckDB's SQL."""
    def lit(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    text = "payload"
    for pattern in HIDDEN:
        text = f"regexp_replace({text}, {lit(pattern)}, ' ', 'g')"
    text = f"regexp_replace(regexp_replace({text}, {lit(BREAK)}, chr(10), 'g'), '<[^>]*>', '', 'g')"
    for name, char in ENTITIES:
        text = f"replace({text}, {lit(name)}, {lit(char)})"
    text = f"trim(regexp_replace(regexp_replace({text}, '[ \\t\\r\\x0B\\x0C]+', ' ', 'g'), ' ?\\n[ \\n]*', chr(10), 'g'), ' ' || chr(10))"

    def uuid(expr: str) -> str:
        return f"'<urn:uuid:' || regexp_replace(md5({expr}), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5') || '>'"

    nl, crlf = "chr(10)", "chr(13) || chr(10)"
    return f"""
WITH p AS (SELECT page_id, coalesce(url, '') target_uri, coalesce(html, '') payload FROM pages),
r AS (SELECT page_id, target_uri, payload, '{DATE}' AS date,
             {uuid(f"'response' || {nl} || coalesce(CAST(page_id AS VARCHAR), '') || {nl} || target_uri || {nl} || sha1(payload)")} refers_to,
             'HTTP/1.1 200 OK' || {crlf} || 'Content-Type: text/html; charset=utf-8' || {crlf} || 'Content-Length: ' || strlen(payload) || {crlf} source_headers,
             'sha1:' || sha1(payload) payload_digest, {text} AS text,
             trim(regexp_replace(regexp_extract(payload, {lit(TITLE)}, 1), '[ \\t\\r\\n\\x0B\\x0C]+', ' ', 'g'), ' ') title,
             len(regexp_extract_all(payload, {lit(LINK)})) links FROM p),
b AS (SELECT *, 'metadata' warc_type, 'application/warc-fields' content_type,
             'source-record-id: ' || refers_to || {crlf} || 'http-status: 200' || {crlf} || 'title: ' || title || {crlf} || 'links: ' || links || {crlf}
             || 'payload-digest: ' || payload_digest || {crlf} || 'text-digest: sha1:' || sha1(text) || {crlf} || 'source-headers: '
             || replace(regexp_replace(source_headers, '[\\r\\n]+$', ''), {crlf}, {crlf} || ' ') || {crlf} AS block FROM r
      UNION ALL SELECT *, 'conversion', 'text/plain; charset=utf-8', text FROM r)
SELECT page_id, warc_type, {uuid(f"warc_type || {nl} || refers_to")} record_id, refers_to, target_uri, date, content_type,
       strlen(block) content_length, 'sha1:' || sha1(block) block_digest, payload_digest, source_headers, block FROM b"""
