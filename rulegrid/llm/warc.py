"""WARC derivatives: from every response a metadata record and a plain-text conversion record.

Both refer to the response by ``WARC-Refers-To`` and keep its target URI and payload digest; the metadata record's fields hold the source's
length, digest, title, language and number of links.  Record ids are name-based: the MD5 of what the record is about, written as a UUID, so a
record gets the same id whenever and wherever it is built.  Everything is one projection with regular expressions: no shuffle, no Python.

Plain text: comments, scripts and styles go; tags of blocks become line feeds, other tags go; the entities of ``ENTITIES`` are decoded (``&amp;`` last);
white space is collapsed to single spaces and single line feeds.

Results for odd input: a null page body or url is empty (an empty text, an empty target); equal rows give equal records; an empty table gives
none; unclosed comments, scripts and tags stay as text; very long pages are handled by the same expressions; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Expressions that both Java and RE2 read alike, and what replaces their matches.
STEPS = (
    (r"(?s)<!--.*?-->", ""),
    (r"(?is)<(script|style|noscript)[\s>].*?</(script|style|noscript)[ \t\r\n]*>", " "),
    (r"(?i)</?(p|div|br|li|ul|ol|h[1-6]|tr|table|article|section|header|footer|nav|title|body|html|head|blockquote|pre|hr)([ \t\r\n/][^>]*)?>", "\n"),
    (r"<[a-zA-Z/!?][^>]*>", ""),
)
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))
SPACES = ((r"[ \t\r\x0B\f]+", " "), (r" ?\n[ \n]*", "\n"), (r"^[ \n]+|[ \n]+$", ""))
TITLE = r"(?is)<title[^>]*>([^<]*)</title"
LANGUAGE = r"(?i)<html[^>]* lang=\"([^\"]*)\""
LINK = r"(?i)<a[ \t\r\n][^>]*href="


def plain_text(html: Column) -> Column:
    out = html
    for pattern, to in STEPS:
        out = F.regexp_replace(out, pattern, to)
    for entity, to in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(to))
    for pattern, to in SPACES:
        out = F.regexp_replace(out, pattern, to)
    return out


def record_id(*about: Column) -> Column:
    """``urn:uuid`` of the parts, name-based (version 3 layout)."""
    h = F.md5(F.concat_ws("\n", *about))
    return F.concat(F.lit("urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-3"), F.substring(h, 14, 3), F.lit("-8"), F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))


def _headers(kind: str, content_type: str) -> Column:
    pairs = {
        "WARC-Type": F.lit(kind), "WARC-Record-ID": F.concat(F.lit("<"), "record_id", F.lit(">")), "WARC-Refers-To": F.concat(F.lit("<"), "refers_to", F.lit(">")),
        "WARC-Target-URI": F.col("target_uri"), "WARC-Block-Digest": F.col("block_digest"), "Content-Type": F.lit(content_type), "Content-Length": F.col("content_length").cast("string"),
    }
    return F.concat(F.lit("WARC/1.1\r\n"), *[F.concat(F.lit(f"{k}: "), v, F.lit("\r\n")) for k, v in pairs.items()])


def derivatives(pages: DataFrame) -> DataFrame:
    """Two rows per row of ``pages (page_id, url, html)``: ``page_id, record_type, record_id, refers_to, target_uri, payload_digest`` (the
    source's), ``content_length, block_digest, headers, block``.  A record as written to a file is headers, CRLF, block, CRLF CRLF."""
    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("target_uri"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    )
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    source = source.withColumn("payload_digest", F.concat(F.lit("sha1:"), F.sha1(F.col("html").cast("binary")))).withColumn(
        "refers_to", record_id(F.lit("response"), page, F.col("target_uri"), F.col("payload_digest"))
    )
    fields = F.concat(
        F.lit("source-length: "), F.octet_length("html").cast("string"), F.lit("\r\nsource-payload-digest: "), F.col("payload_digest"),
        F.lit("\r\ntitle: "), F.regexp_replace(F.regexp_extract("html", TITLE, 1), r"[\r\n]+", " "), F.lit("\r\nlanguage: "), F.regexp_extract("html", LANGUAGE, 1),
        F.lit("\r\nlinks: "), F.regexp_count("html", F.lit(LINK)).cast("string"), F.lit("\r\n"),
    )
    built = source.select(
        "page_id", "target_uri", "payload_digest", "refers_to",
        F.explode(F.array(
            F.struct(F.lit("metadata").alias("record_type"), fields.alias("block")), F.struct(F.lit("conversion").alias("record_type"), plain_text(F.col("html")).alias("block"))
        )).alias("r"),
    ).select("*", "r.record_type", "r.block")
    built = (
        built.withColumn("record_id", record_id(F.col("record_type"), F.col("refers_to")))
        .withColumn("block_digest", F.concat(F.lit("sha1:"), F.sha1(F.col("block").cast("binary"))))
        .withColumn("content_length", F.octet_length("block").cast("long"))
    )
    headers = F.when(F.col("record_type") == "metadata", _headers("metadata", "application/warc-fields")).otherwise(_headers("conversion", "text/plain"))
    return built.select("page_id", "record_type", "record_id", "refers_to", "target_uri", "payload_digest", "content_length", "block_digest", headers.alias("headers"), "block")


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def duckdb_sql() -> str:
    """The same records as DuckDB SQL over the view ``pages``."""
    text = "html"
    for pattern, to in STEPS:
        text = f"regexp_replace({text}, {_quote(pattern)}, {_quote(to)}, 'g')"
    for entity, to in ENTITIES:
        text = f"replace({text}, {_quote(entity)}, {_quote(to)})"
    for pattern, to in SPACES:
        text = f"regexp_replace({text}, {_quote(pattern)}, {_quote(to)}, 'g')"

    def uuid(h: str) -> str:
        return f"'urn:uuid:' || substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-3' || substr({h}, 14, 3) || '-8' || substr({h}, 18, 3) || '-' || substr({h}, 21, 12)"

    crlf = "chr(13) || chr(10)"
    fields = (
        f"'source-length: ' || strlen(html) || {crlf} || 'source-payload-digest: ' || payload_digest || {crlf} || 'title: ' || "
        f"regexp_replace(regexp_extract(html, {_quote(TITLE)}, 1), '[\\r\\n]+', ' ', 'g') || {crlf} || 'language: ' || regexp_extract(html, {_quote(LANGUAGE)}, 1) || {crlf} || "
        f"'links: ' || len(regexp_extract_all(html, {_quote(LINK)})) || {crlf}"
    )
    return f"""
WITH source AS (
  SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS html, 'sha1:' || sha1(coalesce(html, '')) AS payload_digest FROM pages
), named AS (
  SELECT *, md5('response' || chr(10) || coalesce(CAST(page_id AS VARCHAR), '') || chr(10) || target_uri || chr(10) || payload_digest) AS h FROM source
), refs AS (SELECT *, {uuid('h')} AS refers_to FROM named), built AS (
  SELECT page_id, 'metadata' AS record_type, refers_to, target_uri, payload_digest, {fields} AS block FROM refs
  UNION ALL
  SELECT page_id, 'conversion', refers_to, target_uri, payload_digest, {text} FROM refs
), digested AS (
  SELECT *, md5(record_type || chr(10) || refers_to) AS r, CAST(strlen(block) AS BIGINT) AS content_length, 'sha1:' || sha1(block) AS block_digest FROM built
), ids AS (SELECT *, {uuid('r')} AS record_id FROM digested)
SELECT page_id, record_type, record_id, refers_to, target_uri, payload_digest, content_length, block_digest,
  'WARC/1.1' || {crlf} || 'WARC-Type: ' || record_type || {crlf} || 'WARC-Record-ID: <' || record_id || '>' || {crlf} || 'WARC-Refers-To: <' || refers_to || '>' || {crlf} ||
  'WARC-Target-URI: ' || target_uri || {crlf} || 'WARC-Block-Digest: ' || block_digest || {crlf} || 'Content-Type: ' ||
  CASE record_type WHEN 'metadata' THEN 'application/warc-fields' ELSE 'text/plain' END || {crlf} || 'Content-Length: ' || content_length || {crlf} AS headers, block
FROM ids
"""
