"""WARC archives as Spark text: written one capture a row, read back record by record, joined into captures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
VERSION = "WARC/1.1"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base32: four runs of 40 bits as eight digits to the base 32 each, then other letters for the digits."""
    hexed = F.sha1(payload)
    runs = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * run, 10), 16, 32), 8, "0") for run in range(4)]
    return F.translate(F.concat(*runs), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def _uuid(*parts: Column) -> Column:
    """A record id that follows from what it names, so a task that runs again writes the same archive."""
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(F.md5(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])),
                                                          "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _record(headers: list[tuple[str, Column | str]], block: Column) -> Column:
    lines = [F.lit(VERSION + CRLF)]
    for name, value in headers:
        value = F.lit(value) if isinstance(value, str) else value
        # A header without a value is left out.
        lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit("")))
    size = F.octet_length(block).cast("string")
    return F.concat(*lines, F.lit("Content-Length: "), size, F.lit(CRLF + CRLF), block, F.lit(CRLF))


def _http_body(payload: Column) -> tuple[Column, Column]:
    """Transfer header and body. A payload that holds the archive's own version mark is sent in chunks that part it."""
    parts = F.split(payload, VERSION.replace(".", "\\."), -1)
    last = F.size(parts) - 1
    pieces = F.transform(parts, lambda x, k: F.concat(F.when(k > 0, F.lit("1.1")).otherwise(F.lit("")), x,
                                                      F.when(k < last, F.lit("WARC/")).otherwise(F.lit(""))))
    chunked = F.concat(F.array_join(F.transform(pieces, lambda x: F.concat(F.lower(F.hex(F.octet_length(x).cast("long"))), F.lit(CRLF), x, F.lit(CRLF))), ""),
                       F.lit("0" + CRLF + CRLF))
    marked = F.instr(payload, VERSION) > 0
    return F.when(marked, F.lit("Transfer-Encoding: chunked" + CRLF)).otherwise(F.lit("")), F.when(marked, chunked).otherwise(payload)


def _unchunked(block: Column) -> Column:
    """The payload of a chunked body, line by line: a size, then data up to that size, then a size again."""
    step = lambda mode, need, out: F.struct(F.lit(mode).alias("mode"), need.alias("need"), out.alias("out"))

    def read(s: Column, line: Column) -> Column:
        n = F.octet_length(line).cast("long")
        size = F.conv(F.trim(F.substring_index(line, ";", 1)), 16, 10).cast("long")
        kept = lambda x: F.array_append(s["out"], x)
        return (F.when(s["mode"] == 0, F.when(size == 0, step(3, size, s["out"])).otherwise(step(1, size, s["out"])))
                .when(s["mode"] == 2, step(0, F.lit(0).cast("long"), s["out"]))
                .when(s["mode"] == 3, s)
                .when(n == s["need"], step(0, F.lit(0).cast("long"), kept(line)))
                .when(n + 2 == s["need"], step(2, F.lit(0).cast("long"), kept(F.concat(line, F.lit(CRLF)))))
                .otherwise(step(1, s["need"] - n - 2, kept(F.concat(line, F.lit(CRLF))))))

    start = step(0, F.lit(0).cast("long"), F.array().cast("array<string>"))
    return F.aggregate(F.split(block, CRLF, -1), start, read, lambda s: F.array_join(s["out"], ""))


def write_archives(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
                   min_revisit_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """One request, response (or revisit) and metadata record for every row of ``pages``, in gzip archives below ``path``.

    Payloads of at least ``min_revisit_bytes`` bytes that occur again are written once, with the smallest id;
    other ids revisit them. Digests meet in a combined aggregate; only ids that revisit go back to the pages, in a join on
    (id, digest), so a payload of a third of all pages makes no large group.

    A null payload is empty. A null id is larger than any other and revisits equal payloads of pages with one; among null
    ids alone all are responses. Rows that share id and payload are alike: all responses, or all revisits.
    A null url leaves the target out; line ends and version marks in a url are percent-encoded.
    """
    body = F.coalesce(F.col(body_col), F.lit(""))
    facts = pages.select(F.col(id_col).alias("id"), base32_sha1(body).alias("digest"), F.octet_length(body).cast("long").alias("bytes"))
    first = facts.where(F.col("bytes") >= min_revisit_bytes).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = (facts.join(first, "digest").where((F.col("id") != F.col("first")) | F.col("id").isNull() & F.col("first").isNotNull())
             .select(F.col("id").alias("_id"), F.col("digest").alias("_digest"), "first").distinct())
    url = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.col(url_col), "\r", "%0D"), "\n", "%0A"), "WARC/1", "WARC%2F1")
    rows = pages.select(F.col(id_col).alias("id"), url.alias("url"), body.alias("body"), base32_sha1(body).alias("digest"))
    rows = rows.join(again, rows["id"].eqNullSafe(again["_id"]) & (rows["digest"] == again["_digest"]), "left")
    revisit = F.col("_digest").isNotNull()
    transfer, sent = _http_body(F.col("body"))
    http = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF), transfer, F.lit(CRLF))
    me = _uuid(F.col("id"), F.col("digest"))
    common = [("WARC-Date", date), ("WARC-Target-URI", F.col("url"))]
    response = _record([("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))), ("WARC-Record-ID", me), *common,
                        ("WARC-Profile", F.when(revisit, F.lit(IDENTICAL))),
                        ("WARC-Refers-To", F.when(revisit, _uuid(F.col("first"), F.col("digest")))),
                        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
                        ("Content-Type", "application/http; msgtype=response")], F.when(revisit, http).otherwise(F.concat(http, sent)))
    parts = [F.regexp_extract("url", "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^#]*)", k) for k in (1, 2)]
    asked = F.concat(F.lit("GET "), F.coalesce(F.nullif(parts[1], F.lit("")), F.lit("/")), F.lit(" HTTP/1.1" + CRLF + "Host: "),
                     F.coalesce(parts[0], F.lit("")), F.lit(CRLF + CRLF))
    request = _record([("WARC-Type", "request"), ("WARC-Record-ID", _uuid(F.lit("request"), F.col("id"), F.col("digest"))), *common,
                       ("WARC-Concurrent-To", me), ("Content-Type", "application/http; msgtype=request")], asked)
    notes = F.concat(F.coalesce(F.concat(F.lit("pageId: "), F.col("id").cast("string"), F.lit(CRLF)), F.lit("")),
                     F.lit("payloadBytes: "), F.octet_length("body").cast("string"), F.lit(CRLF))
    metadata = _record([("WARC-Type", "metadata"), ("WARC-Record-ID", _uuid(F.lit("metadata"), F.col("id"), F.col("digest"))), *common,
                        ("WARC-Concurrent-To", me), ("Content-Type", "application/warc-fields")], notes)
    # Each record ends in an empty line; the writer's line end closes the last one of a row.
    value = F.concat(request, F.lit(CRLF), response, F.lit(CRLF), metadata)
    rows.select(value.alias("value")).write.option("compression", "gzip").option("lineSep", CRLF).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row for every record: record_id, record_type, concurrent_to, refers_to, target_uri, date, payload_digest
    (of the header), block (bytes), http_head and payload (bytes; null but for HTTP blocks).

    Archives are split at the version mark by Spark's text reader; a record that is shorter than its declared length
    raises an error, so a foreign archive with the mark inside a payload is refused, never cut.
    """
    raw = spark.read.option("lineSep", VERSION + CRLF).text(path).where("value <> ''")
    head = F.substring_index("value", CRLF + CRLF, 1)
    field = lambda name: F.nullif(F.regexp_extract("head", f"(?im)^{name}:[ \\t]*(.*?)[ \\t]*$", 1), F.lit(""))
    size = F.coalesce(field("Content-Length").cast("long"), F.lit(0))
    start = F.octet_length("head") + 5
    block = F.expr("substring(cast(value as binary), octet_length(head) + 5, cast(size as int))")
    out = raw.withColumn("head", head).withColumn("size", size)
    out = out.select("head", F.when(F.octet_length("value") - start + 1 < F.col("size"),
                                    F.raise_error(F.concat(F.lit("truncated record "), F.col("head")))).otherwise(block).alias("block"))
    is_http = F.lower(F.coalesce(field("Content-Type"), F.lit(""))).startswith("application/http")
    out = out.select(
        field("WARC-Record-ID").alias("record_id"), field("WARC-Type").alias("record_type"),
        field("WARC-Concurrent-To").alias("concurrent_to"), field("WARC-Refers-To").alias("refers_to"),
        field("WARC-Target-URI").alias("target_uri"), field("WARC-Date").alias("date"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"), "block",
        F.when(is_http, F.substring_index(F.col("block").cast("string"), CRLF + CRLF, 1)).alias("http_head"))
    sent = F.expr("substring(block, octet_length(http_head) + 5)")
    chunked = F.lower("http_head").contains("transfer-encoding: chunked")
    return out.withColumn("payload", F.when(chunked, F.encode(_unchunked(sent.cast("string")), "UTF-8")).otherwise(F.when(F.col("http_head").isNotNull(), sent)))


def assemble_captures(records: DataFrame) -> DataFrame:
    """One nested row for every response or revisit: record_id, target_uri, date, response, request, metadata, n_requests, n_metadata.

    Requests and metadata find their response through its id in their concurrent-to header. Of several requests (or metadata
    records) of one response the one of smallest id is kept in the row and all are counted; one that names no
    response in ``records`` has no capture. A response without partners has null in their place. Equal record ids make
    one row each. The payload stays a column of the row and is not read unless it is used.
    """
    # Both kinds of partners in one reading: each record id once, then one row a capture.
    kinds = ("request", "metadata")
    once = (records.where(F.col("record_type").isin(*kinds)).groupBy("concurrent_to", F.col("record_type").alias("kind"), F.col("record_id").alias("id"))
            .agg(F.min("block").alias("block")))
    of = lambda kind: F.when(F.col("kind") == kind, F.struct("id", F.col("block").cast("string").alias("block")))
    partners = once.groupBy(F.col("concurrent_to").alias("record_id")).agg(
        *[F.min(of(k)).alias(k) for k in kinds], *[F.count(of(k)).alias(f"n_{k}") for k in kinds])

    fields = F.expr("map_from_entries(transform(filter(split(metadata.block, '\\r\\n'), x -> instr(x, ': ') > 0), "
                    "x -> struct(substring_index(x, ': ', 1), substring(x, instr(x, ': ') + 2))))")
    main = records.where(F.col("record_type").isin("response", "revisit"))
    return (main.select("record_id", "record_type", "refers_to", "target_uri", "date", "http_head", "payload", "payload_digest",
                        F.octet_length("payload").cast("long").alias("sent_bytes"), base32_sha1(F.col("payload")).alias("sent_digest"))
            .join(partners, "record_id", "left")
            .withColumn("metadata", F.when(F.col("metadata").isNotNull(), F.struct(F.col("metadata.id").alias("id"), fields.alias("fields"))))
            .select("record_id", "target_uri", "date",
                    F.struct("record_type", "refers_to", "http_head", "payload", "payload_digest", "sent_bytes", "sent_digest").alias("response"),
                    "request", "metadata",
                    F.coalesce("n_request", F.lit(0)).alias("n_requests"), F.coalesce("n_metadata", F.lit(0)).alias("n_metadata")))
