"""WARC archives: writing with segments and revisits, reading with reassembly.

``write_archive`` turns pages into records: an HTTP response in chunked transfer
framing, cut into continuation records if it is long, or a revisit if an equal
payload of at least ``revisit_bytes`` is kept by the record with the largest page
id. ``read_archive`` parses the files by content length, groups continuation
records by their origin's identifier, orders them by segment number, verifies the
total length and decodes the framing.

Record identifiers are ``urn:page:<page id>:<payload SHA-1>:<row>``; a revisit refers
to its page id and payload.

Defined results: a null page is an empty payload; a null page id is never referred
to, and comes back null; repeated rows are a record each (of one id and payload, all
are responses); segments that are missing, or whose total is wrong, give a null
payload and ``complete`` false. No pages give an empty archive.
"""

from __future__ import annotations

import gzip
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, saved

EOL = "\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def chunked(payload, chunk_bytes: int) -> F.Column:
    """A binary column in chunked transfer framing, as a string of the same bytes."""
    size = F.octet_length(payload)
    count = F.ceil(size / F.lit(chunk_bytes)).cast("int")

    def chunk(i):
        part = F.substring(payload, i * chunk_bytes + 1, F.lit(chunk_bytes))
        return F.concat(F.lower(F.hex(F.octet_length(part))), F.lit(EOL), part.cast("string"), F.lit(EOL))

    chunks = F.transform(F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>")), chunk)
    return F.concat(F.array_join(chunks, ""), F.lit("0" + EOL + EOL))


def _header(name: str, value) -> F.Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), r"[\r\n]+", " "), F.lit(EOL)), F.lit(""))


def write_archive(pages: DataFrame, path: str, *, revisit_bytes: int = 1000, segment_bytes: int = 32768,
                  chunk_bytes: int = 8192, records_per_file: int = 5000) -> None:
    """Writes a record per row of ``pages`` (page_id, url, html) as gzip files under ``path``."""
    with Scratch(pages.sparkSession, "warc") as scratch:
        _write(pages, path, revisit_bytes, segment_bytes, chunk_bytes, records_per_file, scratch)


def _write(pages, path, revisit_bytes, segment_bytes, chunk_bytes, records_per_file, scratch) -> None:
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"digest": F.sha1("payload"), "size": F.octet_length("payload")})
    # only payloads that stand in several records: written first, so that its size decides on a broadcast
    kept = scratch.save(rows.where(F.col("size") >= revisit_bytes).groupBy("digest", "size")
                 .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
                 .where("n > 1 and refers_to is not null")
                 .select(F.concat("digest", F.lit(":"), "size").alias("same"), "refers_to"), "kept")
    # small payloads have no partner; their own key spreads them
    same = F.when(F.col("size") >= revisit_bytes, F.concat("digest", F.lit(":"), "size")).otherwise(
        F.concat(F.lit("own "), F.coalesce(F.col("page_id").cast("string"), F.lit(""))))
    told = (rows.withColumn("same", same).join(kept, "same", "left").drop("same")
            .withColumn("revisit", F.coalesce(~F.col("page_id").eqNullSafe(F.col("refers_to")), F.lit(False)) & F.col("refers_to").isNotNull())
            .withColumn("row", F.monotonically_increasing_id()))
    block = F.when(F.col("revisit"), F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), chunked(F.col("payload"), chunk_bytes)))
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(":"), "digest", F.lit(":"), "row", F.lit(">"))
    blocks = told.select("page_id", "url", "digest", "refers_to", "revisit", name.alias("id"), block.cast("binary").alias("block"))
    segments = F.greatest(F.ceil(F.octet_length("block") / F.lit(segment_bytes)), F.lit(1)).cast("int")
    cut = (blocks.withColumn("segments", segments).withColumn("segment", F.explode(F.sequence(F.lit(1), F.col("segments"))))
           .withColumn("part", F.substring(F.col("block"), (F.col("segment") - 1) * segment_bytes + 1, F.lit(segment_bytes))))
    first, several, last = F.col("segment") == 1, F.col("segments") > 1, F.col("segment") == F.col("segments")
    only = lambda test, value: F.when(test, value)
    record = F.concat(
        F.lit("WARC/1.1" + EOL),
        _header("WARC-Type", F.when(~first, "continuation").when(F.col("revisit"), "revisit").otherwise("response")),
        _header("WARC-Record-ID", F.when(first, F.col("id")).otherwise(F.concat(F.expr("left(id, length(id) - 1)"), F.lit("+"), "segment", F.lit(">")))),
        F.lit("WARC-Date: 2024-01-01T00:00:00Z" + EOL),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Page-ID", F.col("page_id")),
        _header("WARC-Payload-Digest", only(first, F.concat(F.lit("sha1:"), "digest"))),
        _header("WARC-Refers-To", only(F.col("revisit"), F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(":"), "digest", F.lit(">")))),
        _header("WARC-Segment-Number", only(several, F.col("segment"))),
        _header("WARC-Segment-Origin-ID", only(~first, F.col("id"))),
        _header("WARC-Segment-Total-Length", only(several & last, F.octet_length("block"))),
        F.lit("Content-Type: application/http; msgtype=response" + EOL),
        _header("Content-Length", F.octet_length("part")),
        F.lit(EOL), F.col("part").cast("string"))
    # the sink ends every record with the two line ends that the format asks for
    (cut.select(record.alias("value")).write.option("lineSep", EOL * 2).option("maxRecordsPerFile", records_per_file)
     .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path))


def records_of(content: bytes):
    """(headers, block) of every record of one archive file, by content length."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)), 1 << 16)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            key, _, value = line.partition(b":")
            headers[key.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("the file ends within a record")
        yield headers, block


def payload_of(block: bytes) -> bytes | None:
    """Payload of an HTTP message; None if its chunked framing is broken."""
    head, end, body = block.partition(b"\r\n\r\n")
    if not end:
        return None
    if b"transfer-encoding: chunked" not in head.lower():
        return body
    parts, at = [], 0
    while True:
        stop = body.find(b"\r\n", at)
        try:
            size = int(body[at:stop].split(b";")[0], 16) if stop >= 0 else -1
        except ValueError:
            size = -1
        if size < 0 or len(body) < stop + 2 + size:
            return None
        if size == 0:
            return b"".join(parts)
        parts.append(body[stop + 2:stop + 2 + size])
        at = stop + 2 + size
        if body[at:at + 2] != b"\r\n":
            return None
        at += 2


INFO = {"record_id": T.StringType(), "record_type": T.StringType(), "page_id": T.LongType(),
        "refers_to": T.LongType(), "header_digest": T.StringType()}
WHOLE, PART = (T.StructType([T.StructField(n, t) for n, t in (INFO | more).items()]) for more in (
    {"payload": T.BinaryType(), "complete": T.BooleanType()},
    {"origin": T.StringType(), "segment": T.IntegerType(), "total": T.LongType(), "block": T.BinaryType()}))


def _info(h: dict[str, str]) -> tuple:
    refers = h.get("warc-refers-to", "")
    page = h.get("warc-page-id")
    digest = h.get("warc-payload-digest")
    return (h["warc-record-id"], h["warc-type"], int(page) if page else None,
            int(refers.split(":")[2]) if refers else None, digest.removeprefix("sha1:") if digest else None)


def _parsed(files: DataFrame, schema: T.StructType, row) -> DataFrame:
    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds, rows, held = to_arrow_schema(schema), [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), kinds)], names=kinds.names)

        for files_ in batches:
            for content in files_.column(0):
                for headers, block in records_of(content.as_py()):
                    if (made := row(headers, block)) is not None:
                        rows.append(made)
                        held += len(block)
                    if held > 8 << 20 or len(rows) >= 5000:
                        yield batch()
                        rows, held = [], 0
        if rows:
            yield batch()

    return files.mapInArrow(run, schema)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records of an archive with their whole, decoded payloads (null for revisits).

    Only continued records are shuffled, by their origin's identifier; one
    record's segments are what a group holds.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")

    def whole(h, block):
        if "warc-segment-number" in h or h["warc-type"] not in ("response", "revisit"):
            return None
        if h["warc-type"] == "revisit":
            return (*_info(h), None, True)
        payload = payload_of(block)
        return (*_info(h), payload, payload is not None)

    def part(h, block):
        if "warc-segment-number" not in h:
            return None
        total = h.get("warc-segment-total-length")
        return (*_info(h), h.get("warc-segment-origin-id", h["warc-record-id"]), int(h["warc-segment-number"]),
                int(total) if total else None, block)

    lead = {c: F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c) for c in WHOLE.names[:5]}
    grouped = _parsed(files, PART, part).groupBy("origin").agg(
        *lead.values(), F.max("total").alias("total"), F.max("segment").alias("segments"),
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"))
    numbers = F.transform("parts", lambda p: p["segment"])
    block = F.array_join(F.transform("parts", lambda p: p["block"].cast("string")), "").cast("binary")
    verified = F.coalesce((F.octet_length("block") == F.col("total")) & (numbers == F.sequence(F.lit(1), F.col("segments"))), F.lit(False))
    joined = grouped.withColumn("block", block).withColumn("verified", verified).select(*WHOLE.names[:5], "block", "verified")

    def decode(batches):
        import pyarrow as pa

        for b in batches:
            payloads = [payload_of(x) if ok else None for x, ok in zip(b.column(5).to_pylist(), b.column(6).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(payloads, pa.binary()), pa.array([p is not None for p in payloads])], names=WHOLE.names)

    return _parsed(files, WHOLE, whole).unionByName(joined.mapInArrow(decode, WHOLE))


def op1_warc(spark, sf_dir: str) -> DataFrame:
    """Every page written to WARC files and read back."""
    with Scratch(spark, "warc") as scratch:
        path = f"{scratch.root}/archive"
        write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), path)
        read = saved(read_archive(spark, path).select(
            "page_id", "record_type", "refers_to", "complete", "header_digest", F.octet_length("payload").cast("long").alias("bytes"),
            F.sha1("payload").alias("digest")), "warc-read")
    responses = (read.where("record_type = 'response' and page_id is not null")
                 .groupBy(F.col("page_id").alias("target"), F.col("digest").alias("same")).agg(F.max("bytes").alias("target_bytes")))
    both = read.join(responses, (F.col("refers_to") == F.col("target")) & (F.col("header_digest") == F.col("same")), "left")
    return both.select(
        "page_id", F.coalesce("bytes", "target_bytes").alias("payload_bytes"), F.coalesce("digest", "same").alias("payload_digest"),
        "record_type", "refers_to",
        F.coalesce(F.col("complete") & (F.coalesce("digest", "same") == F.col("header_digest")), F.lit(False)).alias("verified"))


SQL = """
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS payload_digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
k AS (SELECT payload_digest, payload_bytes, max(page_id) AS target FROM p WHERE payload_bytes >= 1000 GROUP BY 1, 2)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN target IS NOT NULL AND page_id IS DISTINCT FROM target THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM target THEN target END AS refers_to, true AS verified
FROM p LEFT JOIN k USING (payload_digest, payload_bytes)
"""
