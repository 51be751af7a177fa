"""WARC archives with revisit records for payloads that occur again.

Writing: page headers (id, address, payload length and digest, never the
payload) are shuffled by digest; per digest the smallest page is the response,
the others revisit it; the marked headers are joined back to the pages and each
page becomes one record.  Spark's text writer puts the records out, the blank
lines that end a record being its line separator, so the archives are committed
like any Spark output and live on any file system that Spark writes.

Reading: archive files are split into records by their Content-Length, and
revisit records are joined to the responses they refer to.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.llm.joins import lookup
from claimflow.llm.scratch import Scratch, scratch

# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"

SMALLEST = 100           # shorter payloads are stored again rather than referred to
RECORDS_PER_FILE = 20_000
DATE = "2000-01-01T00:00:00Z"


def _record_id(page: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.coalesce(page.cast("string"), F.lit("none")), digest))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *parts))


def _payload(html: Column) -> Column:
    return F.coalesce(html, F.lit(""))


def _digest(html: Column) -> Column:
    return F.sha2(F.encode(_payload(html), "utf-8"), 256)


def _address(url: Column) -> Column:
    return F.regexp_replace(url, r"[\x00-\x1F\x7F]", "")


def resolve(run: Scratch, pages: DataFrame, smallest: int = SMALLEST) -> DataFrame:
    """The pages that revisit another: page_id, digest, first_id, first_uri.

    Pages with equal payloads of at least ``smallest`` bytes: the smallest
    page_id is the response, the others revisit it.  Rows that share page_id and
    payload with the response are responses too; a page without an id can only
    revisit.
    """
    headers = run.stage(pages.select("page_id", _address(F.col("url")).alias("uri"),
                                     F.octet_length(_payload(F.col("html"))).alias("bytes"),
                                     _digest(F.col("html")).alias("digest"))
                        .filter(F.col("bytes") >= smallest), "headers")
    firsts = run.stage(
        headers.groupBy("digest").agg(
            F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "uri"))).alias("f"),
            F.count("*").alias("n"))
        .filter("n > 1 AND f IS NOT NULL")
        .select("digest", F.col("f.page_id").alias("first_id"), F.col("f.uri").alias("first_uri"), "n"),
        "firsts")
    same = lookup(headers.select("page_id", "digest"), firsts, ["digest"], "n")
    return run.stage(same.filter(~F.col("page_id").eqNullSafe(F.col("first_id"))).distinct(), "revisits")


def records(pages: DataFrame, revisits: DataFrame, date: str = DATE) -> DataFrame:
    """One row ``value`` per page: the text of its record, without the final blank lines."""
    p = pages.select("page_id", _address(F.col("url")).alias("uri"), _payload(F.col("html")).alias("html"),
                     _digest(F.col("html")).alias("digest"))
    r = revisits.select(F.col("page_id").alias("r_page"), F.col("digest").alias("r_digest"),
                        "first_id", "first_uri")
    j = p.join(r, p["page_id"].eqNullSafe(r["r_page"]) & (p["digest"] == r["r_digest"]), "left")
    again = F.col("first_id").isNotNull()

    def field(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    def only(name: str, value: Column) -> Column:
        return F.when(again, field(name, value)).otherwise("")

    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length("html").cast("string"), F.lit(END))
    block = F.concat(http, F.when(again, "").otherwise(F.col("html")))
    first = F.concat(F.lit("<"), _record_id(F.col("first_id"), F.col("digest")), F.lit(">"))
    return j.select(F.concat(
        F.lit(f"{VERSION}\r\n"),
        field("WARC-Type", F.when(again, "revisit").otherwise("response")),
        field("WARC-Record-ID", F.concat(F.lit("<"), _record_id(F.col("page_id"), F.col("digest")), F.lit(">"))),
        field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", F.col("uri")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        only("WARC-Profile", F.lit(PROFILE)), only("WARC-Refers-To", first),
        only("WARC-Refers-To-Target-URI", F.col("first_uri")), only("WARC-Refers-To-Date", F.lit(date)),
        field("X-Page-ID", F.col("page_id").cast("string")),
        field("Content-Type", F.lit("application/http;msgtype=response")),
        field("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"), block).alias("value"))


def write_archives(run: Scratch, pages: DataFrame, path: str, date: str = DATE) -> None:
    """Write ``pages`` (page_id, url, html) as archives under ``path``."""
    (records(pages, resolve(run, pages), date).write.option("lineSep", END)
     .option("maxRecordsPerFile", RECORDS_PER_FILE).option("compression", "none").text(path))


READ_SCHEMA = ("record_id string, record_type string, page_id long, uri string, date string, "
               "payload_digest string, payload_bytes long, refers_to_id string, stored_digest string")


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8").split("\r\n")
    return {"": lines[0]} | {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}


def parse(data: bytes, with_payload: bool = False) -> Iterator[dict]:
    """The records of one archive; a record that is cut or malformed is an error."""
    at, view = 0, memoryview(data)
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        head = _headers(data[at:end])
        start = end + 4
        stop = start + int(head["content-length"])
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where it says")
        body = data.find(b"\r\n\r\n", start, stop) + 4
        http, kind = _headers(data[start:body - 4]), head["warc-type"]
        stored = view[body:stop] if kind == "response" else None
        page = head.get("x-page-id")
        out = {"record_id": head["warc-record-id"].strip("<>"), "record_type": kind,
               "page_id": None if page is None else int(page), "uri": head.get("warc-target-uri"),
               "date": head.get("warc-date"),
               "payload_digest": head["warc-payload-digest"].removeprefix("sha256:"),
               "payload_bytes": int(http["content-length"]),
               "refers_to_id": head["warc-refers-to"].strip("<>") if "warc-refers-to" in head else None,
               "stored_digest": hashlib.sha256(stored).hexdigest() if stored is not None else None}
        if with_payload:
            out["payload"] = bytes(stored) if stored is not None else None
        yield out
        at = stop + 4


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The records of the archives under ``path``, one row each.

    ``stored_digest`` is computed from the stored payload of a response;
    ``with_payload`` adds the payload itself.
    """
    ddl = READ_SCHEMA + (", payload binary" if with_payload else "")
    names = [c.split()[0] for c in ddl.split(", ")]
    kinds = {c: {"long": pa.int64(), "binary": pa.binary()}.get(t, pa.string())
             for c, t in (x.split() for x in ddl.split(", "))}
    schema = pa.schema([(c, kinds[c]) for c in names])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                rows, size = [], 0
                for row in parse(data.as_py(), with_payload):
                    rows.append(row)
                    size += len(row.get("payload") or b"")
                    if len(rows) >= 5000 or size >= 1 << 25:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(split, ddl)


def resolved(run: Scratch, archive: DataFrame) -> DataFrame:
    """Archive records with ``refers_to``: the page_id of the response that a revisit names."""
    rows = run.stage(archive, "records")
    again = rows.filter("record_type = 'revisit'")
    named = again.groupBy("refers_to_id").agg(F.count("*").alias("n"))
    originals = rows.filter("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to_id")).agg(
        F.min("page_id").alias("refers_to"))
    found = run.stage(named.join(originals, "refers_to_id"), "originals")
    return lookup(again, found, ["refers_to_id"], "n", "left").unionByName(
        rows.filter("record_type <> 'revisit'").withColumn("refers_to", F.lit(None).cast("long")))


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as its record in the archives tells it.

    Null html is an empty payload, a null url has no address header, control
    characters in a url are left out.  Further columns are not read; no pages
    give no rows.
    """
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    with scratch(spark) as run:
        path = run.path("warc")
        write_archives(run, pages, path)
        out = resolved(run, read_archives(spark, path)).select(
            "page_id", "payload_bytes",
            # a response's digest is that of the bytes read back
            F.coalesce("stored_digest", "payload_digest").alias("payload_digest"),
            "record_type", "refers_to")
        return run.result(out, "op2")


OP2_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (
  SELECT *, CASE WHEN payload_bytes >= 100
                 THEN min(page_id) OVER (PARTITION BY payload_digest, payload_bytes >= 100)
                 ELSE page_id END AS first_id
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM f
"""
