"""WARC archives with revisit records.

Headers, without payloads, are shuffled by payload digest; the record with the largest id of
each payload stays a response, the others refer to it. Only records that may be revisits go
through a join with their payload, and the archives are written by Spark's text writer: a record
is a row, and the blank lines that end a WARC record are the line separator.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import datetime, timezone
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cotejo.llm.common import id_filter, mark_possible, record_batch, stage
from cotejo.session import ensure_checkpoint_dir

END = "\r\n\r\n"
RECORDS_PER_FILE = 20_000
# Digits of base 32 as Spark's conv writes them, and as RFC 4648 does.
CONV32, RFC32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(value: Column) -> Column:
    """SHA-1 in upper-case base 32: four times 40 bits, eight digits each."""
    code = F.sha1(value)
    parts = [F.lpad(F.conv(F.substring(code, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), CONV32, RFC32)


def record_urn(record: Column) -> Column:
    code = F.md5(record.cast("string"))
    parts = [F.substring(code, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def records(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest and the record's own number."""
    payload = F.coalesce("html", F.lit(""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        base32_sha1(payload.cast("binary")).alias("payload_digest"),
    ).withColumn("record", F.xxhash64("page_id", "url", "payload_digest"))


def resolve(headers: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Add record_type and refers_to to headers: of equal payloads of at least ``least_bytes``
    the largest page_id is the response. Repeated rows of that id are all responses."""
    keys = ["payload_digest", "payload_bytes"]
    originals = headers.groupBy(*keys).agg(F.max(F.struct("page_id", "url")).alias("first"))
    revisit = (F.col("payload_bytes") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    return (
        headers.join(originals, keys)
        .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(revisit, F.col("first.page_id")))
        .withColumn("refers_to_url", F.when(revisit, F.col("first.url")))
        .drop("first")
    )


def _field(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))).otherwise("")


def _record(kind: str, date: str, extra: list[Column], payload: Column) -> Column:
    """A whole record but for the blank lines at its end, header fields made anew."""
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(END)
    )
    head = F.concat(
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Date: {date}\r\n"),
        _field("WARC-Record-ID", record_urn(F.concat_ws(":", F.lit(kind), F.col("record")))),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _field("Page-ID", F.col("page_id")),
        _field("Payload-Length", F.col("payload_bytes")),
        *extra,
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _field("Content-Length", F.octet_length(http) + F.octet_length(payload)),
        F.lit("\r\n"),
    )
    return F.concat(head, http, payload)


def _without(every: DataFrame, revisits: DataFrame) -> DataFrame:
    """Records that are no revisits. What surely is a response, by the hash of its key, passes
    without a shuffle; the others are compared by the key itself, so that equal hashes of two
    records lose none."""
    key = ["record", "page_id", "url", "payload_digest"]
    marked = mark_possible(every, "record", id_filter(revisits, "record"), "__possible")
    sure, other = marked.filter("not __possible").drop("__possible"), marked.filter("__possible").drop("__possible")
    known = revisits.select(*key).distinct().alias("__r")
    same = reduce(and_, [F.col(f"__o.{c}").eqNullSafe(F.col(f"__r.{c}")) for c in key])
    return sure.unionByName(other.alias("__o").join(known, same, "left_anti"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, date: str | None = None) -> None:
    """Write gzipped archives of ``pages`` (page_id, url, html) in which a payload lies once.
    ``date`` stands in all headers, by default the time of the call."""
    date = date or f"{datetime.now(timezone.utc):%Y-%m-%dT%H:%M:%SZ}"
    every = records(pages)
    headers = stage(resolve(every.drop("payload"), least_bytes))
    revisits = headers.filter("record_type = 'revisit'")
    whole = _without(every, revisits)
    referring = [
        F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"),
        F.lit(f"WARC-Refers-To-Date: {date}\r\n"),
        _field("WARC-Refers-To", record_urn(F.concat_ws(":", F.lit("response"), F.xxhash64("refers_to", "refers_to_url", "payload_digest")))),
        _field("WARC-Refers-To-Target-URI", F.col("refers_to_url")),
        _field("Refers-To-Page-ID", F.col("refers_to")),
    ]
    (
        whole.select(_record("response", date, [], F.col("payload")).alias("value"))
        .unionByName(revisits.select(_record("revisit", date, referring, F.lit("")).alias("value")))
        .write.option("lineSep", END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(path)
    )


ARCHIVED = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, intact boolean"


def parse_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record, from the stretches between blank lines.

    Blocks hold blank lines themselves; their length says where they end. One record is held.
    """
    mark = END.encode()
    waiting, have, need = [], 0, 0
    for piece in pieces:
        waiting.append(piece + mark)
        have += len(waiting[-1])
        if have < need:
            continue
        held, need = b"".join(waiting), 0
        while held:
            start = len(held) - len(held.lstrip(b"\r\n"))
            end = held.find(mark, start)
            if end < 0:
                break
            fields = dict(line.split(": ", 1) for line in held[start:end].decode().split("\r\n")[1:])
            size, at = int(fields["Content-Length"]), end + len(mark)
            if len(held) < at + size:
                need = at + size
                break
            yield fields, held[at : at + size]
            held = held[at + size :].lstrip(b"\r\n")
        waiting, have = [held], len(held)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """What the archives say: a row for each record. ``payload_bytes`` and ``payload_digest`` of
    a response are taken from its block, those of a revisit from its header."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import base64
        import hashlib

        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("intact", pa.bool_())])
        pieces = (v.as_py() for batch in batches for v in batch.column(0).cast(pa.binary()))
        rows = []
        number = lambda fields, name: int(fields[name]) if name in fields else None
        for fields, block in parse_records(pieces):
            length, code, good = number(fields, "Payload-Length"), fields["WARC-Payload-Digest"].removeprefix("sha1:"), True
            if fields["WARC-Type"] == "response":
                payload = block[block.index(END.encode()) + len(END) :]
                found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                good = found == code and length == len(payload)
                length, code = len(payload), found
            rows.append((number(fields, "Page-ID"), fields.get("WARC-Target-URI"), length, code, fields["WARC-Type"], number(fields, "Refers-To-Page-ID"), good))
            if len(rows) >= 5000:
                yield record_batch(schema, zip(*rows))
                rows = []
        if rows:
            yield record_batch(schema, zip(*rows))

    return spark.read.option("lineSep", END).text(path).mapInArrow(run, ARCHIVED)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write archives of ``pages`` to the shared folder and read them back.

    A null html is an empty payload; empty payloads are equal to each other. Repeated rows get a
    record each. A null page_id is below all others; a null url has no target field. Other
    columns are not read. An empty table gives no rows.
    """
    spark = pages.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cotejo-llm/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, least_bytes)
    return read_archives(spark, path)
