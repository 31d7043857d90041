"""WARC archives with revisit resolution.

Payload digests are made where the payloads are; only headers (order key, digest, length) meet by digest, each group
keeping its largest key. The choice is joined back, and archives are written with fresh headers: the chosen record of
equal payloads as a response, the others as revisits that refer to it and carry no payload. Reading parses by
Content-Length in a stream (plain or gzip, one or many members), hashes payloads as they pass, and joins revisits to
the responses they refer to.

Archives are written by Spark's own text sink, a record a row and the record end as separator, gzip-compressed, so
they go to any file system Spark knows and appear only when a task commits.

Defined cases: a null payload is empty; payloads under ``least`` bytes are never revisits; of records repeated with the
chosen key and payload all stay responses and share the id that revisits refer to; a null key counts as smaller than any, and records with only null keys all
stay responses; control characters in URIs are percent-encoded; an empty table writes an empty archive and reads back
none; other columns are not written.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import lean, small, stored

END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST, DATE = 1000, "2000-01-01T00:00:00Z"
#: Records of an archive: it is read as a whole, so it must stay well under 2 GB compressed.
RECORDS = 20_000
RECORD = "record_id string, record_type string, target_uri string, key long, refers_to_id string, header_digest string, payload_bytes long, payload_digest string"
CHUNK = 1 << 20


# ---------------------------------------------------------------- deciding
def choose(records: DataFrame, least: int = LEAST, order: Column | None = None) -> DataFrame:
    """``records`` (key, uri, payload) with payload_digest, payload_bytes, record_type, original (the response's place
    in the ``order``, which is the key unless given), record_id and refers_to_id."""
    records = records.withColumn("__at", F.col("key") if order is None else order)
    payload = F.coalesce(F.col("payload"), F.lit("").cast(records.schema["payload"].dataType))
    named = records.withColumn("payload", payload).withColumns({"payload_digest": F.sha1(F.col("payload").cast("binary")), "payload_bytes": F.octet_length("payload").cast("long")})
    heads = named.where(F.col("payload_bytes") >= least).select("__at", "payload_digest", "payload_bytes")
    chosen = heads.groupBy("payload_digest", "payload_bytes").agg(F.max("__at").alias("original"), F.count("*").alias("n"))
    chosen = small(stored(chosen.where("n > 1 and original is not null").drop("n"), "originals"))
    joined = named.join(chosen, ["payload_digest", "payload_bytes"], "left")
    again = F.col("original").isNotNull() & ~F.col("__at").eqNullSafe(F.col("original"))
    joined = joined.withColumns({"record_type": F.when(again, "revisit").otherwise("response"), "referred": F.col("original").isNotNull() & ~again, "original": F.when(again, F.col("original"))})
    # Only a record that others refer to needs an id that they can make too; the others' tell rows apart.
    each = record_id(F.col("__at"), F.col("payload_digest"), F.col("uri"), F.monotonically_increasing_id())
    own = F.when(F.col("referred"), record_id(F.col("__at"), F.col("payload_digest"))).otherwise(each)
    other = record_id(F.col("original"), F.col("payload_digest"))
    return joined.withColumns({"record_id": own, "refers_to_id": F.when(again, other)}).drop("referred", "__at")


def record_id(*of):
    h = F.md5(F.concat_ws(":", *(F.coalesce(c.cast("string"), F.lit("null")) for c in of)).cast("binary"))
    parts = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *parts))


# ---------------------------------------------------------------- writing
def one_line(text):
    """Control characters and blanks percent-encoded, as a header's value needs."""
    out = F.coalesce(text, F.lit(""))
    for code in (*range(33), 127):
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return out


def rendered(chosen: DataFrame, date: str = DATE) -> DataFrame:
    """(value): each record of what choose() gives, without its end."""
    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    block = F.concat(http, body)
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: <"), F.col("record_id"), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), one_line(F.col("uri"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.concat(F.lit("X-Order-Key: "), F.col("key").cast("string")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <"), F.col("refers_to_id"), F.lit(f">\r\nWARC-Profile: {PROFILE}"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return chosen.select(F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block).alias("value"))


def write_archives(chosen: DataFrame, path: str, date: str = DATE, records: int = RECORDS) -> None:
    """Writes what choose() gives, at most so many records to an archive."""
    write_records(rendered(chosen, date), path, records)


def write_records(values: DataFrame, path: str, records: int = RECORDS) -> None:
    values.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records).text(path)


# ---------------------------------------------------------------- reading
class Stream:
    """Bytes of a plain or gzip file, a piece at a time."""

    def __init__(self, content: bytes):
        self.content, self.at, self.held = content, 0, b""
        self.squeezed = content[:2] == b"\x1f\x8b"
        self.inflate = zlib.decompressobj(31) if self.squeezed else None

    def more(self) -> bytes:
        while True:
            if self.inflate is not None and self.inflate.eof:  # the next member
                rest = self.inflate.unused_data
                self.at -= len(rest)
                self.inflate = zlib.decompressobj(31)
            elif self.inflate is not None and self.inflate.unconsumed_tail:
                return self.inflate.decompress(self.inflate.unconsumed_tail, CHUNK)
            if self.at >= len(self.content):
                return b""
            piece = self.content[self.at : self.at + CHUNK]
            self.at += len(piece)
            if self.inflate is None:
                return piece
            if out := self.inflate.decompress(piece, CHUNK):
                return out

    def until(self, mark: bytes) -> bytes | None:
        """Up to the mark, which is passed over; None at the end."""
        while (k := self.held.find(mark)) < 0:
            if not (piece := self.more()):
                return None
            self.held += piece
        out, self.held = self.held[:k], self.held[k + len(mark) :]
        return out

    def take(self, n: int):
        """The next n bytes, in pieces."""
        while n > 0:
            if not self.held and not (piece := self.more()):
                raise EOFError("the archive ends within a record")
            elif not self.held:
                self.held = piece
            out, self.held = self.held[:n], self.held[n:]
            n -= len(out)
            yield out


def parse(content: bytes, payloads: bool = False):
    """Records of an archive: header names (lower case) to values, with payload_bytes, payload_digest and, if asked
    for, payload and raw (the record as it is, without its end)."""
    stream = Stream(content)
    while (head := stream.until(END.encode())) is not None:
        top = head.lstrip(b"\r\n")
        head = top.decode("utf-8", "replace")
        if not head.startswith("WARC/"):
            raise ValueError("not a WARC record: " + head[:60])
        record = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.split("\r\n")[1:])}
        digest, n, block, body, kept, whole = hashlib.sha1(), 0, b"", record.get("content-type", "")[:16] != "application/http", [], []
        for piece in stream.take(int(record["content-length"])):
            if payloads:
                whole.append(piece)
            if not body:
                block += piece
                k = block.find(END.encode())
                if k < 0:
                    continue
                piece, body = block[k + 4 :], True
            digest.update(piece)
            n += len(piece)
            if payloads:
                kept.append(piece)
        record |= {"payload_bytes": n, "payload_digest": digest.hexdigest(), "payload": b"".join(kept), "raw": top + END.encode() + b"".join(whole) if payloads else b""}
        yield record
        for _ in stream.take(4):  # the record end
            pass


@lean
def _read(payloads: bool, batches):
    for batch in batches:
        for content in batch.column(0):
            rows: list = []
            for r in parse(content.as_py(), payloads):
                key = r.get("x-order-key")
                row = [r["warc-record-id"].strip("<>"), r["warc-type"], r.get("warc-target-uri"), int(key) if key else None, (r.get("warc-refers-to") or "").strip("<>") or None, r.get("warc-payload-digest"), r["payload_bytes"], r["payload_digest"]]
                if payloads:  # of records that are written anew the payload, of others all
                    row += [r["payload"], None if r["warc-type"] == "response" else r["raw"]]
                rows.append(row)
                if len(rows) == (64 if payloads else 4096):
                    yield _batch(rows, payloads)
                    rows = []
            yield _batch(rows, payloads)


def _batch(rows: list, payloads: bool) -> pa.RecordBatch:
    kinds = [pa.string()] * 3 + [pa.int64()] + [pa.string()] * 2 + [pa.int64(), pa.string()] + [pa.binary()] * 2 * payloads
    names = [x.split()[0] for x in RECORD.split(", ")] + ["payload", "raw"] * payloads
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """A row a record; payload_bytes and payload_digest are of the bytes found in it."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(partial(_read, payloads), RECORD + ", payload binary, raw binary" * payloads)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records`` as read, with refers_to (the original's key); a revisit gets the original's length and digest."""
    found = records.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to_id")).agg(
        F.max_by(F.struct(F.col("key").alias("refers_to"), F.col("payload_bytes").alias("n"), F.col("payload_digest").alias("d")), "payload_bytes").alias("o"))
    # Responses join by their own id, so they don't gather where NULL keys go.
    joined = records.withColumn("refers_to_id", F.coalesce("refers_to_id", "record_id")).join(found, "refers_to_id", "left")
    own = F.col("record_type") == "response"
    return joined.select("key", "record_id", "record_type", "target_uri",
                         F.when(own, F.col("payload_bytes")).otherwise(F.col("o.n")).alias("payload_bytes"),
                         F.when(own, F.col("payload_digest")).otherwise(F.coalesce("o.d", F.regexp_replace("header_digest", "^sha1:", ""))).alias("payload_digest"),
                         F.when(~own, F.col("o.refers_to")).alias("refers_to"))


def deduplicate_archives(spark: SparkSession, source: str, target: str, least: int = LEAST) -> None:
    """Rewrites archives: equal payloads are stored once, revisits get fresh headers. Revisits of the source whose
    original is there are resolved to it first, and so decided anew like any other record. Revisits whose original is
    elsewhere and records of other types are written as they are. Records without order key, as other writers'
    are, come before those with one, by a hash of their id."""
    records = stored(read_archives(spark, source, payloads=True), "records")
    bodies = records.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to_id")).agg(F.max("payload").alias("body"))
    # Records without a reference join by their own id, so they don't gather where NULL keys go.
    named = records.withColumn("refers_to_id", F.when(F.col("record_type") == "revisit", F.coalesce("refers_to_id", "record_id")).otherwise(F.col("record_id")))
    whole = named.join(bodies, "refers_to_id", "left")
    anew = (F.col("record_type") == "response") | (F.col("record_type") == "revisit") & F.col("body").isNotNull()
    order = F.coalesce("key", -1 - F.xxhash64("__id").bitwiseAND(F.lit((1 << 63) - 1)))
    chosen = choose(whole.where(anew).select("key", F.col("record_id").alias("__id"), F.col("target_uri").alias("uri"), F.coalesce("body", "payload").alias("payload")), least, order)
    write_records(rendered(chosen).union(whole.where(~anew).select(F.col("raw").cast("string").alias("value"))), target)
