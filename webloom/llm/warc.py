"""WARC archives: writing with segmentation and chunked framing, reading with
reassembly.

Writing. One record per page: an HTTP response with the page in chunked
transfer framing. A block longer than ``segment_bytes`` is split: the first
segment keeps the record's type, the others are ``continuation`` records that
name it in WARC-Segment-Origin-ID and carry their WARC-Segment-Number; the
last one gives WARC-Segment-Total-Length. Of pages with equal payloads of at
least ``revisit_bytes`` the one with the largest page_id is a response, the
others are revisit records that refer to it. Files hold at most
``records_per_file`` records, so their size is bounded.

Reading. Files are parsed by their headers and Content-Length; whole records
go straight on, segments are grouped by origin, ordered by number, their
total length verified, then the block is unchunked. Revisits take payload
facts from the response they refer to.

Rows: one record per page row. Null html is an empty payload; null page_id and
url are kept as null (the header is absent). Repeated (page_id, payload) rows
give one record each; if they are the group's largest they are all responses.
A record whose segments are missing, repeated with other contents or of the
wrong total length is reported with ``complete`` false, never dropped. Extra
columns of the pages are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm.common import require, small_enough, stored

HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"


def chunked(body: bytes, size: int) -> bytes:
    """Chunked transfer framing."""
    parts = []
    for at in range(0, len(body), size):
        part = body[at:at + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(data: bytes) -> bytes:
    """Inverse of ``chunked``; chunk extensions and trailers are skipped.
    Raises ValueError on broken framing."""
    parts, at = [], 0
    while True:
        end = data.index(b"\r\n", at)
        size = int(data[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(parts)
        if data[at + size:at + size + 2] != b"\r\n":
            raise ValueError("broken chunk")
        parts.append(data[at:at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def _record(kind: str, rid: str, block: bytes, extra: list[tuple[str, str]]) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", rid), ("WARC-Date", DATE), *extra,
            ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block


def records_of(page_id, url, html, refers_to, segment_bytes: int, chunk_bytes: int) -> list[bytes]:
    """The WARC records of a page: one, or the segments of one."""
    payload = (html or "").encode()
    sha1 = hashlib.sha1(payload)
    rid = f"<urn:page:{page_id}:{sha1.hexdigest()}>"
    extra = [("WARC-Payload-Digest", "sha1:" + base64.b32encode(sha1.digest()).decode())]
    if page_id is not None:
        extra.append(("WARC-Page-ID", str(page_id)))
    if url is not None:
        extra.append(("WARC-Target-URI", quote(url, safe="!#$&'()*+,/:;=?@[]~")))
    if refers_to is not None:
        extra += [("WARC-Refers-To", f"<urn:page:{refers_to}:{sha1.hexdigest()}>"),
                  ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
        return [_record("revisit", rid, b"HTTP/1.1 200 OK\r\n\r\n", extra)]
    block = HTTP_HEAD + chunked(payload, chunk_bytes)
    if len(block) <= segment_bytes:
        return [_record("response", rid, block, extra)]
    out = []
    for n, at in enumerate(range(0, len(block), segment_bytes), 1):
        last = [("WARC-Segment-Total-Length", str(len(block)))] * (at + segment_bytes >= len(block))
        part = block[at:at + segment_bytes]
        if n == 1:
            out.append(_record("response", rid, part, [*extra, ("WARC-Segment-Number", "1")]))
        else:
            out.append(_record("continuation", f"{rid[:-1]}:{n}>", part, [
                ("WARC-Segment-Origin-ID", rid), ("WARC-Segment-Number", str(n)), *last]))
    return out


def write_warc(pages: DataFrame, path: str, segment_bytes: int = 16384, chunk_bytes: int = 4096,
               revisit_bytes: int = 1000, records_per_file: int = 1024) -> None:
    """Write the pages as WARC files under ``path`` with Spark's writer."""
    require(pages, "page_id", "url", "html")
    rows = pages.select(F.col("page_id").cast("bigint"), "url", "html",
                        F.sha1(F.coalesce("html", F.lit(""))).alias("digest"))
    repeated = (rows.where(F.octet_length("html") >= revisit_bytes).groupBy("digest")
                .agg(F.max("page_id").alias("keep"), F.min("page_id").alias("least"), F.count("page_id").alias("ids"),
                     F.count("*").alias("n"))
                .where("keep is not null and (least < keep or ids < n)").select("digest", "keep"))
    # Few payloads repeat; where their digests are few enough, the pages are not shuffled.
    rows = rows.join(small_enough(stored(repeated, "repeated-payloads")), "digest", "left").select(
        "page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("keep")), F.col("keep")).alias("refers_to"))

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                out += records_of(row["page_id"], row["url"], row["html"], row["refers_to"], segment_bytes, chunk_bytes)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    # A record is followed by two line ends, which is what the text writer puts after each row.
    (rows.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", records_per_file).text(path))


def parse_file(data: bytes):
    """(headers, block) of every record of an archive file."""
    at = 0
    while True:
        at = data.find(b"WARC/1.", at)
        if at < 0:
            return
        end = data.index(b"\r\n\r\n", at)
        head = {}
        for line in data[at:end].split(b"\r\n")[1:]:
            k, _, v = line.partition(b":")
            head[k.strip().lower().decode()] = v.strip().decode()
        at = end + 4 + int(head["content-length"])
        yield head, data[end + 4:at]


SCHEMA = ("record_type string, record_id string, origin_id string, segment int, total_length bigint, "
          "page_id bigint, url string, payload_digest string, refers_to string, block binary")


def _fields(head: dict, block: bytes) -> dict:
    digest = head.get("warc-payload-digest")
    page, refers = head.get("warc-page-id"), head.get("warc-refers-to")
    number, total = head.get("warc-segment-number"), head.get("warc-segment-total-length")
    return {
        "record_type": head["warc-type"], "record_id": head["warc-record-id"],
        "origin_id": head.get("warc-segment-origin-id") or (head["warc-record-id"] if number else None),
        "segment": int(number) if number else None, "total_length": int(total) if total else None,
        "page_id": int(page) if page else None,
        "url": unquote(head["warc-target-uri"]) if "warc-target-uri" in head else None,
        "payload_digest": base64.b32decode(digest[5:]).hex() if digest else None,
        "refers_to": refers, "block": block}


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives, segments not yet joined."""
    import pyspark.sql.types as T
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(T.StructType.fromDDL(SCHEMA))

    def run(batches):
        for batch in batches:
            for data in batch.column(0):
                held, size = [], 0
                for head, block in parse_file(data.as_py()):
                    held.append(_fields(head, block))
                    size += len(block)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema=arrow)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=arrow)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, SCHEMA)


def reassemble(records: DataFrame) -> DataFrame:
    """Whole records: (record_type, record_id, page_id, url, payload_digest,
    refers_to, block, complete). Continuations are grouped by origin; a first
    segment without its others, or others without a first, stay incomplete."""
    whole = records.where("segment is null").select(
        "record_type", "record_id", "page_id", "url", "payload_digest", "refers_to", "block",
        F.lit(True).alias("complete"))
    parts = records.where("segment is not null")
    first = F.col("segment") == 1
    # Equal copies of a segment (a record written twice) count once in the block.
    pieces = (parts.groupBy("origin_id", "segment", "block")
              .agg(F.max("total_length").alias("total_length"), F.sum(first.cast("int")).alias("copies"),
                   *[F.first(c, ignorenulls=True).alias(c) for c in
                     ("record_type", "page_id", "url", "payload_digest", "refers_to")]))
    joined = pieces.groupBy("origin_id").agg(
        F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("segments"),
        F.max("total_length").alias("total_length"), F.max(F.when(first, F.col("copies"))).alias("copies"),
        *[F.max(F.when(first, F.col(c))).alias(c) for c in
          ("record_type", "page_id", "url", "payload_digest", "refers_to")])
    numbers = F.transform("segments", lambda s: s["segment"])
    block = F.aggregate("segments", F.lit(b""), lambda a, s: F.concat(a, s["block"]))
    joined = (joined.withColumn("block", block)
              .withColumn("complete", F.coalesce(
                  (F.octet_length("block") == F.col("total_length"))
                  & (numbers == F.sequence(F.lit(1), F.size("segments"))), F.lit(False)))
              .withColumn("copy", F.explode(F.sequence(F.lit(1), F.coalesce("copies", F.lit(1)).cast("int")))))
    return whole.unionByName(joined.select(
        F.coalesce("record_type", F.lit("continuation")).alias("record_type"), F.col("origin_id").alias("record_id"),
        "page_id", "url", "payload_digest", "refers_to", "block", "complete"))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Pages read back: (record_type, record_id, page_id, url, payload_digest,
    refers_to_record, payload, complete). The digest is recomputed from the
    payload of complete responses; ``complete`` also says it matched."""
    records = reassemble(read_records(spark, path))
    kind = "payload binary, sha1 string"
    names = records.columns

    def run(batches):
        at = {n: i for i, n in enumerate(names)}
        for batch in batches:
            payload, sha1 = [], []
            for block, kind_, ok in zip(batch.column(at["block"]).to_pylist(), batch.column(at["record_type"]).to_pylist(),
                                        batch.column(at["complete"]).to_pylist(), strict=True):
                body = None
                if ok and kind_ == "response":
                    try:
                        body = http_payload(block)
                    except ValueError:
                        pass
                payload.append(body)
                sha1.append(None if body is None else hashlib.sha1(body).hexdigest())
            kept = [batch.column(at[n]) for n in names if n != "block"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(payload, pa.binary()), pa.array(sha1, pa.string())],
                                             names=[*[n for n in names if n != "block"], "payload", "sha1"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in records.schema if f.name != "block")
    out = records.mapInArrow(run, f"{fields}, {kind}")
    ok = F.when(F.col("record_type") == "response", F.col("sha1").eqNullSafe(F.col("payload_digest"))).otherwise(F.col("complete"))
    return out.withColumn("complete", ok).withColumnRenamed("refers_to", "refers_to_record").drop("sha1")


def page_records(warc: DataFrame) -> DataFrame:
    """Per page: (page_id, payload_bytes, payload_digest, record_type,
    refers_to, complete). A revisit's size is that of the response it names,
    found by a join of ids and sizes; a dangling reference is incomplete."""
    facts = warc.select("page_id", "record_type", "record_id", "refers_to_record", "payload_digest", "complete",
                        F.octet_length("payload").cast("bigint").alias("payload_bytes"))
    named = warc.where("record_type = 'revisit'").select(F.col("refers_to_record").alias("target")).distinct()
    target = (facts.where("record_type = 'response'").join(named, F.col("record_id") == F.col("target"), "left_semi")
              .groupBy(F.col("record_id").alias("target"))
              .agg(F.max("page_id").alias("target_page"), F.max("payload_bytes").alias("target_bytes")))
    joined = facts.join(target, F.col("refers_to_record") == F.col("target"), "left")
    return joined.select(
        "page_id", F.coalesce("payload_bytes", "target_bytes").alias("payload_bytes"), "payload_digest", "record_type",
        F.col("target_page").alias("refers_to"),
        (F.col("complete") & (F.col("refers_to_record").isNull() | F.col("target").isNotNull())).alias("complete"))
