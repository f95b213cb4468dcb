"""WARC archives: write with segmentation and chunked framing, read back, reassemble."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.llm.common import bitmap, flagged, read, stored
from conform.session import scratch_dir

CRLF = b"\r\n"
_RECORD = (
    "record_id string, record_type string, uri string, digest string, refers_to string, "
    "origin string, segment int, total long, block binary"
)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _cut(data: bytes, size: int) -> list[bytes]:
    """Pieces of about ``size`` bytes that split no UTF-8 character; one empty piece of nothing."""
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + size)
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        out.append(data[at:end])
        at = end
    return out or [b""]


def _record(fields: dict[str, object], block: bytes) -> bytes:
    head = [b"WARC/1.1", *[f"{k}: {v}".encode() for k, v in fields.items() if v is not None]]
    return CRLF.join([*head, f"Content-Length: {len(block)}".encode(), b"", block])


def _http(payload: bytes, chunk: int) -> bytes:
    """An HTTP response whose body travels in chunks."""
    framed = b"".join(f"{len(c):x}".encode() + CRLF + c + CRLF for c in _cut(payload, chunk) if c)
    head = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Transfer-Encoding: chunked", b"", b""]
    return CRLF.join(head) + framed + b"0" + CRLF + CRLF


def unframe(http: bytes) -> bytes:
    """The payload of an HTTP response, chunked transfer framing undone."""
    head, _, body = http.partition(CRLF + CRLF)
    if b"transfer-encoding: chunked" not in head.lower():
        return body
    out, at = [], 0
    while True:
        line = body.index(CRLF, at)
        size = int(body[at:line].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        out.append(body[line + 2 : line + 2 + size])
        at = line + 2 + size + 2


def parse(archive: bytes) -> Iterator[dict[str, object]]:
    """Records of one archive file, by their content lengths."""
    at = 0
    while at < len(archive):
        end = archive.index(CRLF + CRLF, at)
        lines = archive[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}: {lines[0][:40]!r}")
        fields = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines[1:])}
        start, size = end + 4, int(fields["content-length"])
        block = archive[start : start + size]
        at = start + size + 4
        if len(block) < size or archive[start + size : at] != CRLF + CRLF:
            raise ValueError(f"record {fields.get('warc-record-id')} is cut short")
        number = fields.get("warc-segment-number")
        total = fields.get("warc-segment-total-length")
        yield {
            "record_id": fields["warc-record-id"],
            "record_type": fields["warc-type"],
            "uri": fields.get("warc-target-uri"),
            "digest": fields.get("warc-payload-digest"),
            "refers_to": fields.get("warc-refers-to"),
            "origin": fields.get("warc-segment-origin-id"),
            "segment": int(number) if number else None,
            "total": int(total) if total else None,
            "block": block,
        }


def write_warc(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    body_col: str = "html",
    least: int = 0,
    segment_size: int = 16_384,
    chunk_size: int = 4_096,
) -> None:
    """Write a record per page to WARC files under ``path``.

    The payload is the page in UTF-8 (null: empty), wrapped in an HTTP response with chunked
    framing. Of pages with equal payloads of at least ``least`` bytes, the one with the smallest id is the
    response and the others are revisits that refer to it and carry no payload; which rows share a
    payload is decided on digests only. A response over ``segment_size`` bytes is cut into a first
    segment and continuation records. Rows that repeat an id and a payload give one response and revisits of it;
    a null id sorts last. Other columns are ignored; no rows give no records.
    """
    body = F.coalesce(F.col(body_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), body.alias("body")
    ).withColumn("sha", F.sha1("body"))
    keyed = rows.where(F.octet_length("body") >= least).select("sha", "id")
    shared = stored(
        keyed.groupBy("sha").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id"))["id"].alias("first_id"), F.count("*").alias("n"))
        .where("n > 1").select("sha", "first_id", F.xxhash64("sha").alias("key")),
        "warc-shared",
    )

    def name(page: object, ordinal: int, sha: str) -> str:
        return f"<urn:page:{'' if page is None else page}:{ordinal}:{sha}>"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes] = []
            for r in batch.to_pylist():
                fields = {
                    "WARC-Type": "response",
                    "WARC-Record-ID": name(r["id"], r["ordinal"], r["sha"]),
                    "WARC-Target-URI": None if r["url"] is None else "".join(r["url"].split()),
                }
                if r["ordinal"]:
                    out.append(_record(fields | {
                        "WARC-Type": "revisit",
                        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(r["sha"])).decode(),
                        "WARC-Refers-To": name(r["first_id"], 0, r["sha"]),
                    }, b""))
                    continue
                body = r["body"] or b""
                fields["WARC-Payload-Digest"] = "sha1:" + digest(body)
                block = _http(body, chunk_size)
                parts = _cut(block, segment_size)
                if len(parts) == 1:
                    out.append(_record(fields, block))
                    continue
                out.append(_record(fields | {"WARC-Segment-Number": 1}, parts[0]))
                for i, part in enumerate(parts[1:], 2):
                    out.append(_record({
                        "WARC-Type": "continuation",
                        "WARC-Record-ID": f"{fields['WARC-Record-ID'][:-1]}:{i}>",
                        "WARC-Segment-Origin-ID": fields["WARC-Record-ID"],
                        "WARC-Segment-Number": i,
                        "WARC-Segment-Total-Length": len(block) if i == len(parts) else None,
                    }, part))
            yield pa.RecordBatch.from_arrays([pa.array([x.decode() for x in out], pa.string())], ["value"])

    # Most payloads are surely not shared: a bitmap of fixed size says so, and their bodies are not shuffled.
    maybe = flagged(bitmap(shared, "key"), "key")
    hashed = rows.withColumn("key", F.xxhash64("sha"))
    own, unsure = hashed.where(~maybe), hashed.where(maybe)
    judged = unsure.join(shared.select("sha", "first_id", F.lit(True).alias("shared")), "sha", "left")
    heads = judged.where("shared and id <=> first_id and body is not null").dropDuplicates(["id", "sha"])
    responses = own.select("id", "url", "body", "sha").unionByName(
        judged.where("shared is null").select("id", "url", "body", "sha")
    ).unionByName(heads.select("id", "url", "body", "sha")).select("*", F.lit(0).alias("ordinal"), F.lit(None).cast("long").alias("first_id"))
    repeats = (
        rows.select("id", "url", "sha").join(shared, "sha")
        .groupBy("id", "sha").agg(F.first("first_id").alias("first_id"), F.sort_array(F.collect_list(F.struct("url"))).alias("urls"))
        .select("id", "sha", "first_id", F.posexplode("urls").alias("ordinal", "u"))
        .select("id", F.col("u.url").alias("url"), F.lit(None).cast("binary").alias("body"), "sha", (F.col("ordinal") + F.when(F.expr("id <=> first_id"), 0).otherwise(1)).alias("ordinal"), "first_id")
    )
    revisits = repeats.where("ordinal > 0")
    for frame in (responses, revisits):
        frame.mapInArrow(encode, "value string").write.mode("append").option("lineSep", "\r\n\r\n").option(
            "compression", "gzip"
        ).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives under ``path``; a file is one task's unit, as gzip cannot be split."""
    import gzip

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("record_id", pa.string()), ("record_type", pa.string()), ("uri", pa.string()), ("digest", pa.string()),
            ("refers_to", pa.string()), ("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()),
            ("block", pa.binary()),
        ])
        for batch in batches:
            for content in batch.column(0):
                rows: list[dict[str, object]] = []
                for record in parse(gzip.decompress(content.as_py())):
                    rows.append(record)
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(decode, _RECORD)


def reassemble(records: DataFrame) -> DataFrame:
    """Full payloads of the response records, and what the revisits refer to.

    Continuation records are grouped by their origin's id (one page a group), put in order by segment number, checked for
    gaps and against the total length that the last one states, and the chunked framing of the joined block is undone. Records
    without segments skip the grouping. A broken segment list fails the job. A revisit takes length and digest
    from the record that it refers to. Returns record_id, record_type, payload, payload_bytes,
    payload_digest and refers_to.
    """
    whole = records.where("segment is null and record_type = 'response'").select("record_id", "digest", "block")
    pieces = records.where("segment is not null").select(
        F.coalesce("origin", "record_id").alias("record_id"),
        F.struct("segment", "digest", "total", "block").alias("piece"),
    )
    ordered = pieces.groupBy("record_id").agg(F.array_sort(F.collect_list("piece")).alias("p")).select(
        "record_id",
        F.element_at("p.digest", 1).alias("digest"),
        F.expr("aggregate(p, X'', (a, x) -> concat(a, x.block))").alias("block"),
        F.element_at("p.total", -1).alias("total"),
        (F.element_at("p.segment", -1) == F.size("p")).alias("gapless"),
    )
    sound = F.col("gapless") & (F.octet_length("block") == F.col("total"))
    joined = ordered.withColumn(
        "block", F.when(sound, F.col("block")).otherwise(F.raise_error(F.concat(F.lit("broken segments of "), "record_id")))
    ).select("record_id", "digest", "block")

    def undo(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, stated, blocks = (c.to_pylist() for c in batch.columns)
            payloads = [unframe(b) for b in blocks]
            digests = [digest(p) for p in payloads]
            for i, found, want in zip(ids, digests, stated, strict=True):
                if want != f"sha1:{found}":
                    raise ValueError(f"payload of {i} does not match its digest")
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(payloads, pa.binary()), pa.array(digests)], ["record_id", "payload", "payload_digest"])

    full = whole.unionByName(joined).mapInArrow(undo, "record_id string, payload binary, payload_digest string")
    return full.select(
        "record_id", F.lit("response").alias("record_type"), "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest",
        F.lit(None).cast("string").alias("refers_to"),
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    write_warc(read(spark, sf_dir, "pages"), path)
    records = read_warc(spark, path)
    keep = ["record_id", "record_type", "payload_bytes", "payload_digest", "refers_to"]
    responses = stored(reassemble(records).select(keep), "warc-read")
    target = responses.select(
        F.col("record_id").alias("refers_to"), F.col("payload_bytes").alias("n"), F.col("payload_digest").alias("d")
    )
    revisits = records.where("record_type = 'revisit'").select("record_id", "record_type", "digest", "refers_to").join(target, "refers_to")
    agreed = F.when(F.col("digest") == F.concat(F.lit("sha1:"), "d"), F.col("d")).otherwise(F.raise_error(F.lit("a revisit does not match its response")))
    both = responses.unionByName(
        revisits.select("record_id", "record_type", F.col("n").alias("payload_bytes"), agreed.alias("payload_digest"), "refers_to")
    )
    page = lambda c: F.when(F.split(c, ":")[2] != "", F.split(c, ":")[2].cast("long"))
    return both.select(
        page(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page(F.col("refers_to")).alias("refers_to"),
    )


# DuckDB has SHA-1 in hexadecimal only: two hexadecimal digits a byte are turned into base 32 by five-bit groups.
SQL = """
with p as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as h from pages
), b as (
  select *, list_aggregate(list_transform(string_split(h, ''),
    lambda x: right(bin(strpos('0123456789abcdef', x) + 15), 4)), 'string_agg', '') as bits from p
), q as (
  select page_id, payload_bytes, list_aggregate(list_transform(range(0, 32),
    lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(
      16 * cast(substr(bits, i * 5 + 1, 1) as integer) + 8 * cast(substr(bits, i * 5 + 2, 1) as integer)
      + 4 * cast(substr(bits, i * 5 + 3, 1) as integer) + 2 * cast(substr(bits, i * 5 + 4, 1) as integer)
      + cast(substr(bits, i * 5 + 5, 1) as integer) + 1 as integer), 1)), 'string_agg', '') as payload_digest
  from b
), f as (select *, min(page_id) over (partition by payload_digest) as first_id from q)
select page_id, payload_bytes, payload_digest, case when page_id = first_id then 'response' else 'revisit' end as record_type,
       case when page_id <> first_id then first_id end as refers_to
from f
"""
