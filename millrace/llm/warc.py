"""WARC archives with revisit records.

1. Every page is written where it lies, as a gzip member of a segment file; its header (payload digest, place, target) becomes a row.
2. Headers alone are shuffled by payload digest: the record with the largest page_id (then segment and offset) of a digest is the response,
   the others revisit it. Payloads shorter than `least` bytes are all responses.
3. Decisions go to their segments; each segment is rewritten as an archive: a warcinfo record, then records with fresh headers (record id, date of
   the rewriting, block and payload digests), revisits without their payload and with the id, target and date of what they refer to.
4. Archives are read back; revisits take the full payload's length and digest from the response they are joined to.

Payloads are never shuffled. Null html is an empty payload, a null url an empty target. Repeated and null page_ids are records of their own. An
archive that is written again holds the same bytes. Extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_dir, read, read_file, settle, table, write_file

SEGMENT_BYTES = 4 << 20  # of payload, or one page more
SPACE = uuid.UUID("9a1c7f0e-52b3-4b0e-9d7a-3f5c6b1e2d40")
INFO = b"software: warc-rewriter\r\nformat: WARC File Format 1.1\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(*parts) -> str:
    """The same for the same parts, so that a task that runs again writes the same ids."""
    return f"<urn:uuid:{uuid.uuid5(SPACE, ':'.join(map(str, parts)))}>"


def now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def record(kind: str, fields: dict[str, str], block: bytes) -> bytes:
    """One WARC/1.1 record as a gzip member."""
    content = "application/warc-fields" if kind == "warcinfo" else "application/http;msgtype=response"
    head = {"WARC-Type": kind, **fields, "WARC-Block-Digest": f"sha1:{digest_of(block)}", "Content-Type": content, "Content-Length": str(len(block))}
    raw = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(raw) + pack.flush()


def parse(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, header fields, block) of each gzip member."""
    at, view = 0, memoryview(data)
    while at < len(data):
        unpack, parts, end = zlib.decompressobj(31), [], at
        while not unpack.eof:
            if end >= len(data):
                raise ValueError("the archive ends within a record")
            parts.append(unpack.decompress(view[end : end + 8192]))
            end = min(end + 8192, len(data))
        size = end - len(unpack.unused_data) - at
        raw = b"".join(parts)
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        yield at, size, fields, rest[: int(fields["Content-Length"])]
        at += size


def payload_of(block: bytes) -> bytes:
    return block.partition(b"\r\n\r\n")[2]


HEADERS = "page_id long, digest string, payload_bytes long, target string, segment string, offset long"


def write_segments(pages: DataFrame, out_dir: str, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """Every page as a full record; returns a header row for each."""
    schema = pa.schema([("page_id", pa.int64()), ("digest", pa.string()), ("payload_bytes", pa.int64()), ("target", pa.string()), ("segment", pa.string()), ("offset", pa.int64())])
    date = now()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, seq, held, at, raw = TaskContext.get().partitionId(), 0, [], 0, 0
        rows: list[dict] = []
        for batch in batches:
            for key, html, url in zip(batch.column(0), batch.column(1).cast(pa.binary()), batch.column(2)):
                payload, segment = html.as_py() or b"", f"{place:08d}-{seq:08d}"
                digest = digest_of(payload)
                url = " ".join((url.as_py() or "").split())
                member = record("response", {"WARC-Record-ID": record_id("segment", segment, at), "X-Page-Id": str(key.as_py()), "WARC-Date": date, "WARC-Target-URI": url, "WARC-Payload-Digest": f"sha1:{digest}"}, HTTP + payload)
                rows.append({"page_id": key.as_py(), "digest": digest, "payload_bytes": len(payload), "target": url, "segment": segment, "offset": at})
                held.append(member)
                at += len(member)
                raw += len(payload)
                if raw >= SEGMENT_BYTES:
                    write_file(f"{out_dir}/{segment}.warc.gz", b"".join(held))
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    held, rows, at, raw, seq = [], [], 0, 0, seq + 1
        if held:
            write_file(f"{out_dir}/{place:08d}-{seq:08d}.warc.gz", b"".join(held))
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    cols = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).cast("string").alias("html"), F.col(url_col).cast("string").alias("url"))
    return settle(cols.mapInArrow(run, HEADERS), "headers")


def resolve(headers: DataFrame, least: int = 0) -> DataFrame:
    """segment, offset, and of revisits the response's place and target (else null)."""
    place = F.struct("page_id", "segment", "offset", "target")
    first = headers.filter(F.col("payload_bytes") >= least).groupBy("digest").agg(F.max(place).alias("r"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "r")
    own = F.col("r").isNull() | ((F.col("segment") == F.col("r.segment")) & (F.col("offset") == F.col("r.offset")))
    refers = F.when(~own, F.col("r"))
    return headers.join(first, "digest", "left").select("segment", "offset", refers["segment"].alias("to_segment"), refers["offset"].alias("to_offset"), refers["target"].alias("to_target"))


def rewrite(decisions: DataFrame, segment_dir: str, out_dir: str) -> DataFrame:
    """Deduplicated archives, one for each segment; returns their manifest: file, n_records."""
    schema = pa.schema([("file", pa.string()), ("n_records", pa.int64())])
    date = now()

    def archive(segment: str, to: dict[int, tuple]) -> pa.RecordBatch:
        out = [record("warcinfo", {"WARC-Record-ID": record_id("archive", segment), "WARC-Date": date, "WARC-Filename": f"{segment}.warc.gz"}, INFO)]
        for at, _, f, block in parse(read_file(f"{segment_dir}/{segment}.warc.gz")):
            there, place, target = to[at]
            fresh = {"WARC-Record-ID": record_id("record", segment, at), "X-Page-Id": f["X-Page-Id"], "WARC-Date": date, "WARC-Target-URI": f["WARC-Target-URI"], "WARC-Warcinfo-ID": record_id("archive", segment), "WARC-Payload-Digest": f"sha1:{digest_of(payload_of(block))}"}
            if there is None:
                out.append(record("response", fresh, block))
            else:
                refers = {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id("record", there, place), "WARC-Refers-To-Target-URI": target, "WARC-Refers-To-Date": date}
                out.append(record("revisit", fresh | refers, HTTP))
        write_file(f"{out_dir}/{segment}.warc.gz", b"".join(out))
        return table(schema, file=[f"{out_dir}/{segment}.warc.gz"], n_records=[len(out) - 1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now_, to = None, {}
        for batch in batches:
            for segment, at, *target in zip(*(c.to_pylist() for c in batch.columns)):
                if segment != now_:
                    if now_ is not None:
                        yield archive(now_, to)
                    now_, to = segment, {}
                to[at] = tuple(target)
        if now_ is not None:
            yield archive(now_, to)

    parts = max(int(decisions.sparkSession.conf.get("spark.sql.shuffle.partitions")), decisions.sparkSession.sparkContext.defaultParallelism)
    dealt = decisions.select("segment", "offset", "to_segment", "to_offset", "to_target").repartition(parts, "segment").sortWithinPartitions("segment", "offset")
    return settle(dealt.mapInArrow(run, "file string, n_records long"), "archives")


RECORDS = "page_id long, record_id string, record_type string, refers_to_id string, payload_bytes long, payload_digest string"


def read_archives(files: DataFrame) -> DataFrame:
    """A row per page; refers_to, payload_bytes and payload_digest of revisits are those of the response they refer to."""
    names = ("page_id", "record_id", "record_type", "refers_to_id", "payload_bytes", "payload_digest")
    schema = pa.schema([(n, pa.int64() if n in ("page_id", "payload_bytes") else pa.string()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                for _, _, f, block in parse(read_file(name)):
                    if f["WARC-Block-Digest"] != f"sha1:{digest_of(block)}":
                        raise ValueError("a block is not what its digest says")
                    if f["WARC-Type"] == "warcinfo":
                        continue
                    row = {"page_id": None if f["X-Page-Id"] == "None" else int(f["X-Page-Id"]), "record_id": f["WARC-Record-ID"], "record_type": f["WARC-Type"]}
                    if row["record_type"] == "response":
                        payload = payload_of(block)
                        row |= {"payload_bytes": len(payload), "payload_digest": digest_of(payload)}
                    else:
                        row |= {"refers_to_id": f["WARC-Refers-To"], "payload_digest": f["WARC-Payload-Digest"].removeprefix("sha1:")}
                    rows.append(row)
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    parts = max(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), files.sparkSession.sparkContext.defaultParallelism)
    records = settle(files.select("file").repartition(parts, "file").mapInArrow(run, RECORDS), "records")
    responses = records.filter("record_type = 'response'").drop("refers_to_id")
    originals = responses.select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("full"), F.col("payload_digest").alias("digest"))
    revisits = records.filter("record_type = 'revisit'").join(originals, "refers_to_id").select("page_id", "record_id", "record_type", "refers_to", F.col("full").alias("payload_bytes"), F.col("digest").alias("payload_digest"))
    return responses.withColumn("refers_to", F.lit(None).cast("long")).unionByName(revisits)


def op8_warc_revisits(spark, sf_dir) -> DataFrame:
    """Contract query: every page archived, resolved, rewritten and read back."""
    segments, archives = fresh_dir(spark, "segments"), fresh_dir(spark, "archives")
    headers = write_segments(read(spark, sf_dir, "pages"), segments)
    files = rewrite(resolve(headers), segments, archives)
    return read_archives(files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


