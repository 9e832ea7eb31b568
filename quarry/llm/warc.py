"""WARC archives: writer with revisit records and sequential reader.

The writer gives each record a gzip member of its own.  Archives lie on shared
storage; the manifest of a written Parquet table names those of successful
task attempts, and only those are read.  The reader inflates member by member
in small steps, frames the block by Content-Length and checks the digests.

Of records with equal payloads of ``MIN_REVISIT`` bytes or more, the one with
the smallest page_id is a response and the others revisit it; the digest's
smallest id comes from a partial aggregation, written as a table, and a join
that adaptive execution splits where one payload is very frequent, or a
broadcast where few payloads repeat.

Edge cases: NULL html is an empty payload; rows of equal id and payload are
all the response (or revisits) of that id; a NULL page_id never is the
referred one unless all are NULL (then all are responses); a NULL URL has no
target header; control characters of a URL are percent-encoded; an empty
table gives no archives and no rows.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.shared import filesystem, materialise, work_folder

MIN_REVISIT = 100
ARCHIVE_BYTES = 64 << 20
STEP = 1 << 16


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit's block is the HTTP head alone, with the full payload's length."""
    revisit = refers_to is not None
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if not revisit:
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", "WARC-Date: 2024-01-01T00:00:00Z",
            f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return ("\r\n".join(head) + "\r\n\r\n").encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def members(stream) -> Iterator[bytes]:
    """Each gzip member of a stream, inflated in steps."""
    raw, left = stream.read(STEP), b""
    while raw:
        unpack, parts = zlib.decompressobj(31), []
        while not unpack.eof:
            if not raw:
                raise ValueError("archive ends within a gzip member")
            parts.append(unpack.decompress(raw))
            left = unpack.unused_data
            raw = left if unpack.eof else stream.read(STEP)
        raw = raw or stream.read(STEP)
        yield b"".join(parts)


def _page(value: str) -> int | None:
    number = value.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def parse(data: bytes) -> dict:
    """The record of a member; raises on wrong framing or a wrong digest."""
    at = data.find(b"\r\n\r\n")
    lines = data[:max(at, 0)].decode("utf-8", "surrogatepass").split("\r\n")
    if at < 0 or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    head = dict(line.split(": ", 1) for line in lines[1:])
    length = int(head["Content-Length"])
    block, end = data[at + 4:at + 4 + length], data[at + 4 + length:]
    if len(block) != length or end != b"\r\n\r\n":
        raise ValueError("block does not end at its Content-Length")
    if head["WARC-Block-Digest"] != "sha256:" + hashlib.sha256(block).hexdigest():
        raise ValueError("wrong block digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    full = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
    if head["WARC-Type"] == "response" and (len(payload) != full or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("wrong payload digest or length")
    refers = head.get("WARC-Refers-To")
    return {"page_id": _page(head["WARC-Record-ID"]), "url": head.get("WARC-Target-URI"),
            "payload_bytes": full, "payload_digest": digest, "record_type": head["WARC-Type"],
            "refers_to": _page(refers) if refers else None,
            "payload": payload if head["WARC-Type"] == "response" else None}


def _write(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        fs.create_dir(path, recursive=True)
        out, name, size = None, "", 0
        for batch in batches:
            for row in range(batch.num_rows):
                r = {c: batch[c][row].as_py() for c in batch.schema.names}
                if out is None:
                    name, size = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                payload = (r["html"] or "").encode("utf-8", "surrogatepass")
                size += out.write(member(record(r["page_id"], r["url"], payload, r["digest"], r["refers_to"]))) or 0
                if size >= archive_bytes:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_arrays([pa.array([name])], names=["name"])
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name])], names=["name"])

    return run


def write_archives(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> tuple[str, DataFrame]:
    """Write a record per row; (folder, manifest of archive names)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    digest = F.sha2(F.col("html").cast("binary"), 256)
    firsts = (rows.where(F.octet_length("html") >= MIN_REVISIT).groupBy(digest.alias("digest"))
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    firsts = materialise(firsts, "warc-firsts")  # of known size: where payloads seldom repeat, the pages are not shuffled
    folder = work_folder(pages.sparkSession, "warc")
    refers = F.when(F.col("page_id").eqNullSafe(F.col("first")), F.lit(None)).otherwise(F.col("first"))
    joined = rows.withColumn("digest", digest).join(firsts, "digest", "left").withColumn("refers_to", refers).drop("first")
    return folder, materialise(joined.mapInArrow(_write(folder, archive_bytes), "name string"), "warc-manifest")


FIELDS = (("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
          ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()))
SCHEMA = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long, payload binary")


def _read(folder: str, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        for batch in batches:
            for name in batch["name"].to_pylist():
                held, size = [], 0
                with fs.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for data in members(stream):
                        held.append(parse(data))
                        if not with_payload:
                            held[-1]["payload"] = None
                        size += len(data) if with_payload else 200
                        if size > 4 << 20:
                            yield _rows(held)
                            held, size = [], 0
                if held:
                    yield _rows(held)

    return run


def _rows(held: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in held], t) for c, t in FIELDS],
                                      names=[c for c, _ in FIELDS])


def read_archives(folder: str, manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record of the manifest's archives."""
    return manifest.select("name").mapInArrow(_read(folder, with_payload), SCHEMA)


def warc_round_trip(pages: DataFrame) -> DataFrame:
    folder, manifest = write_archives(pages)
    return read_archives(folder, manifest, with_payload=False).drop("url", "payload")


#: DuckDB SQL of the query over ``pages``.
ORACLE = """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""
