"""Dictionary-compressed WARC archives (.warc.zst), written and read back.

A Zstandard dictionary is built from a bounded sample of the records
(``sample_records``, ``sample_bytes`` of each: parameters), embedded in a
leading skippable frame of every archive, and each record is compressed as a
frame of its own.  Of records with equal payloads the one with the smallest
page_id is a response; the others are revisits that refer to it.

Tasks write archives of about ``archive_bytes`` under names of their own and
report them in a manifest that Spark commits; archives of failed or repeated
attempts are in no manifest and never read.  Archives are read back with
Spark's binary file source.

Defined results: null html is an empty payload; rows with the response's
page_id and payload (repeated rows) are responses too; null page_ids come last
in the choice of a response; null urls give no target header; an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabula.llm.common import hash_sample, maybe_broadcast, scratch_path, written

#: Fixed values of the .warc.zst format: magic number of the dictionary's skippable frame.
DICT_MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(url: str) -> str:
    """A url without characters that would end a header line."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def encode_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_uri(url)}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def decode_record(record: bytes) -> dict:
    """Headers and payload of a record; checks a response's length and digest."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("record's length differs from its Content-Length")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != length or payload_digest(payload) != digest):
        raise ValueError("a response's payload differs from its length or digest")

    def number(name: str) -> int | None:
        value = fields.get(name, "<urn:page:None>")[len("<urn:page:"):-1]
        return None if value == "None" else int(value)

    return {"type": fields["WARC-Type"], "page_id": number("WARC-Record-ID"), "refers_to": number("WARC-Refers-To"),
            "url": fields.get("WARC-Target-URI"), "bytes": length, "digest": digest, "payload": payload}


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICT_MAGIC, len(dictionary)) + dictionary


def read_archive(content: bytes) -> Iterator[bytes]:
    """The decompressed records of an archive."""
    magic, size = struct.unpack_from("<II", content)
    if magic != DICT_MAGIC:
        raise ValueError("no dictionary frame at the start")
    view = memoryview(content)[8 + size:]
    known = zstandard.ZstdCompressionDict(content[8:8 + size]) if size else None
    reader = zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()
    while len(view):
        frame = reader.decompressobj()
        data = frame.decompress(view)
        if not frame.eof:
            raise ValueError("an archive ends inside a frame")
        yield data
        view = view[len(view) - len(frame.unused_data):]


def train_dictionary(pages: DataFrame, size: int = 64 << 10, sample_records: int = 400, sample_bytes: int = 16 << 10) -> bytes:
    """Dictionary from the records of about ``sample_records`` distinct pages, chosen by hash; empty if too few."""
    rows = hash_sample(pages.select("page_id", "url", F.substring("html", 1, sample_bytes).alias("html")),
                       sample_records).collect()
    rows.sort(key=lambda r: tuple((v is None, v) for v in r))
    samples = [encode_record(r["page_id"], r["url"], (r["html"] or "").encode("utf-8", "replace"), None, False) for r in rows]
    if sum(map(len, samples)) < 20 * 1024 or len(samples) < 20:
        return b""
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, samples)) // 10), samples).as_bytes()
    except zstandard.ZstdError:      # samples too uniform to build one from
        return b""


def _writer(folder: str, dictionary: bytes, archive_bytes: int, level: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        press = zstandard.ZstdCompressor(level=level, dict_data=known, write_checksum=True)
        attempt = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        out, name, size, records, n = None, "", 0, 0, 0
        done: list[tuple[str, int, int]] = []
        for batch in batches:
            for page_id, url, html, refers_to, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name = f"pages-{attempt}-{n:05d}.warc.zst"
                    out, n, records = fs.open_output_stream(f"{base}/{name}", compression=None), n + 1, 0
                    head = dictionary_frame(dictionary) + press.compress(
                        f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>\r\n"
                        f"WARC-Date: {DATE}\r\nWARC-Filename: {name}\r\nContent-Type: application/warc-fields\r\nContent-Length: 0\r\n\r\n\r\n\r\n".encode())
                    out.write(head)
                    size = len(head)
                frame = press.compress(encode_record(page_id, url, (html or "").encode("utf-8", "replace"), refers_to, revisit))
                out.write(frame)
                size, records = size + len(frame), records + 1
                if size >= archive_bytes:
                    out.close()
                    done.append((name, records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((name, records, size))
        yield pa.RecordBatch.from_pydict({"name": [d[0] for d in done], "records": [d[1] for d in done], "bytes": [d[2] for d in done]},
                                         schema=pa.schema([("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))
    return write


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = 16 << 20, level: int = 3) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives in ``folder``; returns the written
    manifest (name, records, bytes)."""
    spark = pages.sparkSession
    pages = pages.select("page_id", "url", "html").withColumn("digest", F.sha1(F.coalesce("html", F.lit("")).cast("binary")))
    # only payloads that occur more than once need a lookup
    shared = pages.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first_id")).filter("n > 1")
    shared = written(shared.select(F.col("digest").alias("shared_digest"), "first_id"), "payloads")
    shared = maybe_broadcast(shared, shared.count(), 120)
    marked = pages.join(shared, F.col("digest") == F.col("shared_digest"), "left")
    revisit = F.col("shared_digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    rows = marked.select("page_id", "url", "html", F.when(revisit, F.col("first_id")).alias("refers_to"), revisit.alias("revisit"))
    dictionary = train_dictionary(pages)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(folder)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(jpath)
    manifest = rows.mapInArrow(_writer(folder, dictionary, archive_bytes, level), "name string, records long, bytes long")
    return written(manifest, "manifest")


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per record of the manifest's archives, payloads included."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("archive", pa.string())])
        names = ("page_id", "url", "payload", "bytes", "digest", "type", "refers_to")
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows: list[dict] = []
                held = 0
                for record in read_archive(content.as_py()):
                    if b"\r\nWARC-Type: warcinfo\r\n" in record[:200]:
                        continue
                    rows.append(decode_record(record))
                    held += len(record)
                    if held > 16 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t.type) for k, t in zip(names, schema)] + [pa.array([name] * len(rows))], schema=schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t.type) for k, t in zip(names, schema)] + [pa.array([name] * len(rows), pa.string())], schema=schema)

    if manifest.isEmpty():
        files = spark.createDataFrame([], "name string, content binary")
    else:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
        files = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
        files = files.join(manifest.select("name"), "name", "left_semi")
    return files.mapInArrow(parse, "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
                                   "record_type string, refers_to long, archive string")


def op6(pages: DataFrame) -> DataFrame:
    spark = pages.sparkSession
    folder = scratch_path(spark, "archives")
    manifest = write_archives(pages, folder)
    return read_archives(spark, folder, manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: DuckDB SQL for op6; base32 from the digest's bits, five at a time.
OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
s AS (SELECT page_id, strlen(h) AS payload_bytes, CAST(from_hex(sha1(h)) AS BIT)::VARCHAR AS bits, min(page_id) OVER (PARTITION BY h) AS first_id FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1
    + 16 * CAST(substr(bits, CAST(5 * i + 1 AS BIGINT), 1) AS INT) + 8 * CAST(substr(bits, CAST(5 * i + 2 AS BIGINT), 1) AS INT)
    + 4 * CAST(substr(bits, CAST(5 * i + 3 AS BIGINT), 1) AS INT) + 2 * CAST(substr(bits, CAST(5 * i + 4 AS BIGINT), 1) AS INT)
    + CAST(substr(bits, CAST(5 * i + 5 AS BIGINT), 1) AS INT) AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM s
"""
