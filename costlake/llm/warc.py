"""WARC archives of individually compressed records with an embedded dictionary.

``write_warc`` plans revisits relationally (payload SHA-1, largest page_id per
equal payload), then every task packs its records into archives of about
``ARCHIVE_BYTES``: a Zstandard dictionary is built from the archive's own records
and put into a leading skippable frame (magic 0x184D2A5D), and every record is
one Zstandard frame, so any of them can be read by its offset. Archives are
written under a name of their own attempt and moved into place, and a task's rows
are sorted first, whatever order the shuffle gave them, so a retried or
speculative task replaces a file by an equal one. ``read_warc`` opens the
archives through Spark's binary reader.

A task holds one archive at a time. Equal payloads are found by a join with the
repeated digests only; AQE splits a digest with very many rows.

Defined results: a NULL html is an empty payload; payloads below ``MIN_REVISIT``
bytes are all responses; rows that repeat the largest page_id of a payload are
all responses; a NULL page_id or url gives a record without that header (a NULL
page_id revisits like any other); control characters in urls are percent-encoded
in the archive; an empty table gives no archives and no rows; columns other than
page_id, url and html are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costlake.llm.text import text_of
from costlake.session import materialize, scratch_path

MIN_REVISIT = 1000
ARCHIVE_BYTES = 8 << 20
DICT_BYTES = 32 << 10
DICT_SAMPLE_BYTES = 1 << 20
LEVEL = 3
DICT_MAGIC = 0x184D2A5D      # skippable frame that holds the dictionary
DATE = "2024-01-01T00:00:00Z"
# Characters that stand for themselves in a target URI; the header with a url that has others.
_URI_SAFE = "%/:?#[]@!$&'()*+,;=~"
URL_AS_GIVEN = "X-Url-As-Given"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(page_id: int | None, url: str | None, payload: bytes, size: int, sha1_hex: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit (``refers_to`` given) carries no payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}"]
    name = f"page:{page_id}" if page_id is not None else f"uuid:{uuid.uuid5(uuid.NAMESPACE_URL, sha1_hex)}"
    head += [f"WARC-Record-ID: <urn:{name}>", f"WARC-Date: {DATE}"]
    if url is not None:
        told = quote(url, safe=_URI_SAFE)
        head.append("WARC-Target-URI: " + told)
        if told != url:       # what a header cannot hold stays readable for ``read_warc``
            head.append(f"{URL_AS_GIVEN}: " + base64.b64encode(url.encode()).decode())
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode())
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes]) -> bytes:
    """Dictionary from evenly spread records; raw content of them where they are
    too few or too alike to train on."""
    step = max(1, sum(map(len, records)) // DICT_SAMPLE_BYTES)
    sample = records[::step]
    try:
        return zstandard.train_dictionary(DICT_BYTES, sample, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(sample)[:DICT_BYTES]


def pack(records: list[bytes]) -> bytes:
    """An archive: the dictionary frame, then one frame per record."""
    d = build_dictionary(records)
    z = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_checksum=True)
    return b"".join([struct.pack("<II", DICT_MAGIC, len(d)), d, *map(z.compress, records)])


def unpack(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an archive."""
    magic, size = struct.unpack_from("<II", archive)
    if magic != DICT_MAGIC:
        raise ValueError("the archive has no leading dictionary frame")
    d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(archive[8:8 + size]))
    with d.stream_reader(memoryview(archive)[8 + size:], read_across_frames=True) as r:
        data = io.BytesIO(r.read())
    while head := data.readline():
        if head != b"WARC/1.1\r\n":
            raise ValueError("a record does not begin with its version")
        headers = {}
        while (line := data.readline()) != b"\r\n":
            k, _, v = line.decode().rstrip("\r\n").partition(": ")
            headers[k] = v
        yield headers, data.read(int(headers["Content-Length"]))
        data.read(4)


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/")
                                  and not uri.startswith("file://") else uri)


def revisits(pages: DataFrame, key: str = "page_id", html: str = "html", min_bytes: int = MIN_REVISIT) -> DataFrame:
    """(page_id, url, payload, size, sha1, refers_to) of every page."""
    payload = F.encode(text_of(html), "UTF-8")
    p = pages.select(F.col(key).cast("bigint").alias("page_id"), "url", payload.alias("payload")).select(
        "*", F.octet_length("payload").cast("bigint").alias("size"), F.sha1("payload").alias("sha1"))
    top = materialize(p.filter(F.col("size") >= min_bytes).groupBy("sha1", "size")
                      .agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    other: Column = F.col("page_id").isNull() | (F.col("page_id") != F.col("top"))
    return p.join(top, ["sha1", "size"], "left").select(
        "page_id", "url", "payload", "size", "sha1", F.when(other, F.col("top")).alias("refers_to"))


def write_warc(pages: DataFrame, folder: str, key: str = "page_id", html: str = "html",
               archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write archives into ``folder`` (a path that executors share); returns the
    manifest (path, records, bytes)."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _filesystem(folder)
        part, n, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pa.RecordBatch:
            data, name = pack(held), f"part-{part:05d}-{n:05d}.warc.zst"
            store.create_dir(base, recursive=True)
            attempt = f"{base}/_{name}.{uuid.uuid4().hex}"
            with store.open_output_stream(attempt) as f:
                f.write(data)
            store.move(attempt, f"{base}/{name}")
            return pa.RecordBatch.from_pydict({"path": [name], "records": [len(held)], "bytes": [len(data)]})

        for b in batches:
            for i in range(b.num_rows):
                row = [b.column(c)[i].as_py() for c in range(6)]
                held.append(record(*row))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield flush()
                    n, held, size = n + 1, [], 0
        if held:
            yield flush()

    rows = revisits(pages, key, html).sortWithinPartitions("sha1", "size", "page_id", "url")
    return materialize(rows.mapInArrow(write, "path string, records bigint, bytes bigint"))


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Records of every archive in ``folder``: page_id, url, payload_bytes,
    payload_digest, record_type, refers_to and the stored payload."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("payload", pa.binary())])

    def number(urn: str | None) -> int | None:
        return int(urn[10:-1]) if urn and urn.startswith("<urn:page:") else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                rows = []
                for h, block in unpack(content.as_py()):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    revisit = h["WARC-Type"] == "revisit"
                    told = base64.b32decode(h["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    if not revisit and hashlib.sha1(payload).hexdigest() != told:
                        raise ValueError(f"{h['WARC-Record-ID']}: payload does not match its digest")
                    size = int(http.rpartition(b"Content-Length: ")[2]) if revisit else len(payload)
                    uri = h.get("WARC-Target-URI")
                    if URL_AS_GIVEN in h:
                        uri = base64.b64decode(h[URL_AS_GIVEN]).decode()
                    rows.append((number(h["WARC-Record-ID"]), uri, size, told,
                                 h["WARC-Type"], number(h.get("WARC-Refers-To")), None if revisit else payload))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)],
                                                 schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.warc.zst").load(folder).select("content")
    return files.mapInArrow(read, "page_id bigint, url string, payload_bytes bigint, payload_digest string, "
                                  "record_type string, refers_to bigint, payload binary")


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Archive ``pages`` and read the archives back."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    if write_warc(pages, folder).agg(F.sum("records")).first()[0]:
        return read_warc(spark, folder)
    return spark.createDataFrame([], "page_id bigint, url string, payload_bytes bigint, payload_digest string, "
                                     "record_type string, refers_to bigint, payload binary")
