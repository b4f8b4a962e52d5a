"""WARC archives compressed record by record with a Zstandard dictionary of their own.

Each task writes archives of a bounded raw size: it holds the records of one
archive, trains a dictionary on records taken at even strides, writes it as a
leading skippable frame, then every record as a frame of its own.  Records of
equal payload are written once: the pages meet the smallest page_id of their
payload's digest (a pre-aggregated join, so a payload shared by many pages is
no hot group) and the others become revisits.  Archives carry the names that
the committed manifest lists; a lost or repeated task attempt only leaves a
file that no manifest names.

Edge cases: a null html is an empty payload, a null url an empty target (line
breaks in it are percent-encoded); payloads below ``min_bytes`` are always
responses; rows of one page_id with one payload are all written as that page's
response if it is the smallest; a null page_id never counts as smallest unless
all of a payload's are null; an archive with too little to train on has an empty
dictionary frame; an empty table writes no archive; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from latentspark.llm.common import batched, by_batch, rows_of
from latentspark.session import cut, scratch_path

# The skippable frame that holds the dictionary, the record heads, the revisit profile.
DICTIONARY_MAGIC = 0x184D2A5D
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the HTTP head alone."""
    revisit = refers_to is not None
    block = HTTP_HEAD if revisit else HTTP_HEAD + payload
    target = re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", url or "")
    head = [VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {target}", "Content-Type: application/http;msgtype=response",
            f"WARC-Payload-Digest: sha1:{payload_digest(payload)}", f"WARC-Payload-Length: {len(payload)}"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Named fields and block of a record; a block that is not as long as announced is an error."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    size = int(fields["Content-Length"])
    if version != VERSION or len(rest) != size + 4:
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    return fields, rest[:size]


def archive(records: list[bytes], *, dictionary_bytes: int = 64 << 10, sample_bytes: int = 2 << 20, level: int = 3) -> bytes:
    """Dictionary frame and one compressed frame per record."""
    import zstandard
    total = sum(map(len, records))
    stride = max(1, -(-total // sample_bytes))
    samples = records[::stride]
    try:
        trained = zstandard.train_dictionary(min(dictionary_bytes, max(256, sum(map(len, samples)) // 8)), samples,
                                             k=256, d=8, f=20, accel=1, level=level)
    except zstandard.ZstdError:
        trained = None
    content = trained.as_bytes() if trained else b""
    compressor = zstandard.ZstdCompressor(level=level, write_checksum=True, **({"dict_data": trained} if trained else {}))
    return b"".join([struct.pack("<II", DICTIONARY_MAGIC, len(content)), content, *map(compressor.compress, records)])


def records_of(stream) -> Iterator[bytes]:
    """Records of an archive, read frame by frame; memory is bounded by the largest record."""
    import zstandard
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame")
    content = stream.read(size)
    options = {"dict_data": zstandard.ZstdCompressionDict(content)} if content else {}
    decompressor = zstandard.ZstdDecompressor(**options)
    left = b""
    while True:
        frame, out = decompressor.decompressobj(), []
        while not frame.eof:
            data = left or stream.read(1 << 18)
            left = b""
            if not data:
                if out:
                    raise ValueError("archive ends inside a record")
                return
            out.append(frame.decompress(data))
            left = frame.unused_data if frame.eof else b""
        yield b"".join(out)


def _files(uri: str):
    """(file system, path) of a folder that Spark names by a URI or a plain path."""
    import pyarrow.fs as fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def with_references(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, refers_to``: refers_to is the response's page_id for rows to be written as revisits."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumn("sha", F.sha1("html")).withColumn("size", F.octet_length("html"))
    first = (p.filter(F.col("size") >= min_bytes).groupBy(F.col("sha").alias("a"), F.col("size").alias("b"))
             .agg(F.min("page_id").alias("first")))
    joined = p.join(first.hint("merge"), (F.col("sha") == F.col("a")) & (F.col("size") == F.col("b")), "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.select("page_id", "url", "html", refers.alias("refers_to"))


MANIFEST = pa.schema([("path", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())])


def write_archives(pages: DataFrame, folder: str, *, min_bytes: int = 0, archive_bytes: int = 16 << 20) -> DataFrame:
    """Writes ``pages`` as archives into ``folder``; returns the committed manifest ``path, n_records, n_bytes``."""
    def run(batches):
        import uuid
        files, base = _files(folder)
        files.create_dir(base, recursive=True)

        def save(records):
            data = archive(records)
            name = f"pages-{uuid.uuid4().hex}.warc.zst"
            with files.open_output_stream(f"{base}/{name}") as out:
                out.write(data)
            return name, len(records), len(data)

        def out():
            held, size = [], 0
            for page_id, url, html, refers_to in rows_of(batches):
                held.append(record(page_id, url, html.encode("utf-8", "surrogatepass"), refers_to))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield save(held)
                    held, size = [], 0
            if held:
                yield save(held)
        yield from batched(out(), MANIFEST, 1)

    return cut(by_batch(with_references(pages, min_bytes), run, "path string, n_records long, n_bytes long"))


READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                  ("record_type", pa.string()), ("refers_to", pa.int64())])


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per record of the archives that the manifest lists; a response's payload is checked against its digest."""
    n = max(1, min(manifest.count(), 10_000))

    def page(field):
        number = field[len("<urn:page:"):-1]
        return int(number) if number else None

    def run(batches):
        files, base = _files(folder)

        def out():
            for (name,) in rows_of(batches):
                with files.open_input_stream(f"{base}/{name}") as stream:
                    for raw in records_of(stream):
                        fields, block = parse(raw)
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        size = int(fields["WARC-Payload-Length"])
                        if fields["WARC-Type"] == "response":
                            payload = block[len(HTTP_HEAD):]
                            if (len(payload), payload_digest(payload)) != (size, digest):
                                raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
                        refers_to = fields.get("WARC-Refers-To")
                        yield (page(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"],
                               page(refers_to) if refers_to else None)
        yield from batched(out(), READ)

    return manifest.select("path").repartition(n).mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes ``pages`` into a fresh folder of the shared checkpoint folder and reads the archives back."""
    folder = scratch_path(spark, "warc")
    return read_archives(write_archives(pages, folder, min_bytes=min_bytes), folder)
