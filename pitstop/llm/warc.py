"""Dictionary-compressed WARC archives.

Every task writes its pages, in id order, to archives of bounded size: a
Zstandard dictionary built from records of the archive leads it in a skippable
frame, and each record is a frame of its own, compressed with it.  Payloads
that were archived already are written as revisit records."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator, Sequence

import pyarrow as pa
import zstandard as zstd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitstop.llm.scratch import fresh_path, stage, write_file

MAGIC = 0x184D2A5D              # skippable frame that holds the dictionary
ARCHIVE_BYTES = 32 << 20        # records of an archive, before compression
DICTIONARY_BYTES = 48 << 10
SAMPLE_BYTES = 2 << 20          # records the dictionary is built from
MIN_REVISIT = 100               # shorter payloads are always written
LEVEL = 3
LAST = 2**63 - 1                # stands for a null id: larger than any
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """A response record, or a revisit (head of the response alone) if it refers to another."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = head if revisit else head + payload
    target = "" if url is None else "".join(c if " " < c != "\x7f" else "%%%02X" % ord(c) for c in url)
    fields = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>",
              f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}",
              "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if target:
        fields.append(f"WARC-Target-URI: {target}")
    if revisit:
        fields += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return ("WARC/1.1\r\n" + "\r\n".join(fields) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def dictionary(records: Sequence[bytes]) -> zstd.ZstdCompressionDict:
    """Built from records spread over the archive; too few to learn from serve as they are."""
    step = max(1, sum(map(len, records)) // SAMPLE_BYTES)
    sample = [r[:1 << 17] for r in records[::step]]
    try:
        return zstd.train_dictionary(DICTIONARY_BYTES, sample, k=512, d=8)
    except zstd.ZstdError:
        return zstd.ZstdCompressionDict(b"".join(sample)[:DICTIONARY_BYTES] or b"WARC/1.1\r\n", dict_type=zstd.DICT_TYPE_RAWCONTENT)


def archive(records: Sequence[bytes]) -> bytes:
    known = dictionary(records)
    frame = zstd.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=True).compress
    body = known.as_bytes()
    return struct.pack("<II", MAGIC, len(body)) + body + b"".join(map(frame, records))


def read_archive(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of every record of an archive."""
    magic, size = struct.unpack_from("<II", content)
    if magic != MAGIC:
        raise ValueError("the archive has no dictionary frame")
    reader = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(content[8:8 + size])).stream_reader(
        memoryview(content)[8 + size:], read_across_frames=True)
    data = reader.readall()
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if version != "WARC/1.1":
            raise ValueError("not a WARC record")
        fields = dict(x.split(": ", 1) for x in lines)
        at = end + 4 + int(fields["Content-Length"])
        yield fields, data[end + 4:at]
        at += 4


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES,
                   columns: Sequence[str] = ("page_id", "url", "html")) -> DataFrame:
    """Archives of all pages under ``folder``; returns (archive, records), staged.

    The payload is the html in UTF-8, a null one is empty.  Of pages with
    equal payloads of MIN_REVISIT bytes or more those with the smallest id (a
    null one is larger than any) are responses, the others revisit it.  A
    file is written under another name and renamed, and a task's rows are
    sorted, so one that runs again writes the same files."""
    page_id, url, html = columns
    body = F.coalesce(F.col(html), F.lit(""))
    row = pages.select(F.coalesce(F.col(page_id).cast("long"), F.lit(LAST)).alias("page_id"), F.col(url).alias("url"),
                       body.alias("html"), F.sha2(body.cast("binary"), 256).alias("digest"))
    seen = row.filter(F.octet_length("html") >= MIN_REVISIT).select("page_id", "digest")
    # One row a payload, pre-aggregated; only those that come again go on.
    first = (seen.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("_n"))
             .filter((F.col("_n") > 1) & (F.col("refers_to") != LAST)).drop("_n"))
    again = seen.join(first, "digest").filter("page_id <> refers_to").distinct()
    fixed = (row.join(again, ["page_id", "digest"], "left").select("page_id", "url", "html", "digest", "refers_to")
             .sortWithinPartitions("page_id", "digest", "url"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, names, counts = TaskContext.get().partitionId(), [], []
        held, size = [], 0

        def flush():
            name = f"part-{part:06d}-{len(names):04d}.warc.zst"
            write_file(folder, name, archive(held))
            names.append(name)
            counts.append(len(held))

        for batch in batches:
            for values in zip(*(batch.column(i) for i in range(5))):
                i, u, text, digest, refers = (v.as_py() for v in values)
                held.append(record(None if i == LAST else i, u, text.encode(), digest, refers))
                size += len(held[-1])
                if size >= archive_bytes:
                    flush()
                    held, size = [], 0
        if held:
            flush()
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(counts, pa.int64())], ["archive", "records"])

    return stage(fixed.mapInArrow(write, "archive string, records long"), "warc-manifest")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to and url
    of every record of the archives in ``folder``; the digest of a response is
    taken from the payload that was read."""
    def page(name):
        return None if name is None or name == "<urn:page:None>" else int(name[10:-1])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                out = [[], [], [], [], [], []]
                for fields, block in read_archive(content.as_py()):
                    kind, (head, payload) = fields["WARC-Type"], block.split(b"\r\n\r\n", 1)
                    size = int(head.rpartition(b"Content-Length: ")[2])
                    digest = hashlib.sha256(payload).hexdigest() if kind == "response" else fields["WARC-Payload-Digest"][7:]
                    if kind == "response" and (size != len(payload) or fields["WARC-Payload-Digest"] != f"sha256:{digest}"):
                        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
                    for column, value in zip(out, (page(fields["WARC-Record-ID"]), size, digest, kind,
                                                   page(fields.get("WARC-Refers-To")), fields.get("WARC-Target-URI"))):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()))],
                    ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"])

    files = (spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
             .option("pathGlobFilter", "*.warc.zst").load(folder))
    return files.select("content").mapInArrow(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the archives to the shared folder and read them back.  An empty
    table writes none and gives no rows."""
    spark = pages.sparkSession
    folder = fresh_path(spark, "warc")
    manifest = write_archives(pages, folder, **options)
    if manifest.isEmpty():
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, "
                                         "refers_to long, url string")
    return read_archives(spark, folder)
