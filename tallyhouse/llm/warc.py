"""WARC archives, each compressed with a Zstandard dictionary of its own.

An archive file (``.warc.zst``) starts with a skippable frame that holds the
dictionary, built from a bounded sample of the file's own records; after it
every record is a frame of its own, so a reader can start at any record.

Records are ``response`` records with the payload behind an HTTP header, or,
for a payload of ``revisit_bytes`` or more that another page with a smaller
page_id has too, ``revisit`` records that refer to that page and hold no
payload.  Duplicates are found by SHA-256 in a join on digests that occur more
than once.

A task gathers one archive's records up to ``archive_bytes`` at a time, writes
the file under a temporary name and renames it.  Its rows are sorted, so a
repeated attempt makes the same files again and replaces its predecessor's.

Edge cases: a null html counts as empty; a null url is written as an empty
one; a null page_id stands for itself and never is what others refer to; rows
that repeat a payload's smallest page_id are responses, each; an empty table
gives no records; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import ship_by_value, stored
from tallyhouse.session import ensure_checkpoint_dir

ship_by_value(__name__)

REVISIT_BYTES = 100
ARCHIVE_BYTES = 16 << 20      # uncompressed records in one archive, about
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 2 << 20        # of an archive's records, from which its dictionary is built
LEVEL = 3
# fixed values of the formats
SKIPPABLE = 0x184D2A5D
FRAME = b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
ROW = "page_id {}, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to {}, payload binary"


def mark_revisits(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload (UTF-8 bytes), payload_digest, record_type, refers_to."""
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"),
                        F.coalesce("html", F.lit("")).cast("binary").alias("payload")) \
        .withColumn("payload_digest", F.sha2("payload", 256))
    again = stored(rows.filter(F.length("payload") >= revisit_bytes).groupBy("payload_digest") \
        .agg(F.count("*").alias("n"), F.min("page_id").alias("first_id")).filter("n > 1") \
        .select("payload_digest", "first_id"), "payload-digests")
    revisit = F.col("page_id") > F.col("first_id")
    return rows.join(again, "payload_digest", "left").select(
        "page_id", "url", "payload", "payload_digest",
        F.when(F.coalesce(revisit, F.lit(False)), "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"))


def record_bytes(page_id, url: str, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One WARC/1.1 record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    name = lambda i: f"<urn:page:{i}>"
    head = ["WARC/1.1", f"WARC-Type: {kind}",
            f"WARC-Record-ID: {name('' if page_id is None else page_id)}",
            f"WARC-Target-URI: {' '.join(url.split())}", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha256:{digest}"]
    if kind == "revisit":
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {name(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The fields of one record; the payload is checked against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    size = int(http.rsplit(b"Content-Length: ", 1)[1])
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda s: s.removeprefix("<urn:page:").removesuffix(">") or None
    return {"page_id": number(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "payload_bytes": size,
            "payload_digest": digest, "record_type": kind, "refers_to": number(fields.get("WARC-Refers-To", "")),
            "payload": payload if kind == "response" else None}


def archive_bytes_of(records: list[bytes], dictionary_bytes: int = DICTIONARY_BYTES,
                     sample_bytes: int = SAMPLE_BYTES, level: int = LEVEL) -> bytes:
    """A whole archive: the dictionary in a skippable frame, then a frame per record."""
    import zstandard
    samples, taken = [], 0
    for k in range(0, len(records), max(1, sum(map(len, records)) // sample_bytes)):
        piece = records[k][:32 << 10]         # the dictionary alone is built from prefixes
        samples.append(piece)
        taken += len(piece)
        if taken >= sample_bytes:
            break
    try:
        trained = zstandard.train_dictionary(min(dictionary_bytes, max(1024, taken // 8)), samples, k=512, d=8)
    except zstandard.ZstdError:               # too few or too short records to train on: their bytes as they are
        trained = zstandard.ZstdCompressionDict(b"".join(samples)[:dictionary_bytes] or b" ",
                                                dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    raw = trained.as_bytes()
    trained.precompute_compress(level=level)
    press = zstandard.ZstdCompressor(level=level, dict_data=trained, write_content_size=True)
    return struct.pack("<II", SKIPPABLE, len(raw)) + raw + b"".join(map(press.compress, records))


def read_archive(data: bytes):
    """The records (bytes) of an archive, one after another."""
    import zstandard
    magic, size = struct.unpack_from("<II", data)
    if magic != SKIPPABLE:
        raise ValueError("no dictionary frame")
    raw = data[8:8 + size]
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    at = 8 + size
    while at < len(data):
        if data[at:at + 4] != FRAME:
            raise ValueError(f"no frame at {at}")
        frame, parts = reader.decompressobj(), []
        while not frame.eof:
            if at >= len(data):
                raise ValueError("the last frame is cut off")
            fed = data[at:at + (16 << 10)]
            parts.append(frame.decompress(fed))
            at += len(fed)
        at -= len(frame.unused_data)
        yield b"".join(parts)


def _write(folder: str, archive_bytes: int):
    def archives(batches):
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        held, size, number = [], 0, 0

        def finish():
            nonlocal held, size, number
            name = f"{root}/part-{task.partitionId():05d}-{number:04d}.warc.zst"
            draft = f"{root}/_{task.partitionId():05d}-{number:04d}-{task.taskAttemptId()}"
            data = archive_bytes_of(held)
            with store.open_output_stream(draft) as out:
                out.write(data)
            store.move(draft, name)
            row = (name.rsplit("/", 1)[1], len(held), size, len(data))
            held, size, number = [], 0, number + 1
            return row

        done = []
        for batch in batches:
            for row in batch.to_pylist():
                held.append(record_bytes(row["page_id"], row["url"], row["payload"], row["payload_digest"],
                                         row["record_type"], row["refers_to"]))
                size += len(held[-1])
                if size >= archive_bytes:
                    done.append(finish())
        if held:
            done.append(finish())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*done), (
                pa.string(), pa.int64(), pa.int64(), pa.int64()))], names=["file", "records", "raw_bytes", "file_bytes"])
    return archives


def write_warc(pages: DataFrame, folder: str, revisit_bytes: int = REVISIT_BYTES,
               archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages to archives in ``folder`` (a URI); returns one row per
    archive file: file, records, raw_bytes, file_bytes."""
    from pyarrow import fs
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    marked = mark_revisits(pages, revisit_bytes).sortWithinPartitions("page_id", "payload_digest", "url")
    return stored(marked.mapInArrow(
        _write(folder, archive_bytes), "file string, records bigint, raw_bytes bigint, file_bytes bigint"), "archives")


def read_warc(spark, folder: str, id_type: str = "bigint") -> DataFrame:
    """One row per record of all archives in ``folder``."""
    convert = {"bigint": int, "int": int, "string": str}[id_type]
    own = lambda x: None if x is None else convert(x)
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    kind = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type]
    types = [kind, pa.string(), pa.int64(), pa.string(), pa.string(), kind, pa.binary()]

    def rows(batches):
        for batch in batches:
            for data in batch.column(0):
                found = []
                for record in map(parse_record, read_archive(data.as_py())):
                    record |= {"page_id": own(record["page_id"]), "refers_to": own(record["refers_to"])}
                    found.append(record)
                    if len(found) == 512:
                        yield pa.RecordBatch.from_pylist(found, schema=pa.schema(list(zip(names, types))))
                        found = []
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema=pa.schema(list(zip(names, types))))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return files.select("content").mapInArrow(rows, ROW.format(id_type, id_type))


def archive(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write all pages to archives in the shared folder, read these back and
    return page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    folder = folder or f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(pages, folder)
    return read_warc(spark, folder, pages.select("page_id").schema[0].dataType.simpleString()).drop("url", "payload")


ORACLE_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM f
"""
