"""WARC archives in Zstandard: one frame per record, a dictionary in front.

An archive opens with a skippable frame that holds the dictionary of its records, then
has one Zstandard frame per record. Archives are written by Spark's own file writer, one
row per archive, so a task that is lost and run again leaves no half archive; what the
writer puts behind a row is an empty skippable frame, which every reader passes over.

Of records with equal payloads the one with the largest id holds the payload, and the
others are ``revisit`` records that refer to it. Equality is by SHA-1 and length.

The reader decodes each frame with the dictionary found in front and checks the frame's
declared size, the version line, the required headers, the block length, the end marks,
the length the HTTP headers give and the payload digest. A record that fails keeps its
row, with ``problem`` saying why; a broken frame ends its archive, with one such row.

Defined cases: a null payload is empty; a null id is smaller than every other, and the
records of a group of null ids all hold the payload, as do several rows of the largest
id; repeated rows give a record each; an empty table gives an archive without records;
a null address is empty; further columns are ignored. A payload longer than an archive's
size makes an archive of its own.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES = 16 << 10
SAMPLE_BYTES = 1 << 20
SAMPLE_RECORD_BYTES = 16 << 10
LEVEL = 3
CHUNK = 1 << 16

DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
EMPTY_FRAME = struct.pack("<II", 0x184D2A50, 0).decode("ascii")

REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = ("path string, place long, record_type string, record_id string, refers_to string, target_uri string, "
          "payload_bytes long, payload_digest string, payload binary, problem string")


def urn(record: object) -> str:
    return "<urn:page:none>" if record is None else f"<urn:page:{record}>"


def from_urn(column):
    """The id in a record's URN; null for none."""
    return F.nullif(F.regexp_extract(column, "^<urn:page:(.*)>$", 1), F.lit("none"))


def build(record, uri: str, payload: bytes | None, size: int, digest: str, refers_to) -> bytes:
    """One WARC record; without a payload it is a revisit."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n").encode()
    block = http if payload is None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if payload is None else 'response'}", f"WARC-Record-ID: {urn(record)}",
             f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if payload is None:
        lines += [f"WARC-Refers-To: {urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(lines: list[bytes]) -> dict[str, str]:
    fields = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise ValueError("header line without a name")
        fields.setdefault(name.strip().lower().decode("utf-8", "replace"), value.strip().decode("utf-8", "replace"))
    return fields


def parse(record: bytes) -> dict:
    """The fields of a record; raises ValueError with what is wrong."""
    head, mark, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not mark or lines[0] not in (b"WARC/1.0", b"WARC/1.1"):
        raise ValueError("no WARC header")
    fields = _fields(lines[1:])
    missing = [name for name in REQUIRED if name not in fields]
    if missing:
        raise ValueError(f"without {missing[0]}")
    if not fields["content-length"].isdigit():
        raise ValueError("content-length is no number")
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError("block length differs from content-length")
    kind, digest = fields["warc-type"], fields.get("warc-payload-digest", "")
    found = {"record_type": kind, "record_id": fields["warc-record-id"], "refers_to": fields.get("warc-refers-to"),
             "target_uri": fields.get("warc-target-uri"), "payload_digest": digest.partition(":")[2] or None,
             "payload": None, "payload_bytes": None}
    if kind in ("response", "revisit"):
        inner, mark, payload = rest[:size].partition(b"\r\n\r\n")
        if not mark or not inner.startswith(b"HTTP/"):
            raise ValueError("no HTTP header")
        declared = _fields(inner.split(b"\r\n")[1:]).get("content-length", "")
        if kind == "response":
            if declared and declared != str(len(payload)):
                raise ValueError("payload length differs from HTTP content-length")
            if digest.startswith("sha1:") and digest[5:] != base64.b32encode(hashlib.sha1(payload).digest()).decode():
                raise ValueError("payload digest differs")
            found |= {"payload": payload, "payload_bytes": len(payload)}
        else:
            if not found["refers_to"]:
                raise ValueError("revisit without warc-refers-to")
            found["payload_bytes"] = int(declared) if declared.isdigit() else None
    else:
        found |= {"payload": rest[:size], "payload_bytes": size}
    return found


def pack(records: list[bytes]) -> bytes:
    """An archive of the records, with a dictionary where there is enough to learn from."""
    samples, room = [], SAMPLE_BYTES
    step = max(1, len(records) * SAMPLE_RECORD_BYTES // SAMPLE_BYTES)
    for record in records[::step]:
        samples.append(record[:SAMPLE_RECORD_BYTES])
        room -= len(samples[-1])
        if room <= 0:
            break
    out, trained = bytearray(), None
    try:
        if len(samples) >= 8:
            trained = zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        trained = None
    if trained is not None:
        body = zstandard.ZstdCompressor(level=LEVEL).compress(trained.as_bytes())
        out += struct.pack("<II", DICTIONARY_FRAME, len(body)) + body
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
    for record in records:
        out += compressor.compress(record)
    return bytes(out)


def unpack(archive: memoryview) -> Iterator[tuple[int, bytes | None, str | None]]:
    """(place, record, problem) of each frame of an archive."""
    place, dictionary = 0, None
    while place < len(archive):
        head = bytes(archive[place:place + 8])
        if len(head) == 8 and struct.unpack("<I", head[:4])[0] in SKIPPABLE:
            magic, size = struct.unpack("<II", head)
            if place + 8 + size > len(archive):
                yield place, None, "skippable frame beyond the end"
                return
            if magic == DICTIONARY_FRAME and place == 0:
                body = bytes(archive[8:8 + size])
                try:
                    if body.startswith(FRAME_MAGIC):
                        body = zstandard.ZstdDecompressor().decompress(body)
                    dictionary = zstandard.ZstdCompressionDict(body)
                except zstandard.ZstdError as error:
                    yield place, None, f"dictionary: {error}"
                    return
            place += 8 + size
            continue
        try:
            declared = zstandard.get_frame_parameters(archive[place:place + 32]).content_size
            decoder = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
            pieces, end = [], place
            while not decoder.eof:
                if end >= len(archive):
                    raise zstandard.ZstdError("frame beyond the end")
                pieces.append(decoder.decompress(archive[end:end + CHUNK]))
                end = min(end + CHUNK, len(archive))
            end -= len(decoder.unused_data)
        except zstandard.ZstdError as error:
            yield place, None, f"frame: {error}"
            return
        record = b"".join(pieces)
        wrong = declared not in (zstandard.CONTENTSIZE_UNKNOWN, zstandard.CONTENTSIZE_ERROR, len(record))
        yield place, record, "frame size differs" if wrong else None
        place = end


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html") -> None:
    """Write a record per row below ``path``."""
    rows = pages.select(
        F.col(f"`{page_id}`").alias("id"), F.coalesce(F.col(f"`{url}`").cast("string"), F.lit("")).alias("uri"),
        F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.length("payload").cast("long")})
    last = rows.groupBy("digest", "size").agg(F.max("id").alias("last"))
    joined = rows.join(last, ["digest", "size"]).withColumn("revisit", ~F.col("id").eqNullSafe(F.col("last")))
    joined = joined.select("id", "uri", F.when(~F.col("revisit"), F.col("payload")).alias("payload"), "size", "digest", "last")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([pack(records)], pa.binary())], names=["archive"])

        records, room = [], ARCHIVE_BYTES
        for batch in batches:
            for i in range(batch.num_rows):
                record, uri, body, size, digest, refers_to = (column[i].as_py() for column in batch.columns)
                text = build(record, uri.replace("\r", "%0D").replace("\n", "%0A"), body, size,
                             base64.b32encode(bytes.fromhex(digest)).decode(), refers_to)
                if records and len(text) > room:
                    yield archive()
                    records, room = [], ARCHIVE_BYTES
                records.append(text)
                room -= len(text)
        if records:
            yield archive()

    archives = joined.mapInArrow(run, "archive binary").select(F.col("archive").cast("string").alias("value"))
    archives.write.option("lineSep", EMPTY_FRAME).option("maxRecordsPerFile", 1).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per record of the archives below ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                rows, room = [], ARCHIVE_BYTES
                for place, record, problem in unpack(memoryview(content.as_buffer())):
                    row = {"path": name.as_py(), "place": place, "problem": problem}
                    if problem is None:
                        try:
                            row |= parse(record)
                        except ValueError as error:
                            row["problem"] = str(error)
                    rows.append(row)
                    room -= len(record or b"")
                    if room <= 0:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, room = [], ARCHIVE_BYTES
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([(name, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[kind])
                        for name, kind in (part.split() for part in RECORD.split(", "))])
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, RECORD)


def sound_records(read: DataFrame) -> DataFrame:
    """``read`` as it is, if no record has a problem; otherwise the job fails and names one with its
    place. For callers who have to account for every record; ``read_archives`` itself goes on."""
    fault = F.concat_ws(" ", F.col("path"), F.col("place").cast("string"), F.col("problem"))
    return read.where(F.when(F.col("problem").isNull(), F.lit(True)).otherwise(F.raise_error(fault).cast("boolean")))
