"""WARC archives with one Zstandard frame per record and a dictionary in front.

Layout of a file: a skippable frame with the dictionary, then one frame per record, with
empty skippable frames between them. Any decoder of ``.warc.zst`` files reads this.

``write_archives`` writes a file per partition to a folder of Spark's file system;
``read_archives`` reads such folders, or files of other writers (their dictionary may
itself be compressed, or absent).
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.batches import byte_slices, filled

# Fixed values of the format.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGICS = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: An empty skippable frame, all ASCII, so that Spark's text writer can put it between rows.
GAP = struct.pack("<II", 0x184D2A50, 0).decode("ascii")
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"

#: A file's dictionary is trained on its first records, up to so many bytes.
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 32 << 10
FEED = 1 << 16
#: Parts of the pages that look for equal payloads apart from each other.
PARTS = 64

READ_SCHEMA = (
    "archive string, record_id string, record_type string, target_uri string, refers_to_id string, "
    "payload binary, payload_bytes bigint, payload_digest string, error string"
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def mark_revisits(pages: DataFrame, key: str, payload: str, min_bytes: int = 0) -> DataFrame:
    """``pages`` with ``refers_to``: of rows with equal payloads the largest key, null in its own row.

    Payloads under ``min_bytes`` refer to nothing. Keys are reduced to one row per payload
    that occurs again, and each of ``PARTS`` parts of the pages looks it up by itself, so that
    equal pages do not meet in one task. Rows that repeat the largest key are all left
    without a reference; null keys come before all others.
    """
    body = F.coalesce(F.col(payload), F.lit(""))
    same = F.concat(F.sha1(F.encode(body, "UTF-8")), F.octet_length(body).cast("string"))
    marked = pages.withColumns({"__same": same, "__part": F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int")})
    last = marked.groupBy("__same").agg(F.max(key).alias("__last"), F.count(F.lit(1)).alias("__rows"))
    parts = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))
    last = last.filter("__rows > 1").select("__same", "__last", parts.alias("__part"))
    refers = F.when(
        (F.octet_length(body) >= min_bytes) & ~F.col(key).eqNullSafe(F.col("__last")), F.col("__last")
    )
    joined = marked.join(last, ["__same", "__part"], "left").withColumn("refers_to", refers)
    return joined.drop("__same", "__part", "__last")


def _record(kind: str, record_id: str, uri: str | None, refers_to: str | None, payload: bytes) -> bytes:
    block = HTTP_HEAD if kind == "revisit" else HTTP_HEAD + payload
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}"]
    if uri is not None:
        head.append(f"WARC-Target-URI: {quote(uri, safe=':/?#[]@!$&()*+,;=%~')}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += [
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return b"WARC/1.1\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    for batch in batches:
        for part in byte_slices(batch, "payload"):
            rows = zip(
                *(part.column(c).to_pylist() for c in ("record_id", "uri", "refers_to_id")),
                filled(part.column("payload")).to_pylist(),
                strict=True,
            )
            for record_id, uri, refers_to, payload in rows:
                kind = "response" if refers_to is None else "revisit"
                yield _record(kind, record_id, uri, refers_to, payload)


def _dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """Of a few records, or of records without anything in common, there is none."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples) if len(samples) > 7 else None
    except zstandard.ZstdError:
        return None


def _frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    records = _records(batches)
    samples, held = [], 0
    for record in records:
        samples.append(record)
        held += len(record)
        if held >= SAMPLE_BYTES:
            break
    trained = _dictionary(samples)
    raw = trained.as_bytes() if trained else b""
    options = {"dict_data": trained} if trained else {}
    compressor = zstandard.ZstdCompressor(level=6, write_content_size=True, write_checksum=True, **options)
    out = [struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw] if trained else []
    size = 0

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])

    def every() -> Iterator[bytes]:
        while samples:
            yield samples.pop(0)
        yield from records

    for record in every():
        out.append(compressor.compress(record))
        size += len(out[-1])
        if size >= SAMPLE_BYTES:
            yield flush()
            out, size = [], 0
    if out:
        yield flush()


def write_archives(records: DataFrame, path: str) -> None:
    """Write ``(record_id, uri, refers_to_id, payload binary)``, a file per partition.

    A record with ``refers_to_id`` becomes a revisit: it has the digest of its payload but
    not the payload. A null payload is empty, a null uri is left out, and characters that
    can't stand in a header are percent-encoded. An empty table makes an empty folder.
    """
    frames = records.select("record_id", "uri", "refers_to_id", "payload").mapInArrow(_frames, "frame binary")
    as_text = frames.select(F.col("frame").cast("string").alias("value"))
    as_text.write.option("lineSep", GAP).option("compression", "none").text(path)


# --- reading ---------------------------------------------------------------------


def _split(content: memoryview) -> Iterator[tuple[bytes | None, str | None]]:
    """Every record of an archive; where a frame can't be decoded, what is wrong, and the end."""
    at, decoder = 0, zstandard.ZstdDecompressor()
    while at < len(content):
        if at + 8 > len(content):
            yield None, "cut off"
            return
        magic, length = struct.unpack_from("<II", content, at)
        if magic in SKIPPABLE_MAGICS:
            if at + 8 + length > len(content):
                yield None, "cut off"
                return
            if magic == DICTIONARY_MAGIC and at == 0:
                raw = bytes(content[8 : 8 + length])
                if raw[:4] == struct.pack("<I", FRAME_MAGIC):
                    raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
                decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
            at += 8 + length
            continue
        if magic != FRAME_MAGIC:
            yield None, "no frame"
            return
        frame, parts = decoder.decompressobj(), []
        try:
            while not frame.eof and at < len(content):
                parts.append(frame.decompress(content[at : at + FEED]))
                at += min(FEED, len(content) - at)
        except zstandard.ZstdError:
            yield None, "broken frame"
            return
        if not frame.eof:
            yield None, "cut off"
            return
        at -= len(frame.unused_data)
        yield b"".join(parts), None


def _header(lines: list[bytes]) -> dict[str, str] | None:
    fields = {}
    for line in lines:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon or name != name.strip() or not name:
            return None
        fields[name.lower()] = value.strip()
    return fields


def _digest_matches(stated: str | None, payload: bytes) -> bool:
    """Digests by other algorithms than SHA-1 are not checked."""
    return not (stated or "").lower().startswith("sha1:") or stated[5:].upper() == base32_sha1(payload)


def _parse(record: bytes) -> dict:
    head, found, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not found or version not in VERSIONS:
        return {"error": "no WARC header"}
    fields = _header(lines)
    if fields is None:
        return {"error": "bad header line"}
    if missing := [name for name in REQUIRED if not fields.get(name)]:
        return {"error": f"no {missing[0]}"}
    row = {
        "record_id": fields["warc-record-id"].strip("<>"),
        "record_type": fields["warc-type"],
        "target_uri": fields.get("warc-target-uri"),
        "refers_to_id": fields.get("warc-refers-to", "").strip("<>") or None,
    }
    length = fields["content-length"]
    if not (length.isascii() and length.isdigit()) or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        return row | {"error": "wrong length"}
    block = rest[:-4]
    if not _digest_matches(fields.get("warc-block-digest"), block):
        return row | {"error": "wrong block digest"}
    stated = fields.get("warc-payload-digest")
    if row["record_type"] == "revisit":
        return row | {"payload_digest": (stated or "").partition(":")[2] or None}
    payload = block
    if fields.get("content-type", "").startswith("application/http"):
        _, ended, payload = block.partition(b"\r\n\r\n")
        if not ended:
            return row | {"error": "no HTTP header"}
    if not _digest_matches(stated, payload):
        return row | {"error": "wrong payload digest"}
    return row | {"payload": payload, "payload_bytes": len(payload), "payload_digest": base32_sha1(payload)}


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record: ids, type, digest and payload, or ``error`` with the first fault found.

    Checked: frames, version, required fields, ``Content-Length`` against the frame, and
    SHA-1 digests. A frame that can't be decoded gives one row with an error, and ends its
    file. A revisit has a digest but no payload. Without ``payloads`` that column is null;
    its length and digest are there all the same. A file is read as a whole by one task,
    so an archive must fit in its memory (2 GB at most, as Spark's binary reader has it).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(n, pa.binary() if n == "payload" else pa.int64() if n == "payload_bytes" else pa.string()) for n in names]
        )
        for batch in batches:
            for i in range(batch.num_rows):
                archive = batch.column("path")[i].as_py()
                content = memoryview(batch.column("content")[i].as_buffer())
                rows, size = [], 0
                for record, error in _split(content):
                    row = {"error": error} if error else _parse(record)
                    if not payloads:
                        row.pop("payload", None)
                    size += len(row.get("payload") or b"") + 200
                    rows.append(row | {"archive": archive})
                    if size >= SAMPLE_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    names = [field.split()[0] for field in READ_SCHEMA.split(", ")]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "[!_.]*").load(path)
    return files.select("path", "content").mapInArrow(run, READ_SCHEMA)
