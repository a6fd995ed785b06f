"""WARC archives in Zstandard: one frame per record, the dictionary in a leading skippable
frame.

Writing goes through Spark's own file writer, so archives land in any store that Spark
reaches and a retried task leaves no half file: a row is one frame, and the writer's line
separator is an empty skippable frame, which every Zstandard reader steps over.  A
partition is an archive; its first frame is the dictionary.  Partitions are sized from the
summed payloads.

Reading takes each archive as one binary row (archives are bounded by ``ARCHIVE_BYTES``
plus one record), loads the dictionary, walks the frames by their block headers, decodes
one frame at a time and checks version line, header fields, lengths, trailer and digest;
a bad frame raises with its archive and offset.

Defined results: a null or empty payload is a record with an empty payload; records with
equal payloads refer to the smallest id among them (rows that share that id are responses
all); a null id comes back null and refers to the smallest id if there is one; control
characters in a URL are percent-encoded; an empty table writes no record and reads as an
empty table; the dictionary comes from a bounded sample and affects sizes only."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import materialize, per_row

ARCHIVE_BYTES = 24 << 20
DICTIONARY_BYTES = 16 << 10
SAMPLE_ROWS, SAMPLE_BYTES = 800, 4096
# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
SEPARATOR = "P*M\x18\0\0\0\0"           # a skippable frame (0x184D2A50) of no bytes
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


class WarcError(ValueError):
    pass


def train(pages: DataFrame, payload: str) -> bytes:
    """A dictionary from the beginnings of at most SAMPLE_ROWS different payloads, those with
    the smallest hashes; b'' if there is too little to train on."""
    some = pages.where(F.length(payload) > 0).select(F.xxhash64(payload).alias("h"), F.substring(F.col(payload).cast("binary"), 1, SAMPLE_BYTES).alias("p"))
    # of so many payloads, about 4 * SAMPLE_ROWS different ones have a hash below the bound:
    # only those, cut and one for each hash, meet to be ordered
    n = some.select(F.approx_count_distinct("h")).first()[0]
    bound = (1 << 63) - 1 if n <= 4 * SAMPLE_ROWS else -(1 << 63) + (1 << 64) * 4 * SAMPLE_ROWS // n
    rows = some.where(F.col("h") <= bound).groupBy("h").agg(F.min("p").alias("p")).orderBy("h").limit(SAMPLE_ROWS).select("p").collect()
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [bytes(r["p"]) for r in rows], level=3).as_bytes()
    except zstandard.ZstdError:
        return b""


def _head(fields: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def record(key: int | None, url: str | None, size: int, digest: str, payload: bytes | None, refers: int | None) -> bytes:
    """One record; ``payload`` None makes a revisit record, whose block is the HTTP head."""
    clean = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "") or "about:blank"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    kind = "response" if payload is not None else "revisit"
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{'' if key is None else key}>"), ("WARC-Date", DATE),
              ("WARC-Target-URI", clean), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if payload is None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{'' if refers is None else refers}>")]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return _head(fields) + block + b"\r\n\r\n"


def base32_sha1(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def plan_records(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_bytes: int = 0) -> DataFrame:
    """(id, url, size, sha1, payload or null for revisits, refers)."""
    p = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                     F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    p = p.withColumn("size", F.octet_length("payload").cast("long")).withColumn("sha1", F.sha1("payload"))
    # written first: both sides of the join are then plain shuffles that Spark can split
    # where one payload has very many pages
    same = materialize(p.where(F.col("size") >= min_bytes).groupBy("sha1").agg(F.min("id").alias("first"), F.count("*").alias("n"))
                       .where("n > 1").select("sha1", "first"), "warc-same")
    j = p.join(same, "sha1", "left")
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return j.select("id", "url", "size", "sha1", F.when(~again, F.col("payload")).alias("payload"),
                    F.when(again, F.col("first")).alias("refers"))


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
          min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write archives under ``path``: a response record for each different payload, revisit
    records for the others; payloads under ``min_bytes`` are always responses."""
    dictionary = train(pages, payload_col)
    total = pages.agg(F.sum(F.octet_length(F.col(payload_col)) + 600).alias("b")).first()["b"] or 0
    plan = plan_records(pages, id_col, url_col, payload_col, min_bytes)
    schema = pa.schema([("frame", pa.binary())])

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        extra = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        out = zstandard.ZstdCompressor(level=3, dict_data=extra, write_content_size=True, write_checksum=True)
        started = not dictionary
        for key, url, size, sha1, payload, refers in rows:
            if not started:
                packed = zstandard.ZstdCompressor(level=9).compress(dictionary)
                yield (struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed,)
                started = True
            yield (out.compress(record(key, url, size, base32_sha1(sha1), payload, refers)),)

    parts = max(1, -(-total // archive_bytes))
    frames = (plan.repartition(parts, F.xxhash64("id", "url", "sha1"))
              .mapInArrow(per_row(run, schema, 64), "frame binary"))
    frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", SEPARATOR).text(path)


def _skip(data: memoryview, at: int) -> int:
    """The end of the frame at ``at``: block headers tell the blocks' sizes."""
    p = zstandard.get_frame_parameters(data[at:at + 18])
    at += zstandard.frame_header_size(data[at:at + 18])
    while True:
        if at + 3 > len(data):
            raise WarcError("truncated frame")
        h = int.from_bytes(data[at:at + 3], "little")
        at += 3 + (1 if (h >> 1) & 3 == 1 else h >> 3)
        if h & 1:
            break
    at += 4 if p.has_checksum else 0
    if at > len(data):
        raise WarcError("truncated frame")
    return at


def frames(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, decoded record) of each frame; the dictionary is loaded on the way."""
    view, at, reader, first = memoryview(data), 0, zstandard.ZstdDecompressor(), True
    while at < len(view):
        if at + 8 > len(view):
            raise WarcError("truncated frame")
        magic, size = struct.unpack_from("<II", view, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if at + 8 + size > len(view):
                raise WarcError("truncated skippable frame")
            if magic == DICTIONARY_MAGIC:
                if not first:
                    raise WarcError("a dictionary after the first frame")
                body = bytes(view[at + 8:at + 8 + size])
                if body[:4] == struct.pack("<I", FRAME_MAGIC):
                    body = zstandard.ZstdDecompressor().decompress(body, max_output_size=1 << 27)
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body))
            at += 8 + size
        elif magic == FRAME_MAGIC:
            end = _skip(view, at)
            yield at, reader.decompressobj().decompress(view[at:end])
            at = end
        else:
            raise WarcError(f"no frame at {at}")
        first = False


def parse(rec: bytes) -> dict:
    """Checked fields of one record."""
    head, mark, rest = rec.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not mark or lines[0] != "WARC/1.1":
        raise WarcError("no WARC/1.1 head")
    fields = {}
    for line in lines[1:]:
        k, colon, v = line.partition(": ")
        if not colon or k.lower() in fields:
            raise WarcError(f"bad or repeated header line {line[:60]!r}")
        fields[k.lower()] = v
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - fields.keys()
    if missing or not fields.get("content-length", "").isdigit():
        raise WarcError(f"missing or bad headers: {sorted(missing) or 'content-length'}")
    n = int(fields["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise WarcError(f"Content-Length {n}, but {len(rest) - 4} bytes before the trailer")
    http, mark, payload = rest[:n].partition(b"\r\n\r\n")
    size = re.search(rb"\r\nContent-Length: (\d+)", http)
    if not mark or not size:
        raise WarcError("no HTTP head")
    kind, digest = fields["warc-type"], fields.get("warc-payload-digest", "")
    if kind == "response":
        if len(payload) != int(size[1]):
            raise WarcError("payload and HTTP Content-Length differ")
        if digest != "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode():
            raise WarcError("payload digest differs")
    elif kind != "revisit" or payload or "warc-refers-to" not in fields:
        raise WarcError(f"bad record of type {kind}")
    def page(field: str) -> int | None:
        m = re.fullmatch(r"<urn:page:(-?\d*)>", fields.get(field, "<urn:page:>"))
        if not m:
            raise WarcError(f"bad {field}")
        return int(m[1]) if m[1] else None
    return {"id": page("warc-record-id"), "type": kind, "url": fields.get("warc-target-uri"), "size": int(size[1]),
            "digest": digest[5:], "refers": page("warc-refers-to"), "payload": payload if kind == "response" else None}


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """(id, type, url, size, digest, refers[, payload]) of every record under ``path``."""
    kinds = [("id", pa.int64()), ("type", pa.string()), ("url", pa.string()), ("size", pa.int64()), ("digest", pa.string()),
             ("refers", pa.int64())] + [("payload", pa.binary())] * with_payload
    names = [k for k, _ in kinds]

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for name, data in rows:
            try:
                for at, rec in frames(data):
                    got = parse(rec)
                    yield tuple(got[k] for k in names)
            except (WarcError, zstandard.ZstdError) as e:
                raise WarcError(f"{name}: {e}") from e

    src = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    ddl = "id long, type string, url string, size long, digest string, refers long" + ", payload binary" * with_payload
    return src.mapInArrow(per_row(run, pa.schema(kinds), 256), ddl)
