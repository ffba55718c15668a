"""WARC archives compressed with Zstandard: one frame per record, dictionary in the leading skippable frame.

**Writing.** Records are packed into archives of about ``ARCHIVE_BYTES`` compressed bytes. Each archive starts
with a skippable frame (magic 0x184D2A5D) that holds the dictionary trained on its first records; then one
frame per record follows. An archive is one row, written as one file by Spark's own committed writer: its
line end is an empty skippable frame, which is valid Zstandard, so the files can be read by any reader.

**Reading.** Any ``*.warc.zst`` files come as (path, content) from Spark's ``binaryFile`` source. The reader
takes the dictionary from the leading skippable frame (itself compressed or not; none is fine), decodes one
frame at a time, and checks version line, header lines, required fields, Content-Length, record end, and
the digests of block and payload.

**Revisits.** Of pages with equal payloads (length and SHA-1) of at least ``least`` bytes, that with the
smallest page_id is a response, the others are revisits that refer to it and hold no payload. Rows that share
that smallest page_id are all responses. Only digests are grouped and shuffled, never payloads; the table
of repeated digests is broadcast if its measured size allows, else joined with salted keys.

Edge cases: null html is an empty payload; a null url is an empty target; a null page_id counts as larger than
all others and is written as ``null``; repeated rows are repeated records; an empty table writes no archive
and reads back no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aferir.llm.common import whole_text
from aferir.operators.join import join_unique
from aferir.session import broadcast_if_small, ensure_checkpoint_dir, materialise

# Fixed values of the formats.
DICTIONARY_MAGIC, ZSTD_MAGIC = 0x184D2A5D, b"\x28\xb5\x2f\xfd"
SKIPPABLE_LOW, SKIPPABLE_HIGH = 0x184D2A50, 0x184D2A5F
VERSION = b"WARC/1.1"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: An empty skippable frame, all ASCII: the line end of Spark's text writer.
EMPTY_FRAME = struct.pack("<II", SKIPPABLE_LOW, 0).decode("ascii")

#: Compressed bytes of an archive, bytes of records its dictionary is trained on, and of the dictionary.
ARCHIVE_BYTES, SAMPLE_BYTES, DICTIONARY_BYTES = 16 << 20, 2 << 20, 64 << 10
#: Bytes given to the decoder at once, and of decoded records in a batch.
CHUNK, BATCH_BYTES = 16 << 10, 16 << 20
#: The capture date of pages, which have none.
DATE = "2000-01-01T00:00:00Z"
ID = "<urn:page:{}:{}>"


class BadRecord(ValueError):
    """A frame that is not one whole valid record."""


def digest(data: bytes) -> str:
    """Upper-case base32 of SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def record_bytes(fields: Iterable[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return VERSION + b"\r\n" + head.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


def http_response(payload: bytes) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload


def page_record(page: str, url: str, payload: bytes, sha1: str, first: str | None) -> bytes:
    """The record of a page; ``first`` is the page it revisits."""
    # A line end or a blank at an end would not come back from a header line.
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url)
    block = b"" if first is not None else http_response(payload)
    fields = [
        ("WARC-Type", "response" if first is None else "revisit"),
        ("WARC-Record-ID", ID.format(page, sha1)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{sha1}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if first is not None:
        fields += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", ID.format(first, sha1))]
    return record_bytes(fields, block)


def trained(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary for records like these; None where they are too few or too small to train one."""
    size = min(DICTIONARY_BYTES, sum(map(len, records)) // 10)
    if len(records) < 8 or size < 1024:
        return None
    try:
        return zstandard.train_dictionary(size, records)
    except zstandard.ZstdError:
        return None


class Archive:
    """An archive that is being written."""

    def __init__(self, first_records: list[bytes]) -> None:
        dictionary = trained(first_records)
        self.parts: list[bytes] = []
        if dictionary is not None:
            # The dictionary itself is compressed, which readers must expect.
            body = zstandard.ZstdCompressor().compress(dictionary.as_bytes())
            self.parts.append(struct.pack("<II", DICTIONARY_MAGIC, len(body)) + body)
        self.compressor = zstandard.ZstdCompressor(dict_data=dictionary, write_checksum=True)
        self.size = sum(map(len, self.parts))
        for record in first_records:
            self.add(record)

    def add(self, record: bytes) -> None:
        self.parts.append(self.compressor.compress(record))
        self.size += len(self.parts[-1])


def archives(records: Iterable[bytes]) -> Iterator[bytes]:
    """Records packed into archives; what is held at once is the sample and one compressed archive."""
    sample, size, archive = [], 0, None
    for record in records:
        if archive is None:
            sample.append(record)
            size += len(record)
            if size >= SAMPLE_BYTES:
                archive, sample, size = Archive(sample), [], 0
        else:
            archive.add(record)
        if archive is not None and archive.size >= ARCHIVE_BYTES:
            yield b"".join(archive.parts)
            archive = None
    if sample:
        archive = Archive(sample)
    if archive is not None:
        yield b"".join(archive.parts)


def skippable(data: memoryview, at: int) -> tuple[int, memoryview] | None:
    """Magic number and content of a skippable frame at ``at``."""
    if len(data) - at < 8:
        return None
    magic, size = struct.unpack_from("<II", data, at)
    if not SKIPPABLE_LOW <= magic <= SKIPPABLE_HIGH:
        return None
    if at + 8 + size > len(data):
        raise BadRecord(f"the skippable frame at {at} is cut off")
    return magic, data[at + 8 : at + 8 + size]


def frames(data: bytes) -> Iterator[tuple[int, bytes]]:
    """Place and decoded content of every data frame of an archive."""
    view, at, dictionary = memoryview(data), 0, None
    if (lead := skippable(view, 0)) and lead[0] == DICTIONARY_MAGIC:
        body = bytes(lead[1])
        if body.startswith(ZSTD_MAGIC):
            body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
        dictionary, at = zstandard.ZstdCompressionDict(body), 8 + len(lead[1])
    decoder = zstandard.ZstdDecompressor(dict_data=dictionary)
    while at < len(view):
        if skipped := skippable(view, at):
            at += 8 + len(skipped[1])
            continue
        begun, frame, out = at, decoder.decompressobj(), []
        try:
            while not frame.eof and at < len(view):
                piece = view[at : at + CHUNK]
                out.append(frame.decompress(piece))
                at += len(piece) - len(frame.unused_data)
        except zstandard.ZstdError as error:
            raise BadRecord(f"the frame at {begun} does not decode: {error}") from None
        if not frame.eof:
            raise BadRecord(f"the frame at {begun} is cut off")
        yield begun, b"".join(out)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record that fills ``data``; raises BadRecord with the reason."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not gap or not version.startswith(b"WARC/1."):
        raise BadRecord("no version line or no end of the header")
    fields: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        try:
            key, text = name.decode("ascii"), value.decode("utf-8").strip(" \t")
        except UnicodeDecodeError:
            raise BadRecord("a header line is not text") from None
        if not colon or not key or key != key.strip():
            raise BadRecord(f"a header line without a name: {line[:80]!r}")
        if key.lower() in fields:
            raise BadRecord(f"{key} stands twice")
        fields[key.lower()] = text
    for name in REQUIRED:
        if name.lower() not in fields:
            raise BadRecord(f"no {name}")
    length = fields["content-length"]
    if not (length.isascii() and length.isdigit()):
        raise BadRecord(f"Content-Length is {length!r}")
    size = int(length)
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise BadRecord(f"Content-Length is {size}, the frame holds {len(rest) - 4}")
    return fields, rest[:size]


def http_payload(fields: dict[str, str], block: bytes) -> bytes:
    """The payload of a record: the body of a HTTP response, or the whole block."""
    if not fields.get("content-type", "").startswith("application/http") or fields["warc-type"] == "revisit":
        return block
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"HTTP/"):
        raise BadRecord("the block is no HTTP message")
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip() != b"%d" % len(body):
            raise BadRecord("the Content-Length of the HTTP message is wrong")
    return body


def checked(fields: dict[str, str], block: bytes) -> bytes:
    """The payload, after its digests were compared."""
    payload = http_payload(fields, block)
    found = {"warc-block-digest": block} | ({} if fields["warc-type"] == "revisit" else {"warc-payload-digest": payload})
    for name, data in found.items():
        kind, _, stated = fields.get(name, "").partition(":")
        if kind == "sha1" and stated != digest(data):
            raise BadRecord(f"{name} differs")
    return payload


# --- Spark ---


def with_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, html, the digest (hex SHA-1) and ``first``: the page it revisits; null for a response."""
    payload = whole_text("html").cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long"), whole_text("url").alias("url"), whole_text("html").alias("html")
    ).withColumns({"hex": F.sha1(payload), "size": F.octet_length("html").cast("long")})
    groups = rows.where(F.col("size") >= least).groupBy("hex", "size").agg(F.count("*").alias("n"), F.min("page_id").alias("first"))
    repeated = groups.where((F.col("n") > 1) & F.col("first").isNotNull()).select("hex", "size", "first")
    repeated = materialise(repeated)
    small = broadcast_if_small(repeated)
    keys = ["hex", "size"]
    joined = join_unique(rows, repeated, keys) if small is repeated else rows.join(small, keys, "left")
    return joined.withColumn("first", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> None:
    """Write a record per page to ``*.warc.zst`` archives (named by Spark) in ``folder``."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                rows = zip(batch["page_id"], batch["url"], batch["html"], batch["hex"], batch["first"], strict=True)
                for page, url, html, hexed, first in rows:
                    sha1 = base64.b32encode(bytes.fromhex(hexed)).decode("ascii")
                    yield page_record(page, url, html.encode("utf-8"), sha1, None if pd.isna(first) else first)

        for archive in archives(records()):
            yield pd.DataFrame({"value": [archive]})

    rows = with_revisits(pages, least).select(
        F.coalesce(F.col("page_id").cast("string"), F.lit("null")).alias("page_id"),
        "url", "html", "hex", F.col("first").cast("string").alias("first"),
    )
    packed = rows.mapInPandas(pack, "value binary").select(F.col("value").cast("string").alias("value"))
    packed.write.option("lineSep", EMPTY_FRAME).option("maxRecordsPerFile", 1).text(folder)


RECORDS = (
    "path string, offset long, warc_type string, record_id string, target string, date string,"
    " payload_digest string, refers_to string, payload_bytes long, payload binary, problem string"
)


def read_archives(files: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record of archives given as (path, content).

    ``problem`` tells why a record, or the rest of an archive after a frame that does not decode, is
    invalid; it is null for valid records. Without ``payloads`` they are checked but not returned.
    """

    def rows(path: str, content: bytes) -> Iterator[tuple]:
        offset = 0
        try:
            for offset, data in frames(content):
                fields: dict[str, str] = {}
                try:
                    fields, block = parse_record(data)
                    payload, problem = checked(fields, block), None
                except BadRecord as bad:
                    payload, problem = b"", str(bad)
                name = fields.get
                yield (
                    path, offset, name("warc-type"), name("warc-record-id"), name("warc-target-uri"), name("warc-date"),
                    name("warc-payload-digest"), name("warc-refers-to"), len(payload), payload if payloads else None, problem,
                )
        except (BadRecord, zstandard.ZstdError) as bad:
            yield (path, offset, *[None] * 6, 0, None, str(bad))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [field.split()[0] for field in RECORDS.split(", ")]
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                held, size = [], 0
                for row in rows(path, bytes(content)):
                    held.append(row)
                    size += 300 + (row[8] if payloads else 0)
                    if size >= BATCH_BYTES:
                        yield pd.DataFrame(held, columns=names)
                        held, size = [], 0
                if held:
                    yield pd.DataFrame(held, columns=names)

    return files.select("path", "content").mapInPandas(read, RECORDS)


def archive_files(spark: SparkSession, folder: str) -> DataFrame:
    """The archives of a folder as (path, content). A file above two gigabytes is an error, never skipped."""
    return spark.read.format("binaryFile").load(folder).select("path", "content")


def page_report(records: DataFrame) -> DataFrame:
    """Pages as their records tell: size and digest of the full payload, kind, and the page a revisit refers to.

    A revisit holds no payload: its size is that of the response it refers to. A record with a problem, or a
    revisit whose response is not there, is an error.
    """
    part = lambda name: F.regexp_extract(name, r"^<urn:page:([^:]*):", 1)
    rows = records.select(
        part("record_id").try_cast("long").alias("page_id"),
        "record_id",
        "payload_bytes",
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"),
        F.when(F.col("problem").isNull(), F.col("warc_type"))
        .otherwise(F.raise_error(F.concat(F.lit("bad record: "), F.col("path"), F.lit(": "), F.col("problem"))))
        .alias("record_type"),
        F.col("refers_to").alias("response_id"),
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    responses = rows.where("record_type = 'response'").select(*columns, F.lit(None).cast("long").alias("refers_to"))
    revisits = rows.where("record_type = 'revisit'").drop("payload_bytes")
    wanted = revisits.select(F.col("response_id").alias("record_id")).distinct()
    sizes = rows.where("record_type = 'response'").select("record_id", "payload_bytes")
    sizes = sizes.join(wanted, "record_id", "left_semi").groupBy("record_id").agg(F.max("payload_bytes").alias("payload_bytes"))
    found = join_unique(revisits, sizes.withColumnRenamed("record_id", "response_id"), ["response_id"])
    lost = F.raise_error(F.concat(F.lit("no response for revisit "), F.col("record_id")))
    revisits = found.withColumn("payload_bytes", F.coalesce("payload_bytes", lost.cast("long")))
    return responses.unionByName(revisits.select(*columns, part("response_id").try_cast("long").alias("refers_to")))


def scratch_folder(spark: SparkSession) -> str:
    """A new name in the shared folder that spark.checkpoint.dir names."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/warc-{uuid.uuid4().hex}"
