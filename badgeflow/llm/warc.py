"""WARC archives: written one gzip member per record, read back in sequence.

An archive is a run of bytes of bounded size (a larger record gets one of its own),
held as a row (archive, data), so that any store Spark can write holds it. Archives
that lie as files are read through Spark's binary source. The reader takes the bytes
in small pieces: one zlib stream per member, header lines, Content-Length bytes of
block, the closing blank lines, and the end of the member; digests are verified.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from badgeflow.llm.common import stored, table

ARCHIVE_BYTES = 4 << 20
PIECE = 64 << 10
DATE = "2024-01-01T00:00:00Z"
GZIP = 31  # zlib's window bits for a gzip member
SALTS = 32

ARCHIVES = "archive string, n_records int, data binary"
RECORDS = """
    archive string, number int, page_id bigint, url string, payload_bytes bigint, payload_digest string,
    record_type string, refers_to bigint, payload binary
"""


class WarcError(ValueError):
    """Bytes that are no well-formed, undamaged archive."""


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None) -> str:
    """A version 8 UUID that holds the page's number, so references lead back to it."""
    low = 0 if page_id is None else page_id & (1 << 64) - 1
    middle = 4 if page_id is None else low >> 62
    value = int.from_bytes(b"page\0\0", "big") << 80 | 8 << 76 | middle << 64 | 2 << 62 | low & (1 << 62) - 1
    return f"<urn:uuid:{uuid.UUID(int=value)}>"


def page_of(identifier: str | None) -> int | None:
    if not identifier:
        return None
    value = uuid.UUID(identifier.strip("<>").removeprefix("urn:uuid:")).int
    middle = value >> 64 & 0xFFF
    if middle & 4:
        return None
    low = (middle & 3) << 62 | value & (1 << 62) - 1
    return low - (1 << 64) if low >> 63 else low


def record(headers: list[tuple[str, str]], block: bytes, level: int = 6) -> bytes:
    """One record as one gzip member."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers)]
    lines += [f"WARC-Block-Digest: sha1:{digest(block)}", f"Content-Length: {len(block)}", "", ""]
    squeeze = zlib.compressobj(level, zlib.DEFLATED, GZIP)
    return squeeze.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + squeeze.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response, or a revisit of the response of page ``refers_to``: then the HTTP
    header alone is kept, which still tells the payload's length."""
    revisit = refers_to is not None
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if revisit:
        headers.append(("WARC-Refers-To", record_id(refers_to)))
        headers.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return record(headers, http.encode() + (b"" if revisit else payload))


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes


class Reader:
    """Records of one archive, from its bytes in pieces of any size."""

    def __init__(self, pieces: Iterable[bytes]):
        self.pieces = iter(pieces)
        self.left = b""

    def _member(self) -> Iterator[bytes]:
        """The decompressed bytes of the next gzip member, as they come."""
        stream, piece, self.left = zlib.decompressobj(GZIP), self.left, b""
        while not stream.eof:
            piece = piece or next(self.pieces, b"")
            try:
                data = stream.decompress(piece, PIECE)
            except zlib.error as error:
                raise WarcError(f"damaged gzip member: {error}") from error
            if not piece and not data:
                raise WarcError("the archive ends within a record")
            piece = stream.unconsumed_tail
            if data:
                yield data
        self.left = stream.unused_data

    def __iter__(self) -> Iterator[Record]:
        while True:
            while not self.left:
                piece = next(self.pieces, None)
                if piece is None:
                    return
                self.left = piece
            yield self._record()

    def _record(self) -> Record:
        data, member = bytearray(), self._member()
        while (end := data.find(b"\r\n\r\n")) < 0:
            if (more := next(member, None)) is None:
                raise WarcError("no end of the record's header")
            data += more
        version, *lines = bytes(data[:end]).decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise WarcError(f"not a record: {version[:40]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        if not headers.get("content-length", "").isdigit():
            raise WarcError("no Content-Length")
        size = int(headers["content-length"])
        del data[: end + 4]
        for more in member:
            data += more
            if len(data) > size + 4:
                raise WarcError("the member goes on after the record's end")
        if len(data) != size + 4 or data[size:] != b"\r\n\r\n":
            raise WarcError("the block's length is not Content-Length")
        block = bytes(data[:size])
        if headers.get("warc-block-digest", f"sha1:{digest(block)}") != f"sha1:{digest(block)}":
            raise WarcError("the block does not fit its digest")
        return Record(headers, block)


def page_row(found: Record) -> tuple:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload)."""
    headers = found.headers
    kind, claimed = headers["warc-type"], headers.get("warc-payload-digest", "").removeprefix("sha1:")
    http, _, payload = found.block.partition(b"\r\n\r\n")
    sizes = [v for k, _, v in (line.partition(b":") for line in http.split(b"\r\n")) if k.lower() == b"content-length"]
    size = int(sizes[0]) if sizes else len(payload)
    if kind == "response" and (len(payload) != size or digest(payload) != claimed):
        raise WarcError("the payload does not fit its length or digest")
    return (
        page_of(headers.get("warc-record-id")),
        headers.get("warc-target-uri"),
        size,
        claimed,
        kind,
        page_of(headers.get("warc-refers-to")),
        payload if kind == "response" else None,
    )


def first_pages(pages: DataFrame, salts: int = SALTS) -> DataFrame:
    """Pages with ``refers_to``: of equal payloads, the smallest page_id.

    Counted before the join, and joined only for payloads that repeat; their keys are
    salted, so copies of one payload, however many, go to ``salts`` tasks.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.coalesce("html", F.lit("")).alias("html"),
        F.sha1(F.encode(F.coalesce("html", F.lit("")), "UTF-8")).alias("sha1"),
    ).withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int"))
    repeated = (
        rows.groupBy("sha1")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 AND first IS NOT NULL")
        .select("sha1", "first", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    )
    again = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    return rows.join(repeated, ["sha1", "salt"], "left").select(
        "page_id", "url", "html", F.when(again, F.col("first")).alias("refers_to")
    )


def write_archives(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """(archive, n_records, data) for pages with ``refers_to``; each task writes its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number, members, held = TaskContext.get().partitionId(), 0, [], 0

        def close() -> pa.RecordBatch:
            name = f"pages-{task:06d}-{number:06d}.warc.gz"
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([len(members)], pa.int32()), pa.array([b"".join(members)], pa.binary())],
                ["archive", "n_records", "data"],
            )

        for batch in batches:
            for page_id, url, html, refers_to in zip(*(batch[c] for c in range(4))):
                payload = html.as_py().encode()
                members.append(page_record(page_id.as_py(), url.as_py(), payload, refers_to.as_py()))
                held += len(members[-1])
                if held >= archive_bytes:
                    yield close()
                    number, members, held = number + 1, [], 0
        if members:
            yield close()

    return pages.select("page_id", "url", "html", "refers_to").mapInArrow(run, ARCHIVES)


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The page records of (archive, data), verified; damage raises WarcError.

    Records of other types are passed over. ``payloads=False`` leaves payload NULL.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        names = ["archive", "number", "page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            for archive, data in zip(batch[0].to_pylist(), batch[1]):
                view, rows, held = data.as_buffer(), [], 0
                pieces = (view.slice(at, min(PIECE, view.size - at)).to_pybytes() for at in range(0, view.size, PIECE))
                for number, found in enumerate(Reader(pieces)):
                    if found.headers.get("warc-type") not in ("response", "revisit"):
                        continue
                    row = page_row(found)
                    rows.append((archive, number, *row[:6], row[6] if payloads else None))
                    held += len(found.block) if payloads else 0
                    if held > ARCHIVE_BYTES or len(rows) >= 10_000:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return archives.select("archive", "data").mapInArrow(run, RECORDS)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """The page records of archives that lie as files under ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(path)
    return read_archives(files.select(F.col("path").alias("archive"), F.col("content").alias("data")))


def archive_pages(pages: DataFrame) -> DataFrame:
    """Archives of all pages, in the cluster's shared folder.

    NULL html is an empty payload, and a NULL url is left out. Pages that repeat a
    payload are revisits of the one with the smallest page_id; pages without an id
    never are that one, and are responses if no page with an id has their payload.
    Repeated rows of the smallest page_id are all responses.
    """
    return stored(write_archives(first_pages(pages)), "warc")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written to archives and read back."""
    records = read_archives(archive_pages(table(spark, sf_dir, "pages")), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
