"""Writing pages as WARC archives, and a splittable reader of such archives.

Each record is a gzip member of its own. The reader deals byte ranges of the archives to tasks. A task looks for gzip's
magic bytes in its range, takes a candidate for a member only if its beginning decodes to a WARC header, and owns the
records that start inside the range, reading past its end where the last one goes on. So an archive of any size is read
by many tasks, and a lost task is read again by itself.

Archives are in a folder that all executors share. A task writes under a name of its own, and only the names that
successful tasks return are read; what failed or repeated attempts left is never seen.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_at_exit, shared_dir, staged
from .common import join_keys

MAGIC = b"\x1f\x8b\x08"
#: Bytes of a range; bytes after which a task begins another archive; bytes read at a time.
SPLIT, ARCHIVE, CHUNK = 4 << 20, 256 << 20, 1 << 18
#: Smaller payloads are always stored.
REVISIT_FROM = 1000
DATE = "2020-01-01T00:00:00Z"
NO_PAGE = uuid.UUID(int=(1 << 128) - 1)
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def record_id(page: int | None) -> str:
    """An id from which the page's number can be read again."""
    return f"<urn:uuid:{NO_PAGE if page is None else uuid.UUID(int=page + (1 << 63))}>"


def page_of(record: str | None) -> int | None:
    if not record:
        return None
    value = uuid.UUID(record.strip("<>").rpartition(":")[2])
    return None if value == NO_PAGE else value.int - (1 << 63)


def header_value(text: str | None) -> str:
    """A value without line ends, which would end the header line."""
    return "".join(c if " " <= c != "\x7f" else f"%{ord(c):02X}" for c in text or "")


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record, or a revisit of the page ``refers_to`` with the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page)}", f"WARC-Target-URI: {header_value(url)}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def chosen(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) as page_id, url, payload, digest, refers_to."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload")})
    # A narrow row for each payload that occurs more than once; heavy ones (error pages) are dealt to all tasks.
    large = (F.col("size") >= REVISIT_FROM) & F.col("page_id").isNotNull()
    groups = staged(rows.select("page_id", "digest", "size").where(large).groupBy("digest", "size").agg(F.max("page_id").alias("stored"), F.count("*").alias("copies")), "digests")
    total = groups.agg(F.sum("copies")).first()[0] or 0
    # Rows that no group can have meet none: their own hash stands for the digest in the join.
    keyed = rows.withColumns({"full": F.col("digest"), "digest": F.when(large, F.col("digest")).otherwise(F.hex(F.xxhash64("page_id", "url")))})
    joined = join_keys(keyed, groups.where("copies > 1"), ["digest", "size"], "copies", total, F.xxhash64("page_id", "url"), "left")
    return joined.select("page_id", "url", "payload", F.col("full").alias("digest"), F.when(F.col("stored") != F.col("page_id"), F.col("stored")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Writes a record for each row of ``pages`` into ``folder``; returns path and bytes of the archives that count."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out = path = None
        done = []
        for batch in batches:
            for page, url, payload, digest, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to")), strict=True):
                if out is None:
                    path = f"{root.rstrip('/')}/{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(path, compression=None)  # the records are members of their own
                out.write(gzip_member(record(page, url, payload, digest, refers_to), level))
                if out.tell() >= ARCHIVE:
                    done.append((path.rpartition("/")[2], out.tell()))
                    out.close()
                    out = None
        if out is not None:
            done.append((path.rpartition("/")[2], out.tell()))
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], ["name", "bytes"])

    names = staged(chosen(pages).mapInArrow(write, "name string, bytes long"), "archives")
    return names.select(F.concat(F.lit(folder.rstrip("/") + "/"), "name").alias("path"), "bytes")


class Range:
    """A file's bytes from ``at`` on, read in chunks as they are needed."""

    def __init__(self, file, size: int, at: int):
        self.file, self.size, self.base, self.data = file, size, at, b""

    def fill(self, upto: int) -> bool:
        """Whether there are bytes up to offset ``upto``."""
        while self.base + len(self.data) < min(upto, self.size):
            self.file.seek(self.base + len(self.data))
            more = self.file.read(max(CHUNK, min(upto, self.size) - self.base - len(self.data)))
            if not more:
                break
            self.data += more
        return self.base + len(self.data) >= upto

    def forget(self, at: int) -> None:
        if at - self.base > CHUNK:
            self.data, self.base = self.data[at - self.base :], at

    def find(self, at: int, end: int) -> int:
        """The first magic bytes that start in [at, end), or -1."""
        while at < end:
            self.forget(at)
            stop = min(end, at + CHUNK)
            self.fill(stop + len(MAGIC) - 1)
            found = self.data.find(MAGIC, at - self.base, stop - self.base + len(MAGIC) - 1)
            if found >= 0:
                return self.base + found
            at = stop
        return -1

    def member(self, at: int) -> tuple[bytes, int] | None:
        """The content of the member that starts at ``at``, if it is a WARC record, and where the member ends."""
        z, out, pos = zlib.decompressobj(31), bytearray(), at
        try:
            while not z.eof:
                if not self.fill(pos + 1):
                    return None
                step = self.data[pos - self.base : pos - self.base + CHUNK]
                out += z.decompress(step)
                pos += len(step)
                if len(out) >= 7 and not out.startswith(b"WARC/1."):
                    return None
        except zlib.error:
            return None
        return (bytes(out), pos - len(z.unused_data)) if out.startswith(b"WARC/1.") else None


def parsed(content: bytes) -> tuple[dict[str, str], bytes] | None:
    """A record's header fields (names in lower case) and block; None if they don't hold together."""
    head, gap, rest = content.partition(b"\r\n\r\n")
    fields = dict((k.strip().lower(), v.strip()) for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:]))
    length = fields.get("content-length", "")
    return (fields, rest[: int(length)]) if gap and length.isdigit() and len(rest) >= int(length) else None


def records_in(store: fs.FileSystem, path: str, size: int, start: int, end: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records that start in [start, end) of an archive."""
    with store.open_input_file(path) as file:
        data, at = Range(file, size, start), start
        while (at := data.find(at, end)) >= 0:
            got = data.member(at)
            record = parsed(got[0]) if got else None
            if record:
                yield record
            at = got[1] if record else at + 1


def row_of(fields: dict[str, str], block: bytes) -> tuple:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) of a record of pages."""
    import hashlib

    head, _, payload = block.partition(b"\r\n\r\n")
    http = dict((k.strip().lower(), v.strip()) for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:]))
    kind = fields.get("warc-type")
    if kind == "revisit":
        size, digest = int(http.get("content-length", 0)), base64.b32decode(fields["warc-payload-digest"].rpartition(":")[2]).hex()
    else:
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    return page_of(fields.get("warc-record-id")), fields.get("warc-target-uri"), size, digest, kind, page_of(fields.get("warc-refers-to")), payload


def read_archives(archives: DataFrame, split: int = SPLIT, payload: bool = False) -> DataFrame:
    """The records of ``archives`` (path, bytes), read by ranges of ``split`` bytes; with their payloads if asked for."""
    spark = archives.sparkSession
    ranges = archives.where("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0), F.col("bytes") - 1, F.lit(split))).alias("start"))
    dealt = ranges.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    schema = RECORDS + (", payload binary" if payload else "")
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], types[i]) for i in range(len(names))], names)

        for batch in batches:
            for path, size, start in zip(*(batch.column(c).to_pylist() for c in ("path", "bytes", "start")), strict=True):
                store, root = fs.FileSystem.from_uri(path)
                rows, held = [], 0
                for fields, block in records_in(store, root, size, start, min(size, start + split)):
                    rows.append(row_of(fields, block))
                    held += len(block)
                    if len(rows) == 1000 or held > 8 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
                yield batch_of(rows)

    return dealt.mapInArrow(read, schema)


def round_trip(pages: DataFrame, split: int = SPLIT, payload: bool = False) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as archives into the shared folder and reads them back.

    Per row: page_id, url, payload_bytes, payload_digest, record_type, refers_to. Of equal payloads of at least 1000
    bytes the one with the largest page_id is stored as a response and the others revisit it.

    Edge cases: null and empty html are empty payloads; a null url reads back as empty; control characters in urls are
    percent-encoded; rows without page_id are responses; rows repeated with one page_id are written as often as they
    come; an empty table gives no rows; other columns are ignored.
    """
    folder = f"{shared_dir(pages.sparkSession)}/siftwork/warc-{uuid.uuid4().hex}"
    archives = write_archives(pages, folder)
    drop_at_exit(pages.sparkSession, folder)
    return read_archives(archives, split, payload)
