"""WARC archives: writing, normalising monolithic gzip files, reading by offset.

A writer task puts its pages into archives of one gzip stream each, the way a careless
crawler does: nothing in such a file can be reached without inflating all before it. The
normaliser inflates an archive once as a stream and rewrites every record as a gzip member
of its own, beside a sidecar index of (offset, length, page). While it does, records whose
payload an earlier page has become revisit records without payload.

Files are named after partitions and moved into place when whole, so a task that runs again
after an executor is lost writes the same files again. They lie in a folder that all
executors share, reached through Arrow's file systems (file:, hdfs:, s3:, gs:).
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmetrics.llm.common import new_path, order_id, written

LEVEL = 3
ARCHIVE_BYTES = 1 << 30
CHUNK = 1 << 20
#: Payloads of fewer bytes are never revisits.
MIN_REVISIT_BYTES = 0
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _files(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(archive: str, ordinal: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{ordinal}')}>"


def _head(first: str, fields: list[tuple[str, object]]) -> bytes:
    lines = [first] + [f"{name}: {str(value)}" for name, value in fields if value is not None]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _uri(url: str | None, page_id: int | None) -> str:
    """The url without what would break a header line."""
    if not url:
        return f"urn:page:{page_id}"
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def response_record(archive: str, ordinal: int, page_id: int | None, url: str | None, payload: bytes, digest: str) -> bytes:
    http = _head("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))])
    head = _head(
        "WARC/1.1",
        [
            ("WARC-Type", "response"),
            ("WARC-Record-ID", record_id(archive, ordinal)),
            ("WARC-Date", DATE),
            ("WARC-Target-URI", _uri(url, page_id)),
            ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("Page-ID", page_id),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", len(http) + len(payload)),
        ],
    )
    return head + http + payload + b"\r\n\r\n"


class Inflater:
    """Reads a gzip file of one or many members as one stream of lines and bytes."""

    def __init__(self, raw):
        self.raw, self.buffer, self.z, self.done = raw, bytearray(), zlib.decompressobj(31), False

    def _more(self) -> bool:
        if self.done:
            return False
        data = self.z.unconsumed_tail or self.raw.read(CHUNK)
        if not data:
            if not self.z.eof:
                raise ValueError("the archive ends within a gzip member")
            self.done = True
            return False
        while data:
            if self.z.eof:
                self.z = zlib.decompressobj(31)
            self.buffer += self.z.decompress(data, 8 * CHUNK)
            if self.z.eof:
                data = self.z.unused_data
                if not data:
                    data = self.raw.read(CHUNK)
                    if not data:
                        self.done = True
            else:
                break
        return True

    def line(self) -> bytes:
        while (at := self.buffer.find(b"\r\n")) < 0:
            if not self._more():
                if self.buffer:
                    raise ValueError("the archive ends within a header line")
                return b""
        out = bytes(self.buffer[: at + 2])
        del self.buffer[: at + 2]
        return out

    def pieces(self, n: int) -> Iterator[bytes]:
        """The next n bytes, in pieces of a bounded size."""
        while n:
            if not self.buffer and not self._more():
                raise ValueError("the archive ends within a record")
            part = bytes(self.buffer[: min(n, CHUNK)])
            del self.buffer[: len(part)]
            n -= len(part)
            yield part

    def head(self) -> tuple[bytes, list[tuple[str, str]]] | None:
        """First line and fields of a header block; None at the end of the archive."""
        first = self.line()
        while first == b"\r\n":
            first = self.line()
        if not first:
            return None
        fields = []
        while (line := self.line()) != b"\r\n":
            if not line:
                raise ValueError("the archive ends within a header")
            name, _, value = line.decode().partition(":")
            fields.append((name, value.strip()))
        return first.rstrip(b"\r\n"), fields


class Member:
    """One gzip member being written; size is what has come out so far."""

    def __init__(self, out, level: int):
        self.out, self.z, self.size = out, zlib.compressobj(level, zlib.DEFLATED, 31), 0

    def write(self, data: bytes) -> None:
        self._put(self.z.compress(data))

    def close(self) -> None:
        self._put(self.z.flush())

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)


def _write_archives(path: str, level: int, archive_bytes: int):
    """Pages to monolithic archives; a row for each record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        files, root = _files(path)
        number = ordinal = size = 0
        member = out = name = None
        temp = f"{root}/.raw-{task.taskAttemptId()}"

        def finish() -> None:
            member.close()
            out.close()
            files.move(temp, f"{root}/{name}")

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = []
                for page_id, url, html in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True):
                    if member is None or size >= archive_bytes:
                        if member is not None:
                            finish()
                        name = f"raw-{task.partitionId():06d}-{number:04d}.warc.gz"
                        out = files.open_output_stream(temp, compression=None)
                        member, number, ordinal, size = Member(out, level), number + 1, 0, 0
                    payload = (html or "").encode("utf-8", "surrogatepass")
                    digest = payload_digest(payload)
                    record = response_record(name, ordinal, page_id, url, payload, digest)
                    member.write(record)
                    rows.append((name, ordinal, page_id, len(payload), digest))
                    ordinal, size = ordinal + 1, size + len(record)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                    ["archive", "ordinal", "page_id", "payload_bytes", "payload_digest"],
                )
        if member is not None:
            finish()

    return run


def write_archives(pages: DataFrame, path: str, page_col: str = "page_id", url_col: str = "url", html_col: str = "html", level: int = LEVEL, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write each partition of pages as monolithic archives. Returns a row per record: archive,
    ordinal (its place there), page_id, payload_bytes, payload_digest."""
    files, root = _files(path)
    files.create_dir(root, recursive=True)
    own = pages.select(
        F.col(page_col).cast("long"), F.col(url_col).cast("string"), F.col(html_col).cast("string")
    )
    schema = "archive string, ordinal long, page_id long, payload_bytes long, payload_digest string"
    return written(own.mapInArrow(_write_archives(path, level, archive_bytes), schema), "warc-records")


def mark_revisits(records: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Add first_archive, first_ordinal and refers_to: the record of the least page_id with the
    same payload, null for that record itself and for payloads under min_bytes. Pages without an
    id come last; among equal ids the record that comes first in the archives."""
    place = F.struct(order_id(F.col("page_id")).alias("at"), "archive", "ordinal", "page_id")
    firsts = (
        records.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select("payload_digest", "first")
    )
    # a table, so that both sides of the join are plain exchanges: a digest that a third of the
    # pages share is then split by adaptive execution
    firsts = written(firsts, "warc-firsts")
    own = (F.col("first.archive") == F.col("archive")) & (F.col("first.ordinal") == F.col("ordinal"))
    first = F.when(~own, F.col("first"))
    return records.join(firsts, "payload_digest", "left").select(
        "archive",
        "ordinal",
        first["archive"].alias("first_archive"),
        first["ordinal"].alias("first_ordinal"),
        first["page_id"].alias("refers_to"),
    )


def normalise(raw_file, out, index, level: int, revisits: dict[int, tuple[str, int, int | None]]) -> int:
    """Rewrite the records of an open monolithic archive as members of out, and their places to
    index. revisits: by ordinal, the record referred to. Returns the number of records."""
    stream, offset, ordinal = Inflater(raw_file), 0, 0
    while head := stream.head():
        first, fields = head
        length = int(dict(fields)["Content-Length"])
        member, target = Member(out, level), revisits.get(ordinal)
        page = dict(fields).get("Page-ID", "")
        if target is None:
            member.write(_head(first.decode(), fields))
            for part in stream.pieces(length):
                member.write(part)
        else:
            before = length
            status, http = stream.head()
            block = _head(status.decode(), http)
            before -= len(block)
            for _ in stream.pieces(before):
                pass
            changed = {"WARC-Type": "revisit", "Content-Length": len(block)}
            fields = [(k, changed.get(k, v)) for k, v in fields]
            fields += [
                ("WARC-Profile", PROFILE),
                ("WARC-Refers-To", record_id(target[0], target[1])),
                ("Refers-To-Page-ID", target[2]),
            ]
            member.write(_head(first.decode(), fields) + block)
        member.write(b"\r\n\r\n")
        member.close()
        index.write(f"{offset}\t{member.size}\t{page}\n".encode())
        offset += member.size
        ordinal += 1
    return ordinal


def _normalise_group(path: str, level: int, keep_raw: bool):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        files, root = _files(path)
        archive = rows["archive"].iloc[0]
        name = archive.replace("raw-", "members-")
        done = pd.DataFrame({"archive": [name], "records": [len(rows)]})
        from pyarrow import fs

        if files.get_file_info(f"{root}/{archive}").type == fs.FileType.NotFound:
            # an earlier attempt had finished, index and all, before its result was lost
            assert files.get_file_info(f"{root}/{name}").type == fs.FileType.File, archive
            return done
        marked = rows[rows["first_archive"].notna()]
        revisits = {
            int(o): (a, int(f), None if pd.isna(r) else int(r))
            for o, a, f, r in zip(marked["ordinal"], marked["first_archive"], marked["first_ordinal"], marked["refers_to"], strict=True)
        }
        temp = f"{root}/.{name}-{TaskContext.get().taskAttemptId()}"
        with (
            files.open_input_stream(f"{root}/{archive}", compression=None) as raw,
            files.open_output_stream(temp, compression=None) as out,
            files.open_output_stream(f"{temp}.idx", compression=None) as index,
        ):
            records = normalise(raw, out, index, level, revisits)
        assert records == len(rows), f"{archive}: {records} records, {len(rows)} written"
        files.move(f"{temp}.idx", f"{root}/{name}.idx")
        files.move(temp, f"{root}/{name}")
        if not keep_raw:
            files.delete_file(f"{root}/{archive}")
        return done

    return run


def normalise_archives(marked: DataFrame, path: str, level: int = LEVEL, keep_raw: bool = False) -> DataFrame:
    """Normalise every archive that marked has records of. Returns archive and records."""
    archives = marked.select("archive").distinct().count()
    spread = marked.repartition(max(1, 4 * archives), "archive")
    done = spread.groupBy("archive").applyInPandas(
        _normalise_group(path, level, keep_raw), "archive string, records long"
    )
    return written(done, "warc-archives")


def _read_members(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _files(path)
        open_name = source = None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = []
                for archive, offset, length in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True):
                    if archive != open_name:
                        if source is not None:
                            source.close()
                        open_name, source = archive, files.open_input_file(f"{root}/{archive}")
                    source.seek(offset)
                    rows.append(read_record(source.read(length)))
                names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
                types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[n] for r in rows], t) for n, t in zip(names, types, strict=True)], names
                )

    return run


def read_record(member: bytes) -> dict:
    """A record from its gzip member. The digest of a response is computed from its payload and
    must be the one that its header states."""
    data = zlib.decompress(member, 31)
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = block[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    http_fields = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    response = fields["WARC-Type"] == "response"
    if response and payload_digest(payload) != stated:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not have its digest")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("Page-ID"),
        "url": fields["WARC-Target-URI"],
        "record_type": fields["WARC-Type"],
        "refers_to": number("Refers-To-Page-ID"),
        "payload_bytes": len(payload) if response else int(http_fields["Content-Length"]),
        "payload_digest": stated,
        "payload": payload if response else None,
    }


def read_archives(spark, path: str) -> DataFrame:
    """All records of the normalised archives in a folder, each read by its offset."""
    index = spark.read.text(f"{path}/*.idx")
    parts = F.split("value", "\t")
    places = index.select(
        F.regexp_replace(F.element_at(F.split(F.input_file_name(), "/"), -1), r"\.idx$", "").alias("archive"),
        parts[0].cast("long").alias("offset"),
        parts[1].cast("long").alias("length"),
    )
    schema = (
        "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
        "payload_digest string, payload binary"
    )
    archives = index.select(F.input_file_name()).distinct().count()
    places = places.repartition(max(1, 4 * archives), "archive").sortWithinPartitions("archive", "offset")
    return places.mapInArrow(_read_members(path), schema)


def round_trip(pages: DataFrame, path: str | None = None, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write pages as archives, normalise these with revisits, and read all records back.

    A null html is an empty payload; a null url gets a urn of the page; a null page_id stays
    null and comes last in the order of pages. Repeated rows are records of their own, and of
    equal payloads only one is a response. An empty table gives no rows. Other columns of
    pages are left out.
    """
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    records = write_archives(pages, path)
    if records.isEmpty():
        return spark.createDataFrame([], "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary")
    normalise_archives(mark_revisits(records, min_bytes), path)
    return read_archives(spark, path)


def digest(pages: DataFrame) -> DataFrame:
    return round_trip(pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
         sha1(coalesce(html, '')) AS hex, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages
), d AS (
  SELECT *, list_transform(range(0, 8),
    lambda g: ('0x' || substr(hex, g * 5 + 1, 5))::BIGINT) AS groups FROM p
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + ((groups[1 + i // 4] >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM d
"""
