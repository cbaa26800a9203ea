"""WARC archives: written by Spark's text sink, read by byte ranges.

Written: a gzip member per record. A member ends with the four bytes of its
content's length, whose last is 0 below 16 MiB; the text sink writes that byte
as its line end. A larger record gets an empty member after it, which ends in 0
as well. So archives are plain gzip, on every store, and under Spark's commit
protocol. Of records with equal payloads the one with the smallest id is the
response, the others revisit it.

Read: the text source with the gzip magic as its line end cuts files into byte
ranges; a task has the candidates that start in its range. A candidate is a
member if its header inflates to a WARC header; else it goes on the member
before it. One too short to tell stays open until what follows decides. What a range begins with and cannot place, or leaves open at its
end, is joined to its neighbour's part in a second step.

Null html or url: empty, or left out. Equal rows become equal records, all of
them responses if they have the smallest id; a null id is a revisit where the
payload has an id, else a response. Archives must not be named ``*.gz``: Spark
would inflate such a file whole, in one task.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillflow.llm.shared import slices, stage
from rillflow.session import work_dir

# Start of a gzip member, and names of the format.
MAGIC = b"\x1f\x8b\x08"
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
ID = "urn:page:"

LEVEL = 6
PROBE = 4096


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One gzip member, or two where the first does not end in 0."""
    head = "".join(f"{name}: {value}\r\n" for name, value in headers)
    text = f"{VERSION}\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    packed = _gzip(text)
    return packed if packed[-1] == 0 else packed + _gzip(b"")


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, wbits=31)
    return packer.compress(data) + packer.flush()


def _record(kind: str, page_id: int | None, url: str | None, digest: str, size: int, payload: bytes, first: int | None = None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    headers = [("WARC-Type", kind), ("WARC-Record-ID", f"<{ID}{'' if page_id is None else page_id}>"), ("WARC-Date", DATE)]
    if url:
        headers.append(("WARC-Target-URI", "".join(url.split())))
    headers += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if kind == "revisit":
        headers += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", f"<{ID}{first}>")]
    return _member(headers, http + payload)


def _base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def write_warc(pages: DataFrame, path: str, least_revisit: int = 0) -> None:
    """Archives of ``page_id, url, html``; payloads of fewer than ``least_revisit`` bytes are all responses.

    Tasks compress before the rows move, so the join with the smallest ids
    shuffles about what is written.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html", F.sha1(payload).alias("sha"))
    large = rows.where(F.octet_length(F.coalesce("html", F.lit(""))) >= least_revisit)
    firsts = large.groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("sha", "first")

    def respond(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            out = []
            for row in batch.to_pylist():
                body = (row["html"] or "").encode()
                out.append({
                    "page_id": row["page_id"], "url": row["url"], "sha": row["sha"], "size": len(body),
                    "member": _record("response", row["page_id"], row["url"], _base32(row["sha"]), len(body), body),
                })
            yield pa.RecordBatch.from_pylist(out, pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("sha", pa.string()), ("size", pa.int64()), ("member", pa.binary())]))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "member"):
            lines = []
            for row in batch.to_pylist():
                member, first = row["member"], row["first"]
                if first is not None and row["page_id"] != first and row["size"] >= least_revisit:
                    member = _record("revisit", row["page_id"], row["url"], _base32(row["sha"]), row["size"], b"", first)
                lines.append(member[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary())], names=["line"])

    responses = rows.mapInArrow(respond, "page_id bigint, url string, sha string, size bigint, member binary")
    members = responses.join(firsts, "sha", "left").select("page_id", "url", "sha", "size", "member", "first").mapInArrow(finish, "line binary")
    members.select(F.col("line").cast("string").alias("value")).write.option("lineSep", "\0").text(path)


def _parsed(text: bytes) -> dict | None:
    """Type, ids, digest and payload of a record; None for other kinds of record."""
    head, _, rest = text.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}
    if fields.get("warc-type") not in ("response", "revisit"):
        return None
    block = rest[:int(fields.get("content-length", 0))]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = len(payload)
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if fields["warc-type"] == "revisit":
        lengths = [v for n, _, v in (h.partition(b":") for h in http.split(b"\r\n")) if n.strip().lower() == b"content-length"]
        size = int(lengths[0]) if lengths else 0
        digest = fields.get("warc-payload-digest", "").partition(":")[2] or None
        payload = None
    return {
        "record_type": fields["warc-type"], "page_id": _page(fields.get("warc-record-id")), "refers_to": _page(fields.get("warc-refers-to")),
        "url": fields.get("warc-target-uri"), "payload_bytes": size, "payload_digest": digest, "payload": payload,
    }


def _page(uri: str | None) -> int | None:
    text = (uri or "").strip("<>").removeprefix(ID)
    return int(text) if text.lstrip("-").isdigit() else None


def _starts_member(data: bytes) -> bool | None:
    """Whether what follows a magic is a member's header and inflates to a WARC header; None if it is too short to tell."""
    if data and data[0] & 0xE0:
        return False
    for most in (PROBE, len(data)):
        inflate = zlib.decompressobj(31)
        try:
            text = inflate.decompress(MAGIC + data[:most], 5)
        except zlib.error:
            return False
        if text == b"WARC/":
            return True
        if inflate.eof or not b"WARC/".startswith(text):
            return False
    return None


class _Range:
    """The candidates of one byte range, in order."""

    def __init__(self):
        self.member = None
        self.parts: list[bytes] = []
        self.text: list[bytes] = []
        self.proven = self.placed = False

    def _feed(self, part: bytes) -> bool:
        """Goes on with the open member; False if the data is not its continuation."""
        try:
            self.text.append(self.member.decompress(part))
        except zlib.error:
            return False
        if not self.proven:
            text = b"".join(self.text)[:5]
            if not b"WARC/".startswith(text) or (self.member.eof and text != b"WARC/"):
                return False
            self.proven = text == b"WARC/"
            self.placed |= self.proven
        self.parts.append(part)
        return True

    def _ended(self) -> list[tuple[bytes | None, bytes | None]]:
        if not self.member.eof:
            return []
        self.member = None
        return [(b"".join(self.text), None)]

    def take(self, data: bytes) -> list[tuple[bytes | None, bytes | None]]:
        """Whole records' texts, or parts that belong to the range before, in order.

        A start too short to decide stays open; if it is refused later, the
        parts that followed it are tried anew.
        """
        part = MAGIC + data
        if self.member is not None:
            if self._feed(part):
                return self._ended()
            self.member = None
            if not self.proven:
                again = [*self.parts[1:], part]
                out = self._refused(self.parts[0])
                for other in again:
                    out += self.take(other[len(MAGIC):])
                return out
        starts = _starts_member(data)
        if starts is False:
            return self._refused(part)
        self.member, self.parts, self.text, self.proven = zlib.decompressobj(31), [], [], False
        if not self._feed(part):
            self.member = None
            self.placed |= bool(starts)
            return [] if starts else self._refused(part)
        return self._ended()

    def _refused(self, part: bytes) -> list[tuple[bytes | None, bytes | None]]:
        return [] if self.placed else [(None, part)]

    def add(self, data: bytes) -> tuple[bytes | None, bytes | None]:
        """The first of what ``take`` gives."""
        return next(iter(self.take(data)), (None, None))

    def open_part(self) -> bytes | None:
        return b"".join(self.parts) if self.member is not None else None


_RECORD = pa.schema([
    ("record_type", pa.string()), ("page_id", pa.int64()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("payload", pa.binary()),
    ("path", pa.string()), ("range_start", pa.int64()), ("number", pa.int64()), ("opens", pa.bool_()), ("part", pa.binary()),
])
_RECORD_SQL = (
    "record_type string, page_id bigint, refers_to bigint, url string, payload_bytes bigint, payload_digest string, payload binary,"
    " path string, range_start bigint, number bigint, opens boolean, part binary"
)
RECORD_COLUMNS = _RECORD.names[:7]


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The response and revisit records below ``path``; without ``payloads`` that column is null.

    What tasks found is staged, so that the files are inflated once.
    """
    candidates = (
        spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
        .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("range_start"), F.col("value").cast("binary").alias("data"))
    )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, current, number = None, None, 0

        def left_open():
            part = current.open_part() if current else None
            return [] if part is None else [{"path": here[0], "range_start": here[1], "number": number + 1, "opens": current.proven, "part": part}]

        for batch in slices(batches, "data"):
            out = []
            for path_, start, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (path_, start) != here:
                    out += left_open()
                    here, current, number = (path_, start), _Range(), 0
                    if start == 0:
                        continue  # what stands before the first magic
                for text, before in current.take(data):
                    row = _parsed(text) if text else None
                    if row:
                        out.append(row if payloads else row | {"payload": None})
                    if before is not None:
                        number += 1
                        out.append({"path": path_, "range_start": start, "number": number, "opens": False, "part": before})
            if out:
                yield pa.RecordBatch.from_pylist(out, _RECORD)
        out = left_open()
        if out:
            yield pa.RecordBatch.from_pylist(out, _RECORD)

    found = stage(candidates.mapInArrow(records, _RECORD_SQL), "warc-records")
    in_file = Window.partitionBy("path").orderBy("range_start", "number")
    parts = found.where("part IS NOT NULL").select("path", "range_start", "number", "part", F.sum(F.col("opens").cast("int")).over(in_file).alias("member"))

    def joined(frame: pd.DataFrame) -> pd.DataFrame:
        whole, rows = _Range(), []
        for part in frame.sort_values(["range_start", "number"])["part"]:
            for data in part.split(MAGIC)[1:]:
                rows += [row for text, _ in whole.take(data) if text and (row := _parsed(text))]
        if not payloads:
            rows = [row | {"payload": None} for row in rows]
        return pd.DataFrame(rows, columns=RECORD_COLUMNS).astype({c: "Int64" for c in ("page_id", "refers_to", "payload_bytes")})

    across = parts.groupBy("path", "member").applyInPandas(joined, _RECORD_SQL.partition(", path")[0])
    return found.where("part IS NULL").select(*RECORD_COLUMNS).unionByName(across)


def warc_archive(pages: DataFrame) -> str:
    """Writes the archives below the shared work folder; its path."""
    path = work_dir(pages.sparkSession, "warc")
    write_warc(pages, path)
    return path
