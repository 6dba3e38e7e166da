"""WARC archives: a writer with revisit records and a reader that salvages what damage leaves.

Writer. One gzip member a record. Groups of equal payloads are found on (digest, id) alone; payloads travel once, by (id,
digest), so a page that many urls share is no hot key. Of the rows with equal payloads of at least ``least_bytes`` bytes the one
with the largest id becomes the ``response``; the others become ``revisit`` records that refer to it and hold
no payload. Smaller payloads are all ``response``. Archives are written under a name of the task's
attempt, first beside it and then renamed; the manifest names those of the attempts that count.

Reader. A stream of members (or of plain records). After a failed check (broken gzip data, no version line,
a wrong length, a payload that doesn't have its digest) it looks for the next gzip member or version line that
checks out, goes on there, and logs the bytes between as a quarantined gap. Memory holds one record and one
read block, whatever an archive's size.

Defined results: null payload: empty; null url: no target line; null ids: written as ``null``, read as null; a
null id is the largest only if all ids of its group are null, and then all are responses, as are repeated rows of
the largest id. Line breaks in urls are percent-encoded. Other columns of the input are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import Tables, scratch, uri

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
BLOCK = 1 << 20
MOST = 1 << 32  # bytes of a record that the reader takes for one; twice what a cell can hold
READ_SCHEMA = "kind string, path string, start long, end long, reason string, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def bare_digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to, revisit: bool, date: str) -> bytes:
    """One record, not yet compressed."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["WARC-Payload-Digest: sha1:" + digest, "WARC-Block-Digest: sha1:" + bare_digest(block), "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict | str:
    """The fields of one whole record, or why it fails its checks."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not lines[0].startswith(VERSION) or not mark:
        return "no version line"
    fields = {}
    for line in lines[1:]:
        key, colon, value = line.partition(b":")
        if not colon:
            return "malformed header"
        fields[key.strip().lower()] = value.strip()
    size = fields.get(b"content-length", b"")
    if not size.isdigit() or len(rest) != int(size) + 4 or not rest.endswith(b"\r\n\r\n"):
        return "wrong length"
    block = rest[:-4]
    if fields.get(b"warc-block-digest", b"").decode("ascii", "replace") != "sha1:" + bare_digest(block):
        return "wrong block digest"
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields.get(b"warc-payload-digest", b"").decode("ascii", "replace").removeprefix("sha1:")
    kind = fields.get(b"warc-type", b"").decode("ascii", "replace")
    if kind == "response" and digest != bare_digest(payload):
        return "wrong payload digest"
    length = re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)

    def number(key: bytes) -> int | None:
        found = re.fullmatch(rb"<urn:page:(-?\d+)>", fields.get(key, b""))
        return int(found[1]) if found else None

    url = fields.get(b"warc-target-uri")
    return {"page_id": number(b"warc-record-id"), "url": None if url is None else url.decode("utf-8", "replace"), "record_type": kind, "refers_to": number(b"warc-refers-to"), "payload_bytes": int(length[1]) if length else len(payload), "payload_digest": digest}


class Window:
    """Bytes of a stream from a moving start on; what lies before the start is forgotten."""

    def __init__(self, stream, block: int = BLOCK) -> None:
        self.stream, self.block, self.data, self.base, self.ended = stream, block, bytearray(), 0, False

    def more(self) -> bool:
        got = b"" if self.ended else self.stream.read(self.block)
        self.ended = not got
        self.data += got
        return bool(got)

    def have(self, pos: int, n: int) -> bytes:
        """Up to ``n`` bytes from ``pos`` on."""
        while pos + n > self.base + len(self.data) and self.more():
            pass
        return bytes(self.data[pos - self.base : pos - self.base + n])

    def forget(self, pos: int) -> None:
        if pos - self.base >= self.block:
            del self.data[: pos - self.base]
            self.base = pos


def member(window: Window, pos: int, most: int) -> tuple[bytes, int] | str:
    """The gzip member at ``pos`` and where it ends, or why it can't be read."""
    unzip, out, at, size = zlib.decompressobj(31), [], pos, 0
    while True:
        got = window.have(at, window.block)
        if not got:
            return "truncated member"
        try:
            out.append(unzip.decompress(got, most + 1 - size))
        except zlib.error as error:
            return f"broken member: {str(error)[:60]}"
        size += len(out[-1])
        if size > most:
            return "record too large"
        at += len(got) - len(unzip.unused_data) - len(unzip.unconsumed_tail)
        if unzip.eof:
            return b"".join(out), at


def plain(window: Window, pos: int, most: int) -> tuple[bytes, int] | str:
    """The uncompressed record at ``pos`` and where it ends."""
    n = 4096
    while b"\r\n\r\n" not in (head := window.have(pos, n)):
        if len(head) < n or n > 1 << 20:
            return "header without end"
        n *= 2
    end = head.index(b"\r\n\r\n") + 4
    size = re.search(rb"(?i)\r\ncontent-length: *(\d+)\r\n", head[:end])
    if not size:
        return "no length"
    if (whole := end + int(size[1]) + 4) > most:
        return "record too large"
    data = window.have(pos, whole)
    return (data, pos + whole) if len(data) == whole else "truncated record"


def salvage(stream, most: int = MOST, block: int = BLOCK) -> Iterator[tuple]:
    """("record", start, end, fields) and ("gap", start, end, reason), in order, for all bytes of ``stream``."""
    window, pos, gap, reason = Window(stream, block), 0, None, ""
    while window.have(pos, 1):
        start = window.have(pos, 8)
        got: tuple[bytes, int] | str = "no member or version line"
        if start.startswith(MAGIC):
            got = member(window, pos, most)
        elif start.startswith(VERSION):
            got = plain(window, pos, most)
        fields = parse(got[0]) if isinstance(got, tuple) else got
        if isinstance(fields, dict):
            if gap is not None:
                yield "gap", gap, pos, reason
                gap = None
            yield "record", pos, got[1], fields
            pos = got[1]
            window.forget(pos)
            continue
        if gap is None:
            gap, reason = pos, fields
        pos += 1
        while True:  # the next place where a record may begin
            data = window.have(pos, block)
            marks = [i for i in (data.find(MAGIC), data.find(VERSION)) if i >= 0]
            if marks:
                pos += min(marks)
                break
            if len(data) < block:
                pos += len(data)
                break
            pos += block - 8
            window.forget(pos)
    if gap is not None:
        yield "gap", gap, pos, reason


def plan_records(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least_bytes: int) -> DataFrame:
    """page_id, url, payload, refers_to (null for responses)."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"), F.sha1(payload).alias("digest"))
    tables = Tables(pages.sparkSession)
    members = tables.keep(pages.select(F.col(id_col).cast("long").alias("page_id"), payload.alias("payload")).where(F.octet_length("payload") >= least_bytes).select("page_id", F.sha1("payload").alias("digest")), "members")
    firsts = members.groupBy("digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = tables.keep(firsts.where("n > 1 and first is not null").select("digest", "first"), "firsts")
    others = members.join(firsts, "digest").where(~F.col("page_id").eqNullSafe(F.col("first"))).select(F.col("page_id").alias("p"), F.col("digest").alias("d"), "first").distinct()
    others = tables.keep(others, "others")
    tables.drop("members", "firsts")
    found = rows.join(others.hint("shuffle_hash"), F.col("page_id").eqNullSafe(F.col("p")) & (F.col("digest") == F.col("d")), "left")
    return found.select("page_id", "url", "payload", F.col("first").alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0, archive_bytes: int = 64 << 20, date: str = "1970-01-01T00:00:00Z", level: int = 4) -> DataFrame:
    """Writes the archives of ``pages`` into ``folder`` when run; returns their manifest: path, records, bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        part, number, out = context.partitionId(), 0, None
        done: list[tuple[str, int, int]] = []

        def close() -> None:
            nonlocal out, number
            out.close()
            final = f"{root}/part-{part:06d}-{number:05d}-{context.taskAttemptId()}.warc.gz"
            store.move(temp, final)
            done.append((final, records, size))
            out, number = None, number + 1

        for batch in batches:
            ids, urls, refers = batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), batch.column("refers_to").to_pylist()
            payloads = batch.column("payload")
            for i, page_id in enumerate(ids):
                if out is None:
                    temp = f"{root}/_part-{part:06d}-{number:05d}-{context.taskAttemptId()}"
                    out, records, size = store.open_output_stream(temp, compression=None), 0, 0
                payload = payloads[i].as_py()
                pack = zlib.compressobj(level, zlib.DEFLATED, 31)
                data = pack.compress(record(page_id, urls[i], payload, bare_digest(payload), refers[i], refers[i] is not None, date)) + pack.flush()
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= archive_bytes:
                    close()
        if out is not None:
            close()
        yield pa.RecordBatch.from_pydict({"path": [x[0] for x in done], "records": [x[1] for x in done], "bytes": [x[2] for x in done]}, schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return plan_records(pages, id_col, url_col, payload_col, least_bytes).mapInArrow(run, "path string, records long, bytes long")


def read_archives(paths: DataFrame, folder: str, most: int = MOST) -> DataFrame:
    """Records and gaps (``kind``) of the archives named in column ``path``, in the store of ``folder``."""
    names = [x.split()[0] for x in READ_SCHEMA.split(", ")]

    def rows(found: list[dict]) -> pa.RecordBatch:
        types = {"string": pa.string(), "long": pa.int64()}
        return pa.RecordBatch.from_arrays([pa.array([x.get(n) for x in found], types[t]) for n, t in (x.split() for x in READ_SCHEMA.split(", "))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                if path is None:
                    continue
                found: list[dict] = []
                with store.open_input_stream(path, compression=None) as stream:
                    for kind, start, end, what in salvage(stream, most):
                        found.append({"kind": kind, "path": path, "start": start, "end": end} | (what if kind == "record" else {"reason": what}))
                        if len(found) == 5000:
                            yield rows(found)
                            found = []
                yield rows(found)

    return paths.select("path").mapInArrow(run, READ_SCHEMA)


def round_trip(pages: DataFrame, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Writes ``pages`` to archives in the shared folder, then reads every archive back."""
    spark = pages.sparkSession
    folder = uri(scratch(spark, "warc"))
    manifest = f"{folder}-manifest"
    write_archives(pages, folder, id_col, url_col, payload_col, least_bytes).write.parquet(manifest)
    names = spark.read.parquet(manifest).select("path")
    spread = names.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    whole = F.when(F.col("kind") == "record", True).otherwise(F.raise_error(F.concat(F.lit("an archive has a gap: "), "reason")).cast("boolean"))
    return read_archives(spread, folder).where(whole).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
