"""WARC archives: a writer with one gzip member per record, and a reader that salvages.

The reader checks each member (gzip CRC and length) and each record (version line, Content-Length,
block digest, closing line ends). After a failed check it searches on from the next byte for the next
gzip magic or version line where a whole member or record passes every check again, goes on there, and
logs the bytes in between as a quarantined gap. Members are parsed to their end, however many records
they hold, and plain records and members may follow each other in one file.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import shared_input, shared_output, text_or_empty, written
from quarterline.session import scratch_path

# Fixed values of the format.
VERSION = b"WARC/1.1"
GZIP_MAGIC = b"\x1f\x8b\x08"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")

_RECORD = ("path string, start long, end long, record_type string, page_id long, refers_to long, url string, "
           "payload binary, payload_bytes long, payload_digest string, gap string")
_RECORD_T = pa.schema([("path", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("record_type", pa.string()),
                       ("page_id", pa.int64()), ("refers_to", pa.int64()), ("url", pa.string()),
                       ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                       ("gap", pa.string())])


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None,
                 revisit: bool = False) -> bytes:
    """One WARC record; a revisit holds the HTTP head of the page and no payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    name = "none" if page_id is None else str(page_id)
    head = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{name}>",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}",
            "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
            f"WARC-Block-Digest: sha1:{sha1_base32(block)}"]
    if revisit:
        to = "none" if refers_to is None else str(refers_to)
        head += [f"WARC-Refers-To: <urn:page:{to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return VERSION + b"\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data, start: int = 0) -> tuple[dict, int]:
    """The record at ``start`` and its end; ValueError names the failed check."""
    if not _VERSION_LINE.match(data, start):
        raise ValueError("version line")
    head_end = data.find(b"\r\n\r\n", start)
    if head_end < 0:
        raise ValueError("header end")
    fields = {}
    for line in bytes(data[start:head_end]).split(b"\r\n")[1:]:
        k, sep, v = line.partition(b": ")
        if not sep:
            raise ValueError("header line")
        fields[k.decode("latin-1").lower()] = v.decode("utf-8", "replace")
    if not fields.get("content-length", "").isdigit():
        raise ValueError("content length")
    end = head_end + 4 + int(fields["content-length"])
    block = bytes(data[head_end + 4:end])
    if len(block) != int(fields["content-length"]) or bytes(data[end:end + 4]) != b"\r\n\r\n":
        raise ValueError("record end")
    if fields.get("warc-block-digest", "") != f"sha1:{sha1_base32(block)}":
        raise ValueError("block digest")
    http, sep, payload = block.partition(b"\r\n\r\n")
    length = re.search(rb"(?i)^content-length: *(\d+) *$", http, re.M)
    said = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    kind = fields.get("warc-type", "")
    if kind == "response" and sha1_base32(payload) != said:
        raise ValueError("payload digest")
    number = lambda name: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(name, ""))) else None
    return {"record_type": kind, "page_id": number("warc-record-id"), "refers_to": number("warc-refers-to"),
            "url": fields.get("warc-target-uri"), "payload": payload if kind == "response" else None,
            "payload_bytes": len(payload) if kind == "response" else int(length[1]) if length else None,
            "payload_digest": said}, end + 4


def _member(data, start: int) -> tuple[list[tuple[dict | None, str | None]], int]:
    """What the gzip member at ``start`` holds, parsed to its end, and the member's end: (record, None) for every valid
    record and (None, failed check) for every stretch in between; ValueError if the member has no valid record."""
    d = zlib.decompressobj(31)
    out, at = [], start
    try:
        while not d.eof and at < len(data):
            out.append(d.decompress(bytes(data[at:at + 65536])))
            at += 65536
    except zlib.error as e:
        raise ValueError("gzip member") from e
    if not d.eof:
        raise ValueError("gzip member cut off")
    whole = b"".join(out)
    found, place, lost = [], 0, None
    while place < len(whole):
        try:
            record, end = parse_record(whole, place)
        except ValueError as e:
            lost = lost or f"{e} in a member"
            m = _VERSION_LINE.search(whole, place + 1)
            if m is None:
                break
            place = m.start()
            continue
        if lost:
            found.append((None, lost))
            lost = None
        found.append((record, None))
        place = end
    if lost:
        found.append((None, lost))
    if not any(r for r, _ in found):
        raise ValueError(found[0][1].removesuffix(" in a member") if found else "empty member")
    return found, min(at, len(data)) - len(d.unused_data)


def _next_start(data, at: int) -> int:
    """The next place where a member or a version line may begin; -1 if there is none."""
    magic, line = data.find(GZIP_MAGIC, at), _VERSION_LINE.search(data, at)
    if line is None:
        return magic
    return line.start() if magic < 0 else min(magic, line.start())


def salvage(data) -> Iterator[tuple[int, int, dict | None, str | None]]:
    """(start, end, record, None) for each valid record, (start, end, None, failed check) for each gap.

    Files may mix gzip members of one or more records with plain records: after a failed check the search goes
    on at the next gzip magic or version line, whichever comes first. Records and gaps inside a member have the
    member's start and end. An empty file has neither."""
    at, size = 0, len(data)
    lost, why = None, None
    while at < size:
        try:
            if bytes(data[at:at + 3]) == GZIP_MAGIC:
                found, end = _member(data, at)
            else:
                record, end = parse_record(data, at)
                found = [(record, None)]
        except ValueError as e:
            if lost is None:
                lost, why = at, str(e)
            at = _next_start(data, at + 1)
            if at < 0:
                break
            continue
        if lost is not None:
            yield lost, at, None, why
            lost = None
        for record, reason in found:
            yield at, end, record, reason
        at = end
    if lost is not None:
        yield lost, size, None, why


def whole_archives(records: DataFrame) -> DataFrame:
    """The records of archives that must be undamaged: a quarantined gap is an error, not a missing row."""
    message = F.concat(F.lit("archive "), F.col("path"), F.lit(" lost bytes "), F.col("start").cast("string"), F.lit(" to "),
                       F.col("end").cast("string"), F.lit(": "), F.col("gap"))
    return records.filter(F.assert_true(F.col("gap").isNull(), message).isNull())


def write_warc(pages: DataFrame, folder: str | None = None, roll_bytes: int = 64 << 20) -> DataFrame:
    """Write ``(page_id, url, html)`` rows as WARC files and return their paths (path, n_records).

    Of records with equal payloads the one with the largest page_id is a response, the others are
    revisits that name it. Rows that repeat that page_id and payload are responses too. Null html is
    an empty payload, and empty payloads count as equal like any others; a null page_id sorts below
    all ids. The digest groups are aggregated map-side; the html rows meet them in a join whose row
    side AQE may split, so a payload that a third of all pages share is no hot task. An empty table
    writes files without records, or none; other columns are not looked at.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    html = text_or_empty("html")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        html.alias("html"), F.unhex(F.sha1(html.cast("binary"))).alias("sha"))
    groups = (rows.groupBy("sha").agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n"))
              .filter("n > 1").drop("n"))
    groups = written(groups, "warc-groups")
    j = rows.join(groups.withColumn("dup", F.lit(True)), "sha", "left").select(
        "page_id", "url", "html", "top",
        (F.coalesce("dup", F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("top"))).alias("revisit"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, rolled = TaskContext.get().partitionId(), 0
        rows = (r for b in batches for r in zip(*(b[c] for c in ("page_id", "url", "html", "top", "revisit"))))
        row = next(rows, None)
        while row is not None:
            path, size, n = f"{folder}/part-{part:06d}-{rolled:04d}.warc.gz", 0, 0
            with shared_output(path) as f:
                while row is not None and size < roll_bytes:
                    i, url, html, top, again = (x.as_py() for x in row)
                    member = gzip.compress(record_bytes(i, url, html.encode(), top, again), 6, mtime=0)
                    f.write(member)
                    size, n, row = size + len(member), n + 1, next(rows, None)
            rolled += 1
            yield pa.record_batch([pa.array([path]), pa.array([n], pa.int64())], names=["path", "n_records"])

    return written(j.mapInArrow(put, "path string, n_records long"), "warc-files")


def read_warc(files: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records and quarantined gaps (``gap`` names the failed check, start and end the lost bytes) of the
    WARC files whose paths are in column ``path``; one task reads a file at a time, memory-mapped."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b["path"].to_pylist():
                out, held = [], 0
                with shared_input(path) as data:
                    for start, end, r, why in salvage(data):
                        r = r or dict.fromkeys(_RECORD_T.names)
                        r = r | {"path": path, "start": start, "end": end, "gap": why}
                        if not with_payload:
                            r["payload"] = None
                        held += len(r["payload"] or b"") + 200
                        out.append(r)
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(out, schema=_RECORD_T)
                            out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=_RECORD_T)

    n = max(1, files.count())  # one row per file: file sizes are bounded by roll_bytes
    return files.select("path").repartition(min(n, 100_000)).mapInArrow(read, _RECORD)
