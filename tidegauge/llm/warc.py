"""WARC archives of pages: a writer, and a reader that salvages damaged files.

Archives are written by Spark's text sink, a record a line: plain records end with the
two line ends that the format asks for; compressed ones are gzip members, parted by
members of no content. The reader checks every record (member checksum, version line,
header lines, length, end, block digest). Where a check fails it looks for the next
member or version line from which a whole valid record can be read, goes on there, and
reports the bytes between as a gap.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.common import column, settle

#: A gzip member of no content.
EMPTY_MEMBER = bytes([0x1F, 0x8B, 8, 0, 0, 0, 0, 0, 0, 3, 3, 0, 0, 0, 0, 0, 0, 0, 0, 0])
MEMBER, VERSION = b"\x1f\x8b\x08", b"WARC/"
#: Fixed values of the format.
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
STEP = 1 << 16
FIELDS = ("file string, offset long, length long, kind string, reason string, "
          "headers map<string,string>, http map<string,string>, payload binary")


def with_revisits(pages: DataFrame, id_col: str, payload: str, least: int) -> DataFrame:
    """Adds payload (binary), digest, size and refers_to, the greatest id of equal
    payloads of at least ``least`` bytes, for all but that row."""
    full = F.coalesce(column(payload).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(column(id_col).alias("id"), "*", full.alias("__payload"))
    rows = rows.withColumn("__digest", F.sha1("__payload")).withColumn("__size", F.octet_length("__payload").cast("long"))
    # Only digests are shuffled for this; stored, so that a large group can be divided.
    least_rows = rows.filter(F.col("__size") >= least).groupBy("__digest", "__size").agg(
        F.max("id").alias("__last"), F.count("*").alias("__copies"))
    shared = settle(least_rows.filter("__copies > 1").drop("__copies"), "payloads")
    return rows.join(shared, ["__digest", "__size"], "left").withColumn(
        "__refers", F.when(F.col("id") < F.col("__last"), F.col("__last")))


def _records(rows: DataFrame, url: str, date: str) -> Column:
    """The bytes of a record up to, and without, the two line ends after its block."""
    revisit = F.col("__refers").isNotNull()
    target = F.regexp_replace(F.coalesce(column(url).cast("string"), F.lit("")), "[\\x00-\\x20]+", "%20")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("__size").cast("string"), F.lit("\r\n\r\n"))
    block = F.concat(http.cast("binary"), F.when(revisit, F.lit(b"")).otherwise(F.col("__payload")))

    def uri(name: str) -> Column:
        return F.concat(F.lit("<urn:x-page:"), F.coalesce(F.col(name).cast("string"), F.lit("")), F.lit(">"))

    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), uri("id"), F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), target,
        F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: "), uri("__refers"), F.lit(f"\r\nWARC-Profile: {REVISIT}")))
        .otherwise(""),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("__digest"),
        F.lit("\r\nWARC-Block-Digest: sha1:"), F.sha1(block),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head.cast("binary"), block)


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url: str = "url", payload: str = "html",
                   compress: bool = True, revisit_bytes: int = 1000, archive_bytes: int = 16 << 20,
                   date: str = "1970-01-01T00:00:00Z") -> None:
    """One record per row, in archives of about ``archive_bytes`` of payload.

    A null payload is empty. A row whose payload (of at least revisit_bytes) equals that
    of a row of greater id is a revisit of the row of the greatest; rows of a repeated id
    are each written, and the copies of the greatest id are all responses; rows without
    an id are responses. Extra columns are ignored; an empty table writes no records.
    """
    slim = pages.select(*{id_col: 0, url: 0, payload: 0})
    rows = with_revisits(slim, id_col, payload, revisit_bytes)
    record = rows.select(_records(rows, url, date).alias("record"), F.xxhash64("id").alias("deal"))
    total = slim.agg(F.sum(F.octet_length(column(payload).cast("string")) + 600)).first()[0] or 0
    record = record.repartition(max(1, -(-total // archive_bytes))).select("record")
    end = END
    if compress:
        def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([gzip.compress(r.as_buffer().to_pybytes() + END, 6, mtime=0) for r in batch.column(0)],
                              pa.binary())], ["record"])
        record, end = record.mapInArrow(members, "record binary"), EMPTY_MEMBER
    (record.select(F.col("record").cast("string").alias("value")).write
     .option("encoding", "ISO-8859-1").option("lineSep", end.decode("latin-1")).text(path))


def _headers(lines: bytes) -> dict[str, str] | None:
    found: dict[str, str] = {}
    name = None
    for line in lines.split(b"\r\n"):
        if line[:1] in (b" ", b"\t") and name:
            found[name] += " " + line.strip().decode("utf-8", "replace")
            continue
        head, colon, value = line.partition(b":")
        if not colon or not head.strip():
            return None
        name = head.strip().decode("utf-8", "replace").lower()
        found[name] = value.strip().decode("utf-8", "replace")
    return found


def _digest_holds(field: str, block: bytes) -> bool:
    kind, _, value = field.partition(":")
    if kind.lower() not in ("sha1", "sha256", "md5"):
        return True  # a digest that cannot be checked is no failed check
    own = hashlib.new(kind.lower(), block)
    return value.lower() == own.hexdigest() or value.upper() == base64.b32encode(own.digest()).decode()


def read_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int] | str:
    """Headers, block and end of the record at that place, or the check that fails."""
    if data[at: at + 5] != VERSION:
        return "no version line"
    line = data.find(b"\r\n", at, at + 32)
    stop = data.find(END, at)
    if line < 0 or stop < 0:
        return "header cut short"
    headers = _headers(data[line + 2: stop]) if stop > line else None
    if headers is None:
        return "header line"
    size = headers.get("content-length", "")
    if not size.isdigit():
        return "length"
    first = stop + 4
    last = first + int(size)
    if data[last: last + 4] != END:
        return "record end"
    block = bytes(data[first:last])
    if "warc-block-digest" in headers and not _digest_holds(headers["warc-block-digest"], block):
        return "block digest"
    return headers, block, last + 4


def unpacked(data: bytes, at: int, stop: int) -> Iterator[bytes | int | str]:
    """The content of the gzip member at that place in parts, as far as it can be
    unpacked; last its end, or the check that fails."""
    view, unpack = memoryview(data)[:stop], zlib.decompressobj(31)
    while not unpack.eof:
        if at >= stop:
            yield "member cut short"
            return
        before, packed = unpack.copy(), view[at: at + STEP]
        try:
            # Parts of bounded size, also of content that packs well.
            part = unpack.decompress(packed, STEP * 16)
            yield part
            while unpack.unconsumed_tail:
                before, packed = unpack.copy(), unpack.unconsumed_tail
                yield unpack.decompress(packed, STEP * 16)
        except zlib.error:
            try:  # all that comes before the damage
                for i in range(len(packed)):
                    yield before.decompress(packed[i: i + 1])
            except zlib.error:
                pass
            yield "member checksum"
            return
        at += min(STEP, stop - at) - len(unpack.unused_data)
    yield at


def content_records(parts: Iterator[bytes | int | str], held: int) -> Iterator[str | tuple[dict[str, str], bytes]]:
    """Records of unpacked content, and the failed check where bytes between are lost.

    Content is let go once its records are read and they are more than ``held`` bytes.
    """
    buffer, at, done, bad = bytearray(), 0, False, None

    def more() -> bool:
        nonlocal done
        size = len(buffer) + max(STEP, len(buffer) - at)
        while not done and len(buffer) < size:
            part = next(parts)
            if isinstance(part, bytes):
                buffer.extend(part)
            else:
                done = True
        return not done

    more()
    while at < len(buffer) or not done:
        found = read_record(buffer, at)
        # Only these may come from content that is not unpacked yet.
        if isinstance(found, str) and not done and (found != "block digest" and found != "length"):
            if found != "no version line" or len(buffer) - at < len(VERSION):
                if found != "record end" or _cut(buffer, at):
                    more()
                    continue
        if not isinstance(found, str):
            if bad is not None:
                yield bad
                bad = None
            yield found[:2]
            at = found[2]
        else:
            bad = bad or found
            start = buffer.find(VERSION, at + 1)
            while start < 0 and not done:
                at = max(at, len(buffer) - len(VERSION))
                more()
                start = buffer.find(VERSION, at + 1)
            at = start if start >= 0 else len(buffer)
        if at > held:
            del buffer[:at]
            at = 0
    if bad is not None:
        yield bad


def _cut(data: bytearray, at: int) -> bool:
    """Whether the record at that place ends after the data."""
    stop = data.find(END, at)
    size = _headers(bytes(data[data.find(b"\r\n", at) + 2: stop]))["content-length"]
    return stop + 8 + int(size) > len(data)


def salvage(data: bytes, limit: int) -> Iterator[tuple[int, int, str | tuple[dict[str, str], bytes]]]:
    """(offset, length, record or reason) over a whole file: records and gaps, in order.

    Records of one member, and gaps in its content, have the member's place and length. Those out of
    a damaged member follow the gap that its bytes are, with length 0 and the gap's end; one
    that held a single record and nothing else is a gap only. ``limit``: see content_records.
    """
    at, bad, reason = 0, None, ""
    torn: list[int] = []

    def gap() -> Iterator[tuple[int, int, str | tuple[dict[str, str], bytes]]]:
        # A damaged member ends where the next one begins that records come out of.
        stop, saved = at, []
        for place in reversed(torn):
            every = list(content_records(unpacked(data, place, stop), limit))
            found = [f for f in every if not isinstance(f, str)]
            if found and len(every) > 1:
                stop = place
                saved.append((place, found))
        yield bad, at - bad, reason
        for place, found in reversed(saved):
            yield from ((at, 0, record) for record in found)
        torn.clear()

    while at < len(data):
        if data[at: at + 3] == MEMBER:
            end: bytes | int | str = ""
            for end in unpacked(data, at, len(data)):
                pass
            here, some, lost = end, False, []
            for found in content_records(unpacked(data, at, len(data)), limit) if isinstance(end, int) else ():
                if isinstance(found, str):
                    lost.append(found)
                    continue
                if bad is not None:
                    yield from gap()
                    bad = None
                some = True
                yield at, end - at, found
            if isinstance(end, int) and (some or not lost):
                if bad is not None:
                    yield from gap()
                    bad = None
                for check in lost:
                    yield at, end - at, check
                at = end
                continue
            if isinstance(end, str):
                torn.append(at)
            else:
                here = lost[0]
        else:
            one = read_record(data, at)
            if not isinstance(one, str):
                if bad is not None:
                    yield from gap()
                    bad = None
                yield at, one[2] - at, one[:2]
                at = one[2]
                continue
            here = one
        if bad is None:
            bad, reason = at, here
        starts = [p for p in (data.find(MEMBER, at + 1), data.find(VERSION, at + 1)) if p >= 0]
        at = min(starts, default=len(data))
    if bad is not None:
        yield from gap()


def read_archives(spark: SparkSession, path: str, limit: int = 4 << 20) -> DataFrame:
    """file, offset, length, kind, reason, headers, http and payload of all archives.

    kind is ``record``, or ``gap`` for quarantined bytes with the failed check as reason.
    headers and http have lower-case names; of a record that holds an HTTP message the
    payload is its body, of others the whole block. One task holds one archive (of at
    most 2 GB) at a time, and a record and ``limit`` bytes of what it unpacks to. No files: no rows.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*[!_]*").option("recursiveFileLookup", "true")
             .load(path).filter("length > 0").select("path", "content"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name, data = batch.column("path")[i].as_py(), batch.column("content")[i].as_buffer().to_pybytes()
                rows, held = [], 0
                for offset, length, found in salvage(data, limit):
                    if isinstance(found, str):
                        rows.append((name, offset, length, "gap", found, None, None, None))
                    else:
                        http, body = http_message(found)
                        rows.append((name, offset, length, "record", None, list(found[0].items()), list(http.items()), body))
                        held += len(body)
                    if held > STEP * 64 or len(rows) >= 1000:
                        yield table(rows)
                        rows, held = [], 0
                yield table(rows)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        pairs = pa.map_(pa.string(), pa.string())
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pairs, pairs, pa.binary()]
        names = ["file", "offset", "length", "kind", "reason", "headers", "http", "payload"]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)

    return files.mapInArrow(run, FIELDS)


def http_message(record: tuple[dict[str, str], bytes]) -> tuple[dict[str, str], bytes]:
    """Header fields and body of the HTTP message in a record; of other blocks no fields."""
    headers, block = record
    head, end, body = block.partition(END)
    if not headers.get("content-type", "").startswith("application/http") or not end:
        return {}, block
    return _headers(head.partition(b"\r\n")[2]) or {}, body
