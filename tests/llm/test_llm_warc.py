"""WARC: round trips, and salvage of damaged archives."""

import gzip
import hashlib
import random

import pytest
from conftest import SF
from pyspark.sql import functions as F

from tidegauge.llm import warc as w
from tidegauge.llm.common import fresh_path

ROWS = [(1, "http://a/", "x" * 2000), (2, "http://b/ c", "x" * 2000), (3, None, "short"), (4, "u", "short"), (5, "u", None),
        (6, "u", "é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n\x00" * 40), (7, "u", "x" * 2000), (None, "u", "x" * 2000)]


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, record int")


@pytest.mark.parametrize("compress", [True, False])
def test_round_trip(spark, compress):
    path = fresh_path(spark, "warc")
    w.write_archives(pages(spark), path, compress=compress, archive_bytes=5000)
    rows = w.read_archives(spark, path).collect()
    assert {r["kind"] for r in rows} == {"record"} and len(rows) == len(ROWS)
    by = {r["headers"]["warc-record-id"]: r for r in rows}
    for page, _, html in ROWS:
        data, r = (html or "").encode(), by[f"<urn:x-page:{'' if page is None else page}>"]
        assert r["headers"]["warc-payload-digest"] == "sha1:" + hashlib.sha1(data).hexdigest()
        assert int(r["http"]["content-length"]) == len(data)
        if page in (1, 2):
            assert r["headers"]["warc-type"] == "revisit" and r["headers"]["warc-refers-to"] == "<urn:x-page:7>"
            assert r["payload"] == b""
        else:
            assert r["headers"]["warc-type"] == "response" and r["payload"] == data


def test_other_readers_can_read_the_members(spark):
    path = fresh_path(spark, "warc")
    w.write_archives(pages(spark), path)
    files = spark.read.format("binaryFile").load(path).filter("length > 0").collect()
    assert sum(gzip.decompress(f["content"]).count(b"\r\nWARC-Record-ID: ") for f in files) == len(ROWS)


def archive(n, compress, seed=1):
    """Records one by one, as bytes."""
    rng, out = random.Random(seed), []
    for i in range(n):
        block = b"HTTP/1.1 200 OK\r\nContent-Length: 9\r\n\r\n" + rng.randbytes(rng.randint(1, 3000))
        head = (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:{i}>\r\nWARC-Block-Digest: sha1:"
                f"{hashlib.sha1(block).hexdigest()}\r\nContent-Type: application/http\r\nContent-Length: {len(block)}\r\n\r\n")
        record = head.encode() + block + b"\r\n\r\n"
        out.append(gzip.compress(record, 6, mtime=0) if compress else record)
    return out


def ids(found):
    return [int(f[2][0]["warc-record-id"][12:-1]) for f in found if not isinstance(f[2], str)]


@pytest.mark.parametrize("compress", [True, False])
@pytest.mark.parametrize("seed", range(12))
def test_salvage_recovers_all_whole_records(compress, seed):
    rng, records = random.Random(seed), archive(20, compress, seed)
    hurt = set(rng.sample(range(20), rng.randint(1, 5)))
    parts = []
    for i, r in enumerate(records):
        if i in hurt:
            kind = rng.randint(0, 3)
            if kind == 0:
                at = rng.randrange(len(r) // 2, len(r) - 30)
                r = r[:at] + bytes([r[at] ^ 0x55]) + r[at + 1:]
            elif kind == 1:
                r = r[:rng.randrange(1, len(r) - 30)]
            elif kind == 2:
                r = r[rng.randrange(1, len(r) // 2):]
            else:
                r = b"\x1f\x8b\x08 junk WARC/1.1 junk \r\n\r\n" + r
                hurt.discard(i)
        parts.append(r)
    data = b"".join(parts)
    found = list(w.salvage(data, 1 << 20))
    assert set(range(20)) - hurt <= set(ids(found)) and ids(found) == sorted(set(ids(found)))
    covered = 0
    for offset, length, _ in found:  # records and gaps cover the file once
        assert offset == covered
        covered += length
    assert covered == len(data)


def test_a_wrong_length_does_not_take_the_next_records():
    records = archive(3, False)
    records[0] = records[0].replace(b"Content-Length: ", b"Content-Length: 9", 1)
    found = list(w.salvage(b"".join(records), 1 << 20))
    assert ids(found) == [1, 2]
    assert found[0][:2] == (0, len(records[0])) and isinstance(found[0][2], str)


def test_damaged_files_through_spark(spark, tmp_path):
    records = archive(4, True)
    (tmp_path / "part-1.warc.gz").write_bytes(records[0] + b"junk" + records[1])
    (tmp_path / "part-2.warc").write_bytes(b"")
    (tmp_path / "part-3.warc.gz").write_bytes(records[2][:-9] + records[3])
    rows = w.read_archives(spark, str(tmp_path)).collect()
    gaps = sorted((r["file"][-14:-8], r["offset"], r["length"], r["reason"]) for r in rows if r["kind"] == "gap")
    assert sum(r["kind"] == "record" for r in rows) == 3
    assert [g[1:3] for g in gaps] == [(len(records[0]), 4), (0, len(records[2]) - 9)]
    assert all(g[3] for g in gaps)


def test_repeated_ids_and_empty_table(spark):
    path = fresh_path(spark, "warc")
    w.write_archives(pages(spark, [(7, "u", "y" * 1000), (7, "u", "y" * 1000), (6, "u", "y" * 1000)]), path)
    kinds = sorted(r["headers"]["warc-type"] for r in w.read_archives(spark, path).collect())
    assert kinds == ["response", "response", "revisit"]
    path = fresh_path(spark, "warc")
    w.write_archives(pages(spark).limit(0), path)
    assert w.read_archives(spark, path).count() == 0


def test_all_pages(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet")
    path = fresh_path(spark, "warc")
    w.write_archives(rows, path)
    got = w.read_archives(spark, path).filter("kind = 'record'").select(
        F.regexp_extract(F.col("headers")["warc-record-id"], "(\\d+)", 1).cast("long").alias("page_id"))
    assert got.distinct().count() == rows.count() == got.count()


@pytest.mark.parametrize("limit", [1000, 1 << 30])
def test_members_of_several_records(limit):
    records = archive(20, False)
    hurt = bytearray(records[7])
    hurt[-40] ^= 0x55
    whole = gzip.compress(b"".join(records), 6, mtime=0)
    # Longer than the limit, one bad digest, a bad checksum, and an end cut off.
    assert ids(w.salvage(whole, limit)) == list(range(20))
    found = list(w.salvage(gzip.compress(b"".join([*records[:7], bytes(hurt), *records[8:]]), 6, mtime=0), limit))
    assert ids(found) == [i for i in range(20) if i != 7]
    assert [f[2] for f in found if isinstance(f[2], str)] == ["block digest"]
    assert ids(w.salvage(whole[:-8] + b"\0" * 8, limit)) == list(range(20))
    cut = list(w.salvage(whole[:len(whole) // 2] + archive(21, True)[20], limit))
    assert len(ids(cut)) > 6 and ids(cut)[:6] == list(range(6))
