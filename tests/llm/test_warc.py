"""WARC archives: round trip, revisits and salvage of damaged bytes."""

from __future__ import annotations

import random
import zlib

import pandas as pd
import pytest
from pyspark.sql import functions as F

from newsloom.llm import warc
from newsloom.session import cut_lineage


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"https://e.example/{i} x", f"<p>{i % 7}</p>" * (i % 5), "extra") for i in range(60)]
    rows += [(60, None, None, None), (61, "u", "", "e"), (61, "u", "", "e"), (62, "u", "é" * 90000, "e"),
             (63, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "e")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, sha1 string")


def test_matches_sql(pages, in_sql, same):
    frame = pd.DataFrame([tuple(r) for r in pages.collect()], columns=pages.columns)
    same(warc.round_trip(pages), in_sql(warc.SQL, pages=frame))


def test_null_ids_and_small_payloads(spark):
    pages = spark.createDataFrame([(None, "u", "same"), (None, "u", "same"), (4, "u", "x"), (5, "u", "x")],
                                  "page_id long, url string, html string")
    rows = [tuple(r) for r in warc.round_trip(pages).select("page_id", "record_type", "refers_to").collect()]
    assert sorted(rows, key=str) == sorted(
        [(None, "response", None)] * 2 + [(4, "revisit", 5), (5, "response", None)], key=str)
    small = warc.read_archives(warc.archives(pages, least_bytes=2)).select("record_type").collect()
    assert [r[0] for r in small] == ["response"] * 4


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(pages).collect() == []


def test_payloads_come_back_whole(pages):
    got = warc.read_archives(cut_lineage(warc.archives(pages, archive_bytes=2000), "test"))
    assert got.select("archive").distinct().count() > 3
    bodies = {r.record_id: bytes(r.payload).decode() for r in
              got.where("record_type = 'response'").collect()}
    texts = {r.html or "" for r in pages.collect()}
    assert set(bodies.values()) == texts


def _archive(n: int) -> tuple[list[bytes], bytes]:
    members = [warc._page_record(i, "u", b"%d" % i * 300, warc.sha1_base32(b"%d" % i * 300), None)
               for i in range(n)]
    return members, b"".join(members)


@pytest.mark.parametrize("seed", range(12))
def test_salvage_recovers_every_whole_member(seed):
    draw = random.Random(seed)
    members, data = _archive(8)
    bounds = [sum(map(len, members[:i])) for i in range(9)]
    hurt = draw.randrange(8)
    at = bounds[hurt] + draw.randrange(10, len(members[hurt]) - 8)
    kind = seed % 3
    if kind == 0:  # overwritten
        data = data[:at] + bytes([data[at] ^ 0xFF, 0, 255]) + data[at + 3:]
    elif kind == 1:  # cut out
        data = data[:at] + data[bounds[hurt + 1]:]
    else:  # foreign bytes before a member
        data = data[:bounds[hurt]] + b"\x1f\x8bnoise WARC/1.1\r\nbroken" + data[bounds[hurt]:]
    found = list(warc.salvage(data))
    ids = [int(x.headers["warc-record-id"][10:-1]) for x in found if not x.why]
    assert ids == [i for i in range(8) if i != hurt or kind == 2]
    gaps = [x for x in found if x.why]
    assert len(gaps) == 1
    assert sum(x.end - x.start for x in found) == len(data)  # every byte is accounted for


def _one_member(n: int, level: int = 6) -> tuple[list[bytes], bytes]:
    plain = [zlib.decompress(m, 31) for m in _archive(n)[0]]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return plain, packer.compress(b"".join(plain)) + packer.flush()


def _ids(found) -> list[int]:
    return [int(x.headers["warc-record-id"][10:-1]) for x in found if not x.why]


def test_a_damaged_record_inside_a_member_is_one_inner_gap():
    plain, _ = _one_member(5)
    hurt = bytearray(b"".join(plain))
    hurt[sum(map(len, plain[:3])) - 50] ^= 0xFF
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    member = packer.compress(bytes(hurt)) + packer.flush()
    found = list(warc.salvage(member + _archive(1)[1]))
    assert _ids(found) == [0, 1, 3, 4, 0]
    gap, = [x for x in found if x.why]
    assert gap.why == "block digest differs"
    assert gap.inner == (sum(map(len, plain[:2])), sum(map(len, plain[:3])))


def test_a_member_cut_short_keeps_its_whole_records():
    plain, member = _one_member(5)
    found = list(warc.salvage(member[:-20]))
    assert _ids(found) in ([0, 1, 2, 3], [0, 1, 2, 3, 4]) and found[-1].why


@pytest.mark.parametrize("level", [0, 6])
@pytest.mark.parametrize("part", [0.3, 0.6, 0.95])
def test_a_broken_stream_keeps_what_can_be_checked(level, part):
    draw = random.Random(5)  # texts that hardly shrink, so that the fault lies behind a record or two
    texts = [draw.randbytes(4000).hex().encode() for _ in range(6)]
    plain = [zlib.decompress(warc._page_record(i, "u", d, warc.sha1_base32(d), None), 31) for i, d in enumerate(texts)]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    member = packer.compress(b"".join(plain)) + packer.flush()
    at = int(len(member) * part)
    hurt = member[:at] + bytes([member[at] ^ 0xFF]) + member[at + 1:]
    found = list(warc.salvage(hurt + _archive(2)[1]))
    ids = _ids(found)
    assert ids[-2:] == [0, 1] and len(ids) == len(set(ids[:-2])) + 2
    assert len(ids) >= 3 and any(x.why for x in found)
    assert all(any(x.block in p for p in plain) for x in found[:-2] if not x.why)


def test_plain_records_digests_and_truncation():
    block = b"HTTP/1.1 200 OK\r\n\r\nbody"
    good = (b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n" % len(block)) + block + b"\r\n\r\n"
    wrong = good.replace(b"WARC-Type: response\r\n",
                         b"WARC-Type: response\r\nWARC-Block-Digest: sha1:AAAA\r\n")
    found = list(warc.salvage(good + wrong + good + good[:-9]))
    assert [x.why for x in found] == ["", "block digest differs", "", "content length does not fit"]
    assert list(warc.salvage(b"")) == []


def test_binary_files_can_be_read(spark, tmp_path):
    _, data = _archive(3)
    (tmp_path / "a.warc.gz").write_bytes(data + b"tail")
    rows = warc.read_archives(warc.archive_files(spark, str(tmp_path)))
    assert [r[0] for r in rows.orderBy("start").select("kind").collect()] == ["record"] * 3 + ["gap"]
    assert rows.where(F.col("kind") == "gap").first().stop == len(data) + 4
