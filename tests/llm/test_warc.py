"""WARC archives: exact round trip, splits, revisits."""
import base64
import gzip
import re
import hashlib
import random
from io import BytesIO

import pytest
from compare import compare, duck
from conftest import SF_MID
from llm.fixtures import clashing, table

from riskwin.llm import warc as W
from riskwin.session import scratch_path


class Bytes:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at:at + n]


def expected(pages):
    first = {}
    for i, html in pages:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, html in pages:
        b = (html or "").encode()
        f = first.get(html or "")
        same = i is None or i == f
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if same else "revisit", None if same else f))
    return sorted(out, key=str)


def test_pages_round_trip(spark):
    got = sorted((tuple(r) for r in W.op7_warc(spark, SF_MID).collect()), key=str)
    assert got == expected(table(SF_MID, "pages", "page_id, html"))


def test_sql(spark):
    r = compare(W.op7_warc(spark, SF_MID), duck(SF_MID), W.WARC_SQL)
    assert r["cols"] and r["rows"][0] == r["rows"][1] and r["hash"]


@pytest.mark.parametrize("split", [1, 7, 100, 333, 5000, 1 << 20])
def test_every_record_belongs_to_one_split(split, monkeypatch):
    monkeypatch.setattr(W, "READ", 64)
    rng = random.Random(split)
    payloads = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 5, 300, 900]))) for _ in range(25)]
    # members inside payloads are no records: a plain one, and one that looks like a record's start
    payloads[3] = gzip.compress(b"inner") * 3
    payloads[9] = W.MAGIC * 40
    data = b"".join(W.encode_record(i, f"http://x/{i}", p, W.base32_sha1(p), None, False, level=1) for i, p in enumerate(payloads))
    rows = [r for a in range(0, len(data), split) for r in W.read_split(Bytes(data), len(data), a, min(len(data), a + split))]
    assert [(r[0], r[6]) for r in rows] == list(enumerate(payloads))


def test_members_are_plain_gzip():
    record = W.encode_record(7, "http://a/%0A\r\n", b"<p>", W.base32_sha1(b"<p>"), None, False)
    text = gzip.open(BytesIO(record)).read()
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and text.endswith(b"<p>\r\n\r\n")
    assert W.decode_record(text)[1] == "http://a/%0A\r\n"
    with pytest.raises(ValueError):
        W.decode_record(text.replace(b"<p>", b"<q>"))


def test_awkward_rows(spark):
    big = "é<p>" * 300_000
    rows = [(3, "u", "same"), (1, None, "same"), (2, "v", "same"), (1, None, "same"), (None, "n", "same"), (5, "u", None),
            (6, "u", ""), (7, "u\r\nX: y", big), (8, "u", big), (None, None, None)]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"), ["digest", "first", "payload"])
    folder = scratch_path(spark, "warc-test")
    archives = W.write_archives(pages, folder, archive_bytes=1000)
    assert archives.count() > 1
    got = W.read_archives(archives, folder, split_bytes=200).collect()
    found = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=str)
    assert found == expected([(i, h) for i, _, h in rows])
    assert sorted(((r["page_id"], r["url"]) for r in got), key=str) == sorted(((i, u) for i, u, _ in rows), key=str)
    assert {bytes(r["payload"]) for r in got if r["page_id"] == 7} == {big.encode()}


def test_short_payloads_are_always_written(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-test")
    got = W.read_archives(W.write_archives(pages, folder, min_bytes=5), folder).collect()
    assert {r["page_id"]: r["record_type"] for r in got} == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-test")
    archives = W.write_archives(pages, folder)
    assert archives.count() == 0 and W.read_archives(archives, folder).count() == 0


def test_damage_is_found_and_costs_one_record(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"u{i}", f"page {i} " * (5 + i)) for i in range(40)], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-test")
    archives = W.write_archives(pages.coalesce(1), folder)
    row = archives.collect()
    assert len(row) == 1
    name, size = row[0]["file"], row[0]["bytes"]
    whole = open(f"{folder.removeprefix('file:')}/{name}", "rb").read()
    starts = [i for i in range(size) if whole.startswith(W.MAGIC, i)]
    starts = [a for a in starts if W._Window(Bytes(whole), size, a).member(a)]
    assert len(starts) == 40
    ends = [*starts[1:], size]

    def broken(data):
        (tmp_path / name).write_bytes(data)
        where = str(tmp_path)
        gaps = [tuple(r)[1:] for r in W.damaged_ranges(archives, where, split_bytes=300).collect()]
        kept = {r["page_id"] for r in W.read_archives(archives, where, 300, damaged="skip").collect()}
        return sorted(gaps), kept, lambda: W.read_archives(archives, where, 300).collect()

    ids = [int(re.search(rb"page (\d+) ", gzip.decompress(whole[a:b])).group(1)) for a, b in zip(starts, ends)]
    for at, lost in ((starts[7], 7), (starts[20] + 40, 20), (starts[0], 0), (ends[39] - 3, 39)):
        data = bytearray(whole)
        data[at] ^= 0x55
        gaps, kept, read = broken(bytes(data))
        assert gaps == [(starts[lost], ends[lost])]
        assert kept == set(ids) - {ids[lost]}
        with pytest.raises(Exception, match="no record in bytes"):
            read()
    # cut off inside the last but one record, and between two
    gaps, kept, read = broken(whole[:starts[39] - 2])
    assert gaps == [(starts[38], starts[39] - 2), (starts[39] - 2, size)] and kept == set(ids[:38])
    gaps, kept, read = broken(whole[:starts[39]])
    assert gaps == [(starts[39], size)] and kept == set(ids[:39])
    with pytest.raises(Exception, match="no record in bytes"):
        read()
    gaps, kept, read = broken(whole)
    assert gaps == [] and len(read()) == 40
