"""WARC archives: exact round trips, members and index, revisits against a plain grouping."""

from __future__ import annotations

import gzip
import hashlib
import io
import zlib
from collections import defaultdict

import pytest

from tidepool.llm import warc
from tidepool.llm.common import shared_folder

SCHEMA = "page_id bigint, url string, html string, payload string, sum string, offset long"


def pages():
    big, other = "<p>" + "é" * 700 + "</p>", "x" * 1000
    out = [(1, "http://a/", big), (2, "http://b/\r\nX: y", big), (7, None, big), (3, "http://c/", "small"),
           (4, "http://d/", "small"), (5, "u", None), (6, "u", ""), (None, "u", other), (9, "u", other), (9, "u", other),
           (10, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\n" * 60), (11, "u", "y" * 300_000), (None, "u", "lonely")]
    return [(*r, "a", "b", 1) for r in out]


def brute(data):
    largest = {}
    for i, _, html, *_ in data:
        h = html or ""
        if len(h.encode()) >= 1000:
            largest[h] = max(largest.get(h, -1), -1 if i is None else i)
    out = []
    for i, _, html, *_ in data:
        h = html or ""
        top = largest.get(h, -1)
        refers = top if top != -1 and i != top else None
        out.append((i, len(h.encode()), hashlib.sha1(h.encode()).hexdigest(),
                    "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def test_round_trip(spark):
    docs = spark.createDataFrame(pages(), SCHEMA)
    got = warc.round_trip(docs).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(pages())


def test_files_members_and_index(spark, monkeypatch):
    whole, single = shared_folder(spark, "t-whole"), shared_folder(spark, "t-single")
    planned = warc.plan_records(spark.createDataFrame(pages(), SCHEMA).coalesce(1))
    archives = warc.write_archives(planned, whole, roll=2000)
    assert archives.count() > 1                                       # archives roll over
    new = warc.normalise(archives, single)
    entries = defaultdict(list)
    for e in warc.read_index(new, single).collect():
        entries[e["archive"]].append(e)
    plain = {r["archive"]: r["n_records"] for r in archives.collect()}
    assert sum(plain.values()) == len(pages()) == sum(map(len, entries.values()))
    for path in plain:                                                # one member holds the whole archive
        data = open(path, "rb").read()
        one = zlib.decompressobj(31)
        one.decompress(data)
        assert one.eof and not one.unused_data
    for path, listed in entries.items():                              # members at the offsets, nothing between
        data, end = open(path, "rb").read(), 0
        for e in sorted(listed, key=lambda e: e["offset"]):
            assert e["offset"] == end
            end += e["length"]
            fields, _ = warc.parse(gzip.decompress(data[e["offset"]:end]))
            assert fields["warc-type"] == e["record_type"]
        assert end == len(data)


@pytest.mark.parametrize("size", [1, 7, 100_000])
def test_streams_in_any_chunks_and_members(size):
    raw = [warc.record(k, "u", b"x" * k, None) for k in range(0, 200, 7)]
    for parts in ([b"".join(raw)], raw):
        stream = io.BytesIO(b"".join(gzip.compress(p) for p in parts))
        assert list(warc.records(warc.inflated(stream, size))) == raw
    with pytest.raises(ValueError):
        list(warc.records([raw[0] + raw[1][:-9]]))


def test_empty(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
