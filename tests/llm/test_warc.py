"""WARC: exact round trips, revisits, segments, broken archives."""

import gzip
import hashlib
import random

import pytest

from sideline.llm import warc

SCHEMA = "page_id long, url string, html string"


def _pages():
    rnd = random.Random(4)
    big = "".join(rnd.choice("<p>é中🙂\r\n\r\nWARC/1.1\r\n ") for _ in range(30_000))
    same = "s" * 1000
    return [(1, "http://a/1", big), (2, "http://a/2", same), (3, None, same), (4, "http://a/\r\n4", "s" * 999), (5, "u", "s" * 999), (6, "u", ""), (7, "u", None),
            (8, "u", big), (9, "u", "0\r\n\r\n"), (None, "u", same), (10, "u", "é" * 20_000), (11, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\n")]


def test_round_trip_with_revisits(spark, tmp_path):
    pages = _pages()
    warc.write_archives(spark.createDataFrame(pages, SCHEMA), str(tmp_path / "w"))
    rows = warc.reassemble(warc.read_records(spark, str(tmp_path / "w"))).collect()
    by = {r.page_id: r for r in rows}
    assert len(rows) == len(pages) and all(r.complete for r in rows)
    for page_id, _, html in pages:
        payload = (html or "").encode()
        if by[page_id].type == "response":
            assert bytes(by[page_id].payload) == payload and by[page_id].payload_digest == hashlib.sha1(payload).hexdigest()
        else:
            assert by[page_id].stated == hashlib.sha1(payload).hexdigest()
    assert {k for k, r in by.items() if r.type == "revisit"} == {1, 2, None}
    assert by[2].refers == by[None].refers == by[3].record_id and by[1].refers == by[8].record_id


def test_query_matches_brute_force(spark, tmp_path):
    pages = _pages()[:-3] + [(12, "u", "t" * 1500), (12, "u", "t" * 1500), (2, "v", "q" * 1200)]
    spark.createDataFrame([(p, u, h, i) for i, (p, u, h) in enumerate(pages)], SCHEMA + ", digest int").write.parquet(str(tmp_path / "pages.parquet"))
    found = sorted((tuple(r) for r in warc.op3_warc_reassembly(spark, str(tmp_path)).collect()), key=str)
    top = {}
    for p, _, h in pages:
        if len((h or "").encode()) >= 1000:
            top[h] = max(top.get(h, -1), -1 if p is None else p)
    want = [(p, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest(), *(("revisit", top[h]) if h in top and top[h] != p else ("response", None))) for p, _, h in pages]
    assert found == sorted(want, key=str)


def test_no_pages(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "pages.parquet"))
    assert warc.op3_warc_reassembly(spark, str(tmp_path)).collect() == []


def _archive(tmp_path, records, name="x.warc.gz", pack=gzip.compress):
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / name).write_bytes(b"".join(pack(r + b"\r\n\r\n") for r in records))
    return str(tmp_path / "in")


def test_segments_over_archives_in_any_order(spark, tmp_path):
    """Gzip members for each record, as other writers make; segments lie in different archives, one plain."""
    payload = bytes(range(256)) * 300
    records = list(warc.records_of(5, "u", "urn:uuid:5", hashlib.sha1(payload).hexdigest(), None, payload))
    assert len(records) > 3
    _archive(tmp_path, records[::-2], "a.warc.gz")
    path = _archive(tmp_path, records[-2::-2], "b.warc", bytes)
    row = warc.reassemble(warc.read_records(spark, path)).collect()
    assert len(row) == 1 and row[0].complete and bytes(row[0].payload) == payload


@pytest.mark.parametrize("spoil", ["missing", "length", "digest", "framing"])
def test_incomplete_records(spark, tmp_path, spoil):
    payload = b"z" * 60_000
    records = list(warc.records_of(5, "u", "urn:uuid:5", hashlib.sha1(payload).hexdigest() if spoil != "digest" else "00" * 20, None, payload))
    if spoil == "missing":
        del records[1]
    if spoil == "length":
        records[-1] = records[-1].replace(b"WARC-Segment-Total-Length: ", b"WARC-Segment-Total-Length: 1")
    if spoil == "framing":
        records = [warc.record("response", "urn:uuid:5", b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\nzz\r\n", WARC_Page_ID=5)]
    row = warc.reassemble(warc.read_records(spark, _archive(tmp_path, records))).collect()
    assert [(r.page_id, r.complete, r.payload) for r in row] == [(5, False, None)]


def test_chunks():
    for payload in (b"", b"a", "é".encode() * 9000, b"\r\n" * 5000):
        assert warc.unchunked(warc.chunked(payload)) == payload
    assert warc.unchunked(b"5\r\nab") is None and warc.unchunked(b"") is None
    assert warc.unchunked(b"2;x=y\r\nab\r\n0\r\n\r\n") == b"ab"


def test_parsing_costs_what_the_records_hold():
    """Records of one long part are walked, not cut off its front: none is copied again with all that follows it."""
    class Counted(bytes):
        copied = 0

        def __getitem__(self, at):
            got = super().__getitem__(at)
            if isinstance(at, slice):
                Counted.copied += len(got)
                return Counted(got)
            return got

        def __radd__(self, before):
            return Counted(bytes(before) + bytes(self))

        def lstrip(self, *chars):
            return Counted(super().lstrip(*chars))

    records = [warc.record("response", f"urn:uuid:{i}", b"x" * (i % 50)) + b"\r\n\r\n" for i in range(500)]
    whole = b"".join(records)
    got = list(warc.parse(iter([Counted(whole)])))
    assert [len(block) for _, block in got] == [i % 50 for i in range(500)]
    assert Counted.copied <= 2 * len(whole)
    for step in (1, 2, 3, 7, 100):  # parts that end anywhere, line ends between records included
        cut = [whole[k: k + step] for k in range(0, len(whole), step)]
        assert [(f["warc-record-id"], b) for f, b in warc.parse(iter(cut))] == [(f["warc-record-id"], bytes(b)) for f, b in got]


def test_whole_records_and_segments_are_read_apart(spark, tmp_path):
    warc.write_archives(spark.createDataFrame(_pages(), SCHEMA), str(tmp_path / "w"))
    every, whole, parts = (sorted(map(str, warc.read_records(spark, str(tmp_path / "w"), only).drop("block").collect())) for only in (None, False, True))
    assert whole and parts and sorted(whole + parts) == every
    assert warc.read_records(spark, str(tmp_path / "w"), True).where("number is null").count() == 0
