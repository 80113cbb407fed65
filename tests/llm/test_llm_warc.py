import gzip

import brute
import pytest

from lexitally.llm import shared, warc

SHAPE = "page_id BIGINT, url STRING, html STRING, payload STRING, key INT"


def round_trip(spark, rows, **options):
    path = shared.new_path(spark, "archives")
    warc.write(spark.createDataFrame([(*r, "x", 1) for r in rows], SHAPE), path, **options)
    return path, warc.read(spark, path, content=True).collect()


def test_odd_pages(spark):
    nested = warc.record(7, "http://a/", b"x\r\n\r\nWARC/1.1\r\n", "D", None, None).decode()
    rows = [(1, "http://a/ b\r\nX: y", "one"), (2, None, "one"), (3, "u", "one"), (4, "u", None), (5, "u", ""), (6, "ü", nested),
            (7, "u", nested + "\r\n\r\n"), (8, "u", "é" * 100_000), (9, "u", nested), (9, "u", nested)]
    path, found = round_trip(spark, rows)
    want = brute.archive([(p, h) for p, _, h in rows])
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found} == want
    assert len(found) == len(rows)
    texts = {p: (h or "").encode() for p, _, h in rows}
    assert all(bytes(r.payload) == texts[r.page_id] for r in found if r.record_type == "response")
    assert all(r.payload is None for r in found if r.record_type == "revisit")
    assert {r.url for r in found if r.page_id == 1} == {"http://a/%20b%0D%0AX:%20y"}
    for file in spark.read.format("binaryFile").load(path).collect():
        assert gzip.decompress(file.content).startswith(b"WARC/1.1\r\n")


def test_rows_without_a_key_and_small_payloads(spark):
    _, found = round_trip(spark, [(None, "u", "same"), (1, "u", "same"), (2, "u", "same"), (3, "u", "s"), (4, "u", "s")], min_bytes=2)
    assert sorted((str(r.page_id), r.record_type, r.refers_to) for r in found) == [
        ("1", "revisit", 2), ("2", "response", None), ("3", "response", None), ("4", "response", None), ("None", "response", None)]


def test_many_archives(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE", 1000)
    raw = b"".join(warc.record(i, "u", b"x" * 300, warc._sha1(b"x" * 300), None, None) for i in range(9))
    assert [len(r.payload) for r in warc.records(raw)] == [300] * 9


def test_damage_is_found():
    raw = warc.record(1, "u", b"payload", warc._sha1(b"payload"), None, None)
    assert [r.payload for r in warc.records(raw)] == [b"payload"]
    with pytest.raises(ValueError):
        list(warc.records(raw.replace(b"payload", b"pbyload")))
    with pytest.raises(ValueError):
        list(warc.records(raw[:-3]))


def test_nothing(spark):
    path = shared.new_path(spark, "archives")
    warc.write(spark.createDataFrame([], SHAPE), path)
    assert warc.read(spark, path).collect() == []
