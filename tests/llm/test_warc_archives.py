"""WARC: several archives are read side by side, and archives of other makers are read too."""

import base64
import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from statlens.llm import warc


def sha1(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind, block, end=b"\r\n", **fields):
    head = [b"WARC/1.0", b"WARC-Type: " + kind.encode(), *(f"{k.replace('_', '-')}: {v}".encode() for k, v in fields.items()), f"Content-Length: {len(block)}".encode()]
    return end.join(head) + end + end + block + b"\r\n\r\n"


PAGE = b"<html lang=en>\r\n\r\n" + "é".encode() * 5000 + b"WARC/1.0\n"
FOREIGN = [
    record("warcinfo", b"software: some crawler\r\nformat: WARC\r\n", WARC_Record_ID="<urn:uuid:1>", Content_Type="application/warc-fields"),
    record("request", b"GET / HTTP/1.1\r\nHost: a.org\r\n\r\n", WARC_Record_ID="<urn:uuid:2>", WARC_Target_URI="http://a.org/"),
    # no length, a folded line, no digest
    record("response", b"HTTP/1.1 200 OK\r\nServer: x\r\nX-Long: one,\r\n  two\r\n\r\n" + PAGE, WARC_Record_ID="<urn:uuid:3>", WARC_Target_URI="http://a.org/"),
    record("response", b"HTTP/1.0 200\nContent-Type:text/html\nContent-Length:  7\n\nseven b", WARC_Record_ID="<urn:uuid:4>", WARC_Payload_Digest="sha1:" + sha1(b"seven b")),
    # a digest without the transfer encoding
    record("response", b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n2\r\nab\r\n0\r\n\r\n", WARC_Record_ID="<urn:uuid:5>", WARC_Payload_Digest="sha1:" + sha1(b"ab")),
    record("metadata", b"", WARC_Record_ID="<urn:uuid:6>"),
    record("response", b"HTTP/1.1 broken header", WARC_Record_ID="<urn:uuid:7>"),
    record("resource", b"\x00\x01not http", end=b"\n", WARC_Record_ID="<urn:uuid:8>", WARC_Payload_Digest="md5:00"),
    record("revisit", b"HTTP/1.1 304 Not Modified\r\n\r\n", WARC_Record_ID="<urn:uuid:9>", WARC_Payload_Digest="sha1:" + sha1(b"seven b"), WARC_Refers_To="<urn:uuid:4>"),
    record("revisit", b"", WARC_Record_ID="<urn:uuid:10>"),
]
PAYLOADS = [FOREIGN[0].split(b"\r\n\r\n", 1)[1][:-4], b"GET / HTTP/1.1\r\nHost: a.org\r\n\r\n", PAGE, b"seven b", b"2\r\nab\r\n0\r\n\r\n", b"", b"HTTP/1.1 broken header",
            b"\x00\x01not http", b"", b""]


@pytest.mark.parametrize("form", ["plain", "member a record", "one member"])
@pytest.mark.parametrize("chunk", [1, 7, 4096])
def test_foreign_records(form, chunk):
    whole = b"".join(FOREIGN)
    data = {"plain": whole, "member a record": b"".join(map(gzip.compress, FOREIGN)), "one member": gzip.compress(whole)}[form]
    rows = list(warc.record_chunks(io.BytesIO(data), chunk))
    by: dict = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    assert list(by) == [f"<urn:uuid:{k}>" for k in range(1, 11)]
    for (_, own), payload in zip(by.items(), PAYLOADS):
        assert b"".join(r[7] for r in own) == payload and [r[5] for r in own] == list(range(len(own)))
        assert [r[6] for r in own] == [False] * (len(own) - 1) + [True] and own[0][0] is own[0][4] is None
        assert own[-1][8] == hashlib.sha1(payload).hexdigest() and all(len(r[7]) <= chunk for r in own)
        if own[0][2] != "revisit":
            assert own[-1][9] == len(payload)
    assert by["<urn:uuid:3>"][-1][10] == sha1(PAGE) and by["<urn:uuid:4>"][0][10] == sha1(b"seven b")
    assert by["<urn:uuid:9>"][0][9:] == (None, sha1(b"seven b")) and by["<urn:uuid:10>"][0][9:] == (None, None)


def test_damage_is_seen():
    with pytest.raises(ValueError, match="digest"):
        list(warc.record_chunks(io.BytesIO(record("response", b"HTTP/1.1 200\r\n\r\nx", WARC_Payload_Digest="sha1:" + sha1(b"y")))))
    whole = gzip.compress(b"".join(FOREIGN))
    with pytest.raises(EOFError):
        list(warc.record_chunks(io.BytesIO(whole[:-200])))
    with pytest.raises(EOFError):
        list(warc.record_chunks(io.BytesIO(FOREIGN[2][:-300])))
    with pytest.raises(ValueError, match="not a WARC record"):
        list(warc.record_chunks(io.BytesIO(b"GIF89a\r\n")))


def test_archives_are_read_side_by_side(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1)  # an archive a record
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"page {i % 7}" * 50) for i in range(30)], "page_id long, url string, html string")
    manifest = warc.write_archives(spark, pages, f"file://{tmp_path}/a")
    assert manifest.count() == 30
    got = warc.read_archives(manifest).withColumn("task", F.spark_partition_id())
    assert got.select("task").distinct().count() >= 20
    back = {r.page_id: r for r in got.collect()}
    assert len(back) == 30 and all(bytes(back[i].data).decode() == f"page {i % 7}" * 50 and back[i].record_type == "response" for i in range(7))
    assert all(back[i].refers_to == i % 7 and back[i].payload_bytes == 300 for i in range(7, 30))


def test_folder_of_foreign_archives(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.warc").write_bytes(b"".join(FOREIGN))
    (tmp_path / "deep" / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, FOREIGN)))
    (tmp_path / "c.warc").write_bytes(b"")
    (tmp_path / "note.txt").write_bytes(b"no archive")
    found = warc.list_archives(spark, f"file://{tmp_path}")
    assert found.count() == 2  # Spark lists no empty file
    got = warc.read_archives(found, chunk=1000)
    assert got.where("last").groupBy("record_id").count().where("count = 2").count() == 10
    assert got.where("page_id IS NOT NULL").count() == 0
