import gzip
import hashlib
from pathlib import Path

import pytest

from reelhouse.llm import store, warc

BIG = "<p>" + "x" * 120
PAGES = [
    (5, "http://a/1", BIG, 1), (2, "http://a/2", BIG, 1), (9, None, BIG, 1), (3, "http://b/\r\nX: y", "short", 1),
    (4, "http://b/2", "short", 1), (6, "http://c", None, 1), (7, "http://c/é", "é\r\n\r\nWARC/1.1\r\n" * 20, 1),
    (8, "u", "y" * 100, 1), (10, "u", "y" * 99, 1), (11, "u", "y" * 100, 1), (12, "u", "y" * 99, 1), (13, "u", "z" * 300_000, 1),
]


def frame(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest int")


def test_round_trip(spark):
    path = store.new_path(spark, "t")
    warc.write_archive(frame(spark), path)
    got = {r.page_id: r for r in warc.read_archive(spark, path).collect()}
    assert set(got) == {p[0] for p in PAGES}
    by_payload = {}
    for i, _, html, _ in PAGES:
        by_payload.setdefault(html or "", []).append(i)
    for i, url, html, _ in PAGES:
        raw, r = (html or "").encode(), got[i]
        first = min(by_payload[html or ""])
        again = len(raw) >= 100 and i != first
        assert (r.record_type, r.refers_to) == (("revisit", first) if again else ("response", None))
        assert bytes(r.payload) == raw and r.payload_bytes == len(raw)
        assert r.payload_digest == hashlib.sha256(raw).hexdigest()
        assert r.header.startswith("WARC/1.1\r\n") and r.header.endswith("\r\n\r\n") and r.header.count("\r\n\r\n") == 1
        assert r.url == (url or "").replace("\r", "%0D").replace("\n", "%0A")
    assert spark.read.parquet(f"{path}/payloads").count() == len(by_payload)


def read_records(raw):
    """Records of a WARC file by their Content-Length."""
    while raw:
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        n = int(fields[b"Content-Length"])
        assert head.startswith(b"WARC/1.1") and rest[n : n + 4] == b"\r\n\r\n"
        yield fields, rest[:n]
        raw = rest[n + 4 :]


def test_exported_files_are_warc(spark, tmp_path):
    path = store.new_path(spark, "t")
    warc.write_archive(frame(spark), path)
    warc.export_warc(warc.read_archive(spark, path), str(tmp_path / "out"))
    found = [x for f in Path(tmp_path / "out").glob("part-*.gz") for x in read_records(gzip.decompress(f.read_bytes()))]
    assert len(found) == len(PAGES)
    for fields, payload in found:
        if fields[b"WARC-Type"] == b"response":
            assert fields[b"WARC-Payload-Digest"] == b"sha256:" + hashlib.sha256(payload).hexdigest().encode()


def test_damage_is_found(spark):
    path = store.new_path(spark, "t")
    warc.write_archive(frame(spark), path)
    stored = spark.read.parquet(f"{path}/payloads")
    stored.selectExpr("digest", "cast('other' as binary) AS payload", "owner", "octets").write.parquet(f"{path}/bad/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{path}/bad/headers")
    with pytest.raises(Exception, match="does not match"):
        warc.read_archive(spark, f"{path}/bad").collect()


def test_repeats_null_ids_and_empty(spark):
    path = store.new_path(spark, "t")
    warc.write_archive(frame(spark, [(None, "u", BIG, 1), (4, "u", BIG, 1), (4, "u", BIG, 1)]), path)
    got = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in warc.read_archive(spark, path).collect())
    assert got == [(0, "revisit", 4), (4, "response", None), (4, "response", None)]
    path = store.new_path(spark, "t")
    warc.write_archive(frame(spark, []), path)
    assert warc.read_archive(spark, path).count() == 0
