import base64
import hashlib
import random
import struct

import zstandard

from citegrid.llm import warc

PAGES = "page_id long, url string, html string, top string, sha string"


def pages():
    rng = random.Random(2)
    out = [(i, f"http://x/{i}", "<html>" + " ".join(f"w{rng.randrange(99)}" for _ in range(200)), "a", "b") for i in range(200)]
    out += [(300 + i, "http://y", "<p>copy</p>", "a", "b") for i in range(40)]
    out += [(400, None, None, None, None), (401, "http://bad\r\nline", "", "a", "b"), (None, "u", "<p>copy</p>", "a", "b"),
            (None, "u", "only null ids", "a", "b"), (None, "u", "only null ids", "a", "b"), (339, "http://y", "<p>copy</p>", "a", "b"),
            (402, "v", "é\r\n\r\nWARC/1.1\r\n" * 30_000, "a", "b")]
    return out


def plain(rows, least=0):
    out = []
    for i, _, html, *_ in rows:
        p = (html or "").encode()
        top = max((x[0] for x in rows if (x[2] or "").encode() == p and x[0] is not None), default=None)
        revisit = len(p) >= least and top is not None and i != top
        out.append((str(i), len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame(pages(), PAGES).repartition(3)
    for least in (0, 500):
        manifest = warc.write(df, str(tmp_path / f"a{least}"), least_bytes=least, file_bytes=20_000)
        got = [(str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read(spark, manifest).collect()]
        assert sorted(got, key=str) == plain(pages(), least)
        assert manifest.count() > 3 and sum(r.records for r in manifest.collect()) == len(pages())


def test_format(spark, tmp_path):
    manifest = warc.write(spark.createDataFrame(pages(), PAGES).coalesce(1), str(tmp_path / "one"))
    with open(manifest.first().uri.removeprefix("file://"), "rb") as f:
        raw = f.read()
    magic, size = struct.unpack("<II", raw[:8])
    assert magic & 0xFFFFFFF0 == 0x184D2A50 and size > 0
    frame = zstandard.get_frame_parameters(raw[8 + size:])
    assert frame.dict_id == zstandard.ZstdCompressionDict(raw[8:8 + size]).dict_id() and frame.has_checksum
    one = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw[8:8 + size])).decompress(raw[8 + size:])
    assert one.startswith(b"WARC/1.1\r\n") and one.endswith(b"\r\n\r\n") and one.count(b"WARC-Type") == 1


def test_payloads_come_back(spark, tmp_path):
    manifest = warc.write(spark.createDataFrame(pages(), PAGES).coalesce(2), str(tmp_path / "two"))
    bodies = [body for r in manifest.collect() for fields, body in warc.read_records(r.uri) if fields["WARC-Type"] == "response"]
    assert set(bodies) == {(p[2] or "").encode() for p in pages()}


def test_empty(spark, tmp_path):
    manifest = warc.write(spark.createDataFrame([], PAGES), str(tmp_path / "none"))
    assert manifest.count() == 0 and warc.read(spark, manifest).count() == 0
