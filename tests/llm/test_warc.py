import base64
import hashlib
import os
import zlib

import pytest

from lectern.llm import warc

ROWS = [(1, "http://a/ b", "x" * 2000), (2, "http://a", "x" * 2000), (3, "http://c", "x" * 2000), (4, None, None), (5, "u", ""), (6, "u", "é\r\n\r\nWARC/1.1\r\n" * 90), (7, "u", "é\r\n\r\nWARC/1.1\r\n" * 90), (8, "u", "y" * 999), (9, "u", "y" * 999), (None, "u", "x" * 2000), (3, "http://c", "x" * 2000), (10, "u", "long " * 50000)]


@pytest.mark.parametrize("records", [1, 3, 1000])
def test_round_trip(spark, tmp_path, records):
    pages = spark.createDataFrame([(*r, "clash") for r in ROWS], "page_id long, url string, html string, value string").repartition(3)
    warc.write_arc(pages, f"{tmp_path}/arc", records)
    warc.arc_to_warc(spark, f"{tmp_path}/arc", f"{tmp_path}/warc", records=records)
    got = warc.read_warc(spark, f"{tmp_path}/warc").collect()
    row = lambda k, html, kind, to: (-1 if k is None else k, len((html or "").encode()), hashlib.sha1((html or "").encode()).hexdigest(), kind, to)
    revisits = {1: 3, 2: 3, None: 3, 6: 7}
    want = [row(k, h, "revisit" if k in revisits else "response", revisits.get(k)) for k, _, h in ROWS]
    found = [(-1 if r.page_id is None else r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(map(str, found)) == sorted(map(str, want))


@pytest.mark.parametrize("version", [1, 2])
def test_versions_and_lengths(version):
    block = "HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\né\n"
    text = warc.version_block(version, "f.arc", "20200101000000") + "\n" + warc.arc_record(version, "f.arc", "http://a", "20200102030405", block) + "\n"
    (r,) = warc.parse_arc(text.encode())
    assert r["block"] == block.encode() and r["URL"] == "http://a" and warc.iso_date(r["Archive-date"]) == "2020-01-02T03:04:05Z"
    with pytest.raises(ValueError, match="ends within"):
        list(warc.parse_arc(text.encode()[:-4]))
    with pytest.raises(ValueError, match="fields"):
        list(warc.parse_arc(text.replace("http://a ", "http://a b ").encode()))


def test_empty(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_arc(pages, f"{tmp_path}/arc")
    warc.arc_to_warc(spark, f"{tmp_path}/arc", f"{tmp_path}/warc")
    assert warc.read_warc(spark, f"{tmp_path}/warc").count() == 0


def members(data):
    while data:
        z = zlib.decompressobj(wbits=31)
        yield z.decompress(data)
        data = z.unused_data


def test_files_by_bytes(spark, tmp_path):
    """Payloads of 20 MB that do not compress: a file each, and every record a member that can be read alone."""
    large = [base64.b64encode(os.urandom(15 << 20)).decode() for _ in range(3)]
    rows = [(i, "http://a", large[i % 3]) for i in range(4)] + [(10 + i, "http://b", f"{i} " * 600) for i in range(50)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    warc.write_arc(pages, f"{tmp_path}/arc", size=1 << 20)
    warc.arc_to_warc(spark, f"{tmp_path}/arc", f"{tmp_path}/warc", size=1 << 20)
    got = {r.page_id: r for r in warc.read_warc(spark, f"{tmp_path}/warc").collect()}
    assert len(got) == 54 and {k: r.refers_to for k, r in got.items() if r.record_type == "revisit"} == {0: 3}
    assert all(r.payload_digest == hashlib.sha1(html.encode()).hexdigest() for k, _, html in rows for r in [got[k]])
    files = [f.read_bytes() for f in tmp_path.glob("warc/part-*")]
    # the three large payloads; the fourth is a revisit and has none
    assert sum(len(f) > 1 << 20 for f in files) == 3
    for f in files:
        found = [m for m in members(f) if m]
        assert all(m.startswith(b"WARC/1.1\r\n") and m.endswith(b"\r\n\r\n") and len(list(warc.parse_warc(m))) == 1 for m in found)
        assert len(f) <= (1 << 20) + 20 or len(found) == 1


def test_string_keys(spark, tmp_path):
    same = "x" * 1500
    pages = spark.createDataFrame([("9", "u\u00a0v", same), ("10", "u", same), ("a: \r\nb", "u", same + "y"), (None, "u", same)], "page_id string, url string, html string")
    warc.write_arc(pages, f"{tmp_path}/arc")
    warc.arc_to_warc(spark, f"{tmp_path}/arc", f"{tmp_path}/warc")
    got = {r.page_id: r for r in warc.read_warc(spark, f"{tmp_path}/warc", "string").collect()}
    assert {k: r.refers_to for k, r in got.items()} == {"9": "10", "10": None, "a: \r\nb": None, None: "10"}
    assert got["9"].target_uri == "u%C2%A0v"
