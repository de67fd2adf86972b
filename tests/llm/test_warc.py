from __future__ import annotations

import gzip
import hashlib
from base64 import b32encode

import pytest
from pyarrow import fs

from ledgermend.llm.files import MANIFEST, filesystem
from ledgermend.llm.store import new_path
from ledgermend.llm.warc import read_archives, write_archives

SCHEMA = "page_id long, url string, html string, payload string, sha1 string, response long"
ROWS = [
    (1, "http://a/x", "<p>one</p>"),
    (2, "http://a/y z\r\nX: y", "<p>one</p>"),
    (9, None, "<p>one</p>"),
    (9, None, "<p>one</p>"),  # a repeated row
    (4, "http://ä/", None),
    (3, "", ""),
    (5, "http://b/", "\r\n\r\nWARC/1.1\r\n\r\n" * 3),
    (6, "http://c/", "é漢🙂" * 50_000),
    (None, "http://d/", "<p>one</p>"),
    (None, "http://e/", "alone"),
    (None, None, "nameless twice"),
    (None, None, "nameless twice"),
    *[(100 + k, f"http://h/{k}", f"page {k} " * 400) for k in range(40)],
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "x", "y", 7) for r in ROWS], SCHEMA)


def sha(html: str | None) -> str:
    return b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def files(uri: str) -> dict[str, bytes]:
    system, path = filesystem(uri)
    found = system.get_file_info(fs.FileSelector(path))
    return {f.base_name: system.open_input_stream(f.path, compression=None).read() for f in found}


def test_round_trip(spark, pages):
    uri = new_path(spark, "warc-test")
    write_archives(pages, uri)
    got = read_archives(spark, uri).collect()
    want: dict = {}
    for page_id, _, html in ROWS:
        want.setdefault(sha(html), []).append(page_id)
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in got) == sorted((str(p), len((h or "").encode()), sha(h)) for p, _, h in ROWS)
    for key, ids in want.items():
        own = [r for r in got if r.payload_digest == key]
        named = [i for i in ids if i is not None]
        if not named:
            assert all(r.record_type == "response" and r.refers_to is None for r in own)
            continue
        assert [r.page_id for r in own if r.record_type == "response"] == [max(named)]
        assert all(r.refers_to == max(named) for r in own if r.record_type == "revisit")
    payloads = {r.page_id: bytes(r.payload) for r in got if r.record_type == "response"}
    assert payloads[5] == ROWS[6][2].encode() and payloads[6] == ROWS[7][2].encode()
    assert all(r.payload is None for r in got if r.record_type == "revisit")


def test_archives_are_plain_gzip_and_do_not_change(spark, pages):
    first, second = new_path(spark, "warc-test"), new_path(spark, "warc-test")
    write_archives(pages, first, roll_bytes=2000)
    write_archives(pages, second, roll_bytes=2000)
    one, two = files(first), files(second)
    assert one == two and MANIFEST in one and len(one) > 5
    assert not [name for name in one if name.endswith(".tmp")]
    archives = [gzip.decompress(data) for name, data in one.items() if name != MANIFEST]
    assert all(a.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") for a in archives)
    assert b"\r\nX: y" not in b"".join(archives)
    assert read_archives(spark, first).count() == len(ROWS)


def test_files_beside_the_manifest_do_not_count(spark, pages):
    uri = new_path(spark, "warc-test")
    write_archives(pages, uri)
    system, path = filesystem(uri)
    with system.open_output_stream(f"{path}/pages-999999-000000.warc.gz") as out:
        out.write(b"left by a lost attempt")
    assert read_archives(spark, uri).count() == len(ROWS)


def test_small_payloads_and_no_rows(spark, pages):
    uri = new_path(spark, "warc-test")
    write_archives(pages, uri, least_bytes=11)
    assert {r.record_type for r in read_archives(spark, uri).where("payload_bytes <= 10").collect()} == {"response"}
    empty = new_path(spark, "warc-test")
    write_archives(pages.where("false"), empty)
    assert read_archives(spark, empty).collect() == []


def test_repeated_rows_over_several_partitions(spark):
    """One page_id and payload in many rows with different URLs has one response."""
    rows = [(7, f"http://x/{k}", "<p>same</p>") for k in range(400)] + [(k % 5, f"http://y/{k}", "<p>same</p>") for k in range(50)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(8)
    uri = new_path(spark, "warc-test")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        write_archives(frame, uri)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    got = read_archives(spark, uri).collect()
    assert len(got) == 450 and [r.page_id for r in got if r.record_type == "response"] == [7]
    assert all(r.refers_to == 7 for r in got if r.record_type == "revisit")
