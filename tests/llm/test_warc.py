import base64
import gzip
import hashlib
import io

import pyarrow as pa
import pytest

from llm import shared, warc

PAGES = [
    (1, "http://a.example/1", "<p>same</p>"), (2, "http://a.example/2", "<p>same</p>"), (9, "http://a.example/9?x=1%20 y\r\nz", "<p>same</p>"),
    (3, None, None), (4, "u", ""), (5, "u", "ünïcode \x1f\x8b\x08 in text" * 3), (6, "u", "x" * 600_000), (7, "u", "WARC/1.1\r\n\r\n" * 40),
    (8, "u", "".join(chr(33 + i * i % 90) for i in range(30_000))), (None, "u", "no id"), (None, "u", "<p>same</p>"), (20, "u", "twice"), (20, "u", "twice"),
]


def want(pages, least=0):
    last = {}
    for i, _, html in pages:
        payload = (html or "").encode()
        if i is not None and len(payload) >= least:
            last[payload] = max(i, last.get(payload, i))
    out = []
    for i, url, html in pages:
        payload = (html or "").encode()
        other = last.get(payload)
        refers = other if i is not None and other is not None and i < other else None
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append(("response" if refers is None else "revisit", i, url, len(payload), digest, refers))
    return sorted(map(str, out))


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*p, "extra") for p in PAGES], "page_id long, url string, html string, payload string")


@pytest.mark.parametrize("split_bytes, least", [(97, 0), (4096, 6), (8 << 20, 0)])
def test_archives_are_read_back_whatever_the_splits(pages, split_bytes, least):
    found = warc.archived(pages, least, split_bytes).collect()
    assert sorted(str(tuple(r)) for r in found) == want(PAGES, least)


def test_payloads_survive_and_gzip_reads_the_archives(spark, pages):
    folder = shared.shared_path(spark, "warc")
    manifest = warc.write(warc.with_revisits(pages), folder)
    texts = sorted(bytes(r.payload) for r in warc.read(manifest, 1000).filter("record_type = 'response'").collect())
    assert texts == sorted((h or "").encode() for i, _, h in PAGES if (i, h) not in {(1, "<p>same</p>"), (2, "<p>same</p>"), (3, None)})
    files = manifest.collect()
    for f in files:
        with open(f.path, "rb") as raw:
            whole = gzip.decompress(raw.read())
        assert whole.count(b"WARC-Record-ID") == f.records
    assert sum(f.records for f in files) == len(PAGES)


def test_members_are_owned_by_the_range_they_begin_in():
    parts = [warc.record(i, "u", bytes([65 + i]) * (i * 50)) for i in range(8)]
    noise = [b"", b"\x1f\x8b\x08 no member", gzip.compress(b"not a record"), b"", b"\x1f\x8b", b"", b"\x1f\x8b\x08\x00", b""]
    data = b"".join(n + p for n, p in zip(noise, parts))
    file = pa.PythonFile(io.BytesIO(data), mode="r")
    whole = [warc.parsed(m)["page_id"] for m in warc.members(file, 0, len(data))]
    assert whole == list(range(8))
    for step in (1, 7, 64, 500):
        split = [warc.parsed(m)["page_id"] for a in range(0, len(data), step) for m in warc.members(file, a, min(a + step, len(data)))]
        assert split == whole


def test_damaged_records_are_errors():
    raw = gzip.decompress(warc.record(1, "u", b"payload"))
    with pytest.raises(ValueError, match="digest"):
        warc.parsed(raw.replace(b"payload\r\n", b"pAyload\r\n"))
    with pytest.raises(ValueError, match="long"):
        warc.parsed(raw[:-4])


def test_no_pages(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archived(empty).count() == 0
