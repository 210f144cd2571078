import base64
import hashlib
import io
import random

import pytest

from doorstep.llm import warc

SCHEMA = "page_id long, url string, html string"


def brute(pages):
    best = {}
    for page, _, html in pages:
        html = html or ""
        if page is not None and (best.get(html) is None or page > best[html]):
            best[html] = page
        best.setdefault(html, None)
    rows = []
    for page, _, html in pages:
        data = (html or "").encode()
        first = page == best[html or ""]
        rows.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if first else "revisit", None if first else best[html or ""]))
    return sorted(rows, key=repr)


@pytest.fixture
def pages():
    rng = random.Random(1)
    texts = ["", None, "a", "é\r\n\r\nWARC/1.1\r\n\r\n", "\r\n\r\n", "WARC/1.1\r\nContent-Length: 5\r\n\r\n", "x" * 70_000, "日本" * 9000]
    rows = [(i, rng.choice([None, "http://a b/\r\nX: y", f"http://h/{i}"]), rng.choice([*texts, f"own {i}"])) for i in range(80)]
    return rows + [(5, None, "dup id"), (5, None, "dup id"), (None, None, "only null"), (None, "u", "a")]


def test_pages_by_brute_force(spark, pages):
    df = spark.createDataFrame(pages, SCHEMA).repartition(3).selectExpr("*", "1 as digest", "2 as response")
    got = [tuple(r) for r in warc.page_records(df).collect()]
    assert sorted(got, key=repr) == brute(pages)
    assert warc.page_records(df.limit(0)).count() == 0


def test_archives_hold_the_payloads(spark, pages, tmp_path):
    df = spark.createDataFrame(pages, SCHEMA)
    manifest = warc.write_archives(warc.plan_records(df), str(tmp_path / "w"), file_bytes=20_000)
    assert manifest.count() >= 3 and {p.suffix for p in (tmp_path / "w").iterdir()} == {".gz"}
    payloads = {}
    for r in warc.read_chunks(manifest).where("record_type = 'response'").orderBy("page_id", "chunk_no").collect():
        payloads.setdefault(r.page_id, []).append(bytes(r.data))
    want = {p: (h or "").encode() for p, _, h in pages}
    for page in set(payloads) - {5, None}:
        assert b"".join(payloads[page]) == want[page]


@pytest.mark.parametrize("chunk", [1, 7, 5000])
def test_chunks_and_running_digests(chunk):
    data = bytes(range(256)) * 40
    head = warc.record_head(9, "u", "response", None, len(data), "X")
    other = warc.record_head(3, None, "revisit", 9, len(data), "DIGEST")
    stream = io.BytesIO(head + data + b"\r\n\r\n" + other + b"\r\n\r\n" + head.replace(b"10240", b"0") + b"\r\n\r\n")
    rows = list(warc.read_records(stream, chunk))
    big = [r for r in rows if r[0] == 9][: -(-len(data) // chunk)]
    assert [r[3] for r in big] == list(range(len(big))) and all(len(r[5]) <= chunk for r in big)
    for r in big[:: max(1, len(big) // 9)]:
        assert r[6] == warc._base32(hashlib.sha1(data[: r[4] + len(r[5])]).digest())
    assert [r[7] for r in big] == [False] * (len(big) - 1) + [True]
    assert rows[-2][:4] == (3, "revisit", 9, 0) and rows[-2][4:] == (len(data), b"", "DIGEST", True)
    assert rows[-1][5:] == (b"", warc._base32(hashlib.sha1().digest()), True)


def test_broken_archives():
    head = warc.record_head(9, "u", "response", None, 10, "X")
    for bad in (head[:-6], head + b"short", head + b"0123456789abcd", b"HTTP/1.1 200\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.read_records(io.BytesIO(bad)))


def test_archives_are_read_by_many_tasks(spark, pages, tmp_path):
    df = spark.createDataFrame(pages, SCHEMA)
    manifest = warc.write_archives(warc.plan_records(df), str(tmp_path / "w"), file_bytes=2_000)
    assert manifest.count() >= 8
    chunks = warc.read_chunks(manifest, with_data=False)
    chunks.count()
    assert chunks.rdd.getNumPartitions() == manifest.count()
