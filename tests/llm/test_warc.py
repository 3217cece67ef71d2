import base64
import gzip
import hashlib
import io
import zlib

import pyarrow.dataset as ds
import pytest

from badgeflow.llm import warc
from badgeflow.llm.warc import Reader, WarcError, archive_pages, op6_warc, page_of, page_record, page_row, read_archives, read_files, record_id

PAGES = "page_id bigint, url string, html string"


def want_of(pages):
    """(bytes, digest, type, refers_to) for each (page_id, html), by plain comparison."""
    first = {}
    for page_id, html in pages:
        if page_id is not None:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    out = []
    for page_id, html in pages:
        data = (html or "").encode()
        refers = first.get(html or "")
        again = refers is not None and (page_id is None or page_id > refers)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, len(data), digest, "revisit" if again else "response", refers if again else None))
    return sorted(map(str, out))


def got_of(df):
    return sorted(str(tuple(r)) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())


def test_whole_table(spark, sf_dir):
    pages = ds.dataset(f"{sf_dir}/pages.parquet").to_table().to_pylist()
    assert got_of(op6_warc(spark, sf_dir)) == want_of([(p["page_id"], p["html"]) for p in pages])


ROWS = [
    (5, "http://a/", "same"), (3, None, "same"), (9, "http://b/\r\nX: y", "same"), (4, "u", None), (6, "u", ""),
    (7, "ü", "漢字 \r\n\r\n WARC/1.1\r\n"), (None, "n", "same"), (None, "n", "alone"), (8, "l", "x" * 300_000),
    (-2, "neg", "below"), (2**63 - 1, "max", "below"), (3, None, "same"),
]


def test_edges(spark):
    df = spark.createDataFrame(ROWS, PAGES)
    archives = archive_pages(df)
    assert got_of(read_archives(archives)) == want_of([(i, h) for i, _, h in ROWS])
    found = {r.page_id: r for r in read_archives(archives).collect() if r.page_id is not None}
    assert bytes(found[7].payload).decode() == ROWS[5][2] and found[7].url == "ü"
    assert found[3].url is None and found[9].url == "http://b/%0D%0AX: y" and found[9].payload is None
    assert len(bytes(found[8].payload)) == 300_000
    clash = df.selectExpr("*", "1 AS sha1", "2 AS salt", "3 AS first", "4 AS refers_to", "5 AS data")
    assert got_of(read_archives(archive_pages(clash))) == want_of([(i, h) for i, _, h in ROWS])
    assert read_archives(archive_pages(spark.createDataFrame([], PAGES))).count() == 0


def test_small_archives_and_files(spark, tmp_path):
    df = spark.createDataFrame([(i, f"u{i}", f"page {i} " * 200) for i in range(50)], PAGES)
    archives = warc.write_archives(warc.first_pages(df), archive_bytes=500).collect()
    assert sum(r.n_records for r in archives) == 50 and len(archives) > 10
    assert len({r.archive for r in archives}) == len(archives)
    for r in archives:
        (tmp_path / r.archive).write_bytes(bytes(r.data))
    assert got_of(read_files(spark, str(tmp_path))) == want_of([(i, f"page {i} " * 200) for i in range(50)])


def members(*pages):
    return [page_record(i, "u", h, r) for i, h, r in pages]


def test_one_gzip_member_per_record():
    parts = members((1, b"one", None), (2, b"one", 1), (3, b"", None))
    data = b"".join(parts)
    for size in (1, 7, 1000):
        pieces = [data[at : at + size] for at in range(0, len(data), size)]
        rows = [page_row(r) for r in Reader(pieces)]
        assert [(r[0], r[2], r[4], r[5]) for r in rows] == [(1, 3, "response", None), (2, 3, "revisit", 1), (3, 0, "response", None)]
    for part in parts:
        text = gzip.GzipFile(fileobj=io.BytesIO(part)).read()
        assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
    assert list(Reader([])) == []


def squeezed(text):
    stream = zlib.compressobj(6, zlib.DEFLATED, 31)
    return stream.compress(text) + stream.flush()


@pytest.mark.parametrize(
    "data",
    [
        members((1, b"payload", None))[0][:-9],
        b"no gzip at all",
        squeezed(b"HTTP/1.1 200 OK\r\n\r\n"),
        squeezed(b"WARC/1.1\r\nWARC-Type: response\r\n"),
        squeezed(b"WARC/1.1\r\nWARC-Type: response\r\n\r\nxx\r\n\r\n"),
        squeezed(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nxx\r\n\r\n"),
        squeezed(b"WARC/1.1\r\nContent-Length: 1\r\n\r\nxx\r\n\r\n"),
        squeezed(b"WARC/1.1\r\nContent-Length: 2\r\nWARC-Block-Digest: sha1:AAAA\r\n\r\nxx\r\n\r\n"),
    ],
)
def test_damage_is_noticed(data):
    with pytest.raises(WarcError):
        list(Reader([data]))


def test_a_false_payload_digest_is_noticed():
    (found,) = Reader(members((1, b"payload", None)))
    found.headers["warc-payload-digest"] = "sha1:AAAA"
    with pytest.raises(WarcError):
        page_row(found)


@pytest.mark.parametrize("page_id", [0, 1, -1, 2**62, 2**63 - 1, -(2**63), None])
def test_record_ids(page_id):
    assert page_of(record_id(page_id)) == page_id
