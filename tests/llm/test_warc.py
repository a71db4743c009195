import gzip

import pytest

from quarryline.llm import warc
from quarryline.session import new_path

SCHEMA = "page_id long, url string, html string, payload string, value string"


def there_and_back(spark, rows, **options):
    path = new_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(rows, SCHEMA).repartition(2), path, **options)
    return path, warc.read_archives(spark, path).collect()


@pytest.mark.parametrize("payload", [b"", b"x", b"a\r\n0\r\n\r\nb", bytes(range(256)) * 99])
@pytest.mark.parametrize("size", [1, 7, 8192])
def test_chunks_round_trip(payload, size):
    assert warc.unchunked(warc.chunked(payload, size)) == payload


def test_broken_chunks():
    for body in (b"", b"5\r\nab", b"2\r\nabc\r\n0\r\n\r\n", b"zz\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(body)


@pytest.mark.parametrize("segment_bytes", [64, 1000, 32 << 10])
def test_round_trip(spark, segment_bytes):
    long_html = "é\r\n\r\n<p>ö</p>" * 5000
    rows = [
        (1, "http://a/", "<html>\r\n\r\n1</html>", None, "v"),
        (2, None, None, None, None),
        (3, "http://b/ x\r\ny", "", "p", None),
        (4, "http://c/", long_html, None, None),
        (5, "http://d/", long_html, None, None),
        (5, "http://d/", long_html, None, None),
        (None, "http://e/", "no id", None, None),
        (None, "http://e/", "no id", None, None),
    ]
    _, got = there_and_back(spark, rows, segment_bytes=segment_bytes)
    assert len(got) == len(rows) and all(r["whole"] for r in got)
    by_page = {}
    for r in got:
        by_page.setdefault(r["page"], []).append(r)
    assert bytes(by_page["4"][0]["payload"]).decode() == long_html
    assert [r["record_type"] for r in by_page["5"]] == ["revisit", "revisit"]
    assert {r["refers_to"] for r in by_page["5"]} == {"4"}
    assert (by_page["2"][0]["record_type"], by_page["3"][0]["refers_to"]) == ("response", "2")
    assert sorted(r["record_type"] for r in by_page[None]) == ["response", "revisit"]
    for r in got:
        html = next(h or "" for i, _, h, *_ in rows if (str(i) if i else None) == r["page"])
        assert r["payload_bytes"] == len(html.encode())
        assert r["payload_digest"] == warc.base32_sha1(html.encode())


def test_missing_segment_is_told(spark, tmp_path):
    records = list(warc.response_records("urn:x", '"1"', None, b"abc" * 500, 400))
    assert len(records) > 3
    for name, kept in {"all": records[::-1], "hole": records[:1] + records[2:], "twice": records * 2}.items():
        folder = tmp_path / name
        folder.mkdir()
        for i, record in enumerate(kept):  # each segment in an archive of its own
            (folder / f"{i}.warc.gz").write_bytes(gzip.compress(record + b"\r\n\r\n"))
        [got] = warc.read_archives(spark, str(folder)).collect()
        assert got["whole"] == (name != "hole") and (got["payload"] is None) == (name == "hole")


def test_no_pages(spark):
    assert there_and_back(spark, [])[1] == []
