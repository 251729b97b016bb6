"""WARC records of very long pages, and cuts between characters."""

import base64
import hashlib
import time

import pytest

from folioloom.llm import store, warc


@pytest.mark.parametrize("text", ["", "a", "é" * 9, "a😀" * 7, "x" * 16])
@pytest.mark.parametrize("size", [4, 5, 16])
def test_cut(text, size):
    parts = warc.cut(text.encode(), size)
    assert b"".join(parts).decode() == text and all(len(p) <= size for p in parts)
    assert "".join(p.decode() for p in parts) == text


def test_ten_megabytes(spark):
    pages = [(1, "u", "<p>é long page</p>\r\n\r\n" * 500_000), (2, "u", "short"), (3, "u", "😀" * 100_001)]
    path = store.fresh_path(spark, "test-long")
    begun = time.perf_counter()
    warc.write(spark.createDataFrame(pages, "page_id bigint, url string, html string"), path)
    got = {r["page_id"]: r for r in warc.read(spark, path).collect()}
    assert time.perf_counter() - begun < 60
    for page, _, html in pages:
        raw = html.encode()
        assert got[page]["payload"] == raw and got[page]["payload_bytes"] == len(raw) and got[page]["verified"]
        assert got[page]["payload_digest"] == base64.b32encode(hashlib.sha1(raw).digest()).decode()
