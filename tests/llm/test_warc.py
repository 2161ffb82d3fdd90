import base64
import hashlib

import pytest

pytest.importorskip("fieldmosaic.llm.warc")
from fieldmosaic.llm import common, warc


@pytest.mark.parametrize("least", [0, 3])
def test_round_trip(spark, monkeypatch, least):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2_000)
    monkeypatch.setattr(warc, "READ_BYTES", 900)
    html = ["a", "", None, "<p>é\r\n\r\nx</p>", "abc" * 900, "a", "abc" * 900, "", "zz"] * 3
    rows = [(100 - i, f"http://x/{i}\n é" if i % 5 else None, h, "q") for i, h in enumerate(html)] + [(7, "u", "same", "q"), (7, "u", "same", "q"), (None, "u", "abc" * 900, "q")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    folder = common.new_dir(spark, "warc")
    index = warc.write(df, folder, least)
    got = warc.read(index, folder).collect()
    assert index.count() == len(rows) == len(got) and index.select("archive").distinct().count() > 1
    smallest = {}
    for i, _, h, _ in rows:
        if i is not None:
            smallest[h or ""] = min(i, smallest.get(h or "", 999))
    want = []
    seen = set()
    for i, _, h, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (h or "").encode()
        first = len(raw) < least or (i == smallest[h or ""] and (i, h) not in seen)
        seen.add((i, h))
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if first else "revisit", None if first else smallest[h or ""], raw if first else None))
    key = lambda r: (r[0] is None, r[0] or 0, r[3])
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got), key=key) == sorted(want, key=key)
    assert warc.read(index.where("record_type = 'response'").limit(0), folder).count() == 0


def test_empty(spark):
    folder = common.new_dir(spark, "warc")
    index = warc.write(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert index.count() == 0 and warc.read(index, folder).count() == 0


def test_payload_of_rows_without_an_id(spark):
    rows = [(None, "u", "same"), (None, "v", "same"), (None, "w", None), (None, "x", ""), (3, "y", "other")]
    folder = common.new_dir(spark, "warc")
    index = warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), folder)
    got = warc.read(index, folder, payload=False).collect()
    assert sorted((r.payload_bytes, r.record_type) for r in got) == [(0, "response"), (0, "revisit"), (4, "response"), (4, "revisit"), (5, "response")]
    assert all(r.refers_to is None for r in got) and [r.page_id for r in got if r.payload_bytes == 5] == [3]
