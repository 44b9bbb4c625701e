import base64
import gzip
import hashlib
import random

import pytest
from frames import prose
from pyspark.sql import functions as F

from stocktide.llm import warc
from stocktide.llm.warc import archive_round_trip, read_archives, write_archives


def pages(spark, rows):
    made = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return made.withColumns({c: F.lit("x") for c in ("digest", "first", "_page", "path", "n")})


def case():
    rng = random.Random(18)
    same = "<p>" + prose(rng, 50)
    rows = [(i, f"http://a.example/{i}", prose(rng, rng.randrange(400))) for i in range(120)]
    rows += [(200 + i, f"http://b.example/{i}", same) for i in range(30)]
    rows += [(300, None, None), (301, "http://c.example/a\r\nb", ""), (302, "", "é😀" * 1000), (None, "u", same),
             (None, "u", "alone"), (303, "x", "z" * 3_000_000), (200, "again", same), (400, "g", "\x1f\x8b\x08 WARC/1.1")]
    return rows


def expected(rows, least):
    first = {}
    for page, _, html in rows:
        if page is not None:
            first[html or ""] = min(first.get(html or "", 1 << 60), page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        known = first.get(html or "")
        revisit = len(data) >= least and known is not None and known != page
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, len(data), digest, "revisit" if revisit else "response", known if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    monkeypatch.setattr(warc, "RANGE_BYTES", 5_000)
    for least in (0, 100):
        found = archive_round_trip(spark, pages(spark, case()), least).drop("target_uri").collect()
        assert sorted(map(tuple, found), key=str) == expected(case(), least)


def test_any_range_size_reads_the_same(spark, tmp_path):
    folder = str(tmp_path / "w")
    files = write_archives(pages(spark, case()).coalesce(1), folder)
    total = files.agg(F.sum("records")).first()[0]
    assert total == len(case())
    seen = set()
    for size in (997, 60_000, 1 << 30):
        rows = read_archives(files, size).collect()
        assert len(rows) == total
        seen.add(frozenset((r.path, r.offset, r.record_id, r.type, r.payload_digest, bytes(r.payload)) for r in rows))
    assert len(seen) == 1
    whole = b"".join(gzip.open(r.path.removeprefix("file:")).read() for r in files.collect())
    assert whole.count(b"WARC/1.1\r\nWARC-Type: ") == total
    for r in read_archives(files).where("type = 'response'").collect():
        assert _sha1(r.payload) == r.payload_digest and len(r.payload) == r.payload_bytes


def _sha1(data):
    return base64.b32encode(hashlib.sha1(bytes(data)).digest()).decode()


def test_bytes_that_are_no_record_are_skipped(spark, tmp_path):
    folder = str(tmp_path / "w")
    files = write_archives(pages(spark, case()[:20]), folder).collect()
    path = tmp_path / "joined.warc.gz"
    noise = b"\x1f\x8b\x08" + bytes(range(256)) + gzip.compress(b"not a record")
    path.write_bytes(noise + b"".join(open(f.path.removeprefix("file:"), "rb").read() for f in files))
    frame = spark.createDataFrame([(str(path), path.stat().st_size)], "path string, bytes bigint")
    assert read_archives(frame, 1000).count() == 20


def test_a_header_longer_than_a_step_is_read(spark, tmp_path):
    rng = random.Random(19)
    long = "data:" + "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGH0123456789+/") for _ in range(200_000))
    rows = [(1, "http://a.example/1", "one"), (2, long, "two"), (3, "http://a.example/3", "three")]
    found = {r.page_id: r.target_uri for r in archive_round_trip(spark, pages(spark, rows)).collect()}
    assert found == {page: url for page, url, _ in rows}
    files = write_archives(pages(spark, rows).coalesce(1), str(tmp_path / "w"))
    assert [read_archives(files, size).count() for size in (997, 60_000, 1 << 30)] == [3, 3, 3]


def test_a_missing_record_is_an_error(spark, tmp_path):
    files = write_archives(pages(spark, case()).coalesce(1), str(tmp_path / "w"))
    assert warc.complete(read_archives(files), files).count() == len(case())
    with pytest.raises(ValueError, match="were read"):
        warc.complete(read_archives(files).where("record_id <> 'urn:page:5'"), files)
    with pytest.raises(ValueError, match="0 were read"):
        warc.complete(read_archives(files).where("false"), files)


def test_empty_table(spark):
    assert archive_round_trip(spark, pages(spark, [])).collect() == []
