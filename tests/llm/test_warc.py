import gzip
import hashlib
import io

import pytest

from fairtally.llm import warc

SCHEMA = "page_id bigint, url string, html string, payload_digest string, original bigint"


def test_round_trip(spark, tmp_path):
    big, other = "ä" * 600, "x" * 999
    rows = [
        (1, "http://a/1", big),
        (2, "http://a/2\r\n%41", big),
        (3, None, big),
        (3, None, big),
        (4, "u", other),
        (5, "u", other),
        (6, "u", None),
        (7, "u", ""),
        (None, "u", big),
        (8, "u", "<p>\r\n\r\nWARC/1.1" * 200_000),
    ]
    pages = spark.createDataFrame([(*r, "d", 0) for r in rows], SCHEMA)
    files = warc.write_warc(pages, str(tmp_path / "w"), most_bytes=400)
    assert files.count() > 2
    read = warc.read_warc(files).collect()
    payload = {p: (h or "").encode() for p, _, h in rows}
    assert sorted(r.page_id or 0 for r in read) == sorted(p or 0 for p, _, _ in rows)
    for r in read:
        assert r.payload_bytes == len(payload[r.page_id])
        assert r.payload_digest == hashlib.sha1(payload[r.page_id]).hexdigest()
        assert r.refers_to == {1: 3, 2: 3}.get(r.page_id)
        assert r.record_type == ("revisit" if r.refers_to else "response")
        assert r.payload == (None if r.refers_to else payload[r.page_id])
    assert {r.url for r in read if r.page_id == 2} == {"http://a/2\r\n%41"}
    # Each archive is plain gzip too.
    for f in files.collect():
        with open(f.path.removeprefix("file://"), "rb") as file:
            assert gzip.decompress(file.read()).count(b"WARC-Record-ID") == f.records


def test_damage_is_noticed():
    record = warc._record(1, "u", hashlib.sha1(b"abc").hexdigest(), 3, None, b"abc")
    assert [warc.parse_record(m)["payload"] for m in warc.members(io.BytesIO(record * 3))] == [b"abc"] * 3
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(record[:-9])))
    plain = gzip.decompress(record)
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(plain.replace(b"abc", b"abd"))
    with pytest.raises(ValueError, match="length"):
        warc.parse_record(plain.replace(b"abc", b"ab"))


def test_no_pages(spark, tmp_path):
    files = warc.write_warc(spark.createDataFrame([], SCHEMA), str(tmp_path / "w"))
    assert warc.read_warc(files).collect() == []
