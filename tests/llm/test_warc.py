"""Archives, their index and ranged reads."""

from __future__ import annotations

import gzip
import hashlib
from pathlib import Path

from strata.llm import warc

PAGE = "page_id bigint, url string, html string"


def table(spark, rows):
    return spark.createDataFrame(rows, PAGE)


def expected(rows, least=1000):
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == body and p is not None]
        keeper = max(same, default=None) if len(body) >= least else page_id
        again = keeper is not None and page_id != keeper
        out.append(
            (
                page_id,
                len(body),
                hashlib.sha1(body).hexdigest(),
                "revisit" if again else "response",
                keeper if again else None,
            )
        )
    return out


def key(row):
    return tuple((v is not None, v) if not isinstance(v, str) else (True, v) for v in row)


def test_records_come_back(spark):
    big, long = "<p>é\r\n\r\n" * 300, "x" * 400_000
    rows = [(i, f"http://h/{i}?q= a\r\nX: y", big) for i in range(5)]
    rows += [(9, "http://h/9", big), (7, None, None), (8, "", ""), (10, "u", "short"), (11, "u", "short")]
    rows += [(20, "u", long), (21, "u", long), (22, "u", long + "y"), (None, "n", big), (9, "r", big)]
    rows += [(30, "only ids unknown", "z" * 1000)]
    found = warc.through_archives(spark, table(spark, rows)).collect()
    got = [
        (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found
    ]
    assert sorted(got, key=key) == sorted(expected(rows), key=key)
    for r in found:
        if r.record_type == "response":
            assert hashlib.sha1(bytes(r.payload)).hexdigest() == r.payload_digest


def test_selected_records_are_read_through_their_places(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"page {i} " * (1 + 50 * i)) for i in range(40)]
    path = (tmp_path / "warc").as_uri()
    (tmp_path / "warc").mkdir()
    index = warc.write(table(spark, rows).coalesce(2), path, archive_bytes=3000)
    assert index.count() == 40
    wanted = index.where("page_id % 7 = 0")
    for gap, longest in ((0, 1), (1 << 16, 1 << 20)):
        read = warc.read(wanted, path, gap, longest).collect()
        assert {r.page_id: bytes(r.payload).decode() for r in read} == {
            p: h for p, _, h in rows if p % 7 == 0
        }


def test_archives_are_plain_warc(spark, tmp_path):
    (tmp_path / "warc").mkdir()
    warc.write(table(spark, [(1, "http://h/1", "a" * 2000), (2, "http://h/2", "a" * 2000)]).coalesce(1),
               (tmp_path / "warc").as_uri())
    data = b"".join(gzip.decompress(p.read_bytes()) for p in Path(tmp_path / "warc").iterdir())
    assert data.count(b"WARC/1.1\r\n") == 2 and data.endswith(b"\r\n\r\n")
    assert b"WARC-Refers-To: <urn:page:2>" in data and data.count(b"a" * 2000) == 1


def test_empty_table(spark):
    assert warc.through_archives(spark, table(spark, [])).count() == 0
