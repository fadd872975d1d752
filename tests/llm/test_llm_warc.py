import base64
import gzip
import hashlib

import pyarrow.fs
import pytest

from conftest import SF_SMALL
from lanekit.llm import warc
from lanekit.llm.queries import QUERIES
from lanekit.sources.scratch import scratch_path

SAME = "<p>the same</p>"
ROWS = [(5, "http://a/", SAME), (3, "http://b/", SAME), (9, None, SAME), (None, "http://c/", SAME), (1, "http://d/", None),
        (2, "x\r\ny", ""), (7, "http://e/", "é" * 100_000), (7, "http://e/", "é" * 100_000), (8, "http://f/", "a\r\n\r\nb")]


def pages(spark, rows=ROWS):
    return spark.createDataFrame([r + (1, "z") for r in rows],
                                 "page_id bigint, url string, html string, first bigint, sha string").repartition(3)


def brute(rows, least=0):
    raw = [(p, (h or "").encode()) for p, _, h in rows]
    out = []
    for p, data in raw:
        same = [q for q, d in raw if d == data and q is not None]
        first = min(same) if same and len(data) >= least else None
        revisit = sum(d == data for _, d in raw) > 1 and first is not None and first != p
        out.append((p is None, p, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if revisit else "response", first if revisit else None))
    return sorted(out)


@pytest.mark.parametrize("least", [0, 1, 16])
def test_round_trip(spark, least):
    got = warc.archived(spark, pages(spark), least).collect()
    assert sorted((r.page_id is None, *r) for r in got) == brute(ROWS, least)


def test_query(spark):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()]
    got = QUERIES["op4_warc_archive"](spark, SF_SMALL).collect()
    assert sorted((r.page_id is None, *r) for r in got) == brute(rows)


def test_index_selects_records(spark):
    """Only the selected byte ranges are read, coalesced or one by one."""
    index = warc.write(pages(spark), scratch_path(spark, "t-warc"), archive_bytes=300)
    some = index.filter("page_id in (1, 3, 8)")
    for gap in (0, 1 << 20):
        got = {r.page_id: r for r in warc.read(some, payload=True, gap_bytes=gap, read_bytes=400).collect()}
        assert set(got) == {1, 3, 8}
        assert bytes(got[8].payload) == b"a\r\n\r\nb" and bytes(got[3].payload) == SAME.encode()
    assert index.select("file").distinct().count() > 3


def test_archives_are_warc(spark):
    index = warc.write(pages(spark), scratch_path(spark, "t-warc")).collect()
    for r in index:
        fs, path = warc.filesystem(r.file)
        data = fs.open_input_file(path).read()
        raw = gzip.decompress(data[r.offset:r.offset + r.length])
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.split(b"\r\n")
        assert lines[0] == b"WARC/1.1" and raw.endswith(b"\r\n\r\n")
        fields = dict(x.split(b": ", 1) for x in lines[1:])
        assert int(fields[b"Content-Length"]) == len(rest) - 4
        assert fields[b"WARC-Type"].decode() == r.record_type


def test_damage_is_an_error(spark):
    index = warc.write(pages(spark, ROWS[:1]), scratch_path(spark, "t-warc"))
    row = index.first()
    fs, path = warc.filesystem(row.file)
    with fs.open_output_stream(path, compression=None) as f:
        raw = warc.record(5, None, b"other", None).replace(warc.digest(b"other").encode(), warc.digest(b"x").encode())
        f.write(gzip.compress(raw))
    with pytest.raises(Exception, match="does not have its digest|Compressed file ended|CRC|no WARC"):
        warc.read(index).collect()


def test_empty_and_folders(spark):
    assert warc.archived(spark, pages(spark).limit(0)).count() == 0
    for name in ("/tmp/x", "file:/tmp/x", "file:///tmp/x"):
        fs, path = warc.filesystem(name)
        assert isinstance(fs, pyarrow.fs.LocalFileSystem) and path == "/tmp/x"
