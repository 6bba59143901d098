import gzip
import json
import zlib

import pytest

from tools.check_oracle import duck, rows_of
from vaultline.llm import warc as W
from vaultline.llm.common import table

from ..conftest import SF_SMALL
from . import cases

KIND = "page_id long, url string, html string, digest string, offset int"


def frame(spark):
    rows = [(1, "http://a/\r\nX-Evil: 1", "<p>é 💥\r\n\r\n</p>", "c", 1), (2, "http://b/", "same", "c", 1), (9, None, "same", "c", 1),
            (5, "http://c/", "same", "c", 1), (5, "http://c/", "same", "c", 1), (6, "u", None, "c", 1), (7, "u", "", "c", 1),
            (8, "http://long/", "z" * 3_000_000, "c", 1), (None, "n", "alone", "c", 1), (None, "n", "same", "c", 1)]
    return spark.createDataFrame(rows, KIND)


def test_query_equals_sql(spark):
    assert rows_of(W.op10_warc(spark, SF_SMALL).toPandas()) == rows_of(duck(SF_SMALL).sql(W.ORACLE).df())


@pytest.mark.parametrize("archive_bytes", [1, 64 << 20])
def test_round_trip(spark, archive_bytes):
    pages = frame(spark)
    got = W.read_records(W.normalise(W.write_archives(pages, archive_bytes=archive_bytes))).collect()
    assert len(got) == pages.count()
    top = {"same": 9, "": 7}
    for r in got:
        source = [p for p in pages.collect() if p["page_id"] == r["page_id"] and W.base32_sha1((p["html"] or "").encode()) == r["payload_digest"]]
        text = source[0]["html"] or ""
        assert r["payload_bytes"] == len(text.encode())
        first = top.get(text, r["page_id"])
        assert (r["record_type"], r["refers_to"]) == (("response", None) if r["page_id"] == first else ("revisit", first))
        assert r["payload"] == (text if r["record_type"] == "response" else None)
        assert "\n" not in r["url"] and "\r" not in r["url"]


def test_small_payloads_may_all_be_responses(spark):
    got = W.read_records(W.normalise(W.write_archives(frame(spark), min_bytes=5))).collect()
    assert {r["record_type"] for r in got if r["payload_bytes"] < 5} == {"response"}


def test_members_and_index(spark, tmp_path):
    """One stream becomes a member for every record; the index finds each alone; other tools' members are read as well."""
    records = [W.record(i, f"http://h/{i}", ("x" * i).encode(), W.base32_sha1(("x" * i).encode()), None) for i in range(50)]
    for name, data in (("one", gzip.compress(b"".join(records))), ("many", b"".join(map(gzip.compress, records)))):
        (tmp_path / f"{name}.warc.gz").write_bytes(data)
        out, index = W._rewrite(str(tmp_path / f"{name}.warc.gz"), str(tmp_path), f"{name}-new.warc.gz")
        whole = (tmp_path / f"{name}-new.warc.gz").read_bytes()
        assert [zlib.decompress(whole[a:a + n], 31) for a, n, _, _ in index] == records
        assert gzip.decompress(whole) == b"".join(records)
        side = [json.loads(x) for x in (tmp_path / f"{name}-new.warc.gz.idx").read_text().splitlines()]
        assert [(x["offset"], x["length"], x["record"], x["type"]) for x in side] == index


def test_broken_archives_are_refused(tmp_path):
    record = W.record(1, "http://h/", b"payload", W.base32_sha1(b"payload"), None)
    for cut in (20, len(record) - 6):
        (tmp_path / "cut.warc.gz").write_bytes(gzip.compress(record[:cut]))
        with pytest.raises(ValueError, match="the file ends"):
            W._rewrite(str(tmp_path / "cut.warc.gz"), str(tmp_path), "new.warc.gz")


@pytest.mark.parametrize("kept", [1, 3])
def test_a_stream_cut_between_two_records_is_refused(tmp_path, kept):
    """All that can be inflated are whole records, but the stream has no end."""
    records = [W.record(i, "http://h/", b"payload", W.base32_sha1(b"payload"), None) for i in range(6)]
    stream = zlib.compressobj(1, zlib.DEFLATED, 31)
    data = stream.compress(b"".join(records[:kept])) + stream.flush(zlib.Z_SYNC_FLUSH)
    (tmp_path / "cut.warc.gz").write_bytes(data)
    with pytest.raises(ValueError, match="cut off"):
        W._rewrite(str(tmp_path / "cut.warc.gz"), str(tmp_path), "new.warc.gz")
    (tmp_path / "cut.warc.gz").write_bytes(gzip.compress(records[0]) + data)
    with pytest.raises(ValueError, match="cut off"):
        W._rewrite(str(tmp_path / "cut.warc.gz"), str(tmp_path), "new.warc.gz")
    assert not (tmp_path / "new.warc.gz").exists()


def test_archives_are_read_in_several_tasks(spark):
    index = W.normalise(W.write_archives(frame(spark).repartition(3), archive_bytes=1))
    found = W.read_records(index).selectExpr("*", "spark_partition_id() AS task").collect()
    assert len({r["task"] for r in found}) > 1


def test_empty_table(spark):
    assert W.read_records(W.normalise(W.write_archives(frame(spark).limit(0)))).count() == 0
    assert table(spark, SF_SMALL, "pages").count() > 0 and cases is not None
