from __future__ import annotations

import gzip
import hashlib
from pathlib import Path

import pytest

from cairn.llm import warc


def pages(spark):
    long = "<p>" + "ü" * 200 + "</p>"
    rows = [(5, "http://a/", long), (3, "http://b/\r\nX: y", long), (9, None, "short"), (1, "http://c/", "short"), (7, "http://d/", None), (8, "http://e/", ""), (None, "http://f/", long), (3, "http://g/", long)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


@pytest.mark.parametrize("compress", [True, False])
def test_round_trip(spark, tmp_path, compress):
    path = f"file://{tmp_path}/archive"
    rows = warc.with_revisits(pages(spark))
    warc.write_warc(rows, path, compress)
    got = sorted((r.record_id, r.record_type, r.refers_to or "", r.payload, r.payload_length) for r in warc.read_warc(spark, path).collect())
    want = sorted((r.record_id, r.record_type, r.refers_to or "", None if r.record_type == "revisit" else bytes(r.payload), len(r.payload)) for r in rows.collect())
    assert got == want
    assert sorted(x[0] for x in got if x[1] == "revisit") == ["urn:x-no-page:", "urn:x-page:5"]
    assert {x[2] for x in got if x[1] == "revisit"} == {"urn:x-page:3"}


def test_pushed_predicates_and_skipped_payloads(spark, tmp_path):
    path = f"{tmp_path}/archive"
    warc.write_warc(warc.with_revisits(pages(spark)), path)
    some = warc.read_warc(spark, path, ["record_type", "record_id"]).where("record_type = 'revisit'")
    assert some.count() == 2
    reader = warc.WarcReader(path, some.schema, 1 << 20)
    from pyspark.sql.datasource import EqualTo

    assert list(reader.pushFilters([EqualTo(("record_type",), "revisit")])) == []
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 2


def test_members_are_standard_gzip(spark, tmp_path):
    warc.write_warc(warc.with_revisits(pages(spark)), str(tmp_path / "a"))
    for f in Path(tmp_path / "a").glob("*.warc.gz"):
        assert gzip.open(f).read().startswith(b"WARC/1.1\r\n")


def test_foreign_members_without_lengths_are_read_through(tmp_path):
    import pyarrow.fs as pafs

    data = [warc.render("response", f"<urn:x:{k}>", b"p" * (5000 * k)) for k in range(4)]
    (tmp_path / "x.warc.gz").write_bytes(b"".join(gzip.compress(d) for d in data))
    with pafs.LocalFileSystem().open_input_file(str(tmp_path / "x.warc.gz")) as f:
        assert [len(r.payload) for r in warc.records(f, {}, True)] == [0, 5000, 10000, 15000]


def test_query(spark):
    rows = warc.op9_warc(spark, "/root/testdata/sf0.001").collect()
    html = {r.page_id: (r.html or "").encode() for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    assert {r.page_id: (r.payload_bytes, r.payload_digest) for r in rows} == {k: (len(v), hashlib.sha256(v).hexdigest()) for k, v in html.items()}


def test_ids_of_any_text_come_back(spark, tmp_path):
    long = "<p>" + "ü" * 200
    rows = [("a:b", long), ("a:b:c", long), ("", long), (None, long), ("%41 +é", "short"), ("x\r\ny", None)]
    frame = spark.createDataFrame([(i, "u", h, "clash", "clash") for i, h in rows], "page_id string, url string, html string, met_by string, first string")
    frame.write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r for r in warc.op9_warc(spark, str(tmp_path)).collect()}
    assert set(got) == {i for i, _ in rows}
    for i, h in rows:
        data = (h or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
        assert (got[i].record_type, got[i].refers_to) == (("revisit", "") if h == long and i != "" else ("response", None))


def test_a_long_payload_and_equal_rows(spark, tmp_path):
    rows = [(1, "u", "x" * 9_000_000), (1, "u", "x" * 9_000_000), (2, "u", "x" * 9_000_000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_warc(warc.with_revisits(frame), str(tmp_path / "l"))
    got = sorted((r.record_type, r.payload_length, len(r.payload or b"")) for r in warc.read_warc(spark, str(tmp_path / "l")).collect())
    assert got == [("response", 9_000_000, 9_000_000)] * 2 + [("revisit", 9_000_000, 0)]


def test_overwriting_and_two_writers_at_once(spark, tmp_path):
    path = str(tmp_path / "o")
    own = warc.with_revisits(pages(spark))
    warc.write_warc(own, path)
    other = warc.WarcWriter(path, False, True, 1 << 20)  # a job that has begun and not ended
    own.write.format("warc").mode("overwrite").save(path)
    assert warc.read_warc(spark, path).count() == own.count()
    assert (tmp_path / "o" / other.own).exists()
    other.abort([])
    assert not (tmp_path / "o" / other.own).exists()


def test_empty(spark, tmp_path):
    warc.write_warc(warc.with_revisits(pages(spark).limit(0)), str(tmp_path / "e"))
    assert warc.read_warc(spark, str(tmp_path / "e")).count() == 0
