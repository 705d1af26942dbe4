"""WARC bundles (9): round trip, SQL, seek tables and random access."""

import io

import pyarrow.fs as pafs
import pytest
import zstandard

from loanlake.llm import warc
from loanlake.llm.warc import op9_warc, read_bundles, read_record, read_seek_table, write_bundles


def test_pages_against_sql(spark, edge, sql):
    rows = op9_warc(spark, edge)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert rows.columns == names
    want = sql(f"select {', '.join(names)} from ({warc.ORACLE})").fetchall()
    found = [tuple(r) for r in rows.collect()]
    # A row without an id refers to the response of its payload; SQL's <> leaves it out.
    found = [(*r[:3], "response", None) if r[0] is None else r for r in found]
    assert sorted(found, key=repr) == sorted(want, key=repr)


def test_nothing(spark, empty):
    assert op9_warc(spark, empty).count() == 0


@pytest.fixture()
def small(monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 2_000)
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 3_000)


def test_index_leads_to_the_record(spark, edge, tmp_path):
    pages = spark.read.parquet(f"{edge}/pages.parquet").where("page_id is not null").distinct()
    folder = str(tmp_path / "bundles")
    index = write_bundles(pages, folder)
    html = {r.page_id: r.html or "" for r in pages.collect()}
    kinds = {r.page_id: r.record_type for r in read_bundles(index, folder).collect()}
    rows = index.collect()
    assert sorted(r.page_id for r in rows) == sorted(html)
    for row in rows:
        head, payload = read_record(folder, row.bundle, row.frame, row.offset)
        assert head["WARC-Record-ID"] == f"<urn:x-page:{row.page_id}>"
        assert payload.decode() == (html[row.page_id] if kinds[row.page_id] == "response" else "")


def test_bundle_is_plain_zstandard_with_a_seek_table(small, tmp_path):
    writer = warc.BundleWriter(str(tmp_path))
    records = [
        warc.record_bytes(i, f"http://x/{i}", bytes([65 + i]) * 900, "0", None, "1970-01-01T00:00:00Z")
        for i in range(9)
    ]
    for i, record in enumerate(records):
        writer.add(i, record)
    writer.close()
    assert sorted(number for number, *_ in writer.index) == list(range(9))
    for bundle in {name for _, name, *_ in writer.index}:
        with pafs.LocalFileSystem().open_input_file(f"{tmp_path}/{bundle}") as file:
            frames = read_seek_table(file)
            plain = b"".join(warc.read_frame(file, frame) for frame in frames)
        data = (tmp_path / bundle).read_bytes()
        stream = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True)
        assert stream.read() == plain
        assert len(frames) == 1 + max(f for _, name, f, _ in writer.index if name == bundle)
    assert plain.count(b"WARC/1.1") >= 1


def test_damage_is_noticed(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://x/", "payload " * 40)], "page_id long, url string, html string")
    folder = tmp_path / "damaged"
    index = write_bundles(pages, str(folder))
    (bundle,) = folder.iterdir()
    frame = zstandard.ZstdDecompressor().decompress(bundle.read_bytes())
    packed = zstandard.ZstdCompressor().compress(frame.replace(b"payload", b"PAYLOAD", 1))
    bundle.write_bytes(packed + warc.seek_table([(len(packed), len(frame))]))
    with pytest.raises(Exception, match="damaged"):
        read_bundles(index, str(folder)).collect()


def test_file_uris():
    assert warc.place_of("file:/tmp/x")[1] == warc.place_of("file:///tmp/x")[1] == "/tmp/x"
    assert warc.place_of("/tmp/x")[1] == "/tmp/x"


def test_bundles_are_read_in_a_task_each(spark, tmp_path):
    pages = spark.range(40).selectExpr("id as page_id", "'u' as url", "repeat(cast(id as string), 9) as html")
    index = write_bundles(pages.repartition(12), str(tmp_path))
    bundles = index.select("bundle").distinct().count()
    assert bundles == 12
    read = read_bundles(index, str(tmp_path))
    assert read.rdd.getNumPartitions() == bundles
    assert read.selectExpr("spark_partition_id()").distinct().count() == bundles
    assert sorted(r.page_id for r in read.collect()) == list(range(40))
