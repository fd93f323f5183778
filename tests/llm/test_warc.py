import hashlib
from io import BytesIO

import pyarrow as pa
import zstandard

from tallgrass.llm import warc
from tallgrass.plans.durable import scratch

PAGES = "page_id long, url string, html string, digest string, kept_id long"


def through(spark, rows, **options):
    pages = spark.createDataFrame([(*r, "x", 7) for r in rows], PAGES)
    folder = scratch(spark, "warc-test")
    index = warc.write_bundles(pages, folder, **options)
    return folder, index, [tuple(r)[:5] for r in warc.read_bundles(spark, folder, index).collect()]


def test_round_trip_and_revisits(spark):
    big, small = "é" * 600, "<p>x</p>"
    rows = [(1, "http://a", big), (9, None, big), (4, "http://c\r\nX: y", big), (2, "u", small), (3, "u", small), (5, "u", None), (None, "u", ""), (6, "u", "\r\n\r\nWARC/1.1\r\n" * 90)]
    folder, index, found = through(spark, rows)
    expected = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        other = 9 if html == big and page_id != 9 else None
        expected.append((page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if other else "response", other))
    order = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(found, key=order) == sorted(expected, key=order)
    for entry in index.collect():
        fields, payload = warc.fetch(folder, entry.bundle, entry.frame, entry.at)
        html = next(h for p, _, h in rows if p == entry.page_id)
        assert fields["X-Page-ID"] == ("" if entry.page_id is None else str(entry.page_id))
        assert payload == (b"" if fields["WARC-Type"] == "revisit" else (html or "").encode())


def test_repeated_rows_and_empty_table(spark):
    assert sorted(through(spark, [(1, "u", "a" * 2000)] * 2 + [(0, "u", "a" * 2000)])[2])[0][3:] == ("revisit", 1)
    assert through(spark, [])[2] == []


def test_frames_are_independent_and_any_zstd_reader_reads_them():
    out = BytesIO()
    writer = warc.BundleWriter(out, frame_bytes=50, frame_records=3)
    records = [bytes([65 + k]) * (10 + 7 * k) for k in range(9)]
    places = [writer.add(r) for r in records]
    writer.close()
    source = pa.BufferReader(out.getvalue())
    frames = warc.seek_table(source)
    assert len(frames) > 2
    for (frame, at), record in zip(places, records):
        assert warc.read_frame(source, frames, frame)[at : at + len(record)] == record
    reader = zstandard.ZstdDecompressor().stream_reader(BytesIO(out.getvalue()), read_across_frames=True)
    assert reader.read() == b"".join(records)


def test_every_record_has_an_id_of_its_own(spark):
    rows = [(1, "u", "a" * 2000), (1, "u", "a" * 2000), (None, "v", "b"), (None, "v", "b"), (0, "w", "a" * 2000)]
    folder, index, _ = through(spark, rows)
    fields = [warc.fetch(folder, r.bundle, r.frame, r.at)[0] for r in index.collect()]
    assert len({x["WARC-Record-ID"] for x in fields}) == len(rows)
    assert [x["WARC-Refers-To-Target-URI"] for x in fields if x["WARC-Type"] == "revisit"] == ["u"]


def test_a_payload_longer_than_a_frame(spark):
    long = "é" * (3 * warc.FRAME_BYTES // 2)
    folder, index, found = through(spark, [(1, "u", long), (2, "u", "x"), (3, "u", long)])
    assert sorted(found) == sorted([(k, len(raw := h.encode()), hashlib.sha1(raw).hexdigest(), t, o) for k, h, t, o in [(1, long, "revisit", 3), (2, "x", "response", None), (3, long, "response", None)]])
    entry = next(r for r in index.collect() if r.page_id == 3)
    assert warc.fetch(folder, entry.bundle, entry.frame, entry.at)[1].decode() == long
