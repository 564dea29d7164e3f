"""Archives: an exact round trip, seek tables, single records."""

import random
from hashlib import sha256

import pytest
import zstandard
from pyarrow import fs
from pyspark.sql import functions as F

from casefeatures.llm import warc
from casefeatures.sources.files import scratch_path

PAGES = "page_id long, url string, html string"


def pages(seed=1):
    rng = random.Random(seed)
    big = "<p>" + "".join(chr(rng.randrange(97, 123)) for _ in range(300)) + "</p>"
    rows = [(i, f"http://x/{i}", f"<p>{i} " + "é" * rng.randrange(200)) for i in range(40)]
    rows += [(50, "http://a b\r\nX: y", big), (41, None, big), (45, "u", big), (60, "u", "x" * 99), (61, "u", "x" * 99), (62, "u", "x" * 100), (63, "u", "x" * 100)]
    rows += [(70, "u", None), (71, None, ""), (72, "u", None), (41, None, big), (None, "u", big), (None, "u", "n" * 200), (80, "u", "WARC/1.1\r\n\r\n" * 50), (81, "u", "m" * 3_000_000)]
    return rows


def brute(rows):
    first = {}
    for i, _, html in rows:
        raw = (html or "").encode()
        if len(raw) >= 100 and i is not None:
            first[raw] = min(i, first.get(raw, i))
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        revisit = raw in first and first[raw] != i
        out.append((i, len(raw), sha256(raw).hexdigest(), "revisit" if revisit else "response", first[raw] if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("frame", [200, 1 << 20])
def test_round_trip(spark, monkeypatch, frame):
    monkeypatch.setattr(warc, "FRAME_BYTES", frame)
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 4000)
    rows = pages()
    df = spark.createDataFrame(rows, PAGES).repartition(3).withColumns({"digest": F.lit(1), "path": F.lit(""), "first": F.lit(0)})
    out = warc.round_trip(df, scratch_path(spark, "archives"))
    assert sorted((tuple(r)[:5] for r in out.collect()), key=str) == brute(rows)


def test_shuffled_groups_agree(spark, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    rows = pages(2)
    out = warc.round_trip(spark.createDataFrame(rows, PAGES), scratch_path(spark, "archives"))
    assert sorted((tuple(r)[:5] for r in out.collect()), key=str) == brute(rows)


def test_single_records_and_plain_readers(spark, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 500)
    rows = [r for r in pages() if r[0] is not None]
    folder = scratch_path(spark, "archives")
    index = warc.write_archives(spark.createDataFrame(rows, PAGES), folder).cache()
    got = {r["page_id"]: r["payload"] for r in warc.fetch(index.where("record_type = 'response'"), folder).collect()}
    for i, _, html in rows:
        if i in got:
            assert bytes(got[i]) == (html or "").encode()
    assert set(got) == {b[0] for b in brute(rows) if b[3] == "response"}
    for r in index.select("path").distinct().collect():
        with fs.LocalFileSystem().open_input_file(r["path"]) as f:
            frames = warc.frames_of(f)
            f.seek(0)
            raw = f.read()
        # A reader that knows no seek table reads the frames one after the other and skips the footer.
        assert len(zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()) == sum(x[2] for x in frames)


def test_damage_is_noticed(tmp_path):
    text = warc.record(1, "u", b"abc", sha256(b"abc").hexdigest(), 3, "response", None)
    packed = zstandard.ZstdCompressor().compress(text)
    (tmp_path / "a").write_bytes(packed + warc.seek_table([(len(packed), len(text), 1)]))
    with fs.LocalFileSystem().open_input_file(str(tmp_path / "a")) as f:
        with pytest.raises(ValueError, match="checksum"):
            warc.read_frame(f, *warc.frames_of(f)[0])


def test_empty(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES), scratch_path(spark, "archives")).collect() == []
