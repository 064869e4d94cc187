from __future__ import annotations

import hashlib

import zstandard
from pyspark.sql import functions as F

from tidemark.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, first int"


def brute(rows):
    def payload(r):
        return (r[2] or "").encode()

    first = {}
    for r in rows:
        if r[0] is not None and len(payload(r)) >= warc.LEAST_REVISIT:
            first[payload(r)] = min(r[0], first.get(payload(r), r[0]))
    out = []
    for r in rows:
        lead = first.get(payload(r))
        refers = lead if lead is not None and lead != r[0] else None
        kind = "response" if refers is None else "revisit"
        out.append((r[0], len(payload(r)), hashlib.sha256(payload(r)).hexdigest(), kind, refers))
    return sorted(out, key=str)


def rows_in():
    long = "<p>é" + "x" * 200
    rows = [(i, f"http://a/{i % 7}\r\nX: y", long if i % 3 == 0 else f"{long}{i}") for i in range(60)]
    rows += [(100, None, None), (101, "u", ""), (102, "u", "short"), (103, "u", "short"), (None, "u", long)]
    rows += [(0, "again", long), (None, None, None), (200, "big", "y" * 3_000_000), (150, "z", "y" * 3_000_000)]
    return [(*r, "clash", 1) for r in rows]


def test_round_trip(spark):
    rows = rows_in()
    index, read = warc.archive(spark.createDataFrame(rows, SCHEMA).repartition(3))
    got = read.drop("record_id").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    wanted = spark.createDataFrame([("urn:page:200",), ("urn:page:5",)], "record_id string")
    found = warc.read_bundles(warc.find_records(index, wanted)).collect()
    assert sorted((r.page_id, r.record_type) for r in found) == [(5, "response"), (200, "revisit")]


def test_bundles_are_plain_zstandard_with_seek_table(spark):
    index, _ = warc.archive(spark.createDataFrame(rows_in(), SCHEMA).coalesce(1))
    frames = index.orderBy("frame").collect()
    assert len({f.bundle for f in frames}) == 1 and len(frames) > 1
    # The long record has a frame of its own, wherever it stands among the short ones.
    assert [len(f.records) for f in frames if f.content_bytes > warc.FRAME_BYTES] == [1]
    store, path = warc.open_store(frames[0].bundle)
    with store.open_input_file(path) as source:
        raw = source.read()
        table = warc.read_seek_table(source, len(raw))
    assert [t[0] for t in table] == [f.frame_at for f in frames]
    whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\n") == len(rows_in()) and len(whole) == sum(t[2] for t in table)


def test_empty(spark):
    index, read = warc.archive(spark.createDataFrame([], SCHEMA))
    assert index.count() == 0 and read.count() == 0


def test_frames_do_not_depend_on_each_other(spark):
    index, _ = warc.archive(spark.createDataFrame(rows_in(), SCHEMA))
    one = index.filter(F.col("frame") == 0).limit(1)
    assert warc.read_bundles(one).count() == len(one.collect()[0].records)
