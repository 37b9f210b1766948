"""Streams over several batches: late rows, sides that come apart, and a source that is read again after a crash."""

import datetime
import os
import socket
import time

import pytest
from pyspark.sql import functions as F

from siftwork.streaming import datagrams, live, merge

START = datetime.datetime(2024, 1, 1)


def at(seconds):
    return START + datetime.timedelta(seconds=seconds)


class Folder:
    """Tables that land in a folder one after another."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema, self.n = spark, path, schema, 0
        path.mkdir()

    def land(self, rows):
        if rows:
            self.spark.createDataFrame(rows, self.schema).coalesce(1).write.parquet(f"{self.path}-{self.n}")
            for name in os.listdir(f"{self.path}-{self.n}"):
                if name.endswith(".parquet"):
                    os.rename(f"{self.path}-{self.n}/{name}", self.path / f"{self.n}-{name}")
        self.n += 1

    def stream(self):
        return live.landed(self.spark, str(self.path), self.schema)


def run(stream, out, checkpoint):
    live.each_batch(stream, lambda b, i: b.write.mode("overwrite").parquet(f"{out}/batch={i}"), str(checkpoint)).awaitTermination()


def test_windows_leave_late_rows_out(spark, tmp_path):
    source = Folder(spark, tmp_path / "in", "ts timestamp, k string, value double")
    counts = lambda: live.windowed_counts(source.stream(), "ts", "10 seconds", "30 seconds", ["k"]).select(F.unix_seconds("window.start").alias("start"), "k", "n", "total")
    batches = [
        [(at(s), "a", 1.0) for s in range(40)],
        [(at(95), "a", 1.0), (at(35), "a", 1.0)],  # 35 comes late: the watermark stands at 29 when it comes
        [(at(5), "a", 100.0), (at(96), "b", 1.0)],  # 5 is behind the watermark of 85: its window has gone out
        [(at(300), "a", 1.0)],
    ]
    for rows in batches:
        source.land(rows)
        run(counts(), tmp_path / "out", tmp_path / "cp")
    got = sorted((r.start - int(START.replace(tzinfo=datetime.timezone.utc).timestamp()), r.k, r.n, r.total) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(0, "a", 30, 30.0), (30, "a", 11, 11.0), (90, "a", 1, 1.0), (90, "b", 1, 1.0)]


def test_sessions_end_with_a_gap(spark, tmp_path):
    source = Folder(spark, tmp_path / "in", "ts timestamp, k string")
    sessions = lambda: live.sessions(source.stream(), "ts", "1 second", "5 seconds", ["k"]).select(F.unix_seconds("session_window.start").alias("start"), "n")
    for rows in ([(at(s), "a") for s in (0, 3, 7)], [(at(10), "a"), (at(30), "a")], [(at(100), "a")]):
        source.land(rows)
        run(sessions(), tmp_path / "out", tmp_path / "cp")
    first = int(START.replace(tzinfo=datetime.timezone.utc).timestamp())
    assert sorted((r.start - first, r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [(0, 4), (30, 1)]


def test_repeats_are_known_over_batches(spark, tmp_path):
    source = Folder(spark, tmp_path / "in", "ts timestamp, k string")
    for rows in ([(at(1), "a"), (at(2), "b"), (at(3), "a")], [(at(4), "a"), (at(5), "c")]):
        source.land(rows)
        run(live.first_seen(source.stream(), "k", "ts", "1 hour"), tmp_path / "out", tmp_path / "cp")
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c"]


def line(i):
    return f"Took {i}.5ms (detect: 1ms, crop: 1ms, track: 1ms, 3D points: 1ms)" if i % 3 == 0 else f"Confidence[0]: 0.{i % 10} / 3D fitting error: {i} / Eyes: O, C"


PACKETS, LINES = "stream string, seq long, ts timestamp, packet binary", "stream string, seq long, ts timestamp, line string"


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", merge.STATE_STORE)
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_two_streams_are_merged(spark, tmp_path, rocks):
    packets = [(s, i, at(i), f"{s}{i}".encode()) for s in "ab" for i in range(20)]
    lines = [(s, i, at(i * 2 / 3), line(i)) for s in "ab" for i in range(30)] + [("a", 100, at(3), "noise")]
    a, b = Folder(spark, tmp_path / "p", PACKETS), Folder(spark, tmp_path / "l", LINES)
    # One side first, then the other alone, then rows of both; a timing line and its confidence line come in two batches.
    for p, r in (((0, 10), (0, 4)), ((10, 15), (0, 0)), ((0, 0), (4, 7)), ((15, 20), (7, 101))):
        a.land([x for x in packets if p[0] <= x[1] < p[1]])
        b.land([x for x in lines if r[0] <= x[1] < r[1]])
        run(merge.merged(a.stream(), b.stream(), 3600, "1 hour"), tmp_path / "out", tmp_path / "cp")
    got = sorted(tuple(r)[:6] for r in spark.read.parquet(str(tmp_path / "out")).drop("batch").collect())
    expected = sorted(tuple(r) for r in merge.merged_batch(spark.createDataFrame(packets, PACKETS), spark.createDataFrame(lines, LINES)).collect())
    assert len(got) == 40 and got == expected
    assert [r[5] for r in got[:4]] == [0.5, None, 3.5, None]


def test_what_waits_too_long_comes_out_alone(spark, tmp_path, rocks):
    a, b = Folder(spark, tmp_path / "p", PACKETS), Folder(spark, tmp_path / "l", LINES)
    a.land([("a", i, at(i), b"p%d" % i) for i in range(4)])
    b.land([("a", i, at(i), line(1)) for i in range(2)])
    run(merge.merged(a.stream(), b.stream(), 5, "1 second"), tmp_path / "out", tmp_path / "cp")
    a.land([("other", 0, at(500), b"x")])  # the watermark moves on
    b.land([])
    run(merge.merged(a.stream(), b.stream(), 5, "1 second"), tmp_path / "out", tmp_path / "cp")
    got = sorted((r.stream, r.frame_no, r.packet, r.confidence) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("a", 1, b"p0", 0.1), ("a", 2, b"p1", 0.1), ("a", 3, b"p2", None), ("a", 4, b"p3", None)]


def test_datagrams_are_read_again(spark, tmp_path):
    """The first batch fails after its packets were written down; a new query from the checkpoint has them, and none twice."""
    with socket.socket(socket.AF_INET, socket.SOCK_DGRAM) as probe:
        probe.bind(("127.0.0.1", 0))
        port = probe.getsockname()[1]
    spark.dataSource.register(datagrams.DatagramSource)
    stream = spark.readStream.format("datagrams").option("port", port).option("folder", f"file://{tmp_path}/segments").option("tasks", 3).load()
    out, seen = str(tmp_path / "out"), tmp_path / "failed"

    def action(batch, i):
        rows = batch.collect()
        if rows and not seen.exists():
            seen.write_text(repr(sorted(r.packet for r in rows)))
            raise RuntimeError("the executor is lost")
        if rows:
            spark.createDataFrame(rows, batch.schema).write.mode("overwrite").parquet(f"{out}/batch={i}")

    sender, sent = socket.socket(socket.AF_INET, socket.SOCK_DGRAM), 0

    def send_until(done):
        nonlocal sent
        for _ in range(200):
            sender.sendto(b"packet %05d" % sent, ("127.0.0.1", port))
            sent += 1
            time.sleep(0.1)
            if done():
                return
        raise AssertionError("nothing has come")

    read = lambda: spark.read.schema("segment long, place long, packet binary").parquet(out).collect() if os.path.exists(out) else []
    try:
        query = live.each_batch(stream, action, str(tmp_path / "cp"), once=False, interval="200 milliseconds")
        send_until(lambda: not query.isActive)
        lost = eval(seen.read_text())
        query = live.each_batch(stream, action, str(tmp_path / "cp"), once=False, interval="200 milliseconds")
        send_until(lambda: len(read()) >= len(lost) + 5)
    finally:
        query.stop()
        sender.close()
    got = [r.packet for r in read()]
    assert set(lost) <= set(got) and len(got) == len(set(got))
    places = sorted((r.segment, r.place) for r in read())
    assert all(b in ((a[0], a[1] + 1), (b[0], 0)) for a, b in zip(places, places[1:]))


def test_segments(tmp_path):
    folder = f"file://{tmp_path}/s"
    reader = datagrams.DatagramReader(0, folder, 2, 1, 10)
    assert reader.initialOffset() == {"segment": 0, "place": 0}
    for n in range(3):
        datagrams.write_segment(folder, n, [b"%d-%d" % (n, i) for i in range(5)] + [b""])
    parts = reader.partitions({"segment": 0, "place": 4}, {"segment": 2, "place": 3})
    assert [row for p in parts for row in reader.read(p)] == [(0, 4, b"0-4"), (0, 5, b""), *((1, i, b"1-%d" % i if i < 5 else b"") for i in range(6)), *((2, i, b"2-%d" % i) for i in range(3))]
    reader.commit({"segment": 2, "place": 6})
    assert sorted(datagrams.segments(folder)) == [1, 2]
    with pytest.raises(FileNotFoundError, match="keep"):
        reader.partitions({"segment": 0, "place": 4}, {"segment": 0, "place": 6})
