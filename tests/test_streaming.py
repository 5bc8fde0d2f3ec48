"""Streams: same transforms as batch; watermark drops late rows in append mode."""

import json
import os
import time

from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from cumulo.streaming import runner as R
from cumulo.streaming import windows as SW


def _write(path, name, rows):
    with open(os.path.join(path, name), "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")


def _ev(ip, host, t):
    return {"ip": ip, "event_time": t, "referrer": None, "host": host, "url": "/", "geodata": "{}"}


def test_sessions_exact_gap_merges(spark):
    rows = [("a", "h", "2024-01-01 00:00:00"), ("a", "h", "2024-01-01 00:05:00"),   # exactly one gap: same session
            ("a", "h", "2024-01-01 00:10:01"), ("b", "h", "2024-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "ip string, host string, t string").withColumn("ts", F.to_timestamp("t"))
    got = sorted((r.ip, r.num_hits) for r in SW.sessions(df, "ts", ["ip", "host"]).collect())
    assert got == [("a", 1), ("a", 2), ("b", 1)]


def test_stream_complete_mode_equals_batch(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    base = [_ev("1.1.1.1", "x.example.com", f"2024-01-01T00:0{m}:00.000Z") for m in range(8)]
    base += [_ev("2.2.2.2", "y.example.com", f"2024-01-01T00:{m:02d}:30.000Z") for m in (1, 2, 20)]
    _write(src, "a.json", base)
    stream = R.events_with_time(R.file_source(spark, src), delay="15 seconds")
    agg = SW.tumbling_counts(stream, "event_timestamp", ["host"])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    q = R.start(agg, "tumbling_complete", mode="complete", trigger_seconds=None, fmt="memory",
                checkpoint=os.path.join(scratch, "ck1"), state_partitions=3)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    q.processAllAvailable()
    got = spark.table("tumbling_complete")
    batch = SW.tumbling_counts(SW.parse_event_time(spark.read.schema(R.EVENT_SCHEMA).json(src)),
                               "event_timestamp", ["host"])
    assertDataFrameEqual(got, batch)
    q.stop()


def test_late_rows_are_dropped_in_append_mode(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    stream = R.events_with_time(R.file_source(spark, src, max_files_per_trigger=1), delay="15 seconds")
    agg = SW.tumbling_counts(stream, "event_timestamp", ["host"])
    q = R.start(agg, "tumbling_append", mode="append", trigger_seconds=None, fmt="memory",
                checkpoint=os.path.join(scratch, "ck2"))
    _write(src, "1.json", [_ev("1", "h", "2024-01-01T00:01:00.000Z"), _ev("1", "h", "2024-01-01T00:02:00.000Z")])
    q.processAllAvailable()
    # moves the watermark past the first window
    _write(src, "2.json", [_ev("1", "h", "2024-01-01T00:20:00.000Z")])
    q.processAllAvailable()
    # late: its window [00:00, 00:05) is already final
    _write(src, "3.json", [_ev("1", "h", "2024-01-01T00:03:00.000Z")])
    q.processAllAvailable()
    # closing sentinel so the 00:20 window is emitted too
    _write(src, "4.json", [_ev("1", "h", "2024-01-01T01:00:00.000Z")])
    q.processAllAvailable()
    time.sleep(0.5)
    q.processAllAvailable()
    got = {(r.window_start.minute, r.num_hits) for r in spark.table("tumbling_append").collect()}
    q.stop()
    assert (0, 2) in got and (20, 1) in got and (0, 3) not in got


def test_session_report_domain_filter(spark):
    sess = spark.createDataFrame([("a.example.com", 3), ("example.com", 1), ("other.org", 5)],
                                 "host string, num_hits long")
    r = {x.host: (x.num_sessions, x.num_events) for x in SW.session_report(sess, domain="example.com").collect()}
    assert r == {"a.example.com": (1, 3), "example.com": (1, 1)}


def test_landing_job_restarts_from_checkpoint(spark, scratch):
    src, sink, ck = (os.path.join(scratch, x) for x in ("in", "out", "ck"))
    os.makedirs(src)
    _write(src, "1.json", [_ev("1.1.1.1", "h", "2024-01-01T00:00:01.000Z"), _ev("2.2.2.2", "h", "bad-time")])
    landed = SW.enrich_landing(R.file_source(spark, src))
    q = R.start(landed, "landing", trigger_seconds=None, batch_writer=R.parquet_writer(sink), checkpoint=ck)
    q.processAllAvailable()
    q.stop()
    # a new run of the same job resumes after the committed batch: nothing is landed twice
    _write(src, "2.json", [_ev("3.3.3.3", "h", "2024-01-01T00:00:02.000Z")])
    q = R.start(SW.enrich_landing(R.file_source(spark, src)), "landing2", trigger_seconds=None,
                batch_writer=R.parquet_writer(sink), checkpoint=ck)
    q.processAllAvailable()
    q.stop()
    out = spark.read.parquet(sink)
    assert out.count() == 3
    assert out.filter(F.col("event_timestamp").isNull()).count() == 1   # malformed time -> NULL, row kept
    # replaying a batch id overwrites its own partition (idempotent sink)
    R.parquet_writer(sink)(spark.read.parquet(sink).filter("batch_id = 0").drop("batch_id"), 0)
    assert spark.read.parquet(sink).count() == 3


def test_two_sinks_on_one_source(spark, scratch):
    """L4: a second aggregation on the same source definition, each with its own checkpoint."""
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    rows = [_ev("1", "a.example.com", "2024-01-01T00:01:00.000Z"),
            _ev("2", "a.example.com", "2024-01-01T00:02:00.000Z"),
            _ev("3", "b.example.com", "2024-01-01T00:07:00.000Z")]
    rows[0]["referrer"] = "https://t.co/x"
    _write(src, "a.json", rows)
    source = R.events_with_time(R.file_source(spark, src))
    by_host = SW.tumbling_counts(source, "event_timestamp", ["host"])
    by_ref = SW.tumbling_counts(source, "event_timestamp", ["host", "referrer"])
    q1 = R.start(by_host, "by_host", mode="complete", trigger_seconds=None, fmt="memory",
                 checkpoint=os.path.join(scratch, "c1"))
    q2 = R.start(by_ref, "by_ref", mode="complete", trigger_seconds=None, fmt="memory",
                 checkpoint=os.path.join(scratch, "c2"))
    q1.processAllAvailable()
    q2.processAllAvailable()
    assert {(r.host, r.num_hits) for r in spark.table("by_host").collect()} == {("a.example.com", 2),
                                                                                ("b.example.com", 1)}
    assert spark.table("by_ref").count() == 3
    q1.stop()
    q2.stop()


def test_stream_sessions_append_with_watermark(spark, scratch):
    """Session windows on a stream; a session is emitted once the watermark passes its end."""
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    stream = R.events_with_time(R.file_source(spark, src, max_files_per_trigger=1), delay="15 seconds")
    sess = SW.sessions(stream, "event_timestamp", ["ip", "host"], gap="5 minutes")
    q = R.start(sess, "sess_append", mode="append", trigger_seconds=None, fmt="memory",
                checkpoint=os.path.join(scratch, "ck"))
    _write(src, "1.json", [_ev("9", "h", "2024-01-01T00:00:00.000Z"), _ev("9", "h", "2024-01-01T00:04:00.000Z")])
    q.processAllAvailable()
    _write(src, "2.json", [_ev("9", "h", "2024-01-01T00:30:00.000Z")])   # closes the first session
    q.processAllAvailable()
    _write(src, "3.json", [_ev("9", "h", "2024-01-01T01:30:00.000Z")])   # moves the watermark again
    q.processAllAvailable()
    got = sorted((r.session_start.minute, r.num_hits) for r in spark.table("sess_append").collect())
    q.stop()
    assert got[0] == (0, 2) and (30, 1) in got
