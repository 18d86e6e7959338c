"""Topic semantics: replay, resume without loss or repeats, heartbeat text."""

import os
import re
import time

from pyspark.sql import functions as F

from paths import SF_SMALL
from fundlens.session import shared_dir
from fundlens.sources import table
from fundlens.streaming import append_to_topic, drain, emit_heartbeats, rate_heartbeat, read_topic


def test_resume_reads_only_new_files(spark):
    base = shared_dir(spark, "t-resume")
    topic, sink, ckpt = (os.path.join(base, p) for p in ("topic", "sink", "ckpt"))
    events = table(spark, SF_SMALL, "events")
    n = events.count()
    first = events.where(F.col("event_id") < F.lit(n // 2))
    append_to_topic(first, topic)
    stream = read_topic(spark, topic, events.schema)
    drain(stream, sink, ckpt)
    n1 = spark.read.parquet(sink).count()
    assert n1 == first.count()
    drain(stream, sink, ckpt)  # restart with nothing new
    assert spark.read.parquet(sink).count() == n1
    append_to_topic(events.where(F.col("event_id") >= F.lit(n // 2)), topic)
    drain(stream, sink, ckpt)
    out = spark.read.parquet(sink)
    assert out.count() == n and out.select("event_id").distinct().count() == n
    # a fresh checkpoint replays everything from the beginning
    replay = os.path.join(base, "replay")
    drain(stream, replay, os.path.join(base, "ckpt2"))
    assert spark.read.parquet(replay).count() == n


def test_rate_heartbeat_format(spark):
    q = (rate_heartbeat(spark, 5).writeStream.format("memory").queryName("heartbeat_t")
         .outputMode("append").start())
    try:
        deadline = time.time() + 60
        while time.time() < deadline and spark.table("heartbeat_t").count() < 3:
            time.sleep(0.5)
    finally:
        q.stop()
    rows = [r["value"] for r in spark.table("heartbeat_t").collect()]
    assert len(rows) >= 3
    for v in rows:
        assert re.fullmatch(r"message ecrit le \d\d:\d\d:\d\d:\d{6}000", v), v


def test_resume_after_failure_no_loss_no_repeat(spark, tmp_path):
    import pytest
    base = shared_dir(spark, "t-crash")
    topic, sink, ckpt = (os.path.join(base, p) for p in ("topic", "sink", "ckpt"))
    events = table(spark, SF_SMALL, "events")
    n = events.count()
    half = F.col("event_id") < F.lit(n // 2)
    append_to_topic(events.where(half).coalesce(1), topic)
    append_to_topic(events.where(~half).coalesce(1), topic)
    marker = os.path.join(tmp_path, "fail")
    open(marker, "w").close()

    @F.udf("long")
    def crash_on_second_half(event_id):
        # a consumer that dies while reading the second file
        if os.path.exists(marker) and event_id >= n // 2:
            raise RuntimeError("consumer crashed")
        return event_id

    def stream():
        s = read_topic(spark, topic, events.schema, max_files_per_trigger=1)
        return s.withColumn("event_id", crash_on_second_half("event_id"))

    with pytest.raises(Exception):
        drain(stream(), sink, ckpt)
    assert spark.read.parquet(sink).count() == n // 2  # first file committed
    os.remove(marker)
    drain(stream(), sink, ckpt)  # restart on the same checkpoint
    out = spark.read.parquet(sink)
    assert out.count() == n and out.select("event_id").distinct().count() == n


def test_heartbeats_are_appended_to_a_topic(spark):
    base = shared_dir(spark, "t-emit")
    topic = emit_heartbeats(spark, os.path.join(base, "topic"), os.path.join(base, "ckpt"), 8)
    got = [r.value for r in spark.read.parquet(topic).collect()]
    assert got and all(re.fullmatch(r"message ecrit le \d\d:\d\d:\d\d:\d{9}", v) for v in got)
    stream = read_topic(spark, topic, spark.read.parquet(topic).schema)
    sink = drain(stream, os.path.join(base, "sink"), os.path.join(base, "ckpt2"))
    assert sorted(r.value for r in spark.read.parquet(sink).collect()) == sorted(got)
