"""Streaming queries over ``events`` (step 7).

Each query drains a stream into a sink in the shared checkpoint folder and
returns a batch DataFrame over what the sink holds, so the oracle can check
that every event arrived exactly once.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from fundlens.session import shared_dir
from fundlens.sources.tables import table, table_path
from fundlens.plans.oracle import FEED_START
from fundlens.streaming import append_to_topic, drain, heartbeat_messages, read_topic
from fundlens.streaming.topics import append_once, feed, forget_last_commit


def _events_stream(spark, sf):
    path = table_path(sf, "events")
    schema = spark.read.parquet(path).schema
    if os.path.isdir(path):
        return read_topic(spark, path, schema)
    return read_topic(spark, os.path.dirname(path), schema, glob=os.path.basename(path))


def _summary(sink: DataFrame) -> DataFrame:
    """Sums are decimal, so they do not depend on the order of the rows."""
    return (sink.groupBy("event_type")
                .agg(F.count(F.lit(1)).alias("n"),
                     F.count_distinct("event_id").alias("n_ids"),
                     F.sum(F.col("value").cast("decimal(18,6)")).cast("decimal(38,6)").alias("sum_value")))


def stream_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Read the whole topic from the beginning (fresh checkpoint)."""
    base = shared_dir(spark, "stream-replay")
    sink = drain(_events_stream(spark, sf), os.path.join(base, "sink"),
                 os.path.join(base, "checkpoint"))
    return _summary(spark.read.parquet(sink))


def stream_resume(spark: SparkSession, sf: str) -> DataFrame:
    """R2: a consumer stops and restarts on the same checkpoint.

    The events arrive in two appends (before / from the middle of their time
    range).  Run 1 reads the first, run 2 finds nothing new, run 3 reads
    only the second: the sink then holds every event once.
    """
    base = shared_dir(spark, "stream-resume")
    topic, sink, ckpt = (os.path.join(base, p) for p in ("topic", "sink", "checkpoint"))
    events = table(spark, sf, "events")
    # The midpoint is a scalar subquery evaluated by Spark, not a driver value.
    mid = events.agg(((F.min(F.unix_timestamp("ts")) + F.max(F.unix_timestamp("ts"))) / 2)).scalar()
    early = F.coalesce(F.unix_timestamp("ts") < mid, F.lit(False))
    append_to_topic(events.where(early), topic)
    stream = read_topic(spark, topic, events.schema)
    drain(stream, sink, ckpt)
    drain(stream, sink, ckpt)
    append_to_topic(events.where(~early), topic)
    drain(stream, sink, ckpt)
    return _summary(spark.read.parquet(sink))


def stream_heartbeat(spark: SparkSession, sf: str) -> DataFrame:
    """S11/R3 over the events topic: each event becomes a timestamped
    message ``message ecrit le HH:mm:ss:nnnnnnnnn``."""
    base = shared_dir(spark, "stream-heartbeat")
    stream = heartbeat_messages(_events_stream(spark, sf), "ts").select("event_id", "value")
    sink = drain(stream, os.path.join(base, "sink"), os.path.join(base, "checkpoint"))
    return spark.read.parquet(sink)


def stream_feed(spark: SparkSession, sf: str) -> DataFrame:
    """A message a second from a fixed start, read back as a stream
    and joined to the events of the same number."""
    base = shared_dir(spark, "stream-feed")
    topic, sink, ckpt = (os.path.join(base, p) for p in ("topic", "sink", "checkpoint"))
    events = table(spark, sf, "events", ["event_id", "event_type"])
    messages = (events.agg(F.max("event_id")).head()[0] or 0) + 1
    feed(spark, topic, os.path.join(base, "producer"), messages, FEED_START * 1000)
    schema = spark.read.parquet(topic).schema
    drain(read_topic(spark, topic, schema).select("number", "value"), sink, ckpt)
    return spark.read.parquet(sink).join(events, F.col("number") == F.col("event_id")) \
        .select("event_id", "event_type", "value")


def stream_consumers(spark: SparkSession, sf: str) -> DataFrame:
    """Two consumers of one topic with offsets of their own.  The
    first reads each append as it comes, and is taken back before its last
    commit, so that its last batch runs again; the second starts late."""
    base = shared_dir(spark, "stream-consumers")
    topic = os.path.join(base, "topic")
    events = table(spark, sf, "events")
    late = F.col("event_id") % 3 == 0
    path = lambda who, what: os.path.join(base, f"{who}-{what}")
    append_to_topic(events.where(~late).repartition(5), topic)
    stream = read_topic(spark, topic, events.schema, max_files_per_trigger=2)
    append_once(stream, path("first", "sink"), path("first", "offset"))
    append_to_topic(events.where(late), topic)
    append_once(stream, path("first", "sink"), path("first", "offset"))
    append_once(stream, path("second", "sink"), path("second", "offset"))
    if forget_last_commit(spark, path("first", "offset")) is None:
        raise RuntimeError("the first consumer has committed nothing")
    append_once(stream, path("first", "sink"), path("first", "offset"))
    found = [_summary(spark.read.parquet(path(who, "sink"))).withColumn("consumer", F.lit(who))
             for who in ("first", "second")]
    return found[0].unionByName(found[1])
