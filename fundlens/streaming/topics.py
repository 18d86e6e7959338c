"""Topic semantics on Structured Streaming.

A topic is an append-only folder of files (or a Kafka topic - the format
and options are arguments); a consumer's offset is its checkpoint folder.

* replay from the beginning = a fresh checkpoint;
* resume after the last message read = the same checkpoint again: the file
  source's log records which files were committed, so a restart reads only
  new files, with neither loss nor repeats, also after a crash mid-batch;
* ``trigger(availableNow=True)`` drains what exists now in bounded
  micro-batches of ``FILES_PER_BATCH`` files, unless the caller names
  another number, and stops.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

# Fixed value: the text in front of a message's time.
MESSAGE_PREFIX = "message ecrit le "
# Files of a micro-batch of a file topic.
FILES_PER_BATCH = 1000


def read_topic(spark: SparkSession, path: str | None, schema: StructType | None = None,
               fmt: str = "parquet", glob: str | None = None,
               max_files_per_trigger: int | None = FILES_PER_BATCH,
               options: dict | None = None) -> DataFrame:
    """An unbounded DataFrame over a topic.

    A file topic is a folder and needs its ``schema``.  A Kafka topic takes
    neither: ``read_topic(spark, None, fmt="kafka", options={
    "kafka.bootstrap.servers": ..., "subscribe": ..., "startingOffsets":
    "earliest"})`` (earliest = from the beginning on a fresh checkpoint).
    """
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if path and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(path) if path else reader.load()


def drain(stream: DataFrame, sink_path: str | None, checkpoint: str, fmt: str = "parquet",
          timeout_s: float | None = None, query_name: str | None = None,
          options: dict | None = None) -> str | None:
    """Run ``stream`` into an append-only sink until everything
    available now is consumed, then stop.  Files sinks are exactly-once
    (the sink's own log names the committed files).  Only a caller that names
    a ``timeout_s`` has the run stopped."""
    writer = (stream.writeStream.format(fmt).outputMode("append")
              .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if sink_path:
        writer = writer.option("path", sink_path)
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    if query_name:
        writer = writer.queryName(query_name)
    q = writer.start()
    try:
        finished = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
        if finished is False:
            raise TimeoutError(f"stream into {sink_path} did not drain in {timeout_s}s")
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    finally:
        if q.isActive:
            q.stop()
    return sink_path


def append_to_topic(df: DataFrame, path: str | None, fmt: str = "parquet",
                    options: dict | None = None) -> None:
    """A producer appends a batch of messages - new files in a file
    topic, or records of a Kafka topic (``fmt="kafka"``, ``path=None``,
    a ``value`` column and ``{"kafka.bootstrap.servers": ..., "topic": ...}``)."""
    writer = df.write.mode("append").format(fmt)
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    writer.save(path) if path else writer.save()


def message_text(ts: Column | str) -> Column:
    """S11's text: ``message ecrit le HH:mm:ss:<nanoseconds>`` (Spark keeps
    microseconds, so the last three of the nine digits are 0).

    Built from the time fields: for a session-zone timestamp (the rate
    source) they read the session's clock, for a TIMESTAMP_NTZ they read its
    wall clock as is - ``date_format`` would shift an NTZ value that falls
    in a daylight-saving gap of the session zone.
    """
    t = F.col(ts) if isinstance(ts, str) else ts
    micros = F.extract(F.lit("SECOND"), t) * 1_000_000
    nanos = (micros % 1_000_000).cast("long") * 1000
    return F.concat(F.lit(MESSAGE_PREFIX),
                    F.format_string("%02d:%02d:%02d:%09d", F.hour(t), F.minute(t), F.second(t), nanos))


def heartbeat_messages(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """S11 over any (streaming or batch) table with a timestamp column."""
    return df.withColumn("value", message_text(ts_col))


def rate_heartbeat(spark: SparkSession, rows_per_second: int = 1) -> DataFrame:
    """One timestamped message per second from the ``rate`` source."""
    src = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return heartbeat_messages(src).select("timestamp", "value")


def feed(spark: SparkSession, path: str, checkpoint: str, messages: int, start_ms: int,
         interval_ms: int = 1000, rows_per_batch: int = 100_000) -> str:
    """S11 + R3 with a clock of its own: a producer that appends the messages
    number 0 to ``messages`` - 1 to a file topic, the n-th stamped ``n``
    intervals after ``start_ms`` (Unix milliseconds), as ``number``,
    ``timestamp`` and ``value``.  The ``rate-micro-batch`` source gives a batch
    of a fixed number of rows a run, so a rerun on the same checkpoint goes on
    where the last one ended and the messages do not depend on the hour."""
    size = min(rows_per_batch, max(messages, 1))
    source = (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", size)
              .option("startTimestamp", start_ms).option("advanceMillisPerBatch", size * interval_ms).load())
    at = F.timestamp_millis(F.lit(start_ms) + F.col("value") * interval_ms)
    rows = source.where(F.col("value") < messages).select(F.col("value").alias("number"), at.alias("timestamp"))
    for _ in range(-(-messages // size)):
        drain(heartbeat_messages(rows), path, checkpoint)
    return path


def append_once(stream: DataFrame, path: str, checkpoint: str) -> str:
    """S10, idempotent: each micro-batch writes the folder ``batch=<id>`` of
    ``path`` whole.  A batch that runs again after a failure (its id and its
    messages are those of the checkpoint's log) replaces what it wrote, so
    nothing is there twice."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return path


def forget_last_commit(spark: SparkSession, checkpoint: str) -> int | None:
    """Take a consumer back to just before the commit of its last micro-batch,
    as after a crash in between; the batch's number, which runs again."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return None
    numbers = [int(f.getPath().getName()) for f in files.listStatus(folder) if f.getPath().getName().isdigit()]
    if not numbers:
        return None
    last = jvm.org.apache.hadoop.fs.Path(folder, str(max(numbers)))
    files.delete(last, False)
    files.delete(jvm.org.apache.hadoop.fs.Path(folder, f".{max(numbers)}.crc"), False)
    return max(numbers)


def emit_heartbeats(spark: SparkSession, path: str, checkpoint: str, seconds: float,
                    rows_per_second: int = 1) -> str:
    """S11 + R3: a producer that appends one message per second to a file
    topic, for ``seconds`` (its own run time, the caller's choice)."""
    q = (rate_heartbeat(spark, rows_per_second).writeStream.format("parquet").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint).start())
    try:
        q.awaitTermination(seconds)
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    finally:
        if q.isActive:
            q.stop()
    return path
