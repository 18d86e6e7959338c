"""Exact deduplication with a heavy-hitter split.

Texts are equal when they agree without ASCII white space.  Every row is
reduced to a digest (SHA-256) and stored once.  A Misra-Gries summary per
task, merged, names the few digests that may hold at least ``1 / (counters +
1)`` of all rows; their exact counts and winners come from one aggregation
with map-side combining and are broadcast (at most ``counters + 1`` rows), so
rows of frequent digests are settled where they lie.  The remaining digests,
each below that share, are shuffled by digest.

Of equal texts the row with the most code points in its original text stays,
then the smallest id (a null id last).  A null text counts as empty; empty
texts are equal to each other.  Whole repeated rows count in ``group_size``;
``duplicate_groups`` marks each of them as kept when their key wins, and
``deduplicate`` returns one of them.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fundlens.llm.frames import stored, unspaced

#: Counters of a Misra-Gries summary; bounds what is broadcast.
COUNTERS = 1000


def merge_summaries(summary: dict, more: dict, counters: int) -> dict:
    """Misra-Gries merge: add, then subtract the (counters + 1)-th largest
    count.  Any key with more than n / (counters + 1) of the n counted rows
    stays, and no count exceeds the true one."""
    for key, n in more.items():
        summary[key] = summary.get(key, 0) + n
    if len(summary) > counters:
        cut = sorted(summary.values(), reverse=True)[counters]
        summary = {k: n - cut for k, n in summary.items() if n > cut}
    return summary


def _summarise(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary: dict = {}
        for batch in batches:
            counts = batch.column(0).value_counts()
            pairs = zip(counts.field(0).to_pylist(), counts.field(1).to_pylist(), strict=True)
            summary = merge_summaries(summary, dict(pairs), counters)
        yield pa.RecordBatch.from_pydict(
            {"digest": pa.array(list(summary), pa.string()),
             "seen": pa.array(list(summary.values()), pa.int64())})
    return run


def _winners(rows: DataFrame, counters: int) -> list:
    """(digest, members, best) of the digests with at least ``1 / (counters +
    1)`` of all rows and at least two: exact, at most counters + 1."""
    total = rows.count()
    floor = total / (counters + 1)
    # what a task's summary lacks of a digest is below its share of ``floor``
    named = (rows.select("digest").mapInArrow(_summarise(counters), "digest string, seen long")
             .groupBy("digest").agg(F.sum("seen").alias("seen"))
             .where(F.col("seen") >= floor))
    found = [r.digest for r in named.select("digest").collect()]
    if not found:
        return []
    table = rows.sparkSession.createDataFrame([(d,) for d in found], "digest string")
    exact = (rows.join(F.broadcast(table), "digest", "left_semi").groupBy("digest")
             .agg(F.count("*").alias("members"), F.min("rank").alias("best")))
    return exact.where((F.col("members") >= 2 * floor) & (F.col("members") > 1)).collect()


def _rank(df: DataFrame, id_col: str, text_col: str) -> Column:
    """Sorts the row that stays first: the longest original text, then a null
    id last, then the smallest id."""
    key = df[id_col]
    length = F.length(F.coalesce(df[text_col], F.lit("")))
    return F.struct((-length).alias("length"), key.isNull().alias("no_id"), key.alias("id"))


def _digest(df: DataFrame, text_col: str) -> Column:
    return F.sha2(unspaced(df[text_col]).cast("binary"), 256)


def _digests(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = df.select(_rank(df, id_col, text_col).alias("rank"),
                     _digest(df, text_col).alias("digest"))
    return stored(rows, "digests")


def _winner_table(rows: DataFrame, counters: int) -> DataFrame:
    """The broadcast side of the split: digest, members, best."""
    schema = T.StructType([T.StructField("digest", T.StringType()),
                           T.StructField("members", T.LongType()),
                           T.StructField("best", rows.schema["rank"].dataType)])
    return F.broadcast(rows.sparkSession.createDataFrame(_winners(rows, counters), schema))


def duplicate_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     counters: int = COUNTERS) -> DataFrame:
    """One row per input row: its id, ``keep_id``, ``group_size``, ``kept``
    and ``text_sha256`` of the text without white space."""
    rows = _digests(df, id_col, text_col)
    winners = _winner_table(rows, counters)
    each = Window.partitionBy("digest")
    hot = rows.join(winners, "digest")
    cold = (rows.join(winners, "digest", "left_anti")
            .withColumns({"members": F.count("*").over(each), "best": F.min("rank").over(each)}))
    return hot.unionByName(cold).select(
        F.col("rank.id").alias(id_col), F.col("best.id").alias("keep_id"),
        F.col("members").alias("group_size"), (F.col("rank") == F.col("best")).alias("kept"),
        F.col("digest").alias("text_sha256"))


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                counters: int = COUNTERS) -> DataFrame:
    """The rows that stay, one per text, with the columns of ``df``.  Of rows
    with the same winning key the one with the smallest row hash stays."""
    winners = _winner_table(_digests(df, id_col, text_col), counters)
    hashed = [df[f"`{f.name}`"] for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    rows = df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"),
                     _digest(df, text_col).alias("digest"),
                     _rank(df, id_col, text_col).alias("rank"), F.xxhash64(*hashed).alias("tie"))
    hot = (rows.join(winners, "digest").where(F.col("rank") == F.col("best"))
           .groupBy("digest").agg(F.min_by("row", "tie").alias("row")))
    first = F.row_number().over(Window.partitionBy("digest").orderBy("rank", "tie"))
    cold = rows.join(winners, "digest", "left_anti").withColumn("place", first).where("place = 1")
    return hot.select("row.*").unionByName(cold.select("row.*"))
