"""Mixing sources to target weights along a time-varying curriculum.

Sizes are word counts.  Sources, sorted by code point with null last, get the
weights 5, 2, 1 in turn and share 100 % of all words by weight; a target is at
most ``MAX_EPOCHS`` times its source's words, and what it would exceed is
shared again by weight among the rest, which gives ``min(cap, level *
weight)`` with one level for all sources.

Each source also has a schedule: its weight runs linearly from a start to an
end factor over the training, times in [0, 1].  The integral of the schedule
up to a time is the source's cumulative token demand.  The source's documents
are put in a pseudo-random order (a hash of the id), repeated epoch by epoch,
and a copy's position in training is the time at which the demand reaches the
middle of the copy's words: the demand is inverted in closed form.  Every
document is taken once per whole epoch; in the last, partial epoch those whose
middle lies below the target are taken, so a source misses its target by at
most half a document.  Documents are range-sorted by position.

The running sums need no group in one task: a source's hash order is cut into
``BUCKETS`` ranges, whose sums are added up first.  Results depend on ids,
sizes and sources only, so reruns agree.  Null texts have size 0 and are not
taken by the partial epoch of an empty source; a null source is a source of
its own; rows repeated whole get neighbouring places in the order; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fundlens.llm.frames import SPACE_PATTERN, stored

WEIGHTS = (5.0, 2.0, 1.0)
#: Start and end factor of the schedules, in turn like the weights: heavy
#: sources early, light ones late.
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
MAX_EPOCHS = 3
#: Hash ranges per source for the running sums.
BUCKETS = 4096


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space; null: 0."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE_PATTERN)
    blank = F.when(F.element_at(parts, 1) == "", 1).otherwise(0) \
        + F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    return (F.size(parts) - blank).cast("long")


def _turn(values, place: Column) -> Column:
    """The value of a repeating list at a place counted from 1."""
    return F.element_at(F.array(*[F.lit(v) for v in values]),
                        ((place - 1) % len(values) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, schedules=SCHEDULES,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source of ``sizes`` (source, size): its words, target and
    schedule.  The windows here run over one row per source."""
    order = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    rows = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
            .withColumn("place", order)
            .withColumn("weight", _turn(weights, F.col("place")))
            .withColumn("cap", (max_epochs * F.col("source_size")).cast("double")))
    # The level fills sources in the order in which they reach their caps:
    # with those before a source at their caps, the rest share what is left.
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / F.sum("weight").over(after))
    # the level of the first source that it does not fill holds for all
    open_ = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    whole = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("level", F.first(open_, ignorenulls=True).over(whole))
    target = F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    start, end = zip(*schedules, strict=True)
    return rows.select("source", "source_size", target.alias("target"),
                       _turn(start, F.col("place")).alias("start_weight"),
                       _turn(end, F.col("place")).alias("end_weight"))


def demand_time(share: Column, start: Column, end: Column) -> Column:
    """The time at which a source whose weight runs linearly from ``start``
    to ``end`` has had ``share`` of its tokens: the inverse of the integral
    ``start * t + (end - start) * t**2 / 2`` over its value at 1."""
    slope, goal = end - start, share * (start + end) / 2
    root = F.sqrt(F.greatest(start * start + 2 * slope * goal, F.lit(0.0)))
    # 2 * goal / (start + root) also holds where the slope is 0
    return F.when(goal <= 0, F.lit(0.0)).otherwise(F.least(2 * goal / (start + root), F.lit(1.0)))


def _sized(df: DataFrame, id_col: str, text_col: str, source_col: str, *more: Column) -> DataFrame:
    place = F.xxhash64(df[id_col].cast("string"))
    return df.select(df[id_col].alias("id"), df[source_col].cast("string").alias("source"),
                     word_count(df[text_col]).alias("size"), place.alias("place"),
                     F.pmod(place, F.lit(BUCKETS)).alias("bucket"), *more)


def _planned(rows: DataFrame, sizes: DataFrame, ties: list[str], options: dict) -> DataFrame:
    """``rows`` with ``source_size``, ``target``, ``copies`` and
    ``positions``; ``sizes`` are the same rows or fewer columns of them."""
    in_source = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (sizes.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
              .withColumn("base", F.coalesce(F.sum("words").over(in_source), F.lit(0)))
              .select(F.col("source").alias("s"), F.col("bucket").alias("b"), "base"))
    targets = source_targets(sizes, **options).withColumnRenamed("source", "t")
    ranges = stored(ranges.join(targets, F.col("s").eqNullSafe(F.col("t"))).drop("t"), "ranges")
    in_range = Window.partitionBy("source", "bucket").orderBy("place", "id", "size", *ties) \
        .rowsBetween(Window.unboundedPreceding, -1)
    rows = (rows.withColumn("before", F.coalesce(F.sum("size").over(in_range), F.lit(0)))
            .join(ranges, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))))
    middle = F.col("base") + F.col("before") + F.col("size") / 2
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    partial = middle < (epochs - F.floor(epochs)) * F.col("source_size")
    copies = (F.floor(epochs) + F.when(partial & (F.col("size") > 0), 1).otherwise(0)).cast("int")
    rows = rows.withColumns({"middle": middle, "copies": copies})

    def time(epoch: Column) -> Column:
        share = (epoch * F.col("source_size") + F.col("middle")) / F.col("target")
        return demand_time(share, F.col("start_weight"), F.col("end_weight"))

    positions = F.when((F.col("copies") > 0) & (F.col("target") > 0),
                       F.transform(F.sequence(F.lit(0), F.col("copies") - 1), time))
    return rows.withColumn("positions", F.coalesce(positions, F.array().cast("array<double>")))


def plan_mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", **options) -> DataFrame:
    """One row per document, range-sorted by the position of its first copy
    (documents not taken last): id, source, ``size``, ``source_size``,
    ``target``, ``taken`` words and the training ``positions`` of its
    copies.  ``options``: weights, schedules, max_epochs."""
    rows = stored(_sized(df, id_col, text_col, source_col), "sizes")
    plan = _planned(rows, rows, [], options)
    return plan.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size",
        "target", (F.col("copies") * F.col("size")).alias("taken"), "positions",
    ).orderBy(F.try_element_at("positions", F.lit(1)).asc_nulls_last(), F.col(id_col))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", **options) -> DataFrame:
    """The training sequence: the rows of ``df``, one per copy taken, with
    its columns, range-sorted by position."""
    whole = F.struct(*[df[f"`{c}`"] for c in df.columns])
    hashed = [df[f"`{f.name}`"] for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    rows = _sized(df, id_col, text_col, source_col, whole.alias("row"), F.xxhash64(*hashed).alias("tie"))
    sizes = stored(_sized(df, id_col, text_col, source_col), "sizes")
    copies = (_planned(rows, sizes, ["tie"], options)
              .select("row", "id", "tie", F.explode("positions").alias("position")))
    return copies.orderBy("position", "id", "tie").select("row.*")
