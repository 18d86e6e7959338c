"""Profiling operators: frequency tables, describe, null audit, top-n,
class balance, schema report (A1-A4, A7-A11, O1-O4, M10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def frequency(df: DataFrame, *keys: str | Column, ascending: bool = False) -> DataFrame:
    """A1-A3: ``groupBy(keys).count()`` ordered by count, keys as tie-break.

    Keys may be expressions (a boolean flag forms its own null group).  The
    hash aggregate runs partial (map side) then final, so a hot key costs
    one row per map task in the shuffle.
    """
    counts = df.groupBy(*keys).count()
    order = F.col("count").asc() if ascending else F.col("count").desc()
    key_names = [c for c in counts.columns if c != "count"]
    return counts.orderBy(order, *[F.col(k).asc_nulls_first() for k in key_names])


def frequencies(df: DataFrame, sets: dict[str, Sequence[str]]) -> DataFrame:
    """A1-A4: several frequency tables of one scan: ``(profile, key,
    second_key, count)`` with the keys as text, one profile per named list of
    one or two columns.

    Grouping sets: each row is expanded once per set in front of one partial
    and one final hash aggregate; ``grouping_id`` tells the sets apart, so a
    null key is a group of its own and not a column left out."""
    columns = list(dict.fromkeys(c for keys in sets.values() for c in keys))
    width = len(columns)
    number = {name: sum(1 << (width - 1 - i) for i, c in enumerate(columns) if c not in keys)
              for name, keys in sets.items()}
    if len(set(number.values())) < len(sets):
        raise ValueError("two profiles have the same columns")
    counts = (df.select(*columns).groupingSets([[F.col(c) for c in keys] for keys in sets.values()],
                                               *[F.col(c) for c in columns])
                .agg(F.count(F.lit(1)).alias("count"), F.grouping_id().alias("_set")))

    def pick(values: dict[str, Column]) -> Column:
        out = F.lit(None).cast("string")
        for name, value in values.items():
            out = F.when(F.col("_set") == number[name], value.cast("string")).otherwise(out)
        return out

    return counts.select(
        pick({name: F.lit(name) for name in sets}).alias("profile"),
        pick({name: F.col(keys[0]) for name, keys in sets.items()}).alias("key"),
        pick({name: F.col(keys[1]) for name, keys in sets.items() if len(keys) > 1}).alias("second_key"),
        "count")


def filtered_frequency(df: DataFrame, condition: Column, *keys: str) -> DataFrame:
    """A4: frequency table of the rows matching ``condition``."""
    return frequency(df.where(condition), *keys)


def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, stddev (sample), min, max per column, typed.

    One aggregate pass over the table for all columns, then an unpivot of
    the single result row into one row per column.
    """
    aggs = []
    for c in columns:
        aggs += [F.count(c).alias(f"{c}__count"),
                 F.avg(c).cast("double").alias(f"{c}__mean"),
                 F.stddev_samp(c).cast("double").alias(f"{c}__stddev"),
                 F.min(c).cast("double").alias(f"{c}__min"),
                 F.max(c).cast("double").alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 F.col(f"{c}__count").alias("count"),
                 F.col(f"{c}__mean").alias("mean"),
                 F.col(f"{c}__stddev").alias("stddev"),
                 F.col(f"{c}__min").alias("min"),
                 F.col(f"{c}__max").alias("max"))
        for c in columns]))
    return wide.select(rows)


def null_audit(df: DataFrame, columns: list[str]) -> DataFrame:
    """P6 as one pass: the number of nulls of every column, one row."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns])


def null_audit_before_after(df: DataFrame, columns: list[str], fill: dict) -> DataFrame:
    """P6 + P9 check in one pass: null counts before and after a fill.

    Each column is carried raw and filled in the same projection, counted by
    one aggregate, and the single result row is unpivoted into the two
    stages - the input is read once, not once per stage.
    """
    filled = {f"{c}__after": v for c, v in fill.items() if c in columns}
    both = (df.select(*columns, *[F.col(c).alias(f"{c}__after") for c in columns])
              .na.fill(filled))
    wide = both.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in both.columns])
    stage = lambda name, suffix: F.struct(
        *[F.col(f"{c}{suffix}").alias(f"{c}_nulls") for c in columns],
        F.lit(name).alias("stage"))
    return wide.select(F.inline(F.array(stage("before_fill", ""), stage("after_fill", "__after"))))


def flag_before_after(df: DataFrame, before: Column, after: Column, name: str) -> DataFrame:
    """A3 before/after a repair, in one pass: rows per flag value at each
    stage.  One aggregate on (before, after) over the input, then a second
    over its at most nine rows."""
    pairs = df.groupBy(before.alias("_b"), after.alias("_a")).count()
    per_stage = pairs.select(F.inline(F.array(
        F.struct(F.lit("before").alias("stage"), F.col("_b").alias(name), F.col("count").alias("n")),
        F.struct(F.lit("after").alias("stage"), F.col("_a").alias(name), F.col("count").alias("n")))))
    return per_stage.groupBy("stage", name).agg(F.sum("n").alias("count"))


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    """A10: duplicate removal on a column subset."""
    return df.select(*columns).dropDuplicates()


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """First ``n`` rows in a total order (planned as
    TakeOrderedAndProject: per-partition top-n, then a merge of n x P rows)."""
    return df.orderBy(*order).limit(n)


def preview(df: DataFrame, n: int = 20, *order: Column) -> list:
    """The first ``n`` rows on the driver - the only collect the
    library offers, always behind a limit."""
    return (df.orderBy(*order) if order else df).limit(n).collect()


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows per label and their share of all rows.

    The share's window has no partition key, but it runs over the grouped
    result, which has one row per label value.
    """
    counts = df.groupBy(label).count()
    return counts.withColumn(
        "share", F.round(F.col("count") / F.sum("count").over(Window.partitionBy()), 9))


def schema_report(df: DataFrame) -> list[tuple[int, str, str]]:
    """A11 + A8: (position, column, type) of every column - metadata only,
    no job runs."""
    return [(i + 1, f.name, f.dataType.simpleString())
            for i, f in enumerate(df.schema.fields)]
