"""Ranks and selections over large grouped results, without one task that
holds them all (T5, T3).

``ranked`` numbers a table's rows in a total order: a range exchange puts the
rows of each partition after those of the one before, each partition is sorted
on its own, and the sizes of the partitions (one row each) turn a row's place
in its partition into its place in the whole.  ``most_frequent`` selects the
rows with the largest counts exactly: histograms of the counts, 16 bits at a
time, narrow down the smallest count that is kept, and only the rows that tie
there are ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fundlens.operators.words import explode_values
from fundlens.session import shared_dir
from fundlens.sources.files import materialize

#: Bits of a count that one histogram resolves: at most 65,536 rows.
RADIX = 16


def ranked(df: DataFrame, *order: Column, within: str | None = None, rank: str = "rank") -> DataFrame:
    """``df`` with ``rank``: its place from 0 in the order, which must be
    total, in all rows or among those with the same value of ``within``.

    The sorted rows are written once, which fixes their places; what is
    summed up over partitions has one row per partition and value of
    ``within``."""
    keys = [F.col(within).asc_nulls_first(), *order] if within else list(order)
    place = F.monotonically_increasing_id()
    rows = (df.repartitionByRange(*keys).sortWithinPartitions(*keys)
              .withColumns({"_part": F.shiftright(place, 33), "_place": place.bitwiseAND((1 << 33) - 1)}))
    rows = materialize(rows, shared_dir(df.sparkSession, "ranked"))
    group = [F.col(within).alias("_group")] if within else [F.lit(0).alias("_group")]
    sizes = rows.groupBy("_part", *group).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(F.col("_part").alias("_p"), "_group", (
        F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_base"))
    same = F.col("_part") == F.col("_p")
    if within:
        same &= F.col(within).eqNullSafe(F.col("_group"))
    return (rows.join(F.broadcast(bases), same).withColumn(rank, F.col("_place") + F.col("_base"))
                .drop("_part", "_place", "_p", "_group", "_base"))


def category_index_large(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """T5 for columns with any number of categories: as
    ``text_features.category_index``, with ``idx`` as a long."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"),
                               F.col(c).cast("string").alias("value")) for c in columns])
    rows = explode_values(df, pairs, name="pair").select("pair.*").where(F.col("value").isNotNull())
    return rank_categories(rows.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count")))


def rank_categories(counts: DataFrame) -> DataFrame:
    """(``column_name``, ``value``, ``count``) with ``idx``: per column the
    most frequent value first, ties by the smaller value."""
    return ranked(counts, F.col("count").desc(), F.col("value").asc(), within="column_name", rank="idx")


def smallest_kept(df: DataFrame, count: str, size: int) -> tuple[int, int] | None:
    """The largest t such that at least ``size`` rows have a count (not
    negative) of t or more, and how many have more; None if there are no more
    than ``size`` rows."""
    top = df.agg(F.max(count)).head()[0]
    if top is None or df.count() <= size:
        return None
    prefix, above = 0, 0
    for shift in range(max(int(top).bit_length() - 1, 0) // RADIX * RADIX, -1, -RADIX):
        digit = F.shiftright(F.col(count), shift).alias("digit")
        part = df.where(F.shiftright(F.col(count), shift + RADIX) == prefix) if shift + RADIX < 63 else df
        histogram = part.groupBy(digit).agg(F.count(F.lit(1)).alias("n")).collect()  # at most 2 ** RADIX rows
        for value, n in sorted(histogram, reverse=True):
            if above + n >= size:
                prefix = value
                break
            above += n
    return prefix, above


def most_frequent(df: DataFrame, count: str, name: str, size: int) -> DataFrame:
    """The ``size`` rows of a stored ``df`` with the largest ``count``, ties by
    the smaller ``name`` (unique)."""
    found = smallest_kept(df, count, size)
    if found is None:
        return df
    least, above = found
    ties = df.where(F.col(count) == least).orderBy(name).limit(size - above)
    return df.where(F.col(count) > least).unionByName(ties)


def vocabulary(pairs: DataFrame, size: int, min_df: float = 1.0, n_docs: int | None = None) -> DataFrame:
    """The terms that CountVectorizer keeps of ``(doc, term, tf)``: of
    those in at least ``min_df`` documents (a share of ``n_docs`` below 1) the
    ``size`` with the most occurrences; ``(term, total, df)``.  Terms that tie
    at the border are taken in their own order."""
    if min_df < 1 and n_docs is None:
        raise ValueError("a share of the documents needs their number")
    bound = min_df if min_df >= 1 else min_df * n_docs
    terms = pairs.groupBy("term").agg(F.sum("tf").alias("total"), F.count_if(F.col("tf") > 0).alias("df"))
    terms = materialize(terms.where(F.col("df") >= bound), shared_dir(pairs.sparkSession, "terms"))
    return most_frequent(terms, "total", "term", size)
