"""Join helpers.

A side is only hinted for broadcast when its size in bytes is bounded by
construction.  Other joins are left to Spark; AQE may turn them into a
broadcast at run time from real shuffle statistics, and splits skewed
partitions (``spark.sql.adaptive.skewJoin.enabled``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Bytes of the broadcast side of a hot-key split.
HOT_BYTES = 64 << 20


def join_hot_split(big: DataFrame, keyed: DataFrame, key: str, weight: str,
                   max_bytes: int = HOT_BYTES) -> DataFrame:
    """Inner join of ``big`` with ``keyed`` (one row per key) when the exact
    number of ``big`` rows per key is known (``keyed[weight]``, e.g. a
    term's document frequency is its number of (doc, term) pairs).

    A key is hot by its weight alone: when its share of all ``big`` rows is
    larger than its row's share of ``max_bytes``.  The shares add up to at
    most 1, so the hot rows of ``keyed`` take at most ``max_bytes`` and are
    broadcast; their rows of ``big`` never enter a shuffle: they are marked by
    a broadcast left join and filtered out before the remaining keys are
    joined by shuffle, where a key of ``b`` bytes has at most ``b / max_bytes``
    of all rows.  Nothing is sampled or dropped.

    The exclusion is a left join + ``IS NULL`` rather than a left-anti
    join: Catalyst pushes an anti join below an aggregate on the key, which
    would make the two branches' copies of ``big`` differ and stop Spark
    from reusing one exchange for both.
    """
    # a row's size as text, with room for fixed-width fields and overhead
    size = sum((F.octet_length(F.coalesce(F.col(c).cast("string"), F.lit(""))) + 32
                for c in keyed.columns), F.lit(0))
    total = keyed.agg(F.coalesce(F.sum(weight), F.lit(0))).scalar()
    is_hot = F.col(weight) * F.lit(float(max_bytes)) > size * total
    hot = keyed.where(is_hot)
    cold = keyed.where(~is_hot)
    hot_part = big.join(F.broadcast(hot), key)
    marks = F.broadcast(hot.select(key, F.lit(True).alias("_hot_key")))
    cold_part = (big.join(marks, key, "left").where(F.col("_hot_key").isNull())
                    .drop("_hot_key").join(cold, key))
    return hot_part.unionByName(cold_part)
