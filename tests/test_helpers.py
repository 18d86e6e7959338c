"""Scale helpers: hot-key joins, spread, bounded preview, shared folder."""

import os

from pyspark.sql import functions as F

from fundlens.operators.profile import preview
from fundlens.session import checkpoint_root, shared_dir
from fundlens.sources.tables import spread


def test_spread_is_noop_when_parallel_enough(spark):
    wide = spark.range(0, 1000, numPartitions=16)
    assert spread(wide, min_partitions=8) is wide
    narrow = spark.range(0, 1000, numPartitions=1)
    out = spread(narrow, "id", min_partitions=8)
    assert out.rdd.getNumPartitions() == 8
    assert sorted(r[0] for r in out.collect()) == list(range(1000))


def test_preview_is_bounded(spark):
    rows = preview(spark.range(100), 5, F.col("id").desc())
    assert [r[0] for r in rows] == [99, 98, 97, 96, 95]


def test_shared_dir_under_checkpoint_root(spark):
    root = checkpoint_root(spark)
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a != b and a.startswith(os.path.join(root, "fundlens"))
    assert spark.sparkContext.getCheckpointDir() is not None


def test_scale_conf():
    from fundlens.session import scale_conf
    c = scale_conf(100 << 40)  # 100 TiB through the largest shuffle
    assert int(c["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert scale_conf(1 << 20)["spark.sql.shuffle.partitions"] == "200"


def test_join_hot_split_equals_plain_join(spark):
    from fundlens.operators.joins import join_hot_split
    # key 0 holds a third of all rows
    big = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1).alias("k"),
        F.col("id").alias("v"))
    keyed = big.groupBy("k").agg(F.count(F.lit(1)).alias("w"))
    # key 0's share of the rows is above its row's share of the bytes, no other's is
    split = join_hot_split(big, keyed, "k", "w", max_bytes=1000)
    plain = big.join(keyed, "k")
    assert sorted(split.collect()) == sorted(plain.collect())
    # the hot key is matched by the broadcast branch only
    p = split._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in p and "LeftOuter" in p


def test_join_hot_split_of_a_small_key_table(spark):
    from fundlens.operators.joins import join_hot_split
    big = spark.range(5000).select((F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    keyed = big.groupBy("k").agg(F.count(F.lit(1)).alias("w"))
    out = join_hot_split(big, keyed, "k", "w")  # all hot
    assert sorted(out.collect()) == sorted(big.join(keyed, "k").collect())


def test_customer_with_a_third_of_all_orders(spark):
    from fundlens.sources.views import with_customers
    orders = spark.range(3000).select(F.col("id").alias("o_orderkey"), F.when(
        F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).cast("long").alias("o_custkey"))
    customer = spark.range(400).select(F.col("id").alias("c_custkey"), F.concat(F.lit("c"), "id").alias("c_name"),
                                       (F.col("id") % 25).alias("c_nationkey"))
    got = with_customers(orders, customer).select("o_orderkey", "o_custkey", "c_name").collect()
    want = orders.join(customer, F.col("c_custkey") == F.col("o_custkey")).select("o_orderkey", "o_custkey", "c_name")
    assert sorted(got) == sorted(want.collect())


def test_folders_are_removed(spark):
    import pytest
    from fundlens.session import remove_dir
    path = shared_dir(spark, "t-gone")
    spark.range(3).write.parquet(path)
    remove_dir(spark, path)
    assert not os.path.exists(path)
    with pytest.raises(ValueError):
        remove_dir(spark, "/tmp")
