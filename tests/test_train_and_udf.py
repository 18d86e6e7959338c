"""Model fit / tune / save / reload on sf0.001, and the null-safe UDF."""

import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from fundlens.functions.cleaning import clean_currency
from fundlens.functions.udfs import clean_currency_udf, identity_udf, null_safe_udf
from fundlens.operators import evaluate as EV
from fundlens.operators import train as TR
from fundlens.plans.campaign_queries import campaign_prepare
from fundlens.session import shared_dir


@pytest.fixture(scope="module")
def split(spark):
    return EV.hash_split(campaign_prepare(spark, SF_SMALL), "project_id")


def test_fit_save_reload_same_predictions(spark, split):
    train, test = split
    model = TR.fit(train)
    assert len(model.stages) == 9
    path = TR.save_model(model, shared_dir(spark, "t-model"))
    again = TR.load_model(path)
    a = model.transform(test).select("project_id", "predictions")
    b = again.transform(test).select("project_id", F.col("predictions").alias("p2"))
    j = a.join(b, "project_id")
    assert j.count() == test.count()
    assert j.where(F.col("predictions") != F.col("p2")).count() == 0


def test_tune_small_grid(spark, split):
    train, _ = split
    sizes = []
    tuned = TR.tune(train, TR.grid_of(reg_param=(1e-7, 0.1), min_df=(1.0, 20.0), max_iter=(5,)), sizes=sizes)
    assert len(tuned.validationMetrics) == 4 and len(tuned.bestModel.stages) == 9
    assert all(0.0 <= f1 <= 1.0 for f1 in tuned.validationMetrics)
    # vocabularies differ by min_df, and only by it
    vocabulary = [v for *_, v in sizes]
    assert vocabulary[0] == vocabulary[2] > vocabulary[1] == vocabulary[3]
    assert len({(f, v) for f, v, _ in sizes}) == 1
    # saved and reloaded with its grid and metrics
    again = TR.load_model(TR.save_model(tuned, shared_dir(spark, "t-tuned")))
    assert again.validationMetrics == tuned.validationMetrics
    grid = lambda m: [{p.name: v for p, v in point.items()} for point in m.getEstimatorParamMaps()]
    assert grid(again) == grid(tuned) and grid(again)[0] == {"regParam": 1e-7, "minDF": 1.0, "maxIter": 5}
    set_ = lambda m: [r for r in TR.parameter_report(m) if not r[3].endswith("__output")]
    assert set_(again) == set_(tuned)


def test_tune_persists_little(spark, split):
    """Persisted datasets at any time, sampled while tuning."""
    import threading
    import time
    train, _ = split
    most, done = [0], threading.Event()

    def watch():
        while not done.is_set():
            most[0] = max(most[0], spark.sparkContext._jsc.getPersistentRDDs().size())
            time.sleep(0.02)

    watcher = threading.Thread(target=watch)
    watcher.start()
    TR.tune(train, TR.grid_of(reg_param=(1e-5, 1e-3, 0.1), min_df=(1.0, 5.0)))
    done.set()
    watcher.join()
    assert most[0] <= 3


def test_tune_by_random_split(spark, split):
    train, _ = split
    tuned = TR.tune(train, TR.grid_of(reg_param=(0.1,)), key=None)
    assert len(tuned.validationMetrics) == 1


def test_hash_split_is_partition_independent(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = EV.hash_split(df.repartition(3), "k")[1].orderBy("k").collect()
    b = EV.hash_split(df.repartition(7), "k")[1].orderBy("k").collect()
    assert a == b and 50 < len(a) < 150


def test_null_safe_udf(spark):
    df = spark.createDataFrame([("EUR",), ("True",), (None,), ("US",)], "currency string")
    got = df.select(clean_currency_udf()("currency").alias("u"), clean_currency("currency").alias("n")).collect()
    assert [tuple(r) for r in got] == [("EUR", "EUR"), (None, None), (None, None), (None, None)]
    # a function that would turn null into a value still yields null
    always_x = null_safe_udf(lambda s: s.fillna("x").map(lambda v: "x"), "string")
    assert [r[0] for r in df.select(always_x("currency")).collect()] == ["x", "x", None, "x"]


def test_udf_keeps_types(spark):
    big, nan = (1 << 53) + 1, float("nan")
    df = spark.createDataFrame([(big, nan), (None, 1.5), (3, None)], "b long, d double")
    got = df.select(identity_udf("long")("b"), identity_udf("double")("d")).collect()
    assert [r[0] for r in got] == [big, None, 3]
    assert got[0][1] != got[0][1] and [r[1] for r in got[1:]] == [1.5, None]
    both = null_safe_udf(lambda a, b: a + b, "double")
    assert [r[0] for r in df.select(both(F.col("b").cast("double"), "d")).collect()][1:] == [None, None]
    nothing = df.where("b is null and d is null").select(identity_udf("long")("b"))
    assert nothing.collect() == []
