"""Distributed ranking and selection, profiles in one scan, nested
vocabularies, model certificates, observed writes, consumers."""

import os

import pytest
from paths import SF_SMALL
from pyspark.ml import Pipeline
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from fundlens.operators import profile, ranking
from fundlens.operators import text_features as TF
from fundlens.operators import train as TR
from fundlens.session import shared_dir
from fundlens.sources import campaigns
from fundlens.sources.files import observed_write, read_csv_checked
from fundlens.streaming.topics import append_once, append_to_topic, feed, forget_last_commit, read_topic


def test_ranked_equals_a_sort(spark):
    rows = [(i % 3 if i % 5 else None, (i * 7919) % 101, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "g int, n int, name int").repartition(9)
    order = lambda r: (-r[1], r[2])
    got = ranking.ranked(df, F.col("n").desc(), F.col("name").asc())
    assert [tuple(r)[:3] for r in sorted(got.collect(), key=lambda r: r["rank"])] == sorted(rows, key=order)
    within = ranking.ranked(df, F.col("n").desc(), F.col("name").asc(), within="g", rank="idx").collect()
    for g in (0, 1, 2, None):
        mine = sorted((r for r in within if r["g"] == g), key=lambda r: r["idx"])
        assert [r["idx"] for r in mine] == list(range(len(mine)))
        assert [tuple(r)[:3] for r in mine] == sorted((r for r in rows if r[0] == g), key=order)
    assert ranking.ranked(df.limit(0), F.col("n")).collect() == []


def test_large_category_index_equals_the_window_form(spark):
    df = spark.createDataFrame([(str(i % 17), "x" if i % 3 else None) for i in range(200)], "a string, b string")
    plain = {tuple(r) for r in TF.category_index(df, ["a", "b"]).collect()}
    large = ranking.category_index_large(df, ["a", "b"])
    assert {(r["column_name"], r["value"], r["count"], r["idx"]) for r in large.collect()} == plain
    assert large.count() == len(plain)
    tree = large._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in tree or "_group" in tree  # only over partitions' sizes


@pytest.mark.parametrize("size", [0, 1, 7, 50, 199, 200, 500])
def test_most_frequent_is_exact(spark, size):
    rows = [(f"t{i:03d}", [3, 3, 70_000, 1 << 40, (1 << 40) + i % 4, i][i % 6]) for i in range(200)]
    df = spark.createDataFrame(rows, "term string, total long").repartition(5)
    got = sorted((r["term"] for r in ranking.most_frequent(df, "total", "term", size).collect()))
    assert got == sorted(t for t, _ in sorted(rows, key=lambda r: (-r[1], r[0]))[:size])


def test_vocabulary_equals_count_vectorizer(spark):
    docs = [(i, [w for k, w in enumerate("abcdefgh") for _ in range((i * (k + 3)) % (k + 2))]) for i in range(40)]
    df = spark.createDataFrame(docs, "id int, filtered array<string>")
    model = CountVectorizer(inputCol="filtered", outputCol="v", vocabSize=5, minDF=0.3).fit(df)
    found = ranking.vocabulary(TF.term_counts(df, "id"), 5, 0.3, 40).collect()
    totals = {r["term"]: r["total"] for r in found}
    assert sorted(totals.values()) == sorted(
        sum(d.count(t) for _, d in docs) for t in model.vocabulary) and len(found) == 5
    with pytest.raises(ValueError):
        ranking.vocabulary(TF.term_counts(df, "id"), 5, 0.3)


def test_profiles_in_one_scan(spark):
    df = spark.createDataFrame([(1, "x", None), (1, None, None), (None, "x", True), (1, "x", None)],
                               "a int, b string, c boolean")
    got = profile.frequencies(df, {"a": ["a"], "ab": ["a", "b"], "c": ["c"]})
    assert {tuple(r) for r in got.collect()} == {
        ("a", "1", None, 3), ("a", None, None, 1), ("ab", "1", "x", 2), ("ab", "1", None, 1), ("ab", None, "x", 1),
        ("c", None, None, 3), ("c", "true", None, 1)}
    with pytest.raises(ValueError):
        profile.frequencies(df, {"ab": ["a", "b"], "ba": ["b", "a"]})
    from fundlens.plans.campaign_queries import profile_all
    plan = profile_all(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1 and "CartesianProduct" not in plan


def _text_rows(spark, n=60):
    words = "red green blue cyan pink grey gold jade ruby onyx".split()
    rows = [(i, " ".join(w for k, w in enumerate(words) if (i * 31 + k * 17) % (k + 2) < 2), "fr" if i % 3 else "de",
             "web" if i % 4 else "book", i % 9 * 10, int((i * 31 + 17) % 3 < 2 or i % 5 == 0)) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id int, text string, lang string, source string, n_chars int, quality int")


STAGES = {"label_col": "quality", "categorical": ("lang", "source"), "numeric": ("n_chars",)}


def test_nested_vocabularies_tune_as_single_points(spark):
    rows = _text_rows(spark)
    grid = TR.grid_of(reg_param=(0.01, 0.5), min_df=(2.0, 20.0, 0.6))
    sizes: list = []
    together = TR.tune(rows, grid, key="doc_id", sizes=sizes, **STAGES)
    fit_part, _ = TR.inner_split(rows, "doc_id")
    tokens = Pipeline(stages=TF.ml_stages(**STAGES)[:2]).fit(fit_part).transform(fit_part)
    for point, (_, _, n_terms), metric in zip(grid, sizes, together.validationMetrics):
        counter = CountVectorizer(inputCol="filtered", outputCol="v", minDF=point["min_df"]).fit(tokens)
        assert len(counter.vocabulary) == n_terms
        alone = TR.tune(rows, [point], key="doc_id", **STAGES).validationMetrics[0]
        assert metric == pytest.approx(alone, abs=1e-6)


def test_stationary_only_at_the_minimum(spark):
    rows = _text_rows(spark)
    for steps, small in ((300, True), (1, False)):
        model = TR.fit(rows, reg_param=0.1, max_iter=steps, tol=1e-12, **STAGES)
        part = model.transform(rows).select("doc_id", "quality", "features")
        found = TR.stationarity(part, model.stages[-1], "doc_id", [
            ("tfidf", len(model.stages[2].vocabulary)), ("n_chars", 1), ("lang", 1), ("source", 1)]).collect()
        assert len(found) == 5 and all(r["norm"] < 1e-5 for r in found) == small


def test_vector_entries(spark):
    df = spark.createDataFrame([(1, Vectors.sparse(4, [1, 3], [2.0, -1.0])), (2, Vectors.dense([0.0, 5.0])),
                                (3, Vectors.sparse(3, [], []))], ["id", "v"])
    assert sorted(map(tuple, TR.vector_entries(df, "id", "v").collect())) == [(1, 1, 2.0), (1, 3, -1.0), (2, 1, 5.0)]


def test_split_pipeline_and_persist(spark):
    df = spark.range(1000).repartition(4)
    parts = TR.random_split(df)
    assert sum(p.count() for p in parts) == 1000 and 50 < parts[1].count() < 150
    assert [p.count() for p in TR.random_split(df)] == [p.count() for p in parts]
    stages = TR.build_pipeline(**STAGES).getStages()
    assert [type(s).__name__ for s in stages] == [
        "RegexTokenizer", "StopWordsRemover", "CountVectorizer", "IDF", "StringIndexer", "StringIndexer",
        "OneHotEncoder", "VectorAssembler", "LogisticRegression"]
    with TR.persisted(df) as cached:
        assert cached.storageLevel.useMemory
    assert not df.storageLevel.useMemory
    from fundlens.plans.io_queries import word_count_cached
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    word_count_cached(spark, SF_SMALL).collect()
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before


def test_stored_parameters_equal_the_report(spark):
    model = TR.fit(_text_rows(spark), reg_param=0.25, **STAGES)
    path = TR.save_model(model, shared_dir(spark, "model"))
    stored = {(r.stage, r.parameter): (r.stage_class, r.value) for r in TR.stored_parameters(spark, path).collect()}
    assert stored[8, "regParam"] == ("LogisticRegressionModel", "0.25")
    assert {(i, p) for i, _, p, _ in TR.parameter_report(model)} <= {(i, p) for i, p in stored} | {
        (i, p) for i, _, p, v in TR.parameter_report(model)}
    assert {i for i, _ in stored} == set(range(9))


def test_observed_write_is_one_job(spark):
    df = campaigns(spark, SF_SMALL).select("project_id", "goal")
    path = shared_dir(spark, "observed")
    counts = observed_write(df, path, {"n": F.count(F.lit(1)), "no_goal": F.count_if(F.col("goal").isNull())})
    back = spark.read.parquet(path)
    assert counts == {"n": back.count(), "no_goal": back.where("goal is null").count()}


def test_bad_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,score\n1,"two\nlines, ""q""",3.5\n2,plain\n3,x,1.5,more\n4,,\n')
    got = read_csv_checked(spark, str(tmp_path))
    assert dict(got.dtypes)["score"] == "double" and dict(got.dtypes)["id"] == "int"
    assert sorted((r["id"], r["name"], r["_bad"]) for r in got.collect()) == [
        (1, 'two\nlines, "q"', None), (2, "plain", "2,plain"), (3, "x", "3,x,1.5,more"), (4, None, None)]


def test_broken_records_whichever_file_is_read_first(spark):
    from fundlens.plans.io_queries import csv_inferred
    rows = [(50, 1, 1.5, "  lead"), (50, 1, 1.5, "  lead"), (100, 2, None, ""), (101, None, 2e10, 'a"b\\'),
            (102, 3, -0.5, None), (None, 4, 1.0, "x"), (3_000_000_000, 5, 7.25, "\ttab")]
    sf = shared_dir(spark, "few-customers")
    spark.createDataFrame(rows, "c_custkey long, c_nationkey int, c_acctbal double, c_name string") \
        .coalesce(1).write.parquet(os.path.join(sf, "customer.parquet"))
    want = [(k, n, b, None if c is None else c + ' says "yes, no"\nand more', False) for k, n, b, c in rows]
    want += [(k, None, None, None, True) for k, *_ in rows if k is not None and k % 50 == 0]
    for _ in range(6):  # file names, and so their order, are random
        assert sorted(map(tuple, csv_inferred(spark, sf).collect()), key=repr) == sorted(want, key=repr)


def test_a_replayed_batch_writes_nothing_twice(spark):
    base = shared_dir(spark, "consumer")
    topic, sink, offset = (os.path.join(base, p) for p in ("topic", "sink", "offset"))
    assert forget_last_commit(spark, offset) is None
    append_to_topic(spark.range(100).repartition(3), topic)
    stream = read_topic(spark, topic, spark.range(1).schema, max_files_per_trigger=1)
    append_once(stream, sink, offset)
    before = {r.id: r.batch for r in spark.read.parquet(sink).collect()}
    written = os.stat(os.path.join(sink, "batch=2")).st_mtime_ns
    assert forget_last_commit(spark, offset) == 2
    append_once(stream, sink, offset)
    again = spark.read.parquet(sink).collect()
    assert len(again) == 100 and {r.id: r.batch for r in again} == before
    assert os.stat(os.path.join(sink, "batch=2")).st_mtime_ns > written


def test_feed_goes_on_after_a_restart(spark):
    base = shared_dir(spark, "feed")
    path, offset = os.path.join(base, "topic"), os.path.join(base, "offset")
    feed(spark, path, offset, 25, 1_700_000_000_000, interval_ms=500, rows_per_batch=10)
    rows = sorted((r.number, r.timestamp.timestamp(), r.value[-9:]) for r in spark.read.parquet(path).collect())
    assert rows == [(i, 1_700_000_000 + i / 2, "500000000" if i % 2 else "000000000") for i in range(25)]
