"""Twin checks: each relational text/category stage against its
pyspark.ml stage (SURVEY section 5, "twin")."""

import pytest
from pyspark.ml.feature import (IDF, CountVectorizer, OneHotEncoder, RegexTokenizer,
                                StopWordsRemover, StringIndexer)
from pyspark.sql import functions as F

from paths import SF_SMALL
from fundlens.functions.text import ENGLISH_STOP_WORDS
from fundlens.operators import text_features as TF
from fundlens.plans.campaign_queries import campaign_prepare
from fundlens.sources import table


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF_SMALL, "documents", ["doc_id", "text"]).cache()


def test_stop_word_list_is_spark_default(spark):
    assert list(ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_tokens_and_stop_words_match_ml(spark, docs):
    ml = RegexTokenizer(inputCol="text", outputCol="ml_tokens", pattern=r"\W+").transform(docs)
    ml = StopWordsRemover(inputCol="ml_tokens", outputCol="ml_filtered").transform(ml)
    ours = ml.transform(TF.add_tokens).transform(TF.add_filtered)
    bad = ours.where((F.col("tokens") != F.col("ml_tokens")) | (F.col("filtered") != F.col("ml_filtered")))
    assert bad.count() == 0


def test_filtered_keeps_repeats(spark):
    df = spark.createDataFrame([("the cat and the cat",)], "text string")
    out = df.transform(TF.add_tokens).transform(TF.add_filtered).first()["filtered"]
    assert out == ["cat", "cat"]


def test_tfidf_matches_ml(spark, docs):
    d = docs.transform(TF.add_tokens).transform(TF.add_filtered)
    cv = CountVectorizer(inputCol="filtered", outputCol="tf_vec").fit(d)
    v = IDF(inputCol="tf_vec", outputCol="tfidf_vec").fit(cv.transform(d)).transform(cv.transform(d))
    vocab = cv.vocabulary
    ml = {}
    for r in v.select("doc_id", "tf_vec", "tfidf_vec").collect():
        for i, w in zip(r["tfidf_vec"].indices, r["tfidf_vec"].values):
            ml[(r["doc_id"], vocab[i])] = (r["tf_vec"][int(i)], w)
    ours = {(r["doc_id"], r["term"]): (r["tf"], r["tfidf"])
            for r in TF.tfidf(d, "doc_id").collect()}
    assert ours.keys() == ml.keys()
    for k, (tf, w) in ours.items():
        assert tf == ml[k][0]
        assert w == pytest.approx(ml[k][1], rel=1e-9, abs=1e-12)


def test_min_df_filters_terms(spark, docs):
    d = docs.transform(TF.add_tokens).transform(TF.add_filtered)
    t = TF.tfidf(d, "doc_id", min_df=5.0)
    assert t.where(F.col("df") < 5).count() == 0
    cv = CountVectorizer(inputCol="filtered", outputCol="v", minDF=5.0).fit(d)
    assert t.select("term").distinct().count() == len(cv.vocabulary)


def test_category_index_and_one_hot_match_ml(spark):
    prep = campaign_prepare(spark, SF_SMALL).cache()
    cols = ("country2", "currency2")
    idx = TF.category_index(prep, cols)
    for c in cols:
        labels = StringIndexer(inputCol=c, outputCol="i", handleInvalid="skip").fit(prep).labelsArray[0]
        ours = [r["value"] for r in idx.where(F.col("column_name") == c).orderBy("idx").collect()]
        assert ours == list(labels), c
    ml = prep
    for c in cols:
        ml = StringIndexer(inputCol=c, outputCol=f"{c}_i", handleInvalid="skip").fit(ml).transform(ml)
    ml = OneHotEncoder(inputCols=[f"{c}_i" for c in cols], outputCols=[f"{c}_v" for c in cols]).fit(ml).transform(ml)
    hot = TF.one_hot(prep, "project_id", cols, idx)
    joined = ml.join(hot, "project_id").collect()
    assert len(joined) == prep.count()
    for r in joined:
        for c in cols:
            vec = r[f"{c}_v"]
            assert vec.size == r[f"{c}_size"]
            pos = list(vec.indices)
            assert pos == ([] if r[f"{c}_hot"] is None else [r[f"{c}_hot"]])
            assert r[f"{c}_i"] == r[f"{c}_idx"]
