"""Model queries (step 6): the text pipeline on ``documents`` with ``labels``.

Coefficients are not SQL; the results hold what SQL can say of a model: the
rows it scores, the size of its features and vocabulary, and that its
predictions follow its probabilities.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from fundlens.operators import evaluate as EV
from fundlens.operators import text_features as TF
from fundlens.operators import train as TR
from fundlens.operators.text_features import THRESHOLDS
from fundlens.plans.oracle import GRID_MIN_DF, GRID_REG, MODEL_MIN_DF
from fundlens.session import shared_dir
from fundlens.sources.files import materialize
from fundlens.sources.tables import spread, table

#: Norm of a gradient that counts as 0.
GRADIENT_TOLERANCE = 1e-4
STAGES = {"label_col": "quality", "categorical": ("lang", "source"), "numeric": ("n_chars",)}


def _split(spark, sf):
    """Labelled documents, written once, and their hash split."""
    docs = table(spark, sf, "documents", ["doc_id", "text", "lang", "source", "n_chars"])
    labels = table(spark, sf, "labels", ["doc_id", "quality"])
    rows = materialize(spread(docs.join(labels, "doc_id"), "doc_id"), shared_dir(spark, "labelled"))
    return EV.hash_split(rows, "doc_id")


def train_score(spark: SparkSession, sf: str) -> DataFrame:
    """Fit the nine stages on 90 %, score the other 10 %: per label the rows
    scored, those whose prediction is not p(1) > 0.3, and the features."""
    train, test = _split(spark, sf)
    scored = TR.fit(train, min_df=float(MODEL_MIN_DF), **STAGES).transform(test)
    above = (vector_to_array("probability")[1] > THRESHOLDS[1]).cast("int")
    return scored.groupBy("quality").agg(
        F.count(F.lit(1)).alias("n_scored"), F.count_if(above != F.col("predictions")).alias("n_disagree"),
        F.max(F.size(vector_to_array("features"))).cast("long").alias("feature_size"))


def grid_search(spark: SparkSession, sf: str) -> DataFrame:
    """The 12-point grid: per point the rows it is fitted on and judged on,
    and its vocabulary."""
    train, _ = _split(spark, sf)
    sizes: list = []
    grid = TR.grid_of(reg_param=GRID_REG, min_df=GRID_MIN_DF)
    TR.tune(train, grid, key="doc_id", sizes=sizes, **STAGES)
    rows = [(float(p["reg_param"]), float(p["min_df"]), *map(int, n)) for p, n in zip(grid, sizes)]
    return spark.createDataFrame(
        rows, "reg_param double, min_df double, n_fit long, n_validation long, vocabulary long")


def model_stationarity(spark: SparkSession, sf: str) -> DataFrame:
    """A regularised classifier fitted to convergence on the training rows:
    per feature block whether the loss's gradient there is below
    ``GRADIENT_TOLERANCE``."""
    train, _ = _split(spark, sf)
    model = TR.fit(train, min_df=float(MODEL_MIN_DF), reg_param=0.1, max_iter=300, tol=1e-10, **STAGES)
    rows = PipelineModel(stages=model.stages[:-1]).transform(train).select("doc_id", "quality", "features")
    rows = materialize(rows, shared_dir(spark, "fitted-rows"))
    blocks = [("tfidf", len(model.stages[2].vocabulary)), ("n_chars", 1),
              *((c, len(model.stages[4 + k].labels) - 1) for k, c in enumerate(STAGES["categorical"]))]
    found = TR.stationarity(rows, model.stages[-1], "doc_id", blocks)
    return found.select("block", "n_features", (F.col("norm") < GRADIENT_TOLERANCE).alias("stationary"))


def model_confusion(spark: SparkSession, sf: str) -> DataFrame:
    """The tuned model's coefficients applied as a table: relational TF-IDF
    weights and categories joined to them give a margin per held-out row, and
    p(1) > 0.3 a prediction.  Per label: rows, those the model itself predicts
    otherwise, and those whose probabilities differ by over 1e-9."""
    train, test = _split(spark, sf)
    grid = TR.grid_of(reg_param=GRID_REG[2:3], min_df=GRID_MIN_DF[-1:])
    best = TR.tune(train, grid, key="doc_id", **STAGES).bestModel
    cv, idf, *indexers = best.stages[2:4 + len(STAGES["categorical"])]
    weights = [float(x) for x in best.stages[-1].coefficients]
    terms = spark.createDataFrame([(t, float(idf.idf[i]), weights[i]) for i, t in enumerate(cv.vocabulary)],
                                  "term string, idf double, weight double")
    counts = TF.term_counts(test.transform(TF.add_tokens).transform(TF.add_filtered), "doc_id")
    by_text = (counts.join(F.broadcast(terms), "term").groupBy("doc_id")
               .agg(F.sum(F.col("tf") * F.col("idf") * F.col("weight")).alias("margin")))
    at = len(cv.vocabulary)
    other = F.col("n_chars") * weights[at]
    at += 1
    known = F.lit(True)
    for c, indexer in zip(STAGES["categorical"], indexers):
        value = F.lit(0.0)  # the last category has no coefficient
        for k, name in enumerate(indexer.labels[:-1]):
            value = F.when(F.col(c) == name, F.lit(weights[at + k])).otherwise(value)
        other += value
        known &= F.col(c).isin(*indexer.labels)
        at += len(indexer.labels) - 1
    margin = F.coalesce("margin", F.lit(0.0)) + other + float(best.stages[-1].intercept)
    rule = test.where(known).join(by_text, "doc_id", "left").select("doc_id", (1 / (1 + F.exp(-margin))).alias("p"))
    own = best.transform(test).select("doc_id", "quality", "predictions", vector_to_array("probability")[1].alias("own"))
    both = own.join(rule, "doc_id", "left")
    return both.groupBy("quality").agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.count_if(~F.col("predictions").eqNullSafe((F.col("p") > THRESHOLDS[1]).cast("double"))).alias("n_different"),
        F.count_if(~F.coalesce(F.abs(F.col("p") - F.col("own")) < 1e-9, F.lit(False))).alias("n_apart"))


def model_parameters(spark: SparkSession, sf: str) -> DataFrame:
    """What a saved tuned model says of its best classifier, counter and
    assembler, as JSON, and the grid's size."""
    train, _ = _split(spark, sf)
    grid = TR.grid_of(reg_param=GRID_REG[:2], min_df=GRID_MIN_DF[-1:])
    path = TR.save_model(TR.tune(train, grid, key="doc_id", **STAGES), shared_dir(spark, "model"))
    found = TR.stored_parameters(spark, path)
    return found.where(F.col("parameter").isin("thresholds", "tol", "maxIter", "elasticNetParam", "minDF",
                                               "vocabSize", "handleInvalid", "dropLast"))


def model_reload(spark: SparkSession, sf: str) -> DataFrame:
    """Tune over two points, save, load back: per label the rows scored and
    those that the two models predict differently."""
    train, test = _split(spark, sf)
    grid = TR.grid_of(reg_param=GRID_REG[:2], min_df=GRID_MIN_DF[-1:])
    model = TR.tune(train, grid, key="doc_id", **STAGES)
    again = TR.load_model(TR.save_model(model, shared_dir(spark, "model")))
    first = model.bestModel.transform(test).select("doc_id", "quality", "predictions")
    second = again.bestModel.transform(test).select("doc_id", F.col("predictions").alias("again"))
    return first.join(second, "doc_id").groupBy("quality").agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.count_if(F.col("predictions") != F.col("again")).alias("n_different"))
