"""Training, tuning, persistence.

The reference fits its nine-stage pipeline inside a train/validation grid
search, so the tokenizer and stop-word stages (which have nothing to tune) are
re-run for each grid point.  Here the tokens are written once to the shared
folder, and a featurizer is fitted once for all points that share its
parameters but for the least document frequency: their vocabularies are nested,
so the others' features are slices of its vectors.  Features are written once
per vocabulary, for all classifiers.  The result is the same
``TrainValidationSplitModel``.

Driver-side state is MLlib's own and bounded by parameters: the vocabulary
(at most ``vocab_size`` terms), the category labels, the coefficient vector.
Gradients are combined with a tree aggregate on the executors.
"""

from __future__ import annotations

import contextlib
import itertools
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import SparkContext, StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.tuning import TrainValidationSplitModel
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession, functions as F

from fundlens.operators.evaluate import hash_bucket
from fundlens.operators.text_features import ml_stages
from fundlens.session import remove_dir, shared_dir
from fundlens.sources.files import materialize

# The reference's grid (regParam written 10e-8 ... 10e-2).
REG_PARAMS = (1e-7, 1e-5, 1e-3, 1e-1)
MIN_DFS = (55.0, 75.0, 95.0)
TRAIN_RATIO = 0.7
SPLIT_SEED = 1991


@contextlib.contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Persist, materialise once, hand out, unpersist on exit.  A lost
    cached block is recomputed from lineage, so this is safe under executor
    loss."""
    df.persist(level)
    try:
        df.count()
        yield df
    finally:
        df.unpersist()


def random_split(df: DataFrame, weights=(0.9, 0.1), seed: int = SPLIT_SEED):
    """M1 as in the reference (membership depends on partitioning)."""
    return df.randomSplit(list(weights), seed)


def build_pipeline(**kw) -> Pipeline:
    """M3: the nine stages in one Pipeline."""
    return Pipeline(stages=ml_stages(**kw))


@contextlib.contextmanager
def tokenised(train: DataFrame, pre: PipelineModel):
    """The rows with their tokens, without the text, written once to the
    shared folder and removed on exit."""
    spark = train.sparkSession
    path = shared_dir(spark, "tokens")
    text = pre.stages[0].getInputCol()
    try:
        yield materialize(pre.transform(train).drop(text, "tokens"), path)
    finally:
        remove_dir(spark, path)


def fit(train: DataFrame, **kw) -> PipelineModel:
    """M4: fit the nine-stage pipeline; the input is tokenised once, for all
    of its estimators."""
    stages = ml_stages(**kw)
    pre = Pipeline(stages=stages[:2]).fit(train)
    with tokenised(train, pre) as rows:
        rest = Pipeline(stages=stages[2:]).fit(rows)
    return PipelineModel(stages=[*pre.stages, *rest.stages])


def parameter_report(model) -> list[tuple[int, str, str, str]]:
    """M4: (stage, its class, parameter, value) of a fitted pipeline, as
    ``extractParamMap`` gives them."""
    best = getattr(model, "bestModel", model)
    return [(i, type(stage).__name__, param.name, str(value)) for i, stage in enumerate(best.stages)
            for param, value in sorted(stage.extractParamMap().items(), key=lambda x: x[0].name)]


def f1_evaluator(label_col: str = "final_status", prediction_col: str = "predictions",
                 metric: str = "f1") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(metricName=metric, labelCol=label_col,
                                             predictionCol=prediction_col)


# What a grid may set: the stage and its parameter.
TUNABLE = {"min_df": (2, "minDF"), "min_tf": (2, "minTF"), "vocab_size": (2, "vocabSize"),
           "min_doc_freq": (3, "minDocFreq"), "reg_param": (8, "regParam"), "max_iter": (8, "maxIter"),
           "elastic_net": (8, "elasticNetParam"), "tol": (8, "tol")}


def grid_of(**values: Sequence) -> list[dict]:
    """All combinations, the first parameter slowest."""
    return [dict(zip(values, point)) for point in itertools.product(*values.values())]


def inner_split(df: DataFrame, key: str, train_ratio: float = TRAIN_RATIO):
    """(fit, validation) by a hash of the key, in tenths: the same rows on
    any cluster."""
    bucket = hash_bucket(F.concat(F.col(key).cast("string"), F.lit("-validation")))
    held = round((1 - train_ratio) * 10)
    return df.where(bucket >= held), df.where(bucket < held)


def document_bound(min_df: float, n_docs: int) -> float:
    """CountVectorizer's rule: a number of documents, or a share below 1."""
    return min_df if min_df >= 1 else min_df * n_docs


@contextlib.contextmanager
def sliced(parts: Sequence[DataFrame], model: PipelineModel, assembler, bound: float, classifier):
    """The (label, features) of ``parts``, transformed by a featurizer up to
    its assembler, for the terms in at least ``bound`` documents, and the number
    of those.  A term's count and weight do not depend on the vocabulary, so
    its part of the vector is sliced; the result is written once to the shared
    folder, for all classifiers, and removed on exit."""
    frequency = model.stages[1].docFreq
    terms = [i for i, n in enumerate(frequency) if n >= bound]
    inputs = assembler.getInputCols()
    spark, path = parts[0].sparkSession, []
    try:
        out = []
        for part in parts:
            if len(terms) < len(frequency) and terms:
                slicer = VectorSlicer(inputCol=inputs[0], outputCol="_terms", indices=terms)
                part = slicer.transform(part).drop(inputs[0]).withColumnRenamed("_terms", inputs[0])
            rows = assembler.transform(part).select(classifier.getLabelCol(), classifier.getFeaturesCol())
            path.append(shared_dir(spark, "features"))
            out.append(materialize(rows, path[-1]))
        yield *out, len(terms)
    finally:
        for folder in path:
            remove_dir(spark, folder)


def tune(train: DataFrame, grid: Sequence[dict] | None = None, key: str | None = "project_id",
         train_ratio: float = TRAIN_RATIO, parallelism: int = 2, seed: int = SPLIT_SEED,
         sizes: list | None = None, **kw) -> TrainValidationSplitModel:
    """M5 + M6: grid search on a train/validation split, best by f1, refit on
    all of ``train``: a ``TrainValidationSplitModel`` with the grid, each
    point's metric and the best nine-stage model.

    ``grid``: points over ``TUNABLE`` (by default the reference's 12).  Points
    that differ only in the classifier and ``min_df`` share one featurizer.  The split is by
    a hash of ``key``; with None it is ``randomSplit``, as in the reference,
    whose membership depends on partitioning.  ``sizes`` collects (fit rows,
    validation rows, vocabulary) per point."""
    grid = list(grid or grid_of(reg_param=REG_PARAMS, min_df=MIN_DFS))
    stages = ml_stages(**kw)
    pipeline, evaluator = Pipeline(stages=stages), f1_evaluator(kw.get("label_col", "final_status"))
    maps = [{stages[TUNABLE[k][0]].getParam(TUNABLE[k][1]): v for k, v in point.items()} for point in grid]
    # minDF alone does not need another count, unless the vocabulary is cut by size
    nested = {"min_df"} if not any("vocab_size" in p or "min_tf" in p for p in grid) else set()
    features_of = [tuple(sorted((k, v) for k, v in point.items() if TUNABLE[k][0] < 8 and k not in nested))
                   for point in grid]
    metrics: list[float] = [0.0] * len(grid)
    counts: list = [None] * len(grid)
    pre = Pipeline(stages=stages[:2]).fit(train)

    with tokenised(train, pre) as rows:
        fit_part, val_part = (inner_split(rows, key, train_ratio) if key
                              else rows.randomSplit([train_ratio, 1 - train_ratio], seed))
        n_fit = fit_part.count()
        n_rows = (n_fit, val_part.count()) if sizes is not None else None
        for shared in dict.fromkeys(features_of):
            # the points that share a featurizer but for the least document
            # frequency; their vocabularies are parts of the largest one
            points = [i for i, f in enumerate(features_of) if f == shared]
            bounds = [grid[i].get("min_df", stages[2].getMinDF()) for i in points]
            least = points[min(range(len(points)), key=lambda k: document_bound(bounds[k], n_fit))]
            front = [s.copy(maps[least]) for s in stages[2:-1]]
            model = Pipeline(stages=front[:-1]).fit(fit_part)
            parts = [model.transform(part) for part in (fit_part, val_part)]
            for bound in dict.fromkeys(bounds):
                same = [i for i, b in zip(points, bounds) if b == bound]
                with sliced(parts, model, front[-1], document_bound(bound, n_fit), stages[-1]) as (fits, vals, n_terms):
                    def score(i: int) -> float:
                        return evaluator.evaluate(stages[-1].copy(maps[i]).fit(fits).transform(vals))

                    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
                        for i, metric in zip(same, pool.map(score, same)):
                            metrics[i] = float(metric)
                            counts[i] = n_rows and (*n_rows, n_terms)
        best = max(range(len(grid)), key=metrics.__getitem__)
        rest = Pipeline(stages=[s.copy(maps[best]) for s in stages[2:]]).fit(rows)
    if sizes is not None:
        sizes.extend(counts)
    found = TrainValidationSplitModel(PipelineModel(stages=[*pre.stages, *rest.stages]), metrics)
    found._set(estimator=pipeline, estimatorParamMaps=maps, evaluator=evaluator, trainRatio=train_ratio, seed=seed)
    return found


def vector_entries(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, i, value)``: the entries of a sparse or dense vector column,
    without zeros."""
    vector = F.unwrap_udt(vector_col)
    places = F.when(vector["type"] == 0, vector["indices"]) \
        .otherwise(F.transform(F.sequence(F.lit(0), F.size(vector["values"]) - 1), lambda i: i))
    entries = F.arrays_zip(places.alias("i"), vector["values"].alias("value"))
    return (df.select(id_col, F.explode_outer(entries).alias("entry"))
              .select(id_col, F.col("entry.i").alias("i"), F.col("entry.value").alias("value"))
              .where("value <> 0"))


def coefficient_table(model) -> DataFrame:
    """``(i, coefficient)`` of a fitted classifier; i = -1 is the intercept."""
    spark = SparkSession.active()
    rows = [(int(i), float(x)) for i, x in enumerate(model.coefficients) if x] + [(-1, float(model.intercept))]
    return spark.createDataFrame(rows, "i int, coefficient double")


def stationarity(rows: DataFrame, classifier, id_col: str, blocks: Sequence[tuple[str, int]]) -> DataFrame:
    """M2: how far a fitted logistic regression is from the minimum of its
    loss over ``rows`` (those it was fitted on, with features and label).

    Per block of features, named with its size, and for the intercept: the
    number of features and the norm of the loss's gradient by the standardised
    coefficients, ``mean((p - y) x / s) + reg * s * coefficient``, 0 at the
    minimum (s: the feature's sample deviation; constant features have no
    coefficient).  It is a sparse dot product by joins: entries with
    coefficients to a margin per row, rows' residuals back to entries, summed
    per feature in front of the shuffle.  Coefficients are one per feature, as
    MLlib holds them on the driver."""
    label, reg = classifier.getLabelCol(), classifier.getRegParam()
    spark = rows.sparkSession
    folder = shared_dir(spark, "entries")
    entries = materialize(vector_entries(rows, id_col, classifier.getFeaturesCol()), folder)
    betas = coefficient_table(classifier)
    margins = (entries.join(F.broadcast(betas), "i").groupBy(id_col)
               .agg(F.sum(F.col("value") * F.col("coefficient")).alias("margin")))
    p = 1 / (1 + F.exp(-(F.coalesce("margin", F.lit(0.0)) + float(classifier.intercept))))
    residuals = materialize(rows.select(id_col, label).join(margins, id_col, "left")
                            .select(id_col, (p - F.col(label)).alias("residual")), shared_dir(spark, "residuals"))
    n = residuals.count()
    per_feature = (entries.join(residuals, id_col).groupBy("i")
                   .agg(F.sum(F.col("value") * F.col("residual")).alias("dot"),
                        F.sum("value").alias("total"), F.sum(F.col("value") * F.col("value")).alias("squares")))
    deviation = F.sqrt(F.greatest((F.col("squares") - F.col("total") * F.col("total") / n) / (n - 1), F.lit(0.0)))
    slope = per_feature.join(F.broadcast(betas), "i", "left").withColumn("s", deviation).select("i", F.when(
        F.col("s") > 1e-12, F.col("dot") / n / F.col("s")
        + reg * F.col("s") * F.coalesce("coefficient", F.lit(0.0))).otherwise(0.0).alias("slope"))
    block, start = F.lit(None).cast("string"), sum(size for _, size in blocks)
    for name, size in reversed(blocks):
        block = F.when(F.col("i") < start, F.lit(name)).otherwise(block)
        start -= size
    names = spark.createDataFrame([(b, int(size)) for b, size in blocks], "block string, n_features long")
    norms = slope.groupBy(block.alias("block")).agg(F.sqrt(F.sum(F.col("slope") * F.col("slope"))).alias("norm"))
    intercept = residuals.agg(F.abs(F.avg("residual")).alias("norm")) \
        .select(F.lit("intercept").alias("block"), F.lit(1).cast("long").alias("n_features"), "norm")
    return (names.join(norms, "block", "left").select("block", "n_features", F.coalesce("norm", F.lit(0.0)).alias("norm"))
            .union(intercept))


def save_model(model, path: str, overwrite: bool = True) -> str:
    """Write a fitted model (the default refuses an existing path)."""
    w = model.write()
    (w.overwrite() if overwrite else w).save(path)
    return path


def stored_parameters(spark: SparkSession, path: str) -> DataFrame:
    """S7 + M4: ``(stage, stage_class, parameter, value)`` of a saved pipeline
    or of a saved tuned model's best one, read from its metadata: one JSON line
    a stage, parameters that were set over the defaults.  Values are JSON; the
    stages are in the order of their folders' numbers."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").text(path) \
        .select("value", F.regexp_extract(F.input_file_name(), r"/stages/(\d+)_[^/]*/metadata/[^/]*$", 1).alias("at")) \
        .where((F.col("at") != "") & F.col("value").startswith("{") & ~F.input_file_name().contains("/estimator/"))
    meta = F.from_json("value", "class string, paramMap map<string,string>, defaultParamMap map<string,string>")
    rows = lines.select(F.col("at").cast("int").alias("stage"), meta.alias("m"))
    both = F.map_zip_with("m.paramMap", "m.defaultParamMap", lambda _, own, default: F.coalesce(own, default))
    return rows.select("stage", F.element_at(F.split("m.class", r"\."), -1).alias("stage_class"),
                       F.explode(both).alias("parameter", "value"))


def load_model(path: str) -> PipelineModel | TrainValidationSplitModel:
    """Reload a saved model, a pipeline's or a tuned one with its grid
    and metrics."""
    return DefaultParamsReader.loadParamsInstance(path, SparkContext.getOrCreate())
