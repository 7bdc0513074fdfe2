"""Supervised failure-risk models on Spark ML."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleethazard.functions.scalar import logit_loss
from fleethazard.operators.metrics import class_balanced_weights
from fleethazard.operators.ordered import lookup_join
from fleethazard.operators.scaling import fit_scaler, scaler_params
from fleethazard.operators.sweep import ranking_of, score_counts
from fleethazard.params import ModelSpec
from fleethazard.session import compiled_methods, written

WEIGHT = "_weight"
PART_CELLS = 100_000_000  # feature values of the train rows in one task; a task of a pass costs some 27 ms beside its rows


def with_balanced_weights(train: DataFrame, label: str = "label") -> DataFrame:
    """Weight column that gives both classes the same total (two-row lookup)."""
    weights = class_balanced_weights(train, label).select(label, F.col("weight").alias(WEIGHT))
    return lookup_join(train, weights, [label])


def _in_even_parts(vectors: DataFrame, keys: Sequence[str], n_rows: int, n_features: int) -> DataFrame:
    """``vectors`` in even parts, as many for each core, kept on the executors' disks until they are unpersisted.

    A fit passes over its rows hundreds of times and a pass ends with its last task: parts as the files were cut leave most cores
    idle while a larger part, or one more than there are cores, is worked on. Rows are dealt by key; without one, in turn."""
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    parts = cores * max(1, math.ceil(n_rows * n_features / (cores * PART_CELLS)))
    keys = [c for c in keys if c in vectors.columns]
    return vectors.repartition(parts, *keys).persist(StorageLevel.DISK_ONLY)  # memory is for the fit's own form of the rows


def _fit_on_even_parts(train: DataFrame, stages: list, model, n_features: int) -> PipelineModel:
    """``model`` fitted behind ``stages``, which make the vectors once, on class-balanced rows in even parts."""
    keys = [c for c in ("engine_id", "cycle") if c in train.columns]
    vectors = PipelineModel(stages).transform(with_balanced_weights(train)).select(*keys, "features", "label", WEIGHT)
    even = _in_even_parts(vectors, keys, train.count(), n_features)
    try:
        with compiled_methods(train.sparkSession):
            return PipelineModel([*stages, model.fit(even)])
    finally:
        even.unpersist()


def _scaled_assembler(params: dict) -> list:
    """Assemble and standardise with population statistics, as saveable pipeline stages."""
    names = params["feature_columns"]
    terms = ", ".join(
        f"(`{c}` - {m!r}D) / {s!r}D AS `_z_{i}`"
        for i, (c, m, s) in enumerate(zip(names, params["mean"], params["std"]))
    )
    return [
        SQLTransformer(statement=f"SELECT *, {terms} FROM __THIS__"),
        VectorAssembler(inputCols=[f"_z_{i}" for i in range(len(names))], outputCol="features"),
    ]


def fit_logreg(train: DataFrame, feature_columns: Sequence[str], spec: ModelSpec = ModelSpec()) -> PipelineModel:
    """Standardised, class-balanced logistic regression with L2 strength 1 on the summed loss."""
    params = scaler_params(fit_scaler(train, feature_columns))
    n = train.count()
    model = LogisticRegression(
        featuresCol="features", labelCol="label", weightCol=WEIGHT, maxIter=spec.logreg_max_iter,
        regParam=1.0 / n, elasticNetParam=0.0, standardization=False)
    return _fit_on_even_parts(train, _scaled_assembler(params), model, len(feature_columns))


def _varying(train: DataFrame, feature_columns: Sequence[str]) -> list[int]:
    """Places of the features that hold more than one value; the first feature if none does."""
    first = train.select(*[F.col(c).cast("double") for c in feature_columns]).first()
    if first is None:
        return list(range(len(feature_columns)))
    given = np.array(first, dtype=float)  # a missing value is NaN

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = list(range(len(given)))
        for batch in batches:
            columns = {i: batch.column(i).to_numpy(zero_copy_only=False) for i in left}
            left = [i for i, x in columns.items() if not ((x == x).any() if np.isnan(given[i]) else (x != given[i]).any())]
        yield pa.RecordBatch.from_arrays([pa.array(sorted({*range(len(given))} - {*left}), pa.int32())], names=["place"])

    values = train.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(feature_columns)])
    return sorted(r["place"] for r in values.mapInArrow(look, "place int").distinct().collect()) or [0]  # a row per feature


def fit_gbt(train: DataFrame, feature_columns: Sequence[str], spec: ModelSpec = ModelSpec()) -> PipelineModel:
    """Class-balanced boosted trees. Features that are constant over the train rows can't part them and are left out of the passes."""
    model = GBTClassifier(
        featuresCol="features", labelCol="label", weightCol=WEIGHT, maxIter=spec.gbt_trees, stepSize=spec.gbt_step,
        maxDepth=spec.gbt_depth, seed=spec.seed)
    places = _varying(train, feature_columns)
    stages = [VectorAssembler(inputCols=list(feature_columns), outputCol="all_features"),
              VectorSlicer(inputCol="all_features", outputCol="features", indices=places)]
    return _fit_on_even_parts(train, stages, model, len(places))


FITTERS = {"logreg": fit_logreg, "gbt": fit_gbt}


def predict_proba(model: PipelineModel, df: DataFrame, name: str = "y_proba") -> DataFrame:
    """Add the positive-class probability; keys and targets stay on the row."""
    scored = model.transform(df).withColumn(name, vector_to_array("probability")[1])
    return scored.select(*df.columns, name)


def predict_by_model(models: dict[str, PipelineModel], df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``model``, the columns ``keep`` and ``y_proba``: a row for each row of ``df`` and model, from one pass over ``df``."""
    names = {c: f"_p_{i}" for i, c in enumerate(models)}
    for c, name in names.items():
        df = predict_proba(models[c], df, name)
    each = F.array(*[F.struct(F.lit(c).alias("model"), F.col(name).alias("y_proba")) for c, name in names.items()])
    return df.select(*keep, F.inline(each)).select("model", *keep, "y_proba")


def top_feature_importance(model: PipelineModel, feature_columns: Sequence[str], spark, top: int = 20) -> DataFrame:
    """Largest gain-based importances of a tree model."""
    weights = dict(zip(model.stages[-2].getIndices(), model.stages[-1].featureImportances.toArray()))  # none for constant features
    rows = [(c, float(weights.get(i, 0.0))) for i, c in enumerate(feature_columns)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature").limit(top)


def window_features(windows: DataFrame, window_length: int, n_features: int) -> DataFrame:
    """Flattened window as one vector of L*F doubles."""
    flat = F.transform(F.flatten("window"), lambda v: v.cast("double"))
    return windows.withColumn("features", array_to_vector(flat)).drop("window")


def fit_window_classifier(windows: DataFrame, window_length: int, n_features: int,
                          spec: ModelSpec = ModelSpec()) -> PipelineModel:
    """One-hidden-layer network on flattened scaled windows."""
    model = MultilayerPerceptronClassifier(
        featuresCol="features", labelCol="label", layers=[window_length * n_features, spec.mlp_hidden, 2],
        maxIter=spec.mlp_epochs, seed=spec.seed)
    return Pipeline(stages=[model]).fit(window_features(windows, window_length, n_features))


def fit_window_classifier_by_epochs(train: DataFrame, val: DataFrame, window_length: int, n_features: int,
                                    spec: ModelSpec = ModelSpec()) -> tuple[PipelineModel, DataFrame]:
    """The network trained epoch by epoch, and its history ``epoch, val_loss, val_pr_auc``.

    An epoch takes ``mlp_steps`` optimiser steps from the weights of the one before. After each, the val windows are scored;
    training stops after ``mlp_patience`` epochs that improve on neither PR-AUC nor, at the same PR-AUC, loss, and the weights of
    the best epoch are returned. This is the rule of `early_stop_best_epoch`. Both sets of windows are flattened once; those of train are
    dealt into even parts."""
    keys = [c for c in ("engine_id", "pred_cycle") if c in train.columns]
    flat = window_features(train.select(*keys, "label", "window"), window_length, n_features)
    even = _in_even_parts(flat, keys, train.count(), window_length * n_features)
    try:
        return _fit_epochs(even, written(window_features(val.select("label", "window"), window_length, n_features), "window-vectors"),
                           window_length, n_features, spec)
    finally:
        even.unpersist()


def _fit_epochs(train: DataFrame, val: DataFrame, window_length: int, n_features: int, spec: ModelSpec) -> tuple[PipelineModel, DataFrame]:
    """The epochs of `fit_window_classifier_by_epochs` over flattened windows."""
    weights, best, history = None, None, []
    for epoch in range(1, spec.mlp_epochs + 1):
        network = MultilayerPerceptronClassifier(
            featuresCol="features", labelCol="label", layers=[window_length * n_features, spec.mlp_hidden, 2],
            maxIter=spec.mlp_steps, seed=spec.seed)
        model = (network if weights is None else network.setInitialWeights(weights)).fit(train)
        weights = model.weights
        scored = _with_logit(predict_proba(model, val))
        counted = score_counts(scored, loss=F.sum(logit_loss(F.col("logit"), F.col("label"))))
        loss = counted.agg(F.sum("loss") / F.sum("n")).first()[0]
        area = ranking_of(counted).first()["pr_auc"]
        history.append((epoch, loss, area))
        if best is None or (area, -loss) > best[0]:
            best = (area, -loss), epoch, model
        if epoch - best[1] >= spec.mlp_patience:
            break
    return PipelineModel([best[2]]), train.sparkSession.createDataFrame(history, "epoch int, val_loss double, val_pr_auc double")


def _with_logit(scored: DataFrame) -> DataFrame:
    p = F.least(F.greatest(F.col("y_proba"), F.lit(1e-15)), F.lit(1 - 1e-15))
    return scored.withColumn("logit", F.log(p / (1 - p)))


def predict_window_proba(model: PipelineModel, windows: DataFrame, window_length: int, n_features: int) -> DataFrame:
    """``y_proba`` and its ``logit`` per window."""
    flat = window_features(windows, window_length, n_features)
    return _with_logit(predict_proba(model, flat).drop("features"))
