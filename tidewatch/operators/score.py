"""Scoring flows.

A scorer turns feature columns into a class-probability array ``proba``;
``apply_prediction`` then derives ``pred_label`` (argmax, lowest index on
ties), ``pred_confidence`` (max probability), ``prediction_binary`` (1 only
for the Normal class) and ``attack_type`` (decoded class name).

Three scorers:
* ``score_ml``      a fitted ``pyspark.ml`` classifier — JVM scoring, the default;
* ``score_linear``  a logistic model given by coefficients, as plain column
                    arithmetic (JVM, codegen; used by the fixture queries);
* ``score_pandas``  a foreign ``predict_proba`` model through an iterator
                    pandas UDF that loads the model once per Python worker.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Tuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from tidewatch.functions.classes import argmax_index, binary_prediction, decode_class, max_probability


def apply_prediction(df: DataFrame, class_map: dict[int, str], proba_col: str = "proba",
                     drop_proba: bool = True) -> DataFrame:
    idx = argmax_index(proba_col)
    cols = [c for c in df.columns if not (drop_proba and c == proba_col)]
    return df.select(
        *cols,
        idx.alias("pred_label"),
        max_probability(proba_col).alias("pred_confidence"),
        binary_prediction(idx, class_map).alias("prediction_binary"),
        decode_class(idx, class_map).alias("attack_type"),
    )


def score_linear(df: DataFrame, weights: dict[str, float], intercept: float = 0.0,
                 centers: dict[str, float] | None = None) -> DataFrame:
    """Two-class logistic scorer: ``p1 = 1 / (1 + exp(-z))`` with
    ``z = intercept + sum(w_c * (x_c - center_c))``; ``proba = [1 - p1, p1]``."""
    centers = centers or {}
    z = F.lit(float(intercept))
    for c, w in weights.items():
        z = z + F.lit(float(w)) * (F.col(c) - F.lit(float(centers.get(c, 0.0))))
    p1 = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    return df.withColumn("proba", F.array(F.lit(1.0) - p1, p1))


def score_ml(df: DataFrame, model, feature_cols: list[str]) -> DataFrame:
    """Score with a fitted ``pyspark.ml`` model: a pipeline that assembles its
    own features, or a bare classifier (features assembled here, NULL/NaN
    kept, not dropped)."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    if isinstance(model, PipelineModel):
        scored = model.transform(df)
    else:
        va = VectorAssembler(inputCols=feature_cols, outputCol=model.getFeaturesCol(), handleInvalid="keep")
        scored = model.transform(va.transform(df))
    return scored.select(*df.columns, vector_to_array("probability").alias("proba"))


PRED_SCHEMA = T.StructType([T.StructField("pred_label", T.IntegerType()),
                            T.StructField("pred_confidence", T.DoubleType())])


def score_pandas(df: DataFrame, load_model: Callable[[], object], feature_cols: list[str],
                 class_map: dict[int, str]) -> DataFrame:
    """Score with a foreign model exposing ``predict_proba(DataFrame)``.

    N feature columns in, struct ``(pred_label, pred_confidence)`` out, as an
    iterator pandas UDF: ``load_model`` runs once per Python worker (not per
    batch), Arrow batches in and out, and argmax/max are numpy vector ops over
    the whole batch (``argmax`` takes the first maximum, so ties go to the
    lowest class index as in the JVM path).  Adds ``prediction_binary`` and
    ``attack_type`` like ``apply_prediction``."""

    @F.pandas_udf(PRED_SCHEMA)
    def _predict(batches: Iterator[Tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        scorer = None
        for batch in batches:
            features = batch if isinstance(batch, tuple) else (batch,)
            matrix = np.column_stack([pd.to_numeric(f, errors="coerce").to_numpy(np.float64) for f in features])
            if scorer is None:
                scorer = load_model()
            known = ~np.isnan(matrix).any(axis=1)  # a row with a missing feature gets no prediction
            label, best = np.zeros(len(matrix), np.int32), np.full(len(matrix), np.nan)
            if known.any():
                scores = np.asarray(scorer.predict_proba(pd.DataFrame(matrix[known], columns=feature_cols)))
                if scores.ndim != 2 or len(scores) != known.sum() or scores.shape[1] < 2:
                    raise ValueError(f"predict_proba gave shape {scores.shape} for {known.sum()} rows")
                label[known] = np.argmax(scores, axis=1)
                best[known] = scores[np.arange(len(scores)), label[known]]
            yield pd.DataFrame({"pred_label": pd.arrays.IntegerArray(label, ~known),
                                "pred_confidence": pd.arrays.FloatingArray(best, ~known)})

    pred = _predict(*[F.col(c) for c in feature_cols])
    out = df.withColumn("_pred", pred)
    idx = F.col("_pred.pred_label")
    return out.select(*df.columns, idx.alias("pred_label"),
                      F.col("_pred.pred_confidence").alias("pred_confidence"),
                      binary_prediction(idx, class_map).alias("prediction_binary"),
                      decode_class(idx, class_map).alias("attack_type"))
