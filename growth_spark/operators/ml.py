"""Bagged regressions and a principal-component step, by Spark's own estimators."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .stats import clip_unit


def vectors(df: DataFrame, features: list[str], components: int | None = None) -> DataFrame:
    """``df`` with ``vector`` of its features (nulls as 0), reduced to its principal components if asked."""
    rows = VectorAssembler(inputCols=features, outputCol="_all" if components else "vector").transform(df.fillna(0, features))
    return PCA(k=components, inputCol="_all", outputCol="vector").fit(rows).transform(rows).drop("_all") if components else rows


def bagged_logistic(df: DataFrame, label: str, bags: int = 5, seed: int = 0) -> tuple[np.ndarray, float]:
    """Mean coefficients and intercept of logistic regressions on bootstrap samples of rows with ``vector``.

    Samples of one class are drawn again; rows of one class alone are an error.
    """
    if df.select(label).distinct().count() < 2:
        raise ValueError(f"{label} has rows of one class only")
    models: list = []
    while len(models) < bags:
        drawn = df.sample(True, 1.0, seed)
        seed += 1
        if drawn.select(label).distinct().count() == 2:
            models.append(LogisticRegression(featuresCol="vector", labelCol=label, regParam=0.01).fit(drawn))
    return np.mean([m.coefficients.toArray() for m in models], axis=0), float(np.mean([m.intercept for m in models]))


def bagged_linear(df: DataFrame, label: str, bags: int = 5, seed: int = 0) -> tuple[np.ndarray, float]:
    models = [LinearRegression(featuresCol="vector", labelCol=label, regParam=0.01).fit(df.sample(True, 1.0, seed + i)) for i in range(bags)]
    return np.mean([m.coefficients.toArray() for m in models], axis=0), float(np.mean([m.intercept for m in models]))


def folds(df: DataFrame, key: str, n: int) -> DataFrame:
    """A fold number below ``n`` for each row: one row a fold where there are no more rows than ``n``, else by a hash of the key."""
    if df.limit(n + 1).count() <= n:
        return df.withColumn("fold", F.row_number().over(Window.orderBy(F.xxhash64(key), key)).cast("bigint") - 1)
    return df.withColumn("fold", F.pmod(F.xxhash64(key), F.lit(n)))


def held_out_logistic(df: DataFrame, features: list[str], label: str, key: str, n: int, bags: int = 5, seed: int = 0) -> DataFrame:
    """``df`` with ``fold`` and the ``prediction`` of the bagged models that were fitted without the row's fold."""
    rows = vectors(folds(df, key, n), features).persist()
    fitted = []
    for k in sorted(r[0] for r in rows.select("fold").distinct().collect()):
        coefficients, intercept = bagged_logistic(rows.filter(F.col("fold") != k), label, bags, seed)
        fitted.append((k, coefficients.tolist(), intercept))
    models = df.sparkSession.createDataFrame(fitted, "fold bigint, _weights array<double>, _intercept double")
    total = F.col("_intercept")
    for i, f in enumerate(features):
        total = total + F.coalesce(F.col(f).cast("double"), F.lit(0.0)) * F.col("_weights")[i]
    scored = rows.join(F.broadcast(models), "fold").withColumn("prediction", 1 / (1 + F.exp(-total)))
    return scored.drop("vector", "_weights", "_intercept")


def applied(df: DataFrame, features: list[str], coefficients: np.ndarray, intercept: float, logistic: bool = False) -> DataFrame:
    """``df`` with ``prediction`` of averaged coefficients over plain columns: no model object is shipped."""
    total = F.lit(float(intercept))
    for f, c in zip(features, coefficients, strict=True):
        total = total + F.coalesce(F.col(f).cast("double"), F.lit(0.0)) * float(c)
    scored = df.withColumn("prediction", 1 / (1 + F.exp(-total)) if logistic else total)
    return scored if logistic else scored.withColumn("prediction", clip_unit("prediction"))
