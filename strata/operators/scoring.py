"""Model training and batch scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def risk_pipeline(categorical: list[str], numeric: list[str], label: str, max_bins: int = 52,
                  max_iter: int = 20, max_depth: int = 5) -> Pipeline:
    """Gradient-boosted trees over indexed categories and imputed numbers."""
    indexed = [f"{c}_idx" for c in categorical]
    stages = [
        StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep"),
        Imputer(inputCols=numeric, outputCols=numeric),
        VectorAssembler(inputCols=indexed + numeric, outputCol="features"),
        StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc"),
        GBTClassifier(lossType="logistic", maxBins=max_bins, maxIter=max_iter, maxDepth=max_depth, seed=7),
    ]
    return Pipeline(stages=stages)


def register_scorer(spark: SparkSession, name: str, predict: Callable[[pd.DataFrame], pd.Series],
                    return_type: str, model: object | None = None):
    """Make a model callable from SQL and DataFrames on a struct of its feature columns.

    `predict` gets one Arrow batch as a DataFrame; with `model`, it gets the model as
    second argument, shipped to every executor once as a broadcast.
    """
    shared = spark.sparkContext.broadcast(model) if model is not None else None

    @F.pandas_udf(return_type)
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            yield predict(batch) if shared is None else predict(batch, shared.value)

    return spark.udf.register(name, score)
