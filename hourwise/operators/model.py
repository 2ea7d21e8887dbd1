"""Gradient-boosted forecasts with Spark ML (M3-M6).

Training runs as Spark jobs over the executors; only metrics and feature importances (one value per feature) come back
to the driver.  Spark's trees reject NULL/NaN features: missing values are imputed with the training part's median, and
an indicator column beside each feature that has missing values in training says which were.  The series key is one
numeric feature, the series' past mean (``encoding``), so bins do not grow with the number of series.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialized
from . import encoding
from .clean import numeric_columns

# Columns that look ahead of the current row (non-causal); excluded from features unless asked.
NON_CAUSAL = ("LoadCentered3", "LoadCentered7", "LoadRolling3", "LoadTrailing1")


@dataclass
class Fitted:
    model: PipelineModel
    features: list[str]
    key: str | None = None
    best_iteration: int | None = None
    missing: list[str] = field(default_factory=list)  # features with an indicator
    means: encoding.KeyMeans | None = None

    @property
    def gbt(self) -> GBTRegressionModel:
        return self.model.stages[-1]

    @property
    def n_trees(self) -> int:
        return len(self.gbt.trees)


def feature_columns(df: DataFrame, target: str, exclude: Sequence[str] = (), *, allow_non_causal: bool = False) -> list[str]:
    ex = {target, *exclude}
    if not allow_non_causal:
        ex |= set(NON_CAUSAL)
    return [c for c in numeric_columns(df) if c not in ex]


def _cast_features(df: DataFrame, features: Sequence[str], missing: Sequence[str] = ()) -> DataFrame:
    out = df.withColumns({c: F.col(f"`{c}`").cast("double") for c in features})
    return out.withColumns({f"{c}__missing": F.col(f"`{c}`").isNull().cast("double") for c in missing})


def _missing(df: DataFrame, features: Sequence[str]) -> list[str]:
    """Features with a missing value in ``df``."""
    if not features:
        return []
    row = df.agg(*[F.max(F.col(f"`{c}`").isNull()).alias(f"m{i}") for i, c in enumerate(features)]).first()
    return [c for i, c in enumerate(features) if row[i]]


def _fit(train: DataFrame, valid: DataFrame | None, label: str, features: Sequence[str], key: str | None, ts: str, **gbt) -> Fitted:
    """Imputer, assembler and trees; ``valid`` rows only decide when boosting stops."""
    features = list(features)
    fitted = Fitted(None, features, key, missing=_missing(train, features))
    rows = _cast_features(train, features, fitted.missing)
    tested = _cast_features(valid, features, fitted.missing) if valid is not None else None
    inputs = list(features)
    if key:
        name = f"{key}__mean"
        fitted.means = encoding.key_means(rows, [key], label, name)
        rows = encoding.past_key_means(rows, [key], ts, label, name)
        tested = fitted.means.add(tested) if tested is not None else None
        inputs.append(name)
    imputer = Imputer(strategy="median", inputCols=inputs, outputCols=[f"{c}__imp" for c in inputs]).fit(rows)
    assembler = VectorAssembler(inputCols=[f"{c}__imp" for c in inputs] + [f"{c}__missing" for c in fitted.missing], outputCol="features", handleInvalid="keep")
    trees = GBTRegressor(featuresCol="features", labelCol=label, predictionCol="prediction", lossType="squared", maxBins=32, **gbt)
    if tested is not None:
        rows = rows.withColumn("__valid", F.lit(False)).unionByName(tested.withColumn("__valid", F.lit(True)), allowMissingColumns=True)
        trees.setValidationIndicatorCol("__valid")
    ready = assembler.transform(imputer.transform(rows)).select("features", F.col(f"`{label}`").cast("double").alias(label), *(["__valid"] if tested is not None else []))
    # boosting reads the rows in every round: the joins and the imputer run once
    model = trees.fit(materialized(ready.where(F.col(f"`{label}`").isNotNull()), "tree-rows"))
    fitted.model = PipelineModel(stages=[imputer, assembler, model])
    return fitted


def fit_gbt(train: DataFrame, label: str, features: Sequence[str], *, key: str | None = "series", ts: str = "Timestamp",
            max_iter: int = 100, max_depth: int = 4, step_size: float = 0.1, seed: int = 42) -> Fitted:
    """M3: boosted trees with squared loss."""
    return _fit(train, None, label, features, key, ts, maxIter=max_iter, maxDepth=max_depth, stepSize=step_size, seed=seed)


def fit_gbt_early_stop(train: DataFrame, valid: DataFrame, label: str, features: Sequence[str], *, key: str | None = "series",
                       ts: str = "Timestamp", max_iter: int = 200, max_depth: int = 6, step_size: float = 0.1, tol: float = 0.0,
                       seed: int = 42) -> Fitted:
    """M4: boosting stops inside training, in the first round that does not lower the error on ``valid`` by more than
    ``tol`` of it, and the rounds up to the best one are kept: no round is fitted twice and none after the stop."""
    fitted = _fit(train, valid, label, features, key, ts, maxIter=max_iter, maxDepth=max_depth, stepSize=step_size, seed=seed, validationTol=tol)
    fitted.best_iteration = fitted.n_trees
    return fitted


def predict(fitted: Fitted, df: DataFrame) -> DataFrame:
    """M5: add ``prediction``; helper columns of the pipeline are dropped."""
    rows = _cast_features(df, fitted.features, fitted.missing)
    if fitted.means is not None:
        rows = fitted.means.add(rows)
    out = fitted.model.transform(rows)
    helper = [c for c in out.columns if c.endswith(("__imp", "__missing", "__mean")) or c == "features"]
    return out.drop(*helper)


def importances(fitted: Fitted, spark) -> DataFrame:
    """M6: ``(feature, importance)`` from the fitted trees (normalised to sum 1), highest first; an indicator counts for
    its feature."""
    names = list(fitted.features) + ([fitted.key] if fitted.key else []) + fitted.missing
    vec = fitted.gbt.featureImportances.toArray().tolist()
    total = dict.fromkeys(names, 0.0)
    for n, v in zip(names, vec):
        total[n] += float(v)
    return spark.createDataFrame(list(total.items()), "feature string, importance double").orderBy(F.desc("importance"), "feature")


def top_importances(fitted: Fitted, spark, n: int = 10) -> DataFrame:
    """O2: the ``n`` most important features."""
    return importances(fitted, spark).limit(n)
