"""Demand models with ``pyspark.ml``.

The reference tunes scikit-learn / LightGBM models on one machine. Here models
are fitted by Spark ML estimators (training is distributed, the data never
leaves the cluster), and the elastic-net searches run on fold-wise Gram
matrices (``grams``). Only fitted parameters and metrics reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsense.operators.quality import regression_metrics

# The reference's search spaces.
EN_ALPHAS = [float(x) for x in np.logspace(math.log10(1e-3), math.log10(10.0), num=5)]
EN_L1_RATIOS = [0.1, 0.5, 1.0]
EN_MAX_ITER = [10000, 50000]
EN_TOL = [1e-5, 1e-3]
RANDOM_SEARCH_CALLS = 50
SEED = 42
FOLDS = 5

LABEL = "quantity"
FEATURES = "features"


def depth_for_leaves(num_leaves: int) -> int:
    """Spark trees are depth-bounded: the depth whose full tree holds the leaves."""
    return max(1, math.ceil(math.log2(num_leaves)))


def assembler(input_cols: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(input_cols), outputCol=FEATURES, handleInvalid="keep")


def label_std(rows: DataFrame) -> float:
    """Standard deviation of the label, for :func:`elastic_net`."""
    return float(rows.agg(F.stddev_samp(LABEL).alias("s")).first()["s"] or 1.0)


def elastic_net(reg: float = 0.01, l1_ratio: float = 0.5, max_iter: int = 10000, tol: float = 1e-5, std: float = 1.0) -> LinearRegression:
    """sklearn's ElasticNet objective with (alpha, l1_ratio) = (``reg``,
    ``l1_ratio``). Spark fits the label divided by its standard deviation
    ``std``, which leaves its L1 term as it is and divides its L2 term by
    ``std``; (regParam, elasticNetParam) are chosen so that both agree."""
    l1, l2 = reg * l1_ratio, reg * (1 - l1_ratio) * std
    return LinearRegression(
        featuresCol=FEATURES, labelCol=LABEL, predictionCol="y_pred", regParam=l1 + l2, elasticNetParam=l1 / (l1 + l2) if l1 + l2 else 0.0,
        maxIter=max_iter, tol=tol, standardization=False, fitIntercept=True,
    )


def boosted_trees(
    step: float = 0.05, max_depth: int = 5, subsample: float = 0.8, colsample: str = "all", max_iter: int = 50,
    validation_col: str | None = "is_val",
) -> GBTRegressor:
    """Gradient-boosted trees; with ``validation_col`` training stops when
    the validation error stops improving (early stopping)."""
    kw = dict(
        featuresCol=FEATURES, labelCol=LABEL, predictionCol="y_pred", stepSize=step, maxDepth=max_depth,
        subsamplingRate=subsample, featureSubsetStrategy=colsample, maxIter=max_iter, seed=SEED,
    )
    if validation_col:
        kw["validationIndicatorCol"] = validation_col
    return GBTRegressor(**kw)


def elastic_net_grid() -> list[dict]:
    """The whole elastic-net grid, alpha x l1_ratio x max_iter x tol (the
    reference's 120 combinations less its two solver-only options)."""
    return [
        {"alpha": a, "l1_ratio": r, "max_iter": m, "tol": t}
        for a in EN_ALPHAS for r in EN_L1_RATIOS for m in EN_MAX_ITER for t in EN_TOL
    ]


def random_param_maps(n: int = RANDOM_SEARCH_CALLS, seed: int = SEED) -> list[dict]:
    """J8 [re-aimed]: ``n`` parameter maps drawn from the reference's ranges
    (alpha log-uniform 1e-4..10, l1_ratio uniform 0.01..1, max_iter integer
    10000..50000, tol log-uniform 1e-6..1e-2)."""
    rng = np.random.default_rng(seed)
    return [
        {
            "alpha": float(10 ** rng.uniform(-4, 1)),
            "l1_ratio": float(rng.uniform(0.01, 1.0)),
            "max_iter": int(rng.integers(10000, 50001)),
            "tol": float(10 ** rng.uniform(-6, -2)),
        }
        for _ in range(n)
    ]


def estimator_of(params: dict, std: float) -> LinearRegression:
    """The Spark estimator of a parameter map of a search."""
    return elastic_net(params["alpha"], params["l1_ratio"], params["max_iter"], params["tol"], std)


def rmsle(pred: DataFrame) -> float:
    """RMSLE of predicted rows."""
    return regression_metrics(pred.select(F.col(LABEL).alias("y_true"), "y_pred")).first()["rmsle"]


def validation_rmsle(model, val: DataFrame) -> float:
    """RMSLE of a fitted model on validation rows."""
    return rmsle(model.transform(val))


def select_best_refit(candidates: dict, train: DataFrame, val: DataFrame, train_val: DataFrame):
    """The candidate with the lowest validation RMSLE wins and is refit on
    train + val. ``candidates`` maps a name to an unfitted Pipeline."""
    scores = {}
    for name, pipe in candidates.items():
        scores[name] = validation_rmsle(pipe.fit(train), val)
    best = min(scores, key=lambda k: (scores[k] if scores[k] is not None else float("inf")))
    return best, scores, candidates[best].fit(train_val)


def pipeline(input_cols: Sequence[str], estimator) -> Pipeline:
    return Pipeline(stages=[assembler(input_cols), estimator])


def save_pipeline(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def batch_inference(model: PipelineModel, df: DataFrame, keys: Sequence[str], sensitive: str = "is_registered") -> DataFrame:
    """Prediction, truth and the sensitive flag of every row (all rows,
    same-row truth: trap K11; the flag itself, not an encoded digit: K12)."""
    out = model.transform(df)
    return out.select(*keys, F.col(LABEL).alias("y_true"), "y_pred", sensitive)


def warm_refresh(saved_path: str, refreshed: DataFrame) -> PipelineModel:
    """Reload a stored pipeline and fit it again with the same settings
    on refreshed data (Spark ML has no warm start)."""
    stored = PipelineModel.load(saved_path)
    stages = []
    for st in stored.stages:
        if isinstance(st, VectorAssembler):
            stages.append(st)
        else:
            est = {"LinearRegressionModel": LinearRegression, "GBTRegressionModel": GBTRegressor}[type(st).__name__]()
            est = est.copy(st.extractParamMap()) if hasattr(st, "extractParamMap") else est
            for p, v in st.extractParamMap().items():
                if est.hasParam(p.name):
                    est._set(**{p.name: v})
            stages.append(est)
    return Pipeline(stages=stages).fit(refreshed)
