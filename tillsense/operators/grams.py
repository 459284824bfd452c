"""Elastic-net searches and refits over Gram matrices.

Squared loss depends on the data only through the sums of products of the
columns. One pass over the training rows gives one such matrix per fold
(``(columns + 2)^2`` numbers, whatever the number of rows), and then every
parameter map of a search is fitted and validated on every fold from the
matrices alone: the data is read once, not once per map and fold.

Such a matrix can be added to: a stored model keeps the one of its rows, and a
refit adds that of the new rows and starts at the stored weights. The old rows
are not read again, and the refit has the optimum of a fit on all rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPREAD = 32  # partial sums per fold that are added up before the last sum


def fold_of(row_id: str, folds: int, seed: int) -> Column:
    """Fold of a row by a seeded arithmetic hash of its id (the same in SQL)."""
    return F.pmod(F.pmod(F.col(row_id) * F.lit(2654435761) + F.lit(seed), F.lit(2147483647)), F.lit(folds)).cast("int")


def fold_grams(rows: DataFrame, columns: Sequence[str], label: str, fold: Column, folds: int) -> np.ndarray:
    """grams[fold] = sum over the fold's rows of z zT with z = (1, columns, label)."""
    names = [*columns, label]
    width = len(names) + 1

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((folds, width, width))
        for pdf in batches:
            z = np.column_stack([np.ones(len(pdf)), pdf[names].to_numpy(dtype=np.float64)])
            f = pdf["_fold"].to_numpy()
            for k in range(folds):
                total[k] += z[f == k].T @ z[f == k]
        part = int(np.abs(total).sum()) % SPREAD
        yield pd.DataFrame({"fold": range(folds), "part": part, "gram": [g.tobytes() for g in total]})

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width * width)
        for b in pdf["gram"]:
            total += np.frombuffer(b)
        return pd.DataFrame({"fold": pdf["fold"].iloc[:1], "part": 0, "gram": [total.tobytes()]})

    schema = "fold int, part int, gram binary"
    parts = rows.select(fold.alias("_fold"), *[F.col(c).cast("double") for c in names]).mapInPandas(partial, schema)
    once = parts.groupBy("fold", "part").applyInPandas(added, schema)
    out = np.zeros((folds, width, width))
    for r in once.groupBy("fold").applyInPandas(added, schema).collect():
        out[r["fold"]] = np.frombuffer(r["gram"]).reshape(width, width)
    return out


@dataclass(frozen=True)
class Fit:
    intercept: float
    weights: np.ndarray
    optimal: bool
    sweeps: int = 0

    @property
    def residual(self) -> np.ndarray:
        """r with (row's residual) = r . (1, columns, label)."""
        return np.concatenate([[-self.intercept], -self.weights, [1.0]])


def fit_elastic_net(gram: np.ndarray, alpha: float, l1_ratio: float, max_iter: int, tol: float, start: np.ndarray | None = None) -> Fit:
    """Coordinate descent for 1/(2n) |y - Xw - b|^2 + alpha*l1*|w|_1 + alpha*(1-l1)/2*|w|_2^2
    from a Gram matrix, from the weights ``start`` (none: 0) on; ``optimal`` tells
    whether the subgradient conditions hold (to the tolerance) at the end, and
    ``sweeps`` how often all weights were visited."""
    n = gram[0, 0]
    mean = gram[0, 1:] / n
    cov = gram[1:, 1:] / n - np.outer(mean, mean)
    a, b = cov[:-1, :-1], cov[:-1, -1]
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio)
    w = np.zeros(len(b)) if start is None else np.array(start, dtype=np.float64)
    grad = b - a @ w
    sweeps = 0
    for sweeps in range(1, max_iter + 1):  # noqa: B007
        most = 0.0
        for j in range(len(w)):
            if a[j, j] <= 1e-12:
                continue
            rho = grad[j] + a[j, j] * w[j]
            new = np.sign(rho) * max(abs(rho) - l1, 0.0) / (a[j, j] + l2)
            step = new - w[j]
            if step:
                grad -= a[:, j] * step
                w[j] = new
                most = max(most, abs(step) * np.sqrt(a[j, j]))
        if most <= tol * np.sqrt(cov[-1, -1]) * 1e-2:
            break
    off = np.where(w != 0, np.abs(grad - l2 * w - l1 * np.sign(w)), np.maximum(np.abs(grad) - l1, 0.0))
    off[np.diag(a) <= 1e-12] = 0.0
    scale = np.sqrt(np.maximum(np.diag(a), 1e-12) * cov[-1, -1])
    return Fit(float(mean[-1] - mean[:-1] @ w), w, bool((off <= 10 * tol * scale).all()), sweeps)


def mse(gram: np.ndarray, residual: np.ndarray) -> float:
    return float(residual @ gram @ residual / gram[0, 0])


def cross_validate(grams: np.ndarray, params: dict) -> dict:
    """Mean over the folds of the validation MSE of a parameter map and of the
    mean predictor; each fold counts once (trap K19)."""
    total = grams.sum(axis=0)
    scores, plain, optimal = [], [], True
    for g in grams:
        if g[0, 0] == 0 or g[0, 0] == total[0, 0]:
            continue
        fit = fit_elastic_net(total - g, **params)
        mean = (total - g)[0, -1] / (total - g)[0, 0]
        scores.append(mse(g, fit.residual))
        plain.append(mse(g, np.concatenate([[-mean], np.zeros(len(fit.weights)), [1.0]])))
        optimal &= fit.optimal
    return {**params, "mean_mse": float(np.mean(scores)), "plain_mse": float(np.mean(plain)), "optimal": optimal}


def search(grams: np.ndarray, maps: Sequence[dict]) -> list[dict]:
    """Every parameter map through cross validation, with the best one marked."""
    rows = [{"param_index": i, **cross_validate(grams, m)} for i, m in enumerate(maps)]
    best = min(range(len(rows)), key=lambda i: rows[i]["mean_mse"])
    return [{**r, "is_best": i == best} for i, r in enumerate(rows)]


@dataclass(frozen=True)
class GramModel:
    """An elastic net with the Gram matrix it was fitted from."""

    columns: list[str]
    label: str
    gram: np.ndarray
    params: dict
    fit: Fit

    @property
    def n_rows(self) -> int:
        return int(self.gram[0, 0])


def _whole_gram(rows: DataFrame, columns: Sequence[str], label: str) -> np.ndarray:
    return fold_grams(rows, columns, label, F.lit(0), 1)[0]


def fit_gram_model(rows: DataFrame, columns: Sequence[str], label: str, params: dict) -> GramModel:
    """J4 from one pass: an elastic net with ``params`` (alpha, l1_ratio, max_iter, tol)."""
    gram = _whole_gram(rows, columns, label)
    return GramModel(list(columns), label, gram, dict(params), fit_elastic_net(gram, **params))


def refreshed(model: GramModel, new_rows: DataFrame) -> GramModel:
    """The model with ``new_rows`` added, refitted from its weights on. Only
    the new rows are read."""
    gram = model.gram + _whole_gram(new_rows, model.columns, model.label)
    return GramModel(model.columns, model.label, gram, model.params, fit_elastic_net(gram, **model.params, start=model.fit.weights))


def save_gram_model(model: GramModel, spark: SparkSession, path: str) -> str:
    """The model as a Parquet table of (part, i, name, value): a few thousand
    numbers, whatever the data."""
    rows = [("gram", i, None, float(v)) for i, v in enumerate(model.gram.ravel())]
    rows += [("weight", i, c, float(v)) for i, (c, v) in enumerate(zip(model.columns, model.fit.weights, strict=True))]
    rows += [("param", i, k, float(v)) for i, (k, v) in enumerate(model.params.items())]
    rows += [("intercept", 0, model.label, model.fit.intercept), ("optimal", 0, None, float(model.fit.optimal)), ("sweeps", 0, None, float(model.fit.sweeps))]
    spark.createDataFrame(rows, "part string, i int, name string, value double").coalesce(1).write.mode("overwrite").parquet(path)
    return path


def load_gram_model(spark: SparkSession, path: str) -> GramModel:
    table = spark.read.parquet(path).toPandas().sort_values(["part", "i"])
    part = {k: t for k, t in table.groupby("part")}
    width = len(part["weight"]) + 2
    params = dict(zip(part["param"]["name"], part["param"]["value"], strict=True))
    params["max_iter"] = int(params["max_iter"])
    one = lambda k: part[k].iloc[0]
    fit = Fit(float(one("intercept")["value"]), part["weight"]["value"].to_numpy(), bool(one("optimal")["value"]), int(one("sweeps")["value"]))
    return GramModel(part["weight"]["name"].tolist(), one("intercept")["name"], part["gram"]["value"].to_numpy().reshape(width, width), params, fit)


def predict_gram_model(model: GramModel, df: DataFrame, out: str = "y_pred") -> DataFrame:
    """``df`` with the model's prediction, in the JVM."""
    total = F.lit(model.fit.intercept)
    for c, w in zip(model.columns, model.fit.weights, strict=True):
        if w:
            total = total + F.col(c) * F.lit(float(w))
    return df.withColumn(out, total)
