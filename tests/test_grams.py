"""Elastic-net fits from Gram matrices against Spark's own estimator."""

import numpy as np

from tillsense.operators import grams as GR
from tillsense.operators import models as MD


def test_gram_fit_equals_spark_linear_regression(spark):
    r = np.random.default_rng(3)
    x = r.standard_normal((400, 4))
    x[:, 3] = x[:, 0] + 0.1 * r.standard_normal(400)
    y = 1.5 + x @ np.array([2.0, -1.0, 0.0, 0.5]) + 0.3 * r.standard_normal(400)
    rows = [(i, *map(float, x[i]), float(y[i])) for i in range(400)]
    df = spark.createDataFrame(rows, "row_id long, a double, b double, c double, d double, quantity double").repartition(5)
    grams = GR.fold_grams(df, list("abcd"), "quantity", GR.fold_of("row_id", 5, 42), 5)
    z = np.column_stack([np.ones(400), x, y])
    assert np.allclose(grams.sum(axis=0), z.T @ z)
    for alpha, l1 in ((0.01, 0.5), (0.3, 1.0), (0.1, 0.1)):
        fit = GR.fit_elastic_net(grams.sum(axis=0), alpha, l1, 10000, 1e-5)
        model = MD.pipeline(list("abcd"), MD.elastic_net(alpha, l1, 10000, 1e-9, MD.label_std(df))).fit(df).stages[-1]
        assert fit.optimal
        assert np.allclose(fit.weights, model.coefficients.toArray(), atol=1e-3) and abs(fit.intercept - model.intercept) < 1e-3
        assert np.isclose(GR.mse(grams.sum(axis=0), fit.residual), ((y - fit.intercept - x @ fit.weights) ** 2).mean())


def test_search_marks_the_best_map_and_uses_every_fold():
    r = np.random.default_rng(5)
    z = np.column_stack([np.ones(500), r.standard_normal((500, 3))])
    z = np.column_stack([z, z @ np.array([1.0, 2.0, 0.0, -1.0]) + 0.1 * r.standard_normal(500)])
    fold = np.arange(500) % 5
    grams = np.stack([z[fold == k].T @ z[fold == k] for k in range(5)])
    rows = GR.search(grams, MD.elastic_net_grid())
    assert len(rows) == 60 and sum(x["is_best"] for x in rows) == 1 and all(x["optimal"] for x in rows)
    best = next(x for x in rows if x["is_best"])
    assert best["alpha"] == min(MD.EN_ALPHAS) and best["mean_mse"] < 0.02 < best["plain_mse"]


def linear_rows(spark, n, seed):
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, 5))
    y = 2 + x @ np.array([1.0, -2.0, 0.0, 0.3, 0.0]) + 0.5 * r.standard_normal(n)
    return spark.createDataFrame([(i, *map(float, x[i]), float(y[i])) for i in range(n)], "row_id long, a double, b double, c double, d double, e double, quantity double").repartition(4)


def test_refreshed_model_equals_a_fit_on_all_rows(spark, tmp_path):
    old, new = linear_rows(spark, 600, 1), linear_rows(spark, 200, 2)
    params = {"alpha": 0.05, "l1_ratio": 0.5, "max_iter": 10000, "tol": 1e-9}
    first = GR.fit_gram_model(old, list("abcde"), "quantity", params)
    path = GR.save_gram_model(first, spark, str(tmp_path / "model"))
    loaded = GR.load_gram_model(spark, path)
    assert loaded.columns == first.columns and loaded.params == params and loaded.n_rows == 600
    assert (loaded.gram == first.gram).all() and (loaded.fit.weights == first.fit.weights).all()
    again = GR.refreshed(loaded, new)
    whole = GR.fit_gram_model(old.unionByName(new), list("abcde"), "quantity", params)
    assert again.n_rows == whole.n_rows == 800 and again.fit.optimal
    assert np.allclose(again.fit.weights, whole.fit.weights, atol=1e-7) and np.isclose(again.fit.intercept, whole.fit.intercept)
    assert again.fit.sweeps <= whole.fit.sweeps
    assert not np.allclose(again.fit.weights, first.fit.weights, atol=1e-4)


def test_refresh_reads_new_rows_only(spark, tmp_path):
    old = linear_rows(spark, 300, 3)
    old.write.parquet(str(tmp_path / "old"))
    params = {"alpha": 0.01, "l1_ratio": 0.5, "max_iter": 1000, "tol": 1e-6}
    GR.save_gram_model(GR.fit_gram_model(spark.read.parquet(str(tmp_path / "old")), list("abcde"), "quantity", params), spark, str(tmp_path / "model"))
    for f in (tmp_path / "old").iterdir():
        f.unlink()  # the old rows are gone
    model = GR.refreshed(GR.load_gram_model(spark, str(tmp_path / "model")), linear_rows(spark, 50, 4))
    assert model.n_rows == 350 and model.fit.optimal


def test_gram_predictions_are_linear(spark):
    df = linear_rows(spark, 100, 5)
    model = GR.fit_gram_model(df, list("abcde"), "quantity", {"alpha": 0.01, "l1_ratio": 0.5, "max_iter": 1000, "tol": 1e-6})
    for r in GR.predict_gram_model(model, df).collect():
        assert np.isclose(r["y_pred"], model.fit.intercept + model.fit.weights @ np.array([r[c] for c in "abcde"]))
