"""Drift statistics and encoders against brute-force NumPy versions."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tillsense.operators import drift as DR
from tillsense.operators import encoding as EN


def _ks(a, b):
    v = np.sort(np.unique(np.concatenate([a, b])))
    fa = np.searchsorted(np.sort(a), v, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), v, side="right") / len(b)
    return np.max(np.abs(fa - fb)), v, fa, fb


def test_ks_and_wasserstein(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(0, 1, 400).round(3), rng.normal(0.3, 1.2, 300).round(3)
    ref = spark.createDataFrame(pd.DataFrame({"stockcode": "p", "x": a}))
    cur = spark.createDataFrame(pd.DataFrame({"stockcode": "p", "x": b}))
    ks = DR.drift_numeric_ks(ref, cur, ["x"]).first()
    d, v, fa, fb = _ks(a, b)
    assert np.isclose(ks.ks_stat, d)
    w = DR.drift_numeric_wasserstein(ref, cur, ["x"]).first()
    w1 = np.sum(np.abs(fa - fb)[:-1] * np.diff(v))
    assert np.isclose(w.w1, w1)
    assert np.isclose(w.w1_norm, w1 / max(np.std(a), 0.001))


def test_jensen_shannon(spark):
    ref = spark.createDataFrame([("p", c) for c in "aaabbc"], "stockcode string, c string")
    cur = spark.createDataFrame([("p", c) for c in "abbbbd"], "stockcode string, c string")
    got = DR.drift_categorical_js(ref, cur, ["c"]).first().js_distance
    p = np.array([3, 2, 1, 0]) / 6
    q = np.array([1, 4, 0, 1]) / 6
    m = (p + q) / 2
    kl = lambda x: np.sum(np.where(x > 0, x * np.log(np.where(x > 0, x, 1) / m), 0))
    assert np.isclose(got, np.sqrt((kl(p) + kl(q)) / 2))


def test_binary_encoder_rules(spark):
    assert [EN.n_digits(n) for n in (1, 2, 3, 4, 5, 8, 9)] == [1, 2, 3, 3, 4, 4, 5]
    train = spark.createDataFrame([(1, "z", 1.0), (2, "y", None), (3, "z", 10.0), (4, "x", 20.0), (5, "w", 2.0)], "row_id long, c string, v double")
    m = EN.fit_column_transform(train, ["v"], ["c"], order_col="row_id")
    # median of 1, 2, 10, 20 is 6 (interpolated), population std of the imputed column
    assert np.isclose(m.medians["v"], 6.0)
    imputed = np.array([1.0, 6.0, 10.0, 20.0, 2.0])
    assert np.isclose(m.stds["v"], imputed.std()) and np.isclose(m.means["v"], imputed.mean())
    test = spark.createDataFrame([(9, "y", 10.0), (10, "unseen", None)], "row_id long, c string, v double")
    out = {r.row_id: r for r in EN.transform(test, m, keep=["row_id"]).collect()}
    # categories by first appearance: z=1, y=2, x=3, w=4 -> 4 categories, 3 digits
    assert m.digits["c"] == 3
    assert [out[9][f"cat__c_{k}"] for k in range(3)] == [0.0, 1.0, 0.0]
    assert [out[10][f"cat__c_{k}"] for k in range(3)] == [0.0, 0.0, 0.0]
    assert np.isclose(out[10]["num__v"], (6.0 - imputed.mean()) / imputed.std())


def _categories(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_id long, a string, b string").repartition(3)


def test_a_second_fit_keeps_old_ordinals(spark, tmp_path):
    path = str(tmp_path / "dictionary")
    first = _categories(spark, [("x", "1"), ("y", None), ("x", "2")])
    second = _categories(spark, [("z", "2"), ("y", "3"), ("w", "1"), ("z", "0")])
    read = lambda d: {(r["column_name"], r["category"]): r["ordinal"] for r in d.collect()}
    old = read(EN.extend_dictionary(first, ["a", "b"], path, "v1"))
    assert old == {("a", "x"): 1, ("a", "y"): 2, ("b", "1"): 1, ("b", "2"): 2}
    new = old | {("a", "z"): 3, ("a", "w"): 4, ("b", "3"): 3, ("b", "0"): 4}
    assert read(EN.extend_dictionary(second, ["a", "b"], path, "v2")) == new
    assert read(EN.extend_dictionary(second, ["a", "b"], path, "v2")) == new  # a retry
    m = EN.with_dictionary(EN.ColumnTransformModel([], ["a", "b"]), spark.read.parquet(path))
    assert m.digits == {"a": 3, "b": 3}
    got = {r["row_id"]: "".join(str(int(r[f"cat__a_{k}"])) for k in range(3)) for r in EN.transform(second, m, ["row_id"]).collect()}
    assert got == {0: "011", 1: "010", 2: "100", 3: "011"}


def test_columns_with_few_categories_are_mapped_without_a_join(spark):
    few = [f"é{i % 5}" if i % 7 else None for i in range(400)]
    many = [f"m{i}" if i % 3 else None for i in range(400)]
    df = _categories(spark, list(zip(few, many, strict=True)))
    m = EN.fit_column_transform(df, [], ["a", "b"])
    assert set(m.small) == {"a"}
    mapped = EN.transform(df, m, ["row_id"])
    m.small = {}
    joined = EN.transform(df, m, ["row_id"])
    assert mapped.exceptAll(joined).count() == 0 and mapped.count() == joined.count() == 400
    m = EN.fit_column_transform(df, [], ["a"])
    assert "Join" not in EN.transform(df, m, ["row_id"])._jdf.queryExecution().executedPlan().toString()


def test_first_nonfinite_cells_of_all_columns(spark):
    from tillsense.operators import quality as QU

    nan, inf = float("nan"), float("inf")
    rows = [(i, 1.0, 2.0, 0.0) for i in range(50)]
    rows[30], rows[7], rows[9], rows[40] = (30, nan, 2.0, inf), (7, 1.0, -inf, nan), (9, 1.0, 2.0, nan), (40, nan, nan, nan)
    df = spark.createDataFrame(rows, "row_id long, num__x double, num__y double, cat__c_0 double").repartition(4)
    got = [tuple(r) for r in QU.nonfinite_positions(df, ["num__x", "num__y", "cat__c_0"]).collect()]
    assert got == [(7, 1, "num__y"), (7, 2, "cat__c_0"), (9, 2, "cat__c_0"), (30, 0, "num__x"), (30, 2, "cat__c_0")]
    assert QU.nonfinite_positions(df.where("row_id < 5"), ["num__x"]).collect() == []
