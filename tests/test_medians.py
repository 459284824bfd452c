"""Medians of all columns from whole rows."""

import statistics

from tillsense.operators import encoding as EN
from tillsense.operators import ranking as RK


def test_medians_take_rows_apart_only_inside_the_brackets(spark, monkeypatch):
    nan = float("nan")
    rows = [(float(i * 7919 % 1000), None if i % 3 else float(i % 5), nan, nan if i % 2 else -float(i), i) for i in range(1000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e long")
    seen, total = [], RK.running_total
    monkeypatch.setattr(RK, "running_total", lambda rows, *a, **k: seen.append(rows.agg({"_c": "sum"}).first()[0]) or total(rows, *a, **k))
    got = {r.column_name: r.median for r in EN.fit_medians(df, ["a", "b", "c", "d", "e"]).collect()}
    want = {k: statistics.median(v for r in rows if (v := r["abcde".index(k)]) is not None and v == v) for k in "abde"}
    assert got == want
    assert seen[0] < 1000
    wide = {r.column_name: r.median for r in RK.exact_medians(df, ["a", "b", "c", "d", "e"], accuracy=2).collect()}
    assert wide == want
    calls = []
    monkeypatch.setattr(type(df), "unpivot", lambda *a, **k: calls.append(a))
    EN.fit_medians(df, ["a", "b"]).collect()
    assert not calls


def test_medians_without_values(spark):
    df = spark.createDataFrame([(None,)], "a double")
    assert RK.exact_medians(df, ["a"]).collect() == [] and RK.exact_medians(df.limit(0), ["a"]).collect() == []
