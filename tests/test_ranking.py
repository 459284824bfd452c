"""Skew-safe ranking helpers against brute force, with one hot key."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillsense.operators.ranking import exact_median, last_by, mode_by, range_cell, range_numbered, running_total


def _fixture(spark, n=3000, seed=7):
    rng = np.random.default_rng(seed)
    keys = np.where(rng.random(n) < 0.4, "hot", rng.choice(list("abcdefgh"), n))
    vals = rng.normal(10, 3, n).round(2)
    pdf = pd.DataFrame({"k": keys, "v": vals, "t": np.arange(n)})
    return pdf, spark.createDataFrame(pdf)


def test_running_total_is_row_number(spark):
    pdf, df = _fixture(spark)
    got = running_total(df, ["k"], [F.col("t")], out="rn", partitions=6).toPandas().sort_values("t")
    exp = pdf.sort_values("t").groupby("k").cumcount() + 1
    assert (got["rn"].to_numpy() == exp.sort_index().to_numpy()).all()


def test_running_total_global_with_totals(spark):
    pdf, df = _fixture(spark)
    got = running_total(df, [], [F.col("v"), F.col("t")], out="rn", total_out="n", partitions=5).toPandas()
    assert sorted(got["rn"]) == list(range(1, len(pdf) + 1))
    assert set(got["n"]) == {len(pdf)}
    got = got.sort_values("rn")
    assert (np.diff(got["v"].to_numpy()) >= 0).all()


def test_weighted_running_total(spark):
    pdf, df = _fixture(spark)
    df = df.withColumn("w", (F.col("t") % 3).cast("long"))
    got = running_total(df, ["k"], [F.col("t")], out=["cw", "rn"], weight=["w", None], total_out=["tw", None]).toPandas().sort_values("t")
    pdf = pdf.sort_values("t").assign(w=lambda d: d.t % 3)
    assert (got["cw"].to_numpy() == pdf.groupby("k")["w"].cumsum().to_numpy()).all()
    assert (got["tw"].to_numpy() == pdf.groupby("k")["w"].transform("sum").to_numpy()).all()


def test_exact_median_matches_numpy(spark):
    pdf, df = _fixture(spark)
    got = {r.k: r.median for r in exact_median(df, "v", ["k"], partitions=7).collect()}
    for k, g in pdf.groupby("k"):
        assert np.isclose(got[k], np.median(g["v"]))
    glob = exact_median(df, "v", []).first().median
    assert np.isclose(glob, np.median(pdf["v"]))


def test_mode_and_last(spark):
    df = spark.createDataFrame([("k", "x", 1), ("k", "y", 2), ("k", "y", 3), ("k", "x", 4), ("j", None, 1)], "k string, c string, t int")
    assert {r.k: r.m for r in mode_by(df, ["k"], "c", out="m").collect()} == {"k": "x"}
    assert {r.k: r.c for r in last_by(df, ["k"], ["c"], ["t"]).collect()} == {"k": "x", "j": None}


def test_next_value_across_partitions(spark):
    pdf, df = _fixture(spark)
    got = running_total(df, ["k"], [F.col("t")], out="rn", partitions=7, next_of="t").toPandas().sort_values("t")
    exp = pdf.sort_values("t").groupby("k")["t"].shift(-1)
    assert got["next_t"].fillna(-1).to_numpy().tolist() == exp.fillna(-1).to_numpy().tolist()


def test_exact_median_with_repeated_values(spark):
    rows = [("a", 1.0)] * 5 + [("a", 2.0)] * 5 + [("b", 3.0)] * 4 + [("b", 7.0)] + [("c", 4.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.median for r in exact_median(df, "v", ["k"], partitions=3).collect()}
    assert got == {"a": 1.5, "b": 3.0, "c": 4.0}


def test_exact_median_bracket_fallback(spark):
    """A tiny sketch accuracy makes brackets miss: results must stay exact."""
    pdf, df = _fixture(spark, n=4000, seed=3)
    got = {r.k: r.median for r in exact_median(df, "v", ["k"], accuracy=2).collect()}
    for k, g in pdf.groupby("k"):
        assert np.isclose(got[k], np.median(g["v"]))
    assert np.isclose(exact_median(df, "v", [], accuracy=3).first().median, np.median(pdf["v"]))


@pytest.mark.parametrize("cells", [1, 7, 64])
def test_range_numbered_is_row_number(spark, cells):
    """NULL keys, ties, negative and missing numbers; a group with most rows."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(2000):
        v = None if i % 11 == 0 else float("nan") if i % 97 == 0 else float(rng.integers(-5, 5))
        rows.append((None if i % 13 == 0 else "hot" if i % 3 else f"g{i % 7}", v, None if i % 5 == 0 else f"é,{i % 17}", i))
    df = spark.createDataFrame(rows, "g string, v double, s string, i long").repartition(5)
    order = ["v", "s", "i"]
    for group in ([], ["g"]):
        got = {r["i"]: (r["rn"], r["n"]) for r in range_numbered(df, group, order, "rn", "n", cells).collect()}
        exp = running_total(df, group, [F.col(c).asc_nulls_first() for c in order], "rn", total_out="n")
        assert got == {r["i"]: (r["rn"], r["n"]) for r in exp.collect()}
    assert range_numbered(df.limit(0), ["g"], order).collect() == []


def test_range_numbered_spreads_a_hot_group_and_moves_keys_only(spark, tmp_path):
    rows = [("hot", i, "wide" * 20) for i in range(4000)]
    spark.createDataFrame(rows, "g string, i long, pad string").repartition(4).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    sizes = df.groupBy(range_cell(df, ["g", "i"], 16).alias("c")).count().collect()
    assert len(sizes) == 16 and max(r["count"] for r in sizes) < 2 * 4000 / 16
    plan = range_numbered(df, ["g"], ["i"], cells=16).select("g", "i", "rn")._jdf.queryExecution().executedPlan().toString()
    assert "pad" not in plan and "rangepartitioning" not in plan
    assert "split(" not in plan  # the bounds are constants, not parsed for each row


def test_the_range_of_a_row_is_searched_once_and_ends_at_the_first_field_that_differs(spark, tmp_path):
    rows = [(None if i % 9 == 0 else f"g{i % 5}", None if i % 7 == 0 else float(i % 31), i) for i in range(3000)]
    spark.createDataFrame(rows, "g string, v double, i long").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = range_numbered(df, [], ["g", "v", "i"], cells=16).select("i", "rn")._jdf.queryExecution().optimizedPlan().toString()
    # once where the rows are counted, once where they are numbered: no filter repeats it
    assert plan.count("aggregate([") == 2 and "<= struct(" not in plan
    cell = range_cell(df, ["g", "v", "i"], 16)
    got = [r.c for r in df.orderBy(F.col("g").asc_nulls_first(), F.col("v").asc_nulls_first(), "i").select(cell.alias("c")).collect()]
    assert got == sorted(got) and set(got) == set(range(16))


def test_numbered_rows_take_one_exchange(spark, tmp_path):
    rows = [("hot" if i % 3 else f"g{i % 40}", i) for i in range(3000)] + [(None, 5), (None, 6)]
    spark.createDataFrame(rows, "g string, i long").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    try:
        out = range_numbered(df, ["g"], ["i"], "rn", "n", 16)
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        got = {(r.g, r.i): (r.rn, r.n) for r in out.collect()}
    finally:
        for n, v in old.items():
            spark.conf.set(n, v)
    assert "SortMergeJoin" not in plan
    groups = {}
    for g, i in rows:
        groups.setdefault(g, []).append(i)
    assert got == {(g, i): (k + 1, len(v)) for g, v in groups.items() for k, i in enumerate(sorted(v))}
