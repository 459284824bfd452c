"""What is stored and exchanged on the way to the features and the scored grid."""

import re

from tests.rows import raw_frame
from tillsense.operators import features as FE
from tillsense.operators import pricing as PR
from tillsense.streaming import refresh as RF

ROWS = [
    ("1", "A", 2.0, "2020-01-05", 3.0, "c1", "x"),
    ("2", "A", 4.0, "2020-02-05", None, None, None),
    ("3", None, 1.0, "2020-01-07", 5.0, "c2", "y"),
    ("4", None, 3.0, "2020-01-08", None, "c2", None),
    ("5", "unknown", 3.0, "2020-01-09", 9.0, "c3", "y"),
]


def test_feature_rows_are_stored_without_derived_columns(spark, monkeypatch):
    stored, write = [], FE.materialize
    monkeypatch.setattr(FE, "materialize", lambda df, name, *a: stored.append(df.columns) or write(df, name, *a))
    raw = raw_frame(spark, ROWS)
    got = {r.invoiceno: r for r in FE.transactions_features(raw).collect()}
    assert stored == [raw.columns]
    # rows without a code take the values of the product 'unknown', but none of its months
    assert (got["4"].stockcode, got["4"].country, got["4"].unitprice) == ("unknown", "y", 7.0)
    assert got["4"].product_max_price_all_time is None and got["5"].product_max_price_all_time == 9.0
    assert (got["2"].country, got["2"].unitprice, got["2"].product_avg_quantity_last_month) == ("x", 3.0, 2.0)


def test_feature_rows_take_one_exchange_and_no_join(spark):
    plan = FE.windowed_rows(raw_frame(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("Initial Plan")[0]
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_hot_products_have_the_same_features(spark):
    more = [
        ("6", "A", 5.0, "2020-02-07", 7.0, "c1", "y"),
        ("7", "A", None, "2020-03-01", 11.0, "c1", "y"),
        ("8", "A", -1.0, None, 2.0, "c1", None),
        ("9", "A", 2.0, "2020-04-01", 4.0, "c1", None),
        ("10", "D", 2.0, "2020-04-01", 4.0, "c1", "z"),
        ("11", "m", 2.0, "2020-04-01", None, "c1", None),
        ("12", "M", 3.0, "2020-05-01", float("nan"), "c1", "z"),
    ]
    raw = raw_frame(spark, ROWS + more)
    table = lambda hot: sorted(map(str, FE.transactions_features(raw, hot_rows=hot).collect()))
    assert FE.hot_products(raw, 4) == ["A"] and FE.hot_products(raw, 100) == []
    assert sorted(FE.hot_products(raw, 2)) == ["A", "M", "unknown"]
    assert table(100) == table(4) == table(2) == table(1)


def test_scored_rows_are_not_exchanged(spark):
    grid = spark.createDataFrame([("A", 0, 1.0), ("A", 1, 2.0), ("B", 0, 3.0)], "stockcode string, bin int, unit_price double")
    fit = [f"{g}{c}" for g in ("", "global_") for c in ("slope", "momentum_weight", "intercept")]
    model = spark.createDataFrame([("A", *[1.0] * 6)], "stockcode string, " + ", ".join(f"{c} double" for c in fit))
    sample = spark.createDataFrame([("A", 1, 0.5), ("A", 2, 0.7), ("B", 1, 0.1)], "stockcode string, sample_no int, momentum double")
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    try:
        scored = PR.score_grid(grid, model, sample)
        plan = scored._jdf.queryExecution().executedPlan().toString().split("\n")
        rows = {(r.stockcode, r.bin, r.sample_no): r.use_backup for r in scored.collect()}
    finally:
        for n, v in old.items():
            spark.conf.set(n, v)
    assert rows == {("A", 0, 1): False, ("A", 0, 2): False, ("A", 1, 1): False, ("A", 1, 2): False, ("B", 0, 1): True}
    depth = lambda line: len(re.match(r"[\s:+\-|]*", line).group())
    found = [i for i, line in enumerate(plan) if "explode(_grid" in line]
    assert found
    for i in found:
        at = depth(plan[i])
        for line in reversed(plan[:i]):
            if depth(line) < at:
                at = depth(line)
                assert "Exchange" not in line


def test_scored_rows_are_not_sorted_for_their_flags(spark):
    rows = [("A", 800.0, 1.0), ("A", 1.0, 2.0), ("B", 1.0, 2.0), (None, 1.0, 2.0)]
    scored = spark.createDataFrame(rows, "stockcode string, y_primary double, y_backup double").repartition(3, "stockcode")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = PR.score_failover(scored)
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        got = sorted(((r.stockcode or "", r.use_backup, r.y_pred) for r in out.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "ShuffledHashJoin" in plan and "Sort" not in plan.replace("SortAggregate", "")
    assert got == [("", None, 1.0), ("A", True, 1.0), ("A", True, 2.0), ("B", False, 1.0)]


def test_bootstrap_adds_up_the_stored_rows(spark, tmp_path, monkeypatch):
    read, add = [], RF.ST.contribution
    monkeypatch.setattr(RF.ST, "contribution", lambda rows: read.append(rows.inputFiles()) or add(rows))
    raw = raw_frame(spark, ROWS)
    RF.bootstrap(spark, raw, f"{tmp_path}/h", f"{tmp_path}/f", buckets=2)
    assert read and read[0] and all("/h/" in f for f in read[0])
    got = spark.read.parquet(f"{tmp_path}/f").select(*FE.FEATURE_COLUMNS).collect()
    assert sorted(map(str, got)) == sorted(map(str, FE.transactions_features(raw).select(*FE.FEATURE_COLUMNS).collect()))
