"""Feature rows are stored and exchanged without what follows from their other columns."""

import datetime as dt

from pyspark.sql import functions as F

from rows import raw_frame
from tillsense.operators import drift as DR
from tillsense.operators import encoding as EN
from tillsense.operators import features as FE
from tillsense.operators import pricing as PR

ROWS = [
    ("1", "A", 3.0, "1969-12-31T23:59:59", 2.0, "c1", "FR"),
    ("2", "A", 2.0, "2001-02-28T00:00:00", None, None, "FR"),
    ("3", "A", 4.0, "2001-03-04T10:00:00.123457", 4.0, "c2", None),
    ("4", "B", 1.0, "2001-03-05T10:00:00", None, "unknown", "DE"),  # only the global price is known
    ("5", None, 5.0, None, -1.5, None, None),
    ("6", "C", 2.0, "2004-02-29T00:00:00", 0.0, "c3", "DE"),
    ("7", "C", 2.0, "2004-03-01T00:00:00", float("nan"), "c3", "DE"),
]


def _features(spark):
    return FE.transactions_features(raw_frame(spark, ROWS))


def test_stored_form_is_whole_again(spark):
    f = _features(spark)
    stored = FE.stored_form(f)
    assert not set(FE.DERIVED) & set(stored.columns)
    back = FE.with_derived(stored.withColumn("row_id", F.lit(1)))
    assert back.columns == [*f.columns, "row_id"] and [x.dataType for x in back.drop("row_id").schema] == [x.dataType for x in f.schema]
    text = lambda df: sorted(map(str, df.collect()))  # noqa: E731 (NaN is unequal to itself)
    assert text(back.drop("row_id")) == text(f)
    assert f.where(F.col("day_of_week") == "Wed").count() == 2  # 1969-12-31 and 2001-02-28


def test_rows_cross_the_product_exchange_with_raw_columns_only(spark):
    plan = FE.windowed_rows(raw_frame(spark, ROWS))._jdf.queryExecution().optimizedPlan()
    found, todo = [], [plan]
    while todo:
        p = todo.pop()
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
        if "RepartitionByExpression" in p.getClass().getName():
            found.append({p.output().apply(i).name() for i in range(p.output().size())})
    assert found == [{"invoiceno", "stockcode", "quantity", "invoicedate", "unitprice", "customerid", "country"}]
    physical = FE.windowed_rows(raw_frame(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert physical.count("Exchange hashpartitioning") == 1  # the windows use it


def test_samples_of_hot_and_other_products_are_the_same(spark):
    start = dt.datetime(2001, 1, 1)
    rows = [(str(i), "hot" if i % 3 else f"p{i % 9}", 1.0 + i % 5, (start + dt.timedelta(hours=i)).isoformat(), 1.0 + i % 7, None, None) for i in range(600)]
    f = FE.transactions_features(raw_frame(spark, rows)).cache()
    for limit in (5, 1000):
        want = sorted(map(tuple, PR.product_sample(f, limit, hot_rows=10**9).collect()))
        assert want == sorted(map(tuple, PR.product_sample(f, limit, hot_rows=201).collect()))
        assert len(want) == sum(min(limit, r["count"]) for r in f.groupBy("stockcode").count().collect())
    plan = PR.product_sample(f)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(stockcode") == 1 and "_salt" not in plan


def test_drift_of_hot_and_other_groups_is_the_same(spark):
    rows = [(None if i % 11 == 0 else f"g{i % 4 and 1}", None if i % 7 == 0 else float(i % 13), float("nan") if i % 5 == 0 else float(i % 3), i % 2) for i in range(900)]
    df = spark.createDataFrame(rows, "stockcode string, a double, b double, side int").cache()
    ref, cur = df.where("side = 0"), df.where("side = 1 AND (stockcode IS NULL OR a > 3)")
    cold, hot, mixed = (DR._cdf(ref, cur, ["stockcode"], ["a", "b"], n) for n in (10**9, 1, 301))
    want = sorted(map(str, cold.collect()))
    assert want and want == sorted(map(str, hot.select(*cold.columns).collect())) == sorted(map(str, mixed.select(*cold.columns).collect()))
    # one exchange, of whole rows
    plan = DR._cdf(ref, cur, ["stockcode"], ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "ranked_input" not in plan


def test_large_dictionaries_are_joined_before_columns_are_derived(spark, monkeypatch):
    monkeypatch.setattr(EN, "MAP_LIMIT", 2)
    f = _features(spark).withColumn("row_id", F.monotonically_increasing_id())
    m = EN.fit_column_transform(f, ["unitprice", "unitprice_log"], ["stockcode", "is_registered", "day_of_week"])
    want = EN.transform(f, m, ["row_id", "year"])
    stored = FE.stored_form(f)
    seen = []

    def derive(df):
        seen.append(df.columns)
        return FE.with_derived(df)

    got = EN.transform(stored, m, ["row_id", "year"], derive)
    assert "_ord_stockcode" in seen[0] and "_ord_day_of_week" not in seen[0] and "unitprice_log" not in seen[0]
    assert got.columns == want.columns and len(m.small) == 1
    ids = f.select("row_id").count()
    assert got.count() == want.count() == ids


def test_large_tables_are_spread_over_more_tasks(spark):
    from tillsense.operators.ranking import range_numbered, spread_by

    df = spark.range(1000)
    assert spread_by(df, ["id"], 1000, 50).rdd.getNumPartitions() == 20
    numbered = range_numbered(df, [], ["id"], out="n", cells=9)
    assert "hashpartitioning(_cell" in numbered._jdf.queryExecution().executedPlan().toString()
    assert numbered.where(F.col("n") != F.col("id") + 1).count() == 0 and numbered.count() == 1000
