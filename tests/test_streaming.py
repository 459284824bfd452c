"""M1 over several micro-batches equals the batch feature table."""

from pyspark.sql import functions as F

from rows import SF0001, raw_frame
from tillsense.operators import features as FE
from tillsense.plans.catalog import round_doubles
from tillsense.plans.q_core import FEATURE_OUT
from tillsense.sources.retail import retail_transactions
from tillsense.sources.tables import table_path
from tillsense.operators.ranking import exact_median
from tillsense.streaming import refresh as RF
from tillsense.streaming import state as ST


def test_refresh_in_several_batches(spark):
    raw = retail_transactions(spark, SF0001)
    base = table_path(raw, "refresh_test")
    cut = F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")
    RF.bootstrap(spark, raw.where(F.col("invoicedate") < cut), f"{base}/history", f"{base}/features")
    new = raw.where(F.col("invoicedate") >= cut)
    for y in (1999, 2000, 2001):
        new.where(F.year("invoicedate") == y).coalesce(1).write.parquet(f"{base}/incoming/y{y}")
    path = RF.incremental_refresh(
        spark, f"{base}/incoming", raw.schema, f"{base}/history", f"{base}/features", f"{base}/_state", max_files_per_trigger=1
    )
    got = round_doubles(spark.read.parquet(path).select(*FEATURE_OUT))
    exp = round_doubles(FE.transactions_features(raw).select(*FEATURE_OUT))
    assert got.count() == exp.count()
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
    # three batches were recorded in the history, plus the bootstrap
    keys = [r.batch_key for r in spark.read.parquet(f"{base}/history").select("batch_key").distinct().collect()]
    assert len(keys) == 4 and "bootstrap" in keys
    # a stream that starts anew meets recorded files only: nothing changes
    RF.incremental_refresh(spark, f"{base}/incoming", raw.schema, f"{base}/history", f"{base}/features", f"{base}/_state2")
    assert spark.read.parquet(f"{base}/history").count() == raw.count()
    again = round_doubles(spark.read.parquet(path).select(*FEATURE_OUT))
    assert again.count() == exp.count() and again.exceptAll(exp).count() == 0


def _rows(spark, *rows):
    return raw_frame(spark, [(i, p, 1.0, f"2020-0{m}-01", price, "c", "a") for i, p, m, price in rows])


def _table(df):
    return sorted(round_doubles(df.select("invoiceno", "stockcode", "unitprice", "unitprice_vs_max", "product_avg_quantity_last_month")).collect())


def test_restarted_stream_keeps_batches_and_global_price_follows(spark):
    """A product without a price of its own follows the global median, and a
    second run that counts from batch 0 again keeps the first run's rows."""
    old = _rows(spark, ("1", "p", 1, 9.0), ("2", "q", 1, None), ("3", "p", 2, 9.0))
    one = _rows(spark, ("4", "r", 3, 1.0), ("5", "r", 3, 1.0), ("6", "r", 4, 1.0))
    two = _rows(spark, ("7", "s", 5, 1.0), ("8", "p", 5, 2.0))
    base = table_path(old, "refresh_restart")
    RF.bootstrap(spark, old, f"{base}/h", f"{base}/f", buckets=8)
    assert ("2", "q", 9.0) in [tuple(r)[:3] for r in _table(spark.read.parquet(f"{base}/f"))]
    RF.refresh_batch(spark, one, 0, f"{base}/h", f"{base}/f", "run1", buckets=8)
    assert ("2", "q", 1.0) in [tuple(r)[:3] for r in _table(spark.read.parquet(f"{base}/f"))]
    RF.refresh_batch(spark, two, 0, f"{base}/h", f"{base}/f", "run2", buckets=8)
    RF.refresh_batch(spark, two, 0, f"{base}/h", f"{base}/f", "run2", buckets=8)  # a retry
    assert spark.read.parquet(f"{base}/h").count() == 8
    assert _table(spark.read.parquet(f"{base}/f")) == _table(FE.transactions_features(old.unionByName(one).unionByName(two)))


def test_a_batch_reads_only_the_history_of_its_buckets(spark):
    old = _rows(spark, *[(str(i), f"p{i % 40}", 1 + i % 9, 1.0 + i % 7) for i in range(400)])
    base = table_path(old, "refresh_plan")
    RF.bootstrap(spark, old, f"{base}/h", f"{base}/f", buckets=16)
    new = _rows(spark, ("900", "p3", 9, 2.0))
    refreshed, _, in_buckets, _, gmed = RF.touched_features(spark, new, "run-0", f"{base}/h", 16)
    assert len(in_buckets) == 1
    plan = refreshed.withColumn("g", gmed)._jdf.queryExecution().executedPlan().toString().split("\n")
    scans = [line for line in plan if "FileScan parquet" in line and "batch_key" in line]
    history = [line for line in scans if "invoicedate" in line.split("Batched")[0]]
    state = [line for line in scans if line not in history]
    assert history and state
    # of the history only the touched bucket is read, and of the state too
    for line in history + state:
        assert "(bucket#" in line.split("PartitionFilters")[1].split("PushedFilters")[0], line


def test_state_adds_up_over_batches(spark):
    """Months, value counts and country counts of all batches are those of all rows, also compacted."""
    first = _rows(spark, ("1", "p", 1, 9.0), ("2", "p", 1, None), ("3", None, 2, 9.0))
    second = _rows(spark, ("4", "p", 1, 9.0), ("5", "q", 3, 2.0), ("6", "m", 3, 2.0))
    path = table_path(first, "state")
    ST.store(ST.contribution(first), path, "a", 4)
    ST.store(ST.contribution(second), path, "b", 4)
    ST.store(ST.contribution(second), path, "b", 4)  # a retry replaces its own part
    ST.record_files(first, path, "a")
    ST.record_files(second.withColumn(ST.FILE, F.lit("f1")), path, "b")
    small = ST.compacted(spark, path, table_path(first, "compacted"), 4)
    whole = ST.contribution(first.unionByName(second))
    nothing = {k: v.limit(0) for k, v in ST.contribution(first).items()}
    for name in ST.TABLES:
        expected = sorted(map(str, whole[name].collect()))
        for p in (path, small):
            assert sorted(map(str, ST.merged(spark, p, name, nothing, "none", None).select(*whole[name].columns).collect())) == expected
    for p in (path, small):
        assert [r[0] for r in ST.known_files(spark, p, "a").collect()] == ["f1"]


def test_median_of_counts_is_the_median_of_the_values(spark):
    values = [("a", v) for v in (1.0, 1.0, 2.0, 5.0)] + [("b", 3.0)] + [("c", float(v)) for v in range(11)]
    df = spark.createDataFrame(values, "g string, v double")
    counts = df.groupBy("g", "v").agg(F.count("*").alias("n"))
    got = {r["g"]: r["m"] for r in ST.median_of_counts(counts, "v", "n", ["g"], "m").collect()}
    assert got == {"a": 1.5, "b": 3.0, "c": 5.0}
    assert ST.median_of_counts(counts, "v", "n", [], "m").first()["m"] == exact_median(df, "v", [], out="m").first()["m"]
