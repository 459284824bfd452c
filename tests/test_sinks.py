"""Sinks and snapshot sources on small frames written under the session's
checkpoint folder."""

import os
import time

import pytest
from pyspark.sql import functions as F

from rows import raw_frame
from tillsense.operators import drift as DR
from tillsense.operators import features as FE
from tillsense.operators import quality as QU
from tillsense.plans.catalog import round_doubles
from tillsense.sources import sinks as SK
from tillsense.sources.retail import scan_transactions, scan_transactions_checked
from tillsense.sources.tables import drop_session_tables, materialize, session_cache, table_path


def test_latest_by_name_and_by_modification(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    base = table_path(df, "snapshots")
    # written in this order: the newest *name* is written first
    df.where("k = 2").write.parquet(f"{base}/processed_df_20250101")
    time.sleep(1.1)
    df.where("k = 1").write.parquet(f"{base}/processed_df_20240101")
    by_name = [r.k for r in SK.scan_latest_file(spark, base).collect()]
    by_time = [r.k for r in SK.scan_latest_modified(spark, base).collect()]
    assert by_name == [2]
    assert by_time == [1]


def test_price_curve_cache_expires(spark):
    curves = spark.createDataFrame([("p", 1.0), ("q", 2.0)], "stockcode string, optimal_unit_price double")
    h = F.sha2(F.col("stockcode"), 256)
    store = SK.store_price_curves(curves, h, created_at=1000.0)
    req = store.select("stockcode", "params_hash").withColumn(
        "request_time", F.when(F.col("stockcode") == "p", F.lit(1000.0 + 60)).otherwise(F.lit(1000.0 + SK.CACHE_TTL_SECONDS + 1))
    )
    hits = [r.stockcode for r in SK.cached_price_curves(store, req).collect()]
    assert hits == ["p"]


def _curve(spark, products, price):
    return spark.createDataFrame([(p, float(b), price * b) for p in products for b in range(3)], "stockcode string, bin double, sales double")


def _stored(spark, path):
    return sorted((r.stockcode, r.bin, r.sales) for r in SK.read_price_curves(spark, path).collect())


def test_stored_curve_is_replaced_and_not_doubled(spark):
    path = table_path(_curve(spark, "p", 1.0), "curves")
    h = F.sha2(F.col("stockcode"), 256)
    names = [f"p{i}" for i in range(40)]
    SK.store_price_curves(_curve(spark, names, 1.0), h, 1000.0, path)
    SK.store_price_curves(_curve(spark, names[:5], 9.0).where("bin < 2"), h, 2000.0, path)
    expected = [(p, float(b), (9.0 if p in names[:5] else 1.0) * b) for p in names for b in range(2 if p in names[:5] else 3)]
    assert _stored(spark, path) == sorted(expected)


def test_expired_curves_are_swept(spark):
    path = table_path(_curve(spark, "p", 1.0), "curves")
    h = F.sha2(F.col("stockcode"), 256)
    SK.store_price_curves(_curve(spark, ["a", "b", "c"], 1.0), h, 0.0, path)
    SK.store_price_curves(_curve(spark, ["c", "d"], 2.0), h, 3000.0, path)
    assert SK.sweep_price_curves(spark, path, 3600.0) == 6
    assert {r[0] for r in _stored(spark, path)} == {"c", "d"}
    assert SK.sweep_price_curves(spark, path, 3600.0) == 0
    # storing sweeps the partitions that it rewrites
    SK.store_price_curves(_curve(spark, ["c"], 3.0), h, 10000.0, path)
    assert [r for r in _stored(spark, path) if r[0] == "c"] == [("c", 0.0, 0.0), ("c", 1.0, 3.0), ("c", 2.0, 6.0)]


def test_lookup_prunes_partitions(spark):
    path = table_path(_curve(spark, "p", 1.0), "curves")
    h = F.sha2(F.col("stockcode"), 256)
    store = SK.store_price_curves(_curve(spark, [f"p{i}" for i in range(50)], 1.0), h, 1000.0, path)
    req = spark.createDataFrame([("p7", 1500.0)], "stockcode string, request_time double").withColumn("params_hash", h)
    hits = SK.cached_price_curves(store, req)
    assert [r.stockcode for r in hits.collect()] == ["p7"] * 3
    assert "dynamicpruning" in hits._jdf.queryExecution().executedPlan().toString()


def test_write_splits_partitioned(spark):
    s = spark.createDataFrame([(1, "train"), (2, "val"), (3, "test")], "row_id long, split string")
    back = SK.write_splits(s)
    assert sorted((r.row_id, r.split) for r in back.collect()) == [(1, "train"), (2, "val"), (3, "test")]
    assert back.where("split = 'test'").count() == 1


def test_metrics_history_append_and_latest(spark):
    h = spark.createDataFrame([("p", 2020, 0.5), ("p", 2021, 0.4), ("q", 2020, 0.9)], "stockcode string, timestamp int, mse double")
    path = table_path(h, "history")
    SK.append_metrics_history(h.where("timestamp = 2020"), path, "v1")
    SK.append_metrics_history(h.where("timestamp = 2021"), path, "v2")
    back = SK.read_metrics_history(spark, path)
    assert back.count() == 3 and set(back.columns) >= {"model_version", "recorded_at"}
    latest = {r.stockcode: (r.timestamp, r.model_version) for r in QU.latest_metrics(back).collect()}
    assert latest == {"p": (2021, "v2"), "q": (2020, "v1")}


def test_gates_raise(spark):
    report = spark.createDataFrame([("a", True), ("b", False)], "column_name string, is_blocking boolean")
    with pytest.raises(QU.QualityGateError):
        QU.assert_gate(report)
    summary = spark.createDataFrame([("p", True)], "stockcode string, drift_detected boolean")
    with pytest.raises(DR.DriftDetected):
        DR.drift_gate(summary)
    QU.assert_gate(report.where("NOT is_blocking"))


def test_drop_session_tables_removes_files_and_cached_handles(spark):
    """Intermediate tables of one application share one folder; dropping it
    deletes the files and forgets the cached handles of that application."""
    import os

    cache = session_cache()
    app = spark.sparkContext.applicationId
    t = materialize(spark.range(5), "drop_probe")
    cache[(app, "probe")] = t
    cache[("other-app", "probe")] = t
    path = t.inputFiles()[0].replace("file://", "").replace("file:", "")
    assert os.path.exists(path)
    assert drop_session_tables(spark)
    assert not os.path.exists(path)
    assert list(cache) == [("other-app", "probe")]
    # stored tables are rebuilt on demand afterwards
    assert materialize(spark.range(3), "drop_probe").count() == 3


def test_cluster_session_without_checkpoint_dir_is_refused():
    """A machine-local scratch folder is only made in local mode; on a
    cluster the shared spark.checkpoint.dir must be configured."""
    from types import SimpleNamespace

    from tillsense.session import checkpoint_dir

    set_dirs = []

    def ctx(master, configured=None):
        conf = SimpleNamespace(get=lambda key, default=None: configured if key == "spark.checkpoint.dir" else default)
        sc = SimpleNamespace(
            master=master,
            getCheckpointDir=lambda: set_dirs[-1] if set_dirs else None,
            getConf=lambda: conf,
            setCheckpointDir=set_dirs.append,
        )
        return SimpleNamespace(sparkContext=sc)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(ctx("yarn"))
    assert set_dirs == []
    assert checkpoint_dir(ctx("yarn", "hdfs:///shared/ckpt")) == "hdfs:///shared/ckpt"
    assert set_dirs == ["hdfs:///shared/ckpt"]


def test_latest_of_flat_files_and_partitioned_folders(spark, tmp_path):
    flat = tmp_path / "flat"
    flat.mkdir()
    (flat / "sales_2024.csv").write_text("k,v\n1,old\n")
    (flat / "sales_2025.csv").write_text("k,v\n2,new\n3,new\n")
    os.utime(flat / "sales_2025.csv", (1, 1))
    assert sorted(r.k for r in SK.scan_latest_file(spark, str(flat), "csv").collect()) == ["2", "3"]
    assert [r.k for r in SK.scan_latest_modified(spark, str(flat), "csv").collect()] == ["1"]
    base = str(tmp_path / "snaps")
    for name, n in (("s1", 3), ("s2", 5)):
        spark.range(n).withColumn("part", F.col("id") % 2).write.partitionBy("part").parquet(f"{base}/{name}")
    assert sorted(r.id for r in SK.scan_latest_file(spark, base).collect()) == [0, 1, 2, 3, 4]


def test_csv_scan_takes_both_date_styles_and_no_nan(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        "invoiceno,stockcode,description,quantity,invoicedate,unitprice,customerid,country\n"
        "1,a,x,2,12/1/2010 8:26,2.5,17850.0,UK\n2,a,x,nan,2010-12-02 09:00:00,NaN,nan,UK\n3,a,x,bad,never,bad,C7,\n"
    )
    got = [tuple(r) for r in scan_transactions(spark, str(path)).select("quantity", F.col("invoicedate").cast("string"), "unitprice", "customerid", "country").collect()]
    assert got[0] == (2.0, "2010-12-01 08:26:00", 2.5, "17850", "UK")
    assert got[1][:3] == (None, "2010-12-02 09:00:00", None)
    assert got[2] == (None, None, None, "C7", None)
    f = FE.phase1(scan_transactions(spark, str(path)))
    assert [r.m for r in f.select(F.col("product_max_price_all_time").alias("m")).collect()] == [2.5] * 3


def test_features_of_a_union_and_of_dates_after_2001(spark):
    a = raw_frame(spark, [("1", "p", 1.0, "2010-12-01T08:26:47", 2.0, "c", "a")])
    b = raw_frame(spark, [("2", "p", 3.0, "2011-01-05T10:00:13", 4.0, "c", "a"), ("3", "q", 1.0, "2011-01-06T00:00:01", None, None, None)])
    got = {r.invoiceno: r for r in round_doubles(FE.transactions_features(a.unionByName(b))).collect()}
    assert got["1"].invoicedate == 1291192007.0 and got["2"].invoicedate == 1294221613.0
    assert got["3"].unitprice == 3.0 and got["2"].product_avg_quantity_last_month == 1.0


def test_unreadable_fields_and_broken_lines_are_counted(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(
        "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
        "1,a,x,3,2010-12-01 08:26:00,2.5,17850.0,UK\n"
        "2,b,x,many,12/1/2010 8:26,n/a,,UK\n"
        "3,c,x\n"
        "4,d,x,1,31/31/1999,abc,5,FR\n"
        "5,e,x,2,2010-12-01 08:26:00,1.0,5,FR,one,more\n"
        "6,f,x,,,NaN,,\n"
    )
    rows, bad = scan_transactions_checked(spark, str(path))
    got = {r["invoiceno"]: (r["quantity"], str(r["invoicedate"]), r["unitprice"], r["customerid"]) for r in rows.collect()}
    assert got == {
        "1": (3.0, "2010-12-01 08:26:00", 2.5, "17850"), "2": (None, "2010-12-01 08:26:00", None, None),
        "4": (1.0, "None", None, "5"), "6": (None, "None", None, None),
    }
    assert sorted((r["reason"], r["line"][:1]) for r in bad.collect()) == [
        ("bad_date", "4"), ("bad_quantity", "2"), ("bad_unitprice", "4"), ("broken_line", "3"), ("broken_line", "5"),
    ]


def test_attribution_reports_are_compressed_and_whole(spark, tmp_path):
    rows = [(f"{i}", 0.5 * i if i % 3 else None, float(i)) for i in range(3000)]
    long = spark.createDataFrame(rows, "stockcode string, shap_value double, feature_value double").withColumn("feature_name", F.lit("unitprice"))
    summary = long.groupBy("feature_name").agg(F.avg(F.abs("shap_value")).alias("mean_abs_shap"))
    paths = SK.write_attribution_reports(long, long, summary, str(tmp_path))
    back = spark.read.schema(long.schema).json(paths["long"])
    assert sorted(back.collect(), key=str) == sorted(long.collect(), key=str)
    assert spark.read.json(paths["summary"]).collect()[0]["mean_abs_shap"] == summary.collect()[0]["mean_abs_shap"]
    stored = sum(f.stat().st_size for f in (tmp_path / "long").glob("part-*"))
    assert 0 < stored < 40 * len(rows)  # 75 bytes a record as text
