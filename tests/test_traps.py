"""Hand-made fixtures, one per trap of SURVEY §2.15 (FIXTURES.md §4)."""

import hashlib
import math

from pyspark.sql import functions as F

from rows import raw_frame
from tillsense.operators import cleaning as C
from tillsense.operators import features as FE
from tillsense.operators import pricing as PR
from tillsense.operators import quality as QU
from tillsense.operators import splits as SP
from tillsense.sources.retail import normalize_columns


def test_k1_missing_tokens(spark):
    vals = ["", "nan", "N/A", "na", "None", "none", "x", None]
    df = spark.createDataFrame([(v,) for v in vals], "c string")
    out = [r.c for r in C.normalize_missing(df).collect()]
    assert [v for v in out if v is not None] == ["x"]


def test_k2_column_names_idempotent(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a", "B c", "D__e"])
    once = normalize_columns(df)
    assert once.columns == ["a", "b_c", "d_e"]
    assert normalize_columns(once).columns == ["a", "b_c", "d_e"]


def test_k3_not_in_keeps_null(spark):
    df = spark.createDataFrame([("x",), (None,), ("B",)], "stockcode string")
    assert sorted(C.drop_admin_codes_pre(df).collect(), key=str) == sorted([("x",), (None,)], key=str)


def test_k4_zero_divisor_and_bad_quantity(spark):
    df = spark.createDataFrame([(5.0, 0.0, 0.0)], "unitprice double, product_max_price_all_time double, product_avg_quantity_last_month double")
    r = C.price_ratio_features(df).first()
    assert r.unitprice_vs_max == 0.0 and r.unitprice_to_avg == 0.0
    q = spark.createDataFrame([("abc",), ("3",)], "quantity string")
    assert [r.quantity for r in C.positive_quantity(q).collect()] == [3.0]


def test_k6_null_code_gets_null_max_and_zero_lag(spark):
    raw = raw_frame(spark, [("1", None, 2.0, "2020-01-05", 3.0, "c", "a"), ("2", "p", 1.0, "2020-01-05", 9.0, "c", "a")])
    p1 = FE.phase1(raw)
    r = p1.where(F.col("stockcode").isNull()).first()
    assert r.product_max_price_all_time is None
    assert r.product_avg_quantity_last_month == 0.0


def test_e1_lag_skips_gap_months(spark):
    raw = raw_frame(spark, [("1", "p", 2.0, "2020-01-05", 1.0, "c", "a"), ("2", "p", 5.0, "2020-01-20", 1.0, "c", "a"), ("3", "p", 1.0, "2020-03-02", 1.0, "c", "a")])
    out = {str(r.month): r.product_avg_quantity_last_month for r in FE.phase1(raw).select("month", "product_avg_quantity_last_month").distinct().collect()}
    assert out["2020-01-01"] == 0.0
    assert out["2020-03-01"] == 7.0  # March gets January's sum; February is absent


def test_k20_undated_row_counts_for_max_not_for_lag(spark):
    """A row with an unparsable date (NULL month) still belongs to the
    product's all-time max price, but its quantity never becomes a lag."""
    raw = raw_frame(
        spark,
        [
            ("1", "p", 50.0, None, 99.0, "c", "a"),
            ("2", "p", 2.0, "2020-01-05", 1.0, "c", "a"),
            ("3", "p", 3.0, "2020-02-05", 2.0, "c", "a"),
        ],
    )
    rows = FE.phase1(raw).select("invoiceno", "product_max_price_all_time", "product_avg_quantity_last_month").collect()
    got = {r.invoiceno: (r.product_max_price_all_time, r.product_avg_quantity_last_month) for r in rows}
    assert got == {"1": (99.0, 0.0), "2": (99.0, 0.0), "3": (99.0, 2.0)}


def test_d3_mode_smallest_on_ties_and_unknown(spark):
    rows = [("p", "a"), ("p", "a"), ("p", "b"), ("p", "b"), ("p", None), ("q", None)]
    df = spark.createDataFrame([(k, c, 1.0) for k, c in rows], "stockcode string, country string, unitprice double")
    got = {r.stockcode: r.imputed_country for r in FE.product_mode_median(df).collect()}
    assert got == {"p": "a", "q": "unknown"}


def test_k21_median_skips_nan(spark):
    df = spark.createDataFrame([("p", 1.0, "a"), ("p", 2.0, "a"), ("p", float("nan"), "a")], "stockcode string, unitprice double, country string")
    assert FE.product_mode_median(df).first().imputed_unitprice == 1.5


def test_k25_tie_goes_to_lower_price(spark):
    curve = spark.createDataFrame([("p", 2.0, 10.0), ("p", 1.0, 10.0), ("p", 3.0, 5.0)], "stockcode string, unit_price double, sales double")
    assert PR.optimal_price(curve).first().optimal_unit_price == 1.0


def _bounds(spark, stats, **kw):
    df = spark.createDataFrame(stats, "stockcode string, unitprice_min double, unitprice_median double, unitprice_max double")
    return {r.stockcode: (r.price_lo, r.price_hi) for r in PR.price_bounds(df, **kw).collect()}


def test_j1_price_bounds_rules(spark):
    got = _bounds(spark, [("none", None, None, None), ("low", 0.05, 3.0, 4.0), ("eq", 1.0, 1.0, 1.0)])
    assert got["none"] == (2.0, 20.0 * 5) or got["none"] == (2.0, 20.0)
    # no stats: [2, 20]; 20 - 2 >= 10 so no widening
    assert got["none"] == (2.0, 20.0)
    # min < 0.1 -> median 3 -> floor 3; 4 - 3 < 10 -> 4 * 5 = 20
    assert got["low"] == (3.0, 20.0)
    # equal at 1 -> lo = max(2, .9) = 2, hi = 1.6 -> widened x5 = 8
    assert got["eq"] == (2.0, 8.0)
    # equal at 1 with unitprice_max=1 given -> [2, 1.6], no swap, no widening
    eq = _bounds(spark, [("eq", 1.0, 1.0, 1.0)], unitprice_max=1.0)
    assert eq["eq"][0] == 2.0 and math.isclose(eq["eq"][1], 1.6)
    # params 30, 10 -> swapped
    assert _bounds(spark, [("x", 1.0, 2.0, 3.0)], unitprice_min=30.0, unitprice_max=10.0)["x"] == (10.0, 30.0)


def test_e4_split_sizes(spark):
    rows = [(k, i) for k, n in (("a", 4), ("b", 10), ("c", 10000)) for i in range(n)]
    df = spark.createDataFrame(rows, "stockcode string, t long")
    out = SP.ordered_split_by_product(df, ["t"]).groupBy("stockcode", "split").count().collect()
    got = {(r.stockcode, r.split): r["count"] for r in out}
    assert got[("a", "train")] == 4 and ("a", "test") not in got
    assert (got[("b", "test")], got[("b", "val")], got[("b", "train")]) == (2, 2, 6)
    assert (got[("c", "test")], got[("c", "val")], got[("c", "train")]) == (500, 500, 9000)
    # test rows are the last ones
    last = SP.ordered_split_by_product(df, ["t"]).where("stockcode = 'b' AND split = 'test'").agg(F.min("t")).first()[0]
    assert last == 8


def test_d14_absent_group_counts_as_zero(spark):
    pred = spark.createDataFrame([(1.0, 2.0, 1), (2.0, 2.5, 1)], "y_true double, y_pred double, is_registered int")
    gap = QU.fairness_gap(QU.fairness_group_metrics(pred)).first()
    assert gap.mae_unprivileged is None
    assert math.isclose(gap.mae_diff, -0.75)
    assert math.isclose(gap.mean_outcome_difference, -2.25)
    assert gap.is_mod_acceptable == 0


def test_j10_failover_is_per_product(spark):
    rows = [("p", 0, 1000.0, 1.0), ("p", 1, 1.0, 1.5), ("q", 0, 1.0, 9.0), ("q", 1, 2.0, 9.0)]
    df = spark.createDataFrame(rows, "stockcode string, bin int, y_primary double, y_backup double")
    got = {(r.stockcode, r.bin): r.y_pred for r in PR.score_failover(df).collect()}
    assert got[("p", 0)] == 1.0 and got[("p", 1)] == 1.5  # exp(1000) = Inf: whole product uses backup
    assert got[("q", 0)] == 1.0 and got[("q", 1)] == 2.0


def test_j11_flagship_equals_step_by_step_composition(spark):
    """The flagship's window form (grid kept on its product partitioning)
    gives the same table as J2 -> J10 -> D8 -> F3 joined back."""
    rows = []
    for i in range(40):
        rows.append((str(i), "p", float(1 + i % 5), f"2020-0{1 + i % 6}-0{1 + i % 9}", float(2 + (i % 7)), "c", "a"))
        rows.append((str(100 + i), "q", float(3 + i % 2), f"2020-0{1 + i % 3}-1{i % 9}", 4.0, "c", "b"))
    f = FE.transactions_features(raw_frame(spark, rows))
    got = sorted(PR.price_recommendation(f, num_price_bins=7).collect())
    stats = PR.price_stats(f)
    grid = PR.price_grid(PR.price_bounds(stats), 7)
    curve = PR.price_curve(PR.score_grid(grid, PR.demand_plane_by_product(f), PR.product_sample(f)))
    best = PR.optimal_price(curve)
    ref = curve.join(best, "stockcode").select(
        "stockcode",
        F.col("unit_price").alias("unit_price"),
        F.col("quantity_avg").cast("bigint").alias("quantity"),
        F.col("quantity_min").cast("bigint").alias("quantity_min"),
        F.col("quantity_max").cast("bigint").alias("quantity_max"),
        F.col("sales").alias("predicted_sales"),
        F.col("optimal_unit_price").alias("optimal_unit_price"),
        F.col("max_predicted_sales").alias("max_predicted_sales"),
    )
    assert len(got) == 14
    assert got == sorted(ref.collect())


def test_j11_samples_1200_rows_a_product(spark):
    """The reference scores 1,200 sampled rows at each price; a product with fewer rows gives all."""
    rows = [("hot", f"h{i}", float(i)) for i in range(1500)] + [("cold", f"c{i}", float(i)) for i in range(40)]
    f = spark.createDataFrame(rows, "stockcode string, invoiceno string, product_avg_quantity_last_month double").repartition(7)
    sample = PR.product_sample(f)
    assert sample._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 3  # bounded before each shuffle
    got = {}
    for r in sample.collect():
        got.setdefault(r.stockcode, []).append((r.sample_no, r.momentum))
    for product, size in (("hot", 1200), ("cold", 40)):
        want = sorted((hashlib.md5(f"{i}|42".encode()).hexdigest(), m) for p, i, m in rows if p == product)[:size]
        assert [n for n, _ in sorted(got[product])] == list(range(1, size + 1))
        assert all(math.isclose(m, math.log1p(w)) for (_, m), (_, w) in zip(sorted(got[product]), want, strict=True))


def test_corner_failover_is_the_failover_of_all_scored_rows(spark):
    """Overflow, underflow, missing fits and missing momenta of some products."""
    fits = {"ok": (-1.0, 0.1, 2.0), "over": (300.0, 1.0, 2.0), "under": (-400.0, 0.0, 1.0), "none": (None, 0.1, 1.0), "late": (0.0, 400.0, 1.0), "gap": (0.5, 0.1, 1.0)}
    per = spark.createDataFrame(
        [(p, 2.0, 20.0, *f, 0.5, 0.1, 1.0) for p, f in fits.items()],
        "stockcode string, price_lo double, price_hi double, slope double, momentum_weight double, intercept double, global_slope double, global_momentum_weight double, global_intercept double",
    )
    sample = spark.createDataFrame(
        [(p, i, float(i) / 2 if p != "gap" or i else None) for p in fits for i in range(5)], "stockcode string, sample_no int, momentum double"
    )
    for bins in (1, 7):
        flags = {r.stockcode: r.use_backup for r in PR.corner_failover(per, sample, bins).collect()}
        fit = [c for c in per.columns if "price" not in c and c != "stockcode"]
        rows = PR.price_grid(per.join(sample, "stockcode"), bins, carry=["sample_no", "momentum", *fit])
        scored = PR.score_failover(PR._predictions(rows))
        assert flags == {r.stockcode: r.use_backup for r in scored.select("stockcode", "use_backup").distinct().collect()}
        assert not flags["ok"] and flags["none"] and flags["gap"] and flags["late"]
        assert flags["under"] == flags["over"] == (bins > 1)  # the lowest price alone is harmless
