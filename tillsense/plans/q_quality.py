"""Registered plans: splits, encoding, quality gates, inference metrics,
fairness, attributions and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillsense.operators import drift as DR
from tillsense.operators import encoding as EN
from tillsense.operators import features as FE
from tillsense.operators import quality as QU
from tillsense.operators import splits as SP
from tillsense.plans.catalog import register, round_doubles
from tillsense.plans.q_core import OK, slim_features, stored_features
from tillsense.plans.sql import FEATURES, RETAIL, TOTAL_ORDER_SQL, q6, with_ctes
from tillsense.sources.retail import ORDER_KEYS, retail_transactions
from tillsense.sources.tables import cache_key, materialize, session_cache, table_path

TEST_FRACTION = 0.1  # global split: 10 % test, then 10 % of the rest for validation
DRIFT_CUTOFF = 899251200.0  # 1998-07-01 00:00:00 UTC: reference rows before, current rows after

NUM_COLS = [
    "invoicedate", "unitprice", "product_avg_quantity_last_month", "product_max_price_all_time",
    "unitprice_vs_max", "unitprice_to_avg", "unitprice_squared", "unitprice_log",
]
# drift leaves out identifiers, the group key and the calendar columns that define the cut
DRIFT_SKIP = {"invoiceno", "customerid", "stockcode", "invoicedate", "year", "year_month"}
CAT_COLS = ["invoiceno", "stockcode", "customerid", "country", "year", "year_month", "day_of_week", "is_registered"]

# literal weights of the linear scorer used to check attributions in SQL
ATTR_WEIGHTS = {"unitprice_log": -0.5, "unitprice_vs_max": 0.3, "product_avg_quantity_last_month": 0.0001, "unitprice_to_avg": -0.001}

# ---------------------------------------------------------------- SQL fragments
SPLIT_G_SQL = f""",
split_rank AS (SELECT *, row_number() OVER (ORDER BY {TOTAL_ORDER_SQL}) AS row_id, count(*) OVER () AS _n FROM features),
split_sizes AS (SELECT *, _n - CAST(ceil(_n * {TEST_FRACTION}) AS BIGINT) AS _tv FROM split_rank),
split_g AS (
  SELECT * EXCLUDE (_n, _tv),
         CASE WHEN row_id > _tv THEN 'test'
              WHEN row_id > _tv - CAST(ceil(_tv * {TEST_FRACTION}) AS BIGINT) THEN 'val' ELSE 'train' END AS split
  FROM split_sizes
)"""

SPLIT_P_SQL = f""",
pos_rank AS (
  SELECT *, row_number() OVER (PARTITION BY stockcode ORDER BY {TOTAL_ORDER_SQL}) AS pos,
         count(*) OVER (PARTITION BY stockcode) AS _n FROM features
),
split_p AS (
  SELECT * EXCLUDE (_n, _size),
         CASE WHEN pos > _n - _size THEN 'test' WHEN pos > _n - 2 * _size THEN 'val' ELSE 'train' END AS split
  FROM (SELECT *, CAST(floor(least(_n * 0.2, 500.0)) AS BIGINT) AS _size FROM pos_rank)
)"""

# J3 fitted on the train rows of the per-product split, scored on its test rows
INFER_SQL = SPLIT_P_SQL + """,
tfit AS (
  SELECT stockcode, regr_slope(quantity, unitprice_log) AS slope, regr_intercept(quantity, unitprice_log) AS intercept,
         regr_count(quantity, unitprice_log) AS n_obs, regr_sxx(quantity, unitprice_log) AS sxx
  FROM split_p WHERE split = 'train' GROUP BY stockcode
),
tglob AS (
  SELECT regr_slope(quantity, unitprice_log) AS gs, regr_intercept(quantity, unitprice_log) AS gi FROM split_p WHERE split = 'train'
),
inference AS (
  SELECT s.*, s.quantity AS y_true,
         CASE WHEN f.n_obs >= 2 AND f.sxx > 0 THEN f.intercept + f.slope * ln(1 + s.unitprice)
              ELSE g.gi + g.gs * ln(1 + s.unitprice) END AS y_pred
  FROM split_p s LEFT JOIN tfit f ON s.stockcode = f.stockcode CROSS JOIN tglob g
  WHERE s.split = 'test'
)"""


_SPLITS: dict = session_cache()


def _stored_split(spark, sf_dir, kind):
    """Split tables are written once per session and data folder, in the stored form of
    feature rows (the reference writes its split tables too); fits and scores read them."""
    key = (*cache_key(spark, sf_dir), kind)
    if key not in _SPLITS:
        f = slim_features(spark, sf_dir)
        if kind == "global":
            s = SP.ordered_split_global(f, SP.total_order(f), TEST_FRACTION, TEST_FRACTION)
        else:
            s = SP.ordered_split_by_product(f, SP.total_order(f))
        _SPLITS[key] = materialize(s, f"split_{kind}")
    return _SPLITS[key]


def split_global(spark, sf_dir):
    return FE.with_derived(_stored_split(spark, sf_dir, "global"))


def split_product(spark, sf_dir):
    return FE.with_derived(_stored_split(spark, sf_dir, "product"))


def encoded(spark, sf_dir, m, keep):
    """The global split's rows encoded by ``m``; they cross the joins with the large
    dictionaries without the columns that follow from others of their row."""
    s = _stored_split(spark, sf_dir, "global")
    return EN.transform(s.withColumn("row_id", F.col("row_id").cast("bigint")), m, keep, FE.with_derived)


def inference_results(spark, sf_dir, *carried):
    """Per-product demand line fitted on train rows, scored on test
    rows; prediction, truth and the sensitive flag stay on one row.
    Products without a usable line (or without train rows) use the overall
    line (a scalar subquery)."""
    from tillsense.operators import pricing as PR

    sp = split_product(spark, sf_dir)
    train = sp.where(F.col("split") == "train")
    model = PR.demand_model_by_product(train).select("stockcode", "slope", "intercept", "uses_global")
    g = PR.global_line(train)
    lx = F.log1p(F.col("unitprice"))
    usable = F.coalesce(~F.col("uses_global"), F.lit(False))
    pred = F.when(usable, F.col("intercept") + F.col("slope") * lx).otherwise(g.getField("intercept") + g.getField("slope") * lx)
    test = sp.where(F.col("split") == "test")
    return test.join(model, "stockcode", "left").select(
        *ORDER_KEYS, "stockcode", F.col("quantity").alias("y_true"), pred.alias("y_pred"), "is_registered", *carried
    )


# ================================================================ E3/E4/G2/A8: splits
@register("ordered_split_global", with_ctes(FEATURES + SPLIT_G_SQL, f"SELECT row_id, split, {OK} FROM split_g"))
def q_ordered_split_global(spark, sf_dir):
    return split_global(spark, sf_dir).select(F.col("row_id").cast("bigint"), "split", *ORDER_KEYS)


_ROWS = SP.GLOBAL_SPLIT_ROWS


@register(
    "ordered_split_rows",
    with_ctes(
        FEATURES + f",\nnumbered AS (SELECT *, row_number() OVER (ORDER BY {TOTAL_ORDER_SQL}) AS row_id, count(*) OVER () AS n FROM features)",
        f"SELECT row_id, CASE WHEN row_id > n - {_ROWS} THEN 'test' WHEN row_id > n - 2 * {_ROWS} THEN 'val' ELSE 'train' END AS split, {OK} FROM numbered",
    ),
)
def q_ordered_split_rows(spark, sf_dir):
    """The global split in its row-count form: 50,000 rows each for test and validation."""
    f = slim_features(spark, sf_dir)
    s = SP.ordered_split_global(f, SP.total_order(f), SP.GLOBAL_SPLIT_ROWS, SP.GLOBAL_SPLIT_ROWS)
    return s.select(F.col("row_id").cast("bigint"), "split", *ORDER_KEYS)


@register("ordered_split_by_product", with_ctes(FEATURES + SPLIT_P_SQL, f"SELECT stockcode, pos, split, {OK} FROM split_p"))
def q_ordered_split_by_product(spark, sf_dir):
    return split_product(spark, sf_dir).select("stockcode", F.col("pos").cast("bigint"), "split", *ORDER_KEYS)


@register("union_train_val", with_ctes(FEATURES + SPLIT_G_SQL, f"SELECT row_id, split, {OK} FROM split_g WHERE split IN ('train', 'val')"))
def q_union_train_val(spark, sf_dir):
    return SP.union_train_val(split_global(spark, sf_dir)).select(F.col("row_id").cast("bigint"), "split", *ORDER_KEYS)


@register("write_splits", with_ctes(FEATURES + SPLIT_G_SQL, f"SELECT row_id, split, {OK} FROM split_g"))
def q_write_splits(spark, sf_dir):
    from tillsense.sources.sinks import write_splits

    s = split_global(spark, sf_dir).select(F.col("row_id").cast("bigint"), "split", *ORDER_KEYS)
    return write_splits(s)


# ================================================================ I: encoding
def _fitted(spark, sf_dir):
    s = split_global(spark, sf_dir)
    s = s.withColumn("row_id", F.col("row_id").cast("bigint"))
    train = s.where(F.col("split") == "train")
    return s, EN.fit_column_transform(train, NUM_COLS, CAT_COLS, order_col="row_id")


_TRAIN = "(SELECT * FROM split_g WHERE split = 'train')"
_MED_SQL = ",\nmed AS (SELECT column_name, median(value) AS median FROM (UNPIVOT (SELECT " + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" for c in NUM_COLS
) + f" FROM {_TRAIN}) ON {', '.join(NUM_COLS)} INTO NAME column_name VALUE value) GROUP BY column_name)"
_SCALE_SQL = ",\nscale AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, avg(v) AS mean, stddev_pop(v) AS std FROM (SELECT coalesce(CAST(t.{c} AS DOUBLE), (SELECT median FROM med WHERE column_name = '{c}')) AS v FROM {_TRAIN} t)"
    for c in NUM_COLS
) + ")"
_ORD_SQL = ",\nfirsts AS (SELECT column_name, category, min(row_id) AS first_pos FROM (UNPIVOT (SELECT row_id, " + ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" for c in CAT_COLS
) + f" FROM {_TRAIN}) ON {', '.join(CAT_COLS)} INTO NAME column_name VALUE category) GROUP BY column_name, category),\n" + """ords AS (
  SELECT column_name, category, row_number() OVER (PARTITION BY column_name ORDER BY first_pos) AS ordinal,
         count(*) OVER (PARTITION BY column_name) AS n_categories FROM firsts
),
digits AS (
  SELECT column_name, CASE WHEN max(n_categories) <= 1 THEN 1 ELSE CAST(ceil(log2(max(n_categories))) AS INTEGER) + 1 END AS n_digits
  FROM ords GROUP BY column_name
)"""
_ENC = FEATURES + SPLIT_G_SQL + _MED_SQL + _SCALE_SQL + _ORD_SQL


@register("impute_median", with_ctes(_ENC, f"SELECT column_name, {q6('median')} AS median FROM med"))
def q_impute_median(spark, sf_dir):
    s = split_global(spark, sf_dir)
    return round_doubles(EN.fit_medians(s.where(F.col("split") == "train"), NUM_COLS))


@register("standardize", with_ctes(_ENC, f"SELECT column_name, {q6('mean', 2)} AS mean, {q6('std', 2)} AS std FROM scale"))
def q_standardize(spark, sf_dir):
    s = split_global(spark, sf_dir)
    train = s.where(F.col("split") == "train")
    med = {r["column_name"]: r["median"] for r in EN.fit_medians(train, NUM_COLS).collect()}
    # epoch seconds and squared prices are up to 1e10: two decimals
    return round_doubles(EN.fit_scaling(train, NUM_COLS, med), {"mean": 2, "std": 2})


@register(
    "binary_encode",
    with_ctes(
        _ENC,
        "SELECT o.column_name, o.category, o.ordinal, d.n_digits, lpad(bin(o.ordinal), d.n_digits, '0') AS bits "
        "FROM ords o JOIN digits d ON o.column_name = d.column_name",
    ),
)
def q_binary_encode(spark, sf_dir):
    _, m = _fitted(spark, sf_dir)
    d = F.lit(None).cast("int")
    for c, k in m.digits.items():
        d = F.when(F.col("column_name") == c, F.lit(k)).otherwise(d)
    o = m.ordinals.withColumn("n_digits", d)
    return o.select(
        "column_name", "category", F.col("ordinal").cast("bigint"), "n_digits",
        F.lpad(F.bin(F.col("ordinal")), F.col("n_digits"), F.lit("0")).alias("bits"),
    )


@register(
    "extended_dictionary",
    with_ctes(
        FEATURES + SPLIT_G_SQL + ",\nfirsts AS (SELECT column_name, category, min(row_id) AS first_pos, min(CASE WHEN split = 'train' THEN 0 ELSE 1 END) AS late FROM (UNPIVOT (SELECT row_id, split, "
        + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in CAT_COLS)
        + f" FROM split_g) ON {', '.join(CAT_COLS)} INTO NAME column_name VALUE category) GROUP BY column_name, category)",
        "SELECT column_name, category, row_number() OVER (PARTITION BY column_name ORDER BY late, first_pos) AS ordinal FROM firsts",
    ),
)
def q_extended_dictionary(spark, sf_dir):
    """The dictionary of the train rows, extended by the later ones: old ordinals stay."""
    s = split_global(spark, sf_dir).withColumn("row_id", F.col("row_id").cast("bigint"))
    path = table_path(s, "dictionary")
    EN.extend_dictionary(s.where(F.col("split") == "train"), CAT_COLS, path, "train")
    return EN.extend_dictionary(s.where(F.col("split") != "train"), CAT_COLS, path, "later")


def _bits_sql(c: str) -> str:
    return (
        f"CASE WHEN o_{c}.ordinal IS NULL THEN repeat('0', (SELECT n_digits FROM digits WHERE column_name = '{c}')) "
        f"ELSE lpad(bin(o_{c}.ordinal), (SELECT n_digits FROM digits WHERE column_name = '{c}'), '0') END AS cat__{c}"
    )


def _num_sql(c: str) -> str:
    m = f"(SELECT median FROM med WHERE column_name = '{c}')"
    mean = f"(SELECT mean FROM scale WHERE column_name = '{c}')"
    sd = f"(SELECT CASE WHEN std IS NULL OR std = 0 THEN 1.0 ELSE std END FROM scale WHERE column_name = '{c}')"
    return q6(f"(coalesce(CAST(s.{c} AS DOUBLE), {m}) - {mean}) / {sd}") + f" AS num__{c}"


@register(
    "column_transform",
    with_ctes(
        _ENC,
        "SELECT s.row_id, s.split, " + ", ".join(_num_sql(c) for c in NUM_COLS) + ", " + ", ".join(_bits_sql(c) for c in CAT_COLS)
        + " FROM split_g s "
        + " ".join(f"LEFT JOIN (SELECT category, ordinal FROM ords WHERE column_name = '{c}') o_{c} ON CAST(s.{c} AS VARCHAR) = o_{c}.category" for c in CAT_COLS),
    ),
)
def q_column_transform(spark, sf_dir):
    _, m = _fitted(spark, sf_dir)
    mat = encoded(spark, sf_dir, m, ["row_id", "split"])
    bits = [F.concat(*[F.col(f"cat__{c}_{k}").cast("int").cast("string") for k in range(m.digits[c])]).alias(f"cat__{c}") for c in CAT_COLS]
    return round_doubles(mat.select("row_id", "split", *[f"num__{c}" for c in NUM_COLS], *bits))


@register(
    "scale_target",
    with_ctes(
        FEATURES + SPLIT_G_SQL + ",\nyst AS (SELECT avg(quantity) AS m, stddev_pop(quantity) AS s FROM split_g WHERE split = 'train')",
        "SELECT row_id, split, " + q6("(quantity - yst.m) / CASE WHEN yst.s IS NULL OR yst.s = 0 THEN 1.0 ELSE yst.s END") + " AS quantity_scaled FROM split_g CROSS JOIN yst",
    ),
)
def q_scale_target(spark, sf_dir):
    s = EN.scale_target(split_global(spark, sf_dir))
    return round_doubles(s.select(F.col("row_id").cast("bigint"), "split", "quantity_scaled"))


# ================================================================ D9-D11: gates and profiles
_GATE_COLS = [c for c in (NUM_COLS + CAT_COLS + ["quantity"])]
_DOUBLE_COLS = set(NUM_COLS + ["quantity"])


def _missing_sql(cols, table, doubles):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL{' OR isnan(' + c + ')' if c in doubles else ''}) AS BIGINT) AS n_missing FROM {table}" for c in cols
    )


@register(
    "quality_gate_nulls",
    with_ctes(
        FEATURES + ",\nprof AS (" + _missing_sql(_GATE_COLS, "features", _DOUBLE_COLS) + ")",
        "SELECT column_name, CASE WHEN column_name = 'quantity' THEN 'y' ELSE 'X' END AS part, n_missing, n_missing > 0 AS is_blocking FROM prof",
    ),
)
def q_quality_gate_nulls(spark, sf_dir):
    f = stored_features(spark, sf_dir).select(*_GATE_COLS)
    return QU.quality_gate_nulls(f, "quantity")


@register(
    "quality_gate_nonfinite",
    with_ctes(
        _ENC + ",\nmatrix AS (SELECT " + ", ".join(_num_sql(c) for c in NUM_COLS) + " FROM split_g s)",
        " UNION ALL ".join(f"SELECT 'num__{c}' AS column_name, CAST(count_if(isnan(num__{c})) AS BIGINT) AS n_nan, CAST(count_if(isinf(num__{c})) AS BIGINT) AS n_inf FROM matrix" for c in NUM_COLS),
    ),
)
def q_quality_gate_nonfinite(spark, sf_dir):
    _, m = _fitted(spark, sf_dir)
    mat = round_doubles(encoded(spark, sf_dir, m, ["row_id"]))
    return QU.quality_gate_nonfinite(mat, [f"num__{c}" for c in NUM_COLS])


# every numeric column and one digit of a category are made non-finite in some rows
_POISON = {f"num__{c}": 997 + i for i, c in enumerate(NUM_COLS)} | {"cat__is_registered_0": 500}


@register(
    "nonfinite_positions",
    with_ctes(
        FEATURES + SPLIT_G_SQL,
        "SELECT row_id, column_name FROM (" + " UNION ALL ".join(f"SELECT row_id, '{c}' AS column_name, {i} AS place FROM split_g WHERE row_id % {m} = 0" for i, (c, m) in enumerate(_POISON.items()))
        + ") ORDER BY row_id, place LIMIT 5",
    ),
)
def q_nonfinite_positions(spark, sf_dir):
    """The first five non-finite cells of the whole encoded matrix, in the order of
    its rows and columns, after some cells were made NaN or infinite."""
    _, m = _fitted(spark, sf_dir)
    mat = encoded(spark, sf_dir, m, ["row_id"])
    hit = {c: F.col("row_id") % k == 0 for c, k in _POISON.items()}
    mat = mat.withColumns({c: F.when(h, F.lit(float("nan") if i % 2 else float("-inf"))).otherwise(F.col(c)) for i, (c, h) in enumerate(hit.items())})
    # the matrix is a stored table, as in a model's input
    return QU.nonfinite_positions(materialize(mat, "poisoned_matrix"), m.output_columns()).select("row_id", "column_name")


@register(
    "missing_profile",
    with_ctes(RETAIL, _missing_sql(["invoiceno", "stockcode", "quantity", "invoicedate", "unitprice", "customerid", "country"], "retail", {"quantity", "unitprice"})),
)
def q_missing_profile(spark, sf_dir):
    r = retail_transactions(spark, sf_dir).select("invoiceno", "stockcode", "quantity", "invoicedate", "unitprice", "customerid", "country")
    return QU.missing_profile(r)


# ================================================================ C6, D12-D14: inference, metrics, fairness
@register(
    "align_predictions",
    with_ctes(FEATURES + INFER_SQL, f"SELECT {OK}, stockcode, {q6('y_true')} AS y_true, {q6('y_pred')} AS y_pred, is_registered FROM inference"),
)
def q_align_predictions(spark, sf_dir):
    return round_doubles(inference_results(spark, sf_dir))


_METRICS_SQL = (
    "count(*) AS n_rows, " + q6("avg(pow(y_true - y_pred, 2))") + " AS mse, "
    + q6("avg(abs(exp(least(y_true, 10.0)) - exp(least(y_pred, 10.0))))") + " AS mae, "
    + q6("sqrt(avg(pow(ln(1 + exp(least(y_true, 10.0))) - ln(1 + exp(least(y_pred, 10.0))), 2)))") + " AS rmsle"
)


@register("regression_metrics", with_ctes(FEATURES + INFER_SQL, f"SELECT {_METRICS_SQL} FROM inference"))
def q_regression_metrics(spark, sf_dir):
    return round_doubles(QU.regression_metrics(inference_results(spark, sf_dir)))


_FAIR_SQL = """,
fgroups AS (
  SELECT stockcode, is_registered, count(*) AS n_rows, avg(pow(y_true - y_pred, 2)) AS mse, avg(abs(y_true - y_pred)) AS mae,
         CASE WHEN min(least(y_true, y_pred)) > -1 THEN sqrt(avg(pow(ln(1 + y_true) - ln(1 + y_pred), 2))) END AS rmsle,
         avg(y_pred) AS mean_prediction
  FROM inference GROUP BY stockcode, is_registered
),
fgap AS (
  SELECT stockcode,
         max(CASE WHEN is_registered = 0 THEN mse END) AS mse_unprivileged, max(CASE WHEN is_registered = 0 THEN mae END) AS mae_unprivileged,
         max(CASE WHEN is_registered = 0 THEN rmsle END) AS rmsle_unprivileged, max(CASE WHEN is_registered = 0 THEN mean_prediction END) AS mean_prediction_unprivileged,
         max(CASE WHEN is_registered = 1 THEN mse END) AS mse_privileged, max(CASE WHEN is_registered = 1 THEN mae END) AS mae_privileged,
         max(CASE WHEN is_registered = 1 THEN rmsle END) AS rmsle_privileged, max(CASE WHEN is_registered = 1 THEN mean_prediction END) AS mean_prediction_privileged
  FROM fgroups GROUP BY stockcode
)"""
_GAP_COLS = [f"{m}_{g}" for g in ("unprivileged", "privileged") for m in ("mse", "mae", "rmsle", "mean_prediction")]


@register(
    "fairness_group_metrics",
    with_ctes(FEATURES + INFER_SQL + _FAIR_SQL, "SELECT stockcode, is_registered, n_rows, " + ", ".join(f"{q6(c)} AS {c}" for c in ["mse", "mae", "rmsle", "mean_prediction"]) + " FROM fgroups"),
)
def q_fairness_group_metrics(spark, sf_dir):
    return round_doubles(QU.fairness_group_metrics(inference_results(spark, sf_dir), group=["stockcode"]))


@register(
    "fairness_gap",
    with_ctes(
        FEATURES + INFER_SQL + _FAIR_SQL,
        "SELECT stockcode, " + ", ".join(f"{q6(c)} AS {c}" for c in _GAP_COLS) + ", "
        + q6("coalesce(mae_unprivileged, 0.0) - coalesce(mae_privileged, 0.0)") + " AS mae_diff, "
        + q6("coalesce(mean_prediction_unprivileged, 0.0) - coalesce(mean_prediction_privileged, 0.0)") + " AS mean_outcome_difference, "
        "CAST(abs(coalesce(mean_prediction_unprivileged, 0.0) - coalesce(mean_prediction_privileged, 0.0)) <= 0.1 AS INTEGER) AS is_mod_acceptable, "
        "'is_registered' AS sensitive_feature, 1 AS privileged_group, CAST(0.1 AS DOUBLE) AS mod_threshold FROM fgap",
    ),
)
def q_fairness_gap(spark, sf_dir):
    g = QU.fairness_group_metrics(inference_results(spark, sf_dir), group=["stockcode"])
    return round_doubles(QU.fairness_gap(g, group=["stockcode"]))


# ================================================================ J13, C7, D15, F6, F5: attributions, rankings
_AF = list(ATTR_WEIGHTS)


def _attributions(spark, sf_dir):
    sp = split_product(spark, sf_dir)
    rows = sp.where(F.col("split") == "test")
    background = sp.where(F.col("split") == "train")
    return QU.linear_attribution(rows, background, ATTR_WEIGHTS, keys=[*ORDER_KEYS, "stockcode"], group=["stockcode"])


_ATTR_SQL = (
    SPLIT_P_SQL
    + ",\nbg AS (SELECT stockcode, "
    + ", ".join(f"avg({c}) AS m_{c}" for c in _AF)
    + " FROM split_p WHERE split = 'train' GROUP BY stockcode),\n"
    + "attr AS (SELECT s.*, "
    + ", ".join(f"CAST({ATTR_WEIGHTS[c]} AS DOUBLE) * (s.{c} - bg.m_{c}) AS shap_{c}" for c in _AF)
    + " FROM split_p s LEFT JOIN bg ON s.stockcode = bg.stockcode WHERE s.split = 'test'),\n"
    + "attr_long AS ("
    + " UNION ALL ".join(f"SELECT {OK}, stockcode, '{c}' AS feature_name, shap_{c} AS shap_value, CAST({c} AS DOUBLE) AS feature_value FROM attr" for c in _AF)
    + ")"
)


@register(
    "linear_attribution",
    with_ctes(FEATURES + _ATTR_SQL, f"SELECT {OK}, stockcode, " + ", ".join(f"{q6(c)} AS {c}, {q6('shap_' + c)} AS shap_{c}" for c in _AF) + " FROM attr"),
)
def q_linear_attribution(spark, sf_dir):
    return round_doubles(_attributions(spark, sf_dir))


@register(
    "align_attributions",
    with_ctes(FEATURES + _ATTR_SQL, f"SELECT {OK}, stockcode, feature_name, {q6('shap_value')} AS shap_value, {q6('feature_value')} AS feature_value FROM attr_long"),
)
def q_align_attributions(spark, sf_dir):
    return round_doubles(QU.align_attributions(_attributions(spark, sf_dir), _AF, [*ORDER_KEYS, "stockcode"]))


@register(
    "mean_abs_attribution",
    with_ctes(FEATURES + _ATTR_SQL, f"SELECT feature_name, {q6('avg(abs(shap_value))')} AS mean_abs_shap FROM attr_long GROUP BY feature_name"),
)
def q_mean_abs_attribution(spark, sf_dir):
    long = QU.align_attributions(_attributions(spark, sf_dir), _AF, [*ORDER_KEYS, "stockcode"])
    return round_doubles(QU.mean_abs_attribution(long))


@register(
    "rank_features",
    with_ctes(
        FEATURES + _ATTR_SQL,
        f"SELECT feature_name, {q6('avg(abs(shap_value))')} AS mean_abs_shap FROM attr_long GROUP BY feature_name ORDER BY avg(abs(shap_value)) DESC, feature_name",
    ),
)
def q_rank_features(spark, sf_dir):
    long = QU.align_attributions(_attributions(spark, sf_dir), _AF, [*ORDER_KEYS, "stockcode"])
    return round_doubles(QU.rank_features(QU.mean_abs_attribution(long)))


# metric history: one record per (product, year) of the inference rows; newest per product
_HIST_SQL = """,
history AS (
  SELECT i.stockcode, f.year AS timestamp, count(*) AS n_rows, avg(pow(i.y_true - i.y_pred, 2)) AS mse
  FROM inference i JOIN features f USING (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)
  GROUP BY i.stockcode, f.year
)"""


def _history(spark, sf_dir):
    return inference_results(spark, sf_dir, "year").groupBy("stockcode", F.col("year").alias("timestamp")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(F.pow(F.col("y_true") - F.col("y_pred"), 2)).alias("mse")
    )


@register(
    "latest_metrics",
    with_ctes(
        FEATURES + INFER_SQL + _HIST_SQL,
        f"SELECT stockcode, timestamp, n_rows, {q6('mse')} AS mse FROM (SELECT *, row_number() OVER (PARTITION BY stockcode ORDER BY timestamp DESC) AS rn FROM history) WHERE rn = 1",
    ),
)
def q_latest_metrics(spark, sf_dir):
    return round_doubles(QU.latest_metrics(_history(spark, sf_dir)))


# ================================================================ L: drift
DRIFT_NUM = [c for c in NUM_COLS if c not in DRIFT_SKIP]
DRIFT_CAT = [c for c in CAT_COLS if c not in DRIFT_SKIP]


def _drift_sides(spark, sf_dir):
    f = stored_features(spark, sf_dir)
    return f.where(F.col("invoicedate") < DRIFT_CUTOFF), f.where(F.col("invoicedate") >= DRIFT_CUTOFF)


def _unpivot_sql(src: str, cols: list[str], cast: str, ref: bool) -> str:
    flags = "1 AS c_ref, 0 AS c_cur" if ref else "0 AS c_ref, 1 AS c_cur"
    parts = [f"SELECT stockcode, '{c}' AS column_name, CAST({c} AS {cast}) AS value, {flags} FROM {src}" for c in cols]
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE value IS NOT NULL"


_DRIFT_SQL = f""",
dref AS (SELECT * FROM features WHERE invoicedate < {DRIFT_CUTOFF}),
dcur AS (SELECT * FROM features WHERE invoicedate >= {DRIFT_CUTOFF}),
ncounts AS (
  SELECT stockcode, column_name, value, CAST(sum(c_ref) AS BIGINT) AS c_ref, CAST(sum(c_cur) AS BIGINT) AS c_cur FROM (
    {_unpivot_sql('dref', DRIFT_NUM, 'DOUBLE', True)} UNION ALL {_unpivot_sql('dcur', DRIFT_NUM, 'DOUBLE', False)}
  ) WHERE NOT isnan(value) GROUP BY stockcode, column_name, value
),
cdf AS (
  SELECT *, sum(c_ref) OVER w AS cum_ref, sum(c_cur) OVER w AS cum_cur, row_number() OVER w AS rank,
         CAST(sum(c_ref) OVER (PARTITION BY stockcode, column_name) AS BIGINT) AS n_ref, CAST(sum(c_cur) OVER (PARTITION BY stockcode, column_name) AS BIGINT) AS n_cur
  FROM ncounts WINDOW w AS (PARTITION BY stockcode, column_name ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
cdf2 AS (SELECT *, cum_ref / n_ref AS F_ref, cum_cur / n_cur AS F_cur FROM cdf),
ks AS (
  SELECT stockcode, column_name, max(abs(F_ref - F_cur)) AS ks_stat, max(n_ref) AS n_ref, max(n_cur) AS n_cur
  FROM cdf2 GROUP BY stockcode, column_name
),
ks2 AS (
  SELECT *, CASE WHEN n_ref > 0 AND n_cur > 0 THEN ks_stat > {DR.KS_ALPHA_COEF} * sqrt((n_ref + n_cur) / (n_ref * n_cur)) END AS ks_drift FROM ks
),
steps AS (
  SELECT a.*, b.value AS next_value FROM cdf2 a
  LEFT JOIN cdf2 b ON a.stockcode = b.stockcode AND a.column_name = b.column_name AND b.rank = a.rank + 1
),
refstd AS (
  SELECT stockcode, column_name, stddev_pop(value) AS ref_std FROM ({_unpivot_sql('dref', DRIFT_NUM, 'DOUBLE', True)})
  WHERE NOT isnan(value) GROUP BY stockcode, column_name
),
w1 AS (
  SELECT s.stockcode, s.column_name, coalesce(sum(abs(F_ref - F_cur) * (next_value - value)), 0.0) AS w1,
         max(n_ref) AS n_ref, max(n_cur) AS n_cur
  FROM steps s GROUP BY s.stockcode, s.column_name
),
w2 AS (
  SELECT w1.*, r.ref_std,
         CASE WHEN w1.n_ref > 0 AND w1.n_cur > 0 THEN w1.w1 / greatest(r.ref_std, {DR.WASSERSTEIN_MIN_STD}) END AS w1_norm
  FROM w1 LEFT JOIN refstd r ON w1.stockcode = r.stockcode AND w1.column_name = r.column_name
),
w3 AS (SELECT *, w1_norm >= {DR.WASSERSTEIN_THRESHOLD} AS w1_drift FROM w2),
ccounts AS (
  SELECT stockcode, column_name, value, CAST(sum(c_ref) AS BIGINT) AS c_ref, CAST(sum(c_cur) AS BIGINT) AS c_cur FROM (
    {_unpivot_sql('dref', DRIFT_CAT, 'VARCHAR', True)} UNION ALL {_unpivot_sql('dcur', DRIFT_CAT, 'VARCHAR', False)}
  ) GROUP BY stockcode, column_name, value
),
ctot AS (SELECT stockcode, column_name, CAST(sum(c_ref) AS BIGINT) AS n_ref, CAST(sum(c_cur) AS BIGINT) AS n_cur FROM ccounts GROUP BY stockcode, column_name),
cshares AS (
  SELECT c.stockcode, c.column_name, c.c_ref, c.c_cur, c.c_ref / t.n_ref AS p, c.c_cur / t.n_cur AS q, t.n_ref, t.n_cur
  FROM ccounts c JOIN ctot t ON c.stockcode = t.stockcode AND c.column_name = t.column_name
  WHERE t.n_ref > 0 AND t.n_cur > 0
),
js AS (
  SELECT stockcode, column_name,
         sqrt(greatest(sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0.0 END
                        + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0.0 END) / 2, 0.0)) AS js_distance,
         max(n_ref) AS n_ref, max(n_cur) AS n_cur, count(*) - 1 AS df,
         greatest((max(n_ref) + max(n_cur)) * (sum(c_ref * c_ref / (n_ref * (c_ref + c_cur)) + c_cur * c_cur / (n_cur * (c_ref + c_cur))) - 1), 0.0) AS chi2
  FROM cshares GROUP BY stockcode, column_name
),
js2 AS (
  SELECT *, js_distance >= {DR.JS_THRESHOLD} AS js_drift,
         CASE WHEN df > 0 THEN chi2 > df * pow(1 - 2.0 / (df * 9) + {DR.CHI2_Z} * sqrt(2.0 / (df * 9)), 3) ELSE false END AS chi2_drift
  FROM js
),
dcols AS (
  SELECT k.stockcode, k.column_name, 'numeric' AS role,
         'ks' AS test, k.ks_stat AS statistic, w.w1_norm AS other_statistic, coalesce(k.ks_drift, false) AS drifted
  FROM ks2 k JOIN w3 w ON k.stockcode = w.stockcode AND k.column_name = w.column_name
  WHERE k.n_ref > 0 AND k.n_cur > 0
  UNION ALL
  SELECT stockcode, column_name, 'categorical', 'chi2', chi2, js_distance, coalesce(chi2_drift, false) FROM js2
),
dsum AS (
  SELECT stockcode, CAST(count_if(drifted) AS BIGINT) AS num_drifts, count(*) AS n_columns FROM dcols GROUP BY stockcode
)"""


@register(
    "drift_numeric_ks",
    with_ctes(FEATURES + _DRIFT_SQL, f"SELECT stockcode, column_name, {q6('ks_stat')} AS ks_stat, n_ref, n_cur, ks_drift FROM ks2"),
)
def q_drift_numeric_ks(spark, sf_dir):
    ref, cur = _drift_sides(spark, sf_dir)
    return round_doubles(DR.drift_numeric_ks(ref, cur, DRIFT_NUM))


@register(
    "drift_numeric_wasserstein",
    with_ctes(FEATURES + _DRIFT_SQL, f"SELECT stockcode, column_name, {q6('w1', 0)} AS w1, n_ref, n_cur, {q6('ref_std', 0)} AS ref_std, {q6('w1_norm')} AS w1_norm, w1_drift FROM w3"),
)
def q_drift_numeric_wasserstein(spark, sf_dir):
    ref, cur = _drift_sides(spark, sf_dir)
    # raw distances are in squared prices, up to 1e10: whole numbers; the normed one has all decimals
    return round_doubles(DR.drift_numeric_wasserstein(ref, cur, DRIFT_NUM), {"w1": 0, "ref_std": 0})


@register(
    "drift_categorical_js",
    with_ctes(FEATURES + _DRIFT_SQL, f"SELECT stockcode, column_name, {q6('js_distance')} AS js_distance, n_ref, n_cur, js_drift, {q6('chi2')} AS chi2, chi2_drift FROM js2"),
)
def q_drift_categorical_js(spark, sf_dir):
    ref, cur = _drift_sides(spark, sf_dir)
    return round_doubles(DR.drift_categorical_js(ref, cur, DRIFT_CAT))


_SUMMARY_SEL = (
    "SELECT stockcode, num_drifts > 0 AS drift_detected, num_drifts, "
    + q6("num_drifts / n_columns")
    + f" AS shared_drifts, n_columns, '{','.join(DRIFT_NUM)}' AS num_cols, '{','.join(DRIFT_CAT)}' AS cat_cols FROM dsum"
)


def _summary(spark, sf_dir):
    ref, cur = _drift_sides(spark, sf_dir)
    cols = DR.drift_columns(ref, cur, DRIFT_NUM, DRIFT_CAT)
    return DR.drift_summary(cols, DRIFT_NUM, DRIFT_CAT)


@register("drift_summary", with_ctes(FEATURES + _DRIFT_SQL, _SUMMARY_SEL))
def q_drift_summary(spark, sf_dir):
    return round_doubles(_summary(spark, sf_dir))


@register("drift_report", with_ctes(FEATURES + _DRIFT_SQL, f"SELECT stockcode, column_name, role, test, {q6('statistic')} AS statistic, {q6('other_statistic')} AS other_statistic, drifted FROM dcols"))
def q_drift_report(spark, sf_dir):
    ref, cur = _drift_sides(spark, sf_dir)
    return round_doubles(DR.drift_columns(ref, cur, DRIFT_NUM, DRIFT_CAT))


@register("drift_gate", with_ctes(FEATURES + _DRIFT_SQL, f"SELECT stockcode, num_drifts FROM dsum WHERE num_drifts > 0"))
def q_drift_gate(spark, sf_dir):
    """L5 as a report: the products whose pipeline the gate stops
    (``drift.drift_gate`` raises on the same summary)."""
    s = _summary(spark, sf_dir)
    return s.where(F.col("drift_detected")).select("stockcode", "num_drifts")
