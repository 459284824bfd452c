"""Registered plans: sources, cleaning, features, joins, aggregates,
windows, sorts, set operations, scalar functions and pricing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillsense.functions.exprs import epoch_seconds, is_nonfinite, linspace_point, round6
from tillsense.operators import cleaning as C
from tillsense.operators import features as FE
from tillsense.operators import imputation as IM
from tillsense.operators import pricing as PR
from tillsense.operators.ranking import running_total
from tillsense.operators.splits import total_order
from tillsense.plans.catalog import register, round_doubles
from tillsense.plans.sql import (
    FEATURES,
    FEATURE_DOUBLES,
    PHASE1_ONLY,
    PHASE2_ROWS,
    PRICING,
    RETAIL,
    TOTAL_ORDER_SQL,
    features_from,
    q6,
    round_cols,
    with_ctes,
)
from tillsense.sources.retail import ORDER_KEYS, normalize_columns, read_table, retail_transactions
from tillsense.sources.tables import cache_key, materialize, session_cache

RAW_COLS = ["invoiceno", "stockcode", "quantity", "invoicedate", "unitprice", "customerid", "country"] + ORDER_KEYS
FEATURE_OUT = FE.FEATURE_COLUMNS + ORDER_KEYS
OK = ", ".join(ORDER_KEYS)
NEW_BATCH_FROM = "2000-01-01 00:00:00"


def features_of(spark, sf_dir):
    return FE.transactions_features(retail_transactions(spark, sf_dir))


_STORED: dict = session_cache()


def slim_features(spark, sf_dir):
    """T2 written once per session and data folder under the checkpoint
    folder, without the columns that follow from others of their row."""
    key = cache_key(spark, sf_dir)
    if key not in _STORED:
        _STORED[key] = materialize(FE.stored_form(features_of(spark, sf_dir)), "features")
    return _STORED[key]


def stored_features(spark, sf_dir):
    """T2 as every downstream plan reads it back (the reference likewise
    stores its processed table and each stage reads it)."""
    return FE.with_derived(slim_features(spark, sf_dir))


def phase1_of(spark, sf_dir):
    return FE.phase1(retail_transactions(spark, sf_dir))


def rows_of(spark, sf_dir):
    return FE.phase2_rows(phase1_of(spark, sf_dir))


def keyed(df, *cols):
    return round_doubles(df.select(*ORDER_KEYS, *cols))


def sel(ctes: str, cols: list[str], frm: str, doubles: list[str] = (), where: str = "") -> str:
    return with_ctes(ctes, f"SELECT {round_cols(cols, list(doubles))} FROM {frm} {where}")


# ================================================================ A: sources
@register(
    "scan_transactions",
    with_ctes(
        RETAIL,
        "SELECT invoiceno, stockcode, quantity, strftime(invoicedate, '%Y-%m-%d %H:%M:%S') AS invoicedate, "
        f"unitprice, customerid, country, {OK} FROM retail",
    ),
)
def q_scan_transactions(spark, sf_dir):
    r = retail_transactions(spark, sf_dir)
    return r.withColumn("invoicedate", F.date_format("invoicedate", "yyyy-MM-dd HH:mm:ss"))


@register(
    "normalize_columns",
    "SELECT c_custkey AS cust_key, c_name AS cust_name, c_mktsegment AS market_segment, c_acctbal AS acct_bal FROM customer",
)
def q_normalize_columns(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Cust Key"),
        F.col("c_name").alias("Cust__Name"),
        F.col("c_mktsegment").alias("Market Segment"),
        F.col("c_acctbal").alias("acct_bal"),
    )
    return normalize_columns(c)


@register(
    "price_sales_history",
    sel(FEATURES, ["stockcode", "price", "sales", "volume"] + ORDER_KEYS,
        "(SELECT *, unitprice AS price, unitprice * quantity AS sales, quantity AS volume FROM features)",
        ["price", "sales", "volume", "l_quantity", "l_extendedprice"]),
)
def q_price_sales_history(spark, sf_dir):
    f = stored_features(spark, sf_dir)
    return keyed(f, "stockcode", F.col("unitprice").alias("price"), (F.col("unitprice") * F.col("quantity")).alias("sales"), F.col("quantity").alias("volume"))


def _batches(spark, sf_dir):
    raw = retail_transactions(spark, sf_dir)
    cut = F.lit(NEW_BATCH_FROM).cast("timestamp_ntz")
    old = raw.where(F.col("invoicedate") < cut)
    new = raw.where(F.col("invoicedate") >= cut).drop("country")  # a new file without the column
    return old, new


_UNION_SQL = (
    RETAIL
    + f""",
batches AS (
  SELECT * FROM retail WHERE invoicedate < TIMESTAMP '{NEW_BATCH_FROM}'
  UNION ALL
  SELECT * REPLACE (CAST(NULL AS VARCHAR) AS country) FROM retail WHERE invoicedate >= TIMESTAMP '{NEW_BATCH_FROM}'
)"""
)


@register(
    "union_batches",
    with_ctes(
        _UNION_SQL,
        "SELECT invoiceno, stockcode, quantity, strftime(invoicedate, '%Y-%m-%d %H:%M:%S') AS invoicedate, "
        f"unitprice, customerid, country, {OK} FROM batches",
    ),
)
def q_union_batches(spark, sf_dir):
    old, new = _batches(spark, sf_dir)
    u = old.unionByName(new, allowMissingColumns=True)
    return u.select(*RAW_COLS).withColumn("invoicedate", F.date_format("invoicedate", "yyyy-MM-dd HH:mm:ss"))


@register(
    "concat_new_batch",
    with_ctes(_UNION_SQL + "," + features_from("batches"), f"SELECT {round_cols(FEATURE_OUT, FEATURE_DOUBLES)} FROM features"),
)
def q_concat_new_batch(spark, sf_dir):
    old, new = _batches(spark, sf_dir)
    u = old.unionByName(new, allowMissingColumns=True)
    return round_doubles(FE.transactions_features(C.normalize_missing(u)))


# ================================================================ B: projections / filters
_MISSING = "('', 'nan', 'N/A', 'na', 'None', 'none')"


@register(
    "normalize_missing",
    with_ctes(
        RETAIL,
        "SELECT "
        + ", ".join(f"CASE WHEN {c} IN {_MISSING} THEN NULL ELSE {c} END AS {c}" for c in ("invoiceno", "stockcode", "customerid", "country"))
        + f", {OK} FROM retail",
    ),
)
def q_normalize_missing(spark, sf_dir):
    r = C.normalize_missing(retail_transactions(spark, sf_dir), ["invoiceno", "stockcode", "customerid", "country"])
    return r.select("invoiceno", "stockcode", "customerid", "country", *ORDER_KEYS)


@register("canonical_stockcode", sel(PHASE1_ONLY, ["stockcode"] + ORDER_KEYS, "p1a", ["l_quantity", "l_extendedprice"]))
def q_canonical_stockcode(spark, sf_dir):
    return keyed(C.canonical_stockcode(retail_transactions(spark, sf_dir)), "stockcode")


@register(
    "drop_admin_codes_pre",
    sel(PHASE1_ONLY, ["stockcode"] + ORDER_KEYS, "p1a", ["l_quantity", "l_extendedprice"], "WHERE stockcode IS NULL OR stockcode NOT IN ('B', 'CRUK', 'C2')"),
)
def q_drop_admin_codes_pre(spark, sf_dir):
    return keyed(C.drop_admin_codes_pre(C.canonical_stockcode(retail_transactions(spark, sf_dir))), "stockcode")


@register(
    "drop_admin_codes_post",
    sel(PHASE1_ONLY, ["stockcode"] + ORDER_KEYS, "p1", ["l_quantity", "l_extendedprice"], "WHERE stockcode IS NULL OR stockcode NOT IN ('D', 'S')"),
)
def q_drop_admin_codes_post(spark, sf_dir):
    return keyed(C.drop_admin_codes_post(phase1_of(spark, sf_dir)), "stockcode")


@register(
    "prune_columns",
    with_ctes(PHASE1_ONLY, f"SELECT * EXCLUDE (month_name, month, invoicedate) REPLACE ({q6('quantity')} AS quantity, {q6('unitprice')} AS unitprice, {q6('unitprice_vs_max')} AS unitprice_vs_max, {q6('unitprice_to_avg')} AS unitprice_to_avg, {q6('unitprice_squared')} AS unitprice_squared, {q6('unitprice_log')} AS unitprice_log, {q6('product_avg_quantity_last_month')} AS product_avg_quantity_last_month, {q6('product_max_price_all_time')} AS product_max_price_all_time, {q6('l_quantity')} AS l_quantity, {q6('l_extendedprice')} AS l_extendedprice) FROM p1"),
)
def q_prune_columns(spark, sf_dir):
    return round_doubles(C.prune_columns(phase1_of(spark, sf_dir), ["month_name", "month", "invoicedate", "description"]))


@register(
    "calendar_features",
    with_ctes(
        PHASE1_ONLY,
        f"SELECT year, strftime(month, '%Y-%m-%d') AS month, month_name, day_of_week, epoch(invoicedate) AS epoch_seconds, {OK} FROM p1b",
    ),
)
def q_calendar_features(spark, sf_dir):
    df = C.calendar_features(C.drop_admin_codes_pre(C.canonical_stockcode(retail_transactions(spark, sf_dir))))
    return df.select(
        "year", F.date_format("month", "yyyy-MM-dd").alias("month"), "month_name", "day_of_week",
        epoch_seconds("invoicedate").alias("epoch_seconds"), *ORDER_KEYS,
    )


@register(
    "positive_quantity",
    sel(RETAIL, ["quantity"] + ORDER_KEYS, "(SELECT * REPLACE (coalesce(TRY_CAST(quantity AS DOUBLE), 0.0) AS quantity) FROM retail)",
        ["quantity", "l_quantity", "l_extendedprice"], "WHERE quantity > 0"),
)
def q_positive_quantity(spark, sf_dir):
    return keyed(C.positive_quantity(retail_transactions(spark, sf_dir)), "quantity")


@register(
    "price_ratio_features",
    sel(PHASE1_ONLY, ["unitprice_vs_max", "unitprice_to_avg"] + ORDER_KEYS, "p1", ["unitprice_vs_max", "unitprice_to_avg", "l_quantity", "l_extendedprice"]),
)
def q_price_ratio_features(spark, sf_dir):
    return keyed(phase1_of(spark, sf_dir), "unitprice_vs_max", "unitprice_to_avg")


@register(
    "price_shape_features",
    sel(PHASE1_ONLY, ["unitprice_squared", "unitprice_log"] + ORDER_KEYS, "p1", ["unitprice_squared", "unitprice_log", "l_quantity", "l_extendedprice"]),
)
def q_price_shape_features(spark, sf_dir):
    return keyed(phase1_of(spark, sf_dir), "unitprice_squared", "unitprice_log")


@register("log_target", sel(FEATURES, ["quantity"] + ORDER_KEYS, "features", ["quantity", "l_quantity", "l_extendedprice"]))
def q_log_target(spark, sf_dir):
    return keyed(stored_features(spark, sf_dir), "quantity")


@register(
    "registered_flag",
    sel(PHASE1_ONLY, ["is_registered", "customerid"] + ORDER_KEYS, "p1", ["l_quantity", "l_extendedprice"]),
)
def q_registered_flag(spark, sf_dir):
    return keyed(phase1_of(spark, sf_dir), "is_registered", "customerid")


@register(
    "fill_unknown_keys",
    sel(PHASE2_ROWS, ["stockcode", "invoiceno", "customerid"] + ORDER_KEYS, "p2", ["l_quantity", "l_extendedprice"]),
)
def q_fill_unknown_keys(spark, sf_dir):
    return keyed(rows_of(spark, sf_dir), "stockcode", "invoiceno", "customerid")


@register("filter_product", sel(FEATURES, FEATURE_OUT, "features", FEATURE_DOUBLES, "WHERE stockcode = 'M'"))
def q_filter_product(spark, sf_dir):
    return round_doubles(C.filter_product(stored_features(spark, sf_dir), "M"))


_NUM, _CAT = (
    ["invoicedate", "unitprice", "product_avg_quantity_last_month", "product_max_price_all_time",
     "unitprice_vs_max", "unitprice_to_avg", "unitprice_squared", "unitprice_log"],
    ["invoiceno", "stockcode", "customerid", "country", "year", "year_month", "day_of_week", "is_registered"],
)


@register(
    "column_profile",
    with_ctes(
        FEATURES,
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, '{'numeric' if c in _NUM else 'categorical'}' AS role, count(DISTINCT {c}) AS n_distinct FROM features"
            for c in _NUM + _CAT
        ),
    ),
)
def q_column_profile(spark, sf_dir):
    return C.column_profile(stored_features(spark, sf_dir), "quantity", exclude=ORDER_KEYS)


@register(
    "coerce_numeric",
    with_ctes(RETAIL, f"SELECT TRY_CAST(invoiceno AS DOUBLE) AS invoiceno, TRY_CAST(customerid AS DOUBLE) AS customerid, TRY_CAST(country AS DOUBLE) AS country, {OK} FROM retail"),
)
def q_coerce_numeric(spark, sf_dir):
    r = C.coerce_numeric(retail_transactions(spark, sf_dir), ["invoiceno", "customerid", "country"])
    return r.select("invoiceno", "customerid", "country", *ORDER_KEYS)


_X_COLS = [c for c in FEATURE_OUT if c != "quantity"]


@register("split_features_target", sel(FEATURES, _X_COLS, "features", FEATURE_DOUBLES))
def q_split_features_target(spark, sf_dir):
    x, _ = C.split_features_target(stored_features(spark, sf_dir))
    return round_doubles(x)


@register("transactions_features", sel(FEATURES, FEATURE_OUT, "features", FEATURE_DOUBLES))
def q_transactions_features(spark, sf_dir):
    """B17, built and stored once per session; later plans read the stored table."""
    return round_doubles(stored_features(spark, sf_dir))


# ================================================================ C: joins
@register(
    "join_last_month_quantity",
    with_ctes(PHASE1_ONLY, f"SELECT stockcode, strftime(month, '%Y-%m-%d') AS month, {q6('product_avg_quantity_last_month')} AS product_avg_quantity_last_month, {OK} FROM p1"),
)
def q_join_last_month_quantity(spark, sf_dir):
    p = phase1_of(spark, sf_dir)
    return round_doubles(p.select("stockcode", F.date_format("month", "yyyy-MM-dd").alias("month"), "product_avg_quantity_last_month", *ORDER_KEYS))


@register(
    "join_max_price",
    sel(PHASE1_ONLY, ["product_max_price_all_time"] + ORDER_KEYS, "p1", ["product_max_price_all_time", "l_quantity", "l_extendedprice"]),
)
def q_join_max_price(spark, sf_dir):
    return keyed(phase1_of(spark, sf_dir), "product_max_price_all_time")


@register(
    "join_product_imputation",
    sel(FEATURES, ["country", "unitprice"] + ORDER_KEYS, "features", ["unitprice", "l_quantity", "l_extendedprice"]),
)
def q_join_product_imputation(spark, sf_dir):
    return keyed(stored_features(spark, sf_dir), "country", "unitprice")


# ================================================================ D: aggregates
@register(
    "monthly_product_sales",
    with_ctes(PHASE1_ONLY, f"SELECT stockcode, strftime(month, '%Y-%m-%d') AS month, {q6('prod_total_monthly_quantity')} AS prod_total_monthly_quantity, {q6('prod_ave_monthly_price')} AS prod_ave_monthly_price FROM monthly"),
)
def q_monthly_product_sales(spark, sf_dir):
    df = C.calendar_features(C.drop_admin_codes_pre(C.canonical_stockcode(retail_transactions(spark, sf_dir))))
    m = FE.monthly_product_sales(df)
    return round_doubles(m.withColumn("month", F.date_format("month", "yyyy-MM-dd")))


@register("product_max_price", sel(PHASE1_ONLY, ["stockcode", "product_max_price_all_time"], "maxp", ["product_max_price_all_time"]))
def q_product_max_price(spark, sf_dir):
    df = C.calendar_features(C.drop_admin_codes_pre(C.canonical_stockcode(retail_transactions(spark, sf_dir))))
    return round_doubles(FE.product_max_price(df))


@register(
    "product_mode_median",
    with_ctes(
        PHASE2_ROWS + ",\n" + "country_counts AS (SELECT stockcode, country, count(*) AS n FROM p2 WHERE country IS NOT NULL GROUP BY stockcode, country),"
        "mode_country AS (SELECT stockcode, country AS imputed_country FROM (SELECT *, row_number() OVER (PARTITION BY stockcode ORDER BY n DESC, country ASC) AS rn FROM country_counts) WHERE rn = 1),"
        "median_price AS (SELECT stockcode, median(unitprice) AS imputed_unitprice FROM p2 GROUP BY stockcode)",
        f"SELECT k.stockcode, coalesce(m.imputed_country, 'unknown') AS imputed_country, {q6('p.imputed_unitprice')} AS imputed_unitprice "
        "FROM (SELECT DISTINCT stockcode FROM p2) k LEFT JOIN mode_country m ON k.stockcode = m.stockcode LEFT JOIN median_price p ON k.stockcode = p.stockcode",
    ),
)
def q_product_mode_median(spark, sf_dir):
    return round_doubles(FE.product_mode_median(rows_of(spark, sf_dir)))


@register("global_median_price", with_ctes(PHASE2_ROWS, f"SELECT {q6('median(unitprice)')} AS global_median_price FROM p2"))
def q_global_median_price(spark, sf_dir):
    return round_doubles(FE.global_median_price(rows_of(spark, sf_dir)))


# ================================================================ E/F: windows, sorts
@register(
    "last_month_quantity",
    with_ctes(PHASE1_ONLY, f"SELECT stockcode, strftime(month, '%Y-%m-%d') AS month, {q6('lastq')} AS product_avg_quantity_last_month FROM lagged"),
)
def q_last_month_quantity(spark, sf_dir):
    df = C.calendar_features(C.drop_admin_codes_pre(C.canonical_stockcode(retail_transactions(spark, sf_dir))))
    lag = FE.last_month_quantity(FE.monthly_product_sales(df))
    return round_doubles(lag.withColumn("month", F.date_format("month", "yyyy-MM-dd")))


@register(
    "sort_product_month",
    with_ctes(PHASE1_ONLY, f"SELECT stockcode, strftime(month, '%Y-%m-%d') AS month, {q6('prod_total_monthly_quantity')} AS prod_total_monthly_quantity FROM monthly ORDER BY stockcode, month"),
)
def q_sort_product_month(spark, sf_dir):
    df = C.calendar_features(C.drop_admin_codes_pre(C.canonical_stockcode(retail_transactions(spark, sf_dir))))
    m = FE.monthly_product_sales(df).orderBy("stockcode", "month")
    return round_doubles(m.select("stockcode", F.date_format("month", "yyyy-MM-dd").alias("month"), "prod_total_monthly_quantity"))


_LAST_SQL = f"""last_rows AS (
  SELECT stockcode, arg_max(struct_pack(unitprice := unitprice, customerid := customerid, country := country),
                            struct_pack({", ".join(f"k{i} := {c}" for i, c in enumerate(["invoicedate", "invoiceno"] + ORDER_KEYS))})) AS r
  FROM features GROUP BY stockcode
)"""


@register(
    "last_value_per_group",
    with_ctes(FEATURES + "," + _LAST_SQL, f"SELECT stockcode, {q6('r.unitprice')} AS unitprice, r.customerid AS customerid, r.country AS country FROM last_rows"),
)
def q_last_value_per_group(spark, sf_dir):
    f = stored_features(spark, sf_dir)
    return round_doubles(IM.last_value_per_group(f, ["stockcode"], ["unitprice", "customerid", "country"], total_order(f)))


def _row_ids(f):
    return running_total(f, [], [F.col(c).asc_nulls_first() for c in total_order(f)], out="row_id")


_ROWID_SQL = f"ranked AS (SELECT *, row_number() OVER (ORDER BY {TOTAL_ORDER_SQL}) AS row_id FROM features)"
_SAMPLE_SQL = _ROWID_SQL + """,
sample AS (
  SELECT * FROM ranked ORDER BY (row_id * 2654435761 + 42) % 2147483647, row_id LIMIT 1200
)"""


@register(
    "fixed_size_sample",
    with_ctes(FEATURES + "," + _SAMPLE_SQL, f"SELECT row_id, stockcode, {q6('unitprice')} AS unitprice, {q6('quantity')} AS quantity FROM sample"),
)
def q_fixed_size_sample(spark, sf_dir):
    s = PR.fixed_size_sample(_row_ids(stored_features(spark, sf_dir)), "row_id")
    return round_doubles(s.select(F.col("row_id").cast("bigint").alias("row_id"), "stockcode", "unitprice", "quantity"))


# ================================================================ G: set operations (G1 above)
# ================================================================ H: scalar functions
@register(
    "fn_string",
    with_ctes(
        RETAIL,
        "SELECT lower(country) AS country_lower, replace(country, '_', ' ') AS country_spaced, "
        f"stockcode IN ('M', 'D') AS is_listed, CAST(l_orderkey AS VARCHAR) AS invoice_text, {OK} FROM retail",
    ),
)
def q_fn_string(spark, sf_dir):
    r = retail_transactions(spark, sf_dir)
    return r.select(
        F.lower("country").alias("country_lower"), F.replace(F.col("country"), F.lit("_"), F.lit(" ")).alias("country_spaced"),
        F.col("stockcode").isin("M", "D").alias("is_listed"), F.col("l_orderkey").cast("string").alias("invoice_text"), *ORDER_KEYS,
    )


@register(
    "fn_date",
    "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, "
    "strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start, strftime(o_orderdate, '%b') AS month_name, "
    "strftime(o_orderdate, '%a') AS day_name, epoch(o_orderdate) AS epoch_seconds FROM orders",
)
def q_fn_date(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
        F.date_format(F.trunc(F.col("o_orderdate").cast("date"), "month"), "yyyy-MM-dd").alias("month_start"),
        F.date_format("o_orderdate", "MMM").alias("month_name"), F.date_format("o_orderdate", "EEE").alias("day_name"),
        epoch_seconds("o_orderdate").alias("epoch_seconds"),
    )


@register(
    "fn_math",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    + ", ".join(
        f"{q6(e)} AS {n}"
        for e, n in [
            ("ln(1 + l_quantity)", "log1p_qty"), ("pow(l_discount, 2)", "discount_sq"), ("exp(l_tax)", "exp_tax"),
            ("abs(l_quantity - 25)", "abs_dev"), ("least(l_quantity, 10.0)", "clipped_qty"), ("sqrt(l_extendedprice)", "sqrt_price"),
        ]
    )
    + ", CAST(floor(l_extendedprice) AS BIGINT) AS floor_price FROM lineitem",
)
def q_fn_math(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return round_doubles(
        li.select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            F.log1p("l_quantity").alias("log1p_qty"), F.pow("l_discount", 2).alias("discount_sq"), F.exp("l_tax").alias("exp_tax"),
            F.abs(F.col("l_quantity") - 25).alias("abs_dev"), F.least(F.col("l_quantity"), F.lit(10.0)).alias("clipped_qty"),
            F.sqrt("l_extendedprice").alias("sqrt_price"), F.floor("l_extendedprice").alias("floor_price"),
        )
    )


@register(
    "fn_conditional",
    with_ctes(
        RETAIL,
        f"SELECT {q6('coalesce(unitprice, 0.0)')} AS price_or_zero, CASE WHEN quantity < 0 THEN 'return' ELSE 'sale' END AS kind, "
        f"coalesce(customerid, 'unknown') AS customer, {OK} FROM retail",
    ),
)
def q_fn_conditional(spark, sf_dir):
    r = retail_transactions(spark, sf_dir)
    return round_doubles(
        r.select(
            F.coalesce("unitprice", F.lit(0.0)).alias("price_or_zero"),
            F.when(F.col("quantity") < 0, F.lit("return")).otherwise(F.lit("sale")).alias("kind"),
            F.coalesce("customerid", F.lit("unknown")).alias("customer"), *ORDER_KEYS,
        )
    )


@register(
    "fn_linspace",
    with_ctes(
        FEATURES + ", mm AS (SELECT stockcode, min(unitprice) AS lo, max(unitprice) AS hi FROM features GROUP BY stockcode)",
        f"SELECT stockcode, CAST(r.i AS INTEGER) AS bin, {q6('CASE WHEN r.i = 4 THEN hi ELSE r.i * ((hi - lo) / 4) + lo END')} AS price FROM mm, range(0, 5) AS r(i)",
    ),
)
def q_fn_linspace(spark, sf_dir):
    f = stored_features(spark, sf_dir)
    mm = f.groupBy("stockcode").agg(F.min("unitprice").alias("lo"), F.max("unitprice").alias("hi"))
    g = mm.select("stockcode", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("bin"))
    return g.select("stockcode", "bin", round6(linspace_point("lo", "hi", F.col("bin"), 5)).alias("price"))


@register(
    "fn_hash_json",
    with_ctes(
        FEATURES,
        "SELECT stockcode, sha256(concat('[(''num_price_bins'', ''100''), (''stockcode'', ''', stockcode, ''')]')) AS params_hash, "
        "concat('prediction:{', stockcode, '}:', sha256(concat('[(''num_price_bins'', ''100''), (''stockcode'', ''', stockcode, ''')]'))) AS cache_key, "
        "CAST(to_json(struct_pack(stockcode := stockcode, num_price_bins := 100)) AS VARCHAR) AS request_json "
        "FROM (SELECT DISTINCT stockcode FROM features)",
    ),
)
def q_fn_hash_json(spark, sf_dir):
    k = IM.distinct_products(stored_features(spark, sf_dir))
    text = F.concat(F.lit("[('num_price_bins', '100'), ('stockcode', '"), F.col("stockcode"), F.lit("')]"))
    h = F.sha2(text, 256)
    return k.select(
        "stockcode", h.alias("params_hash"), F.concat(F.lit("prediction:{"), F.col("stockcode"), F.lit("}:"), h).alias("cache_key"),
        F.to_json(F.struct(F.col("stockcode"), F.lit(100).alias("num_price_bins"))).alias("request_json"),
    )


_MELT = ["unitprice", "unitprice_vs_max", "unitprice_to_avg", "unitprice_log"]


@register(
    "fn_array",
    with_ctes(
        FEATURES,
        " UNION ALL ".join(f"SELECT {OK}, '{c}' AS feature_name, {q6(c)} AS value FROM features" for c in _MELT),
    ),
)
def q_fn_array(spark, sf_dir):
    f = stored_features(spark, sf_dir).select(*ORDER_KEYS, *_MELT)
    return round_doubles(f.unpivot(ORDER_KEYS, _MELT, "feature_name", "value"))


@register(
    "fn_numeric_test",
    with_ctes(
        FEATURES,
        "SELECT coalesce(isnan(unitprice_vs_max), false) AS ratio_is_nan, coalesce(isinf(unitprice_to_avg), false) AS ratio_is_inf, "
        f"coalesce(unitprice_to_avg = 0, false) AS ratio_is_zero, coalesce(isnan(exp(quantity)) OR isinf(exp(quantity)), false) AS pred_nonfinite, {OK} FROM features",
    ),
)
def q_fn_numeric_test(spark, sf_dir):
    f = stored_features(spark, sf_dir)
    return f.select(
        F.coalesce(F.isnan("unitprice_vs_max"), F.lit(False)).alias("ratio_is_nan"),
        F.coalesce(F.abs(F.col("unitprice_to_avg")) == float("inf"), F.lit(False)).alias("ratio_is_inf"),
        F.coalesce(F.col("unitprice_to_avg") == 0, F.lit(False)).alias("ratio_is_zero"),
        F.coalesce(is_nonfinite(F.exp("quantity")), F.lit(False)).alias("pred_nonfinite"),
        *ORDER_KEYS,
    )


# ================================================================ J: pricing
_PRICING = FEATURES + "," + PRICING


def _pricing_parts(spark, sf_dir):
    f = stored_features(spark, sf_dir)
    stats = PR.price_stats(f)
    grid = PR.price_grid(PR.price_bounds(stats))
    return f, grid, PR.demand_plane_by_product(f), PR.product_sample(f)


@register(
    "price_recommendation",
    with_ctes(
        _PRICING,
        f"SELECT c.stockcode, {q6('c.unit_price')} AS unit_price, CAST(trunc(c.quantity_avg) AS BIGINT) AS quantity, "
        "CAST(c.quantity_min AS BIGINT) AS quantity_min, CAST(c.quantity_max AS BIGINT) AS quantity_max, "
        f"{q6('c.sales')} AS predicted_sales, {q6('b.optimal_unit_price')} AS optimal_unit_price, "
        f"{q6('b.max_predicted_sales')} AS max_predicted_sales "
        "FROM curve c JOIN best b ON c.stockcode = b.stockcode",
    ),
)
def q_price_recommendation(spark, sf_dir):
    return round_doubles(PR.price_recommendation(stored_features(spark, sf_dir)))


@register("price_bounds", sel(_PRICING, ["stockcode", "price_lo", "price_hi"], "bounds", ["price_lo", "price_hi"]))
def q_price_bounds(spark, sf_dir):
    return round_doubles(PR.price_bounds(PR.price_stats(stored_features(spark, sf_dir))))


# request with explicit parameters (min 30, max 10 -> swapped, no widening)
@register("price_bounds_params", with_ctes(FEATURES, "SELECT DISTINCT stockcode, 10.0 AS price_lo, 30.0 AS price_hi FROM features"))
def q_price_bounds_params(spark, sf_dir):
    return round_doubles(PR.price_bounds(PR.price_stats(stored_features(spark, sf_dir)), unitprice_min=30.0, unitprice_max=10.0))


@register("price_grid", sel(_PRICING, ["stockcode", "bin", "unit_price"], "grid", ["unit_price"]))
def q_price_grid(spark, sf_dir):
    _, grid, _, _ = _pricing_parts(spark, sf_dir)
    return round_doubles(grid)


@register(
    "demand_model_by_product",
    sel(_PRICING, ["stockcode", "slope", "intercept", "n_obs", "global_slope", "global_intercept", "uses_global"], "model",
        ["slope", "intercept", "global_slope", "global_intercept"]),
)
def q_demand_model_by_product(spark, sf_dir):
    return round_doubles(PR.demand_model_by_product(stored_features(spark, sf_dir)))


@register("score_failover", sel(_PRICING, ["stockcode", "bin", "unit_price", "sample_no", "y_pred", "use_backup"], "scored", ["unit_price", "y_pred"]))
def q_score_failover(spark, sf_dir):
    _, grid, model, sample = _pricing_parts(spark, sf_dir)
    return round_doubles(PR.score_grid(grid, model, sample).select("stockcode", "bin", "unit_price", "sample_no", "y_pred", "use_backup"))


_CURVE_COLS = ["stockcode", "unit_price", "quantity_avg", "quantity_min", "quantity_max", "sales"]


@register(
    "price_curve",
    with_ctes(_PRICING, f"SELECT stockcode, {q6('unit_price')} AS unit_price, {q6('quantity_avg')} AS quantity_avg, CAST(quantity_min AS BIGINT) AS quantity_min, CAST(quantity_max AS BIGINT) AS quantity_max, {q6('sales')} AS sales FROM curve"),
)
def q_price_curve(spark, sf_dir):
    _, grid, model, sample = _pricing_parts(spark, sf_dir)
    return round_doubles(PR.price_curve(PR.score_grid(grid, model, sample)))


@register(
    "sort_price_curve",
    with_ctes(_PRICING, f"SELECT stockcode, {q6('unit_price')} AS unit_price, {q6('sales')} AS sales FROM curve ORDER BY stockcode, unit_price"),
)
def q_sort_price_curve(spark, sf_dir):
    _, grid, model, sample = _pricing_parts(spark, sf_dir)
    return round_doubles(PR.sort_price_curve(PR.price_curve(PR.score_grid(grid, model, sample)).select("stockcode", "unit_price", "sales")))


@register("optimal_price", sel(_PRICING, ["stockcode", "optimal_unit_price", "max_predicted_sales"], "best", ["optimal_unit_price", "max_predicted_sales"]))
def q_optimal_price(spark, sf_dir):
    _, grid, model, sample = _pricing_parts(spark, sf_dir)
    return round_doubles(PR.optimal_price(PR.price_curve(PR.score_grid(grid, model, sample))))


@register(
    "cross_sample_prices",
    with_ctes(
        _PRICING,
        f"SELECT s.stockcode, s.sample_no, g.bin, {q6('g.unit_price')} AS unit_price, {q6('s.momentum')} AS momentum "
        "FROM psample s JOIN grid g ON s.stockcode = g.stockcode",
    ),
)
def q_cross_sample_prices(spark, sf_dir):
    _, grid, _, sample = _pricing_parts(spark, sf_dir)
    return round_doubles(PR.cross_sample_prices(sample, grid).select("stockcode", "sample_no", "bin", "unit_price", "momentum"))


# ================================================================ D5-D7, C4: product statistics
_ORDER_STRUCT = "struct_pack(" + ", ".join(f"k{i} := {c}" for i, c in enumerate(["invoicedate", "invoiceno"] + ORDER_KEYS)) + ")"
_STATS_SQL = f""",
pstats AS (
  SELECT stockcode, median(unitprice) AS unitprice_median, max(unitprice) AS unitprice_max, min(unitprice) AS unitprice_min,
         arg_max(product_avg_quantity_last_month, {_ORDER_STRUCT}) AS product_avg_quantity_last_month
  FROM features GROUP BY stockcode
),
pcountry AS (
  SELECT stockcode, country FROM (
    SELECT stockcode, country, row_number() OVER (PARTITION BY stockcode ORDER BY count(*) DESC, country ASC) AS rn
    FROM features WHERE country IS NOT NULL GROUP BY stockcode, country) WHERE rn = 1
),
stats_table AS (
  SELECT s.stockcode, s.unitprice_median, s.unitprice_max, s.unitprice_min, c.country, s.product_avg_quantity_last_month
  FROM pstats s LEFT JOIN pcountry c ON s.stockcode = c.stockcode
),
cust_daily AS (
  SELECT customerid, CAST(floor(invoicedate / 86400) AS BIGINT) AS day,
         sum(CAST(round(exp(quantity) - 1.0) * unitprice AS DECIMAL(38, 8))) AS spend, count(DISTINCT invoiceno) AS invoices
  FROM features GROUP BY customerid, day
),
cust_measures AS (
  SELECT customerid, day,
         CAST(day - lag(day) OVER (PARTITION BY customerid ORDER BY day) AS DOUBLE) AS customer_recency_days,
         CAST(sum(spend) OVER (PARTITION BY customerid ORDER BY day RANGE BETWEEN 364 PRECEDING AND CURRENT ROW) AS DOUBLE) AS customer_total_spend_ltm,
         sum(invoices) OVER (PARTITION BY customerid ORDER BY day RANGE BETWEEN 364 PRECEDING AND CURRENT ROW) AS customer_freq_ltm
  FROM cust_daily
),
activity AS (
  SELECT f.*, m.customer_recency_days, m.customer_total_spend_ltm, m.customer_freq_ltm
  FROM features f LEFT JOIN cust_measures m
    ON f.customerid = m.customerid AND CAST(floor(f.invoicedate / 86400) AS BIGINT) = m.day
),
latest AS (
  SELECT stockcode, customerid,
         arg_max(struct_pack(a := customer_recency_days, b := customer_total_spend_ltm, c := customer_freq_ltm), {_ORDER_STRUCT}) AS r
  FROM activity GROUP BY stockcode, customerid
)"""
_STATS_COLS = ["stockcode", "unitprice_median", "unitprice_max", "unitprice_min", "country", "product_avg_quantity_last_month"]
_STATS_DBL = ["unitprice_median", "unitprice_max", "unitprice_min", "product_avg_quantity_last_month"]
_LATEST_SEL = (
    f"l.stockcode, l.customerid, l.r.a AS customer_recency_days_latest, {q6('l.r.b')} AS customer_total_spend_ltm_latest, "
    "CAST(l.r.c AS BIGINT) AS customer_freq_ltm_latest"
)


def _stats_parts(spark, sf_dir):
    f = stored_features(spark, sf_dir)
    order = total_order(f)
    return f, IM.product_price_stats(f, order), order


@register("product_price_stats", with_ctes(FEATURES + _STATS_SQL, f"SELECT {round_cols(_STATS_COLS, _STATS_DBL)} FROM stats_table"))
def q_product_price_stats(spark, sf_dir):
    _, stats, _ = _stats_parts(spark, sf_dir)
    return round_doubles(stats)


@register("customer_latest_by_product", with_ctes(FEATURES + _STATS_SQL, f"SELECT {_LATEST_SEL} FROM latest l"))
def q_customer_latest_by_product(spark, sf_dir):
    f = stored_features(spark, sf_dir)
    return round_doubles(IM.customer_latest_by_product(IM.customer_activity(f), total_order(f)))


@register("distinct_products", with_ctes(FEATURES, "SELECT DISTINCT stockcode FROM features"))
def q_distinct_products(spark, sf_dir):
    return IM.distinct_products(stored_features(spark, sf_dir))


@register(
    "cross_stats_customers",
    with_ctes(
        FEATURES + _STATS_SQL,
        "SELECT " + ", ".join(f"{q6('s.' + c)} AS {c}" for c in _STATS_DBL)
        + f", s.country, {_LATEST_SEL} FROM stats_table s JOIN latest l ON s.stockcode = l.stockcode",
    ),
)
def q_cross_stats_customers(spark, sf_dir):
    f, stats, order = _stats_parts(spark, sf_dir)
    latest = IM.customer_latest_by_product(IM.customer_activity(f), order)
    return round_doubles(IM.cross_stats_customers(stats, latest))
