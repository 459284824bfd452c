"""The feature table T2 and its building blocks.

Phase order follows the reference (trap K15): the monthly lag and the
all-time max price see the rows before the quantity filter; the product
mode/median imputation sees the rows after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillsense.functions.exprs import epoch_seconds, not_in_keep_null
from tillsense.operators import cleaning as C
from tillsense.operators.ranking import HOT_ROWS, HOT_SAMPLE, exact_median, mode_by, spread_by
from tillsense.sources.tables import materialize

FEATURE_COLUMNS = [
    "invoiceno", "stockcode", "quantity", "invoicedate", "unitprice", "customerid", "country",
    "year", "year_month", "day_of_week", "product_avg_quantity_last_month",
    "product_max_price_all_time", "unitprice_vs_max", "unitprice_to_avg",
    "unitprice_squared", "unitprice_log", "is_registered",
]


#: Columns that follow from the others of a row: a stored feature table and the
#: exchanges of its rows leave them out (``stored_form``, ``with_derived``).
DERIVED = ["year", "year_month", "day_of_week", "unitprice_vs_max", "unitprice_to_avg", "unitprice_squared", "unitprice_log", "is_registered"]
OWN_PRICE, OWN_CUSTOMER = "_own_price", "_own_customer"

# True where a price is the global median: neither the row nor its product has one.
GLOBAL_PRICE = "price_is_global"


def monthly_product_sales(df: DataFrame, with_max_price: bool = False) -> DataFrame:
    """Per (stockcode, month): total quantity (all-NULL -> 0, trap K26)
    and mean price; NULL keys dropped (trap K6). ``with_max_price`` also
    keeps the month's max price so D2 can be derived without another pass
    over the transactions."""
    aggs = [
        F.coalesce(F.sum("quantity"), F.lit(0.0)).alias("prod_total_monthly_quantity"),
        F.avg("unitprice").alias("prod_ave_monthly_price"),
    ]
    if with_max_price:
        aggs.append(F.max("unitprice").alias("_month_max_price"))
    return (
        df.where(F.col("stockcode").isNotNull() & F.col("month").isNotNull())
        .groupBy("stockcode", "month")
        .agg(*aggs)
    )


def last_month_quantity(monthly: DataFrame) -> DataFrame:
    """Previous *present* month's total per product (lag 1 by month).

    The window runs on the monthly aggregate (one row per product-month),
    so a hot product holds at most one row per month here.
    """
    w = Window.partitionBy("stockcode").orderBy("month")
    return monthly.select(
        "stockcode", "month",
        F.lag("prod_total_monthly_quantity", 1).over(w).alias("product_avg_quantity_last_month"),
    )


def join_last_month_quantity(df: DataFrame, lagged: DataFrame) -> DataFrame:
    """Left join on (stockcode, month), miss -> 0."""
    return df.join(lagged, ["stockcode", "month"], "left").withColumn(
        "product_avg_quantity_last_month", F.coalesce(F.col("product_avg_quantity_last_month"), F.lit(0.0))
    )


def product_max_price(df: DataFrame) -> DataFrame:
    """Max price per product (NULL key dropped)."""
    return df.where(F.col("stockcode").isNotNull()).groupBy("stockcode").agg(
        F.max("unitprice").alias("product_max_price_all_time")
    )


def join_max_price(df: DataFrame) -> DataFrame:
    """Left join of the all-time max. Aggregate + join instead of a
    per-product window: the aggregate combines map-side and AQE splits a
    skewed join partition, where a window would put a hot product in one task."""
    return df.join(product_max_price(df), "stockcode", "left")


def product_mode_median(df: DataFrame) -> DataFrame:
    """D3: modal country (smallest on ties, none -> 'unknown') and median price."""
    mode = mode_by(df, ["stockcode"], "country", out="imputed_country")
    med = exact_median(df, "unitprice", ["stockcode"], out="imputed_unitprice")
    keys = df.select("stockcode").distinct()
    return (
        keys.join(mode, "stockcode", "left")
        .join(med, "stockcode", "left")
        .withColumn("imputed_country", F.coalesce(F.col("imputed_country"), F.lit("unknown")))
    )


def global_median_price(df: DataFrame) -> DataFrame:
    """Median price of all rows, as a one-row DataFrame."""
    return exact_median(df, "unitprice", [], out="global_median_price")


def product_imputation(df: DataFrame) -> DataFrame:
    """Modal country and median price per product, joined with each other, so
    the rows take one join, not two."""
    mode = mode_by(df, ["stockcode"], "country", out="imputed_country")
    med = exact_median(df, "unitprice", ["stockcode"], out="imputed_unitprice")
    return mode.join(med, "stockcode", "full")


def join_product_imputation(df: DataFrame, global_median=None, per_product: DataFrame | None = None) -> DataFrame:
    """Country <- product mode; price <- product median <- global median.

    ``global_median`` overrides the table's own median (a refresh of some
    products passes the median of all rows), ``per_product`` its own mode and
    median. ``GLOBAL_PRICE`` marks the rows whose price is the global one."""
    # one value for the whole table: a scalar subquery, run once, no join
    gmed = global_median_price(df).scalar() if global_median is None else global_median
    per_product = product_imputation(df) if per_product is None else per_product
    return imputed(df.join(per_product, "stockcode", "left"), gmed)


def imputed(df: DataFrame, gmed) -> DataFrame:
    """Rows that carry their product's values, imputed."""
    return df.withColumns(
        {
            "country": F.coalesce(F.col("country"), F.col("imputed_country"), F.lit("unknown")),
            "unitprice": F.coalesce(F.col("unitprice"), F.col("imputed_unitprice"), gmed),
            GLOBAL_PRICE: F.col("unitprice").isNull() & F.col("imputed_unitprice").isNull(),
        }
    ).drop("imputed_country", "imputed_unitprice")


def monthly_totals(df: DataFrame) -> DataFrame:
    """Quantity and highest price per (stockcode, month); they add up over
    batches. The NULL month (unparsable date) is a group of its own."""
    return (
        df.where(F.col("stockcode").isNotNull())
        .groupBy("stockcode", "month")
        .agg(
            F.coalesce(F.sum("quantity"), F.lit(0.0)).alias("_q"),
            F.max("unitprice").alias("_maxp"),
        )
    )


def monthly_product_features(monthly: DataFrame) -> DataFrame:
    """Lag (E1) and all-time max price (D2) as ONE table keyed by (stockcode,
    month), so the rows take a single join for both.

    One aggregate per (stockcode, month) (``monthly_totals``: the NULL month is
    kept, so the max sees every row of the product as D2 does, while its
    quantity never feeds a lag), then one window per product over that
    aggregate (at most one row per month). The rows join it with a null-safe
    month key."""
    w = Window.partitionBy("stockcode").orderBy("month")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return monthly.select(
        F.col("stockcode").alias("_mstock"),
        F.col("month").alias("_mmonth"),
        # NULL months sort first; masking them keeps the first dated month's lag NULL
        F.lag(F.when(F.col("month").isNotNull(), F.col("_q")), 1).over(w).alias("_lastq"),
        F.max("_maxp").over(whole).alias("product_max_price_all_time"),
    )


def stored_form(features: DataFrame) -> DataFrame:
    """Feature rows without ``DERIVED``, and with two flags of what the row had
    itself before it was imputed."""
    own = {OWN_PRICE: F.col("unitprice_squared").isNotNull(), OWN_CUSTOMER: F.col("is_registered") == 1}
    return features.withColumns(own).drop(*DERIVED)


def with_derived(stored: DataFrame) -> DataFrame:
    """The feature rows of ``stored_form``, whole again, in their order of columns;
    further columns stay behind them."""
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("invoicedate") / 86400).cast("int"))
    price = F.col("unitprice")
    df = stored.withColumns(
        {
            "year": F.year(day),
            "year_month": F.month(day),
            "day_of_week": F.date_format(day, "EEE"),
            "is_registered": F.col(OWN_CUSTOMER).cast("int"),
            "_imputed_price": price,
            "unitprice": F.when(F.col(OWN_PRICE), price),  # the price's features are those of the row's own price
        }
    )
    df = C.price_shape_features(C.price_ratio_features(df)).withColumn("unitprice", F.col("_imputed_price"))
    return df.select(*FEATURE_COLUMNS, *[c for c in stored.columns if c not in (*FEATURE_COLUMNS, OWN_PRICE, OWN_CUSTOMER)])


def phase1_rows(raw: DataFrame) -> DataFrame:
    """Rows after code cleaning with calendar columns."""
    df = C.canonical_stockcode(raw)
    df = C.drop_admin_codes_pre(df)
    df = C.prune_columns(df, ["description"])
    return C.calendar_features(df)


def phase1(raw: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Rows after code cleaning with calendar, momentum and price features,
    before the quantity filter. ``totals`` overrides the rows' own monthly
    totals (a refresh passes those of its merged state)."""
    df = phase1_rows(raw)
    return _with_month_features(df, monthly_product_features(monthly_totals(df) if totals is None else totals))


def _with_month_features(df: DataFrame, feats: DataFrame) -> DataFrame:
    """Momentum and price features of rows; further columns of ``feats`` stay."""
    cond = (F.col("stockcode") == F.col("_mstock")) & F.col("month").eqNullSafe(F.col("_mmonth"))
    return _price_features(df.join(feats, cond, "left").drop("_mstock", "_mmonth"))


def _price_features(df: DataFrame) -> DataFrame:
    """Features of rows that carry ``_lastq`` and the product's highest price."""
    df = df.withColumn(
        "product_avg_quantity_last_month",
        F.coalesce(F.when(F.col("month").isNotNull(), F.col("_lastq")), F.lit(0.0)),
    ).drop("_lastq")
    df = C.price_ratio_features(df)
    df = C.price_shape_features(df)
    return C.registered_flag(df)


def with_product_values(df: DataFrame, feats: DataFrame, per_product: DataFrame) -> DataFrame:
    """``df`` with its (product, month) features and its product's mode and median.
    The two tables are joined with each other, so the rows take one join. Rows
    without a code have no month features; their product is 'unknown'."""
    table = feats.join(per_product.withColumnRenamed("stockcode", "_pstock"), F.col("_mstock") == F.col("_pstock"), "left").drop("_pstock")
    names = ("imputed_country", "imputed_unitprice")
    first = [F.max(c).alias(c) for c in names]  # one row at most
    uncoded = per_product.where(F.col("stockcode") == "unknown").agg(*first).select(F.struct(*names).alias("s")).scalar()
    out = _with_month_features(df, table)
    return out.withColumns({c: F.when(F.col("stockcode").isNull(), uncoded.getField(c)).otherwise(F.col(c)) for c in names})


def phase2_rows(df: DataFrame) -> DataFrame:
    """Rows of phase 2 before the product imputation (post codes dropped,
    positive quantity, typed calendar columns, keys filled)."""
    df = C.drop_admin_codes_post(df)
    df = C.prune_columns(df, ["month_name"])
    df = C.positive_quantity(df)
    df = df.withColumns({"year_month": F.month("invoicedate"), "invoicedate": epoch_seconds("invoicedate")}).drop("month")
    return C.fill_unknown_keys(df)


def imputation_rows_price(raw: DataFrame) -> DataFrame:
    """Prices of the raw rows that survive to the imputation step (codes and
    quantity filters only: phase 1 does not change prices)."""
    df = C.drop_admin_codes_post(C.drop_admin_codes_pre(C.canonical_stockcode(raw)))
    return C.positive_quantity(df).select("unitprice")


def _product():
    """The product of a raw row; rows without a code belong to 'unknown'."""
    return F.coalesce(F.when(F.col("stockcode") == "m", F.lit("M")).otherwise(F.col("stockcode")), F.lit("unknown"))


def hot_products(raw: DataFrame, hot_rows: int = HOT_ROWS) -> list[str]:
    """Products with about ``hot_rows`` rows and more (total rows / ``hot_rows`` of
    them at most), told by a sample: a product gets the same values on either way."""
    share = min(1.0, HOT_SAMPLE / hot_rows)
    counts = raw.select(_product().alias("_p")).sample(share, 7).groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    return [r["_p"] for r in counts.where(F.col("_n") >= hot_rows * share).collect()]


def windowed_rows(raw: DataFrame, n: int = 0) -> DataFrame:
    """Rows of phase 2 with their product's values by windows: one exchange to the
    product, of the raw columns only, and no joins. A product's rows are sorted in one
    task, and may spill; ``n`` is the number of rows, where it is known."""
    df = C.drop_admin_codes_pre(C.canonical_stockcode(raw))
    df = C.calendar_features(spread_by(df, [_product()], n))
    coded = F.col("stockcode").isNotNull()
    price = F.col("unitprice")
    kept = not_in_keep_null("stockcode", C.ADMIN_CODES_POST) & (F.coalesce(F.col("quantity").try_cast("double"), F.lit(0.0)) > 0)
    df = df.withColumns(
        {
            "_p": _product(),
            "_m": F.year("month") * 12 + F.month("month"),
            "_kept": kept,
            "_v": F.when(kept & ~F.isnan(price.cast("double")), price.cast("double")),
        }
    ).drop("year", "month", "month_name", "day_of_week")
    month = Window.partitionBy("_p", "_m")
    by_month = Window.partitionBy("_p").orderBy("_m")
    whole = by_month.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # a month is present where a row with a code is in it; rows without a date have none
    present = F.col("_m").isNotNull() & (F.count(F.when(coded, 1)).over(month) > 0)
    df = df.withColumn("_q", F.when(present, F.coalesce(F.sum(F.when(coded, F.col("quantity"))).over(month), F.lit(0.0))))
    df = df.withColumns(
        {
            "_lastq": F.last("_q", ignorenulls=True).over(by_month.rangeBetween(Window.unboundedPreceding, -1)),
            "product_max_price_all_time": F.max(F.when(coded, price)).over(whole),
            "_n": F.count("_v").over(whole),
        }
    )
    df = df.withColumn("_c", F.count(F.when(F.col("_kept"), 1)).over(Window.partitionBy("_p", "country")))
    df = df.withColumn("_rn", F.row_number().over(Window.partitionBy("_p").orderBy(F.col("_v").asc_nulls_last())))
    product = Window.partitionBy("_p")
    middle = [F.max(F.when(F.col("_rn") == rank((F.col("_n") + 1) / 2), F.col("_v"))).over(product) for rank in (F.floor, F.ceil)]
    often = F.when(F.col("_kept") & F.col("country").isNotNull(), F.struct((-F.col("_c")).alias("n"), F.col("country").alias("v")))
    df = df.withColumns({"_a": middle[0], "_b": middle[1], "_mode": F.min(often).over(product)})
    df = df.where("_kept").withColumns(
        {
            "imputed_country": F.col("_mode.v"),
            "imputed_unitprice": F.col("_a") + F.lit(0.5) * (F.col("_b") - F.col("_a")),
            "product_max_price_all_time": F.when(coded, F.col("product_max_price_all_time")),
            "_lastq": F.when(coded, F.col("_lastq")),
        }
    )
    df = df.drop("_p", "_m", "_kept", "_v", "_q", "_n", "_c", "_rn", "_a", "_b", "_mode")
    return phase2_rows(_price_features(C.calendar_features(df)))


def joined_rows(rows: DataFrame, totals: DataFrame | None = None, per_product: DataFrame | None = None) -> DataFrame:
    """Rows of phase 2 (``rows`` are those of phase 1) joined with the values of
    their product, which are aggregated from the rows where they are not given."""
    totals = monthly_totals(rows) if totals is None else totals
    per_product = product_imputation(phase2_rows(rows).select("stockcode", "unitprice", "country")) if per_product is None else per_product
    # the filters of phase 2 go first: the values they would change come from the
    # tables, and the rows cross one exchange, to both tables at once
    df = C.positive_quantity(C.drop_admin_codes_post(rows))
    return phase2_rows(with_product_values(df, monthly_product_features(totals), per_product))


def transactions_features(
    raw: DataFrame, global_median=None, price_source: bool = False, totals: DataFrame | None = None, per_product: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The full feature table T2 (plus any lineage columns of ``raw``);
    with ``price_source`` also ``GLOBAL_PRICE``. The rows cross one exchange, to
    their product; those of hot products are joined with their aggregates. Given
    what the products' rows add up to (``totals``, ``per_product``,
    ``global_median``), the rows are only joined with it and not aggregated."""
    raw = raw.drop("description")
    if totals is None or per_product is None or global_median is None:
        # the hot products, the global median and the rows read this: write it once,
        # without derived columns, instead of re-running the source joins
        raw = materialize(raw, "features_raw")
    rows = phase1_rows(raw)
    kept = phase2_rows(rows).select("stockcode", "unitprice", "country")
    gmed = global_median_price(kept).scalar() if global_median is None else global_median
    if totals is None and per_product is None:
        hot = hot_products(raw, hot_rows)
        df = windowed_rows(raw.where(~_product().isin(hot)) if hot else raw, raw.count())
        if hot:
            df = df.unionByName(joined_rows(phase1_rows(raw.where(_product().isin(hot)))))
    else:
        df = joined_rows(rows, totals, per_product)
    df = imputed(df, gmed)
    df = C.log_target(df)
    extra = [c for c in raw.columns if c not in FEATURE_COLUMNS and c not in ("description",)]
    return df.select(*FEATURE_COLUMNS, *extra, *([GLOBAL_PRICE] if price_source else []))
